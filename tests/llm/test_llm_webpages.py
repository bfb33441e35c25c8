import html
import re

import pytest
from llm_cases import SF

from logloom.llm import registry, webpages

SCHEMA = "page_id bigint, url string, html string"


def test_query_extracts_whole_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = registry.QUERIES["op6_html_extraction"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        source = pages[r.page_id].html
        article = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><meta charset=utf-8><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body class="page-17 has-sidebar"><div class="top-nav"><a href=/>Home</a><a href=/b>About us and more of the same</a></div>
<header><h1>Site name that is long enough to matter</h1></header>
<div id="cookie-notice"><p>We use cookies on this site, please agree to this long text.</p></div>
<div class="layout"><div class="post-4711 entry"><h1>Title {n}</h1><p>First <b>bold</b> text&nbsp;of {n}, with   blanks &lt;here&gt; &eacute;&#233;.
<p>Second paragraph<br>after a break, see <a href=x>this</a>.<ul><li>one<li>two</ul>
<form><p>Your name</p><input></form><div class="advert"><p>Buy this, buy that, buy it all today.</p></div>
<blockquote>Quoted words.</blockquote><!-- <p>hidden</p> --></div>
<div class="sidebar"><p>Other stories that are quite long too, so that length alone is no guide at all here.</p></div>
<section class="comments"><p>Reader: I think that this is a very long comment, longer than the article itself, by far, really.</p></section></div>
<footer>(c) {n}</footer></body></html>"""
TEXT = "Title {n}\nFirst bold text of {n}, with blanks <here> éé.\nSecond paragraph after a break, see this.\none\ntwo\nQuoted words."


def test_a_full_page(spark):
    pages = [(i, f"https://www.Host.example/a/{i}", PAGE.replace("{n}", str(i))) for i in range(5)]
    found = {r.page_id: r.text for r in webpages.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert found == {i: TEXT.replace("{n}", str(i)) for i in range(5)}


def test_a_hosts_consensus_overrules_one_page(spark):
    frame = "<body><div class='a'><p>{a}</p></div><div class='b1'><p>{b}</p></div></body>"
    pages = [(i, "http://h/x", frame.format(a="short", b="the long main text of the page " * 3)) for i in range(9)]
    pages.append((9, "http://h/y", frame.format(a="an unusual long teaser " * 9, b="brief main text")))
    pages.append((10, "http://other/y", frame.format(a="an unusual long teaser " * 9, b="brief main text")))
    pages.append((11, "http://h/z", "<body><main><p>no such path</p></main>"))
    found = {r.page_id: r.text for r in webpages.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert found[9] == "brief main text" and found[10].startswith("an unusual") and found[11] == "no such path"


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain words only", "plain words only"),
        ("<p>open <i>tags", "open tags"),
        ("<p>a</p></div></p>b", "a\nb"),
        ("<article><p>x &amp y &#x41; &bogus;</article>", "x & y A &bogus;"),
        ("<script>never closed <p>a", ""),
        ("<head><title>t</title><body><p>late", "late"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a\nb\nc"),
        ("<div\tclass=ads><p>x</p></div><div><p>y</p></div>", "y"),
        ("<p>cut <a href='x", "cut"),
    ],
)
def test_markup(source, text):
    assert webpages.main_text(source, []) == text


def test_very_long_and_deep_pages():
    assert webpages.main_text("<div>" * 3000 + "<p>x</p>", []) in ("x", "")
    long = "<article>" + "<p>some words</p>" * 50_000 + "</article>"
    assert len(webpages.main_text(long, [])) == 50_000 * 11 - 1


def test_messy_rows(spark):
    pages = [(1, None, None), (2, "no url", "<p>x"), (None, None, "<p>y"), (3, "http://h/", ""), (3, "http://h/", ""), (4, "http://h/", "<<<>>>&&&")]
    table = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "'x' AS text", "'x' AS host", "'x' AS paths", "1 AS n_chars")
    found = sorted(map(tuple, webpages.extract(table).collect()), key=repr)
    assert [(r[0], r[2], r[3]) for r in found if r[0] != 4] == sorted([(1, "", 0), (2, "x", 1), (None, "y", 1), (3, "", 0), (3, "", 0)], key=repr)
    assert webpages.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "frame",
    ["<div class='content with-sidebar'>", "<div class='content-sidebar-wrap'>", "<div class='no-sidebar main'>", "<div class='layout has-comments'>", "<div class='elementor-widget-text'>",
     "<form action=/>", "<div class='widget'>", "<div id=page-header>"],
)
def test_a_frame_named_like_boilerplate_keeps_its_article(frame):
    source = f"<body><nav><a href=/>Home</a></nav>{frame}<h1>Title</h1><p>The long text of the article.</p><div class=sidebar><p>Aside.</p></div>"
    assert webpages.main_text(source, []) == "Title\nThe long text of the article."


def test_text_is_never_lost_as_a_whole():
    assert webpages.main_text("<body><div class=sidebar><p>one</p></div><div class=widget><p>two</p></div>", []) == "one\ntwo"
    assert webpages.main_text("<body><aside><p>all there is</p></aside>", []) == "all there is"


def test_title_lead_and_smaller_sections_stay_with_the_body(spark):
    long = "A long sentence of the body of this article. " * 9
    page = "<body><div class=menu-box><a href=/>Home and more</a></div><article><h1>Title</h1><p class=lead>Lead.</p><div class=body><p>{}</p></div></article></body>"
    two = "<body><article><h1>T</h1><section class=a><p>Short part.</p></section><section class=b><p>{}</p></section></article></body>"
    pages = [(i, f"http://{host}/{i}", html.format(long + str(i))) for host, html in (("one", page), ("two", two)) for i in range(3)]
    found = {(r.url[7:10], r.page_id): r.text for r in webpages.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(found["one", i] == f"Title\nLead.\n{long}{i}" and found["two", i] == f"T\nShort part.\n{long}{i}" for i in range(3))
    linked = "<div><div class=x><p>Some words of the text.</p></div><p><a href=1>Another page of this site</a></p></div>"
    assert webpages.main_text(linked, []) == "Some words of the text."


ARTICLE = "<h1>Title</h1><p>The first paragraph of the article, which is long enough.</p><p>And the second one.</p>"
WHOLE = "Title\nThe first paragraph of the article, which is long enough.\nAnd the second one."
COMMENTS = "<div class=item><p>Ann: I do not agree.</p></div><div class=item><p>Bob: I do.</p></div>"


@pytest.mark.parametrize(
    "inside, text",
    [
        (f"{ARTICLE}<section class=discussion><h3>Discussion</h3>{COMMENTS}</section>", WHOLE),
        (f"{ARTICLE}<section class=discussion><p>Ann: I do not agree.</p></section>", WHOLE),
        (f"{ARTICLE}<section class=user-comments-list>{COMMENTS}</section>", WHOLE),
        (f"{ARTICLE}<div class=recirc><a href=1>Another story</a> <a href=2>And one more</a></div>", WHOLE),
        (f"{ARTICLE}<div class=recirc><ul><li><a href=1>Another story</a><li><a href=2>And one more</a></ul></div>", WHOLE),
        (f"{ARTICLE}<div class=social-history><p>She grew up on a farm.</p></div>", f"{WHOLE}\nShe grew up on a farm."),
        (f"{ARTICLE}<section id=notice-of-results><p>The results came late.</p></section>", f"{WHOLE}\nThe results came late."),
        (f"{ARTICLE}<section class=discussion><h2>Discussion</h2><p>We have shown that.</p></section>", f"{WHOLE}\nDiscussion\nWe have shown that."),
        ("<header><h1>Title</h1><p>By Ann</p><nav><a href=/>Home</a></nav></header>" + ARTICLE.removeprefix("<h1>Title</h1>"), WHOLE),
        (f"{ARTICLE}<div class=box><p>See <a href=1>there</a> for what they said about it.</p></div>", f"{WHOLE}\nSee there for what they said about it."),
        (f"{ARTICLE}<div class=social-icons>Like us</div><div class=newsletter-signup>Sign up</div><div class=comments-area><h3>Comments</h3>Mine</div>", WHOLE),
    ],
)
def test_what_names_leave_open(spark, inside, text):
    source = f"<body><header><h1>Site</h1></header><article>{inside}</article></body>"
    assert webpages.main_text(source, []) == text
    pages = [(i, "http://h/x", source.replace("second one", f"second one, {i},")) for i in range(2)]
    found = {r.page_id: r.text for r in webpages.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert found == {i: text.replace("second one", f"second one, {i},") for i in range(2)}


def test_a_hosts_pages_decide_on_doubtful_elements(spark):
    page = "<body><article>{}<div class=social-note><p>{}</p></div><div class=more><a href=1>{}</a>{}</div></article></body>"
    pages = [(i, "http://same/x", page.format(ARTICLE, "Follow all of us there.", "One", " or a text")) for i in range(4)]
    pages += [(10 + i, "http://other/x", page.format(ARTICLE, f"A note of its own, {i}.", "One", " or a text" * (i > 0))) for i in range(4)]
    found = {r.page_id: r.text for r in webpages.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(found[i] == f"{WHOLE}\nOne or a text" for i in range(4))
    # The block is a list of links on one page, but not on its host.
    assert all(found[10 + i] == f"{WHOLE}\nA note of its own, {i}.\nOne{' or a text' * (i > 0)}" for i in range(4))


def test_equal_votes_go_to_the_first_path(spark):
    counted = spark.createDataFrame([("h", f"/p{i}", 5) for i in range(9, 0, -1)] + [(None, "/x", 1)], "host string, path string, n bigint")
    assert {r.vote_host: r.paths for r in webpages.winners(counted, share=0.1).collect()} == {"h": [f"/p{i}" for i in range(1, 6)], None: ["/x"]}
