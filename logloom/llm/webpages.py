"""Main text of web pages by consensus of a host's pages.

Each page scores its containers by the text of their blocks, links counting against them; half of a block's score goes to the container
around. The page votes for the generalised path of its best container: tags with their classes from the root, numbers replaced. Votes are
counted per host in Spark. Each page is then read again: the text of the host's winning path, in order of votes, or of the
page's own best container where no winning path occurs.

From its best container a page moves up to the container around as long as that adds text of which little is links, up to an article.

Menus, headers, footers, sidebars, adverts, notices, forms, comments and the like are left out by tag, role or class, wherever they are.
A class or id counts if one of its names has a listed word that only words of place and form follow ("comments-list", "page-sidebar"; not
"with-sidebar"). What only a class, id or role names, and a form, stays if it holds most of the page's text and its heading, or nearly all text. If
all text would be left out, it all stays. The headings of a header inside an article stay.

Where a name can be read both ways ("social-history", "discussion") the page and its host decide: the element goes if its text is mostly links, if
at least ``REPEATS`` pages of the host have an element of that name and their texts are the same on most, or, for words of comments, if it is a run of like
elements or has no heading of its own. These texts are compared in Spark, over all pages of a host. A block below the article goes
if ``LINK_LIST`` of the text of its path on the host is links.

Defined cases: null or empty html gives an empty text. Pages without a host are a host of their own. A page without containers
gives its body's text. Rows are independent but for the votes; other columns are not looked at; an empty table gives an empty result.
"""

from html import unescape
import re
from collections import Counter
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.text import slices
from logloom.sources.durable import discard, durable

#: A path wins beside the first one if it has this share of its host's votes.
WIN_SHARE = 0.2
MAX_PATHS = 5
#: Parts in which a host's paths are ranked first.
PARTS = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title|xmp|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*\Z",  # cut off inside a quoted value
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("html body main article section div td center blockquote dd".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt table tr pre hr header footer nav aside form figure figcaption address details summary fieldset".split())
_DROPPED = frozenset("nav header footer aside form button select option menu dialog head label fieldset figcaption".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words that name what is no text, words that name comments or a part of a study, and words of place and form that may follow them.
_LISTED = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|footer|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice"
    r"|pagination|popup|promo\w*|related|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)\d*",
    re.I,
)
_COMMENTS = frozenset("comment comments commentlist disqus discussion discussions replies respond responses".split())
_EITHER_WAY = frozenset("discussion discussions replies responses".split())
_FORM = frozenset(
    "area articles bar block body bottom box button buttons container content feed form header footer holder icons inner item items left links list lists main media "
    "module nav navigation outer overlay panel posts primary right row secondary section signup slot stories thread title top unit wrap wrapper".split()
)
_MEANING_NO = re.compile(r"(?:no|not|has|have|with|without|hide|show|is)[-_]", re.I)
#: A name that begins with a listed word and ends so is a frame around it.
_AROUND = re.compile(r"(?:wrap|wrapper|layout|page)$", re.I)
#: Whole-page frames say nothing about their content by their class.
_FRAMES = frozenset("html body main".split())
#: An article goes only by a class that says just this; "has-comments" is no reason.
_NO_ARTICLE = frozenset("ad ads advert comment comments notice promo promoted related response sponsored".split())
#: Never text, whatever else is left.
_NEVER = frozenset("head button select option label".split())
#: Where moving up ends.
_UNITS = frozenset("article main body html".split())
MAX_LINK_SHARE, MOST, NEARLY_ALL = 0.3, 0.5, 0.9
#: Pages of a host that make a repetition, and the share of links in a list of links.
REPEATS, LINK_LIST = 3, 0.8
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a list of comments repeats.
_LIKE = frozenset("div article section li blockquote details dd".split())
_CLOSES_P = _BLOCKS - frozenset(("html", "body"))


@dataclass
class Page:
    """Containers in page order as (path, parent) and blocks as (container, raw text, characters, characters in links)."""

    containers: list[tuple[str, int]] = field(default_factory=list)
    blocks: list[tuple[int, str, int, int]] = field(default_factory=list)
    doubts: list[tuple[str, str]] = field(default_factory=list)  # key and text of elements in doubt


def _named(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs and "=" in attrs else {}


def _step(tag: str, named: dict[str, str]) -> str:
    classes = sorted(set(re.sub(r"\d+", "N", named.get("class", "")).lower().split()))
    return ".".join([tag, *classes])


def _named_as(names: str) -> str:
    """``name`` if a class or id names boilerplate, ``doubt`` if it may, else empty."""
    found = ""
    for name in names.split():
        if _MEANING_NO.match(name) or _AROUND.search(name):
            continue
        words = [word for word in re.split(r"[-_]+", name.lower()) if word]
        if len(words) == 1 and words[0] in _EITHER_WAY:
            found = "doubt"
        for at, word in enumerate(words):
            if _LISTED.fullmatch(word):
                if all(w in _FORM or w.isdigit() or _LISTED.fullmatch(w) for w in words[at + 1 :]):
                    return "name"
                if at == 0:
                    found = "doubt"
    return found


def _boilerplate(tag: str, named: dict[str, str]) -> str:
    """How an element is left out: ``never`` text, ``tag``, by its ``name``, which its text may outweigh, or in ``doubt``; empty for content."""
    if tag in _NEVER:
        return "never"
    if tag in _DROPPED:
        return "name" if tag == "form" else "tag"
    if not named or tag in _FRAMES:
        return ""
    if tag == "article":
        return "name" if not _NO_ARTICLE.isdisjoint(named.get("class", "").lower().split()) else ""
    if named.get("role", "").lower() in _ROLES:
        return "name"
    ways = {_named_as(named.get("class", "")), _named_as(named.get("id", ""))}
    return "name" if "name" in ways else "doubt" if "doubt" in ways else ""


@dataclass
class Drop:
    """An element that may be left out: how, what is around it, and what speaks for it."""

    how: str
    around: int
    key: str = ""
    comments: bool = False
    chars: int = 0  # outside links
    linked: int = 0
    heading: bool = False  # the page's
    titled: bool = False  # has any heading
    texts: list[str] = field(default_factory=list)
    children: Counter = field(default_factory=Counter)

    def goes(self, repeated: frozenset[str] | set[str]) -> bool:
        """For an element in doubt."""
        if self.linked > MOST * (self.chars + self.linked) or self.key in repeated:
            return True
        return self.comments and (not self.titled or max(self.children.values(), default=0) >= 2)


def parse(source: str, repeated: Collection[str] = ()) -> Page:
    """The page; of ``repeated`` elements in doubt, named by their keys, the texts are the same on most pages of the host."""
    page = Page([("", -1)])
    drops = [Drop("", -1)]
    of_block: list[int] = []
    # Open elements: tag, container, what it is left out with, inside a link.
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
    parts: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            if raw and not raw.isspace():
                page.blocks.append((stack[-1][1], raw, len(raw), linked))
                of_block.append(stack[-1][2])
                drop = drops[stack[-1][2]]
                drop.chars += len(raw) - linked
                drop.linked += linked
                if drop.how == "doubt":
                    drop.texts.append(raw)
            parts.clear()
            linked = 0

    for token in _TOKEN.finditer(source):
        start = token.start()
        if start > at and drops[stack[-1][2]].how != "never":
            parts.append(source[at:start])
            if stack[-1][3]:
                linked += start - at
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            if tag in _BLOCKS:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if tag in ("h1", "main"):
            drops[stack[-1][2]].heading = True
        if tag in _HEADINGS:
            drops[stack[-1][2]].titled = True
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCKS:
            flush()
            if tag == "body":  # also ends a head that was left open
                del stack[1:]
            if tag in _CLOSES_P or tag == "li":
                _close_implied(stack, tag)
        elif tag == "th":
            parts.append(" ")
        if tag in _VOID:
            continue
        named = _named(token["attrs"])
        _, container, dropped, inside = stack[-1]
        if tag in _LIKE and drops[dropped].how == "doubt":
            drops[dropped].children[len(stack), _step(tag, named)] += 1
        if tag in _CONTAINERS:
            page.containers.append((f"{page.containers[container][0]}/{_step(tag, named)}", container))
            container = len(page.containers) - 1
        if tag in _HEADINGS and drops[dropped].key == "title":
            dropped = drops[dropped].around
        elif (how := _boilerplate(tag, named)) and drops[dropped].how != "never":
            if how == "doubt":
                words = re.split(r"[-_\s]+", f"{named.get('class', '')} {named.get('id', '')}".lower())
                drops.append(Drop(how, dropped, _key(tag, named), not _COMMENTS.isdisjoint(words)))
            else:
                of_article = tag == "header" and any(name in ("article", "main") for name, *_ in stack)
                drops.append(Drop(how, dropped, "title" if of_article else ""))
            dropped = len(drops) - 1
        stack.append((tag, container, dropped, inside or tag == "a"))
    if at < len(source) and drops[stack[-1][2]].how != "never":
        parts.append(source[at:])
    flush()
    page.doubts = [(drop.key, "\n".join(drop.texts)) for drop in drops if drop.how == "doubt" and drop.texts]
    left = _left_out(drops, frozenset(repeated))
    if not all(left[drop] for drop in of_block):
        page.blocks = [block for block, drop in zip(page.blocks, of_block) if not left[drop]]
    return page


def _key(tag: str, named: dict[str, str]) -> str:
    """An element in doubt by its tag, classes and id, numbers replaced."""
    return f"{_step(tag, named)}#{re.sub(r'[0-9]+', 'N', named.get('id', '')).lower()}"


def _left_out(drops: list[Drop], repeated: frozenset[str]) -> list[bool]:
    """Whether the text directly in each of ``drops`` is left out. Text that its tag leaves out has no weight."""
    goes = [drop.how == "doubt" and drop.goes(repeated) for drop in drops]
    for at in range(len(drops) - 1, 0, -1):
        drop = drops[at]
        if drop.how == "name" or drop.how == "doubt":
            drops[drop.around].chars += drop.chars
            drops[drop.around].heading |= drop.heading
    whole = drops[0].chars
    left = [False]
    for drop, out in zip(drops[1:], goes[1:]):
        heavy = drop.chars > (MOST if drop.heading else NEARLY_ALL) * whole
        stays = heavy if drop.how == "name" else drop.how == "doubt" and (heavy or not out)
        left.append(left[drop.around] or not stays)
    return left


def _close_implied(stack: list[tuple[str, int, bool, bool]], tag: str) -> None:
    """An open paragraph ends where a block begins, an open list item where the next one does."""
    closed = {"li": ("li", "p"), "tr": ("tr", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p")}.get(tag, ("p", "h1", "h2", "h3", "h4", "h5", "h6"))
    for depth in range(len(stack) - 1, 0, -1):
        name = stack[depth][0]
        if name in closed:
            del stack[depth:]
            return
        if name in _BLOCKS:
            return


def best_container(page: Page) -> int:
    """The container with the most text of its own blocks and half of the text one level below, the first among equals, or a container
    around it that adds text of which little is links."""
    scores = [0.0] * len(page.containers)
    for container, _, chars, linked in page.blocks:
        worth = chars - 2 * linked
        scores[container] += worth
        parent = page.containers[container][1]
        if parent >= 0:
            scores[parent] += worth / 2
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    chars_in, linked_in = [0] * len(scores), [0] * len(scores)
    for container, _, chars, linked in page.blocks:
        chars_in[container] += chars
        linked_in[container] += linked
    for i in range(len(scores) - 1, 0, -1):
        parent = page.containers[i][1]
        chars_in[parent] += chars_in[i]
        linked_in[parent] += linked_in[i]

    def tag(i: int) -> str:
        return page.containers[i][0].rsplit("/", 1)[-1].split(".", 1)[0]

    above = best
    while tag(above) not in _UNITS and (above := page.containers[above][1]) > 0 and tag(above) not in ("body", "html"):
        added, links = chars_in[above] - chars_in[best], linked_in[above] - linked_in[best]
        if added and links > MAX_LINK_SHARE * added:
            break
        if added:
            best = above
    return best


def link_lists(page: Page, roots: set[int]) -> dict[str, tuple[int, int]]:
    """Characters, and those in links, by path of the blocks (``div``, ``section``) below any of ``roots``."""
    chars, linked = [0] * len(page.containers), [0] * len(page.containers)
    for container, _, n, in_links in page.blocks:
        chars[container] += n
        linked[container] += in_links
    for i in range(len(chars) - 1, 0, -1):
        chars[page.containers[i][1]] += chars[i]
        linked[page.containers[i][1]] += linked[i]
    below, found = [False] * len(chars), {}
    for i, (path, parent) in enumerate(page.containers):
        below[i] = parent >= 0 and (parent in roots or below[parent])
        if below[i] and chars[i] and path.rsplit("/", 1)[-1].split(".", 1)[0] in ("div", "section"):
            one, two = found.get(path, (0, 0))
            found[path] = one + chars[i], two + linked[i]
    return found


def text_of(page: Page, roots: set[int], links: Collection[str] = ()) -> str:
    """Blocks inside any of ``roots`` but not below it in a path of ``links``, white space made single, one line each."""
    inside = [False] * len(page.containers)
    for i, (path, parent) in enumerate(page.containers):
        inside[i] = i in roots or (parent >= 0 and inside[parent] and path not in links)
    lines = []
    for container, raw, _, _ in page.blocks:
        if inside[container]:
            line = " ".join((unescape(raw) if "&" in raw else raw).split())
            if line:
                lines.append(line)
    return "\n".join(lines)


def main_text(source: str, paths: Collection[str], repeated: Collection[str] = (), linked: Mapping[str, tuple[int, int]] | None = None) -> str:
    """The text of a page by what its host's pages say: winning paths, keys of elements whose text is the same on most pages, and the
    characters, and those in links, of paths below an article. Without the last the page itself says it."""
    if not source:
        return ""
    page = parse(source, repeated)
    chosen = {best_container(page)}
    for path in paths:
        roots = {i for i, (own, _) in enumerate(page.containers) if own == path}
        if roots and text_of(page, roots):
            chosen = roots
            break
    found = link_lists(page, chosen) if linked is None else linked
    lists = {path for path, (chars, links) in found.items() if links >= LINK_LIST * chars}
    return text_of(page, chosen, lists) or text_of(page, chosen)


def host(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


EVIDENCE = "host string, kind string, path string, text bigint, n bigint, chars bigint, linked bigint"
VOTE, DOUBT, LINKS = "vote", "doubt", "links"


def evidence(pages: DataFrame) -> DataFrame:
    """What each host's pages say, counted inside each task before the shuffle (``host, kind, path, text, n, chars, linked``).

    ``vote``: pages whose best container has the path. ``doubt``: pages with an element in doubt of that key, by a hash of its text. ``links``: characters,
    and those in links, of paths below the best container, where some are links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[tuple, list[int]] = {}

        def add(key: tuple, chars: int = 0, linked: int = 0) -> None:
            own = counted.setdefault(key, [0, 0, 0])
            own[0], own[1], own[2] = own[0] + 1, own[1] + chars, own[2] + linked

        for batch in slices(batches):
            for where, source in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                page = parse(source or "")
                for key, text in dict(page.doubts).items():
                    add((where, DOUBT, key, xxhash.xxh64_intdigest(" ".join(text.split()).encode()) - (1 << 63)))
                if page.blocks:
                    best = best_container(page)
                    add((where, VOTE, page.containers[best][0], 0))
                    for path, (chars, linked) in link_lists(page, {best}).items():
                        add((where, LINKS, path, 0), chars, linked)
            if len(counted) > 100_000:
                yield handed(counted)
                counted.clear()
        yield handed(counted)

    def handed(counted: dict[tuple, list[int]]) -> pa.RecordBatch:
        texts = [pa.array([key[i] for key in counted], pa.string()) for i in range(3)]
        numbers = [pa.array([key[3] for key in counted], pa.int64())] + [pa.array([own[i] for own in counted.values()], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(texts + numbers, names=["host", "kind", "path", "text", "n", "chars", "linked"])

    cast = pages.select(host().alias("host"), "html").mapInArrow(run, EVIDENCE)
    return cast.groupBy("host", "kind", "path", "text").agg(*[F.sum(c).alias(c) for c in ("n", "chars", "linked")])


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, n``: pages of a host whose best container has the path."""
    return evidence(pages).filter(F.col("kind") == VOTE).select("host", "path", "n")


def winners(counted: DataFrame, share: float = WIN_SHARE, most: int = MAX_PATHS) -> DataFrame:
    """``vote_host, paths``: the winning paths of each host, most votes first, the first path among equals.

    A host's best paths are found part by part first, so that a host of very many paths is not one task.
    """
    order = [F.col("n").desc(), F.col("path")]
    whole = counted.groupBy("host").agg(F.sum("n").alias("all"))
    parted = counted.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(PARTS)))
    first = parted.withColumn("place", F.row_number().over(Window.partitionBy("host", "part").orderBy(*order))).filter(F.col("place") <= most)
    top = first.withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy(*order))).filter(F.col("place") <= most)
    top = top.alias("t").join(whole.alias("w"), F.col("t.host").eqNullSafe(F.col("w.host"))).filter(f"place = 1 or n >= {share} * all")
    return top.groupBy(F.col("t.host").alias("vote_host")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("paths"))


def verdicts(found: DataFrame) -> DataFrame:
    """``host, path, kind`` of what goes: keys of elements in doubt with one text on most of the host's pages, and paths whose text is links."""
    doubts = found.filter(F.col("kind") == DOUBT).groupBy("host", "path").agg(F.sum("n").alias("n"), F.max("n").alias("same"))
    doubts = doubts.filter((F.col("n") >= REPEATS) & (2 * F.col("same") > F.col("n")))
    lists = found.filter((F.col("kind") == LINKS) & (F.col("chars") > 0) & (F.col("linked") >= LINK_LIST * F.col("chars")))
    return doubts.select("host", "path", F.lit(DOUBT).alias("kind")).unionByName(lists.select("host", "path", "kind"))


def extract(pages: DataFrame) -> DataFrame:
    """Contract of the operator: ``page_id, url, text, n_chars`` for every row of ``pages``."""
    found = durable(evidence(pages), "evidence")
    elected = winners(found.filter(F.col("kind") == VOTE).select("host", "path", "n"))
    out = verdicts(found).groupBy(F.col("host").alias("out_host")).agg(*[F.collect_set(F.when(F.col("kind") == kind, F.col("path"))).alias(kind) for kind in (DOUBT, LINKS)])
    known = durable(elected.join(out, F.col("vote_host").eqNullSafe(F.col("out_host")), "left").drop("out_host"), "paths")
    discard(found)
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    joined = rows.join(known, F.col("host").eqNullSafe(F.col("vote_host")), "left").select("page_id", "url", "html", "paths", DOUBT, LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            asked = zip(*[batch[name].to_pylist() for name in ("html", "paths", DOUBT, LINKS)])
            texts = [main_text(source or "", paths or [], repeated or [], {path: (1, 1) for path in links or []}) for source, paths, repeated, links in asked]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
