import hashlib
import re
from collections import defaultdict

import pytest
from llm_cases import SF, clashing, messy, rows

from logloom.llm import linededup, registry


def brute(docs, depth=3, min_docs=3, min_words=3, constant=5, similarity=0.8):
    """Kept lines per row, from the definition."""
    words_of = lambda line: ["<*>" if re.search("[0-9]", w) else w for w in re.findall("[^\x20\x09-\x0d]+", line)]
    fit = lambda ws: len(ws) >= min_words and len([w for w in ws if w != "<*>"]) >= 2
    lines = defaultdict(set)  # document -> masked lines
    for doc_id, text in docs:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                ws = tuple(words_of(line))
                if fit(ws):
                    lines[doc_id].add(ws)
    often = defaultdict(int)
    for own in lines.values():
        for ws in own:
            if len(ws) > constant:
                for place, word in enumerate(ws):
                    often[len(ws), ws[:depth], place, word] += word != "<*>"

    def template(ws):
        if len(ws) > constant:
            form = tuple(w if often[len(ws), ws[:depth], i, w] >= min_docs else None for i, w in enumerate(ws))
            stay = sum(w is not None for w in form)
            if stay >= constant and stay >= similarity * len(ws):
                return (ws[:depth], form)
        return None

    where = defaultdict(set)
    for doc_id, own in lines.items():
        for ws in own:
            where[ws].add(doc_id)
            if (form := template(ws)) is not None:
                where["form", form].add(doc_id)
    gone = lambda key, doc_id: len(where[key]) >= min_docs and doc_id > min(where[key])
    out = []
    for doc_id, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            ws = tuple(words_of(line))
            form = template(ws) if fit(ws) else None
            drop = doc_id is not None and fit(ws) and (gone(ws, doc_id) or (form is not None and gone(("form", form), doc_id)))
            if not drop:
                kept.append(line)
        out.append((doc_id, "\n".join(kept)))
    return out


def cleaned(docs):
    return rows(linededup.dedup_lines(docs).select("row.doc_id", "text"))


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute(docs)}
    found = registry.QUERIES["op1_line_dedup"](spark, SF).collect()
    assert {r.doc_id: r.kept_sha256 for r in found} == expected
    assert sum(r.n_removed for r in found) > 0


def test_variable_fields_are_generalised(spark):
    names = ["alice", "bob", "carol", "dave"]
    docs = [(i, f"Own line number {name} has\nPage {i} of {i + 9} shown\nThis page was last edited by {name} on a Monday morning") for i, name in enumerate(names)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = dict(cleaned(table))
    assert found[0] == docs[0][1]
    assert all(found[i] == f"Own line number {names[i]} has" for i in (1, 2, 3))
    assert cleaned(table) == sorted(brute(docs), key=repr)


def test_two_documents_are_not_recurring_and_short_lines_stay(spark):
    docs = [(1, "All rights are reserved here\nok"), (2, "All rights are reserved here\nok"), (3, "ok"), (4, "ok")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert cleaned(table) == docs


def test_messy_rows(spark):
    docs = clashing(messy(spark), "row", "lines", "n_lines", "id", "line")
    found = linededup.dedup_lines(docs)
    assert found.count() == messy(spark).count()
    assert set(docs.columns) - {"text"} == set(found.schema["row"].dataType.names)
    expected = brute([(r.doc_id, r.text) for r in messy(spark).collect()])
    assert cleaned(docs) == sorted(expected, key=repr)
    assert linededup.dedup_lines(messy(spark, [])).count() == 0


@pytest.mark.parametrize("word, seen", [(b"a1", b"<*>"), (b"abc", b"abc"), (b"7", b"<*>")])
def test_masking(word, seen):
    assert linededup.masked([word]) == [seen]


@pytest.mark.parametrize("most", [0, 1, 1 << 18])
def test_lines_are_dropped_the_same_way_wherever_their_first_documents_are(spark, most):
    often, seldom = "this line is in every text", "that line is in three texts only"
    texts = [(i, "\n".join([often, f"own words {i} of one", *[seldom] * (i < 3), often]), "x") for i in range(20)] + [(None, f"{often}\n{seldom}", "x")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, other string").repartition(3)
    found = {r.row.doc_id: (r.text, r.n_lines, r.n_removed) for r in linededup.dedup_lines(docs, most=most).collect()}
    for i, text, _ in texts:
        lines = text.split("\n")
        kept = lines if not i else [x for x in lines if x not in (often, seldom) and not x.startswith("own")]
        assert found[i] == ("\n".join(kept), len(lines), len(lines) - len(kept)), i
    lines, firsts = linededup.recurring_lines(docs)
    _, held = linededup.frequent(firsts, most)
    # Documents move only for lines that are not held.
    assert (linededup.surplus_lines(lines, firsts.filter(~held)).count() == 0) == (most > 10)
