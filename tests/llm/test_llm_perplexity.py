import itertools
import math
from collections import Counter

import pytest
from llm_cases import SF, clashing, messy, rows

from logloom.llm import perplexity, registry


def brute_model(texts, order):
    """Modified Kneser-Ney with nothing dropped, from the definition."""
    longest = Counter()
    for text in texts:
        for word in text.encode().split():
            framed = f" {word.decode()} "
            for end in range(2, len(framed) + 1):
                longest[framed[max(0, end - order) : end]] += 1
    counts = {k: Counter() for k in range(1, order + 1)}
    raw = Counter()
    for gram, n in longest.items():
        raw[gram] += n
    counts[order] = Counter({g: n for g, n in longest.items() if len(g) == order})
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1
        for gram, n in longest.items():
            if len(gram) == k:
                counts[k][gram] += n
    cut = {k: perplexity.discounts(Counter(c.values())) for k, c in counts.items()}
    contexts = {k: {} for k in counts}
    for k, table in counts.items():
        for gram, n in table.items():
            contexts[k].setdefault(gram[:-1], []).append(n)

    def p(gram):
        if not gram:
            return 1.0 / (len(counts[1]) + 1)
        k = len(gram)
        seen = contexts[k].get(gram[:-1])
        if seen is None:
            return p(gram[1:])
        d = lambda n: cut[k][min(n, 3) - 1]
        own = counts[k].get(gram, 0)
        held = (own - d(own)) / sum(seen) if own else 0.0
        return held + sum(d(n) for n in seen) / sum(seen) * p(gram[1:])

    return p, set(counts[1])


TEXTS = ["banana bandana banana", "cab cabana band", "abba ab ba banana cab", "dab dabba"]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string")
    return perplexity.fit(docs, order=3, budget=1 << 18)["x"]


def test_model_equals_the_definition(model):
    p, _ = brute_model(TEXTS, 3)
    for word in ("banana", "cab", "zebra", "d", "abd", "naan"):
        framed = f" {word} "
        expected = sum(math.log(p(framed[max(0, end - 3) : end])) for end in range(2, len(framed) + 1))
        assert model.score([word])[0] == pytest.approx(expected, rel=1e-9), word


def test_probabilities_sum_to_one(model):
    p, letters = brute_model(TEXTS, 3)
    for context in (" ", "a", "an", " b", "zz"):
        assert sum(p((context + c)[-3:]) for c in letters) + p((context + "?")[-3:]) == pytest.approx(1.0)


def test_pruned_model_still_sums_to_one(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string")
    small = perplexity.fit(docs, order=3, budget=20)["x"]
    assert all(len(grams.hashes) <= 20 for grams in small.orders)
    letters = sorted(set("".join(TEXTS)) - {" "})
    for head in ("", "b", "ba"):
        # Of all one-character continuations of a word, each ended by the closing blank after it.
        whole = small.score([head + c for c in letters])
        assert all(value < 0 for value in whole)
    mass = sum(math.exp(v) for n in range(0, 3) for v in small.score(["".join(w) for w in itertools.product(letters, repeat=n + 1)]))
    assert mass < 1.0


def brute_statistics(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_query_equals_brute_force_on_the_base_rules(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = registry.QUERIES["op9_quality"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        n, chars, symbols, lines, again = brute_statistics(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, again)
        assert r.base_failed == (n < 10 or 100 * again > 20 * n)
        assert not (r.base_failed and r.kept)
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    judged = [r for r in found if r.doc_id in clean and not r.base_failed]
    assert sum(r.kept for r in judged) >= 0.97 * len(judged)


def test_perplexity_tells_noise_from_language(spark):
    good = [(i, " ".join(TEXTS[(i + j) % 4] for j in range(5)), "x") for i in range(60)]
    noise = [(100, "qzxj wvkq jjxz qqqz zxcv wkjq qpzx zzkj xqwv kjqz vwxz qkzj " * 3, "x")]
    found = perplexity.quality(spark.createDataFrame(good + noise, "doc_id bigint, text string, lang string"), order=3)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[100].log_perplexity > max(by_id[i].log_perplexity for i in range(60))
    limits = perplexity.bands(found.filter("doc_id < 100").select("lang", "log_perplexity"))
    assert not [r for r in perplexity.judge(found.drop("base_failed", "kept", "perplexity"), limits).collect() if r.doc_id == 100][0].kept


def test_messy_rows(spark):
    found = perplexity.quality(clashing(messy(spark), "n_words", "kept", "low", "h1"))
    assert found.count() == messy(spark).count()
    empty = [r for r in found.collect() if r.n_words == 0]
    assert all(r.log_perplexity is None and r.base_failed and not r.kept for r in empty)
    # U+00A0 is no ASCII white space: that text has one word.
    assert sorted(r.n_words for r in found.collect())[:4] == [0, 0, 0, 1]
    assert perplexity.quality(messy(spark, [])).count() == 0
    assert rows(perplexity.quality(messy(spark)).select("doc_id", "kept")) == rows(found.select("doc_id", "kept"))


def test_labelled_noise_is_rejected_and_clean_text_stays(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(label[r.doc_id], r.kept) for r in registry.QUERIES["op9_quality"](spark, SF).collect() if r.doc_id in label and not r.base_failed]
    noise, clean = [kept for quality, kept in judged if quality == 0], [kept for quality, kept in judged if quality == 1]
    assert len(noise) > 20 and noise.count(False) >= 0.9 * len(noise)
    assert clean.count(True) >= 0.98 * len(clean)


@pytest.mark.parametrize("most", [0, 3, 1 << 18])
def test_no_counted_gram_is_dropped_from_the_scores(spark, most):
    # The rare words of a long text: a share of the corpus, as in a pruned model, would leave none of their n-grams.
    lines = [*TEXTS, "banana cab dab abba " * 50_000, "zyx xyz"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(lines)] + [(9, "naan zzyx ?", "x"), (9, "", None)], "doc_id bigint, text string, lang string")
    words = perplexity.learned_words(docs.filter("doc_id < 9")).unionByName(spark.createDataFrame([("x", w, 1, 0) for w in ("naan", "zzyx", "?")], "lang string, word string, n bigint, m bigint"))
    values = perplexity.word_values(words, 3)
    p, _ = brute_model(lines, 3)
    for r in values.collect():
        framed = f" {r.word} "
        expected = sum(math.log(p(framed[max(0, end - 3) : end])) for end in range(2, len(framed) + 1))
        assert r.s0 / 1e9 == pytest.approx(expected, abs=1e-7), r.word
    found = {r.doc_id: r for r in perplexity.score(docs.filter("lang is not null"), values, most).collect()}
    by_word = {r.word: r.s0 for r in values.collect()}
    assert len(found) == len(lines) + 1
    assert found[9].log_perplexity == pytest.approx(-(by_word["naan"] + by_word["zzyx"] + by_word["?"]) / 1e9 / 12)


@pytest.mark.parametrize("most, task", [(0, 1), (3, 4), (1 << 18, 1 << 18)])
def test_only_items_that_are_not_held_leave_the_task(spark, monkeypatch, most, task):
    from logloom.llm import itemsums

    rests, store = [], itemsums.durable

    def stored(table, name="table"):
        found = store(table, name)
        if "rest" in found.columns:
            rests.extend(len(r.rest) for r in found.select("rest").collect())
        return found

    monkeypatch.setattr(itemsums, "durable", stored)
    texts = [(1, "a b a c", "x"), (2, "a d", "y"), (3, None, "x"), (4, "d d b", None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").repartition(2)
    split, measure = (lambda text: text.encode().split()), (lambda text, items, numbers: ((len(items),), 2))
    counts = itemsums.counted(docs, split, measure, None, task)
    assert all(r.m == 2 * r.n for r in counts.collect())
    by_item = {(r.lang, r.item): r.n for r in counts.collect()}
    assert by_item == {("x", "a"): 2, ("x", "b"): 1, ("x", "c"): 1, ("y", "a"): 1, ("y", "d"): 1, (None, "d"): 2, (None, "b"): 1}
    values = counts.filter("item != 'c'").selectExpr("lang", "item", "n", "ascii(item) * if(lang = 'x', 100, 1) AS s0")
    found = {r.doc_id: (r.lang, r.n_items, r.s0) for r in itemsums.summed(docs, values, split, measure, "n_items bigint", most, task).collect()}
    worth = lambda lang, words: sum(ord(w) * (100 if lang == "x" else 1) for w in words if w != "c") if lang else 0
    assert {i: found[i][:2] for i in found} == {i: (lang, len((text or "").split())) for i, text, lang in texts}
    assert all(found[i][2] == worth(lang, (text or "").split()) for i, text, lang in texts if lang)
    assert found[4][2] == 2 * ord("d") + ord("b")
    # Without a value a word stays unheld: only "c" leaves if all values are held.
    assert sum(rests) == (1 if most > 3 else 7 if most == 0 else sum(rests)) and sum(rests) <= 7


@pytest.mark.parametrize("most", [0, 4, 1 << 18])
def test_grams_of_many_words_are_taken_at_once(spark, most):
    import numpy as np

    from logloom.llm import itemsums

    words = ["a", "banana", "saßen", "😀é", "x" * 40, "ab", "banana"]
    by_hand = [f" {w} "[max(0, end - 5) : end].encode() for w in words for end in range(2, len(w) + 3)]
    keys, lengths, names = perplexity.spelled_all(words)
    assert names(np.arange(len(keys))) == by_hand and lengths.tolist() == [len(w) + 1 for w in words]
    assert len(set(keys.tolist())) == len(set(by_hand)) == len(set(zip(keys.tolist(), by_hand)))
    table = spark.createDataFrame([(w, lang, i, i) for i, w in enumerate(words) for lang in ("x", None)] + [(None, "x", 90, 1)], "text string, lang string, id bigint, m bigint").repartition(3)
    counts = itemsums.counted_at_once(table, perplexity.spelled_all, "m")
    expected = Counter()
    for i, word in enumerate(words):
        for lang in ("x", None):
            for gram in perplexity.spelled_all([word])[2](np.arange(len(word) + 1)):
                expected[lang, gram.decode(), "n"] += 1
                expected[lang, gram.decode(), "m"] += i
    expected["x", "  ", "n"], expected["x", "  ", "m"] = 1, 1  # the empty text's closing blank
    assert {(r.lang, r.item, c): r[c] for r in counts.collect() for c in "nm"} == dict(expected)
    values = counts.selectExpr("lang", "item", "n", "length(item) * 10 + ascii(item) + if(lang is null, 0, 1000) AS s0")
    worth = lambda lang, w: sum(10 * len(g.decode()) + g[0] + (1000 if lang else 0) for g in perplexity.spelled_all([w])[2](np.arange(len(w) + 1)))
    found = itemsums.summed_at_once(table.drop("m"), values, perplexity.spelled_all, most)
    assert {(r.lang, r.id): r.s0 for r in found.collect()} == {(lang, i): worth(lang, w) for i, w in enumerate(words) for lang in ("x", None)} | {("x", 90): worth("x", "")}
