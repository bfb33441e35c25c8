import math
import zlib
from collections import Counter

import pytest
from llm_cases import SF, clashing, messy

from logloom.llm import langid, registry


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = registry.QUERIES["op7_language_id"](spark, SF).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    judged = [r.lang_pred == docs[r.doc_id].lang for r in found if r.held_out and r.lang_pred != "und"]
    assert len(judged) > 150 and sum(judged) >= 0.98 * len(judged)


def test_prediction_uses_only_the_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out()))
    changed = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    assert sorted(langid.predict(docs, model).collect()) == sorted(langid.predict(changed, model).collect())


TRAIN = [(1, "der hund und der kater", "de"), (3, "the dog and the cat", "en"), (4, "le chien et le chat", "fr")]


def test_model_equals_the_definition(spark):
    train = spark.createDataFrame(TRAIN, "doc_id bigint, text string, lang string")
    model = langid.fit(train)
    floor = math.log(3 / langid.BUDGET) - math.log(2)
    words = {lang: Counter(text.split()) for _, text, lang in TRAIN}
    for word, row in model.tables[0].items():
        for column, lang in enumerate(model.langs):
            n = words[lang][word]
            assert model.logs[0][row, column] == pytest.approx(math.log(n / 5) if n else floor)
    grams = {lang: Counter(g for w, n in c.items() for g in langid.spelled(w, 3) * n) for lang, c in words.items()}
    for gram, row in model.tables[3].items():
        for column, lang in enumerate(model.langs):
            n = grams[lang][gram]
            assert model.logs[3][row, column] == pytest.approx(math.log(n / grams[lang].total()) if n else floor)
    # "cats" is unseen: its known 4-grams are those of "^cats$" that occur in training.
    known = [g for g in langid.spelled("cats", 4) if g in model.tables[4]]
    assert known == ["^cat"]
    assert model.unseen("cats") == pytest.approx(model.logs[4][model.tables[4]["^cat"]])
    assert model.predict(["cats"], {})[0] == "en"
    assert model.unseen("ß").tolist() == [0, 0, 0]


def test_budget_bounds_the_model(spark):
    train = spark.createDataFrame(TRAIN, "doc_id bigint, text string, lang string")
    small = langid.fit(train, budget=9)
    assert all(len(table) <= 9 for table in small.tables)
    assert small.predict(["the", "und", "the"], {})[0] == "en"


def test_messy_rows(spark):
    extra = [(20, "12345 !!! ½ ___", "en", "a", 1), (21, "²x", "en", "a", 1), (22, "ABC", None, "a", 1)]
    docs = clashing(messy(spark).unionByName(messy(spark, extra)), "score", "held_out", "k", "n", "word")
    found = langid.identify(docs)
    assert found.count() == messy(spark).count() + 3
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[2].lang_pred, by_id[2].score, by_id[3].lang_pred, by_id[20].lang_pred) == ("und", 0.0, "und", "und")
    assert by_id[21].lang_pred != "und" and by_id[22].lang_pred != "und"
    assert langid.identify(messy(spark, [])).count() == 0
    unknown = langid.identify(messy(spark, [(1, "some words", None, "a", 1)])).collect()
    assert [(r.lang_pred, r.score) for r in unknown] == [("und", 0.0)]


@pytest.mark.parametrize("most", [0, 1 << 17])
def test_a_rare_word_of_a_large_corpus_stays_known(spark, most):
    # Seen once among 600,000 words: a threshold that grows with the corpus drops it and spells it by n-grams.
    lines = [*TRAIN, (6, "the dog and the cat " * 120_000, "en"), (8, "hunder", "en")]
    asked = [(i, "hunder", None) for i in range(100, 140)] + [(200, "cats", None)]
    docs = spark.createDataFrame(lines + asked, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in langid.identify(docs, most=most).collect()}
    assert len(found) == len(lines) + len(asked)
    assert {found[i].lang_pred for i in range(100, 140)} == {"en"} and found[200].lang_pred == "en"


def test_values_equal_the_model(spark):
    train = spark.createDataFrame(TRAIN, "doc_id bigint, text string, lang string")
    words = langid.word_counts(train, langid.letter_words).unionByName(spark.createDataFrame([(None, w, 1) for w in ("cats", "ß", "dogge")], "lang string, word string, n bigint"))
    model, (langs, values) = langid.fit(train), langid.word_values(words)
    found = {r.word: [r[f"s{i}"] / 1e9 for i in range(len(langs))] for r in values.collect()}
    assert langs == model.langs and set(found) == set(model.tables[0]) | {"cats", "dogge"}
    for word, value in found.items():
        row = model.tables[0].get(word)
        assert value == pytest.approx(model.unseen(word) if row is None else model.logs[0][row], abs=1e-8), word
