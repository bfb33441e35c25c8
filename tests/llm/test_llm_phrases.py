import random
import re
from collections import Counter

import pytest
from llm_cases import SF, clashing, messy, rows

from logloom.llm import phrases

ENDS, WORDS = r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_hand(docs, least, longest=5, top=2000):
    sizes, counts = Counter(), {}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(ENDS, lowered(text or "")):
            words = re.findall(WORDS, piece)
            sizes[lang] += len(words)
            of = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    of[tuple(words[i : i + k])] += 1
    out = []
    for lang, of in counts.items():
        n = sizes[lang]
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and of[p[i:j]] <= a}
        kept = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, l, r = min((1000 * a * n // (of[p[:k]] * of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out, key=repr)


def drawn(spark, seed, docs=150, vocabulary=9):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "A", "b c"]
    made = []
    for i in range(docs):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(draw.randrange(60)))
        text += draw.choice(["", "the quick brown fox jumps over", "x y z x y z x y z"])
        made.append((i, draw.choice([text, text, None]), draw.choice(["en", "de", None]), "s", 1))
    return messy(spark, made), [(row[1], row[2]) for row in made]


@pytest.mark.parametrize("seed, least, top, block_words", [(1, 5, 2000, 1 << 19), (2, 3, 40, 50)])
def test_equals_brute_force(spark, seed, least, top, block_words):
    table, docs = drawn(spark, seed)
    assert rows(phrases.collocations(table.repartition(5), least, 5, top, 100, block_words)) == by_hand(docs, least, top=top)


def test_messy_rows(spark):
    table = clashing(messy(spark), "phrase", "n", "block", "items")
    docs = [(r["text"], r["lang"]) for r in table.collect()]
    assert rows(phrases.collocations(table, 2)) == by_hand(docs, 2)


def test_empty_table(spark):
    assert phrases.collocations(messy(spark, [])).collect() == []
    assert phrases.collocations(messy(spark, [(1, "one two", "en", "a", 1)])).collect() == []


def test_large_products_are_exact(spark):
    a, l, r, n = 3 * 10**11 + 7, 9 * 10**11 + 1, 8 * 10**11 + 3, 9 * 10**12 + 5
    found = spark.createDataFrame([("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)], "lang string, phrase string, words int, n bigint")
    row = phrases.scored(found, spark.createDataFrame([("en", n)], "lang string, n bigint")).first()
    assert row["score"] == 1000 * a * n // (l * r) and 1000 * a * n > 2**63


def test_cover_is_a_share(spark):
    found = spark.createDataFrame([("en", "x y", 2, 10), ("en", "x y z", 3, 9)], "lang string, phrase string, words int, a bigint")
    assert {r["phrase"] for r in phrases.uncovered(found, 100).collect()} == {"x y", "x y z"}
    assert {r["phrase"] for r in phrases.uncovered(found, 90).collect()} == {"x y z"}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(phrases.collocations(docs)) == by_hand([(r["text"], r["lang"]) for r in docs.collect()], 100)


def test_hashes_are_those_of_spark_and_infrequent_phrases_go(spark):
    from pyspark.sql import functions as F

    pairs = [("en", "the quick"), ("und", "é"), ("", ""), ("de", "x" * 100)]
    table = spark.createDataFrame(pairs, "lang string, phrase string").select(F.xxhash64("lang", "phrase").alias("h"))
    found = phrases.phrase_hashes([lang for lang, _ in pairs], [phrase.encode() for _, phrase in pairs])
    assert [r.h for r in table.collect()] == found.view("int64").tolist()
    docs = messy(spark, [(i, f"a b c{i} d e", "en", "s", 1) for i in range(50)])
    words = phrases.occurrences(docs)
    longer = phrases.extended(words, phrases.frequent(words, 50))
    assert sorted(r.phrase for r in longer.selectExpr("explode(items) AS x").selectExpr("x.phrase").distinct().collect()) == ["a b", "d e"]


def test_phrases_of_thin_buckets_are_not_made(spark):
    import numpy as np

    docs = messy(spark, [(i, "a b" if i < 50 else "b a", "en", "s", 1) for i in range(60)]).repartition(3)
    words = phrases.occurrences(docs, 20)
    longer = phrases.extended(words, phrases.frequent(words, 50), 50)
    assert {(r.phrase, r.n) for r in phrases.frequent(longer, 1).collect()} == {("a b", 50)}
    numbers = np.array([0, 0, 5, 300, 1 << 23, (1 << 24) - 1], np.uint64)
    assert phrases.unpacked(phrases.packed(numbers)).tolist() == numbers.tolist()


def test_filters_are_as_small_as_their_sets_and_go_once_relations_are_stored(spark):
    import os

    import numpy as np

    from logloom.llm import bitfilter

    left = set(os.listdir(spark.sparkContext._temp_dir))
    found, _ = phrases.mine(messy(spark, [(i, "a b c", "en", "s", 1) for i in range(60)]), 50, 3)
    assert set(os.listdir(spark.sparkContext._temp_dir)) <= left
    assert {(r.phrase, r.n) for r in found.filter("words > 1").collect()} == {("a b", 60), ("b c", 60), ("a b c", 60)}
    hashes = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 3000)
    small = bitfilter.build(spark.createDataFrame([(int(h),) for h in hashes], "h bigint"), "h").value
    assert small.nbytes <= 1 << 22 and bitfilter.holds(small, hashes.view(np.uint64)).all()
    assert bitfilter.holds(small, np.random.default_rng(2).integers(0, 1 << 63, 100_000).astype(np.uint64)).mean() < 1e-3


def test_filters_are_made_from_small_batches_and_blocks_tell_hashes_without_phrases(spark):
    import numpy as np
    import pyarrow as pa

    from logloom.llm import bitfilter

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(batch.nbytes > 16 << 20)], pa.int64())], names=["h"])

    wide = spark.range(0, 300, 1, 1).selectExpr("repeat(cast(id % 10 AS string), 100000) AS text")
    assert bitfilter.build(wide.mapInArrow(sizes, "h bigint"), "h").value[0] == 1  # bit 0: no batch was large
    block = phrases.occurrences(messy(spark, [(1, "a b. a c", "en", "s", 1)]).coalesce(1)).first()
    assert phrases.unpacked(block["places"]).tolist() == [0, 1, 3, 4] and phrases.from_planes(block["phrases"]).tolist() == [0, 1, 0, 2]
    told = phrases.phrase_hashes([x["lang"] for x in block["items"]], [x["phrase"].encode() for x in block["items"]])
    assert np.frombuffer(block["hashes"], np.uint64).tolist() == told.tolist()


def test_relations_are_stored_in_small_groups_and_read_a_few_rows_at_once(spark, monkeypatch):
    import os
    from urllib.parse import urlparse

    import pyarrow as pa
    import pyarrow.parquet as pq

    from logloom.sources import durable as tables

    def groups(table):
        for file in table.inputFiles():
            told = pq.ParquetFile(urlparse(file).path).metadata
            yield from map(told.row_group, range(told.num_row_groups))

    def noise(batches):
        for batch in batches:
            for i in batch["id"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([os.urandom(200_000)], pa.binary())], names=["id", "data"])

    stored = tables.durable(spark.range(0, 120, 1, 1).mapInArrow(noise, "id bigint, data binary"), "noise", ["data"])
    assert max(g.total_byte_size for g in groups(stored)) < 2 * tables.WIDE_GROUP_BYTES < 120 * 200_000
    assert sorted(r.id for r in stored.filter("length(data) = 200000").collect()) == list(range(120))

    before, seen = spark.conf.get(tables.READ_ROWS), []

    def discard(table):
        if "places" in table.columns:
            encodings = {e for g in groups(table) for c in map(g.column, range(g.num_columns)) if c.path_in_schema in phrases.WIDE for e in c.encodings}
            seen.append((spark.conf.get(tables.READ_ROWS), any("DICTIONARY" in e for e in encodings)))
        tables.discard(table)

    monkeypatch.setattr(phrases, "discard", discard)
    found, _ = phrases.mine(messy(spark, [(i, "a b c", "en", "s", 1) for i in range(60)]), 50, 3)
    assert seen == [(str(tables.WIDE_ROWS), False)] * 2 + [(before, False)]
    assert {(r.phrase, r.n) for r in found.filter("words > 1").collect()} == {("a b", 60), ("b c", 60), ("a b c", 60)}
    assert spark.conf.get(tables.READ_ROWS) == before
