import hashlib
import random

import pytest
from llm_cases import SF, clashing, messy

from logloom.llm import registry, substrings


def brute(docs, window=13):
    """Kept words per row: windows are judged on the input."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p : p + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[tuple(w[p : p + window])] < i:
                    gone.update(range(p, p + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(table):
    return sorted(map(tuple, table.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = got(registry.QUERIES["op5_substring_dedup"](spark, SF))
    assert found == brute(docs) and sum(r[2] for r in found) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_SOURCES", 3)
    monkeypatch.setattr(substrings, "CHUNK_READERS", 4)
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(40)]
    passages = [[draw.choice(pool) for _ in range(draw.randint(13, 30))] for _ in range(6)]
    docs = []
    for i in range(60):
        words = [draw.choice(pool) for _ in range(draw.randint(0, 20))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            cut = draw.randint(0, 4)
            words += p[cut:] if draw.random() < 0.5 else p
            words += [draw.choice(pool) for _ in range(draw.randint(0, 3))]
        docs.append((draw.randint(0, 50), " ".join(words)))
    docs += [(100 + i, docs[0][1]) for i in range(5)] + [(90, "same " * 30), (91, "same " * 13), (92, "same " * 12)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(substrings.dedup_substrings(table)) == brute(docs)


def test_messy_rows(spark):
    docs = clashing(messy(spark), "h1", "masks", "copy", "anchor", "n_words")
    expected = brute([(r.doc_id, r.text) for r in messy(spark).collect()])
    assert got(substrings.dedup_substrings(docs)) == expected
    assert substrings.dedup_substrings(messy(spark, [])).count() == 0
    alone = messy(spark, [(1, "only one here", "en", "s", 1)])
    assert got(substrings.dedup_substrings(alone))[0][2] == 0


def test_windows_of_many_documents_at_once(spark):
    import numpy as np

    from logloom.llm import bitfilter

    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 31}" for j in range(n)), "x") for i, n in enumerate([0, 5, 12, 13, 14, 40, 200, 13])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").coalesce(1)
    hashes = substrings.WordHashes()
    by_hand = {i: substrings.anchors(hashes.of(text.encode().split()))[0] for i, text, _ in texts}
    found = substrings.document_anchors(docs).collect()
    assert {i: {r.anchor for r in found if r.doc_id == i} for i in by_hand} == {i: set(a.view(np.int64).tolist()) for i, a in by_hand.items()}
    some = bitfilter.build(spark.createDataFrame([(int(by_hand[6].view(np.int64)[50]),), (int(by_hand[3].view(np.int64)[0]),)], "h bigint"), "h")
    expected = set()
    for i, text, _ in texts:
        words = hashes.of(text.encode().split())
        passed = bitfilter.holds(some.value, by_hand[i])
        first, second = substrings.run_hashes(words, 13, 1)[passed], substrings.run_hashes(words, 13, 2)[passed] >> np.uint64(32)
        expected |= set(zip([i] * len(first), first.view(np.int64).tolist(), second.astype(np.int64).astype(np.int32).tolist()))
    suspects = [tuple(r) for r in substrings.suspects(docs, some).collect()]
    assert len(suspects) == len(set(suspects)) and set(suspects) == expected and expected


def test_filters_take_no_worker_beside_the_one_that_reads_the_texts(spark):
    from pyspark.sql import functions as F

    from logloom.llm import bitfilter

    def workers(table):
        return table._jdf.queryExecution().executedPlan().toString().count("MapInArrow")

    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words), (2, words), (3, words + " x")], "doc_id bigint, text string")
    rows = substrings.keyed(docs)
    twice = bitfilter.build(rows.filter("doc_id = 1"), "h1")
    texts = rows.withColumn("screened", F.lit(True)).unionByName(rows.filter("doc_id = 1").withColumn("screened", F.lit(False)))
    found = substrings.document_anchors(texts, twice)
    assert workers(found) == 1 and {r.doc_id for r in found.collect()} == {1, 3}
    part = bitfilter.build(rows.filter("doc_id < 3").select(F.xxhash64("doc_id").alias("h")), "h")
    own = substrings.parties(texts, twice, part)
    assert workers(own) == 1 and [r.doc_id for r in own.collect()] == [1]
    kept = substrings.apply(docs, substrings.removals(docs))
    assert workers(kept) == 2 and sorted((r.doc_id, r.n_removed) for r in kept.collect()) == [(1, 0), (2, 20), (3, 20)]
