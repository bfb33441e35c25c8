import hashlib
import math
import zlib
from collections import Counter

import pytest
from llm_cases import ROWS, clashing, messy, rows

from logloom.llm import numbering, sharding


def by_hand(key, weights):
    text = "null" if key is None else str(key)
    bids = []
    for shard, weight in enumerate(weights):
        u = (int(hashlib.md5(f"{text}:{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        bids.append((-math.log(u) / weight, shard))
    return min(bids)[1]


def test_messy_rows(spark):
    found = sharding.sharded(clashing(messy(spark), "shard", "slot", "size", "row", "law")).collect()
    assert len(found) == len(ROWS)
    slots = {}
    for row in found:
        assert row["shard"] == by_hand(row["doc_id"], [1.0] * 16) and row["law"] == "key"
        assert row["grown_shard"] == by_hand(row["doc_id"], [1.0] * 17) and row["grown_shard"] in (row["shard"], 16)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    expected = Counter((doc_id, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for doc_id, text, *_ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected


def test_empty_table(spark):
    assert sharding.sharded(messy(spark, [])).collect() == []


def test_slots_do_not_depend_on_the_layout(spark):
    docs = messy(spark, [(i % 40, f"text {i % 60}", "en", "a", 1) for i in range(400)])
    one, many = sharding.sharded(docs.coalesce(1)), sharding.sharded(docs.repartition(7))
    assert rows(one) == rows(many)


def test_weights_give_shares(spark):
    weights = [4.0, 2.0, 1.0, 1.0]
    counts = Counter(r["shard"] for r in spark.range(20_000).select(sharding.shard_of("id", weights).alias("shard")).collect())
    assert all(abs(counts[s] / 20_000 - w / 8) < 0.015 for s, w in enumerate(weights))


def test_few_records_move(spark):
    before, after = [3.0, 1.0, 2.0], [3.0, 1.0, 2.0, 2.0]
    pairs = spark.range(10_000).select(sharding.shard_of("id", before).alias("a"), sharding.shard_of("id", after).alias("b")).collect()
    moved = [r for r in pairs if r["a"] != r["b"]]
    assert {r["b"] for r in moved} == {3} and abs(len(moved) / 10_000 - 0.25) < 0.02
    heavier = spark.range(10_000).select(sharding.shard_of("id", before).alias("a"), sharding.shard_of("id", [3.0, 5.0, 2.0]).alias("b")).collect()
    assert {r["b"] for r in heavier if r["a"] != r["b"]} == {1}


@pytest.mark.parametrize("weights", [[], [1.0, 0.0]])
def test_weights_are_positive(weights):
    with pytest.raises(ValueError):
        sharding.shard_of("id", weights)


def test_written_shards_hold_all_records(spark, tmp_path):
    docs = clashing(messy(spark), "shard")
    sharding.write_shards(docs, str(tmp_path / "out"), weights=(2.0, 1.0), slices=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.select(docs.columns)) == rows(docs)
    assert all(r["shard_"] == by_hand(r["doc_id"], [2.0, 1.0]) for r in back.collect())


def test_numbered_spreads_a_repeated_row(spark):
    table = spark.range(0, 30_000, 1, 8).selectExpr("if(id < 20000, 1, id) AS g", "0 AS x")
    found = numbering.numbered(table, ["g"], [], "place").groupBy("g").agg({"place": "max", "*": "count"}).collect()
    assert all(r["max(place)"] == r["count(1)"] - 1 for r in found) and len(found) == 10_001
