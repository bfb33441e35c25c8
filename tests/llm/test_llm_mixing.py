from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, clashing, messy, rows

from logloom.llm import mixing, registry


def brute_targets(size_of, weights=(5, 2, 1), cap=3):
    """Reshares the excess until no source is above its limit."""
    order = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, full = Fraction(sum(size_of.values())), set()
    while True:
        rest = total - sum(cap * size_of[s] for s in full)
        free = sum(weight[s] for s in size_of if s not in full)
        target = {s: Fraction(cap * size_of[s]) if s in full else rest * weight[s] / free for s in size_of}
        over = {s for s in size_of if s not in full and target[s] >= cap * size_of[s]}
        if not over or len(full | over) == len(size_of):
            return {s: min(t, Fraction(cap * size_of[s])) for s, t in target.items()}
        full |= over


def check(found, docs):
    size_of, largest = defaultdict(int), defaultdict(int)
    sizes = [(i, s, len([w for w in (t or "").encode().split()])) for i, s, t in docs]
    for _, source, size in sizes:
        size_of[source] += size
        largest[source] = max(largest[source], size)
    expected = brute_targets(size_of)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == size_of[r.source] and r.target == pytest.approx(float(expected[r.source]), rel=1e-9)
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert sum(expected.values()) == sum(size_of.values())
    return {s: (taken[s], float(expected[s]), largest[s]) for s in size_of}


def with_source(spark, docs):
    table = mixing.mix(docs)
    return table.join(docs.select("doc_id", "source"), "doc_id").collect()


def test_query_meets_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = registry.QUERIES["op10_mixing"](spark, SF)
    again = registry.QUERIES["op10_mixing"](spark, SF)
    assert rows(found) == rows(again)
    joined = found.join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(joined) == docs.count()
    for taken, target, largest in check(joined, [(r.doc_id, r.source, r.text) for r in docs.collect()]).values():
        assert abs(taken - target) <= largest / 2 + 1e-6


def test_small_sources_are_capped(spark):
    docs = [(i, "a", "w " * 100) for i in range(50)] + [(100 + i, "b", "w " * 3) for i in range(10)] + [(200, None, "w")]
    table = spark.createDataFrame([(i, s, t) for i, s, t in docs], "doc_id bigint, source string, text string")
    found = check(with_source(spark, table), docs)
    assert found["b"] == (90, 90.0, 3) and found[None] == (3, 3.0, 1)


def test_mixed_rows_are_repeated_as_taken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    for r in mixing.mix(docs).collect():
        if r["size"]:
            assert r.taken == r["size"] * counts.get(r.doc_id, 0)
    assert mixing.mixed(docs).columns == docs.columns


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abcdé", min_size=1, max_size=2), st.integers(0, 1000), min_size=1, max_size=8))
def test_targets_of_the_brute_force_are_feasible(size_of):
    target = brute_targets(size_of)
    assert all(t <= 3 * size_of[s] for s, t in target.items()) and sum(target.values()) == sum(size_of.values())


def test_messy_rows(spark):
    docs = clashing(messy(spark), "size", "target", "pick", "part", "cut", "row")
    found = mixing.mix(docs)
    assert found.count() == messy(spark).count()
    assert all(r.taken <= 3 * r["size"] for r in found.collect())
    assert set(mixing.mixed(docs).columns) == set(docs.columns)
    assert mixing.mix(messy(spark, [])).count() == 0
    assert [r.target for r in mixing.mix(messy(spark, [(1, None, None, None, None)])).collect()] == [0.0]
