import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, clashing, messy, rows

from logloom.llm import components, registry, simhash


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    group = list(range(len(ids)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                group[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[root(i)] = min(own, least.get(root(i), own))
    return [least.get(root(i)) for i in range(len(ids))]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = [brute_fingerprint(r.text) for r in docs]
    expected = brute_components([r.doc_id for r in docs], prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.QUERIES["op8_simhash"](spark, SF).collect()}
    assert found == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, expected)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200))
def test_majority(hashes):
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.majority(np.array(hashes, np.uint64)) == expected


@pytest.mark.parametrize("tile", [3, 50, 10_000])
def test_all_links_are_found_whatever_the_tile(spark, tile):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 25, dtype=np.uint64)
    near = [int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in draw.integers(0, 64, (3, 2))]
    prints = sorted({int(b) for b in base} | set(near) | {0, 1, 3, 2**64 - 1})
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    found = components.components(simhash.near_links(table, 4, tile)).collect()
    label = {p: p for p in prints} | {r.node % (1 << 64): r.component % (1 << 64) for r in found}
    expected = brute_components(list(range(len(prints))), prints)
    groups = {}
    for p, c in zip(prints, expected):
        groups.setdefault(c, set()).add(label[p])
    assert all(len(labels) == 1 for labels in groups.values()) and len({min(x) for x in groups.values()}) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    found = rows(components.components(spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")))
    assert dict(found) == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1100)]}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_messy_rows(spark):
    docs = clashing(messy(spark), "fp", "ones", "label", "component_id", "fingerprint")
    found = simhash.near_dedup(docs).collect()
    rows_in = messy(spark).collect()
    prints = [brute_fingerprint(r.text) for r in rows_in]
    expected = [(r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows_in, prints, brute_components([r.doc_id for r in rows_in], prints))]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert simhash.near_dedup(messy(spark, [])).count() == 0
