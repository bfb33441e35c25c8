import numpy as np
import pytest
from llm_cases import SF, rows

from logloom.llm import capfilters, registry

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(table, cosine=0.98):
    usable = [r for r in table if r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    group = list(range(len(table)))
    links = [0] * len(table)

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    index = {id(r): i for i, r in enumerate(table)}
    for k, a in enumerate(usable):
        for b in usable[:k]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine - 1e-12:
                    i, j = index[id(a)], index[id(b)]
                    links[i] += 1
                    links[j] += 1
                    group[root(i)] = root(j)
    least = {}
    for i, r in enumerate(table):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted([(r[0], links[i], least.get(root(i)), r[0] is None or r[0] == least[root(i)]) for i, r in enumerate(table)], key=repr)


def planted(n=300, groups=20, dim=64, seed=4):
    """Vectors in two labels, groups of near copies whose noise straddles the threshold, exact copies among them."""
    draw = np.random.default_rng(seed)
    out = [draw.standard_normal(dim) for _ in range(n)]
    for g in range(groups):
        center = draw.standard_normal(dim)
        for _ in range(6):
            out.append(center + draw.uniform(0.02, 0.16) * draw.standard_normal(dim))
        out.append(out[-1])
    return [(i, [float(x) for x in np.float32(v)], i % 2 if i < n else i // 7 % 2) for i, v in enumerate(out)]


def test_query_equals_brute_force(spark):
    table = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows(registry.QUERIES["op4_embedding_near_dedup"](spark, SF)) == brute(table)


@pytest.mark.parametrize("tile", [4, 512])
def test_recall_on_planted_groups(spark, tile):
    table = planted()
    found = capfilters.classes_of
    vectors = spark.createDataFrame(table, SCHEMA)
    assert found is not None
    expected = brute(table)
    got = rows(capfilters.near_dedup(vectors))
    true = sum(e[1] for e in expected)
    assert true > 100 and sum(g[1] for g in got) >= 0.99 * true
    assert all(g[1] <= e[1] for g, e in zip(got, expected))
    if tile != capfilters.TILE:
        cls = vectors.selectExpr("*", "xxhash64(label, embedding) AS cls")
        classes = capfilters.classes_of(cls)
        small = capfilters.links(classes, tile=tile).filter("other is null").groupBy("cls").sum("n")
        whole = capfilters.links(classes).filter("other is null").groupBy("cls").sum("n")
        assert rows(small) == rows(whole)


def test_decoding_finds_all_filters_within_reach():
    draw = np.random.default_rng(0)
    units = capfilters.unit(draw.standard_normal((20, 12)))
    parts = capfilters.directions(12, 3, 5)
    home, who, name = capfilters.decode(units, parts, 0.4)
    for i, x in enumerate(units):
        score = {a * 25 + b * 5 + c: sum(x[p] @ code[k] for (p, code), k in zip(parts, (a, b, c))) for a in range(5) for b in range(5) for c in range(5)}
        best = max(score.values())
        assert score[home[i]] == pytest.approx(best)
        assert set(name[who == i].tolist()) == {f for f, s in score.items() if best - s <= 0.4 + 1e-12}


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    table = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [1.0, None], 1), (8, [inf, 1.0], 1), (9, [nan, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 2),
        (12, [1e-42, 0.0], 1), (13, [3e38, 3e38], 1), (14, [-1.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame(table, SCHEMA)
    assert rows(capfilters.near_dedup(vectors.selectExpr("*", "'x' AS cls", "'x' AS n_links", "1 AS component"))) == brute(table)
    assert capfilters.near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("codes", [8, 16, 40])
def test_recall_does_not_depend_on_the_number_of_directions(spark, codes):
    table = planted(seed=9)
    expected = sum(e[1] for e in brute(table))
    got = rows(capfilters.near_dedup(spark.createDataFrame(table, SCHEMA), codes=codes))
    assert expected > 100 and 0.99 * expected <= sum(g[1] for g in got) <= expected


def test_work_per_vector_grows_slower_than_the_table():
    draw = np.random.default_rng(2)
    units = capfilters.unit(draw.standard_normal((3000, 64)))
    share = {}
    for codes in (8, 16, 32):
        home, who, name = capfilters.decode(units, capfilters.directions(64, 2, codes), capfilters.reach_of(64))
        held = np.bincount(home, minlength=codes**2)
        share[codes] = held[name].sum() / len(units) ** 2
        assert len(who) / len(units) < 3 * codes
    # Four times the classes, twice the directions: half the share of them is met.
    assert share[32] < 0.6 * share[16] < 0.36 * share[8]
    assert [capfilters.codes_for(n) for n in (0, 16_384, 65_536, 4 * 65_536)] == [8, 8, 16, 32]
