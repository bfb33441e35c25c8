"""The anomaly model: exact parts against numpy, the forest against its definition and by its properties."""

import math
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from logloom.functions import fixed
from logloom.operators import anomaly, isolation_forest as forest

PLANTED = 333


def hours_table(spark, count, planted=None):
    hour = F.timestamp_seconds(F.lit(1_451_606_400) + F.col("id") * 3600).cast("timestamp_ntz")
    odd = F.col("id") == F.lit(-1 if planted is None else planted)
    return spark.range(count).select(
        hour.alias("Hour_Window"),
        (F.pmod(F.xxhash64("id"), F.lit(50)) + 100 + F.when(odd, 9000).otherwise(0)).alias("Total_Logs"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30)) + 30).alias("CBS_Count"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20)) + F.when(odd, 800).otherwise(0)).alias("CSI_Count"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(12)) + F.when(odd, 70).otherwise(0)).alias("Unique_Templates"),
        F.lit(3).cast("bigint").alias("Active_Components"),
        (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(40)) / 100.0).alias("CSI_Ratio"),
    )


def by_hour(scores):
    return {row.Hour_Window: row.Anomaly_Score for row in scores.collect()}


@pytest.fixture(scope="module")
def hours(spark):
    return hours_table(spark, 720, PLANTED).cache()


@pytest.fixture(scope="module")
def scores(hours):
    return anomaly.anomaly_scores(hours).cache()


def test_planted_hour_is_worst(hours, scores):
    planted = hours.filter("Total_Logs > 9000").first().Hour_Window
    triage = anomaly.anomaly_triage(scores).collect()
    assert triage[0].Hour_Window == planted
    assert [row.Anomaly_Score for row in triage] == sorted(row.Anomaly_Score for row in triage)
    assert len(triage) == 20 and len(anomaly.anomaly_triage(scores, 5).collect()) == 5


def test_share_of_flagged_hours(scores):
    kpis = anomaly.anomaly_kpis(scores).first()
    assert kpis.Total_Windows == 720
    assert abs(kpis.Flagged_Windows - 0.03 * 720) <= 1
    assert kpis.Anomaly_Rate_Text == f"{kpis.Flagged_Windows / 720 * 100:.1f}%"
    assert anomaly.flagged(scores).filter("Anomaly_Score >= 0").count() == 0


def test_status_and_marker_size(scores):
    rows = anomaly.with_status(scores).collect()
    assert all(row.dot_size == max(row.CSI_Count, 500) for row in rows)
    assert all(row.Status == ("Anomaly 🔴" if row.Is_Anomaly else "Normal 🟢") for row in rows)
    assert {row.dot_size > 500 for row in rows} == {True, False}


def test_order_and_partitioning_do_not_matter(hours, scores):
    shuffled = hours.orderBy(F.desc("Total_Logs")).repartition(7)
    assert by_hour(anomaly.anomaly_scores(shuffled)) == by_hour(scores)


def test_scale_does_not_matter(hours, scores):
    rescaled = hours.withColumn("Total_Logs", F.col("Total_Logs") * 1024)
    expected = by_hour(scores)
    for hour, score in by_hour(anomaly.anomaly_scores(rescaled)).items():
        assert score == pytest.approx(expected[hour], abs=1e-9)


def test_other_seed_gives_other_scores(hours, scores):
    assert by_hour(anomaly.anomaly_scores(hours, seed=7, trees=50)) != by_hour(scores)


def test_input_is_checked(spark):
    with pytest.raises(ValueError):
        anomaly.anomaly_scores(hours_table(spark, 1))
    with pytest.raises(ValueError):
        anomaly.anomaly_scores(hours_table(spark, 9).drop("CSI_Ratio"))
    gap = hours_table(spark, 9).withColumn("CSI_Ratio", F.when(F.col("Hour_Window") != F.lit("2016-01-01"), F.col("CSI_Ratio")))
    assert anomaly.complete_rows(gap).count() == 8


@pytest.mark.parametrize("count, share", [(9, 0.1), (10, 0.05), (99, 0.05), (100, 0.03)])
def test_contamination_tiers(spark, count, share):
    assert tuple(anomaly.contamination_tier(hours_table(spark, count)).first()) == (count, share)
    assert anomaly.Scaler.fit(hours_table(spark, count)).share == share


def test_standardised_features(hours):
    scaled = anomaly.Scaler.fit(hours).transform(hours).toPandas()
    for name in fixed.FEATURES:
        values = scaled[name].to_numpy(dtype=float)
        expected = (values - values.mean()) / (values.std() or 1.0)
        np.testing.assert_allclose(scaled[f"{name}_Z"], expected, rtol=1e-9, atol=1e-9)
    assert set(scaled["Active_Components_Z"]) == {0.0}


@pytest.mark.parametrize("share", [0.0, 0.03, 0.1, 0.5, 1.0])
def test_quantile_by_either_way(spark, share):
    table = spark.range(30_000).select((F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7.0).alias("v")).cache()
    expected = np.percentile(table.toPandas()["v"], share * 100)
    assert anomaly.quantile(table, "v", share) == pytest.approx(expected, rel=1e-12)
    assert anomaly.quantile(table, "v", share, exact_rows=1000) == pytest.approx(expected, rel=1e-12)


def test_quantile_of_mostly_equal_values(spark):
    table = spark.range(30_000).select(F.when(F.col("id") < 10_000, 1.0).otherwise(F.col("id") * 1.0).alias("v")).cache()
    expected = np.percentile(table.toPandas()["v"], 3)
    assert anomaly.quantile(table, "v", 0.03, exact_rows=1000) == expected == 1.0


def test_average_path():
    assert list(forest.average_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert float(forest.average_path(256)) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def walk(tree, point):
    """Depth of the leaf a point ends in, plus what it left unsplit, by following the definition."""
    node = 0
    while tree["left"][node] != node:
        node = tree["left"][node] + int(point[tree["feature"][node]] > tree["threshold"][node])
    return tree["path_length"][node]


def partition_depths(tree, points):
    """Leaf sizes and depths by sending the training points down the tree."""
    leaves, open_nodes = {}, [(0, np.arange(len(points)), 0)]
    while open_nodes:
        node, members, depth = open_nodes.pop()
        if tree["left"][node] == node:
            leaves[node] = (len(members), depth)
            continue
        right = points[members, tree["feature"][node]] > tree["threshold"][node]
        assert right.any() and not right.all()  # every split separates something
        open_nodes.append((tree["left"][node], members[~right], depth + 1))
        open_nodes.append((tree["left"][node] + 1, members[right], depth + 1))
    return leaves


@pytest.mark.parametrize("rows, distinct", [(2, 2), (3, 3), (256, 1000), (256, 3), (100, 1)])
def test_trees_follow_their_definition(rows, distinct):
    rng = np.random.default_rng(5)
    points = rng.integers(0, distinct, size=(rows, 3)).astype(float)
    limit = math.ceil(math.log2(rows))
    tree = forest.grow_tree(points, limit, np.random.default_rng(1))
    leaves = partition_depths(tree, points)
    assert sum(size for size, _ in leaves.values()) == rows
    assert len(tree["left"]) == 2 * len(leaves) - 1
    for node, (size, depth) in leaves.items():
        assert depth <= limit
        assert tree["path_length"][node] == pytest.approx(depth + float(forest.average_path(size)))


def test_scores_follow_their_definition():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(64, 4))
    trees = [forest.grow_tree(points, 6, np.random.default_rng(i)) for i in range(20)]
    roots = np.concatenate([[0], np.cumsum([len(tree["left"]) for tree in trees])[:-1]])
    nodes = {name: np.concatenate([tree[name] for tree in trees]) for name in ("feature", "threshold", "path_length")}
    nodes["left"] = np.concatenate([tree["left"] + root for tree, root in zip(trees, roots)])
    nodes["roots"] = roots
    found = forest.raw_scores(points, nodes, 6, 64)
    for point, score in zip(points, found):
        mean = np.mean([walk(tree, point) for tree in trees])
        assert score == pytest.approx(-(2 ** (-mean / float(forest.average_path(64)))))


def test_early_cut_of_draws_changes_no_sample(spark):
    table = hours_table(spark, 3000).cache()
    drawn = [
        forest.draw_samples(table, ["Total_Logs"], ["Hour_Window"], 3000, 5, 64, 42, spare=spare).select("tree_id", "Hour_Window")
        for spare in (True, False)
    ]
    assert drawn[0].count() == drawn[1].count() == 5 * 64
    assert drawn[0].exceptAll(drawn[1]).count() == 0


def test_task_code_needs_no_copy_of_the_package(tmp_path):
    task = tmp_path / "task"
    task.write_bytes(cloudpickle.dumps(forest.grow_tree))
    check = (
        "import pickle, sys, numpy as np; grow = pickle.load(open(sys.argv[1], 'rb')); "
        "assert len(grow(np.arange(8.0).reshape(4, 2), 2, np.random.default_rng(0))['left']) >= 3"
    )
    subprocess.run([sys.executable, "-c", check, str(task)], cwd=tmp_path, check=True)


def test_trees_may_draw_from_disjoint_parts(spark):
    table = spark.range(40_000).select("id", (F.col("id") % 101).alias("a"), (F.col("id") % 13).alias("b"))
    for spare in (True, False):
        drawn = forest.draw_samples(table, ["a", "b"], ["id"], 40_000, 20, 64, 3, spare, once=True).toPandas()
        assert len(drawn) == drawn["id"].nunique() == 20 * 64 and set(drawn.groupby("tree_id").size()) == {64}
    model = forest.fit_forest(table, ["a", "b"], ["id"], trees=20, sample=64, count=40_000, once=True)
    odd = spark.createDataFrame([(50.0, 6.0), (5000.0, 900.0)], "a double, b double")
    normal, far = (row.Raw_Score for row in model.score(odd).collect())
    assert far < normal


def test_draws_without_spare_equal_those_with(spark):
    table = spark.range(5_000).selectExpr("id", "id % 7 AS a")
    one, two = (forest.draw_samples(table, ["a"], ["id"], 5_000, 5, 32, 1, spare).collect() for spare in (True, False))
    assert sorted(one) == sorted(two)


def test_keys_must_tell_rows_apart(spark):
    table = spark.range(50).select((F.col("id") % 10).alias("k"), F.col("id").cast("double").alias("a"))
    with pytest.raises(Exception, match="does not tell rows apart"):
        forest.fit_forest(table, ["a"], ["k"], trees=3, sample=40)


def test_least_draws_in_parts_equal_those_of_the_whole():
    draw = np.random.default_rng(5)
    rows = pa.table({"id": np.arange(3000)})
    row, tree, value = np.repeat(np.arange(3000), 4), np.tile(np.arange(4), 3000), draw.integers(-(2**62), 2**62, 12_000)
    kept = forest.LeastDraws(4, 16)
    for start in range(0, 12_000, 400):
        part = slice(start, start + 400)
        kept.add(rows, row[part], tree[part], value[part])
    trees, draws, table = kept.shrink()
    for t in range(4):
        expected = sorted(zip(value[tree == t], row[tree == t]))[:16]
        assert list(zip(draws[trees == t], np.array(table["id"])[trees == t])) == expected


def test_node_table(spark):
    table = spark.range(300).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    model = forest.fit_forest(table, ["a", "b"], ["id"], trees=4, sample=32)
    nodes = model.table(spark).toPandas()
    assert len(nodes) == len(model.nodes["left"]) and set(nodes.tree_id) == {0, 1, 2, 3}
    inner = nodes[nodes.left != nodes.node]
    # Children of a node are in its tree, each node but the roots is a child once.
    assert (nodes.tree_id[inner.left].to_numpy() == inner.tree_id.to_numpy()).all()
    children = np.concatenate([inner.left, inner.left + 1])
    assert sorted([*children, *model.nodes["roots"]]) == list(range(len(nodes)))
