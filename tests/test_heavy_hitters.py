"""Bounded counters, and the most frequent values by way of them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logloom.operators import heavy_hitters, hourly, system_log, volume
from logloom.registry import event_source


def skewed(seed, heavy=12, rare=6000):
    draw = random.Random(seed)
    values = [f"heavy {i}" for i in range(heavy) for _ in range(900 - 40 * i)] + [f"rare {i}" for i in range(rare)]
    draw.shuffle(values)
    return values


def first(counts, k):
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:k]


@pytest.mark.parametrize("most", [1, 7, 50, 100_000])
def test_counters_bound_every_count(most):
    values = skewed(1)
    held = heavy_hitters.Counters(most)
    for start in range(0, len(values), 97):
        part = Counter(values[start : start + 97])
        held.add(list(part), list(part.values()))
        assert len(held.counts) <= 2 * most
    true = Counter(values)
    for value, n in true.items():
        assert held.counts.get(value, 0) <= n <= held.counts.get(value, 0) + held.error
    # What is taken off is taken off more than ``most`` counters.
    assert held.error * (most + 1) <= len(values)


@pytest.mark.parametrize("counters, candidates", [(256, 65_536), (256, 3), (4, 65_536), (100_000, 65_536)])
def test_top_is_exact_on_every_way(spark, counters, candidates):
    values = skewed(2)
    table = spark.createDataFrame([(v,) for v in values], "value string").repartition(6)
    found = heavy_hitters.top(table, "value", "n", 10, None, counters, candidates)
    assert [tuple(r) for r in found.collect()] == first(Counter(values), 10)


def test_few_candidates_are_counted_when_counters_separate(spark):
    table = spark.createDataFrame([(v,) for v in skewed(3)], "value string").repartition(6).cache()
    found = heavy_hitters.sketch(table, "value", None, 256).cache()
    merged = found.filter("low > 0").groupBy("value").agg(F.sum("low").alias("low"))
    error = found.agg(F.sum("error")).first()[0]
    bound = heavy_hitters.bound_of(merged, error, 10)
    assert 0 < error < bound.kth_low and bound.separates
    assert merged.filter(F.col("low") + error >= bound.kth_low).count() <= 12
    # Each task hands on a bounded number of counters, whatever the number of values.
    assert found.count() <= 6 * 257
    # With few values there is nothing to take off.
    assert heavy_hitters.bound_of(merged.limit(3), 0, 10).separates
    assert not heavy_hitters.bound_of(merged.limit(3), 5, 10).separates


def test_weights_nulls_and_ties(spark):
    rows = [("a", 5), ("b", 5), (None, 9), ("c", 1), ("a", 1), ("b", 1)]
    table = spark.createDataFrame(rows, "t string, w bigint")
    assert [tuple(r) for r in heavy_hitters.top(table, "t", "n", 3, "w").collect()] == [(None, 9), ("a", 6), ("b", 6)]
    assert heavy_hitters.top(table.limit(0), "t", "n", 3).collect() == []


def test_frequent_templates_equal_top_templates(spark):
    parsed = event_source.parsed_system(spark, "/root/testdata/sf0.001")
    expected = [tuple(r) for r in volume.top_templates(parsed).collect()]
    for counters in (2, 4096):
        assert [tuple(r) for r in volume.frequent_templates(parsed, counters=counters).collect()] == expected
    summary = system_log.summarise(parsed)
    assert [tuple(r) for r in volume.frequent_templates(summary, weight="Line_Count").collect()] == expected


def test_hours_add_up_in_any_number_of_parts(spark):
    parsed = event_source.parsed_system(spark, "/root/testdata/sf0.01").cache()
    exact = hourly.hourly_features(parsed)
    parts = [hourly.hourly_sketches(parsed.filter(F.length("Content") % 3 == part)) for part in range(3)]
    whole, added = hourly.merged_hours(hourly.hourly_sketches(parsed)), hourly.merged_hours(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for table in (whole, added):
        assert table.columns == exact.columns and [t for _, t in table.dtypes] == [t for _, t in exact.dtypes]
        for one, other in zip(table.collect(), exact.collect(), strict=True):
            assert {**one.asDict(), "Unique_Templates": 0} == {**other.asDict(), "Unique_Templates": 0}
            assert abs(one.Unique_Templates - other.Unique_Templates) <= 0.07 * other.Unique_Templates + 1


def test_sketches_of_a_summary_and_of_unlisted_components(spark):
    parsed = event_source.parsed_system(spark, "/root/testdata/sf0.001")
    one = hourly.merged_hours(hourly.hourly_sketches(parsed))
    two = hourly.merged_hours(hourly.hourly_sketches(system_log.summarise(parsed), weight="Line_Count"))
    assert one.collect() == two.collect()
    with pytest.raises(Exception, match="components other than"):
        hourly.hourly_sketches(parsed.withColumn("Component", F.lit("XYZ"))).collect()


def test_the_bounded_summary_does_not_grow_with_the_templates(spark):
    parsed = event_source.parsed_system(spark, "/root/testdata/sf0.001").withColumn("EventTemplate", F.col("Content"))
    whole, bounded = system_log.summarise(parsed).count(), system_log.bounded_summary(parsed)
    assert bounded.count() == system_log.with_hour(parsed).select("Hour_Window", "Level", "Component").distinct().count() < whole
    one, two = hourly.hourly_sketches(parsed), hourly.hourly_sketches(bounded, weight="Line_Count")
    for merged, exact in zip(hourly.merged_hours(two).collect(), hourly.hourly_features(parsed).collect(), strict=True):
        assert {**merged.asDict(), "Unique_Templates": 0} == {**exact.asDict(), "Unique_Templates": 0}
        assert abs(merged.Unique_Templates - exact.Unique_Templates) <= 0.07 * exact.Unique_Templates + 1
    assert one.drop("Templates_Sketch").exceptAll(two.drop("Templates_Sketch")).count() == 0
