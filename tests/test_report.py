"""Report operators: shares, ranks, gaps, texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.functions import numbers, text
from logloom.operators import components, severity, stages, templates
from pyspark.sql import functions as F


def volume(spark, *rows):
    return spark.createDataFrame(list(rows), "Component string, Total_Logs bigint")


@pytest.fixture
def ranked(spark):
    return components.with_share_and_rank(volume(spark, ("CBS", 600), ("", 300), ("CSI", 100)))


def test_missing_names_are_unlabelled(spark):
    names = [row.Component for row in components.with_share_and_rank(volume(spark, (None, 2), ("", 1))).collect()]
    assert names == ["Unlabeled", "Unlabeled"]


def test_rank_is_dense_and_shares_add_up(spark):
    rows = components.with_share_and_rank(volume(spark, ("a", 5), ("b", 5), ("c", 2))).collect()
    assert [row.Rank for row in rows] == [1, 1, 2]
    assert sum(row.SharePct for row in rows) == pytest.approx(100)


def test_comparison_keeps_rank_and_share_of_all(ranked):
    rows = components.compare_to_benchmark(ranked, ["CSI", "Unlabeled"], "CSI").collect()
    assert [tuple(row) for row in rows] == [("Unlabeled", 300, 30.0, 2, 3.0, 200.0), ("CSI", 100, 10.0, 3, 1.0, 0.0)]
    assert [row.SelectedSharePct for row in components.selected_share(ranked, ["CSI", "Unlabeled"]).collect()] == [75.0, 25.0]


def test_selection_is_checked(ranked):
    with pytest.raises(ValueError):
        components.compare_to_benchmark(ranked, [], "CBS")
    with pytest.raises(ValueError):
        components.compare_to_benchmark(ranked, ["CBS"], "CSI")
    with pytest.raises(ValueError):
        components.with_share_and_rank(ranked.drop("Total_Logs"))


def test_cards_and_views(ranked):
    comparison = components.compare_to_benchmark(ranked, ["CBS", "CSI"], "CBS")
    cards = [tuple(row) for row in components.cards(comparison, "CBS").collect()]
    assert cards == [
        ("CBS (Benchmark)", "600", "+0.0% vs CBS", "Rank #1 • Share 60.00%"),
        ("CSI", "100", "-83.3% vs CBS", "Rank #3 • Share 10.00%"),
    ]
    assert [row.Value for row in components.metric_view(comparison).collect()] == [600, 100]
    assert [row.Value for row in components.metric_view(comparison, relative=True).collect()] == [60.0, 10.0]
    assert components.comparison_table(comparison).columns[2:] == [
        "Share (%)", "Rank", "Multiple vs Benchmark", "Gap vs Benchmark (%)",
    ]


def test_default_selection_takes_the_largest(spark):
    ranked = components.with_share_and_rank(volume(spark, *[(f"c{i}", i) for i in range(9)]))
    assert [row.Component for row in components.default_selection(ranked).collect()] == [f"c{i}" for i in range(8, 2, -1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=50, max_size=50))
def test_rounding_and_texts_agree_with_python(spark, values):
    """Two-decimal values are where ties happen."""
    exact = [value / 100 for value in values] + [0.125, 0.375, 1.005, 2.675, 0.25, 0.75, -0.25, -0.001, 1e-9]
    table = spark.createDataFrame([(value,) for value in exact], "x double").coalesce(1)
    rows = table.select(
        "x",
        numbers.round_half_even(F.col("x"), 2).alias("two"),
        numbers.signed_decimals(F.col("x"), 1).alias("signed"),
        numbers.decimals(F.col("x"), 2).alias("plain"),
    ).collect()
    for row in rows:
        assert row.two == np.round(row.x, 2)
        assert row.signed == f"{row.x:+.1f}"
        assert row.plain == f"{row.x:.2f}"


def test_severity_summary(spark):
    levels = spark.createDataFrame([("INFO", 3), ("Info", 1), ("error", 1), (None, 3)], "Level string, Total_Logs bigint")
    assert tuple(severity.severity_summary(levels).first()) == (8, 4, 1, 12.5, "12.500% (1 of 8)")
    assert tuple(severity.severity_summary(levels.limit(0)).first()) == (0, 0, 0, 0.0, "0.000% (0 of 0)")


def test_labels_are_cut_beyond_eighty_characters(spark):
    table = spark.createDataFrame([("x" * 80,), ("y" * 81,)], "t string").select(text.shorten(F.col("t")).alias("s"))
    assert [row.s for row in table.collect()] == ["x" * 80, "y" * 77 + "..."]


def test_template_concentration(spark):
    table = spark.createDataFrame([(f"t{i}", 1000 * i) for i in range(10)], "EventTemplate string, Actions bigint")
    rows = templates.template_concentration(table).collect()
    assert [row.Actions for row in rows] == [9000, 8000, 7000, 6000, 5000, 4000, 3000, 2000]
    assert rows[0].Actions_Text == "9,000"


def test_speedup_in_stage_order(spark):
    one, two = "1 Worker Node", "2 Worker Nodes"
    runs = [
        ("Top Event Templates", one, 736.07), ("Top Event Templates", two, 300.09),
        ("Component Volume", two, 71.59), ("Component Volume", one, 147.87), ("Component Volume", one, 150.0),
        ("Something Else", one, 1.0), ("Severity Levels", one, 98.76),
    ]
    timings = spark.createDataFrame(runs, "Process string, `Worker Setup` string, Seconds double")
    assert [tuple(row) for row in stages.stage_speedup(timings).collect()] == [
        ("Component Volume", 147.87, 71.59, 2.07),
        ("Severity Levels", 98.76, None, None),
        ("Top Event Templates", 736.07, 300.09, 2.45),
        ("Something Else", 1.0, None, None),
        ("All Stages", 883.94, 371.68, 2.38),
    ]
    assert [row.Process for row in stages.ordered_timings(timings).collect()][-2:] == ["Component Volume", "Top Event Templates"]
    assert stages.ordered_timings(timings).count() == len(runs)
