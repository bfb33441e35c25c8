"""Comparing components: shares, ranks, gaps to a benchmark.

These work on the component volume table. It has one row per component name the parser looks for plus one for
lines without any, so the windows over the whole table below are over a handful of rows.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions import fixed, numbers
from logloom.operators.guards import require_columns, require_values


def whole_table():
    return Window.partitionBy()


def with_share_and_rank(volume: DataFrame) -> DataFrame:
    """Name the unlabelled row, add the share of all lines in percent and the dense rank by volume."""
    require_columns(volume, "Component", "Total_Logs")
    nameless = F.coalesce(F.col("Component"), F.lit("")) == ""
    total = F.sum("Total_Logs").over(whole_table())
    return volume.select(
        F.when(nameless, fixed.UNLABELED).otherwise(F.col("Component")).alias("Component"),
        "Total_Logs",
        (F.try_divide(F.col("Total_Logs"), total) * 100).alias("SharePct"),
        F.dense_rank().over(Window.orderBy(F.desc("Total_Logs"))).alias("Rank"),
    ).orderBy(F.desc("Total_Logs"), F.asc("Component"))


def default_selection(ranked: DataFrame, k: int = fixed.DEFAULT_SELECTION) -> DataFrame:
    """The ``k`` components with most lines."""
    return ranked.select("Component", "Total_Logs").orderBy(F.desc("Total_Logs"), F.asc("Component")).limit(k)


def compare_to_benchmark(ranked: DataFrame, selected: Sequence[str], benchmark: str) -> DataFrame:
    """Selected components with their volume as a multiple of the benchmark's and the gap to it in percent."""
    require_values(selected, "component")
    if benchmark not in selected:
        raise ValueError(f"benchmark {benchmark!r} is not among the selected components")
    chosen = ranked.filter(F.col("Component").isin(list(selected)))
    is_benchmark = F.col("Component") == benchmark
    reference = F.max(F.when(is_benchmark, F.col("Total_Logs"))).over(whole_table())
    gap = F.try_divide(F.col("Total_Logs") - reference, reference) * 100
    return chosen.select(
        "Component",
        "Total_Logs",
        "SharePct",
        "Rank",
        numbers.round_half_even(F.try_divide(F.col("Total_Logs"), reference), 3).alias("Vs_Benchmark"),
        numbers.round_half_even(gap, 2).alias("RelativeGapPct"),
    ).orderBy(F.desc("Total_Logs"), F.asc("Component"))


def comparison_table(comparison: DataFrame) -> DataFrame:
    """The comparison under the column titles of the report."""
    return comparison.withColumnsRenamed(
        {
            "SharePct": fixed.TITLE_SHARE,
            "Vs_Benchmark": fixed.TITLE_MULTIPLE,
            "RelativeGapPct": fixed.TITLE_GAP,
        }
    )


def metric_view(comparison: DataFrame, relative: bool = False) -> DataFrame:
    """One value per component, absolute volume or share, largest first."""
    metric = F.col("SharePct") if relative else F.col("Total_Logs")
    return comparison.select("Component", metric.alias("Value")).orderBy(F.desc("Value"), F.asc("Component"))


def cards(comparison: DataFrame, benchmark: str) -> DataFrame:
    """The texts of each component's summary card, largest component first."""
    badge = F.when(F.col("Component") == benchmark, fixed.CARD_BADGE).otherwise("")
    change = numbers.signed_decimals(F.col("RelativeGapPct"), 1)
    share = numbers.decimals(F.col("SharePct"), 2)
    return comparison.orderBy(F.desc("Total_Logs"), F.asc("Component")).select(
        F.concat(F.col("Component"), badge).alias("Title"),
        numbers.grouped(F.col("Total_Logs")).alias("Value"),
        F.concat(change, F.lit(fixed.CARD_DELTA + benchmark)).alias("Delta"),
        F.concat(F.lit(fixed.CARD_RANK), F.col("Rank").cast("string"), F.lit(fixed.CARD_SHARE), share, F.lit("%")).alias("Note"),
    )


def selected_share(ranked: DataFrame, selected: Sequence[str]) -> DataFrame:
    """Share of each selected component among the selected ones, in percent."""
    require_values(selected, "component")
    total = F.sum("Total_Logs").over(whole_table())
    return (
        ranked.filter(F.col("Component").isin(list(selected)))
        .select("Component", "Total_Logs", (F.try_divide(F.col("Total_Logs"), total) * 100).alias("SelectedSharePct"))
        .orderBy(F.desc("Total_Logs"), F.asc("Component"))
    )
