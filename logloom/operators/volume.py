"""Line counts per component, level and template.

All functions take parsed lines or, with ``weight``, a table that already carries line counts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed
from logloom.operators import heavy_hitters


def line_count(weight: str | None = None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def count_by(lines: DataFrame, key: str, total: str, weight: str | None = None) -> DataFrame:
    """Counts per value of ``key``, largest first, ties in key order."""
    counts = lines.groupBy(key).agg(line_count(weight).alias(total))
    return counts.orderBy(F.desc(total), F.asc(key))


def component_volume(lines: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(lines, "Component", "Total_Logs", weight)


def severity_levels(lines: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(lines, "Level", "Total_Logs", weight)


def top_templates(lines: DataFrame, k: int = fixed.TOP_TEMPLATES, weight: str | None = None) -> DataFrame:
    return count_by(lines, "EventTemplate", "Actions", weight).limit(k)


def frequent_templates(lines: DataFrame, k: int = fixed.TOP_TEMPLATES, weight: str | None = None, counters: int = heavy_hitters.COUNTERS) -> DataFrame:
    """:func:`top_templates` for text whose templates are mostly unique: the same table, without a shuffle of all templates.

    The lines are read twice, with counters of bounded size and for an exact count of the few templates that can be among the first.
    """
    return heavy_hitters.top(lines, "EventTemplate", "Actions", k, weight, counters)
