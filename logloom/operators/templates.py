"""Event-template concentration."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed, numbers, text
from logloom.operators.guards import require_columns


def template_concentration(templates: DataFrame, k: int = fixed.REPORT_TEMPLATES) -> DataFrame:
    """The ``k`` most frequent templates with a shortened label and a printable count."""
    require_columns(templates, "EventTemplate", "Actions")
    return (
        templates.orderBy(F.desc("Actions"), F.asc("EventTemplate"))
        .limit(k)
        .select(
            text.shorten(F.col("EventTemplate")).alias("Short_Name"),
            "EventTemplate",
            "Actions",
            numbers.grouped(F.col("Actions")).alias("Actions_Text"),
        )
    )
