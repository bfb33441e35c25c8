"""Pipe-delimited server-metric lines: parsing, severity and the per-server reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed, render, text

LINE_COUNT = "Line_Count"


def parse_server_metrics(lines: DataFrame) -> DataFrame:
    """One row per line; fields a line does not have, or that hold no number, are null."""
    fields = lines.select(F.split("value", text.quoted(fixed.FIELD_SEPARATOR)).alias("fields"))

    def field(position: int):
        return F.get("fields", F.lit(position))

    def whole(position: int):
        # Through double: decimals are dropped, where a direct cast would refuse them.
        return text.first_number(field(position)).try_cast("int")

    return fields.select(
        field(0).alias("Time stamp"),
        field(1).alias("Server"),
        field(2).alias("Level"),
        whole(3).alias("Response Time (ms)"),
        whole(4).alias("CPU (%)"),
        text.first_number(field(5)).alias("Memory (GB)"),
        whole(6).alias("Requests"),
    )


def render_server_metrics(metrics: DataFrame) -> DataFrame:
    """The text lines of a metric table; the inverse of :func:`parse_server_metrics` for complete rows."""
    names = ("Time stamp", "Server", "Level", "Response Time (ms)", "CPU (%)", "Memory (GB)", "Requests")
    return metrics.select(render.metric_line(*[F.col(name) for name in names]).alias("value"))


def classify_severity(metrics: DataFrame, target: str = "Level") -> DataFrame:
    """Set the severity that the row's CPU load and response time call for."""
    return metrics.withColumn(target, render.severity(F.col("CPU (%)"), F.col("Response Time (ms)")))


def summarise(metrics: DataFrame) -> DataFrame:
    """Line counts per server, level and memory value; both reports are aggregates of this table.

    Counts are combined before the shuffle. With memory values that never repeat the table has a row per line, of three columns
    instead of seven.
    """
    return metrics.groupBy("Server", "Level", "Memory (GB)").agg(F.count(F.lit(1)).alias(LINE_COUNT))


def errors_by_server(metrics: DataFrame, level: str = "ERROR", weight: str | None = None) -> DataFrame:
    """Lines at ``level`` per server; ``weight`` names a column of line counts."""
    lines = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        metrics.filter(F.col("Level") == level)
        .groupBy("Server")
        .agg(lines.alias("Total_errors"))
        .orderBy(F.desc("Total_errors"), F.asc("Server"))
    )


def memory_over_average(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Per server: lines above the average memory of all lines, and the highest value; ``weight`` names a column of line counts.

    The average is a scalar subquery, so the table is read twice; give a stored table, not lines to be parsed.
    """
    memory = F.col("Memory (GB)")
    each = F.lit(1) if weight is None else F.col(weight)
    known = F.sum(F.when(memory.isNotNull(), each))
    average = metrics.agg(F.try_divide(F.sum(memory * each), known)).scalar()
    return (
        metrics.filter(memory > average)
        .groupBy("Server")
        .agg(F.sum(each).cast("bigint").alias("times_over_avg"), F.max(memory).alias("peak_memory_gb"))
        .orderBy(F.desc("times_over_avg"), F.asc("Server"))
    )
