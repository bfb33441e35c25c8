"""Severity mix."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import numbers
from logloom.operators.guards import require_columns


def severity_summary(levels: DataFrame) -> DataFrame:
    """One row: all lines, info lines, error lines and the error share; level names match in any case."""
    require_columns(levels, "Level", "Total_Logs")
    level = F.lower(F.col("Level").cast("string"))

    def lines_at(name: str):
        return F.coalesce(F.sum(F.when(level == name, F.col("Total_Logs"))), F.lit(0))

    totals = levels.agg(
        F.coalesce(F.sum("Total_Logs"), F.lit(0)).cast("bigint").alias("Total_Logs"),
        lines_at("info").cast("bigint").alias("Info_Logs"),
        lines_at("error").cast("bigint").alias("Error_Logs"),
    )
    share = F.try_divide(F.col("Error_Logs"), F.col("Total_Logs")) * 100
    return totals.withColumn("Error_Pct", F.coalesce(share, F.lit(0.0))).withColumn(
        "Error_Text",
        F.concat(
            numbers.decimals(F.col("Error_Pct"), 3),
            F.lit("% ("),
            numbers.grouped(F.col("Error_Logs")),
            F.lit(" of "),
            numbers.grouped(F.col("Total_Logs")),
            F.lit(")"),
        ),
    )
