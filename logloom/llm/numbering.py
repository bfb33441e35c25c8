"""Places of rows in their groups, without any group passing through one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.sources.durable import durable

PLACE_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: the place of each row in its group, from 0 without gaps. Group columns hold no null.

    Rows are dealt by ranges of group and order, so a large group lies over several tasks. Each task numbers what it holds; what a
    group has in earlier tasks is added from a table with one row per task and group. Rows equal in group and order are spread by
    where they come from, so that a row repeated many times is no hot key either.
    """
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranges = [F.col(g) for g in group] + order + [F.col("_tie")]
    stored = durable(dealt.repartitionByRange(*ranges).sortWithinPartitions(*ranges).drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # The identifier is the number of the task above the place in the task.
    placed = stored.withColumn("_part", F.shiftright("_at", PLACE_BITS)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
    spans = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).drop("_first", "_n")
    return placed.join(spans, [*group, "_part"]).withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
