"""Stage timings of the batch jobs and the speedup between two worker setups."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed, numbers
from logloom.operators.guards import require_columns


def ordered_timings(timings: DataFrame, stages: Sequence[str] = fixed.STAGES) -> DataFrame:
    """Timings by setup, in stage order; stages that are not listed come last, by name."""
    require_columns(timings, "Process", "Worker Setup", "Seconds")
    place = F.array_position(F.array(*[F.lit(stage) for stage in stages]), F.col("Process"))
    order = F.when(place > 0, place).otherwise(len(stages) + 1).cast("int")
    return timings.withColumn("Stage_Order", order).orderBy("Worker Setup", "Stage_Order", "Process")


def stage_speedup(
    timings: DataFrame,
    setups: Sequence[str] = fixed.WORKER_SETUPS,
    stages: Sequence[str] = fixed.STAGES,
) -> DataFrame:
    """One row per stage: seconds under either setup, of several runs the fastest, and their quotient.

    The last row sums the stages that have a time under both setups, so no stage is left out of the whole.
    """
    slow, fast = setups
    wide = (
        ordered_timings(timings, stages)
        .groupBy("Process", "Stage_Order")
        .pivot("Worker Setup", [slow, fast])
        .agg(F.min("Seconds"))
        .withColumnsRenamed({slow: "Slow", fast: "Fast"})
    )
    exact = lambda name: F.sum(F.col(name).cast("decimal(18,6)")).cast("double").alias(name)  # noqa: E731  in any order
    total = wide.filter("Slow IS NOT NULL AND Fast IS NOT NULL").agg(exact("Slow"), exact("Fast"))
    total = total.select(F.lit(fixed.ALL_STAGES).alias("Process"), F.lit(len(stages) + 2).alias("Stage_Order"), "Slow", "Fast")
    return wide.unionByName(total).orderBy("Stage_Order", "Process").select(
        "Process",
        F.col("Slow").alias(fixed.TITLE_SLOW),
        F.col("Fast").alias(fixed.TITLE_FAST),
        numbers.round_half_even(F.try_divide("Slow", "Fast"), 2).alias(fixed.TITLE_SPEEDUP),
    )
