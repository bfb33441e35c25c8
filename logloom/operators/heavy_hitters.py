"""The most frequent values of a column without a shuffle of all distinct values.

Each task keeps at most ``2 * counters`` counters (Misra and Gries, 1982; merged as Agarwal and others, 2012). When they are full the value of the largest that has to
go is taken off all of them; the sum of what was taken off is the task's error. So for every value, counted or not::

    low <= true count <= low + error

with ``low`` and ``error`` summed over the tasks. If the k-th largest ``low`` is above ``error`` no value outside the counters can be among the k most frequent, and
of those inside only the ones with ``low + error >= k-th low`` can. These candidates are counted again, exactly. Otherwise, or when there are too many
candidates to hand out, the exact way is taken: all values are grouped. The result is exact either way.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.sources.durable import durable

# The helpers below travel with the tasks that call them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Counters a task hands on, and candidates that are broadcast at most.
COUNTERS, CANDIDATES = 4096, 65_536


class Counters:
    """Counts of values in bounded memory; ``error`` bounds what any value's count lacks."""

    def __init__(self, most: int):
        self.most, self.error = most, 0
        self.counts: dict[str | None, int] = {}

    def add(self, values: list[str | None], counts: list[int]) -> None:
        held = self.counts
        for value, n in zip(values, counts):
            held[value] = held.get(value, 0) + n
        if len(held) > 2 * self.most:
            self.shrink()

    def shrink(self) -> None:
        """Down to ``most`` counters at most: the largest count that has to go is taken off all of them."""
        if len(self.counts) <= self.most:
            return
        sizes = np.fromiter(self.counts.values(), np.int64, len(self.counts))
        off = int(np.partition(sizes, len(sizes) - self.most - 1)[len(sizes) - self.most - 1])
        self.counts = {value: n - off for value, n in self.counts.items() if n > off}
        self.error += off


def sketch(rows: DataFrame, value: str, weight: str | None = None, counters: int = COUNTERS) -> DataFrame:
    """``value, low, error``: the counters of every task, and one row per task with its error and no count.

    ``weight`` names a column of whole numbers, one or more each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counters(counters)
        for batch in batches:
            table = pa.table({"value": batch["value"], "weight": batch["weight"]}).group_by("value").aggregate([("weight", "sum")])
            held.add(table["value"].to_pylist(), table["weight_sum"].to_pylist())
        held.shrink()
        n = len(held.counts)
        columns = [
            pa.array([*held.counts, None], pa.string()), pa.array([*held.counts.values(), 0], pa.int64()),
            pa.array([0] * n + [held.error], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["value", "low", "error"])

    each = F.lit(1) if weight is None else F.col(weight)
    return rows.select(F.col(value).cast("string").alias("value"), each.cast("bigint").alias("weight")).mapInArrow(run, "value string, low bigint, error bigint")


@dataclass(frozen=True)
class Bound:
    """What the counters say about the ``k`` most frequent values."""

    error: int
    kth_low: int
    values: int

    @property
    def separates(self) -> bool:
        """Whether no value outside the counters can be among the k most frequent."""
        return self.error == 0 or self.kth_low > self.error


def bound_of(merged: DataFrame, error: int, k: int) -> Bound:
    """``merged`` has one row per value with its ``low``."""
    largest = [row["low"] for row in merged.orderBy(F.desc("low")).select("low").limit(k).collect()]  # k numbers
    return Bound(error, largest[-1] if len(largest) == k else 0, len(largest))


def top(rows: DataFrame, value: str, total: str, k: int, weight: str | None = None, counters: int = COUNTERS, candidates: int = CANDIDATES) -> DataFrame:
    """The ``k`` most frequent values with their exact counts, largest first, ties in the order of values.

    Two passes over ``rows`` where the counters separate, so it should be cheap to read twice.
    """
    each = F.count(F.lit(1)) if weight is None else F.sum(weight)
    found = durable(sketch(rows, value, weight, counters), "counters")
    error = found.agg(F.sum("error")).first()[0] or 0
    # A task's error row has no count; a null value among the rows has one.
    merged = found.filter("low > 0").groupBy("value").agg(F.sum("low").alias("low"))
    bound = bound_of(merged, error, k)
    counted = rows
    if bound.separates:
        likely = merged.filter(F.col("low") + error >= bound.kth_low).select(F.col("value").alias("_likely"))
        likely = durable(likely.limit(candidates + 1), "candidates")
        if likely.count() <= candidates:
            counted = rows.join(F.broadcast(likely), F.col(value).cast("string").eqNullSafe(F.col("_likely")), "left_semi")
    return counted.groupBy(value).agg(each.alias(total)).orderBy(F.desc(total), F.asc(value)).limit(k)
