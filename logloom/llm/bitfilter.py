"""A filter of bounded size over 64-bit hashes: never misses a member, lets a few others through.

It is the only thing broadcast about a set that grows with the corpus. Its size does not beyond ``2 ** bits`` bits; small sets have smaller filters. On larger
sets more strangers pass, which costs time in the exact step behind the filter and never changes its result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.text import slices
from logloom.sources.durable import shuffles_released

BITS = 27
#: Words of 64 bits for each that has a bit set, and at least, where the bound leaves room: one stranger in 4,096 passes.
SPARSE, LEAST_WORDS = 64, 1 << 10


def release(used: list[Broadcast]) -> None:
    """Takes filters off the disks of driver and executors; what reads them is stored by then."""
    while used:
        used.pop().destroy()


def build(members: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """The filter of the hashes in ``column``, broadcast once; Spark sets the bits, the driver gets at most ``2 ** (bits - 6)`` words of 64.

    ``members`` is often still to be made from whole texts, so Python workers get little at once here as well.
    """
    with shuffles_released(members.sparkSession):
        words = members.groupBy(_word(F.col(column), bits).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(column).bitwiseAND(63).cast("int"))).alias("bits")
        )
        found = words.toArrow()
    out = np.zeros(min(1 << (bits - 6), max(LEAST_WORDS, 1 << (SPARSE * found.num_rows).bit_length())), np.uint64)
    np.bitwise_or.at(out, found["word"].to_numpy() & (len(out) - 1), found["bits"].to_numpy().view(np.uint64))
    return members.sparkSession.sparkContext.broadcast(out)


def _word(hashed: Column, bits: int) -> Column:
    return F.shiftright(hashed, 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1).cast("bigint"))


def holds(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be members."""
    at = (hashes >> np.uint64(6)) & np.uint64(len(words) - 1)
    return (words[at.astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def members(rows: DataFrame, shared: Broadcast, column: str, wanted: bool = True) -> DataFrame:
    """Rows whose hash in ``column`` passes (or does not pass) the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = batch[column].to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(holds(shared.value, hashes) == wanted))

    return rows.mapInArrow(run, rows.schema)
