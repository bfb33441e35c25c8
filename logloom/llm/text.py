"""Small helpers shared by the text operators."""

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space. ``bytes.split()`` cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows taken at once inside a task; a batch of long texts never turns into Python objects as a whole.
ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small pieces."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def returning_memory(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same task, which gives memory that it no longer uses back to the system when it ends.

    Worker processes are kept for the next task. Without this they hold what the largest task needed beside the JVM's own work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # GNU C library
            trim(0)

    return run


def small_table(spark: SparkSession, rows: Iterable[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A few rows that the driver has, as a table.

    They go to Spark as Arrow data. Given as Python objects they would be read by Python workers of another kind than those of ``mapInArrow``, which
    stay on every executor beside them.
    """
    schema = pa.schema(columns)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(columns, row)) for row in rows], schema=schema))


def sized_slices(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of one row or of up to ``size`` bytes in a text column."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, end - start)
            start = end


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [text or "" for text in column.to_pylist()]


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by id and text, so that repeated ids with different texts stay apart and nulls compare equal.

    Two rows with the same id share a key only if two 64-bit hashes of their texts agree.
    """
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text, F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2"))


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``rejected`` (one column ``key`` as :func:`row_key` makes it), columns unchanged."""
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key().alias("key"))
    kept = marked.join(rejected.select("key").distinct(), marked["key"].eqNullSafe(rejected["key"]), "left_anti")
    return kept.select("row.*")


def only_one(docs: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is in ``winners``, one row for each key, columns unchanged."""
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key().alias("key"))
    kept = marked.join(winners.select("key"), marked["key"].eqNullSafe(winners["key"]), "left_semi")
    return kept.dropDuplicates(["key"]).select("row.*")
