"""Intermediate tables that outlive executors.

A table that later steps read more than once is written to the shared checkpoint folder, so that losing an
executor costs a re-read and never a recomputation from raw text.
"""

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from logloom.sources.files import delete

_tables_of_job: ContextVar[list[str] | None] = ContextVar("tables_of_job", default=None)


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that :func:`durable` stores inside the block when the block ends well.

    For jobs that write their results before they end. After an error the tables stay, for a look at them.
    """
    paths: list[str] = []
    token = _tables_of_job.set(paths)
    try:
        yield
    finally:
        _tables_of_job.reset(token)
    for name in paths:
        delete(spark, name)


def discard(table: DataFrame) -> None:
    """Removes the files of a table that :func:`durable` returned, once nothing that is still to be computed reads it."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        delete(table.sparkSession, folder)


#: Spark's setting to remove the shuffle files of a query when it ends. A stored table needs none of them any more.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's limit of the bytes it sends to a Python worker at once. Its default of 64 MB, twice in memory for each task, is much beside rows that hold whole texts.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: Spark's number of rows that a task reads from a parquet file at once. Its default of 4,096 is a whole file where a row holds 100 KB and more.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
#: Of tables with such rows: rows read at once, bytes sent to a Python worker at once, bytes of a row group, rows after which its size is looked at.
WIDE_ROWS, WIDE_BATCH_BYTES, WIDE_GROUP_BYTES, WIDE_CHECK_ROWS = 8, 2 << 20, 4 << 20, 8


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside the block leave no shuffle files on the executors' disks, and send little to a Python worker at once."""
    before = {RELEASE: spark.conf.get(RELEASE, "false"), BATCH: spark.conf.get(BATCH)}
    spark.conf.set(RELEASE, "true")
    if (limit := before[BATCH].removesuffix("b")).isdigit() and int(limit) > BATCH_BYTES:  # else somebody has chosen it
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def wide_rows_read(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside the block take few rows of a stored table at once, as fits rows of 100 KB and more."""
    before = {READ_ROWS: spark.conf.get(READ_ROWS), BATCH: spark.conf.get(BATCH)}
    limits = {READ_ROWS: (WIDE_ROWS, ""), BATCH: (WIDE_BATCH_BYTES, "b")}
    for name, (most, unit) in limits.items():
        if (limit := before[name].removesuffix("b")).isdigit() and int(limit) > most:  # else somebody has chosen it
            spark.conf.set(name, f"{most}{unit}")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; on a cluster no machine-local folder would do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="logloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(table: DataFrame, name: str = "table", wide: Sequence[str] = ()) -> DataFrame:
    """The same rows, computed once and read from a parquet table in the shared folder from then on.

    A table whose rows are of 100 KB and more says which parquet columns make them ``wide``. It is stored in small row groups and pages, since a task that writes or
    reads holds a whole one of each; these columns get no dictionary, which would be made anew for each row group.
    """
    spark = table.sparkSession
    path = scratch_path(spark, name)
    writer = table.write
    if wide:
        checks = {f"parquet.{of}.size.row.check.min": WIDE_CHECK_ROWS for of in ("block", "page")}
        plain = {f"parquet.enable.dictionary#{column}": "false" for column in wide}
        writer = writer.options(**{"parquet.block.size": WIDE_GROUP_BYTES, **checks, **plain})
    with shuffles_released(spark):
        writer.parquet(path)
    if (paths := _tables_of_job.get()) is not None:
        paths.append(path)
    return spark.read.schema(table.schema).parquet(path)
