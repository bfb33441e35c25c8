"""Writing result tables, text and run timings."""

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.sources import files
from logloom.sources.readers import result_path

PREVIEW_ROWS = 20


@dataclass(frozen=True)
class Export:
    """What writing one result took and gave."""

    seconds: float
    rows: int
    bytes: int


def write_result(table: DataFrame, base: str, name: str) -> str:
    """Replace the named result table under ``base``; the old one stays until the new one is whole."""
    path = result_path(base, name)
    files.replace(table, path)
    return path


def export(
    spark: SparkSession,
    result: str | DataFrame,
    name: str,
    base: str,
    mirror: str | None = None,
) -> float:
    """:func:`measured_export`, of which only the seconds count."""
    return measured_export(spark, result, name, base, mirror).seconds


def measured_export(
    spark: SparkSession,
    result: str | DataFrame,
    name: str,
    base: str,
    mirror: str | None = None,
) -> Export:
    """Write a query text or table as the named result; rows are counted while they are written, bytes are those of the stored files.

    The copy under ``mirror`` is made from the stored result, which is not computed again for it.
    """
    started = time.monotonic()
    table = spark.sql(result) if isinstance(result, str) else result
    if not table.columns:
        raise ValueError(f"{name} has no columns")
    seen = Observation()
    path = write_result(table.observe(seen, F.count(F.lit(1)).alias("rows")), base, name)
    if mirror is not None:
        write_result(spark.read.schema(table.schema).parquet(path), mirror, name)
    return Export(time.monotonic() - started, seen.get["rows"], files.stored_bytes(spark, path))


def append_metrics(spark: SparkSession, path: str, setup: str, exports: Mapping[str, Export]) -> None:
    """Add seconds, rows and bytes of the exports of one run to the metrics table, as one small file."""
    runs = [(process, setup, float(made.seconds), made.rows, made.bytes) for process, made in exports.items()]
    spark.createDataFrame(runs, schemas.RUN_METRICS).coalesce(1).write.mode("append").parquet(path)


def append_timings(spark: SparkSession, path: str, setup: str, seconds: Mapping[str, float]) -> None:
    """Add the stage times of one run to the timings table, as one small file."""
    runs = [(process, setup, float(taken)) for process, taken in seconds.items()]
    spark.createDataFrame(runs, schemas.STAGE_TIMINGS).coalesce(1).write.mode("append").parquet(path)


def write_lines(lines: DataFrame, path: str, files: int | None = None, value: str = "value") -> None:
    """Write a text column, one line per row, into ``files`` files or as many as there are tasks.

    Only an exact number of files needs a shuffle.
    """
    text = lines.select(F.col(value).alias("value"))
    if files is not None:
        text = text.repartition(files)
    text.write.mode("overwrite").text(path)


def register_view(table: DataFrame, name: str) -> DataFrame:
    """Make a table available to SQL under ``name``."""
    table.createOrReplaceTempView(name)
    return table


def show(table: DataFrame, rows: int = PREVIEW_ROWS) -> None:
    """A preview on the console; use :func:`export` to keep the table."""
    table.show(rows, truncate=False)
