"""Reading log text and result tables."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom import schemas
from logloom.sources import files as files_
from logloom.sources.durable import durable


def read_lines(spark: SparkSession, path: str | Sequence[str], max_rows: int = 0, origin: str | None = None) -> DataFrame:
    """Lines of a text file, or of all text files in a folder, as ``value``; ``max_rows`` 0 means all.

    The cap comes before any parsing. With ``origin`` a column of that name holds the file of each line. Plain text splits at any line;
    files packed with a codec that cannot be split are one task each.
    """
    lines = spark.read.schema(schemas.RAW_LINES).text(path)
    if max_rows > 0:
        lines = first_rows(spark, lines.inputFiles(), max_rows)
    elif origin is not None:
        lines = _located(lines)
    return lines.select("value", *([F.col("file").alias(origin)] if origin is not None else []))


def first_rows(spark: SparkSession, addresses: Sequence[str], max_rows: int) -> DataFrame:
    """``value, file`` of the first ``max_rows`` lines of text files, in the order of their names and of the lines in them.

    Lines are counted by file and input split, in batches of files that grow until the cap is reached; files behind the cut are never
    opened. Of the file with the cut the splits before it are read whole, and only lines of the split with the cut pass through one task.
    """
    files = sorted(map(files_.plain_name, addresses))
    start, size, left = 0, 1, max_rows
    while start < len(files):
        counts = durable(split_counts(_lines(spark, files[start : start + size])), "split-counts")
        cut = running_counts(counts).filter((F.col("before") < left) & (F.col("before") + F.col("n") >= left)).first()
        if cut is not None:
            at = {name: place for place, name in enumerate(files)}.get(cut["file"])
            if at is None:
                raise LookupError(f"{cut['file']} is not among the files of the scan")
            return _up_to(spark, files[:at], cut["file"], cut["start"], left - cut["before"])
        left -= counts.agg(F.sum("n")).first()[0] or 0
        start, size = start + size, size * 4
    return _lines(spark, files).select("value", "file") if files else spark.createDataFrame([], "value string, file string")


def split_counts(lines: DataFrame) -> DataFrame:
    """``file, start, n``: the lines of each input split that has any; a split is named by its file and its first byte."""
    return lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))


def running_counts(counts: DataFrame) -> DataFrame:
    """``counts`` with ``before``, the lines of all splits before: those of earlier files, by name, and those of the file's earlier splits.

    The one window over everything has one row per file.
    """
    earlier = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("file").agg(F.sum("n").alias("held"))
    files = files.select("file", F.coalesce(F.sum("held").over(earlier(Window.orderBy("file"))), F.lit(0)).alias("files_before"))
    inside = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("file").orderBy("start"))), F.lit(0))
    return counts.withColumn("inside", inside).join(files, "file").withColumn("before", F.col("inside") + F.col("files_before")).drop("inside", "files_before")


def _up_to(spark: SparkSession, whole: Sequence[str], file: str, start: int, rows: int) -> DataFrame:
    """Whole files, the splits of one more file before ``start``, and the first ``rows`` lines of the split there."""
    lines = _lines(spark, [file])
    parts = [lines.filter(F.col("start") < start), lines.filter(F.col("start") == start).limit(rows)]
    if whole:
        parts.insert(0, _lines(spark, whole))
    return reduce(DataFrame.unionByName, parts).select("value", "file")


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines of the named files; the names are taken literally."""
    return _located(spark.read.schema(schemas.RAW_LINES).text([files_.literal_path(file) for file in files]))


def _located(lines: DataFrame) -> DataFrame:
    """Lines with the file and the split they come from, as the scan itself reports them."""
    file = files_.plain_name_of(F.col("_metadata.file_path"))
    return lines.select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("start"))


def read_result(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    """A result table under ``base``; a typed empty table if its folder is missing or holds no data."""
    try:
        return spark.read.schema(schema).parquet(result_path(base, name))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def result_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def resolve_base(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First candidate folder with a result table that holds data, else the first that exists, else the first."""
    for holds in (has_results, exists):
        for candidate in candidates:
            if holds(spark, candidate):
                return candidate
    return candidates[0]


def has_results(spark: SparkSession, base: str) -> bool:
    return exists(spark, f"{base.rstrip('/')}/*.parquet/part-*")


def has_result(spark: SparkSession, base: str, name: str) -> bool:
    """Whether the named result holds data files; a look at the folder, no job."""
    return exists(spark, f"{result_path(base, name)}/part-*")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that matches a pattern, exists on whatever file system it names."""
    return files_.exists(spark, path)


def cached(table: DataFrame) -> DataFrame:
    """Keep a table that is read repeatedly in memory, on disk where it does not fit."""
    return table.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def cached_tables(*tables: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """The tables, :func:`cached` inside the block and released when it ends, also by an error."""
    kept = []
    try:
        for table in tables:
            kept.append(cached(table))
        yield tuple(kept)
    finally:
        for table in kept:
            table.unpersist()
