"""Files and folders on whatever file system a path names."""

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL = "^file:/+"


def plain_name(address: str) -> str:
    """The path behind an address as Spark writes it; decoded once, local paths with one slash."""
    return re.sub(_LOCAL, "file:/", unquote(address))


def plain_name_of(address: Column) -> Column:
    """:func:`plain_name` of a column, such as the metadata column ``file_path``. A plus sign stands for itself in a path."""
    return F.regexp_replace(F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B"))), _LOCAL, "file:/")


def literal_path(name: str) -> str:
    """A path for Spark's readers that names exactly one file: characters of patterns lose their meaning."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", name)


def _system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path or pattern: one listing, no job."""
    system, path = _system(spark, pattern)
    return bool(system.globStatus(path))


def delete(spark: SparkSession, name: str) -> None:
    system, path = _system(spark, name)
    system.delete(path, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, path = _system(spark, old)
    if not system.rename(path, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old} to {new}")


def stored_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of all files under a path."""
    system, path = _system(spark, name)
    return system.getContentSummary(path).getLength()


def beside(path: str, what: str) -> str:
    """A hidden name in the same folder that nothing else uses."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{what}-{name}-{uuid.uuid4().hex}"


def replace(table: DataFrame, path: str) -> None:
    """Write a table as parquet in the place of what is there.

    It is written beside the old one first. If that fails the old one is untouched, and a table that is read from ``path`` may be written to it. Then
    two renames swap them, and the old one goes. Where the second rename fails the old one is put back. Readers that start between the
    two renames find nothing; a file system whose renames copy (an object store) makes that time longer.
    """
    spark, new, old = table.sparkSession, beside(path, "new"), beside(path, "old")
    try:
        table.write.parquet(new)
    except BaseException:
        delete(spark, new)
        raise
    there = exists(spark, literal_path(path))
    if there:
        rename(spark, path, old)
    try:
        rename(spark, new, path)
    except BaseException:
        if there:
            rename(spark, old, path)
        delete(spark, new)
        raise
    if there:
        delete(spark, old)
