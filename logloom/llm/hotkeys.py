"""Joins with a table of unique keys, some of which may belong to a large part of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it belongs to over one in so many rows.
HOT = 1000


def looked_up(rows: DataFrame, by: str, table: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """``rows`` joined with ``table`` (unique ``key``) on the column ``by``, whatever number of rows shares a key.

    ``counts`` has ``key, n``, the number of rows by key. Keys with over ``1 / hot`` of all rows, fewer than ``hot``, are joined by a
    broadcast, the others by a shuffle.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = counts.filter(F.col("n") * hot > total).select("key")
    much = F.broadcast(many.join(table, "key").withColumnRenamed("key", "_key"))
    few = table.join(F.broadcast(many), "key", "left_anti").withColumnRenamed("key", "_key")
    marked = rows.join(F.broadcast(many.select(F.col("key").alias("_hot"))), F.col(by) == F.col("_hot"), "left")
    one = marked.filter("_hot is not null").join(much, F.col(by) == F.col("_key"))
    other = marked.filter("_hot is null").join(few, F.col(by) == F.col("_key"))
    return one.unionByName(other).drop("_hot", "_key")
