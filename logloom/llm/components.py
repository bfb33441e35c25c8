"""Connected components of a graph that no single machine holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.sources.durable import durable

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``, two different ids): component is its smallest node.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its smallest one, then every
    node and its smaller neighbours are tied to the smallest of them. The number of edges never grows and rounds grow as
    the logarithm of the longest chain. Each round is a stored table, so a lost executor costs one round at most.
    """
    given = durable(edges.select("a", "b").filter("a != b"), "links")  # read more than once below
    now = durable(_smaller(given), "edges")
    before = _mark(now)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        now = durable(_smaller(_larger(now)), "edges")
        mark = _mark(now)
        if mark == before:
            break
        before = mark
    else:
        raise ArithmeticError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """Edges ``a > b`` so that each ``a`` points to the smallest of its smaller neighbours."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    ties = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
