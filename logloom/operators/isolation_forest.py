"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) fitted and applied by Spark.

Every tree sees a small sample of the rows, so fitting is one grouped task per tree whatever the size of the
table, and the finished forest has at most ``trees * (2 * sample - 1)`` nodes: small enough to hand to every
executor. The rows to be scored never leave their partitions.
"""

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions import fixed
from logloom.sources.durable import durable

# The helpers below travel with the tasks that call them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("feature", T.LongType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.LongType()),
        T.StructField("path_length", T.DoubleType()),
    ]
)


def average_path(rows: np.ndarray) -> np.ndarray:
    """Mean depth at which an unsuccessful search in a binary tree over ``rows`` rows ends."""
    rows = np.asarray(rows, dtype=float)
    many = np.maximum(rows, 3.0)
    estimate = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
    return np.where(rows > 2, estimate, np.where(rows == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, depth_limit: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Grow one tree, a whole level at a time.

    Nodes are numbered level by level and siblings are neighbours, so ``left`` alone tells both children; a leaf
    points to itself. ``path_length`` of a leaf is its depth plus the mean depth of what it left unsplit.
    """
    feature, threshold, left, path = [], [], [], []
    node_of, level_start, level_size = np.zeros(len(points), dtype=int), 0, 1
    for depth in range(depth_limit + 1):
        low = np.full((level_size, points.shape[1]), np.inf)
        high = np.full((level_size, points.shape[1]), -np.inf)
        alive = node_of >= 0
        np.minimum.at(low, node_of[alive], points[alive])
        np.maximum.at(high, node_of[alive], points[alive])
        rows = np.bincount(node_of[alive], minlength=level_size)
        splittable = (high > low) if depth < depth_limit else np.zeros_like(low, dtype=bool)
        inner = splittable.any(axis=1)
        # A uniform choice among the features that still vary: the largest of one random number each.
        chosen = np.where(splittable, rng.random(low.shape), -1.0).argmax(axis=1)
        picked = np.arange(level_size)
        span_low, span_high = low[picked, chosen], high[picked, chosen]
        cut = np.where(inner, span_low + rng.random(level_size) * np.where(inner, span_high - span_low, 0.0), np.inf)
        cut = np.where(inner & (cut >= span_high), span_low, cut)
        children = level_start + level_size + 2 * (np.cumsum(inner) - 1)
        feature.append(np.where(inner, chosen, 0))
        threshold.append(cut)
        left.append(np.where(inner, children, level_start + picked))
        path.append(np.where(inner, 0.0, depth + average_path(rows)))
        if not inner.any():
            break
        here = np.where(alive, node_of, 0)
        goes_right = points[np.arange(len(points)), chosen[here]] > cut[here]
        first_child = children[here] - (level_start + level_size)
        node_of = np.where(alive & inner[here], first_child + goes_right, -1)
        level_start, level_size = level_start + level_size, 2 * int(inner.sum())
    return {
        "feature": np.concatenate(feature),
        "threshold": np.concatenate(threshold),
        "left": np.concatenate(left),
        "path_length": np.concatenate(path),
    }


def raw_scores(points: np.ndarray, forest: dict[str, np.ndarray], depth_limit: int, sample: int) -> np.ndarray:
    """Scores in [-1, 0]; the lower, the easier a point is to isolate.

    All points go down one tree before the next: a tree's nodes then stay in the processor's cache.
    """
    values, row_start = points.ravel(), np.arange(len(points)) * points.shape[1]
    depth = np.zeros(len(points))
    for root in forest["roots"]:
        node = np.full(len(points), root)
        for _ in range(depth_limit):
            value = values.take(row_start + forest["feature"].take(node))
            node = forest["left"].take(node) + (value > forest["threshold"].take(node))
        depth += forest["path_length"].take(node)
    return -np.power(2.0, -depth / len(forest["roots"]) / float(average_path(sample)))


@dataclass(frozen=True)
class ForestModel:
    """A fitted forest: ``nodes`` holds the node arrays of all trees, one tree after the other."""

    features: tuple[str, ...]
    sample: int
    depth_limit: int
    nodes: dict[str, np.ndarray]

    def table(self, spark: SparkSession) -> DataFrame:
        """``tree_id, node, feature, threshold, left, path_length``: one row per node, numbered through all trees."""
        starts = np.sort(self.nodes["roots"])
        node = np.arange(len(self.nodes["left"]))
        tree = np.searchsorted(starts, node, side="right") - 1
        columns = {"tree_id": tree, "node": node, **{name: self.nodes[name] for name in ("feature", "threshold", "left", "path_length")}}
        return spark.createDataFrame(pa.table({name: pa.array(values) for name, values in columns.items()}))

    def score(self, rows: DataFrame, target: str = "Raw_Score") -> DataFrame:
        """Add the raw score of every row."""
        shared = rows.sparkSession.sparkContext.broadcast(self.nodes)
        depth_limit, sample = self.depth_limit, self.sample

        @F.pandas_udf(T.DoubleType())
        def forest_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(raw_scores(batch.to_numpy(dtype=float), shared.value, depth_limit, sample))

        values = F.struct(*[F.col(name).cast("double").alias(name) for name in self.features])
        return rows.withColumn(target, forest_score(values))


class LeastDraws:
    """The ``sample`` rows with the lowest draws of each tree. Those of two sets of rows give those of both, so it can be worked out in parts."""

    def __init__(self, trees: int, sample: int):
        self.sample = sample
        self.limits = np.full(trees, np.iinfo(np.int64).max)
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Table]] = []
        self.held = 0

    def add(self, rows: pa.Table, row: np.ndarray, tree: np.ndarray, draw: np.ndarray) -> None:
        """Row number ``row[i]`` of ``rows`` has ``draw[i]`` for ``tree[i]``."""
        low = draw <= self.limits[tree]
        if low.any():
            self.parts.append((tree[low], draw[low], rows.take(pa.array(row[low]))))
            self.held += int(low.sum())
        if self.held > 4 * self.sample * len(self.limits):
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        tree, draw = (np.concatenate([part[i] for part in self.parts]) for i in range(2))
        order = np.lexsort((draw, tree))
        sizes = np.bincount(tree, minlength=len(self.limits))
        place = np.arange(len(tree)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = order[place < self.sample]
        kept = tree[order], draw[order], pa.concat_tables([part[2] for part in self.parts]).take(pa.array(order))
        full = sizes >= self.sample
        last = np.cumsum(np.minimum(sizes, self.sample)) - 1
        self.limits[full] = kept[1][last[full]]
        self.parts, self.held = [kept], len(order)
        return kept


def draw_samples(
    rows: DataFrame, features: Sequence[str], key: Sequence[str], count: int, trees: int, sample: int, seed: int,
    spare: bool = True, once: bool = False,
) -> DataFrame:
    """The rows each tree is fitted on: ``sample`` rows per tree without repetition.

    With ``once`` every row is dealt to one tree, by hash, and drawn for that tree only: a row is looked at once, not once per tree. It needs a
    table of many times ``trees * sample`` rows.

    A row's draw for a tree is a hash of seed, tree and row, so a sample depends on neither order nor
    partitioning, and the ``sample`` lowest draws win. Every task keeps its own lowest draws; these are stored, so ``rows`` are read once. With ``spare``
    only draws below a limit that leaves far more candidates than needed go on from there, unless a tree would get too few.
    """
    values = [F.col(name).cast("double").alias(f"x{i}") for i, name in enumerate(features)]
    if once:
        tree = F.array(F.pmod(F.xxhash64(F.lit(seed), F.lit("tree"), *key), F.lit(trees)).cast("int"))
    else:
        tree = F.sequence(F.lit(0), F.lit(trees - 1))
    draws = F.transform("trees", lambda t: F.xxhash64(F.lit(seed), t, *key))
    names = [*key, *[f"x{i}" for i in range(len(features))]]
    asked = rows.select(*key, *values, tree.alias("trees")).withColumn("draws", draws)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = LeastDraws(trees, sample)
        for batch in batches:
            per_row = pc.list_value_length(batch["trees"]).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), per_row)
            kept.add(pa.Table.from_batches([batch.select(names)]), row, batch["trees"].flatten().to_numpy(), batch["draws"].flatten().to_numpy())
        if kept.parts:
            tree, draw, table = kept.shrink()
            yield from table.append_column("tree_id", pa.array(tree, pa.int32())).append_column("draw", pa.array(draw)).to_batches()

    schema = T.StructType([*asked.select(*names).schema.fields, T.StructField("tree_id", T.IntegerType()), T.StructField("draw", T.LongType())])
    drawn = durable(asked.mapInArrow(least, schema), "draws")
    if spare:
        candidates = sample + 12 * math.sqrt(sample) + 40
        each = count / trees if once else count
        highest = min(int(-(2**63) + min(candidates / max(each, 1), 1.0) * 2**64), 2**63 - 1)
        near = drawn.filter(F.col("draw") <= F.lit(highest))
        enough = near.groupBy("tree_id").count().filter(F.col("count") >= sample).count()  # one number
        drawn = near if enough == trees else drawn
    per_tree = Window.partitionBy("tree_id").orderBy("draw", *key)
    return drawn.withColumn("place", F.row_number().over(per_tree)).filter(F.col("place") <= sample)


def fit_forest(
    rows: DataFrame,
    features: Sequence[str] = fixed.FEATURES,
    key: Sequence[str] = ("Hour_Window",),
    trees: int = fixed.FOREST_TREES,
    sample: int = fixed.FOREST_SAMPLE,
    seed: int = fixed.FOREST_SEED,
    count: int | None = None,
    once: bool = False,
) -> ForestModel:
    """Fit on ``rows``; ``key`` identifies a row, which is checked among the sampled ones. Needs two rows or more; ``count`` is their number if known.

    ``once`` lets trees draw from disjoint parts of the table, for tables of many times ``trees * sample`` rows; see :func:`draw_samples`.
    """
    count = rows.count() if count is None else count
    if count < 2:
        raise ValueError("an isolation forest needs two rows or more")
    sample = min(sample, count)
    depth_limit = math.ceil(math.log2(max(sample, 2)))
    width = len(features)

    def grow(drawn: pa.Table) -> pa.Table:
        drawn = drawn.sort_by("place")
        if drawn.select(list(key)).group_by(list(key)).aggregate([]).num_rows < drawn.num_rows:
            raise ValueError(f"{list(key)} does not tell rows apart")
        points = np.column_stack([drawn[f"x{i}"].to_numpy() for i in range(width)])
        tree_id = drawn["tree_id"][0].as_py()
        tree = grow_tree(points, depth_limit, np.random.default_rng([seed, tree_id]))
        nodes = len(tree["left"])
        fixed_part = {"tree_id": [tree_id] * nodes, "rows": [len(points)] * nodes, "node": np.arange(nodes)}
        return pa.table({name: pa.array(values) for name, values in {**fixed_part, **tree}.items()})

    samples = draw_samples(rows, features, key, count, trees, sample, seed, True, once)
    # The samples are small enough for Spark to put them all into one task; trees should grow side by side.
    tasks = min(trees, rows.sparkSession.sparkContext.defaultParallelism)
    grown = samples.repartition(tasks, "tree_id").groupBy("tree_id").applyInArrow(grow, NODE_SCHEMA)
    # At most trees * (2 * sample - 1) rows, whatever the size of the table.
    forest = grown.toArrow().sort_by([("tree_id", "ascending"), ("node", "ascending")])
    roots = np.flatnonzero(forest["node"].to_numpy() == 0)
    nodes = {name: forest[name].to_numpy() for name in ("feature", "threshold", "left", "path_length")}
    # Children are numbered within their tree; in the joined arrays they move with its root.
    nodes["left"] = nodes["left"] + roots[forest["tree_id"].to_numpy()]
    nodes["roots"] = roots
    return ForestModel(tuple(features), sample, depth_limit, nodes)
