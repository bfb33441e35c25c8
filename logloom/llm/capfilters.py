"""Embedding near-dedup by spherical-cap filters.

The unit sphere is covered with caps around structured directions: a vector's coordinates are cut into blocks, each block has a few random
unit directions, and a filter is one direction per block, so that ``codes ** blocks`` filters cost ``codes * blocks`` products. A vector is stored under the filter
with its highest score. It asks under every filter whose score is within ``reach`` of its own highest; these are decoded from the short lists of
its best directions per block. Vectors meet on filters, and the cosine of every meeting is computed in double precision.

The number of directions follows from the data (:func:`codes_for`): with c of them in each of two blocks a vector asks about ``2.4 c`` filters (measured at 64
dimensions), which is what is moved, and meets ``2.2 / c`` of all classes of its label, which is what is computed. Both stay in balance if c grows with the square
root of the number of classes of the largest label.

``reach`` is ``DEVIATIONS`` standard deviations of how far the score of one filter, relative to another, can drift between two vectors at the threshold. A pair
is missed only if it drifts farther than that in both directions; recall against brute force is measured in the tests.

Equal vectors of a label are one class. Under each filter, classes that are stored and classes that ask are dealt into tiles of bounded
size; tiles are compared as matrices and yield per class the number of its links and a star of links per group, never a list of pairs. A pair
that meets in both directions counts where the smaller class asks.

Defined cases: vectors that are null, zero, or hold a null or non-finite component, and vectors without label, link with nothing and are components of
their own; so do vectors of different lengths. Null ids are no component's id unless all of its ids are null. Repeated rows are linked. Other
columns are not looked at. An empty table gives an empty result.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import components
from logloom.sources.durable import durable

COSINE, BLOCKS, CODES, DEVIATIONS, SEED = 0.98, 2, 16, 4.5, 42
TILE = 512
LEAST_CODES, CLASSES_PER_CODE = 8, 256


def codes_for(classes: int) -> int:
    """Directions per block for the number of classes of the largest label: 8 up to 16,384, 16 at 65,536, 63 at a million, 1,977 at a billion."""
    return max(LEAST_CODES, math.ceil(math.sqrt(classes / CLASSES_PER_CODE)))


def directions(dim: int, blocks: int = BLOCKS, codes: int = CODES, seed: int = SEED) -> list[tuple[slice, np.ndarray]]:
    """Per block its coordinates and its unit directions, the same everywhere for the same arguments."""
    blocks = max(1, min(blocks, dim))
    edges = np.linspace(0, dim, blocks + 1).astype(int)
    draw = np.random.default_rng([seed, dim])
    out = []
    for low, high in zip(edges[:-1], edges[1:]):
        code = draw.standard_normal((codes, high - low))
        out.append((slice(int(low), int(high)), code / np.linalg.norm(code, axis=1, keepdims=True)))
    return out


def reach_of(dim: int, cosine: float = COSINE, blocks: int = BLOCKS, deviations: float = DEVIATIONS) -> float:
    """Two vectors at the threshold are ``sqrt(2 - 2 cosine)`` apart, spread over ``dim`` directions; two filters differ by at most ``sqrt(2 blocks)`` on average."""
    return deviations * np.sqrt((2 - 2 * cosine) * 2 * min(blocks, dim) / dim)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def shortfalls(units: np.ndarray, parts: list[tuple[slice, np.ndarray]]) -> list[np.ndarray]:
    """Per block, how far each direction's score is below the best one."""
    out = []
    for place, code in parts:
        scores = units[:, place] @ code.T
        out.append(scores.max(axis=1, keepdims=True) - scores)
    return out


def decode(units: np.ndarray, parts: list[tuple[slice, np.ndarray]], reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filter stored under for each vector, and (vector, filter) for all filters asked."""
    lacks = shortfalls(units, parts)
    codes = parts[0][1].shape[0]
    home = reduce(lambda whole, lack: whole * codes + lack.argmin(axis=1), lacks, np.zeros(len(units), np.int64))
    who, total, name = np.arange(len(units)), np.zeros(len(units)), np.zeros(len(units), np.int64)
    for lack in lacks:  # extends only what is still within reach
        row, code = np.nonzero(total[:, None] + lack[who] <= reach)
        total, name, who = total[row] + lack[who[row], code], name[row] * codes + code, who[row]
    return home, who, name


def classes_of(vectors: DataFrame) -> DataFrame:
    """``cls, label, embedding, times``: distinct usable vectors per label. ``cls`` hashes both."""
    return vectors.groupBy("cls", "label").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least"))


def usable() -> F.Column:
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def meetings(classes: DataFrame, cosine: float, blocks: int, codes: int, deviations: float) -> DataFrame:
    """``cls, label, dim, filter, asks``: one row where a class is stored and one for each filter that it asks under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["dim"].to_numpy()
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                units = unit(_matrix(part["embedding"], dim))
                home, who, name = decode(units, directions(dim, blocks, codes), reach_of(dim, cosine, blocks, deviations))
                rows = np.concatenate([np.arange(part.num_rows), who])
                asks = np.arange(len(rows)) >= part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part["cls"].take(pa.array(rows)), part["label"].take(pa.array(rows)), part["dim"].take(pa.array(rows)), pa.array(np.concatenate([home, name])), pa.array(asks)],
                    names=["cls", "label", "dim", "filter", "asks"],
                )

    rows = classes.select("cls", "label", F.size("embedding").alias("dim"), "embedding")
    return rows.mapInArrow(run, f"cls bigint, label {rows.schema['label'].dataType.simpleString()}, dim int, filter bigint, asks boolean")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def compare(asking: tuple, stored: tuple, dim: int, cosine: float, blocks: int, codes: int, reach: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Links of the classes of two tiles under one filter: number of linked vectors per class, and star links."""
    (a_cls, a_units, a_times), (b_cls, b_units, b_times) = asking, stored
    hits = a_units @ b_units.T >= cosine
    row, column = np.nonzero(hits & (a_cls[:, None] != b_cls[None, :]))
    if not len(row):
        return {}, []
    # The pair also meets where b asks for a's filter: then it counts only where the smaller class asks.
    parts = directions(dim, blocks, codes)
    homes = [lack.argmin(axis=1) for lack in shortfalls(a_units, parts)]
    back = sum(lack[column, home[row]] for lack, home in zip(shortfalls(b_units, parts), homes)) <= reach
    counts = ~back | (a_cls[row] < b_cls[column])
    row, column = row[counts], column[counts]
    links: dict[int, int] = {}
    for own, other, times in ((a_cls[row], b_cls[column], b_times[column]), (b_cls[column], a_cls[row], a_times[row])):
        names, at = np.unique(own, return_inverse=True)
        for name, n in zip(names.tolist(), np.bincount(at, weights=times).astype(np.int64).tolist()):
            links[name] = links.get(name, 0) + n
    return links, _stars(a_cls[row], b_cls[column])


def _stars(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """At most one link per class, to the smallest class of its group."""
    names, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = both[: len(a)], both[len(a) :]
    group = np.arange(len(names))
    while True:
        least = np.minimum(group[a], group[b])
        new = group.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == group).all():
            break
        group = new
    tied = np.flatnonzero(group != np.arange(len(names)))
    return list(zip(names[tied].tolist(), names[group[tied]].tolist()))


def links(classes: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, codes: int = CODES, deviations: float = DEVIATIONS, tile: int = TILE) -> DataFrame:
    """``cls, other, n``: with ``other`` null, n vectors linked to a class; otherwise a link of a star."""
    met = durable(meetings(classes, cosine, blocks, codes, deviations), "meetings")
    place = ["label", "dim", "filter"]
    sizes = met.groupBy(*place).agg(F.sum(F.when(F.col("asks"), 0).otherwise(1)).alias("held"), F.sum(F.when(F.col("asks"), 1).otherwise(0)).alias("asking"))
    sizes = sizes.filter("held > 0 and asking > 0").select(*place, F.ceil(F.col("held") / tile).alias("parts"), F.ceil(F.col("asking") / tile).alias("rounds"))
    dealt = met.join(sizes, place).withColumn("own", F.pmod(F.xxhash64("cls"), F.when(F.col("asks"), F.col("rounds")).otherwise(F.col("parts"))))
    full = dealt.join(classes.select("cls", "embedding", "times"), "cls")
    packed = full.groupBy(*place, "asks", "own", "parts", "rounds").agg(F.collect_list(F.struct("cls", "times", "embedding")).alias("rows"))
    packed = durable(packed, "tiles")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    ask = packed.filter("asks").select(*place, F.col("own").alias("round"), up_to("parts").alias("part"), F.col("rows").alias("asking"))
    hold = packed.filter("not asks").select(*place, F.col("own").alias("part"), up_to("rounds").alias("round"), F.col("rows").alias("stored"))
    pairs = ask.join(hold, [*place, "part", "round"]).select("dim", "asking", "stored")

    def rows_of(value: pa.ListScalar, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = value.values
        return rows.field("cls").to_numpy(), unit(_matrix(rows.field("embedding"), dim)), rows.field("times").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: list[tuple[int, int | None, int]] = []
            for dim, asking, stored in zip(batch["dim"].to_pylist(), batch["asking"], batch["stored"]):
                found, stars = compare(rows_of(asking, dim), rows_of(stored, dim), dim, cosine, blocks, codes, reach_of(dim, cosine, blocks, deviations))
                counted += [(c, None, n) for c, n in found.items()] + [(a, b, 0) for a, b in stars]
            columns = list(zip(*counted)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cls", "other", "n"])

    return pairs.mapInArrow(run, "cls bigint, other bigint, n bigint")


def near_dedup(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, codes: int | None = None, deviations: float = DEVIATIONS) -> DataFrame:
    """Contract of the operator: ``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding, label``).

    Without ``codes`` their number follows from the classes.
    """
    cls = F.when(usable(), F.xxhash64("label", "embedding"))
    rows = vectors.select("vec_id", "label", "embedding").withColumn("cls", cls)
    classes = durable(classes_of(rows.filter("cls is not null")), "classes")
    if codes is None:
        largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0  # one number
        codes = codes_for(largest)
    found = durable(links(classes, cosine, blocks, codes, deviations), "links")
    counts = found.filter("other is null").groupBy("cls").agg(F.sum("n").alias("links"))
    groups = components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "cls")
    table = classes.select("cls", "times", "least").join(groups, "cls", "left").join(counts, "cls", "left")
    table = durable(table.withColumn("component", F.coalesce("component", "cls")), "components")
    names = table.groupBy("component").agg(F.min("least").alias("component_id"))
    table = table.join(names, "component").select("cls", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "cls").join(table, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
