"""SimHash near-dedup: 64-bit fingerprints compared exactly, tile by tile.

Distinct fingerprints are dealt into tiles by the number of their set bits. Two fingerprints that differ in at most
``radius`` bits have population counts that differ by at most ``radius``, so tile pairs farther apart are skipped; the others are
compared by exclusive-or and bit counts in numpy. All pairs within the radius are found. The work grows with the square of the number of
*distinct* fingerprints, divided by the share of tile pairs skipped; copies cost nothing.

Inside a tile pair links are reduced to a star per group at once, so a large group of near copies yields as many links
as it has members, not as many as it has pairs.

Defined cases: a null or blank text has fingerprint 0 and is linked like any other. Null ids are never a component's id unless all
of its ids are null. Repeated rows each get a row. Other columns are not looked at. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import components
from logloom.llm.text import raw_texts, returning_memory, slices, small_table
from logloom.sources.durable import durable

RADIUS, WORDS, SEED = 4, 4, 42
TILE = 8192


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """Bit-wise majority of the hashes of all shingles; ``bytes.lower`` changes A-Z only."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - size + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashed = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :].tolist())]
    return majority(np.array(hashed, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096].astype(">u8").view(np.uint8)
        counts += np.unpackbits(part).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """``doc_id, h1, h2, fp`` for every row of ``docs``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(text, size) for text in raw_texts(batch["text"])], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["h1"], batch["h2"], pa.array(found.view(np.int64))], names=["doc_id", "h1", "h2", "fp"]
            )

    keyed = docs.select("doc_id", "text", F.xxhash64("text", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    return keyed.mapInArrow(returning_memory(run), "doc_id bigint, h1 bigint, h2 bigint, fp bigint")


def near_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``fp``) that connect what is within ``radius`` bits."""
    counted = distinct.select("fp", F.bit_count("fp").alias("ones"))
    sizes = {row["ones"]: row["count"] for row in counted.groupBy("ones").count().collect()}  # 65 rows at most
    dealt = {ones: -(-n // tile) for ones, n in sizes.items()}
    spark = distinct.sparkSession
    plan = small_table(spark, sorted(dealt.items()), {"ones": pa.int32(), "parts": pa.int32()})
    tiles = (
        counted.join(F.broadcast(plan), "ones")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("ones", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = durable(tiles, "tiles")
    # Every tile travels to each tile that it must be compared with; a pair of tiles meets once.
    near = [(p, q, parts) for p in dealt for q, parts in dealt.items() if 0 <= q - p <= radius]
    reach = small_table(spark, near, {"ones": pa.int32(), "with_ones": pa.int32(), "with_parts": pa.int32()})
    left = (
        tiles.join(F.broadcast(reach), "ones")
        .withColumn("with_part", F.explode(F.expr("sequence(if(ones = with_ones, part, 0), with_parts - 1)")))
        .select(F.col("ones").alias("own_ones"), F.col("part").alias("own_part"), F.col("fps").alias("own"), F.col("with_ones").alias("ones"), F.col("with_part").alias("part"))
    )
    pairs = left.join(tiles, ["ones", "part"]).select(
        "own", F.col("fps").alias("other"), ((F.col("ones") == F.col("own_ones")) & (F.col("part") == F.col("own_part"))).alias("same")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for own, other, same in zip(batch["own"], batch["other"], batch["same"].to_pylist()):
                a, b = tile_links(_unsigned(own), _unsigned(other), same, radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return pairs.mapInArrow(returning_memory(run), "a bigint, b bigint")


def _unsigned(value: pa.ListScalar) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False).view(np.uint64)


def tile_links(own: np.ndarray, other: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links of the groups that fingerprints of two tiles form."""
    nodes = own if same else np.concatenate([own, other])
    group = np.arange(len(nodes))
    shift = 0 if same else len(own)
    for i, one in enumerate(own):
        start = i + 1 if same else 0
        hits = np.flatnonzero(np.bitwise_count(other[start:] ^ one) <= radius)
        if len(hits):
            met = np.unique(np.append(group[hits + start + shift], group[i]))
            if len(met) > 1:
                group[np.isin(group, met)] = met[0]
    tied = group != np.arange(len(nodes))
    return nodes[tied], nodes[group[tied]]


def near_groups(docs: DataFrame, radius: int = RADIUS, size: int = WORDS) -> DataFrame:
    """``doc_id, h1, h2, fp, label, component_id`` for every row; ``label`` names the group even where ids are null."""
    rows = durable(fingerprints(docs, size), "fingerprints")
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = components(near_links(distinct, radius))
    labelled = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("label")
    )
    labelled = durable(labelled, "labels")
    ids = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return rows.join(labelled.select("fp", "label").join(ids, "label"), "fp")


def near_dedup(docs: DataFrame, radius: int = RADIUS, size: int = WORDS) -> DataFrame:
    """Contract of the operator: ``doc_id``, ``fingerprint`` in hexadecimal, ``component_id``."""
    return near_groups(docs, radius, size).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def winners(groups: DataFrame) -> DataFrame:
    """``key`` of the row that stays in each group: smallest id, null last, then smallest text hash."""
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h1", "h2")
    first = groups.groupBy("label").agg(F.min(order).alias("w"))
    return first.select(F.struct(F.col("w.doc_id").alias("id"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2")).alias("key"))
