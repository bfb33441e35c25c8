"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard bids for a key: a hash of key and shard number gives ``u`` between 0 and 1, the bid is ``-ln(u) / weight`` and the lowest wins, the smaller
shard number among equals. A shard gets keys in proportion to its weight. A bid knows nothing of the other shards, so a new shard takes keys
only into itself, and a shard that goes gives up only its own. Finding the shard is a projection: no shuffle, no state.

Hashes are the first 52 bits of MD5, which any engine can repeat. ``slot`` numbers the rows of a shard (see :mod:`logloom.llm.numbering`) in the
order of a second hash, so that it is independent of files and tasks.

Defined cases: a null key is a key of its own, a null text is empty. Rows with equal keys share a shard; a key that holds many rows makes
its shard that much larger, which is the law, but never one task. Repeated rows get a slot each. Weights are positive. Other columns are not
looked at, whatever their names. An empty table gives an empty result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.numbering import numbered
from logloom.sources.durable import durable

SHARDS = 16
HASH_DIGITS = 13
SLICES = 64


def hashed(value: Column) -> Column:
    """The first 52 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")


def key_text(key: str | Column) -> Column:
    return F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("null"))


def shard_of(key: str | Column, weights: Sequence[float]) -> Column:
    """The shard that wins the key; ``weights`` has one number per shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    bids = []
    for shard, weight in enumerate(weights):
        u = (hashed(F.concat(key_text(key), F.lit(f":{shard}"))) + F.lit(0.5)) / F.lit(float(1 << 4 * HASH_DIGITS))
        bids.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*bids))["shard"] if len(bids) > 1 else F.lit(0)


def assign(records: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """``row, shard``: every record whole, and its shard."""
    return records.select(F.struct(*[records[c] for c in records.columns]).alias("row"), shard_of(records[key], weights).alias("shard"))


def write_shards(records: DataFrame, path: str, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS, slices: int = SLICES) -> None:
    """The records as parquet with one folder ``shard=<number>`` per shard; the name gets underscores until no column has it.

    Records are dealt by shard and a hash of their content, so a shard is at most ``slices`` files and one repeated key is not one task.
    """
    name = "shard"
    while name.lower() in [c.lower() for c in records.columns]:
        name += "_"
    dealt = assign(records, key, weights).withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)))
    dealt.repartition("shard", "slice").select(F.col("shard").alias(name), "row.*").write.partitionBy(name).parquet(path)


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Contract of the operator: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row, all shards of weight 1."""
    content = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(docs["doc_id"].alias("doc_id"), (F.length(content) + 1).cast("bigint").alias("size"), F.crc32(content).alias("text_crc32"))
    rows = rows.withColumn("shard", shard_of("doc_id", [1.0] * shards)).withColumn("grown_shard", shard_of("doc_id", [1.0] * (shards + 1)))
    rows = rows.withColumn("spread", hashed(F.concat_ws(":", key_text("doc_id"), F.col("text_crc32").cast("string"))))
    order = [F.col("spread"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    # Stored, since dealing by ranges reads the rows twice; they have no text.
    return numbered(durable(rows, "shards"), ["shard"], order, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
