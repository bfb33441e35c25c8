"""Mixing sources to target weights by capped water-filling.

Every source gets a share of all words in proportion to its weight, at most ``max_epochs`` times its own size; what is above is
shared again among the others by weight until none is above. The water level is found from prefix sums over the table of sources, one row each.

A source whose target is e times its size gives every document ``floor(e)`` times. For the fraction, documents are ordered by a
seeded hash and taken once more up to the word where the target is met, to the nearest document. The cut is found in two
steps, so that no task sees a whole source: sizes of 4,096 hash ranges per source, then the documents of the one range with the cut.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; sources without words get target 0. Rows
equal in id and text are taken or left together. Other columns are not looked at. An empty table gives an empty result.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.text import raw_texts, returning_memory, slices
from logloom.sources.durable import durable

WEIGHTS, MAX_EPOCHS, SEED = (5.0, 2.0, 1.0), 3.0, 42
#: Hashes are the first 60 bits of MD5, which any engine can repeat; ranges are the first 12 of them.
HASH_BITS, RANGE_BITS = 60, 12


def pick() -> F.Column:
    """The seeded place of a document among those of its source."""
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, pick, size`` for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = pa.array([len(text.split()) for text in raw_texts(batch["text"])], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["source"], batch["pick"], counts], names=["doc_id", "source", "pick", "size"])

    return docs.select("doc_id", "source", "text", pick().alias("pick")).mapInArrow(returning_memory(run), "doc_id bigint, source string, pick bigint, size bigint")


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` for the sources of ``rows`` (``source``, ``size``).

    ``weights`` repeat over the sources in code-point order. Windows run over one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    source = source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_epochs))
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = fullest.rowsBetween(Window.unboundedPreceding, -1), fullest.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    source = source.withColumn("full", F.col("cap") / F.col("weight") <= left / F.sum("weight").over(onward)).withColumn("total", total)
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    level = F.try_divide(rest, F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything))
    return source.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``whole`` repetitions and ``cut``: documents with a smaller hash are taken once more."""
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(epochs)).withColumn("more", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    part = F.shiftright("pick", HASH_BITS - RANGE_BITS)
    ranges = rows.groupBy("source", part.alias("part")).agg(F.sum("size").alias("held"))
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("below", F.coalesce(F.sum("held").over(running), F.lit(0)))
    same = F.col("r.source").eqNullSafe(F.col("p.source"))
    crossed = ranges.alias("r").join(plan.alias("p"), same).filter("below < more and more <= below + held").select("r.source", "part", "below", "more")
    inside = (
        rows.withColumn("part", part).alias("r").join(crossed.alias("p"), same & (F.col("r.part") == F.col("p.part")))
        .groupBy("r.source", "r.part", "p.below", "p.more", "pick").agg(F.sum("size").alias("size"))
    )
    up_to = Window.partitionBy("source").orderBy("pick").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("below") + F.coalesce(F.sum("size").over(up_to), F.lit(0)) + F.col("size") / 2
    last = inside.withColumn("reached", reached).groupBy("source", "part").agg(F.max(F.when(F.col("reached") <= F.col("more"), F.col("pick"))).alias("last"))
    cut = F.coalesce(F.col("last") + 1, F.call_function("shiftleft", F.col("part"), F.lit(HASH_BITS - RANGE_BITS)))
    found = last.select(F.col("source").alias("cut_source"), cut.alias("cut"))
    return plan.join(found, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0).cast("bigint")).alias("cut")
    )


def plan_of(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    return durable(cuts(rows, durable(targets(rows, weights, max_epochs), "targets")), "cuts")


def repeats() -> F.Column:
    return F.col("whole") + (F.col("pick") < F.col("cut")).cast("bigint")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Contract of the operator: ``doc_id, size, source_size, target, taken`` for every row."""
    rows = durable(sizes(docs), "sizes")
    plan = plan_of(rows, weights, max_epochs)
    joined = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * repeats()).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken."""
    plan = plan_of(durable(sizes(docs), "sizes"), weights, max_epochs).withColumnRenamed("source", "plan_source")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("source"), pick().alias("pick"))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.select("row", F.explode(F.expr("array_repeat(0, cast(whole + if(pick < cut, 1, 0) as int))"))).select("row.*")
