"""Sums of word values over documents, whatever the number of distinct words.

The values of the most frequent words, at most ``HELD_WORDS``, are broadcast and summed in the task that reads the text. All
other words of a document are joined to the table of values. Which words are held changes the way, never the
result: values are whole numbers, in units of ``1 / SCALE``, so sums do not depend on their order.
"""

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.text import slices
from logloom.sources.durable import durable

SCALE = 1_000_000_000
HELD_WORDS = 1 << 17


def whole(value: Column) -> Column:
    """A value in whole units."""
    return F.round(value * SCALE).cast("bigint")


def frequent(values: DataFrame, width: int, most: int) -> Broadcast:
    """By language the row of each held word, and the matrix of their values."""
    # Half powers of two: some tens of rows.
    bucket = F.floor(2 * F.log2("n"))
    sizes = sorted(((r["bucket"], r["count"]) for r in values.groupBy(bucket.alias("bucket")).count().collect()), reverse=True)
    least, taken = None, 0
    for place, size in sizes:
        if (taken := taken + size) > most:
            break
        least = place
    rows: dict[str | None, dict[str, int]] = {}
    matrix = np.zeros((0, width), np.int64)
    if least is not None:
        found = values.filter(bucket >= least).select("lang", "word", *[f"s{i}" for i in range(width)]).toArrow()
        for row, (lang, word) in enumerate(zip(found["lang"].to_pylist(), found["word"].to_pylist())):
            rows.setdefault(lang, {})[word] = row
        matrix = np.column_stack([np.zeros((found.num_rows, 0), np.int64), *[found[f"s{i}"].to_numpy() for i in range(width)]])
    return values.sparkSession.sparkContext.broadcast((rows, matrix))


def sums(docs: DataFrame, values: DataFrame, width: int, describe: Callable[[str], tuple[Counter, tuple]], figures: str, most: int = HELD_WORDS) -> DataFrame:
    """The columns of ``docs`` but ``text``, the ``figures`` that ``describe`` gives beside the words, and ``s0`` to the width.

    ``docs`` has ``text`` and ``lang``; ``values`` has ``lang, word, n, s0 ...``, one row per language and word. A word without a
    row counts nothing.
    """
    shared = frequent(values, width, most)
    carried = [c for c in docs.columns if c != "text"]
    made = [f.split() for f in figures.split(", ")]
    held = [f"s{i}" for i in range(width)]
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(
        ["row_id bigint", *[f"{c} {types[c]}" for c in carried], figures, *[f"{s} bigint" for s in held], "rest array<struct<word:string,n:bigint>>"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, matrix = shared.value
        row_id = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            told, totals, words, times, ends = [], [], [], [], [0]
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                counted, figure = describe(text or "")
                have = rows.get(lang, {})
                at, often = [], []
                for word, n in counted.items():
                    row = have.get(word)
                    if row is None:
                        words.append(word)
                        times.append(n)
                    else:
                        at.append(row)
                        often.append(n)
                told.append(figure)
                totals.append(np.array(often, np.int64) @ matrix[at] if at else np.zeros(width, np.int64))
                ends.append(len(words))
            if not told:
                continue
            ids = pa.array(np.arange(row_id, row_id + len(told)))
            row_id += len(told)
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], ["word", "n"]))
            yield pa.RecordBatch.from_arrays(
                [ids, *[batch[c] for c in carried], *[pa.array(column) for column in zip(*told)], *[pa.array(column) for column in np.array(totals).T.copy()], rest],
                names=["row_id", *carried, *[name for name, _ in made], *held, "rest"],
            )

    stored = durable(docs.mapInArrow(run, schema), "sums")
    rest = stored.select("row_id", F.col("lang").alias("lang_of"), F.explode("rest").alias("x")).select("row_id", "lang_of", F.col("x.word").alias("word_of"), F.col("x.n").alias("times"))
    met = rest.join(values, F.col("lang_of").eqNullSafe(F.col("lang")) & (F.col("word_of") == F.col("word")))
    names = [*carried, *[name for name, _ in made]]
    if not width:
        return stored.select(names)
    more = met.groupBy("row_id").agg(*[F.sum(F.col("times") * F.col(s)).alias(f"more_{s}") for s in held])
    return stored.drop("rest").join(more, "row_id", "left").select(*names, *[(F.col(s) + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in held])
