"""Word counts by language, pre-aggregated inside each task before anything is shuffled."""

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.text import slices

#: Distinct words a task holds before it hands its counts on.
HELD = 100_000
COUNTS = "lang string, word string, n bigint"


def partial_counts(docs: DataFrame, split: Callable[[str], list[str]]) -> DataFrame:
    """Rows ``lang, word, n``; a word may come several times per language, once for each time a task handed over.

    ``docs`` has ``text`` and ``lang``. A null text has no words, a null language is one of its own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}
        for batch in slices(batches):
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                if text:
                    held.setdefault(lang, Counter()).update(split(text))
            if sum(map(len, held.values())) >= HELD:
                yield from handed(held)
                held.clear()
        yield from handed(held)

    def handed(held: dict[str | None, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            names = list(counter)
            for start in range(0, len(names), 50_000):
                part = names[start : start + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array(part, pa.string()),
                        pa.array([counter[w] for w in part], pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    return docs.select("text", "lang").mapInArrow(count, COUNTS)


def word_counts(docs: DataFrame, split: Callable[[str], list[str]]) -> DataFrame:
    """One row per language and word with its count over all texts."""
    return partial_counts(docs, split).groupBy("lang", "word").agg(F.sum("n").alias("n"))
