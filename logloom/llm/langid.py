"""Language identification, words first.

A word of the model counts with the logarithm of its frequency in each language. An unseen word is spelled: the longest character
n-grams of ``^word$`` that the model knows count with their mean log frequency, from ``ORDER`` characters down to one. The language with the highest sum
wins, the first by code point among equals; the score is its share after exponentiation.

Every counted word and n-gram of the labelled texts stays, in tables that are joined to the distinct words of all texts; the words'
values are then summed by text (see :mod:`logloom.llm.wordsums`). What a language lacks counts half of the rarest item in any.

Defined cases: a text that is null or has no letter is ``und`` with score 0. Without any labelled text everything is ``und``. Texts of
unknown language are not learned from. Rows are independent; other columns are not looked at; an empty table gives an empty result.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.text import slices
from logloom.llm.words import word_counts
from logloom.llm.wordsums import HELD_WORDS, SCALE, sums, whole
from logloom.sources.durable import discard, durable

ORDER, BUDGET = 4, 1 << 18
UNKNOWN = "und"
CACHED_WORDS = 100_000
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    words = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [w for w in ("".join(filter(str.isalpha, word)) for word in words) if w]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: remainder 2 of the checksum of the id as text. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spelled(word: str, length: int) -> list[str]:
    framed = f"^{word}$" if length > 1 else word
    return [framed[i : i + length] for i in range(len(framed) - length + 1)]


@dataclass
class Model:
    """``tables[0]`` holds words, ``tables[k]`` n-grams of k characters: text to row of the matrix of log frequencies."""

    langs: list[str]
    tables: list[dict[str, int]]
    logs: list[np.ndarray]

    def unseen(self, word: str) -> np.ndarray:
        for length in range(len(self.tables) - 1, 0, -1):
            table = self.tables[length]
            rows = [table[g] for g in spelled(word, length) if g in table]
            if rows:
                return self.logs[length][rows].mean(0)
        return np.zeros(len(self.langs))

    def predict(self, words: list[str], cache: dict[str, np.ndarray]) -> tuple[str, float]:
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        rows, times = [], []
        table = self.tables[0]
        for word, n in Counter(words).items():
            row = table.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
            else:
                found = cache.get(word)
                if found is None:
                    found = cache[word] = self.unseen(word)
                total += n * found
        if rows:
            total += np.array(times, float) @ self.logs[0][rows]
        best = int(total.argmax())
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def spelled_words(words: DataFrame, order: int = ORDER) -> DataFrame:
    """The rows of ``words`` with ``k`` and ``piece``, once for each n-gram of each length."""
    framed = F.when(F.col("k") == 1, F.col("word")).otherwise(F.concat(F.lit("^"), F.col("word"), F.lit("$")))
    places = F.expr("sequence(1, length(framed) - k + 1)")
    spelt = words.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(order)))).withColumn("framed", framed)
    spelt = spelt.filter("length(framed) >= k").withColumn("at", F.explode(places))
    return spelt.withColumn("piece", F.expr("substring(framed, at, k)")).drop("framed", "at")


def spelled_as(words: DataFrame, length: int) -> DataFrame:
    """The rows of ``words`` with ``piece``, once for each n-gram of one length."""
    framed = F.concat(F.lit("^"), F.col("word"), F.lit("$")) if length > 1 else F.col("word")
    spelt = words.withColumn("framed", framed).filter(F.length("framed") >= length)
    spelt = spelt.withColumn("at", F.explode(F.expr(f"sequence(1, length(framed) - {length - 1})")))
    return spelt.withColumn("piece", F.expr(f"substring(framed, at, {length})")).drop("framed", "at")


def learned_grams(words: DataFrame, order: int = ORDER) -> DataFrame:
    return spelled_words(words, order).groupBy("lang", "k", F.col("piece").alias("item")).agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, order: int = ORDER, budget: int = BUDGET) -> Model:
    """The model of all rows of ``labelled`` (``text``, ``lang``) whose language is known, to be held in one place.

    A word or n-gram stays if it makes up at least ``languages / budget`` of its words or n-grams. No query uses it: they
    take :func:`word_values`, which drops nothing.
    """
    words = durable(word_counts(labelled.filter("lang is not null"), letter_words), "words")
    levels = [words.select("lang", F.lit(0).alias("k"), F.col("word").alias("item"), "n")]
    grams = learned_grams(words, order)
    table = durable(levels[0].unionByName(grams), "items")
    totals = {(r["lang"], r["k"]): r["n"] for r in table.groupBy("lang", "k").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for lang, _ in totals})
    if not langs:
        return Model([], [{} for _ in range(order + 1)], [np.zeros((0, 0))] * (order + 1))
    least = docs_least(table.sparkSession, totals, len(langs) / budget)
    kept = table.join(F.broadcast(least), ["lang", "k"]).filter("n >= least").select("lang", "k", "item", "n").toArrow().to_pydict()
    tables: list[dict[str, int]] = [{} for _ in range(order + 1)]
    entries: list[list[tuple[int, int, float]]] = [[] for _ in range(order + 1)]
    for lang, k, item, n in zip(kept["lang"], kept["k"], kept["item"], kept["n"]):
        row = tables[k].setdefault(item, len(tables[k]))
        entries[k].append((row, langs.index(lang), math.log(n / totals[lang, k])))
    floor = math.log(len(langs) / budget) - math.log(2)
    logs = []
    for k in range(order + 1):
        matrix = np.full((len(tables[k]), len(langs)), floor)
        for row, column, value in entries[k]:
            matrix[row, column] = value
        logs.append(matrix)
    return Model(langs, tables, logs)


def docs_least(spark, totals: dict[tuple[str, int], int], share: float) -> DataFrame:
    """Smallest count that stays, one row per language and length."""
    return spark.createDataFrame([(lang, k, max(1.0, share * n)) for (lang, k), n in totals.items()], "lang string, k int, least double")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; only ``text`` decides."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.tables, model.logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        cache: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            if len(cache) > CACHED_WORDS:
                cache.clear()
            found = [model.predict(letter_words(text or ""), cache) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def word_values(words: DataFrame, order: int = ORDER) -> tuple[list[str], DataFrame]:
    """The languages, and ``lang, word, n, s0 ...`` with the log frequency of each word in each language in whole units.

    ``words`` has ``lang, word, n``; those without a language are valued but not learned from. ``lang`` is empty in the
    result. Unseen words of which no letter is known have no row. The driver gets one total per language and length.
    """
    learned = words.filter("lang is not null")
    table = durable(learned.select("lang", F.lit(0).alias("k"), F.col("word").alias("item"), "n").unionByName(learned_grams(learned, order)), "items")
    totals = {(r["lang"], r["k"]): r["n"] for r in table.groupBy("lang", "k").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for lang, _ in totals})
    if not langs:
        return langs, words.select(F.lit("").alias("lang"), "word", "n").limit(0)
    floors = [math.log(min(len(langs) / BUDGET, *(1 / totals[lang, k] for lang in langs if (lang, k) in totals))) - math.log(2) for k in range(order + 1)]
    floor = F.get(F.array(*map(F.lit, floors)), F.col("k"))

    def log_frequency(lang: str) -> Column:
        total = F.get(F.array(*[F.lit(float(totals.get((lang, k), 1))) for k in range(order + 1)]), F.col("k"))
        n = F.sum(F.when(F.col("lang") == lang, F.col("n")))
        return F.coalesce(F.log(n / total), floor)

    sums_of = [f"s{i}" for i in range(len(langs))]
    # Stored tables go as soon as the values are there: at any time at most a few of them use disk.
    vectors = durable(table.groupBy("k", "item").agg(*[log_frequency(lang).alias(s) for s, lang in zip(sums_of, langs)]), "vectors")
    counts = durable(words.groupBy("word").agg(F.sum("n").alias("n"), F.max(F.col("lang").isNotNull()).alias("seen")), "counts")
    seen = counts.filter("seen").join(vectors.filter("k = 0"), F.col("word") == F.col("item")).select("word", "n", *sums_of)
    # From long n-grams to short ones, each time only words of which no longer one is known.
    left, unseen, stored = counts.filter("not seen").select("word", "n"), None, []
    for length in range(order, 0, -1):
        known = vectors.filter(F.col("k") == length).drop("k")
        met = spelled_as(left, length).join(known, F.col("piece") == F.col("item"))
        means = durable(met.groupBy("word").agg(F.first("n").alias("n"), *[F.avg(s).alias(s) for s in sums_of]), "means")
        left = durable(left.join(means.select("word"), "word", "left_anti"), "left")
        stored += [means, left]
        unseen = means if unseen is None else unseen.unionByName(means)
    valued = seen.unionByName(unseen).select(F.lit("").alias("lang"), "word", "n", *[whole(F.col(s)).alias(s) for s in sums_of])
    valued = durable(valued, "values")
    for read in (table, vectors, counts, *stored):
        discard(read)
    return langs, valued


def describe(text: str) -> tuple[Counter, tuple[int]]:
    words = letter_words(text)
    return Counter(words), (len(words),)


def identify(docs: DataFrame, order: int = ORDER, most: int = HELD_WORDS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, by a model of the rows that are not held out."""
    taught = docs.select("text", F.when(~held_out(), F.col("lang")).alias("lang"))
    words = durable(word_counts(taught, letter_words), "words")
    langs, values = word_values(words, order)
    if langs:
        discard(words)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text", F.lit("").alias("lang"))
    found = sums(rows, values, len(langs), describe, "n_words bigint", most)
    if not langs:
        return found.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    totals = F.array(*[F.col(f"s{i}") for i in range(len(langs))])
    best = F.array_max(totals)
    first = F.get(F.array(*map(F.lit, langs)), (F.array_position(totals, best) - 1).cast("int"))
    share = 1 / F.aggregate(totals, F.lit(0.0), lambda sum, x: sum + F.exp((x - best) / SCALE))
    some = F.col("n_words") > 0
    return found.select("doc_id", "held_out", F.when(some, first).otherwise(UNKNOWN).alias("lang_pred"), F.when(some, share).otherwise(0.0).alias("score"))
