"""Quality rules: word statistics of a text and its perplexity under a modified Kneser-Ney n-gram model of its language.

The model is over the characters of a word, each word framed by one blank, so a word's probability does not depend
on its neighbours and equal words are scored once. Spark counts the n-grams of all trusted texts. Every counted n-gram stays: the model
is a table of sorted hash arrays, one row per shard, and the distinct n-grams of all words are sent to their shards and found by binary search. Values
of n-grams are summed over the distinct words, values of words over the texts (see :mod:`logloom.llm.itemsums`). Texts are read twice, to count their words and to
sum the words' values; between the two only tables of distinct words and n-grams are stored.

Models and bands are learned from trusted texts only: those that pass the base rules and have at most one symbol in ten words.
A model that has seen the noise finds it likely. A language without a trusted text learns from all its texts.

Perplexity bands are per language: a text is rejected beyond ``spread`` interquartile ranges outside the quartiles of the
natural logarithm of perplexity of trusted texts, widened by ``slack / sqrt(words)`` since short texts scatter more.

Defined cases: a null or blank text has no words, no perplexity and fails the word-count rule. A null language is a
language of its own. A language with a single text accepts it. Rows are judged one by one, repeated rows alike; null ids stay
null. Columns other than ``doc_id``, ``text`` and ``lang`` are not looked at. An empty table gives an empty result.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import itemsums
from logloom.llm.itemsums import HELD_ITEMS, item_hash
from logloom.llm.text import small_table
from logloom.llm.words import partial_counts
from logloom.llm.wordsums import SCALE, whole
from logloom.sources.durable import discard, durable

ORDER, BUDGET = 5, 1 << 18
SPREAD, SLACK = 6.0, 4.0
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Symbols per hundred words that a trusted text may have.
TRUSTED_SYMBOLS = 10
#: N-grams in a shard of the model.
SHARD_GRAMS = 1 << 17
#: Log-perplexities are counted in bins of this width to find quartiles.
BIN = 0.01

FIGURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str) -> list[str]:
    return [word.decode() for word in text.encode().split()]


@dataclass
class Grams:
    """N-grams of one order: hashes ascending, log probability, log weight handed to shorter n-grams when a context."""

    hashes: np.ndarray
    log_p: np.ndarray
    log_gamma: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions, and whether the hash is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


@dataclass
class LanguageModel:
    """``orders[k - 1]`` holds the n-grams of length k; ``log_unseen`` is a character never seen."""

    orders: list[Grams] = field(default_factory=list)
    log_unseen: float = 0.0

    def score(self, words: list[str]) -> np.ndarray:
        """Natural-log probability of each word with its closing blank, given the opening blank."""
        codes, starts = _codes(words)
        n = len(codes)
        position = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        hashes = _hashes(codes, len(self.orders))
        total = np.full(n, np.nan)
        passed = np.zeros(n)
        for k in range(len(self.orders), 0, -1):
            grams = self.orders[k - 1]
            open_now = np.flatnonzero(np.isnan(total) & (position >= k - 1) & (position > 0))
            if not len(open_now):
                continue
            at, there = grams.find(hashes[k - 1][open_now])
            hit, miss = open_now[there], open_now[~there]
            total[hit] = passed[hit] + grams.log_p[at[there]]
            if k > 1 and len(miss):
                contexts = self.orders[k - 2]
                at, there = contexts.find(hashes[k - 2][miss - 1])
                passed[miss[there]] += contexts.log_gamma[at[there]]
        rest = np.isnan(total) & (position > 0)
        total[rest] = passed[rest] + self.log_unseen
        total[position == 0] = 0.0
        return np.add.reduceat(total, starts) if n else np.zeros(0)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of `` word `` for all words in a row, and where each begins."""
    joined = "".join(f" {word} " for word in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(word) + 2 for word in words), np.int64, len(words))
    return codes, np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(words) else np.zeros(0, np.int64)


def _hashes(codes: np.ndarray, orders: int) -> list[np.ndarray]:
    """Hash of the k characters that end at each place, for k from 1; places too near the start hold rubbish."""
    with np.errstate(over="ignore"):
        mixed = (codes + np.uint64(1)) * _BASE
        mixed ^= mixed >> np.uint64(29)
        out = [mixed * np.uint64(0xBF58476D1CE4E5B9)]
        for _ in range(1, orders):
            before = np.empty_like(out[-1])
            before[:1] = 0
            before[1:] = out[-1][:-1]
            step = (before ^ (before >> np.uint64(31))) * _BASE + mixed
            out.append(step)
    return out


def gram_hash(gram: str) -> np.uint64:
    codes = np.array([ord(c) for c in gram], np.uint64)
    return _hashes(codes, len(gram))[len(gram) - 1][-1]


def trusted(n_words: int, n_symbols: int, n_repeat_words: int) -> bool:
    """Whether models learn from a text of these figures."""
    return n_words >= MIN_WORDS and 100 * n_repeat_words <= MAX_REPEAT_PERCENT * n_words and 100 * n_symbols <= TRUSTED_SYMBOLS * n_words


def learned_words(docs: DataFrame) -> DataFrame:
    """``lang, word, n, m``: how often a word is in all texts, and in those that models learn from.

    Models learn from the trusted texts, or from all texts of a language that has none.
    """
    words = durable(itemsums.counted(docs, raw_words, measured).withColumnRenamed("item", "word"), "words")
    # One row per language.
    untaught = F.lit(False)
    for row in words.groupBy("lang").agg(F.sum("m").alias("m")).filter("m = 0").collect():
        untaught = untaught | F.col("lang").eqNullSafe(F.lit(row["lang"]))
    return words.withColumn("m", F.when(untaught, F.col("n")).otherwise(F.col("m")))


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, n`` for the longest n-gram that ends at each character of each word."""
    return word_grams(partial_counts(docs, split_words), order).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def word_grams(words: DataFrame, order: int = ORDER) -> DataFrame:
    """The rows of ``words`` (``lang, word`` and more) with ``gram``, once for each character and the closing blank."""
    ends = F.sequence(F.lit(2), F.length("word") + 2)
    framed = words.withColumn("framed", F.concat(F.lit(" "), F.col("word"), F.lit(" "))).withColumn("end", F.explode(ends))
    start = F.greatest(F.col("end") - order + 1, F.lit(1))
    return framed.withColumn("gram", F.col("framed").substr(start, F.col("end") - start + 1)).drop("framed", "end")


def adjusted_counts(grams: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """For each length k the rows ``lang, gram, c, r``: the count Kneser-Ney uses and the count in the text.

    ``c`` is the count in the text for the longest length and for n-grams at the start of a word, otherwise the number
    of different characters before the n-gram.
    """
    longest = grams.filter(F.length("gram") == order)
    levels = [longest.select("lang", "gram", F.col("n").alias("c"), F.col("n").alias("r"))]
    for k in range(order - 1, 0, -1):
        tail = F.substring("gram", 2, k).alias("gram")
        inner = levels[0].groupBy("lang", tail).agg(F.count(F.lit(1)).alias("c"), F.sum("r").alias("r"))
        first = grams.filter(F.length("gram") == k).select("lang", "gram", F.col("n").alias("c"), F.col("n").alias("r"))
        levels.insert(0, inner.unionByName(first).groupBy("lang", "gram").agg(F.sum("c").alias("c"), F.sum("r").alias("r")))
    return levels


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = (counts.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2 or not n3:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def fit(docs: DataFrame, order: int = ORDER, budget: int = BUDGET) -> dict[str | None, LanguageModel]:
    """One model per language from all texts of ``docs`` (``text``, ``lang``), to be held in one place.

    An n-gram stays if it makes up at least ``languages / budget`` of its language's characters. The mass of dropped n-grams goes
    to the shorter ones, so every distribution still sums to one. No query uses it: they score by :func:`fit_table`.
    The driver receives the kept n-grams, at most ``order * budget`` of them, and per language and order a few numbers.
    """
    grams = durable(count_grams(docs, order), "grams")
    totals = {r["lang"]: r["n"] for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    models = {lang: LanguageModel() for lang in totals}
    share = len(totals) / budget
    levels = [level.withColumn("k", F.lit(k + 1)) for k, level in enumerate(adjusted_counts(grams, order))]
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = durable(table, "levels")
    ranks: dict[tuple, dict[int, int]] = {}
    for r in table.filter("c <= 4").groupBy("lang", "k", "c").count().collect():
        ranks.setdefault((r["lang"], r["k"]), {})[r["c"]] = r["count"]
    sizes = {(r["lang"], r["k"]): (r["total"], r["kinds"]) for r in table.groupBy("lang", "k").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")).collect()}

    context = F.expr("substring(gram, 1, k - 1)")
    spark = docs.sparkSession
    small = spark.createDataFrame(
        [(lang, k, *discounts(ranks.get((lang, k), {})), max(1.0, share * totals[lang])) for lang, k in sizes] or [(None, 0, 0.0, 0.0, 0.0, 0.0)],
        "lang_of string, k_of int, d1 double, d2 double, d3 double, least double",
    )
    # One row per language and order, built here: broadcast by its size.
    joined = table.join(F.broadcast(small), F.col("lang").eqNullSafe(F.col("lang_of")) & (F.col("k") == F.col("k_of"))).select(
        "lang", "k", "gram", "c", context.alias("context"), (F.col("r") >= F.col("least")).alias("kept"),
        F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"),
    )
    joined = joined.withColumn("own", F.when(F.col("kept"), F.col("c") - F.col("d")).otherwise(0.0))
    per_context = joined.groupBy("lang", "k", "context").agg(F.sum("c").alias("total"), F.sum("own").alias("held"))
    kept = joined.filter("kept").alias("g").join(
        per_context.alias("x"), F.col("g.lang").eqNullSafe(F.col("x.lang")) & (F.col("g.k") == F.col("x.k")) & (F.col("g.context") == F.col("x.context"))
    )
    alphas = kept.select("g.lang", "g.k", "g.gram", (F.col("own") / F.col("total")).alias("alpha")).toArrow()
    # Only contexts that are kept n-grams themselves; for a dropped one the shorter context is used as it is.
    contexts = per_context.alias("x").join(
        joined.filter("kept").select("lang", F.col("k").alias("length"), "gram").alias("g"),
        F.col("x.lang").eqNullSafe(F.col("g.lang")) & (F.col("x.context") == F.col("g.gram")), "left_semi",
    )
    contexts = contexts.filter("k > 1").unionByName(per_context.filter("k = 1"))
    gammas = contexts.select("lang", "k", "context", (1 - F.col("held") / F.col("total")).alias("gamma")).toArrow()
    return _assemble(models, order, sizes, alphas.to_pydict(), gammas.to_pydict())


def _assemble(models, order, sizes, alphas, gammas):
    by: dict = {}
    for lang, k, gram, alpha in zip(alphas["lang"], alphas["k"], alphas["gram"], alphas["alpha"]):
        by.setdefault((lang, k), {})[gram] = alpha
    weight: dict = {}
    for lang, k, context, gamma in zip(gammas["lang"], gammas["k"], gammas["context"], gammas["gamma"]):
        weight.setdefault(lang, {})[context] = gamma
    for lang, model in models.items():
        own = weight.get(lang, {})
        unseen = own.get("", 1.0) / (sizes.get((lang, 1), (0, 0))[1] + 1)
        shorter: dict[str, float] = {}
        tables = []
        for k in range(1, order + 1):
            here = by.get((lang, k), {})
            shorter = {g: a + own.get(g[:-1], 1.0) * (shorter.get(g[1:], _backed(g[1:], tables, own, unseen)) if k > 1 else 1.0 / (sizes[lang, 1][1] + 1)) for g, a in here.items()}
            tables.append(shorter)
        model.log_unseen = math.log(max(unseen, 1e-300))
        for k, table in enumerate(tables, 1):
            grams = sorted((int(gram_hash(g)), g) for g in table)
            model.orders.append(
                Grams(
                    np.array([h for h, _ in grams], np.uint64),
                    np.log(np.maximum(np.array([table[g] for _, g in grams], float), 1e-300)),
                    np.log(np.maximum(np.array([own.get(g, 1.0) for _, g in grams], float), 1e-300)),
                )
            )
    return models


def _backed(gram: str, tables: list[dict[str, float]], own: dict[str, float], unseen: float) -> float:
    """Probability of the last character of ``gram`` from the tables of its length and less."""
    passed = 1.0
    while gram:
        if gram in tables[len(gram) - 1]:
            return passed * tables[len(gram) - 1][gram]
        passed *= own.get(gram[:-1], 1.0) if len(gram) > 1 else 1.0
        gram = gram[1:]
    return passed * unseen


def raw_words(text: str) -> list[bytes]:
    return text.encode().split()


def measured(text: str, words: list[bytes], numbers: np.ndarray) -> tuple[tuple[int, ...], int]:
    """The :data:`FIGURES` of a text of these words, which ``numbers`` tell apart, and whether models learn from it.

    Code points in words, symbols, repeated lines, and words in windows of five that occur twice.
    """
    data = text.encode()
    word_chars = len(text) - len(data) + len(data.translate(None, BLANKS.encode()))
    symbols = len(data) - len(data.translate(None, SYMBOLS.encode()))
    seen: set[str] = set()
    repeated = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(BLANKS):
                repeated += line in seen
                seen.add(line)
    again = repeated_words(words, numbers)
    return (len(words), word_chars, symbols, repeated, again), int(trusted(len(words), symbols, again))


def repeated_words(words: list[bytes], numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that is found at least twice, windows compared word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.asarray(numbers, np.int64)
    # Equal windows have equal sums, so without equal sums there are none; most texts end here.
    sums = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for offset in range(window):
            sums = sums * _BASE + ids[offset : offset + n].astype(np.uint64)
    sums.sort()
    if not (sums[1:] == sums[:-1]).any():
        return 0
    ids = np.unique(ids, return_inverse=True)[1]
    kinds = int(ids.max()) + 1
    code = np.zeros(n, np.int64)
    for offset in range(window):  # ranks of ever longer runs, so that codes stay small and exact
        code = np.unique(code * kinds + ids[offset : offset + n], return_inverse=True)[1]
    twice = (np.bincount(code) > 1)[code]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def fit_table(grams: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """``lang, gram, log_p, log_gamma`` of every n-gram of every length, and ``lang_of, log_unseen`` with one row per language.

    The same model as :func:`fit` with nothing dropped; ``grams`` as :func:`count_grams` gives them. The driver gets a few
    numbers per language and order.
    """
    spark = grams.sparkSession
    levels = [level.select("lang", F.lit(k).alias("k"), "gram", "c") for k, level in enumerate(adjusted_counts(grams, order), 1)]
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = counted = durable(table, "levels")
    ranks: dict[tuple, dict[int, int]] = {}
    for r in table.filter("c <= 4").groupBy("lang", "k", "c").count().collect():
        ranks.setdefault((r["lang"], r["k"]), {})[r["c"]] = r["count"]
    kinds = {(r["lang"], r["k"]): r["count"] for r in table.groupBy("lang", "k").count().collect()}
    small = small_table(
        spark,
        [(lang, k, *discounts(ranks.get((lang, k), {})), 1.0 / (kinds[lang, 1] + 1)) for lang, k in kinds],
        {"lang_of": pa.string(), "k_of": pa.int32(), "d1": pa.float64(), "d2": pa.float64(), "d3": pa.float64(), "uniform": pa.float64()},
    )
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    # One row per language and order, built here: broadcast by its size.
    owned = table.join(F.broadcast(small), F.col("lang").eqNullSafe(F.col("lang_of")) & (F.col("k") == F.col("k_of"))).select(
        "lang", "k", "gram", "c", F.expr("substring(gram, 1, k - 1)").alias("context"), (F.col("c") - d).alias("own"), "uniform"
    )
    totals = owned.groupBy("lang", "k", "context", "uniform").agg(F.sum("c").alias("total"), F.sum("own").alias("held"))
    totals = durable(totals.withColumn("gamma", 1 - F.col("held") / F.col("total")), "contexts")

    def of(k: int) -> DataFrame:
        x = totals.filter(F.col("k") == k).select(F.col("lang").alias("lang_x"), F.col("context").alias("context_x"), "total", "gamma")
        return owned.filter(F.col("k") == k).join(x, F.col("lang").eqNullSafe(F.col("lang_x")) & (F.col("context") == F.col("context_x")))

    shorter = durable(of(1).select("lang", "gram", (F.col("own") / F.col("total") + F.col("gamma") * F.col("uniform")).alias("p")), "grams")
    table, stored = shorter, [shorter]
    for k in range(2, order + 1):
        tails = shorter.select(F.col("lang").alias("lang_t"), F.col("gram").alias("tail"), F.col("p").alias("p_tail"))
        met = of(k).join(tails, F.col("lang").eqNullSafe(F.col("lang_t")) & (F.expr("substring(gram, 2, k - 1)") == F.col("tail")))
        shorter = durable(met.select("lang", "gram", (F.col("own") / F.col("total") + F.col("gamma") * F.col("p_tail")).alias("p")), "grams")
        stored.append(shorter)
        table = table.unionByName(shorter)
    weights = totals.filter("k > 1").select(F.col("lang").alias("lang_x"), F.col("context").alias("context_x"), "gamma")
    model = table.join(weights, F.col("lang").eqNullSafe(F.col("lang_x")) & (F.col("gram") == F.col("context_x")), "left").select(
        "lang", "gram", _log("p").alias("log_p"), F.coalesce(_log("gamma"), F.lit(0.0)).alias("log_gamma")
    )
    unseen = totals.filter("k = 1").select(F.col("lang").alias("lang_of"), _log(F.col("gamma") * F.col("uniform")).alias("log_unseen"))
    model, unseen = durable(model, "model"), durable(unseen, "unseen")
    for read in (*stored, counted, totals):
        discard(read)
    return model, unseen


def _log(value: Column | str) -> Column:
    return F.log(F.greatest(F.col(value) if isinstance(value, str) else value, F.lit(1e-300)))


def hash_arrays(model: DataFrame) -> tuple[DataFrame, int]:
    """The model as sorted hash arrays, one row per shard of at most about ``SHARD_GRAMS`` n-grams: ``shard, hashes, log_p, log_gamma``; and the number of shards.

    A shard holds a class of hashes, in ascending order. N-grams are told apart by 64 bits of language and characters.
    """
    shards = max(1, -(-model.count() // SHARD_GRAMS))
    hashed = model.select(item_hash("lang", "gram").alias("h"), "log_p", "log_gamma")
    held = F.sort_array(F.collect_list(F.struct("h", "log_p", "log_gamma")))
    grouped = hashed.groupBy(F.pmod("h", F.lit(shards)).alias("shard")).agg(held.alias("held"))
    return durable(grouped.select("shard", F.col("held.h").alias("hashes"), F.col("held.log_p").alias("log_p"), F.col("held.log_gamma").alias("log_gamma")), "model"), shards


def found_in(arrays: DataFrame, shards: int, sought: DataFrame) -> DataFrame:
    """``sought`` (``lang``, ``key`` and more) with ``log_p`` and ``log_gamma``, null where the model lacks the key: a binary search in the key's shard."""
    asked = sought.withColumn("h", item_hash("lang", "key")).withColumn("shard_of", F.pmod("h", F.lit(shards)))
    kept = sought.columns
    types = {f.name: f.dataType.simpleString() for f in sought.schema}
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept], "log_p double", "log_gamma double"])

    def search(queries: pa.Table, held: pa.Table) -> pa.Table:
        hashes = held["hashes"].combine_chunks().flatten().to_numpy() if held.num_rows else np.zeros(0, np.int64)
        wanted = queries["h"].to_numpy()
        columns = [queries[c] for c in kept]
        if not len(hashes):
            return pa.table([*columns, pa.nulls(len(wanted), pa.float64()), pa.nulls(len(wanted), pa.float64())], names=[*kept, "log_p", "log_gamma"])
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        absent = hashes[at] != wanted
        values = [pa.array(held[name].combine_chunks().flatten().to_numpy()[at], mask=absent) for name in ("log_p", "log_gamma")]
        return pa.table([*columns, *values], names=[*kept, "log_p", "log_gamma"])

    return asked.groupBy("shard_of").cogroup(arrays.groupBy("shard")).applyInArrow(search, schema)


def spelled_all(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], list[bytes]]]:
    """The longest n-gram that ends at each character of the words and at the blank after them: hashes of 64 bits, how many a word has, and what spells some of them."""
    joined = "".join(f" {word} " for word in words)
    codes, starts = _codes(words)
    lengths = np.diff(np.append(starts, len(codes)))
    position = np.arange(len(codes)) - np.repeat(starts, lengths)
    hashes = _hashes(codes, order)
    keys = hashes[order - 1]
    for k in range(2, order):
        keys = np.where(position == k - 1, hashes[k - 1], keys)
    ends = np.flatnonzero(position > 0)

    def names(places: np.ndarray) -> list[bytes]:
        at = ends[places]
        return [joined[start:end].encode() for start, end in zip((at - np.minimum(position[at], order - 1)).tolist(), (at + 1).tolist())]

    return keys[ends], lengths - 1, names


def gram_values(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, item, n, s0``: the log probability, in whole units, of the last character of every n-gram of ``grams`` (``lang, item, n, m``) after the others.

    The model is that of the n-grams with ``m > 0``. Any other backs off: the longest ending the model has counts, and what is
    passed on by the contexts of the longer ones.
    """
    model, unseen = fit_table(grams.filter("m > 0").select("lang", F.col("item").alias("gram"), F.col("m").alias("n")), order)
    arrays, shards = hash_arrays(model)
    discard(model)
    at = F.explode(F.sequence(F.lit(1), F.when(F.col("m") > 0, 1).otherwise(F.length("item"))))
    endings = grams.select("lang", "item", "n", "m", at.alias("at"))
    own, context = F.expr("substring(item, at)"), F.expr("substring(item, at, length(item) - at)")
    parts = F.when(F.col("m") > 0, F.array(F.struct(own.alias("key"), F.lit(True).alias("own"))))
    parts = parts.otherwise(F.array(F.struct(own.alias("key"), F.lit(True).alias("own")), F.struct(context.alias("key"), F.lit(False).alias("own"))))
    sought = endings.withColumn("part", F.explode(parts)).select("lang", "item", "n", "at", "part.key", "part.own")
    steps = found_in(arrays, shards, sought).groupBy("lang", "item", "n").agg(
        F.min(F.when(F.col("own") & F.col("log_p").isNotNull(), F.struct("at", "log_p"))).alias("hit"),
        F.sort_array(F.collect_list(F.when(~F.col("own") & F.col("log_gamma").isNotNull(), F.struct("at", "log_gamma")))).alias("contexts"),
    )
    passed = F.aggregate("contexts", F.lit(0.0), lambda sum, x: sum + F.when(F.col("hit").isNull() | (x["at"] < F.col("hit.at")), x["log_gamma"]).otherwise(0.0))
    # One row per language.
    backed = steps.join(F.broadcast(unseen), F.col("lang").eqNullSafe(F.col("lang_of")))
    return backed.select("lang", "item", "n", whole(passed + F.coalesce("hit.log_p", "log_unseen")).alias("s0"))


def word_values(words: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, word, n, s0``: the log probability of every word (see :func:`learned_words`) in whole units, from the model of the learned ones."""
    spelt = words.select("lang", "word", F.col("n").alias("times"), "m", F.col("word").alias("text"))
    split = lambda words: spelled_all(words, order)
    grams = durable(itemsums.counted_at_once(spelt, split, "m"), "grams")
    found = durable(gram_values(grams, order), "valued")
    discard(grams)
    values = itemsums.summed_at_once(spelt.drop("m"), found, split)
    discard(found)
    return values.select("lang", "word", F.col("times").alias("n"), "s0")


def score(docs: DataFrame, values: DataFrame, most: int = HELD_ITEMS) -> DataFrame:
    """One row per document: key, statistics and log perplexity per character (null without words)."""
    keyed = docs.select("doc_id", "text", "lang", F.xxhash64("text", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    found = itemsums.summed(keyed, values.withColumnRenamed("word", "item"), raw_words, measured, FIGURES, most)
    per_character = -F.col("s0") / SCALE / (F.col("word_chars") + F.col("n_words"))
    return found.withColumn("log_perplexity", F.when(F.col("n_words") > 0, per_character)).select("doc_id", "h1", "h2", "lang", *[f.split()[0] for f in FIGURES.split(", ")], "log_perplexity")


def bands(scores: DataFrame, spread: float = SPREAD) -> dict[str | None, tuple[float, float]]:
    """Lower and upper log-perplexity per language.

    Quartiles come from a histogram, which has a bounded number of bins whatever the number of documents.
    """
    binned = scores.filter("log_perplexity is not null").groupBy("lang", F.floor(F.col("log_perplexity") / BIN).alias("bin")).count()
    found: dict = {}
    for row in binned.collect():
        found.setdefault(row["lang"], []).append((row["bin"], row["count"]))
    out = {}
    for lang, bins in found.items():
        bins.sort()
        places, counts = np.array([b for b, _ in bins]), np.cumsum([c for _, c in bins])
        low, high = (float(places[np.searchsorted(counts, q * counts[-1])]) * BIN for q in (0.25, 0.75))
        reach = spread * max(high - low, BIN)
        out[lang] = (low - reach, high + BIN + reach)
    return out


def trusted_scores(scores: DataFrame) -> DataFrame:
    """Scores of trusted texts; all scores of a language that has none."""
    fine = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    fine = fine & (100 * F.col("n_symbols") <= TRUSTED_SYMBOLS * F.col("n_words"))
    marked = scores.withColumn("fine", fine)
    langs = marked.groupBy(F.col("lang").alias("of")).agg(F.max("fine").alias("any"))
    # One row per language.
    return marked.join(F.broadcast(langs), F.col("lang").eqNullSafe(F.col("of"))).filter("fine or not any").select("lang", "log_perplexity")


def judge(scores: DataFrame, limits: dict[str | None, tuple[float, float]], slack: float = SLACK) -> DataFrame:
    """Scores with ``perplexity``, ``base_failed`` and ``kept``."""
    spark = scores.sparkSession
    # One row per language.
    table = small_table(spark, [(lang, *b) for lang, b in limits.items()], {"band_lang": pa.string(), "low": pa.float64(), "high": pa.float64()})
    wide = F.lit(slack) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    inside = F.col("log_perplexity").between(F.col("low") - wide, F.col("high") + wide)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        scores.join(F.broadcast(table), F.col("lang").eqNullSafe(F.col("band_lang")), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & F.coalesce(inside, F.lit(True)))
        .withColumn("perplexity", F.exp("log_perplexity"))
        .drop("band_lang", "low", "high")
    )


def quality(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Verdict per document, from models and bands fitted on the trusted texts of ``docs``."""
    docs = docs.select("doc_id", "text", "lang")
    words = learned_words(docs)
    values = word_values(words, order)
    discard(words)
    scores = score(docs, values)
    discard(values)
    return judge(scores, bands(trusted_scores(scores)))
