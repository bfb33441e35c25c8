"""Phrase collocation mining by set-oriented relational mining (SETM).

The relation of level k holds every occurrence of a phrase of k words as (piece, place, phrase), sorted by piece and place, and is stored. The
next level comes from a merge-join of the relation with itself on the same piece and the next place: two phrases that overlap in all but one word make one
of k + 1. Words are counted first, and the relation of level 1 holds the frequent ones. Group counts over the whole corpus find the phrases that are frequent, and the relation is semi-joined with them before it is extended
again: occurrences of phrases that are not frequent go. All contiguous parts of a frequent phrase are frequent, so nothing is lost.

Layout. A row of the relation is a *block*: occurrences of about ``BLOCK_WORDS`` words of text, in order. A place is the number of the word in its
block; a piece's end leaves one place free, so the next place always lies in the same piece. Phrases are numbered within the block and
stored once per block, with their hashes. Places, numbers and hashes are bytes to Spark, which moves them as a whole and not element by element; what
needs only these does not read the phrases. Group counts move one row per block and distinct phrase, so a word that is everywhere is one row per block and not one per
occurrence.

The semi-join is done where the relation lies, by a bit filter of the frequent phrases of at most 16 MB (see :mod:`logloom.llm.bitfilter`), which goes when the next
relation is stored. It misses none; the few others that it lets through are extended and fall to the next, exact count. With more than some 10^8 frequent phrases of a length it lets most through: then more
is counted, and the result is the same.

A row is large, so the relation is stored in small row groups and read a few rows at once: a task holds little of it, in Spark as in Python, however much there is.

Before a level is made, the hashes of its phrases are counted in buckets (Park, Chen and Yu): a phrase whose bucket has too few occurrences cannot be frequent and is
neither spelled, stored nor moved. What moves is a sorted array of numbers for each task and part of the buckets. The number of buckets grows with the
corpus, some tens for each word of it, so that hardly two phrases share one. The exact count follows.

A candidate is scored at its worst cut, in exact decimals; it goes if a longer candidate around it is as frequent (``COVER`` percent). The longer
candidates with the highest count have one word more, so only these are compared.

Defined cases: a null text has no word, a null language is ``und``. Only A-Z are lower-cased. A piece never spans rows. Repeated rows count each. Texts of any
length: a text with more words than a block makes a larger block. Other columns are not looked at. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm import bitfilter, itemsums
from logloom.llm.itemblocks import Numbers, as_text, one
from logloom.llm.text import raw_texts, returning_memory, slices
from logloom.sources.durable import discard, durable, wide_rows_read

MIN_COUNT, MIN_WORDS, MAX_WORDS, TOP, COVER = 100, 2, 5, 2000, 100
BLOCK_WORDS = 1 << 13
#: Distinct words a task remembers.
TASK_WORDS = 100_000
SALTS = 64
#: Buckets of a part, as a power of two; words of the corpus for each part; phrases that a task counts at once.
PART_BITS, PART_WORDS, TASK_PHRASES = 24, 1 << 20, 1 << 20
SPARK_SEED = 42
UNKNOWN = "und"
# Where pieces end, and what separates words.
PIECE_ENDS, SEPARATORS = b".,;:!?\n\x0b\x0c\r", b" \t"

#: No byte of UTF-8.
_BREAK = b"\xff"
_BLANK = bytes.maketrans(PIECE_ENDS + SEPARATORS, b" " * len(PIECE_ENDS + SEPARATORS))
_ONE_WAY = bytes.maketrans(PIECE_ENDS + SEPARATORS, _BREAK * len(PIECE_ENDS) + b" " * len(SEPARATORS))
RELATION = "block bigint, places binary, phrases binary, hashes binary, items array<struct<lang:string,phrase:string,n:bigint>>"
#: What makes its rows wide, as parquet names it.
WIDE = ("places", "phrases", "hashes", "items.list.element.phrase")


def words_and_breaks(text: bytes) -> list[bytes]:
    """The words of a text with a break between pieces."""
    return text.lower().translate(_ONE_WAY).replace(_BREAK, b" \xff ").split()


def words_only(text: str) -> list[bytes]:
    return text.encode().lower().translate(_BLANK).split()


def _row(block: int, places: np.ndarray, phrases: np.ndarray, langs: list[str], names: list[bytes], counts: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """One block of the relation; places are stored as steps, which are small."""
    struct = pa.StructArray.from_arrays([pa.array(langs, pa.string()), as_text(names), pa.array(counts, pa.int64())], ["lang", "phrase", "n"])
    numbers = [pa.array([data], pa.binary()) for data in (packed(places), planes(phrases), hashes.tobytes())]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *numbers, one(struct)], names=["block", "places", "phrases", "hashes", "items"])


def occurrences(docs: DataFrame, block_words: int = BLOCK_WORDS, shared: Broadcast | None = None) -> DataFrame:
    """The relation of single words of ``docs`` (``text``, ``lang``), or of those in the filter ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        names: list[bytes] = []
        by_lang: dict[str, Numbers] = {}
        langs: list[str] = []
        hashes, kept = np.zeros(0, np.uint64), np.zeros(0, bool)
        parts: list[np.ndarray] = []
        held = 0

        def made() -> pa.RecordBatch:
            nonlocal hashes, kept
            new = phrase_hashes(langs[len(hashes) :], names[len(hashes) :])
            hashes = np.concatenate([hashes, new])
            kept = np.concatenate([kept, np.ones(len(new), bool) if shared is None else bitfilter.holds(shared.value, new)])
            found = np.concatenate(parts)
            # The last number, that of a break, is -1.
            places = np.flatnonzero(np.append(kept, False)[found])
            counts = np.bincount(found[places], minlength=len(names))
            own = np.flatnonzero(counts)
            number = np.zeros(len(names), np.int32)
            number[own] = np.arange(len(own))
            return _row(block, places, number[found[places]], [langs[i] for i in own.tolist()], [names[i] for i in own.tolist()], counts[own], hashes[own])

        for batch in slices(batches):
            for text, lang in zip(raw_texts(batch["text"]), batch["lang"].to_pylist()):
                words = words_and_breaks(text)
                if not words:
                    continue
                lang = UNKNOWN if lang is None else lang
                numbers = by_lang.get(lang)
                if numbers is None:
                    numbers = by_lang[lang] = Numbers(names)
                    numbers[_BREAK] = -1
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                parts.append(np.full(1, -1, np.int32))
                langs += [lang] * (len(names) - len(langs))
                held += len(words)
                if held >= block_words:
                    yield made()
                    block, held, parts = block + 1, 0, []
                    if len(names) > TASK_WORDS:
                        names, by_lang, langs = [], {}, []
                        hashes, kept = np.zeros(0, np.uint64), np.zeros(0, bool)
        if held:
            yield made()

    return docs.select("text", "lang").mapInArrow(returning_memory(run), RELATION)


def frequent(relation: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, n``: the phrases of the relation that occur ``least`` times in the whole corpus."""
    rows = relation.select(F.explode("items").alias("item")).select("item.lang", "item.phrase", "item.n")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def phrase_hashes(langs: list[str], names: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64(lang, phrase)``: the hash of the first is the seed of the second."""
    seeds = {lang: xxhash.xxh64_intdigest(lang.encode(), SPARK_SEED) for lang in set(langs)}
    return np.fromiter(map(xxhash.xxh64_intdigest, names, map(seeds.__getitem__, langs)), np.uint64, len(names))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of the phrase that two overlapping phrases make, from theirs."""
    with np.errstate(over="ignore"):
        mixed = (first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + second
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(32))


def _frequent_places(batch: pa.RecordBatch, shared: Broadcast) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the places with a phrase that passes the filter, its number, and the hashes of all phrases by number."""
    places, phrases = unpacked(batch["places"][0].as_py()), from_planes(batch["phrases"][0].as_py())
    hashes = np.frombuffer(batch["hashes"][0].as_py(), np.uint64)
    here = bitfilter.holds(shared.value, hashes)[phrases]
    return places[here], phrases[here].astype(np.int64), hashes


def planes(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits byte by byte: all lowest bytes, then the next. The higher ones are mostly zero, which files and shuffles compress."""
    return np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers of 32 bits as their steps."""
    return planes(np.diff(numbers.astype("<u4"), prepend=np.uint32(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.int64)


def promising(relation: DataFrame, shared: Broadcast, bits: int, least: int) -> Broadcast:
    """A filter of the buckets, ``2 ** (bits + PART_BITS)`` of them, in which ``least`` occurrences of phrases one word longer fall."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, 1):
            places, phrases, hashes = _frequent_places(batch, shared)
            left = np.flatnonzero(np.diff(places) == 1)
            held.append(pair_hashes(hashes[phrases[left]], hashes[phrases[left + 1]]) >> np.uint64(64 - bits - PART_BITS))
            size += len(left)
            if size >= TASK_PHRASES:
                yield from handed(held)
                held, size = [], 0
        if size:
            yield from handed(held)

    def handed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(held)
        held.clear()
        found.sort()  # in place: np.unique would hold two more copies
        firsts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        times = np.diff(firsts, append=len(found)).astype("<u4")
        found = found[firsts]
        parts = (found >> np.uint64(PART_BITS)).astype(np.int64)
        starts = np.flatnonzero(np.diff(parts, prepend=-1))
        for some in range(0, len(starts), 64):
            rows = [(parts[a], packed(found[a:b] & np.uint64((1 << PART_BITS) - 1)), times[a:b].tobytes()) for a, b in zip(starts[some : some + 64], np.append(starts, len(found))[some + 1 :])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "buckets", "times"])

    def merged(group: pa.Table) -> pa.Table:
        numbers = np.concatenate([unpacked(x) for x in group["buckets"].to_pylist()])
        times = np.concatenate([np.frombuffer(x, "<u4") for x in group["times"].to_pylist()]).astype(np.int64)
        order = np.argsort(numbers)
        starts = np.flatnonzero(np.diff(numbers[order], prepend=-1))
        enough = np.add.reduceat(times[order], starts) >= least
        return pa.table({"h": pa.array((group["part"][0].as_py() << PART_BITS) + numbers[order][starts[enough]])})

    told = relation.select("places", "phrases", "hashes").mapInArrow(returning_memory(buckets), "part bigint, buckets binary, times binary")
    return bitfilter.build(told.groupBy("part").applyInArrow(merged, "h bigint"), "h")


def extended(relation: DataFrame, counts: DataFrame, least: int | None = None, bits: int = 6, filters: list[Broadcast] | None = None) -> DataFrame:
    """The relation of phrases one word longer: what is frequent, merge-joined on the next place of the piece.

    With ``least`` only phrases whose bucket has so many occurrences. ``filters`` gets the filters that the relation is made with.
    """
    shared = bitfilter.build(counts.select(F.xxhash64("lang", "phrase").alias("h")), "h")
    hopeful = None if least is None else promising(relation, shared, bits, least)
    if filters is not None:
        filters += [shared] if hopeful is None else [shared, hopeful]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            places, phrases, hashes = _frequent_places(batch, shared)
            left = np.flatnonzero(np.diff(places) == 1)
            if hopeful is not None:
                own = pair_hashes(hashes[phrases[left]], hashes[phrases[left + 1]]) >> np.uint64(64 - bits - PART_BITS)
                left = left[bitfilter.holds(hopeful.value, own)]
            if not len(left):
                continue
            items = batch["items"].flatten()
            names = items.field("phrase").cast(pa.binary()).to_pylist()
            pairs, number, counted = np.unique(phrases[left] * len(names) + phrases[left + 1], return_inverse=True, return_counts=True)
            first, second = np.divmod(pairs, len(names))
            langs = items.field("lang").take(pa.array(first)).to_pylist()
            longer = [names[a] + b" " + names[b].rpartition(b" ")[2] for a, b in zip(first.tolist(), second.tolist())]
            yield _row(batch["block"][0].as_py(), places[left], number, langs, longer, counted, phrase_hashes(langs, longer))

    return relation.mapInArrow(returning_memory(run), RELATION)


def mine(docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of every phrase of up to ``longest`` words that occurs ``least`` times, and ``lang, n``, the words of each language."""
    known = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    words = durable(itemsums.counted(known, words_only).select("lang", F.col("item").alias("phrase"), "n"), "words")
    sizes = durable(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bits = min(max(6, (total // PART_WORDS).bit_length()), 20)
    counts = durable(words.filter(F.col("n") >= least), "counts")
    discard(words)
    filters = [bitfilter.build(counts.select(F.xxhash64("lang", "phrase").alias("h")), "h")]
    relation = durable(occurrences(known, block_words, filters[0]), "occurrences", WIDE)
    bitfilter.release(filters)
    found = counts.select("lang", "phrase", F.lit(1).alias("words"), "n")
    for length in range(2, longest + 1):
        with wide_rows_read(known.sparkSession):
            longer = durable(extended(relation, counts, least, bits, filters), "occurrences", WIDE)
            bitfilter.release(filters)
            discard(relation)
            relation = longer
            counts = durable(frequent(relation, least), "counts")
        found = found.unionByName(counts.select("lang", "phrase", F.lit(length).alias("words"), "n"))
    discard(relation)
    return found, sizes


def words_of(phrase: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, n), " ")


def scored(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of phrases of two or more words, at the cut with the lowest score, the first among equals."""
    parts = found.select("lang", "phrase", F.col("n"))
    cuts = found.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", words_of(F.col("phrase"), F.lit(1), F.col("cut"))).withColumn("right", words_of(F.col("phrase"), F.col("cut") + 1, F.col("words")))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(sizes, "lang")  # one row per language
    wide = "decimal(19,0)"
    # Below 1000 times n, since neither part is rarer than the phrase: the quotient fits 64 bits, products up to 38 digits are exact.
    score = F.expr(f"(cast(a as {wide}) * cast(n as {wide}) * 1000) div (cast(l as {wide}) * cast(r as {wide}))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")


def uncovered(phrases: DataFrame, cover: int = COVER) -> DataFrame:
    """Phrases without a longer one around them that has ``cover`` percent of their count."""
    longer = phrases.filter("words > 2").select("lang", "phrase", "words", "a")
    inner = F.array(words_of(F.col("phrase"), F.lit(1), F.col("words") - 1), words_of(F.col("phrase"), F.lit(2), F.col("words")))
    around = longer.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    met = phrases.join(around, ["lang", "phrase"], "left")
    return met.filter(F.col("around").isNull() | (100 * F.col("around") < cover * F.col("a"))).drop("around")


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their ``rank``; all but the first of each of ``SALTS`` parts of a language go before one task sees it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    first = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", part).filter(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top).drop("salt")


def collocations(docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, top: int = TOP, cover: int = COVER, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Contract of the operator: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases = durable(scored(*mine(docs, least, longest, block_words)), "phrases")
    return ranked(uncovered(phrases, cover), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
