"""Line dedup by a log-template tree.

A line is cut into words at ASCII white space; words with a digit are variable fields. The tree has fixed depth: the
number of words, then the first ``depth`` words. Inside a leaf a word is generalised when fewer than ``min_docs`` lines
have it at its place; the line takes the generalised form only if at least ``min_constant`` words and
``similarity`` of all words stay, otherwise it is a template of its own with digits generalised.

A template in at least ``min_docs`` documents is recurring. Its lines stay in the document with the smallest id and
are dropped everywhere else. Lines of fewer than ``min_words`` words, or with fewer than two constant words, are left alone.

The tree is counted by Spark, leaf by leaf and word by word, never held in one place: a crowded leaf is many keys, one per
place and word, and counts are combined before each shuffle.

Defined cases: a null text becomes an empty one with one empty line. Documents without id are returned unchanged and
count for nothing. Rows with the same id are one document. Other columns are carried along. An empty table gives an
empty result. Hashes of lines have 64 bits, plus 64 for the leaf.

The first documents of the most frequent recurring lines, at most ``HELD_FIRSTS``, are broadcast as two sorted arrays of numbers, and such lines are dropped in the task
that reads the text. Only documents that lose a line of the others are moved to be joined with their lists. Which lines are held changes the way, never the result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import bitfilter
from logloom.llm.text import raw_texts, returning_memory, slices
from logloom.sources.durable import durable

DEPTH, MIN_DOCS, MIN_WORDS = 3, 3, 3
MIN_CONSTANT, SIMILARITY = 5, 0.8
VARIABLE = b"<*>"
#: Lines that a task remembers to have handed on.
HELD_LINES = 200_000
#: Recurring lines broadcast with their first documents, 16 bytes each.
HELD_FIRSTS = 1 << 18
_DIGITS = b"0123456789"


def masked(words: list[bytes]) -> list[bytes]:
    """Words with a digit become the variable field."""
    return [VARIABLE if word.translate(None, _DIGITS) != word else word for word in words]


def line_words(line: bytes) -> list[bytes]:
    words = line.split()
    return masked(words) if line.translate(None, _DIGITS) != line else words


def eligible(words: list[bytes], min_words: int = MIN_WORDS) -> bool:
    return len(words) >= min_words and len(words) - words.count(VARIABLE) >= 2


def hashes(words: list[bytes], depth: int = DEPTH) -> tuple[int, int]:
    """Of the masked line, and of its leaf."""
    return (
        xxhash.xxh64_intdigest(b" ".join(words)),
        xxhash.xxh64_intdigest(b" ".join(words[:depth]), len(words)),
    )


def scan(docs: DataFrame, depth: int, min_words: int) -> DataFrame:
    """``doc_id, line, leaf, wide``: every eligible line once per row; ``wide`` if it is long enough to be generalised."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lines, leaves, wide = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), raw_texts(batch["text"])):
                own = {}
                for line in set(text.split(b"\n")):
                    words = line_words(line)
                    if eligible(words, min_words):
                        own[hashes(words, depth)] = len(words) > MIN_CONSTANT
                for (line, leaf), long in own.items():
                    ids.append(doc_id)
                    lines.append(line)
                    leaves.append(leaf)
                    wide.append(long)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), _longs(lines), _longs(leaves), pa.array(wide, pa.bool_())],
                names=["doc_id", "line", "leaf", "wide"],
            )

    known = docs.select("doc_id", "text").filter("doc_id is not null")
    return known.mapInArrow(returning_memory(run), "doc_id bigint, line bigint, leaf bigint, wide boolean")


def _longs(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def crowded_lines(docs: DataFrame, leaves: Broadcast, depth: int, min_words: int) -> DataFrame:
    """``leaf, line, words`` of the longer lines whose leaf passes the filter, once each; ``words`` holds hashes, 0 for a variable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()  # lines that this task has handed on
        for batch in slices(batches):
            if len(told) > HELD_LINES:
                told.clear()
            new = {}
            for text in raw_texts(batch["text"]):
                for line in set(text.split(b"\n")):
                    words = line_words(line)
                    if len(words) > MIN_CONSTANT and eligible(words, min_words):
                        key = hashes(words, depth)
                        if key not in told:
                            new[key] = words
            if not new:
                continue
            keys = list(new)
            passed = bitfilter.holds(leaves.value, np.array([leaf for _, leaf in keys], np.uint64))
            keys = [key for key, ok in zip(keys, passed) if ok]
            told.update(keys)
            code = [[0 if w == VARIABLE else xxhash.xxh64_intdigest(w) - (1 << 63) for w in new[key]] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [_longs([leaf for _, leaf in keys]), _longs([line for line, _ in keys]), pa.array(code, pa.list_(pa.int64()))],
                names=["leaf", "line", "words"],
            )

    known = docs.filter("doc_id is not null").select("text")
    found = known.mapInArrow(returning_memory(run), "leaf bigint, line bigint, words array<bigint>")
    return found.groupBy("leaf", "line").agg(F.first("words").alias("words"))


def generalised(crowded: DataFrame, lines: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """``leaf, line, template`` for the lines that take a generalised form.

    Words are counted over distinct lines, each with the number of its documents: a line in many documents is one row.
    """
    docs_of = lines.select("doc_id", "leaf", "line").distinct().groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("docs"))
    counted = durable(crowded.join(docs_of, ["leaf", "line"]), "counted")
    placed = counted.select("leaf", "line", "docs", F.size("words").alias("n"), F.posexplode("words").alias("place", "word")).filter("word != 0")
    frequent = placed.groupBy("leaf", "place", "word").agg(F.sum("docs").alias("all")).filter(F.col("all") >= min_docs).drop("all")
    forms = (
        placed.join(frequent, ["leaf", "place", "word"])
        .groupBy("leaf", "line", "n")
        .agg(F.count(F.lit(1)).alias("constant"), F.bit_xor(F.xxhash64("place", "word")).alias("form"))
    )
    enough = (F.col("constant") >= MIN_CONSTANT) & (F.col("constant") >= F.col("n") * similarity)
    return forms.filter(enough).select("leaf", "line", F.xxhash64("leaf", "form").alias("template"))


def _recurring(rows: DataFrame, key: list[str], min_docs: int) -> DataFrame:
    """The ``key`` of lines in at least ``min_docs`` documents, with the first of these and their number ``n``."""
    docs_of = rows.select(*key, "doc_id").distinct()
    return docs_of.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).filter(F.col("n") >= min_docs)


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """``doc_id, line`` of every eligible line, and ``line, first, n``: lines to drop from every document after the first, and how many documents share the template."""
    lines = durable(scan(docs, depth, min_words), "lines")
    long = lines.filter("wide")
    crowd = long.groupBy("leaf").count().filter(F.col("count") >= min_docs)
    crowded = crowded_lines(docs, bitfilter.build(crowd, "leaf"), depth, min_words)
    templates = durable(generalised(crowded, long, min_docs, similarity), "templates")
    formed = durable(long.select("doc_id", "leaf", "line").join(templates, ["leaf", "line"]), "formed")
    by_form = templates.join(_recurring(formed, ["template"], min_docs), "template").select("line", "first", "n")
    found = _recurring(lines, ["leaf", "line"], min_docs).select("line", "first", "n").unionByName(by_form)
    return lines.select("doc_id", "line"), durable(found.groupBy("line").agg(F.min("first").alias("first"), F.max("n").alias("n")), "firsts")


def frequent(firsts: DataFrame, most: int) -> tuple[Broadcast, Column]:
    """Hashes, ascending, and first documents of the most frequent lines, and which rows of ``firsts`` these are."""
    # Half powers of two: some tens of rows.
    bucket = F.floor(2 * F.log2("n"))
    sizes = sorted(((r["bucket"], r["count"]) for r in firsts.groupBy(bucket.alias("bucket")).count().collect()), reverse=True)
    least, taken = None, 0
    for place, size in sizes:
        if (taken := taken + size) > most:
            break
        least = place
    held = F.lit(False) if least is None else bucket >= least
    found = firsts.filter(held).select("line", "first").toArrow()
    lines = found["line"].to_numpy().view(np.uint64)
    order = np.argsort(lines)
    return firsts.sparkSession.sparkContext.broadcast((lines[order], found["first"].to_numpy()[order])), held


def surplus_lines(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """``doc_id, lines``: hashes of the lines to drop from a document."""
    drop = lines.join(firsts.select("line", "first"), "line").filter("doc_id > first")
    return drop.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def drop_lines(docs: DataFrame, surplus: DataFrame, shared: Broadcast, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with cleaned ``text`` and the columns ``n_lines`` and ``n_removed``, as a struct beside the carried row.

    ``surplus`` has the lines of each document to drop beside those after their first document in ``shared``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, firsts = shared.value
        for batch in slices(batches):
            # Rows that may lose a line beside the shared ones come a second time, joined.
            joined = bitfilter.holds(touched.value, batch["h"].to_numpy().view(np.uint64)) & batch["free"].to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(~joined))
            if not batch.num_rows:
                continue
            ids, split, gone, codes, rows, places = batch["id"].to_pylist(), [], [], [], [], []
            for row, (text, drop) in enumerate(zip(raw_texts(batch["text"]), batch["lines"])):
                lines = text.split(b"\n")
                split.append(lines)
                gone.append(set())
                if ids[row] is None:
                    continue
                own = set(drop.values.to_numpy().view(np.uint64).tolist()) if drop.is_valid else ()
                for place, line in enumerate(lines):
                    words = line_words(line)
                    if eligible(words, min_words):
                        code = xxhash.xxh64_intdigest(b" ".join(words))
                        if code in own:
                            gone[row].add(place)
                        codes.append(code)
                        rows.append(row)
                        places.append(place)
            if codes and len(known):
                sought = np.array(codes, np.uint64)
                at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
                of = np.array([0 if i is None else i for i in ids], np.int64)[rows]
                for i in np.flatnonzero((known[at] == sought) & (of > firsts[at])).tolist():
                    gone[rows[i]].add(places[i])
            texts = [b"\n".join([line for place, line in enumerate(lines) if place not in out]) if out else b"\n".join(lines) for lines, out in zip(split, gone)]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(texts, pa.binary()).cast(pa.string()), pa.array([len(x) for x in split], pa.int64()), pa.array([len(x) for x in gone], pa.int64())],
                names=["row", "text", "n_lines", "n_removed"],
            )

    carried = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), docs["doc_id"].alias("id"), docs["text"].alias("text"))
    rows = rows.withColumn("h", F.coalesce(F.xxhash64("id"), F.lit(0).cast("bigint")))
    # Only rows that may lose a line beside the shared ones are moved to be joined; the others stay in the task that reads them.
    touched = bitfilter.build(surplus.select(F.xxhash64("doc_id").alias("h")).distinct(), "h")
    free = rows.select("row", "id", "text", "h", F.lit(None).cast("array<bigint>").alias("lines"), F.lit(True).alias("free"))
    held = bitfilter.members(rows, touched, "h").join(surplus.select(F.col("doc_id").alias("id"), "lines"), "id", "left")
    held = held.select("row", "id", "text", "h", "lines", F.lit(False).alias("free"))
    row_type = rows.schema["row"].dataType.simpleString()
    return free.unionByName(held).mapInArrow(returning_memory(run), f"row {row_type}, text string, n_lines bigint, n_removed bigint")


def dedup_lines(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, most: int = HELD_FIRSTS
) -> DataFrame:
    """``row`` (the other columns of ``docs``), cleaned ``text``, ``n_lines``, ``n_removed``."""
    lines, firsts = recurring_lines(docs, depth, min_docs, min_words, similarity)
    shared, held = frequent(firsts, most)
    return drop_lines(docs, durable(surplus_lines(lines, firsts.filter(~held)), "surplus"), shared, min_words)
