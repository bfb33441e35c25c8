"""Substring dedup: passages of at least ``WINDOW`` words that also begin in a document with a smaller id are removed.

1. Copies. Texts equal as a whole are found by their hash; all but the smallest id lose everything and take no further part.
2. Anchors. Every window of 13 words has an anchor, the smallest hash among its runs of ``ANCHOR`` words; equal windows have equal anchors. Spark counts
   the documents of each anchor. Those in two or more go into a filter of fixed size (see :mod:`bitfilter`).
3. Recurring passages. Windows whose anchor passes the filter are confirmed by their own hash over all documents. This gives, for each document, the
   earliest documents that it repeats.
4. Automata. The anchors of the repeated documents' recurring windows are compiled into Aho-Corasick automata over words, one per shard of
   documents. Each document streams through the automata of the shards it repeats from, which locate every occurrence; around it
   the windows are compared word by word.

A shard's documents are dealt out again in chunks, so the followers of one popular document never meet in one task. A window found in
a shard counts if its smallest document there is smaller than the reader; that is right whichever document led to the shard.

Defined cases: a null text has no words. Documents without id lose nothing and make nothing repeat. Rows with the same id are one document: they
do not repeat each other. Other columns are not looked at. An empty table gives an empty result. Missing an occurrence would
take no two equal hashes: unequal hashes of equal windows cannot be. Equal hashes of unequal windows only lead to a needless look.
"""

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm import bitfilter
from logloom.llm.text import raw_texts, returning_memory, sized_slices
from logloom.sources.durable import discard, durable

WINDOW, ANCHOR = 13, 7
#: Repeated documents per shard, and followers of a shard handled at once, on average; and the bytes of either, for longer texts.
SHARD_SOURCES, CHUNK_READERS, GROUP_BYTES = 64, 256, 8 << 20
HELD_WORDS = 100_000
#: Bytes of text taken apart at once.
AT_ONCE = 1 << 19
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


class WordHashes(dict):
    """Hash of a word, remembered; bounded by :meth:`trim`."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def trim(self) -> None:
        if len(self) > HELD_WORDS:
            self.clear()

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, length: int, family: int = 0, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of ``length`` words, or of those that begin ``at`` some places, from the hashes of its words in order."""
    n = len(words) - length + 1 if at is None else len(at)
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for offset in range(length):
            total = (total ^ (total >> np.uint64(32))) * _FACTORS[family] + (words[offset : offset + n] if at is None else words[at + offset])
        total = (total ^ (total >> np.uint64(31))) * _FACTORS[family + 1]
        return total ^ (total >> np.uint64(29))


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the word at which it begins; of equal runs the first."""
    runs = run_hashes(words, ANCHOR)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, offset = runs[:n].copy(), np.zeros(n, np.int64)
    for ahead in range(1, WINDOW - ANCHOR + 1):
        smaller = runs[ahead : ahead + n] < least
        offset[smaller] = ahead
        np.minimum(least, runs[ahead : ahead + n], out=least)
    return least, np.arange(n) + offset


def window_anchors(words: np.ndarray) -> np.ndarray:
    """The anchors alone; the words may be those of several documents in a row."""
    runs = run_hashes(words, ANCHOR)
    n = max(0, len(words) - WINDOW + 1)
    least = runs[:n].copy()
    for ahead in range(1, WINDOW - ANCHOR + 1):
        np.minimum(least, runs[ahead : ahead + n], out=least)
    return least


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, text``: hashes of the whole text."""
    return docs.select("doc_id", F.xxhash64("text", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"), "text")


def originals(batch: pa.RecordBatch, twice: Broadcast) -> pa.RecordBatch:
    """Without rows that are ``screened`` and whose text may have copies; the first of those comes in a row that is not screened."""
    doubtful = bitfilter.holds(twice.value, batch["h1"].to_numpy().view(np.uint64))
    return batch.filter(pa.array(~(doubtful & batch["screened"].to_numpy(zero_copy_only=False))))


def _by_windows(rows: DataFrame, schema: str, make, twice: Broadcast | None) -> DataFrame:
    """``make(word hashes, starts, document)`` gives columns for the documents of a batch, all words in a row: where each window begins, and of which document it is.

    Arrays over many documents at once, since a document alone is too short for them; the first column holds numbers of documents. With ``twice`` only :func:`originals`
    count, in the worker that has the texts already: another one before it would hold them a second time.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sized_slices(batches, "text", AT_ONCE):
            hashes.trim()
            if twice is not None:
                batch = originals(batch, twice)
            ids, words, lengths = [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), raw_texts(batch["text"])):
                own = text.split()
                if len(own) >= WINDOW:
                    ids.append(doc_id)
                    words += own
                    lengths.append(len(own))
            if ids:
                document = np.repeat(np.arange(len(ids)), lengths)
                starts = np.flatnonzero(document[: len(words) - WINDOW + 1] == document[WINDOW - 1 :])
                of, *columns = make(hashes.of(words), starts, document[starts])
                yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[of]), *[pa.array(c) for c in columns]], names=names)

    return rows.select("doc_id", "text", *["h1", "screened"] * (twice is not None)).mapInArrow(returning_memory(run), schema)


def document_anchors(rows: DataFrame, twice: Broadcast | None = None) -> DataFrame:
    """``doc_id, anchor``: windows side by side often have one anchor, which is told once."""

    def make(words: np.ndarray, starts: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = window_anchors(words)[starts]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (document[1:] != document[:-1])
        return document[new], least[new].view(np.int64)

    return _by_windows(rows, "doc_id bigint, anchor bigint", make, twice)


def suspects(rows: DataFrame, recurring: Broadcast, twice: Broadcast | None = None) -> DataFrame:
    """``doc_id, w1, w2``: each window once whose anchor may recur."""

    def make(words: np.ndarray, starts: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        passed = bitfilter.holds(recurring.value, window_anchors(words)[starts])
        at, of = starts[passed], document[passed]
        first = run_hashes(words, WINDOW, 1, at)
        order = np.lexsort((first, of))
        new = np.ones(len(order), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (of[order][1:] != of[order][:-1])
        once = order[new]
        second = run_hashes(words, WINDOW, 2, at[once]) >> np.uint64(32)
        return of[once], first[once].view(np.int64), second.astype(np.int64).astype(np.int32)

    return _by_windows(rows, "doc_id bigint, w1 bigint, w2 int", make, twice)


def repeats(found: DataFrame) -> DataFrame:
    """``reader, source``: documents and the earliest documents of the windows they repeat, each pair once."""
    first = found.groupBy("w1", "w2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).filter("source < last").drop("last")
    pairs = found.join(first, ["w1", "w2"]).filter("doc_id > source")
    return pairs.select(F.col("doc_id").alias("reader"), "source").distinct()


#: A word is spelled with three characters, one from each of three alphabets, so that no node of an automaton has many branches.
BASE, ALPHABETS = 48, (0x100, 0x200, 0x10000)


def spelling(number: int) -> str:
    """Three characters for a word's number; matches begin and end between words because the alphabets are disjoint."""
    high, low = divmod(number, BASE)
    high, middle = divmod(high, BASE)
    return chr(ALPHABETS[0] + low) + chr(ALPHABETS[1] + middle) + chr(ALPHABETS[2] + high)


def covered(readers: list[tuple[int, bytes]], sources: list[tuple[int, bytes]], useful) -> list[np.ndarray]:
    """Per reader (id and text), which of its words are in a window of a source with a smaller id. Only one text at a time is taken apart.

    ``useful(words)`` gives the windows of a source that are worth looking for and where their anchors begin. The anchors, a
    fraction of all runs, are the phrases of the automaton; around each of their occurrences in a reader the windows are compared in full.
    """
    names: dict[bytes, str] = {}
    windows: dict[str, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for doc_id, text in sorted(sources, key=lambda s: s[0], reverse=True):  # the smallest id stays as the value
        words = text.split()
        starts, places = useful(words)
        if not len(starts):
            continue
        for word in words:
            if word not in names:
                names[word] = spelling(len(names) + 1)
        spelled = "".join(map(names.__getitem__, words))
        for place in np.unique(places).tolist():
            automaton.add_word(spelled[3 * place : 3 * (place + ANCHOR)])
        for start in starts.tolist():
            windows[spelled[3 * start : 3 * (start + WINDOW)]] = doc_id
    automaton.make_automaton()
    unknown = spelling(0)
    marks = []
    for doc_id, text in readers:
        words = text.split()
        change = np.zeros(len(words) + 1, np.int64)
        if len(automaton):
            spelled = "".join([names.get(word, unknown) for word in words])
            looked = 0  # windows before this one have been compared
            for end, _ in automaton.iter(spelled):
                place = end // 3 - ANCHOR + 1
                for start in range(max(looked, place + ANCHOR - WINDOW), min(place, len(words) - WINDOW) + 1):
                    source = windows.get(spelled[3 * start : 3 * (start + WINDOW)])
                    if source is not None and source < doc_id:
                        change[start] += 1
                        change[start + WINDOW] -= 1
                looked = max(looked, place + 1)
        marks.append(np.cumsum(change)[:-1] > 0)
    return marks


def locate(texts: DataFrame, pairs: DataFrame, recurring: Broadcast) -> DataFrame:
    """``doc_id, h1, h2, mask``: one bit per word of a reader, for every shard that it repeats from.

    ``texts`` (``doc_id, h1, h2, text``) has every reader and source of ``pairs``.
    """
    sizes = durable(texts.groupBy("doc_id").agg(F.sum(F.length(F.col("text").cast("binary"))).alias("bytes")), "sizes")
    sources = pairs.select(F.col("source").alias("doc_id")).distinct()
    held = sources.join(sizes, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()  # two numbers
    shards = max(1, -(-held["n"] // SHARD_SOURCES), -(-held["bytes"] // GROUP_BYTES))
    shard = lambda column: F.pmod(F.xxhash64(column), F.lit(shards))
    routes = pairs.select(F.col("reader").alias("doc_id"), shard("source").alias("shard")).distinct()
    crowd = F.greatest(F.count(F.lit(1)) / CHUNK_READERS, F.sum("bytes") / GROUP_BYTES)
    chunks = routes.join(sizes, "doc_id").groupBy("shard").agg(F.ceil(crowd).alias("chunks"))
    chunks = durable(chunks, "chunks")
    routes = routes.join(chunks, "shard").withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(7)), "chunks")).select("doc_id", "shard", "chunk")
    homes = sources.withColumn("shard", shard("doc_id")).join(chunks, "shard")
    homes = homes.select("doc_id", "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"))
    # One join moves the texts for both roles.
    roles = routes.withColumn("reads", F.lit(True)).unionByName(homes.withColumn("reads", F.lit(False)))
    dealt = texts.join(roles, "doc_id")

    def run(group: pa.Table) -> pa.Table:
        left, right = group.filter(group["reads"]), group.filter(pc.invert(group["reads"]))
        hashes = WordHashes()

        def useful(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            least, places = anchors(hashes.of(words))
            starts = np.flatnonzero(bitfilter.holds(recurring.value, least))
            return starts, places[starts]

        readers, sources = (list(zip(part["doc_id"].to_pylist(), raw_texts(part["text"].combine_chunks()))) for part in (left, right))
        marks = covered(readers, sources, useful)
        hit = pa.array([bool(mark.any()) for mark in marks], pa.bool_())
        bits = pa.array([np.packbits(mark).tobytes() for mark in marks], pa.binary())
        return left.select(["doc_id", "h1", "h2"]).append_column("mask", bits).filter(hit)

    return dealt.groupBy("shard", "chunk").applyInArrow(run, "doc_id bigint, h1 bigint, h2 bigint, mask binary")


def parties(texts: DataFrame, twice: Broadcast, part: Broadcast) -> DataFrame:
    """``doc_id, h1, h2, text`` of the :func:`originals` whose hash of the id may be in ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, "text", AT_ONCE):
            own = originals(batch, twice)
            yield own.filter(pa.array(bitfilter.holds(part.value, own["h"].to_numpy().view(np.uint64)))).select(["doc_id", "h1", "h2", "text"])

    return texts.withColumn("h", F.xxhash64("doc_id")).mapInArrow(run, texts.select("doc_id", "h1", "h2", "text").schema)


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, masks, copy``: what to remove from each row that loses anything."""
    rows = keyed(docs).filter("doc_id is not null")
    names = durable(rows.select("doc_id", "h1", "h2"), "names")
    classes = names.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    classes = durable(classes.select("h1", "h2", "first"), "classes")
    copies = durable(names.join(classes, ["h1", "h2"]).filter("doc_id > first").select("doc_id", "h1", "h2").distinct(), "copies")
    twice = bitfilter.build(classes, "h1")
    # Texts that may have copies are few; of those only the first stays.
    doubtful = bitfilter.members(rows, twice, "h1")
    firsts = durable(doubtful.join(copies, ["doc_id", "h1", "h2"], "left_anti"), "firsts")
    texts = rows.withColumn("screened", F.lit(True)).unionByName(firsts.withColumn("screened", F.lit(False)))

    counted = document_anchors(texts, twice).groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    recurring = bitfilter.build(counted.filter("a < b"), "anchor")
    found = durable(suspects(texts, recurring, twice), "suspects")
    pairs = durable(repeats(found), "pairs")
    discard(found)
    part = pairs.select(F.explode(F.array("reader", "source")).alias("doc_id")).distinct().select(F.xxhash64("doc_id").alias("h"))
    concerned = durable(parties(texts, twice, bitfilter.build(part, "h")), "concerned")
    for read in (names, classes, firsts):
        discard(read)
    masks = durable(locate(concerned, pairs, recurring), "masks")
    discard(concerned)
    marks = masks.groupBy("doc_id", "h1", "h2").agg(F.collect_list("mask").alias("masks")).withColumn("copy", F.lit(False))
    empty = F.array().cast("array<binary>")
    return marks.unionByName(copies.withColumn("masks", empty).withColumn("copy", F.lit(True)))


def removed_words(n_words: int, masks: list[bytes], copy: bool) -> np.ndarray:
    if copy:
        return np.full(n_words, n_words >= WINDOW)
    gone = np.zeros(n_words, bool)
    for mask in masks:
        gone |= np.unpackbits(np.frombuffer(mask, np.uint8), count=n_words).astype(bool)
    return gone


def apply(docs: DataFrame, removal: DataFrame) -> DataFrame:
    """``doc_id, text, n_words, n_removed, kept_sha256`` for every row; ``text`` has the kept words, one blank between them.

    Only rows that may lose something are joined; the others never leave the task that reads them.
    """
    rows = keyed(docs).withColumn("h", F.coalesce(F.xxhash64("doc_id"), F.lit(0).cast("bigint")))
    touched = bitfilter.build(removal.select(F.xxhash64("doc_id").alias("h")).distinct(), "h")
    nothing = [F.lit(None).cast("array<binary>").alias("masks"), F.lit(False).alias("copy")]
    free = rows.select("doc_id", "text", "h", *nothing, F.lit(True).alias("free"))
    held = bitfilter.members(rows, touched, "h").join(removal, ["doc_id", "h1", "h2"], "left")
    held = held.select("doc_id", "text", "h", "masks", F.coalesce("copy", F.lit(False)).alias("copy"), F.lit(False).alias("free"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, "text", AT_ONCE):
            # Rows that may lose something come a second time, joined.
            joined = bitfilter.holds(touched.value, batch["h"].to_numpy().view(np.uint64)) & batch["free"].to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(~joined))
            if not batch.num_rows:
                continue
            out = []
            for text, masks, copy in zip(raw_texts(batch["text"]), batch["masks"].to_pylist(), batch["copy"].to_pylist()):
                words = text.split()
                kept, n = words, len(words)
                if masks or copy:
                    gone = removed_words(n, masks or [], copy)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                joined = b" ".join(kept)
                out.append((joined, n, n - len(kept), hashlib.sha256(joined).hexdigest()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(columns[0], pa.binary()).cast(pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                names=["doc_id", "text", "n_words", "n_removed", "kept_sha256"],
            )

    return free.unionByName(held).mapInArrow(returning_memory(run), "doc_id bigint, text string, n_words bigint, n_removed bigint, kept_sha256 string")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return apply(docs, durable(removals(docs), "removals"))
