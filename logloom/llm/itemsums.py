"""Counts of the items of texts, and sums of item values over texts, whatever the number of distinct items.

Items are counted in the task that reads the texts, so that what moves is one row per task and distinct item. Of the values that follow from the counts those
of the most frequent items, at most ``HELD_ITEMS``, are broadcast as two sorted arrays of numbers and summed in the task that reads the texts again. All other
items of a row, few since they are rare, are joined to the table of values by their hash of 64 bits.

Values are whole numbers, so that sums do not depend on their order. Which items are held changes the way, never the result.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.itemblocks import Numbers, as_text
from logloom.llm.text import returning_memory, sized_slices, slices
from logloom.sources.durable import discard, durable

#: Values broadcast, 16 bytes each.
HELD_ITEMS = 1 << 20
#: Distinct items a task remembers before it hands on what it has counted.
TASK_ITEMS = 200_000
SPARK_SEED = 42
_NO_LANG = "\0"

#: Characters of texts taken apart at once.
AT_ONCE = 1 << 19

Split = Callable[[str], list[bytes]]
#: Gets texts, gives a hash of 64 bits for each of their items, how many items a text has, and what spells the items at given places.
SplitAll = Callable[[list[str]], tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], list[bytes]]]]
Measure = Callable[[str, list[bytes], np.ndarray], tuple[tuple, int]]


def item_hash(lang: str, item: str) -> Column:
    """Items are told apart by 64 bits of language and characters."""
    return F.xxhash64(F.coalesce(F.col(lang), F.lit(_NO_LANG)), F.col(item))


class Items:
    """The items that a task has met, numbered."""

    def __init__(self):
        self.names: list[bytes] = []
        self.langs: list[str | None] = []
        self.by_lang: dict[str | None, Numbers] = {}

    def numbers(self, lang: str | None, items: list[bytes]) -> np.ndarray:
        own = self.by_lang.get(lang)
        if own is None:
            own = self.by_lang[lang] = Numbers(self.names)
        found = np.fromiter(map(own.__getitem__, items), np.int64, len(items))
        self.langs += [lang] * (len(self.names) - len(self.langs))
        return found

    def hashes(self, start: int) -> np.ndarray:
        """:func:`item_hash` of the items from a number on."""
        seeds = {lang: xxhash.xxh64_intdigest((_NO_LANG if lang is None else lang).encode(), SPARK_SEED) for lang in self.by_lang}
        return np.fromiter((xxhash.xxh64_intdigest(name, seeds[lang]) for lang, name in zip(self.langs[start:], self.names[start:])), np.uint64, len(self.names) - start).view(np.int64)


def _longer(values: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([values, np.zeros(n - len(values), values.dtype)])


def counted(rows: DataFrame, split: Split, measure: Measure | None = None, weight: str | None = None, most: int = TASK_ITEMS) -> DataFrame:
    """``lang, item, n, m`` over all ``rows`` (``text``, ``lang``): how often an item is in the texts, and the same with each text counted as often as it weighs.

    ``split`` gives the items of a text in order. ``measure`` gets the text, its items and their numbers, and its second result is what the text weighs; with ``weight`` a
    column says that. With neither a text weighs nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, m = Items(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches):
            parts, lengths, weights = [], [], []
            own = batch[weight].to_pylist() if weight else [None] * batch.num_rows
            for text, lang, weighs in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), own):
                items = split(text or "")
                numbers = held.numbers(lang, items)
                parts.append(numbers)
                lengths.append(len(numbers))
                weights.append(weighs if weight else measure(text or "", items, numbers)[1] if measure else 0)
            numbers, n, m = np.concatenate([*parts, np.zeros(0, np.int64)]), _longer(n, len(held.names)), _longer(m, len(held.names))
            n += np.bincount(numbers, minlength=len(n))
            np.add.at(m, numbers, np.repeat(np.array(weights, np.int64), lengths))
            if len(n) >= most:
                yield from handed(held, n, m)
                held, n, m = Items(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield from handed(held, n, m)

    def handed(held: Items, n: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(n), 10_000):
            part = slice(start, start + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(held.langs[part], pa.string()), as_text(held.names[part]), pa.array(n[part]), pa.array(m[part])], names=["lang", "item", "n", "m"])

    told = rows.select("text", "lang", *[weight] * bool(weight)).mapInArrow(returning_memory(run), "lang string, item string, n bigint, m bigint")
    return told.groupBy("lang", "item").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, about ``AT_ONCE`` bytes of text at once or one text."""
    held, size = [], 0
    for batch in batches:
        for part in sized_slices([batch], "text", AT_ONCE):
            held.append(part)
            size += part["text"].nbytes
            if size >= AT_ONCE:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _of_langs(langs: list[str | None]) -> dict[str | None, np.ndarray]:
    """Places of each language."""
    places: dict[str | None, list[int]] = {}
    for place, lang in enumerate(langs):
        places.setdefault(lang, []).append(place)
    return {lang: np.array(own) for lang, own in places.items()}


def counted_at_once(rows: DataFrame, split: SplitAll, weight: str) -> DataFrame:
    """What :func:`counted` gives with a ``weight``, for short texts of many items: many texts are taken apart at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            texts, weights = table["text"].to_pylist(), table[weight].to_numpy()
            for lang, places in _of_langs(table["lang"].to_pylist()).items():
                keys, lengths, spelled = split([texts[i] or "" for i in places])
                order = np.argsort(keys, kind="stable")
                starts = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
                if not len(starts):
                    continue
                n = np.diff(np.append(starts, len(order)))
                m = np.add.reduceat(np.repeat(weights[places], lengths)[order], starts)
                names = pa.array(spelled(order[starts]), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), names, pa.array(n.astype(np.int64)), pa.array(m.astype(np.int64))], names=["lang", "item", "n", "m"])

    told = rows.select("text", "lang", weight).mapInArrow(returning_memory(run), "lang string, item string, n bigint, m bigint")
    return told.groupBy("lang", "item").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def summed_at_once(rows: DataFrame, values: DataFrame, split: SplitAll, most: int = HELD_ITEMS) -> DataFrame:
    """What :func:`summed` gives without figures, for short texts of many items: many texts are taken apart at once."""
    shared, held = frequent(values, most)
    carried = [c for c in rows.columns if c != "text"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(["row_id bigint", *[f"{c} {types[c]}" for c in carried], "s0 bigint", "rest array<struct<h:bigint,n:bigint>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 33
        known, known_values = shared.value
        for table in _gathered(batches):
            texts, sums = table["text"].to_pylist(), np.zeros(table.num_rows, np.int64)
            far_rows, far_hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lang, places in _of_langs(table["lang"].to_pylist()).items():
                keys, lengths, spelled = split([texts[i] or "" for i in places])
                _, first, number = np.unique(keys, return_index=True, return_inverse=True)
                seed = xxhash.xxh64_intdigest((_NO_LANG if lang is None else lang).encode(), SPARK_SEED)
                hashes = np.fromiter((xxhash.xxh64_intdigest(name, seed) for name in spelled(first)), np.uint64, len(first)).view(np.int64)
                at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                there = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                worth = np.where(there, known_values[at], 0) if len(known) else np.zeros(len(hashes), np.int64)
                sums[places] = np.diff(np.concatenate([[0], np.cumsum(worth[number])])[np.cumsum(lengths)], prepend=0)
                far = np.flatnonzero(~there[number])
                far_rows.append(np.repeat(places, lengths)[far])
                far_hashes.append(hashes[number[far]])
            row, far = np.concatenate(far_rows), np.concatenate(far_hashes)
            order = np.lexsort((far, row))
            row, far = row[order], far[order]
            starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (far[1:] != far[:-1]))[: len(row)])
            times = np.diff(np.append(starts, len(row)))
            rest_ends = np.searchsorted(row[starts], np.arange(table.num_rows + 1))
            rest = pa.StructArray.from_arrays([pa.array(far[starts]), pa.array(times.astype(np.int64))], ["h", "n"])
            ids = pa.array(np.arange(row_id, row_id + table.num_rows))
            row_id += table.num_rows
            own = table.combine_chunks()
            yield from pa.table(
                [ids, *[own[c] for c in carried], pa.array(sums), pa.ListArray.from_arrays(pa.array(rest_ends.astype(np.int32)), rest)], names=["row_id", *carried, "s0", "rest"]
            ).to_batches()

    return _with_rest(durable(rows.mapInArrow(returning_memory(run), schema), "sums"), values.filter(~held), carried)


def _with_rest(stored: DataFrame, values: DataFrame, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of a stored table and ``s0`` with the values of its ``rest`` added. Stored; the other table goes."""
    rest = stored.select("row_id", F.explode("rest").alias("x")).select("row_id", "x.h", F.col("x.n").alias("times"))
    met = rest.join(values.select(item_hash("lang", "item").alias("h"), F.col("s0").alias("value")), "h")
    more = met.groupBy("row_id").agg(F.sum(F.col("times") * F.col("value")).alias("more"))
    found = stored.drop("rest").join(more, "row_id", "left").select(*kept, (F.col("s0") + F.coalesce("more", F.lit(0))).alias("s0"))
    found = durable(found, "summed")
    discard(stored)
    return found


def frequent(values: DataFrame, most: int) -> tuple[Broadcast, Column]:
    """Hashes, ascending, and values of the most frequent items, and which rows of ``values`` these are."""
    # Half powers of two: some tens of rows.
    bucket = F.floor(2 * F.log2("n"))
    sizes = sorted(((r["bucket"], r["count"]) for r in values.groupBy(bucket.alias("bucket")).count().collect()), reverse=True)
    least, taken = None, 0
    for place, size in sizes:
        if (taken := taken + size) > most:
            break
        least = place
    held = F.lit(False) if least is None else bucket >= least
    found = values.filter(held).select(item_hash("lang", "item").alias("h"), "s0").toArrow()
    hashes, order = np.unique(found["h"].to_numpy(), return_index=True)
    return values.sparkSession.sparkContext.broadcast((hashes, found["s0"].to_numpy()[order])), held


def summed(rows: DataFrame, values: DataFrame, split: Split, measure: Measure, figures: str, most: int = HELD_ITEMS, held_in_task: int = TASK_ITEMS) -> DataFrame:
    """The columns of ``rows`` but ``text``, the ``figures`` that ``measure`` gives first, and ``s0``, the sum of the values of a text's items. Stored.

    ``values`` has ``lang, item, n, s0``, one row per language and item. An item without a row counts nothing.
    """
    shared, held = frequent(values, most)
    carried = [c for c in rows.columns if c != "text"]
    made = [f.split()[0] for f in figures.split(", ")]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(["row_id bigint", *[f"{c} {types[c]}" for c in carried], figures, "s0 bigint", "rest array<struct<h:bigint,n:bigint>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 33
        known, known_values = shared.value
        items, hashes, worth, there = Items(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in slices(batches):
            parts, lengths, told = [], [], []
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                own = split(text or "")
                numbers = items.numbers(lang, own)
                parts.append(numbers)
                lengths.append(len(numbers))
                told.append(measure(text or "", own, numbers)[0])
            new = items.hashes(len(hashes))
            at = np.minimum(np.searchsorted(known, new), max(len(known) - 1, 0))
            met = known[at] == new if len(known) else np.zeros(len(new), bool)
            hashes, there = np.concatenate([hashes, new]), np.concatenate([there, met])
            worth = np.concatenate([worth, np.where(met, known_values[at], 0) if len(known) else np.zeros(len(new), np.int64)])
            numbers, ends = np.concatenate(parts), np.cumsum(lengths)
            sums = np.diff(np.concatenate([[0], np.cumsum(worth[numbers])])[ends], prepend=0)
            far = np.flatnonzero(~there[numbers])
            row = np.repeat(np.arange(len(lengths)), lengths)[far]
            pairs, times = np.unique(row * len(hashes) + numbers[far], return_counts=True)
            rest_ends = np.searchsorted(pairs, np.arange(len(lengths) + 1) * len(hashes))
            rest = pa.StructArray.from_arrays([pa.array(hashes[pairs % max(len(hashes), 1)]), pa.array(times.astype(np.int64))], ["h", "n"])
            ids = pa.array(np.arange(row_id, row_id + len(told)))
            row_id += len(told)
            yield pa.RecordBatch.from_arrays(
                [ids, *[batch[c] for c in carried], *[pa.array(column, pa.int64()) for column in zip(*told)], pa.array(sums), pa.ListArray.from_arrays(pa.array(rest_ends.astype(np.int32)), rest)],
                names=["row_id", *carried, *made, "s0", "rest"],
            )
            if len(hashes) > held_in_task:
                items, hashes, worth, there = Items(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    return _with_rest(durable(rows.mapInArrow(returning_memory(run), schema), "sums"), values.filter(~held), [*carried, *made])
