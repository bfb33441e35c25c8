"""SentencePiece encoding and decoding by a Viterbi pass over the trie of distinct marked words.

Blanks become marks and a text is cut before every run of them, where no piece of the model can reach across. The distinct words of many
texts are sorted, which walks their trie depth-first: the forward states of a word are kept on a stack, and the next word starts from
the states of the prefix it shares with the last one.

The forward state of a prefix is the best last piece and where that piece begins. For a unigram model the best path has the
highest sum of scores. For a byte-pair model a path is admissible only if merging would leave each two neighbours apart; exactly
one path is, and it is what merging yields, so the ids equal those of the model's own encoder. Characters outside the
vocabulary become their bytes.

Defined cases: a null or empty text has no pieces. Decoding returns the text, except that marks (U+2581) in it come back as
blanks; ``round_trip`` says so. Rows are independent; other columns are not looked at; an empty table gives an empty result.
Only models with the identity normaliser, kept white space and byte fallback are accepted.
"""

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logloom.llm.text import returning_memory, sized_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHED_WORDS, BATCH_BYTES = 150_000, 4 << 20
UNIGRAM, BPE = 1, 2
NORMAL, BYTE = 1, 6
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: numbers as int, fixed 32-bit values as float, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack("<f" if size == 4 else "<d", data[at : at + size])[0]
            at += size


@dataclass
class Pieces:
    """A vocabulary. ``ranks`` orders merges (smaller first), ``splits`` has the two parts a piece is merged from last."""

    kind: int
    names: list[str]
    ids: dict[str, int]
    scores: dict[str, float]
    splits: dict[str, tuple[str, str]]
    bytes_at: list[int]

    @classmethod
    def read(cls, data: bytes) -> "Pieces":
        names, scores, kinds, trainer, normaliser = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                names.append(piece[1].decode())
                scores.append(piece.get(2, 0.0))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        kind = trainer.get(3, UNIGRAM)
        plain = not normaliser.get(2) and normaliser.get(4, 1) == 0 and normaliser.get(3, 1) == 1
        if kind not in (UNIGRAM, BPE) or not plain or not trainer.get(35) or set(kinds) - {NORMAL, 2, 3, BYTE}:
            raise ValueError("the model needs a normaliser, white-space rule or piece type that is not supported")
        ids = {name: i for i, name in enumerate(names) if kinds[i] == NORMAL}
        bytes_at = [names.index(f"<0x{b:02X}>") for b in range(256)]
        own = cls(kind, names, ids, {n: scores[i] for n, i in ids.items()}, {}, bytes_at)
        if kind == BPE:
            own._find_splits()
        return own

    def _find_splits(self) -> None:
        """The last merge of each piece; pieces that merging never makes leave the vocabulary."""
        for name in [n for n in self.ids if len(n) > 1]:
            parts = self.merge(name, stop=2)
            if len(parts) == 2:
                self.splits[name] = (parts[0], parts[1])
        for name in [n for n in self.ids if len(n) > 1 and n not in self.splits]:
            del self.ids[name]

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours, leftmost first, down to ``stop`` pieces."""
        parts = list(text)
        while len(parts) > stop:
            found = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the text of two pieces yields just these two.

        Merges are undone in reverse order on both sides; a merge across the border that comes before the one undone last
        would have happened first.
        """
        scores, splits = self.scores, self.splits
        limit = float("inf")
        while True:
            across = scores.get(left + right)
            if across is not None and -across < limit:
                return False
            one = -scores[left] if left in splits else -1.0
            two = -scores[right] if right in splits else -1.0
            if one < 0 and two < 0:
                return True
            if one > two:
                limit, left = one, splits[left][1]
            else:
                limit, right = two + 0.5, splits[right][0]

    def id_bytes(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        return [found] if found is not None else [self.bytes_at[b] for b in piece.encode("utf-8", "surrogatepass")]


def trie(pieces: Pieces) -> dict:
    """Pieces by their characters; a piece's own entry is under the empty string."""
    root: dict = {}
    for name in pieces.ids:
        node = root
        for char in name:
            node = node.setdefault(char, {})
        node[""] = name
    return root


def encode_words(words: Iterable[str], pieces: Pieces, root: dict | None = None, known: dict | None = None) -> Iterator[tuple[str, list[int]]]:
    """Ids of each distinct word, in sorted order. ``root`` is the trie of pieces, ``known`` remembers which neighbours stay apart."""
    known = {} if known is None else known
    root = trie(pieces) if root is None else root
    scores, bpe = pieces.scores, pieces.kind == BPE
    unseen = min(scores.values(), default=0.0) - 10.0
    # Per prefix: last piece, where it begins, sum of scores, and the pieces under way as (start, trie node).
    last, starts, sums, open_ends, before = [""], [0], [0.0], [[]], ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del last[shared + 1 :], starts[shared + 1 :], sums[shared + 1 :], open_ends[shared + 1 :]
        for at in range(shared, len(word)):
            char = word[at]
            live = [(start, onward) for start, node in open_ends[at] if (onward := node.get(char)) is not None]
            own = root.get(char)
            if own is not None:
                live.append((at, own))
            total, piece, begin = (-1e300, char, at) if bpe else (sums[at] + unseen, char, at)
            for start, node in live:
                name = node.get("")
                if name is None:
                    continue
                if bpe:
                    pair = (last[start], name)
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = start == 0 or pieces.apart(*pair)
                    if fits:
                        total, piece, begin = 0.0, name, start
                        break
                elif (score := sums[start] + scores[name]) > total:
                    total, piece, begin = score, name, start
            last.append(piece)
            starts.append(begin)
            sums.append(total)
            open_ends.append(live)
        before = word
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at = starts[at]
        ids: list[int] = []
        for piece in reversed(path):
            ids += pieces.id_bytes(piece)
        yield word, ids


def marked_words(text: str) -> list[str]:
    if not text:
        return []
    if text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text:
        return [MARK + word for word in text.split(" ")]
    return _WORDS.findall(MARK + text.replace(" ", MARK))


class RecentWords:
    """Remembers the last ``most`` to ``2 * most`` distinct words asked for.

    Words move to the younger of two halves whenever they are asked for; when that is full the older half is forgotten. Frequent
    words stay, rare ones pass through.
    """

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def unknown(self, words: set[str]) -> list[str]:
        """The words not remembered; the others are now in the younger half."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        new = []
        for word in words.difference(self.young):
            found = self.old.get(word)
            if found is None:
                new.append(word)
            else:
                self.young[word] = found
        return new


def byte_table(pieces: Pieces) -> list[bytes]:
    """What each id stands for."""
    table = [name.encode() for name in pieces.names]
    for byte, i in enumerate(pieces.bytes_at):
        table[i] = bytes([byte])
    return table


def decode(ids: list[int], table: list[bytes]) -> str:
    """The text of a list of ids; bytes that are no text become replacement characters."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ").removeprefix(" ")


def encode(docs: DataFrame, model: str = MODEL, cached_words: int = CACHED_WORDS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_tokens, token_ids, round_trip`` for every row of ``docs``.

    The vocabulary, half a megabyte, is read once by the driver and sent to the tasks. A task remembers ``cached_words`` words, twice as many at most, and takes
    ``batch_bytes`` of text at once: with less it takes less memory and more time.
    """
    with open(model, "rb") as file:
        pieces = Pieces.read(file.read())
    plain = (pieces.kind, pieces.names, pieces.ids, pieces.scores, pieces.splits, pieces.bytes_at)
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shared.value)
        seen = RecentWords(cached_words)
        apart: dict[tuple[str, str], bool] = {}
        inexact: set[str] = set()
        root, table = trie(pieces), byte_table(pieces)
        for batch in sized_slices(batches, "text", batch_bytes):
            texts = [text or "" for text in batch["text"].to_pylist()]
            words = [marked_words(text) for text in texts]
            if len(apart) > 4 * cached_words:
                apart.clear()
            for word, ids in encode_words(seen.unknown(set().union(*words)), pieces, root, apart):
                seen.young[word] = np.array(ids, np.int32).tobytes()
                # Words in a row are the marked text, so a text comes back if all of its words do.
                if b"".join([table[i] for i in ids]) != word.encode("utf-8", "surrogatepass"):
                    inexact.add(word)
            ids = [np.frombuffer(b"".join(map(seen.young.__getitem__, own)), np.int32) for own in words]
            same = [MARK not in text and inexact.isdisjoint(own) for text, own in zip(texts, words)]
            lengths = np.array([len(own) for own in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(lengths), pa.ListArray.from_arrays(offsets, values), pa.array(same)],
                names=["doc_id", "n_tokens", "token_ids", "round_trip"],
            )

    return docs.select("doc_id", "text").mapInArrow(returning_memory(run), "doc_id bigint, n_tokens bigint, token_ids array<int>, round_trip boolean")
