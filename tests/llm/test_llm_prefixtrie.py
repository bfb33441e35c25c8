import hashlib
import random
import zlib

import pytest
from llm_cases import clashing

from logloom.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_hand(rows):
    """The trie by plain loops over all prefixes of all conversations."""
    original: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [row[2:] for row in sorted(own)] for c, own in original.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members: dict[tuple, list[int]] = {}
    for c, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(c)
    children: dict[tuple, int] = {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    saved = dict.fromkeys(members, 0)
    leaves = dict.fromkeys(members, 0)
    for path, own in members.items():
        more = (len(own) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += more
            leaves[path[:depth]] += path not in children
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(path))
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(table):
    return sorted((tuple(row) for row in table.select(*COLUMNS).collect()), key=repr)


def drawn(seed, n=120, most=14, texts=3):
    """Conversations over few texts, so that prefixes of all lengths are shared."""
    draw = random.Random(seed)
    rows = []
    for conv in range(-7, n):
        for turn in range(draw.choice([1, 2, 5, most])):
            text = draw.choice(["", "é" * 3, "plain"][:texts])
            rows.append((conv, turn, "user" if turn % 2 else "assistant", text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, texts, size", [(1, 3, 4), (2, 1, 4), (3, 2, 1)])
def test_equals_brute_force(spark, seed, texts, size):
    rows = drawn(seed, texts=texts)
    assert found(prefixtrie.conversation_trie(conversations(spark, rows), size)) == by_hand(rows)


def test_hot_nodes_by_broadcast_or_by_shuffle(spark):
    rows = drawn(5)
    table = conversations(spark, rows)
    assert found(prefixtrie.conversation_trie(table, hot=1)) == found(prefixtrie.conversation_trie(table, hot=10**9)) == by_hand(rows)


def test_copies_and_a_long_conversation(spark):
    rows = [(conv, turn, "user", f"turn {turn}") for conv in range(300) for turn in range(6)]
    rows += [(1000, turn, "user", f"turn {turn}") for turn in range(200)]
    assert found(prefixtrie.conversation_trie(conversations(spark, rows))) == by_hand(rows)


def test_ends_are_hashed_in_chunks(spark):
    ends = spark.createDataFrame([((1, 2), c) for c in range(-40, 1000)] + [((1, 3), 7)], "key struct<k1:bigint,k2:bigint>, conv_id bigint")
    digests = {tuple(r["key"]): r["ends_sha256"] for r in prefixtrie.ends_digest(ends, 16).collect()}
    assert digests == {(1, 2): hashlib.sha256(",".join(map(str, range(-40, 1000))).encode()).hexdigest(), (1, 3): hashlib.sha256(b"7").hexdigest()}


def test_messy_rows(spark):
    rows = [
        (5, None, None, None), (5, None, None, None), (5, 1, "user", None), (5, 1, "assistant", "x"), (6, 0, "", ""), (None, 0, "user", "lost"),
        (7, 2, "user", "x" * 100_000), (7, 2, "user", "x" * 100_000), (8, -3, None, "é"), (9, 0, "user", "a"), (14, 0, "user", "a"),
    ]
    table = clashing(conversations(spark, rows), "key", "at", "depth", "n", "bytes", "block", "_at")
    assert found(prefixtrie.conversation_trie(table)) == by_hand(rows)


def test_empty_table(spark):
    result = prefixtrie.conversation_trie(conversations(spark, []))
    assert result.collect() == [] and result.columns == COLUMNS


def test_types(spark):
    result = prefixtrie.conversation_trie(conversations(spark, [(1, 0, "user", "a")]))
    assert {t for c, t in result.dtypes if c != "ends_sha256"} == {"bigint"}


def test_whole_table(spark):
    from llm_cases import SF

    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert found(prefixtrie.conversation_trie(table)) == by_hand([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
