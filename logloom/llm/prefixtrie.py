"""Conversation prefix trie by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK`` turns. A block's digest covers its turns and their depths; the digests of a conversation's blocks up to
one of them name the prefix that ends there. Conversations are grouped by these prefixes first. A prefix that all go on from with the same block
needs no more: every depth inside that block has the members of the block. Only blocks in which siblings diverge are opened, and their
turn boundaries found by grouping the turns of the *distinct* blocks, each with its number of conversations.

Digests are two independent 64-bit hashes of depth, role and text, combined by exclusive-or, so that a node has the same name
whether it is reached by blocks or by turns.

Figures over a subtree come without walking it. Every node belongs to the smallest conversation that has it, and these nodes are the last ones of that
conversation's path. So what a conversation shares below a depth follows from its bytes from there on less the bytes of the nodes it owns, and sums
over the distinct conversations of a node. Work and shuffles grow with the number of turns, not with the depth of the trie.

Scale: a turn moves as its digest and size, never as text. Turns are numbered by ranges, so a very long conversation is several tasks;
its *blocks* are added up by a window, which spills. Frequent nodes are sums combined before the shuffle. Nodes with more than ``1 / HOT`` of all
children are looked up by a broadcast, of which there are fewer than ``HOT``. Members' ids are joined in chunks; SHA-256 has no parallel form, so the chunks of one node
pass through one task as a stream, ``CHUNK`` ids a row.

Defined cases: turns are ordered by ``turn``, null first, then role, then digest; repeated rows are turns of their own. Null role or text is empty. Rows
without ``conv_id`` belong to no conversation. A conversation without turns of its own after the rule is applied still exists and is a member of the
root. Other columns are not looked at. An empty table has no conversation and no node, not even the root.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.hotkeys import HOT, looked_up
from logloom.llm.numbering import numbered
from logloom.sources.durable import durable

BLOCK, CHUNK = 4, 4096
GROUP, HEADS = 5, 9
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, t1, t2, bytes``: every turn with its place from 1, two digests of role and text, and the UTF-8 bytes of its text."""
    role, text = F.coalesce(conversations["role"], F.lit("")), F.coalesce(conversations["text"], F.lit(""))
    turns = conversations.filter(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].alias("conv_id"), conversations["turn"].alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(text, F.lit(2), role).alias("t2"),
        F.length(text.cast("binary")).cast("bigint").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2")]
    placed = numbered(turns, ["conv_id"], order, "place")
    return placed.select("conv_id", (F.col("place") + 1).alias("at"), "t1", "t2", "bytes")


def shared_heads(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Rebuilt conversations: the first h turns of the first conversation of a group of ids, then a conversation's own turns after its first h.

    ``turns`` as :func:`ordered_turns` gives them. h is the checksum of the id modulo ``heads``. Adds ``(conv_id, 0)`` rows without digest for
    conversations, so that one without turns is not lost. At most ``heads - 1`` turns of a first conversation are copied, for fewer than two
    groups of ids.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    turns = durable(turns, "turns")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    convs = durable(convs, "conversations")
    first = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = durable(convs.join(first, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))), "conversations")
    heads_of = convs.filter("head > 0").select(F.col("conv_id").alias("to"), "base", "head")
    copied = turns.filter(F.col("at") < heads).join(heads_of, F.col("conv_id") == F.col("base")).filter("at <= head").select(F.col("to").alias("conv_id"), "at", "t1", "t2", "bytes")
    known = convs.select(F.col("conv_id").alias("key"), "h", "head")
    own = looked_up(turns.filter(F.col("at") > h), "conv_id", known, convs.select(F.col("conv_id").alias("key"), "n"))
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("head")).alias("at"), "t1", "t2", "bytes")
    none = convs.select("conv_id", F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("t1"), F.lit(None).cast("bigint").alias("t2"), F.lit(0).cast("bigint").alias("bytes"))
    return copied.unionByName(own).unionByName(none)


def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per conversation and block, with the turns of the block and the names of the prefixes before (``q``) and after (``p``) it.

    ``turns`` has rows ``(conv_id, at = 0)`` too, which make block 0 of every conversation: its prefix is the root.
    """
    x1 = F.when(F.col("at") > 0, F.xxhash64("at", "t1")).otherwise(0)
    x2 = F.when(F.col("at") > 0, F.xxhash64("t2", "at")).otherwise(0)
    cut = turns.select("conv_id", F.ceil(F.col("at") / size).alias("block"), "at", x1.alias("x1"), x2.alias("x2"), "bytes")
    grouped = cut.groupBy("conv_id", "block").agg(
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.sum("bytes").alias("held"),
        F.sort_array(F.collect_list(F.struct("at", "x1", "x2", "bytes"))).alias("turns"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("block")
    after = F.struct(F.bit_xor("b1").over(so_far).alias("k1"), F.bit_xor("b2").over(so_far).alias("k2"))
    named = grouped.withColumn("p", after).withColumn("upto", F.sum("held").over(so_far)).withColumn("last", F.lead("block").over(so_far).isNull())
    before = F.struct(F.col("p.k1").bitwiseXOR(F.col("b1")).alias("k1"), F.col("p.k2").bitwiseXOR(F.col("b2")).alias("k2"))
    return named.withColumn("q", before).select("conv_id", "block", "q", "p", "turns", "upto", "last")


def opened(turns: str = "turns", start: str = "q") -> Column:
    """Nodes along a block: ``key, parent, depth, bytes`` of every turn, from the turns and the prefix before the block."""
    return F.expr(f"""
        transform({turns}, (t, i) -> named_struct(
          'key', aggregate(slice({turns}, 1, i + 1), {start}, (s, x) -> named_struct('k1', s.k1 ^ x.x1, 'k2', s.k2 ^ x.x2)),
          'parent', aggregate(slice({turns}, 1, i), {start}, (s, x) -> named_struct('k1', s.k1 ^ x.x1, 'k2', s.k2 ^ x.x2)),
          'depth', t.at, 'bytes', t.bytes))""")


def nodes_of(cut: DataFrame, hot: int = HOT) -> DataFrame:
    """``key, parent, depth, bytes, n, conv_id`` for every node but the root, of conversations cut by :func:`blocks`."""
    variants = cut.filter("block > 0").groupBy("q", "p").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"))
    variants = durable(variants, "variants")
    # A prefix that goes on with one block only is not opened: its members are those of the block at every depth.
    ways = durable(variants.groupBy(F.col("q").alias("key")).agg(F.count(F.lit(1)).alias("n")), "ways")
    known = looked_up(variants, "q", ways.withColumnRenamed("n", "ways"), ways, hot).withColumn("node", F.explode(opened()))
    whole = known.filter("ways = 1").select("node.*", "n", "conv_id")
    split = known.filter("ways > 1").groupBy("node.key").agg(
        F.first("node.parent").alias("parent"), F.first("node.depth").alias("depth"), F.first("node.bytes").alias("bytes"),
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"),
    )
    return whole.unionByName(split)


def trie(turns: DataFrame, size: int = BLOCK, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """Every node of the trie of conversations, one row each; ``turns`` as :func:`shared_heads` gives them.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    cut = durable(blocks(turns, size), "blocks")
    root = F.struct(F.lit(0).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2"))
    top = cut.filter("block = 0").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0")
    top = top.select(root.alias("key"), F.lit(None).cast(root_type()).alias("parent"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("bytes"), "n", "conv_id")
    nodes = durable(nodes_of(cut, hot).unionByName(top), "nodes")

    # Distinct conversations: where they end, how often they occur, and how many nodes their smallest member owns.
    ends = durable(cut.filter("last").select(F.col("p").alias("key"), "conv_id", F.col("upto").alias("size")), "ends")
    children = durable(nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n")), "children")
    owned = nodes.filter("depth > 0").groupBy("conv_id").agg(F.sum("bytes").alias("own_bytes"), F.min("depth").alias("own_from"))
    kinds = ends.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv_id"), F.first("size").alias("size"))
    kinds = kinds.join(children, "key", "left").withColumn("leaf", F.col("n").isNull().cast("bigint")).drop("n", "key").join(owned, "conv_id", "left")
    paths = cut.select("conv_id", "block", "q", "turns", "upto").join(kinds, "conv_id").withColumn("node", F.explode(opened("turns", "q")))
    # Bytes of the conversation from a turn on: all, less those up to the block's end, plus those of the block from the turn on.
    here = F.expr("aggregate(filter(turns, x -> x.at >= node.depth), 0L, (s, x) -> s + x.bytes)")
    onward = F.col("size") - F.col("upto") + here
    mine = F.coalesce(F.when(F.col("own_from") >= F.col("node.depth"), F.col("own_bytes")).otherwise(onward), F.lit(0))
    mine = F.when(F.col("own_from").isNull(), 0).otherwise(mine)
    below = paths.select("node.key", (F.col("copies") * onward - mine).alias("saved"), "leaf")
    below = below.groupBy("key").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    parents = nodes.select("key", F.col("conv_id").alias("parent_conv_id"))
    topped = looked_up(nodes.filter("depth > 0"), "parent", parents, children, hot)
    topped = topped.unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    found = topped.join(below, "key").join(children.withColumnRenamed("n", "n_children"), "key", "left").join(ends_digest(ends, chunk), "key", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def root_type() -> str:
    return "struct<k1:bigint,k2:bigint>"


def ends_digest(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``key, ends_sha256`` for nodes at which conversations end: the digest of their ids, ascending, joined by commas.

    Ids are numbered within their node, gathered ``chunk`` at a time, and the chunks of a node hashed one after the other.
    """
    flat = ends.select(F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"), "conv_id")
    placed = numbered(flat, ["k1", "k2"], [F.col("conv_id")], "place")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = placed.groupBy("k1", "k2", F.floor(F.col("place") / chunk).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), batch["ids"].to_pylist()):
                if (k1, k2) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (k1, k2), hashlib.sha256(ids.encode())
            yield rows(done)
        if now is not None:
            yield rows([(*now, digest.hexdigest())])

    def rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        k1, k2, digests = ([row[i] for row in done] for i in range(3))
        return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digests, pa.string())], names=["k1", "k2", "ends_sha256"])

    streamed = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "chunk").mapInArrow(run, "k1 bigint, k2 bigint, ends_sha256 string")
    return streamed.select(F.struct("k1", "k2").alias("key"), "ends_sha256")


def conversation_trie(conversations: DataFrame, size: int = BLOCK, hot: int = HOT) -> DataFrame:
    """Contract of the operator: the nodes of the trie of rebuilt conversations."""
    return trie(shared_heads(ordered_turns(conversations)), size, hot)
