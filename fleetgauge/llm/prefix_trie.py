"""Prefix trie of conversations, found by blocks of turns before single turns.

A turn's hash knows its depth, and a prefix is the exclusive-or of its turns' hashes (128
bits), so that prefixes of a conversation of any length come from running totals over
splits of it, never from one task. Conversations are first grouped by the digests of
successive blocks of a few turns. Where all that share a prefix go on with the same block,
the turns inside it are nodes with the same members and are written down as they are. Only
where the blocks differ are their turns regrouped one by one, and by distinct block, not
by conversation.

Sums over a subtree need no walk down the trie: each node belongs to the smallest
conversation in it, and such conversations carry their nodes' sums along the same blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.tiles import bound_batches
from fleetgauge.operators.ordered import POSITION, SPLIT, SPLIT_BITS, in_order
from fleetgauge.session import materialise

# Turns of a block.
BLOCK = 4
# Blocks of a conversation that its weights are sent to at once.
STRIDE = 1 << 12
# A node with more children has them joined to it where they are, without a shuffle, as
# long as there are not too many such nodes for a broadcast.
MANY_CHILDREN = 10_000
BROADCAST_NODES = 1 << 19
# Conversation ids of one row on the way to a node's digest.
IDS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"
NODE = ("depth", "a", "b")
FROM = ("up", "up_a", "up_b")


def _xor(total: Column, value: Column) -> Column:
    return total.bitwiseXOR(value)


def running(ordered: DataFrame, key: str, totals: dict[str, tuple]) -> DataFrame:
    """Add the total of the rows before each, by key, in the order that ``in_order`` gave.

    ``totals`` has for each new column an expression, its aggregate and how two totals are
    put together; 0 stands before the first row. A split of rows is summed by itself, and
    one row for each split and key tells what lies before it.
    """
    splits = ordered.groupBy(SPLIT, key).agg(*[sums(value).alias(f"_{c}") for c, (value, sums, _) in totals.items()])
    earlier = Window.partitionBy(key).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(SPLIT, key, *[F.coalesce(sums(F.col(f"_{c}")).over(earlier), F.lit(0)).alias(f"_{c}") for c, (_, sums, _) in totals.items()])
    inside = Window.partitionBy(SPLIT, key).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    rows = ordered.withColumns({c: F.coalesce(sums(value).over(inside), F.lit(0)) for c, (value, sums, _) in totals.items()})
    rows = rows.join(splits, [SPLIT, key])
    rows = rows.withColumns({c: both(F.col(c), F.col(f"_{c}")) for c, (_, _, both) in totals.items()})
    return rows.drop(*[f"_{c}" for c in totals])


def number(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", split_bits: int = SPLIT_BITS) -> DataFrame:
    """``key``, ``depth`` (1 for a conversation's first turn), ``role`` and ``text``.

    By ``turn``, a null one first; ties by role, then text, and equal rows follow each other.
    Null roles and texts are empty ones; rows without a key belong to no conversation and are
    left out. Other columns are not read, so they may have any name.
    """
    rows = turns.select(
        F.col(key).alias("key"),
        F.col(turn).isNotNull().alias("has"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = in_order(rows.filter("key is not null"), ("has", "turn", "role", "text"), "key", split_bits)
    numbered = running(ordered, "key", {"n": (F.lit(1), F.sum, lambda a, b: a + b)})
    return numbered.select(F.col("key").alias(key), (F.col("n") + 1).alias("depth"), "role", "text")


def _blocks(turns: DataFrame, split_bits: int) -> DataFrame:
    """A row for each conversation and block: the prefix before and after it, and its turns.

    A turn has its depth, the prefix before it and after it, and its words.
    """
    hashes = {c: F.xxhash64(F.lit(lane), "depth", F.xxhash64(F.lit(lane), "role", "text")) for lane, c in ((1, "x"), (2, "y"))}
    words = F.regexp_count("text", F.lit(WORD)).cast("long")
    narrow = turns.select("key", "depth", *[h.alias(c) for c, h in hashes.items()], words.alias("words"))
    ordered = in_order(narrow, ("depth",), "key", split_bits)
    ordered = running(ordered, "key", {f"up_{a}": (F.col(x), F.bit_xor, _xor) for a, x in (("a", "x"), ("b", "y"))})
    turn = F.struct("depth", _xor(F.col("up_a"), F.col("x")).alias("a"), _xor(F.col("up_b"), F.col("y")).alias("b"), "up_a", "up_b", "words")
    rows = ordered.select("key", F.expr(f"(depth - 1) div {BLOCK}").alias("block"), turn.alias("turn"))
    rows = rows.groupBy("key", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    first, last = F.get("turns", F.lit(0)), F.get("turns", F.size("turns") - 1)
    ends = [last["depth"].alias("depth"), last["a"].alias("a"), last["b"].alias("b")]
    return rows.select("key", "block", first["up_a"].alias("up_a"), first["up_b"].alias("up_b"), *ends, "turns")


def _apart(groups: DataFrame, weights: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Turns of the distinct blocks: of those that nothing else follows their prefix with, and of the others."""
    kinds = groups.groupBy("block", "up_a", "up_b").agg(F.count("*").alias("kinds"), F.first(F.struct(*NODE, "turns", *weights)).alias("only"))
    alone = kinds.filter("kinds = 1").select("block", "only.*")
    # By the digest after the block, of which there is one row each, not by the prefix, which many share.
    forks = groups.join(alone.select("block", *NODE), ["block", *NODE], "left_anti")
    parts = []
    for part in (alone, forks):
        part = part.select(F.explode("turns").alias("turn"), *weights).select("turn.*", *weights)
        parts.append(part.withColumn("up", F.col("depth") - 1))
    return parts[0], parts[1]


def _refined(groups: DataFrame, weights: dict[str, Column], own: tuple[str, ...] = ()) -> DataFrame:
    """A row for each node: its weights added up, where siblings differ, over the blocks that share it."""
    alone, forks = _apart(groups, weights)
    keep = [F.first(c).alias(c) for c in own]
    forks = forks.groupBy(*NODE).agg(*[w.alias(c) for c, w in weights.items()], *keep)
    return alone.select(*NODE, *weights, *own).unionByName(forks)


def _ends(last: DataFrame, key: str) -> DataFrame:
    """``sha256`` of the comma-joined ids in ascending order for each node of ``last``.

    Ids are sorted over all tasks and joined where they are; a task then hashes a node's
    stretches one after the other and holds one at a time.
    """

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "first", "ids"]
        for batch in batches:
            rows, now, out = zip(*[c.to_pylist() for c in batch.columns]), None, []
            for *node, member in rows:
                if now == node and len(out[-1][-1]) < IDS:
                    out[-1][-1].append(str(member))
                else:
                    now = node
                    out.append([*node, member, [str(member)]])
            columns = list(zip(*out)) if out else [[]] * 5
            columns[4] = [",".join(ids) for ids in columns[4]]
            types = [pa.int64()] * 3 + [batch.schema.field(3).type, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def finished(node) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in [*node, state.hexdigest()]], names=[*NODE, "sha256"])

        for batch in batches:
            for *node, ids in zip(*[batch.column(c).to_pylist() for c in (0, 1, 2, 4)]):
                if now != node:
                    if now is not None:
                        yield finished(now)
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            yield finished(now)

    bound_batches(last.sparkSession)
    rows = last.select(*NODE, F.col(key).alias("member"))
    kind = rows.schema["member"].dataType.simpleString()
    rows = rows.repartitionByRange(*NODE, "member").sortWithinPartitions(*NODE, "member")
    rows = rows.mapInArrow(stretches, f"depth long, a long, b long, first {kind}, ids string")
    rows = rows.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return rows.mapInArrow(digests, "depth long, a long, b long, sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame | None = None, key: str = "conv_id", split_bits: int = SPLIT_BITS) -> DataFrame:
    """Every distinct prefix of the conversations, from the empty one on, as a node.

    ``turns`` has ``key`` (a whole number), ``depth`` from 1 without gaps, ``role`` and ``text``, as
    ``number`` gives them; ``members`` names conversations that may have no turn. Returned are ``key``
    (the node's smallest member), ``depth``, ``parent`` (the parent's smallest member, null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children in the
    subtree, the node included), ``saved_tokens`` (over the subtree, members beyond the first times
    the words of the node's turn) and ``ends_sha256`` of the members that end there. Without
    conversations there is no root either. Equal turns share a 128-bit hash.
    """
    own = turns.select(F.col(key).alias("key"), "depth", "role", "text").filter("key is not null")
    named = own.select("key") if members is None else members.select(F.col(key).alias("key")).filter("key is not null").unionByName(own.select("key"))
    blocks = materialise(_blocks(own, split_bits), "blocks")
    spans = blocks.groupBy("key").agg(F.max("depth").alias("length"))
    # Members without turns are at the root only.
    lengths = materialise(named.distinct().join(spans, "key", "left").fillna(0, ["length"]), "members")

    by_block = ["block", "up_a", "up_b", *NODE]
    groups = blocks.groupBy(*by_block).agg(F.count("*").alias("n_convs"), F.min("key").alias("key"), F.first("turns").alias("turns"))
    groups = materialise(groups, "groups")
    nodes = _refined(groups, {"n_convs": F.sum("n_convs"), "key": F.min("key")}, (*FROM, "words"))
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.count("*").alias("n_convs"), F.min("key").alias("key")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "n_convs", "key", F.lit(-1).cast("long").alias("up"), zero.alias("up_a"), zero.alias("up_b"), zero.alias("words"))
    nodes = materialise(nodes.unionByName(root), "nodes")

    children = nodes.filter("depth > 0").groupBy(*FROM).agg(F.count("*").alias("n_children"))
    children = children.toDF(*NODE, "n_children")
    cost = (F.col("n_convs") - 1) * F.col("words")
    nodes = nodes.join(children, list(NODE), "left").fillna(0, ["n_children"]).withColumn("cost", cost)
    nodes = in_order(nodes, ("depth",), "key", split_bits)
    # What of its smallest member's nodes lies above a node is no part of its subtree.
    placed = running(nodes, "key", {"above": (F.col("cost"), F.sum, lambda a, b: a + b)}).drop(SPLIT, POSITION, "_chain")
    carried = nodes.groupBy("key").agg(F.sum("cost").alias("cost"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    carried = materialise(carried.join(lengths, "key"), "carried")
    # A long conversation's weights are sent to its blocks in so many rows that none is joined to all.
    stride = F.sequence(zero, F.expr(f"greatest(length - 1, 0) div {BLOCK * STRIDE}"))
    sent = carried.select("key", "cost", "leaves", F.explode(stride).alias("stride"))
    heavy = blocks.select("key", *by_block, F.expr(f"block div {STRIDE}").alias("stride")).join(sent, ["key", "stride"])
    heavy = heavy.groupBy(*by_block).agg(F.sum("cost").alias("total"), F.sum("leaves").alias("n_leaves"))
    sums = {"total": F.sum("total"), "n_leaves": F.sum("n_leaves")}
    sums_of = _refined(groups.drop("n_convs", "key").join(heavy, by_block), sums)
    all_of = carried.agg(F.sum("cost").alias("total"), F.sum("leaves").alias("n_leaves")).filter("n_leaves is not null")
    sums_of = sums_of.unionByName(all_of.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "total", "n_leaves"))

    tails = blocks.select("key", *NODE).join(lengths.filter("length > 0").withColumnRenamed("length", "depth"), ["key", "depth"])
    tails = tails.select(*NODE, "key").unionByName(lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "key"))
    found = placed.join(sums_of, list(NODE)).join(_ends(tails, "key"), list(NODE), "left")
    found = materialise(found.withColumn("saved_tokens", F.col("total") - F.col("above")), "found")
    found = _with_parents(found)
    nothing = hashlib.sha256().hexdigest()
    return found.select(
        F.col("key").alias(key),
        "depth",
        "parent",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent``, the smallest member of the node above."""
    parents = nodes.filter("n_children > 0").select(*[F.col(c).alias(u) for c, u in zip(NODE, FROM)], F.col("key").alias("parent"), "n_children")
    many = parents.filter(F.col("n_children") > MANY_CHILDREN).drop("n_children")
    if many.limit(BROADCAST_NODES + 1).count() > BROADCAST_NODES:
        return nodes.join(parents.drop("n_children"), list(FROM), "left")
    few = parents.filter(F.col("n_children") <= MANY_CHILDREN).drop("n_children")
    of_many = nodes.join(F.broadcast(many), list(FROM))
    of_few = nodes.join(F.broadcast(many), list(FROM), "left_anti").join(few, list(FROM), "left")
    return of_many.unionByName(of_few)
