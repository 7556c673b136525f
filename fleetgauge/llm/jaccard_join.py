"""Documents whose sets of word shingles are nearly the same, linked without a miss.

The steps, all of them Spark jobs over the whole table:

1. Shingles that very many documents hold are counted (the hot ones, a bounded list).
2. Each document gives its set's id, its counts in groups of the shingle hash, and a
   prefix of its shingles: cold ones by hash, then hot ones. Two linked sets share a
   shingle of their prefixes whatever the order is, so the order costs no link.
3. Documents that share a prefix shingle and are of like size meet under the shingle's
   leader, the smallest set id that has it. A leader with many members is cut into
   parts, and each pair of parts is a tile of its own.
4. In a tile the count vectors are points of an R-tree; the summed minima of counts
   bound what two sets can share, for nodes as for points. Sets that pairs within the
   bound connect are a family; who has no such pair is done.
5. Families' whole sets are read, each once, and the same trees give the pairs within the
   bound, which are verified, save those that links already found have joined.
6. Links become components.

Sets are compared by 64-bit hashes of their shingles, and known by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.components import Roots, components
from fleetgauge.llm.count_tree import CountTree
from fleetgauge.llm.tiles import binaries, bound_batches, laid_out, runs, tiles
from fleetgauge.session import materialise

# Groups that a set's shingles are counted in, a power of two.
LEAST_GROUPS, MOST_GROUPS = 64, 8192
# Counts are stored up to here; one that is not below it bounds nothing.
MOST_COUNTED = 255
# A shingle is hot if so many documents hold it; the HOT_MOST most frequent are listed.
HOT_LEAST = 24
HOT_MOST = 1 << 18
# Members of a tile, and the shingles that count as one member where sets are whole.
TILE = 2048
TILE_SHINGLES = 1024
# Documents read again for their sets: up to here their ids are broadcast, beyond it they are joined.
BROADCAST_IDS = 1 << 19


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set of which any linked set's prefix has at least one."""
    return np.where(size > 0, size - (percent * size + 99) // 100 + 1, 0)


def _sets(texts: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for low, high in W.slices(texts):
        hashes, bounds = W.word_hashes(*W.text_buffers(texts.slice(low, high - low)))
        yield low, high, *W.distinct_per_text(*W.shingle_hashes(hashes, bounds, shingle))


def _set_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(W.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
    sizes = np.diff(bounds).astype(np.uint64)
    return W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _frequent(shingle: int, percent: int) -> Callable:
    """Shingles that two documents of a batch have among those by whose hash a prefix may be chosen."""

    def run(batches):
        for batch in batches:
            parts = []
            for _, _, hashes, bounds in _sets(batch.column(0), shingle):
                size = np.diff(bounds)
                owner = np.repeat(np.arange(len(size)), size)
                early = np.arange(len(hashes)) - bounds[:-1][owner] < 2 * prefix_length(size, percent)[owner] + 8
                parts.append(hashes[early])
            values, held = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
            often = held >= 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(held[often], pa.int64())], names=["shingle", "held"]
            )

    return run


def hot_shingles(docs: DataFrame, text: str, shingle: int, percent: int) -> np.ndarray:
    """Hashes, ascending, of shingles that HOT_LEAST documents or more hold, the HOT_MOST most frequent.

    Counted over all documents, but for shingles that a batch of them has once. The list
    only sets an order: no result depends on it.
    """
    counted = docs.select(text).mapInArrow(_frequent(shingle, percent), "shingle long, held long")
    counted = counted.groupBy("shingle").agg(F.sum("held").alias("held")).filter(f"held >= {HOT_LEAST}")
    hot = counted.orderBy(F.desc("held"), "shingle").limit(HOT_MOST).select("shingle").toArrow()
    return np.sort(hot.column("shingle").to_numpy().view(np.uint64))


def _lists(values: np.ndarray, owner: np.ndarray, size: int) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=size))])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def groups_of(size: np.ndarray, percent: int) -> np.ndarray:
    """Groups enough for the counts of unlike sets of a size to differ more than those of linked ones can.

    Counts of two unlike sets differ in all by about 0.8 sqrt(2 size groups), those of linked
    sets by no more than a fixed part of the size; the groups make the first twice the other.
    """
    part = 2 * (100 - percent) / (100 + percent)
    wanted = np.maximum(2.64 * part * part * np.asarray(size, dtype=np.float64), 1)
    return np.clip(2 ** np.ceil(np.log2(wanted)), LEAST_GROUPS, MOST_GROUPS).astype(np.int64)


def group_counts(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Shingles of a set in each of a power of two of groups; neighbours make the groups of half as many."""
    return np.bincount((hashes >> np.uint64(65 - groups.bit_length())).astype(np.int64), minlength=groups)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(groups, -1).sum(axis=1)


def _marks(shingle: int, percent: int, hot: np.ndarray, names: list[str]) -> Callable:
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high, hashes, bounds in _sets(texts, shingle):
                size, rows = np.diff(bounds), high - low
                owner = np.repeat(np.arange(rows), size)
                known = ~np.asarray(ids.slice(low, rows).is_null()) & (size > 0)
                set_ids = _set_ids(hashes, bounds)
                # One document speaks for its copies in the same slice.
                speaks = np.zeros(rows, dtype=bool)
                speakers = np.flatnonzero(known)
                speaks[speakers[np.unique(set_ids[speakers], return_index=True)[1]]] = True
                is_hot = _is_in(hashes, hot)
                cold_before = np.concatenate([[0], np.cumsum(~is_hot)])
                cold = cold_before[bounds[1:]] - cold_before[bounds[:-1]]
                rank = cold_before[:-1] - cold_before[bounds[:-1]][owner]
                at = np.arange(len(hashes)) - bounds[:-1][owner]
                rank = np.where(is_hot, cold[owner] + at - rank, rank)
                take = (rank < prefix_length(size, percent)[owner]) & speaks[owner]
                # As many groups as a larger partner's.
                groups = groups_of(size * 100 // percent + 1, percent)
                counts = [
                    np.minimum(group_counts(hashes[a:b], int(g)), MOST_COUNTED).astype("u1").tobytes() if told else None
                    for a, b, g, told in zip(bounds[:-1], bounds[1:], groups, speaks)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, rows),
                        pa.array(size, pa.int64()),
                        pa.array(set_ids, pa.int64(), mask=~known),
                        _lists(hashes[take & ~is_hot], owner[take & ~is_hot], rows),
                        _lists(hashes[take & is_hot], owner[take & is_hot], rows),
                        pa.array(counts, pa.binary()),
                    ],
                    names=names,
                )

    return run


def _with_bins(sets: DataFrame, percent: int) -> DataFrame:
    """Rows in the ``bin`` of their size and in the next: linked sets are of one bin or neighbours.

    Bins are a little wider than sizes of linked sets can differ, so rounding cannot part them.
    ``native`` marks a row in its own bin: a bin without one has only pairs that meet elsewhere.
    """
    width = math.log(100 / percent) * 1.01 if percent < 100 else 1e-6
    own = F.floor(F.log("size") / width)
    return sets.withColumn("own", own).withColumn("bin", F.explode(F.array(own, own + 1))).select("*", (F.col("bin") == F.col("own")).alias("native")).drop("own")


def _met(marks: DataFrame) -> DataFrame:
    """(set_id, leader): sets that share a prefix shingle, under the smallest of them."""
    cold = marks.select("set_id", F.explode("cold").alias("shingle"))
    together = Window.partitionBy("shingle")
    cold = cold.select(
        "set_id", F.min("set_id").over(together).alias("leader"), F.max("set_id").over(together).alias("last")
    )
    # A hot shingle's holders are no bounded group: their leader is found by a grouped minimum
    # of at most HOT_MOST rows, which is why it may be broadcast.
    hot = marks.select("set_id", F.explode("hot").alias("shingle"))
    leaders = hot.groupBy("shingle").agg(F.min("set_id").alias("leader"), F.max("set_id").alias("last"))
    hot = hot.join(F.broadcast(leaders), "shingle").select("set_id", "leader", "last")
    return cold.unionByName(hot).filter("leader < last").select("set_id", "leader").distinct()


def _pairs(table: pa.Table, counts: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a tile that pass the overlap bound."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    if i == j:
        tree = CountTree(counts, sizes)
        yield from tree.pairs(tree, percent)
        return
    part = table.column("part").to_numpy()
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    if len(left) and len(right):
        trees = CountTree(counts[left], sizes[left]), CountTree(counts[right], sizes[right])
        for a, b in trees[0].pairs(trees[1], percent):
            yield left[a], right[b]


def _maybe_linked(percent: int) -> Callable:
    """Links that join a tile's members into the sets that all pairs within the bound would join."""

    def run(batches):
        ends, heads, waiting = [], [], 0
        for table in runs(batches, ["leader", "bin", "i", "j"]):
            if table.num_rows < 2:
                continue
            counts, sizes = binaries(table.column("counts"), "u1"), table.column("size").to_numpy()
            groups = min(map(len, counts))
            counts = np.array([folded(np.where(c == MOST_COUNTED, 1 << 24, c.astype(np.int32)), groups) for c in counts])
            roots = Roots(table.num_rows)
            for a, b in _pairs(table, counts, sizes, percent):
                roots.join(a, b)
            hung = np.flatnonzero(roots.of != np.arange(len(roots.of)))
            if len(hung):
                ids = table.column("set_id").to_numpy()
                ends.append(ids[hung])
                heads.append(ids[roots.of[hung]])
                waiting += len(hung)
            if waiting >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ends, heads)], names=["a", "b"])
                ends, heads, waiting = [], [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ends, heads)], names=["a", "b"])

    return run


def _whole_sets(shingle: int) -> Callable:
    def run(batches):
        for batch in batches:
            for low, high, hashes, bounds in _sets(batch.column(0), shingle):
                filled = np.flatnonzero(np.diff(bounds))
                data = [hashes[bounds[k] : bounds[k + 1]].tobytes() for k in filled]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_ids(hashes, bounds)[filled]), pa.array(data, pa.binary())], names=["set_id", "shingles"]
                )

    return run


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two ascending arrays without repeats have in common."""
    if len(a) > len(b):
        a, b = b, a
    return int(np.count_nonzero(_is_in(a, b)))


def _linked(percent: int) -> Callable:
    """Links that join a tile's members into the sets that all its links would join."""

    def run(batches):
        for table in runs(batches, ["family", "i", "j"]):
            if table.num_rows < 2:
                continue
            sets = binaries(table.column("shingles"), "<u8")
            sizes = np.array([len(s) for s in sets])
            groups = int(groups_of(sizes.max(), percent))
            counts = np.array([group_counts(s, groups) for s in sets], dtype=np.int32)
            root, links = np.arange(len(sets)), []
            for a, b in _pairs(table, counts, sizes, percent):
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
                while len(a):
                    x, y = int(a[0]), int(b[0])
                    both = shared(sets[x], sets[y])
                    a, b = a[1:], b[1:]
                    if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                        links.append((x, y))
                        root[root == root[x]] = root[y]
                        apart = root[a] != root[b]
                        a, b = a[apart], b[apart]
            if links:
                ids = table.column("set_id").to_numpy()
                ends = np.array(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[ends[:, 0]]), pa.array(ids[ends[:, 1]])], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 90
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` of every row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z in lower case. A document's set
    holds its distinct runs of ``shingle`` words, or all its words as one run if they are
    fewer. Two documents are linked if they share ``percent`` of the union of their sets;
    ``component_id`` is the smallest key that links reach, the document's own included.

    A null or wordless text has an empty set, is linked with nothing and is its own
    component. A row without a key has a null component and links nothing. Rows with the
    same key count as one document and keep a row each. Columns other than ``key`` and
    ``text`` are not read, whatever their names. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    hot = hot_shingles(docs, "text", shingle, percent)
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("n long, set_id long, cold array<long>, hot array<long>, counts binary")])
    marks = materialise(docs.mapInArrow(_marks(shingle, percent, hot, schema.names), schema), "marks")
    # Five joins read the sets; as a table, they are grouped once and no plan holds that grouping again.
    sets = marks.filter("set_id is not null").groupBy("set_id").agg(F.min("key").alias("key"), F.min("n").alias("size"))
    sets = materialise(sets, "sets")

    # What a task needs of a set is joined to the narrow rows only when their tiles are known.
    met = materialise(_met(marks).join(sets.select("set_id", "size"), "set_id"), "met")
    counts = marks.select("set_id", "counts").filter("set_id is not null and counts is not null")
    counts = counts.join(met.select("set_id").distinct(), "set_id", "left_semi").dropDuplicates(["set_id"])
    points = _with_bins(met, percent).withColumn("load", F.lit(1))
    points = tiles(points, ["leader", "bin"], "set_id", TILE).join(counts, "set_id")
    maybe = laid_out(points, ["leader", "bin"], "set_id").mapInArrow(_maybe_linked(percent), "a long, b long")
    families = components(maybe).select(F.col("node").alias("set_id"), F.col("component").alias("family"))
    families = materialise(families.join(sets, "set_id"), "families")

    wanted = families.select("key").distinct()
    if families.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    whole = docs.join(wanted, "key", "left_semi").select("text").mapInArrow(_whole_sets(shingle), "set_id long, shingles binary")
    load = F.greatest("size", F.lit(TILE_SHINGLES)).alias("load")
    tiled = tiles(families.select("set_id", "family", load), ["family"], "set_id", TILE * TILE_SHINGLES)
    tiled = tiled.join(whole.dropDuplicates(["set_id"]), "set_id")
    links = laid_out(tiled, ["family"], "set_id").mapInArrow(_linked(percent), "a long, b long")

    joined = components(links).withColumnRenamed("node", "set_id")
    joined = joined.join(sets.select("set_id", "key"), "set_id")
    lowest = joined.groupBy("component").agg(F.min("key").alias("lowest"))
    joined = joined.join(lowest, "component").select("set_id", "lowest")
    homes = sets.select("set_id", "key").join(joined, "set_id", "left")
    homes = homes.select("set_id", F.coalesce("lowest", "key").alias("home"))
    result = marks.select("key", "n", "set_id").join(homes, "set_id", "left")
    return result.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("home", "key").alias("component_id")
    )
