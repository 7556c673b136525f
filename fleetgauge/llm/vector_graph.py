"""Near-duplicate vectors through a robust-pruned flat graph over overlapping shards.

1. Centres come from a bounded sample. Every distinct vector goes to its nearest centres:
   the shards overlap, so close vectors share one almost always.
2. In a shard each vector keeps, of its nearest ones, those that no kept one is much
   nearer to (robust pruning). Its lists from all shards, and those that name it, are united
   by key: one graph over the whole table.
3. Every vector searches the graph greedily with a beam, from the medoids of each of its
   shards and from itself. Then the search widens: neighbours of all that is in range are
   looked at too, until nothing new is in range.
4. The widening goes on beyond the shards: neighbours, by the united lists, of what is in
   range and in no shard of the vector's own are looked at by joins, until there is nothing new.
5. What is found is verified by the cosine in double precision; a pair found in several
   shards counts once.
6. Recall is audited on a bounded sample of vectors against all rows, by vector; if it is too
   low, the shards are built again with more overlap. Only if that is not enough either, every
   pair is looked at, at a cost of the square of the rows.

A shard that is too large for a task is cut into parts, and each pair of parts has lists
and is searched, so nothing in it is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm.components import Roots, components
from fleetgauge.llm.sampling import sample_of
from fleetgauge.llm.tiles import laid_out, runs, tiles
from fleetgauge.session import materialise

# The sample that centres are fitted on, vectors for each centre, and the most centres.
SAMPLE = 1 << 15
PER_CENTRE = 300
MOST_CENTRES = 1 << 12
# Centres that a vector goes to; doubled up to MOST_OVERLAP while the audit finds too little.
OVERLAP = 4
MOST_OVERLAP = 16
AUDITED = 1000
RECALL = 0.98
# Links up to which a vector's group counts as small.
SMALL = 8
# Vectors of a shard in one task.
PART = 2048
NEAREST = 48
DEGREE = 16
RANDOM_LINKS = 4
ALPHA = 1.2
BEAM = 16
MEDOIDS = 8
# Searches side by side.
ABREAST = 512
# Cosines in single precision may be this much too low.
SLACK = 1e-5


def units(vectors: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of length 1 from a list column of valid vectors of one length."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(dtype)


def _centres(x: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means from rows drawn at random."""
    centres = x[np.random.default_rng(3).choice(len(x), count, replace=False)]
    for _ in range(rounds):
        home = np.concatenate([np.argmax(x[k : k + 4096] @ centres.T, axis=1) for k in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-6, sums / np.maximum(size, 1e-6), centres).astype(np.float32)
    return centres


def robust_prune(x: np.ndarray, points: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours kept for each point from its candidates, the nearest first; -1 fills up.

    The nearest candidate is kept, and those go that it is nearer to, ``alpha`` times over,
    than the point is; then the nearest of the rest, until ``degree`` are kept.
    """
    own = 1 - np.einsum("ij,ikj->ik", points, x[near])
    alive = np.ones(near.shape, dtype=bool)
    kept = np.full((len(points), degree), -1)
    here = np.arange(len(points))
    for step in range(degree):
        has = alive.any(axis=1)
        if not has.any():
            break
        pick = np.argmax(alive, axis=1)
        chosen = near[here, pick]
        kept[has, step] = chosen[has]
        between = 1 - np.einsum("ij,ikj->ik", x[chosen], x[near])
        alive &= alpha * between > own
        alive[here, pick] = False
    return kept


def pruned_lists(x: np.ndarray) -> np.ndarray:
    """The neighbours that each row keeps, -1 where they are fewer than DEGREE."""
    size = len(x)
    if size < 2:
        return np.full((size, 1), -1)
    nearest = min(NEAREST, size - 1)
    pruned = []
    for low in range(0, size, 512):
        points = x[low : low + 512]
        score = points @ x.T
        score[np.arange(len(points)), low + np.arange(len(points))] = -np.inf
        near = np.argpartition(-score, nearest - 1, axis=1)[:, :nearest]
        order = np.argsort(-np.take_along_axis(score, near, axis=1), axis=1, kind="stable")
        pruned.append(robust_prune(x, points, np.take_along_axis(near, order, axis=1), DEGREE, ALPHA))
    return np.concatenate(pruned)


def adjacency(size: int, tail: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Lists of the rows, -1 where one is shorter than the longest: links both ways, and a few drawn at random.

    Random ones lead from one group to another, which pruned ones need not.
    """
    drawn = np.random.default_rng(5).integers(0, size, (size, RANDOM_LINKS)).ravel()
    tail = np.concatenate([tail, np.repeat(np.arange(size), RANDOM_LINKS)])
    head = np.concatenate([head, drawn])
    tail, head = tail[head >= 0], head[head >= 0]
    both = np.unique(np.concatenate([tail * size + head, head * size + tail]))
    tail, head = both // size, both % size
    counts = np.bincount(tail, minlength=size)
    place = np.arange(len(tail)) - (np.cumsum(counts) - counts)[tail]
    out = np.full((size, counts.max()), -1)
    out[tail, place] = head
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """The row nearest to the mean, then rows far from those chosen."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    closest = x @ x[chosen[0]]
    while len(chosen) < min(MEDOIDS, len(x)):
        chosen.append(int(np.argmin(closest)))
        closest = np.maximum(closest, x @ x[chosen[-1]])
    return np.unique(chosen)


def search(
    x: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) with a cosine of ``least`` or more that the graph leads to.

    ``starts`` has a row of start rows for each query.
    """
    many, size = len(queries), len(x)
    graph = np.where(graph < 0, size, graph)
    seen = np.zeros((many, size + 1), dtype=bool)
    seen[:, size] = True  # the row that stands for no row
    ticket = np.empty(seen.shape, dtype=np.int32)
    found = []

    def look(rows: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ahead that the queries see for the first time, and their cosines; others stand for none."""
        wide = ahead.shape
        rows, ahead = np.repeat(rows, wide[1]), ahead.ravel()
        new = np.flatnonzero(~seen[rows, ahead])
        # Of several ways to the same row at once, one counts.
        ticket[rows[new], ahead[new]] = np.arange(len(new))
        new = new[ticket[rows[new], ahead[new]] == np.arange(len(new))]
        seen[rows[new], ahead[new]] = True
        score, nodes = np.full(len(rows), -np.inf, dtype=np.float32), np.full(len(rows), size)
        nodes[new] = ahead[new]
        score[new] = np.einsum("ij,ij->i", queries[rows[new]], x[ahead[new]])
        hit = np.flatnonzero(score >= least)
        found.append(rows[hit] * size + nodes[hit])
        return nodes.reshape(wide), score.reshape(wide)

    beam, score = look(np.arange(many), starts)
    beam, score = (
        np.pad(a, ((0, 0), (0, max(0, BEAM - a.shape[1]))), constant_values=v) for a, v in ((beam, size), (score, -np.inf))
    )
    open_ = beam < size
    while True:
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            break
        pick = np.argmax(np.where(open_[rows], score[rows], -np.inf), axis=1)
        open_[rows, pick] = False
        ahead, near = look(rows, graph[beam[rows, pick]])
        wide = [np.hstack(pair) for pair in ((beam[rows], ahead), (score[rows], near), (open_[rows], ahead < size))]
        best = np.argsort(-wide[1], axis=1, kind="stable")[:, : beam.shape[1]]
        beam[rows], score[rows], open_[rows] = (np.take_along_axis(a, best, axis=1) for a in wide)
    fresh = np.concatenate(found)
    while len(fresh):
        before = len(found)
        for low in range(0, len(fresh), 8192):
            part = fresh[low : low + 8192]
            look(part // size, graph[part % size])
        fresh = np.concatenate(found[before:])
    pairs = np.concatenate(found)
    return pairs // size, pairs % size


def _verified(x: np.ndarray, pairs: np.ndarray, least: float) -> np.ndarray:
    """Distinct unordered pairs of rows whose cosine is ``least`` or more; two columns."""
    pairs = np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1)
    once = np.unique(pairs[:, 0] * len(x) + pairs[:, 1])
    pairs = np.stack([once // len(x), once % len(x)], axis=1)
    right = np.zeros(len(pairs), dtype=bool)
    for low in range(0, len(pairs), 1 << 16):
        a, b = pairs[low : low + (1 << 16)].T
        right[low : low + (1 << 16)] = np.einsum("ij,ij->i", x[a], x[b]) >= least
    return pairs[right]


def _close_pairs(x: np.ndarray, graph: np.ndarray, here: np.ndarray, least: float) -> np.ndarray:
    """Pairs that the rows of ``here`` find among all rows of the graph, verified."""
    single = x.astype(np.float32)
    centre, pairs = medoids(single), [np.zeros((0, 2), dtype=np.int64)]
    for low in range(0, len(here), ABREAST):
        rows = here[low : low + ABREAST]
        starts = np.hstack([np.repeat(centre[None, :], len(rows), axis=0), rows[:, None]])
        q, found = search(single, graph, starts, single[rows], least - SLACK)
        pairs.append(np.stack([rows[q], found], axis=1))
    return _verified(x, np.concatenate(pairs), least)


def _every_pair(x: np.ndarray, here: np.ndarray, least: float) -> np.ndarray:
    single, pairs = x.astype(np.float32), [np.zeros((0, 2), dtype=np.int64)]
    for low in range(0, len(here), ABREAST):
        rows = here[low : low + ABREAST]
        q, found = np.nonzero(single[rows] @ single.T >= least - SLACK)
        pairs.append(np.stack([rows[q], found], axis=1))
    return _verified(x, np.concatenate(pairs), least)


def _tiles_of(batches) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, bool]]:
    """Each tile's rows, their unit vectors, the rows of its first part, and whether it has one part only."""
    for table in runs(batches, ["shard", "i", "j"]):
        table = table.combine_chunks()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        here = np.flatnonzero(table.column("part").to_numpy() == i)
        if len(here) and table.num_rows > 1 and (i == j or len(here) < table.num_rows):
            yield table, units(table.column("vector").combine_chunks()), here, i == j


def _shard_lists(batches) -> Iterator[pa.RecordBatch]:
    """Each vector's pruned neighbours in each tile it is in."""
    for table, x, _, _ in _tiles_of(batches):
        lists = pruned_lists(x.astype(np.float32))
        key = table.column("key").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum((lists >= 0).sum(axis=1))]).astype(np.int32)
        near = pa.ListArray.from_arrays(pa.array(bounds), key.take(pa.array(lists[lists >= 0])))
        yield pa.RecordBatch.from_arrays([key, near], names=["key", "near"])


def _shard_pairs(least: float, every: bool) -> Callable:
    """Pairs of linked vectors of each tile, the copies of both, and, with a null ``b``, each vector's root there."""

    def run(batches):
        for table, x, here, alone in _tiles_of(batches):
            key = table.column("key").combine_chunks()
            if every:
                pairs = _every_pair(x, here, least)
            else:
                near = table.column("near").combine_chunks().fill_null([])
                tail = np.repeat(np.arange(len(x)), pc.list_value_length(near).to_numpy(zero_copy_only=False).astype(np.int64))
                head = pc.index_in(near.flatten(), value_set=key).fill_null(-1).to_numpy().astype(np.int64)
                pairs = _close_pairs(x, adjacency(len(x), tail, head), here, least)
            if not alone:
                # Pairs inside a part are its own tile's.
                first = np.zeros(len(x), dtype=bool)
                first[here] = True
                pairs = pairs[first[pairs[:, 0]] != first[pairs[:, 1]]]
            if not len(pairs):
                continue
            roots = Roots(len(x))
            roots.join(pairs[:, 0], pairs[:, 1])
            told = np.flatnonzero(roots.of != np.arange(len(x)))
            copies = table.column("copies").to_numpy()
            a, b = (key.take(pa.array(side)) for side in pairs.T)
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(copies[pairs[:, 0]]), pa.array(copies[pairs[:, 1]]), pa.nulls(len(a), key.type)], names=PAIR
            )
            none = pa.nulls(len(told), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(told)), pa.nulls(len(told), key.type), none, none, key.take(pa.array(roots.of[told]))], names=PAIR
            )

    return run


PAIR = ["a", "b", "a_copies", "b_copies", "root"]


def _beyond(least: float, names: list[str]) -> Callable:
    """Those of given pairs whose vectors are close enough."""

    def run(batches):
        for batch in batches:
            x, y = units(batch.column("a_vector")), units(batch.column("b_vector"))
            keep = pa.array(np.einsum("ij,ij->i", x, y) >= least)
            yield batch.select(names).filter(keep)

    return run


def _widened(pairs: DataFrame, near: DataFrame, homes: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """Pairs of vectors without a common shard that the united lists lead to from what is in range.

    Each round looks at the neighbours of the vectors found in the last one. Pairs with a common
    shard were met there. Whether any is left is first asked for all vectors of the same
    shards at once: in a dense group they are many, and hardly any has a neighbour beyond.
    """
    shards = homes.filter(F.col("shard") == F.get("shards", F.lit(0))).select("key", "shards")
    kind = vectors.schema["key"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), *T.StructType.fromDDL("a_copies long, b_copies long")])
    front, out = pairs.select("a", "b"), None
    while True:
        both = front.unionByName(front.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.join(shards.toDF("a", "a_shards"), "a")
        ways = both.select("a_shards", "b").distinct().join(near.withColumnRenamed("key", "b"), "b")
        ways = ways.select("a_shards", "b", F.explode("near").alias("c")).join(shards.toDF("c", "c_shards"), "c")
        ways = materialise(ways.filter(~F.arrays_overlap("a_shards", "c_shards")).select("a_shards", "b", "c"), "ways")
        ahead = both.join(ways, ["a_shards", "b"])
        ahead = ahead.select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("b")).distinct()
        if out is not None:
            ahead = ahead.join(out, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            own = vectors.select(F.col("key").alias(side), F.col("vector").alias(f"{side}_vector"), F.col("copies").alias(f"{side}_copies"))
            ahead = ahead.join(own, side)
        fresh = ahead.select("a", "b", "a_copies", "b_copies", "a_vector", "b_vector").mapInArrow(_beyond(least, schema.names), schema)
        fresh = materialise(fresh, "beyond")
        if fresh.isEmpty():
            return fresh if out is None else out
        out = fresh if out is None else materialise(out.unionByName(fresh), "beyond")
        front = fresh.select("a", "b")


def _assigned(centres: np.ndarray, overlap: int) -> Callable:
    """A row for each vector and shard, with all the vector's shards in ascending order."""

    def run(batches):
        for batch in batches:
            x = units(batch.column(1), np.float32)
            nearest = np.sort(np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :overlap], axis=1).astype(np.int64)
            width = nearest.shape[1]
            rows = np.repeat(np.arange(len(x)), width)
            bounds = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(nearest[rows].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(nearest.ravel()), lists], names=["key", "shard", "shards"]
            )

    return run


def _true_links(queries: np.ndarray, least: float) -> Callable:
    def run(batches):
        total = np.zeros(len(queries), dtype=np.int64)
        for batch in batches:
            x, copies = units(batch.column(0)), batch.column(1).to_numpy()
            for low in range(0, len(x), 4096):
                total += (queries @ x[low : low + 4096].T >= least) @ copies[low : low + 4096]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(queries))), pa.array(total)], names=["query", "links"])

    return run


def audit_recall(vectors: DataFrame, links: DataFrame, least: float) -> float:
    """Share of its links, by brute force against all, that was found for a vector, the mean of at most 1.2 AUDITED ones.

    Or the mean of those with at most SMALL links, if it is less: large groups, whose vectors
    have most links, do not hide what small ones lose.
    """
    sample = sample_of(vectors.select("key", "vector", "copies"), "key", AUDITED).toArrow()
    if not sample.num_rows:
        if vectors.isEmpty():
            return 1.0
        raise ValueError("an audit needs vectors to look at")
    queries = units(sample.column("vector").combine_chunks())
    counted = vectors.select("vector", "copies").mapInArrow(_true_links(queries, least), "query long, links long")
    there = {r[0]: r[1] for r in counted.groupBy("query").agg(F.sum("links")).collect()}
    ids = vectors.sparkSession.createDataFrame([(k,) for k in sample.column("key").to_pylist()], vectors.select("key").schema)
    got = {r[0]: r[1] for r in links.join(F.broadcast(ids), "key").select("key", "links").collect()}
    copies = sample.column("copies").to_pylist()
    true = [there[n] - copies[n] for n in range(len(copies))]
    shares = [(t, min(got.get(k, 0) / t, 1.0)) for k, t in zip(sample.column("key").to_pylist(), true) if t]
    kinds = [s for _, s in shares], [s for t, s in shares if t <= SMALL]
    return min((sum(own) / len(own) for own in kinds if own), default=1.0)


def _linked(vectors: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(key, links) and (key, root) of distinct vectors of one length."""
    count = vectors.count()
    sample = units(sample_of(vectors.select("key", "vector"), "key", SAMPLE).toArrow().column("vector").combine_chunks(), np.float32)
    centres = _centres(sample, int(min(max(count // PER_CENTRE, 1), MOST_CENTRES, max(len(sample) // 8, 1))))
    kind = vectors.schema["key"].dataType
    shard = T.StructType([vectors.schema["key"], *T.StructType.fromDDL("shard long, shards array<long>").fields])
    listed = T.StructType([T.StructField("key", kind), T.StructField("near", T.ArrayType(kind))])
    told = T.StructType(
        [T.StructField("a", kind), T.StructField("b", kind), *T.StructType.fromDDL("a_copies long, b_copies long"), T.StructField("root", kind)]
    )
    overlap, every = OVERLAP, False
    while True:
        homes = vectors.select("key", "vector").mapInArrow(_assigned(centres, overlap), shard)
        homes = materialise(homes, "shards")
        dealt = tiles(homes.select("key", "shard").withColumn("load", F.lit(1)), ["shard"], "key", PART).join(vectors, "key")
        if every:
            found = laid_out(dealt, ["shard"], "key")
        else:
            lists = laid_out(dealt, ["shard"], "key").mapInArrow(_shard_lists, listed)
            # The graph of the whole table: a vector's neighbours from all its shards.
            near = lists.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
            near = materialise(near, "lists")
            found = laid_out(dealt.join(near, "key", "left"), ["shard"], "key")
        found = materialise(found.mapInArrow(_shard_pairs(least, every), told), "found")
        pairs = materialise(found.filter("b is not null").drop("root").distinct(), "pairs")
        roots = found.filter("b is null").select(F.col("a").alias("key"), "root")
        if not every and overlap < len(centres):
            more = _widened(pairs, near, homes, vectors, least)
            pairs = pairs.unionByName(more)
            roots = roots.unionByName(more.select(F.col("b").alias("key"), F.col("a").alias("root")))
        ends = [pairs.select(F.col(a).alias("key"), F.col(f"{b}_copies").alias("copies")) for a, b in ("ab", "ba")]
        links = materialise(ends[0].unionByName(ends[1]).groupBy("key").agg(F.sum("copies").alias("links")), "links")
        if every or audit_recall(vectors, links, least) >= RECALL:
            return links, roots
        if overlap < min(MOST_OVERLAP, len(centres)):
            overlap *= 2
        else:
            centres, overlap, every = centres[:1], 1, True


def valid(vector: str) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and one that is not zero."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda c: c != 0), F.lit(False))


def near_duplicates(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row of ``table``.

    Rows are linked if the cosine of their vectors is ``least`` or more in double precision
    and the search finds the pair; none below ``least`` is linked. ``n_links`` counts other
    rows, exact copies too; ``component_id`` is the smallest key that links reach, the own
    one included, and ``kept`` marks the rows whose key it is.

    Vectors that are null, empty, zero, or have a null or non-finite component are linked
    with nothing; nor are vectors of different length. A row without a key has null
    component and kept, is linked with nothing and counts for nothing. Rows of one key count as one copy
    each. Columns other than ``key`` and ``vector`` are not read; an empty table gives an
    empty result.
    """
    rows = table.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    # Two hashes with different seeds stand for a vector; -0.0 counts as 0.0.
    plain = F.transform("vector", lambda c: c + F.lit(0).cast("float"))
    usable = valid("vector") & F.col("key").isNotNull()
    rows = rows.withColumn("h1", F.when(usable, F.xxhash64(plain))).withColumn("h2", F.when(usable, F.xxhash64(plain, F.lit(1))))
    groups = rows.filter("h1 is not null").groupBy("h1", "h2")
    distinct = groups.agg(F.min("key").alias("key"), F.min("vector").alias("vector"), F.count("*").alias("copies"))
    distinct = materialise(distinct.withColumn("length", F.size("vector")), "vectors")
    links = roots = None
    for length in sorted(r[0] for r in distinct.select("length").distinct().collect()):
        one, hung = _linked(distinct.filter(F.col("length") == length).select("key", "vector", "copies"), least)
        links, roots = (one, hung) if links is None else (links.unionByName(one), roots.unionByName(hung))
    if links is None:
        homes = distinct.select("h1", "h2", "copies", F.col("key").alias("home"), F.lit(0).cast("long").alias("links"))
    else:
        joined = components(roots, "key", "root").withColumnRenamed("node", "key")
        homes = distinct.join(links, "key", "left").join(joined, "key", "left")
        homes = homes.select("h1", "h2", "copies", F.coalesce("component", "key").alias("home"), F.coalesce("links", F.lit(0)).alias("links"))
    result = rows.join(homes, ["h1", "h2"], "left")
    component = F.coalesce("home", "key")
    return result.select(
        F.col("key").alias(key),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("key") == component).alias("kept"),
    )
