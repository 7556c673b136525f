import numpy as np
import pytest

from fleetgauge.llm import vector_graph as V


def _brute(rows, least=0.9):
    known = [(k, np.array(v, dtype=float)) for k, v in rows if k is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links = {k: 0 for k, _ in rows}
    home = {k: k for k, _ in rows}
    pairs = []
    for i, (a, x) in enumerate(known):
        for b, y in known[i + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    for _ in rows:
        for a, b in pairs:
            home[a] = home[b] = min(home[a], home[b])
    return links, home


def _groups(count, copies, width=16, seed=4):
    drawn = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        centre = drawn.normal(size=width)
        for _ in range(drawn.integers(1, copies)):
            rows.append((centre + drawn.normal(size=width) * 0.15).astype(np.float32).tolist())
    return [(int(k), v) for k, v in zip(drawn.permutation(len(rows)), rows)]


@pytest.mark.parametrize("part", [2048, 40])
def test_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(V, "PART", part)
    monkeypatch.setattr(V, "PER_CENTRE", 60)
    rows = _groups(60, 9) + [(10_000 + k, v) for k, (_, v) in enumerate(_groups(1, 40, seed=5))]
    rows += [(20_000, rows[0][1]), (20_001, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in V.near_duplicates(df).collect()}
    links, home = _brute(rows)
    found = sum(r.n_links for r in got.values())
    assert all(got[k].n_links <= links[k] for k in links) and found >= 0.97 * sum(links.values())
    assert sum(got[k].component_id == home[k] for k in home) >= 0.97 * len(home)
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, None, 0), (5, [nan, 1.0], 0)]
    rows += [(6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, [], 0), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (10, [-0.0, 1.0], 0), (11, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in V.near_duplicates(df).collect())
    alone = [(str(k), 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)]
    linked = [("1", 2, 1, True), ("2", 2, 1, False), ("2", 2, 1, False), ("10", 1, 10, True), ("11", 1, 10, False)]
    assert got == sorted([*alone, *linked, ("None", 0, None, None)], key=str) or set(got) == {*alone, *linked, ("None", 0, None, None)}
    assert V.near_duplicates(df.limit(0)).collect() == []
    assert len(V.near_duplicates(df.filter("vec_id = 3")).collect()) == 1


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_all_comes_through_the_search(monkeypatch):
    """A task finds nothing but what its search of the graph leads to."""
    rows = sorted(_groups(40, 9))
    names = ["key", "shard", "i", "j", "part", "vector", "copies"]
    columns = [V.pa.array([k for k, _ in rows]), *[V.pa.array([0] * len(rows))] * 4, V.pa.array([v for _, v in rows]), V.pa.array([1] * len(rows))]
    tile = V.pa.RecordBatch.from_arrays(columns, names=names)
    near = {k: n for batch in V._shard_lists([tile]) for k, n in zip(*[c.to_pylist() for c in batch.columns])}
    tile = tile.append_column("near", V.pa.array([near[k] for k, _ in rows]))
    links, _ = _brute(rows)
    found = [r for batch in V._shard_pairs(0.9, False)([tile]) for r in batch.to_pylist()]
    assert sum(r["b"] is not None for r in found) >= 0.98 * sum(links.values()) / 2 > 50
    none = np.zeros(0, dtype=np.int64)
    monkeypatch.setattr(V, "search", lambda *_: (none, none))
    assert list(V._shard_pairs(0.9, False)([tile])) == []


@pytest.mark.parametrize("part", [2048, 60])
def test_recall_over_the_borders_of_shards(spark, monkeypatch, part):
    """Small shards with little overlap: groups lie across their borders, and lists of all shards are united."""
    monkeypatch.setattr(V, "PART", part)
    monkeypatch.setattr(V, "PER_CENTRE", 25)
    monkeypatch.setattr(V, "OVERLAP", 2)
    monkeypatch.setattr(V, "MOST_OVERLAP", 2)
    monkeypatch.setattr(V, "RECALL", 0.0)
    rows = _groups(150, 14, width=24, seed=8)
    got = {r.vec_id: r for r in V.near_duplicates(_frame(spark, rows)).collect()}
    links, home = _brute(rows)
    assert sum(links.values()) > 3000
    shares = [got[k].n_links / links[k] for k in links if links[k]]
    assert all(got[k].n_links <= links[k] for k in links) and np.mean(shares) >= 0.98
    assert np.mean([got[k].component_id == home[k] for k in home]) >= 0.98


def test_widening_goes_beyond_the_shards(spark):
    """a and c share no shard; both are in range of b, whose list names c."""
    key = "key long, vector array<float>, copies long"
    angles = {1: 0.0, 2: 0.2, 3: 0.4, 4: 0.6}
    vectors = spark.createDataFrame([(k, [float(np.cos(t)), float(np.sin(t))], k) for k, t in angles.items()], key)
    homes = spark.createDataFrame([(1, 0, [0]), (2, 0, [0, 1]), (2, 1, [0, 1]), (3, 1, [1, 2]), (3, 2, [1, 2]), (4, 2, [2])], "key long, shard long, shards array<long>")
    near = spark.createDataFrame([(1, [2]), (2, [1, 3]), (3, [2, 4]), (4, [3])], "key long, near array<long>")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")
    found = {(r.a, r.b, r.a_copies, r.b_copies) for r in V._widened(pairs, near, homes, vectors, float(np.cos(0.45))).collect()}
    assert found == {(1, 3, 1, 3), (2, 4, 2, 4)}
    # What is found in one round is gone on from in the next.
    found = {(r.a, r.b) for r in V._widened(pairs, near, homes, vectors, float(np.cos(0.65))).collect()}
    assert found == {(1, 3), (2, 4), (1, 4)}


def test_lists_are_pruned():
    drawn = np.random.default_rng(9)
    x = np.repeat(drawn.normal(size=(300, 16)), 3, axis=0) + drawn.normal(size=(900, 16)) * 0.05
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    lists = V.pruned_lists(x)
    assert lists.shape == (900, V.DEGREE) and (lists != np.arange(900)[:, None]).all()
    assert ((lists >= 0).sum(axis=1) >= 1).all() and (lists < 0).any()
    score = x @ x.T
    np.fill_diagonal(score, -1)
    assert (lists[:, 0] == score.argmax(axis=1)).all()


def test_audit_sees_lost_small_groups(spark):
    drawn = np.random.default_rng(6)
    big = drawn.normal(size=16) + drawn.normal(size=(300, 16)) * 0.01
    small = np.repeat(drawn.normal(size=(20, 16)), 2, axis=0)
    small[1::2] += drawn.normal(size=(20, 16)) * 0.01
    rows = [(k, v.tolist(), 1) for k, v in enumerate([*big, *small])]
    vectors = spark.createDataFrame(rows, "key long, vector array<float>, copies long")
    links = spark.createDataFrame([(k, 299) for k in range(300)], "key long, links long")
    assert V.audit_recall(vectors, links, 0.9) < V.RECALL
    links = spark.createDataFrame([(k, 299 if k < 300 else 1) for k in range(340)], "key long, links long")
    assert V.audit_recall(vectors, links, 0.9) == 1


def test_last_round_is_audited(spark, monkeypatch):
    monkeypatch.setattr(V, "PER_CENTRE", 10)
    monkeypatch.setattr(V, "OVERLAP", 1)
    monkeypatch.setattr(V, "MOST_OVERLAP", 1)
    monkeypatch.setattr(V, "RECALL", 1.0)
    rows = _groups(60, 9)
    got = {r.vec_id: r for r in V.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    links, home = _brute(rows)
    assert all(got[k].n_links == links[k] and got[k].component_id == home[k] for k in links)
