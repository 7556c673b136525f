"""The trie of conversations against a plain one of nested dictionaries."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from fleetgauge.llm import prefix_trie as X
from fleetgauge.llm.queries import PREFIX_TRIE_SQL, op11_conversation_prefix_trie


def _built(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def _plain(built):
    """Columns of the query, from all prefixes one by one."""
    members, ends = {}, {}
    for c, own in built.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
        ends.setdefault(tuple(own), []).append(c)
    kids = {}
    for prefix in members:
        if prefix:
            kids.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = kids.get(prefix, [])
        words = len(re.findall(X.WORD, prefix[-1][1])) if prefix else 0
        leaves[prefix] = sum(leaves[k] for k in below) if below else 1
        saved[prefix] = sum(saved[k] for k in below) + (len(members[prefix]) - 1) * words
    return sorted(
        (
            (
                min(own),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(own),
                len(kids.get(prefix, [])),
                leaves[prefix],
                saved[prefix],
                hashlib.sha256(",".join(map(str, sorted(ends.get(prefix, [])))).encode()).hexdigest(),
            )
            for prefix, own in members.items()
        ),
        key=repr,
    )


def _made(seed):
    drawn = random.Random(seed)
    rows = []
    for c in drawn.sample(range(400), 200):
        for turn in range(drawn.choice([1, 2, 3, 5, 9, 14])):
            role = drawn.choice(["user", "user", None])
            text = drawn.choice(["hi", "hi", "hi", "what is it ?", "  a\tb\x0bc ", "", None, f"own {c}"])
            rows.append((c, drawn.choice([None, turn, turn, 3]), role, text))
    for c in range(1000, 1060):  # copies, and a long common start
        rows += [(c, turn, "user", "same") for turn in range(10)] + ([(c, 10, "user", "end")] if c % 3 == 0 else [])
    return [*rows, (None, 1, "user", "nobody"), (60, 0, "user", "only"), (61, 0, "user", "x")]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed, bits, many", [(1, 16, 10_000), (2, 3, 2), (3, 5, 1)])
def test_trie_is_the_plain_one(spark, tmp_path, monkeypatch, seed, bits, many):
    monkeypatch.setattr(X, "MANY_CHILDREN", many)
    monkeypatch.setattr(X, "STRIDE", 2)
    monkeypatch.setattr(X, "IDS", 3)
    for name in ("in_order",):
        real = getattr(X, name)
        monkeypatch.setattr(X, name, lambda df, order, key, _bits, real=real: real(df, order, key, bits))
    rows = _made(seed)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    df.repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op11_conversation_prefix_trie(spark, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert _rows(got) == _plain(_built(rows))


def test_sql_is_the_plain_one(spark, tmp_path):
    rows = _made(4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = duckdb.connect()
    found.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert sorted(found.sql(PREFIX_TRIE_SQL).fetchall(), key=repr) == _plain(_built(rows))


def test_whole_table(spark, sf_dir, duck):
    assert _rows(op11_conversation_prefix_trie(spark, sf_dir)) == sorted(duck.sql(PREFIX_TRIE_SQL).fetchall(), key=repr)


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    nothing = spark.createDataFrame([], schema)
    assert X.prefix_trie(X.number(nothing)).collect() == []
    # Conversations without any turn are members of the root.
    ids = spark.createDataFrame([(7,), (5,), (None,), (5,)], "conv_id long")
    (root,) = X.prefix_trie(X.number(nothing), ids).collect()
    assert tuple(root) == (5, 0, None, 2, 0, 1, 0, hashlib.sha256(b"5,7").hexdigest())
    one = spark.createDataFrame([(3, None, None, None), (3, None, None, None), (None, 1, "a", "b")], schema)
    assert [(r.conv_id, r.depth, r.parent, r.n_convs, r.saved_tokens) for r in X.prefix_trie(X.number(one)).orderBy("depth").collect()] == [
        (3, 0, None, 1, 0), (3, 1, 3, 1, 0), (3, 2, 3, 1, 0),
    ]
    long = " ".join(["word"] * 200_000)
    two = spark.createDataFrame([(1, 0, "u", long), (2, 0, "u", long)], schema)
    assert {r.depth: r.saved_tokens for r in X.prefix_trie(X.number(two)).collect()} == {0: 200_000, 1: 200_000}
