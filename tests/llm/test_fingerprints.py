import hashlib
import random
from itertools import product

import pyarrow as pa

from fleetgauge.llm import fingerprints as S

ROWS = "doc_id long, text string, fingerprint int, stretch string"


def _text(drawn, words):
    return " ".join(drawn.choice("ash birch cedar elm fir oak pine yew".split()) + str(drawn.randrange(40)) for _ in range(words))


def test_search_finds_all_within_radius(spark):
    drawn = random.Random(1)
    base = [drawn.getrandbits(S.BITS) for _ in range(12)]
    marks = list(base)
    for b in base:
        for flips in range(0, 10):
            for at in drawn.sample(range(S.BITS), flips):
                b ^= 1 << at
            marks.append(b)
    hexes = [f"{m:032x}" for m in marks]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hexes + hexes[:5])], "doc_id long, fingerprint string")
    queries = df.filter("doc_id % 3 = 0")
    got = {(r.query, r.near, r.distance) for r in S.within_radius(queries, df).collect()}
    asked = {r.fingerprint for r in queries.collect()}
    true = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count()) for a, b in product(asked, set(hexes))}
    assert got == {t for t in true if t[2] <= S.RADIUS}


def test_edits_in_order_of_keys(spark, monkeypatch):
    drawn = random.Random(2)
    monkeypatch.setattr(S, "STRETCH", 7)
    rows = [(k * 3, _text(drawn, drawn.choice([0, 1, 2, 30])) + "é" * (k % 3), 1, "x") for k in range(60)]
    rows[10] = (rows[10][0], None, 1, None)
    df = spark.createDataFrame(drawn.sample(rows, len(rows)), ROWS).repartition(5)
    got = {r.doc_id: r for r in S.compare_edits(df).collect()}
    assert len(got) == len(rows)
    texts = [r[1] or "" for r in rows]
    marks = [f.tobytes().hex() for f in S.fingerprints(pa.array(texts))]
    for n, (key, *_) in enumerate(rows):
        after = (n + 1) % len(rows)
        half = len(texts[n]) // 2
        edited = texts[n][: len(texts[n]) - half] + texts[after][:half]
        row = got[key]
        assert (row.n_chars, row.edited_sha256) == (len(texts[n]), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, got[rows[after][0]].fingerprint) == (marks[n], marks[after])
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if marks[n] == marks[after]:
            assert row.near_next == 1


def test_likeness_tells_edited_from_other_texts():
    drawn = random.Random(3)
    texts = [_text(drawn, 200) for _ in range(80)]
    edited = [S.edited_text(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
    own, changed = S.fingerprints(pa.array(texts)), S.fingerprints(pa.array(edited))
    near, far = S.likeness(own, changed), S.likeness(own, own[[*range(1, 80), 0]])
    assert (near > far).mean() > 0.95 and (S.likeness(own, own) == 1).all()


def test_edge_rows(spark):
    rows = [(None, "a b", 1, ""), (None, "a b", 1, ""), (1, None, 1, ""), (2, "", 1, ""), (2, "", 1, ""), (3, "A  b", 1, None)]
    df = spark.createDataFrame(rows, ROWS)
    got = S.compare_edits(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "None", "None"]
    zero = "0" * 32
    assert {r.fingerprint for r in got if r.doc_id in (1, 2)} == {zero}
    marks = {r.fingerprint for r in S.fingerprint(df).collect() if r.doc_id is None or r.doc_id == 3}
    assert len(marks) == 1 and zero not in marks
    empty = df.limit(0)
    assert S.compare_edits(empty).collect() == [] and S.fingerprint(empty).collect() == []
    assert S.compare_edits(df.filter("doc_id = 3")).first().near_next == 1
