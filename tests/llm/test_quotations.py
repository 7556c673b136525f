import random
import time

import duckdb
import pandas as pd
import pytest

from fleetgauge.llm import quotations as Q

ROWS = [
    (1, 0, "user", "Hello there.\nHow do I open the gate?\nThanks"),
    (1, 1, "assistant", "On Monday, user wrote:\n> How do I open the gate?\nPush it.\nThen pull."),
    (1, 2, "user", "> > How do I open the gate?\n> Push it.\n> Then pull.\nIt works!\n> never said this"),
    (1, 3, "user", ">Push it. THEN pull!\n\nsame here"),
    (1, 4, "assistant", ">>It works!\n> something else\n> same here\nok"),
    (2, 0, "user", "> It works!\nI saw this elsewhere"),
    (2, 1, "user", "yes"),
    (2, 2, "user", "yes"),
    (2, 3, "user", ">yes\nno"),
    (2, 4, None, None),
    (2, 5, "x", ""),
    (None, 6, "user", "> yes\nq"),
    (2, None, "user", "> yes\nr"),
    (3, 0, "user", "> > > \n>\n   > deep\n"),
    (3, 1, "user", "deep"),
    (3, 2, "u", "> deep\n>> deep"),
    (3, 2, "u", "> deep\n>> deep"),
    *[(4, k, "u", f"> line {k - 1}\nline {k}") for k in range(12)],
]
SCHEMA = "conv_id long, turn long, role string, text string"


def _made(seed):
    """Conversations that quote themselves and each other, at several levels, often the same lines."""
    drawn = random.Random(seed)
    rows = []
    for conv in range(400):
        said = []
        for turn in range(drawn.randint(1, 9)):
            lines = []
            for _ in range(drawn.randint(1, 4)):
                if said and drawn.random() < 0.6:
                    source = drawn.choice(said if drawn.random() < 0.7 or not rows else [drawn.choice(rows)[3]])
                    level = drawn.choice([">", "> ", "> > ", ">>> ", " > "])
                    if drawn.random() < 0.3:
                        lines.append(drawn.choice(["On Monday, she wrote:", "er schrieb:", "she said so:"]))
                    lines += [level + line for line in source.split("\n")[: drawn.randint(1, 3)]]
                else:
                    lines.append(drawn.choice(["yes", "No, thanks!", f"own {drawn.randint(0, 60)} words", "", "  ", f"c{conv} t{turn}"]))
            text = "\n".join(lines)
            said.append(text)
            rows.append((conv, turn, drawn.choice(["user", "assistant"]), text))
    return rows


@pytest.mark.parametrize("rows", [ROWS, _made(1)], ids=["edges", "made"])
def test_against_sql(spark, rows):
    got = Q.reply_order(spark.createDataFrame(rows, SCHEMA))
    if len(rows) > 1000:
        totals = got.selectExpr("sum(n_quoted) q", "sum(n_linked) l", "max(depth) d").first()
        assert totals.q > 2000 and totals.l > 1500 and totals.d >= 3
    # The view of this name is what the SQL reads.
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    engine = duckdb.connect()
    engine.register("conversations", conversations)
    reply = engine.execute(Q.REPLY_ORDER_SQL)
    names = [d[0] for d in reply.description]
    assert sorted(names) == sorted(got.columns)
    theirs = sorted(repr(tuple(r[names.index(c)] for c in got.columns)) for r in reply.fetchall())
    assert sorted(repr(tuple(r)) for r in got.collect()) == theirs


def test_threads(spark):
    rows = {(r.conv_id, r.turn): r for r in Q.reply_order(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert (rows[1, 4].parent_turn, rows[1, 4].root_turn, rows[1, 4].depth) == (3, 0, 3)
    assert (rows[4, 11].root_turn, rows[4, 11].depth) == (0, 11)
    assert rows[1, 1].text == "Push it.\nThen pull." and rows[1, 2].n_quoted == 3 and rows[1, 2].n_linked == 2
    assert all(">" not in r.text for r in rows.values())


def test_native_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA + ", depth int, hash string")
    result = Q.reply_order(df)
    assert result.collect() == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_next_conversation_is_tried(spark):
    rows = [(1, 3, "> the same passage"), (1, 5, "the same passage"), (2, 0, "the same passage"), (3, 0, "the same passage")]
    rows += [(0, 0, "> said nowhere else"), (0, 1, "said nowhere else"), (3, 1, "> the same passage")]
    got = Q.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert sorted((r.conv_id, r.turn, r.from_conv, r.from_turn) for r in got if r.from_conv is not None) == [(1, 3, 2, 0), (3, 1, 3, 0)]
    assert len(got) == 3


def test_long_messages_cost_their_lines(spark):
    """One message of very many passages, and one of a single very long line."""
    lines = "\n".join(f"own {k}\n> quoted {k}" for k in range(6400))
    rows = [(1, 0, "u", "\n".join(f"quoted {k}" for k in range(6400))), (1, 1, "u", lines), (2, 0, "u", "> " + "word " * 400_000)]
    start = time.monotonic()
    got = {(r.conv_id, r.turn): r for r in Q.reply_order(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert time.monotonic() - start < 60
    assert (got[1, 1].n_quoted, got[1, 1].n_linked, got[1, 1].parent_turn) == (6400, 6400, 0)
    assert got[1, 1].text.count("\n") == 6399 and got[2, 0].text == ""
