"""Quotations in messages linked to what they quote, and conversations in reply order.

Every step is a DataFrame expression or join. A line's quote level is the number of ``>``
that it begins with. Lines of one level that follow each other are a passage. A passage
is normalised to its letters and digits in lower case and known by its hash, and so is
each of its lines. Messages are indexed by the hashes of their own passages and lines;
a quoted passage is of the earliest message that has it whole, or else the earliest that
has one of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.session import materialise

# Up to three blanks may stand before each sign.
MARK = r"^(?:[ \t]{0,3}>)+[ \t]?"
# A line that announces the quotation after it.
ANNOUNCES = r"(?i)\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b.*:\s*$"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")))


def _hash(text: Column) -> Column:
    return F.md5(text)


def _bound(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once, whatever looks at them.

    A projection would be merged into the next one, and an array worked out again for every
    element that a lambda there looks at. A generator keeps them apart.
    """
    named = F.struct(*[value.alias(name) for name, value in columns.items()])
    bound = df.select("*", F.explode(F.array(named)).alias("_bound"))
    return bound.select(*df.columns, *[F.col(f"_bound.{name}").alias(name) for name in columns])


def _parsed(messages: DataFrame) -> DataFrame:
    """Messages with ``passages``: (level, line contents), written once as all later steps read them.

    The cost is of the number of lines, however many passages they are in.
    """
    df = _bound(messages, raw=F.split(F.coalesce("text", F.lit("")), "\n", -1))
    df = _bound(
        df,
        levels=F.transform("raw", quote_level),
        contents=F.transform("raw", lambda line: F.regexp_replace(line, MARK, "")),
    ).drop("raw", "text")
    # Lines, from 0, with which a passage begins.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("levels") - 1),
        lambda k: (k == 0) | (F.get("levels", k) != F.get("levels", F.greatest(k - 1, F.lit(0)))),
    )
    df = _bound(df, begins=starts)
    df = _bound(df, ends=F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("levels"))))
    df = _bound(df, spans=F.arrays_zip("begins", "ends")).drop("begins", "ends")

    def passage(span: Column) -> Column:
        lines = F.slice("contents", span["begins"] + 1, span["ends"] - span["begins"])
        # The last line of an own passage goes, if it announces the quotation that follows.
        announces = (
            (F.get("levels", span["begins"]) == 0)
            & F.coalesce(F.get("levels", span["ends"]) > 0, F.lit(False))
            & F.get("contents", span["ends"] - 1).rlike(ANNOUNCES)
        )
        own = F.when(announces, F.slice("contents", span["begins"] + 1, span["ends"] - span["begins"] - 1)).otherwise(lines)
        return F.struct(F.get("levels", span["begins"]).alias("level"), own.alias("lines"))

    df = _bound(df, passages=F.transform("spans", passage)).drop("levels", "contents", "spans")
    return materialise(df, "messages")


def _keys(lines: Column) -> Column:
    """Hashes of a passage, then of its lines, those without letters and digits left out."""
    whole = normalised(F.array_join(lines, " "))
    every = F.concat(F.array(whole), F.transform(lines, normalised))
    return F.transform(F.filter(every, lambda t: t != ""), _hash)


def link_quotations(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``passage``, ``level`` of each quoted passage, and ``from_conv``, ``from_turn``.

    A passage is looked for in earlier messages of its own conversation first, then in
    other conversations, of whose messages the smallest (conversation, turn) that has it
    counts. The whole passage goes before its lines. Both are null if no message has it.
    """
    return _links(_parsed(messages))


def _links(own: DataFrame) -> DataFrame:
    said = F.filter("passages", lambda p: p["level"] == 0)
    keys = F.array_distinct(F.flatten(F.transform(said, lambda p: _keys(p["lines"]))))
    index = own.select("conv_id", "turn", F.explode(keys).alias("hash")).filter("conv_id is not null and turn is not null")
    # One row for a hash and conversation, and one for a hash, with the two smallest conversations
    # that have it, of which one is another than the quoting one: however many messages say the
    # same, a quotation meets one of them.
    here = index.groupBy("hash", "conv_id").agg(F.min("turn").alias("here"))
    place = F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))
    spots = here.withColumn("place", place).filter("place <= 2").select("hash", F.struct("conv_id", F.col("here").alias("turn")).alias("spot"))
    ends = spots.groupBy("hash").agg(F.min("spot").alias("first"), F.max("spot").alias("second"))

    quoted = own.select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
    quoted = quoted.select("conv_id", "turn", "passage", "p.level", "p.lines").filter("level > 0").distinct()
    tried = quoted.select("conv_id", "turn", "passage", F.posexplode(_keys(F.col("lines"))).alias("try", "hash"))
    tried = tried.join(here, ["hash", "conv_id"], "left").join(ends, "hash", "left")
    inside = F.when(F.col("here") < F.col("turn"), F.struct("conv_id", F.col("here").alias("turn")))
    outside = F.when(~F.col("first.conv_id").eqNullSafe(F.col("conv_id")), F.col("first"))
    outside = outside.when(~F.col("second.conv_id").eqNullSafe(F.col("conv_id")), F.col("second"))
    # A whole passage, try 0, goes before lines; the own conversation goes before others.
    tried = tried.withColumn("origin", F.coalesce(inside, outside)).filter("origin is not null")
    rank = F.struct(F.least("try", F.lit(1)).alias("try"), F.isnull(inside).alias("outside"), F.col("origin"))
    best = tried.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("passage").alias("n"))
    best = best.agg(F.min(rank)["origin"].alias("origin"))
    spot = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("passage") == F.col("n"))
    linked = quoted.join(best, spot, "left")
    return linked.select(
        "conv_id", "turn", "passage", "level", F.col("origin.conv_id").alias("from_conv"), F.col("origin.turn").alias("from_turn")
    )


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of messages that reply to another, by doubling the distance looked back."""
    walk = materialise(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        up = walk.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        far = walk.join(up, ["conv_id", "root"], "left")
        if far.filter("next is not null").isEmpty():
            return walk
        far = far.select("conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        walk = materialise(far, "replies")


def reply_order(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Every message without its quotations, and where it stands among the replies.

    ``text`` has the lines that quote nothing, without the line that announces a quotation,
    and without blank lines around; ``n_quoted`` passages were quoted, of which ``n_linked``
    were found. ``parent_turn`` is the message of the same conversation that the first
    passage of level 1 is of, ``root_turn`` the message where its chain of replies began
    (the own turn without a parent), ``depth`` the length of that chain. Conversations read
    in reply order by (``conv_id``, ``root_turn``, ``depth``, ``turn``): thread after
    thread, and no reply before what it answers.

    A null text is empty. Messages without conversation or turn keep their rows, quote and
    are quoted by nobody. Repeated rows of a message keep a row each; its earliest passage
    decides. Other columns are not read, whatever their names; an empty table gives an
    empty result.
    """
    kinds = {"conv_id": conv, "turn": turn, "role": role}
    messages = conversations.select(*[F.col(c).alias(n) for n, c in kinds.items()], F.col(text).cast("string").alias("text"))
    own = _parsed(messages)
    links = materialise(_links(own), "quotations")
    counted = links.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quoted"),
        F.count("from_turn").alias("n_linked"),
        F.min(
            F.when((F.col("level") == 1) & (F.col("from_conv") == F.col("conv_id")), F.struct("passage", "from_turn"))
        )["from_turn"].alias("parent"),
    )
    threads = _threads(counted.filter("parent is not null"))
    counted = counted.join(threads, ["conv_id", "turn"], "left")
    said = F.flatten(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["lines"]))
    clean = F.regexp_replace(F.array_join(said, "\n"), r"^\s+|\s+$", "")
    own = own.select("conv_id", "turn", "role", clean.alias("text"))
    rows = own.join(counted, ["conv_id", "turn"], "left")
    return rows.select(
        F.col("conv_id").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        "text",
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )


# The same in the SQL of the checking engine, over a view ``conversations``.
REPLY_ORDER_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations
), line AS (
  SELECT id, conv_id, turn, k, ls[k] AS l,
    length(regexp_replace(regexp_extract(ls[k], '^(?:[ \t]{0,3}>)+[ \t]?'), '[^>]', '', 'g')) AS level,
    regexp_replace(ls[k], '^(?:[ \t]{0,3}>)+[ \t]?', '') AS content
  FROM (SELECT id, conv_id, turn, ls, unnest(generate_series(1, len(ls))) AS k FROM raw)
), turned AS (
  SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY id ORDER BY k) THEN 0 ELSE 1 END AS new,
    lead(level) OVER (PARTITION BY id ORDER BY k) AS next_level FROM line
), run AS (
  SELECT *, sum(new) OVER (PARTITION BY id ORDER BY k) - 1 AS passage,
    trim(lower(regexp_replace(content, '[^\p{L}\p{N}]+', ' ', 'g'))) AS norm
  FROM turned
  WHERE NOT (level = 0 AND coalesce(next_level, 0) > 0
    AND regexp_matches(content, '(?i)\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b.*:\s*$'))
), passages AS (
  SELECT id, any_value(conv_id) AS conv_id, any_value(turn) AS turn, passage, any_value(level) AS level,
    trim(lower(regexp_replace(string_agg(content, ' ' ORDER BY k), '[^\p{L}\p{N}]+', ' ', 'g'))) AS whole
  FROM run GROUP BY id, passage
), keys AS (
  SELECT id, conv_id, turn, passage, level, 0 AS try, md5(whole) AS hash FROM passages WHERE whole <> ''
  UNION ALL
  SELECT id, conv_id, turn, passage, level, 1, md5(norm) FROM run WHERE norm <> ''
), idx AS (
  SELECT DISTINCT hash, conv_id, turn FROM keys WHERE level = 0 AND conv_id IS NOT NULL AND turn IS NOT NULL
), tried AS (
  SELECT q.conv_id, q.turn, q.passage, q.try,
    CASE WHEN h.turn < q.turn THEN 0 ELSE 1 END AS outside,
    CASE WHEN h.turn < q.turn THEN q.conv_id ELSE f.conv_id END AS from_conv,
    CASE WHEN h.turn < q.turn THEN h.turn ELSE f.turn END AS from_turn
  FROM (SELECT DISTINCT conv_id, turn, passage, try, hash FROM keys WHERE level > 0) q
  LEFT JOIN (SELECT hash, conv_id, min(turn) AS turn FROM idx GROUP BY ALL) h ON h.hash = q.hash AND h.conv_id = q.conv_id
  LEFT JOIN (SELECT hash, min({'c': conv_id, 't': turn}).c AS conv_id, min({'c': conv_id, 't': turn}).t AS turn FROM idx GROUP BY hash) f
    ON f.hash = q.hash AND f.conv_id IS DISTINCT FROM q.conv_id
), best AS (
  SELECT conv_id, turn, passage, min({'a': try, 'b': outside, 'c': from_conv, 'd': from_turn}) AS o
  FROM tried WHERE from_turn IS NOT NULL GROUP BY ALL
), quoted AS (
  SELECT p.conv_id, p.turn, p.passage, p.level, b.o.c AS from_conv, b.o.d AS from_turn
  FROM (SELECT DISTINCT conv_id, turn, passage, level FROM passages WHERE level > 0) p
  LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM p.conv_id AND b.turn IS NOT DISTINCT FROM p.turn AND b.passage = p.passage
), counted AS (
  SELECT conv_id, turn, count(*) AS n_quoted, count(from_turn) AS n_linked,
    arg_min(from_turn, passage) FILTER (level = 1 AND from_conv = conv_id) AS parent
  FROM quoted GROUP BY conv_id, turn
), chain AS (
  SELECT conv_id, turn, parent AS root, CAST(1 AS BIGINT) AS depth FROM counted WHERE parent IS NOT NULL
  UNION ALL
  SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM chain c
  JOIN counted p ON p.conv_id = c.conv_id AND p.turn = c.root WHERE p.parent IS NOT NULL
), ends AS (
  SELECT conv_id, turn, max(depth) AS depth, arg_max(root, depth) AS root FROM chain GROUP BY ALL
), own AS (
  SELECT r.id, r.conv_id, r.turn, r.role,
    regexp_replace(coalesce(string_agg(content, chr(10) ORDER BY k) FILTER (level = 0), ''), '^\s+|\s+$', '', 'g') AS text
  FROM raw r LEFT JOIN run USING (id) GROUP BY r.id, r.conv_id, r.turn, r.role
)
SELECT o.conv_id, o.turn, o.role, o.text, c.parent AS parent_turn, coalesce(e.root, o.turn) AS root_turn,
  coalesce(e.depth, 0) AS depth, coalesce(c.n_quoted, 0) AS n_quoted, coalesce(c.n_linked, 0) AS n_linked
FROM own o LEFT JOIN counted c ON c.conv_id = o.conv_id AND c.turn = o.turn
LEFT JOIN ends e ON e.conv_id = o.conv_id AND e.turn = o.turn
"""
