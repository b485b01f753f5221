"""Chat formatting: quoted passages are linked to their messages, and conversations put in reply order without them.

DataFrame functions only. No step gathers a conversation: one that holds a third of all rows is many rows of ordinary
aggregates, joins by message, and a range-partitioned ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverlay.operators.stage import store

#: Quoted lines shorter than this, once normalised, are too common to say whom they quote.
LEAST = 12

_PREFIX = r"^[ \t>]*>"
_ATTRIBUTION = r"^On [^\n]{1,200} wrote:[ \t]*\n([ \t]*>)"
_QUOTED = r"^[ \t]*>[^\n]*(?:\n|\z)"
_SPACE = r"[\x09-\x0D\x20]+"


def level(line: Column) -> Column:
    """Nesting of a line's quotation: how many ``>`` it starts with, spaces and tabs between them aside."""
    prefix = F.regexp_extract(line, _PREFIX, 0)
    return F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))


def normalised(line: Column) -> Column:
    """A line without its quote marks, in lower case, white space as single spaces."""
    body = F.substring(line, F.length(F.regexp_extract(line, _PREFIX, 0)) + 1, F.length(line))
    return F.trim(F.regexp_replace(F.lower(body), _SPACE, " "))


def without_quotes(text: Column) -> Column:
    """A text without quoted lines, the ``On ... wrote:`` lines right before them, and space around what is left."""
    plain = F.regexp_replace(F.regexp_replace(text, "(?dm)" + _ATTRIBUTION, "$1"), "(?dm)" + _QUOTED, "")
    return F.regexp_replace(plain, r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+\z", "")


def passages(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """``conv, turn, level, hash, size`` of every line long enough to tell, level 0 being the author's own."""
    lines = messages.where(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.explode(F.split(text, "\n")).alias("line")
    )
    body = lines.select("conv", "turn", level(F.col("line")).alias("level"), normalised(F.col("line")).alias("body"))
    return body.where(F.length("body") >= LEAST).select("conv", "turn", "level", F.xxhash64("body").alias("hash"), F.length("body").alias("size"))


def quotation_links(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv, turn, level, hash, size, original``: each quoted line and the message it comes from.

    The original is the first message of the conversation that holds the line as its author's own, if it is earlier
    than the quoting one. Own lines are pre-aggregated to one row per conversation and line, so a line that stands in
    any number of messages is one join partner.
    """
    quoting = messages.where(F.col(text).rlike("(?dm)^[ \t]*>"))
    quoted = passages(quoting, conv, turn, text).where("level > 0").distinct()
    talks = quoting.select(F.col(conv).alias("conv")).distinct()
    own = passages(messages, conv, turn, text).where("level = 0").join(talks, "conv", "left_semi")
    first = own.groupBy("conv", "hash").agg(F.min("turn").alias("original"))
    return quoted.join(first, ["conv", "hash"]).where("original < turn").select("conv", "turn", "level", "hash", "size", "original")


def replies(links: DataFrame) -> DataFrame:
    """``conv, turn, parent``: the message that a message answers, from its first-level quotations.

    It is the one most characters are quoted from; of equals, the latest.
    """
    votes = links.where("level = 1").groupBy("conv", "turn", "original").agg(F.sum("size").alias("chars"))
    return votes.groupBy("conv", "turn").agg(F.max_by("original", F.struct("chars", "original")).alias("parent"))


def threads(parents: DataFrame) -> DataFrame:
    """``conv, turn, parent, root, depth`` of all answers, by pointer doubling: as many rounds as log2 of the depth."""
    now = store(parents.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        up = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        step = now.join(up, ["conv", "root"], "left")
        moved = step.where(F.col("_root").isNotNull())
        if moved.isEmpty():
            return now
        now = store(step.select("conv", "turn", "parent", F.coalesce("_root", "root").alias("root"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "replies")


def _same(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> list[Column]:
    return [left[a].eqNullSafe(right[b]) for a, b in keys.items()]


def reply_order(keys: DataFrame) -> DataFrame:
    """``conv, turn, parent, root, depth, position`` from ``..., n``: rank in the conversation by root, depth, turn.

    Rows are dealt by range over all conversations, counted within each range, and stitched at the seams, so the
    largest conversation is ranked by many tasks.
    """
    order = ["root", "depth", "turn"]
    dealt = store(keys.repartitionByRange("conv", *order).withColumn("pid", F.spark_partition_id()), "reply-order")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = dealt.withColumn("inner", before(W.partitionBy("pid", "conv").orderBy(*order)))
    parts = dealt.groupBy("conv", "pid").agg(F.sum("n").alias("n"))
    seams = parts.select(F.col("conv").alias("_conv"), F.col("pid").alias("_pid"), before(W.partitionBy("conv").orderBy("pid")).alias("outer"))
    joined = inner.join(seams, [inner.conv.eqNullSafe(seams["_conv"]), inner.pid == seams["_pid"]])
    return joined.select("conv", "turn", "parent", "root", "depth", (F.col("inner") + F.col("outer")).alias("position"))


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, reply_to, root, depth, position``: one row per message, texts without quotations.

    ``reply_to`` is the turn that a message quotes (null: none found); such chains lead to ``root``, the turn they
    start from, ``depth`` answers up. ``position`` ranks a conversation's messages by root, depth and turn, from 0, so
    every answer comes after what it answers. Messages with equal conversation and turn share one position, and the
    next one counts them all. Null conversations and turns are kept, grouped as equals, nulls first, and never linked;
    a null text stays null, and one of quotes alone becomes empty. Other columns are ignored; an empty table gives an
    empty result.
    """
    found = threads(replies(quotation_links(messages, conv, turn, text)))
    keys = messages.groupBy(F.col(conv).alias("conv"), F.col(turn).alias("turn")).agg(F.count("*").alias("n"))
    placed = keys.join(found, ["conv", "turn"], "left").select(
        "conv", "turn", "parent", F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n"
    )
    order = reply_order(placed).withColumnsRenamed({"conv": "_conv", "turn": "_turn"})
    rows = messages.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.col(role).alias("_r"), without_quotes(F.col(text)).alias("_x"))
    return rows.join(order, _same(rows, order, {"_c": "_conv", "_t": "_turn"})).select(
        F.col("_c").alias(conv), F.col("_t").alias(turn), F.col("_r").alias(role), F.col("_x").alias(text), F.col("parent").alias("reply_to"), "root", "depth", "position"
    )


# the same result by plain joins and a recursion, for DuckDB
SQL = rf"""WITH RECURSIVE lines AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    cut AS (SELECT conv_id, turn, line, regexp_extract(line, '{_PREFIX}') AS prefix FROM lines),
    body AS (SELECT conv_id, turn, length(prefix) - length(replace(prefix, '>', '')) AS level,
        trim(regexp_replace(lower(substr(line, length(prefix) + 1)), '{_SPACE}', ' ', 'g')) AS body FROM cut),
    own AS (SELECT conv_id, body, min(turn) AS original FROM body WHERE level = 0 AND length(body) >= {LEAST} GROUP BY 1, 2),
    votes AS (SELECT q.conv_id, q.turn, original, sum(length(body)) AS chars
        FROM (SELECT DISTINCT * FROM body WHERE level = 1 AND length(body) >= {LEAST}) q JOIN own USING (conv_id, body) WHERE original < q.turn GROUP BY 1, 2, 3),
    up AS (SELECT conv_id, turn, original AS parent FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY chars DESC, original DESC) = 1),
    climb AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM up
        UNION ALL SELECT c.conv_id, c.turn, u.parent, depth + 1 FROM climb c JOIN up u ON u.conv_id = c.conv_id AND u.turn = c.root),
    top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM climb GROUP BY 1, 2)
    SELECT m.conv_id, m.turn, m.role,
        regexp_replace(regexp_replace(regexp_replace(m.text, '(?m){_ATTRIBUTION}', '\1', 'g'), '(?m){_QUOTED}', '', 'g'), '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+\z', '', 'g') AS text,
        u.parent AS reply_to, coalesce(t.root, m.turn) AS root, coalesce(t.depth, 0) AS depth,
        rank() OVER (PARTITION BY m.conv_id ORDER BY coalesce(t.root, m.turn), coalesce(t.depth, 0), m.turn) - 1 AS position
    FROM conversations m LEFT JOIN up u ON u.conv_id = m.conv_id AND u.turn = m.turn LEFT JOIN top t ON t.conv_id = m.conv_id AND t.turn = m.turn"""
