"""The trie of conversation prefixes: digests of all prefixes, screened by a count-min sketch, grouped exactly where shared."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import record
from coverlay.llm.merkle import CRC32_SQL
from coverlay.operators.spread import look_up, running
from coverlay.operators.stage import store

#: Rows of the sketch; each takes its own 32 bits of a prefix's 128-bit digest.
ROWS = 4
#: Counters per row: twice as many as prefixes, within these bounds. The upper one bounds what is sent to every task
#: (2 bits a counter), not what is counted: a fuller sketch only lets more prefixes through to the exact grouping.
LEAST_WIDTH, MOST_WIDTH = 1 << 12, 1 << 24
_BLOCK = 1 << 12  # bytes of a bitmap in one record
_IDS = 512  # ids in one piece of a list that is hashed
_NONE = hashlib.sha256(b"").hexdigest()


# ---- conversations and the digests of their prefixes ----


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``c, place, h1, h2, cp``: every turn by its place in its conversation, 128 bits of its role and text, its code points.

    Turns are ordered by ``turn``, null first; equal ones by their hash. Null roles and texts are empty. Rows without a
    conversation are left out. Texts are hashed where they are read and don't travel.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(text, F.lit("/"), role).alias("h2"), F.char_length(text).cast("long").alias("cp"),
    )
    return running(rows, ["c"], ["turn", "h1", "h2"]).select("c", "place", "h1", "h2", "cp")


def grafted(rows: DataFrame, shared: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first of their family: ``(c, i, length, h1, h2, cp)`` per turn and ``(c, length)`` each.

    Conversation ``c`` begins with the first ``h`` turns of conversation ``c - c % family`` (all it has if fewer, none if
    there is no such conversation) and goes on with its own after its first ``h``; ``h`` is the CRC-32 of its id modulo
    ``shared``.
    """
    h = F.crc32(F.col("c").cast("string").cast("binary")) % shared
    sizes = rows.groupBy("c").agg(F.max("place").alias("n"))
    heads = sizes.select(F.col("c").alias("base"), F.col("n").alias("there"))
    plan = sizes.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % family).alias("base")).join(heads, "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    plan = store(plan.select("c", "base", "h", taken.alias("k"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    first = rows.where(F.col("place") < shared).select(F.col("c").alias("base"), "place", "h1", "h2", "cp")
    given = plan.join(first, "base").where("place <= k").select("c", F.col("place").alias("i"), "length", "h1", "h2", "cp")
    own = look_up(rows.where(F.col("place") > h), ["c"], plan.select("c", "h", "k", "length"))
    own = own.select("c", (F.col("place") - F.col("h") + F.col("k")).alias("i"), "length", "h1", "h2", "cp")
    return given.unionByName(own), plan.select("c", "length")


def _key(depth: Column, words: list[Column]) -> list[Column]:
    return [F.xxhash64(depth, words[0], words[1]), F.xxhash64(depth, words[2], words[3])]


def prefixes(rows: DataFrame) -> DataFrame:
    """``c, i, length, cp, k1, k2, p1, p2``: 128-bit digests of each prefix and of the one a turn shorter.

    A prefix is the sum of hashes of its turns with their places. Sums can be carried from task to task, so a conversation is scanned by
    as many tasks as it is long.
    """
    word = [F.xxhash64(F.lit(seed), "i", "h1", "h2") for seed in (1, 2)]
    split = {f"w{2 * j + b}": (F.shiftrightunsigned(w, 32) if b else w.bitwiseAND(F.lit(0xFFFFFFFF))) for j, w in enumerate(word) for b in (0, 1)}
    names = list(split)
    summed = running(rows.withColumns(split), ["c"], ["i"], names, "_place")
    here, there = [F.col(f"{w}_upto") for w in names], [F.col(f"{w}_upto") - F.col(w) for w in names]
    keys = [*_key(F.col("i"), here), *_key(F.col("i") - 1, there)]
    return summed.select("c", "i", "length", "cp", *[k.alias(n) for k, n in zip(keys, ("k1", "k2", "p1", "p2"), strict=True)])


# ---- the sketch ----


def _cells(k1: np.ndarray, k2: np.ndarray, width: int) -> list[np.ndarray]:
    """Counter of each digest in each row."""
    parts = []
    for k in (k1, k2):
        k = k.view(np.uint64)
        parts += [k & np.uint64(0xFFFFFFFF), k >> np.uint64(32)]
    return [(p & np.uint64(width - 1)).astype(np.int64) + r * width for r, p in enumerate(parts)]


def sketch(keys: DataFrame, width: int) -> bytes:
    """Count-min sketch of ``k1, k2`` whose counters stop at two, as the bitmap of those that reached it.

    Tasks fill a sketch each and pass on its blocks as two bitmaps, once and twice; blocks are added up task by task. Only
    the last bitmap reaches the driver, ``ROWS * width / 8`` bytes.
    """

    def fill(batches):
        once, twice = (np.zeros(ROWS * width, bool) for _ in range(2))
        for batch in batches:
            for cells in _cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), width):
                seen, n = np.unique(cells, return_counts=True)
                twice[seen] |= once[seen] | (n > 1)
                once[seen] = True
        a, b = np.packbits(once), np.packbits(twice)
        for at in range(0, len(a), _BLOCK):
            if a[at : at + _BLOCK].any():
                yield record(block, [at], [a[at : at + _BLOCK].tobytes()], [b[at : at + _BLOCK].tobytes()])

    def add(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for at, *maps in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = (np.frombuffer(m, np.uint8) for m in maps)
                if at in held:
                    x, y = held[at]
                    held[at] = [x | a, y | b | (x & a)]
                else:
                    held[at] = [a, b]
        for at, (_, b) in held.items():
            yield record(block, [at], [b""], [b.tobytes()])

    block = [("at", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())]
    ddl = "at long, once binary, twice binary"
    total = keys.select("k1", "k2").mapInArrow(fill, ddl).repartition("at").mapInArrow(add, ddl)
    out = bytearray(ROWS * width // 8)
    for r in total.select("at", "twice").collect():
        out[r.at : r.at + len(r.twice)] = r.twice
    return bytes(out)


def screened(rows: DataFrame, most_width: int = MOST_WIDTH) -> DataFrame:
    """``rows`` of :func:`prefixes` with ``shared`` and ``parent_shared``: false if the sketch proves that only one conversation has it."""
    width = LEAST_WIDTH
    n = 2 * rows.count()
    while width < min(n, most_width):
        width *= 2
    seen = rows.sparkSession.sparkContext.broadcast(sketch(rows, width))
    names = [*rows.columns, "shared", "parent_shared"]

    def look(batches):
        twice = np.frombuffer(seen.value, np.uint8)

        def estimate(k1, k2):
            out = np.ones(len(k1), bool)
            for cells in _cells(k1, k2, width):
                out &= (twice[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
            return out

        for batch in batches:
            k1, k2, p1, p2 = (batch.column(i).to_numpy() for i in range(4, 8))
            root = batch.column(1).to_numpy() == 1  # its parent has no turns: all share it
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(estimate(k1, k2)), pa.array(estimate(p1, p2) | root)], names=names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(look, f"{kinds}, shared boolean, parent_shared boolean")


# ---- nodes ----


def list_digests(rows: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: SHA-256 of the ids ``c`` of each key, ascending and comma-joined.

    The ids are sorted by range over all tasks and joined in pieces there; a hash is one after the other by nature, so
    the pieces of one key then pass through one task, which holds one batch of them.
    """
    piece = [("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())]
    done = [("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]

    def join(batches):
        for batch in batches:
            k1, k2, c = (batch.column(i).to_numpy() for i in range(3))
            change = (np.diff(k1) != 0) | (np.diff(k2) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(c)]
            cuts = [(i, min(i + _IDS, b)) for a, b in zip(edges, edges[1:], strict=False) for i in range(a, b, _IDS)]
            if cuts:
                yield record(piece, *(x[[i for i, _ in cuts]] for x in (k1, k2, c)), [b",".join(b"%d" % v for v in c[i:j].tolist()) for i, j in cuts])

    def hashed(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key == (k1, k2):
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids)
            if out:
                yield record(done, *map(list, zip(*out, strict=True)))
        if key is not None:
            yield record(done, [key[0]], [key[1]], [state.hexdigest()])

    order = ["k1", "k2", "c"]
    pieces = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "k1 long, k2 long, first long, ids binary")
    dealt = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def nodes(rows: DataFrame, all_lengths: DataFrame, most_width: int = MOST_WIDTH) -> DataFrame:
    """One row per node of the trie over turns (``c, i, length, h1, h2, cp``) of conversations (``c, length``).

    ``conv_id`` is a node's smallest member, ``depth`` its number of turns, ``parent_conv_id`` the parent's smallest member
    (null at the root), ``n_convs`` its members, ``n_children`` its children, ``n_leaves`` the childless nodes of its
    subtree, ``saved_tokens`` the code points that its subtree needn't hold again, and ``ends_sha256`` a digest of
    the members that end in it.

    A prefix that the sketch proves to be one conversation's own makes its node in the task that reads it; all others
    are grouped exactly. What a subtree adds up belongs to the smallest members of its nodes: each node's share is put
    at its place in that conversation, running sums from the end give every prefix of the conversation what lies behind it, and
    a node is the sum over its members. So there are no rounds over depths, and no conversation is in one task.
    """
    screen = store(screened(store(prefixes(rows), "prefixes"), most_width), "screened")
    nothing = [F.lit(0).cast("long")] * 4
    roots = all_lengths.select(
        "c", F.lit(0).cast("long").alias("i"), "length", F.lit(0).cast("long").alias("cp"), *[k.alias(n) for k, n in zip(_key(F.lit(0).cast("long"), nothing), ("k1", "k2"), strict=True)],
        *[F.lit(None).cast("long").alias(p) for p in ("p1", "p2")],
    )
    exact = store(screen.where("shared").select("c", "i", "length", "cp", "k1", "k2", "p1", "p2").unionByName(roots), "shared-prefixes")
    alone = screen.where("NOT shared")
    basic = exact.groupBy("k1", "k2").agg(
        F.min("c").alias("conv_id"), F.min("i").alias("depth"), F.count("*").alias("n_convs"), F.min("cp").alias("cp"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    basic = store(basic, "trie-basic")
    below = basic.where("depth > 0").select("p1", "p2").unionByName(alone.where("parent_shared").select("p1", "p2"))
    counts = below.groupBy("p1", "p2").agg(F.count("*").alias("n_children")).withColumnsRenamed({"p1": "k1", "p2": "k2"})
    found = store(basic.join(counts, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    share = found.select(F.col("conv_id").alias("c"), F.col("depth").alias("i"), ((F.col("n_convs") - 1) * F.col("cp")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    tails = alone.where("i = length").select("c", "i", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaf"))
    zero = F.lit(0).cast("long")
    put = share.where("saved > 0 OR leaf > 0").unionByName(tails).select("c", (-F.col("i")).alias("up"), F.lit(0).alias("kind"), "saved", "leaf", *[F.lit(None).cast("long").alias(k) for k in ("k1", "k2")])
    asked = exact.select("c", (-F.col("i")).alias("up"), F.lit(1).alias("kind"), zero.alias("saved"), zero.alias("leaf"), "k1", "k2")
    behind = running(put.unionByName(asked), ["c"], ["up", "kind"], ["saved", "leaf"]).where("kind = 1")
    sums = behind.groupBy("k1", "k2").agg(F.sum("leaf_upto").alias("n_leaves"), F.sum("saved_upto").alias("saved_tokens"))

    parents = found.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    full = found.join(sums, ["k1", "k2"]).join(list_digests(exact.where("i = length")), ["k1", "k2"], "left")
    # a parent that isn't among the nodes was proved to be the conversation's own
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id")
    names = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    shared = look_up(full.drop("cp"), ["p1", "p2"], parents, "left").select(
        "conv_id", "depth", parent, *names, F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")
    )
    last = F.col("i") == F.col("length")
    one = F.lit(1).cast("long")
    mine = [
        one.alias("n_convs"), (~last).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(last, F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(_NONE).alias("ends_sha256"),
    ]
    inner = alone.where("NOT parent_shared").select(F.col("c").alias("conv_id"), F.col("i").alias("depth"), F.col("c").alias("parent_conv_id"), *mine)
    edge = look_up(alone.where("parent_shared").select("c", "i", "length", "p1", "p2"), ["p1", "p2"], parents)
    edge = edge.select(F.col("c").alias("conv_id"), F.col("i").alias("depth"), "parent_conv_id", *mine)
    return shared.unionByName(inner).unionByName(edge)


def trie(conversations: DataFrame, shared: int = 6, family: int = 100, most_width: int = MOST_WIDTH, **columns: str) -> DataFrame:
    """:func:`nodes` of :func:`grafted` conversations. ``columns`` name the input's, see :func:`turns`.

    Null conversation ids are ignored, null turns come first, null roles and texts are empty; repeated rows are turns each, and
    turns that tie follow a hash of what they say. Further columns are ignored, whatever their names. No conversations give no nodes.
    """
    rows, lengths = grafted(store(turns(conversations, **columns), "turns"), shared, family)
    return nodes(store(rows, "rebuilt"), lengths, most_width)


SQL = f"""
WITH turns_ AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, {CRC32_SQL.format("conv_id")} % 6 AS h FROM turns_),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN turns_ t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
  UNION ALL SELECT conv_id, 1, place, role, text FROM convs JOIN turns_ USING (conv_id) WHERE place > h),
listed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, length(text) AS cp,
    sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '' ORDER BY part, place)
      OVER (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)) AS node FROM rebuilt),
sized AS (SELECT c.conv_id, coalesce(max(depth), 0) AS size FROM convs c LEFT JOIN listed USING (conv_id) GROUP BY c.conv_id),
members AS (
  SELECT conv_id, depth, cp, node, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent, size FROM listed JOIN sized USING (conv_id)
  UNION ALL SELECT conv_id, 0, 0, '', NULL, size FROM sized),
basic AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(cp) AS cp, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256 FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM basic WHERE depth > 0 GROUP BY parent),
counted AS (SELECT b.*, coalesce(n, 0) AS n_children FROM basic b LEFT JOIN kids USING (node)),
trees AS (
  SELECT m.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.cp) AS saved_tokens
  FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.depth <= c.depth GROUP BY m.node)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN trees USING (node) LEFT JOIN basic p ON p.node = c.parent
"""
