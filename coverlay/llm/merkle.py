"""Merkle manifest of a dataset: a tree per source, a tree of those, and a proof for every row, by sibling-shift self-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.operators.spread import number_by
from coverlay.operators.stage import store

#: Columns that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other; digests take part as their hex text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that no two rows run together: ``bytes:value``, ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return digest(*[field(c) for c in columns.values()])


def _with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` with ``left`` and ``right``: the digests of the others of its run, before and after it.

    Sibling ``k`` of the node in slot ``s`` has slot ``(s + k) mod fan`` of the same run (for two: the index with its
    last bit flipped), so each is an equi-join of the level with itself.
    """
    slot, start = F.col("pos") % fan, F.col("pos") - F.col("pos") % fan
    others = nodes.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("digest").alias("_digest"))
    out = nodes
    for k in range(1, fan):
        index = F.expr("pos ^ 1") if fan == 2 else start + (slot + k) % fan
        other = others.select("_tree", "_pos", F.col("_digest").alias(f"_other{k}"))
        out = out.withColumn("_index", index).join(other, (F.col("tree") == F.col("_tree")) & (F.col("_index") == F.col("_pos")), "left")
        out = out.drop("_tree", "_pos", "_index")
    side = lambda after: F.concat_ws("", *[F.when((slot + k < fan) == F.lit(after), F.col(f"_other{k}")) for k in range(1, fan)])
    return out.withColumns({"left": side(False), "right": side(True)}).drop(*[f"_other{k}" for k in range(1, fan)])


def levels(leaves: DataFrame, most: int, fan: int) -> list[DataFrame]:
    """All levels of all trees, leaves first: ``tree, pos, n, digest, left, right``; level 0 keeps further columns.

    ``leaves`` has ``tree``, ``pos`` from 0, ``n`` (nodes of its tree) and ``digest``; ``most`` is the largest ``n``. Every
    level is written once, a ``fan``-th of the one before; a tree with one node left is not carried further.
    """
    nodes, out = leaves, []
    while True:
        out.append(store(_with_siblings(nodes, fan), f"merkle-{len(out)}"))
        if most <= 1:
            return out
        first = out[-1].where((F.col("n") > 1) & (F.col("pos") % fan == 0))
        nodes = first.select(
            "tree", F.expr(f"pos div {fan}").alias("pos"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"), digest(F.col("digest"), F.col("right")).alias("digest")
        )
        most = -(-most // fan)


def tops(tree: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of every tree's last node."""
    ends = [level.where("n = 1").select("tree", "digest") for level in tree]
    out = ends[0]
    for end in ends[1:]:
        out = out.unionByName(end)
    return out


def with_paths(tree: list[DataFrame], above: DataFrame, fan: int) -> DataFrame:
    """Level 0 of ``tree`` with ``path``, the siblings of a leaf's ancestors from its own level up, and what ``above`` holds.

    ``above`` has a row per ``tree`` with the ``path`` over its last node and any further columns. Paths go down from parents to
    children, so each level costs one join of its own size and not of the number of leaves; each is written once.
    """
    held = [c for c in above.columns if c not in ("tree", "path")]
    down = None
    for k in range(len(tree) - 1, -1, -1):
        level = tree[k]
        here = level.where("n = 1").join(above, "tree")
        if down is not None:
            parents = down.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), "path", *held)
            going = level.where("n > 1").join(parents, (F.col("tree") == F.col("_tree")) & (F.expr(f"pos div {fan}") == F.col("_pos"))).drop("_tree", "_pos")
            step = F.array(F.struct("left", "right")).cast(_PATH)
            here = here.unionByName(going.withColumn("path", F.concat(step, "path")))
        down = here if k == 0 else store(here.select("tree", "pos", "path", *held), f"merkle-paths-{k}")
    return down


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf_digest, lambda acc, at: digest(at["left"], acc, at["right"]))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", fan: int = 3, extra: dict[str, Column] | None = None) -> DataFrame:
    """``<id_col>, leaf, subroot, root, path`` for every row: its leaf, its source's root, the root of all, and its siblings.

    A leaf is the digest of ``fields``. Leaves of a source ascend by id (null first), those with one id by a hash of what is
    in them; every ``fan`` consecutive nodes become one until one is left. Sources are leaves of the upper tree in the
    order of their bytes, null first. Texts are hashed where they are read and never shuffled, equal rows are leaves each.
    ``extra`` columns are computed from ``docs`` and carried along; other columns are ignored, whatever their names.
    An empty table has no root and gives no rows.
    """
    extra = extra or {}
    read = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("source"), leaf({c: F.col(c) for c in fields}).alias("digest"), *[c.alias(n) for n, c in extra.items()]
    )
    read = store(read, "merkle-leaves")  # dealing by range looks at its rows twice
    rows = store(number_by(read, ["source", "id", "digest"], "at"), "merkle-leaves")
    sources = number_by(rows.groupBy("source").agg(F.min("at").alias("start"), F.count("*").alias("n")), ["source"], "tree")
    sources = store(sources, "merkle-sources")
    most, count = sources.agg(F.max("n"), F.count("*")).first()
    if not count:
        return read.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"), *extra).limit(0)
    placed = sources.select(F.col("source").alias("_source"), "start", "n", "tree")
    leaves = rows.join(placed, F.col("source").eqNullSafe(F.col("_source"))).select("tree", (F.col("at") - F.col("start")).alias("pos"), "n", "digest", "id", *extra)
    lower = levels(leaves, most, fan)
    heads = tops(lower)
    upper = levels(heads.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("n"), "digest"), count, fan)
    top = tops(upper).select("tree", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    over = with_paths(upper, top, fan).select(F.col("pos").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    down = with_paths(lower, over, fan)
    return down.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path", *extra)


def verify(
    docs: DataFrame, tampered: Column, change: dict[str, Column], fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", fan: int = 3,
) -> DataFrame:
    """``<id_col>, leaf, subroot, root, proof_sha256, folded_root, verified``: what the manifest says of changed rows.

    Where ``tampered`` is true, the leaf is computed with the columns of ``change`` in place of its own; ``folded_root`` is
    what it gives with the original siblings, ``verified`` whether that is the root. Rows are as in :func:`manifest`.
    """
    changed = leaf({c: change.get(c, F.col(c)) for c in fields})
    rows = manifest(docs, fields, id_col, group_col, fan, {"_changed": F.when(F.coalesce(tampered, F.lit(False)), changed)})
    folded = rows.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.coalesce("_changed", "leaf"), F.col("path"))})
    return folded.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def newlines_deleted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`verify` with a fixed tampering: texts of rows whose id has an even CRC-32 lose their newlines."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return verify(docs, even, {text_col: F.translate(F.col(text_col), "\n", "")}, id_col=id_col)


#: CRC-32 of a decimal number ``{}`` in SQL: bytes shifted in bit by bit.
CRC32_SQL = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}::VARCHAR) + 1),
  lambda p: [ascii(({0}::VARCHAR)[p])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END))"""


def _leaf_sql(text: str) -> str:
    part = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(part.format(text if c == "text" else c) for c in FIELDS) + ")"


SQL = f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN {CRC32_SQL.format("doc_id")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed FROM documents),
base AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM rows_),
lower_(tree, lvl, pos, n, digest) AS (
  SELECT tree, 0, row_number() OVER (PARTITION BY tree ORDER BY id) - 1, count(*) OVER (PARTITION BY tree), leaf FROM base
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM lower_ WHERE n > 1 GROUP BY tree, lvl, pos // 3),
sub AS (SELECT tree, lvl AS height, digest AS subroot FROM lower_ WHERE n = 1),
upper_(lvl, pos, n, digest) AS (
  SELECT 0, tree, count(*) OVER (), subroot FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_ WHERE n > 1 GROUP BY lvl, pos // 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY id) - 1 AS pos FROM base),
steps AS (
  SELECT id, l.lvl AS step, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < l.pos), '') AS before,
    coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > l.pos), '') AS after
  FROM placed b JOIN lower_ l ON l.tree = b.tree AND l.n > 1 AND l.pos = b.pos // (3 ** l.lvl)::BIGINT
    JOIN lower_ s ON s.tree = l.tree AND s.lvl = l.lvl AND s.pos // 3 = l.pos // 3 GROUP BY id, l.lvl, l.pos
  UNION ALL
  SELECT id, height + l.lvl, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < l.pos), ''),
    coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > l.pos), '')
  FROM placed b JOIN sub USING (tree) JOIN upper_ l ON l.n > 1 AND l.pos = b.tree // (3 ** l.lvl)::BIGINT
    JOIN upper_ s ON s.lvl = l.lvl AND s.pos // 3 = l.pos // 3 GROUP BY id, height, l.lvl, l.pos),
folds(id, step, digest) AS (
  SELECT id, 0, coalesce(changed, leaf) FROM base
  UNION ALL
  SELECT f.id, f.step + 1, sha256(before || f.digest || after) FROM folds f JOIN steps s ON s.id = f.id AND s.step = f.step),
ends_ AS (SELECT id, arg_max(digest, step) AS folded_root FROM folds GROUP BY id),
proofs AS (SELECT id, string_agg(before || after, '' ORDER BY step) AS path FROM steps GROUP BY id)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(path, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM base JOIN sub USING (tree) JOIN ends_ USING (id) LEFT JOIN proofs USING (id), (SELECT digest AS root FROM upper_ WHERE n = 1)
"""
