"""Polygons cut into pieces of few vertices, as a table of edges: no task holds a long outline whole.

A polygon is its directed edges, inside on the left. Tiles with too many are halved across their longer side, all of them
in one pass: edges are cut at the middle line, and where the line runs inside the polygon both halves get it as a border.
What remains in a tile is linked into polygons by half-edges. Passes end where a tile is short enough for one task (``GATHERED``):
the kernel halves and links it in place by the same rules and gives the same pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.kernel import NESTED, KernelUnavailable, enable
from coverlay.operators.dissolve import outline_edges
from coverlay.operators.halfedges import directed, oriented, outlines
from coverlay.operators.spread import look_up, running
from coverlay.operators.stage import store

_ENDS = ["x1", "y1", "x2", "y2"]
_TILE = ["tile", "left", "low", "right", "high"]
#: Halvings after which a tile stays as it is: its number is a 64-bit integer. 2^60 tiles are finer than doubles are.
DEEPEST = 60
#: Edges of a tile, or points of a key, that one task takes at once. 0: all is done by the table, as it is without the kernel.
GATHERED = 16_384


def subdivide(df: DataFrame, keys: Sequence[str], nested: str = "nested", max_points: int = 512, band: float | None = None) -> DataFrame:
    """``keys, tile, nested``: the polygons of each key cut into polygons of at most ``max_points`` points, holes included.

    See :func:`subdivide_edges`, to which only keys of more than ``GATHERED`` points go. Others are cut where their row is; only
    if they have several are rows brought together. Parts of one key must not overlap, whether they come in one row or in
    several. Null and empty geometries have no pieces; columns besides ``keys`` are left out. ``df`` is read twice.
    """
    _checked(max_points)
    keys = list(keys)
    rows = df.select(*keys, F.col(nested).alias("_nested")).where(" AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, "_nested"]))
    if not _gathered(df.sparkSession):
        return subdivide_edges(_segments(rows, keys), keys, max_points, band)
    finite = F.forall(F.flatten(N.rings("_nested")), lambda p: _finite(p["x"], p["y"]))
    points = F.when(finite, N.num_points("_nested"))  # null: something is missing, which the table leaves out as it comes to it
    per = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), F.count(points).alias("_whole"), F.sum(points).alias("_points"))
    short = (F.col("_whole") == F.col("_rows")) & (F.greatest("_points", "_rows") <= GATHERED)
    others = store(per.select(*keys, (~short).alias("_long"), "_rows").where("_long OR _rows > 1").drop("_rows"), "keys-apart")
    plain = F.col("_nested") if rows.schema["_nested"].dataType.simpleString() == NESTED.simpleString() else N.map_points("_nested", lambda p: N.xy(p["x"], p["y"]))
    cut = lambda d, nesteds: _pieces(d, keys, G.cut_rows(nesteds, max_points, DEEPEST))
    found = cut(rows.join(others, keys, "left_anti"), F.array(plain))
    if others.isEmpty():
        return found
    several = rows.join(others.where("NOT _long"), keys, "left_semi").groupBy(*keys).agg(F.collect_list(plain).alias("_rows"))
    found = found.unionByName(cut(several, F.col("_rows")))
    long = others.where("_long")
    if long.isEmpty():
        return found
    return found.unionByName(subdivide_edges(_segments(rows.join(long, keys, "left_semi"), keys), keys, max_points, band))


def subdivide_edges(edges: DataFrame, keys: Sequence[str], max_points: int = 512, band: float | None = None) -> DataFrame:
    """The same for outlines given as ``keys, ring, x1, y1, x2, y2``, inside on the left, of any length.

    Every pass halves all tiles of more than ``GATHERED`` edges, so there are about log2(edges / GATHERED) passes, and only rows of
    such tiles are written again. The others are gathered, halved further and linked by one task each. Where that many
    edges meet in one place a tile stays too full: it is halved ``DEEPEST`` times, then linked as it is, by the table. ``keys`` must
    not be null; edges without length are left out, those that are there twice in opposite directions cancel.
    """
    _checked(max_points)
    keys = list(keys)
    most = _gathered(edges.sparkSession)
    ends = edges.select(*keys, F.col("ring").cast("long").alias("ring"), *_ENDS).where("x1 <> x2 OR y1 <> y2")
    rows = store(_first_tiles(ends, keys), "tiles")
    short, done = [], []
    for _ in range(DEEPEST):
        rows = store(look_up(rows, [*keys, "tile"], _ways(rows, keys, max_points, most)), "tiles")
        short.append(rows.where("_gather").drop("_gather", "_full"))
        done.append(rows.where("NOT _gather AND NOT _full").drop("_gather", "_full"))
        rest = rows.where("NOT _gather AND _full").drop("_gather", "_full")
        if rest.isEmpty():
            break
        rows = store(_halves(rest, keys), "tiles")
    else:
        done.append(rows)
    by_table = lambda d: outlines(directed(outline_edges(d, [*keys, "tile"]), [*keys, "tile"]), [*keys, "tile"], band).drop("face")
    if not most:
        return by_table(_all(done))
    as_double = lambda names: [F.col(c).cast("double").alias(c) for c in names]
    gathered = _all(short).groupBy(*keys, *_TILE).agg(F.collect_list(F.struct("ring", *as_double(_ENDS))).alias("_edges"))
    found = _pieces(gathered, keys, G.cut_tile("_edges", "tile", *as_double(_TILE[1:]), max_points, DEEPEST))
    left = _all(done)
    return found if left.isEmpty() else found.unionByName(by_table(left))


def _checked(max_points: int) -> None:
    if max_points < 8:
        raise ValueError("a tile needs 8 points at least")


def _gathered(spark: SparkSession) -> int:
    """``GATHERED``, or 0 in a session that can't load the kernel."""
    try:
        return GATHERED if GATHERED and enable(spark) else 0
    except KernelUnavailable:
        return 0


def _finite(*values: Column) -> Column:
    """Are these numbers that a box can have? Not if one is null, NaN or infinite."""
    return F.coalesce(F.greatest(*[F.coalesce(F.abs(v), F.lit(float("inf"))) for v in values]) < float("inf"), F.lit(False))


def _segments(rows: DataFrame, keys: list[str]) -> DataFrame:
    segments = N.to_segments(rows.select(*keys, oriented("_nested").alias("_rings")), "_rings", keys)
    return segments.select(*keys, F.xxhash64("part", "ring").alias("ring"), *_ENDS)


def _pieces(rows: DataFrame, keys: list[str], cut: Column) -> DataFrame:
    return rows.select(*keys, F.explode(cut).alias("_piece")).select(*keys, "_piece.tile", "_piece.nested")


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for d in frames[1:]:
        out = out.unionByName(d)
    return out


def _first_tiles(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's box as its tile 1."""
    box = edges.groupBy(*keys).agg(
        F.min(F.least("x1", "x2")).alias("left"), F.min(F.least("y1", "y2")).alias("low"),
        F.max(F.greatest("x1", "x2")).alias("right"), F.max(F.greatest("y1", "y2")).alias("high"),
    )
    return look_up(edges, keys, box.withColumn("tile", F.lit(1).cast("long"))).select(*keys, "ring", *_ENDS, *_TILE)


def _ways(rows: DataFrame, keys: list[str], max_points: int, most: int) -> DataFrame:
    """``keys, tile, _gather, _full``: tiles for one task, of at most ``most`` edges, and tiles to be halved. A polygon of a tile has
    its edges' starts and one closing point per ring, whose ends are either pieces of outlines and borders (one ring) or whole
    outlines; so edges and distinct outlines together bound its points."""
    box = [F.first(c).alias(c) for c in _TILE[1:]]
    per = rows.groupBy(*keys, "tile", "ring").agg(F.count("*").alias("_n"), F.min(_finite(*[F.col(c) for c in _ENDS])).alias("_finite"), *box)
    sums = per.groupBy(*keys, "tile").agg(F.sum("_n").alias("_edges"), (F.sum("_n") + F.count("*")).alias("_n"), F.min("_finite").alias("_finite"), *box)
    middle, across = _middle()
    low, high = F.when(across, F.col("left")).otherwise(F.col("low")), F.when(across, F.col("right")).otherwise(F.col("high"))
    gather = F.col("_finite") & (F.col("_edges") <= most)
    return sums.select(*keys, "tile", gather.alias("_gather"), ((F.col("_n") > max_points) & (low < middle) & (middle < high)).alias("_full"))


def _middle() -> tuple[Column, Column]:
    """Where the longer side of a tile is halved, and whether that is the horizontal one."""
    across = F.col("right") - F.col("left") >= F.col("high") - F.col("low")
    half = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) / 2
    return F.when(across, half("left", "right")).otherwise(half("low", "high")), across


def _halves(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All edges of tiles in the halves of these, with the borders between them.

    ``u`` is the place along the halved side, ``v`` the place along the line. Points on the line count as beyond it, so an
    edge crosses or doesn't, and crossings alternate between ways in and out whatever touches the line.
    """
    middle, across = _middle()
    swap = lambda a, b: F.when(F.col("_across"), F.col(a)).otherwise(F.col(b))
    e = rows.withColumns({"_mid": middle, "_across": across}).withColumns({"u1": swap("x1", "y1"), "v1": swap("y1", "x1"), "u2": swap("x2", "y2"), "v2": swap("y2", "x2")})
    e = e.withColumns({"_far1": F.col("u1") >= F.col("_mid"), "_far2": F.col("u2") >= F.col("_mid")})
    near_far = lambda a, b: F.when(F.col("_far1"), F.col(b)).otherwise(F.col(a))
    nu, nv, fu, fv = near_far("u1", "u2"), near_far("v1", "v2"), near_far("u2", "u1"), near_far("v2", "v1")
    at = F.when(fu == F.col("_mid"), fv).otherwise(nv + (fv - nv) * ((F.col("_mid") - nu) / (fu - nu)))
    e = e.withColumn("_at", F.when(F.col("_far1") != F.col("_far2"), at))

    piece = lambda u1, v1, u2, v2, far: F.struct(u1.alias("u1"), v1.alias("v1"), u2.alias("u2"), v2.alias("v2"), far.alias("_far"))
    c = F.col
    parts = F.when(c("_at").isNull(), F.array(piece(c("u1"), c("v1"), c("u2"), c("v2"), c("_far1")))).otherwise(
        F.array(piece(c("u1"), c("v1"), c("_mid"), c("_at"), c("_far1")), piece(c("_mid"), c("_at"), c("u2"), c("v2"), c("_far2")))
    )
    carried = [*keys, "ring", *_TILE, "_mid", "_across"]
    cut = e.select(*carried, F.explode(parts).alias("_p")).select(*carried, "_p.*").where("u1 <> u2 OR v1 <> v2")

    # places on the line: crossings turn inside and outside about, vertices on it only break the border
    on = lambda u, v: F.when(c(u) == c("_mid"), F.struct(c(v).alias("v"), F.lit(0).alias("turn")))
    crossing = F.when(c("_at").isNotNull(), F.struct(c("_at").alias("v"), F.lit(1).alias("turn")))
    places = e.select(*keys, *_TILE, "_mid", "_across", F.explode(F.array_compact(F.array(crossing, on("u1", "v1"), on("u2", "v2")))).alias("_p"))
    grouped = places.groupBy(*keys, "tile", F.col("_p.v").alias("v")).agg(
        (F.sum("_p.turn") % 2).cast("int").alias("turn"), *[F.first(x).alias(x) for x in [*_TILE[1:], "_mid", "_across"]]
    )
    walked = running(grouped, [*keys, "tile"], ["v"], sums=["turn"])
    inside = F.col("turn_upto") % 2 == 1
    # a place opens the stretch of its number and closes the one before
    ends = F.array(F.struct(c("place").alias("stretch"), F.when(inside, c("v")).alias("open"), F.lit(None).cast("double").alias("close")), F.struct((c("place") - 1).alias("stretch"), F.lit(None).cast("double").alias("open"), c("v").alias("close")))
    rest = [*_TILE[1:], "_mid", "_across"]
    stretches = walked.select(*keys, "tile", *rest, F.explode(ends).alias("_s")).groupBy(*keys, "tile", "_s.stretch").agg(
        F.max("_s.open").alias("open"), F.max("_s.close").alias("close"), *[F.first(x).alias(x) for x in rest]
    ).where("open IS NOT NULL AND close IS NOT NULL")
    # inside on the left: up along a vertical line for the half before it, and back along a horizontal one
    up = lambda far: piece(c("_mid"), c("open"), c("_mid"), c("close"), F.lit(far))
    down = lambda far: piece(c("_mid"), c("close"), c("_mid"), c("open"), F.lit(far))
    sides = F.when(c("_across"), F.array(up(False), down(True))).otherwise(F.array(down(False), up(True)))
    borders = stretches.select(*keys, F.lit(0).cast("long").alias("ring"), *_TILE, "_mid", "_across", F.explode(sides).alias("_p")).select(*carried, "_p.*")

    both = cut.unionByName(borders)
    back = lambda a, b: F.when(c("_across"), c(a)).otherwise(c(b))
    edge = lambda name, when, far: F.when(when & (c("_far") == F.lit(far)), c("_mid")).otherwise(c(name)).alias(name)
    return both.select(
        *keys, "ring", back("u1", "v1").alias("x1"), back("v1", "u1").alias("y1"), back("u2", "v2").alias("x2"), back("v2", "u2").alias("y2"),
        (c("tile") * 2 + c("_far").cast("long")).alias("tile"),
        edge("left", c("_across"), True), edge("low", ~c("_across"), True), edge("right", c("_across"), False), edge("high", ~c("_across"), False),
    )
