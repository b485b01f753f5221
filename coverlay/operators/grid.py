"""Spatial joins planned as equi-joins on grid cells.

A geometry predicate alone would plan as a nested loop. Here each side is spread over the grid cells its
bounding box covers and joined on the cell (and any equality keys), so Catalyst picks sort-merge, hash or
broadcast and AQE can split skewed cells. A pair that meets in several cells is kept only in the cell that
holds the lower-left corner of the two boxes' overlap, so no ``distinct`` is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlay.functions import geometry as G
from coverlay.kernel import enable

BOX = ("xmin", "ymin", "xmax", "ymax")


def with_bounds(df: DataFrame, geom: str = "geom", prefix: str = "") -> DataFrame:
    """Add the bounding box as four double columns; empty and NULL geometries get NULLs."""
    enable(df.sparkSession)
    boxed = df.withColumn("_b", G.bounds(geom))
    return boxed.select(*df.columns, *[F.col(f"_b.{c}").alias(prefix + c) for c in BOX])


def cell_of(v, cell: float) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return F.floor(v / F.lit(float(cell)))


def cell_range(lo, hi, cell: float) -> Column:
    return F.explode(F.sequence(cell_of(lo, cell), cell_of(hi, cell)))


def explode_cells(df: DataFrame, cell: float, prefix: str = "", cx: str = "cx", cy: str = "cy") -> DataFrame:
    """One row per grid cell the box touches. Rows with a NULL box have no cells, so no filter is needed: one
    would be pushed below the box and make Spark parse every geometry twice."""
    xmin, ymin, xmax, ymax = (prefix + c for c in BOX)
    cols = df.withColumn(cx, cell_range(xmin, xmax, cell))
    return cols.withColumn(cy, cell_range(ymin, ymax, cell))


def corner_cell(df: DataFrame, cell: float, prefix: str = "", cx: str = "cx", cy: str = "cy") -> DataFrame:
    """Every row once, in the grid cell of its box's lower-left corner. Rows with a NULL box stay out, as above."""
    only = lambda v: F.explode(F.array_compact(F.array(cell_of(prefix + v, cell))))
    return df.withColumn(cx, only("xmin")).withColumn(cy, only("ymin"))


def cell_key(x, y, cell: float) -> Column:
    """Z-order key of a point's cell: near cells get near keys. Used to lay out and sort tables."""
    ix, iy = (cell_of(v, cell).cast("int") for v in (x, y))
    out = F.lit(0).cast("bigint")
    for bit in range(24):
        for k, i in enumerate((ix, iy)):
            b = F.shiftright(i + F.lit(1 << 23), bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(b, 2 * bit + k))
    return out


def suggest_cell_size(df: DataFrame, geom: str = "geom") -> float:
    """Twice the median longer side of the boxes, as a power of two. One aggregate over the layer."""
    b = with_bounds(df.select(geom), geom)
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    med = b.agg(F.percentile_approx(side, 0.5)).first()[0]
    if not med:
        return 1.0
    size = 1.0
    while size < med * 2:
        size *= 2
    while size >= med * 4:
        size /= 2
    return size


#: largest side, in bytes of all its columns spread over cells, that a join may broadcast; the session setting
#: ``spark.coverlay.broadcastLimit`` takes its place
BROADCAST_LIMIT = 64 * 1024 * 1024


def _bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.BinaryType, T.StringType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)) + 16
    return F.lit(16)


def _fits(side: DataFrame) -> bool:
    """Measure a side as it would be sent, all columns: one small aggregate."""
    limit = int(side.sparkSession.conf.get("spark.coverlay.broadcastLimit", str(BROADCAST_LIMIT)))
    size = side.agg(F.sum(sum((_bytes(f) for f in side.schema), F.lit(0)))).first()[0]
    return (size or 0) <= limit


def _splits() -> Column:
    """Sub-cells per side of a cell at its level: exact powers of two."""
    return F.expr("shiftleft(CAST(1 AS BIGINT), _lv)")


def _refine(left: DataFrame, right: DataFrame, on: Sequence[str], cell: float, limit: int):
    """Cut hot cells into 4**level equal cells, the same on both sides, from exact per-cell counts."""
    keys = [*on, "_cx", "_cy"]
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl")).join(
        right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr")), keys
    )
    n = F.greatest("_nl", "_nr")
    hot = counts.where(n > F.lit(limit)).select(
        *keys, F.least(F.ceil(F.log(n / F.lit(limit)) / F.log(F.lit(4.0))), F.lit(26)).cast("int").alias("_lv")
    )

    def spread(df: DataFrame, p: str) -> DataFrame:
        # the sub-cells of a cell are clamped to it, so every copy stays inside its own cell
        d = df.join(hot, keys, "left").withColumn("_lv", F.coalesce("_lv", F.lit(0)))
        k, size = _splits(), F.lit(float(cell)) / _splits()

        def axis(lo: str, hi: str, c: str) -> Column:
            first, last = F.col(c) * k, (F.col(c) + 1) * k - 1
            a = F.greatest(F.floor(F.col(lo) / size), first)
            b = F.least(F.floor(F.col(hi) / size), last)
            return F.explode(F.sequence(a, F.greatest(a, b)))

        d = d.withColumn("_ix", axis(p + "xmin", p + "xmax", "_cx"))
        return d.withColumn("_iy", axis(p + "ymin", p + "ymax", "_cy"))

    size = F.lit(float(cell)) / _splits()
    return spread(left, "_l"), spread(right, "_r"), [*keys, "_lv", "_ix", "_iy"], size


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    predicate: Callable[[Column, Column], Column] | None,
    cell: float,
    on: Sequence[str] = (),
    left_geom: str = "geom",
    right_geom: str = "geom2",
    where: Column | None = None,
    expand: float = 0.0,
    refine_above: int | None = None,
    small: str | None = None,
    inside: str | None = None,
    left_id: str | None = None,
) -> DataFrame:
    """Inner join of two layers on ``predicate(left_geom, right_geom)`` and equality of the ``on`` columns.

    The sides must not share column names other than ``on``. ``predicate=None`` keeps pairs whose boxes meet.
    ``where`` is an extra cheap condition tested before the exact predicate; ``expand`` grows the left boxes.
    ``refine_above`` counts rows per cell first and cuts cells that hold more than that many into smaller ones.
    ``small='left'`` or ``'right'`` names a side that is expected to be small and cheap to compute: it is measured,
    and broadcast if it fits, so that the other side is not shuffled. If it does not fit, the join is the usual one.
    ``inside='left'`` or ``'right'`` names the side whose areas lie in their partners, as ``predicate`` demands: a pair then
    meets in the cell of the inner box's lower-left corner, so that side is not spread over cells.
    ``left_id`` names a column that identifies left rows: unless a side is broadcast, left rows are spread without their
    geometry, which pairs whose boxes meet get back by that column. Left is then read twice; rows without an id stay out.
    """
    if inside == "left" and expand:
        raise ValueError("grown boxes don't lie in their partners")
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"rename these columns on one side: {sorted(clash)}")
    l, r = with_bounds(left, left_geom, "_l"), with_bounds(right, right_geom, "_r")
    if expand:
        e = F.lit(float(expand))
        l = l.withColumns(
            {"_lxmin": F.col("_lxmin") - e, "_lymin": F.col("_lymin") - e}
            | {"_lxmax": F.col("_lxmax") + e, "_lymax": F.col("_lymax") + e}
        )
    l = (corner_cell if inside == "left" else explode_cells)(l, cell, "_l", "_cx", "_cy")
    r = (corner_cell if inside == "right" else explode_cells)(r, cell, "_r", "_cx", "_cy")
    px, py = F.greatest("_lxmin", "_rxmin"), F.greatest("_lymin", "_rymin")
    if small == "left" and _fits(l):
        l, refine_above, left_id = F.broadcast(l), None, None
    elif small == "right" and _fits(r):
        r, refine_above, left_id = F.broadcast(r), None, None
    if left_id:
        l = l.drop(left_geom)
    if refine_above:
        l, r, keys, size = _refine(l, r, on, cell, refine_above)
        # a corner on the clamped edge of a cell belongs to the base cell it falls in
        at = {"_cx": cell_of(px, cell), "_cy": cell_of(py, cell), "_ix": F.floor(px / size), "_iy": F.floor(py / size)}
    else:
        keys = [*on, "_cx", "_cy"]
        at = {"_cx": cell_of(px, cell), "_cy": cell_of(py, cell)}
    meet = (
        (F.col("_lxmin") <= F.col("_rxmax")) & (F.col("_rxmin") <= F.col("_lxmax"))
        & (F.col("_lymin") <= F.col("_rymax")) & (F.col("_rymin") <= F.col("_lymax"))
    )
    if inside:
        a, b = ("_r", "_l") if inside == "left" else ("_l", "_r")
        meet = meet & (F.col(a + "xmin") <= F.col(b + "xmin")) & (F.col(b + "xmax") <= F.col(a + "xmax"))
        meet = meet & (F.col(a + "ymin") <= F.col(b + "ymin")) & (F.col(b + "ymax") <= F.col(a + "ymax"))
    for key, home in at.items():
        meet = meet & (F.col(key) == home)
    # coalesce keeps Catalyst from inferring "box edge is not NULL" filters; those would be pushed down to the
    # scans, where every geometry would be built and measured once more per edge
    pairs = l.join(r, keys).where(F.coalesce(meet, F.lit(False)))
    if where is not None:
        pairs = pairs.where(where)
    if left_id:
        pairs = pairs.join(left.select(left_id, left_geom), left_id)
    if predicate is not None:
        pairs = pairs.where(predicate(F.col(left_geom), F.col(right_geom)))
    return pairs.select(*left.columns, *[c for c in right.columns if c not in on])


def spatial_filter(
    left: DataFrame,
    right: DataFrame,
    predicate: Callable[[Column, Column], Column],
    cell: float,
    key: str | Sequence[str],
    keep: bool = True,
    **options,
) -> DataFrame:
    """Rows of ``left`` that have (``keep``) or lack a partner in ``right``; ``key`` identifies a left row."""
    keys = [key] if isinstance(key, str) else list(key)
    hits = spatial_join(left, right, predicate, cell, **options).select(*keys).distinct()
    return left.join(hits, keys, "left_semi" if keep else "left_anti")
