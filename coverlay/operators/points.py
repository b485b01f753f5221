"""Points against areas and outlines: even–odd containment, nearest outline."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators.attributes import best_per_key
from coverlay.operators.grid import cell_of, cell_range, spatial_join
from coverlay.operators.spread import look_up
from coverlay.operators.stage import store

#: Width of a cell in cells of the next finer grid, in the search for nearest outlines.
_FAN = 4
#: Points of a cell that one task measures; the points of fuller cells are dealt over several.
_CROWD = 10_000


def crosses_ray(px, py) -> Column:
    """Does the ray from the point towards +x cross segment ``(x1, y1)–(x2, y2)``? Half-open in y."""
    at = F.col("x1") + (py - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return ((F.col("y1") > py) != (F.col("y2") > py)) & (px < at)


def on_segment(px, py) -> Column:
    cross = (F.col("x2") - F.col("x1")) * (py - F.col("y1")) - (F.col("y2") - F.col("y1")) * (px - F.col("x1"))
    return (
        (cross == 0)
        & px.between(F.least("x1", "x2"), F.greatest("x1", "x2"))
        & py.between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    )


def points_in_keyed_areas(
    points: DataFrame, areas: DataFrame, on: Sequence[str], point_id: str, area_id: str, nested: str = "nested",
    band: float | None = None,
) -> DataFrame:
    """Pairs of a point and an area with equal keys where the point is strictly inside the area.

    Built-in expressions only: areas become segments, each pair sums its ray crossings. Points on the outline
    are not inside. The pair sums are partially aggregated before the shuffle. ``band`` is a height in y by which
    segments are spread and joined as well: a point then meets only segments at its own height, and a key with
    very many points or vertices is spread over many join keys.
    """
    on = list(on)
    seg = N.to_segments(areas, nested, [*on, area_id])
    px, py = F.col("px"), F.col("py")
    pts = points.select(*on, point_id, F.col("x").alias("px"), F.col("y").alias("py"))
    keys = on
    if band:
        keys = [*on, "_band"]
        pts = pts.withColumn("_band", cell_of("py", band))
        seg = seg.withColumn("_band", cell_range(F.least("y1", "y2"), F.greatest("y1", "y2"), band))
    near = pts.join(seg, keys).where(
        (py >= F.least("y1", "y2")) & (py <= F.greatest("y1", "y2")) & (px <= F.greatest("x1", "x2"))
    )
    per = near.groupBy(*on, point_id, area_id).agg(
        F.sum(crosses_ray(px, py).cast("int")).alias("_n"), F.max(on_segment(px, py)).alias("_edge")
    )
    return per.where((F.col("_n") % 2 == 1) & ~F.col("_edge")).drop("_n", "_edge")


def areas_meeting_point(areas: DataFrame, x: float, y: float, area_id: str, nested: str = "nested") -> DataFrame:
    """Areas that a constant point lies in or on. The box test runs before any segment is made."""
    b = areas.withColumn("_b", N.bounds(nested))
    px, py = F.lit(float(x)), F.lit(float(y))
    near = b.where(px.between(F.col("_b.xmin"), F.col("_b.xmax")) & py.between(F.col("_b.ymin"), F.col("_b.ymax")))
    seg = N.to_segments(near, nested, [area_id])
    per = seg.groupBy(area_id).agg(
        F.sum(crosses_ray(px, py).cast("int")).alias("_n"), F.max(on_segment(px, py)).alias("_edge")
    )
    return per.where((F.col("_n") % 2 == 1) | F.col("_edge")).select(area_id)


def points_in_areas(points: DataFrame, areas: DataFrame, cell: float, on: Sequence[str] = (), **options) -> DataFrame:
    """Points (``x``, ``y``) joined to every area they are inside of, through the grid."""
    pts = points.withColumn("_pt", G.point("x", "y"))
    return spatial_join(
        pts, areas, G.within, cell, on=on, left_geom="_pt", right_geom="geom", **options
    ).drop("_pt")


def nearest_outline(
    points: DataFrame, layer: DataFrame, cell: float, point_id: str, layer_id: str, on: Sequence[str] = (),
    max_segments: int = 64, k: int = 1,
) -> DataFrame:
    """The ``k`` nearest feature outlines of every point, exact: ``point columns, layer_id, nearest, dist``; ties are kept.

    Everything but the distances themselves is settled per grid cell that holds points, whatever the distances. Outlines
    leave one of their vertices in each cell of a pyramid of grids, from ``cell`` up to the extent of everything; a cell of points
    takes the ``k`` features whose vertices are nearest to its middle from the grids' cells around it, which bounds what its points can be
    away. One range join then lists the outlines within that bound, in the grid whose cells are as wide, and the points, which
    are shuffled once, are measured against those of their cell. Points without any partner under ``on`` stay out, as do points
    without coordinates or id; with fewer than ``k`` features all are found. ``point_id`` must be unique.
    """
    on = list(on)
    home = [*on, "_px", "_py"]
    points = points.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col(point_id).isNotNull())
    placed = points.withColumns({"_px": cell_of("x", cell), "_py": cell_of("y", cell)})
    # short runs of the outline: small boxes, and no point is measured against a whole border
    chopped = layer.select(*on, layer_id, F.explode(G.chop(G.boundary("geom"), max_segments)).alias("_outline"))
    lines = store(chopped.select("*", G.bounds("_outline").alias("_b"), F.element_at(F.element_at(F.element_at(G.decode("_outline"), 1), 1), 1).alias("_v")), "outlines")
    cells = store(placed.groupBy(*home).agg(F.count("*").alias("_n")), "cells")
    west, south, farthest = _joint_extent(cells, lines, cell)
    levels = max(1, 1 + math.ceil(math.log(max(farthest / cell, 1.0), _FAN)))
    width = F.lit(float(cell)) * F.pow(F.lit(float(_FAN)), F.col("_level"))
    every_level = F.explode(F.array(*[F.lit(n) for n in range(levels + 1)])).alias("_level")
    in_x, in_y = (lambda v: F.floor((v - F.lit(west)) / width)), (lambda v: F.floor((v - F.lit(south)) / width))
    keys = [*on, "_level", "_cx", "_cy"]

    # features of different classes are different ones, so a cell's row per class is enough and stays bounded
    marks = lines.select(*on, layer_id, "_v", every_level).withColumns({"_cx": in_x(F.col("_v.x")), "_cy": in_y(F.col("_v.y")), "_class": F.pmod(F.xxhash64(layer_id), F.lit(4 * k - 3))})
    marks = marks.groupBy(*keys, "_class").agg(F.min(F.struct(F.col(layer_id).alias("f"), F.col("_v.x").alias("vx"), F.col("_v.y").alias("vy"))).alias("_m"))
    x0, y0 = F.col("_px") * F.lit(float(cell)), F.col("_py") * F.lit(float(cell))
    asked = cells.select(*home, every_level).withColumns({"_cx": in_x(x0 + cell / 2), "_cy": in_y(y0 + cell / 2)})
    away = F.hypot(F.col("_m.vx") - x0 - cell / 2, F.col("_m.vy") - y0 - cell / 2)
    seen = look_up(asked, keys, marks).select(*home, F.col("_m.f").alias("_f"), F.struct(away.alias("d"), "_m.vx", "_m.vy").alias("_m"))
    seen = seen.groupBy(*home, "_f").agg(F.min("_m").alias("_m")).groupBy(*home).agg(F.slice(F.array_sort(F.collect_list("_m")), 1, k).alias("_marks"))
    corner = lambda v, lo: F.greatest(F.abs(v - lo), F.abs(v - lo - cell))
    cells = cells.join(seen.hint("merge"), home, "left").withColumn("_marks", F.when(F.size("_marks") >= k, F.col("_marks")))
    reach = F.array_max(F.transform("_marks", lambda m: F.hypot(corner(m["vx"], x0), corner(m["vy"], y0))))
    # distances from corners and middles are rounded in the last digits of coordinates
    slack = lambda d: F.coalesce(d, F.lit(farthest)) * (1 + 1e-9) + farthest * 1e-12
    cells = store(cells.select("*", slack(reach).alias("_reach")), "bounds")

    level = F.greatest(F.lit(0), F.least(F.lit(levels), F.ceil(F.log(F.greatest(F.col("_reach") / cell, F.lit(1.0))) / math.log(_FAN)).cast("int")))
    span = lambda in_, lo, hi: F.explode(F.sequence(in_(lo), in_(hi)))
    boxes = cells.withColumn("_level", level).withColumns({"_xlo": in_x(x0 - F.col("_reach")), "_ylo": in_y(y0 - F.col("_reach"))})
    boxes = boxes.withColumn("_cx", span(in_x, x0 - F.col("_reach"), x0 + cell + F.col("_reach"))).withColumn("_cy", span(in_y, y0 - F.col("_reach"), y0 + cell + F.col("_reach")))
    runs = lines.select(*on, layer_id, "_outline", "_b", every_level).withColumns({"_rx": in_x(F.col("_b.xmin")), "_ry": in_y(F.col("_b.ymin"))})
    runs = runs.withColumn("_cx", span(in_x, F.col("_b.xmin"), F.col("_b.xmax"))).withColumn("_cy", span(in_y, F.col("_b.ymin"), F.col("_b.ymax")))
    gap = lambda lo, hi, a, b: F.greatest(F.lit(0.0), lo - F.col(b), F.col(a) - hi)
    # both sides are spread over cells, which the planner's sizes don't show: left to itself it may send one of them whole through the driver
    near = boxes.join(runs.hint("merge"), keys).where(
        (F.col("_cx") == F.greatest("_xlo", "_rx")) & (F.col("_cy") == F.greatest("_ylo", "_ry"))  # a pair meets in several cells and counts in the first
        & (F.hypot(gap(x0, x0 + cell, "_b.xmin", "_b.xmax"), gap(y0, y0 + cell, "_b.ymin", "_b.ymax")) <= F.col("_reach"))
    )
    crowded = F.ceil(F.col("_n") / _CROWD).cast("int")
    near = near.select(*home, F.explode(F.sequence(F.lit(0), crowded - 1)).alias("_lot"), layer_id, "_outline", "_b", "_marks")
    # few cells are crowded: one of _CROWD points at most
    lots = F.broadcast(cells.where(F.col("_n") > _CROWD).select(*home, crowded.alias("_lots")))
    dealt = placed.join(lots, home, "left").withColumn("_lot", F.pmod(F.xxhash64(point_id, "x", "y"), F.coalesce("_lots", F.lit(1))).cast("int")).drop("_lots")
    home = [*home, "_lot"]
    bound = slack(F.array_max(F.transform("_marks", lambda m: F.hypot(F.col("x") - m["vx"], F.col("y") - m["vy"]))))
    here = lambda v, lo, hi: F.greatest(F.lit(0.0), F.col(lo) - F.col(v), F.col(v) - F.col(hi))
    hits = dealt.join(near.hint("merge"), home).where(F.hypot(here("x", "_b.xmin", "_b.xmax"), here("y", "_b.ymin", "_b.ymax")) <= bound)
    hits = G.once(hits.withColumn("_pt", G.point("x", "y")), "nearest", G.nearest_point("_outline", "_pt"))
    hits = hits.withColumn("dist", N.distance(N.xy("x", "y"), "nearest"))
    columns = [*points.columns, layer_id, "nearest", "dist"]
    # neighbouring runs share a vertex
    single = [point_id, layer_id, "nearest"]
    if k == 1:
        # the first ranking needs no shuffle: it leaves a row or little more per point for the second
        first = lambda df, by: df.withColumn("_rank", F.rank().over(W.partitionBy(*by).orderBy("dist"))).where("_rank = 1")
        return first(first(hits.select(*columns, "_px", "_py", "_lot"), [*home, point_id]).select(*columns), [point_id]).select(*columns).dropDuplicates(single)
    hits = store(hits.select(*columns).dropDuplicates(single), "near-outlines")
    best = best_per_key(hits, [point_id, layer_id], "dist")
    order = best.groupBy(point_id, layer_id).agg(F.min("dist").alias("dist")).withColumn("_rank", F.rank().over(W.partitionBy(point_id).orderBy("dist")))
    return best.join(order.where(F.col("_rank") <= k).select(point_id, layer_id), [point_id, layer_id], "left_semi")


def _joint_extent(cells: DataFrame, lines: DataFrame, cell: float) -> tuple[float, float, float]:
    """Lower left corner and diagonal of a box of whole cells around both layers; no point is farther than that from any outline. 0 if either is empty."""
    b = lines.agg(F.min("_b.xmin"), F.min("_b.ymin"), F.max("_b.xmax"), F.max("_b.ymax")).first()
    p = cells.agg(F.min("_px"), F.min("_py"), F.max("_px") + 1, F.max("_py") + 1).first()
    if b[0] is None or p[0] is None:
        return 0.0, 0.0, 0.0
    west, south = (min(math.floor(b[i] / cell), p[i]) * cell for i in (0, 1))
    return west, south, math.hypot(max(b[2], p[2] * cell) - west, max(b[3], p[3] * cell) - south) * (1 + 1e-9)
