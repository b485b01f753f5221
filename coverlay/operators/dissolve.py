"""Dissolve (union by key) that never puts a whole key into one task.

Rows are unioned first within small grid cells, then within ever larger ones. After each level a polygon
that no row outside its cell can reach is finished and takes no further part, so a key that owns a third of
the table is merged in many tasks, and only polygons that really are large travel to the top.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators.grid import cell_of, with_bounds
from coverlay.operators.halfedges import directed, oriented, outlines
from coverlay.operators.stage import cut

_FAN = 8
#: open polygons a layer may have left for the last, un-gridded merge without another level before it; the session
#: setting ``spark.coverlay.fewOpenPolygons`` takes its place. The result is the same with any number.
_FEW = 2000


def _extent(df: DataFrame) -> tuple[float, float]:
    """Longest box side and largest absolute coordinate of a layer: one aggregate over the boxes."""
    b = with_bounds(df.select("geom")).agg(
        F.max(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))).alias("side"),
        F.max(F.greatest(F.abs("xmin"), F.abs("xmax"), F.abs("ymin"), F.abs("ymax"))).alias("far"),
    ).first()
    return (b["side"] or 0.0, b["far"] or 0.0) if b else (0.0, 0.0)


def dissolve_parts(
    df: DataFrame, keys: Sequence[str], geom: str = "geom", cell: float | None = None, extent: tuple | None = None
) -> DataFrame:
    """Union the areas of each key and return its disjoint polygons, one row per polygon: ``keys, geom``.

    ``extent = (longest box side, largest absolute coordinate)``, or bounds on them, saves the aggregate that
    measures the layer. Every level is checkpointed: finished polygons are written once and stay put, the
    shrinking rest goes on.
    """
    keys = list(keys)
    # NULL and empty geometries fall out by themselves: they have no polygons to list
    d = df.select(*keys, F.col(geom).alias("geom"))
    side, far = extent or _extent(d)
    # a row is assigned by the middle of its box, so it reaches at most half its side beyond its cell
    reach, size = side / 2, cell or 2.0 ** math.ceil(math.log2(max(side, 1e-9) * 4))
    levels = 1 + max(0, math.ceil(math.log(max(1.0, 2 * far / size), _FAN)))
    mid = lambda lo, hi: (F.col(lo) + F.col(hi)) / 2
    todo = with_bounds(d).select(
        *keys, "geom", cell_of(mid("xmin", "xmax"), size).alias("_cx"), cell_of(mid("ymin", "ymax"), size).alias("_cy")
    )
    few, found = int(df.sparkSession.conf.get("spark.coverlay.fewOpenPolygons", str(_FEW))), None
    for _ in range(levels):
        parts = cut(_merge(todo, keys, size, reach))
        finished = parts.where("_done").select(*keys, "geom")
        found = finished if found is None else found.unionByName(finished)
        size *= _FAN
        up = lambda c: F.floor(F.col(c) / F.lit(_FAN)).alias(c)
        todo = parts.where("NOT _done").select(*keys, "geom", up("_cx"), up("_cy"))
        open_rows = todo.count()
        if not open_rows:
            return found
        if open_rows <= few:
            break
    last = todo.groupBy(*keys).agg(G.union_agg("geom").alias("geom")).select(*keys, F.explode(G.polygons("geom")).alias("geom"))
    return found.unionByName(last)


def _merge(rows: DataFrame, keys: list[str], size: float, reach: float) -> DataFrame:
    """Union rows per key and cell; a polygon well inside its cell, out of reach of all other cells, is done."""
    merged = rows.groupBy(*keys, "_cx", "_cy").agg(G.union_agg("geom").alias("geom"))
    p = with_bounds(merged.withColumn("geom", F.explode(G.polygons("geom"))))
    x0, y0 = F.col("_cx") * F.lit(size), F.col("_cy") * F.lit(size)
    m, s = F.lit(reach), F.lit(size)
    done = (
        (F.col("xmin") > x0 + m) & (F.col("xmax") < x0 + s - m) & (F.col("ymin") > y0 + m) & (F.col("ymax") < y0 + s - m)
    )
    return p.select(*keys, "geom", "_cx", "_cy", done.alias("_done"))


def dissolve(df: DataFrame, keys: Sequence[str], geom: str = "geom", **options) -> DataFrame:
    """Union by key, one (multi)polygon per key. The last step only lists finished polygons side by side."""
    keys = list(keys)
    return dissolve_parts(df, keys, geom, **options).groupBy(*keys).agg(G.collect_agg("geom").alias("geom"))


def dissolve_local(df: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    """Union by a key whose groups are known to be small (one feature, one zone): a single aggregate."""
    return df.groupBy(*keys).agg(G.union_agg(geom).alias("geom"))


def collect(df: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    """All parts of a key in one multi-geometry, overlaps left as they are."""
    return df.groupBy(*keys).agg(G.collect_agg(geom).alias("geom"))


def outline_edges(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges left on the outline after dissolving an exact coverage: shared edges cancel in pairs.

    Works on directed segments with ``x1, y1, x2, y2`` of consistently oriented rings; plain arithmetic and one
    partially aggregated shuffle, no geometry. Neighbours must share edges vertex for vertex.
    """
    flip = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    pick = lambda a, b: F.when(flip, F.col(b)).otherwise(F.col(a))
    e = segments.select(
        *keys, pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"),
        pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2"), F.when(flip, -1).otherwise(1).alias("_dir"),
    )
    net = e.groupBy(*keys, "x1", "y1", "x2", "y2").agg(F.sum("_dir").alias("dir"), F.count(F.lit(1)).alias("uses"))
    return net.where(F.col("uses") % 2 == 1).drop("uses")


def outline_measures(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area and perimeter per key straight from the outline edges; rings need not be linked for either."""
    cross = (F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) * F.col("dir")
    return edges.groupBy(*keys).agg(
        F.abs(F.sum(cross) / 2).alias("area"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("perimeter"),
    )


def dissolve_exact(df: DataFrame, keys: Sequence[str], nested: str = "nested", band: float | None = None) -> DataFrame:
    """``keys, nested``: one row per polygon of each key of an exact coverage, from its edges alone.

    Shared edges cancel, what is left is linked into rings by half-edges (:mod:`coverlay.operators.halfedges`); no polygon is
    read, and none is computed. Same result as :func:`dissolve_parts` where neighbours share edges vertex for vertex.
    """
    keys = list(keys)
    segments = N.to_segments(df.select(*keys, oriented(nested).alias("_rings")), "_rings", keys)
    return outlines(directed(outline_edges(segments, keys), keys), keys, band).drop("face")
