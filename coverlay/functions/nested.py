"""Geometry as plain Spark arrays: parts → rings → points ``(x, y)``.

Everything here is built-in column arithmetic, so it works without the kernel and stays inside the JVM.
A polygon part holds its shell first and its holes after it; every ring repeats its first point at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _d(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


# ---- points ----


def xy(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def translate(p, dx, dy) -> Column:
    p = _c(p)
    return xy(p["x"] + _d(dx), p["y"] + _d(dy))


def distance(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def azimuth(a, b) -> Column:
    """Bearing from a to b, clockwise from north in radians; NULL when the points coincide."""
    a, b = _c(a), _c(b)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    return F.when((dx != 0) | (dy != 0), F.pmod(F.atan2(dx, dy) + F.lit(2 * math.pi), F.lit(2 * math.pi)))


def make_line(a, b) -> Column:
    """Two-point line; NULL when either end is."""
    a, b = _c(a), _c(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.array(a, b))


def move(p, bearing, dist) -> Column:
    """The point ``dist`` away from ``p`` along a bearing."""
    return translate(p, F.sin(bearing) * _d(dist), F.cos(bearing) * _d(dist))


def overshoot(a, b, by: float = 0.00001) -> Column:
    """The line a–b made longer by ``by`` at both ends; NULL when the points coincide."""
    a, b = _c(a), _c(b)
    ab, ba = azimuth(a, b), azimuth(b, a)
    return make_line(
        F.when(ba.isNotNull(), move(a, ba, by)),
        F.when(ab.isNotNull(), move(a, ab, distance(a, b) + F.lit(by))),
    )


def project(p, a, b) -> Column:
    """The point of segment a–b closest to p."""
    p, a, b = _c(p), _c(a), _c(b)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / len2)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return xy(a["x"] + t * dx, a["y"] + t * dy)


# ---- constructors ----


def ring(coords: list) -> Column:
    """Closed ring from a list of ``(x, y)`` column pairs; the first point is repeated at the end."""
    pts = [xy(x, y) for x, y in coords]
    return F.array(*pts, pts[0])


def box_ring(x0, y0, x1, y1) -> Column:
    x0, y0, x1, y1 = (_c(v) if isinstance(v, str) else _d(v) for v in (x0, y0, x1, y1))
    return ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


# ---- rings and parts ----


def exterior(nested) -> Column:
    """Keep each part's shell: holes are filled."""
    return F.transform(_c(nested), lambda p: F.slice(p, 1, 1))


def rings(nested) -> Column:
    return F.flatten(_c(nested))


def num_points(nested) -> Column:
    return F.aggregate(rings(nested), F.lit(0), lambda acc, r: acc + F.size(r))


def is_empty(nested) -> Column:
    return F.size(_c(nested)) == 0


def _fold_segments(r: Column, zero: Column, step) -> Column:
    pairs = F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: step(a, b))
    return F.aggregate(pairs, zero, lambda acc, v: acc + v)


def ring_area(r) -> Column:
    """Signed: positive when the ring runs anticlockwise. Taken relative to the first point for precision."""
    r = _c(r)
    o = r[0]
    cross = lambda a, b: (a["x"] - o["x"]) * (b["y"] - o["y"]) - (b["x"] - o["x"]) * (a["y"] - o["y"])
    return _fold_segments(r, F.lit(0.0), cross) / 2


def ring_length(r) -> Column:
    return _fold_segments(_c(r), F.lit(0.0), lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]))


def area(nested) -> Column:
    per_part = lambda p: F.aggregate(
        F.transform(p, lambda r, i: F.abs(ring_area(r)) * F.when(i == 0, 1.0).otherwise(-1.0)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
    return F.aggregate(F.transform(_c(nested), per_part), F.lit(0.0), lambda acc, v: acc + v)


def length(nested) -> Column:
    return F.aggregate(F.transform(rings(nested), ring_length), F.lit(0.0), lambda acc, v: acc + v)


def bounds(nested) -> Column:
    pts = F.flatten(rings(nested))
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def map_points(nested, f) -> Column:
    """Apply ``f(point) -> point`` to every vertex."""
    return F.transform(_c(nested), lambda part: F.transform(part, lambda r: F.transform(r, f)))


def map_rings(nested, f) -> Column:
    return F.transform(_c(nested), lambda part: F.transform(part, f))


def without_repeats(r) -> Column:
    """Drop points equal to the one before them."""
    r = _c(r)
    return F.filter(
        F.transform(r, lambda p, i: F.struct(p.alias("p"), (i > 0).alias("tail"), F.get(r, i - 1).alias("q"))),
        lambda s: ~(s["tail"] & (s["p"]["x"] == s["q"]["x"]) & (s["p"]["y"] == s["q"]["y"])),
    )["p"]


def without_near_repeats(r, tolerance: float) -> Column:
    """Drop points within ``tolerance`` of the last kept one; both end points stay."""
    r = _c(r)
    n = F.size(r)
    inner = F.aggregate(
        F.slice(r, 2, F.greatest(n - 2, F.lit(0))),
        F.slice(r, 1, 1),
        lambda kept, p: F.when(distance(F.element_at(kept, -1), p) > F.lit(tolerance), F.concat(kept, F.array(p))).otherwise(
            kept
        ),
    )
    return F.when(n < 3, r).otherwise(F.concat(inner, F.slice(r, n, 1)))


def remove_repeated_points(nested, tolerance: float | None = None) -> Column:
    if tolerance:
        return map_rings(nested, lambda r: without_near_repeats(r, tolerance))
    return map_rings(nested, without_repeats)


def snap_to_grid(nested, size: float) -> Column:
    """Round to a grid, drop repeated points, then rings with fewer than four points, then empty parts."""
    s = F.lit(float(size))
    moved = map_points(nested, lambda p: xy(F.rint(p["x"] / s) * s, F.rint(p["y"] / s) * s))
    rounded = remove_repeated_points(moved)
    alive = F.filter(rounded, lambda part: F.size(part[0]) >= 4)
    return F.transform(alive, lambda part: F.filter(part, lambda r: F.size(r) >= 4))


def centroid(nested) -> Column:
    """Area-weighted centre of all parts, holes subtracted."""
    nested = _c(nested)
    o = nested[0][0][0]

    def moments(r, i):
        sign = F.when(ring_area(r) >= 0, 1.0).otherwise(-1.0) * F.when(i == 0, 1.0).otherwise(-1.0)

        def cross(a, b):
            return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (b["x"] - o["x"]) * (a["y"] - o["y"])

        a2 = _fold_segments(r, F.lit(0.0), cross)
        mx = _fold_segments(r, F.lit(0.0), lambda a, b: cross(a, b) * (a["x"] + b["x"] - 2 * o["x"]))
        my = _fold_segments(r, F.lit(0.0), lambda a, b: cross(a, b) * (a["y"] + b["y"] - 2 * o["y"]))
        return F.struct((sign * a2).alias("a"), (sign * mx).alias("mx"), (sign * my).alias("my"))

    per_ring = F.flatten(F.transform(nested, lambda part: F.transform(part, moments)))
    total = lambda f: F.aggregate(per_ring, F.lit(0.0), lambda acc, m: acc + m[f])
    a = total("a")
    return F.when(a != 0, xy(o["x"] + total("mx") / (3 * a), o["y"] + total("my") / (3 * a)))


# ---- row forms ----


def to_vertices(df: DataFrame, nested: str, keep: list[str], last: str | None = None) -> DataFrame:
    """One row per vertex with 1-based ``part, ring, seq`` paths and ``x, y``.

    ``last`` names a column for the ring's last sequence number; it comes from the array, without a window.
    """
    a = df.select(*keep, F.posexplode(nested).alias("_p", "_part"))
    b = a.select(*keep, (F.col("_p") + 1).alias("part"), F.posexplode("_part").alias("_r", "_ring"))
    end = [F.size("_ring").alias(last)] if last else []
    c = b.select(*keep, "part", (F.col("_r") + 1).alias("ring"), *end, F.posexplode("_ring").alias("_s", "_pt"))
    return c.select(
        *keep, *([last] if last else []), "part", "ring", (F.col("_s") + 1).alias("seq"), F.col("_pt.x").alias("x"), F.col("_pt.y").alias("y")
    )


def to_segments(df: DataFrame, nested: str, keep: list[str]) -> DataFrame:
    """One row per ring segment ``(x1, y1) → (x2, y2)``; pairs are formed inside the array, without a shuffle."""
    a = df.select(*keep, F.posexplode(nested).alias("_p", "_part"))
    b = a.select(*keep, (F.col("_p") + 1).alias("part"), F.posexplode("_part").alias("_r", "_ring"))
    pairs = F.zip_with(
        F.slice("_ring", 1, F.size("_ring") - 1),
        F.slice("_ring", 2, F.size("_ring") - 1),
        lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")),
    )
    c = b.select(*keep, "part", (F.col("_r") + 1).alias("ring"), F.posexplode(pairs).alias("_s", "_seg"))
    return c.select(*keep, "part", "ring", (F.col("_s") + 1).alias("seq"), "_seg.*")
