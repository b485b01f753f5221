"""Polygons from edges: faces of noded line work, and outlines of exact coverages, as tables of half-edges.

A half-edge is a directed segment ``x1, y1, x2, y2`` that has its face on its left. Each has one follower on the border of
that face: at its end, the first half-edge clockwise from the way it came. Followers form rings; a ring is found and
ordered by pointer doubling, in log2(longest ring) joins, so no task sees a ring before it is written as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import nested as N
from coverlay.operators.adjacency import canonical_edges
from coverlay.operators.attributes import best_per_key
from coverlay.operators.points import points_in_keyed_areas
from coverlay.operators.spread import number_by
from coverlay.operators.stage import store

_ENDS = ["x1", "y1", "x2", "y2"]


def both_ways(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The two half-edges of each distinct undirected edge; edges without length go."""
    e = canonical_edges(edges, list(keys)).where("x1 <> x2 OR y1 <> y2").distinct()
    return e.unionByName(e.select(*keys, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2")))


def oriented(nested: str) -> Column:
    """Parts → rings → points with each part's shell anticlockwise and its holes clockwise: the inside is on the left."""
    return F.transform(nested, lambda part: F.transform(part, lambda r, i: F.when((N.ring_area(r) > 0) == (i == 0), r).otherwise(F.reverse(r))))


def directed(outline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Half-edges of :func:`~coverlay.operators.dissolve.outline_edges`: turned where ``dir`` says so."""
    turned = F.col("dir") < 0
    pick = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    return outline.select(*keys, pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"), pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2"))


def followers(halves: DataFrame, group: Sequence[str], clockwise: bool = True) -> DataFrame:
    """``h, next`` of half-edges with an id ``h``: the sharpest turn at the end of each, among half-edges of its ``group``.

    Arrivals and departures of a node are put in the order of their directions; an arrival goes on with the first
    departure clockwise (or anticlockwise) from where it came, back only if there is no other.
    """
    way = lambda ax, ay, bx, by: F.atan2(F.col(by) - F.col(ay), F.col(bx) - F.col(ax)) * (1.0 if clockwise else -1.0)
    out = halves.select(*group, F.col("x1").alias("x"), F.col("y1").alias("y"), way("x1", "y1", "x2", "y2").alias("way"), F.lit(1).alias("out"), "h")
    into = halves.select(*group, F.col("x2").alias("x"), F.col("y2").alias("y"), way("x2", "y2", "x1", "y1").alias("way"), F.lit(0).alias("out"), "h")
    # -pi and pi are one direction
    both = out.unionByName(into).withColumn("way", F.when(F.col("way") <= -F.pi(), F.pi()).otherwise(F.col("way")))
    node = W.partitionBy(*group, "x", "y")
    leaving = F.when(F.col("out") == 1, F.col("h"))
    before = F.last(leaving, ignorenulls=True).over(node.orderBy("way", "out").rowsBetween(W.unboundedPreceding, -1))
    around = F.max(F.when(F.col("out") == 1, F.struct("way", "h"))).over(node)["h"]
    return both.withColumns({"_before": before, "_around": around}).where("out = 0").select("h", F.coalesce("_before", "_around").alias("next"))


def cycles(follow: DataFrame) -> DataFrame:
    """``h, ring, ahead`` of a permutation ``h, next``: the smallest id of each cycle, and how many steps lead to it.

    Pointer doubling: after ``k`` rounds each id knows the smallest of the ``2^k`` ids from it on.
    """
    state = store(follow.select("h", F.col("next").alias("jump"), F.col("h").alias("ring"), F.lit(0).cast("long").alias("ahead")), "cycles")
    step = 1
    while True:
        there = state.select(F.col("h").alias("jump"), F.col("jump").alias("_jump"), F.col("ring").alias("_ring"), F.col("ahead").alias("_ahead"))
        less = F.col("_ring") < F.col("ring")
        state = store(state.join(there, "jump").select(
            "h", F.col("_jump").alias("jump"), F.least("ring", "_ring").alias("ring"), F.when(less, F.col("_ahead") + step).otherwise(F.col("ahead")).alias("ahead"), less.alias("moved"),
        ), "cycles")
        if state.where("moved").isEmpty():
            return state.select("h", "ring", "ahead")
        step *= 2


def _traced(halves: DataFrame, group: Sequence[str], name: str, clockwise: bool = True) -> DataFrame:
    found = cycles(followers(halves, group, clockwise)).withColumnsRenamed({"ring": name, "ahead": f"{name}_ahead"})
    return halves.drop(name, f"{name}_ahead").join(found, "h")


def rings(halves: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, face, ring, area, path``: the borders of all faces as closed rings that don't touch themselves.

    ``face`` tells connected areas apart: tracing by the sharpest clockwise turn never crosses from one to another that only
    touches it in a point. Where such a border passes a node twice, it is traced once more within its face by the
    sharpest turn the other way, which parts holes from the shell and from each other. ``area`` is positive for
    shells (anticlockwise), negative for holes and for the outside of line work.
    """
    keys = list(keys)
    faced = halves if "face" in halves.columns else _traced(halves, keys, "face")
    faced = store(faced, "faces")
    busy = faced.groupBy("face", "x1", "y1").count().where("count > 1").select("face").distinct()
    busy = store(busy, "touching-faces")
    plain = faced.join(busy, "face", "left_anti").withColumns({"ring": F.col("face"), "ring_ahead": F.col("face_ahead")})
    again = faced.join(busy, "face", "left_semi")
    both = plain if busy.isEmpty() else plain.unionByName(_traced(store(again, "touching"), ["face"], "ring", clockwise=False).select(*plain.columns))
    # the ring's first half-edge, then those that are further from it
    at = F.struct((F.col("ring_ahead") > 0).alias("later"), (-F.col("ring_ahead")).alias("pos"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    per = both.groupBy(*keys, "face", "ring").agg(F.array_sort(F.collect_list(at)).alias("_at"), (F.sum(cross) / 2).alias("area"))
    path = F.transform("_at", lambda p: N.xy(p["x"], p["y"]))
    return per.select(*keys, "face", "ring", "area", F.concat(path, F.slice(path, 1, 1)).alias("path"))


def assemble(found: DataFrame, keys: Sequence[str] = (), band: float | None = None) -> DataFrame:
    """``keys, face, nested``: one polygon per shell of :func:`rings`, holes in it.

    A hole of a face with a shell is that shell's. Others (they don't touch a shell) belong to the smallest shell of
    their key around them: rays from one of their points cross its border an odd number of times. ``band`` cuts borders and
    rays by height. The outside of line work is in no shell and goes.
    """
    keys = list(keys)
    found = store(found, "rings")
    shells = found.where("area > 0")
    holes = found.where("area < 0")
    own = holes.join(shells.select("face", F.col("ring").alias("shell")), "face").select("ring", "shell")
    free = holes.join(shells.select("face"), "face", "left_anti")
    points = free.select(*keys, F.col("ring").alias("hole"), (-F.col("area")).alias("_least"), F.element_at("path", 1)["x"].alias("x"), F.element_at("path", 1)["y"].alias("y"))
    areas = shells.select(*keys, F.col("ring").alias("shell"), F.array(F.array("path")).alias("nested"))
    inside = points_in_keyed_areas(points, areas, keys, "hole", "shell", band=band or _height(found))
    sized = inside.join(shells.select(F.col("ring").alias("shell"), "area"), "shell").join(points.select("hole", "_least"), "hole").where("area > _least")
    placed = own.unionByName(best_per_key(sized.select("hole", "shell", "area"), ["hole"], "area").select(F.col("hole").alias("ring"), "shell"))
    cut = holes.join(placed, "ring").groupBy("shell").agg(F.array_sort(F.collect_list(F.struct("ring", "path"))).alias("_cut"))
    whole = shells.join(cut.withColumnRenamed("shell", "ring"), "ring", "left")
    inner = F.coalesce(F.transform("_cut", lambda h: h["path"]), F.array().cast(found.schema["path"].dataType.simpleString().join(["array<", ">"])))
    return whole.select(*keys, "face", F.array(F.concat(F.array("path"), inner)).alias("nested"))


def _height(found: DataFrame) -> float:
    """A band of rays as high as a usual ring, and a 4096th of everything at least."""
    y = F.transform("path", lambda p: p["y"])
    tall = F.array_max(y) - F.array_min(y)
    usual, low, high = found.agg(F.percentile_approx(tall, 0.5), F.min(F.array_min(y)), F.max(F.array_max(y))).first()
    return max(usual or 0.0, ((high or 0.0) - (low or 0.0)) / 4096) or 1.0


def faces(edges: DataFrame, keys: Sequence[str] = (), band: float | None = None) -> DataFrame:
    """``keys, face, nested``: every bounded face of noded line work ``keys, x1, y1, x2, y2``, holes cut out.

    Edges may be given in either direction and more than once; they must meet at their ends only. Edges with the same face
    on both sides (dangling ends, bridges) bound nothing and go. Faces come out whole whatever their size; ids follow from
    the coordinates, not from how rows are partitioned. An empty table has no faces.
    """
    keys = list(keys)
    halves = store(number_by(both_ways(edges, keys), [*keys, *_ENDS], "h"), "half-edges")
    traced = store(_traced(halves, keys, "face"), "faces")
    other = traced.select(*keys, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("face").alias("_other"))
    compared = store(traced.join(other, [*keys, *_ENDS]).withColumn("idle", F.col("face") == F.col("_other")).drop("_other"), "faces")
    left = compared.where("NOT idle").drop("idle")
    if not compared.where("idle").isEmpty():
        left = left.drop("face", "face_ahead")
    return assemble(rings(left, keys), keys, band)


def outlines(halves: DataFrame, keys: Sequence[str], band: float | None = None) -> DataFrame:
    """``keys, face, nested``: the polygons per key that directed outline edges bound, inside on the left.

    Takes what is left of an exact coverage once shared edges have cancelled. Parts that touch in points are polygons of their
    own, holes that touch the shell or each other are rings of their own; islands in holes are shells.
    """
    keys = list(keys)
    return assemble(rings(store(number_by(halves.select(*keys, *_ENDS), [*keys, *_ENDS], "h"), "half-edges"), keys), keys, band)
