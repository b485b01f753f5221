"""Rings and faces from edges: against the geometry kernel, and by the definition."""

import random

import pytest
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators import halfedges as H
from coverlay.operators.dissolve import dissolve_exact, dissolve_local

NESTED = "array<array<array<struct<x:double,y:double>>>>"
EDGES = "x1 double, y1 double, x2 double, y2 double"


def tidy(ring):
    """A ring without its repeated end and without vertices on straight lines, from its smallest point on."""
    pts = [tuple(p) for p in ring][:-1]
    keep = [
        b for a, b, c in zip(pts[-1:] + pts[:-1], pts, pts[1:] + pts[:1], strict=True)
        if (b[0] - a[0]) * (c[1] - b[1]) != (c[0] - b[0]) * (b[1] - a[1])
    ]
    turn = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(keep, keep[1:] + keep[:1], strict=True))
    at = keep.index(min(keep))
    keep = keep[at:] + keep[:at]
    return tuple(keep if turn > 0 else keep[:1] + keep[:0:-1])


def plain(nested):
    return {(tidy(part[0]), frozenset(map(tidy, part[1:]))) for part in nested}


def box(x, y, w=1, h=1):
    x, y, w, h = map(float, (x, y, w, h))
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def dissolved(spark, rows):
    """``{key: polygons}`` by edges and by the kernel's union."""
    df = spark.createDataFrame(rows, f"k int, nested {NESTED}")
    got = {}
    for r in dissolve_exact(df, ["k"]).collect():
        got.setdefault(r.k, []).append(r.nested[0])
    valid = dissolve_exact(df, ["k"]).select(G.is_valid(G.encode("nested")).alias("v")).collect()
    assert all(r.v for r in valid)
    want = dissolve_local(df.withColumn("geom", G.encode("nested")), ["k"]).select("k", G.decode("geom").alias("nested")).collect()
    return {k: plain(v) for k, v in got.items()}, {r.k: plain(r.nested) for r in want}


@pytest.mark.parametrize("seed", range(3))
def test_random_cells(spark, seed):
    """Cells of a grid dealt to three keys: corners that touch, holes that touch shells and each other, islands in holes."""
    rng = random.Random(seed)
    rows = [(rng.randrange(3), [[box(x, y)]]) for x in range(9) for y in range(9) if rng.random() < 0.95]
    got, want = dissolved(spark, rows)
    assert got == want


def test_nested_holes_and_islands(spark):
    """A frame in a frame in a frame; the island in the innermost hole touches its border in a corner."""
    frames = [(1, [[box(-d, -d, 2 * d, 2 * d), box(-d + 1, -d + 1, 2 * d - 2, 2 * d - 2)]]) for d in (2, 6, 10)]
    got, want = dissolved(spark, [*frames, (1, [[[(0.0, 0.0), (1.0, 1.0), (0.0, 0.5), (0.0, 0.0)]]]), (2, [[box(-9, -9, 18, 18)]])])
    assert got == want and len(got[1]) == 4


def test_rings_given_either_way(spark):
    square, hole = box(0, 0, 4, 4), box(1, 1)
    for shell in (square, square[::-1]):
        for inner in (hole, hole[::-1]):
            got, want = dissolved(spark, [(1, [[shell, inner]]), (1, [[box(4, 0, 4, 4)]]), (1, [[box(1, 1)[::-1]]])])
            assert got[1] == {(tidy([(0.0, 0.0), (4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]), frozenset())} == want[1]


def network(spark, edges):
    found = H.faces(spark.createDataFrame([tuple(map(float, e)) for e in edges], EDGES))
    return sorted((tidy(r.nested[0][0]), frozenset(map(tidy, r.nested[0][1:]))) for r in found.collect())


def sides(ring):
    return [(*a, *b) for a, b in zip(ring, ring[1:], strict=False)]


@pytest.mark.parametrize("seed", range(3))
def test_random_networks(spark, seed):
    """Grid edges left out at random: dangling ends, bridges, parts inside faces, faces that meet themselves in a node."""
    rng = random.Random(seed)
    edges = [e for x in range(9) for y in range(9) for e in ((x, y, x + 1, y), (x, y, x, y + 1)) if rng.random() < 0.62]
    edges += [(b, c, a, d) for a, d, b, c in rng.sample(edges, 9)] + rng.sample(edges, 9)
    got = network(spark, edges)
    lines = spark.createDataFrame([tuple(map(float, e)) for e in {(min(e[:2], e[2:]) + max(e[:2], e[2:])) for e in edges}], EDGES)
    kernel = lines.agg(F.collect_list(G.line(F.array(N.xy("x1", "y1"), N.xy("x2", "y2")))).alias("lines")).select(F.explode(G.polygonize("lines")).alias("g"))
    want = [p for r in kernel.select(G.decode("g").alias("n")).collect() for p in plain(r.n)]
    assert got == sorted(want)


def test_a_face_as_long_as_the_network(spark):
    """Ladder without rungs, a tail, a bridge to an island that lies in a face, and slanted edges."""
    n = 150
    ladder = [(i, 0, i + 1, 0) for i in range(n)] + [(i, 3, i + 1, 3) for i in range(n)] + [(0, 0, 0, 3), (n, 0, n, 3)]
    island = sides([(5, 1), (6, 2), (5, 2), (5, 1)])
    bridged = sides([(9, 1), (10, 2), (9, 2), (9, 1)]) + [(9, 2, 9, 3)]
    got = network(spark, ladder + island + bridged + [(n, 3, n + 1, 4), (n + 1, 4, n + 2, 4)])
    assert len(got) == 3 and sorted(len(h) for _, h in got) == [0, 0, 2]


def test_ids_and_empty(spark):
    edges = [tuple(map(float, e)) for x in range(4) for e in sides(box(x, 0))]
    frame = spark.createDataFrame(edges, EDGES)
    one, two = (sorted(map(str, H.faces(frame.repartition(n)).collect())) for n in (1, 5))
    assert one == two and len(one) == 4
    assert H.faces(frame.limit(0)).count() == 0 and dissolve_exact(spark.createDataFrame([], f"k int, nested {NESTED}"), ["k"]).count() == 0
