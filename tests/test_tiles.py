"""Subdivision by edges: nothing is lost, doubled or too large."""

import math
import random

import pytest
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators import tiles as T

NESTED = "array<array<array<struct<x:double,y:double>>>>"


def box(x, y, w=1.0, h=1.0):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def star(n, cx=0.0, cy=0.0, seed=1, least=2.0):
    at = random.Random(seed)
    pts = [(cx + math.cos(2 * math.pi * i / n) * r, cy + math.sin(2 * math.pi * i / n) * r) for i in range(n) for r in [at.uniform(least, 10)]]
    return [*pts, pts[0]]


def stairs(n):
    """Whole coordinates, with vertices and edges on the lines that halve it."""
    pts = [(0.0, 0.0), (float(n), 0.0)]
    for i in range(n, 0, -1):
        pts += [(float(i), float(n - i + 1)), (float(i - 1), float(n - i + 1))]
    return [*pts, pts[0]]


CASES = {
    1: [[box(0.0, 0.0)]],
    2: [[star(50, least=8.0)]],
    3: [[star(40, least=8.0), *[box(i * 2.0, j * 2.0, 0.5, 0.5) for i in range(-1, 2) for j in range(-1, 2)]]],
    4: [[stairs(16)]],
    5: [[box(0.0, 0.0, 8.0, 8.0), *[box(i + 0.5, j + 0.5, 0.5, 0.5) for i in (1, 3, 5) for j in (2, 4)]], [box(100.0, 100.0)]],
    6: [[box(0.0, 0.0, 8.0, 8.0), [(4.0, 2.0), (6.0, 4.0), (4.0, 6.0), (2.0, 4.0), (4.0, 2.0)]]],
    7: [[[(0.0, 0.0), *[(float(i), 0.0) for i in range(1, 30)], (30.0, 0.0), (30.0, 0.001), (0.0, 0.001), (0.0, 0.0)]]],
    8: [[box(0.0, 0.0, 16.0, 16.0), *[box(8.0, 2.0 * j, 2.0, 1.0) for j in range(1, 7)]]],
}


@pytest.mark.parametrize("most", [24])
def test_pieces_against_the_whole(spark, most):
    given = spark.createDataFrame([(k, v, "extra") for k, v in CASES.items()], f"k int, nested {NESTED}, tile string")
    pieces = T.subdivide(given, ["k"], max_points=most).withColumn("geom", G.encode("nested")).cache()
    assert pieces.columns == ["k", "tile", "nested", "geom"]
    assert pieces.where(~G.is_valid("geom")).count() == 0
    assert pieces.agg(F.max(N.num_points("nested"))).first()[0] <= most
    whole = given.select("k", G.encode("nested").alias("whole"))
    united = pieces.groupBy("k").agg(G.union_agg("geom").alias("united"), F.sum(N.area("nested")).alias("area"))
    for r in united.join(whole, "k").select("k", "area", G.area("whole").alias("want"), G.area(G.difference("whole", "united")).alias("lost"), G.area(G.difference("united", "whole")).alias("new")).collect():
        assert r.area == pytest.approx(r.want, rel=1e-9), r.k
        assert (r.lost or 0) < 1e-9 and (r.new or 0) < 1e-9, r.k
    assert {r.k for r in united.collect()} == set(CASES)
    assert pieces.where("k = 1").count() == 1 and pieces.where("k = 2").count() >= 4
    pieces.unpersist()


def test_odd_rows(spark):
    none = spark.createDataFrame([], f"k int, nested {NESTED}")
    assert T.subdivide(none, ["k"], max_points=8).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [[[(1.0, 1.0), (1.0, 1.0), (1.0, 1.0), (1.0, 1.0)]]])], f"k int, nested {NESTED}")
    assert T.subdivide(odd, ["k"], max_points=8).collect() == []
    with pytest.raises(ValueError, match="8 points"):
        T.subdivide(odd, ["k"], max_points=4)


def test_edges_that_meet_in_one_place_end(spark, monkeypatch):
    """A fan whose spikes meet in one point can't be cut below its spikes there; after the last halving it stays as it is."""
    monkeypatch.setattr(T, "DEEPEST", 3)
    spikes = [[[(0.0, 0.0), (1.0, i / 8), (1.0, i / 8 + 1 / 16), (0.0, 0.0)]] for i in range(12)]
    fan = spark.createDataFrame([(1, spikes)], f"k int, nested {NESTED}")
    got = T.subdivide(fan, ["k"], max_points=16)
    assert got.agg(F.sum(N.area("nested"))).first()[0] == pytest.approx(12 / 32)


def by_way(spark, monkeypatch, given, most, gathered):
    """All pieces, point by point, where a task may take ``gathered`` edges at once."""
    monkeypatch.setattr(T, "GATHERED", gathered)
    got = T.subdivide(given, ["k"], max_points=most)
    return sorted((r.k, r.tile, [[[(p.x, p.y) for p in ring] for ring in part] for part in r.nested]) for r in got.collect())


@pytest.mark.parametrize("most", [24])
def test_one_task_and_the_table_make_the_same_pieces(spark, monkeypatch, most):
    """Short outlines in their rows, longer ones by the table down to tiles of 40 edges, and all of it by the table."""
    reversed_star = star(60, 3.0, -2.0, seed=5)[::-1]
    rows = [*CASES.items(), (9, [[reversed_star]]), (10, [[star(50, 1e6, -1e6, seed=7)]]), (11, [[star(12)]]), (11, [[star(30, 40.0, 40.0, seed=3)], [box(80.0, 0.0)]])]
    # the same outline twice cancels, rows without a key or a shape are left out, a missing number goes to the table
    rows += [(12, [[box(0.0, -0.0)]]), (12, [[box(0.0, 0.0)]]), (None, [[box(0.0, 0.0)]]), (13, None), (14, [[box(0.0, 0.0)]]), (14, None), (15, [])]
    given = spark.createDataFrame(rows, f"k int, nested {NESTED}")
    table = by_way(spark, monkeypatch, given, most, 0)
    assert {k for k, _, _ in table} == {*range(1, 12), 14}
    assert by_way(spark, monkeypatch, given, most, 1 << 14) == table
    assert by_way(spark, monkeypatch, given, most, 40) == table


def test_edges_as_a_table_make_the_same_pieces(spark, monkeypatch):
    nested = spark.createDataFrame([(1, [[star(200, seed=11), box(-0.5, -0.5)]])], f"k int, nested {NESTED}")
    edges = N.to_segments(nested.select("k", T.oriented("nested").alias("n")), "n", ["k"]).select("k", "ring", "x1", "y1", "x2", "y2")
    for gathered in (0, 50):
        monkeypatch.setattr(T, "GATHERED", gathered)
        got = sorted((r.tile, str(r.nested)) for r in T.subdivide_edges(edges, ["k"], 32).collect())
        want = want if gathered else got
        assert got == want and len(got) > 8


def test_short_outlines_are_not_written_as_edges(spark, monkeypatch):
    """What failed by disk: all that a table of short outlines leaves on disk is the list of keys that need more."""
    written = []
    keep = T.store
    monkeypatch.setattr(T, "store", lambda df, name="stage": written.append((name, (out := keep(df, name)).count())) or out)
    given = spark.range(200).select(F.col("id").alias("k"), F.array(F.array(F.array(*[N.xy(F.col("id") + x, F.lit(y)) for x, y in star(64)]))).alias("nested"))
    pieces = T.subdivide(given, ["k"], max_points=16)
    assert pieces.select("k").distinct().count() == 200 and pieces.agg(F.max(N.num_points("nested"))).first()[0] <= 16
    assert written == [("keys-apart", 0)]
