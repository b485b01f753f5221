"""Overlay, dissolve, repair and simplification: invariants and awkward shapes."""

import random

import pytest
from pyspark.sql import functions as F

from coverlay.functions import geodesy
from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.functions import zoom as Z
from coverlay.functions.keys import KeyRanges, release
from coverlay.operators.dissolve import dissolve, dissolve_parts
from coverlay.operators.grid import spatial_join
from coverlay.operators.simplify import simplify_coverage
from tests.test_joins import boxes, frame

UNIT = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"


def scalar(df, expr):
    return df.select(expr).first()[0]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_dissolve_matches_brute_force(spark, parts):
    """Overlapping boxes, a third of them in one place: same polygons for any partitioning and cell size."""
    rows = boxes(150, 11, spread=12.0)
    d = frame(spark, rows).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2)).repartition(parts)
    whole = d.groupBy("g").agg(G.union_agg("geom").alias("geom"))
    want = {(r.g, round(r.a, 6)) for r in whole.select("g", F.explode(G.polygons("geom")).alias("p")).select("g", G.area("p").alias("a")).collect()}
    for cell in (None, 1.0, 100.0):
        got = dissolve_parts(d, ["g"], cell=cell)
        assert {(r.g, round(r.a, 6)) for r in got.select("g", G.area("geom").alias("a")).collect()} == want
    total = {r.g: r.a for r in dissolve(d, ["g"]).select("g", G.area("geom").alias("a")).collect()}
    assert total == pytest.approx({r.g: r.a for r in whole.select("g", G.area("geom").alias("a")).collect()})


def test_dissolve_ignores_null_and_empty(spark, shapes):
    d = shapes([(1, None), (1, "POLYGON EMPTY"), (1, UNIT), (2, None)])
    assert [tuple(r) for r in dissolve_parts(d, ["id"]).select("id", G.area("geom")).collect()] == [(1, 16.0)]


def test_area_is_split_by_overlay(spark):
    j = spatial_join(frame(spark, boxes(40, 12)), frame(spark, boxes(40, 13), "2"), G.intersects, 4.0)
    off = j.select(
        F.abs(G.area("geom") - G.area(G.difference("geom", "geom2")) - F.coalesce(G.area(G.polygonal_intersection("geom", "geom2")), F.lit(0.0))).alias("e")
    )
    assert off.agg(F.max("e")).first()[0] < 1e-9


def test_polygonal_intersection_ignores_lines_and_points(spark, shapes):
    d = shapes([(1, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))"), (2, "POLYGON ((4 4, 5 4, 5 5, 4 5, 4 4))"), (3, "LINESTRING (0 0, 4 4)"),
                (4, "POLYGON ((3 3, 9 3, 9 9, 3 9, 3 3))"), (5, "POLYGON ((50 50, 51 50, 51 51, 50 50))")])
    got = d.select("id", G.area(G.polygonal_intersection("geom", G.from_text(F.lit(UNIT))))).orderBy("id").collect()
    assert [r[1] for r in got] == [None, None, None, 1.0, None]


def test_repair(spark, shapes):
    d = shapes([
        (1, "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"), (2, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (0 0, 2 1, 1 2, 0 0))"),
        (3, "POLYGON ((0 0, 4 0, 4 4, 8 4, 4 4, 0 4, 0 0))"), (4, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"),
    ])
    got = d.select("id", G.is_valid("geom").alias("ok"), G.area(G.make_valid("geom")).alias("a"), G.is_valid(G.make_valid("geom")).alias("now")).orderBy("id").collect()
    assert [r.ok for r in got] == [False, True, False, True]
    assert [r.a for r in got] == [2.0, 14.5, 16.0, 1.0] and all(r.now for r in got)


def test_parts_of_a_collection(spark, shapes):
    d = shapes([(1, "GEOMETRYCOLLECTION (POLYGON ((0 0, 1 0, 1 1, 0 0)), LINESTRING (0 0, 9 9), POLYGON EMPTY)"), (2, "POLYGON EMPTY"), (3, None)])
    got = d.select("id", F.size(G.parts("geom")).alias("n"), F.size(G.polygons("geom")).alias("p"), G.kind("geom").alias("k")).orderBy("id").collect()
    assert [(r.n, r.p) for r in got[:2]] == [(2, 1), (0, 0)] and got[0].k == "GeometryCollection" and got[2].k is None


def test_snap_collapses_and_vw_never_loses_a_feature(spark, shapes):
    d = shapes([(1, "POLYGON ((0 0, 0.000001 0, 0.000001 0.000001, 0 0))"), (2, UNIT)])
    got = d.select("id", G.is_empty(G.snap_to_grid("geom", 0.00001)).alias("gone"), G.num_points(G.simplify_vw("geom", 1e6)).alias("n")).orderBy("id").collect()
    assert [(r.gone, r.n) for r in got] == [(True, 4), (False, 4)]
    nested = d.select("id", F.size(N.snap_to_grid(G.decode("geom"), 0.00001)).alias("n")).orderBy("id").collect()
    assert [r.n for r in nested] == [0, 1]


def test_split_in_turn(spark, shapes):
    d = shapes([(1, UNIT)])
    cross = G.from_text(F.lit("MULTILINESTRING ((-1 2, 5 2), (2 2, 2 5))"))
    assert scalar(d, F.size(G.split_polygon("geom", cross))) == 3
    assert scalar(d, F.size(G.split_polygon("geom", G.from_text(F.lit("LINESTRING (1 1, 2 2)"))))) == 1
    assert scalar(d, F.size(G.split_polygon("geom", F.lit(None).cast("binary")))) == 1


def test_chopped_buffer_covers_the_same(spark):
    rng = random.Random(3)
    x, pts = 0.0, []
    for _ in range(200):
        x += rng.uniform(0.5, 1.5)
        pts.append(f"{x} {rng.uniform(-1, 1)}")
    d = spark.createDataFrame([(1, f"LINESTRING ({', '.join(pts)})")], "id int, wkt string").select("id", G.from_text("wkt").alias("geom"))
    whole = scalar(d, G.area(G.buffer_flat("geom", 0.1, 1)))
    runs = d.select("id", F.explode(G.chop("geom", 16)).alias("geom"))
    assert runs.count() > 10
    pieces = runs.groupBy("id").agg(G.union_agg(G.buffer_flat("geom", 0.1, 1)).alias("geom"))
    assert scalar(pieces, G.area("geom")) == pytest.approx(whole, rel=1e-9)


def test_chop_wraps_closed_rings(spark, shapes):
    ring = shapes([(1, UNIT)]).select("id", G.boundary("geom").alias("geom"))
    runs = ring.select("id", F.explode(G.chop("geom", 3)).alias("geom"))
    pieces = runs.groupBy("id").agg(G.union_agg(G.buffer_flat("geom", 0.25, 1)).alias("geom"))
    assert scalar(pieces, G.area("geom")) == pytest.approx(scalar(ring, G.area(G.buffer("geom", 0.25, 1))))


def test_simplified_coverage_stays_a_coverage(spark):
    """Wavy common borders: fewer vertices, no overlap, no gap, and both sides agree on the border."""
    n, rows = 4, []
    wave = lambda t, s: 0.2 * ((t * 7 + s * 3) % 5 - 2) / 2

    def edge(ax, ay, bx, by, key):
        k = 12
        return [(ax + (bx - ax) * i / k + (wave(i, key) if ax == bx and 0 < i else 0), ay + (by - ay) * i / k + (wave(i, key) if ay == by and 0 < i else 0)) for i in range(k)]

    size = 4.0
    for i in range(n):
        for j in range(n):
            x, y = i * size, j * size
            bottom, top = edge(x, y, x + size, y, i * 10 + j), edge(x, y + size, x + size, y + size, i * 10 + j + 1)
            left, right = edge(x, y, x, y + size, 500 + i * 10 + j), edge(x + size, y, x + size, y + size, 500 + (i + 1) * 10 + j)
            back = lambda pts, end: [end] + pts[:0:-1]
            ring = bottom + right + back(top, (x + size, y + size)) + back(left, (x, y + size))
            ring.append(ring[0])
            rows.append((i * n + j, "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in ring) + "))"))
    d = spark.createDataFrame(rows, "id int, wkt string").select("id", G.from_text("wkt").alias("geom"))
    assert d.where(~G.is_valid("geom")).count() == 0
    out = simplify_coverage(d, "id", 0.3, 4.0).persist()
    assert out.count() == n * n
    before, after = (x.agg(F.sum(G.num_points("geom"))).first()[0] for x in (d, out))
    assert after < before / 3
    union = out.groupBy(F.lit(1)).agg(G.union_agg("geom").alias("u"), F.sum(G.area("geom")).alias("s")).select(G.area("u").alias("u"), "s", G.num_parts("u").alias("n")).first()
    assert union.u == pytest.approx(union.s, abs=1e-9) and union.n == 1
    holes = out.groupBy(F.lit(1)).agg(G.union_agg("geom").alias("u")).select(F.size(N.rings(G.decode("u")))).first()[0]
    assert holes == 1
    out.unpersist()


def test_albers_area(spark):
    """A one-degree cell at the equator side of the zone against the closed form of an ellipsoid cell."""
    d = spark.createDataFrame([(133.0, -25.0)], "x double, y double")
    box = F.array(F.array(N.box_ring(F.col("x"), F.col("y"), F.col("x") + 0.01, F.col("y") + 0.01)))
    assert scalar(d, N.area(geodesy.albers_nested(box))) == pytest.approx(1108.0 * 1009.6, rel=2e-3)


def test_datum_shift_is_about_two_metres(spark):
    d = spark.createDataFrame([(144.0, -37.0)], "x double, y double")
    p = d.select(geodesy.gda2020(F.col("x"), F.col("y")).alias("p")).first().p
    dy, dx = (p.y + 37.0) * 111000, (p.x - 144.0) * 89000
    assert 1.2 < (dx * dx + dy * dy) ** 0.5 < 2.2 and dy > 0


def test_zoom_columns(spark):
    d = spark.createDataFrame([(0,), (5,), (10,), (15,), (20,)], "z int")
    got = d.select(Z.decimal_places("z").alias("p"), Z.tolerance("z").alias("t")).collect()
    assert [r.p for r in got] == [1, 2, 3, 5, 6]
    assert got[3].t == pytest.approx(9.208633852887194e-09, rel=1e-12)


def test_release_and_ranges(spark):
    d = spark.createDataFrame([("2024-01-31",), ("2024-02-01",), ("2024-10-31",), ("2024-12-01",)], "d string")
    assert [r[0] for r in d.select(release(F.col("d").cast("date"))).collect()] == ["202311", "202402", "202408", "202411"]
    assert KeyRanges.plan(1, 25, 6) == KeyRanges(1, 10, 3)
    assert KeyRanges.plan(1, 601, 6) == KeyRanges(1, 101, 6)
    assert KeyRanges.plan(1, 601, 6).jdbc_options("gid")["numPartitions"] == "6"


def test_nested_forms_agree_with_kernel(spark, shapes):
    d = shapes([(1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"), (2, "MULTIPOLYGON (((0 0, 3 0, 0 3, 0 0)), ((5 5, 6 5, 6 7, 5 5)))")])
    d = d.withColumn("n", G.decode("geom"))
    for r in d.select(N.area("n").alias("a"), G.area("geom").alias("b"), N.length("n").alias("c"), G.length("geom").alias("d"),
                      N.centroid("n").alias("e"), G.centroid("geom").alias("f"), N.num_points("n").alias("g"), G.num_points("geom").alias("h")).collect():
        assert r.a == r.b and r.c == pytest.approx(r.d) and r.g == r.h
        assert r.e.x == pytest.approx(r.f.x) and r.e.y == pytest.approx(r.f.y)
