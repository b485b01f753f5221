"""Grid joins, points, order and lines against brute force on small random layers."""

import math
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators import attributes as A
from coverlay.operators import grid
from coverlay.operators import points as P
from coverlay.operators.grid import corner_cell, spatial_filter, spatial_join, suggest_cell_size, with_bounds
from coverlay.operators.lines import chain_lines, label_chains, merge_lines, node_edges
from coverlay.operators.points import nearest_outline, points_in_areas, points_in_keyed_areas
from coverlay.operators.spread import look_up, running


def boxes(n, seed, spread=40.0, big=0.1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # a third of all boxes sit in one small place
        x, y = (rng.uniform(0, 1), rng.uniform(0, 1)) if i % 3 == 0 else (rng.uniform(-spread, spread), rng.uniform(-spread, spread))
        w, h = (rng.uniform(0.1, 20) if rng.random() < big else rng.uniform(0.05, 1) for _ in "wh")
        out.append((i, x, y, x + w, y + h))
    return out


def frame(spark, rows, suffix=""):
    d = spark.createDataFrame(rows, "id int, x0 double, y0 double, x1 double, y1 double")
    return d.select(F.col("id").alias(f"id{suffix}"), G.box("x0", "y0", "x1", "y1").alias(f"geom{suffix}"))


def meet(a, b):
    return a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]


@pytest.mark.parametrize("cell,refine", [(1.0, None), (7.3, None), (64.0, None), (4.0, 5), (64.0, 10), (0.7, 3)])
def test_pairs_once_each(spark, cell, refine):
    a, b = boxes(120, 1), boxes(110, 2)
    got = spatial_join(frame(spark, a), frame(spark, b, "2"), G.intersects, cell, refine_above=refine).select("id", "id2").collect()
    want = sorted((p[0], q[0]) for p in a for q in b if meet(p, q))
    assert sorted(map(tuple, got)) == want


def test_equality_keys_and_expand(spark):
    a, b = boxes(60, 3), boxes(60, 4)
    left = frame(spark, a).withColumn("g", F.col("id") % 3)
    right = frame(spark, b, "2").withColumn("g", F.col("id2") % 3)
    got = spatial_join(left, right, lambda x, y: G.within_distance(x, y, 1.5), 3.0, on=["g"], expand=1.5)

    def gap(p, q):
        return math.hypot(max(p[1] - q[3], q[1] - p[3], 0), max(p[2] - q[4], q[2] - p[4], 0))

    want = sorted((p[0], q[0]) for p in a for q in b if p[0] % 3 == q[0] % 3 and gap(p, q) <= 1.5)
    assert sorted(tuple(r) for r in got.select("id", "id2").collect()) == want


@pytest.mark.parametrize("small", ["left", "right"])
@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_measured_broadcast_changes_nothing(spark, monkeypatch, small, limit):
    monkeypatch.setattr(grid, "BROADCAST_LIMIT", limit)
    a, b = boxes(50, 14), boxes(50, 15)
    j = spatial_join(frame(spark, a), frame(spark, b, "2"), G.intersects, 3.0, refine_above=4, small=small)
    assert sorted(tuple(r) for r in j.select("id", "id2").collect()) == sorted((p[0], q[0]) for p in a for q in b if meet(p, q))
    hinted = "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    assert hinted or limit == 0


def test_filter_keeps_or_drops(spark):
    a, b = boxes(80, 5), boxes(20, 6)
    hit = {p[0] for p in a if any(meet(p, q) for q in b)}
    left, right = frame(spark, a), frame(spark, b, "2")
    keep = spatial_filter(left, right, G.intersects, 4.0, "id")
    drop = spatial_filter(left, right, G.intersects, 4.0, "id", keep=False)
    assert {r.id for r in keep.collect()} == hit
    assert {r.id for r in drop.collect()} == {p[0] for p in a} - hit


def test_null_and_empty_have_no_partner(spark, shapes):
    left = shapes([(1, None), (2, "POLYGON EMPTY"), (3, "POINT (0.5 0.5)")])
    right = shapes([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")]).select(F.col("id").alias("id2"), F.col("geom").alias("geom2"))
    assert [r.id for r in spatial_join(left, right, G.intersects, 1.0).collect()] == [3]


def test_plan_is_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spatial_join(frame(spark, boxes(10, 7)), frame(spark, boxes(10, 8), "2"), G.intersects, 2.0)
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # one bounds call per side: no inferred filter evaluates geometry again
    assert plan.count("cv_bounds") == 2


def test_nested_columns_clash_is_an_error(spark):
    with pytest.raises(ValueError):
        spatial_join(frame(spark, boxes(3, 1)), frame(spark, boxes(3, 1)), G.intersects, 1.0)


def test_predicates_need_interior_contact(spark, shapes):
    box = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
    d = shapes([(1, "POINT (0 0)"), (2, "POINT (2 2)"), (3, "POINT (9 9)")]).withColumn("box", G.from_text(F.lit(box)))
    got = d.select("id", G.within("geom", "box"), G.intersects("geom", "box"), G.touches("geom", "box")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, False, True, True), (2, True, True, False), (3, False, False, False)]


def test_suggested_cell(spark):
    assert suggest_cell_size(frame(spark, [(i, 0.0, 0.0, 3.0, 1.0) for i in range(9)])) == 8.0


@pytest.mark.parametrize("band", [None, 0.7, 16.0])
def test_ray_crossings_match_the_kernel(spark, band):
    rng = random.Random(16)
    rows = [(i, *v) for i, v in enumerate((float(x), float(y), x + 3.0, y + 2.0) for x in range(-6, 6, 2) for y in range(-6, 6, 3))]
    tri = spark.createDataFrame(rows, "id int, x0 double, y0 double, x1 double, y1 double").select(
        "id", (F.col("id") % 2).alias("g"), F.array(F.array(N.ring([(F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y0") + 0.5), (F.col("x0") + 1.0, F.col("y1"))]))).alias("nested"))
    tri = tri.withColumn("geom", G.encode("nested"))
    pts = [(i, i % 2, rng.uniform(-7, 9), rng.choice([rng.uniform(-7, 7), float(rng.randint(-6, 6))])) for i in range(300)]
    p = spark.createDataFrame(pts, "pt int, g int, x double, y double")
    got = points_in_keyed_areas(p, tri, ["g"], "pt", "id", band=band).select("pt", "id")
    want = points_in_areas(p.select("pt", "g", "x", "y"), tri.select("id", "g", "geom"), 2.0, on=["g"]).select("pt", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 20


def test_nearest_outline_is_exact(spark):
    rng = random.Random(9)
    layer = [b for b in boxes(40, 10)]
    pts = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(50)]

    def dist(p, b):
        x, y = p[1], p[2]
        if b[1] < x < b[3] and b[2] < y < b[4]:
            return min(x - b[1], b[3] - x, y - b[2], b[4] - y)
        return math.hypot(max(b[1] - x, x - b[3], 0), max(b[2] - y, y - b[4], 0))

    near = nearest_outline(
        spark.createDataFrame(pts, "pt int, x double, y double"), frame(spark, layer), 2.0, "pt", "id"
    )
    got = {r.pt: r.dist for r in near.collect()}
    assert len(got) == len(pts)
    for p in pts:
        assert got[p[0]] == pytest.approx(min(dist(p, b) for b in layer), abs=1e-9)


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_k_with_ties_in_a_fixed_number_of_jobs(spark, k):
    """All pairs by the definition; twins at one distance are both there. A tenth and a thousand times the distances take as many jobs."""
    rng, jobs = random.Random(5), []
    for scale in (0.1, 1000.0):
        layer = [(i, *(v * scale for v in b[1:])) for i, b in enumerate(boxes(25, 10))]
        layer += [(100 + i, *b[1:]) for i, b in enumerate(layer[:5])]  # twins
        pts = [(i, rng.uniform(-60, 60) * scale, rng.uniform(-60, 60) * scale) for i in range(30)]

        def dist(p, b):
            x, y = p[1], p[2]
            if b[1] < x < b[3] and b[2] < y < b[4]:
                return min(x - b[1], b[3] - x, y - b[2], b[4] - y)
            return math.hypot(max(b[1] - x, x - b[3], 0), max(b[2] - y, y - b[4], 0))

        want = set()
        for p in pts:
            at = sorted((round(dist(p, b), 6), b[0]) for b in layer)
            want |= {(p[0], i) for d, i in at if d <= at[k - 1][0]}
        tracker, group = spark.sparkContext.statusTracker(), f"nearest-{k}-{scale}"
        spark.sparkContext.setJobGroup(group, group)
        near = nearest_outline(spark.createDataFrame(pts, "pt int, x double, y double"), frame(spark, layer), 2.0, "pt", "id", k=k)
        assert {(r.pt, r.id) for r in near.collect()} == want
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert abs(jobs[0] - jobs[1]) <= 4  # adaptive execution splits plans by size, loops would double them


def test_fewer_features_than_asked_for(spark):
    near = nearest_outline(spark.createDataFrame([(1, 0.0, 0.0)], "pt int, x double, y double"), frame(spark, [(7, 5.0, 5.0, 6.0, 6.0), (8, 50.0, 5.0, 60.0, 6.0)]), 1.0, "pt", "id", k=5)
    assert {r.id for r in near.collect()} == {7, 8}


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_rows_made_by_explode_are_not_sent_through_the_driver(spark, tmp_path):
    """The planner sees a file of a few kB, and not the rows that come from each of its rows."""
    spark.range(0, 300, 1, 2).write.parquet(str(tmp_path / "small"))
    rows = spark.read.parquet(str(tmp_path / "small")).select("id", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("n"))
    found = look_up(rows, ["id"], rows.groupBy("id").agg(F.max("n").alias("most")))
    assert broadcasts(found) == 0
    assert sorted(map(tuple, found.select("id", "n", "most").collect())) == [(i, n, 20) for i in range(300) for n in range(21)]


def test_running_sums_of_many_short_groups_are_not_sent_through_the_driver(spark):
    rows = spark.range(0, 200).select((F.col("id") % 100).alias("g"), "id", F.lit(2).alias("v"))
    found = running(rows, ["g"], ["id"], sums=["v"])
    assert broadcasts(found) == 0
    assert sorted(map(tuple, found.select("g", "place", "v_upto").collect())) == [(g, i, 2 * i) for g in range(100) for i in (1, 2)]


def test_nearest_outline_of_a_crowd_in_one_cell(spark, monkeypatch):
    """Points of a full cell are dealt over tasks, and only rows per cell are spread over the grids; repeated and null ids as ever."""
    monkeypatch.setattr(P, "_CROWD", 20)
    rng = random.Random(3)
    layer = [(i, -3.0 + 2 * i, -1.0, -2.0 + 2 * i, 1.0) for i in range(5)] + [(9, 400.0, 0.0, 401.0, 1.0)]
    pts = [(i, rng.uniform(-7, -4), rng.uniform(2, 3)) for i in range(90)] + [(90, 399.0, 0.5), (90, 398.0, 0.5), (None, 0.0, 0.0)]
    d = spark.createDataFrame(pts, "pt int, x double, y double")
    near = nearest_outline(d, frame(spark, layer), 8.0, "pt", "id")
    assert broadcasts(near) == 1  # the crowded cells
    got = {(r.pt, r.id): r.dist for r in near.collect()}
    want = {(p, 0): math.hypot(max(-3.0 - x, 0), y - 1.0) for p, x, y in pts[:90]} | {(90, 9): 1.0}
    assert got == pytest.approx(want)


def test_lead_over_all_matches_window(spark):
    d = spark.range(0, 500).select(((F.col("id") * 7919) % 1009).alias("k"), F.col("id").alias("v"))
    want = d.select("k", F.lead("v").over(W.orderBy("k")).alias("n")).collect()
    got = A.lead_over_all(d, ["k"], ["v"], partitions=7).select("k", F.col("next.v").alias("n")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want), key=lambda r: r[0])


def test_best_per_key_keeps_ties(spark):
    d = spark.createDataFrame([(1, "a", 2.0), (1, "b", 2.0), (1, "c", 3.0), (2, "d", 1.0)], "g int, n string, v double")
    assert sorted(r.n for r in A.best_per_key(d, ["g"], "v").collect()) == ["a", "b", "d"]
    one = A.one_per_key(d, ["g"], [F.col("v"), F.col("n")])
    assert sorted((r.g, r.n) for r in one.collect()) == [(1, "a"), (2, "d")]


def test_delete_keeps_unknown(spark):
    d = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, s string")
    assert sorted(r.id for r in A.delete_where(d, F.col("s") == "x").collect()) == [2, 3]


def test_remap_reports_losses(spark):
    d = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "pid string, v int")
    link = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "B2")], "old string, new string")
    with pytest.raises(Exception, match="two new keys for b"):
        A.remap_key(d, link, "pid", "old", "new").collect()
    said_twice = link.where("new <> 'B2'").union(link.where("old = 'a'"))
    assert sorted(tuple(r) for r in A.remap_key(d, said_twice, "pid", "old", "new").collect()) == [("A", 1), ("B", 2)]
    assert [r.pid for r in A.unmapped(d, link, "pid", "old").collect()] == ["z"]
    assert [r.old for r in A.ambiguous(link, "old", "new").collect()] == ["b"]


EDGE = "x1 double, y1 double, x2 double, y2 double"


def test_chains_stop_at_junctions_and_close_loops(spark):
    # a T of three arms of length 5, a loop of six edges, a single edge
    arms = [(float(i), 0.0, i + 1.0, 0.0) for i in range(5)] + [(-float(i), 0.0, -i - 1.0, 0.0) for i in range(5)]
    arms += [(0.0, i + 1.0, 0.0, float(i)) for i in range(5)]
    ring = [(20, 0), (21, 0), (22, 0), (22, 1), (21, 1), (20, 1)]
    loop = [(*map(float, ring[i]), *map(float, ring[(i + 1) % 6])) for i in range(6)]
    d = spark.createDataFrame(arms + loop + [(50.0, 0.0, 51.0, 1.0)], EDGE)
    paths = [[(p.x, p.y) for p in r.path] for r in merge_lines(d).collect()]
    assert sorted(len(p) for p in paths) == [2, 6, 6, 6, 7]
    closed = next(p for p in paths if len(p) == 7)
    assert closed[0] == closed[-1] and set(closed) == {(float(a), float(b)) for a, b in ring}
    assert all(math.dist(p[i], p[i + 1]) <= 1.5 for p in paths for i in range(len(p) - 1))


def test_chains_keep_keys_apart(spark):
    rows = [(k, float(i), 0.0, i + 1.0, 0.0) for k in (1, 2) for i in range(9)]
    lines = chain_lines(label_chains(spark.createDataFrame(rows, f"k int, {EDGE}"), ["k"]), ["k"])
    assert sorted((r.k, len(r.path)) for r in lines.collect()) == [(1, 10), (2, 10)]


def test_noding_cuts_at_foreign_vertices(spark):
    d = spark.createDataFrame(
        [("a", 0.0, 0.0, 4.0, 0.0), ("b", 0.0, 0.0, 1.0, 0.0), ("b", 1.0, 0.0, 4.0, 0.0), ("c", 2.0, 1e-9, 2.0, 5.0)], f"id string, {EDGE}"
    )
    exact = node_edges(d, 1.0, ["id"])
    assert sorted((r.id, r.x1, r.x2) for r in exact.where("y2 = 0").collect()) == [
        ("a", 0.0, 1.0), ("a", 1.0, 4.0), ("b", 0.0, 1.0), ("b", 1.0, 4.0)]
    near = node_edges(d, 1.0, ["id"], tolerance=1e-6).where("id = 'a'").orderBy("x1").collect()
    assert [(r.x1, r.x2) for r in near] == [(0.0, 1.0), (1.0, 2.0), (2.0, 4.0)]


def test_no_direction_no_line(spark):
    d = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 1.0)], "ax double, ay double, bx double, by double")
    a, b = N.xy("ax", "ay"), N.xy("bx", "by")
    got = d.select(N.azimuth(a, b).alias("z"), N.overshoot(a, b).alias("l")).collect()
    assert got[0].z is None and got[0].l is None
    assert got[1].z == 0.0 and got[1].l[0].y == pytest.approx(-1e-5) and got[1].l[1].y == pytest.approx(1 + 1e-5)


def test_partners_beyond_any_radius_are_found(spark, shapes):
    layer = shapes([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")])
    points = spark.createDataFrame([(1, 2.0, 0.5), (2, 5_000_000.0, 0.5), (3, None, 0.5)], "pt int, x double, y double")
    near = nearest_outline(points, layer, 1.0, "pt", "id")
    assert sorted((r.pt, r.dist) for r in near.collect()) == [(1, 1.0), (2, 4_999_999.0)]
    assert nearest_outline(points, layer.limit(0), 1.0, "pt", "id").count() == 0


def test_multi_is_bytes_only(spark, shapes):
    d = shapes([(1, "POINT (1 2)"), (2, "LINESTRING (0 0, 1 1)"), (3, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (4, "MULTIPOINT ((1 1))"), (5, None)])
    got = d.select("id", G.kind(G.multi("geom")).alias("k"), G.num_parts(G.multi("geom")).alias("n")).orderBy("id").collect()
    assert [r.k for r in got] == ["MultiPoint", "MultiLineString", "MultiPolygon", "MultiPoint", None] and [r.n for r in got][:4] == [1] * 4


def inside(a, b):
    return a[1] <= b[1] and b[3] <= a[3] and a[2] <= b[2] and b[4] <= a[4]


@pytest.mark.parametrize("refine", [None, 5])
def test_inner_areas_meet_in_one_cell_and_geometry_comes_back_by_id(spark, refine):
    """areas in others are spread to one cell, the outer ones without their geometry; the pairs are those of brute force."""
    outer = [*boxes(60, 5, big=0.6), (60, -40.0, -40.0, 41.0, 41.0), (61, 0.0, 0.0, 2.0, 2.0), (62, None, None, None, None)]
    inner = [*boxes(150, 6, big=0.0), (150, 0.0, 0.0, 2.0, 2.0), (151, 0.5, 2.0, 1.0, 2.5), (152, 0.0, 0.0, 1.0, 2.0), (153, None, None, None, None)]
    want = {(a[0], b[0]) for a in outer for b in inner if None not in (*a, *b) and inside(a, b)}
    assert len(want) > 150
    a, b = frame(spark, outer), frame(spark, inner, "2")
    got = spatial_join(a, b, G.contains, 2.0, refine_above=refine, inside="right", left_id="id")
    assert got.columns == ["id", "geom", "id2", "geom2"]
    rows = [tuple(r) for r in got.select("id", "id2").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    swapped = spatial_join(frame(spark, inner), frame(spark, outer, "2"), G.within, 2.0, refine_above=refine, inside="left")
    assert sorted((r.id2, r.id) for r in swapped.collect()) == sorted(want)
    placed = corner_cell(with_bounds(a), 2.0).collect()
    assert sorted(r.id for r in placed) == [*range(62)]
    with pytest.raises(ValueError):
        spatial_join(a, b, G.within, 2.0, inside="left", expand=1.0)


def test_rows_spread_by_id_give_the_same_pairs(spark):
    """left rows that lose their geometry on the way keep their keys, conditions and growth."""
    left, right = boxes(80, 7), boxes(80, 8)
    a = frame(spark, left).withColumn("g", F.col("id") % 2)
    b = frame(spark, right, "2").withColumns({"g": F.col("id2") % 2, "w": F.col("id2") + 1})
    options = dict(cell=2.0, on=["g"], where=F.col("id") < F.col("id2"), expand=0.25)
    near = lambda x, y: G.within_distance(x, y, 0.25)
    rows = lambda d: sorted(tuple(r) for r in d.select("id", "g", "id2", "w", G.area("geom"), G.area("geom2")).collect())
    plain = rows(spatial_join(a, b, near, **options))
    assert plain and rows(spatial_join(a, b, near, left_id="id", **options)) == plain
    assert rows(spatial_join(a, b, near, left_id="id", small="left", **options)) == plain
