"""Rules of the cleaning that the large example layer does not reach, on a few hand-made features."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.plans import CleanConfig, clean, gaps, qa, split
from coverlay.plans.clean import ready, shift_fix_points
from coverlay.sources import readers as R
from coverlay.sources import writers as Wr

CFG = CleanConfig(cell=8.0, border_width=0.5, min_gap_area=None, sliver_exceptions=("X",), always_keep=("K",), drop_at=(100.5, 0.5))


def poly(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


@pytest.fixture(scope="module")
def pieces(shapes):
    rows = [
        (1, "A", "S", "SPLIT", poly(0, 0, 1, 1)), (2, "B", "S", "SPLIT", poly(2, 0, 3, 1)), (3, "K", "S", "SPLIT", poly(4, 0, 5, 1)),
        (4, "C", "S", "CENTROID", poly(100, 0, 101, 1)), (5, "D", "S", "GOOD", poly(6, 0, 7, 1)),
    ]
    d = shapes(rows, "id int, locality_pid string, loc_state string, match_type string, wkt string")
    return d.withColumn("piece_id", F.col("id").cast("bigint")).drop("id")


def test_fix_points(spark, pieces):
    points = spark.createDataFrame([(0.5, 0.5), (0.6, 0.5), (2.0, 0.5), (6.5, 0.5)], "x double, y double")
    got = {r.locality_pid: r.match_type for r in split.apply_fix_points(pieces, points, CFG).collect()}
    # a point on an outline is not inside; only open pieces change; the listed id stays; the listed place goes
    assert got == {"A": "MANUAL", "B": "SPLIT", "K": "MANUAL", "C": "SPLIT", "D": "GOOD"}


def test_slivers_go_to_the_longest_border(spark, shapes):
    rows = [
        (1, "A", "S", "BORDER SLIVER", poly(0, 0, 1, 10)), (2, "B", "S", "GOOD", poly(1, 0, 2, 6)), (3, "C", "S", "GOOD", poly(1, 6, 2, 10)),
        (4, "D", "T", "GOOD", poly(-1, 0, 0, 10)), (5, "E", "S", "BORDER SLIVER", poly(50, 0, 51, 2)), (6, "G", "S", "GOOD", poly(51, 1, 52, 2)),
        (7, "F", "S", "GOOD", poly(51, 0, 52, 1)),
    ]
    d = shapes(rows, "id int, locality_pid string, loc_state string, match_type string, wkt string").withColumn("piece_id", F.col("id").cast("bigint"))
    got = {r.piece_id: r.locality_pid for r in split.reassign_slivers(d, CFG).collect()}
    assert got == {1: "B", 2: "B", 3: "C", 4: "D", 5: "F", 6: "G", 7: "F"}


def test_zones_that_are_all_gap(shapes):
    zones = shapes([(1, "S", poly(0, 0, 1, 1)), (2, "S", poly(1, 0, 2, 1)), (3, "S", poly(5, 0, 6, 1)), (4, "S", poly(0, 1, 1, 2))],
                   "zone_id long, state string, wkt string")
    land = shapes([("S", poly(0, 0, 0.5, 1)), ("S", poly(0, 1, 1, 2))], "loc_state string, wkt string")
    found = gaps.border_gaps(zones, land, CFG)
    area = {r.zone_id: r.a for r in found.select("zone_id", G.area("geom").alias("a")).collect()}
    assert area == {1: 0.5, 2: 1.0, 4: 1.0}
    strict = gaps.border_gaps(zones, land, dataclasses.replace(CFG, add_covered_zones=False))
    assert {r.zone_id for r in strict.collect()} == {1, 2}


def test_small_gaps_are_dropped(shapes):
    side = 0.000005
    d = shapes([(1, "S", poly(140.0, -30.0, 140.0 + side, -30.0 + side)), (2, "S", poly(140.0, -30.0, 140.001, -29.999))], "hole_id long, state string, wkt string")
    assert [r.hole_id for r in gaps.large_enough(d, CleanConfig()).collect()] == [2]


def test_overlap_contact_needs_shared_area(shapes):
    hole = shapes([(1, "S", poly(0, 0, 1, 4))], "hole_id long, state string, wkt string")
    land = shapes([("A", "S", poly(1, 0, 2, 2)), ("B", "S", poly(1, 2, 2, 4))], "locality_pid string, loc_state string, wkt string")
    assert gaps.split_points(hole, land, dataclasses.replace(CFG, contact="overlap")).count() == 0
    p = gaps.split_points(hole, land, CFG).collect()
    assert [(r.x, r.y) for r in p] == [(1.0, 2.0)]


@pytest.mark.parametrize("hot_cell", [None, 2])
def test_whole_run(spark, shapes, hot_cell):
    """Two states; a gap on the border shared by two localities, an overshoot, a fix point, a lost locality."""
    areas = shapes([("S", poly(0, 0, 10, 10)), ("T", poly(10, 0, 20, 10))], "state string, wkt string")
    rows = [
        ("s1", "S", "1000", poly(0, 0, 9.875, 5)), ("s2", "S", "1000", poly(0, 5, 9.875, 10)), ("t1", "T", "2000", poly(9.875, 0, 20, 10)),
        ("sea", "T", None, poly(30, 30, 31, 31)), ("bay", "S", "9999", poly(-5, 4, 0, 6)),
    ]
    bdys = shapes(rows, "locality_pid string, state string, postcode string, wkt string").select(
        "locality_pid", F.upper("locality_pid").alias("locality_name"), "postcode", "state", F.lit("G").alias("locality_class"),
        F.lit(1).alias("address_count"), F.lit(1).alias("street_count"), "geom")
    cfg = dataclasses.replace(CFG, hot_cell=hot_cell)
    out = clean(bdys, areas, spark.createDataFrame([(1.0, 1.0)], "x double, y double"), cfg)
    got = {r.locality_pid: r.a for r in out["display"].select("locality_pid", F.round(G.area("geom"), 4).alias("a")).collect()}
    # "sea" never met a state outline and is kept whole; "bay" only touches the coast from outside and is kept too
    assert got["s1"] == 50.0 and got["s2"] == 50.0 and got["t1"] == 100.0
    assert {r.locality_pid for r in out["dropped"].collect()} == {r.locality_pid for r in bdys.collect()} - set(got)
    codes = {(r.postcode, r.a) for r in out["postcodes"].select("postcode", F.round(G.area("geom"), 2).alias("a")).collect()}
    assert {("1000", 100.0), ("2000", 100.0)} <= codes
    assert out["invalid"].count() == 0 and out["empty"].count() == 0
    qa.check_contract(out["display"], ["locality_pid"], ["locality_name", "state", "geom"], {"MultiPolygon"})


def test_inputs_are_made_ready(spark, shapes):
    """One SRID decides whether fix points move; fixed-width codes lose their padding."""
    bdys = spark.createDataFrame([("a", "12  ", 7844), ("b", None, 7844)], "locality_pid string, postcode string, srid int")
    points = shapes([(1, "POINT (140 -30)")])
    same, moved = ready(bdys, points)
    assert same.columns == ["locality_pid", "postcode"] and sorted(str(r.postcode) for r in same.collect()) == ["12", "None"]
    at = moved.first()
    assert at.x != 140.0 and abs(at.x - 140.0) < 1e-3
    old, there = ready(bdys.withColumn("srid", F.lit(4283)), points)
    assert there.first().x == 140.0
    with pytest.raises(ValueError):
        ready(bdys.drop("srid"), points)


def test_contract_failures(shapes):
    d = shapes([(1, "POINT (1 1)"), (1, None)])
    with pytest.raises(qa.ContractError) as e:
        qa.check_contract(d, ["id"], ["geom"], {"Polygon"})
    assert all(w in str(e.value) for w in ("null geom", "geometry kind", "duplicate keys"))


def test_duplicate_vertices_by_part_or_mixed(shapes):
    d = shapes([("p", "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((2 0, 4 0, 4 2, 2 2, 2 0)))")], "locality_pid string, wkt string")
    assert qa.duplicate_vertices(d).count() == 0
    assert {(r.longitude, r.latitude) for r in qa.duplicate_vertices(d, by_part=False).collect()} == {(2, 2)}


def test_fix_point_forms(spark):
    rows = [(1, "a", 1, 1, None, None, "0101000020BB1000000000000000000840000000000000F0BF"), (2, "b", 1, 1, 5.5, -6.25, None)]
    d = R.fix_point_geometry(spark.createDataFrame(rows, R.FIX_POINTS))
    got = d.orderBy("gid").select(G.as_text("geom").alias("t"), "srid").collect()
    assert [tuple(r) for r in got] == [("POINT (3 -1)", 4283), ("POINT (5.5 -6.25)", None)]
    moved = shift_fix_points(d, 7844).orderBy("gid").collect()
    assert moved[0].x != 3.0 and abs(moved[0].x - 3.0) < 1e-3


def test_srid_must_be_one_of_two(spark):
    d = spark.createDataFrame([(4283,), (4283,)], "srid int")
    assert R.detect_srid(d) == 4283
    for bad in ([(4283,), (7844,)], [(4326,)]):
        with pytest.raises(ValueError):
            R.detect_srid(spark.createDataFrame(bad, "srid int"))


def _document(path):
    import glob

    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_documents_are_valid_json(spark, shapes, tmp_path):
    rows = [(i, f"loc{i:02}", 'a "quoted" \\ name', None if i % 2 else "2000", poly(i, 0, i + 1, 1)) for i in range(30)]
    d = shapes(rows, "gid long, locality_pid string, locality_name string, postcode string, wkt string").withColumns(
        {"state": F.lit("S"), "locality_class": F.lit("G"), "address_count": F.lit(1), "street_count": F.lit(2)}).repartition(5)
    Wr.write_geojson_document(d, str(tmp_path / "doc"))
    doc = json.loads(_document(tmp_path / "doc"))
    assert doc["type"] == "FeatureCollection" and [f["properties"]["gid"] for f in doc["features"]] == list(range(30))
    assert doc["features"][3]["geometry"]["coordinates"][0][0][1] in ([4, 0], [3, 1])
    assert doc["features"][3]["properties"]["postcode"] == "" and doc["features"][0]["properties"]["locality_name"] == 'a "quoted" \\ name'
    Wr.write_boxes(d, str(tmp_path / "boxes"))
    assert [b["id"] for b in json.loads(_document(tmp_path / "boxes"))] == [f"loc{i:02}" for i in range(30)]


def test_box_read_is_pushed_down(spark, shapes, tmp_path):
    d = shapes([(i, poly(i, 0, i + 1, 1)) for i in range(50)])
    Wr.write_clustered(d, str(tmp_path / "c"), 4.0, partitions=3)
    box = R.read_box(spark, str(tmp_path / "c"), 10.5, 0.0, 12.5, 1.0)
    assert sorted(r.id for r in box.select("id").collect()) == [10, 11, 12]
    plan = box.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(xmin,12.5)" in plan and "geom" not in plan.split("ReadSchema")[1]
