"""Projections, filters, keyed joins, aggregates, windows, sorting, set operations, table updates, scalars."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import geodesy
from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.functions.keys import KeyRanges, release
from coverlay.operators import attributes as A
from coverlay.operators.adjacency import canonical_edges
from coverlay.operators.dissolve import collect, dissolve_parts, outline_edges, outline_measures
from coverlay.operators.grid import spatial_filter, spatial_join
from coverlay.operators.halfedges import faces
from coverlay.operators.lines import make_lines
from coverlay.plans import display
from coverlay.sources.writers import box_arrays, clustered
from workload import layers as L
from workload.registry import query, table

# ---- projections and filters ----


@query("fil1", f"WITH {L.LOC} SELECT k, locality_pid, state AS loc_state, 'SPLIT' AS match_type FROM loc")
def fil1(spark, sf):
    d = L.localities_nested(spark, sf)
    return d.select("k", "locality_pid", F.col("state").alias("loc_state"), F.lit("SPLIT").alias("match_type"))


@query("fil2", f"WITH {L.LOC} SELECT k, postcode FROM loc WHERE postcode IS NOT NULL AND postcode NOT IN ('NA', '9999')")
def fil2(spark, sf):
    return L.localities_nested(spark, sf).where(display.coded(L.CFG)).select("k", "postcode")


@query("fil3", f"WITH {L.LOC} SELECT k, postcode FROM loc WHERE postcode IS NULL OR postcode IN ('NA', '9999')")
def fil3(spark, sf):
    return L.localities_nested(spark, sf).where(display.uncoded(L.CFG)).select("k", "postcode")


def _mixed(spark, sf):
    """Points, lines, polygons and multipolygons in one column."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("double").alias("x"))
    b = lambda d: N.box_ring(F.col("x") + d, 0.0, F.col("x") + d + 1.0, 1.0)
    geom = (
        F.when(F.col("k") % 4 == 0, G.encode(F.array(F.array(b(0.0)))))
        .when(F.col("k") % 4 == 1, G.point("x", F.lit(1.0)))
        .when(F.col("k") % 4 == 2, G.line(F.array(N.xy("x", F.lit(0.0)), N.xy("x", F.lit(2.0)))))
        .otherwise(G.encode(F.array(F.array(b(0.0)), F.array(b(4.0)))))
    )
    return c.select("k", geom.alias("geom"))


@query("fil4", "SELECT c_custkey AS k, 'Polygon' AS kind FROM customer WHERE c_custkey % 4 = 0")
def fil4(spark, sf):
    d = _mixed(spark, sf).withColumn("kind", G.kind("geom"))
    return A.delete_where(d, F.col("kind") != "Polygon").select("k", "kind")


def dirty(spark, sf):
    """Boxes, with a bow-tie in every seventh row and an empty polygon in every fifth of the rest."""
    d = L.localities(spark, sf)
    x, y = F.col("x0"), F.col("y0")
    tie = F.array(N.xy(x, y), N.xy(x + 2.0, y + 2.0), N.xy(x + 2.0, y), N.xy(x, y + 2.0), N.xy(x, y))
    none = F.array().cast("array<array<array<struct<x:double,y:double>>>>")
    geom = F.when(F.col("k") % 7 == 0, G.encode(F.array(F.array(tie)))).when(
        F.col("k") % 5 == 0, G.encode(none)).otherwise(F.col("geom"))
    return d.withColumn("geom", geom)


@query("fil5", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 7 = 0")
def fil5(spark, sf):
    return dirty(spark, sf).where(~G.is_valid("geom")).select("k")


@query("fil6", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0")
def fil6(spark, sf):
    return dirty(spark, sf).where(G.is_empty("geom")).select("k")


def _lonlat_nested(spark, sf):
    d = L.lonlat(spark, sf)
    ring = N.box_ring("lon", "lat", F.col("lon") + F.col("side"), F.col("lat") + F.col("side"))
    return d.withColumn("nested", F.array(F.array(ring)))


def lonlat_boxes(spark, sf):
    return _lonlat_nested(spark, sf).withColumn("geom", G.encode("nested"))


@query("fil7", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0")
def fil7(spark, sf):
    d = _lonlat_nested(spark, sf).withColumn("a", N.area(geodesy.albers_nested("nested")))
    return d.where(F.col("a") >= 1.0).select("k")


@query("fil8", f"WITH {L.LOC} SELECT k FROM loc WHERE state <> 'ASIA' AND locality_pid <> 'loc0000000007'")
def fil8(spark, sf):
    exceptions = ["loc0000000007"]
    d = L.localities_nested(spark, sf)
    return d.where((F.col("state") != "ASIA") & ~F.col("locality_pid").isin(*exceptions)).select("k")


@query("fil9", f"""WITH {L.LONLAT} SELECT k, lon::DECIMAL(8,5)::DOUBLE AS longitude FROM ll
WHERE lat::DECIMAL(7,5) = -30.46875 OR lon::DECIMAL(8,5) = 130.25000""")
def fil9(spark, sf):
    d = L.lonlat(spark, sf).select("k", F.col("lon").cast("decimal(8,5)").alias("longitude"), F.col("lat").cast("decimal(7,5)").alias("latitude"))
    hit = (F.col("latitude") == F.lit("-30.46875").cast("decimal(7,5)")) | (F.col("longitude") == F.lit("130.25").cast("decimal(8,5)"))
    return d.where(hit).select("k", F.col("longitude").cast("double").alias("longitude"))


@query("fil10", f"WITH {L.LOC} SELECT k, (s % 10)::INT AS seq, CASE WHEN s > 10 THEN 2 ELSE 1 END AS ring FROM loc, (SELECT unnest([2, 3, 4, 12, 13, 14]) AS s) WHERE s < 10 OR holed")
def fil10(spark, sf):
    v = N.to_vertices(L.localities_nested(spark, sf), "nested", ["k"])
    v = v.withColumn("last", F.max("seq").over(W.partitionBy("k", "part", "ring")))
    return v.where((F.col("seq") > 1) & (F.col("seq") < F.col("last"))).select("k", "seq", "ring")


@query("fil11", f"WITH {L.LOC} SELECT k FROM loc WHERE left(state, 3) = 'AME'")
def fil11(spark, sf):
    return L.localities_nested(spark, sf).where(F.col("state").startswith("AME")).select("k")


# ---- keyed joins ----


@query("joi2", f"""WITH {L.LOC}{L.STATES} SELECT l.state AS loc_state, s.state AS ste_state, count(*) AS n
FROM loc l JOIN st s ON l.b = s.b AND l.x0 <= s.sx1 AND l.x1 >= s.sx0 AND l.y0 <= s.sy1 AND l.y1 >= s.sy0
 AND NOT (l.x0 > s.sx0 AND l.x1 < s.sx1 AND l.y0 > s.sy0 AND l.y1 < s.sy1) GROUP BY 1, 2""")
def joi2(spark, sf):
    states = L.state_boxes(spark, sf)
    lines = states.select("state_gid", G.boundary("geom").alias("line"))
    hits = spatial_join(L.localities(spark, sf).select(F.col("state").alias("loc_state"), "geom"), lines, G.intersects, 16.0, right_geom="line")
    named = hits.join(states.select("state_gid", F.col("state").alias("ste_state")), "state_gid")
    return named.groupBy("loc_state", "ste_state").agg(F.count(F.lit(1)).alias("n"))


@query("joi12", "WITH m AS (SELECT o_custkey, min(o_totalprice) AS p FROM orders GROUP BY 1) SELECT o.o_custkey, o.o_orderkey, o.o_totalprice FROM orders o JOIN m ON o.o_custkey = m.o_custkey AND o.o_totalprice = m.p")
def joi12(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return A.best_per_key(o, ["o_custkey"], "o_totalprice").select("o_custkey", "o_orderkey", "o_totalprice")


@query("joi13", "SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' WHERE o_orderkey IS NULL")
def joi13(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("joi14", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def joi14(spark, sf):
    used = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return A.delete_matching(table(spark, sf, "orders").select("o_orderkey"), used, ["o_orderkey"])


@query("joi15", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def joi15(spark, sf):
    used = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(used, "o_orderkey", "left_semi")


@query("joi16", "SELECT c_custkey, c_name, n, top FROM customer JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def joi16(spark, sf):
    g = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    return table(spark, sf, "customer").select("c_custkey", "c_name").join(g, "c_custkey")


@query("joi17", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def joi17(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return o.join(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey").drop("c_custkey")


@query("joi18", "SELECT o_orderkey, 'loc' || c_custkey AS locality_pid FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 <> 0")
def joi18(spark, sf):
    """Re-key rows through a linkage table; unlinked rows are dropped and doubly linked keys would be an error."""
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("old"), "o_custkey").alias("locality_pid"))
    link = table(spark, sf, "customer").where(F.col("c_custkey") % 10 != 0).select(
        F.concat(F.lit("old"), "c_custkey").alias("old_pid"), F.concat(F.lit("loc"), "c_custkey").alias("new_pid"))
    return A.remap_key(o, link, "locality_pid", "old_pid", "new_pid")


_RELEASES = "SELECT c_custkey, c_custkey % 11 <> 0 AS in_old, c_custkey % 13 <> 0 AS in_new FROM customer"


@query("joi20", f"WITH r AS ({_RELEASES}) SELECT c_custkey AS k, CASE WHEN in_new THEN 'new' ELSE 'lost' END AS change FROM r WHERE in_old <> in_new")
def joi20(spark, sf):
    from coverlay.plans.qa import release_changes

    k = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return release_changes(k.where(F.col("k") % 11 != 0), k.where(F.col("k") % 13 != 0), "k")


# ---- aggregates ----

_PERIMETER = """, adj AS (
  SELECT a.owner, count(*) AS n FROM cells a JOIN cells b ON a.owner = b.owner
   AND ((b.cx = a.cx + 1 AND b.cy = a.cy) OR (b.cx = a.cx AND b.cy = a.cy + 1)) GROUP BY 1)
SELECT c.owner, c.n::DOUBLE AS area, (4 * c.n - 2 * coalesce(adj.n, 0))::DOUBLE AS perimeter
FROM (SELECT owner, count(*) AS n FROM cells GROUP BY 1) c LEFT JOIN adj ON adj.owner = c.owner"""

BRAND_CELLS = """cells AS (SELECT p_partkey AS cell_id, p_brand AS owner, (p_partkey % 32)::DOUBLE AS cx, (p_partkey // 32)::DOUBLE AS cy FROM part)"""


def _side(spark, sf):
    n = table(spark, sf, "orders").count()
    return (1.0, float(max(512, n // 512 + 1)))


@query("agg1", f"WITH {L.CELLS}{_PERIMETER}")
def agg1(spark, sf):
    """Dissolve a layer in which a few owners hold everything."""
    cells = L.cells_nested(spark, sf).select("owner", G.encode("nested").alias("geom"))
    d = dissolve_parts(cells, ["owner"], cell=32.0, extent=_side(spark, sf))
    return d.groupBy("owner").agg(F.sum(G.area("geom")).alias("area"), F.sum(G.length("geom")).alias("perimeter"))


@query("agg1_edges", f"WITH {L.CELLS}{_PERIMETER}")
def agg1_edges(spark, sf):
    """The same measures of an exact coverage from its edges alone: shared edges cancel."""
    seg = N.to_segments(L.cells_nested(spark, sf), "nested", ["owner"])
    return outline_measures(outline_edges(seg, ["owner"]), ["owner"])


@query("agg2", f"""WITH {L.LOC} SELECT postcode, state, round(sum((x1 - x0) * (y1 - y0)), 2) AS area FROM loc
WHERE postcode IS NOT NULL AND postcode <> 'NA' GROUP BY 1, 2""")
def agg2(spark, sf):
    d = display._filled(L.localities(spark, sf).where(display.coded(L.CFG)), ["postcode", "state"], L.CFG)
    return d.groupBy("postcode", "state").agg(F.round(F.sum(G.area("geom")), 2).alias("area"))


@query("agg4", "SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY 1 HAVING count(*) = 1")
def agg4(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") == 1)


@query("agg5", "SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1")
def agg5(spark, sf):
    d = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return d.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("agg6", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg6(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("agg7", "SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1")
def agg7(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))


@query("agg8", "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def agg8(spark, sf):
    return table(spark, sf, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


_BOX = """'{"id":"c' || k || '","l":' || lon::DECIMAL(7,4) || ',"b":' || lat::DECIMAL(6,4) || ',"r":' || (lon + side)::DECIMAL(7,4) || ',"t":' || (lat + side)::DECIMAL(6,4) || '}'"""


def _labelled(spark, sf):
    return lonlat_boxes(spark, sf).withColumn("locality_pid", F.concat(F.lit("c"), "k"))


@query("agg9", f"""WITH {L.LONLAT} SELECT k // 64 AS page, '[' || string_agg({_BOX}, ',' ORDER BY 'c' || k) || ']' AS boxes FROM ll GROUP BY 1""")
def agg9(spark, sf):
    return box_arrays(_labelled(spark, sf), F.floor(F.col("k") / 64))


@query("agg10", f"WITH {L.LOC} SELECT state, sum(CASE WHEN holed THEN 10 ELSE 5 END)::BIGINT AS points FROM loc GROUP BY 1")
def agg10(spark, sf):
    return L.localities(spark, sf).groupBy("state").agg(F.sum(G.num_points("geom")).alias("points"))


_STEPS = """, s AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM tr WINDOW w AS (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id))"""


@query("agg11", f"""WITH {L.TRACKS}{_STEPS} SELECT user_id, date_trunc('day', ts)::DATE::VARCHAR AS day, count(*)::INT AS n,
round(coalesce(sum(sqrt((x - px) * (x - px) + (y - py) * (y - py))), 0), 6) AS length FROM s GROUP BY 1, 2""")
def agg11(spark, sf):
    """One line per user and day: a line is one row, so its key has to bound its points."""
    d = L.tracks(spark, sf).withColumn("day", F.to_date("ts").cast("string"))
    lines = make_lines(d, ["user_id", "day"], ["ts", "event_id"])
    return lines.select("user_id", "day", F.size("path").alias("n"), F.round(N.ring_length("path"), 6).alias("length"))


@query("agg12", f"WITH {BRAND_CELLS} SELECT owner, cell_id // 512 AS block, count(*)::INT AS parts, count(*)::DOUBLE AS area FROM cells GROUP BY 1, 2")
def agg12(spark, sf):
    cells = L.brand_cells_nested(spark, sf).withColumns({"geom": G.encode("nested"), "block": F.floor(F.col("cell_id") / 512)})
    return collect(cells, ["owner", "block"]).select("owner", "block", G.num_parts("geom").alias("parts"), G.area("geom").alias("area"))


@query("agg13", f"WITH {L.TRACKS} SELECT x % 16 AS x, y % 8 AS y, count(*) AS cnt FROM tr GROUP BY 1, 2 HAVING count(*) > 1")
def agg13(spark, sf):
    p = L.tracks(spark, sf).select(N.xy(F.col("x") % 16, F.col("y") % 8).alias("p"))
    return p.groupBy("p").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1).select("p.x", "p.y", "cnt")


@query("agg14", f"WITH {BRAND_CELLS} SELECT floor(cx / 8) AS tx, floor(cy / 8) AS ty, count(*) AS faces, count(*)::DOUBLE AS area FROM cells GROUP BY 1, 2")
def agg14(spark, sf):
    """Faces of noded line work, per tile of bounded size."""
    seg = N.to_segments(L.brand_cells_nested(spark, sf), "nested", ["cell_id"])
    k = F.col("cell_id")
    tiled = seg.select(F.floor(k % 32 / 8).cast("double").alias("tx"), F.floor(F.floor(k / 32) / 8).cast("double").alias("ty"),
                       F.least(N.xy("x1", "y1"), N.xy("x2", "y2")).alias("p"), F.greatest(N.xy("x1", "y1"), N.xy("x2", "y2")).alias("q"))
    g = tiled.distinct().groupBy("tx", "ty").agg(F.collect_list(G.line(F.array("p", "q"))).alias("lines"))
    faces = g.select("tx", "ty", F.explode(G.polygonize("lines")).alias("face"))
    return faces.groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("faces"), F.sum(G.area("face")).alias("area"))


@query("agg14_faces", f"WITH {BRAND_CELLS} SELECT cx::BIGINT AS cx, CASE WHEN cx % 2 = 0 THEN 1 ELSE count(*) END AS faces, count(*)::DOUBLE AS area FROM cells GROUP BY cx")
def agg14_faces(spark, sf):
    """Faces of one noded network, however far they reach: without the rungs of even columns, each of those is one face."""
    seg = N.to_segments(L.brand_cells_nested(spark, sf), "nested", ["cell_id"])
    used = canonical_edges(seg, []).groupBy("x1", "y1", "x2", "y2").agg(F.count(F.lit(1)).alias("uses"))
    found = faces(used.where("uses = 1 OR y1 <> y2 OR x1 % 2 = 1").drop("uses"))
    left = F.floor(N.bounds("nested")["xmin"]).alias("cx")
    return found.select(left, N.area("nested").alias("area")).groupBy("cx").agg(F.count(F.lit(1)).alias("faces"), F.sum("area").alias("area"))


@query("agg15", f"""WITH {BRAND_CELLS}, adj AS (
  SELECT a.owner, a.cell_id // 512 AS block, count(*) AS n FROM cells a JOIN cells b ON a.owner = b.owner AND a.cell_id // 512 = b.cell_id // 512
   AND ((b.cx = a.cx + 1 AND b.cy = a.cy) OR (b.cx = a.cx AND b.cy = a.cy + 1)) GROUP BY 1, 2)
SELECT c.owner, c.block, (4 * c.n - coalesce(adj.n, 0))::DOUBLE AS length FROM (SELECT owner, cell_id // 512 AS block, count(*) AS n FROM cells GROUP BY 1, 2) c
LEFT JOIN adj ON adj.owner = c.owner AND adj.block = c.block""")
def agg15(spark, sf):
    cells = L.brand_cells_nested(spark, sf).withColumn("block", F.floor(F.col("cell_id") / 512))
    lines = N.to_segments(cells, "nested", ["owner", "block"]).withColumn("line", G.line(F.array(N.xy("x1", "y1"), N.xy("x2", "y2"))))
    return lines.groupBy("owner", "block").agg(G.union_agg("line").alias("geom")).select("owner", "block", G.length("geom").alias("length"))


# ---- windows and order ----

_VERT = "(SELECT k, holed, r.ring, s.seq FROM loc, (SELECT unnest([1, 2]) AS ring) r, (SELECT unnest([1, 2, 3, 4, 5]) AS seq) s WHERE r.ring = 1 OR holed)"


@query("win1", f"WITH {L.LOC} SELECT k, ring::INT AS ring, seq::INT AS seq, 5::INT AS max_seq FROM {_VERT}")
def win1(spark, sf):
    v = N.to_vertices(L.localities_nested(spark, sf), "nested", ["k"])
    return v.select("k", "ring", "seq", F.max("seq").over(W.partitionBy("k", "part", "ring")).alias("max_seq"))


@query("win2", f"WITH {L.LOC} SELECT k, ring::INT AS ring, seq::INT AS seq, ((ring - 1) * 5 + seq)::INT AS point_seq FROM {_VERT}")
def win2(spark, sf):
    v = N.to_vertices(L.localities_nested(spark, sf), "nested", ["k"])
    return v.select("k", "ring", "seq", F.row_number().over(W.partitionBy("k").orderBy("part", "ring", "seq")).alias("point_seq"))


@query("win3", f"WITH {L.LOC}, p AS (SELECT DISTINCT postcode FROM loc WHERE postcode IS NOT NULL) SELECT postcode, lead(postcode) OVER (ORDER BY postcode) AS next_postcode FROM p")
def win3(spark, sf):
    p = L.localities_nested(spark, sf).where(F.col("postcode").isNotNull()).select("postcode").distinct()
    return A.lead_over_all(p, ["postcode"], ["postcode"]).select("postcode", F.col("next.postcode").alias("next_postcode"))


@query("win4", f"""WITH {L.TRACKS}, s AS (SELECT *, lead(x) OVER (ORDER BY event_id) AS nx, lead(y) OVER (ORDER BY event_id) AS ny FROM tr)
SELECT event_id, round(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)), 6) AS length FROM s""")
def win4(spark, sf):
    p = L.tracks(spark, sf).select("event_id", N.xy("x", "y").alias("p"))
    led = A.lead_over_all(p, ["event_id"], ["p"]).withColumn("path", N.make_line("p", F.col("next.p")))
    return led.select("event_id", F.round(N.ring_length("path"), 6).alias("length"))


@query("srt1", f"WITH {L.LOC} SELECT k, state, locality_name, coalesce(postcode, '') AS postcode FROM loc ORDER BY loc.state, locality_name, loc.postcode NULLS LAST")
def srt1(spark, sf):
    order = [F.col(c).asc_nulls_last() for c in ("state", "locality_name", "postcode")]
    d = L.localities_nested(spark, sf).orderBy(*order)
    return d.select("k", "state", "locality_name", F.coalesce("postcode", F.lit("")).alias("postcode"))


@query("srt2", "WITH m AS (SELECT o_custkey, max(o_totalprice) AS p FROM orders GROUP BY 1) SELECT o.o_custkey, o.o_orderkey FROM orders o JOIN m ON o.o_custkey = m.o_custkey AND o.o_totalprice = m.p")
def srt2(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return A.best_per_key(o, ["o_custkey"], "o_totalprice", largest=True).select("o_custkey", "o_orderkey")


@query("srt3", f"""WITH {L.LOC}, c AS (SELECT k, floor((x0 + x1) / 2 / 16)::BIGINT + 8388608 AS ix, floor((y0 + y1) / 2 / 16)::BIGINT + 8388608 AS iy FROM loc)
SELECT k, list_sum(list_transform(range(24), lambda i: (((ix >> i) & 1) << (2 * i)) + (((iy >> i) & 1) << (2 * i + 1))))::BIGINT AS cell_key FROM c""")
def srt3(spark, sf):
    d = clustered(L.localities(spark, sf).select("k", "geom"), 16.0)
    return d.repartitionByRange("cell_key").sortWithinPartitions("cell_key").select("k", "cell_key")


# ---- set operations and table updates ----


@query("set1", "SELECT 1::INT AS line_num, event_id FROM events WHERE event_id % 100 < 81 UNION ALL SELECT 2::INT, event_id FROM events WHERE event_id % 100 >= 81")
def set1(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    a = e.where(F.col("event_id") % 100 < 81).select(F.lit(1).alias("line_num"), "event_id")
    return a.unionByName(e.where(F.col("event_id") % 100 >= 81).select(F.lit(2).alias("line_num"), "event_id"))


@query("set2", "SELECT c_custkey AS gid, c_name AS name FROM customer UNION ALL SELECT 900000000 + s_suppkey, NULL FROM supplier")
def set2(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("gid"), F.col("c_name").alias("name"))
    return A.append(c, table(spark, sf, "supplier").select((F.col("s_suppkey") + 900000000).alias("gid")))


@query("set3", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def set3(spark, sf):
    sold = table(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey").join(sold, "p_partkey", "left_anti")


@query("mut1", f"WITH {L.LOC} SELECT k FROM loc WHERE (postcode = 'NA') IS NOT TRUE")
def mut1(spark, sf):
    return A.delete_where(L.localities_nested(spark, sf), F.col("postcode") == "NA").select("k")


@query("mut2", f"WITH {L.LOC} SELECT k FROM loc WHERE NOT (j = 4 AND NOT (odd AND r = 0))")
def mut2(spark, sf):
    d = L.localities(spark, sf)
    shells = d.select(F.col("k").alias("k2"), G.fill_holes("geom").alias("geom2"))
    inner = spatial_filter(d.select("k", "geom"), shells, lambda a, b: G.contains(b, a), 16.0, "k", where=F.col("k") != F.col("k2"))
    return A.delete_matching(d, inner, ["k"]).select("k")


@query("mut3", "SELECT c_custkey AS k, CASE WHEN n <= 5 THEN 'FEW' ELSE 'OPEN' END AS match_type FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def mut3(spark, sf):
    d = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit("OPEN").alias("match_type"))
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= 5)
    return A.set_where_key(d, n, ["k"], "match_type", F.lit("FEW"), F.col("match_type") == "OPEN")


@query("mut7", f"WITH {L.LONLAT} SELECT k, round(side * side, 9) AS area, 5::INT AS points FROM ll")
def mut7(spark, sf):
    """Whole layer rebuilt in the other datum: it moves by metres and keeps its shape."""
    d = lonlat_boxes(spark, sf)
    moved = d.withColumn("geom", G.encode(geodesy.gda2020_nested(G.decode("geom"))))
    return moved.select("k", F.round(G.area("geom"), 9).alias("area"), G.num_points("geom").alias("points"))


# ---- scalars ----


@query("scl1", f"WITH {L.LOC} SELECT k, state || '-' || postcode AS label FROM loc")
def scl1(spark, sf):
    return L.localities_nested(spark, sf).select("k", F.concat("state", F.lit("-"), "postcode").alias("label"))


@query("scl2", f"WITH {L.LOC} SELECT k, coalesce(postcode, '') AS postcode FROM loc")
def scl2(spark, sf):
    return L.localities_nested(spark, sf).select("k", F.coalesce("postcode", F.lit("")).alias("postcode"))


@query("scl3", "SELECT c_custkey AS k, replace(replace(c_name, '#', '-'), 'Customer', 'Cust') AS name FROM customer")
def scl3(spark, sf):
    c = table(spark, sf, "customer")
    name = F.replace(F.replace("c_name", F.lit("#"), F.lit("-")), F.lit("Customer"), F.lit("Cust"))
    return c.select(F.col("c_custkey").alias("k"), name.alias("name"))


@query("scl4", "SELECT event_id, round(sin(value), 9) AS s, round(cos(value), 9) AS c FROM events")
def scl4(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(F.sin("value"), 9).alias("s"), F.round(F.cos("value"), 9).alias("c"))


@query("scl5", f"WITH {L.LONLAT} SELECT k, lon::DECIMAL(9,6)::DOUBLE AS longitude, lat::DECIMAL(8,6)::DOUBLE AS latitude FROM ll")
def scl5(spark, sf):
    return L.lonlat(spark, sf).select("k", F.col("lon").cast("decimal(9,6)").cast("double").alias("longitude"),
                                      F.col("lat").cast("decimal(8,6)").cast("double").alias("latitude"))


@query("scl6", "SELECT 900000000 + o_orderkey AS gid FROM orders")
def scl6(spark, sf):
    return table(spark, sf, "orders").select((F.lit(900000000) + F.col("o_orderkey")).alias("gid"))


@query("scl7", "SELECT event_id, user_id AS first FROM events")
def scl7(spark, sf):
    path = F.array("user_id", "event_id")
    return table(spark, sf, "events").select("event_id", F.element_at(path, 1).alias("first"))


@query("scl8", """SELECT c_custkey AS k, '{"id":"' || c_name || '","n":' || c_nationkey || '}' AS obj FROM customer""")
def scl8(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("k"), F.to_json(F.struct(F.col("c_name").alias("id"), F.col("c_nationkey").alias("n"))).alias("obj"))


@query("scl10", """SELECT o_orderkey, CASE WHEN month(o_orderdate) = 1 THEN (year(o_orderdate) - 1) || '11'
 WHEN month(o_orderdate) < 5 THEN year(o_orderdate) || '02' WHEN month(o_orderdate) < 8 THEN year(o_orderdate) || '05'
 WHEN month(o_orderdate) < 11 THEN year(o_orderdate) || '08' ELSE year(o_orderdate) || '11' END AS release FROM orders""")
def scl10(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", release("o_orderdate").alias("release"))


@query("scl11", """WITH m AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) AS span FROM orders)
SELECT o_orderkey, floor((o_orderkey - lo) / CASE WHEN span / 6.0 < 10 THEN 10 ELSE floor(span / 6.0) + 1 END)::INT AS chunk FROM orders, m""")
def scl11(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    low, high = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return o.select("o_orderkey", KeyRanges.plan(low, high, 6).bucket("o_orderkey").alias("chunk"))


@query("scl15", f"""WITH {L.LONLAT} SELECT k, lon::DECIMAL(7,4)::DOUBLE AS l, lat::DECIMAL(6,4)::DOUBLE AS b,
(lon + side)::DECIMAL(7,4)::DOUBLE AS r, (lat + side)::DECIMAL(6,4)::DOUBLE AS t FROM ll""")
def scl15(spark, sf):
    from coverlay.operators.grid import with_bounds

    d = with_bounds(lonlat_boxes(spark, sf).select("k", "geom"))
    e = lambda c, p, a: F.col(c).cast(f"decimal({p},4)").cast("double").alias(a)
    return d.select("k", e("xmin", 7, "l"), e("ymin", 6, "b"), e("xmax", 7, "r"), e("ymax", 6, "t"))
