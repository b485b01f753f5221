"""Spatial joins, overlay, the stages of the cleaning, and quality reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators import attributes as A
from coverlay.operators import points as P
from coverlay.operators.adjacency import neighbours_by_edge, touching
from coverlay.operators.dissolve import dissolve_exact
from coverlay.operators.grid import spatial_join
from coverlay.operators.lines import break_line
from coverlay.operators.spread import number_rows
from coverlay.plans import borders, display, gaps, qa, split
from coverlay.sources.writers import vertices
from workload import layers as L
from workload.registry import query, table
from workload.relational import dirty, lonlat_boxes
from workload.shapes import bumpy

_CLOSED = "{a}.x0 <= {b}.x1 AND {b}.x0 <= {a}.x1 AND {a}.y0 <= {b}.y1 AND {b}.y0 <= {a}.y1"
_OPEN = "{a}.x0 < {b}.x1 AND {b}.x0 < {a}.x1 AND {a}.y0 < {b}.y1 AND {b}.y0 < {a}.y1"
_AB = {"a": "a", "b": "b"}


def _second(df, *cols):
    """The same layer with its columns renamed for the right side of a join."""
    return df.select(*[F.col(c).alias(c + "2") for c in cols])


# ---- spatial joins ----


@query("joi1", f"""WITH {L.LOC}{L.STATES} SELECT l.k, s.state_gid FROM loc l JOIN st s ON l.b = s.b
 AND l.x0 <= s.sx1 AND l.x1 >= s.sx0 AND l.y0 <= s.sy1 AND l.y1 >= s.sy0
 AND NOT (l.x0 > s.sx0 AND l.x1 < s.sx1 AND l.y0 > s.sy0 AND l.y1 < s.sy1)""")
def joi1(spark, sf):
    loc = L.localities(spark, sf).select(F.col("k").alias("gid"), "geom")
    return split.border_pairs(loc, L.state_boxes(spark, sf), L.CFG).withColumnRenamed("gid", "k")


@query("joi3", f"""WITH {L.LOC}{L.ZONES} SELECT z.zone_id, l.k FROM zn z JOIN loc l ON z.b = l.b AND z.state = l.state
 AND l.x0 <= zx1 AND l.x1 >= zx0 AND l.y0 <= zy1 AND l.y1 >= zy0""")
def joi3(spark, sf):
    loc = L.localities(spark, sf).select("k", "state", F.col("geom").alias("geom2"))
    j = spatial_join(L.corridor_boxes(spark, sf), loc, G.intersects, 16.0, on=["state"], refine_above=2000)
    return j.select("zone_id", "k")


@query("joi4", f"WITH {L.LOC} SELECT a.k, b.k AS k2 FROM loc a JOIN loc b ON a.b = b.b AND a.state <> b.state AND {_CLOSED.format(**_AB)}")
def joi4(spark, sf):
    d = L.localities(spark, sf).select("k", "state", "geom")
    j = spatial_join(d, _second(d, "k", "state", "geom"), G.intersects, 16.0, where=F.col("state") != F.col("state2"))
    return j.select("k", "k2")


@query("joi5", f"""WITH {L.LOC} SELECT a.k, b.k AS k2 FROM loc a JOIN loc b ON a.b = b.b AND a.state = b.state AND a.k < b.k AND {_CLOSED.format(**_AB)}
 AND (NOT ({_OPEN.format(**_AB)}) OR (a.holed AND b.j = 4) OR (b.holed AND a.j = 4))""")
def joi5(spark, sf):
    d = L.localities(spark, sf).select("k", "state", "geom")
    other = d.select(F.col("k").alias("k2"), "state", F.col("geom").alias("geom2"))
    return touching(d, other, 16.0, on=["state"], where=F.col("k") < F.col("k2")).select("k", "k2")


@query("joi5_edges", f"""WITH {L.AREAS} SELECT a.k AS a, b.k AS b, 1::BIGINT AS edges, 16::DOUBLE AS shared_length FROM area a JOIN area b
 ON a.b = b.b AND a.k < b.k AND ((a.x1 = b.x0) OR (b.x1 = a.x0)) AND a.y1 - a.y0 = 16 AND b.y1 - b.y0 = 16""")
def joi5_edges(spark, sf):
    """Adjacency of an exact coverage from shared edges: one grouped pass, no geometry predicate."""
    return neighbours_by_edge(N.to_segments(L.areas_nested(spark, sf), "nested", ["k"]), "k")


_INNER = "a.x0 <= b.x0 AND a.x1 >= b.x1 AND a.y0 <= b.y0 AND a.y1 >= b.y1"


@query("joi6", f"WITH {L.LOC} SELECT a.k, b.k AS k2 FROM loc a JOIN loc b ON a.b = b.b AND a.postcode <> b.postcode AND {_INNER}")
def joi6(spark, sf):
    d = L.localities(spark, sf).select("k", "postcode", G.fill_holes("geom").alias("geom"))
    j = spatial_join(d, _second(d, "k", "postcode", "geom"), G.contains, 16.0, where=F.col("postcode") != F.col("postcode2"))
    return j.select("k", "k2")


@query("joi7", f"WITH {L.LOC} SELECT b.k, a.k AS k2 FROM loc a JOIN loc b ON a.b = b.b AND a.k <> b.k AND {_INNER}")
def joi7(spark, sf):
    d = L.localities(spark, sf).select("k", G.fill_holes("geom").alias("geom"))
    j = spatial_join(d, _second(d, "k", "geom"), G.within, 16.0, where=F.col("k") != F.col("k2"))
    return j.select("k", "k2")


_IN = "x > x0 AND x < x1 AND y > y0 AND y < y1 AND NOT (holed AND x > hx0 AND x < hx1 AND y > hy0 AND y < hy1)"


@query("joi8", f"WITH {L.POINTS}, {L.LOC} SELECT pt, k FROM pts JOIN loc USING (b) WHERE {_IN}")
def joi8(spark, sf):
    return P.points_in_keyed_areas(L.points(spark, sf), L.localities_nested(spark, sf), ["b"], "pt", "k", band=4.0).select("pt", "k")


@query("joi9", f"WITH {L.POINTS}, {L.LOC} SELECT DISTINCT k FROM (SELECT k FROM pts JOIN loc USING (b) WHERE {_IN} UNION ALL SELECT k FROM loc WHERE locality_pid = 'loc0000000007')")
def joi9(spark, sf):
    loc = L.localities(spark, sf).select("k", "locality_pid", "geom")
    near = P.points_in_areas(L.points(spark, sf).select("pt", "x", "y"), loc.drop("locality_pid"), 16.0).select("k")
    return near.unionByName(loc.where(F.col("locality_pid").isin("loc0000000007")).select("k")).distinct()


@query("joi10", f"WITH {L.LOC} SELECT k FROM loc WHERE x0 <= 8 AND x1 >= 8 AND y0 <= 8 AND y1 >= 8 AND NOT (holed AND hx0 < 8 AND hx1 > 8 AND hy0 < 8 AND hy1 > 8)")
def joi10(spark, sf):
    return P.areas_meeting_point(L.localities_nested(spark, sf), 8.0, 8.0, "k")


@query("joi11", f"""WITH {L.POINTS}, {L.BLOCKS}{L.ZONES}, n AS (
 SELECT pt, CASE WHEN x > zx0 AND x < zx1 THEN least(x - zx0, zx1 - x, y - zy0, zy1 - y) ELSE greatest(zx0 - x, x - zx1) END AS d
 FROM pts p JOIN zn z ON p.b = z.b AND z.r = floor((p.x - 96 * (p.b % 8)) / 16)) SELECT pt, round(min(d), 6) AS dist FROM n GROUP BY 1""")
def joi11(spark, sf):
    r = F.floor((F.col("x") - 96.0 * (F.col("b") % 8)) / 16)
    regions = table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("r"), F.col("r_name").alias("state"))
    pts = L.points(spark, sf).withColumn("r", r).join(regions, "r").select("pt", "state", "b", "x", "y")
    layer = L.corridor_boxes(spark, sf).withColumn("b", F.floor(F.col("zone_id") / 25))
    near = P.nearest_outline(pts, layer, 16.0, "pt", "zone_id", on=["state", "b"])
    return near.select("pt", F.round("dist", 6).alias("dist")).distinct()


@query("joi19", f"""WITH {L.LOC}{L.STATES} SELECT l.k, s.state_gid FROM loc l JOIN st s ON l.b = s.b
 WHERE ({L.overlap('sx0', 'sy0', 'sx1', 'sy1')} - CASE WHEN holed AND l.state = s.state AND sx1 - sx0 = 16 THEN 4 ELSE 0 END) / {L.LOC_AREA} > 0.5""")
def joi19(spark, sf):
    states = L.state_boxes(spark, sf).select("state_gid", F.col("geom").alias("geom2"))
    j = spatial_join(L.localities(spark, sf).select("k", "geom"), states, G.intersects, 16.0)
    ratio = G.area(G.intersection("geom", "geom2")) / G.area("geom")
    return j.where(ratio > 0.5).select("k", "state_gid")


@query("scl13", f"""WITH {L.LOC} SELECT a.k, b.k AS k2, TRUE AS meets, ({_INNER}) AND NOT (a.holed AND b.j = 4) AS holds,
 NOT ({_OPEN.format(**_AB)}) OR (a.holed AND b.j = 4) OR (b.holed AND a.j = 4) AS touches
 FROM loc a JOIN loc b ON a.b = b.b AND a.k <> b.k AND {_CLOSED.format(**_AB)}""")
def scl13(spark, sf):
    d = L.localities(spark, sf).select("k", "geom")
    j = spatial_join(d, _second(d, "k", "geom"), G.intersects, 16.0, where=F.col("k") != F.col("k2"))
    return j.select("k", "k2", G.intersects("geom", "geom2").alias("meets"), G.contains("geom", "geom2").alias("holds"),
                    G.touches("geom", "geom2").alias("touches"))


# ---- updates by place ----


@query("mut4", f"WITH {L.POINTS}, {L.LOC} SELECT k, CASE WHEN k IN (SELECT k FROM pts JOIN loc USING (b) WHERE {_IN}) THEN 'HIT' ELSE 'OPEN' END AS match_type FROM loc")
def mut4(spark, sf):
    loc = L.localities(spark, sf).select("k", "geom")
    hit = P.points_in_areas(L.points(spark, sf).select("pt", "x", "y"), loc, 16.0)
    d = loc.select("k", F.lit("OPEN").alias("match_type"))
    return A.set_where_key(d, hit, ["k"], "match_type", F.lit("HIT"), F.col("match_type") == "OPEN")


@query("mut5", f"""WITH {L.LOC}, t AS (SELECT a.k, b.locality_pid AS other,
  CASE WHEN (a.holed AND b.j = 4) OR (b.holed AND a.j = 4) THEN 8
       WHEN a.x1 = b.x0 OR b.x1 = a.x0 THEN least(a.y1, b.y1) - greatest(a.y0, b.y0)
       ELSE least(a.x1, b.x1) - greatest(a.x0, b.x0) END AS w
  FROM loc a JOIN loc b ON a.b = b.b AND a.state = b.state AND a.k <> b.k AND {_CLOSED.format(**_AB)}
  AND (NOT ({_OPEN.format(**_AB)}) OR (a.holed AND b.j = 4) OR (b.holed AND a.j = 4)))
SELECT l.k, coalesce(m.other, l.locality_pid) AS locality_pid FROM loc l LEFT JOIN
 (SELECT k, arg_min(other, (-w, other)) AS other FROM t GROUP BY 1) m ON m.k = l.k""")
def mut5(spark, sf):
    """Every locality takes the id of the neighbour with the longest common border; ties go to the smallest id."""
    d = L.localities(spark, sf).select("k", "locality_pid", "state", "geom")
    other = d.select(F.col("k").alias("k2"), F.col("locality_pid").alias("other"), "state", F.col("geom").alias("geom2"))
    t = touching(d, other, 16.0, on=["state"], where=F.col("k") != F.col("k2"))
    w = t.select("k", "other", F.round(G.frontage("geom", "geom2", 1e-7), 5).alias("w"))
    best = A.one_per_key(w, ["k"], [-F.col("w"), F.col("other")]).select("k", F.col("other").alias("locality_pid"))
    return A.set_from(d, best, ["k"], ["locality_pid"]).select("k", "locality_pid")


@query("mut6", f"WITH {L.LOC} SELECT k, ((x1 - x0) * (y1 - y0) - CASE WHEN holed THEN 4 ELSE 0 END)::DOUBLE AS area FROM loc WHERE j <> 4")
def mut6(spark, sf):
    d = L.localities(spark, sf)
    shells = d.where(F.col("j") != 4).select("k", "state", G.fill_holes("geom").alias("geom"))
    cut = display.cut_out(shells, "k", d.where(F.col("j") == 4).select("state", "geom"), L.CFG, on=["state"])
    return cut.select("k", G.area("geom").alias("area"))


# ---- overlay ----

_PI = f"{L.overlap('sx0', 'sy0', 'sx1', 'sy1')} - CASE WHEN holed AND l.state = s.state AND sx1 - sx0 = 16 THEN 4 ELSE 0 END"


@query("ovl1", f"WITH {L.LOC}{L.STATES} SELECT k, state_gid, ({_PI})::DOUBLE AS area FROM loc l JOIN st s ON l.b = s.b WHERE ({_PI}) > 0")
def ovl1(spark, sf):
    states = L.state_boxes(spark, sf).select("state_gid", F.col("geom").alias("geom2"))
    j = spatial_join(L.localities(spark, sf).select("k", "geom"), states, None, 16.0)
    p = G.once(j, "shared", G.polygonal_intersection("geom", "geom2")).where(F.col("shared").isNotNull())
    return p.select("k", "state_gid", G.area("shared").alias("area"))


@query("ovl2", f"""WITH {L.LOC}{L.STATES} SELECT l.k, l.state AS loc_state, s.state AS ste_state, ({_PI})::DOUBLE AS area FROM loc l JOIN st s ON l.b = s.b
 WHERE ({_PI}) > 0 AND NOT (l.x0 > s.sx0 AND l.x1 < s.sx1 AND l.y0 > s.sy0 AND l.y1 < s.sy1)""")
def ovl2(spark, sf):
    states = L.state_boxes(spark, sf)
    tiles = borders.tiles(states, ["state_gid", "state"], L.CFG)
    loc = L.localities(spark, sf).select(F.col("k").alias("gid"), "locality_pid", "state", "geom")
    s = split.split_by_states(loc, states, tiles, L.CFG)
    return s.select(F.col("gid").alias("k"), "loc_state", "ste_state", G.area("geom").alias("area"))


@query("ovl3", f"WITH {L.LOC}{L.STATES} SELECT l.k, ({L.LOC_AREA} - ({_PI}))::DOUBLE AS area FROM loc l JOIN st s ON l.b = s.b WHERE ({_PI}) > 0")
def ovl3(spark, sf):
    states = L.state_boxes(spark, sf).select("state_gid", F.col("geom").alias("geom2"))
    j = spatial_join(L.localities(spark, sf).select("k", "geom"), states, G.intersects, 16.0)
    j = j.where(~G.touches("geom", "geom2"))
    return j.select("k", G.area(G.difference("geom", "geom2")).alias("area"))


@query("ovl4", f"WITH {L.LOC} SELECT k, round((x1 - x0) * (y1 - y0) + (x1 - x0) + (y1 - y0) + 0.5 - CASE WHEN holed THEN 1 ELSE 0 END, 6)::DOUBLE AS area FROM loc")
def ovl4(spark, sf):
    d = L.localities(spark, sf)
    return d.select("k", F.round(G.area(G.buffer("geom", 0.5, 1)), 6).alias("area"))


@query("ovl5", f"WITH {L.LOC} SELECT k, CASE WHEN k % 3 = 0 THEN 0 ELSE round((x1 - x0) * (y1 - y0), 4) END::DOUBLE AS area FROM loc")
def ovl5(spark, sf):
    """Opening removes a spur thinner than twice the distance, and whole features of that kind."""
    d = L.localities(spark, sf)
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    spur = N.ring([(x0, y0), (x1, y0), (x1 + 1.0, y0), (x1 + 1.0, y0 + 1e-8), (x1, y0 + 1e-8), (x1, y1), (x0, y1)])
    thin = N.box_ring(x0, y0, x0 + 1e-8, y1)
    d = d.select("k", G.encode(F.array(F.array(F.when(F.col("k") % 3 == 0, thin).otherwise(spur)))).alias("geom"))
    return d.select("k", F.round(G.area(G.open_close("geom", -2e-8, 2e-8)), 4).alias("area"))


@query("ovl7", f"WITH {L.BLOCKS}{L.ZONES} SELECT zone_id, s.piece::INT AS piece, round(8.0::DOUBLE / (zone_id % 4 + 1), 9) AS area FROM zn, (SELECT unnest([1, 2, 3, 4]) AS piece) s WHERE s.piece <= zone_id % 4 + 1")
def ovl7(spark, sf):
    z = L.corridor_boxes(spark, sf).withColumn("_b", G.bounds("geom"))
    n = (F.col("zone_id") % 4).cast("int")
    step = F.lit(16.0) / (n + 1)
    at = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: G.line(F.array(
        N.xy(F.col("_b.xmin") - 1.0, F.col("_b.ymin") + step * i), N.xy(F.col("_b.xmax") + 1.0, F.col("_b.ymin") + step * i))))
    lines = z.where(n > 0).select("zone_id", F.explode(at).alias("line")).groupBy("zone_id").agg(G.union_agg("line").alias("blades"))
    pieces = z.join(lines, "zone_id", "left").select("zone_id", F.posexplode(G.split_polygon("geom", "blades")).alias("i", "piece"))
    return pieces.select("zone_id", (F.col("i") + 1).alias("piece"), F.round(G.area("piece"), 9).alias("area"))


@query("ovl16", f"WITH {L.LOC} SELECT k, ((x1 - x0) * (y1 - y0) - CASE WHEN holed AND b % 3 = 2 THEN 4 ELSE 0 END)::DOUBLE AS area FROM loc WHERE postcode IS NOT NULL AND postcode <> 'NA'")
def ovl16(spark, sf):
    """Polygons inside a polygon of another code are cut out of it."""
    d = L.localities(spark, sf).where(display.coded(L.CFG)).select("k", "j", "postcode", G.fill_holes("geom").alias("geom"))
    inner = d.select(F.col("postcode").alias("postcode2"), F.col("geom").alias("geom2"))
    islands = spatial_join(d.select("postcode", "geom"), inner, G.contains, 16.0, where=F.col("postcode") != F.col("postcode2"))
    masks = islands.select("postcode", F.col("geom2").alias("geom"))
    out = display.cut_out(d, "k", masks, L.CFG, on=["postcode"])
    return out.select("k", G.area("geom").alias("area"))


@query("agg3", f"""WITH {L.LOC}{L.ZONES} SELECT zone_id, (8 - sum({L.overlap('zx0', 'zy0', 'zx1', 'zy1')}))::DOUBLE AS area
FROM zn z JOIN loc l ON z.b = l.b AND z.state = l.state AND l.x0 <= zx1 AND l.x1 >= zx0 AND l.y0 <= zy1 AND l.y1 >= zy0 GROUP BY 1""")
def agg3(spark, sf):
    pieces = L.localities(spark, sf).select(F.col("state").alias("loc_state"), "geom")
    g = gaps.zone_gaps(L.corridor_boxes(spark, sf), pieces, L.CFG)
    return g.groupBy("zone_id").agg(F.sum(G.area("geom")).alias("area"))


# ---- stages of the cleaning ----


@query("cov1", f"WITH {L.AREAS} SELECT state, count(DISTINCT CASE WHEN x0 < lx_min THEN k ELSE -b - 1 END) AS parts, sum((x1 - x0) * (y1 - y0))::DOUBLE AS area FROM (SELECT *, 96 * (b % 8) + 16 * r AS lx_min FROM area) GROUP BY 1")
def cov1(spark, sf):
    d = borders.state_polygons(L.areas(spark, sf), L.CFG)
    return d.groupBy("state").agg(F.count(F.lit(1)).alias("parts"), F.sum(G.area("geom")).alias("area"))


@query("cov1_edges", f"WITH {L.AREAS} SELECT state, count(DISTINCT CASE WHEN x0 < lx_min THEN k ELSE -b - 1 END) AS parts, sum((x1 - x0) * (y1 - y0))::DOUBLE AS area FROM (SELECT *, 96 * (b % 8) + 16 * r AS lx_min FROM area) GROUP BY 1")
def cov1_edges(spark, sf):
    """The same state polygons from the edges of the areas alone; rings are linked, no polygon is united."""
    filled = L.areas_nested(spark, sf).withColumn("nested", N.exterior("nested"))
    d = dissolve_exact(filled, ["state"])
    return d.groupBy("state").agg(F.count(F.lit(1)).alias("parts"), F.sum(N.area("nested")).alias("area"))


def _measured(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(G.area("geom")), 4).alias("area"))


@query("cov2", f"WITH {L.BLOCKS}{L.ZONES} SELECT state, count(*) AS n, 8.0::DOUBLE * count(*) AS area FROM zn GROUP BY 1")
def cov2(spark, sf):
    states = L.state_boxes(spark, sf)
    tiles = borders.tiles(states, ["state_gid", "state"], L.CFG)
    return _measured(borders.corridors(states, tiles, L.CFG), "state")


@query("cov4", f"""WITH {L.LOC}, c AS (SELECT *, CASE WHEN j = 4 AND odd AND r = 0 THEN 'SINGLE' WHEN j = 4 THEN 'GOOD' WHEN j = 2 AND odd AND r = 3 THEN 'BORDER SLIVER' ELSE 'CENTROID' END AS match_type FROM loc)
SELECT state, match_type, count(*) AS n, round(sum(CASE WHEN match_type = 'SINGLE' THEN 12 WHEN match_type = 'BORDER SLIVER' THEN 2 WHEN j = 2 THEN 64 ELSE {L.LOC_AREA} END), 4)::DOUBLE AS area FROM c GROUP BY 1, 2""")
def cov4(spark, sf):
    p = L.stages(spark, sf)["pieces"].where(~F.col("match_type").isin("GOOD BORDER", "MESSY BORDER"))
    return _measured(p.withColumnRenamed("loc_state", "state"), "state", "match_type")


#: A locality kept by name, and a place whose piece is taken out again.
_KEPT, _DROP = "loc0000000002", (20.0, 4.0)


@query("cov4_points", f"""WITH {L.LOC}{L.STATES}, {L.POINTS}, pc AS (
  SELECT l.k, l.locality_pid, l.b, s.state_gid, s.state AS ste_state, ({_PI})::DOUBLE AS area, greatest(x0, sx0) AS px0, least(x1, sx1) AS px1,
         greatest(y0, sy0) AS py0, least(y1, sy1) AS py1, holed, hx0, hx1, hy0, hy1
  FROM loc l JOIN st s ON l.b = s.b WHERE ({_PI}) > 0 AND NOT (l.x0 > s.sx0 AND l.x1 < s.sx1 AND l.y0 > s.sy0 AND l.y1 < s.sy1)),
one AS (SELECT state_gid FROM pc GROUP BY 1 HAVING count(DISTINCT k) = 1),
hit AS (SELECT DISTINCT k, state_gid FROM pc JOIN pts ON pts.b = pc.b AND x > px0 AND x < px1 AND y > py0 AND y < py1
        WHERE NOT (holed AND x > hx0 AND x < hx1 AND y > hy0 AND y < hy1))
SELECT k, ste_state, area, CASE WHEN {_DROP[0]} BETWEEN px0 AND px1 AND {_DROP[1]} BETWEEN py0 AND py1 THEN 'SPLIT' WHEN one.state_gid IS NOT NULL THEN 'SINGLE'
       WHEN hit.k IS NOT NULL OR locality_pid = '{_KEPT}' THEN 'MANUAL' ELSE 'SPLIT' END AS match_type
FROM pc LEFT JOIN one USING (state_gid) LEFT JOIN hit USING (k, state_gid)""")
def cov4_points(spark, sf):
    """Pieces settled by hand: fix points (one per order) over pieces still open, a locality kept by name, one place dropped."""
    states = L.state_boxes(spark, sf)
    cfg = replace(L.CFG, always_keep=(_KEPT,), drop_at=_DROP)
    loc = L.localities(spark, sf).select(F.col("k").alias("gid"), "locality_pid", "state", "geom")
    pieces = split.split_by_states(loc, states, borders.tiles(states, ["state_gid", "state"], cfg), cfg)
    settled = split.apply_fix_points(split.mark_single(number_rows(pieces, "piece_id")), L.points(spark, sf), cfg)
    return settled.select(F.col("gid").alias("k"), "ste_state", G.area("geom").alias("area"), "match_type")


@query("cov5", f"WITH {L.LOC} SELECT o.locality_pid, 2::DOUBLE AS area FROM loc s JOIN loc o ON o.b = s.b AND o.r = 3 AND o.j = 0 WHERE s.odd AND s.r = 3 AND s.j = 2")
def cov5(spark, sf):
    p = L.stages(spark, sf)["pieces"].where(F.col("match_type") == split.SLIVER)
    return p.select("locality_pid", F.round(G.area("geom"), 4).alias("area"))


_GAPS = """SELECT state, sum(n)::BIGINT AS n, sum(n * a)::DOUBLE AS area FROM (
  SELECT state, CASE WHEN r > 0 THEN 1 ELSE 0 END AS n, 2.0 AS a FROM w WHERE j = 0
  UNION ALL SELECT state, CASE WHEN r < 4 THEN 1 ELSE 0 END, 0.125 FROM w WHERE j = 0) GROUP BY 1"""


@query("cov6", f"WITH {L.BLOCKS} {_GAPS}")
def cov6(spark, sf):
    pieces = L.localities(spark, sf).select(F.col("state").alias("loc_state"), "geom")
    return _measured(gaps.border_gaps(L.corridor_boxes(spark, sf), pieces, L.CFG), "state")


@query("cov7", f"WITH {L.BLOCKS} {_GAPS}")
def cov7(spark, sf):
    pieces = L.localities(spark, sf).select(F.col("state").alias("loc_state"), "geom")
    found = gaps.zone_gaps(L.corridor_boxes(spark, sf), pieces, L.CFG)
    return _measured(gaps.merged_gaps(found, L.CFG), "state")


@query("cov8", f"WITH {L.LOC} SELECT state, locality_pid, 0.125::DOUBLE AS gap_area FROM loc WHERE j = 3 AND r < 4")
def cov8(spark, sf):
    """Which border gaps touch exactly one locality, and which locality gets them?"""
    pieces = L.localities(spark, sf).select(F.col("state").alias("loc_state"), "locality_pid", "geom")
    found = gaps.merged_gaps(gaps.zone_gaps(L.corridor_boxes(spark, sf), pieces, L.CFG), L.CFG)
    good = found.join(gaps.single_neighbour(gaps.gap_localities(found, pieces, L.CFG)), "hole_id")
    return good.select("state", "locality_pid", F.round(G.area("geom"), 4).alias("gap_area"))


@query("cov9", f"WITH {L.BLOCKS} SELECT state, (lx + 0.125)::DOUBLE AS x, oy + 8 AS y FROM w WHERE j = 0 AND r > 0")
def cov9(spark, sf):
    pieces = L.localities(spark, sf).select(F.col("state").alias("loc_state"), "locality_pid", "geom")
    found = gaps.merged_gaps(gaps.zone_gaps(L.corridor_boxes(spark, sf), pieces, L.CFG), L.CFG)
    return gaps.split_points(found, pieces, L.CFG).select("state", "x", "y")


@query("cov10", f"WITH {L.BLOCKS} SELECT state, lx::DOUBLE AS x, oy + 8 AS y, 0.12502::DOUBLE AS length FROM w WHERE j = 0 AND r > 0")
def cov10(spark, sf):
    d = L.stages(spark, sf)["splitter_lines"].select("state", G.bounds("line").alias("b"), G.length("line").alias("l"))
    return d.select("state", F.round("b.xmin", 3).alias("x"), F.round("b.ymin", 3).alias("y"), F.round("l", 6).alias("length"))


@query("cov11", f"WITH {L.LOC} SELECT locality_pid, 1::DOUBLE AS area FROM loc WHERE j < 2 AND r > 0")
def cov11(spark, sf):
    p = L.stages(spark, sf)["pieces"].where(F.col("match_type") == split.MESSY_BORDER)
    return p.select("locality_pid", F.round(G.area("geom"), 4).alias("area"))


@query("cov12", f"WITH {L.FINAL} SELECT locality_pid, locality_name, postcode, state, final_area::DOUBLE AS area FROM fin WHERE final_area IS NOT NULL")
def cov12(spark, sf):
    d = L.stages(spark, sf)["full_res"]
    return d.select("locality_pid", "locality_name", "postcode", "state", F.round(G.area("geom"), 4).alias("area"))


@query("cov13", f"""WITH {L.FINAL} SELECT locality_pid, postcode, locality_class, address_count, street_count, final_area::DOUBLE AS area,
 CASE WHEN j = 0 AND odd AND r = 3 THEN 48 WHEN j < 3 THEN 32 WHEN j = 3 THEN 31.5 + CASE WHEN holed THEN 8 ELSE 0 END + CASE WHEN r < 4 THEN 0.5 ELSE 0 END
      WHEN odd AND r = 0 THEN 14 ELSE 8 END::DOUBLE AS perimeter FROM fin WHERE final_area IS NOT NULL""")
def cov13(spark, sf):
    d = L.stages(spark, sf)["display"]
    return d.select("locality_pid", "postcode", "locality_class", "address_count", "street_count",
                    F.round(G.area("geom"), 4).alias("area"), F.round(G.length("geom"), 3).alias("perimeter"))


@query("cov14", f"""WITH {L.FINAL}, filled AS (SELECT *, final_area + CASE WHEN holed THEN 4 ELSE 0 END AS fa FROM fin WHERE final_area IS NOT NULL),
coded AS (SELECT postcode, state, sum(fa - CASE WHEN j = 3 AND holed AND b % 3 = 2 THEN 4 ELSE 0 END) AS area FROM filled
  WHERE postcode IS NOT NULL AND postcode <> 'NA' GROUP BY 1, 2),
open_ AS (SELECT b, r, state, CASE WHEN j = 4 AND odd AND r = 0 THEN 1 ELSE 0 END AS island,
    sum(CASE WHEN j = 3 AND holed THEN fa - 4 ELSE fa END) AS area FROM filled
  WHERE (postcode IS NULL OR postcode = 'NA') AND NOT (j = 4 AND holed IS FALSE AND NOT (odd AND r = 0)) GROUP BY 1, 2, 3, 4)
SELECT postcode, state, round(area, 2)::DOUBLE AS area FROM coded UNION ALL SELECT NULL, state, round(area, 2)::DOUBLE FROM open_""")
def cov14(spark, sf):
    d = L.stages(spark, sf)["postcodes"]
    return d.select("postcode", "state", F.round(G.area("geom"), 2).alias("area"))


@query("cov15", f"""WITH {L.LOC}, c AS (SELECT postcode, sum({L.LOC_AREA}) AS a,
  sum((x1 - x0) * (y1 - y0) * (x0 + x1) / 2 - CASE WHEN holed THEN 4 * (hx0 + 1) ELSE 0 END) AS mx,
  sum((x1 - x0) * (y1 - y0) * (y0 + y1) / 2 - CASE WHEN holed THEN 4 * (hy0 + 1) ELSE 0 END) AS my FROM loc WHERE postcode IS NOT NULL GROUP BY 1),
 s AS (SELECT postcode, mx / a AS x, my / a AS y, lead(postcode) OVER w AS next_postcode, lead(mx / a) OVER w AS nx, lead(my / a) OVER w AS ny FROM c WINDOW w AS (ORDER BY postcode))
SELECT postcode, next_postcode, round(sqrt((nx - x) ** 2 + (ny - y) ** 2), 5) AS length FROM s""")
def cov15(spark, sf):
    d = qa.postcode_path(L.localities(spark, sf).select("postcode", "geom"))
    return d.select("postcode", "next_postcode", F.round(N.ring_length("path"), 5).alias("length"))


# ---- quality reports ----

_REPORT = "locality_pid, locality_name, coalesce(postcode, '') AS postcode, state, address_count, street_count"


@query("qa1", f"WITH {L.FINAL} SELECT {_REPORT} FROM fin WHERE final_area IS NULL")
def qa1(spark, sf):
    return L.stages(spark, sf)["dropped"]


@query("qa2", f"WITH {L.LOC} SELECT {_REPORT} FROM loc WHERE k % 7 = 0")
def qa2(spark, sf):
    return qa.invalid_features(dirty(spark, sf))


@query("qa3", f"WITH {L.LOC} SELECT {_REPORT} FROM loc WHERE k % 7 <> 0 AND k % 5 = 0")
def qa3(spark, sf):
    return qa.empty_features(dirty(spark, sf))


_V = """v AS (SELECT k, s.seq, lon + CASE WHEN s.seq IN (2, 3) THEN side ELSE 0 END AS x, lat + CASE WHEN s.seq IN (3, 4) THEN side ELSE 0 END AS y
 FROM ll, (SELECT unnest([1, 2, 3, 4, 5]) AS seq) s)"""


@query("qa4", f"WITH {L.LONLAT}, {_V} SELECT k, 1::SMALLINT AS polygon_num, 1::SMALLINT AS ring_num, seq::INT AS point_num, x::DECIMAL(9,6)::DOUBLE AS longitude, y::DECIMAL(8,6)::DOUBLE AS latitude FROM v")
def qa4(spark, sf):
    v = vertices(lonlat_boxes(spark, sf).select("k", "geom"), "k")
    return v.withColumns({"longitude": F.col("longitude").cast("double"), "latitude": F.col("latitude").cast("double")})


def _retraced(spark, sf):
    """Boxes in longitude and latitude; every fifth ring passes its second vertex twice."""
    d = L.lonlat(spark, sf)
    x, y, s = F.col("lon"), F.col("lat"), F.col("side")
    ring = N.box_ring(x, y, x + s, y + s)
    twice = F.concat(F.slice(ring, 1, 3), F.slice(ring, 2, 4))
    return d.select("k", G.encode(F.array(F.array(F.when(F.col("k") % 5 == 0, twice).otherwise(ring)))).alias("geom"))


@query("qa5", f"""WITH {L.LONLAT}, s AS (SELECT k,
   unnest(CASE WHEN k % 5 = 0 THEN [lon + side, lon + side, lon + side, lon + side, lon] ELSE [lon + side, lon + side, lon] END) AS x,
   unnest(CASE WHEN k % 5 = 0 THEN [lat, lat + side, lat, lat + side, lat + side] ELSE [lat, lat + side, lat + side] END) AS y FROM ll)
SELECT k, 1::INT AS part, 1::INT AS ring, x::DECIMAL(8,5)::DOUBLE AS longitude, y::DECIMAL(7,5)::DOUBLE AS latitude, count(*) AS cnt
FROM s GROUP BY ALL HAVING count(*) > 1""")
def qa5(spark, sf):
    d = qa.duplicate_vertices(_retraced(spark, sf), "k")
    return d.withColumns({"longitude": F.col("longitude").cast("double"), "latitude": F.col("latitude").cast("double")})


@query("qa6", f"WITH {L.LONLAT}, {_V} SELECT k, 1::INT AS part, 1::INT AS ring, seq::INT AS seq FROM v WHERE x::DECIMAL(8,5) = 114.57813 AND y::DECIMAL(7,5) = -42.17188")
def qa6(spark, sf):
    d = lonlat_boxes(spark, sf).select("k", "geom")
    v = qa.vertex_positions(d, F.lit("114.57813").cast("decimal(8,5)"), F.lit("-42.17188").cast("decimal(7,5)"), "k")
    return v.select("k", "part", "ring", "seq")


@query("qa7", f"WITH {L.LOC} SELECT k, s.line_num::INT AS line_num, CASE WHEN s.line_num = 1 THEN 2 WHEN holed THEN 8 ELSE 3 END::INT AS points FROM loc, (SELECT unnest([1, 2]) AS line_num) s")
def qa7(spark, sf):
    """Vertices of a locality, numbered through all rings, as two ordered lines broken at the third."""
    from pyspark.sql import Window as W

    v = N.to_vertices(L.localities_nested(spark, sf), "nested", ["k"])
    v = v.withColumn("point_seq", F.row_number().over(W.partitionBy("k").orderBy("part", "ring", "seq")))
    return break_line(v, ["k"], "point_seq", 3).select("k", "line_num", F.size("path").alias("points"))


@query("qa8", "SELECT 65 * count(*) AS before, 5 * count(*) AS after, round((1 - 5.0 / 65) * 100, 3)::DOUBLE AS reduction_pct FROM customer")
def qa8(spark, sf):
    d = bumpy(spark, sf).select("geom")
    return qa.vertex_reduction(d, d.select(G.simplify_vw("geom", 0.01).alias("geom")))


@query("qa9", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN 'new' ELSE 'lost' END AS change FROM orders WHERE (o_orderkey % 17 = 0) <> (o_orderkey % 19 = 0)")
def qa9(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return qa.release_changes(o.where(F.col("k") % 17 != 0), o.where(F.col("k") % 19 != 0), "k")


# ---- the function surface ----


@query("udf1", f"WITH {L.LOC}{L.STATES} SELECT k, state_gid, ({_PI})::DOUBLE AS area FROM loc l JOIN st s ON l.b = s.b WHERE ({_PI}) > 0")
def udf1(spark, sf):
    """The overlay function from SQL text, on candidate pairs from the grid."""
    states = L.state_boxes(spark, sf).select("state_gid", F.col("geom").alias("geom2"))
    pairs = spatial_join(L.localities(spark, sf).select("k", "geom"), states, None, 16.0)
    return spark.sql("""SELECT k, state_gid, cv_area(shared) AS area
        FROM {pairs} LATERAL VIEW explode(array(cv_polygonal_intersection(geom, geom2))) AS shared WHERE shared IS NOT NULL""", pairs=pairs)


@query("udf2", f"WITH {L.BLOCKS}{L.ZONES} SELECT zone_id, 2::INT AS pieces FROM zn")
def udf2(spark, sf):
    return spark.sql("""SELECT zone_id, size(cv_split(geom, cv_line(array(
          named_struct('x', b.xmin - 1, 'y', b.ymin + 8), named_struct('x', b.xmax + 1, 'y', b.ymin + 8))))) AS pieces
        FROM (SELECT zone_id, geom, cv_bounds(geom) AS b FROM {z})""", z=L.corridor_boxes(spark, sf))


@query("udf4", f"""WITH {L.AREAS} SELECT state, b, sum((x1 - x0) * (y1 - y0) - CASE WHEN j = 0 THEN 1 ELSE 0 END)::DOUBLE AS area, count(*)::INT AS parts FROM area GROUP BY 1, 2""")
def udf4(spark, sf):
    """Union and collect as SQL aggregates with map-side partial results."""
    return spark.sql("SELECT state, b, cv_area(cv_union_agg(geom)) AS area, cv_nparts(cv_collect_agg(geom)) AS parts FROM {a} GROUP BY state, b",
                     a=L.areas(spark, sf))


@query("udf5", f"WITH {L.LOC} SELECT k, s.line::INT AS line, 5::INT AS points FROM loc, (SELECT unnest([1, 2]) AS line) s WHERE s.line = 1 OR holed")
def udf5(spark, sf):
    """Set-returning functions as generators; path and value come from one generator, so they stay in step."""
    return spark.sql("""SELECT k, CAST(i + 1 AS INT) AS line, cv_npoints(g) AS points
        FROM {loc} LATERAL VIEW posexplode(cv_parts(cv_boundary(geom))) p AS i, g""", loc=L.localities(spark, sf).select("k", "geom"))


@query("agg5_states", f"WITH {L.LOC}{L.STATES} SELECT state_gid, count(DISTINCT k) AS localities FROM loc l JOIN st s ON l.b = s.b WHERE ({_PI}) > 0 GROUP BY 1")
def agg5_states(spark, sf):
    states = L.state_boxes(spark, sf).select("state_gid", F.col("geom").alias("geom2"))
    j = spatial_join(L.localities(spark, sf).select("k", "geom"), states, G.intersects, 16.0)
    j = j.where(~G.touches("geom", "geom2"))
    return j.groupBy("state_gid").agg(F.countDistinct("k").alias("localities"))
