"""Geometry columns: constructors, accessors, measures, transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlay.functions import geodesy
from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.functions import zoom as Z
from coverlay.operators.points import nearest_outline
from coverlay.operators.attributes import lead_over_all
from coverlay.operators.dissolve import dissolve_parts
from coverlay.operators.grid import with_bounds
from coverlay.operators.lines import label_chains, chain_lines
from coverlay.operators.simplify import simplify_coverage, thin_by_zoom
from coverlay.operators.spread import number_rows
from coverlay.operators.tiles import subdivide
from coverlay.sources.readers import detect_srid, fix_point_geometry
from workload import layers as L
from workload.registry import query, table
from workload.relational import BRAND_CELLS, dirty, lonlat_boxes


def _two_part(spark, sf):
    """Each locality with a copy of itself 0.5 to the north as a second part (never used for overlay)."""
    d = L.localities_nested(spark, sf)
    north = N.map_points("nested", lambda p: N.translate(p, 0.0, 500.0))
    return d.withColumn("nested", F.concat("nested", north))


@query("geo1", f"WITH {L.LOC} SELECT k, s.part::INT AS part, {L.LOC_AREA}::DOUBLE AS area FROM loc, (SELECT unnest([1, 2]) AS part) s")
def geo1(spark, sf):
    d = _two_part(spark, sf).select("k", G.encode("nested").alias("geom"))
    p = d.select("k", F.posexplode(G.parts("geom")).alias("i", "geom"))
    return p.select("k", (F.col("i") + 1).alias("part"), G.area("geom").alias("area"))


@query("geo2", f"""WITH {L.LOC}, v AS (SELECT k, r.ring, s.seq, CASE WHEN r.ring = 1 THEN x0 ELSE hx0 END AS xa, CASE WHEN r.ring = 1 THEN x1 ELSE hx1 END AS xb,
 CASE WHEN r.ring = 1 THEN y0 ELSE hy0 END AS ya, CASE WHEN r.ring = 1 THEN y1 ELSE hy1 END AS yb FROM loc, (SELECT unnest([1, 2]) AS ring) r, (SELECT unnest([1, 2, 3, 4, 5]) AS seq) s WHERE r.ring = 1 OR holed)
SELECT k, 1::INT AS part, ring::INT AS ring, seq::INT AS seq, CASE WHEN seq IN (2, 3) THEN xb ELSE xa END AS x, CASE WHEN seq IN (3, 4) THEN yb ELSE ya END AS y FROM v""")
def geo2(spark, sf):
    return N.to_vertices(L.localities(spark, sf).select("k", G.decode("geom").alias("n")), "n", ["k"])


@query("geo3", f"WITH {L.LOC} SELECT k, (2 * (x1 - x0) + 2 * (y1 - y0))::DOUBLE AS outer_length, CASE WHEN holed THEN 2 ELSE 1 END::INT AS rings FROM loc")
def geo3(spark, sf):
    d = L.localities_nested(spark, sf)
    return d.select("k", N.length(N.exterior("nested")).alias("outer_length"), F.size(N.rings("nested")).alias("rings"))


@query("geo4", f"WITH {L.LOC} SELECT k, ((x1 - x0) * (y1 - y0))::DOUBLE AS area FROM loc")
def geo4(spark, sf):
    d = L.localities_nested(spark, sf)
    return d.select("k", G.area(G.encode(N.exterior("nested"))).alias("area"))


@query("geo5", f"WITH {L.LOC} SELECT k, s.line::INT AS line, CASE WHEN s.line = 1 THEN 2 * (x1 - x0) + 2 * (y1 - y0) ELSE 8 END::DOUBLE AS length FROM loc, (SELECT unnest([1, 2]) AS line) s WHERE s.line = 1 OR holed")
def geo5(spark, sf):
    d = L.localities(spark, sf).select("k", F.posexplode(G.parts(G.boundary("geom"))).alias("i", "line"))
    return d.select("k", (F.col("i") + 1).alias("line"), G.length("line").alias("length"))


@query("geo6", f"WITH {L.LOC} SELECT k, {L.LOC_AREA}::DOUBLE AS area FROM loc")
def geo6(spark, sf):
    return L.localities_nested(spark, sf).select("k", N.area("nested").alias("area"))


_LENGTH = "(2 * (x1 - x0) + 2 * (y1 - y0) + CASE WHEN holed THEN 8 ELSE 0 END)::DOUBLE"


@query("geo7", f"WITH {L.LOC} SELECT k, {_LENGTH} AS length FROM loc")
def geo7(spark, sf):
    return L.localities_nested(spark, sf).select("k", N.length("nested").alias("length"))


@query("geo8", f"WITH {L.LOC} SELECT k, CASE WHEN holed THEN 20 ELSE 10 END::INT AS points, 2::INT AS parts, {L.LOC_AREA}::DOUBLE AS second_area FROM loc")
def geo8(spark, sf):
    d = _two_part(spark, sf)
    second = F.array(F.element_at("nested", 2))
    return d.select("k", N.num_points("nested").alias("points"), F.size("nested").alias("parts"), N.area(second).alias("second_area"))


@query("geo9", "SELECT c_custkey AS k, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 = 0 THEN TRUE ELSE FALSE END AS empty, 'Polygon' AS kind, 4283::INT AS srid FROM customer")
def geo9(spark, sf):
    """Kind, emptiness, and the SRID that the layer's extended WKB carries: one for the whole layer."""
    d = dirty(spark, sf)
    wkb = F.hex("geom")
    ewkb = F.concat(F.substring(wkb, 1, 8), F.lit("20BB100000"), F.substring(wkb, 11, 1 << 30))
    d = d.select("k", G.plain_wkb(F.unhex(ewkb)).alias("geom"), G.ewkb_srid(F.unhex(ewkb)).alias("srid"))
    return d.select("k", G.is_empty("geom").alias("empty"), G.kind("geom").alias("kind"), F.lit(detect_srid(d)).alias("srid"))


@query("geo10", f"WITH {L.POINTS} SELECT pt, x, y, 7844::INT AS srid FROM pts")
def geo10(spark, sf):
    d = L.points(spark, sf).select("pt", G.point("x", "y").alias("geom"), F.lit(7844).alias("srid"))
    return d.select("pt", G.centroid("geom").alias("p"), "srid").select("pt", "p.x", "p.y", "srid")


@query("geo11", f"WITH {L.LOC} SELECT k, x0::DOUBLE AS xmin, y0::DOUBLE AS ymin, x1::DOUBLE AS xmax, y1::DOUBLE AS ymax FROM loc")
def geo11(spark, sf):
    return with_bounds(L.localities(spark, sf).select("k", "geom")).drop("geom")


@query("geo12", f"WITH {L.LOC} SELECT k, 'MultiPolygon' AS kind, 1::INT AS parts, {L.LOC_AREA}::DOUBLE AS area FROM loc")
def geo12(spark, sf):
    """Promotion to multi; promoting twice changes nothing."""
    d = L.localities(spark, sf).withColumn("geom", G.multi(G.multi("geom")))
    return d.select("k", G.kind("geom").alias("kind"), G.num_parts("geom").alias("parts"), G.area("geom").alias("area"))


@query("geo13", f"WITH {L.LOC} SELECT k, CASE WHEN holed THEN 10 ELSE 5 END::INT AS points, round({L.LOC_AREA}, 6)::DOUBLE AS area FROM loc")
def geo13(spark, sf):
    """Snapping drops the tiny extra part and the repeated points that rounding makes."""
    d = L.localities_nested(spark, sf)
    x, y = F.col("x0"), F.col("y0")
    speck = F.array(N.box_ring(x - 3.0, y, x - 3.0 + 0.000001, y + 0.000001))
    doubled = F.transform("nested", lambda part: F.transform(part, lambda r: F.flatten(F.transform(
        r, lambda p: F.array(p, N.translate(p, 0.000001, 0.0))))))
    snapped = N.snap_to_grid(F.concat(doubled, F.array(speck)), 0.00001)
    return d.select("k", snapped.alias("n")).select("k", N.num_points("n").alias("points"), F.round(N.area("n"), 6).alias("area"))


@query("geo14", f"WITH {L.LOC} SELECT k, CASE WHEN holed THEN 10 ELSE 5 END::INT AS exact, CASE WHEN holed THEN 10 ELSE 5 END::INT AS near FROM loc")
def geo14(spark, sf):
    d = L.localities_nested(spark, sf)
    doubled = N.map_rings("nested", lambda r: F.flatten(F.transform(r, lambda p: F.array(p, p))))
    close = N.map_rings("nested", lambda r: F.concat(F.flatten(F.transform(F.slice(r, 1, F.size(r) - 1), lambda p: F.array(
        p, N.translate(p, 0.001, 0.0)))), F.slice(r, F.size(r), 1)))
    return d.select("k", N.num_points(N.remove_repeated_points(doubled)).alias("exact"),
                    N.num_points(N.remove_repeated_points(close, 0.01)).alias("near"))


def _helmert_sql(lon: str, lat: str) -> str:
    g = geodesy
    e2 = g.GRS80_F * (2 - g.GRS80_F)
    b = g.GRS80_A * (1 - g.GRS80_F)
    rx, ry, rz = (f"radians({v!r} / 3600)" for v in g.SHIFT_R)
    tx, ty, tz = g.SHIFT_T
    k = 1 + g.SHIFT_S * 1e-6
    return f"""c AS (SELECT k, {g.GRS80_A} / sqrt(1 - {e2!r} * sin(radians({lat})) ** 2) AS nu, radians({lon}) AS lam, radians({lat}) AS phi FROM ll),
 g AS (SELECT k, nu * cos(phi) * cos(lam) AS gx, nu * cos(phi) * sin(lam) AS gy, nu * (1 - {e2!r}) * sin(phi) AS gz FROM c),
 m AS (SELECT k, {tx} + {k!r} * (gx + {rz} * gy - {ry} * gz) AS mx, {ty} + {k!r} * (gy - {rz} * gx + {rx} * gz) AS my,
       {tz} + {k!r} * (gz + {ry} * gx - {rx} * gy) AS mz FROM g),
 u AS (SELECT *, sqrt(mx * mx + my * my) AS p, atan2(mz * {g.GRS80_A}, sqrt(mx * mx + my * my) * {b!r}) AS t FROM m),
 h AS (SELECT k, degrees(atan2(my, mx)) AS lon2, degrees(atan2(mz + {e2 / (1 - e2) * b!r} * sin(t) ** 3, p - {e2 * g.GRS80_A!r} * cos(t) ** 3)) AS lat2 FROM u)"""


@query("geo15", f"WITH {L.LONLAT}, {_helmert_sql('lon', 'lat')} SELECT k, round(lon2, 9) AS lon, round(lat2, 9) AS lat FROM h")
def geo15(spark, sf):
    d = L.lonlat(spark, sf).select("k", geodesy.gda2020(F.col("lon"), F.col("lat")).alias("p"))
    return d.select("k", F.round("p.x", 9).alias("lon"), F.round("p.y", 9).alias("lat"))


def _albers_sql() -> str:
    g, c = geodesy, geodesy.albers_constants()
    e2 = g.GRS80_F * (2 - g.GRS80_F)
    e = e2 ** 0.5
    return f"""v AS (SELECT k, i, radians(lon + CASE WHEN i IN (1, 2) THEN side ELSE 0 END) AS lam, radians(lat + CASE WHEN i IN (2, 3) THEN side ELSE 0 END) AS phi
  FROM ll, (SELECT unnest([0, 1, 2, 3]) AS i) n),
 q AS (SELECT k, i, lam, {1 - e2!r} * (sin(phi) / (1 - {e2!r} * sin(phi) ** 2) - ln((1 - {e!r} * sin(phi)) / (1 + {e!r} * sin(phi))) / {2 * e!r}) AS q FROM v),
 a AS (SELECT k, i, {g.GRS80_A} * sqrt({c['c']!r} - {c['n']!r} * q) / {c['n']!r} AS rho, {c['n']!r} * (lam - radians({g.ALBERS_LON0})) AS th FROM q),
 e AS (SELECT k, i, rho * sin(th) AS ex, {c['rho0']!r} - rho * cos(th) AS ny FROM a),
 o AS (SELECT k, max(CASE WHEN i = 0 THEN ex END) AS ox, max(CASE WHEN i = 0 THEN ny END) AS oy FROM e GROUP BY 1),
 s AS (SELECT e.k, (ex - ox) * (lead(ny) OVER w - oy) - (lead(ex) OVER w - ox) * (ny - oy) AS cr FROM e JOIN o USING (k) WINDOW w AS (PARTITION BY e.k ORDER BY i))"""


@query("geo16", f"WITH {L.LONLAT}, {_albers_sql()} SELECT k, round(abs(sum(cr)) / 2) AS square_metres FROM s GROUP BY 1")
def geo16(spark, sf):
    d = lonlat_boxes(spark, sf)
    return d.select("k", F.round(N.area(geodesy.albers_nested("nested"))).alias("square_metres"))


@query("geo17", f"WITH {L.POINTS} SELECT pt, x + 0.5 AS x, y - 0.25 AS y FROM pts")
def geo17(spark, sf):
    d = L.points(spark, sf).select("pt", N.translate(N.xy("x", "y"), 0.5, -0.25).alias("p"))
    return d.select("pt", "p.x", "p.y")


_STEP = "s AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM tr WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


def _steps(spark, sf):
    """Each event's point and the same user's next one. Range partitions cut through busy users."""
    d = L.tracks(spark, sf).select("event_id", "user_id", "ts", N.xy("x", "y").alias("a"))
    led = lead_over_all(d, ["user_id", "ts", "event_id"], ["user_id", "a"])
    return led.select("event_id", "a", F.when(F.col("next.user_id") == F.col("user_id"), F.col("next.a")).alias("b"))


@query("geo18", f"""WITH {L.TRACKS}, {_STEP} SELECT event_id, round(CASE WHEN nx = x AND ny = y THEN NULL
 ELSE CASE WHEN atan2(nx - x, ny - y) < 0 THEN atan2(nx - x, ny - y) + 2 * pi() ELSE atan2(nx - x, ny - y) END END, 9) AS azimuth FROM s""")
def geo18(spark, sf):
    return _steps(spark, sf).select("event_id", F.round(N.azimuth("a", "b"), 9).alias("azimuth"))


@query("geo19", f"WITH {L.TRACKS}, {_STEP} SELECT event_id, round(sqrt((nx - x) ** 2 + (ny - y) ** 2), 6) AS distance FROM s")
def geo19(spark, sf):
    return _steps(spark, sf).select("event_id", F.round(N.distance("a", "b"), 6).alias("distance"))


@query("geo20", f"WITH {L.TRACKS}, {_STEP} SELECT event_id, CASE WHEN nx IS NULL THEN NULL ELSE 2 END::INT AS points FROM s")
def geo20(spark, sf):
    line = N.make_line("a", "b")
    return _steps(spark, sf).select("event_id", F.when(line.isNotNull(), F.size(line)).alias("points"))


_CENTRE = "round(((x1 - x0) * (y1 - y0) * ({0}0 + {0}1) / 2 - CASE WHEN holed THEN 4 * (h{0}0 + h{0}1) / 2 ELSE 0 END) / " + L.LOC_AREA + ", 9)"


@query("geo21", f"WITH {L.LOC} SELECT k, {_CENTRE.format('x')} AS cx, {_CENTRE.format('y')} AS cy FROM loc")
def geo21(spark, sf):
    d = L.localities_nested(spark, sf).select("k", N.centroid("nested").alias("c"))
    return d.select("k", F.round("c.x", 9).alias("cx"), F.round("c.y", 9).alias("cy"))


@query("geo22", f"""WITH {L.POINTS}, {L.LOC}, n AS (
  SELECT pt, k, x, y, CASE WHEN x > x0 AND x < x1 AND y > y0 AND y < y1 THEN least(x - x0, x1 - x, y - y0, y1 - y)
    ELSE sqrt(greatest(x0 - x, 0, x - x1) ** 2 + greatest(y0 - y, 0, y - y1) ** 2) END AS d
  FROM pts JOIN loc USING (b))
SELECT pt, round(min(d), 6) AS dist FROM n GROUP BY 1""")
def geo22(spark, sf):
    """Closest point on the outlines of a point's block, through the grid."""
    layer = L.localities(spark, sf).select("k", "b", "geom")
    near = nearest_outline(L.points(spark, sf), layer, 4.0, "pt", "k", on=["b"])
    return near.select("pt", F.round("dist", 6).alias("dist")).distinct()


@query("geo23", f"WITH {L.LOC} SELECT k, TRUE AS inside FROM loc")
def geo23(spark, sf):
    d = L.localities(spark, sf).select("k", "geom", G.interior_point("geom").alias("p"))
    return d.select("k", G.within(G.point("p.x", "p.y"), "geom").alias("inside"))


@query("geo24", f"WITH {L.POINTS} SELECT pt, x, y, 4283::INT AS srid FROM pts")
def geo24(spark, sf):
    """Extended WKB in hex is decoded batch-wise; header bytes give the SRID."""
    wkb = F.hex(G.point("x", "y"))
    ewkb = F.concat(F.lit("0101000020BB100000"), F.substring(wkb, 11, 32))
    d = L.points(spark, sf).select(F.col("pt").alias("gid"), F.lit(None).cast("double").alias("longitude"),
                                   F.lit(None).cast("double").alias("latitude"), ewkb.alias("ewkb_hex"))
    out = fix_point_geometry(d).select("gid", "srid", G.centroid("geom").alias("p"))
    return out.select(F.col("gid").alias("pt"), "p.x", "p.y", "srid")


_PAIR = "'[' || {0} || ',' || {1} || ']'"


def _num(e: str) -> str:
    return f"rtrim(rtrim(printf('%.5f', round({e}, 5)), '0'), '.')"


_RING = " || ',' || ".join(
    _PAIR.format(_num(x), _num(y)) for x, y in
    [("lon", "lat"), ("lon + side", "lat"), ("lon + side", "lat + side"), ("lon", "lat + side"), ("lon", "lat")])


@query("geo25", f"WITH {L.LONLAT} SELECT k, '[[[' || {_RING} || ']]]' AS coordinates FROM ll")
def geo25(spark, sf):
    from coverlay.sources.writers import coordinates_json

    d = lonlat_boxes(spark, sf)
    return d.select("k", coordinates_json(F.col("nested"), 5).alias("coordinates"))


@query("geo26", f"""WITH {L.TRACKS}, {_STEP} SELECT event_id, round(CASE WHEN nx = x AND ny = y THEN NULL ELSE sqrt((nx - x) ** 2 + (ny - y) ** 2) + 0.00002 END, 8) AS length FROM s""")
def geo26(spark, sf):
    return _steps(spark, sf).select("event_id", F.round(N.ring_length(N.overshoot("a", "b")), 8).alias("length"))


# ---- repair and simplification ----

AMPLITUDE = 2.0 ** -12


def bumpy_nested(spark, sf):
    """A 16 × 16 box per customer, a vertex at every unit, alternate ones pushed out by 1/4096."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).repartition(L.tasks(spark), "k")
    x, y = F.lit(32.0) * (F.col("k") % 32), F.lit(32.0) * F.floor(F.col("k") / 32)
    c = c.withColumns({"x": x, "y": y})

    def side(fx, fy):
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: N.xy(
            F.col("x") + fx(i.cast("double"), F.when(i % 2 == 1, AMPLITUDE).otherwise(0.0)),
            F.col("y") + fy(i.cast("double"), F.when(i % 2 == 1, AMPLITUDE).otherwise(0.0))))

    zero = lambda *_: F.lit(0.0)
    sides = [
        side(lambda i, a: i, lambda i, a: -a), side(lambda i, a: 16.0 + a, lambda i, a: i),
        side(lambda i, a: 16.0 - i, lambda i, a: 16.0 + a), side(lambda i, a: zero() - a, lambda i, a: 16.0 - i),
    ]
    ring = F.concat(*sides, F.array(N.xy("x", "y")))
    return c.withColumn("nested", F.array(F.array(ring)))


def bumpy(spark, sf):
    return bumpy_nested(spark, sf).withColumn("geom", G.encode("nested")).drop("nested")


@query("ovl6", f"""WITH {L.LOC} SELECT k, CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END::INT AS parts,
 CASE WHEN k % 7 = 0 THEN 2 ELSE {L.LOC_AREA} END::DOUBLE AS area FROM loc WHERE k % 7 = 0 OR k % 5 <> 0""")
def ovl6(spark, sf):
    d = dirty(spark, sf).select("k", F.explode(G.polygons(G.make_valid("geom"))).alias("geom"))
    return d.groupBy("k").agg(F.count(F.lit(1)).cast("int").alias("parts"), F.sum(G.area("geom")).alias("area"))


@query("ovl8", "SELECT c_custkey AS k, 256.0 + 32 * pow(0.5, 12) AS area, TRUE AS small FROM customer")
def ovl8(spark, sf):
    d = bumpy(spark, sf).select("k", F.explode(G.subdivide("geom", 16)).alias("geom"))
    return d.groupBy("k").agg(F.round(F.sum(G.area("geom")), 9).alias("area"), (F.max(G.num_points("geom")) <= 16).alias("small"))


@query("ovl8_tiles", "SELECT c_custkey AS k, 256.0 + 32 * pow(0.5, 12) AS area, TRUE AS small FROM customer")
def ovl8_tiles(spark, sf):
    d = subdivide(bumpy_nested(spark, sf).select("k", "nested"), ["k"], max_points=16, band=32.0)
    return d.groupBy("k").agg(F.round(F.sum(N.area("nested")), 9).alias("area"), (F.max(N.num_points("nested")) <= 16).alias("small"))


@query("ovl9", "SELECT c_custkey AS k, 5::INT AS points, 256::DOUBLE AS area FROM customer")
def ovl9(spark, sf):
    d = bumpy(spark, sf).withColumn("geom", G.simplify("geom", 0.001))
    return d.select("k", G.num_points("geom").alias("points"), G.area("geom").alias("area"))


@query("ovl10", "SELECT c_custkey AS k, 5::INT AS points, 256::DOUBLE AS area FROM customer")
def ovl10(spark, sf):
    d = bumpy(spark, sf).withColumn("geom", G.simplify_vw("geom", 0.01))
    return d.select("k", G.num_points("geom").alias("points"), G.area("geom").alias("area"))


_Z = "(c_custkey % 21)"


@query("ovl11", f"""SELECT c_custkey AS k, round(ln(20 * pow(156543.03390625 / pow(2.0, {_Z} + 1) / (2 * pi() * 6378137 / 360), 2)), 9) AS degrees,
 round(ln(20 * pow(156543.03390625 / pow(2.0, {_Z} + 1), 2)), 9) AS metres FROM customer""")
def ovl11(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 21).alias("z"))
    return c.select("k", F.round(F.ln(Z.tolerance("z")), 9).alias("degrees"), F.round(F.ln(Z.tolerance("z", "metres")), 9).alias("metres"))


@query("ovl12", f"""WITH s AS (SELECT c_custkey AS k, split_part(printf('%.9f', 156543.03390625 / pow(2.0, {_Z}) / (2 * pi() * 6378137 / 360)), '.', 2) AS f FROM customer)
SELECT k, (1 + length(f) - length(ltrim(f, '0')))::INT AS places FROM s""")
def ovl12(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 21).alias("z"))
    return c.select("k", Z.decimal_places("z").alias("places"))


@query("ovl13", "SELECT c_custkey AS k, zoom::INT AS zoom, CASE WHEN zoom = 5 THEN 5 ELSE 65 END::INT AS points FROM customer, (SELECT unnest([5, 10, 15]) AS zoom)")
def ovl13(spark, sf):
    d = thin_by_zoom(bumpy(spark, sf), [5, 10, 15], ["k"])
    whole = d.groupBy("k", "zoom").agg(G.union_agg("geom").alias("geom"))
    return whole.select("k", "zoom", G.num_points("geom").alias("points"))


@query("ovl14", f"""WITH {L.CELLS}, e AS (SELECT cell_id, cell_id % 32 AS i, cell_id // 32 AS row FROM cells)
SELECT row, count(*) AS edges, count(*)::DOUBLE AS length FROM e WHERE i < 31 GROUP BY 1""")
def ovl14(spark, sf):
    """Unit edges, one per order, chained into rows of up to 31 by following shared end points."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("c")).where(F.col("c") % 32 < 31)
    x, y = (F.col("c") % 32).cast("double"), F.floor(F.col("c") / 32).cast("double")
    edges = o.select(x.alias("x1"), y.alias("y1"), (x + 1.0).alias("x2"), y.alias("y2"))
    lines = chain_lines(label_chains(edges))
    return lines.select(F.col("path")[0]["y"].cast("bigint").alias("row"), (F.size("path") - 1).cast("bigint").alias("edges"),
                        N.ring_length("path").alias("length"))


_FACES = f"""WITH {BRAND_CELLS}, adj AS (
  SELECT a.owner, count(*) AS n FROM cells a JOIN cells b ON a.owner = b.owner
   AND ((b.cx = a.cx + 1 AND b.cy = a.cy) OR (b.cx = a.cx AND b.cy = a.cy + 1)) GROUP BY 1)
SELECT c.owner, c.n::DOUBLE AS area, (4 * c.n - 2 * coalesce(adj.n, 0))::DOUBLE AS perimeter
FROM (SELECT owner, count(*) AS n FROM cells GROUP BY 1) c LEFT JOIN adj ON adj.owner = c.owner"""


@query("cov3", _FACES)
def cov3(spark, sf):
    """Shared-border simplification of a coverage: saws along the borders become straight, corners stay."""
    cells = L.brand_cells_nested(spark, sf, saws=True).select("owner", G.encode("nested").alias("geom"))
    parts = number_rows(dissolve_parts(cells, ["owner"], cell=8.0), "pid")
    out = simplify_coverage(parts, "pid", 0.25, 8.0).join(parts.select("pid", "owner"), "pid")
    return out.groupBy("owner").agg(F.round(F.sum(G.area("geom")), 9).alias("area"), F.round(F.sum(G.length("geom")), 9).alias("perimeter"))


@query("ovl15", "SELECT c_custkey AS k, 64::DOUBLE AS length, 256::DOUBLE AS area, 5::INT AS points FROM customer")
def ovl15(spark, sf):
    """Saws shallower than the tolerance are thinned to their straight line, the same one for both neighbours."""
    out = simplify_coverage(L.zigzag_boxes(spark, sf), "k", 0.05, 16.0)
    return out.select("k", F.round(G.length("geom"), 9).alias("length"), F.round(G.area("geom"), 9).alias("area"), G.num_points("geom").alias("points"))


@query("udf3", "SELECT c_custkey AS k, round(32 + 8 * sqrt(16 + pow(1 / 64.0::DOUBLE, 2)), 9)::DOUBLE AS length, 256::DOUBLE AS area, 11::INT AS points FROM customer")
def udf3(spark, sf):
    """The layer function below the depth of the saws: every feature is rebuilt from shared chains as it was."""
    out = simplify_coverage(L.zigzag_boxes(spark, sf), "k", 0.001, 16.0)
    return out.select("k", F.round(G.length("geom"), 9).alias("length"), F.round(G.area("geom"), 9).alias("area"), G.num_points("geom").alias("points"))
