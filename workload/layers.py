"""Layers with real polygons and known answers, one feature per row of a driver table, so they grow with it.

The customers form blocks of 25. A block is a small country of five states side by side, each 16 × 16, with
five localities per state: gaps and overshoots along the state borders, an enclosed island, and in every other
block an offshore island and a locality that lies mostly on the wrong side. Blocks lie on a grid with sea in
between. All coordinates are multiples of 1/128, so areas and lengths are exact. Narrow columns are dealt by key
before geometry, which costs much CPU per byte, is built from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlay import enable
from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.plans import CleanConfig, clean
from workload.registry import table

CFG = CleanConfig(
    cell=16.0, border_simplify=0.001, border_width=0.5, min_gap_area=None, sliver_exceptions=(), always_keep=(),
    drop_at=None,
)

_STAGES: dict[tuple[str, str], dict[str, DataFrame]] = {}


def when(cond, a, b) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond, lit(a)).otherwise(lit(b))


def tasks(spark: SparkSession) -> int:
    """How many tasks make features of short rows: with a number of its own, adaptive execution doesn't merge them by their size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").repartition(tasks(spark), "c_custkey").select(
        k.alias("k"), F.floor(k / 25).alias("b"), (k % 5).cast("int").alias("r"), F.floor(k % 25 / 5).cast("int").alias("j"),
        "c_name", "c_mktsegment",
    )
    c = c.withColumns({"odd": F.col("b") % 2 == 1, "ox": F.lit(96.0) * (F.col("b") % 8), "oy": F.lit(32.0) * F.floor(F.col("b") / 8)})
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("r"), F.col("r_name").alias("state"))
    return c.join(region, "r")


def localities_nested(spark: SparkSession, sf: str) -> DataFrame:
    d = blocks(spark, sf).withColumns({
        "left": F.col("ox") + 16.0 * F.col("r"), "far": F.col("odd") & (F.col("r") == 3), "off": F.col("odd") & (F.col("r") == 0),
    })
    r, j, b, left, far, off = (F.col(c) for c in ("r", "j", "b", "left", "far", "off"))
    pick = lambda *v: F.element_at(F.array(*[F.lit(float(x)) for x in v]), j + 1)
    g = when((j < 2) & (r > 0), 0.125, 0.0)
    over = when((j == 2) & (r < 4), 0.125, 0.0)
    x0 = left + F.when(off & (j == 4), -12.0).when(far & (j == 2), 15.75).otherwise(pick(0, 0, 8, 8, 10) + g)
    x1 = left + F.when(off & (j == 4), -8.0).when(far & (j == 0), 15.75).when(far & (j == 2), 18.0).otherwise(
        pick(8, 8, 16, 16, 12) + over)
    y0 = F.col("oy") + when(off & (j == 4), 0.0, pick(0, 8, 0, 8, 10))
    y1 = F.col("oy") + when(off & (j == 4), 4.0, pick(8, 16, 8, 15.75, 12))
    code = F.concat(r.cast("string"), F.lpad((b % 100).cast("string"), 2, "0"))
    postcode = (
        F.when((j == 0) & (r == 4), F.lit("NA")).when(j < 2, F.concat(F.lit("1"), code))
        .when((j == 3) & (b % 3 != 1), F.concat(F.lit("2"), code)).when((j == 4) & (b % 3 != 0), F.concat(F.lit("3"), code))
    )
    # computed once: inlined into every vertex they would outgrow generated code
    corners = G.once(d.withColumn("postcode", postcode), "_c", F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))
    d = corners.select("*", "_c.*").drop("_c")
    hx, hy = left + 10.0, F.col("oy") + 10.0
    shell = N.box_ring("x0", "y0", "x1", "y1")
    hole = N.box_ring(hx, hy, hx + 2.0, hy + 2.0)
    part = F.when((j == 3) & ~off, F.array(shell, hole)).otherwise(F.array(shell))
    return d.select(
        "k", "b", "r", "j", F.concat(F.lit("loc"), F.lpad(F.col("k").cast("string"), 10, "0")).alias("locality_pid"),
        F.col("c_name").alias("locality_name"), "postcode", "state",
        F.col("c_mktsegment").alias("locality_class"), (F.col("k") % 97).cast("int").alias("address_count"),
        (F.col("k") % 13).cast("int").alias("street_count"), F.array(part).alias("nested"), "x0", "y0", "x1", "y1",
    )


def localities(spark: SparkSession, sf: str) -> DataFrame:
    enable(spark)
    return localities_nested(spark, sf).withColumn("geom", G.encode("nested")).drop("nested")


def boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """The locality layer with exactly the input columns of a cleaning run."""
    return localities(spark, sf).drop("k", "b", "r", "j", "x0", "y0", "x1", "y1")


def areas_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Census areas: five per state, the first with a hole."""
    d = blocks(spark, sf).withColumns({"left": F.col("ox") + 16.0 * F.col("r"), "off": F.col("odd") & (F.col("r") == 0)})
    j, off, left, oy = (F.col(c) for c in ("j", "off", "left", "oy"))
    x0 = left + F.when(j < 3, 4.0 * j).when(j == 3, 12.0).otherwise(when(off, -11.0, 14.0))
    x1 = left + F.when(j < 3, 4.0 * j + 4.0).when(j == 3, when(off, 16.0, 14.0)).otherwise(when(off, -8.0, 16.0))
    y1 = oy + when((j == 4) & off, 4.0, 16.0)
    d = d.withColumns({"x0": x0, "x1": x1, "y1": y1})
    shell = N.box_ring("x0", oy, "x1", "y1")
    hole = N.box_ring(left + 1.0, oy + 1.0, left + 2.0, oy + 2.0)
    part = F.when(j == 0, F.array(shell, hole)).otherwise(F.array(shell))
    return d.select("k", "b", "r", "j", "state", F.array(part).alias("nested"))


def areas(spark: SparkSession, sf: str) -> DataFrame:
    enable(spark)
    return areas_nested(spark, sf).withColumn("geom", G.encode("nested")).drop("nested")


def state_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Ready-made state polygons, for queries whose subject is not the dissolve: ``state_gid, state, geom``."""
    enable(spark)
    d = blocks(spark, sf).where((F.col("j") == 0) | ((F.col("j") == 4) & F.col("odd") & (F.col("r") == 0)))
    left, oy = F.col("ox") + 16.0 * F.col("r"), F.col("oy")
    island = F.col("j") == 4
    return d.select(
        F.col("k").alias("state_gid"), "state",
        G.box(left + when(island, -11.0, 0.0), oy, left + when(island, -8.0, 16.0), oy + when(island, 4.0, 16.0)).alias("geom"),
    )


def corridor_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Ready-made corridors, two per state border: ``zone_id, state, geom``."""
    enable(spark)
    d = blocks(spark, sf).where((F.col("j") < 2) & ~((F.col("j") == 0) & (F.col("r") == 0)) & ~((F.col("j") == 1) & (F.col("r") == 4)))
    left = F.col("ox") + 16.0 * F.col("r") + when(F.col("j") == 0, 0.0, 15.5)
    return d.select(F.col("k").alias("zone_id"), "state", G.box(left, F.col("oy"), left + 0.5, F.col("oy") + 16.0).alias("geom"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """One point per order, in its customer's block, never on an edge: ``pt, b, x, y``."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey").repartition(tasks(spark), "o_orderkey").select(F.col("o_orderkey").alias("pt"), F.floor(F.col("o_custkey") / 25).alias("b"))
    return o.select(
        "pt", "b", ((F.col("pt") * 37) % 5120 / 64 + 1 / 128 + 96.0 * (F.col("b") % 8)).alias("x"),
        ((F.col("pt") * 101) % 1024 / 64 + 1 / 128 + 32.0 * F.floor(F.col("b") / 8)).alias("y"),
    )


def cells_nested(spark: SparkSession, sf: str) -> DataFrame:
    """One unit square per order on a grid 512 wide, owned by the order's priority: few, very large groups."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").repartition(tasks(spark), "o_orderkey").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("owner"))
    x, y = (F.col("cell_id") % 512).cast("double"), F.floor(F.col("cell_id") / 512).cast("double")
    return o.select("cell_id", "owner", F.array(F.array(N.box_ring(x, y, x + 1.0, y + 1.0))).alias("nested"))


def brand_cells_nested(spark: SparkSession, sf: str, saws: bool = False) -> DataFrame:
    """One unit square per part on a grid 32 wide, owned by its brand; ``saws``: with zigzag sides."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand").repartition(tasks(spark), "p_partkey").select(F.col("p_partkey").alias("cell_id"), F.col("p_brand").alias("owner"))
    x, y = (F.col("cell_id") % 32).cast("double"), F.floor(F.col("cell_id") / 32).cast("double")
    return p.select("cell_id", "owner", F.array(F.array(zigzag(x, y, x + 1.0, y + 1.0) if saws else N.box_ring(x, y, x + 1.0, y + 1.0))).alias("nested"))


def zigzag(x0, y0, x1, y1, depth: float = 1 / 64):
    """Ring of a box whose left and right sides are saws of four strokes; neighbours side by side share them exactly."""
    h = (y1 - y0) / 4
    teeth = [(0.0, 0), (depth, 1), (0.0, 2), (depth, 3), (0.0, 4)]
    right = [(x1 + a, y0 + h * i) for a, i in teeth]
    return N.ring([*right, *[(x0 + a, y0 + h * i) for a, i in reversed(teeth)]])


def zigzag_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """One box of 16 by 16 per customer on a grid 32 wide, with saws for sides: ``k, geom``."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).repartition(tasks(spark), "k")
    x, y = 16.0 * (F.col("k") % 32), 16.0 * F.floor(F.col("k") / 32)
    return c.select("k", G.encode(F.array(F.array(zigzag(x, y, x + 16.0, y + 16.0)))).alias("geom"))


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    """One point per event: ``user_id, ts, event_id, x, y``."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    return e.withColumns({"x": (F.col("event_id") % 257).cast("double"), "y": (F.col("event_id") % 127).cast("double")})


def lonlat(spark: SparkSession, sf: str) -> DataFrame:
    """One small box per customer in longitude and latitude: ``k, lon, lat, side``."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).repartition(tasks(spark), "k")
    return c.select(
        "k", (F.lit(114.0) + (F.col("k") * 37 % 2560) / 64).alias("lon"), (F.lit(-43.0) + (F.col("k") * 53 % 2048) / 64).alias("lat"),
        when(F.col("k") % 3 == 0, 0.5 ** 18, 0.0078125).alias("side"),
    )


def stages(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Every table of one cleaning run; run once per session and folder, its stages are checkpointed."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STAGES:
        _STAGES[key] = clean(boundaries(spark, sf), areas(spark, sf), cfg=CFG)
    return _STAGES[key]


# ---- the same layers as SQL text ----

BLOCKS = """w AS (
  SELECT c_custkey AS k, c_name, c_mktsegment, c_custkey // 25 AS b, c_custkey % 5 AS r, (c_custkey % 25) // 5 AS j,
         (c_custkey // 25) % 2 = 1 AS odd, 96.0::DOUBLE * ((c_custkey // 25) % 8) AS ox,
         32.0::DOUBLE * ((c_custkey // 25) // 8) AS oy, r_name AS state,
         96.0::DOUBLE * ((c_custkey // 25) % 8) + 16 * (c_custkey % 5) AS lx
  FROM customer JOIN region ON r_regionkey = c_custkey % 5)"""

LOC = BLOCKS + """, loc AS (
  SELECT k, b, r, j, state, odd, 'loc' || lpad(k::VARCHAR, 10, '0') AS locality_pid, c_name AS locality_name,
         CASE WHEN j = 0 AND r = 4 THEN 'NA' WHEN j < 2 THEN '1' || r || lpad((b % 100)::VARCHAR, 2, '0')
              WHEN j = 3 AND b % 3 <> 1 THEN '2' || r || lpad((b % 100)::VARCHAR, 2, '0')
              WHEN j = 4 AND b % 3 <> 0 THEN '3' || r || lpad((b % 100)::VARCHAR, 2, '0') END AS postcode,
         c_mktsegment AS locality_class, (k % 97)::INT AS address_count, (k % 13)::INT AS street_count,
         lx + CASE WHEN j < 2 THEN CASE WHEN r > 0 THEN 0.125 ELSE 0 END
                   WHEN j = 2 THEN CASE WHEN odd AND r = 3 THEN 15.75 ELSE 8 END WHEN j = 3 THEN 8
                   ELSE CASE WHEN odd AND r = 0 THEN -12 ELSE 10 END END AS x0,
         lx + CASE WHEN j = 0 THEN CASE WHEN odd AND r = 3 THEN 15.75 ELSE 8 END WHEN j = 1 THEN 8
                   WHEN j = 2 THEN CASE WHEN odd AND r = 3 THEN 18 WHEN r < 4 THEN 16.125 ELSE 16 END
                   WHEN j = 3 THEN 16 ELSE CASE WHEN odd AND r = 0 THEN -8 ELSE 12 END END AS x1,
         oy + CASE WHEN j IN (1, 3) THEN 8 WHEN j = 4 AND NOT (odd AND r = 0) THEN 10 ELSE 0 END AS y0,
         oy + CASE WHEN j IN (0, 2) THEN 8 WHEN j = 1 THEN 16 WHEN j = 3 THEN 15.75
                   ELSE CASE WHEN odd AND r = 0 THEN 4 ELSE 12 END END AS y1,
         j = 3 AND NOT (odd AND r = 0) AS holed, lx + 10 AS hx0, oy + 10 AS hy0, lx + 12 AS hx1, oy + 12 AS hy1
  FROM w)"""

AREAS = BLOCKS + """, area AS (
  SELECT k, b, r, j, state,
         lx + CASE WHEN j < 3 THEN 4 * j WHEN j = 3 THEN 12 ELSE CASE WHEN odd AND r = 0 THEN -11 ELSE 14 END END AS x0, oy AS y0,
         lx + CASE WHEN j < 3 THEN 4 * j + 4 WHEN j = 3 THEN CASE WHEN odd AND r = 0 THEN 16 ELSE 14 END
                   ELSE CASE WHEN odd AND r = 0 THEN -8 ELSE 16 END END AS x1,
         oy + CASE WHEN j = 4 AND odd AND r = 0 THEN 4 ELSE 16 END AS y1
  FROM w)"""

STATES = """, st AS (
  SELECT k AS state_gid, state, b, r, lx + CASE WHEN j = 4 THEN -11 ELSE 0 END AS sx0, oy AS sy0,
         lx + CASE WHEN j = 4 THEN -8 ELSE 16 END AS sx1, oy + CASE WHEN j = 4 THEN 4 ELSE 16 END AS sy1
  FROM w WHERE j = 0 OR (j = 4 AND odd AND r = 0))"""

ZONES = """, zn AS (
  SELECT k AS zone_id, state, b, r, lx + CASE WHEN j = 0 THEN 0 ELSE 15.5 END AS zx0, oy AS zy0,
         lx + CASE WHEN j = 0 THEN 0.5 ELSE 16 END AS zx1, oy + 16 AS zy1
  FROM w WHERE j < 2 AND NOT (j = 0 AND r = 0) AND NOT (j = 1 AND r = 4))"""

POINTS = """pts AS (
  SELECT o_orderkey AS pt, o_custkey // 25 AS b, (o_orderkey * 37 % 5120) / 64.0::DOUBLE + 1 / 128.0::DOUBLE + 96 * ((o_custkey // 25) % 8) AS x,
         (o_orderkey * 101 % 1024) / 64.0::DOUBLE + 1 / 128.0::DOUBLE + 32 * ((o_custkey // 25) // 8) AS y
  FROM orders)"""

CELLS = """cells AS (
  SELECT o_orderkey AS cell_id, o_orderpriority AS owner, (o_orderkey % 512)::DOUBLE AS cx, (o_orderkey // 512)::DOUBLE AS cy
  FROM orders)"""

TRACKS = """tr AS (SELECT user_id, ts, event_id, (event_id % 257)::DOUBLE AS x, (event_id % 127)::DOUBLE AS y FROM events)"""

LONLAT = """ll AS (
  SELECT c_custkey AS k, 114 + (c_custkey * 37 % 2560) / 64.0::DOUBLE AS lon, -43 + (c_custkey * 53 % 2048) / 64.0::DOUBLE AS lat,
         CASE WHEN c_custkey % 3 = 0 THEN pow(0.5::DOUBLE, 18) ELSE 0.0078125::DOUBLE END AS side
  FROM customer)"""

#: area of a locality box less its hole, and of its overlap with box (a, b, c, d)
LOC_AREA = "((x1 - x0) * (y1 - y0) - CASE WHEN holed THEN 4 ELSE 0 END)"


def overlap(a: str, b: str, c: str, d: str, x0="x0", y0="y0", x1="x1", y1="y1") -> str:
    return (
        f"(greatest(0, least({x1}, {c}) - greatest({x0}, {a})) * greatest(0, least({y1}, {d}) - greatest({y0}, {b})))"
    )


#: settled area of every locality after cleaning; NULL when nothing is left of it
FINAL = LOC + """, fin AS (
  SELECT *, CASE WHEN j = 2 AND odd AND r = 3 THEN NULL WHEN j = 0 AND odd AND r = 3 THEN 128 WHEN j < 3 THEN 64
                 WHEN j = 3 THEN 62 - CASE WHEN holed THEN 4 ELSE 0 END + CASE WHEN r < 4 THEN 0.125 ELSE 0 END
                 WHEN odd AND r = 0 THEN 12 ELSE 4 END::DOUBLE AS final_area
  FROM loc)"""
