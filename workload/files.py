"""Sources and sinks: every query writes a layer derived from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlay.functions import geometry as G
from coverlay.sources import readers as R
from coverlay.sources import writers as Wr
from workload import layers as L
from coverlay.operators.stage import store
from workload.registry import query, scratch, table
from workload.relational import _BOX, lonlat_boxes


def _display(spark, sf):
    return L.localities(spark, sf).withColumn("gid", F.col("k")).select(
        "gid", "locality_pid", "locality_name", "postcode", "state", "locality_class", "address_count", "street_count", "geom"
    )


@query("src1", f"WITH {L.LOC} SELECT state, count(*) AS n, sum({L.LOC_AREA})::DOUBLE AS area FROM loc GROUP BY 1")
def src1(spark, sf):
    path = scratch(spark, "boundaries")
    L.boundaries(spark, sf).write.mode("overwrite").parquet(path)
    d = R.read_boundaries(spark, path, ["state", "geom"])
    return d.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum(G.area("geom")).alias("area"))


@query("src2", f"WITH {L.POINTS} SELECT pt AS gid, x, y, CASE WHEN pt % 2 = 0 THEN 4283 END::INT AS srid FROM pts")
def src2(spark, sf):
    """Points as extended-WKB hex in even rows and as longitude/latitude in odd rows."""
    even = F.col("pt") % 2 == 0
    hex_ = F.concat(F.lit("0101000020BB100000"), F.substring(F.hex(G.point("x", "y")), 11, 32))
    d = L.points(spark, sf).select(
        F.col("pt").cast("int").alias("gid"), F.concat(F.lit("loc"), "pt").alias("locality_pid"), F.lit(0).alias("loc_gid"),
        F.lit(0).alias("state_gid"), F.when(~even, F.col("x")).alias("longitude"), F.when(~even, F.col("y")).alias("latitude"),
        F.when(even, hex_).alias("ewkb_hex"),
    )
    path = scratch(spark, "points")
    d.write.mode("overwrite").option("header", True).csv(path)
    p = R.read_fix_points(spark, path).select(F.col("gid").cast("bigint").alias("gid"), G.centroid("geom").alias("p"), "srid")
    return p.select("gid", "p.x", "p.y", "srid")


@query("src3", f"WITH {L.LOC} SELECT locality_pid, postcode, {L.LOC_AREA}::DOUBLE AS area FROM loc")
def src3(spark, sf):
    """Four imports into one table: a replacing one and three appending ones, from Parquet, text, GeoJSON lines and a GeoJSON document."""
    d = _display(spark, sf)
    keep = ["locality_pid", "postcode", "geom"]
    a, b, c, e = (d.where(F.col("gid") % 4 == i) for i in range(4))
    landed, text, features, document = (scratch(spark, n) for n in ("landed", "text", "features", "document"))
    R.import_files(a.select(*keep), landed)
    Wr.write_delimited(b, text)
    cols = T.StructType([T.StructField(n, T.StringType()) for n in ("locality_pid", "locality_name", "postcode", "state")] + [T.StructField("geom", T.BinaryType())])
    R.import_files(R.read_delimited_wkb(spark, text, cols).select(*keep), landed, append=True)
    Wr.write_geojson(c, features)
    props = T.StructType([T.StructField("locality_pid", T.StringType()), T.StructField("postcode", T.StringType())])
    Wr.write_geojson_document(e, document)
    for got in (R.read_geojson_lines(spark, features, props), R.read_geojson_document(spark, document, props)):
        R.import_files(got.withColumn("postcode", F.nullif("postcode", F.lit(""))).select(*keep), landed, append=True)
    return spark.read.parquet(landed).select("locality_pid", "postcode", F.round(G.area("geom"), 6).alias("area"))


@query("src4", f"WITH {L.LOC} SELECT locality_pid FROM loc WHERE x0 <= 40 AND x1 >= 4 AND y0 <= 9 AND y1 >= 3")
def src4(spark, sf):
    path = scratch(spark, "clustered")
    Wr.write_clustered(_display(spark, sf), path, 16.0)
    return R.read_box(spark, path, 4.0, 3.0, 40.0, 9.0).select("locality_pid")


@query("snk1", f"WITH {L.LOC} SELECT k AS gid, locality_pid AS loc_pid, locality_name AS name, coalesce(postcode, '') AS postcode, state, locality_class AS loc_class, address_count AS adr_count, street_count AS str_count, {L.LOC_AREA}::DOUBLE AS area FROM loc")
def snk1(spark, sf):
    path = scratch(spark, "shape")
    Wr.replace_table(Wr.shape_columns(_display(spark, sf)), path)
    return spark.read.parquet(path).withColumn("area", G.area("geom")).drop("geom")


def _ring_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    num = lambda e: f"rtrim(rtrim(printf('%.5f', {e}), '0'), '.')"
    return "'[' || " + " || ',' || ".join(f"'[' || {num(x)} || ',' || {num(y)} || ']'" for x, y in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]) + " || ']'"


_SHELL = f"'[' || {_ring_sql('x0', 'y0', 'x1', 'y1')} || CASE WHEN holed THEN ',' || {_ring_sql('hx0', 'hy0', 'hx1', 'hy1')} ELSE '' END || ']'"


@query("snk2", f"""WITH {L.LOC} SELECT '{{"type":"Feature","geometry":{{"type":"MultiPolygon","coordinates":[' || {_SHELL} || ']}},"properties":{{"gid":' || k ||
 ',"locality_pid":"' || locality_pid || '","locality_name":"' || locality_name || '","postcode":"' || coalesce(postcode, '') || '","state":"' || state ||
 '","locality_class":"' || locality_class || '","address_count":' || address_count || ',"street_count":' || street_count || '}}}}' AS value FROM loc""")
def snk2(spark, sf):
    path = scratch(spark, "geojson")
    d = L.localities(spark, sf).withColumn("gid", F.col("k"))
    Wr.write_geojson(d, path)
    return spark.read.text(path)


@query("snk3", f"WITH {L.LOC} SELECT locality_pid, locality_name, postcode, state, {L.LOC_AREA}::DOUBLE AS area FROM loc")
def snk3(spark, sf):
    path = scratch(spark, "delimited")
    Wr.write_delimited(_display(spark, sf), path)
    cols = T.StructType([T.StructField(n, T.StringType()) for n in ("locality_pid", "locality_name", "postcode", "state")] + [T.StructField("geom", T.BinaryType())])
    return R.read_delimited_wkb(spark, path, cols).withColumn("area", G.area("geom")).drop("geom")


@query("snk4", f"WITH {L.LOC} SELECT state, count(*) AS n, sum({L.LOC_AREA})::DOUBLE AS area FROM loc GROUP BY 1")
def snk4(spark, sf):
    """A table definition over the delimited export."""
    path = scratch(spark, "external")
    Wr.write_delimited(_display(spark, sf), path)
    name = "ext_" + path.split("/")[-2].replace("-", "_")
    spark.sql(Wr.external_table_ddl(name, path))
    try:
        out = spark.table(name).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum(G.area(F.unhex(F.col("geom").cast("string")))).alias("area"))
        return store(out, "external")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("snk5", f"WITH {L.LONLAT} SELECT k, {_BOX} AS value FROM ll")
def snk5(spark, sf):
    """All boxes as one JSON array in ordered part files; the lines are read back and taken apart again."""
    path = scratch(spark, "boxes")
    Wr.write_boxes(lonlat_boxes(spark, sf).withColumn("locality_pid", F.concat(F.lit("c"), "k")), path)
    lines = spark.read.text(path).where(~F.col("value").isin("[", "]"))
    text = F.ltrim("value", F.lit(","))
    return lines.select(F.get_json_object(text, "$.id").substr(2, 20).cast("bigint").alias("k"), text.alias("value"))


@query("snk6", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 1")
def snk6(spark, sf):
    path = scratch(spark, "result")
    o = table(spark, sf, "orders").select("o_orderkey")
    Wr.replace_table(o.where(F.col("o_orderkey") % 2 == 0), path)
    Wr.replace_table(o.where(F.col("o_orderkey") % 2 == 1), path)
    return spark.read.parquet(path)


@query("snk6_switch", """SELECT o_orderkey, 'old' AS version FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 2 = 1 UNION ALL SELECT o_orderkey + 1000000000, 'new' FROM orders WHERE o_orderkey % 2 = 0""")
def snk6_switch(spark, sf):
    """A table replaced while it is read, by rows derived from itself: the read begun before ends with the old rows."""
    base = scratch(spark, "switched")
    name = f"result_{base.split('/')[-2].replace('-', '_')}"
    o = table(spark, sf, "orders").select("o_orderkey")
    Wr.switch_table(o.where(F.col("o_orderkey") % 2 == 0), name, base)
    begun = spark.table(name)
    renewed = spark.table(name).select(F.col("o_orderkey") + 1000000000).union(o.where(F.col("o_orderkey") % 2 == 1)).toDF("o_orderkey")
    Wr.switch_table(renewed, name, base)
    now = spark.table(name)
    spark.sql(f"DROP VIEW {name}")
    return begun.withColumn("version", F.lit("old")).union(now.withColumn("version", F.lit("new")))


@query("snk7", f"WITH {L.LOC} SELECT locality_pid, CASE WHEN k % 2 = 0 THEN 202602 ELSE 202605 END::INT AS release, 7844::INT AS srid FROM loc")
def snk7(spark, sf):
    base = scratch(spark, "versions")
    d = _display(spark, sf)
    for i, release in enumerate(("202602", "202605")):
        Wr.replace_table(d.where(F.col("gid") % 2 == i), Wr.release_path(base, release, 7844))
    return spark.read.parquet(base).select("locality_pid", "release", "srid")
