"""Display products: attribute + WKB tables, GeoJSON features, delimited text, box lists."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.kernel import enable
from coverlay.operators.grid import cell_key, with_bounds


def shape_columns(display: DataFrame) -> DataFrame:
    """Export projection with names of at most ten characters and no NULL postcodes."""
    return display.select(
        "gid",
        F.col("locality_pid").alias("loc_pid"),
        F.col("locality_name").alias("name"),
        F.coalesce("postcode", F.lit("")).alias("postcode"),
        "state",
        F.col("locality_class").alias("loc_class"),
        F.col("address_count").alias("adr_count"),
        F.col("street_count").alias("str_count"),
        "geom",
    )


def coordinates_json(nested, decimals: int = 5) -> Column:
    """Coordinates of a parts → rings → points array as GeoJSON text, rounded, trailing zeros dropped."""

    def num(v):
        text = v.cast(f"decimal(30,{decimals})").cast("string")
        return F.regexp_replace(text, r"\.?0+$", "") if decimals else text

    def arr(col, f):
        return F.concat(F.lit("["), F.array_join(F.transform(col, f), ","), F.lit("]"))

    point = lambda p: F.concat(F.lit("["), num(p["x"]), F.lit(","), num(p["y"]), F.lit("]"))
    return arr(nested, lambda part: arr(part, lambda r: arr(r, point)))


def geojson_features(display: DataFrame, decimals: int = 5, extra: list[str] = ()) -> DataFrame:
    """One GeoJSON feature per row in column ``value``: multipolygons, no box, no coordinate-system member."""
    enable(display.sparkSession)
    props = [
        "gid", "locality_pid", "locality_name", F.coalesce("postcode", F.lit("")).alias("postcode"), "state",
        "locality_class", "address_count", "street_count",
    ]
    d = display.select(*extra, F.to_json(F.struct(*props)).alias("_p"), G.decode("geom").alias("_n"))
    return d.select(*extra, F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":'),
        coordinates_json(F.col("_n"), decimals), F.lit('},"properties":'), F.col("_p"), F.lit("}"),
    ).alias("value"))


def write_geojson(display: DataFrame, path: str) -> None:
    """Newline-delimited features, written in parallel."""
    geojson_features(display).write.mode("overwrite").option("compression", "gzip").text(path)


def document_rows(items: DataFrame, order: str, head: str, tail: str) -> DataFrame:
    """Rows ``value`` whose text, in order, is one JSON document: ``head``, items with commas between, ``tail``.

    ``items`` has a unique ``order`` column and a JSON text column ``value``. Only the smallest order value
    passes through the driver; the rows stay range partitioned, so part files concatenated in name order
    (``cat part-*``) are the document and no task ever sees all of it.
    """
    first = items.agg(F.min(order)).first()[0]
    comma = F.when(F.col(order) == F.lit(first), F.lit("")).otherwise(F.lit(","))
    kind = items.schema[order].dataType
    body = items.select(F.lit(1).alias("_s"), F.col(order).alias("_o"), F.concat(comma, "value").alias("value"))
    spark = items.sparkSession
    edges = spark.createDataFrame([(0, head), (2, tail)], "_s int, value string")
    edges = edges.withColumn("_o", F.lit(None).cast(kind)).select("_s", "_o", "value")
    return body.unionByName(edges).orderBy("_s", "_o").select("value")


def write_geojson_document(display: DataFrame, path: str, decimals: int = 5) -> None:
    """The whole layer as one FeatureCollection, spread over ordered part files."""
    features = geojson_features(display.select("*", F.col("gid").alias("_gid")), decimals, extra=["_gid"])
    rows = document_rows(features, "_gid", '{"type":"FeatureCollection","features":[', "]}")
    rows.write.mode("overwrite").text(path)


def write_delimited(display: DataFrame, path: str) -> None:
    """Pipe-delimited attributes and hex WKB, gzip compressed."""
    delimited_columns(display).write.mode("overwrite").option("sep", "|").option("compression", "gzip").csv(path)


def delimited_columns(display: DataFrame) -> DataFrame:
    return display.select("locality_pid", "locality_name", "postcode", "state", F.hex("geom").alias("geom"))


def external_table_ddl(name: str, path: str) -> str:
    """Definition of a table over :func:`write_delimited` output.

    ``geom`` is declared binary, as its consumers read it; the bytes of the file are the WKB in hex digits.
    """
    quoted = path.replace("'", "''")
    return (
        f"CREATE TABLE {name} (locality_pid STRING, locality_name STRING, postcode STRING, state STRING, geom BINARY) "
        f"USING csv OPTIONS (path '{quoted}', sep '|')"
    )


def box_objects(df: DataFrame, key: str = "locality_pid") -> DataFrame:
    """One JSON object ``{id, l, b, r, t}`` per feature, edges to four decimals."""
    b = with_bounds(df.select(key, "geom"))
    edge = lambda c, p: F.col(c).cast(f"decimal({p},4)")
    return b.select(F.col(key), F.to_json(F.struct(
        F.col(key).alias("id"), edge("xmin", 7).alias("l"), edge("ymin", 6).alias("b"),
        edge("xmax", 7).alias("r"), edge("ymax", 6).alias("t"),
    )).alias("value"))


def write_boxes(df: DataFrame, path: str, key: str = "locality_pid") -> None:
    """All box objects as one JSON array, spread over ordered part files."""
    document_rows(box_objects(df, key), key, "[", "]").write.mode("overwrite").text(path)


def box_arrays(df: DataFrame, page: Column, key: str = "locality_pid") -> DataFrame:
    """Box objects gathered into one sorted JSON array per page; ``page`` should bound the rows it groups."""
    b = with_bounds(df.select(page.alias("page"), key, "geom"))
    edge = lambda c, p: F.col(c).cast(f"decimal({p},4)")
    obj = F.struct(F.col(key).alias("id"), edge("xmin", 7).alias("l"), edge("ymin", 6).alias("b"),
                   edge("xmax", 7).alias("r"), edge("ymax", 6).alias("t"))
    return b.groupBy("page").agg(F.to_json(F.sort_array(F.collect_list(obj))).alias("boxes"))


def write_clustered(df: DataFrame, path: str, cell: float, partitions: int | None = None) -> None:
    """Parquet sorted by the Z-order key of each feature's cell, with box columns, for box reads."""
    b = clustered(df, cell)
    # the content hash lets a crowded cell spread over several partitions
    order = [F.col("cell_key"), F.xxhash64(*df.columns)]
    ranged = b.repartitionByRange(partitions, *order) if partitions else b.repartitionByRange(*order)
    ranged.sortWithinPartitions("cell_key").write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, cell: float) -> DataFrame:
    b = with_bounds(df)
    mid = lambda lo, hi: (F.col(lo) + F.col(hi)) / 2
    return b.withColumn("cell_key", cell_key(mid("xmin", "xmax"), mid("ymin", "ymax"), cell))


def release_path(base: str, release: str, srid: int) -> str:
    """Versioned output location: one folder per release and coordinate system."""
    return f"{base.rstrip('/')}/release={release}/srid={srid}"


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def switch_table(df: DataFrame, name: str, base: str) -> str:
    """Replace the table ``name`` while it is being read; returns the folder of the new version below ``base``.

    The rows are written to a folder of their own first, and one statement then points the catalog's view ``name`` to it:
    readers see the old rows or the new ones, never half of either. A read begun before keeps its files, since no version
    is deleted here; a write that fails leaves the table as it was. ``df`` may read ``name`` itself, and columns may change.
    """
    spark = df.sparkSession
    folder = f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return folder


def nested_geometry(df: DataFrame, geom: str = "geom", out: str = "nested") -> DataFrame:
    """Add the array form of a geometry column."""
    enable(df.sparkSession)
    return df.withColumn(out, G.decode(geom))


def vertices(df: DataFrame, key: str = "locality_pid") -> DataFrame:
    """Vertex table: part, ring and sequence numbers with six-decimal longitude and latitude."""
    v = N.to_vertices(nested_geometry(df.select(key, "geom")), "nested", [key])
    return v.select(
        key, F.col("part").cast("smallint").alias("polygon_num"), F.col("ring").cast("smallint").alias("ring_num"),
        F.col("seq").alias("point_num"), F.col("x").cast("decimal(9,6)").alias("longitude"),
        F.col("y").cast("decimal(8,6)").alias("latitude"),
    )
