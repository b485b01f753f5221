"""GeoJSON documents: one file of one FeatureCollection read by many tasks."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlay.functions import geometry as G
from coverlay.sources import readers as R
from coverlay.sources import writers as Wr

PROPS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def ring(i):
    x = float(i % 100)
    return [[x, 0.0], [x + 1, 0.0], [x + 1, float(1 + i % 7)], [x, float(1 + i % 7)], [x, 0.0]]


def document(n, order, space, nested=False):
    names = ['plain', 'a "quoted" {"type":"Feature"', "back\\slash", "two\nlines ],}", "é\U0001F600", ""]
    out = []
    for i in range(n):
        polygon = {"type": "Polygon", "coordinates": [ring(i)]} if i % 3 else {"type": "MultiPolygon", "coordinates": [[ring(i)], [ring(i + 200)]]}
        props = {"name": names[i % len(names)], "n": i, **({"inner": {"type": "Feature"}} if nested and i == 5 else {})}
        parts = {"type": "Feature", "properties": props, "geometry": polygon, "id": i}
        out.append({k: parts[k] for k in order})
    head = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:4283"}}, "features": out, "bbox": [0, 0, 1, 1]}
    return json.dumps(head, separators=(",", ":") if not space else (", ", ": "), indent=space if isinstance(space, int) and space > 1 else None)


@pytest.mark.parametrize("order, space", [(("type", "properties", "geometry", "id"), 0), (("type", "id", "geometry", "properties"), 1), (("properties", "type", "geometry", "id"), 2), (("id", "type", "properties", "geometry"), 0)])
def test_one_file_in_many_tasks(spark, tmp_path, order, space):
    """Any order of members and any white space; strings that look like features or ends of them; every feature once."""
    text = document(700, order, space)
    path = tmp_path / "layer.geojson"
    path.write_text(text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = R.read_geojson_document(spark, str(path), PROPS)
        assert df.rdd.getNumPartitions() >= 5
        got = {r.n: (r.name, r.area) for r in df.select("n", "name", G.area("geom").alias("area")).collect()}
        assert df.count() == 700
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {f["properties"]["n"]: (f["properties"]["name"], sum(1.0 + k % 7 for k in ((i,) if i % 3 else (i, i + 200)))) for i, f in enumerate(json.loads(text)["features"])}
    assert got == want


def test_written_documents_come_back(spark, tmp_path):
    rows = spark.range(300).select(
        F.col("id").alias("gid"), F.col("id").cast("string").alias("locality_pid"), F.concat(F.lit('n"\\'), "id").alias("locality_name"), F.lit("2000").alias("postcode"), F.lit("NSW").alias("state"),
        F.lit("class").alias("locality_class"), F.lit(1).alias("address_count"), F.lit(2).alias("street_count"), G.box(F.col("id").cast("double"), F.lit(0.0), F.col("id") + 1.5, F.lit(1.0)).alias("geom"),
    )
    Wr.write_geojson_document(rows.repartition(3), str(tmp_path / "out"))
    props = T.StructType([T.StructField("locality_pid", T.StringType()), T.StructField("locality_name", T.StringType())])
    back = R.read_geojson_document(spark, str(tmp_path / "out"), props)
    got = {tuple(r) for r in back.select("locality_pid", "locality_name", F.hex(G.plain_wkb("geom")).alias("g")).collect()}
    assert got == {tuple(r) for r in rows.select("locality_pid", "locality_name", F.hex(G.plain_wkb("geom")).alias("g")).collect()} and back.count() == 300


def test_broken_and_empty_documents(spark, tmp_path):
    for name, text in (("cut", document(20, ("type", "properties", "geometry", "id"), 0)[:-90]), ("inner", document(20, ("type", "properties", "geometry", "id"), 0, nested=True))):
        (tmp_path / name).write_text(text)
        with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED"):
            R.read_geojson_document(spark, str(tmp_path / name), PROPS).collect()
    (tmp_path / "none").write_text('{"type":"FeatureCollection","features":[]}')
    assert R.read_geojson_document(spark, str(tmp_path / "none"), PROPS).count() == 0
