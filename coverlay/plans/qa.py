"""Quality reports on a finished layer, and comparisons between layers and releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.kernel import enable
from coverlay.operators.attributes import lead_over_all
from coverlay.sources.writers import nested_geometry

def _report(df: DataFrame) -> DataFrame:
    return df.select(
        "locality_pid", "locality_name", F.coalesce("postcode", F.lit("")).alias("postcode"), "state", "address_count",
        "street_count",
    )


def dropped_features(bdys: DataFrame, display: DataFrame) -> DataFrame:
    """Localities that did not make it into the display layer; sorted on the raw postcode, NULLs last."""
    lost = bdys.join(display.select("locality_pid"), "locality_pid", "left_anti")
    order = [F.col(c).asc_nulls_last() for c in ("state", "locality_name", "postcode")]
    return _report(lost.orderBy(*order))


def invalid_features(display: DataFrame) -> DataFrame:
    enable(display.sparkSession)
    return _report(display.where(~G.is_valid("geom")))


def empty_features(display: DataFrame) -> DataFrame:
    enable(display.sparkSession)
    return _report(display.where(G.is_empty("geom")))


def _rounded_vertices(df: DataFrame, key: str) -> DataFrame:
    v = N.to_vertices(nested_geometry(df.select(key, "geom")), "nested", [key], last="max_seq")
    return v.select(
        key, "part", "ring", "seq", "max_seq", F.col("y").cast("decimal(7,5)").alias("latitude"),
        F.col("x").cast("decimal(8,5)").alias("longitude"),
    )


def duplicate_vertices(df: DataFrame, key: str = "locality_pid", by_part: bool = True) -> DataFrame:
    """Coordinates that occur more than once inside a ring, its first and last vertex left out.

    ``by_part=False`` numbers rings without regard to the part they belong to, so rings of different parts of
    one multipolygon are checked together.
    """
    scope = [key, "part", "ring"] if by_part else [key, "ring"]
    v = _rounded_vertices(df, key)
    if not by_part:
        v = v.withColumn("max_seq", F.max("seq").over(W.partitionBy(*scope)))
    inner = v.where((F.col("seq") > 1) & (F.col("seq") < F.col("max_seq")))
    return inner.groupBy(*scope, "longitude", "latitude").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def vertex_positions(df: DataFrame, longitude: Column, latitude: Column, key: str = "locality_pid") -> DataFrame:
    """Where a coordinate occurs: part, ring and sequence number."""
    return _rounded_vertices(df, key).drop("max_seq").where(
        (F.col("longitude") == longitude) & (F.col("latitude") == latitude)
    )


def vertex_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Vertex totals of two layers and the reduction in per cent: one row, one pass over each layer."""
    enable(before.sparkSession)
    both = before.select(G.num_points("geom").alias("a"), F.lit(0).alias("b")).unionByName(
        after.select(F.lit(0).alias("a"), G.num_points("geom").alias("b"))
    )
    return both.agg(F.sum("a").alias("before"), F.sum("b").alias("after")).select(
        "before", "after", F.round((1 - F.col("after") / F.col("before")) * 100, 3).alias("reduction_pct")
    )


def release_changes(old: DataFrame, new: DataFrame, key: str = "locality_pid") -> DataFrame:
    """Keys that one release has and the other lacks."""
    added = new.select(key).join(old.select(key), key, "left_anti").withColumn("change", F.lit("new"))
    lost = old.select(key).join(new.select(key), key, "left_anti").withColumn("change", F.lit("lost"))
    return added.unionByName(lost)


def postcode_path(postcodes: DataFrame) -> DataFrame:
    """Line from each postcode's centre to the next postcode's: ``postcode, next_postcode, path``."""
    enable(postcodes.sparkSession)
    # the centre of a collection is the area-weighted mean of its members' centres: sums, never one geometry
    each = postcodes.where(F.col("postcode").isNotNull()).select("postcode", G.area("geom").alias("a"), G.centroid("geom").alias("c"))
    sums = each.groupBy("postcode").agg(
        F.sum("a").alias("a"), F.sum(F.col("a") * F.col("c.x")).alias("mx"), F.sum(F.col("a") * F.col("c.y")).alias("my")
    )
    pts = sums.select("postcode", N.xy(F.col("mx") / F.col("a"), F.col("my") / F.col("a")).alias("centre"))
    led = lead_over_all(pts, ["postcode"], ["postcode", "centre"])
    return led.select(
        "postcode", F.col("next.postcode").alias("next_postcode"), N.make_line("centre", F.col("next.centre")).alias("path")
    )


class ContractError(ValueError):
    """A finished layer breaks a promise of its table definition."""


def check_contract(
    df: DataFrame, key: list[str], not_null: list[str], kinds: set[str] | None = None, srids: set[int] | None = None
) -> DataFrame:
    """Fail unless keys are unique, columns filled, and geometry kinds (and SRIDs) are the allowed ones."""
    if kinds:
        enable(df.sparkSession)
    checks = [F.sum(F.col(c).isNull().cast("int")).alias(f"null {c}") for c in not_null]
    if kinds:
        checks.append(F.sum((~G.kind("geom").isin(*kinds)).cast("int")).alias("geometry kind"))
    if srids:
        checks.append(F.sum((~F.col("srid").isin(*srids)).cast("int")).alias("srid"))
    bad = {k: v for k, v in df.agg(*checks).first().asDict().items() if v}
    twice = df.groupBy(*key).count().where(F.col("count") > 1).limit(5).collect()
    if twice:
        bad["duplicate keys"] = [tuple(r)[:-1] for r in twice]
    if bad:
        raise ContractError(str(bad))
    return df
