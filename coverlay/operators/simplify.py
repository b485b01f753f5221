"""Simplification that keeps neighbours joined: every shared border is simplified once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.functions import zoom as Z
from coverlay.kernel import enable
from coverlay.operators.adjacency import canonical_edges
from coverlay.operators.grid import spatial_join
from coverlay.operators.lines import chain_lines, label_chains, node_edges
from coverlay.operators.stage import cut


def _restore_crossings(lines: DataFrame, cell: float) -> DataFrame:
    """Give chains back their own vertices where simplified ones meet away from their ends, until none do."""
    lines = cut(lines.withColumn("kept", F.lit(False)))
    while True:
        a = lines.select("chain", "geom", "kept")
        b = lines.select(F.col("chain").alias("chain2"), F.col("geom").alias("geom2"))
        meets = spatial_join(a, b, G.meets_inside, cell, where=F.col("chain") != F.col("chain2"))
        bad = cut(meets.where(~F.col("kept")).select("chain").distinct())
        if bad.isEmpty():
            return lines.drop("kept", "original")
        flagged = lines.join(bad.withColumn("_bad", F.lit(True)), "chain", "left")
        hit = F.coalesce("_bad", F.lit(False))
        lines = cut(flagged.select(
            "chain", F.when(hit, F.col("original")).otherwise(F.col("geom")).alias("geom"), "original",
            (F.col("kept") | hit).alias("kept"),
        ))


def simplify_coverage(
    df: DataFrame, id_col: str, tolerance: float, cell: float, geom: str = "geom", overlap: float = 0.5,
    snap: float = 0.0,
) -> DataFrame:
    """Simplify a layer of areas so that common borders stay common: ``id_col, geom``.

    Outlines become distinct edges, edges become chains between junctions, each chain is simplified once, and
    every feature is rebuilt from its own chains. A rebuilt face belongs to its feature when more than
    ``overlap`` of it lies inside the original, which also leaves holes out. Groups are as large as one
    polygon's own outline, never larger. ``snap`` is how far a neighbour's
    vertex may be from an edge and still count as lying on it.
    """
    enable(df.sparkSession)
    # polygons, not features: a feature of many islands never meets all of them at once
    layer = df.select(F.col(id_col).alias("_id"), F.posexplode(G.polygons(geom)).alias("_poly", "geom"))
    key = ["_id", "_poly"]
    nested = layer.select(*key, G.decode("geom").alias("_n"))
    seg = N.to_segments(nested, "_n", key).drop("part", "ring", "seq")
    own = cut(node_edges(seg, cell, key, tolerance=snap))
    labelled = cut(label_chains(own.drop(*key).distinct()))
    paths = chain_lines(labelled).withColumn("original", G.line("path"))
    thin = paths.select("chain", G.simplify_topology("original", tolerance).alias("geom"), "original")
    lines = _restore_crossings(thin, cell)
    chain_of = canonical_edges(labelled, ["chain"])
    member = own.join(chain_of, ["x1", "y1", "x2", "y2"]).select(*key, "chain").distinct()
    outline = member.join(lines, "chain").groupBy(*key).agg(F.collect_list("geom").alias("_lines"))
    faces = outline.join(layer, key).select("_id", F.explode(G.faces_inside("_lines", "geom", overlap)).alias("face"))
    return faces.groupBy("_id").agg(G.collect_agg("face").alias("geom")).withColumnRenamed("_id", id_col)


def thin_by_zoom(df: DataFrame, zooms: list[int], keep: list[str], geom: str = "geom") -> DataFrame:
    """One row per feature and zoom level, thinned with that level's area tolerance and repaired."""
    enable(df.sparkSession)
    rows = df.select(*keep, geom, F.explode(F.array(*[F.lit(z) for z in zooms])).alias("zoom"))
    return rows.withColumn(geom, G.make_valid(G.simplify_vw(geom, Z.tolerance("zoom")))).select(*keep, "zoom", geom)
