"""Display layers: full resolution, thinned, and postcodes derived from localities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.operators.dissolve import collect, dissolve_local, dissolve_parts
from coverlay.operators.grid import spatial_join
from coverlay.operators.spread import number_rows
from coverlay.operators.stage import cut
from coverlay.plans.config import CleanConfig
from coverlay.plans.split import SPLIT

ATTRIBUTES = ["locality_pid", "locality_name", "postcode", "state", "locality_class", "address_count", "street_count"]


def full_resolution(pieces: DataFrame, bdys: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Settled pieces united per locality, slivers opened away: ``locality_pid, locality_name, postcode, state, geom, area``.

    ``area`` is declared and left empty, as consumers of the layer expect. Attributes join without geometry.
    """
    # buffers cost much CPU per byte: a number of tasks of its own, so adaptive execution doesn't merge them by their size
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.where(F.col("match_type") != SPLIT).select("locality_pid", "geom").repartition(tasks, "locality_pid")
    kept = dealt.withColumn("geom", G.make_valid("geom"))
    united = dissolve_local(kept, ["locality_pid"])
    opened = G.make_valid(G.open_close("geom", *cfg.final_open))
    parts = united.select("locality_pid", F.explode(G.polygons(opened)).alias("geom"))
    whole = dissolve_local(parts, ["locality_pid"])
    names = bdys.select("locality_pid", "locality_name", "postcode", "state")
    return whole.join(names, "locality_pid").select(
        "locality_pid", "locality_name", "postcode", "state", G.multi("geom").alias("geom"), F.lit(None).cast("decimal(20,3)").alias("area")
    )


def thinned(geom, cfg: CleanConfig) -> Column:
    return G.make_valid(G.snap_to_grid(G.simplify_vw(geom, cfg.thin_tolerance), cfg.snap_size))


def display_localities(full: DataFrame, bdys: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Thinned localities with all attributes: ``gid`` and the attribute columns, ``geom``."""
    parts = full.select("locality_pid", F.explode(G.polygons(thinned("geom", cfg))).alias("geom"))
    whole = dissolve_local(parts, ["locality_pid"])
    return number_rows(bdys.select(*ATTRIBUTES).join(whole, "locality_pid").select(*ATTRIBUTES, G.multi("geom").alias("geom")), "gid")


def _filled(df: DataFrame, keys: list[str], cfg: CleanConfig) -> DataFrame:
    grown = df.select(*keys, G.make_valid(G.buffer("geom", cfg.postcode_grow)).alias("geom"))
    return dissolve_parts(cut(grown), keys).withColumn("geom", G.fill_holes(G.make_valid("geom")))


def cut_out(df: DataFrame, key: str, masks: DataFrame, cfg: CleanConfig, on: list[str] = ()) -> DataFrame:
    """Subtract from every area the masks that meet it (and agree on ``on``); areas without a mask are unchanged."""
    m = masks.select(*on, F.col("geom").alias("geom2"))
    near = spatial_join(df.select(key, *on, "geom"), m, G.intersects, cfg.cell, on=on, refine_above=cfg.hot_cell, left_id=key)
    hole = near.groupBy(key).agg(G.union_agg(G.near_part("geom2", "geom")).alias("_mask"))
    left = df.join(hole, key, "left")
    return left.withColumn(
        "geom", F.when(F.col("_mask").isNotNull(), G.difference("geom", "_mask")).otherwise(F.col("geom"))
    ).drop("_mask")


def coded(cfg: CleanConfig, postcode: str = "postcode") -> Column:
    return F.col(postcode).isNotNull() & ~F.col(postcode).isin(*cfg.no_postcode)


def uncoded(cfg: CleanConfig, postcode: str = "postcode") -> Column:
    return F.col(postcode).isNull() | F.col(postcode).isin(*cfg.no_postcode)


def postcode_areas(display: DataFrame, cfg: CleanConfig) -> tuple[DataFrame, DataFrame]:
    """Areas with and without a postcode after islands of other codes are cut out of them: one row per polygon.

    Masks go with the postcode, whatever the state. Every mask that meets an area is subtracted from it.
    """
    pc = number_rows(_filled(display.where(coded(cfg)), ["postcode", "state"], cfg), "area_id")
    inner = pc.select(F.col("postcode").alias("postcode2"), F.col("geom").alias("geom2"))
    # polygons of a whole code are long beside a cell: only boxes are spread over cells, and inner areas lie in one each
    islands = spatial_join(
        pc.select("area_id", "postcode", "geom"), inner, G.contains, cfg.cell, where=F.col("postcode") != F.col("postcode2"),
        inside="right", left_id="area_id",
    ).select("postcode", F.col("geom2").alias("geom"))
    pc = cut(cut_out(pc, "area_id", islands, cfg, on=["postcode"]))
    none = number_rows(_filled(display.where(uncoded(cfg)), ["state"], cfg), "area_id")
    within = spatial_join(
        none.select("area_id", "geom"), pc.select(F.col("area_id").alias("inner_id"), F.col("geom").alias("geom2")), G.contains, cfg.cell,
        inside="right", left_id="area_id",
    ).dropDuplicates(["inner_id"]).select(F.col("geom2").alias("geom"))
    none = cut(cut_out(none, "area_id", within, cfg))
    surrounded = spatial_join(
        pc.select("area_id", "geom"), none.select(F.col("area_id").alias("inner_id"), F.col("geom").alias("geom2")), G.contains, cfg.cell,
        inside="right", left_id="area_id",
    ).select(F.col("inner_id").alias("area_id")).distinct()
    none = none.join(surrounded, "area_id", "left_anti")
    return pc, none


def display_postcodes(display: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Postcodes, one row per code and state, and un-coded areas one row each: ``gid, postcode, state, geom``."""
    pc, none = postcode_areas(display, cfg)
    explode = lambda d, *keys: d.select(*keys, F.explode(G.polygons(G.make_valid("geom"))).alias("geom"))
    coded_rows = collect(
        dissolve_parts(explode(pc, "postcode", "state"), ["postcode", "state"]), ["postcode", "state"]
    )
    free = explode(none, "state").select(F.lit(None).cast("string").alias("postcode"), "state", "geom")
    return number_rows(coded_rows.unionByName(free).withColumn("geom", G.multi("geom")), "gid")
