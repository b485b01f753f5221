"""Localities cut along state borders, and which of the pieces are theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.kernel import enable
from coverlay.operators.attributes import delete_where, one_per_key, set_from, set_where_key
from coverlay.operators.grid import spatial_join
from coverlay.operators.points import points_in_areas
from coverlay.operators.spread import number_rows
from coverlay.operators.stage import cut
from coverlay.plans.borders import clip_to_layer, state_lines
from coverlay.plans.config import CleanConfig

# Match types of pieces (fixed values that downstream users of the layers filter on).
SPLIT, GOOD, SINGLE, CENTROID, SLIVER = "SPLIT", "GOOD", "SINGLE", "CENTROID", "BORDER SLIVER"
GOOD_BORDER, MESSY_BORDER, MANUAL = "GOOD BORDER", "MESSY BORDER", "MANUAL"


def locality_polygons(bdys: DataFrame) -> DataFrame:
    """One row per polygon: ``gid, locality_pid, state, geom``."""
    enable(bdys.sparkSession)
    return number_rows(bdys.select("locality_pid", "state", F.explode(G.polygons("geom")).alias("geom")), "gid")


def border_pairs(localities: DataFrame, states: DataFrame, cfg: CleanConfig) -> DataFrame:
    """``gid, state_gid`` of localities that meet an outline of a state; found on short runs of the outlines."""
    runs = state_lines(states).select("state_gid", F.explode(G.chop("geom", cfg.max_segments)).alias("line"))
    hits = spatial_join(localities.select("gid", "geom"), runs, G.intersects, cfg.cell, right_geom="line", refine_above=cfg.hot_cell, small="right")
    return hits.select("gid", "state_gid").distinct()


def split_by_states(localities: DataFrame, states: DataFrame, state_tiles: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Pieces of border localities per state: ``gid, locality_pid, loc_state, state_gid, ste_state, match_type, geom``."""
    pairs = cut(border_pairs(localities, states, cfg))
    touched = localities.join(pairs, "gid", "left_semi").withColumnRenamed("state", "loc_state")
    named = state_tiles.withColumnRenamed("state", "ste_state")
    pieces = clip_to_layer(touched, "gid", named, ["state_gid", "ste_state"], cfg, pairs)
    return pieces.select("gid", "locality_pid", "loc_state", "state_gid", "ste_state", F.lit(SPLIT).alias("match_type"), "geom")


def untouched(localities: DataFrame, pieces: DataFrame) -> DataFrame:
    """Localities without a single piece left are taken whole."""
    rest = localities.join(pieces.select("gid").distinct(), "gid", "left_anti")
    return rest.select(
        "gid", "locality_pid", F.col("state").alias("loc_state"), F.lit(None).cast("bigint").alias("state_gid"),
        F.col("state").alias("ste_state"), F.lit(GOOD).alias("match_type"), "geom",
    )


def mark_single(pieces: DataFrame) -> DataFrame:
    """State polygons that only one locality claims settle that locality's pieces."""
    one = pieces.select("state_gid", "locality_pid").distinct().groupBy("state_gid").count().where(F.col("count") == 1)
    return set_where_key(pieces, one, ["state_gid"], "match_type", F.lit(SINGLE), F.col("match_type") != GOOD)


def mark_centroid(pieces: DataFrame, localities: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Pieces that hold the interior point of their own locality. Needs ``piece_id``."""
    open_ = pieces.where(F.col("match_type") == SPLIT)
    pts = localities.join(open_.select("gid").distinct(), "gid", "left_semi").select(
        "locality_pid", G.interior_point("geom").alias("_p")
    ).select("locality_pid", "_p.x", "_p.y")
    hit = points_in_areas(pts, open_.select("locality_pid", "piece_id", "geom"), cfg.cell, on=["locality_pid"], refine_above=cfg.hot_cell)
    return set_where_key(pieces, hit, ["piece_id"], "match_type", F.lit(CENTROID), F.col("match_type") == SPLIT)


def mark_slivers(pieces: DataFrame, corridor_layer: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Pieces still open that lie along a border of their own state."""
    open_ = pieces.where((F.col("match_type") == SPLIT) & ~F.col("locality_pid").isin(*cfg.sliver_exceptions))
    near = spatial_join(
        open_.select("piece_id", F.col("loc_state").alias("state"), "geom"),
        corridor_layer.select("state", F.col("geom").alias("geom2")), G.intersects, cfg.cell, on=["state"],
        refine_above=cfg.hot_cell, small="right",
    )
    return set_where_key(pieces, near, ["piece_id"], "match_type", F.lit(SLIVER), F.col("match_type") == SPLIT)


def reassign_slivers(pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Give border slivers to the neighbour they touch: the longest common outline wins, then the smallest id.

    Neighbours are read from the layer as it was, so an assignment never travels more than one step.
    """
    slivers = pieces.where(F.col("match_type") == SLIVER).select(
        "piece_id", "loc_state", F.col("locality_pid").alias("_own"), "geom"
    )
    other = pieces.select("loc_state", "locality_pid", F.col("geom").alias("geom2"))
    pairs = spatial_join(
        slivers, other, G.touches, cfg.cell, on=["loc_state"], where=F.col("_own") != F.col("locality_pid"),
        refine_above=cfg.hot_cell, small="left",
    ).withColumn("_w", G.frontage("geom", "geom2", cfg.contact_tolerance))
    # one neighbour may touch along several pieces: what counts is its whole common outline
    total = pairs.groupBy("piece_id", "locality_pid").agg(F.round(F.sum("_w"), 6).alias("_w"))
    best = one_per_key(total, ["piece_id"], [-F.col("_w"), F.col("locality_pid")])
    return set_from(pieces, best.select("piece_id", "locality_pid"), ["piece_id"], ["locality_pid"])


def classify(
    localities: DataFrame, states: DataFrame, state_tiles: DataFrame, corridor_layer: DataFrame, cfg: CleanConfig
) -> DataFrame:
    """All pieces with their match type, wrong-side pieces gone, slivers re-assigned. Later rules see open rows only."""
    every = cut(split_by_states(localities, states, state_tiles, cfg))
    pieces = delete_where(every, F.col("loc_state") != F.col("ste_state"))
    pieces = number_rows(pieces.unionByName(untouched(localities, pieces)), "piece_id")
    pieces = mark_centroid(mark_single(pieces), localities, cfg)
    pieces = cut(mark_slivers(pieces, corridor_layer, cfg))
    return cut(reassign_slivers(pieces, cfg))


def apply_fix_points(pieces: DataFrame, points: DataFrame | None, cfg: CleanConfig) -> DataFrame:
    """Curated points settle the open pieces they lie in; one point takes its piece out again.

    Points match by place only. The union of both conditions is two keyed updates, never a nested loop.
    """
    is_open = F.col("match_type") == SPLIT
    if points is not None:
        xy = points.select("x", "y").distinct()
        hit = points_in_areas(xy, pieces.where(is_open).select("piece_id", "geom"), cfg.cell, small="left")
        pieces = set_where_key(pieces, hit, ["piece_id"], "match_type", F.lit(MANUAL), is_open)
    if cfg.always_keep:
        keep = is_open & F.col("locality_pid").isin(*cfg.always_keep)
        pieces = pieces.withColumn("match_type", F.when(keep, MANUAL).otherwise(F.col("match_type")))
    if cfg.drop_at:
        x, y = cfg.drop_at
        b = G.bounds("geom")
        boxed = (F.lit(x) >= b["xmin"]) & (F.lit(x) <= b["xmax"]) & (F.lit(y) >= b["ymin"]) & (F.lit(y) <= b["ymax"])
        there = F.coalesce(boxed & G.intersects("geom", G.point(F.lit(x), F.lit(y))), F.lit(False))
        pieces = pieces.withColumn("match_type", F.when(there, SPLIT).otherwise(F.col("match_type")))
    return pieces
