"""State polygons and the corridors along their common borders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.kernel import enable
from coverlay.operators.dissolve import dissolve_parts
from coverlay.operators.grid import spatial_join
from coverlay.operators.spread import number_rows
from coverlay.operators.stage import cut
from coverlay.plans.config import CleanConfig


def state_polygons(areas: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Census areas with their holes filled, dissolved by state: ``state_gid, state, geom``, one row per polygon."""
    enable(areas.sparkSession)
    filled = areas.select("state", F.explode(G.polygons("geom")).alias("geom")).withColumn("geom", G.fill_holes("geom"))
    return number_rows(dissolve_parts(filled, ["state"]), "state_gid")


def state_lines(states: DataFrame) -> DataFrame:
    """Every ring of every state polygon as a line."""
    return states.select("state_gid", "state", F.explode(G.parts(G.boundary("geom"))).alias("geom"))


def tiles(layer: DataFrame, keys: list[str], cfg: CleanConfig) -> DataFrame:
    """Polygons cut to at most ``max_points`` vertices, so that joins move small pieces."""
    return layer.select(*keys, F.explode(G.subdivide("geom", cfg.max_points)).alias("geom"))


def border_bands(lines: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Thinned state lines as buffers. Long lines are buffered run by run: small boxes, same covered area."""
    thin = lines.select("state", G.simplify("geom", cfg.border_simplify).alias("geom"))
    runs = thin.select("state", F.explode(G.chop("geom", cfg.max_segments)).alias("geom"))
    return runs.withColumn("geom", G.buffer_flat("geom", cfg.border_width, cfg.border_quadrants))


def band_overlaps(bands: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Where the bands of two states overlap, each pair of states once; coastlines have no partner and drop out."""
    other = bands.select(F.col("state").alias("state2"), F.col("geom").alias("geom2"))
    pairs = spatial_join(bands, other, G.intersects, cfg.cell, refine_above=cfg.hot_cell, where=F.col("state") < F.col("state2"))
    shared = pairs.select(
        F.concat("state", F.lit("-"), "state2").alias("pair"), G.polygonal_intersection("geom", "geom2").alias("geom")
    )
    return dissolve_parts(cut(shared), ["pair"])


def clip_to_layer(
    df: DataFrame, key: str, layer_tiles: DataFrame, layer_keys: list[str], cfg: CleanConfig, pairs: DataFrame | None = None
) -> DataFrame:
    """Areas of ``df`` inside each polygon of a tiled layer: ``df columns, layer_keys, geom`` (parts exploded).

    Only the tiles near a feature are put together again for it, so a feature never meets a whole state
    outline. ``pairs`` limits which ``key × layer_keys`` combinations are wanted.
    """
    boxes = df.select(key, "geom")
    near = spatial_join(
        boxes, layer_tiles.select(*layer_keys, F.col("geom").alias("geom2")), None, cfg.cell, refine_above=cfg.hot_cell
    ).drop("geom")
    if pairs is not None:
        near = near.join(pairs, [key, layer_keys[0]], "left_semi")
    local = near.groupBy(key, *layer_keys).agg(G.union_agg("geom2").alias("_mask"))
    cut_out = df.join(local, key).withColumn("geom", F.explode(G.polygons(G.polygonal_intersection("geom", "_mask"))))
    return cut_out.drop("_mask")


def corridors(states: DataFrame, state_tiles: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Border corridors trimmed to land: ``corridor_id, state, geom``. Any state that meets a corridor takes part.

    A corridor can be as long as a border, so it is cut into tiles before it meets the tiles of states; the clipped
    tiles are united level by level, and no group spans a whole border.
    """
    overlaps = number_rows(band_overlaps(border_bands(state_lines(states), cfg), cfg), "_id")
    small = number_rows(tiles(overlaps.select("_id", "geom"), ["_id"], cfg), "_tile")
    clipped = clip_to_layer(small.select("_tile", "_id", "geom"), "_tile", state_tiles, ["state_gid", "state"], cfg)
    keys = ["_id", "state_gid", "state"]
    whole = dissolve_parts(cut(clipped.select(*keys, "geom")), keys)
    return number_rows(whole.select("state", "geom"), "corridor_id")


def zones(corridor_layer: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Corridors cut into small zones: ``zone_id, corridor_id, state, geom``."""
    return number_rows(tiles(corridor_layer, ["corridor_id", "state"], cfg), "zone_id")


def prepare(areas: DataFrame, cfg: CleanConfig) -> dict[str, DataFrame]:
    states = state_polygons(areas, cfg)
    state_tiles = cut(tiles(states, ["state_gid", "state"], cfg))
    corridor_layer = corridors(states, state_tiles, cfg)
    return {
        "states": states,
        "state_tiles": state_tiles,
        "corridors": corridor_layer,
        "zones": zones(corridor_layer, cfg),
    }
