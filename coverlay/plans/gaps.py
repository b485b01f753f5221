"""Gaps between localities along state borders: finding them, and giving each to a locality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geodesy
from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators.attributes import append, one_per_key
from coverlay.operators.dissolve import dissolve_parts
from coverlay.operators.grid import spatial_join
from coverlay.operators.points import nearest_outline
from coverlay.operators.spread import number_rows
from coverlay.operators.stage import cut
from coverlay.plans.config import CleanConfig
from coverlay.plans.split import GOOD_BORDER, MESSY_BORDER


def zone_gaps(zones: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Each zone minus the localities of its state that meet it: ``zone_id, state, geom``. All pieces count."""
    cover = pieces.select(F.col("loc_state").alias("state"), F.col("geom").alias("geom2"))
    pairs = spatial_join(zones.select("zone_id", "state", "geom"), cover, G.intersects, cfg.cell, on=["state"], refine_above=cfg.hot_cell, small="left")
    covered = pairs.groupBy("zone_id").agg(G.union_agg(G.near_part("geom2", "geom")).alias("_cover"))
    rest = zones.select("zone_id", "state", "geom").join(covered, "zone_id")
    return rest.select("zone_id", "state", F.explode(G.polygons(G.difference("geom", "_cover"))).alias("geom"))


def all_gap_zones(zones: DataFrame, gaps: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Zones without a gap of their own that touch one are gaps as a whole."""
    bare = zones.select("zone_id", "state", "geom").join(gaps.select("zone_id").distinct(), "zone_id", "left_anti")
    if not cfg.add_covered_zones:
        cover = pieces.select(F.col("loc_state").alias("state"), F.col("geom").alias("geom2"))
        met = spatial_join(bare, cover, G.intersects, cfg.cell, on=["state"], refine_above=cfg.hot_cell, small="left").select("zone_id").distinct()
        bare = bare.join(met, "zone_id", "left_anti")
    near = spatial_join(bare, gaps.select(F.col("geom").alias("geom2")), G.touches, cfg.cell)
    return bare.join(near.select("zone_id").distinct(), "zone_id", "left_semi")


def border_gaps(zones: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    found = cut(zone_gaps(zones, pieces, cfg))
    return append(found, all_gap_zones(zones, found, pieces, cfg))


def merged_gaps(gaps: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Gaps without slivers, dissolved by state: ``hole_id, state, geom``, one row per polygon."""
    opened = gaps.select("state", G.open_close("geom", *cfg.gap_open).alias("geom"))
    parts = dissolve_parts(cut(opened), ["state"])
    clean = parts.select("state", F.explode(G.polygons(G.make_valid(G.buffer("geom", 0.0)))).alias("geom"))
    return number_rows(clean, "hole_id")


def _meets(cfg: CleanConfig):
    if cfg.contact == "overlap":
        return G.intersects
    return lambda a, b: G.within_distance(a, b, cfg.contact_tolerance)


def gap_pairs(gaps: DataFrame, pieces: DataFrame, cfg: CleanConfig, gap_id: str = "hole_id") -> DataFrame:
    """Gap × locality piece of the same state that meet: ``gap_id, state, geom, locality_pid, geom2``."""
    other = pieces.select(F.col("loc_state").alias("state"), "locality_pid", F.col("geom").alias("geom2"))
    pad = 0.0 if cfg.contact == "overlap" else cfg.contact_tolerance
    return spatial_join(gaps.select(gap_id, "state", "geom"), other, _meets(cfg), cfg.cell, on=["state"], expand=pad,
                        refine_above=cfg.hot_cell, small="left", left_id=gap_id)


def gap_localities(gaps: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    return gap_pairs(gaps, pieces, cfg).select("hole_id", "locality_pid").distinct()


def single_neighbour(pairs: DataFrame) -> DataFrame:
    """Gaps that exactly one locality meets, with that locality."""
    n = pairs.groupBy("hole_id").agg(F.count(F.lit(1)).alias("_n"), F.min("locality_pid").alias("locality_pid"))
    return n.where(F.col("_n") == 1).drop("_n")


def as_pieces(gaps: DataFrame, match_type: str) -> DataFrame:
    return gaps.select(
        "locality_pid", F.col("state").alias("loc_state"), F.col("state").alias("ste_state"),
        F.lit(match_type).alias("match_type"), "geom",
    )


def large_enough(gaps: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Gaps of at least ``min_gap_area`` square metres in an equal-area projection."""
    if cfg.min_gap_area is None:
        return gaps
    measured = G.once(gaps, "_area", N.area(geodesy.albers_nested(G.decode("geom"))))
    return measured.where(F.col("_area") >= F.lit(cfg.min_gap_area)).drop("_area")


def split_points(gaps: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Outline vertices of a gap that more than one locality shares: ``hole_id, state, x, y``."""
    pairs = gap_pairs(gaps, pieces, cfg)
    if cfg.contact == "overlap":
        shared = G.decode(G.polygonal_intersection("geom2", "geom"))
        pts = F.flatten(F.flatten(shared))
    else:
        pts = G.contact_points("geom2", "geom", cfg.contact_tolerance)
    rows = pairs.select("hole_id", "state", "locality_pid", F.explode(pts).alias("p"))
    per = rows.select("hole_id", "state", "locality_pid", "p.x", "p.y").distinct().groupBy("hole_id", "state", "x", "y")
    return per.count().where(F.col("count") > 1).drop("count")


def splitter_lines(points: DataFrame, corridor_layer: DataFrame, cfg: CleanConfig) -> DataFrame:
    """From each split point to the nearest corridor outline of its state, a little too long at both ends.

    A point already on the outline has no direction and gets no line.
    """
    pts = number_rows(points, "point_id")
    near = nearest_outline(
        pts, corridor_layer.select("corridor_id", "state", "geom"), cfg.cell, "point_id", "corridor_id", on=["state"],
    )
    lines = near.select("hole_id", "state", "point_id", N.overshoot(N.xy("x", "y"), F.col("nearest"), cfg.overshoot).alias("path"))
    return lines.where(F.col("path").isNotNull()).select("hole_id", "state", G.line("path").alias("line")).distinct()


def split_gaps(gaps: DataFrame, lines: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Gaps cut by every splitter line of their state that meets them.

    ``split_id, hole_id, state, geom, blades, pieces``; fewer pieces than blades + 1 marks an incomplete cut.
    """
    grown = gaps.select("hole_id", "state", G.open_close("geom", *cfg.gap_grow).alias("geom"))
    hits = spatial_join(
        grown, lines.select("state", "line"), G.intersects, cfg.cell, on=["state"], right_geom="line", small="right"
    )
    blades = hits.groupBy("hole_id").agg(G.union_agg("line").alias("_blades"))
    # cuts cost much CPU per byte: a number of tasks of its own, so adaptive execution doesn't merge them by their size
    tasks = int(gaps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut_up = grown.repartition(tasks, "hole_id").join(blades, "hole_id").withColumn("_faces", G.split_polygon("geom", "_blades"))
    out = cut_up.select(
        "hole_id", "state", G.num_parts("_blades").alias("blades"), F.size("_faces").alias("pieces"),
        F.explode("_faces").alias("geom"),
    )
    return number_rows(out, "split_id")


def frontage(a: Column, b: Column, cfg: CleanConfig) -> Column:
    if cfg.contact == "overlap":
        return G.length(G.boundary(G.polygonal_intersection(a, b)))
    return G.frontage(a, b, cfg.contact_tolerance)


def longest_frontage(split: DataFrame, pieces: DataFrame, cfg: CleanConfig) -> DataFrame:
    """The locality with the most frontage on each gap piece, if it has any; ties go to the smallest id."""
    pairs = gap_pairs(split, pieces, cfg, "split_id")
    length = F.round(frontage(F.col("geom"), F.col("geom2"), cfg), 9)
    measured = G.once(pairs, "_d", length).select("split_id", "locality_pid", "_d")
    return one_per_key(measured.where(F.col("_d") > 1e-6), ["split_id"], [-F.col("_d"), F.col("locality_pid")]).drop("_d")


def assign_gaps(pieces: DataFrame, corridor_layer: DataFrame, zones: DataFrame, cfg: CleanConfig) -> dict[str, DataFrame]:
    """Find the gaps and give them away: pieces with gap pieces added, plus the gap tables for inspection."""
    gaps = merged_gaps(border_gaps(zones, pieces, cfg), cfg)
    pairs = cut(gap_localities(gaps, pieces, cfg))
    good = gaps.join(single_neighbour(pairs), "hole_id")
    with_good = cut(append(pieces, as_pieces(good, GOOD_BORDER)))
    # only gaps that some locality meets can be split; the others have no points to split at
    rest = cut(large_enough(gaps.join(good.select("hole_id"), "hole_id", "left_anti"), cfg))
    met = rest.join(pairs, "hole_id", "left_semi")
    points = split_points(met, with_good, cfg)
    lines = cut(splitter_lines(points, corridor_layer, cfg))
    split = split_gaps(rest, lines, cfg)
    won = split.join(longest_frontage(split, with_good, cfg), "split_id")
    return {
        "gaps": gaps,
        "good_gaps": good,
        "open_gaps": rest,
        "splitter_lines": lines,
        "split_gaps": split,
        "pieces": cut(append(with_good, as_pieces(won, MESSY_BORDER))),
    }
