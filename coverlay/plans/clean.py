"""The whole cleaning as one function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geodesy
from coverlay.functions import geometry as G
from coverlay.operators.stage import cut
from coverlay.plans import borders, display, gaps, qa, split
from coverlay.plans.config import CleanConfig
from coverlay.sources.readers import detect_srid, trim_blanks


def shift_fix_points(points: DataFrame, srid: int) -> DataFrame:
    """Fix points as ``x, y`` in the layer's datum: they are kept in GDA94 and moved when the layer is GDA2020."""
    raw = points.withColumn("_p", G.centroid("geom"))
    if srid == 7844:
        raw = raw.withColumn("_p", geodesy.gda2020(F.col("_p.x"), F.col("_p.y")))
    return raw.select(*[c for c in points.columns if c != "geom"], F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))


def ready(bdys: DataFrame, fix_points: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Inputs as the stages expect them: codes without trailing blanks, and fix points in the layer's datum.

    A layer with an ``srid`` column must have one accepted value; it decides whether fix points that come as ``geom``
    are moved. Fix points that come as ``x, y`` are in the layer's datum already.
    """
    srid = None
    if "srid" in bdys.columns:
        srid = detect_srid(bdys)
        bdys = bdys.drop("srid")
    bdys = trim_blanks(bdys, "postcode")
    if fix_points is not None and "geom" in fix_points.columns:
        if srid is None:
            raise ValueError("fix points given as geom need a layer with an srid column")
        fix_points = shift_fix_points(fix_points, srid)
    return bdys, fix_points


def clean(
    bdys: DataFrame, areas: DataFrame, fix_points: DataFrame | None = None, cfg: CleanConfig = CleanConfig(), check: bool = True,
) -> dict[str, DataFrame]:
    """Localities and census areas in, clean display layers and reports out.

    ``bdys`` holds the locality attributes, ``geom`` and optionally ``srid``; ``areas`` holds ``state, geom``;
    ``fix_points`` holds ``geom``, or ``x, y`` in the layer's datum (see :func:`ready`). Stages with several expensive
    readers are checkpointed. With ``check`` the finished layers must keep the promises of their table definitions.
    """
    bdys, fix_points = ready(bdys, fix_points)
    prepared = borders.prepare(areas, cfg)
    localities = split.locality_polygons(bdys)
    pieces = split.classify(localities, prepared["states"], prepared["state_tiles"], prepared["corridors"], cfg)
    found = gaps.assign_gaps(pieces, prepared["corridors"], prepared["zones"], cfg)
    settled = cut(split.apply_fix_points(found["pieces"], fix_points, cfg))
    full = cut(display.full_resolution(settled, bdys, cfg))
    shown = display.display_localities(full, bdys, cfg)
    postcodes = display.display_postcodes(shown, cfg)
    if check:
        qa.check_contract(shown, ["locality_pid"], ["locality_pid", "locality_name", "state", "geom"], {"MultiPolygon"})
        qa.check_contract(postcodes, ["gid"], ["state", "geom"], {"MultiPolygon"})
    return prepared | found | {
        "localities": localities,
        "pieces": settled,
        "full_res": full,
        "display": shown,
        "postcodes": postcodes,
        "dropped": qa.dropped_features(bdys, shown),
        "invalid": qa.invalid_features(shown),
        "empty": qa.empty_features(shown),
    }
