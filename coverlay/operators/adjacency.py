"""Who borders whom."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.operators.grid import spatial_join


def touching(left: DataFrame, right: DataFrame, cell: float, on: Sequence[str] = (), **options) -> DataFrame:
    """Pairs with outline contact but no interior overlap."""
    return spatial_join(left, right, G.touches, cell, on=on, **options)


def canonical_edges(segments: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Segments with their lower end first, so that both sides of a shared edge are the same row value."""
    flip = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    pick = lambda a, b: F.when(flip, F.col(b)).otherwise(F.col(a))
    return segments.select(
        *keep, pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"),
        pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2"),
    )


def neighbours_by_edge(segments: DataFrame, owner: str) -> DataFrame:
    """Neighbouring owners of an exact coverage and the length of their common border.

    One grouped pass over the edges. An edge of a coverage has at most two owners, so the smallest and largest
    owner are the pair and no pairs are enumerated.
    """
    e = canonical_edges(segments, [owner])
    shared = e.groupBy("x1", "y1", "x2", "y2").agg(F.min(owner).alias("a"), F.max(owner).alias("b"))
    shared = shared.where(F.col("a") < F.col("b"))
    return shared.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("edges"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("shared_length"),
    )
