"""Connected components of a large graph by large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.operators.stage import store


#: Tasks that the links of one node are dealt over, so that a hub is not one task's work.
SALTS = 64


def _with_least(rows: DataFrame) -> DataFrame:
    """``rows`` (``a, b``) with ``m``, the smallest ``b`` of each ``a``. Smallest per salt, then of those, joined back per salt."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("a", "salt").agg(F.min("b").alias("part"))
    least = parts.groupBy("a").agg(F.min("part").alias("m"))
    return salted.join(parts.join(least, "a").select("a", "salt", "m"), ["a", "salt"]).select("a", "b", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = _with_least(edges.union(edges.select("b", "a")))
    return both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    hung = _with_least(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    ends = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return hung.select(F.explode(ends).alias("link")).select("link.*").where("a <> b")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node with a link, root the smallest node of its component.

    ``edges`` has two columns of one orderable type; loops, repeated and reversed links are fine, links with a null
    are ignored, an empty table gives an empty one. Every round is written to the shared folder, and only the count
    and a sum of hashes of a round reach the driver. Neighbours are never gathered: a hub's links are dealt over ``SALTS``
    tasks, its smallest neighbour is an aggregate joined back to each.
    """
    a, b = edges.columns[:2]
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    now, mark = store(now, "component-links"), None  # read several times in a round
    for _ in range(most_rounds):
        now = store(_small_star(_large_star(now)).distinct(), "component-links")
        last, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if mark == last or mark[0] == 0:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # settled: every link goes from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
