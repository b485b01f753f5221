"""Relational steps on keyed layers: arg-best rows, flags, deletes, re-keying, ordered neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverlay.operators.stage import cut


def best_per_key(df: DataFrame, keys: Sequence[str], value: str, largest: bool = False) -> DataFrame:
    """All rows that hold their key's smallest (or largest) value; ties are all kept.

    An aggregate joined back rather than a window: it is partially aggregated before the shuffle and its join
    can be split, so one key owning a large share of the rows does not end up in one task.
    """
    best = df.groupBy(*keys).agg((F.max if largest else F.min)(value).alias(value))
    return df.join(best, [*keys, value], "left_semi")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; the order should be total so that the choice is stable."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which the condition is true; rows for which it is unknown (NULL) stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_matching(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other, list(on), "left_anti")


def set_where_key(df: DataFrame, ids: DataFrame, on: Sequence[str], column: str, value: Column, only: Column) -> DataFrame:
    """Set a column on rows that satisfy ``only`` and whose key occurs in ``ids``; other rows are unchanged."""
    hit = ids.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(hit, list(on), "left")
    change = only & F.coalesce("_hit", F.lit(False))
    return joined.withColumn(column, F.when(F.coalesce(change, F.lit(False)), value).otherwise(F.col(column))).select(
        *df.columns
    )


def set_from(df: DataFrame, values: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from a table with at most one row per key; rows without a match keep their own."""
    renamed = values.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = df.join(renamed, list(on), "left")
    new = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(new).select(*df.columns)


def append(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows that may lack some columns; those become NULL."""
    return df.unionByName(rows, allowMissingColumns=True)


def remap_key(df: DataFrame, linkage: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Replace an old key by its new one; rows whose key is not in the linkage are dropped.

    A row is never multiplied: a key in use that the linkage ties to two different new keys is an error
    (:func:`ambiguous` lists them beforehand). Linkage rows said twice count once.
    """
    link = linkage.groupBy(F.col(old).alias(key)).agg(F.min(new).alias("_new"), F.max(new).alias("_other"))
    twice = F.concat(F.lit("two new keys for "), F.col(key).cast("string"))
    one = F.when(F.col("_new").eqNullSafe(F.col("_other")), F.col("_new")).otherwise(F.raise_error(twice))
    return df.join(link, key).withColumn(key, one).select(*df.columns)


def unmapped(df: DataFrame, linkage: DataFrame, key: str, old: str) -> DataFrame:
    """The rows that :func:`remap_key` drops, so that the loss can be reported."""
    return df.join(linkage.select(F.col(old).alias(key)), key, "left_anti")


def ambiguous(linkage: DataFrame, old: str, new: str) -> DataFrame:
    """Old keys with more than one new key; :func:`remap_key` refuses them."""
    return linkage.groupBy(old).agg(F.countDistinct(new).alias("matches")).where(F.col("matches") > 1)


def lead_over_all(df: DataFrame, order: Sequence[str], values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``lead`` over a total order of the whole table, without sorting it in one task.

    Range partitions are led separately; the first row of each following partition closes the seam. Adds a
    struct column ``next`` with ``values`` of the next row, NULL on the last row. ``order`` must be unique.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = cut(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    row = F.struct(*values)
    w = W.partitionBy("_pid").orderBy(*order)
    led = p.withColumns({"next": F.lead(row).over(w), "_last": F.lead(F.lit(True)).over(w).isNull()})
    # one row per partition, so the un-partitioned window below sees at most n rows
    firsts = p.groupBy("_pid").agg(F.min_by(row, F.struct(*order)).alias("_first"))
    seams = firsts.select("_pid", F.lead("_first").over(W.orderBy("_pid")).alias("_seam"))
    out = led.join(seams, "_pid", "left")
    return out.withColumn("next", F.when(F.col("_last"), F.col("_seam")).otherwise(F.col("next"))).select(
        *df.columns, "next"
    )
