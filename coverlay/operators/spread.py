"""Numbers, running sums and look-ups for tables in which one group may hold a third of all rows.

Groups are cut by ranges of their order or by a salt, so no task holds a whole group; what is combined afterwards is one
short row per group and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.operators.stage import store

#: Tasks that the rows of one key are dealt over.
SALTS = 64


def number_by(df: DataFrame, order: list[str | Column], name: str = "number") -> DataFrame:
    """``df`` with dense numbers from 0 in ascending ``order`` (nulls first), in the column ``name``.

    The numbers follow from the content alone: rows are dealt by range and sorted, a task's rows are counted, and a
    prefix sum over tasks gives each its start. Another partitioning of the same rows gives the same numbers; rows that
    tie in ``order`` are ranked by a hash of all their columns, so only equal rows could change places.
    """
    mine = df.withColumn("_tie", F.xxhash64(*df.columns))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = mine.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, F.col("_tie")).drop("_tie")
    # the place in a task: the rows are sorted and written once, so a retry of a reader sees the same
    at = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    rows = store(dealt.withColumns({"_part": F.spark_partition_id(), "_at": at}), "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per task
    starts = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def number_rows(df: DataFrame, name: str, geom: str = "geom") -> DataFrame:
    """Features with dense ids from 0 in the first column, which another run or partitioning gives again.

    The order is that of a hash of the other columns and the feature's box, then of a hash of all columns: how an earlier
    stage happened to order vertices only tells features apart that agree in all else. One shuffle and one write: the
    hash's range is cut into as many equal parts as a shuffle has, each is ranked by itself, and one count per part tells
    where its ids begin.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    content = [F.col(c) for c in df.columns if c != geom]
    if geom in df.columns:
        box = G.bounds(geom)
        content += [box[c] for c in ("xmin", "ymin", "xmax", "ymax")]
    keyed = df.withColumns({"_key": F.xxhash64(*content), "_tie": F.xxhash64(*df.columns)})
    part = F.least(F.floor((F.col("_key") / F.lit(2.0**64) + 0.5) * parts), F.lit(parts - 1)).cast("int")
    dealt = keyed.withColumn("_part", part).repartition(parts, "_part")
    at = F.row_number().over(W.partitionBy("_part").orderBy("_key", "_tie"))
    rows = store(dealt.withColumn("_at", at).drop("_key", "_tie"), "numbered")
    sizes = dict(rows.groupBy("_part").agg(F.count("*")).collect())  # one short row per part
    starts = [0]
    for p in range(parts - 1):
        starts.append(starts[-1] + sizes.get(p, 0))
    start = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")[F.col("_part")]
    return rows.select((start + F.col("_at") - 1).alias(name), *df.columns)


def running(df: DataFrame, group: list[str], order: list[str], sums: list[str] | None = None, place: str = "place") -> DataFrame:
    """``df`` with ``place``, from 1 in each group in ascending ``order``, and ``<column>_upto``: running sums of ``sums``.

    A group is cut into ranges, each scanned by itself; its segments' totals are carried on by a prefix sum over one
    short row per segment. The ``group`` columns must not be null; rows that tie in ``order`` are in no fixed order.
    """
    sums = sums or []
    rows = store(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()), "running")
    keys = ["_part", *group]
    here = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    scanned = rows.withColumns({"_place": F.count("*").over(here), **{f"_{c}": F.sum(c).over(here) for c in sums}})
    parts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), *[F.sum(c).alias(f"_all_{c}") for c in sums])
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    so_far = {"_rows": "_rows", **{f"_all_{c}": f"_all_{c}" for c in sums}}
    parts = parts.select(*keys, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in so_far.items()])
    # a group has a row at least, so this may be as long as the table: not for the planner to send through the driver
    return scanned.join(parts.hint("merge"), keys).select(
        *df.columns, (F.col("_place") + F.col("_rows")).alias(place), *[(F.col(f"_{c}") + F.col(f"_all_{c}")).alias(f"{c}_upto") for c in sums]
    )


def look_up(rows: DataFrame, keys: list[str], table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows.join(table, keys, how)`` for a ``table`` with one row per key, whatever share of ``rows`` a key has.

    The rows of a key are dealt over ``SALTS`` tasks, and the table's row is copied only to those that have some. Neither is
    left to the planner's sizes: rows made by ``explode`` look as few as those they come from, and would go through the driver.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    wanted = salted.select(*keys, "_salt").distinct().join(table.hint("merge"), keys)
    return salted.join(wanted.hint("merge"), [*keys, "_salt"], how).drop("_salt")
