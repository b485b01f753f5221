"""Ids that follow from content, and tables replaced under their readers."""

import uuid

import pytest
from pyspark.sql import functions as F

from coverlay.operators.spread import number_rows
from coverlay.sources.writers import switch_table


def test_ids_do_not_depend_on_partitioning(spark, shapes):
    rows = [(k % 3 if k % 7 else None, f"POLYGON(({k % 5} 0,{k % 5 + 1} 0,{k % 5 + 1} {1 + k % 2},{k % 5} 0))") for k in range(90)]
    layer = shapes(rows)
    one, many = (number_rows(layer.repartition(n, F.rand(n)), "gid") for n in (1, 13))
    assert one.columns == ["gid", "id", "geom"]
    got = sorted(map(tuple, one.collect()), key=lambda r: r[0])
    assert got == sorted(map(tuple, many.collect()), key=lambda r: r[0]) and [r[0] for r in got] == list(range(90))
    for plan in (one, many):
        assert "monotonically" not in plan._jdf.queryExecution().toString()


def test_ids_of_odd_rows(spark, shapes):
    """Equal rows and empty or null geometries get ids of their own; an empty table gives none."""
    layer = shapes([(1, "POINT(1 1)"), (1, "POINT(1 1)"), (2, "POLYGON EMPTY"), (None, None), (None, None)])
    got = number_rows(layer, "gid").collect()
    assert sorted(r.gid for r in got) == list(range(5)) and len(got) == 5
    assert number_rows(layer.limit(0), "gid").count() == 0
    assert sorted(r.n for r in number_rows(spark.range(5), "n").collect()) == list(range(5))


def test_table_switched_under_readers(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    first = switch_table(spark.range(10), name, f"file:{tmp_path}")
    begun = spark.table(name)
    second = switch_table(spark.table(name).select((F.col("id") + 5).alias("id"), F.lit("x").alias("more")), name, f"file:{tmp_path}")
    assert first != second and sorted(r.id for r in begun.collect()) == list(range(10))
    assert spark.table(name).columns == ["id", "more"] and sorted(r.id for r in spark.table(name).collect()) == list(range(5, 15))
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):
        switch_table(broken, name, f"file:{tmp_path}")
    assert spark.table(name).count() == 10  # a write that fails changes nothing
    spark.sql(f"DROP VIEW {name}")


def test_two_runs_give_the_same_ids(spark):
    """The whole cleaning, on inputs that are dealt differently: pieces, gaps, zones, localities and postcodes keep their ids."""
    from coverlay.functions import geometry as G
    from coverlay.plans import clean
    from tests.conftest import DATA
    from workload import layers as L

    def ids(n):
        deal = lambda d: d.repartition(n, F.rand(n))
        sf = f"{DATA}/sf0.001"
        out = clean(deal(L.boundaries(spark, sf)), deal(L.areas(spark, sf)), cfg=L.CFG, check=False)
        tables = {"states": "state_gid", "corridors": "corridor_id", "zones": "zone_id", "pieces": "piece_id", "display": "gid", "postcodes": "gid"}
        box = G.bounds("geom")
        return {t: sorted(map(tuple, out[t].select(k, "state" if "state" in out[t].columns else "loc_state", *[box[c] for c in ("xmin", "ymin", "xmax", "ymax")]).collect()), key=str) for t, k in tables.items()}

    first = ids(1)
    assert first == ids(11) and all(first.values())
