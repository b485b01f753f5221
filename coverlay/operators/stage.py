"""Cutting lineage between expensive stages so that lost executors cost one stage, not the whole run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. A folder of our own only with a local master, where one disk is all there is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get(_DIR, None) or sc.getConf().get(_DIR, None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {_DIR} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="coverlay-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is written to shared storage and its plan starts from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: columns can be pruned, filters pushed down."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
