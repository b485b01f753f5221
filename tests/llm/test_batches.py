"""Rows that go through Python whole: what a task sees at a time, and what comes back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlay.llm.batches import STEP_BYTES, repeat_rows


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_rows_come_back_in_small_steps(spark, kind):
    long = F.repeat(F.lit("é"), 300_000)  # 0.6 MB each
    d = spark.range(0, 12, 1, 1).select("id", F.when(F.col("id") % 5 != 0, long).cast(kind).alias("text"), (F.col("id") % 3).alias("n"))

    def times(batch):
        sizes = [len(t.as_py()) for t in batch.column(1)]
        assert len(sizes) == 1 or sum(sizes) <= STEP_BYTES
        assert sizes == [0 if r["id"].as_py() % 5 == 0 else 600_000 for r in batch.column(0)]
        return batch.column(2).to_numpy().astype(np.int64)

    got = repeat_rows(d, "text", times, F.col("n")).select("id", F.octet_length("text").alias("size")).collect()
    want = [(i, None if i % 5 == 0 else 600_000) for i in range(12) for _ in range(i % 3)]
    assert sorted(map(tuple, got)) == want
    assert repeat_rows(d, "text", times, F.col("n")).columns == d.columns
    assert repeat_rows(d.limit(0), "text", times, F.col("n")).count() == 0
