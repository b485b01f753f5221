"""Small helpers for operators that read text in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one step of numpy work looks at; a longer text is a step of its own.
STEP_BYTES = 2_000_000


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes, null as empty: Python then works on bytes without decoding."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def runs(sizes: list[int], most: int = STEP_BYTES) -> Iterator[slice]:
    """Consecutive slices of at most ``most`` in total, or of one item."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over single batches; empty batches give nothing."""

    def over(batches):
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(over, schema)  # any column name will do


def repeat_rows(docs: DataFrame, text_col: str, times: Callable[[pa.RecordBatch], np.ndarray], *columns: Column) -> DataFrame:
    """``docs`` with each row as often as ``times`` says: a number for each row of a batch ``row, text as UTF-8 bytes, *columns``.

    The rows travel as one struct beside ``columns``, so neither their number nor their names matter; no shuffle. Texts travel
    once, inside their rows, and rows go back in steps of ``STEP_BYTES`` of text, so a task holds little more than what Spark sends.
    """
    at = docs.columns.index(text_col) if text_col in docs.columns and docs.schema[text_col].dataType == T.StringType() else None
    sent = columns if at is not None else (utf8(text_col), *columns)

    def over(batches):
        for batch in batches:
            row, *rest = batch.columns
            if at is not None:
                rest.insert(0, row.flatten()[at].cast(pa.binary()).fill_null(b""))
            whole = pa.RecordBatch.from_arrays([row, *rest], names=[f"c{i}" for i in range(len(rest) + 1)])
            for part in runs(pc.binary_length(rest[0]).to_pylist()):
                step = whole.slice(part.start, part.stop - part.start)
                if (n := times(step)).any():
                    yield pa.RecordBatch.from_arrays([step.column(0).take(pa.array(np.repeat(np.arange(step.num_rows), n)))], names=["row"])

    schema = T.StructType([T.StructField("row", docs.schema)])
    rows = docs.select(F.struct("*"), *sent)
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(over, schema).select("row.*")


def record(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, (_, t) in zip(columns, schema, strict=True)],
        schema=pa.schema(schema),
    )
