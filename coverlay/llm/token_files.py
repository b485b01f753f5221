"""Flat token files and their per-document counts by a scan for the end-of-document id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverlay.llm.batches import map_batches, record, utf8
from coverlay.llm.bpe import encoder
from coverlay.llm.shared_files import new_folder, open_new, open_old, size_of
from coverlay.operators.stage import store

#: Bytes that one scan step reads; a multiple of every id width.
BLOCK_BYTES = 4 << 20


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts into flat files without an index, one file per partition: ``path, width, ordinal, <id_col>``.

    A file is the ids of its documents as little-endian unsigned integers, each document closed by ``end_id``, which
    no text can produce (special strings are read as ordinary text). Null and empty texts are an ``end_id`` alone.
    The returned rows say which document is the ``ordinal``-th of a file; the files themselves hold ids only.
    """
    folder = new_folder(docs.sparkSession, "flat-tokens")
    kind = docs.schema[id_col].dataType.simpleString()

    def write(batches):
        out, uri, ordinal = None, None, 0
        encode = encoder(tokenizer, True)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    uri, out = open_new(folder, ".bin")
                for text in batch.column(1):
                    out.write(encode.encode(text.as_py()) + end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * n), pa.array([encode.dtype.itemsize] * n, pa.int32()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column(0)],
                    names=["path", "width", "ordinal", id_col],
                )
                ordinal += n
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col(id_col), utf8(text_col)).mapInArrow(write, f"path string, width int, ordinal long, `{id_col}` {kind}")
    return store(rows, "flat-token-ledger")


_BLOCKS = [("path", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int64())), ("total", pa.int64())]


def separator_counts(files: DataFrame, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token counts of every document in flat files (``path, width``): ``path, ordinal, start, n_tokens, closed``.

    Files are cut into blocks by byte range, so one large file is read by many tasks, each a block at a time. A block
    gives the positions after its separators; a document that began in an earlier block is stitched to its start by a
    prefix scan over blocks (the last separator so far, and how many came before). ``n_tokens`` counts the separator.
    Tokens after a file's last separator are a document with ``closed`` false. Empty files have no documents; a size
    that isn't a multiple of the width is an error, as is a null path or width. Repeated rows count once.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for path, width in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            size = size_of(path)
            if size % width:
                raise ValueError(f"{path} has {size} bytes, no multiple of {width}")
            rows += [(path, width, size, at) for at in range(0, size, block_bytes)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)] if rows else
                                          [pa.array([], t) for t in (pa.string(), pa.int32(), pa.int64(), pa.int64())], names=["path", "width", "size", "at"])

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends = []
        for path, width, size, at in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            with open_old(path) as f:
                ids = np.frombuffer(f.read_at(min(block_bytes, size - at), at), dtype=f"<u{width}")
            ends.append(np.flatnonzero(ids == end_id) + (at // width + 1))
        totals = [s // w for s, w in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        return record(_BLOCKS, batch.column(0), pa.array([a // block_bytes for a in batch.column(3).to_pylist()]), pa.array(ends, pa.list_(pa.int64())), pa.array(totals, pa.int64()))

    blocks = store(map_batches(files.select("path", "width").distinct(), cut, "path string, width int, size long, at long"), "blocks")
    tasks = max(1, blocks.count())  # rows are short, what they stand for isn't: a task per block, whatever the rows' bytes
    found = store(map_batches(blocks.repartition(tasks, "path", "at"), scan, "path string, block long, ends array<long>, total long"), "separators")
    so_far = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    stitched = found.withColumns({
        "carried": F.coalesce(F.last(last, ignorenulls=True).over(so_far), F.lit(0)),
        "before": F.coalesce(F.sum(F.size("ends")).over(so_far), F.lit(0)),
        "following": F.count("*").over(W.partitionBy("path").orderBy("block").rowsBetween(1, W.unboundedFollowing)),
    })
    closed = stitched.select("path", "before", "carried", "ends", F.posexplode("ends").alias("pos", "end")).select(
        "path", (F.col("before") + F.col("pos")).alias("ordinal"),
        F.when(F.col("pos") == 0, F.col("carried")).otherwise(F.try_element_at("ends", F.greatest("pos", F.lit(1)))).alias("start"), "end",
    )
    start = F.coalesce(last, F.col("carried"))
    rest = stitched.where((F.col("following") == 0) & (start < F.col("total"))).select(
        "path", (F.col("before") + F.size("ends")).alias("ordinal"), start.alias("start"), (F.col("total") - start).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.select("path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed")).unionByName(rest)


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_tokens`` for every row: documents are written as flat files and counted by scanning those.

    ``n_tokens`` includes the end id, so an empty or null text has 1. Null and repeated ids keep their rows; other
    columns are ignored. An empty table gives an empty result.
    """
    ledger = write_flat(docs, tokenizer, end_id, id_col, text_col)
    counts = separator_counts(ledger.select("path", "width").distinct(), end_id)
    return ledger.join(counts, ["path", "ordinal"]).select(id_col, "n_tokens")
