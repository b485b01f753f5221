"""Packed training sequences in Arrow stream files: equal-length id lists and masks, readable in place."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverlay.llm.batches import utf8
from coverlay.llm.bpe import encoder
from coverlay.llm.shared_files import new_folder, open_new, open_old
from coverlay.operators.stage import store

#: Ids in a sequence, and sequences in a record batch.
LENGTH, ROWS = 2048, 256


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    """``ids`` and ``mask`` are fixed-size lists; ``begins``/``docs`` say which documents begin where in a sequence."""
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length)),
        ("begins", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64())),
    ])


class _Packer:
    """Packs ids of documents end to end into sequences and writes full batches; the last sequence is padded."""

    def __init__(self, out, length: int, dtype: np.dtype):
        self.schema, self.length, self.dtype = file_schema(length, dtype), length, dtype
        self.writer = pa.ipc.new_stream(out, self.schema)
        self.parts: list[np.ndarray] = []
        self.held, self.tokens, self.rows = 0, 0, 0
        self.starts: list[int] = []  # relative to what is held
        self.docs: list[int | None] = []

    def add(self, doc, ids: np.ndarray) -> None:
        self.starts.append(self.held)
        self.docs.append(doc)
        self.parts.append(ids)
        self.held += len(ids)
        self.tokens += len(ids)
        if self.held >= self.length * ROWS:
            self._flush(self.held // (self.length * ROWS) * ROWS)

    def _flush(self, rows: int) -> None:
        """Write ``rows`` sequences in batches of ``ROWS``."""
        flat, size = np.concatenate(self.parts), rows * self.length
        full = np.zeros(size, self.dtype)
        real = min(size, len(flat))
        full[:real] = flat[:real]
        mask = np.arange(size) < real
        starts = np.array(self.starts, dtype=np.int64)
        here = int(np.searchsorted(starts, size))
        cuts = np.searchsorted(starts[:here], np.arange(rows + 1) * self.length)
        begins = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(starts[:here] % self.length, pa.int32()))
        docs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(self.docs[:here], pa.int64()))
        fixed = lambda values: pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
        table = pa.Table.from_arrays([fixed(full), fixed(mask), begins, docs], schema=self.schema)
        self.writer.write_table(table, max_chunksize=ROWS)
        self.rows += rows
        self.parts, self.held = [flat[real:]], len(flat) - real
        self.starts, self.docs = (starts[here:] - size).tolist(), self.docs[here:]

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.writer.close()


def write_sequences(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode whole texts and write them in ascending id order: ``shard, path, documents, tokens, sequences``.

    Rows are dealt by range of the id, so shard after shard holds ascending ids; null ids come first, rows with equal
    ids follow the hash of their text. Each document ends with ``end_id``; an empty or null text is that id alone.
    Documents run on from one sequence into the next; only a shard's last sequence is padded (``mask`` false).
    A task holds one batch of sequences besides one batch of rows, whatever a shard's size.
    """
    folder = new_folder(docs.sparkSession, "sequences")

    def write(batches):
        out = packer = uri = None
        shard = documents = 0
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if packer is None:
                shard = batch.column(2)[0].as_py()
                uri, out = open_new(folder, ".arrows")
                packer = _Packer(out, length, encode.dtype)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, np.frombuffer(encode.encode(text.as_py()) + end, dtype=encode.dtype))
            documents += batch.num_rows
        if packer is not None:
            packer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [uri], "documents": [documents], "tokens": [packer.tokens], "sequences": [packer.rows]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    numbered = dealt.select("id", "text", F.spark_partition_id().cast("long").alias("shard"))
    return store(numbered.mapInArrow(write, "shard long, path string, documents long, tokens long, sequences long"), "sequence-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """Documents as the files hold them: ``doc_id, start, n_tokens, ids_crc32``, dealt over as many tasks as files.

    ``start`` is the number of ids in all documents before it, over all shards. ``ids_crc32`` covers the ids as
    little-endian unsigned 32-bit integers. A file is read batch by batch; a document that spans batches is carried
    on by its running checksum.
    """

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _documents(path, base)

    order = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one short row per file
    placed = shards.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    # rows are short, what they stand for isn't: as many tasks as files, whatever the rows' bytes
    return placed.repartition(max(1, shards.count()), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(path: str, base: int):
    """Rows of one file; ``base`` ids come before it."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    open_doc, rows = None, []  # [doc, start, n_tokens, crc] of the document that runs on
    with open_old(path) as f, pa.ipc.open_stream(f) as reader:
        at = base
        for batch in reader:
            ids = batch.column("ids").flatten().to_numpy()
            ids = ids[: int(batch.column("mask").flatten().true_count)].astype("<u4")  # padding is at the end only
            length = batch.schema.field("ids").type.list_size
            offsets = batch.column("begins").offsets.to_numpy()
            starts = batch.column("begins").flatten().to_numpy() + np.repeat(np.arange(batch.num_rows), np.diff(offsets)) * length
            stops = [*starts.tolist(), len(ids)]
            if open_doc is not None and stops[0] > 0:
                open_doc[2] += stops[0]
                open_doc[3] = zlib.crc32(ids[: stops[0]].tobytes(), open_doc[3])
            for doc, i, j in zip(batch.column("docs").flatten().to_pylist(), stops, stops[1:], strict=False):
                if open_doc is not None:
                    rows.append(open_doc)
                open_doc = [doc, at + i, j - i, zlib.crc32(ids[i:j].tobytes())]
            at += len(ids)
            if len(rows) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                rows = []
    if open_doc is not None:
        rows.append(open_doc)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


class SequenceFile:
    """Random access to one local file through a memory map; nothing is copied until a mask is unpacked for numpy."""

    def __init__(self, path: str):
        self._map = pa.memory_map(pafs.FileSystem.from_uri(path)[1])
        self._batches = list(pa.ipc.open_stream(self._map))
        self._rows = self._batches[0].num_rows if self._batches else 1
        self.length = self._batches[0].schema.field("ids").type.list_size if self._batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self._batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """``(ids, mask)``: a numpy view of the mapped file, and the Arrow view of the mask."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = self._batches[i // self._rows], i % self._rows
        part = lambda c: batch.column(c).values.slice(row * self.length, self.length)
        return part("ids").to_numpy(zero_copy_only=True), part("mask")
