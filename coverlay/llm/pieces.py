"""SentencePiece ids of whole texts through a table of distinct marked words, and back."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, runs, utf8

#: The marker that stands for a space, as in the vocabulary.
MARK = "▁"
#: Distinct words that each half of a worker's table holds between batches, and the longest of them.
REMEMBERED, LONGEST = 100_000, 64

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class PieceEncoder:
    """Ids of texts for a model whose pieces hold markers at their front only.

    Such a piece never reaches over the end of a word, so merges in one marked word (its markers and what follows up
    to the next ones) don't depend on the words around it. A text is cut there; the distinct words of many texts form a
    table, each is segmented once by the library, and the ids are joined back at the words' places.
    Models that pieces of other shapes, a normaliser or another treatment of spaces make different are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self._check()
        # a marker alone: the library adds one in front of a text, but not of an empty one
        self._alone = array("i", [self.model.piece_to_id(MARK)]).tobytes()
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _check(self) -> None:
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model reach across words; its words can't be segmented one by one")
        for sample in ("Ａééﬁ 　x", "  a  b  ", " ", "\ta\n"):
            if self.model.decode(self.model.encode(sample)) != sample:
                raise ValueError("this model changes texts before it cuts them; its words can't be segmented one by one")

    def _segment(self, words: list[str]) -> list[bytes]:
        found = self.model.encode(words, num_threads=1)  # the library puts the first marker back
        return [array("i", ids).tobytes() if w else self._alone for w, ids in zip(words, found, strict=True)]

    @staticmethod
    def words(text: str) -> list[str]:
        """Marked words of a text in their order, each without its first marker."""
        if "  " not in text and MARK not in text and not text.startswith(" "):
            return text.split(" ") if text else []
        return [w[1:] for w in _CHUNK.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers in the machine's order, without an end id."""
        places = [self.words(t) for t in texts]
        table, old = self._young, self._old
        missing = list(set().union(*places).difference(table))
        new = [w for w in missing if w not in old]
        table.update((w, old[w]) for w in missing if w in old)
        table.update(zip(new, self._segment(new), strict=True))
        out = [b"".join(map(table.__getitem__, words)) for words in places]
        for w in new:
            if len(w) > LONGEST:
                del table[w]
        if len(table) > REMEMBERED:
            self._old, self._young = table, {}
        return out


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and model, so that its table serves all tasks of the worker."""
    return PieceEncoder(path)


def _encoded(batches, model: str, back: bool):
    """``id, ids`` and, if ``back``, the text that they decode to; a step of texts at a time."""
    use = piece_encoder(model)
    end = array("i", [use.model.eos_id()]).tobytes()
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_pylist()
        for part in runs(sizes):
            rows = batch.slice(part.start, part.stop - part.start)
            found = [ids + end for ids in use.encode([t.decode("utf-8", "replace") for t in rows.column(1).to_pylist()])]
            cuts = np.concatenate(([0], np.cumsum([len(r) // 4 for r in found]))).astype(np.int32)
            columns = [rows.column(0), pa.ListArray.from_arrays(cuts, np.frombuffer(b"".join(found), np.int32))]
            if back:
                columns.append(pa.array(use.model.decode([memoryview(r).cast("i").tolist() for r in found], num_threads=1), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][: len(columns)])


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """``<id_col>, ids`` for every row: ids of the whole text and the model's end id; with ``back`` also ``decoded``, their text.

    ``model`` is a path that every task can read. A null or empty text is the end id alone. Repeated rows and null ids keep
    their rows; other columns are ignored, whatever their names; an empty table gives an empty result. No shuffle; a task
    holds one step of texts and its table of words, of which it keeps a bounded number from step to step.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    found = rows.mapInArrow(lambda batches: _encoded(batches, model, back), f"id {kind}, ids array<int>" + ", decoded string" * back)
    return found.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids, as the library decodes them. Null ids are an empty text."""
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(encoded.schema.fields)]
    at = encoded.columns.index(ids_col)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(at).fill_null([]) if batch.column(at).null_count else batch.column(at)
        flat, cuts = ids.values.to_numpy(), ids.offsets.to_pylist()
        texts = piece_encoder(model).model.decode([flat[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)], num_threads=1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f"c{i}" for i in range(len(batch.columns) + 1)])

    return map_batches(encoded, one, ", ".join([*kinds, f"c{len(kinds)} string"])).toDF(*encoded.columns, text_col)


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_tokens, ids_sha256, decoded_sha256``: digests of a text's ids and of what they decode to."""
    return encode(docs, model, id_col, text_col, back=True).select(
        id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
