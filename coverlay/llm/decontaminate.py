"""Benchmark passages in documents: q-gram lemma filtering in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, repeat_rows, utf8
from coverlay.llm.shared_files import new_folder
from coverlay.operators.spread import running

_P = 0x9E3779B1


@dataclass(frozen=True)
class Matching:
    """``window`` characters of an item (the whole item if shorter) match with at most ``edits`` of their length.

    A window starts at every character of an item, so any copied passage of ``window`` normalised characters holds a
    whole one. ``q`` is the q-gram length. Items of fewer than ``least`` characters are too short to tell and match
    nothing. ``block`` bounds the item characters that one pass over the documents carries (give or take one item); a
    larger benchmark takes several passes.
    """

    window: int = 80
    q: int = 10
    edits: float = 0.075
    least: int = 30
    block: int = 4_000_000

    def budget(self, length: int) -> int:
        return min(int(length * self.edits), (length - self.q) // self.q)  # the lemma says nothing beyond

    def shared(self, length: int) -> int:
        """q-gram lemma: a match within the budget shares at least so many q-grams."""
        return length + 1 - self.q * (self.budget(length) + 1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point of the basic plane what it counts as: lower case letters and digits, all else a space."""
    out = np.full(1 << 16, 32, dtype=np.uint32)
    for cp in range(1 << 16):
        if not 0xD800 <= cp < 0xE000 and (c := chr(cp)).isalnum():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, offsets)``: letters and digits in lower case, one space for all between, and where each code stood.

    Characters beyond the basic plane count as letters and keep their case.
    """
    codes, table = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4"), _letters()
    codes = table[codes] if len(codes) == 0 or codes.max() < len(table) else np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], codes)
    word = codes != 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    at = np.flatnonzero(keep)
    if len(at) and codes[at[-1]] == 32:
        at = at[:-1]
    return codes[at], at


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of each q-gram, by doubling. Equal hashes of different q-grams only cost an alignment."""
    if len(codes) < q:
        return np.zeros(0, np.uint32)
    power, length, h, out, done, rest = _P, 1, codes.astype(np.uint32), None, 0, q
    while True:
        if rest & 1:
            out = h if out is None else out[: len(out) - length] * np.uint32(power) + h[done:][: len(out) - length]
            done += length
        rest >>= 1
        if not rest:
            return (out ^ (out >> np.uint32(15))) * np.uint32(_P)
        h = h[:-length] * np.uint32(power) + h[length:]
        power, length = power * power % (1 << 32), length * 2


class Patterns:
    """A block of benchmark items and the postings of their q-grams."""

    BITS = 20

    def __init__(self, items: list[tuple[int, str]], how: Matching):
        self.how, self.ids, self.codes, postings = how, [], [], []
        for item, text in items:
            codes, _ = normalise(text or "")
            if len(codes) < max(how.least, how.q):
                continue
            self.ids.append(item)
            self.codes.append(codes)
            postings.append(grams(codes, how.q))
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        hashes = np.concatenate(postings) if postings else np.zeros(0, np.uint32)
        item = np.repeat(np.arange(len(postings)), [len(p) for p in postings])
        place = np.concatenate([np.arange(len(p)) for p in postings]) if postings else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order], place[order]
        self.hashes, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self.hashes >> np.uint32(32 - self.BITS)] = True
        self.least = min((how.shared(min(how.window, len(c))) for c in self.codes), default=1)
        self.half = how.budget(how.window) + 1

    def known(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(places, slots)`` of the text's q-grams that any item has; ``slots`` index ``hashes``."""
        h = grams(codes, self.how.q)
        at = np.flatnonzero(self.seen[h >> np.uint32(32 - self.BITS)])
        if not len(self.hashes) or len(at) < self.least:
            return (np.zeros(0, np.int64),) * 2
        slot = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[slot] == h[at]
        return at[same], slot[same]

    def hits(self, at: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place in text, item, place in item)`` of every q-gram shared at these places."""
        n = self.count[slot]
        posting = np.repeat(self.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[posting], self.place[posting]


#: Shared q-grams that are held at a time.
SLICE = 1_000_000


def _bands(codes: np.ndarray, patterns: Patterns):
    """``(item, first diagonal, places)`` of each diagonal band with enough shared q-grams; an item's bands ascend.

    A band spans ``2 * (budget + 1)`` diagonals and bands overlap by half, so the ``budget + 1`` diagonals that a match
    can use lie within one of them. ``places`` are distinct and ascend. The text is scanned in slices of about
    ``SLICE`` shared q-grams: a band is closed once the text is past its item's end there, and of open ones only
    distinct places are carried on, so long repetitive texts take time but no more memory.
    """
    at, slot = patterns.known(codes)
    n = patterns.count[slot]
    if n.sum() < patterns.least:
        return
    piece = (np.cumsum(n) - n) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(at)]
    item, band, place = (np.zeros(0, np.int64),) * 3
    for i, j in zip(cuts, cuts[1:]):
        where, it, pl = patterns.hits(at[i:j], slot[i:j])
        if len(cuts) == 2:  # the whole text at once: items with too few hits have no band that reaches the bound
            often = np.bincount(it, minlength=len(patterns.codes))[it] >= patterns.least
            where, it, pl = where[often], it[often], pl[often]
        b = np.floor_divide(where - pl, patterns.half)
        item, band, place = np.concatenate([item, it, it]), np.concatenate([band, b, b - 1]), np.concatenate([place, pl, pl])
        key = np.lexsort((place, band, item))
        item, band, place = item[key], band[key], place[key]
        new_band = np.concatenate(([True], (np.diff(item) != 0) | (np.diff(band) != 0)))[: len(item)]
        once = new_band | np.concatenate(([True], np.diff(place) != 0))[: len(item)]
        item, band, place = item[once], band[once], place[once]
        closed = np.ones(len(item), bool) if j == len(at) else (band + 2) * patterns.half + patterns.sizes[item] <= at[j]
        done_item, done_band, done = item[closed], band[closed], place[closed]
        item, band, place = item[~closed], band[~closed], place[~closed]
        edges = np.flatnonzero((np.diff(done_item) != 0) | (np.diff(done_band) != 0)) + 1
        starts, stops = np.concatenate(([0], edges)), np.concatenate((edges, [len(done)]))
        for k in np.flatnonzero(stops - starts >= patterns.least):
            yield int(done_item[starts[k]]), int(done_band[starts[k]]) * patterns.half, done[starts[k] : stops[k]]


def _starts(places: np.ndarray, size: int, how: Matching) -> np.ndarray:
    """Starts of all windows of an item of ``size`` that hold enough of the distinct, ascending ``places``: one linear pass."""
    length = min(how.window, size)
    need, last = how.shared(length), size - length
    if len(places) < need:
        return np.zeros(0, np.int64)
    lo = np.maximum(places[need - 1 :] - (length - how.q), 0)
    hi = np.minimum(places[: len(places) - need + 1], last)
    some = lo <= hi
    change = np.bincount(lo[some], minlength=last + 2) - np.bincount(hi[some] + 1, minlength=last + 2)
    return np.flatnonzero(np.cumsum(change)[: last + 1] > 0)


def align(patterns: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(edits, starts, ends)``: the best place of each pattern, as a whole, in the text of the same row.

    Banded edit distance over all rows of two matrices at once: a text's free start is the band itself, as wide as
    texts are longer than patterns. Ties take the earliest end.
    """
    rows, m = patterns.shape
    width = texts.shape[1] - m + 1
    slots = np.arange(width, dtype=np.int32)
    cost, origin = np.zeros((rows, width), np.int32), np.tile(slots, (rows, 1))  # row 0: a match may begin anywhere in the band
    far, none = np.full((rows, 1), m + texts.shape[1] + 1, np.int32), np.zeros((rows, 1), np.int32)
    for i in range(m):
        # pattern character without a text character, against both
        down, straight = np.concatenate((cost[:, 1:] + 1, far), axis=1), cost + (texts[:, i : i + width] != patterns[:, i : i + 1])
        origin = np.where(down < straight, np.concatenate((origin[:, 1:], none), axis=1), origin)
        best = np.minimum(down, straight)
        # text characters without a pattern character: cheapest slot to the left plus the distance
        shifted = best - slots
        low = np.minimum.accumulate(shifted, axis=1)
        cost = low + slots
        if (better := cost < best).any():
            left = np.maximum.accumulate(np.where(shifted == low, slots, 0), axis=1)
            origin = np.where(better, np.take_along_axis(origin, left, axis=1), origin)
    k = np.argmin(cost, axis=1)
    every = np.arange(rows)
    return cost[every, k], origin[every, k], m + k


#: Windows that are aligned at a time.
_ALIGNED = 512


def _matches(codes: np.ndarray, patterns: Patterns):
    """``(item, windows, edits, starts, ends)``, arrays but for the item, of windows that match within the budget.

    A window found without edits is not aligned again: bands ascend, so whatever follows is later in the text.
    """
    how, half, padded, exact = patterns.how, patterns.half, None, {}
    for it, diagonal, places in _bands(codes, patterns):
        windows = _starts(places, len(patterns.codes[it]), how)
        if it in exact:
            windows = windows[~exact[it][windows]]
        length = min(how.window, len(patterns.codes[it]))
        budget = how.budget(length)
        pad = 4 * half + 2 * how.window + 2 * how.budget(how.window)
        for i in range(0, len(windows), _ALIGNED):
            if padded is None:  # zeros match nothing; a match may lack its start or end
                padded = np.concatenate((np.zeros(pad, codes.dtype), codes, np.zeros(pad, codes.dtype)))
            w = windows[i : i + _ALIGNED]
            lo = diagonal + w - budget
            parts = padded[(lo + pad)[:, None] + np.arange(length + 2 * half + 2 * budget)]
            edits, a, b = align(patterns.codes[it][w[:, None] + np.arange(length)], parts)
            good = edits <= budget
            if good.any():
                w, edits, a, b = w[good], edits[good], np.maximum(lo + a, 0)[good], np.minimum(lo + b, len(codes))[good]
                exact.setdefault(it, np.zeros(len(patterns.codes[it]), bool))[w[edits == 0]] = True
                yield it, w, edits, a, b


def holds_any(text: str, patterns: Patterns) -> bool:
    """Whether any item has a match; the search ends with the first."""
    return any(True for _ in _matches(normalise(text)[0], patterns))


def find(text: str, patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """``(item id, start, end, edits, windows)`` for each item with a match: code points of ``text``, end exclusive.

    ``start`` and ``end`` span the best match of each of the item's windows, ``edits`` is the fewest of any window,
    ``windows`` is how many match.
    """
    codes, offsets = normalise(text)
    best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for it, w, edits, a, b in _matches(codes, patterns):
        if it not in best:
            best[it] = tuple(np.full(len(patterns.codes[it]), -1, np.int64) for _ in range(3))
        seen = best[it]
        better = (seen[0][w] < 0) | (edits < seen[0][w]) | ((edits == seen[0][w]) & (a < seen[1][w]))
        for have, new in zip(seen, (edits, a, b), strict=True):
            have[w[better]] = new[better]
    out = []
    for it, (edits, a, b) in sorted(best.items()):
        some = edits >= 0
        start, end = int(a[some].min()), int(b[some].max())
        out.append((patterns.ids[it], int(offsets[min(start, len(offsets) - 1)]), int(offsets[end - 1]) + 1, int(edits[some].min()), int(some.sum())))
    return out


_FOUND = [("doc", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("windows", pa.int32())]


def contamination(
    docs: DataFrame, benchmark: DataFrame, how: Matching = Matching(), id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``<id_col>, item_id, start, end, edits, windows``: one row per document row and benchmark item found in it.

    The benchmark is the stated query set: it is written in blocks of about ``how.block`` characters to the shared
    folder, where tasks read them, and each block is a pass over all documents. Whole texts are searched, documents aren't shuffled. Null and empty texts and items
    match nothing; repeated rows are each searched; a null id is kept; repeated items give one row each; other
    columns are ignored; an empty table on either side gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id long, start long, `end` long, edits int, windows int"
    names = [id_col, "item_id", "start", "end", "edits", "windows"]
    out = None
    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text)).where(F.col(item_text).isNotNull())
    for block in _blocks(items, how.block):
        def search(batch: pa.RecordBatch, block=block) -> pa.RecordBatch | None:
            patterns = _patterns(block, how)
            texts, rows, found = batch.column(1), [], []
            for i, text in enumerate(texts):
                for hit in find(text.as_py().decode("utf-8", "replace"), patterns):
                    rows.append(i)
                    found.append(hit)
            if not rows:
                return None
            columns = [pa.array(c, t) for c, (_, t) in zip(zip(*found, strict=True), _FOUND[1:], strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], names=names)

        part = map_batches(docs.select(F.col(id_col), utf8(text_col)), search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


@lru_cache(maxsize=1)
def _patterns(block: str, how: Matching) -> Patterns:
    system, path = pafs.FileSystem.from_uri(block)
    rows = pq.read_table(path, columns=["item", "body"], filesystem=system, partitioning=None).to_pylist()
    return Patterns(sorted(((r["item"], r["body"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])), how)


def _blocks(items: DataFrame, most: int) -> list[str]:
    """Folders with the items in blocks of about ``most`` characters, in id order; only their names reach the driver."""
    rows = items.toDF("item", "body").withColumns({"all": F.lit(0), "size": F.length("body").cast("long")})
    placed = running(rows, ["all"], ["item", "body"], ["size"])
    folder = new_folder(items.sparkSession, "benchmark")
    numbered = placed.select("item", "body", F.floor((F.col("size_upto") - F.col("size")) / most).alias("block"))
    numbered.write.partitionBy("block").parquet(folder)
    blocks = numbered.select("block").distinct().collect()  # one short row per pass
    return [f"{folder}/block={b}" for b in sorted(r.block for r in blocks)]


def clean(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark passage, unshuffled and with all columns as they are.

    The search runs once per row, ends with its first match, and only its verdict is kept. Rows with null or empty
    texts stay; repeated rows are judged alike; an empty table on either side gives ``docs`` as it is.
    """
    out = docs
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text")).where(F.col("text").isNotNull())
    for block in _blocks(items, how.block):
        def keep(batch: pa.RecordBatch, block=block) -> np.ndarray:
            patterns = _patterns(block, how)
            return np.array([not holds_any(t.as_py().decode("utf-8", "replace"), patterns) for t in batch.column(1)], dtype=np.int64)

        out = repeat_rows(out, text_col, keep)
    return out
