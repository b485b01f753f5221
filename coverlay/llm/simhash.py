"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, record, utf8
from coverlay.llm.components import components
from coverlay.operators.stage import store

BITS = 64
#: Shingles whose bits are counted at a time; bounds memory on very long texts.
_BLOCK = 1 << 15


def _shingles(text: bytes, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 values of a text's word shingles, a block at a time; a text of fewer words is one shingle, without words none."""
    words = text.lower().split()  # on bytes: A-Z only, and exactly the separators 0x20 and 0x09-0x0D
    if not words:
        return
    ends = np.cumsum([len(w) + 1 for w in words])
    joined, starts = b" ".join(words), np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    stops = ends[shingle - 1 :] - 1 if len(words) >= shingle else ends[-1:] - 1
    hashed, starts, stops = xxhash.xxh64_intdigest, starts[:n].tolist(), stops.tolist()
    for at in range(0, n, _BLOCK):
        yield np.array([hashed(joined[i:j], seed) for i, j in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK], strict=True)], "<u8")


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of word shingles: a bit is 1 if it is set in over half of the shingles' XXH64 values."""
    n, counts = 0, np.zeros(BITS, np.int64)
    for values in _shingles(text, shingle, seed):
        n += len(values)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for few in range(0, len(bits), 255):  # a byte holds the count of so many rows
            counts += bits[few : few + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``id, fp``: a signed 64-bit fingerprint per row. Null and wordless texts have fingerprint 0; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return map_batches(docs.select(F.col(id_col), utf8(text_col)), one, f"id {kind}, fp long")


# ---- the index inside one task: a tree over fingerprints in Gray order ----


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray code; neighbours in this order differ in few bits."""
    out, shift = values.copy(), 1
    while shift < BITS:
        out ^= out >> np.uint64(shift)
        shift *= 2
    return out


class GrayTree:
    """Fingerprints in Gray order under nodes that factor out shared bits.

    A node of level ``k`` spans ``FAN`` nodes of the level below. ``masks[k]`` marks the bits that all its members
    share and that no node above holds, ``patterns[k]`` their values, so a search adds up differences on its way down.
    """

    FAN = 16

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        ands, ors = [self.values], [self.values]
        while len(ands[-1]) > 1:
            at = np.arange(0, len(ands[-1]), self.FAN)
            ands.append(np.bitwise_and.reduceat(ands[-1], at))
            ors.append(np.bitwise_or.reduceat(ors[-1], at))
        shared = [~(a ^ o) for a, o in zip(ands, ors, strict=True)]
        self.masks = [shared[-1]] if len(shared) == 1 else [
            m & ~np.repeat(up, self.FAN)[: len(m)] for m, up in zip(shared, shared[1:], strict=False)
        ] + [shared[-1]]
        self.patterns = [a & m for a, m in zip(ands, self.masks, strict=True)]

    def _spans(self, label: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Smallest and largest label below each node of each level."""
        out = [(label, label)]
        for below in self.masks[:-1]:
            at = np.arange(0, len(below), self.FAN)
            out.append((np.minimum.reduceat(out[-1][0], at), np.maximum.reduceat(out[-1][1], at)))
        return out

    def forest(self, most: int, chunk: int = 1 << 16) -> np.ndarray:
        """Pairs of positions in ``values`` that span the components of "at most ``most`` bits differ".

        Every fingerprint searches the tree. A node is left with all below it once its differences exceed ``most``,
        or if all below it are in the searcher's component already, which can't change the components.
        """
        n, links = len(self.values), []
        label = np.arange(n)
        spans, top, fan = self._spans(label), len(self.masks) - 1, np.arange(self.FAN)
        todo = [(top, q := np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64))]
        while todo:
            level, q, node, diff = todo.pop()
            if len(q) > chunk:
                todo += [(level, q[i : i + chunk], node[i : i + chunk], diff[i : i + chunk]) for i in range(0, len(q), chunk)]
                continue
            low, high = spans[level]
            new = (low[node] != label[q]) | (high[node] != label[q])
            q, node, diff = q[new], node[new], diff[new]
            diff = diff + np.bitwise_count((self.values[q] ^ self.patterns[level][node]) & self.masks[level][node])
            near = diff <= most
            q, node, diff = q[near], node[near], diff[near]
            if level:
                node = (node[:, None] * self.FAN + fan).ravel()
                q, diff = np.repeat(q, self.FAN), np.repeat(diff, self.FAN)
                ok = (node < len(self.masks[level - 1])) & ((node + 1) * self.FAN ** (level - 1) > q)  # each pair once
                todo.append((level - 1, q[ok], node[ok], diff[ok]))
                continue
            before = len(links)
            for a, b in zip(q.tolist(), node.tolist(), strict=True):
                if (x := label[a]) != (y := label[b]):
                    label[label == max(x, y)] = min(x, y)
                    links.append((a, b))
            if len(links) > before:
                spans = self._spans(label)
        return np.array(links, dtype=np.int64).reshape(-1, 2)


# ---- top nodes as Spark keys ----


def _split(mask: int, parts: int) -> list[int]:
    """The bits of ``mask`` in ``parts`` runs of near equal length."""
    bits = [i for i in range(BITS) if mask >> i & 1]
    cuts = [round(len(bits) * k / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def top_nodes(fps: DataFrame, most: int, group: int = 4096, levels: int = 3) -> DataFrame:
    """Fingerprints under the top nodes that hold them: ``mask, pattern, run, fp``; every close pair meets in a node.

    Two values that differ in at most ``most`` bits agree on one of ``most + 1`` blocks, so a node for each block
    value is enough. A node with more than ``group`` members is replaced by nodes that hold a further block of the
    remaining bits. What is still larger after ``levels`` (members that share about half of all bits) is dealt into
    runs by hash, and each pair of runs becomes a node of its own; nothing is left out.
    """
    full, masks = (1 << BITS) - 1, [0]
    here = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    done = None
    for level in range(levels):
        finer = {m: [m | part for part in _split(full & ~m, most + 1)] for m in masks}
        branch = F.coalesce(*[
            F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(x)).cast("long") for x in sub])) for m, sub in finer.items()
        ])
        here = here.select(F.explode(branch).alias("mask"), "fp").withColumn("pattern", F.expr("fp & mask"))
        masks = [x for sub in finer.values() for x in sub]
        large = store(here.groupBy("mask", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > group), "large-nodes")
        small = here.join(large, ["mask", "pattern"], "left_anti").select("mask", "pattern", F.lit("").alias("run"), "fp")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done
        here = here.join(large, ["mask", "pattern"]).select("mask", "pattern", "n", "fp")
        if level < levels - 1:
            here = here.select("mask", "fp")
    runs = F.ceil(F.col("n") / group)
    mine = F.pmod(F.xxhash64("fp"), runs)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), runs - 1), lambda r: F.concat_ws("-", F.least(r, mine), F.greatest(r, mine)))
    return done.unionByName(here.select("mask", "pattern", F.explode(pairs).alias("run"), "fp"))


def links(nodes: DataFrame, most: int) -> DataFrame:
    """``a, b``: links that keep together what belongs together in each top node, found in a tree per node.

    A task reads its nodes one after the other from sorted rows; it holds one node's members at a time.
    """
    link = [("a", pa.int64()), ("b", pa.int64())]

    def search(batches):
        held: list[np.ndarray] = []
        key = None

        def flush():
            if sum(map(len, held)) < 2:
                return None
            tree = GrayTree(np.unique(np.concatenate(held)))
            found = tree.forest(most)
            ends = tree.values.view(np.int64)
            return record(link, *(ends[found[:, i]] for i in (0, 1))) if len(found) else None

        for batch in batches:
            if not batch.num_rows:
                continue
            mask, pattern = (batch.column(i).to_numpy() for i in (0, 1))
            run, names = batch.column(2).dictionary_encode().indices.to_numpy(), batch.column(2)
            fp = batch.column(3).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(pattern) != 0) | (np.diff(run) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)], strict=True):
                this = (mask[i], pattern[i], names[i].as_py())
                if this != key:
                    if (out := flush()) is not None:
                        yield out
                    held, key = [], this
                held.append(fp[i:j])
        if (out := flush()) is not None:
            yield out

    dealt = nodes.repartition("mask", "pattern", "run").sortWithinPartitions("mask", "pattern", "run")
    return dealt.select("mask", "pattern", "run", "fp").mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4, shingle: int = 4, seed: int = 42,
    group: int = 4096,
) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>, fingerprint, component_id``.

    Fingerprints link at ``most`` or fewer differing bits; ``component_id`` is the smallest id that links reach, the
    row's own included. Equal fingerprints are one node of the graph, so copies cost one row. Null and wordless texts
    have fingerprint 0, linked like any other. Repeated ids keep their rows; a null id gets a fingerprint and its
    component's smallest id that isn't null (null if there is none). Other columns are ignored, so their names can't
    clash. An empty table gives an empty result.
    """
    rows = store(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    named = _named(nodes, links(top_nodes(nodes.select("fp"), most, group), most))
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``fp, component_id``: the smallest ``least`` in each fingerprint's component."""
    roots = components(found)
    placed = store(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(heads, "root").select("fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4, shingle: int = 4, seed: int = 42, group: int = 4096,
) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the smallest id, null last, then by a hash of its text.

    Components are those of :func:`near_duplicates`, so all texts without words (null, empty, white space) are one.
    Ids needn't be unique: rows are told apart by id and text, and of rows that share both one stays. All columns
    come back, whatever their names; an empty table gives an empty one.
    """
    mark = F.md5(utf8(text_col))
    marked = docs.select(F.struct(F.col(id_col).alias("id"), mark.alias("mark")).alias("key"), F.col(text_col).alias("text"))
    rows = store(fingerprints(marked, "key", "text", shingle, seed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("id.id").isNull().alias("none"), "id.id", "id.mark")).alias("least"))
    nodes = store(nodes, "nodes")
    roots = components(links(top_nodes(nodes.select("fp"), most, group), most))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
    heads = store(placed.select(F.col("least.id").alias("_id"), F.col("least.mark").alias("_mark")), "kept")
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), mark.alias("_mark"))
    kept = keyed.join(heads, keyed["_id"].eqNullSafe(heads["_id"]) & (keyed["_mark"] == heads["_mark"]), "left_semi")
    repeated = store(kept.groupBy("_id", "_mark").count().where("count > 1").select("_id", "_mark"), "repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    same = [kept["_id"].eqNullSafe(repeated["_id"]), kept["_mark"] == repeated["_mark"]]
    once, twice = kept.join(repeated, same, "left_anti"), kept.join(repeated, same, "left_semi")
    first = twice.groupBy("_id", "_mark").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return once.select("row.*").unionByName(first.select("row.*"))
