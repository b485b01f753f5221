"""Secret scans through a trigram inverted index over each block of documents."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, runs, utf8
from coverlay.llm.literals import trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches whose ``group`` has ``least`` or more characters. ASCII classes and case rules."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# fixed values: the base rules
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),  # runs are as long as can be, so shorter ones needn't be matched
)
#: Well-known token forms that the base rules miss or cut short.
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("source_host", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("maps", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)


class TrigramIndex:
    """The rules' Boolean trigram queries, and for a block of texts the postings of just those trigrams."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
        grams = sorted({g for q in self.queries for any_of in q for all_of in any_of for g in all_of if g.isascii()})
        self.slot = {g: i + 1 for i, g in enumerate(grams)}
        self.table = np.zeros(1 << 24, np.uint16)
        for g, i in self.slot.items():
            a, b, c = g.encode()
            self.table[a << 16 | b << 8 | c] = i

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """Row per trigram, column per text: is it in the text, letters A-Z as a-z?"""
        out = np.zeros((len(self.slot) + 1, len(texts)), bool)
        joined = np.frombuffer(b"\0\0".join(texts).lower(), np.uint8).astype(np.uint32)
        if len(joined) < 3:
            return out
        found = self.table[joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 2 for t in texts])
        out[found[at], np.searchsorted(ends, at, side="right")] = True
        return out

    def candidates(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each rule the texts to verify: intersections and unions of postings; all texts if nothing is mandatory."""
        posted, out = self.postings(texts), []
        for query in self.queries:
            ok = np.ones(len(texts), bool)
            for any_of in query:
                # trigrams beyond ASCII aren't indexed: they narrow nothing
                ok &= np.any([np.all(posted[[self.slot[g] for g in all_of if g in self.slot]], axis=0) for all_of in any_of], axis=0)
            out.append(np.flatnonzero(ok))
        return out

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Verified ``(start, rule, end)`` in code points for each text, by start and then by rule."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        for k, (rule, rows) in enumerate(zip(self.rules, self.candidates(texts), strict=True)):
            search = self.compiled[k].finditer
            for i in rows.tolist():
                if i not in decoded:
                    decoded[i] = texts[i].decode("utf-8", "replace")
                for m in search(decoded[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        return [sorted(f) for f in found]


@lru_cache(maxsize=4)
def _index(rules: tuple[Rule, ...]) -> TrigramIndex:
    return TrigramIndex(rules)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + FURTHER, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``<id_col>, spans``: one row per row of ``docs`` with all spans (``kind, start, end``), by start and rule order.

    ``start`` and ``end`` are code points of the whole text, end exclusive; matches of one rule don't overlap. Tasks
    index and scan a block of texts at a time, without a shuffle. Null is an empty text; a very long text is a block of
    its own. Null and repeated ids keep their rows; other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, texts, out = _index(rules), [t.as_py() for t in batch.column(1)], []
        for part in runs([len(t) for t in texts]):
            out += index.spans(texts[part])
        spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in row] for row in out]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], names=[id_col, "spans"])

    return map_batches(docs.select(F.col(id_col), utf8(text_col)), one, f"`{id_col}` {kind}, spans array<struct<kind:string,start:int,end:int>>")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a SHA-256 of the base spans and all spans as text, from :func:`scan`'s rows."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select(id_col, *counts, F.sha2(named(of(*[r.kind for r in BASE])), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
