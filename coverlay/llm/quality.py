"""Quality rules whose thresholds follow each language and source, read from mergeable quantile sketches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverlay.llm.batches import map_batches, utf8
from coverlay.operators.stage import store

_SYMBOLS, _SEPARATORS, _CONTINUED = b"#*$%&|<>", b" \t\n\v\f\r", bytes(range(0x80, 0xC0))
WINDOW = 8
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Fences:
    """A value is odd beyond ``spread`` quartile distances, and ``slack`` at least, outside its group's quartiles.

    A group with fewer than ``least`` documents is judged by its language's merged sketch, a language with fewer by the
    sketch of all. A quartile read from a sketch is within ``accuracy`` times its value of the true one.
    """

    spread: float = 3.0
    least: int = 200
    accuracy: float = 0.002

    @property
    def base(self) -> float:
        """Ratio of the upper to the lower bound of a sketch's bucket."""
        return (1 + self.accuracy) / (1 - self.accuracy)


#: Measure, slack, and whether low values are odd as well as high ones.
_MEASURES = (
    ("word_length", "try_divide(word_chars, n_words)", 1.5, True),
    ("symbols", "try_divide(n_symbols, n_words)", 0.1, False),
    ("dup_lines", "try_divide(n_dup_lines, n_words)", 0.1, False),
    ("repeats", "try_divide(n_repeat_words, n_words)", 0.25, False),
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a run of ``window`` words that the text holds twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    power, length = 0x9E3779B97F4A7C15, 1
    while length < window:  # a hash of each run, by doubling
        h = h[:-length] * np.uint64(power) + h[length:]
        power, length = power * power % (1 << 64), length * 2
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return 0
    left, right = order[same], order[same + 1]
    true = np.fromiter((words[i : i + window] == words[j : j + window] for i, j in zip(left.tolist(), right.tolist(), strict=True)), bool, len(same))
    edge = np.zeros(len(words) + 1, np.int64)
    found = np.unique(np.concatenate((left[true], right[true])))
    np.add.at(edge, found, 1)
    np.add.at(edge, found + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one UTF-8 text."""
    words = text.split()  # on bytes: exactly the separators 0x20 and 0x09-0x0D
    if not words:
        return 0, 0, len(text) - len(text.translate(None, _SYMBOLS)), 0, 0
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), len(text.translate(None, _SEPARATORS + _CONTINUED)), len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words),
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``id``, the columns of ``by`` and the five counts of each whole text (null: no words), without a shuffle."""
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, *by)]
    names = ["id", *[f"group{i}" for i in range(len(by))]]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([measure(t.as_py()) for t in batch.column(len(names))], dtype=np.int64).reshape(-1, len(_FEATURES))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *[pa.array(np.ascontiguousarray(c)) for c in rows.T]], names=[*names, *_FEATURES])

    schema = ", ".join([f"{n} {k}" for n, k in zip(names, kinds, strict=True)] + [f"{f} long" for f in _FEATURES])
    return map_batches(docs.select(F.col(id_col), *[F.col(c) for c in by], utf8(text_col)), one, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


#: Bucket of the value zero, below all others.
_ZERO = -(1 << 30)


def _bucket(value: str, how: Fences) -> Column:
    return F.when(F.expr(value) > 0, F.ceil(F.ln(F.expr(value)) / np.log(how.base)).cast("int")).otherwise(_ZERO)


def sketches(rows: DataFrame, groups: list[str], how: Fences = Fences()) -> DataFrame:
    """The sketches, ``groups, measure, bucket, n``: how many documents have a measure in a bucket ``(base^(b-1), base^b]``.

    Counts are aggregated in each task and merged by adding, so the result depends on the values alone, not on their
    order or partitions; a sketch has some thousand buckets at most, whatever its group's size. Documents that fail the
    base rules don't shape what is usual. Sketches of several tables can be merged by :func:`merged`, so a new delivery
    needs no look at old texts.
    """
    values = F.array(*[F.struct(F.lit(name).alias("measure"), _bucket(value, how).alias("bucket")) for name, value, _, _ in _MEASURES])
    return rows.where(~base_failed()).select(*groups, F.explode(values).alias("_")).groupBy(*groups, "_.measure", "_.bucket").agg(F.count("*").alias("n"))


def merged(parts: DataFrame, groups: list[str]) -> DataFrame:
    return parts.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def _limits(parts: DataFrame, groups: list[str], how: Fences) -> DataFrame:
    """``groups, rows`` and the limits of each measure, from one level's sketches. Windows run over one sketch's buckets."""
    whole = W.partitionBy(*groups, "measure")
    ranked = parts.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(whole.orderBy("bucket"))})
    value = F.when(F.col("bucket") == _ZERO, 0.0).otherwise(F.pow(F.lit(how.base), F.col("bucket")) * (2 / (how.base + 1)))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), value))
    read = ranked.groupBy(*groups, "measure").agg(F.max("total").alias("rows"), quartile(0.25).alias("a"), quartile(0.75).alias("b"))
    out = [F.max("rows").alias("rows")]
    for name, _, slack, both in _MEASURES:
        wide = F.greatest(how.spread * (F.col("b") - F.col("a")), F.lit(slack))
        for side, limit in (("low", F.col("a") - wide if both else F.lit(-1.0)), ("high", F.col("b") + wide)):
            out.append(F.max(F.when(F.col("measure") == name, limit)).alias(f"{name}_{side}"))
    return read.groupBy(*groups).agg(*out)


def fences(parts: DataFrame, groups: list[str], how: Fences = Fences()) -> DataFrame:
    """``groups`` and for each measure ``<measure>_low`` and ``<measure>_high``, from the first level with enough rows.

    Sketches of no rows give no fences.
    """
    last, names = len(groups), [f"{name}_{side}" for name, *_ in _MEASURES for side in ("low", "high")]
    levels = [_limits(parts if not k else merged(parts, groups[: last - k]), groups[: last - k], how) for k in range(last + 1)]
    chosen, used = levels[0].select(*groups, F.col("rows").alias("rows0")), F.lit(last)
    for k in range(1, last):
        keys = groups[: last - k]
        upper = levels[k].select(*[F.col(g).alias(f"_{g}") for g in keys], F.col("rows").alias(f"rows{k}"))
        chosen = chosen.join(upper, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in keys]).drop(*[f"_{g}" for g in keys])
    for k in reversed(range(last)):
        used = F.when(F.col(f"rows{k}") >= how.least, F.lit(k)).otherwise(used)
    chosen = chosen.select(*groups, used.alias("used"))
    all_levels = None
    for k, level in enumerate(levels):
        keys = [(F.col(g) if i < last - k else F.lit(None).cast(parts.schema[g].dataType)).alias(f"_{g}") for i, g in enumerate(groups)]
        level = level.select(F.lit(k).alias("level"), *keys, *names)
        all_levels = level if all_levels is None else all_levels.unionByName(level)
    match = [F.when(F.col("used") < last - i, F.col(g)).eqNullSafe(F.col(f"_{g}")) for i, g in enumerate(groups)]
    return chosen.join(all_levels, [F.col("used") == F.col("level"), *match]).select(*groups, *names)


def judge(
    docs: DataFrame, how: Fences = Fences(), id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """``<id_col>``, the five counts, ``base_failed``, ``kept`` and ``odd`` (the measures outside their fences).

    One row per row of ``docs``. Thresholds come from all documents of a row's language and source that pass the base
    rules; a null language or source is a group like any other. A text without words fails. If no document passes the
    base rules there are no fences and nothing is kept anyway. Repeated rows are counted and judged each; other columns
    are ignored; an empty table gives an empty result. Two runs give the same verdicts. Texts are read once and never shuffled: counts are stored, and
    the fences, a row per group, are joined to them.
    """
    groups = [f"group{i}" for i in range(len(by))]
    rows = store(features(docs, id_col, text_col, by), "quality-counts")
    limits = store(fences(store(sketches(rows, groups, how), "quality-sketches"), groups, how), "quality-fences")
    named = limits.withColumnsRenamed({g: f"_{g}" for g in groups})
    joined = rows.join(named, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups], "left")
    outside = [
        F.when((F.expr(value) < F.col(f"{name}_low")) | (F.expr(value) > F.col(f"{name}_high")), F.lit(name))
        for name, value, _, _ in _MEASURES
    ]
    odd = F.filter(F.array(*outside), lambda x: x.isNotNull())
    return joined.select(
        F.col("id").alias(id_col), *_FEATURES, base_failed().alias("base_failed"), (~base_failed() & (F.size(odd) == 0)).alias("kept"), odd.alias("odd")
    )
