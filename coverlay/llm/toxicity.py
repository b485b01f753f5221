"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, repeat_rows, runs, utf8
from coverlay.operators.stage import store

_WORD = re.compile(r"[^\W\d_]+")
#: Words in a chain; a text is cut into chains of so many words, each closed by an end tag.
CHAIN = 64


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample and of the model that is fitted on it.

    At most ``documents`` labelled rows of either class are used (those whose id hashes lowest), at most ``chains``
    chains of them (1.4 kB each on the driver), and at most ``features`` features, each seen in ``support`` or more
    toxic documents.
    ``evidence`` is the log-odds from which a word of a toxic document counts as labelled toxic.
    """

    documents: int = 6000
    chains: int = 20_000
    features: int = 50_000
    support: int = 5
    evidence: float = 4.5
    rounds: int = 80
    penalty: float = 1e-5


def features(word: str) -> tuple[str, ...]:
    """A lower-case word as itself, its first 3 to 5 letters and its last 3."""
    return ("w" + word, "3" + word[:3], "4" + word[:4], "5" + word[:5], "e" + word[-3:])


def _forward_backward(emit: np.ndarray, move: np.ndarray):
    """Marginals of tag 1 per place, and of tag pairs per step summed over all chains; log-likelihood's normaliser.

    ``emit``: chains × places, log-odds of tag 1. ``move``: 2 × 2 log weights; a chain starts from and ends in tag 0.
    """
    n, length = emit.shape
    up, t = np.exp(np.clip(emit, -30, 30)), np.exp(move)
    ahead = np.empty((length + 1, n))  # probability of tag 1 given what came so far
    ahead[0] = 0.0
    log_z = np.zeros(n)
    for i in range(length):
        one = ((1 - ahead[i]) * t[0, 1] + ahead[i] * t[1, 1]) * up[:, i]
        zero = (1 - ahead[i]) * t[0, 0] + ahead[i] * t[1, 0]
        ahead[i + 1] = one / (one + zero)
        log_z += np.log(one + zero)
    back0, back1 = np.full(n, t[0, 0]), np.full(n, t[1, 0])  # the end tag
    log_z += np.log((1 - ahead[length]) * back0 + ahead[length] * back1)
    marginal, pairs = np.empty_like(emit), np.zeros((2, 2))
    last1 = ahead[length] * back1 / (ahead[length] * back1 + (1 - ahead[length]) * back0)
    pairs[1, 0] += last1.sum()
    pairs[0, 0] += (1 - last1).sum()
    for i in range(length - 1, -1, -1):
        p1, p0 = ahead[i + 1] * back1, (1 - ahead[i + 1]) * back0
        marginal[:, i] = p1 / (p1 + p0)
        w1, w0 = back1 * up[:, i], back0
        joint = [[(1 - ahead[i]) * t[0, 0] * w0, (1 - ahead[i]) * t[0, 1] * w1], [ahead[i] * t[1, 0] * w0, ahead[i] * t[1, 1] * w1]]
        total = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
        for a in (0, 1):
            for b in (0, 1):
                pairs[a, b] += (joint[a][b] / total).sum()
        back0, back1 = t[0, 0] * w0 + t[0, 1] * w1, t[1, 0] * w0 + t[1, 1] * w1
        scale = back0 + back1
        back0, back1 = back0 / scale, back1 / scale
    return marginal, pairs, log_z


@dataclass
class Crf:
    """Weights per feature, a bias, tag-to-tag weights, and the map from a document's marginals to its score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scorer: tuple[float, float, float] = (0.0, 1.0, 0.0)
    empty: bool = True  # no toxic row to learn from: every score is 0
    _known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        known, weights = self._known, self.weights
        if len(known) > 250_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.bias + sum(weights.get(f, 0.0) for f in features(w))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Probability of the toxic tag for each word of each text; chains of all texts go through together."""
        counts = [len(t) for t in texts]
        emit = self.emissions([w for t in texts for w in t])
        chains = [-(-n // CHAIN) for n in counts]
        grid = np.full((sum(chains), CHAIN), -30.0)  # places after the last word keep tag 0
        first, at, places = 0, 0, []
        for n, c in zip(counts, chains, strict=True):
            grid.reshape(-1)[first * CHAIN : first * CHAIN + n] = emit[at : at + n]
            places.append((first * CHAIN, n))
            first, at = first + c, at + n
        flat = _forward_backward(grid, self.move)[0].reshape(-1) if len(grid) else np.zeros(0)
        return [flat[i : i + n] for i, n in places]

    @staticmethod
    def summary(marginal: np.ndarray) -> tuple[float, float]:
        """A document's evidence: log-odds of its most toxic word, and how many toxic words are expected (log)."""
        if not len(marginal):
            return -12.0, 0.0
        top = float(np.clip(marginal.max(), 6e-6, 1 - 6e-6))
        return float(np.log(top / (1 - top))), float(np.log1p(marginal[marginal > 0.5].sum()))

    def score(self, marginal: np.ndarray) -> float:
        if self.empty:
            return 0.0
        a, b = self.summary(marginal)
        c = self.scorer
        return float(1 / (1 + np.exp(-np.clip(c[0] + c[1] * a + c[2] * b, -50, 50))))


class _Adam:
    def __init__(self, shape, rate):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, gradient):
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-9)


def encode(words: list[str], slot: dict[str, int]) -> np.ndarray:
    """Feature numbers of each word, a row per word; features that the model doesn't know share the last number."""
    nothing = len(slot)
    return np.array([[slot.get(f, nothing) for f in features(w)] for w in words], dtype=np.int32)


def fit_chains(chains: list[tuple[np.ndarray, np.ndarray]], names: list[str], how: Training, block: int = 2048) -> Crf:
    """Maximum likelihood with an L2 penalty on labelled chains: the words' feature numbers and one 0/1 tag for each."""
    nothing, per = len(names), len(features("x"))
    grid = np.full((len(chains), CHAIN, per), nothing, dtype=np.int32)
    tags, real = np.zeros((len(chains), CHAIN), np.int8), np.zeros((len(chains), CHAIN), bool)
    for k, (numbers, marks) in enumerate(chains):
        grid[k, : len(marks)], tags[k, : len(marks)], real[k, : len(marks)] = numbers, marks, True
    weights, bias, move = np.zeros(nothing + 1), -5.0, np.array([[0.0, -1.0], [-1.0, 0.0]])
    adams = _Adam(nothing + 1, 0.2), _Adam((), 0.1), _Adam((2, 2), 0.1)
    seen, edge = np.zeros((2, 2)), np.zeros((len(chains), 1), np.int8)
    np.add.at(seen, (np.hstack([edge, tags]).ravel(), np.hstack([tags, edge]).ravel()), 1)
    scale = max(1.0, float(tags.sum()))
    for _ in range(how.rounds):
        push, total, steps = np.zeros(nothing + 1), 0.0, np.zeros((2, 2))
        for at in range(0, len(chains), block):  # bounds what the driver holds beside the chains themselves
            part = slice(at, at + block)
            emit = np.where(real[part], weights[grid[part]].sum(axis=2) + bias, -30.0)
            marginal, pairs, _ = _forward_backward(emit, move)
            error = np.where(real[part], marginal - tags[part], 0.0)
            push += np.bincount(grid[part].ravel(), np.repeat(error.ravel(), per), nothing + 1)
            total, steps = total + error.sum(), steps + pairs
        push[nothing] = 0
        weights -= adams[0].step(push / scale + how.penalty * weights)
        bias -= float(adams[1].step(total / scale))
        move = move - adams[2].step((steps - seen) / scale)
    return Crf({f: float(w) for f, w in zip(names, weights, strict=False) if w}, float(bias), move, empty=False)


def fit_scorer(evidence: list[tuple[float, float]], toxic: list[int]) -> tuple[float, float, float]:
    """Logistic regression from a document's evidence to its label; classes count alike."""
    x = np.column_stack([np.ones(len(toxic)), np.array(evidence, dtype=float)])
    y, c = np.array(toxic, dtype=float), np.zeros(3)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ c, -50, 50)))
        g = x.T @ (weight * (p - y)) + 1e-4 * c
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
        c = c - np.linalg.solve(h, g)
    return float(c[0]), float(c[1]), float(c[2])


# ---- Spark ----


def held_out(id_col: str):
    """True for rows that no label is learnt from: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, how: Training, id_col: str, text_col: str) -> DataFrame:
    """``text, toxic`` of the labelled rows that are learnt from, at most ``how.documents`` of each class."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("toxic"))
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(how.documents) for y in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])
    rows = docs.select(F.col(id_col).alias("_id"), utf8(text_col).alias("text"))
    return store(rows.join(F.broadcast(picked), "_id").select("text", F.col("toxic").cast("int").alias("toxic")), "toxicity-sample")


def _words(text: bytes) -> list[str]:
    return _WORD.findall(text.decode("utf-8", "replace").lower())


def _feature_counts(sample: DataFrame) -> DataFrame:
    """Documents of each class that hold a feature, counted in each task before the shuffle."""

    def count(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "clean": pa.array([seen[0][f] for f in names], pa.int64()), "toxic": pa.array([seen[1][f] for f in names], pa.int64())})
            seen[0].clear(), seen[1].clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[y].update({f for w in set(_words(text.as_py())) for f in features(w)})
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield flush()
        yield flush()

    parts = sample.select("text", "toxic").mapInArrow(count, "feature string, clean long, toxic long")
    return parts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> Crf:
    """Learn from labelled documents. Texts stay in tasks; the driver gets features with counts, chains and evidence,
    each bounded by ``how``. Without a toxic or without a clean labelled row the model scores everything 0."""
    sample = _sample(docs, labels, how, id_col, text_col)
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Crf()
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    ranked = _feature_counts(sample).where(F.col("toxic") >= how.support).withColumn("odds", odds)
    kept = ranked.orderBy(F.desc("odds"), F.desc("toxic"), "feature").limit(how.features).collect()
    names = [r.feature for r in kept]
    telling = {r.feature for r in kept if r.odds >= how.evidence}

    slot = {f: i for i, f in enumerate(names)}

    def chains(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = _words(text.as_py())
            for i in range(0, len(words), CHAIN):
                part = words[i : i + CHAIN]
                marks = np.array([y and any(f in telling for f in features(w)) for w in part], dtype=np.int8)
                rows.append((bool(marks.any()), y, encode(part, slot).tobytes(), marks.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.bool_(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["marked", "toxic", "words", "marks"]) if rows else None

    made = map_batches(sample, chains, "marked boolean, toxic int, words binary, marks binary")
    # unmarked chains of toxic documents may hold what the counts were too few for: they teach nothing
    made = made.where(F.col("marked") | (F.col("toxic") == 0)).withColumn("lot", F.xxhash64("words"))
    picked = [made.where(F.col("marked") == m).orderBy("lot", "words").limit(how.chains // 2) for m in (True, False)]
    rows = [r for part in picked for r in part.select("words", "marks").toLocalIterator()]
    learnt = [(np.frombuffer(r.words, np.int32).reshape(-1, len(features("x"))), np.frombuffer(r.marks, np.int8)) for r in rows]
    if not any(marks.any() for _, marks in learnt):
        return Crf()
    del rows
    model = fit_chains(learnt, names, how)

    def summaries(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [_words(t.as_py()) for t in batch.column(0)]
        pairs = [model.summary(m) for m in model.marginals(texts)]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]), batch.column(1)], names=["top", "many", "toxic"])

    found = map_batches(sample, summaries, "top double, many double, toxic int").collect()
    model.scorer = fit_scorer([(r.top, r.many) for r in found], [r.toxic for r in found])
    return model


def _judge(text: bytes, marginal: np.ndarray, model: Crf):
    score = model.score(marginal)
    if score < 0.5:
        return score, []
    decoded = text.decode("utf-8", "replace")
    low = decoded.lower()
    at = [m.span() for m in _WORD.finditer(low)]
    if len(low) != len(decoded):  # a few letters grow in lower case: map places back
        back = [i for i, ch in enumerate(decoded) for _ in ch.lower()]
        at = [(back[a], back[b - 1] + 1) for a, b in at]
    return score, [{"start": at[i][0], "end": at[i][1]} for i in np.flatnonzero(marginal >= 0.5).tolist()]


def score(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, held_out, score, predicted, spans``: one row per row of ``docs``, in one narrow pass.

    ``spans`` are the offending words (code points, end exclusive) of documents predicted toxic. Null, empty and
    wordless texts get the score of a text without evidence. Null and repeated ids keep their rows (a null id is never
    held out); other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches):
        for batch in batches:
            texts, scores, spans = [t.as_py() for t in batch.column(2)], [], []
            for part in runs([len(t) for t in texts]):
                for text, marginal in zip(texts[part], model.marginals([_words(t) for t in texts[part]]), strict=True):
                    s, found = _judge(text, marginal, model)
                    scores.append(s)
                    spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=[id_col, "held_out", "score", "predicted", "spans"],
            )

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), utf8(text_col).alias("text"))
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, held_out boolean, score double, predicted int, spans array<struct<start:int,end:int>>")


def clean(docs: DataFrame, model: Crf, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't call toxic, unshuffled and with all columns as they are."""

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        texts, ok = [t.as_py() for t in batch.column(1)], []
        for part in runs([len(t) for t in texts]):
            ok += [model.score(m) < 0.5 for m in model.marginals([_words(t) for t in texts[part]])]
        return np.array(ok, dtype=np.int64)

    return repeat_rows(docs, text_col, keep)
