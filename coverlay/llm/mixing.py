"""Mixing to target weights: soft domain membership, and document rates by projected-gradient least squares."""

from __future__ import annotations

import warnings
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches, repeat_rows, utf8
from coverlay.operators.stage import store


#: Gradient steps after which a fit that isn't near its targets goes on by Newton steps.
_PATIENCE = 20


@dataclass(frozen=True)
class Learning:
    """Bounds of the classifier: labelled rows used per domain (those whose id hashes lowest), and words known.

    Evidence of a text is worth ``weight`` words at most, so long texts keep soft memberships.
    """

    documents: int = 3000
    words: int = 50_000
    weight: float = 12.0


@dataclass(frozen=True)
class Fit:
    """``total`` tokens to plan for, as a multiple of the corpus (None: the least that shrinks no domain). No rate is
    below ``least_rate``; ``pull`` draws rates to 1, less so where it alone would keep a domain from its target by more than
    the relative error ``close``. Gradient steps end at that error, or after ``rounds``; then Newton steps, which must settle in
    as many."""

    total: float | None = 1.0
    least_rate: float = 0.0
    pull: float = 1e-4
    close: float = 1e-3
    rounds: int = 60


@dataclass
class Domains:
    """Naive Bayes over words: log-odds rows per known word, priors, and the order of domains."""

    names: list[str]
    rows: dict[str, int] = field(default_factory=dict)
    logs: np.ndarray = field(default_factory=lambda: np.zeros((1, 1)))
    prior: np.ndarray = field(default_factory=lambda: np.zeros(1))
    weight: float = 12.0

    def membership(self, text: bytes) -> tuple[int, np.ndarray]:
        """``(words, posterior of each domain)`` of one text. A text without known words has the priors."""
        words = text.lower().split()
        known = [r for r in map(self.rows.get, words) if r is not None]
        score = self.prior.copy()
        if known:
            score += self.logs[known].mean(axis=0) * min(self.weight, len(known))
        p = np.exp(score - score.max())
        return len(words), p / p.sum()


def _sample(docs, labelled, domains, how, id_col, text_col, domain_col) -> DataFrame:
    known = labelled.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(domain_col).alias("domain")).dropDuplicates(["_id"])
    parts = [known.where(F.col("domain") == d).orderBy(F.xxhash64("_id"), "_id").limit(how.documents) for d in domains]
    picked = parts[0]
    for part in parts[1:]:
        picked = picked.unionByName(part)
    rows = docs.select(F.col(id_col).alias("_id"), utf8(text_col).alias("text"))
    return store(rows.join(F.broadcast(picked), "_id").select("text", "domain"), "mixing-sample")


def learn(
    docs: DataFrame, labelled: DataFrame, domains: list[str], how: Learning = Learning(), id_col: str = "doc_id", text_col: str = "text",
    domain_col: str = "lang",
) -> Domains:
    """Fit the classifier on the texts of labelled rows (``id_col, domain_col``), a bounded number per domain.

    Words are counted where the texts are; the driver gets ``how.words`` counts per domain at most. Rows of other
    domains, without an id or without a text in ``docs`` teach nothing; without any, all domains are equally likely.
    """
    names, k = sorted(domains), len(domains)
    place = {d: i for i, d in enumerate(names)}
    sample = _sample(docs, labelled, names, how, id_col, text_col, domain_col)

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text, d in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen.update((w, place[d]) for w in text.as_py().lower().split() if len(w) < 200)
                if len(seen) > 300_000:
                    yield _counted(seen)
        yield _counted(seen)

    counts = sample.mapInArrow(count, "word binary, domain int, n long").groupBy("word", "domain").agg(F.sum("n").alias("n"))
    per_word = counts.groupBy("word").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("by"))
    top = per_word.orderBy(F.desc("total"), "word").limit(how.words).collect()
    table = np.array([[r.by.get(i, 0) for i in range(k)] for r in top], dtype=float).reshape(-1, k) + 0.1
    docs_of = {r.domain: r.n for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    prior = np.log(np.array([docs_of.get(d, 0) for d in names], dtype=float) + 1)
    logs = np.log(table / table.sum(axis=0)) if len(table) else np.zeros((0, k))
    return Domains(names, {bytes(r.word): i for i, r in enumerate(top)}, logs, prior - prior.max(), how.weight)


def _counted(seen: Counter) -> pa.RecordBatch:
    rows = list(seen.items())
    seen.clear()
    return pa.RecordBatch.from_arrays(
        [pa.array([w for (w, _), _ in rows], pa.binary()), pa.array([d for (_, d), _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())],
        names=["word", "domain", "n"],
    )


def memberships(docs: DataFrame, model: Domains, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, u, n_tokens, p``: words and posteriors of every row; ``u`` is a number in [0, 1) drawn from id and text."""
    kind, u = docs.schema[id_col].dataType.simpleString(), F.xxhash64(F.col(id_col), F.col(text_col)) / F.lit(2.0**64) + 0.5

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.membership(t.as_py()) for t in batch.column(2)]
        flat = pa.array(np.concatenate([p for _, p in found]))
        p = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(model.names), pa.int32()), flat)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()), p], names=["id", "u", "n_tokens", "p"])

    return map_batches(docs.select(F.col(id_col), u, utf8(text_col)), one, f"id {kind}, u double, n_tokens long, p array<double>")


@dataclass
class Rates:
    """A fitted plan. A document's rate follows from its posterior alone: it replays the steps of the descent, or is
    ``max(least, 1 + posterior · lean)`` if there is a ``lean``."""

    names: list[str]
    step: float = 0.0
    pull: float = 0.0
    least: float = 0.0
    gradients: list[np.ndarray] = field(default_factory=list)
    lean: np.ndarray | None = None
    tokens: list[np.ndarray] = field(default_factory=list)  # expected domain tokens before each pass and after the last
    target: np.ndarray = field(default_factory=lambda: np.zeros(0))
    error: float = 0.0  # largest relative distance of a domain's tokens from its target

    def of(self, p: np.ndarray) -> np.ndarray:
        """Rates of documents, a row of posteriors each."""
        if self.lean is not None:
            return np.maximum(self.least, 1 + p @ self.lean)
        r = np.full(len(p), max(1.0, self.least))
        for g in self.gradients:
            r = np.maximum(self.least, r - self.step * (p @ g + self.pull * (r - 1)))
        return r


def _posteriors(batch: pa.RecordBatch, column: int, k: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, k)


def fit(rows: DataFrame, names: list[str], weights: dict[str, float], how: Fit = Fit()) -> Rates:
    """Nonnegative rates whose expected domain tokens (rate × tokens × posterior) match ``weights`` of the total.

    Minimises the squared relative errors of domain totals plus ``pull`` times the token-weighted squares of rate - 1,
    by projected gradient steps in the token-weighted metric. Where the first 20 of them don't come near the targets, as on
    a corpus skewed to a domain with a small one, the minimum itself is computed: there a rate is
    ``max(least_rate, 1 + posterior · lean)``, and the ``k`` numbers of ``lean`` are found by Newton steps on the dual,
    whose curvature is the k-by-k Gram matrix of the documents above ``least_rate``. A step of either kind is one narrow
    pass over ``rows`` that sends one vector per task; no state is kept between steps, so a lost executor costs a
    recomputed task. Documents without tokens weigh nothing.

    A domain is near its target within ``close``, or ten times ``pull``, which is what that may cost. If it isn't at the
    minimum, ``pull`` is divided by ten for as long as that helps. What is missed then can't be reached with these rows
    and ``least_rate``: ``error`` of the plan says by how much, with a warning.
    """
    k = len(names)
    share = np.array([weights[n] for n in names], dtype=float)
    share = share / share.sum()
    def sums(plan: Rates, square: bool):
        def one(batches):
            total, gram = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                if batch.num_rows:
                    n, p = batch.column(0).to_numpy().astype(float), _posteriors(batch, 1, k)
                    total += (n * plan.of(p)) @ p
                    if square:
                        gram += (p * n[:, None]).T @ p
            yield pa.RecordBatch.from_arrays([pa.array([[*total, *gram.ravel()]], pa.list_(pa.float64()))], names=["v"])

        parts = rows.select("n_tokens", "p").mapInArrow(one, "v array<double>").select(F.posexplode("v").alias("i", "x"))
        found = dict(parts.groupBy("i").agg(F.sum("x")).collect())
        v = np.array([found.get(i, 0.0) for i in range(k + k * k)])
        return v[:k], v[k:].reshape(k, k)

    plan = Rates(names)
    now, gram = sums(plan, True)
    corpus = now.sum()
    if corpus == 0:
        return plan
    total = how.total if how.total is not None else max(1.0, float((now / corpus / share).max()))
    target = share * total
    bend = np.linalg.eigvalsh(gram / corpus / np.outer(target, target)).max() + how.pull
    plan = Rates(names, 1 / bend, how.pull, how.least_rate, target=target * corpus)
    now = now / corpus
    near = max(how.close, 10 * how.pull)
    for done in range(how.rounds + 1):
        plan.tokens.append(now * corpus)
        error = np.abs(now / target - 1).max()
        if error < how.close or done == how.rounds and error < near:
            break
        if done >= min(_PATIENCE, how.rounds) and error >= near:
            now = _settle(rows, plan, corpus, target, near, how)
            plan.tokens.append(now * corpus)
            break
        plan.gradients.append((now - target) / target**2)
        now = sums(plan, False)[0] / corpus
    plan.error = float(np.abs(now / target - 1).max())
    if plan.error >= near:
        warnings.warn(f"targets can't all be met: {dict(zip(names, np.round(now / target, 4).tolist(), strict=True))} of them", stacklevel=2)
    return plan


def _settle(rows: DataFrame, plan: Rates, corpus: float, target: np.ndarray, near: float, how: Fit) -> np.ndarray:
    """Set ``plan.lean`` to the minimum's and return its domain totals, as shares of the corpus; see :func:`fit`."""
    k, lengths = len(target), 0.5 ** np.arange(14)

    def sums(leans: list[np.ndarray]):
        """For each lean: its dual value without targets, domain totals, Gram matrix of the documents above the least rate."""

        def one(batches):
            out = np.zeros((len(leans), 1 + k + k * k))
            for batch in batches:
                if batch.num_rows:
                    n, p = batch.column(0).to_numpy().astype(float), _posteriors(batch, 1, k)
                    for row, lean in zip(out, leans, strict=True):
                        free = 1 + p @ lean
                        r = np.maximum(how.least_rate, free)
                        row[0] += n @ (r * free - r * r / 2)
                        row[1 : k + 1] += (n * r) @ p
                        row[k + 1 :] += ((p * (n * (free >= how.least_rate))[:, None]).T @ p).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([out.ravel()], pa.list_(pa.float64()))], names=["v"])

        parts = rows.select("n_tokens", "p").mapInArrow(one, "v array<double>").select(F.posexplode("v").alias("i", "x"))
        found = dict(parts.groupBy("i").agg(F.sum("x")).collect())
        v = np.array([found.get(i, 0.0) for i in range(len(leans) * (1 + k + k * k))]).reshape(len(leans), -1)
        return v[:, 0], v[:, 1 : k + 1], v[:, k + 1 :].reshape(-1, k, k)

    lean, pull, last = np.zeros(k), how.pull, np.inf
    _, now, gram = (x[0] / corpus for x in sums([lean]))
    for _ in range(how.rounds):
        slope = now - target + pull * target**2 * lean
        if np.abs(slope / target).max() < how.close / 100:
            error = float(np.abs(now / target - 1).max())
            if error < near or pull < 1e-10 or error > 0.9 * last:
                break
            last, pull = error, pull / 10
            slope = now - target + pull * target**2 * lean
        step = np.linalg.lstsq((gram + pull * np.diag(target**2)) / np.outer(target, target), slope / target, rcond=1e-15)[0] / target
        tried = [lean - t * step for t in lengths]
        value, totals, grams = sums(tried)
        value = value / corpus + np.array([pull / 2 * (target * x) @ (target * x) - target @ x for x in tried])
        best = int(np.argmin(value))
        lean, now, gram = tried[best], totals[best] / corpus, grams[best] / corpus
    else:
        raise RuntimeError(f"rates did not settle in {how.rounds} passes: domain tokens are {now / target} of their targets")
    plan.lean, plan.pull = lean, pull
    return now


def rates(rows: DataFrame, plan: Rates, id_col: str = "doc_id") -> DataFrame:
    """``<id_col>, n_tokens, domain, posterior, rate, copies`` from :func:`memberships`' rows.

    ``copies`` is the rate rounded down, or up with the odds of its fraction (by ``u``), so totals hold on average and
    a row gets the same number on every run. Null and repeated ids keep their rows.
    """
    kind, k, names = rows.schema["id"].dataType.simpleString(), len(plan.names), plan.names

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, u = _posteriors(batch, 3, k), batch.column(1).to_numpy()
        r = plan.of(p)
        best = p.argmax(axis=1)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([names[i] for i in best]), pa.array(p.max(axis=1)), pa.array(r), pa.array(_copies(r, u))],
            names=[id_col, "n_tokens", "domain", "posterior", "rate", "copies"],
        )

    return map_batches(rows.select("id", "u", "n_tokens", "p"), one, f"`{id_col}` {kind}, n_tokens long, domain string, posterior double, rate double, copies long")


def _copies(r: np.ndarray, u: np.ndarray) -> np.ndarray:
    whole = np.floor(r)
    return (whole + (u < r - whole)).astype(np.int64)


def mix(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], learning: Learning = Learning(), how: Fit = Fit(),
    id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang",
) -> DataFrame:
    """Rates of every row of ``docs`` for the target ``weights`` of domains; see :func:`rates`.

    Null, empty and wordless texts have no tokens, the priors as posterior and the rate that follows. Other columns are
    ignored; an empty table gives an empty result.
    """
    model = learn(docs, labelled, list(weights), learning, id_col, text_col, domain_col)
    rows = store(memberships(docs, model, id_col, text_col), "memberships")
    return rates(rows, fit(rows, model.names, weights, how), id_col)


def resample(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], learning: Learning = Learning(), how: Fit = Fit(),
    id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang",
) -> DataFrame:
    """``docs`` with each row as often as its rate says, all columns as they are, without a shuffle.

    A row's posterior is computed again from its text, so nothing is joined by id and repeated rows stay repeated.
    """
    model = learn(docs, labelled, list(weights), learning, id_col, text_col, domain_col)
    plan = fit(store(memberships(docs, model, id_col, text_col), "memberships"), model.names, weights, how)
    u = F.xxhash64(F.col(id_col), F.col(text_col)) / F.lit(2.0**64) + 0.5

    def times(batch: pa.RecordBatch) -> np.ndarray:
        p = np.array([model.membership(t.as_py())[1] for t in batch.column(1)])
        return _copies(plan.of(p), batch.column(2).to_numpy())

    return repeat_rows(docs, text_col, times, u)
