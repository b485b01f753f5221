import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlay.llm import mixing as M
from tests.conftest import DATA

W = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return M.learn(docs, docs.where("doc_id % 2 = 0").select("doc_id", "lang"), list(W))


def test_held_out_domains(docs, model):
    rows = docs.where("doc_id % 2 = 1").select("text", "lang").collect()
    right = [model.names[int(model.membership((r.text or "").encode())[1].argmax())] == r.lang for r in rows]
    assert np.mean(right) > 0.97


@pytest.mark.parametrize("how", [M.Fit(), M.Fit(total=0.3), M.Fit(total=None, least_rate=1.0, close=1e-6), M.Fit(total=2.5, least_rate=0.5, close=1e-6)])
def test_totals_match_targets(docs, model, how):
    """Rates from the descent against one computed on whole matrices, and against the targets."""
    rows = M.memberships(docs, model).cache()
    plan = M.fit(rows, model.names, W, how)
    got = M.rates(rows, plan).collect()
    table = rows.collect()
    n, p = np.array([r.n_tokens for r in table], float), np.array([r.p for r in table])
    rate = np.array([r.rate for r in sorted(got, key=lambda r: r.doc_id)])
    order = np.argsort([r.id for r in table])
    n, p = n[order], p[order]
    totals = (rate * n) @ p
    assert np.abs(totals / plan.target - 1).max() < 2e-3 and rate.min() >= how.least_rate
    # plain projected gradient over whole arrays, many more steps
    share = plan.target / n.sum()
    r, step = np.ones(len(n)), plan.step
    for _ in range(400):
        r = np.maximum(how.least_rate, r - step * (p @ (((r * n) @ p / n.sum() - share) / share**2) + how.pull * (r - 1)))
    assert np.abs(r - rate).max() < 0.06  # soft rows settle slowly
    copies = np.array([x.copies for x in sorted(got, key=lambda x: x.doc_id)])
    assert set(np.unique(copies - np.floor(rate))) <= {0, 1} and abs((copies * n).sum() / (rate * n).sum() - 1) < 0.1


def test_odd_rows(spark, docs, model):
    rows = [(1, None), (2, ""), (3, " \n "), (3, " \n "), (None, "the and"), (5, "zzzz" * 100_000), (6, "la de que " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rate": F.lit(1), "p": F.lit(2), "a.b": F.lit(3), "lang": F.lit(None).cast("string")})
    plan = M.fit(M.memberships(frame, model), model.names, W)
    got = M.rates(M.memberships(frame, model), plan).collect()
    assert len(got) == len(rows) and [r.n_tokens for r in got][:4] == [0] * 4 and all(r.rate >= 0 for r in got)
    assert M.mix(frame.limit(0), docs, W).count() == 0
    assert M.mix(frame, docs.limit(0), W).count() == len(rows)
    more = M.resample(frame, docs, W, how=M.Fit(total=None, least_rate=1.0))
    assert more.columns == frame.columns and {(r.doc_id, r.text) for r in more.collect()} == set(rows)


@pytest.mark.parametrize("how", [M.Fit(), M.Fit(total=None, least_rate=1.0)])
@pytest.mark.parametrize("corpus", [(70, 10, 10, 10), (90, 5, 2, 3)])
def test_skewed_corpora_reach_their_targets(spark, corpus, how):
    """Nearly all of a corpus in a domain with a small target."""
    names, weights = ["de", "en", "es", "fr"], {"en": 0.5, "de": 0.17, "es": 0.16, "fr": 0.17}
    rows = [(100, [float(i == d) for i in range(4)]) for d, n in enumerate(corpus) for _ in range(n)]
    plan = M.fit(spark.createDataFrame(rows, "n_tokens long, p array<double>"), names, weights, how)
    n, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    totals, rate = (plan.of(p) * n) @ p, plan.of(p)
    assert np.abs(totals / plan.target - 1).max() < how.close and plan.error < how.close and rate.min() >= how.least_rate


def test_targets_out_of_reach_are_reported(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.5, 0.5])]
    with pytest.warns(UserWarning, match="can't all be met"):
        plan = M.fit(spark.createDataFrame(rows, "n_tokens long, p array<double>"), ["a", "b"], {"a": 0.1, "b": 0.9})
    assert plan.error > 0.1
