from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlay.llm import toxicity as T
from tests.conftest import DATA


def test_marginals_against_all_paths():
    rng = np.random.default_rng(5)
    emit, move = rng.normal(size=(3, 6)) * 2, rng.normal(size=(2, 2))
    marginal, pairs, log_z = T._forward_backward(emit, move)
    for k in range(3):
        weights, ones = [], np.zeros(6)
        for path in product((0, 1), repeat=6):
            steps = list(zip((0, *path), (*path, 0), strict=True))
            w = np.exp(sum(emit[k, i] for i, y in enumerate(path) if y) + sum(move[a, b] for a, b in steps))
            weights.append(w)
            ones += w * np.array(path)
        total = sum(weights)
        assert np.allclose(marginal[k], ones / total) and np.isclose(log_z[k], np.log(total))
    each = [T._forward_backward(emit[k : k + 1], move)[1] for k in range(3)]
    assert np.allclose(pairs, sum(each)) and all(np.isclose(e.sum(), 7) for e in each)


def test_gradient_of_likelihood():
    rng = np.random.default_rng(7)
    emit, move = rng.normal(size=(2, 5)), rng.normal(size=(2, 2))
    marginal, pairs, _ = T._forward_backward(emit, move)
    for i, j in ((0, 1), (1, 4)):
        up = emit.copy()
        up[i, j] += 1e-5
        assert np.isclose((T._forward_backward(up, move)[2].sum() - T._forward_backward(emit, move)[2].sum()) / 1e-5, marginal[i, j], atol=1e-4)
    for a, b in product((0, 1), repeat=2):
        up = move.copy()
        up[a, b] += 1e-5
        assert np.isclose((T._forward_backward(emit, up)[2].sum() - T._forward_backward(emit, move)[2].sum()) / 1e-5, pairs[a, b], atol=1e-4)


@pytest.fixture(scope="module")
def trained(spark):
    bad = ["vilelump", "grotscum", "Vilelumpen"]
    rows = [(i, f"some plain words number n{i % 17} about trees " * 3 + (f"and {bad[i % 3]} {bad[(i + 1) % 3]} here" if i % 4 == 0 else "and nothing else")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")


def test_spans_scores_and_odd_rows(spark, trained):
    docs, labels = trained
    model = T.fit(docs, labels)
    text = "É, VILELUMP\n" + "calm words İ " * 30_000 + "vilelumpy grotscum!"
    rows = [(1000, text), (1001, None), (1002, ""), (1003, "... 12 _"), (1004, "plain words about trees"), (1004, "grotscum"), (None, "grotscum")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(9), "held_out": F.lit("x"), "a.b": F.lit(1)})
    got = T.score(frame, model).collect()
    assert [(r.doc_id, r.predicted) for r in got] == [(1000, 1), (1001, 0), (1002, 0), (1003, 0), (1004, 0), (1004, 1), (None, 1)]
    assert [text[s.start : s.end] for s in got[0].spans] == ["VILELUMP", "vilelumpy", "grotscum"]
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == bool(r.predicted) and bool(r.spans) == bool(r.predicted) for r in got)
    assert {r.doc_id: r.held_out for r in got}[None] is False
    kept = T.clean(frame, model)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1001, 1002, 1003, 1004]
    assert T.score(frame.limit(0), model).count() == 0


def test_held_out_rows_teach_nothing(spark, trained):
    docs, labels = trained
    flipped = labels.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit(docs, labels).weights == T.fit(docs, flipped).weights


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_without_two_classes(spark, trained, toxic):
    docs, labels = trained
    model = T.fit(docs, labels.where("toxic = 0").withColumn("toxic", F.lit(toxic).cast("int")).unionByName(spark.createDataFrame([(None, 1)], labels.schema)))
    assert {r.score for r in T.score(docs.limit(3), model).collect()} == {0.0}


def test_held_out_accuracy(spark):
    """On rows that no label was learnt from, English texts of the larger table (one in fifteen of its toxic ones has no toxic word)."""
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = T.score(docs, T.fit(docs, labels)).where("held_out").join(labels, "doc_id").join(docs.where("lang = 'en'").select("doc_id"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9 and n.get((0, 1), 0) / n[0, 0] < 0.01
