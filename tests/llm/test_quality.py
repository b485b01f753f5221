import random
import re

import numpy as np
from pyspark.sql import functions as F

from coverlay.llm import quality as Q
from tests.conftest import DATA


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 8)} if len(set(runs)) < len(runs) else set()
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


ODD = [None, "", " \n\t", "\n\n# a\n# a\r\n# a\n", "é€\U0001F600 x\x0by\x0cz\x85w", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g", "w " * 200, "x\n" * 30, "#*$%&|<> " * 9, " lead\nlead\n lead\n"]


def test_counts(spark):
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(200)]
    assert [Q.measure((t or "").encode()) for t in texts] == [plain(t) for t in texts]
    assert Q.measure(("q1 q2 " * 70_000).encode())[4] == 140_000


def test_whole_table(spark):
    """Counts against the plain ones, verdicts against quartiles of values rounded as the sketch's buckets round them."""
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    how = Q.Fences(least=15)
    got = {r.doc_id: r for r in Q.judge(docs, how).collect()}
    rows = docs.collect()
    counts = {r.doc_id: plain(r.text) for r in rows}
    assert {d: tuple(g)[1:6] for d, g in got.items()} == counts
    failed = {d: c[0] < 20 or 100 * c[4] > 30 * c[0] for d, c in counts.items()}
    assert {d: g.base_failed for d, g in got.items()} == failed
    measures = {d: (c[1] / c[0], c[2] / c[0], c[3] / c[0], c[4] / c[0]) for d, c in counts.items() if not failed[d]}
    levels = [lambda r: (r.lang, r.source), lambda r: r.lang, lambda r: 0]
    pools: list[dict] = [{}, {}, {}]
    for r in rows:
        if r.doc_id in measures:
            for pool, key in zip(pools, levels, strict=True):
                pool.setdefault(key(r), []).append(measures[r.doc_id])
    step, close = np.log(how.base), 0
    rounded = lambda v: 2 * how.base ** np.ceil(np.log(v) / step) / (how.base + 1) if v > 0 else 0.0
    for r in rows:
        if r.doc_id not in measures:
            assert not got[r.doc_id].kept
            continue
        pool = next(p[k(r)] for p, k in zip(pools, levels, strict=True) if len(p[k(r)]) >= how.least or p is pools[2])
        odd = []
        for i, (name, _, slack, both) in enumerate(Q._MEASURES):
            a, b = (rounded(v) for v in np.quantile([m[i] for m in pool], (0.25, 0.75), method="inverted_cdf"))
            wide = max(3 * (b - a), slack)
            value = measures[r.doc_id][i]
            if value > b + wide or both and value < a - wide:
                odd.append(name)
        close += got[r.doc_id].odd == odd and got[r.doc_id].kept == (not odd)
    assert close == len(measures)


def test_sketches_merge(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = Q.features(docs).cache()
    groups = ["group0", "group1"]
    halves = [Q.sketches(rows.where(f"id % 2 = {k}"), groups) for k in (0, 1)]
    both = Q.fences(Q.merged(halves[0].unionByName(halves[1]), groups), groups).collect()
    once = {(r[0], r[1]): r for r in Q.fences(Q.sketches(rows, groups), groups).collect()}
    assert len(both) == len(once) and all(np.allclose(r[2:], once[r[0], r[1]][2:]) for r in both)


def test_adapts_to_its_group(spark):
    """The same text is usual in one source and odd in another."""
    text = " ".join(f"p99x{i} |" for i in range(30))
    rows = [(i, " ".join(f"p{i}x{k} |" for k in range(30)), "en", "tables") for i in range(250)]
    rows += [(1000 + i, " ".join(f"p{i}x{k}" for k in range(60)), "en", "prose") for i in range(250)]
    rows += [(5000, text, "en", "tables"), (5001, text, "en", "prose")]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[5000].kept and not got[5001].kept and "symbols" in got[5001].odd


def test_odd_rows(spark):
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s") for i, t in enumerate(ODD)] + [(1, "", "en", "s"), (None, "w%d " % 3 * 50, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"group0": F.lit(1), "n": F.lit(2), "kept": F.lit(3)})
    got = Q.judge(frame)
    assert got.count() == len(rows) and {r.doc_id: tuple(r)[1:6] for r in got.collect() if r.doc_id not in (1, None)} == {i: plain(t) for i, t in enumerate(ODD) if i != 1}
    assert Q.judge(frame.limit(0)).count() == 0


def test_no_row_passes_the_base_rules(spark):
    """Tables of junk alone, and sketches of nothing."""
    frame = spark.createDataFrame([(1, "a b", "en", "s"), (2, "w " * 90, None, "s")], "doc_id long, text string, lang string, source string")
    assert [(r.base_failed, r.kept) for r in Q.judge(frame).collect()] == [(True, False)] * 2
    parts = Q.sketches(Q.features(frame), ["group0", "group1"])
    for some in (parts, parts.limit(0)):
        assert Q.fences(some, ["group0", "group1"]).count() == 0 and Q.fences(Q.merged(some, ["group0"]), ["group0"]).count() == 0


def test_two_runs_agree(spark):
    """Fences don't depend on how rows are dealt over partitions."""
    rows = spark.range(60_000).select(
        F.col("id"), F.lit("en").alias("group0"), F.lit("s").alias("group1"), F.lit(100).cast("long").alias("n_words"),
        F.pmod(F.hash("id"), F.lit(5000)).cast("long").alias("word_chars"), *[F.pmod(F.hash("id", F.lit(k)), F.lit(30)).cast("long").alias(c) for k, c in enumerate(("n_symbols", "n_dup_lines", "n_repeat_words"))],
    )
    one, two = (Q.fences(Q.sketches(rows.repartition(n), ["group0", "group1"]), ["group0", "group1"]).collect() for n in (1, 7))
    assert one == two
    a, b = np.quantile(np.array([r.word_chars / 100 for r in rows.collect()]), (0.25, 0.75), method="inverted_cdf")
    assert abs(one[0].word_length_high - (b + max(3 * (b - a), 1.5))) < 0.02 * b
