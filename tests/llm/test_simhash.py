import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coverlay.llm import simhash as S
from coverlay.llm.components import components
from tests.conftest import DATA


def plain_fingerprint(text, k=4):
    words = [w for w in (text or "").encode().lower().split()]
    rows = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] if words else []
    values = [xxhash.xxh64_intdigest(r, 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(fps, most=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= most).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    """Distinct texts under one id or none all stay; a copy goes even if its id is the smallest of another component."""
    text = lambda k: " ".join(f"{k}x{i}" for i in range(60))
    rows = [(None, text(k)) for k in range(5)] + [(7, text(10 + k)) for k in range(5)]
    rows += [(8, text(20)), (9, text(20)), (9, text(21)), (None, text(22)), (None, text(22)), (3, text(23)), (3, text(23))]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [*rows[:10], (8, text(20)), (9, text(21)), (None, text(22)), (3, text(23))]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, plain_components(fps), strict=True)}
    got = {r[0]: (r[1], r[2]) for r in S.near_duplicates(docs).collect()}
    assert got == want


@pytest.mark.parametrize("most, group", [(4, 3), (4, 4096), (6, 40)])
def test_large_nodes_lose_no_link(spark, most, group):
    """Chains, a dense ball and noise; small ``group`` drives every level and the dealing into runs."""
    rng = np.random.default_rng(3)
    values = set(rng.integers(0, 2**63, 40).tolist())
    centre = int(rng.integers(0, 2**63))
    for _ in range(150):
        values.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))
    for start in list(values)[:10]:
        for step in range(4):
            start ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            values.add(start)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = components(S.links(S.top_nodes(fps, most, group), most))
    root = {r.node: r.root for r in found.collect()}
    groups = {}
    for v, c in zip(signed, plain_components([v % 2**64 for v in values], most), strict=True):
        groups.setdefault(c, set()).add(v)
    mine = {}
    for v in signed:
        mine.setdefault(root.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (3, None), (4, ""), (5, " \n\t"), (6, long), (7, "A B c D e"), (8, "É x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "root": F.lit(2), "component_id": F.lit(9)})
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[1] == by[7] and by[None] == by[1] and len(by[1]) == 1
    assert {c for k in (3, 4, 5) for _, c in by[k]} == {3} and {f for f, _ in by[3]} == {"0" * 16}
    assert by[6] == {(f"{plain_fingerprint(long):016x}", 6)}
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8]
    assert S.near_duplicates(docs.limit(0)).count() == 0
