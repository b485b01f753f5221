import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from coverlay.llm import prefix_trie as T
from tests.conftest import DATA

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Nodes by the definition: every conversation's prefixes as tuples."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = own + sum(saved[k] for k in kids.get(p, []))
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        out.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def run(spark, rows, **how):
    return sorted(map(tuple, T.trie(spark.createDataFrame(rows, SCHEMA), **how).collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("most_width", [1 << 12, 8])
def test_shared_prefixes(spark, most_width, monkeypatch):
    """Families, copies, chains and forks; a sketch of eight counters lets nearly everything through, and the nodes are the same."""
    monkeypatch.setattr(T, "LEAST_WIDTH", 8)
    rng, rows = random.Random(2), []
    for c in {rng.choice([0, 100, 200, 1000]) + rng.randrange(100) for _ in range(180)}:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "bot"]), "ab"[: rng.randrange(3)]))
    rows += [(5000 + c, t, "user", f"same{t}") for c in range(70) for t in range(12)]
    rows += [(7001, t, "user", f"long{t % 3}") for t in range(900)] + [(7002, t, "user", f"long{t % 3}") for t in range(700)]
    assert run(spark, rows, most_width=most_width) == plain(rows)


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, ties, repeated rows, conversations that lose all their turns, negative ids."""
    rows = [(None, 1, "user", "x"), (3, None, None, None), (3, 1, "user", "é\U0001F600"), (3, 1, "user", "é\U0001F600"), (4, 2, "user", None), (-105, 1, "bot", "y"), (-100, 1, "bot", "z")]
    rows += [(c, 1, "user", "only") for c in range(201, 212)] + [(c, 1, "user", "t" * 200_000) for c in (300, 301, 302)]
    assert run(spark, rows) == plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("c", "h1", "place", "k1", "n", "_part")})
    assert sorted(map(tuple, T.trie(frame).collect()), key=str) == plain(rows)
    assert T.trie(frame.limit(0)).count() == 0
    assert run(spark, [(None, 1, "user", "x")]) == [] and run(spark, [(1, 1, "user", "x")]) == plain([(1, 1, "user", "x")])


def test_sketch_never_underestimates(spark):
    """Prefixes that occur twice are always let through; of those that occur once nearly all are caught."""
    keys = spark.range(3000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"))
    rows = keys.unionByName(keys.limit(500)).repartition(7)
    bits = T.sketch(rows, 1 << 14)
    import numpy as np

    twice = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    got = keys.collect()
    cells = T._cells(np.array([r.k1 for r in got]), np.array([r.k2 for r in got]), 1 << 14)
    through = np.logical_and.reduce([twice[c] for c in cells])
    often = {tuple(r) for r in rows.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2").collect()}
    assert all(t for r, t in zip(got, through.tolist(), strict=True) if tuple(r) in often) and through.sum() < 600
