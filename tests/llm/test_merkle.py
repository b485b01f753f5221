import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from coverlay.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    out = ""
    for v in (r[0], r[3], r[2], r[4], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(out)


def fold(nodes, fan, proofs, members):
    """Last node of a tree; ``members`` says which rows are below each node, ``proofs`` gets (left, right) for them."""
    while len(nodes) > 1:
        up, below = [], []
        for at in range(0, len(nodes), fan):
            run = nodes[at : at + fan]
            for k in range(len(run)):
                for row in members[at + k]:
                    proofs[row].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            below.append([row for m in members[at : at + fan] for row in m])
        nodes, members = up, below
    return nodes[0], members[0]


def plain(rows, fan=3):
    """One row per row of ``rows`` by the definition."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][3] is not None, (rows[i][3] or "").encode(), rows[i][0] is not None, rows[i][0] or 0, leaf(rows[i], rows[i][1])))
    proofs, subs, groups = {i: [] for i in order}, [], []
    for i in order:
        if groups and rows[groups[-1][0]][3] == rows[i][3]:
            groups[-1].append(i)
        else:
            groups.append([i])
    for g in groups:
        subs.append(fold([leaf(rows[i], rows[i][1]) for i in g], fan, proofs, [[i] for i in g])[0])
    root = fold(subs, fan, proofs, groups)[0]
    out = []
    for g, sub in zip(groups, subs, strict=True):
        for i in g:
            r, text = rows[i], rows[i][1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            acc = leaf(r, text)
            for a, b in proofs[i]:
                acc = H(a, acc, b)
            out.append((r[0], leaf(r, r[1]), sub, root, H(*[a + b for a, b in proofs[i]]), acc, acc == root))
    return out


def key(r):
    return str(r)


@pytest.mark.parametrize("fan", [2, 3, 4])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 82])
def test_against_the_definition(spark, n, fan):
    rows = [(i * 7 % 101, f"t{i}\nx" if i % 3 else "y", "en", [None, "b", "a", "", "Z", "é"][i % 6] if i % 2 else "hot", i) for i in range(n)]
    got = M.verify(spark.createDataFrame(rows, SCHEMA), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, {"text": F.translate("text", "\n", "")}, fan=fan)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, fan), key=key)


def test_odd_rows(spark):
    """Null ids, texts and sources, repeated rows and ids, a long text, clashing names, an empty table."""
    rows = [(None, None, None, None, None), (None, "a\n", None, "s", 2), (1, "", "", "", 0), (1, "", "", "", 0), (1, "x", None, "s", 1), (2, "\n" * 300_000, "de", "s", 1), (-5, "1:2\n", "-", "-", -1), (4, "é\U0001F600\n", "en", "s", 2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    odd = frame.withColumns({c: F.lit(7) for c in ("tree", "pos", "n", "digest", "left", "id", "at", "path", "root", "_tie")})
    assert sorted(map(tuple, M.newlines_deleted(odd).collect()), key=key) == sorted(plain(rows), key=key)
    none = M.newlines_deleted(frame.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_only_changed_rows_fail(spark):
    """Proofs of untouched rows hold, whatever was done to others; a path is a proof by itself."""
    rows = [(i, "a\nb" if i % 5 else "ab", "en", f"s{i % 7}", 3) for i in range(200)]
    got = M.newlines_deleted(spark.createDataFrame(rows, SCHEMA)).collect()
    changed = {i for i in range(200) if i % 5 and zlib.crc32(str(i).encode()) % 2 == 0}
    assert {r.doc_id for r in got if not r.verified} == changed and len({r.root for r in got}) == 1
    first = M.manifest(spark.createDataFrame(rows, SCHEMA)).where("doc_id = 17").first()
    acc = first.leaf
    for at in first.path:
        acc = H(at.left, acc, at.right)
    assert acc == first.root


def test_many_sources(spark):
    """A source for every row: the upper tree is the large one; partitioning doesn't matter."""
    rows = [(i, f"{i}", None, f"src{i}", 1) for i in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(plain(rows), key=key)
    assert all(sorted(map(tuple, M.newlines_deleted(frame.repartition(n)).collect()), key=key) == want for n in (1, 5))
