import hashlib
import re

from pyspark.sql import functions as F

from coverlay.llm import secret_scan as S
from tests.conftest import DATA

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    rows = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    rows += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    rows += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(rows)


def whole(text):
    """Every rule run on the whole text."""
    rows = base(text)
    for k, r in enumerate(S.FURTHER, 3):
        rows += [(m.start(), k, m.end()) for m in re.compile(r.pattern, re.A).finditer(text)]
    return sorted(rows)


def want(doc, text):
    kinds = [r.kind for r in S.BASE + S.FURTHER]
    text = text or ""
    b, w = base(text), whole(text)
    digest = hashlib.sha256(",".join(f"{kinds[k]}:{a}:{e}" for a, k, e in b).encode()).hexdigest()
    return (doc, *[sum(k == n for _, k, _ in b) for n in range(3)], digest, ",".join(f"{kinds[k]}:{a}:{e}" for a, k, e in w))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    got = {r[0]: tuple(r) for r in S.digest(S.scan(docs)).collect()}
    assert got == {r[0]: want(*r) for r in docs.select("doc_id", "text").collect()}
    assert sum(bool(r[5]) for r in got.values()) > 100


def test_odd_rows(spark):
    h = "0123456789abcdef" * 2
    texts = [
        None, "", "TOKEN = 'abcdefgh'", "api-key=abcdefgh", 'apikey":"short token:longenough', "pasſword=abcdefgh toKen=abcdefgh", "é\U0001F600 " + h + " " + h[:31], h + "g" + h + "F",
        "AKIA" + "A" * 12 + "akia" + "AKIAAKIAAKIA12345", "password=password=abcdefgh", "secret=" + h, "x" * 300_000 + " token=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20,
        "sk_live_" + "a" * 20, "https://u:pass@h eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9, "xoxb-1234567890-a AIza" + "b" * 35,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "kind": F.lit("k")})
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, S.digest(S.scan(docs)).collect()), key=key) == sorted([want(*r) for r in rows], key=key)
    assert S.scan(docs.limit(0)).count() == 0


def test_only_candidates_are_verified():
    index = S.TrigramIndex(S.BASE)
    texts = [b"pass the word", b"my PASSWORD", b"tok eken", b"AKI KIA", b"xakiay", b"a tokens"]
    assign, access, full = (c.tolist() for c in index.candidates(texts))
    assert assign == [1, 5] and access == [3, 4] and full == list(range(6))
