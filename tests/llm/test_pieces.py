import hashlib
import random

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from coverlay.llm import pieces as P
from coverlay.llm.queries import PIECES, QUERIES
from tests.conftest import DATA

LIB = SentencePieceProcessor(model_file=PIECES)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(text):
    ids = LIB.encode(text or "", add_eos=True)
    return len(ids), sha(" ".join(map(str, ids))), sha(LIB.decode(ids))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_pieces"](spark, f"{DATA}/sf0.01").collect()}
    assert got == {r.doc_id: want(r.text) for r in docs}


def test_random_texts():
    """Runs of spaces, literal markers, names of special pieces, bytes without a piece, all in any order."""
    rng = random.Random(8)
    parts = [" ", "  ", "   ", "▁", "▁▁", "a", "the", " of", "\n", "\t", "\0", "é", "é", "ﬁ", "　", "​", "\U0001F600", "<s>", "</s>", "<unk>", "<0x0A>", "1", "ß", "…"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(20_000)]
    got = P.PieceEncoder(PIECES).encode(texts)
    assert [list(memoryview(g).cast("i")) for g in got] == LIB.encode(texts)


def test_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 50)
    use, rng = P.PieceEncoder(PIECES), random.Random(1)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(30)) + " " + "x" * 500 for _ in range(5)]
        assert [list(memoryview(g).cast("i")) for g in use.encode(texts)] == LIB.encode(texts)
        assert len(use._young) <= 50 and not any(len(w) > P.LONGEST for w in {**use._young, **use._old})


def test_each_distinct_word_is_segmented_once():
    use, asked = P.PieceEncoder(PIECES), []
    segment = use._segment
    use._segment = lambda words: asked.extend(words) or segment(words)
    use.encode(["b a  b", "a b c ", ""])
    use.encode(["c c c a"])
    assert sorted(asked) == ["", "a", "b", "c", "▁b"]


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, " "), (3, "x" * 400_000), (4, " " * 50_000 + "\n"), (5, "word " * 100_000), (6, "▁ ▁")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "c0": F.lit(2), "decoded": F.lit(3)})
    got = P.digests(frame, PIECES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *want(t))) for i, t in rows)
    assert P.digests(frame.limit(0), PIECES).count() == 0
    back = P.decode(P.encode(frame, PIECES).unionByName(spark.createDataFrame([(9, None)], "doc_id long, ids array<int>")), PIECES).collect()
    assert {r.text for r in back if r.doc_id in (1, 9)} == {""} and [r.text for r in back if r.doc_id == 5] == [rows[6][1]]


def test_models_of_another_shape_are_refused(monkeypatch):
    use = P.PieceEncoder(PIECES)

    class Crossing:
        get_piece_size = lambda self: 2
        id_to_piece = lambda self, i: ["▁a", "a▁b"][i]

    use.model = Crossing()
    with pytest.raises(ValueError, match="across words"):
        use._check()
