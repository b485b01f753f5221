import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coverlay.llm import arrow_stream as A
from coverlay.llm import token_files as T
from coverlay.llm.bpe import WordEncoder
from coverlay.llm.queries import END_ID, SEPARATOR_ID, TOKENIZER

ODD = [
    "It's a can't I'LL 'tis won't,'s", "a<|endoftext|>b <|startoftext|>", "Σίσυφος ΟΔΥΣΣΕΥΣ İstanbul straße", "été x y z ½ x² ٣ 12ab_c __init__",
    "日本語 テスト，。", "a\x1cb\x85c", "é ́abc ḍ̇", "don’t ﬁ ﬂ Å", "", "  \n", "é" * 5000, "\x00a\x00", "word\"). \"quoted\" ('x')", None,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, "other"), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"path": F.lit("p"), "id": F.lit(0), "n_tokens": F.lit(0), "shard": F.lit(7)})


def library(texts, special_as_text=False):
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = special_as_text
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_words_equal_whole_texts():
    e = WordEncoder(TOKENIZER)
    for text, ids in zip(ODD, library(ODD), strict=True):
        assert np.frombuffer(e.encode((text or "").encode()), e.dtype).tolist() == ids, text


def want_documents(rows):
    out, at = [], 0
    for doc, ids in zip([r[0] for r in rows], library([r[1] for r in rows]), strict=True):
        ids = [*ids, END_ID]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("length", [16, 2048])
def test_sequences_round_trip(spark, odd, length, monkeypatch):
    monkeypatch.setattr(A, "ROWS", 4)
    got = sorted(map(tuple, A.read_documents(A.write_sequences(odd, TOKENIZER, END_ID, length)).collect()), key=lambda r: r[1])
    hashes = {(r.doc_id, r.text): r.h for r in odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("h")).collect()}
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r]))
    assert got == want_documents(rows)


def test_sequences_over_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    shards = A.write_sequences(docs, TOKENIZER, END_ID)
    got = sorted(map(tuple, A.read_documents(shards).collect()))
    assert got == want_documents(docs.orderBy("doc_id").select("doc_id", "text").collect())
    row = shards.orderBy("shard").first()
    one = A.SequenceFile(row.path)
    assert len(one) == row.sequences
    ids, mask = one[0]
    first = library([docs.orderBy("doc_id").first().text])[0][:2048]
    assert ids[: len(first)].tolist() == first and len(mask) == 2048 and not ids.flags.owndata
    assert sum(sum(one[i][1].to_pylist()) for i in range(len(one))) == row.tokens


def test_empty_tables(spark, odd):
    assert A.read_documents(A.write_sequences(odd.limit(0), TOKENIZER, END_ID)).count() == 0
    assert T.token_counts(odd.limit(0), TOKENIZER, SEPARATOR_ID).count() == 0


def test_counts_of_odd_rows(odd):
    got = sorted(T.token_counts(odd, TOKENIZER, SEPARATOR_ID).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rows = odd.collect()
    want = [(r.doc_id, len(ids) + 1) for r, ids in zip(rows, library([r.text for r in rows], True), strict=True)]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("block", [4, 12, 64, 1 << 20])
@pytest.mark.parametrize("width", [2, 4])
def test_blocks_are_stitched(spark, tmp_path, block, width):
    rng = np.random.default_rng(block)
    files, want = [], []
    for k, (n, p) in enumerate([(0, 0), (1, 1), (1, 0), (200, 0.05), (300, 0.5), (150, 0), (97, 1)]):
        ids = np.where(rng.random(n) < p, 9, 5).astype(f"<u{width}")
        path = str(tmp_path / f"{k}.bin")
        ids.tofile(path)
        files.append((path, width))
        ends = (np.flatnonzero(ids == 9) + 1).tolist()
        cuts = [0, *ends] + ([n] if n and (not ends or ends[-1] < n) else [])
        want += [(path, i, a, b - a, b in ends) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    got = T.separator_counts(spark.createDataFrame(files, "path string, width int"), 9, block)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_torn_file_is_an_error(spark, tmp_path):
    (tmp_path / "torn.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        T.separator_counts(spark.createDataFrame([(str(tmp_path / "torn.bin"), 2)], "path string, width int"), 9).collect()
