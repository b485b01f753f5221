"""The pipeline: its stages against brute force, planted cases, and what is left when the subpackage is gone."""

import os
import random
import shutil
import subprocess
import sys

import corpus_pipeline as C
from coverlay.llm import decontaminate, toxicity
from coverlay.operators.stage import store
from tests.conftest import DATA
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_token_files import want_documents

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_table(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    named = dict(C.STAGES)
    # toxicity: what stays is what the score says
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    one = store(named["toxicity"](spark, docs, sf))
    assert one.columns == COLUMNS and {r.doc_id for r in one.select("doc_id").collect()} == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    # near copies: the smallest id of each component by all pairs of fingerprints
    two = store(named["near_duplicates"](spark, one, sf))
    rows = sorted((r.doc_id, r.text) for r in one.collect())
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    assert two.columns == COLUMNS and sorted(r.doc_id for r in two.collect()) == sorted({rows[i][0] for i in roots})
    # benchmark passages: every exact one goes, and whatever goes has a verified match
    three = store(named["decontamination"](spark, two, sf))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    plain = lambda t: decontaminate.normalise(t or "")[0].tobytes().decode("utf-32-le")
    items, left = [plain(r.text) for r in bench.collect()], {r.doc_id for r in three.collect()}
    exact = {r.doc_id for r in two.collect() if any(b in plain(r.text) for b in items)}
    assert exact and not exact & left and three.columns == COLUMNS
    assert {r.doc_id for r in decontaminate.contamination(two, bench).collect()} == {r.doc_id for r in two.collect()} - left
    # mixing: nobody is lost, and repeated rows are whole rows
    four = store(named["mixing"](spark, three, sf))
    assert four.columns == COLUMNS and {tuple(r) for r in four.collect()} == {tuple(r) for r in three.collect()} and four.count() >= three.count()
    # packed: a round trip of every row
    five = named["token_output"](spark, four, sf)
    got = sorted(map(tuple, five.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(r.doc_id for r in four.collect())
    want = {r[0]: r[2:] for r in want_documents([(r.doc_id, r.text) for r in three.collect()])}
    assert all(r[2:] == want[r[0]] for r in got) and [r[1] for r in got[1:]] == [r[1] + r[2] for r in got[:-1]]


def test_planted_cases(spark, tmp_path):
    """Exact and near copies, a benchmark passage and a toxic document among clean ones."""
    sf = str(tmp_path)
    for t in ("labels", "benchmark"):
        shutil.copy(f"{DATA}/sf0.1/{t}.parquet", f"{sf}/{t}.parquet")
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").where("doc_id < 4000")
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfghklmn") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(600)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    near = base.split()
    near[300] = "changed"
    planted = {
        900_000: base, 900_001: base, 900_002: " ".join(near), 900_003: text(200) + "\n" + item + "\n" + text(200),
        900_004: text(200) + " you idiot, pathetic worthless loser, stupid scum " + text(100), 900_005: text(500), 900_006: text(80), 900_007: "",
    }
    rows = [(k, v, "en", "planted", len(v)) for k, v in planted.items()]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id for r in C.run(spark, sf).where("doc_id >= 900000").collect()}
    assert left - {900_007} == {900_000, 900_005, 900_006}


def test_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "_build"))
    code = "import __spark_entry__ as e; assert not e.LLM and len(e.queries()) == len(e.oracle_sql()) > 150; print('ok')"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("ok"), done.stderr


def test_every_dealt_query_is_registered():
    import __spark_entry__ as e

    names = {n.split("_")[0] for n in e.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in e.queries()
