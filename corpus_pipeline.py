"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that its predecessor kept and returns them with all their columns; the last one packs
them and returns what its files hold. Stages are written as Parquet in between, so a lost executor costs part of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coverlay.llm import arrow_stream, decontaminate, mixing, simhash, toxicity
from coverlay.llm.queries import END_ID, TOKENIZER
from coverlay.operators.stage import store

#: Target shares of tokens. Rates are 1 at least here: mixing repeats documents of small domains and drops none.
WEIGHTS = {"en": 0.5, "de": 0.17, "es": 0.16, "fr": 0.17}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, doesn't reject."""
    return toxicity.clean(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles that link at 4 or fewer differing bits."""
    return simhash.keep_one(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of languages ask for, each once at least."""
    labelled = _table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", "lang").where("lang IS NOT NULL"), "doc_id")
    return mixing.resample(docs, labelled, WEIGHTS, how=mixing.Fit(total=None, least_rate=1.0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` as the packed sequence files hold them."""
    return arrow_stream.read_documents(arrow_stream.write_sequences(docs, TOKENIZER, END_ID))


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_copies_out),
    ("decontamination", benchmark_out),
    ("mixing", mixed),
    ("token_output", packed),
]

#: Models, fingerprints and tokenizer ids aren't SQL; the tests run each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
