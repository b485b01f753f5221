"""The corpus queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from coverlay.llm import (
    arrow_stream, decontaminate, merkle, mixing, pieces, prefix_trie, quality, quotes, secret_scan, simhash, token_files, toxicity, url_rules,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Its ids: 1 closes a packed document; 49407 is the end-of-text id, which no ordinary text gives.
TOKENIZER, END_ID, SEPARATOR_ID = public_tokenizers.path("word_bpe_49k.json"), 1, 49407
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    """Tokens of every document, counted by scanning the flat files for the separator."""
    return token_files.token_counts(_table(spark, sf_dir, "documents"), TOKENIZER, SEPARATOR_ID)


@query("op10_arrow_stream")
def op10_arrow_stream(spark, sf_dir):
    """Documents as read back from the packed sequence files."""
    return arrow_stream.read_documents(arrow_stream.write_sequences(_table(spark, sf_dir, "documents"), TOKENIZER, END_ID))


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Score and toxic spans of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@query("op9_decontaminate")
def op9_decontaminate(spark, sf_dir):
    """Every document with a benchmark passage, the item and where it stands."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query("op6_quality_rules")
def op6_quality_rules(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality.judge(_table(spark, sf_dir, "documents"))


@query("op3_url_filters", url_rules.sql())
def op3_url_filters(spark, sf_dir):
    """Host, path, site rule and verdict of every page."""
    return url_rules.apply(_table(spark, sf_dir, "pages"))


@query("op8_secret_scan")
def op8_secret_scan(spark, sf_dir):
    """Counts, digest and spans of secrets in every document."""
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


#: Target share of tokens of each domain.
WEIGHTS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def labelled_domains(spark, sf_dir, docs):
    """The labelled table of the domain classifier: rows of ``labels`` with the language of their document."""
    return _table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", "lang").where("lang IS NOT NULL"), "doc_id")


@query("op5_mixing")
def op5_mixing(spark, sf_dir):
    """Domain posterior, rate and copies of every document."""
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_domains(spark, sf_dir, docs), WEIGHTS)


@query("op7_chat_quotes", quotes.SQL)
def op7_chat_quotes(spark, sf_dir):
    """All messages in reply order, without quotations."""
    return quotes.conversations(_table(spark, sf_dir, "conversations"))


@query("op11_merkle", merkle.SQL)
def op11_merkle(spark, sf_dir):
    """Every document's leaf, roots and proof, and what the manifest says once newlines are deleted."""
    return merkle.newlines_deleted(_table(spark, sf_dir, "documents"))


@query("op12_pieces")
def op12_pieces(spark, sf_dir):
    """Digests of every document's ids and of the text that they decode to."""
    return pieces.digests(_table(spark, sf_dir, "documents"), PIECES)


@query("op13_prefix_trie", prefix_trie.SQL)
def op13_prefix_trie(spark, sf_dir):
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))
