"""The registered corpus queries, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, hash_forest, hnsw, html_text, lexical, mixing, pii, prefix_trie, simhash, sql, substring, toxicity, url_filter, warc
from ledgerloom.llm.tables import sha256_hex, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = sql.ORACLES
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Whoever runs this over real data passes a secret of their own.
PII_KEY = "corpus"


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a function under its own name."""
    QUERIES[build.__name__] = build
    return build


@query
def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95 and above."""
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, decoded=True)
    return coded.select("doc_id", "n_tokens", sha256_hex(coded.token_ids).alias("ids_sha256"), sha256_hex(coded.decoded).alias("decoded_sha256"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without later repeats of twenty words."""
    kept = substring.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha256_hex(kept.kept).alias("kept_sha256"))


@query
def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as the archives give it back."""
    archived = warc.archive(table(spark, sf_dir, "pages"))
    return archived.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all sources for a budget of all tokens, none repeated more than one and a quarter times."""
    docs = mixing.counted(table(spark, sf_dir, "documents"))
    return mixing.mix(docs, repeats=1.25, block_tokens=1_000_000).drop("place")


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates in place of personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.model_for(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, machine)
    out = toxicity.held_out(scored["doc_id"])
    return scored.select("doc_id", out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, deciding rule and verdict."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op9_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings of every hundredth one."""
    return hash_forest.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents that score highest for every benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
