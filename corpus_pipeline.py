"""Five stages from raw documents to token ids: toxicity, near-duplicates, personal data, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, mixing, pii, resemblance, toxicity
from ledgerloom.llm.tables import Scratch, digest_of, prepare, spare_names, table

#: From this score on a document is rejected.
TOXIC = 0.7
#: Whoever runs this over real data passes a secret of their own.
PII_KEY = "corpus"
#: No source is repeated more often than this for a budget of all tokens.
REPEATS = 1.25
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: SQL cannot express the machine, the near-duplicates' components or the merges.
ORACLE_SQL = None


def plainly_named(docs: DataFrame, *kept: str) -> DataFrame:
    """``docs`` with all columns but the ``kept`` ones under numbers, so that no operator's own columns clash."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in kept else f"c{k}") for k, c in enumerate(docs.columns)])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the score; the machine learns from the labelled ones that are not held out."""
    named = plainly_named(docs, "doc_id", "text")
    machine = toxicity.model_for(named, table(spark, sf_dir, "labels"))
    scored = toxicity.score(named, machine, keep=tuple(named.columns))
    return scored.where(F.col("toxic_score") < TOXIC).drop("toxic_score").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of texts whose sets of five words are similar by 0.8 or more.

    SimHash proposes the links, sketches of the sets those beyond its radius; every link is checked.

    Where an id has several texts, the one of smallest digest stays; a row that repeats stays once.
    Documents without an id cannot be named and stay.
    """
    return resemblance.first_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in the text; the number of characters follows it. Other columns may have any name."""
    named = plainly_named(docs, "text", "n_chars")
    replaced = pii.pseudonymize(named, PII_KEY)
    length = F.when(F.col("n_entities") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", length).select(*named.columns).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix holds it; those of sources that are too large may not be in it.

    A document is known by its id alone where no other row has it, else by id, text and source together; rows
    that agree in all three are one document of all their words. So rows without an id are mixed like
    others, and no budget is passed by rows that share one. Documents of sources without any words are passed on once.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), digest_of(F.col("text")).alias("digest"),
                       F.col("source").cast("string").alias("source"), mixing.word_count(F.col("text")).alias("n_tokens"))
    scratch = Scratch(spark, "mix-rows")
    rows = rows.groupBy("doc_id", "digest", "source").agg(F.sum("n_tokens").alias("n_tokens"))
    rows = scratch.save(rows, "rows")
    shared = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("shared"))
    whole = F.concat_ws("#", F.coalesce("doc_id", F.lit("")), "digest", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    name = F.when(F.col("doc_id").isNull() | F.col("shared"), whole).otherwise(F.col("doc_id"))
    rows = scratch.save(rows.join(shared, "doc_id", "left").select("*", name.alias("name")), "named")
    mixed = mixing.mix(rows.select(F.col("name").alias("doc_id"), "source", "n_tokens"), repeats=REPEATS)
    held = mixed.groupBy(F.col("doc_id").alias("name")).agg(F.count("*").cast("int").alias("times"))
    silent = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens = 0").select(F.col("source").alias("of"))
    once = rows.join(silent, F.col("source").eqNullSafe(F.col("of")), "left_semi").select("name", F.lit(1).alias("times"))
    times = scratch.save(rows.join(held.unionByName(once), "name").select("doc_id", "digest", "source", "times"), "times")
    scratch.drop("rows")

    spare = spare_names(docs, 5)
    times = times.toDF(*spare[:4])
    same = [docs["doc_id"].cast("string").eqNullSafe(times[spare[0]]), digest_of(docs["text"]) == times[spare[1]], docs["source"].cast("string").eqNullSafe(times[spare[2]])]
    return docs.join(times, same[0] & same[1] & same[2]).withColumn(spare[4], F.explode(F.sequence(F.lit(1), F.col(spare[3])))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids and whether decoding them gave the text back."""
    coded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source", "text"), decoded=True)
    restored = F.col("decoded") == F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return coded.select("doc_id", "lang", "source", "n_tokens", "token_ids", restored.alias("restored"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again by the next."""
    prepare(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
