"""A training corpus from raw documents: each stage reads what the one before kept.

Rows may repeat and any column may be null; other columns of the documents pass through. An empty table
gives an empty corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.llm import bpe, minhash, mixing, pii, queries, toxicity
from incident_analytics.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones among them, scores below one half."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return toxicity.with_score(docs, model, "_toxic").filter("_toxic < 0.5").drop("_toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies. Five-word shingles, similarity 0.8."""
    found = minhash.near_duplicates(docs, k=5)
    # Ids are unique in documents; rows that share one share its fate.
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    # The ids kept are the small side; a hash of them spares sorting the texts.
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placeholders instead of personal data, and n_chars of the new text."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each row."""
    tokens = bpe.encode(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_texts),
]

#: SQL can't express the model, the automata or the merges; a test compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
