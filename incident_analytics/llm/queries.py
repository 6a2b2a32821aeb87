"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.llm import bpe, lm, merkle, minhash, mixing, neighbours, oracles, pii, quality, repair, spotsigs, suffix_tree, suffixes, toxicity
from incident_analytics.llm.shared import ship

Query = Callable[[SparkSession, str], DataFrame]
#: Operators call it themselves; callers that send functions of this package on their own may too.
send_package = ship


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.with_copies(documents(spark, sf_dir), ["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(documents(spark, sf_dir), ranks)


def spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(documents(spark, sf_dir))


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(documents(spark, sf_dir))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    out = lm.scores(docs, ~held_out).withColumn("held_out", held_out)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.with_score(docs, toxicity_model(spark, docs, sf_dir))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeated_bytes(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_tree.without_repeated_words(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def merkle_rows(docs: DataFrame, height: int = merkle.HEIGHT) -> DataFrame:
    """The manifest of documents by lang, and proofs of leaves of which a seventh claims one character more."""
    others = [F.col(c) for c in ("doc_id", "source", "lang")]
    more = F.col("n_chars").cast("decimal(20, 0)") + 1
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    whole = merkle.leaf_digest(*others, F.col("n_chars"), F.col("text"))
    claim = F.when(tampered, merkle.leaf_digest(*others, more, F.col("text"))).otherwise(whole)
    leaves = docs.select("doc_id", "lang", whole.alias("digest"), claim.alias("claim"))
    proofs = merkle.manifest(leaves, "lang", "doc_id", height).proofs()
    return proofs.select(
        F.col("key").alias("doc_id"),
        *(F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.lower(F.hex("proof")).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(documents(spark, sf_dir))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with a fault that the crc32 of conv_id and turn draws; nulls are one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    drawn = rows.select("conv_id", "turn", "role", F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.coalesce("role", space))
    times = F.when(F.col("_fault") == 3, 2).otherwise(1)
    return drawn.filter("_fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))


def repaired_rows(rows: DataFrame) -> DataFrame:
    """Every conversation after damage and repair; zeros and the empty text's digest where no row is left."""
    made = repair.repaired(damaged(rows))
    found = made.conversations.withColumnRenamed("conv_id", "_found")
    digests = made.digests()
    every = rows.select("conv_id").distinct()
    every = every.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left")
    every = every.join(digests, F.col("conv_id").eqNullSafe(F.col("key")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return every.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_toxicity": toxicity_scores,
        "op2_suffix_array_dedup": suffix_array_dedup,
        "op3_substring_dedup": substring_dedup,
        "op4_source_mix": source_mix,
        "op5_quality_rules": quality_rules,
        "op6_spot_fingerprints": spot_fingerprints,
        "op7_lm_score": lm_scores,
        "op8_byte_bpe": byte_bpe,
        "op9_minhash_dedup": minhash_dedup,
        "op10_pii": personal_data,
        "op11_merkle_manifest": merkle_manifest,
        "op12_conversation_repair": conversation_repair,
        "op13_hilbert_neighbours": nearest_vectors,
    }


def llm_oracles() -> dict[str, str]:
    """SQL by query name; the queries without are tested against plain Python."""
    return {
        "op3_substring_dedup": oracles.SUBSTRING_DEDUP,
        "op4_source_mix": oracles.SOURCE_MIX,
        "op9_minhash_dedup": oracles.MINHASH_DEDUP,
        "op11_merkle_manifest": oracles.MERKLE,
        "op12_conversation_repair": oracles.REPAIR,
    }
