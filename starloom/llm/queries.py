"""One query for each corpus operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    decontaminate,
    fuzzy,
    language,
    licenses,
    mixture,
    pii,
    resampling,
    secrets,
    simhash,
    substring,
    tokens,
    toxicity,
    whitening,
)
from starloom.llm.settings import MIX_SEED, OTHER_WEIGHT, TARGET_WEIGHTS
from starloom.llm.shared import held_out, table
from starloom.llm.sql import CORPUS_SQL


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.finder(pii.learn(docs))("text").alias("found"))
    return found.select(
        "doc_id",
        *(f"found.n_{kind}" for kind in pii.KINDS),
        F.sha2("found.base", 256).alias("base_sha256"),
        "found.spans",
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"), shingle=4, bits=4)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")

def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixture.replicated(docs, TARGET_WEIGHTS, OTHER_WEIGHT, epochs=1.0, seed=MIX_SEED)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    seen = labels.where(~held_out("doc_id", 5, 0))
    score = toxicity.scorer(toxicity.learn(docs, seen))("text")
    return docs.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, folder, "documents"), "byte_bpe_50k.json")
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op7_fuzzy_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy.fingerprints(table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.without_repeats(table(spark, folder, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = language.learn(docs.where(~held_out("doc_id", 4, 2)).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "language.*")


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = licenses.license_matches(docs, licenses.common_licenses(spark))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_licenses"),
        F.concat_ws(",", "matches.license").alias("licenses"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("containment"),
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``deviation`` is null where it is beyond a long; ``deviation_exact`` has it to 38 digits."""
    found = whitening.whitened(table(spark, folder, "embeddings"), "vec_id", "embedding", components=8)
    return found.select(
        "vec_id",
        "component",
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        F.col("deviation").alias("deviation_exact"),
    )


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.resampled(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=25
    )
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(table(spark, folder, "documents"), repository="doc_id", owner="source")
    counts = [f"n_{kind}" for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "live", "copied")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_toxicity": op2_toxicity,
    "op3_personal_data": op3_personal_data,
    "op4_simhash": op4_simhash,
    "op5_token_counts": op5_token_counts,
    "op6_decontaminate": op6_decontaminate,
    "op7_fuzzy_fingerprints": op7_fuzzy_fingerprints,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language": op9_language,
    "op10_licenses": op10_licenses,
    "op11_whitening": op11_whitening,
    "op12_resampling": op12_resampling,
    "op13_secrets": op13_secrets,
}
LLM_SQL: dict[str, str] = CORPUS_SQL
