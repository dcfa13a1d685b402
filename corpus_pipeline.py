"""The corpus pipeline: each stage calls one operator and works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, language, mixture, pii, simhash
from starloom.llm.settings import MIX_SEED, OTHER_WEIGHT, TARGET_WEIGHTS
from starloom.llm.shared import modest_batches, reach_package, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be identified (null, or without a letter) go.

    The others stay, whatever language they are in; one without a stated language gets the
    identified one. If none was learned, the same documents go.
    """
    reach_package(spark)
    modest_batches(spark)
    profiles = language.learn(docs.select("text", "lang"))
    return language.with_language(docs, profiles)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id."""
    reach_package(spark)
    modest_batches(spark)
    return simhash.one_of_each_group(docs, shingle=4, bits=4)


def decontaminate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more stands in benchmark windows go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    reach_package(spark)
    modest_batches(spark)
    return pii.without_personal_data(docs, pii.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet the target weights, and shuffled."""
    return mixture.replicated(docs, TARGET_WEIGHTS, OTHER_WEIGHT, epochs=1.0, seed=MIX_SEED)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate_texts),
    ("personal_data", hide_personal_data),
    ("mixture", mix_sources),
]
#: SimHash, the language profiles and the random field have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
