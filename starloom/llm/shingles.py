"""Word shingles as column expressions, and tables cut into blocks that may be broadcast."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import BROADCAST_BYTES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Words of a text column: A-Z lowered, runs of digits, letters and non-ASCII; null has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def hash_at(array: str, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from the 0-based position ``at``."""
    return F.xxhash64(*(F.get(F.col(array), at + k) for k in range(size)))


def positions(docs: DataFrame, size: int) -> DataFrame:
    """A row for each word position of each document with the shingle that starts there.

    Position 0 is there for every document, so a document without words has a row;
    near the end, where a shingle does not fit, the shingle is null.
    """
    place = F.col("at")
    placed = docs.withColumn("at", F.explode_outer(F.sequence(F.lit(0), F.size("doc_words"))))
    fits = place + size <= F.size("doc_words")
    return placed.withColumn("shingle", F.when(fits, hash_at("doc_words", place, size)))


def blocks(df: DataFrame, row_bytes: Column) -> list[DataFrame]:
    """``df`` in parts that are each small enough to broadcast; at least one.

    Rows are dealt by a hash of the whole row, so rows that share a key part as well.
    """
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    count = max(1, math.ceil(size / BROADCAST_BYTES))
    if count == 1:
        return [F.broadcast(df)]
    part = F.pmod(F.xxhash64(F.lit("block"), *df.columns), F.lit(count))
    return [F.broadcast(df.where(part == k)) for k in range(count)]
