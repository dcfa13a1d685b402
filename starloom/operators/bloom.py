"""Bloom filters of keys: rows that meet no kept key go at the scan, before any shuffle.

A filter is a row of 64-bit words, set by aggregation on the executors; its size follows from
the counted number of keys and is bounded. It never drops a row whose key was kept, and lets
a few others through, so an exact join must follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, hashes of a key, and the least and the most bits of a filter (8 MB).
BITS_FOR_KEY, HASHES, FEWEST_BITS, MOST_BITS = 12, 3, 1 << 10, 1 << 26
#: Keys that a filter of the largest size takes while it lets through few others.
MOST_KEYS = MOST_BITS // 8


def bits_for(keys: int) -> int:
    """Bits of a filter for so many keys: a power of two within the bounds."""
    wanted = max(FEWEST_BITS, keys * BITS_FOR_KEY)
    return min(MOST_BITS, 1 << (wanted - 1).bit_length())


def _places(key: Column, bits: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(k)).bitwiseAND(F.lit(bits - 1)) for k in range(HASHES)]


def _bit(place: Column) -> Column:
    return place.bitwiseAND(F.lit(63)).cast("int")


def filter_words(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row, one column ``words``: the filter of all values of a column.

    Words are set by a grouped ``bit_or``, which combines before its shuffle: there are never
    more groups than words.
    """
    placed = keys.select(F.explode(F.array(*_places(F.col(column), bits))).alias("place"))
    one = F.lit(1).cast("long")
    words = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", one, _bit(F.col("place")))).alias("bits")
    )
    all_words = keys.sparkSession.range(0, bits >> 6, 1, 1).join(words, F.col("id") == F.col("word"), "left")
    numbered = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return all_words.agg(F.array_sort(F.collect_list(numbered)).alias("all")).select(F.col("all.bits").alias("words"))


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """Whether the key may be one of the filter's."""

    def is_set(place: Column) -> Column:
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftright", word, _bit(place)).bitwiseAND(F.lit(1)) == 1

    return reduce(Column.__and__, map(is_set, _places(key, bits)))
