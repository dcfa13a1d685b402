"""Conform a raw table: complete keys, known codes, one row per key; and what is rejected."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import bloom

#: Repeated keys that are few enough to send to every task.
MOST_BROADCAST_KEYS = 200_000
#: Columns of rejected rows beside their own: why, and how many rows were alike in all columns.
REASON, COPIES = "reject_reason", "copies"
NULL_KEY, REPEATED_KEY, UNBOUND_CODE = "null key", "repeated key", "unbound code"

#: Writes an intermediate table under a name and returns it as stored.
Keep = Callable[[str, DataFrame], DataFrame]


def has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(key).isNotNull() for key in keys))


def fault(keys: Sequence[str], bound: Mapping[str, Column]) -> Column:
    """Why a row can't be used by itself: a key that is null, or the first code without a meaning.

    ``bound`` tells for each code column whether its value has one; null codes are blanks and pass.
    """
    reason = F.when(~has_key(keys), NULL_KEY)
    for name, known in bound.items():
        unknown = F.col(name).isNotNull() & ~F.coalesce(known, F.lit(False))
        reason = reason.when(unknown, f"{UNBOUND_CODE}: {name}")
    return reason


def conform(
    df: DataFrame, keys: Sequence[str], bound: Mapping[str, Column] | None = None, keep: Keep | None = None
) -> DataFrame:
    """Rows with a complete key and known codes, one per key: the smallest by all other columns in order.

    Keys that repeat are found first, on the key columns alone, by a hash aggregate, and
    stored if ``keep`` is given, so that they are found once. Rows of all other keys pass
    through as they are, neither sorted nor shuffled; only among repeated ones a row is
    chosen. The choice is a total order, so reruns agree. It is taken by ``min`` over a
    struct, which combines before the shuffle: a key that holds a third of all rows travels
    as one row per input partition, where a window would sort the whole group in one task.
    """
    payload = [name for name in df.columns if name not in keys]
    complete = df.where(fault(keys, bound or {}).isNull())
    if not payload:
        return complete.distinct()
    parted = _parted(complete, keys, keep)
    if parted is None:
        return complete
    chosen = (
        parted.contested.groupBy(*keys)
        .agg(F.min(F.struct(*payload)).alias("first_row"))
        .select(*(name if name in keys else f"first_row.{name}" for name in df.columns))
    )
    return parted.single.unionByName(chosen)


class _Parted(NamedTuple):
    """All rows of keys that repeat, and rows of keys that do not."""

    contested: DataFrame
    single: DataFrame


def _parted(df: DataFrame, keys: Sequence[str], keep: Keep | None) -> _Parted | None:
    """Rows parted by whether their key repeats; None if none does.

    Few repeated keys are broadcast. Of more, a Bloom filter of a bounded size is, so that no row
    is shuffled to be parted, however many there are: it lets some rows of other keys pass as
    contested, of which each wins its key unopposed.
    """
    names = {key: f"repeated_{key}" for key in keys}
    repeated = duplicate_keys(df, keys).select(*(F.col(k).alias(n) for k, n in names.items()))
    if keep is not None:
        repeated = keep("repeated_keys", repeated)
    count = repeated.count()
    if not count:
        return None
    if count <= MOST_BROADCAST_KEYS:
        same = reduce(Column.__and__, (F.col(k) == F.col(n) for k, n in names.items()))
        listed = F.broadcast(repeated)
        return _Parted(df.join(listed, same, "left_semi"), df.join(listed, same, "left_anti"))
    bits = bloom.bits_for(count)
    hashed = repeated.select(F.xxhash64(*names.values()).alias("hashed"))
    words = bloom.filter_words(hashed, "hashed", bits).scalar()
    may_repeat = bloom.may_hold(words, F.xxhash64(*keys), bits)
    return _Parted(df.where(may_repeat), df.where(~may_repeat))


class Screened(NamedTuple):
    """Rows that are kept, and all others with ``REASON`` and ``COPIES``."""

    kept: DataFrame
    rejected: DataFrame


def screen(
    df: DataFrame, keys: Sequence[str], bound: Mapping[str, Column], keep: Keep, place: Sequence[str] = ()
) -> Screened:
    """What ``conform`` keeps, and every other row with the reason why it is not kept.

    Rows that are alike in all columns are one rejected row with their number, so raw rows
    are kept rows plus the sum of copies, and a hot key of equal rows is one row. Rivals for
    a key are grouped by all their columns, which no key makes hot; the winner of a key, a
    ``min`` that combines before its shuffle, is joined to them. Columns in ``place`` (where
    a row came from) only decide between rows that are alike in all others.
    """
    own = [name for name in df.columns if name not in place]
    payload = [name for name in [*own, *place] if name not in keys]
    told = df.withColumn(REASON, fault(keys, bound))
    fit = told.where(F.col(REASON).isNull()).drop(REASON)
    faulty = told.where(F.col(REASON).isNotNull()).withColumn(COPIES, F.lit(1).cast("bigint"))
    parted = _parted(fit, keys, keep)
    if parted is None:
        return Screened(fit, faulty)
    rivals = parted.contested.groupBy(*df.columns).agg(F.count("*").alias(COPIES))
    if payload:
        best = rivals.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__best"))
        wins = F.struct(*payload).eqNullSafe(F.col("__best"))
        rivals = rivals.join(best, list(keys)).withColumn("__wins", wins).drop("__best")
    else:
        rivals = rivals.withColumn("__wins", F.lit(True))
    rivals = keep("rivals", rivals)
    losers = rivals.withColumn(COPIES, F.col(COPIES) - F.col("__wins").cast("bigint")).where(F.col(COPIES) > 0)
    lost = losers.select(*df.columns, F.lit(REPEATED_KEY).alias(REASON), COPIES)
    kept = parted.single.unionByName(rivals.where("__wins").select(*df.columns))
    return Screened(kept, faulty.unionByName(lost))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with how many rows hold them."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: whether any key is held twice. The limit stops at the first one found."""
    return duplicate_keys(df, keys).limit(1).agg((F.count("*") > 0).alias("has_duplicates"))


class DuplicateKeyError(ValueError):
    """A table that must have one row per key has more."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """``df`` itself, after a check that its keys are unique."""
    if not duplicate_keys(df, keys).isEmpty():
        raise DuplicateKeyError(f"{table}: more than one row for a value of {', '.join(keys)}")
    return df
