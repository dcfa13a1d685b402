"""Guarded key joins.

A guarded join attaches a parent that must have at most one row per key. All
that can go wrong is counted in one job over the keys alone, pre-aggregated on
both sides, so a hot key or a third of NULL keys costs no more than any other.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.operators.conform import duplicate_keys


#: Rows of a few numbers that are few enough to send to every task.
MOST_BROADCAST_ROWS = 500_000


class JoinGuardError(ValueError):
    """A guarded join would repeat or lose rows, or misses mandatory parents."""


class UnmatchedKeysWarning(UserWarning):
    """An optional guarded join found keys without a parent."""


def join_guard(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row of counts: child rows, rows after a left join, duplicated parent keys, unmatched rows."""
    children = child.groupBy(F.col(key).alias("child_key")).agg(F.count("*").alias("children"))
    parents = parent.groupBy(F.col(key).alias("parent_key")).agg(F.count("*").alias("parents"))
    both = children.join(parents, F.expr("child_key = parent_key"), "full_outer")
    unmatched = (
        F.col("children").isNotNull() & F.col("child_key").isNotNull() & F.col("parents").isNull()
    )
    fan_out = F.col("children") * F.coalesce("parents", F.lit(1))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return both.agg(
        total("children").alias("child_rows"),
        total(fan_out).alias("joined_rows"),
        F.count_if(F.col("parents") > 1).alias("duplicate_parent_keys"),
        total(F.when(unmatched, F.col("children"))).alias("unmatched_rows"),
    )


def require_parents(
    child: DataFrame, parent: DataFrame, key: str, relationship: str, mandatory: bool = True
) -> None:
    """Judge what ``join_guard`` counts: raise or warn as ``safe_left_join`` says, without a join of whole rows."""
    guard = join_guard(child, parent, key).first()
    if guard.duplicate_parent_keys:
        raise JoinGuardError(
            f"{relationship}: {guard.duplicate_parent_keys} values of {key} repeat in the parent"
        )
    if guard.joined_rows != guard.child_rows:
        raise JoinGuardError(
            f"{relationship}: {guard.child_rows} rows would become {guard.joined_rows}"
        )
    _judge_unmatched(guard.unmatched_rows, key, relationship, mandatory)


def safe_left_join(
    child: DataFrame, parent: DataFrame, key: str, relationship: str, mandatory: bool = True
) -> DataFrame:
    """``child`` with the columns of its one parent row per ``key``.

    Raises when a parent key repeats, and, for a mandatory relationship, when a
    non-null child key has no parent; an optional one warns and keeps the rows
    with NULLs. Child columns come first, in their order.
    """
    require_parents(child, parent, key, relationship, mandatory)
    added = [name for name in parent.columns if name != key]
    return child.join(parent, key, "left").select(*child.columns, *added)


def _judge_unmatched(rows: int, key: str, relationship: str, mandatory: bool) -> None:
    if rows:
        problem = f"{relationship}: {rows} rows have a {key} the parent lacks"
        if mandatory:
            raise JoinGuardError(problem)
        warnings.warn(problem, UnmatchedKeysWarning, stacklevel=3)


class Guarded(NamedTuple):
    """Rows whose guard is counted while they are written, and what judges the counts afterwards.

    ``verify`` raises or warns; it must be called after the first action on ``rows``, and
    what was written counts only if it returns.
    """

    rows: DataFrame
    verify: Callable[[], None]


def require_unique_parent(parent: DataFrame, key: str, relationship: str) -> None:
    """Refuse a parent in which a key, used or not, repeats; reads its key column only."""
    repeated = duplicate_keys(parent.select(key), [key]).count()
    if repeated:
        raise JoinGuardError(f"{relationship}: {repeated} values of {key} repeat in the parent")


def guarded_left_join(
    child: DataFrame, parent: DataFrame, key: str, relationship: str, mandatory: bool = True
) -> Guarded:
    """``safe_left_join`` whose child is read and shuffled once: its guard is counted on the joined rows.

    Repeated parent keys are looked for first, in the parent alone. With none of them, no row
    can become two; what is left, children without a parent, an observation counts as the
    rows pass by. A task that runs
    again may count a row twice, so the number in the message is at least that of the rows;
    whether there are any is exact.
    """
    require_unique_parent(parent, key, relationship)
    observation = Observation()
    there = parent.withColumn("__there", F.lit(True))
    lacking = F.col(key).isNotNull() & F.col("__there").isNull()
    joined = child.join(there, key, "left").observe(observation, F.count_if(lacking).alias("unmatched_rows"))
    added = [name for name in parent.columns if name != key]

    def verify() -> None:
        _judge_unmatched(observation.get["unmatched_rows"], key, relationship, mandatory)

    return Guarded(joined.select(*child.columns, *added), verify)


def orphan_rows(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias("known_key"))
    return child.where(F.col(child_key).isNotNull()).join(
        known, F.col(child_key) == F.col("known_key"), "left_anti"
    )


def require_no_orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, relationship: str
) -> DataFrame:
    """``child`` itself, after a check that it has no orphans."""
    if not orphan_rows(child, child_key, parent, parent_key).isEmpty():
        raise JoinGuardError(f"{relationship}: {child_key} holds values missing from {parent_key}")
    return child


def broadcast_if_few(lookup: DataFrame) -> DataFrame:
    """``lookup``, a few numbers a row, with a hint to broadcast it if its rows, which are counted, are few.

    Its other side is then not shuffled; how large its files are does not matter.
    """
    return F.broadcast(lookup) if lookup.count() <= MOST_BROADCAST_ROWS else lookup


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, small: bool) -> DataFrame:
    """Inner equi-join to a lookup; rows without one drop out.

    The hint is given only for a lookup whose checked size is ``small``. A
    larger one is left to the planner, which splits skewed partitions.
    """
    return rows.join(F.broadcast(lookup) if small else lookup, key)
