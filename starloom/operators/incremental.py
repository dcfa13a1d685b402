"""Loads that touch only what has changed since the last one.

Beside a conformed table lies a digest of the raw rows of each of its keys. A later load
compares the digests of the raw rows as they are now with those: only keys whose digests
differ are conformed again, and only the files that hold such a key are rewritten. All other
files are carried over to the new list of the table's files, under their names.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.conform import MOST_BROADCAST_KEYS, conform, fault
from starloom.operators.layout import TARGET_FILE_BYTES, adopt_list, listed_files, new_files
from starloom.sources.store import TABLE_CODEC, TableStore


class Changes(NamedTuple):
    """Keys that differ from the last load, files that stayed, were replaced, and are new."""

    keys: int
    kept: int
    replaced: int
    written: int


def key_digests(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows, digest): the same for two sets of rows of a key only if they are the same set.

    Sums of hashes combine before the shuffle, in any order; a key that holds a third of all
    rows is one row for each task.
    """
    hashed = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.count("*").alias("__rows"), F.sum(hashed).alias("__digest"))


def _differing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of which the raw rows were added, removed or changed."""
    before = old.select(*(F.col(k).alias(f"__old_{k}") for k in keys), F.struct("__rows", "__digest").alias("__before"))
    same = reduce(Column.__and__, (F.col(k) == F.col(f"__old_{k}") for k in keys))
    both = new.withColumn("__now", F.struct("__rows", "__digest")).join(before, same, "full_outer")
    return both.where(~F.col("__now").eqNullSafe(F.col("__before"))).select(
        *(F.coalesce(k, f"__old_{k}").alias(k) for k in keys)
    )


def _few(keys: DataFrame, count: int) -> DataFrame:
    return F.broadcast(keys) if count <= MOST_BROADCAST_KEYS else keys


def replace_keys(
    store: TableStore, name: str, keys: DataFrame, count: int, rows: DataFrame, file_bytes: int = TARGET_FILE_BYTES
) -> Changes:
    """Put ``rows`` in place of all rows of a stored table that have one of ``keys``.

    Files without such a row stay. The others' remaining rows and the new ones are written
    together; the table is then a list of files.
    """
    columns, stored = keys.columns, store.stored(name)
    files = listed_files(store, name)
    table = store.read(name)
    touched = (
        table.withColumn("__file", F.col("_metadata.file_name"))
        .join(_few(keys, count), columns, "left_semi")
        .select("__file")
        .distinct()
    )
    names = {r[0] for r in touched.collect()}
    held = files.select("path", "bytes").collect()
    replaced = {f.path: f.bytes for f in held if f.path.rpartition("/")[2] in names}
    left = store.files_as_table(sorted(replaced), table.schema).join(_few(keys, count), columns, "left_anti")
    made = left.unionByName(rows.select(*table.columns))
    parts = max(1, math.ceil(sum(replaced.values()) / file_bytes))
    folder = store.new_version(name, "p")
    made.repartition(parts).write.parquet(folder, compression=TABLE_CODEC)
    new = new_files(store, folder, table.schema, files)
    gone = store.spark.createDataFrame([(p,) for p in replaced], "path string")
    adopt_list(store, name, stored.schema, files.join(gone, "path", "left_anti").unionByName(new))
    return Changes(count, len(held) - len(replaced), len(replaced), new.count())


def conform_changes(
    store: TableStore, name: str, raw: DataFrame, keys: Sequence[str], bound: Mapping[str, Column] | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> Changes:
    """Make ``conformed.<name>`` what ``conform`` makes of ``raw``, from what it was.

    The first load writes all of it. Rows with a null key or an unknown code are no part of
    a key's digest: they come and go without a change.
    """
    table, digests = f"conformed.{name}", f"digests.{name}"
    fit = raw.where(fault(keys, bound or {}).isNull())

    def keep(what: str, df: DataFrame) -> DataFrame:
        return store.write_work(f"{name}_{what}", df)

    if table not in store or digests not in store:
        store.write(table, conform(raw, keys, bound, keep))
        store.write(digests, key_digests(fit, keys))
        return Changes(store.read(digests).count(), 0, 0, listed_files(store, table).count())
    now = keep("digests", key_digests(fit, keys))
    changed = keep("changed", _differing(store.read(digests), now, keys))
    count = changed.count()
    if not count:
        return Changes(0, listed_files(store, table).count(), 0, 0)
    rows = conform(fit.join(_few(changed, count), list(keys), "left_semi"), keys, None, keep)
    made = replace_keys(store, table, changed, count, rows, file_bytes)
    store.adopt(digests, store.stored(f"work.{name}_digests"))
    return made
