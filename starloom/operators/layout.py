"""How the files of a stored table lie: clustered by day or along a curve, and compacted.

A table is a folder, or a list of files with their sizes and, if it was laid out for it, the
least and greatest value that each file holds of some columns. Lists let a rewrite leave files
where they are, and let a reader leave out files that a filter can't meet.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.sources.store import TABLE_CODEC, StoredTable, TableStore, file_listing

TARGET_FILE_BYTES = 256 * 1024 * 1024
#: A file below this share of the target is small.
SMALL_SHARE = 0.75
#: A place along a curve is a number of so many bits, shared among the columns.
CURVE_BITS = 18
#: And of a column's rank, of so many at most.
MOST_RANK_BITS = 8
#: Accuracy of the quantiles between ranks: rows over this number, at worst.
QUANTILE_ACCURACY = 2_000
#: Files that one job merges others into, at most: each is a branch of its plan.
MOST_MERGED_AT_ONCE = 64


def clustered(df: DataFrame, date_key: str, spread_by: str, files: int) -> DataFrame:
    """Rows range-partitioned by date and sorted within each file.

    ``spread_by`` (the row's own key) breaks ties in the ranges: a day that
    holds a third of all rows is cut over several files, not sent to one task.
    """
    return df.repartitionByRange(files, date_key, spread_by).sortWithinPartitions(
        date_key, spread_by
    )


def rewrite_clustered(
    store: TableStore, name: str, date_key: str, spread_by: str, into: TableStore | None = None,
    made: Collection[str] = (), make: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows of stored table ``name`` in files of about 256 MB by date.

    They replace the table, or become the table of that name of another store. Columns ``made``
    follow from the others: they are not shuffled and sorted, ``make`` adds them to the rows in their places.
    """
    files = max(1, math.ceil(store.size_in_bytes(name) / TARGET_FILE_BYTES))
    rows = store.read(name)
    laid = clustered(rows.drop(*made), date_key, spread_by, files)
    return (into or store).write(name, (make(laid) if make else laid).select(*rows.columns))


# -- a curve through several columns -------------------------------------------


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """Values that cut each column into at most 2^bits parts of about equal rows.

    One pass; each task keeps a sketch of a bounded size. A value that holds many parts'
    rows is one part, so there may be fewer cuts.
    """
    parts = 1 << bits
    shares = F.array(*(F.lit(k / parts) for k in range(1, parts)))
    cuts = df.agg(*(F.percentile_approx(c, shares, QUANTILE_ACCURACY).alias(c) for c in columns)).first()
    return {c: sorted(set(cuts[c] or ())) for c in columns}


def rank_of(column: Column, cuts: Sequence, below: int = 0) -> Column:
    """How many of the sorted ``cuts`` are at most the column's value, plus ``below``, by halving."""
    if not cuts:
        return F.lit(below).cast("long")
    middle = len(cuts) // 2
    upper = rank_of(column, cuts[middle + 1 :], below + middle + 1)
    return F.when(column >= F.lit(cuts[middle]), upper).otherwise(rank_of(column, cuts[:middle], below))


def curve(ranks: Sequence[Column], bits: int) -> Column:
    """Place along a curve that halves every column in turn: the ranks' bits, interleaved."""
    places = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(ranks) + at)
        for bit in range(bits)
        for at, rank in enumerate(reversed(ranks))
    ]
    return reduce(Column.bitwiseOR, places)


def boxes(rows_at: Mapping[int, int], depth: int, most_rows: float) -> dict[int, tuple[int, int]]:
    """For each place along a curve of 2^depth places: its first file, and how many files it has.

    The curve is halved until a part holds ``most_rows`` at most. A part is a box: between
    two cuts in every column, so its file's ranges overlap no other's by chance. A single
    place that holds more is given several files.
    """
    places = sorted(rows_at)
    before = [0, *accumulate(rows_at[p] for p in places)]
    out: dict[int, tuple[int, int]] = {}
    files, parts = 0, [(0, 1 << depth)]
    while parts:
        low, high = parts.pop()
        first, last = bisect_left(places, low), bisect_left(places, high)
        rows = before[last] - before[first]
        if not rows:
            continue
        if rows > most_rows and high - low > 1:
            middle = (low + high) // 2
            parts += [(middle, high), (low, middle)]
            continue
        count = max(1, math.ceil(rows / most_rows))
        out |= dict.fromkeys(places[first:last], (files, count))
        files += count
    return out


def curved(df: DataFrame, columns: Sequence[str], spread_by: str, files: int) -> DataFrame:
    """Rows in about ``files`` files along a curve through ``columns``, each file a box.

    A filter on any of the columns meets few files. A null counts as the least value. Rows
    are counted by place first, of which there are 2^18 at most; a place that holds a third
    of all rows is dealt by ``spread_by`` to files of its own.
    """
    bits = min(MOST_RANK_BITS, CURVE_BITS // len(columns))
    bounds = rank_bounds(df, columns, bits)
    ranks = {
        f"__rank{k}": F.when(F.col(c).isNull(), F.lit(0).cast("long")).otherwise(rank_of(F.col(c), bounds[c]))
        for k, c in enumerate(columns)
    }
    placed = df.withColumns(ranks).withColumn("__place", curve([F.col(r) for r in ranks], bits)).drop(*ranks)
    rows_at = dict(placed.groupBy("__place").count().collect())
    most_rows = max(1.0, sum(rows_at.values()) / files)
    dealt = boxes(rows_at, bits * len(columns), most_rows)
    if not dealt:
        return df
    made = max(first + count for first, count in dealt.values())
    target = df.sparkSession.createDataFrame(
        [(place, first, count) for place, (first, count) in dealt.items()], "__place long, __first int, __files int"
    )
    own = F.col("__first") + F.pmod(F.xxhash64(spread_by), F.col("__files")).cast("int")
    return (
        placed.join(F.broadcast(target), "__place")
        .withColumn("__file", own)
        .repartitionById(made, "__file")
        .sortWithinPartitions("__place", spread_by)
        .select(*df.columns)
    )


def file_statistics(store: TableStore, paths: Sequence[str], schema: StructType, columns: Sequence[str]) -> DataFrame:
    """(path, bytes, row_count, low, high) of files: the range of each column, by one narrow scan."""
    sizes = file_listing(store.spark, *paths).select("path", F.col("length").alias("bytes"))
    by_name = sizes.withColumn("name", F.element_at(F.split("path", "/"), -1))
    rows = store.spark.read.schema(schema).parquet(*paths)
    ranges = rows.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.count("*").alias("row_count"),
        F.struct(*(F.min(c).alias(c) for c in columns)).alias("low"),
        F.struct(*(F.max(c).alias(c) for c in columns)).alias("high"),
    )
    return by_name.join(ranges, "name").drop("name")


def adopt_list(store: TableStore, name: str, schema: str, files: DataFrame) -> DataFrame:
    """Let a list of files be the table ``name``."""
    path = store.new_version(name, "files-")
    files.coalesce(1).write.parquet(path)
    return store.adopt(name, StoredTable(path, schema, listed=True))


def listed_files(store: TableStore, name: str) -> DataFrame:
    """The files of a stored table: path and bytes, and what its list knows besides."""
    stored = store.stored(name)
    if stored.listed:
        return store.spark.read.parquet(stored.path)
    files = file_listing(store.spark, stored.path).select("path", F.col("length").alias("bytes"))
    return files.where(F.element_at(F.split("path", "/"), -1).startswith("part-"))


def new_files(store: TableStore, folder: str, schema: StructType, like: DataFrame) -> DataFrame:
    """The files of a folder, with the ranges of the columns that the list ``like`` has ranges of."""
    if "low" in like.columns:
        return file_statistics(store, [folder], schema, like.schema["low"].dataType.names)
    files = file_listing(store.spark, folder).select("path", F.col("length").alias("bytes"))
    return files.where(F.element_at(F.split("path", "/"), -1).startswith("part-"))


def rewrite_curved(
    store: TableStore, name: str, columns: Sequence[str], spread_by: str, into: TableStore | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Stored table ``name`` rewritten along a curve, with the range of every column in each file."""
    beside, rows = into or store, store.read(name)
    files = max(1, math.ceil(store.size_in_bytes(name) / file_bytes))
    beside.write(name, curved(rows, columns, spread_by, files))
    stored = beside.stored(name)
    listed = file_statistics(beside, [stored.path], rows.schema, columns)
    return adopt_list(beside, name, stored.schema, listed)


def files_where(store: TableStore, name: str, ranges: Mapping[str, tuple[Any, Any]]) -> list[str]:
    """Files of a listed table that may hold a row with all columns within their ranges."""
    files = store.spark.read.parquet(store.stored(name).path)
    known = set(files.schema["low"].dataType.names) if "low" in files.columns else set()
    for column, (low, high) in ranges.items():
        if column in known:
            files = files.where((F.col(f"high.{column}") >= F.lit(low)) & (F.col(f"low.{column}") <= F.lit(high)))
    return sorted(r.path for r in files.select("path").collect())


def read_where(store: TableStore, name: str, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """Rows of a stored table with all columns within ranges (ends included).

    Of a listed table only files are opened whose own ranges meet them.
    """
    rows = store.read(name)
    if store.stored(name).listed:
        rows = store.files_as_table(files_where(store, name, ranges), rows.schema)
    within = [F.col(c).between(F.lit(low), F.lit(high)) for c, (low, high) in ranges.items()]
    return rows.where(reduce(Column.__and__, within)) if within else rows


# -- compaction --------------------------------------------------------------------


def pack(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Places of ``sizes`` in bins of ``capacity`` by first-fit decreasing; larger ones are alone.

    The room left in bins is kept in a tree of maxima, so the first bin with room is found
    in logarithmic time.
    """
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    width = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * width)
    bins: list[list[int]] = [[] for _ in range(width)]
    for k in order:
        need, at = min(sizes[k], capacity), 1
        while at < width:
            at = 2 * at if room[2 * at] >= need else 2 * at + 1
        bins[at - width].append(k)
        room[at] -= need
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return [b for b in bins if b]


class Compaction(NamedTuple):
    """Files that stayed where they are, that were merged, and that they were merged into."""

    kept: int
    merged: int
    written: int


def whole_reads(spark: SparkSession) -> SparkSession:
    """A session with the same settings in which files that are read together are one partition."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in (("maxPartitionBytes", str(1 << 60)), ("openCostInBytes", "0"), ("minPartitionNum", "1")):
        session.conf.set(f"spark.sql.files.{name}", value)
    return session


def merge_files(spark: SparkSession, schema: StructType, bins: Sequence[Sequence[str]], folder: str) -> None:
    """Write one file for each list of files, which one task reads one after the other: no row is shuffled."""
    session = whole_reads(spark)
    for first in range(0, len(bins), MOST_MERGED_AT_ONCE):
        merged = [session.read.schema(schema).parquet(*paths) for paths in bins[first : first + MOST_MERGED_AT_ONCE]]
        reduce(DataFrame.union, merged).write.mode("append").parquet(folder, compression=TABLE_CODEC)


def compact(
    store: TableStore, name: str, into: TableStore | None = None, file_bytes: int = TARGET_FILE_BYTES
) -> Compaction:
    """Merge the small files of a stored table into files of up to ``file_bytes``.

    Only rows of small files are read and written, each file by the task that writes the one it goes
    into; all other files stay in place, under their names. A small file that finds no other to go
    with stays as well. The table is then a list of files; ranges of columns that a list
    had are found again for new files.
    """
    beside, stored = into or store, store.stored(name)
    files = listed_files(store, name)
    listed = sorted(files.select("path", "bytes").collect())
    small = [f for f in listed if f.bytes < SMALL_SHARE * file_bytes]
    bins = [b for b in pack([f.bytes for f in small], file_bytes) if len(b) > 1]
    if not bins:
        if beside is not store:
            beside.adopt(name, stored)
        return Compaction(len(listed), 0, 0)
    spark, schema = store.spark, store.read(name).schema
    merged = {small[k].path for b in bins for k in b}
    folder = beside.new_version(name, "p")
    merge_files(spark, schema, [[small[k].path for k in b] for b in bins], folder)
    gone = spark.createDataFrame([(p,) for p in merged], "path string")
    stays = files.join(gone, "path", "left_anti")
    new = new_files(beside, folder, schema, files)
    adopt_list(beside, name, schema.json(), stays.unionByName(new))
    return Compaction(len(listed) - len(merged), len(merged), len(bins))
