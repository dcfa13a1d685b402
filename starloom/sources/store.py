"""The run's table store: Parquet tables in the cluster's shared folder."""

from __future__ import annotations

import json
import math
import re
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

S, T = TypeVar("S"), TypeVar("T")
JOBS_AT_ONCE, FEWEST_JOBS_AT_ONCE = 8, 2
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
#: Rows in memory are about ten times their compressed files, so up to so many partitions there is one for this much.
SMALL_PARTITION_BYTES, MOST_SMALL_PARTITIONS = 16 * 1024 * 1024, 4096
#: What a task reads of files and of shuffles at most, so that what it sorts or groups stays in memory.
TASK_BYTES = 32 * 1024 * 1024
TASK_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
#: A job's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How many times the bytes of its files the planner takes a table to hold. By the files alone it would broadcast, through
#: the driver, tables of sorted keys and repeated texts that take many times as much unpacked.
FILE_FACTOR, UNPACKED = "spark.sql.sources.fileCompressionFactor", "20.0"
#: Codec of stored tables: padded ids and dates take about half of what the default makes of them.
TABLE_CODEC = "zstd"
LINEAGE_COLUMNS = ("ingestion_timestamp", "pipeline_run_id", "source_system")
#: An empty file in a version whose rows were all written and found right.
VERIFIED = "_VERIFIED"
#: The file that a raw row was read from.
SOURCE_FILE = "source_file"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where it is unset and all runs on one machine, one in the warehouse.

    On a cluster the warehouse may be a folder of the driver's machine, so the setting is required there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def file_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """Path, size and time of every file below ``paths``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path", "length", "modificationTime")
    )


class FolderState(NamedTuple):
    """A short name for files as they are now, and their size."""

    name: str
    bytes: int


def folder_state(spark: SparkSession, *paths: str) -> FolderState:
    files = file_listing(spark, *paths).agg(
        F.count("*").alias("count"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mark"),
    )
    count, size, mark = files.first()
    return FolderState(f"{count}-{size}-{mark % 2**64:x}", size)


def size_shuffles(spark: SparkSession, landing_bytes: int) -> None:
    """Let adaptive execution start from enough shuffle partitions for the input, and tasks take modest parts.

    It merges small partitions but never splits an ordinary one, so a default of
    a few hundred would leave terabytes to each task. Smaller inputs keep the
    session's own number, and so does a session that names a starting number. Tasks
    read ``TASK_BYTES`` of files or merged partitions unless the session names a size: rows unpacked
    from more don't fit a core's share of the memory and spill. Shuffle files are removed
    when their job ends, and a table's size is judged by its rows unpacked, unless the session says otherwise.
    """
    for setting, value in ((SHUFFLE_CLEANUP, "true"), (FILE_FACTOR, UNPACKED)):
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, value)
    for size in TASK_SETTINGS:
        if spark.conf.get(size, None) is None:
            spark.conf.set(size, str(TASK_BYTES))
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    small = min(MOST_SMALL_PARTITIONS, math.ceil(landing_bytes / SMALL_PARTITION_BYTES))
    wanted = max(small, math.ceil(landing_bytes / SHUFFLE_PARTITION_BYTES))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current and spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(wanted))


def moment(when: datetime) -> Column:
    """A naive time as a timestamp of the session's zone."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp")


def stamp_lineage(
    df: DataFrame, source: str | Column, run_id: str, loaded_at: datetime
) -> DataFrame:
    """Add when, by which run and from where a row was loaded."""
    origin = F.lit(source) if isinstance(source, str) else source
    when, run, system = LINEAGE_COLUMNS
    return df.withColumns({when: moment(loaded_at), run: F.lit(run_id), system: origin})


def version_of(path: str) -> str:
    """The name of the version folder that a table's folder or file belongs to."""
    parts = [part for part in path.split("/") if re.fullmatch(r"(v|p|files-)[0-9]{20}-[0-9a-f]{8}", part)]
    return parts[-1] if parts else path


class StoredTable(NamedTuple):
    """A table as a manifest names it: a folder of files or a list of files, and its schema."""

    path: str
    schema: str
    listed: bool = False


class TableStore:
    """Named tables below one folder.

    Each write goes to a new version directory and then becomes the table, so a job may
    replace a table it reads and a failed one replaces nothing. ``snapshot`` says which
    version of each table this store has now; a load that commits it as a manifest
    (``starloom.sources.manifest``) makes all its tables visible at once, and ``at`` opens
    just these. ``reopen`` takes up the last complete version of every table, committed or
    not, so that a load that was broken off can go on.
    """

    def __init__(
        self, spark: SparkSession, folder: str, reopen: bool = False, at: Mapping[str, StoredTable] | None = None
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._stored: dict[str, StoredTable] = {}
        self._bytes: dict[str, int] = {}
        self._locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)
        self._guard = threading.Lock()
        for name, stored in (at or {}).items():
            self._become(name, stored)
        if reopen:
            for name, versions in self._versions(f"v*/{VERIFIED}").items():
                if name not in self._stored:
                    found = spark.read.parquet(versions[-1])
                    self._become(name, StoredTable(versions[-1], found.schema.json()), found)

    def _become(self, name: str, stored: StoredTable, df: DataFrame | None = None) -> None:
        self._stored[name] = stored
        self._bytes.pop(name, None)
        if df is None:
            self._tables.pop(name, None)  # opened when it is read
        else:
            self._tables[name] = df

    def _open(self, stored: StoredTable) -> DataFrame:
        schema = StructType.fromJson(json.loads(stored.schema))
        if not stored.listed:
            return self.spark.read.schema(schema).parquet(stored.path)
        listed = self.spark.read.parquet(stored.path).select("path").collect()
        return self.files_as_table(sorted(r.path for r in listed), schema)

    def files_as_table(self, paths: Sequence[str], schema: StructType) -> DataFrame:
        """Files of a table as one DataFrame; none are an empty one."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _versions(self, marked: str) -> dict[str, list[str]]:
        """Versions of each table that hold a marker, oldest first; names sort by the time of writing."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/*/*/{marked}")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        found: dict[str, list[str]] = {}
        for file in files or []:
            version = file.getPath().getParent()
            table = version.getParent()
            name = f"{table.getParent().getName()}.{table.getName()}"
            found.setdefault(name, []).append(version.toString())
        return {name: sorted(paths) for name, paths in found.items()}

    def drop_old_versions(self, named: Iterable[str] = ()) -> int:
        """Delete all written versions but the current ones; returns how many.

        ``named`` are folders that other manifests still name. A version of which the
        current list of a table holds a file stays whole. A job of its own, for when no
        other application still reads an older version.
        """
        kept = {version_of(path) for path in named}
        for stored in self._stored.values():
            kept.add(version_of(stored.path))
            if stored.listed:
                kept |= {version_of(r.path) for r in self.spark.read.parquet(stored.path).collect()}
        dropped = 0
        for name, paths in self._versions("{v,p,files-}*/_SUCCESS").items():
            with self._lock(name):
                for path in paths:
                    if version_of(path) not in kept and name in self._stored:
                        old = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                        system = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
                        dropped += bool(system.delete(old, True))
        return dropped

    def _lock(self, name: str) -> threading.RLock:
        with self._guard:
            return self._locks[name]

    def __contains__(self, name: str) -> bool:
        return name in self._stored

    def snapshot(self) -> dict[str, StoredTable]:
        """Which stored version each table is at this moment."""
        with self._guard:
            return dict(self._stored)

    def new_version(self, name: str, kind: str = "v") -> str:
        """A folder for a new version of a table; later ones sort after earlier ones.

        ``v`` holds all rows of a table, ``p`` a part of them, ``files-`` a list of files.
        """
        return f"{self.folder}/{name.replace('.', '/')}/{kind}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def write(self, name: str, df: DataFrame, verify: Callable[[], None] | None = None) -> DataFrame:
        """Write ``df`` as the table ``name`` and return the stored table.

        ``verify`` is called when all rows are written. If it raises, the table stays what it
        was; the version that was written is not marked as verified and never taken up.
        """
        path = self.new_version(name)
        df.write.mode("overwrite").parquet(path, compression=TABLE_CODEC)
        if verify is not None:
            verify()
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERIFIED}")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker, True).close()
        with self._lock(name):
            found = self.spark.read.schema(df.schema).parquet(path)
            self._become(name, StoredTable(path, df.schema.json()), found)
        return found

    def write_work(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate table, which no snapshot for readers has to name."""
        return self.write(f"work.{name}", df)

    def drop_work(self, *names: str) -> None:
        """Delete intermediate tables that nothing will read any more."""
        for name in (f"work.{name}" for name in names):
            with self._lock(name):
                stored = self._stored.pop(name, None)
                self._tables.pop(name, None)
                self._bytes.pop(name, None)
                if stored is not None:
                    folder = self.spark._jvm.org.apache.hadoop.fs.Path(stored.path)
                    folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def adopt(self, name: str, stored: StoredTable) -> DataFrame:
        """Let files that are stored already be the table ``name``."""
        with self._lock(name):
            self._become(name, stored)
            return self.read(name)

    def read(self, name: str) -> DataFrame:
        with self._lock(name):
            if name not in self._tables:
                self._tables[name] = self._open(self._stored[name])
            return self._tables[name]

    def paths(self, name: str) -> list[str]:
        """The folder of a table, or its files if it is a list."""
        stored = self._stored[name]
        if stored.listed:
            return sorted(r.path for r in self.spark.read.parquet(stored.path).select("path").collect())
        return [stored.path]

    def stored(self, name: str) -> StoredTable:
        return self._stored[name]

    def get(self, name: str, build: Callable[[], DataFrame | tuple[DataFrame, Callable[[], None]]]) -> DataFrame:
        """The stored table, built and written first if this run has not done so.

        ``build`` gives rows, or rows and what verifies them once written. Tables have a
        lock each: independent ones may be built side by side.
        """
        with self._lock(name):
            if name not in self._stored:
                made = build()
                self.write(name, *(made if isinstance(made, tuple) else (made,)))
            return self.read(name)

    def size_in_bytes(self, name: str) -> int:
        """Bytes on storage, from a file listing."""
        if name not in self._bytes:
            stored = self._stored[name]
            if stored.listed:
                total = self.spark.read.parquet(stored.path).agg(F.sum("bytes")).first()[0]
            else:
                total = file_listing(self.spark, stored.path).agg(F.sum("length")).first()[0]
            self._bytes[name] = total or 0
        return self._bytes[name]

    def register(self, layer: str, database: str) -> None:
        """Make the tables of a layer queryable by SQL as ``database.table``."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, stored in sorted(self._stored.items()):
            of_layer, _, table = name.partition(".")
            if of_layer == layer:
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
                if stored.listed:
                    raise ValueError(f"{name} is a list of files, which a database can't name: rewrite it first")
                self.spark.catalog.createTable(f"{database}.{table}", path=stored.path, source="parquet")


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A short code table written in the query itself; no Python worker makes its rows."""
    structs = (F.struct(*(F.lit(v).alias(c) for c, v in zip(columns, row))) for row in rows)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def jobs_at_once(spark: SparkSession, total_bytes: int) -> int:
    """How many jobs over files of ``total_bytes`` together run at a time: fewer, the more of them fill the cluster.

    What a job shuffles and spills is on disk until it ends, so jobs that would only wait for
    each other's cores start later.
    """
    filling = spark.sparkContext.defaultParallelism * TASK_BYTES
    return max(FEWEST_JOBS_AT_ONCE, min(JOBS_AT_ONCE, JOBS_AT_ONCE * filling // max(1, total_bytes)))


def side_by_side(job: Callable[[S], T], names: Iterable[S], at_once: int = JOBS_AT_ONCE) -> list[T]:
    """``job`` for every name, some at a time: small jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(job, names))
