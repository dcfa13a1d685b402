"""Manifests: all tables of a load become visible in one step.

A load writes new versions of its tables beside the old ones, which nobody sees. Its last
step creates one small file that names the version and the schema of every table. Readers
open the newest manifest, or an older one, and read just the versions it names, whatever a
load writes meanwhile; a load that breaks off before its manifest has changed nothing.

A manifest is written under a name of its own and renamed to its number, which fails if the
number is taken: of two loads that go on from the same manifest one commits, the other gets a
``CommitConflictError``. This needs a file system whose rename refuses an existing target.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starloom.sources.store import StoredTable


class CommitConflictError(RuntimeError):
    """Another load has committed since the manifest that this one goes on from."""


class Manifest(NamedTuple):
    number: int
    properties: dict[str, str]
    tables: dict[str, StoredTable]


class Manifests:
    """The manifests below ``<home>/_manifests``, by number from 1."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark = spark
        self.home = home.rstrip("/")
        self.folder = f"{self.home}/_manifests"
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _name(self, number: int) -> str:
        return f"{number:010d}.json"

    def numbers(self) -> list[int]:
        """Committed numbers, oldest first."""
        pattern = self._path("[0-9]*.json")
        found = pattern.getFileSystem(self._conf).globStatus(pattern)
        return sorted(int(f.getPath().getName().partition(".")[0]) for f in found or [])

    def read(self, number: int) -> Manifest:
        path = self._path(self._name(number))
        stream = path.getFileSystem(self._conf).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        content = json.loads(text)
        tables = {
            name: StoredTable(self._absolute(t["path"]), json.dumps(t["schema"]), t["listed"])
            for name, t in content["tables"].items()
        }
        return Manifest(number, content["properties"], tables)

    def latest(self, **properties: str) -> Manifest | None:
        """The newest manifest, or the newest one with these properties."""
        for number in reversed(self.numbers()):
            found = self.read(number)
            if properties.items() <= found.properties.items():
                return found
        return None

    def commit(
        self, tables: Mapping[str, StoredTable], properties: Mapping[str, str], after: int | None = None
    ) -> Manifest:
        """Name these tables, and only these, in a new manifest.

        ``after`` is the number of the manifest that the load went on from (0: none); by
        default the newest one there is.
        """
        if after is None:
            after = max(self.numbers(), default=0)
        content = {
            "properties": dict(properties),
            "tables": {
                name: {"path": self._relative(t.path), "schema": json.loads(t.schema), "listed": t.listed}
                for name, t in sorted(tables.items())
            },
        }
        draft, final = self._path(f"_draft-{uuid.uuid4().hex}"), self._path(self._name(after + 1))
        system = draft.getFileSystem(self._conf)
        stream = system.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content, indent=1).encode()))
        finally:
            stream.close()
        if not self._rename_to_new(draft, final):
            system.delete(draft, False)
            raise CommitConflictError(f"{final.toString()} is there already: another load has committed")
        return Manifest(after + 1, dict(properties), dict(tables))

    def _rename_to_new(self, draft, final) -> bool:
        """Rename unless the target exists; whether it was done."""
        jvm = self.spark._jvm
        option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        nothing_replaced = self.spark.sparkContext._gateway.new_array(option, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        try:
            context.rename(draft, final, nothing_replaced)
        except Exception as refused:
            if "FileAlreadyExistsException" in str(refused):
                return False
            raise
        return True

    def _relative(self, path: str) -> str:
        """Paths below the home are kept without it, so that a home can be copied elsewhere."""
        marker = f"{self.home}/"
        at = path.find(marker)
        return path[at + len(marker) :] if at >= 0 else path

    def _absolute(self, path: str) -> str:
        return path if path.startswith("/") or ":/" in path else f"{self.home}/{path}"

    def named_folders(self) -> set[str]:
        """Folders that any manifest names, by itself or by a file of one of its lists."""
        named: set[str] = set()
        for number in self.numbers():
            for table in self.read(number).tables.values():
                named.add(table.path)
                if table.listed:
                    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
                    named |= {r.folder for r in self.spark.read.parquet(table.path).select(folder).distinct().collect()}
        return named
