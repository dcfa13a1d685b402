"""Answers from Parquet footers: counts, least and greatest values without reading a column.

Spark's newer Parquet reader answers ``count``, ``min`` and ``max`` of a whole table from the
statistics in file footers. It is a setting of a session, so these tables are opened in a
session of their own, and only small results leave it. Files whose footers lack a value (a
column without any in a row group) can't be asked in this way; then the columns are read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom.sources.store import TableStore

T = TypeVar("T")
SOURCES = "spark.sql.sources.useV1SourceList"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers aggregates of whole Parquet tables from footers."""
    session = spark.newSession()
    others = [s for s in spark.conf.get(SOURCES).split(",") if s.strip() and s.strip() != "parquet"]
    session.conf.set(SOURCES, ",".join(others))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def opened_for_footers(session: SparkSession, store: TableStore, name: str) -> DataFrame:
    """A stored table in such a session."""
    rows, paths = store.read(name), store.paths(name)
    if not paths:
        return session.createDataFrame([], rows.schema)
    return session.read.schema(StructType.fromJson(rows.schema.jsonValue())).parquet(*paths)


def from_footers(
    store: TableStore, ask: Callable[[Callable[[str], DataFrame]], T]
) -> T:
    """``ask`` given a way to open stored tables for footers; given plain ones if footers lack a value.

    ``ask`` must return values, not a DataFrame.
    """
    session = footer_session(store.spark)
    try:
        return ask(lambda name: opened_for_footers(session, store, name))
    except (PySparkException, Py4JJavaError) as refused:
        if "No min/max found" not in str(refused):
            raise
        return ask(store.read)
