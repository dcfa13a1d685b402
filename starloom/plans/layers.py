"""The layered load: raw tables as they come, conformed ones, and gold, with all rejects kept.

Landing tables are copied as they are (``raw``), each row with its load and source file.
Screening parts them into ``conformed`` rows and the ``quarantine`` of rows with a null key, a
repeated key or an unknown code. Entities are bound to the conformed rows (``bronze``),
screened by their own keys (``silver``) and published (``gold``). At every step
raw = kept + rejected must hold, or the load stops.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.calendar import date_dimension
from starloom.operators.conform import (
    COPIES,
    NULL_KEY,
    REASON,
    REPEATED_KEY,
    UNBOUND_CODE,
    conform,
    require_unique,
    screen,
)
from starloom.operators.joins import Guarded
from starloom.plans.publish import GOLD_ENTITIES, GOLD_TABLES, Tables, calendar_ranges, publish_guarded
from starloom.sources import landing as bind
from starloom.sources.landing import ENTITIES, LANDING_KEYS, LANDING_TABLES, Landing, StoredSources, bound_codes
from starloom.sources.store import LINEAGE_COLUMNS, SOURCE_FILE, TableStore, jobs_at_once, side_by_side, stamp_lineage

#: Where rejected rows of a landing table and of an entity are.
LANDING_REJECTS, ENTITY_REJECTS = "quarantine.landing_{}", "quarantine.{}"


class ReconciliationError(ValueError):
    """Rows of a raw table are neither kept nor rejected, or are both."""


def _manifest_row(store: TableStore, name: str, rows: DataFrame) -> DataFrame:
    stored = store.write(name, rows)
    counted = stored.groupBy("source_system", "pipeline_run_id").agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(name).alias("table_name"), "*")


def load_raw(landing: Landing, store: TableStore, run_id: str, loaded_at: datetime) -> DataFrame:
    """Copy every landing table as it comes, with lineage and source file; returns rows stored."""

    def load(table: str) -> DataFrame:
        rows = landing(table).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        return _manifest_row(store, f"raw.{table}", stamp_lineage(rows, f"landing.{table}", run_id, loaded_at))

    return reduce(DataFrame.unionByName, side_by_side(load, LANDING_TABLES))


def _screened(
    store: TableStore, raw: str, kept: str, rejects: str, keys: list[str], codes: dict | None = None
) -> DataFrame:
    """Part a raw table; one row of what became of its rows.

    If all of them are kept, the raw table's files become the kept table: none is written again.
    """
    rows = store.read(raw)
    work = kept.replace(".", "_")
    place = [name for name in (SOURCE_FILE, *LINEAGE_COLUMNS) if name in rows.columns]
    found = screen(rows, keys, codes or {}, lambda name, df: store.write_work(f"{work}_{name}", df), place)
    rejected = store.write(rejects, found.rejected)

    def lost(reason: str) -> Column:
        copies = F.sum(F.when(F.col(REASON).startswith(reason), F.col(COPIES)))
        return F.coalesce(copies, F.lit(0)).cast("bigint")

    told = rejected.agg(
        lost(NULL_KEY).alias("null_keys"),
        lost(UNBOUND_CODE).alias("unbound_codes"),
        lost(REPEATED_KEY).alias("repeated_rows"),
    ).first()
    clean = store.write(kept, found.kept) if sum(told) else found.kept
    raw_rows, kept_rows = rows.count(), clean.count()
    if raw_rows != kept_rows + sum(told):
        raise ReconciliationError(f"{raw}: {raw_rows} rows became {kept_rows} kept and {sum(told)} rejected")
    if not sum(told):
        store.adopt(kept, store.stored(raw))
    store.drop_work(f"{work}_repeated_keys", f"{work}_rivals")
    row = {"table_name": kept, "raw_rows": raw_rows, **told.asDict(), "conformed_rows": kept_rows}
    return store.spark.range(0, 1, 1, 1).select(
        *(F.lit(v).cast("string" if n == "table_name" else "bigint").alias(n) for n, v in row.items())
    )


def screen_sources(store: TableStore) -> DataFrame:
    """Part every raw landing table into conformed and rejected rows; returns the reconciliation."""

    def load(table: str) -> DataFrame:
        rejects = LANDING_REJECTS.format(table)
        return _screened(store, f"raw.{table}", f"conformed.{table}", rejects, LANDING_KEYS[table], bound_codes(table))

    return reduce(DataFrame.unionByName, side_by_side(load, LANDING_TABLES))


def load_bronze(landing: Landing, store: TableStore, run_id: str, loaded_at: datetime) -> DataFrame:
    """Raw landing tables, every entity bound to their conformed rows, and the calendar, with lineage.

    Returns the manifest: table, source system, run and rows stored.
    """
    raw = load_raw(landing, store, run_id, loaded_at)
    store.write("work.sources", screen_sources(store))
    sources = StoredSources(store, landing.as_of)
    lines = store.write("work.line", bind.line(sources))

    def load(name: str) -> DataFrame:
        build, _, source = ENTITIES[name]
        rows = bind.with_text_ids(build(sources, lines), name)
        return _manifest_row(store, f"bronze.{name}_raw", stamp_lineage(rows, f"landing.{source}", run_id, loaded_at))

    stored = side_by_side(load, ENTITIES, landing.jobs_at_once())
    store.drop_work("line")
    days = date_dimension(calendar_ranges(lambda entity: store.read(f"bronze.{entity}_raw")), landing.this_year)
    stored.append(_manifest_row(store, "bronze.date_raw", stamp_lineage(days, "landing.calendar", run_id, loaded_at)))
    return reduce(DataFrame.unionByName, stored, raw)


def load_silver(store: TableStore) -> DataFrame:
    """Screen every bronze table on its key, write it and its rejects, and verify the key.

    Returns what became of the rows of all landing tables and all entities.
    """
    keys = {name: key for name, (_, key, _) in ENTITIES.items()} | {"date": "date_key"}

    def load(name: str) -> DataFrame:
        told = _screened(store, f"bronze.{name}_raw", f"silver.{name}", ENTITY_REJECTS.format(name), [keys[name]])
        require_unique(store.read(f"silver.{name}"), [keys[name]], f"silver.{name}")
        return told

    at_once = jobs_at_once(store.spark, sum(store.size_in_bytes(f"bronze.{name}_raw") for name in keys))
    return reduce(DataFrame.unionByName, side_by_side(load, keys, at_once), store.read("work.sources"))


def load_gold(store: TableStore) -> DataFrame:
    """Publish the gold tables from the silver ones of the same store; returns rows per table."""

    def gold(name: str) -> DataFrame:
        return store.get(f"gold.{name}", lambda: build(name))

    def build(name: str) -> DataFrame | Guarded:
        if name == "dim_date":
            clean = store.read("silver.date").drop(*LINEAGE_COLUMNS)
            return require_unique(clean, ["date_key"], "gold.dim_date")
        entity = GOLD_ENTITIES[name]
        ids = bind.TEXT_IDS.get(entity, {})  # made again of their keys after the join
        return publish_guarded(name, store.read(f"silver.{entity}").drop(*LINEAGE_COLUMNS, *ids), gold)

    counts = [
        gold(name).agg(F.lit(f"gold.{name}").alias("table_name"), F.count("*").alias("row_count"))
        for name in GOLD_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def rejected_rows(store: TableStore, tables: Iterable[str] = LANDING_TABLES) -> DataFrame:
    """How many rows of each landing table and source file were rejected, and why."""
    file = F.element_at(F.split(SOURCE_FILE, "/"), -1)
    counts = [
        store.read(LANDING_REJECTS.format(table))
        .groupBy(F.lit(table).alias("table_name"), file.alias(SOURCE_FILE), REASON)
        .agg(F.sum(COPIES).cast("bigint").alias("row_count"))
        for table in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def refresh_calendar(
    entities: Tables, store: TableStore, this_year: int, run_id: str, loaded_at: datetime
) -> DataFrame:
    """Rebuild only the calendar: raw, conformed and published; returns the published table."""
    days = date_dimension(calendar_ranges(entities), this_year)
    raw = store.write("bronze.date_raw", stamp_lineage(days, "calendar", run_id, loaded_at))
    clean = store.write("silver.date", conform(raw, ["date_key"]))
    require_unique(clean, ["date_key"], "silver.date")
    published = store.write("gold.dim_date", clean.drop(*LINEAGE_COLUMNS))
    return require_unique(published, ["date_key"], "gold.dim_date")
