"""Publish jobs: the gold tables of one state of the landing files.

``Warehouse`` is what queries read. ``publish_warehouse`` loads a warehouse that stays: it
builds, guards and writes all gold tables below a named home and then commits them all at
once by a manifest. ``open_published`` opens what was committed of a landing folder, and
``open_snapshot`` the newest load that was committed, whatever a load is writing meanwhile;
neither builds anything. ``open_warehouse`` gives an application a warehouse of its own,
whose gold tables are written the first time they are asked for.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import columns as c
from starloom.operators.calendar import calendar_bounds, calendar_days, date_range, with_calendar_attributes
from starloom.operators.joins import Guarded, guarded_left_join, join_guard, require_parents, safe_left_join
from starloom.operators.layout import TARGET_FILE_BYTES, compact
from starloom.sources import landing as bind
from starloom.sources.footers import from_footers
from starloom.sources.landing import (
    DATE_COLUMNS,
    ENTITIES,
    LANDING_TABLES,
    ConformedLanding,
    Landing,
)
from starloom.sources.manifest import Manifest, Manifests
from starloom.sources.store import (
    StoredTable,
    TableStore,
    folder_state,
    shared_folder,
    side_by_side,
    size_shuffles,
)

# Published tables and the entities they come from.
DIMENSIONS = {
    "dim_customer": "customer",
    "dim_product": "product",
    "dim_supplier": "supplier",
    "dim_facility": "facility",
    "dim_employee": "employee",
    "dim_technician": "technician",
    "dim_asset": "asset",
    "dim_sales_channel": "sales_channel",
}
FACTS = {
    "fact_sales_order": "sales_order",
    "fact_sales_order_line": "sales_order_line",
    "bridge_supplier_product": "supplier_product",
    "fact_purchase_order_line": "purchase_order_line",
    "fact_shipment": "shipment",
    "fact_inventory_snapshot": "inventory_snapshot",
    "fact_work_order": "work_order",
    "fact_work_order_part": "work_order_part",
    "fact_asset_daily_status": "asset_daily_status",
}
GOLD_ENTITIES = {**DIMENSIONS, **FACTS}
GOLD_TABLES = (*GOLD_ENTITIES, "dim_date")

# Gold facts that take keys of a parent: key, gold parent, parent columns (new name → old).
ORDER_KEYS = {
    name: name
    for name in ("customer_key", "sales_channel_key", "order_date_key", "requested_date_key")
}
ASSET_KEYS = {name: name for name in ("customer_key", "facility_key", "product_key")}
WORK_ORDER_KEYS = {
    "asset_key": "asset_key",
    "technician_key": "technician_key",
    "opened_date_key": "opened_date_key",
    "resolved_date_key": "resolved_date_key",
    "customer_key": "customer_key",
    "facility_key": "facility_key",
    "asset_product_key": "product_key",
}
PARENT_KEYS = {
    "fact_sales_order_line": ("sales_order_key", "fact_sales_order", ORDER_KEYS),
    "fact_shipment": ("sales_order_key", "fact_sales_order", ORDER_KEYS),
    "fact_inventory_snapshot": (
        "product_key", "dim_product", {"standard_cost": "standard_cost"},
    ),
    "fact_work_order": ("asset_key", "dim_asset", ASSET_KEYS),
    "fact_work_order_part": ("work_order_key", "fact_work_order", WORK_ORDER_KEYS),
    "fact_asset_daily_status": ("asset_key", "dim_asset", ASSET_KEYS),
}
# Amounts computed while publishing: table → (new column, quantity, unit amount).
EXTENDED_AMOUNTS = {
    "fact_purchase_order_line": ("purchased_value", "ordered_quantity", "unit_cost"),
    "fact_inventory_snapshot": ("inventory_value", "quantity_on_hand", "standard_cost"),
}


Tables = Callable[[str], DataFrame]


def parent_keys(name: str, gold: Tables) -> DataFrame:
    """The parent's join key and the columns that gold table ``name`` takes from it."""
    key, parent, wanted = PARENT_KEYS[name]
    return gold(parent).select(key, *(F.col(old).alias(new) for new, old in wanted.items()))


def publish(name: str, entity: DataFrame, gold: Tables) -> DataFrame:
    """Gold table ``name`` from its conformed entity and other gold tables, guarded before it is read."""
    if name in PARENT_KEYS:
        key, parent, _ = PARENT_KEYS[name]
        entity = safe_left_join(entity, parent_keys(name, gold), key, f"{name} to {parent}")
    return _with_amounts(name, entity)


def publish_guarded(name: str, entity: DataFrame, gold: Tables) -> Guarded:
    """The same, guarded while it is written: the entity is read and shuffled once."""
    if name not in PARENT_KEYS:
        return Guarded(_with_amounts(name, entity), lambda: None)
    key, parent, _ = PARENT_KEYS[name]
    joined = guarded_left_join(entity, parent_keys(name, gold), key, f"{name} to {parent}")
    return joined._replace(rows=_with_amounts(name, joined.rows))


def publish_lines(name: str, sources: ConformedLanding, lines: DataFrame, gold: Tables) -> Guarded:
    """The same for a fact of ``bind.LINE_FACTS``: its parent is joined to the bare lines.

    Keys as text, dates, statuses and amounts are made of the joined rows, so that the shuffle
    carries only the numbers of a line that they are made of.
    """
    key, parent, wanted = PARENT_KEYS[name]
    entity = GOLD_ENTITIES[name]
    taken, line_column = bind.LINE_FACTS[entity]
    carried = {f"parent_{new}": new for new in wanted}
    parents = parent_keys(name, gold).withColumnsRenamed({new: old for old, new in carried.items()})
    bare = lines.where(taken).drop("line_key").withColumnRenamed(line_column, key)
    joined = guarded_left_join(bare, parents, key, f"{name} to {parent}")
    whole = joined.rows.withColumnRenamed(key, line_column).withColumn("line_key", bind.line_key())
    build, _, _ = ENTITIES[entity]
    own = build(sources, lines).columns
    rows = build(sources, whole, list(carried)).select(*own, *(F.col(old).alias(new) for old, new in carried.items()))
    return joined._replace(rows=_with_amounts(name, rows))


def _with_amounts(name: str, published: DataFrame) -> DataFrame:
    """The amounts and text ids of a gold table."""
    if name in EXTENDED_AMOUNTS:
        amount, quantity, unit = EXTENDED_AMOUNTS[name]
        published = published.withColumn(amount, c.extended(quantity, unit))
    return bind.with_text_ids(published, GOLD_ENTITIES[name])


def calendar_ranges(entities: Tables, names: Iterable[str] = DATE_COLUMNS) -> list[DataFrame]:
    """First and last date of every entity that carries dates, or of those named."""
    return [date_range(entities(name), DATE_COLUMNS[name], name) for name in names]


class NotPublishedError(LookupError):
    """A published warehouse lacks a table."""


class Warehouse:
    """Gold tables over one landing folder.

    Each is published on first use, by itself and its parents; a ``published`` warehouse only
    reads, and refuses a table that it does not have.
    """

    def __init__(
        self, spark: SparkSession, landing: Landing, store: TableStore, published: bool = False
    ):
        self.spark = spark
        self.published = published
        self.landing = landing
        self.store = store
        self.sources = ConformedLanding(landing, store)

    def line(self) -> DataFrame:
        """The conformed order line that most entities are bound to."""
        if self.published and "silver.line" not in self.store:
            raise NotPublishedError(f"silver.line is not in {self.store.folder}: publish it first")
        return self.store.get("silver.line", lambda: bind.line(self.sources, self._stored_bare()))

    def bare_line(self) -> DataFrame:
        """Lines with their own columns: the conformed ones, if they are stored, or else read without any lookup.

        These are stored only if keys repeat, so that rows are chosen once.
        """
        if "silver.line" in self.store:
            return self.line()
        bare = bind.bare_line(self.sources)
        if self.store.read("work.lineitem_repeated_keys").isEmpty():
            return bare
        return self.store.get("work.bare_line", lambda: bare)

    def _stored_bare(self) -> DataFrame | None:
        return self.store.read("work.bare_line") if "work.bare_line" in self.store else None

    def entity(self, name: str) -> DataFrame:
        """A bound entity before publishing. Its columns are computed when read."""
        return bind.with_text_ids(self._bound(name), name)

    def _bound(self, name: str, lines: Callable[[], DataFrame] | None = None) -> DataFrame:
        build, _, _ = ENTITIES[name]
        return build(self.sources, (lines or self.line)())

    def table(self, name: str) -> DataFrame:
        """A gold table, published by itself. The calendar covers all dates there are: see ``calendar_bounds``."""
        if f"gold.{name}" in self.store:
            return self.store.read(f"gold.{name}")
        if self.published:
            raise NotPublishedError(f"gold.{name} is not in {self.store.folder}: publish it first")
        return self.store.get(f"gold.{name}", lambda: self._build(name))

    def _build(self, name: str) -> DataFrame | Guarded:
        if name == "dim_date":
            return with_calendar_attributes(calendar_days(self.calendar_bounds()))
        if GOLD_ENTITIES[name] in bind.LINE_FACTS:
            return publish_lines(name, self.sources, self.line(), self.table)
        return publish_guarded(name, self._bound(GOLD_ENTITIES[name]), self.table)

    def publish_bare(self, names: Iterable[str]) -> bool:
        """Publish tables for a question that needs no others, without lines joined to their lookups.

        Does so only if the entities of all of them take a line's own columns alone, and says whether.
        """
        names = list(names)
        if self.published or not all(GOLD_ENTITIES.get(name) in bind.BARE_ENTITIES for name in names):
            return False

        def publish_one(name: str) -> None:
            entity = GOLD_ENTITIES[name]
            build = lambda: publish_guarded(name, self._bound(entity, self.bare_line), self.table)
            self.store.get(f"gold.{name}", build)

        side_by_side(publish_one, names)
        return True

    def publish_tables(self, names: Iterable[str]) -> None:
        """Publish these tables, as many at a time as the cluster has room for."""
        missing = [name for name in names if f"gold.{name}" not in self.store]
        if missing:
            side_by_side(self.table, missing, self.landing.jobs_at_once())

    def publish_all(self) -> None:
        """Publish every gold table; jobs of independent tables share the cluster."""
        side_by_side(self.sources, LANDING_TABLES)
        self.line()
        self.publish_tables(GOLD_ENTITIES)
        self.store.get("gold.dim_date", lambda: self._build("dim_date"))

    def published_tables(self) -> dict[str, StoredTable]:
        """Stored versions of all gold tables and of the lines, without intermediate tables."""
        layers = ("gold.", "silver.")
        return {name: t for name, t in self.store.snapshot().items() if name.startswith(layers)}

    def sibling_store(self, name: str) -> TableStore:
        """A store beside this one, for jobs that must not touch the published tables."""
        return TableStore(self.spark, f"{self.store.folder}-{name}")

    def calendar_bounds(self) -> DataFrame:
        """First and last day of the calendar, over the dates of all gold tables, published yet or not.

        Published ones are asked by their footers. Of others the dates alone are read from their
        bound entities, which have the rows that will be published, so none is written for it; their
        publishing joins are guarded as if they were.
        """
        published = {entity: gold for gold, entity in GOLD_ENTITIES.items()}
        stored = [entity for entity in DATE_COLUMNS if f"gold.{published[entity]}" in self.store]
        unpublished = [entity for entity in DATE_COLUMNS if entity not in stored]
        if self.published and unpublished:
            self.table(published[unpublished[0]])
        this_year = self.landing.this_year

        def ask(opened: Tables) -> tuple[date, date]:
            ranges = calendar_ranges(lambda entity: opened(f"gold.{published[entity]}"), stored)
            return tuple(calendar_bounds(ranges, this_year).first())

        bounds = [from_footers(self.store, ask)] if stored else []
        if unpublished:
            self.require_guards()
            bounds.append(tuple(calendar_bounds(calendar_ranges(self._bound, unpublished), this_year).first()))
        start, end = min(first for first, _ in bounds), max(last for _, last in bounds)
        return self.spark.range(0, 1, 1, 1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))

    def require_guards(self) -> None:
        """Guard the publishing joins of tables that are not published yet, by their keys alone."""

        def keys(name: str, key: str) -> DataFrame:
            stored = f"gold.{name}" in self.store
            return (self.store.read(f"gold.{name}") if stored else self._bound(GOLD_ENTITIES[name])).select(key)

        def guard(name: str) -> None:
            key, parent, _ = PARENT_KEYS[name]
            require_parents(keys(name, key), keys(parent, key), key, f"{name} to {parent}")

        side_by_side(guard, [name for name in PARENT_KEYS if f"gold.{name}" not in self.store])

    def join_guards(self) -> DataFrame:
        """What the guards of the six publishing joins count, one row each."""
        rows = []
        for name, (key, parent, _) in PARENT_KEYS.items():
            guard = join_guard(
                self.entity(GOLD_ENTITIES[name]), parent_keys(name, self.table), key
            )
            rows.append(guard.select(F.lit(f"{name} to {parent}").alias("relationship"), "*"))
        return reduce(DataFrame.unionByName, rows)


_OPEN: dict[tuple[str, str], Warehouse] = {}
_OPEN_LOCK = threading.Lock()


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of this application for the landing folder as it is now.

    Files that changed since give a new fingerprint and so a new warehouse.
    """
    landing = Landing(spark, folder)
    state = folder_state(spark, *(landing.path(t) for t in LANDING_TABLES))
    root = f"{shared_folder(spark)}/starloom/{spark.conf.get('spark.app.id')}"
    with _OPEN_LOCK:
        place = (root, f"{landing.folder}@{state.name}")
        if place not in _OPEN:
            size_shuffles(spark, state.bytes)
            store = TableStore(spark, f"{root}/warehouse-{len(_OPEN)}-{state.name}")
            _OPEN[place] = Warehouse(spark, landing, store)
        return _OPEN[place]


def publish_warehouse(
    spark: SparkSession, folder: str, home: str, as_of: str = bind.AS_OF, this_year: int = bind.THIS_YEAR
) -> Warehouse:
    """Publish all tables of the landing folder as it is now below ``home``, to stay there.

    Readers see them when the last one is written and the manifest names all of them. A load
    that was broken off goes on with the tables it lacks; one that is committed already does
    nothing. Statuses and the calendar are those of ``as_of`` and ``this_year``.
    """
    landing = Landing(spark, folder, as_of, this_year)
    state, size = _state(spark, landing, as_of, this_year)
    size_shuffles(spark, size)
    manifests = Manifests(spark, home)
    before = max(manifests.numbers(), default=0)
    done = manifests.latest(state=state)
    store = TableStore(spark, f"{manifests.home}/{state}", reopen=done is None, at=done and done.tables)
    warehouse = Warehouse(spark, landing, store)
    if done is None:
        warehouse.publish_all()
        properties = {"state": state, "landing": landing.folder, "as_of": as_of, "this_year": str(this_year)}
        manifests.commit(warehouse.published_tables(), properties, after=before)
    return warehouse


def open_published(
    spark: SparkSession, folder: str, home: str, as_of: str = bind.AS_OF, this_year: int = bind.THIS_YEAR
) -> Warehouse:
    """What ``publish_warehouse`` has published of the landing folder as it is now; never builds."""
    landing = Landing(spark, folder, as_of, this_year)
    state, _ = _state(spark, landing, as_of, this_year)
    found = Manifests(spark, home).latest(state=state)
    store = TableStore(spark, f"{home.rstrip('/')}/{state}", at=found and found.tables)
    return Warehouse(spark, landing, store, published=True)


def open_snapshot(spark: SparkSession, home: str, number: int | None = None) -> Warehouse:
    """The newest committed load below ``home``, or that of a manifest's number; never builds.

    The landing folder is not looked at. Loads that commit later are not seen.
    """
    manifests = Manifests(spark, home)
    found = manifests.latest() if number is None else manifests.read(number)
    if found is None:
        raise NotPublishedError(f"nothing is committed below {home}")
    made = found.properties
    landing = Landing(spark, made["landing"], made["as_of"], int(made["this_year"]))
    store = TableStore(spark, f"{manifests.home}/{made['state']}", at=found.tables)
    return Warehouse(spark, landing, store, published=True)


def compact_published(
    spark: SparkSession, home: str, tables: Iterable[str], file_bytes: int = TARGET_FILE_BYTES
) -> Manifest:
    """Merge small files of published gold tables and commit them as the newest manifest.

    Files of the target's size stay in place; readers of earlier manifests notice nothing.
    A load or compaction that commits meanwhile wins, and this one raises.
    """
    manifests = Manifests(spark, home)
    found = manifests.latest()
    if found is None:
        raise NotPublishedError(f"nothing is committed below {home}")
    store = TableStore(spark, f"{manifests.home}/{found.properties['state']}", at=found.tables)
    side_by_side(lambda name: compact(store, f"gold.{name}", file_bytes=file_bytes), list(tables))
    return manifests.commit(store.snapshot(), found.properties, after=found.number)


def _state(spark: SparkSession, landing: Landing, as_of: str, this_year: int) -> tuple[str, int]:
    """A name for one state of a landing folder and the dates it is judged on, and its size."""
    state = folder_state(spark, *(landing.path(t) for t in LANDING_TABLES))
    return f"{state.name}-{as_of}-{this_year}", state.bytes
