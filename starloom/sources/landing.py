"""Binding of the landing tables to the entities of the star.

Each function returns one entity, not yet enriched with keys of its parents.
The business meaning of the binding is ours (FIXTURES.md, section 2); the column
rules it applies are those of ``starloom.functions.columns``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import columns as c
from starloom.operators.conform import conform, has_key
from starloom.operators.joins import broadcast_if_few
from starloom.sources.store import (
    LINEAGE_COLUMNS,
    SOURCE_FILE,
    TableStore,
    folder_state,
    jobs_at_once,
    literal_rows,
)

LANDING_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

LANDING_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
}

# Fixed values of the binding; the two dates are defaults that a warehouse may replace.
AS_OF = "2001-08-01"
THIS_YEAR = 2024
DIM_ID_WIDTH = 12
ROW_ID_WIDTH = 16
LABOR_RATE = 65
ASSET_TYPES = ("Machine", "Vehicle")
FACILITY_TYPES = ("Factory", "Depot", "Workshop")
JOB_LEVELS = ("Junior", "Experienced", "Principal")
SKILL_LEVELS = ("Basic", "Skilled", "Expert")
SPECIALTIES = ("Power", "Motion", "Fluids", "Software")
WORK_ORDER_TYPES = ("Planned", "Repair", "Survey", "Setup")
SALES_CHANNELS = (
    (1, "Urgent", "Priority"),
    (2, "High", "Priority"),
    (3, "Medium", "Standard"),
    (4, "Not Specified", "Standard"),
    (5, "Low", "Standard"),
)


# The codes that the binding gives a meaning to; rows with others are rejected.
BOUND_CODES = {
    "orders": {"o_orderstatus": ("F", "O", "P")},
    "lineitem": {"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")},
}


def bound_codes(table: str) -> dict[str, Column]:
    """Whether the codes of a landing table are bound, by column."""
    known = {name: F.col(name).isin(*codes) for name, codes in BOUND_CODES.get(table, {}).items()}
    if table == "orders":
        known["o_orderpriority"] = channel_key("o_orderpriority").isin(*(row[0] for row in SALES_CHANNELS))
    return known


class Landing:
    """The source files of one folder, and the day that its statuses are judged on."""

    def __init__(
        self, spark: SparkSession, folder: str, as_of: str = AS_OF, this_year: int = THIS_YEAR
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = F.lit(as_of).cast("date")
        self.this_year = this_year
        self._tables: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __call__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self.spark.read.parquet(self.path(table))
        return self._tables[table]

    def jobs_at_once(self) -> int:
        """How many jobs that make tables of these files run at a time."""
        return jobs_at_once(self.spark, folder_state(self.spark, *map(self.path, LANDING_TABLES)).bytes)


class ConformedLanding:
    """Landing tables with complete, unique keys and known codes, as the entities are bound to them.

    A table is rewritten only if a key repeats, which its key columns alone can tell;
    otherwise a filter is all there is to do. Lines are read once, where they are bound
    (``line``), so they are not written before.
    """

    def __init__(self, landing: Landing, store: TableStore):
        self.spark = landing.spark
        self.landing = landing
        self.as_of = landing.as_of
        self.store = store
        self._tables: dict[str, DataFrame] = {}
        self._locks = {table: threading.Lock() for table in LANDING_TABLES}

    def __call__(self, table: str) -> DataFrame:
        with self._locks[table]:
            if table not in self._tables:
                self._tables[table] = self._conform(table)
            return self._tables[table]

    def _conform(self, table: str) -> DataFrame:
        clean = conform(
            self.landing(table),
            LANDING_KEYS[table],
            bound_codes(table),
            lambda name, df: self.store.get(f"work.{table}_{name}", lambda: df),
        )
        if table == "lineitem" or self.store.read(f"work.{table}_repeated_keys").isEmpty():
            return clean
        return self.store.get(f"conformed.{table}", lambda: clean)


class StoredSources:
    """Landing tables as an earlier load conformed them in a store."""

    def __init__(self, store: TableStore, as_of: Column):
        self.spark = store.spark
        self.store = store
        self.as_of = as_of

    def __call__(self, table: str) -> DataFrame:
        return self.store.read(f"conformed.{table}").drop(*LINEAGE_COLUMNS, SOURCE_FILE)


Tables = Landing | ConformedLanding | StoredSources


def day(name: str) -> Column:
    return F.col(name).cast("date")


def dim_id(prefix: str, key: str) -> Column:
    return c.business_id(prefix, key, DIM_ID_WIDTH)


def row_id(prefix: str, key: str) -> Column:
    return c.business_id(prefix, key, ROW_ID_WIDTH)


def with_date_keys(df: DataFrame, *dates: str) -> DataFrame:
    """Add a ``<date>_key`` for each date (``contract_start_date`` → ``contract_start_date_key``)."""
    return df.withColumns({f"{name}_key": c.date_key(name) for name in dates})


def criticality(order_priority: str) -> Column:
    """Urgent to Critical, high to High, medium to Medium, all others Low."""
    rank = channel_key(order_priority)
    return F.coalesce(c.code_lookup(rank - 1, ("Critical", "High", "Medium")), F.lit("Low"))


def channel_key(order_priority: str) -> Column:
    """The number that the priority's text starts with."""
    return c.leading_number(order_priority)


def places(landing: Tables) -> DataFrame:
    """Nation with its region."""
    region = landing("region").select("r_regionkey", F.col("r_name").alias("region_code"))
    nation = landing("nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", F.col("n_name").alias("country_code"), "region_code"
    )


# -- the conformed line ------------------------------------------------------


def conformed_lineitem(landing: Landing, store: TableStore) -> DataFrame:
    """Order lines of the landing folder, one per order and line number."""
    return ConformedLanding(landing, store)("lineitem")


def bare_line(landing: Tables) -> DataFrame:
    """Order lines with their own columns alone."""
    return landing("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast(c.QUANTITY).alias("quantity"),
        c.money("l_extendedprice").alias("extended_price"),
        c.fraction("l_discount").alias("discount"),
        c.fraction("l_tax").alias("tax"),
        "l_returnflag",
        "l_linestatus",
        day("l_shipdate").alias("ship_date"),
    )


def line(landing: Tables, bare: DataFrame | None = None) -> DataFrame:
    """Order lines, read or given as ``bare`` ones, with the few parent columns that every fact takes.

    Stored once: the lookups are joined here a single time instead of once per
    fact, and all facts become scans of this table. Amounts and dates take their types before
    the joins: decimals and days are short numbers, which a shuffle packs better than doubles and times.
    """
    li = bare_line(landing) if bare is None else bare
    orders = landing("orders").select(
        "o_orderkey", day("o_orderdate").alias("order_date"), criticality("o_orderpriority").alias("priority")
    )
    part = landing("part").select(
        "p_partkey",
        c.money("p_retailprice").alias("standard_cost"),
        F.col("p_size").alias("part_size"),
        F.lit(True).alias("is_priced"),
    )
    supplier = broadcast_if_few(
        landing("supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("facility_key"))
    )
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
        .join(part, li.l_partkey == part.p_partkey, "left")
        .join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
        .select(
            line_key().alias("line_key"),
            *li.columns,
            "order_date",
            "priority",
            "standard_cost",
            "part_size",
            F.coalesce("is_priced", F.lit(False)).alias("is_priced"),
            "facility_key",
        )
    )


def line_key() -> Column:
    """The key of a line, as text; left until after a join, as its two numbers travel lighter."""
    return c.pair_key("l_orderkey", "l_linenumber")


def shipped_between(lines: DataFrame, key: str) -> DataFrame:
    """First and last ship date per ``key``."""
    return lines.groupBy(F.col(key).alias("seen_key")).agg(
        F.min("ship_date").alias("created_on"), F.max("ship_date").alias("modified_on")
    )


# -- dimensions --------------------------------------------------------------


def facility(landing: Tables, lines: DataFrame) -> DataFrame:
    supplier = landing("supplier").select("s_suppkey", "s_nationkey")
    seen = shipped_between(lines, "l_suppkey")
    active = (
        supplier.join(seen, supplier.s_suppkey == seen.seen_key)
        .groupBy("s_nationkey")
        .agg(F.min("created_on").alias("created_on"), F.max("modified_on").alias("modified_on"))
    )
    nation = places(landing)
    key = F.col("n_nationkey").cast("bigint")
    return with_date_keys(
        nation.join(active, nation.n_nationkey == active.s_nationkey, "left").select(
            key.alias("facility_key"),
            dim_id("FAC", "n_nationkey").alias("facility_id"),
            F.col("country_code").alias("facility_name"),
            c.code_lookup(F.pmod(key, F.lit(3)), FACILITY_TYPES).alias("facility_type"),
            "region_code",
            "country_code",
            F.col("country_code").alias("city"),
            (1000 + 100 * key).alias("capacity_units"),
            F.lit("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "created_on",
        "modified_on",
    )


def customer(landing: Tables, lines: DataFrame) -> DataFrame:
    ordered = landing("orders").groupBy("o_custkey").agg(
        F.min(day("o_orderdate")).alias("created_on"), F.max(day("o_orderdate")).alias("modified_on")
    )
    base, nation = landing("customer"), places(landing)
    balance = c.money("c_acctbal")
    return with_date_keys(
        base.join(nation, base.c_nationkey == nation.n_nationkey, "left")
        .join(ordered, base.c_custkey == ordered.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("customer_key"),
            dim_id("CUS", "c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("c_mktsegment").alias("industry"),
            "region_code",
            "country_code",
            F.col("country_code").alias("city"),
            balance.alias("annual_revenue"),
            c.banding(balance, ((2000, "High"), (5000, "Medium")), "Low").alias("risk_tier"),
            F.when(balance < 0, "Inactive").otherwise("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "created_on",
        "modified_on",
    )


def product(landing: Tables, lines: DataFrame) -> DataFrame:
    base, seen = landing("part"), shipped_between(lines, "l_partkey")
    cost = c.money("p_retailprice")
    return with_date_keys(
        base.join(seen, base.p_partkey == seen.seen_key, "left").select(
            F.col("p_partkey").alias("product_key"),
            dim_id("PRD", "p_partkey").alias("product_id"),
            dim_id("SKU-", "p_partkey").alias("sku"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("product_family"),
            F.col("p_name").alias("product_name"),
            cost.alias("standard_cost"),
            c.money(cost * F.lit("1.25").cast(c.FRACTION)).alias("list_price"),
            (F.col("p_size") + 5).alias("lead_time_days"),
            F.col("p_size").cast("decimal(12,2)").alias("weight_kg"),
            (F.col("p_size") >= 40).alias("critical_spare"),
            F.when(F.col("p_size") == 1, "Discontinued").otherwise("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "created_on",
        "modified_on",
    )


def supplier(landing: Tables, lines: DataFrame) -> DataFrame:
    base, nation, seen = landing("supplier"), places(landing), shipped_between(lines, "l_suppkey")
    balance = c.money("s_acctbal")
    tiers = ((2000, "Conditional"), (6000, "Approved"))
    return with_date_keys(
        base.join(nation, base.s_nationkey == nation.n_nationkey, "left")
        .join(seen, base.s_suppkey == seen.seen_key, "left")
        .select(
            F.col("s_suppkey").alias("supplier_key"),
            dim_id("SUP", "s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            "region_code",
            "country_code",
            c.banding(balance, tiers, "Preferred").alias("supplier_tier"),
            F.col("created_on").alias("contract_start_date"),
            F.when(balance < 0, "On Hold").otherwise("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "contract_start_date",
        "created_on",
        "modified_on",
    )


def employee(landing: Tables, lines: DataFrame) -> DataFrame:
    seen = landing("events").groupBy("user_id").agg(
        F.min(day("ts")).alias("created_on"), F.max(day("ts")).alias("modified_on")
    )
    person = landing("customer")
    key = F.col("c_custkey")
    return with_date_keys(
        person.join(seen, person.c_custkey == seen.user_id).select(
            key.alias("employee_key"),
            dim_id("EMP", "c_custkey").alias("employee_id"),
            F.col("c_name").alias("employee_name"),
            F.col("c_mktsegment").alias("department"),
            c.code_lookup(F.pmod(key, F.lit(3)), JOB_LEVELS).alias("job_level"),
            F.col("c_nationkey").cast("bigint").alias("facility_key"),
            dim_id("FAC", "c_nationkey").alias("facility_id"),
            F.col("created_on").alias("hire_date"),
            F.when(c.money("c_acctbal") < 0, "Leave").otherwise("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "hire_date",
        "created_on",
        "modified_on",
    )


def technician(landing: Tables, lines: DataFrame) -> DataFrame:
    base, seen = landing("supplier"), shipped_between(lines, "l_suppkey")
    key = F.col("s_suppkey")
    return with_date_keys(
        base.join(seen, base.s_suppkey == seen.seen_key, "left").select(
            key.alias("technician_key"),
            dim_id("TEC", "s_suppkey").alias("technician_id"),
            key.alias("employee_key"),
            dim_id("EMP", "s_suppkey").alias("employee_id"),
            F.col("s_nationkey").cast("bigint").alias("facility_key"),
            dim_id("FAC", "s_nationkey").alias("facility_id"),
            c.code_lookup(F.pmod(key, F.lit(3)), SKILL_LEVELS).alias("skill_level"),
            c.code_lookup(F.pmod(key, F.lit(4)), SPECIALTIES).alias("specialty"),
            c.warranty_expiry("created_on").alias("certification_expiry"),
            F.when(c.money("s_acctbal") < 0, "On Leave").otherwise("Active").alias("status"),
            "created_on",
            "modified_on",
        ),
        "certification_expiry",
        "created_on",
        "modified_on",
    )


def sales_channel(landing: Tables, lines: DataFrame) -> DataFrame:
    """The channels that orders use, with their names from a code table."""
    used = landing("orders").select(channel_key("o_orderpriority").alias("sales_channel_key"))
    names = ("channel_number", "sales_channel_name", "channel_group")
    labels = literal_rows(landing.spark, names, SALES_CHANNELS)
    codes = used.where(has_key(["sales_channel_key"])).distinct()
    named = F.col("sales_channel_key") == F.col("channel_number")
    return codes.join(F.broadcast(labels), named, "left").select(
        "sales_channel_key",
        c.business_id("CH", "sales_channel_key", 2).alias("sales_channel_id"),
        "sales_channel_name",
        "channel_group",
        F.lit("Active").alias("status"),
    )


def asset(landing: Tables, lines: DataFrame) -> DataFrame:
    content = lines.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("product_key"), F.max("ship_date").alias("last_ship_date")
    )
    owner = landing("customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("facility_key")
    )
    orders = landing("orders")
    key = F.col("o_orderkey")
    return with_date_keys(
        orders.join(content, orders.o_orderkey == content.l_orderkey, "left")
        .join(owner, orders.o_custkey == owner.c_custkey, "left")
        .select(
            key.alias("asset_key"),
            row_id("AST", "o_orderkey").alias("asset_id"),
            row_id("SN-", "o_orderkey").alias("serial_number"),
            F.col("o_custkey").alias("customer_key"),
            dim_id("CUS", "o_custkey").alias("customer_id"),
            "product_key",
            dim_id("PRD", "product_key").alias("product_id"),
            "facility_key",
            dim_id("FAC", "facility_key").alias("facility_id"),
            c.code_lookup(F.pmod(key, F.lit(2)), ASSET_TYPES).alias("asset_type"),
            day("o_orderdate").alias("install_date"),
            c.warranty_expiry(day("o_orderdate")).alias("warranty_expiry"),
            criticality("o_orderpriority").alias("criticality"),
            F.when(F.col("o_orderstatus") == "P", "Out of Service").otherwise("Active").alias("status"),
            day("o_orderdate").alias("created_on"),
            F.coalesce("last_ship_date", day("o_orderdate")).alias("modified_on"),
        ),
        "install_date",
        "warranty_expiry",
        "created_on",
        "modified_on",
    )


# -- facts and the bridge ----------------------------------------------------


def sales_order_line(landing: Tables, lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return lines.where("is_priced").select(
        F.col("line_key").alias("sales_order_line_key"),
        F.col("l_orderkey").alias("sales_order_key"),
        F.col("l_partkey").alias("product_key"),
        "quantity",
        F.try_divide("extended_price", "quantity").cast(c.MONEY).alias("unit_price"),
        F.col("discount").alias("discount_percent"),
        c.line_revenue(F.lit(1), "extended_price", "discount").alias("line_revenue"),
        c.extended("quantity", "standard_cost").alias("line_cost"),
        *carry,
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Revenue, cost and last ship date per order, each line rounded before it is summed."""
    revenue = c.line_revenue(F.lit(1), "extended_price", "discount")
    return (
        lines.where("is_priced")
        .groupBy(F.col("l_orderkey").alias("sales_order_key"))
        .agg(
            F.sum(revenue).cast(c.MONEY).alias("order_revenue"),
            F.sum(c.extended("quantity", "standard_cost")).cast(c.MONEY).alias("order_cost"),
            F.max("ship_date").alias("requested_date"),
        )
    )


def sales_order(landing: Tables, lines: DataFrame) -> DataFrame:
    """Orders that have lines, with their totals; orders without any line drop out.

    Text ids are made after the join, so that the shuffle carries numbers.
    """
    orders = landing("orders").select(
        F.col("o_orderkey").alias("sales_order_key"),
        F.col("o_custkey").alias("customer_key"),
        channel_key("o_orderpriority").alias("sales_channel_key"),
        day("o_orderdate").alias("order_date"),
        "o_orderstatus",
    )
    return with_date_keys(
        orders.join(order_totals(lines), "sales_order_key").select(
            "sales_order_key",
            row_id("SO", "sales_order_key").alias("sales_order_id"),
            "customer_key",
            dim_id("CUS", "customer_key").alias("customer_id"),
            "sales_channel_key",
            c.business_id("CH", "sales_channel_key", 2).alias("sales_channel_id"),
            "order_date",
            F.lit("USD").alias("currency_code"),
            F.when(F.col("o_orderstatus") == "F", "Completed")
            .when(F.col("o_orderstatus") == "O", "Open")
            .otherwise("Cancelled")
            .alias("order_status"),
            "order_revenue",
            "order_cost",
            "requested_date",
            c.gross_margin("order_revenue", "order_cost").alias("gross_margin"),
        ),
        "order_date",
        "requested_date",
    )


def supplier_product(landing: Tables, lines: DataFrame) -> DataFrame:
    """One row per product and supplier; the one with the largest quantity is preferred.

    The preferred supplier is a ``min`` over (quantity descending, supplier), so
    no window collects all suppliers of a product into one task. Pairs, of which a product has
    one per supplier, are shuffled by product once: the choice and its join are both made of
    that shuffle, as either compares all columns of a pair and so reads the same ones.
    """
    pairs = (
        lines.groupBy("l_partkey", "l_suppkey")
        .agg(F.min("quantity").alias("minimum_order_quantity"), F.sum("quantity").alias("total_quantity"))
        .repartition("l_partkey")
    )
    choice = F.struct(
        (-F.col("total_quantity")).alias("order"), F.col("l_suppkey").alias("supplier"), "minimum_order_quantity"
    )
    both_known = F.col("l_suppkey").isNotNull() & F.col("best.supplier").isNotNull()
    best = pairs.groupBy(F.col("l_partkey").alias("best_part")).agg(F.min(choice).alias("best"))
    pair_id = F.concat_ws("-", dim_id("SP", "l_partkey"), dim_id("", "l_suppkey"))
    return pairs.join(best, F.col("l_partkey") == F.col("best_part")).select(
        pair_id.alias("supplier_product_id"),
        F.col("l_partkey").alias("product_key"),
        dim_id("PRD", "l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_key"),
        dim_id("SUP", "l_suppkey").alias("supplier_id"),
        F.concat_ws("-", F.lit("SPN"), dim_id("", "l_partkey"), dim_id("", "l_suppkey")).alias(
            "supplier_part_number"
        ),
        "minimum_order_quantity",
        F.when(both_known, choice == F.col("best")).alias("preferred_supplier"),
    )


def purchase_order_line(landing: Tables, lines: DataFrame) -> DataFrame:
    short = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).otherwise(0)
    received = c.received_quantity("quantity", short)
    return with_date_keys(
        lines.where("is_priced").select(
            F.col("line_key").alias("purchase_order_line_key"),
            row_id("PO", "l_orderkey").alias("purchase_order_id"),
            F.col("l_suppkey").alias("supplier_key"),
            F.col("l_partkey").alias("product_key"),
            "facility_key",
            "order_date",
            c.offset_date("order_date", 30).alias("expected_date"),
            F.col("ship_date").alias("received_date"),
            F.col("quantity").alias("ordered_quantity"),
            received.alias("received_quantity"),
            F.col("standard_cost").alias("unit_cost"),
            c.purchase_status("ship_date", received, "quantity", landing.as_of).alias(
                "purchase_order_status"
            ),
        ),
        "order_date",
        "expected_date",
        "received_date",
    )


def shipment(landing: Tables, lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    hold = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    promised = c.offset_date("ship_date", F.col("l_linenumber") + 2)
    actual = c.offset_date(promised, F.pmod("part_size", F.lit(9)) - 3)
    return with_date_keys(
        lines.select(
            F.col("line_key").alias("shipment_key"),
            F.col("l_orderkey").alias("sales_order_key"),
            "facility_key",
            F.col("l_returnflag").alias("carrier_name"),
            "ship_date",
            promised.alias("promised_delivery_date"),
            actual.alias("actual_delivery_date"),
            c.money(F.col("extended_price") * F.col("tax")).alias("freight_cost"),
            hold.alias("quality_hold"),
            c.shipment_status(hold, actual, landing.as_of).alias("shipment_status"),
            *carry,
        ),
        "ship_date",
        "promised_delivery_date",
        "actual_delivery_date",
    )


def inventory_snapshot(landing: Tables, lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return with_date_keys(
        lines.select(
            F.col("line_key").alias("inventory_snapshot_key"),
            F.col("ship_date").alias("snapshot_date"),
            "facility_key",
            F.col("l_partkey").alias("product_key"),
            F.col("quantity").alias("quantity_on_hand"),
            F.col("l_linenumber").alias("quantity_allocated"),
            F.col("part_size").alias("safety_stock_quantity"),
            c.reorder_point("part_size", 10).alias("reorder_point"),
            c.stockout_flag("quantity", "part_size").alias("stockout_flag"),
            *carry,
        ),
        "snapshot_date",
    )


def work_order(landing: Tables, lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    hours = c.repair_hours("quantity", "priority")
    resolved = c.offset_date("ship_date", c.resolve_days(hours))
    kind = c.code_lookup(F.pmod("l_linenumber", F.lit(4)), WORK_ORDER_TYPES)
    waiting = F.col("l_linestatus") == "O"
    return with_date_keys(
        lines.where("l_returnflag = 'R'").select(
            F.col("line_key").alias("work_order_key"),
            F.col("l_orderkey").alias("asset_key"),
            F.col("l_suppkey").alias("technician_key"),
            F.col("ship_date").alias("opened_date"),
            "priority",
            kind.alias("work_order_type"),
            hours.alias("duration_hours"),
            resolved.alias("resolved_date"),
            c.work_order_status(resolved, waiting, landing.as_of).alias("work_order_status"),
            c.labor_cost(hours, LABOR_RATE).alias("labor_cost"),
            *carry,
        ),
        "opened_date",
        "resolved_date",
    )


def work_order_part(landing: Tables, lines: DataFrame) -> DataFrame:
    """Lines returned as parts, each on the first work order of its order."""
    first = (
        lines.where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("job_order"))
        .agg(F.min_by("line_key", "l_linenumber").alias("work_order_key"))
    )
    parts = lines.where("l_returnflag = 'A' AND is_priced")
    return parts.join(first, F.col("l_orderkey") == F.col("job_order")).select(
        F.col("line_key").alias("work_order_part_key"),
        "work_order_key",
        F.col("l_partkey").alias("product_key"),
        F.col("quantity").alias("quantity_used"),
        c.extended("quantity", "standard_cost").alias("part_cost"),
    )


def asset_daily_status(landing: Tables, lines: DataFrame) -> DataFrame:
    """Events per user and day. The hours seen are bits of one number, so one
    pre-aggregated shuffle counts them, not a distinct of every event."""
    hour_bit = F.expr("shiftleft(1, hour(ts))")
    value = c.money("value")
    daily = landing("events").groupBy(
        F.col("user_id").alias("asset_key"), day("ts").alias("status_date")
    ).agg(
        F.bit_count(F.bit_or(hour_bit)).cast("decimal(5,1)").alias("operating_hours"),
        F.max(value).cast("decimal(5,1)").alias("health_score"),
        F.min(value).cast("decimal(5,1)").alias("temperature_c"),
        F.count_if(F.col("event_type") == "error").cast("int").alias("alert_count"),
    )
    row_key = c.pair_key("asset_key", "status_date")
    return with_date_keys(
        daily.withColumn("asset_daily_status_key", row_key).select(
            "asset_daily_status_key",
            "asset_key",
            "status_date",
            "operating_hours",
            c.downtime_hours("operating_hours").alias("downtime_hours"),
            "health_score",
            "temperature_c",
            "alert_count",
        ),
        "status_date",
    )


# Entities that take no looked-up column of a line.
BARE_ENTITIES = {"facility", "product", "supplier", "technician", "asset", "supplier_product"}

# Facts that are lines, each by itself: entity → the lines it takes, and the column of a line that is its parent's key.
LINE_FACTS = {
    "sales_order_line": ("is_priced", "l_orderkey"),
    "shipment": ("true", "l_orderkey"),
    "inventory_snapshot": ("true", "l_partkey"),
    "work_order": ("l_returnflag = 'R'", "l_orderkey"),
}

# Text ids of the facts that are shuffled whole, each made from a key: id → (prefix, key, width).
PAIR_KEYS = {
    "sales_order_line_key", "purchase_order_line_key", "shipment_key", "inventory_snapshot_key", "work_order_key",
    "work_order_part_key", "asset_daily_status_key",
}
TEXT_IDS = {
    "sales_order_line": {
        "sales_order_line_id": ("SOL", "sales_order_line_key", ROW_ID_WIDTH),
        "sales_order_id": ("SO", "sales_order_key", ROW_ID_WIDTH),
        "product_id": ("PRD", "product_key", DIM_ID_WIDTH),
    },
    "purchase_order_line": {
        "purchase_order_line_id": ("POL", "purchase_order_line_key", ROW_ID_WIDTH),
        "supplier_id": ("SUP", "supplier_key", DIM_ID_WIDTH),
        "product_id": ("PRD", "product_key", DIM_ID_WIDTH),
        "facility_id": ("FAC", "facility_key", DIM_ID_WIDTH),
    },
    "shipment": {
        "shipment_id": ("SHP", "shipment_key", ROW_ID_WIDTH),
        "sales_order_id": ("SO", "sales_order_key", ROW_ID_WIDTH),
        "facility_id": ("FAC", "facility_key", DIM_ID_WIDTH),
    },
    "inventory_snapshot": {
        "inventory_snapshot_id": ("INV", "inventory_snapshot_key", ROW_ID_WIDTH),
        "facility_id": ("FAC", "facility_key", DIM_ID_WIDTH),
        "product_id": ("PRD", "product_key", DIM_ID_WIDTH),
    },
    "work_order": {
        "work_order_id": ("WO", "work_order_key", ROW_ID_WIDTH),
        "asset_id": ("AST", "asset_key", ROW_ID_WIDTH),
        "technician_id": ("TEC", "technician_key", DIM_ID_WIDTH),
    },
    "work_order_part": {
        "work_order_part_id": ("WOP", "work_order_part_key", ROW_ID_WIDTH),
        "work_order_id": ("WO", "work_order_key", ROW_ID_WIDTH),
        "product_id": ("PRD", "product_key", DIM_ID_WIDTH),
    },
    "asset_daily_status": {
        "asset_daily_status_id": ("ADS", "asset_daily_status_key", ROW_ID_WIDTH),
        "asset_id": ("AST", "asset_key", ROW_ID_WIDTH),
    },
}


def with_text_ids(df: DataFrame, entity: str) -> DataFrame:
    """Add an entity's text ids, each after its key.

    They are left until after the join to a parent, or a rewrite in another order, so that the
    shuffle carries numbers instead of padded text.
    """
    ids = {name: rule for name, rule in TEXT_IDS.get(entity, {}).items() if name not in df.columns}
    chosen = []
    for column in df.columns:
        chosen.append(F.col(column))
        for name, (prefix, key, width) in ids.items():
            if key == column:
                made = c.pair_id if key in PAIR_KEYS else c.business_id
                chosen.append(made(prefix, key, width).alias(name))
    return df.select(*chosen)


# Entity name → how it is bound, its key, and the landing table it mostly comes from.
ENTITIES: dict[str, tuple[Callable[[Tables, DataFrame], DataFrame], str, str]] = {
    "facility": (facility, "facility_key", "nation"),
    "customer": (customer, "customer_key", "customer"),
    "product": (product, "product_key", "part"),
    "supplier": (supplier, "supplier_key", "supplier"),
    "employee": (employee, "employee_key", "customer"),
    "technician": (technician, "technician_key", "supplier"),
    "sales_channel": (sales_channel, "sales_channel_key", "orders"),
    "asset": (asset, "asset_key", "orders"),
    "sales_order": (sales_order, "sales_order_id", "orders"),
    "sales_order_line": (sales_order_line, "sales_order_line_id", "lineitem"),
    "supplier_product": (supplier_product, "supplier_product_id", "lineitem"),
    "purchase_order_line": (purchase_order_line, "purchase_order_line_id", "lineitem"),
    "shipment": (shipment, "shipment_id", "lineitem"),
    "inventory_snapshot": (inventory_snapshot, "inventory_snapshot_id", "lineitem"),
    "work_order": (work_order, "work_order_id", "lineitem"),
    "work_order_part": (work_order_part, "work_order_part_id", "lineitem"),
    "asset_daily_status": (asset_daily_status, "asset_daily_status_id", "events"),
}

# Date columns of each entity, from which the calendar takes its bounds.
DATE_COLUMNS = {
    "facility": ["created_on", "modified_on"],
    "customer": ["created_on", "modified_on"],
    "product": ["created_on", "modified_on"],
    "supplier": ["contract_start_date", "created_on", "modified_on"],
    "employee": ["hire_date", "created_on", "modified_on"],
    "technician": ["certification_expiry", "created_on", "modified_on"],
    "asset": ["install_date", "warranty_expiry", "created_on", "modified_on"],
    "sales_order": ["order_date", "requested_date"],
    "purchase_order_line": ["order_date", "expected_date", "received_date"],
    "shipment": ["ship_date", "promised_delivery_date", "actual_delivery_date"],
    "inventory_snapshot": ["snapshot_date"],
    "work_order": ["opened_date", "resolved_date"],
    "asset_daily_status": ["status_date"],
}
