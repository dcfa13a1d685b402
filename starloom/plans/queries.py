"""Every operator as a query over the landing folder.

A query takes the warehouse and returns a DataFrame over whole tables. Gold
tables it needs are published on first use.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import columns as c
from starloom.operators import quality
from starloom.operators.calendar import calendar_days
from starloom.operators.conform import duplicate_keys, has_duplicates
from starloom.operators.formatting import format_metrics, plain
from starloom.operators.incremental import conform_changes
from starloom.operators.joins import lookup_join, orphan_rows
from starloom.operators.lattice import Lattice, build_lattice
from starloom.operators.layout import compact, read_where, rewrite_clustered, rewrite_curved
from starloom.operators.rollup import BROADCAST_BYTES, MetricModel
from starloom.plans.layers import (
    load_bronze,
    load_gold,
    load_raw,
    load_silver,
    refresh_calendar,
    rejected_rows,
    screen_sources,
)
from starloom.plans.measures import MEASURES, last_year, to_date
from starloom.plans.models import MODEL_TABLES, model_table
from starloom.plans.publish import (
    DIMENSIONS,
    FACTS,
    GOLD_ENTITIES,
    Warehouse,
    open_warehouse,
)
from starloom.sources import landing as bind
from starloom.sources.store import jobs_at_once, side_by_side, stamp_lineage

Query = Callable[[Warehouse], DataFrame]

RUN_ID = "run-0001"
LOADED_AT = datetime(2024, 1, 31, 6, 0, 0)
LINE_KEY = ["l_orderkey", "l_linenumber"]

# The seven large facts that are rewritten by date.
CLUSTERED_FACTS = {
    "fact_sales_order_line": ("order_date_key", "sales_order_line_key"),
    "fact_purchase_order_line": ("order_date_key", "purchase_order_line_key"),
    "fact_shipment": ("ship_date_key", "shipment_key"),
    "fact_inventory_snapshot": ("snapshot_date_key", "inventory_snapshot_key"),
    "fact_work_order": ("opened_date_key", "work_order_key"),
    "fact_work_order_part": ("opened_date_key", "work_order_part_key"),
    "fact_asset_daily_status": ("status_date_key", "asset_daily_status_key"),
}

#: Keys are summed as residues below this, so that a sum over any table stays exact.
KEY_RESIDUES = 1_000_003
CURVE_COLUMNS, CURVE_FILE_BYTES, PRODUCT_RANGE = ("order_date_key", "customer_key", "product_key"), 32 * 1024 * 1024, (100, 199)

YEAR_MONTH = ("date.calendar_year", "date.calendar_month")
# Home table → model and the attribute its measures are shown by.
MEASURE_AXES = {
    "customer": ("commercial", "customer.customer_segment"),
    "orders": ("commercial", "sales_channel.channel_group"),
    "product": ("commercial", "product.product_category"),
    "sales": ("commercial", "customer.customer_segment"),
    "facility": ("supply_chain", "facility.region_code"),
    "inventory": ("supply_chain", "product.product_category"),
    "purchase_orders": ("supply_chain", "supplier.supplier_tier"),
    "shipments": ("supply_chain", "facility.region_code"),
    "supplier": ("supply_chain", "supplier.supplier_tier"),
    "asset_daily_status": ("service", "asset.criticality"),
    "asset": ("service", "asset.asset_type"),
    "employee": ("service", "employee.department"),
    "technician": ("service", "technician.specialty"),
    "work_order_parts": ("service", "part_product.product_category"),
    "work_orders": ("service", "technician.specialty"),
}
TIMELESS_HOMES = {"customer", "product", "facility", "supplier", "asset", "employee", "technician"}


def model(warehouse: Warehouse, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> MetricModel:
    def size(table: str) -> int:
        warehouse.table(table)
        return warehouse.store.size_in_bytes(f"gold.{table}")

    return MetricModel(name, warehouse.table, size, broadcast_bytes)


def star(w: Warehouse, where: str, measures: list[str], axis: list[str]) -> DataFrame:
    """A rollup that asks for the tables of its measures and groups, and for the calendar only among these."""
    asked = [*(MEASURES[name].home for name in measures), *(attribute.partition(".")[0] for attribute in axis)]
    w.publish_bare(dict.fromkeys(MODEL_TABLES[where][table] for table in asked))
    return model(w, where).rollup(measures, axis)


# Measures that other models than their first have too, over relationships of their own.
SHARED_MEASURES = {
    "supply_chain": ("n_customers_created", "n_customers_modified", "n_products_created", "n_products_modified"),
    "service": (
        "n_customers_created", "n_customers_modified", "n_products_created", "n_products_modified",
        "n_facilities_created", "n_facilities_modified",
    ),
}


def measure_query(name: str, in_model: str | None = None) -> Query:
    """A measure by year, month and one attribute of its neighbourhood."""
    measure = MEASURES[name]

    def run(w: Warehouse) -> DataFrame:
        if measure.home == "supplier_products":
            axis = ["supplier.supplier_tier", "product.product_category"]
            return star(w, "supply_chain", [name], axis)
        where, attribute = MEASURE_AXES[measure.home]
        timeless = measure.home in TIMELESS_HOMES and not measure.date_role
        dates = YEAR_MONTH[:1] if timeless else YEAR_MONTH
        return model(w, in_model or where).rollup([name], [*dates, attribute])

    return run


# -- sources -----------------------------------------------------------------


def lineage_stamp(w: Warehouse) -> DataFrame:
    return stamp_lineage(w.landing("orders"), "landing.orders", RUN_ID, LOADED_AT).select(
        "o_orderkey", "ingestion_timestamp", "pipeline_run_id", "source_system"
    )


def bronze_load(w: Warehouse) -> DataFrame:
    return load_bronze(w.landing, w.sibling_store("bronze"), RUN_ID, LOADED_AT)


def silver_load(w: Warehouse) -> DataFrame:
    """What became of all rows: kept, or rejected for their keys or codes."""
    store = w.sibling_store("silver")
    load_bronze(w.landing, store, RUN_ID, LOADED_AT)
    return load_silver(store)


def gold_load(w: Warehouse) -> DataFrame:
    """The layered load to its end, in a store of its own; rows of each gold table."""
    store = w.sibling_store("layered")
    load_bronze(w.landing, store, RUN_ID, LOADED_AT)
    load_silver(store)
    return load_gold(store)


def quarantine_report(w: Warehouse) -> DataFrame:
    """Rejected rows of the landing tables by source file and reason."""
    store = w.sibling_store("quarantine")
    load_raw(w.landing, store, RUN_ID, LOADED_AT)
    screen_sources(store)
    return rejected_rows(store)


def content_of(name: str, rows: DataFrame) -> DataFrame:
    """What a rewritten fact holds: rows, days, and a sum over all row keys that no lost or doubled row keeps."""
    day, row = CLUSTERED_FACTS[name]
    return rows.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("row_count"),
        F.min(day).alias("first_date_key"),
        F.max(day).alias("last_date_key"),
        F.sum(c.digest_bucket(row, KEY_RESIDUES)).alias("row_key_digest"),
    )


def published_facts(w: Warehouse) -> int:
    """Publish the seven large facts; how many jobs that rewrite them run at a time."""
    w.publish_tables(CLUSTERED_FACTS)
    return jobs_at_once(w.spark, sum(w.store.size_in_bytes(f"gold.{name}") for name in CLUSTERED_FACTS))


def clustered_rewrite(w: Warehouse) -> DataFrame:
    """The seven large facts rewritten by date beside the published ones; what each holds."""
    beside, at_once = w.sibling_store("clustered"), published_facts(w)

    def rewrite(name: str) -> DataFrame:
        day, row = CLUSTERED_FACTS[name]
        entity = GOLD_ENTITIES[name]
        ids = bind.TEXT_IDS.get(entity, {})
        laid = rewrite_clustered(
            w.store, f"gold.{name}", day, row, beside, ids, lambda rows: bind.with_text_ids(rows, entity)
        )
        return content_of(name, laid)

    return reduce(DataFrame.unionByName, side_by_side(rewrite, CLUSTERED_FACTS, at_once))


def compacted_facts(w: Warehouse) -> DataFrame:
    """The seven large facts with their small files merged, beside the published ones; what each holds."""
    beside, at_once = w.sibling_store("compacted"), published_facts(w)

    def merge(name: str) -> DataFrame:
        compact(w.store, f"gold.{name}", into=beside)
        return content_of(name, beside.read(f"gold.{name}"))

    return reduce(DataFrame.unionByName, side_by_side(merge, CLUSTERED_FACTS, at_once))


def curve_clustered_scan(w: Warehouse) -> DataFrame:
    """Sales of some products from a fact laid along a curve through day, customer and product.

    Files whose own range of products does not meet the filter are not opened.
    """
    name, beside = "gold.fact_sales_order_line", w.sibling_store("curved")
    w.table("fact_sales_order_line")
    rewrite_curved(w.store, name, CURVE_COLUMNS, "sales_order_line_key", into=beside, file_bytes=CURVE_FILE_BYTES)
    return (
        read_where(beside, name, {"product_key": PRODUCT_RANGE})
        .groupBy("product_key")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("quantity").cast("double").alias("units_sold"),
            F.sum(c.digest_bucket("sales_order_line_key", KEY_RESIDUES)).alias("row_key_digest"),
        )
    )


# -- column rules ------------------------------------------------------------


def hash_bucket_assign(w: Warehouse) -> DataFrame:
    return w.landing("customer").select(
        "c_custkey", c.hash_bucket("c_custkey", 20, salt=7).alias("bucket")
    )


def digest_bucket_assign(w: Warehouse) -> DataFrame:
    return w.landing("customer").select(
        "c_custkey", c.digest_bucket("c_custkey", 20, salt="7").alias("bucket")
    )


def code_lookup(w: Warehouse) -> DataFrame:
    code = bind.channel_key("o_orderpriority") - 1
    names = tuple(name for _, name, _ in bind.SALES_CHANNELS)
    return w.landing("orders").select("o_orderkey", c.code_lookup(code, names).alias("channel_name"))


def business_id(w: Warehouse) -> DataFrame:
    return w.landing("orders").select("o_orderkey", c.business_id("SO", "o_orderkey", 12).alias("order_id"))


def date_key(w: Warehouse) -> DataFrame:
    return w.landing("events").select("event_id", c.date_key(bind.day("ts")).alias("event_date_key"))


def offset_dates(w: Warehouse) -> DataFrame:
    lines = w.line().withColumn("promised", c.offset_date("ship_date", F.col("l_linenumber") + 2))
    return lines.select(
        "line_key",
        c.offset_date("order_date", 30).alias("expected_date"),
        F.col("promised").alias("promised_date"),
        c.offset_date("promised", F.pmod("part_size", F.lit(9)) - 3).alias("actual_date"),
    )


def warranty_expiry(w: Warehouse) -> DataFrame:
    ordered = bind.day("o_orderdate")
    return w.landing("orders").select("o_orderkey", c.warranty_expiry(ordered).alias("warranty_expiry"))


def order_status_rule(w: Warehouse) -> DataFrame:
    cancelled = F.col("o_orderstatus") == "P"
    status = c.order_status(bind.day("o_orderdate"), cancelled, w.landing.as_of)
    return w.landing("orders").select("o_orderkey", status.alias("order_status"))


def purchase_status_rule(w: Warehouse) -> DataFrame:
    return w.entity("purchase_order_line").select("purchase_order_line_id", "purchase_order_status")


def shipment_status_rule(w: Warehouse) -> DataFrame:
    return w.entity("shipment").select("shipment_id", "shipment_status")


def work_order_status_rule(w: Warehouse) -> DataFrame:
    return w.entity("work_order").select("work_order_id", "work_order_status")


def risk_tier_banding(w: Warehouse) -> DataFrame:
    tiers = ((2000, "High"), (5000, "Medium"))
    return w.landing("customer").select(
        "c_custkey", c.banding(c.money("c_acctbal"), tiers, "Low").alias("risk_tier")
    )


def priced_lines(w: Warehouse) -> DataFrame:
    """Lines with their product's prices; lines without a product drop out."""
    prices = w.table("dim_product").select("product_key", "standard_cost", "list_price")
    lines = w.line().drop("standard_cost").withColumnRenamed("l_partkey", "product_key")
    small = w.store.size_in_bytes("gold.dim_product") <= BROADCAST_BYTES
    return lookup_join(lines, prices, "product_key", small)


def broadcast_price_join(w: Warehouse) -> DataFrame:
    return priced_lines(w).select("line_key", "product_key", "quantity", "standard_cost", "list_price")


def line_revenue(w: Warehouse) -> DataFrame:
    revenue = c.line_revenue("quantity", "list_price", "discount")
    return priced_lines(w).select("line_key", revenue.alias("line_revenue"))


def line_cost(w: Warehouse) -> DataFrame:
    cost = c.extended("quantity", "standard_cost")
    return priced_lines(w).select("line_key", cost.alias("line_cost"))


def unit_cost(w: Warehouse) -> DataFrame:
    """Standard cost at 85 % and one more per cent for each line number."""
    factor = F.lit("0.85").cast(c.FRACTION) + F.col("l_linenumber") * F.lit("0.01").cast(c.FRACTION)
    return priced_lines(w).select("line_key", c.unit_cost("standard_cost", factor).alias("unit_cost"))


def received_quantity(w: Warehouse) -> DataFrame:
    return w.entity("purchase_order_line").select(
        "purchase_order_line_id", "ordered_quantity", "received_quantity"
    )


def stockout_flag(w: Warehouse) -> DataFrame:
    return w.entity("inventory_snapshot").select(
        "inventory_snapshot_id", "safety_stock_quantity", "reorder_point", "stockout_flag"
    )


def work_order_duration(w: Warehouse) -> DataFrame:
    return w.entity("work_order").select(
        "work_order_id",
        "duration_hours",
        c.resolve_days("duration_hours").alias("days_to_resolve"),
        "resolved_date",
    )


def labor_cost(w: Warehouse) -> DataFrame:
    return w.entity("work_order").select("work_order_id", "labor_cost")


def part_cost(w: Warehouse) -> DataFrame:
    return w.entity("work_order_part").select("work_order_part_id", "quantity_used", "part_cost")


def downtime_hours(w: Warehouse) -> DataFrame:
    return w.entity("asset_daily_status").select(
        "asset_daily_status_id", "operating_hours", "downtime_hours"
    )


def purchased_value(w: Warehouse) -> DataFrame:
    return w.table("fact_purchase_order_line").select("purchase_order_line_id", "purchased_value")


def inventory_value(w: Warehouse) -> DataFrame:
    return w.table("fact_inventory_snapshot").select(
        "inventory_snapshot_id", "standard_cost", "inventory_value"
    )


def order_gross_margin(w: Warehouse) -> DataFrame:
    return w.entity("sales_order").select("sales_order_id", "gross_margin")


def batch_assign(w: Warehouse) -> DataFrame:
    return w.landing("events").select(
        "event_id",
        c.batch_id("event_id", 3).alias("batch_id"),
        c.spread_id("event_id", 1, 4).alias("header_id"),
    )


def display_name(w: Warehouse) -> DataFrame:
    name = c.display_name("customer_segment", "country_code", number="customer_key", width=9)
    return w.entity("customer").select("customer_key", name.alias("display_name"))


def preferred_supplier(w: Warehouse) -> DataFrame:
    preferred = w.entity("supplier_product").where("preferred_supplier")
    return preferred.select("product_key", "supplier_key", "minimum_order_quantity")


# -- conform, joins, grouped totals ------------------------------------------


def conform_dedup(w: Warehouse) -> DataFrame:
    lines = bind.conformed_lineitem(w.landing, w.sibling_store("conform"))
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def incremental_conform(w: Warehouse) -> DataFrame:
    """Conformed lines after two loads: of lines that differ in every hundredth order, then of the lines as they are."""
    store, raw = w.sibling_store("incremental"), w.landing("lineitem")
    other = F.when(F.col("l_orderkey") % 100 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    earlier = raw.where("l_orderkey % 100 <> 1 OR l_orderkey IS NULL").withColumn(
        "l_quantity", other.cast(raw.schema["l_quantity"].dataType)
    )
    for rows in (earlier, raw):
        conform_changes(store, "lineitem", rows, LINE_KEY, bind.bound_codes("lineitem"))
    return store.read("conformed.lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def lineitem_duplicates(w: Warehouse) -> DataFrame:
    return duplicate_keys(w.landing("lineitem"), LINE_KEY)


def duplicate_exists(w: Warehouse) -> DataFrame:
    """Whether raw and conformed lines, and customers, hold a key twice."""
    tables = {
        "lineitem": (w.landing("lineitem"), LINE_KEY),
        "line": (w.line(), LINE_KEY),
        "customer": (w.landing("customer"), ["c_custkey"]),
    }
    found = [
        has_duplicates(df, keys).select(F.lit(name).alias("table_name"), "has_duplicates")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def orders_without_lines(w: Warehouse) -> DataFrame:
    orders = w.landing("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orphan_rows(orders, "o_orderkey", w.line().select("l_orderkey"), "l_orderkey")


def order_totals(w: Warehouse) -> DataFrame:
    return bind.order_totals(w.line())


def order_header_totals(w: Warehouse) -> DataFrame:
    orders = w.landing("orders").select("o_orderkey", "o_orderpriority")
    totals = bind.order_totals(w.line())
    joined = orders.join(totals, F.col("o_orderkey") == F.col("sales_order_key"))
    return joined.select("o_orderkey", "o_orderpriority", "order_revenue", "order_cost")


def row_count_audit(w: Warehouse) -> DataFrame:
    counts = [
        w.table(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in GOLD_ENTITIES
    ]
    return reduce(DataFrame.unionByName, counts)


# -- calendar ----------------------------------------------------------------


def calendar_refresh(w: Warehouse) -> DataFrame:
    """Rebuild the calendar from the conformed entities into a layer of its own."""
    published = {entity: gold for gold, entity in GOLD_ENTITIES.items()}
    side = w.sibling_store("calendar_refresh")
    return refresh_calendar(
        lambda entity: w.table(published[entity]), side, w.landing.this_year, RUN_ID, LOADED_AT
    )


def validation_summary(w: Warehouse) -> DataFrame:
    """All integrity checks of the published tables, stored; raises if one fails."""
    w.publish_tables(GOLD_ENTITIES)
    return quality.run_gate(w.spark, w.table, w.store)


# -- metric queries ----------------------------------------------------------

SALES_MEASURES = ["total_revenue", "gross_margin", "gross_margin_pct", "n_orders_with_sales"]


SALES_STAR = [
    "date.calendar_year",
    "customer.region_code",
    "product.product_category",
    "sales_channel.channel_group",
]


def star_join(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(SALES_MEASURES, SALES_STAR)


# Every active relationship of a fact in one query: model, measures, attributes.
STARS = {
    "star_orders": (
        "commercial",
        ["n_orders", "average_order_value"],
        ["date.calendar_year", "customer.country_code", "sales_channel.sales_channel_name"],
    ),
    "star_purchases": (
        "supply_chain",
        ["purchased_value", "n_purchase_orders", "supplier_fill_rate", "on_time_receipt_rate"],
        ["date.calendar_year", "supplier.supplier_tier", "product.product_category", "facility.facility_type"],
    ),
    "star_shipments": (
        "supply_chain",
        ["n_shipments", "freight_cost", "on_time_delivery_rate", "quality_hold_rate"],
        ["date.calendar_year", "facility.region_code", "customer.customer_segment", "sales_channel.channel_group"],
    ),
    "star_inventory": (
        "supply_chain",
        ["available_quantity", "inventory_value", "stockout_rate"],
        ["date.calendar_year", "product.product_family", "facility.facility_type"],
    ),
    "star_assignments": (
        "supply_chain",
        ["n_supplier_product_assignments", "n_preferred_assignments"],
        ["supplier.supplier_tier", "product.product_category"],
    ),
    "star_work_orders": (
        "service",
        ["n_work_orders", "mean_time_to_repair_hours", "service_level_compliance"],
        [
            "date.calendar_year", "asset.asset_type", "technician.specialty",
            "customer.customer_segment", "facility.facility_type", "product.product_category",
        ],
    ),
    "star_work_order_parts": (
        "service",
        ["parts_cost", "parts_used", "n_work_order_part_lines"],
        [
            "date.calendar_year", "asset.asset_type", "technician.skill_level",
            "customer.risk_tier", "facility.facility_type", "part_product.critical_spare",
            "product.product_category",
        ],
    ),
    "star_asset_status": (
        "service",
        ["asset_availability", "average_health_score", "n_alerts"],
        [
            "date.full_date", "asset.criticality", "customer.customer_segment",
            "facility.facility_type", "product.product_category",
        ],
    ),
    "star_technicians": (
        "service",
        ["n_active_technicians"],
        ["employee.department", "technician.specialty"],
    ),
}


def star_query(name: str) -> Query:
    where, measures, axis = STARS[name]
    return lambda w: star(w, where, measures, axis)


def far_star_join(w: Warehouse) -> DataFrame:
    """The same star with no dimension small enough to broadcast."""
    return model(w, "commercial", broadcast_bytes=0).rollup(SALES_MEASURES, SALES_STAR)


def filtered_rollup(w: Warehouse, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return model(w, "commercial", broadcast_bytes).rollup(
        ["total_revenue", "units_sold", "n_sales_lines"],
        ["date.calendar_year", "product.product_category"],
        filters={
            "customer.customer_segment": ["BUILDING", "MACHINERY"],
            "customer.risk_tier": "High",
            "date.calendar_year": lambda year: year.between(1996, 1999),
            "sales.quantity": lambda quantity: quantity >= 10,
        },
    )


def far_filtered_rollup(w: Warehouse) -> DataFrame:
    """The same with no dimension small enough to broadcast: filters come before the grouping."""
    return filtered_rollup(w, broadcast_bytes=0)


def filtered_rollup_blank(w: Warehouse) -> DataFrame:
    """Alerts of assets without a product, and of all that are not of one named category."""
    service = model(w, "service")
    category = "product.product_category"
    blank = service.rollup(["n_alerts"], ["asset.criticality"], {category: lambda c: c.isNull()})
    first = w.table("dim_product").agg(F.min("product_category")).scalar()
    others = service.rollup(
        ["n_alerts"], ["asset.criticality"], {category: lambda c: ~c.eqNullSafe(first)}
    )
    return blank.select(F.lit("blank").alias("kept"), "*").unionByName(
        others.select(F.lit("all but the first").alias("kept"), "*")
    )


def status_rollup(w: Warehouse) -> DataFrame:
    """Conditional measures grouped by the column they test: other members are blank."""
    return model(w, "commercial").rollup(
        ["n_orders", "n_open_orders", "n_completed_orders", "cancellation_rate"],
        ["orders.order_status"],
    )


def date_role_join(w: Warehouse) -> DataFrame:
    """Shipments under their five dates side by side."""
    return model(w, "supply_chain").rollup(
        [
            "n_shipments",
            "n_shipments_by_promised_delivery_date",
            "n_shipments_by_actual_delivery_date",
            "n_shipments_by_order_date",
            "n_shipments_by_requested_date",
        ],
        ["date.calendar_year", "date.calendar_quarter"],
    )


def date_role_switch(w: Warehouse) -> DataFrame:
    return model(w, "supply_chain").rollup(
        ["purchased_value", "supplier_fill_rate"],
        ["date.calendar_year", "supplier.supplier_tier"],
        date_role="received_date_key",
    )


def drill_across(w: Warehouse) -> DataFrame:
    """Three supply facts by what they share."""
    return model(w, "supply_chain").rollup(
        ["purchased_value", "n_purchase_orders", "n_shipments", "freight_cost", "inventory_value", "stockout_rate"],
        ["date.calendar_year", "date.calendar_month", "facility.region_code"],
    )


def drill_across_sales(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(
        ["n_orders", "average_order_value", "total_revenue", "gross_margin_pct"],
        ["date.calendar_year", "sales_channel.sales_channel_name"],
    )


def drill_across_service(w: Warehouse) -> DataFrame:
    return model(w, "service").rollup(
        ["n_work_orders", "labor_cost", "parts_cost", "asset_availability", "n_alerts"],
        ["asset.criticality", "product.product_category"],
    )


def snowflake_rollup(w: Warehouse) -> DataFrame:
    return model(w, "service").rollup(
        ["n_work_orders", "labor_cost", "service_level_compliance"],
        ["employee.department", "technician.skill_level"],
    )


def two_role_product(w: Warehouse) -> DataFrame:
    return model(w, "service").rollup(
        ["parts_cost", "parts_used"], ["product.product_category", "part_product.product_category"]
    )


def bridge_rollup(w: Warehouse) -> DataFrame:
    return star(
        w, "supply_chain",
        ["n_supplier_product_assignments", "n_preferred_assignments"],
        ["supplier.region_code", "product.product_family"],
    )


def unrelated_total(w: Warehouse) -> DataFrame:
    """Assets by customer segment: no relationship, so each member repeats the total."""
    return model(w, "service").rollup(["n_assets", "n_critical_assets"], ["customer.customer_segment"])


def calendar_rollup(w: Warehouse) -> DataFrame:
    return model(w, "commercial").subtotals(
        ["total_revenue", "gross_margin_pct", "average_selling_price"],
        ["date.calendar_year", "date.calendar_quarter", "date.calendar_month", "date.full_date"],
    )


def distinct_rollup(w: Warehouse) -> DataFrame:
    return model(w, "commercial").subtotals(
        ["n_orders_with_sales", "n_sales_lines"],
        ["date.calendar_year", "date.calendar_quarter", "date.calendar_month"],
        by=["product.product_category"],
    )


def revenue_ytd_daily(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(["total_revenue_ytd"], ["date.full_date"])


def revenue_ly_daily(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(["total_revenue", "total_revenue_ly"], ["date.full_date"])


def revenue_ytd_quarterly(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(
        ["total_revenue_ytd", "total_revenue_ly"],
        ["date.calendar_year", "date.calendar_quarter", "product.product_category"],
    )


def purchase_orders_ytd(w: Warehouse) -> DataFrame:
    """Distinct purchase orders received in the year so far: one received in two months counts once."""
    received = "n_purchase_orders_by_received_date"
    return model(w, "supply_chain").rollup([to_date(received), received], [*YEAR_MONTH, "supplier.supplier_tier"])


def purchase_orders_ly_half(w: Warehouse) -> DataFrame:
    """Distinct purchase orders received in the first half of the year before, counted over both quarters."""
    return model(w, "supply_chain").rollup(
        [last_year("n_purchase_orders_by_received_date"), last_year("total_received_quantity")],
        ["date.calendar_year", "supplier.supplier_tier"],
        filters={"date.calendar_quarter": [1, 2]},
        date_role="received_date_key",
    )


def sorted_month_labels(w: Warehouse) -> DataFrame:
    """Revenue by month name, in the order of the month number."""
    by_month = model(w, "commercial").rollup(
        ["total_revenue"], ["date.month_name", "date.calendar_month"]
    )
    return by_month.orderBy("calendar_month").select("month_name", "calendar_month", "total_revenue")


def formatted_metrics(w: Warehouse) -> DataFrame:
    shown = ["total_revenue", "gross_margin_pct", "units_sold", "average_selling_price"]
    yearly = model(w, "commercial").rollup(shown, ["date.calendar_year"])
    return format_metrics(yearly, shown).orderBy("calendar_year")


def model_orders(w: Warehouse) -> DataFrame:
    return model_table("commercial", "orders", w.table("fact_sales_order"))


def model_part_product(w: Warehouse) -> DataFrame:
    return model_table("service", "part_product", w.table("dim_product"))


def model_table_query(where: str, name: str, gold: str) -> Query:
    return lambda w: model_table(where, name, w.table(gold))


def flagship(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(
        ["total_revenue", "gross_margin_pct", "n_orders_with_sales"],
        [*YEAR_MONTH, "customer.customer_segment"],
    )


def ytd_subtotals(w: Warehouse) -> DataFrame:
    """Revenue and its year to date in the calendar hierarchy, by segment."""
    return model(w, "commercial").subtotals(
        ["total_revenue", "total_revenue_ytd"],
        ["date.calendar_year", "date.calendar_quarter", "date.calendar_month"],
        by=["customer.customer_segment"],
    )


def ly_subtotals(w: Warehouse) -> DataFrame:
    """Revenue of the same period last year in the calendar hierarchy."""
    return model(w, "commercial").subtotals(
        ["total_revenue", "total_revenue_ly"],
        ["date.calendar_year", "date.calendar_quarter", "date.calendar_month"],
    )


def ly_by_month_name(w: Warehouse) -> DataFrame:
    return model(w, "commercial").rollup(
        ["total_revenue_ly"], ["date.calendar_year", "date.month_name", "customer.customer_segment"]
    )


def ly_of_first_quarter(w: Warehouse) -> DataFrame:
    """Last year's first three months, by year: the filter names a column that is not grouped."""
    return model(w, "commercial").rollup(
        ["total_revenue_ly"], ["date.calendar_year"], {"date.calendar_month": [1, 2, 3]}
    )


def ytd_to_second_quarter(w: Warehouse) -> DataFrame:
    """The year to date at the end of the second quarter, by year."""
    return model(w, "commercial").rollup(
        ["total_revenue_ytd"], ["date.calendar_year"], {"date.calendar_quarter": 2}
    )


def subtotals_by_requested_date(w: Warehouse) -> DataFrame:
    return model(w, "commercial").subtotals(
        ["n_orders", "average_order_value"],
        ["date.calendar_year", "date.calendar_month"],
        date_role="requested_date_key",
    )


def sales_dashboard(w: Warehouse) -> DataFrame:
    """All measures of sales and orders at once."""
    homes = ("orders", "sales")
    names = [m.name for m in MEASURES.values() if m.home in homes]
    return model(w, "commercial").rollup(names, [*YEAR_MONTH, "customer.customer_segment"])


# Columns of facts that dashboards group and filter by: a stored aggregate for each list.
DASHBOARD_GRAINS = {
    home: [(day, "customer_key") for day in ("order_date_key", "requested_date_key")] for home in ("orders", "sales")
}


def sales_dashboard_stored(w: Warehouse) -> DataFrame:
    """The same dashboard from stored aggregates by day and customer: no fact is read."""
    commercial = model(w, "commercial")

    def version(table: str) -> str:
        w.table(table)
        return w.store.stored(f"gold.{table}").path

    stored = build_lattice(
        Lattice(w.sibling_store("lattice")),
        commercial.table,
        lambda home: version(MODEL_TABLES["commercial"][home]),
        DASHBOARD_GRAINS,
    )
    navigated = MetricModel("commercial", w.table, commercial.sizes, lattice=stored, versions=version)
    names = [m.name for m in MEASURES.values() if m.home in DASHBOARD_GRAINS]
    return navigated.rollup(names, [*YEAR_MONTH, "customer.customer_segment"])


OPERATORS: dict[str, Query] = {
    "flagship": flagship,
    "lineage_stamp": lineage_stamp,
    "bronze_load": bronze_load,
    "silver_load": silver_load,
    "gold_load": gold_load,
    "quarantine_report": quarantine_report,
    "sales_dashboard_stored": sales_dashboard_stored,
    "clustered_rewrite": clustered_rewrite,
    "compacted_facts": compacted_facts,
    "curve_clustered_scan": curve_clustered_scan,
    "hash_bucket_assign": hash_bucket_assign,
    "digest_bucket_assign": digest_bucket_assign,
    "code_lookup": code_lookup,
    "business_id": business_id,
    "date_key": date_key,
    "offset_dates": offset_dates,
    "warranty_expiry": warranty_expiry,
    "order_status_rule": order_status_rule,
    "purchase_status_rule": purchase_status_rule,
    "shipment_status_rule": shipment_status_rule,
    "work_order_status_rule": work_order_status_rule,
    "risk_tier_banding": risk_tier_banding,
    "line_revenue": line_revenue,
    "line_cost": line_cost,
    "unit_cost": unit_cost,
    "received_quantity": received_quantity,
    "stockout_flag": stockout_flag,
    "work_order_duration": work_order_duration,
    "labor_cost": labor_cost,
    "part_cost": part_cost,
    "downtime_hours": downtime_hours,
    "purchased_value": purchased_value,
    "inventory_value": inventory_value,
    "order_gross_margin": order_gross_margin,
    "batch_assign": batch_assign,
    "display_name": display_name,
    "preferred_supplier": preferred_supplier,
    "broadcast_price_join": broadcast_price_join,
    "order_header_totals": order_header_totals,
    "safe_left_join": Warehouse.join_guards,
    "orphan_rows": orders_without_lines,
    "star_join": star_join,
    "far_star_join": far_star_join,
    "filtered_rollup": filtered_rollup,
    "far_filtered_rollup": far_filtered_rollup,
    "filtered_rollup_blank": filtered_rollup_blank,
    "status_rollup": status_rollup,
    "date_role_join": date_role_join,
    "date_role_switch": date_role_switch,
    "drill_across": drill_across,
    "drill_across_sales": drill_across_sales,
    "drill_across_service": drill_across_service,
    "snowflake_rollup": snowflake_rollup,
    "two_role_product": two_role_product,
    "bridge_rollup": bridge_rollup,
    "unrelated_total": unrelated_total,
    "order_totals": order_totals,
    "duplicate_keys": lineitem_duplicates,
    "duplicate_exists": duplicate_exists,
    "row_count_audit": row_count_audit,
    "calendar_rollup": calendar_rollup,
    "distinct_rollup": distinct_rollup,
    "revenue_ytd_daily": revenue_ytd_daily,
    "revenue_ly_daily": revenue_ly_daily,
    "revenue_ytd_quarterly": revenue_ytd_quarterly,
    "conform_dedup": conform_dedup,
    "incremental_conform": incremental_conform,
    "purchase_orders_ytd": purchase_orders_ytd,
    "purchase_orders_ly_half": purchase_orders_ly_half,
    "sorted_month_labels": sorted_month_labels,
    "calendar_bounds": Warehouse.calendar_bounds,
    "calendar_days": lambda w: calendar_days(w.calendar_bounds()),
    "calendar_refresh": calendar_refresh,
    "formatted_metrics": formatted_metrics,
    "model_orders": model_orders,
    "model_part_product": model_part_product,
    "ytd_subtotals": ytd_subtotals,
    "ly_subtotals": ly_subtotals,
    "subtotals_by_requested_date": subtotals_by_requested_date,
    "ly_by_month_name": ly_by_month_name,
    "ly_of_first_quarter": ly_of_first_quarter,
    "ytd_to_second_quarter": ytd_to_second_quarter,
    "sales_dashboard": sales_dashboard,
    "check_unique": lambda w: quality.check_unique(w.line(), "line_key", "line"),
    "check_dim_keys": lambda w: quality.check_dim_keys(w.table),
    "check_fact_grain": lambda w: quality.check_fact_grain(w.table),
    "check_foreign_keys": lambda w: quality.check_foreign_keys(w.spark, w.table),
    "check_date_keys": lambda w: quality.check_date_keys(w.spark, w.table),
    "check_purchased_value": lambda w: quality.check_purchased_value(w.table),
    "check_inventory_value": lambda w: quality.check_inventory_value(w.table),
    "check_positive_sales": lambda w: quality.check_positive_sales(w.table),
    "check_nonneg_inventory": lambda w: quality.check_nonneg_inventory(w.table),
    "validation_summary": validation_summary,
    "load_audit": lambda w: quality.load_audit(
        w.table, list(GOLD_ENTITIES), RUN_ID, "landing", LOADED_AT
    ).orderBy("table_name"),
}


def table_query(name: str) -> Query:
    return lambda w: w.table(name)


QUERIES: dict[str, Query] = {
    **OPERATORS,
    **{name: table_query(name) for name in ("dim_date", *DIMENSIONS, *FACTS)},
    **{name: star_query(name) for name in STARS},
    **{
        f"model_{where}_{name}": model_table_query(where, name, gold)
        for where, tables in MODEL_TABLES.items()
        for name, gold in tables.items()
    },
    **{f"m_{name}": measure_query(name) for name in MEASURES},
    **{
        f"m_{name}_{where}": measure_query(name, where)
        for where, names in SHARED_MEASURES.items()
        for name in names
    },
}


def run_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The named query as a function of a session and a landing folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(QUERIES[name](open_warehouse(spark, folder)))

    return run
