"""Every table of the three models under its captions, as SQL over the landing tables."""

from __future__ import annotations

import duckdb

from oracles.star_sql import DATES, DECIMALS, with_star

LANDING = """
region(r_regionkey INTEGER, r_name VARCHAR)
nation(n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER)
customer(c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR)
supplier(s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE)
part(p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE)
orders(o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR)
lineitem(l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP)
events(event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)
"""

# The tables of each model.
MODELS = {
    "commercial": "customer=dim_customer date=dim_date orders=fact_sales_order product=dim_product "
    "sales_channel=dim_sales_channel sales=fact_sales_order_line",
    "supply_chain": "customer=dim_customer date=dim_date facility=dim_facility "
    "inventory=fact_inventory_snapshot product=dim_product purchase_orders=fact_purchase_order_line "
    "sales_channel=dim_sales_channel shipments=fact_shipment "
    "supplier_products=bridge_supplier_product supplier=dim_supplier",
    "service": "asset_daily_status=fact_asset_daily_status asset=dim_asset customer=dim_customer "
    "date=dim_date employee=dim_employee facility=dim_facility part_product=dim_product "
    "product=dim_product technician=dim_technician work_order_parts=fact_work_order_part "
    "work_orders=fact_work_order",
}

# Captions that are not the column's words in title case, and columns left out.
CAPTIONS = {
    "full_date": "Date", "calendar_year": "Year", "calendar_quarter": "Quarter",
    "calendar_month": "Month Number", "month_name": "Month", "week_of_year": "Week of Year",
    "day_of_week": "Day of Week", "day_of_week_sort": "Day of Week Sort", "region_code": "Region",
    "country_code": "Country", "weight_kg": "Weight Kilograms", "sku": "SKU",
    "orders.gross_margin": "Gross Margin Value",
    "inventory.quantity_on_hand": "Quantity on Hand Value",
    "inventory.quantity_allocated": "Allocated Quantity Value",
    "inventory.standard_cost": "Snapshot Standard Cost",
    "inventory.inventory_value": "Inventory Value Source",
    "purchase_orders.purchased_value": "Purchased Value Source",
    "shipments.carrier_name": "Carrier", "shipments.freight_cost": "Freight Cost Value",
    "asset_daily_status.operating_hours": "Operating Hours Value",
    "asset_daily_status.downtime_hours": "Downtime Hours Value",
    "asset_daily_status.temperature_c": "Temperature Celsius",
    "work_order_parts.part_cost": "Part Cost Value",
    "work_orders.labor_cost": "Labor Cost Value",
    "supply_chain.product.status": "Status", "supply_chain.facility.status": "Status",
}
LEFT_OUT = {
    "sales": "sales_order_line_key", "inventory": "inventory_snapshot_key",
    "purchase_orders": "purchase_order_line_key", "shipments": "shipment_key sales_order_key",
    "asset_daily_status": "asset_daily_status_key", "work_order_parts": "work_order_part_key",
    "part_product": "list_price lead_time_days weight_kg created_on created_on_key modified_on modified_on_key",
}


def _caption(model: str, table: str, column: str) -> str:
    for known in (f"{model}.{table}.{column}", f"{table}.{column}", column):
        if known in CAPTIONS:
            return CAPTIONS[known]
    if column == "status":
        column = f"{table}_status"
    return column.replace("_", " ").title().replace("Id", "ID") if column.endswith("_id") else column.replace("_", " ").title()


def model_sql() -> dict[str, str]:
    """SQL by query name. Columns come from the star over empty landing tables."""
    empty = duckdb.connect()
    for table in LANDING.strip().splitlines():
        empty.execute(f"CREATE TABLE {table}")
    found = {}
    for model, tables in MODELS.items():
        for table, gold in (pair.split("=") for pair in tables.split()):
            parts = []
            for column, *_ in empty.execute(f"DESCRIBE {with_star(f'SELECT * FROM {gold}')}").fetchall():
                if column in LEFT_OUT.get(table, "").split():
                    continue
                value = column
                if column in DATES.get(gold, []) or column == "full_date":
                    value = f"CAST({column} AS VARCHAR)"
                elif column in DECIMALS.get(gold, []):
                    value = f"CAST({column} AS DOUBLE)"
                parts.append(f'{value} AS "{_caption(model, table, column)}"')
            found[f"model_{model}_{table}"] = with_star(f"SELECT {', '.join(parts)} FROM {gold}")
    return found
