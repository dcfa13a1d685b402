"""SQL of every measure, by year, month and one attribute."""

from __future__ import annotations

from oracles.star_sql import with_star

# home → (from clause alias f, active date key, join, attribute)
HOMES = {
    "customer": ("dim_customer", None, "", "f.customer_segment"),
    "orders": (
        "fact_sales_order", "order_date_key",
        "LEFT JOIN dim_sales_channel x ON f.sales_channel_key = x.sales_channel_key", "x.channel_group",
    ),
    "product": ("dim_product", None, "", "f.product_category"),
    "sales": (
        "fact_sales_order_line", "order_date_key",
        "LEFT JOIN dim_customer x ON f.customer_key = x.customer_key", "x.customer_segment",
    ),
    "facility": ("dim_facility", None, "", "f.region_code"),
    "inventory": (
        "fact_inventory_snapshot", "snapshot_date_key",
        "LEFT JOIN dim_product x ON f.product_key = x.product_key", "x.product_category",
    ),
    "purchase_orders": (
        "fact_purchase_order_line", "order_date_key",
        "LEFT JOIN dim_supplier x ON f.supplier_key = x.supplier_key", "x.supplier_tier",
    ),
    "shipments": (
        "fact_shipment", "ship_date_key",
        "LEFT JOIN dim_facility x ON f.facility_key = x.facility_key", "x.region_code",
    ),
    "supplier": ("dim_supplier", None, "", "f.supplier_tier"),
    "asset_daily_status": (
        "fact_asset_daily_status", "status_date_key",
        "LEFT JOIN dim_asset x ON f.asset_key = x.asset_key", "x.criticality",
    ),
    "asset": ("dim_asset", None, "", "f.asset_type"),
    "employee": ("dim_employee", None, "", "f.department"),
    "technician": ("dim_technician", None, "", "f.specialty"),
    "work_order_parts": (
        "fact_work_order_part", "opened_date_key",
        "LEFT JOIN dim_product x ON f.product_key = x.product_key", "x.product_category",
    ),
    "work_orders": (
        "fact_work_order", "opened_date_key",
        "LEFT JOIN dim_technician x ON f.technician_key = x.technician_key", "x.specialty",
    ),
}


def n(condition: str | None = None) -> str:
    counted = "count(*)" if condition is None else f"count(*) FILTER ({condition})"
    return f"nullif({counted}, 0)"


def div(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"


def money_sum(column: str) -> str:
    return f"CAST(sum(f.{column}) AS DOUBLE)"


def int_sum(column: str) -> str:
    return f"CAST(sum(f.{column}) AS BIGINT)"


def exact(column: str) -> str:
    return f"sum(f.{column})"


def count_distinct(column: str) -> str:
    """Distinct values, the blank counted as one."""
    return (
        f"nullif(count(DISTINCT f.{column}) + CAST(count(*) > count(f.{column}) AS BIGINT), 0)"
    )


def average(column: str) -> str:
    return div(f"sum(f.{column})", f"count(f.{column})")


DONE = "f.work_order_status = 'Completed'"
IN_TARGET = (
    f"{DONE} AND date_diff('day', f.opened_date, f.resolved_date) <= "
    "CASE f.priority WHEN 'Critical' THEN 2 WHEN 'High' THEN 3 ELSE 5 END"
)
CLOSED = "f.purchase_order_status IS DISTINCT FROM 'Open'"
BLANK_DAY = "DATE '0001-01-01'"
DELIVERED = "f.shipment_status = 'Delivered'"

# measure → (home, expression, date key other than the active one)
MEASURES = {
    "n_customers_created": ("customer", n(), "created_on_key"),
    "n_customers_modified": ("customer", n(), "modified_on_key"),
    "n_orders": ("orders", n(), None),
    "n_open_orders": ("orders", n("f.order_status = 'Open'"), None),
    "n_completed_orders": ("orders", n("f.order_status = 'Completed'"), None),
    "average_order_value": ("orders", average("order_revenue"), None),
    "cancellation_rate": ("orders", div(n("f.order_status = 'Cancelled'"), n()), None),
    "n_orders_by_requested_date": ("orders", n(), "requested_date_key"),
    "n_products_created": ("product", n(), "created_on_key"),
    "n_products_modified": ("product", n(), "modified_on_key"),
    "total_revenue": ("sales", money_sum("line_revenue"), None),
    "total_cost": ("sales", money_sum("line_cost"), None),
    "gross_margin": ("sales", "CAST(sum(f.line_revenue) - sum(f.line_cost) AS DOUBLE)", None),
    "gross_margin_pct": (
        "sales", div("(sum(f.line_revenue) - sum(f.line_cost))", exact("line_revenue")), None,
    ),
    "units_sold": ("sales", money_sum("quantity"), None),
    "n_sales_lines": ("sales", n(), None),
    "n_orders_with_sales": ("sales", count_distinct("sales_order_key"), None),
    "average_selling_price": ("sales", div(exact("line_revenue"), exact("quantity")), None),
    "total_revenue_by_requested_date": ("sales", money_sum("line_revenue"), "requested_date_key"),
    "units_sold_by_requested_date": ("sales", money_sum("quantity"), "requested_date_key"),
    "n_facilities_created": ("facility", n(), "created_on_key"),
    "n_facilities_modified": ("facility", n(), "modified_on_key"),
    "quantity_on_hand": ("inventory", money_sum("quantity_on_hand"), None),
    "allocated_quantity": ("inventory", int_sum("quantity_allocated"), None),
    "available_quantity": (
        "inventory", "CAST(sum(f.quantity_on_hand) - sum(f.quantity_allocated) AS DOUBLE)", None,
    ),
    "inventory_value": ("inventory", money_sum("inventory_value"), None),
    "n_stockout_snapshots": ("inventory", n("f.stockout_flag"), None),
    "stockout_rate": ("inventory", div(n("f.stockout_flag"), n()), None),
    "purchased_value": ("purchase_orders", money_sum("purchased_value"), None),
    "n_purchase_orders": ("purchase_orders", count_distinct("purchase_order_id"), None),
    "total_ordered_quantity": ("purchase_orders", money_sum("ordered_quantity"), None),
    "total_received_quantity": ("purchase_orders", money_sum("received_quantity"), None),
    "supplier_fill_rate": (
        "purchase_orders", div(exact("received_quantity"), exact("ordered_quantity")), None,
    ),
    "on_time_receipt_rate": (
        "purchase_orders",
        div(n(f"{CLOSED} AND coalesce(f.received_date, {BLANK_DAY}) <= coalesce(f.expected_date, {BLANK_DAY})"), n(CLOSED)), None,
    ),
    "n_purchase_orders_by_expected_date": (
        "purchase_orders", count_distinct("purchase_order_id"), "expected_date_key",
    ),
    "n_purchase_orders_by_received_date": (
        "purchase_orders", count_distinct("purchase_order_id"), "received_date_key",
    ),
    "n_shipments": ("shipments", n(), None),
    "n_delivered_shipments": ("shipments", n(DELIVERED), None),
    "on_time_delivery_rate": (
        "shipments",
        div(n(f"{DELIVERED} AND coalesce(f.actual_delivery_date, {BLANK_DAY}) <= "
            f"coalesce(f.promised_delivery_date, {BLANK_DAY})"), n(DELIVERED)),
        None,
    ),
    "freight_cost": ("shipments", money_sum("freight_cost"), None),
    "quality_hold_rate": ("shipments", div(n("f.quality_hold"), n()), None),
    "n_shipments_by_promised_delivery_date": ("shipments", n(), "promised_delivery_date_key"),
    "n_shipments_by_actual_delivery_date": ("shipments", n(), "actual_delivery_date_key"),
    "n_shipments_by_order_date": ("shipments", n(), "order_date_key"),
    "n_shipments_by_requested_date": ("shipments", n(), "requested_date_key"),
    "n_supplier_contracts_started": ("supplier", n(), "contract_start_date_key"),
    "n_suppliers_created": ("supplier", n(), "created_on_key"),
    "n_suppliers_modified": ("supplier", n(), "modified_on_key"),
    "operating_hours": ("asset_daily_status", money_sum("operating_hours"), None),
    "downtime_hours": ("asset_daily_status", money_sum("downtime_hours"), None),
    "asset_availability": (
        "asset_daily_status",
        div("sum(f.operating_hours)", "(sum(f.operating_hours) + sum(f.downtime_hours))"), None,
    ),
    "average_health_score": ("asset_daily_status", average("health_score"), None),
    "average_temperature_celsius": ("asset_daily_status", average("temperature_c"), None),
    "n_alerts": ("asset_daily_status", int_sum("alert_count"), None),
    "n_assets_installed": ("asset", n(), "install_date_key"),
    "n_asset_warranties_expiring": ("asset", n(), "warranty_expiry_key"),
    "n_assets_created": ("asset", n(), "created_on_key"),
    "n_assets_modified": ("asset", n(), "modified_on_key"),
    "n_employees_hired": ("employee", n(), "hire_date_key"),
    "n_employees_created": ("employee", n(), "created_on_key"),
    "n_employees_modified": ("employee", n(), "modified_on_key"),
    "n_technician_certifications_expiring": ("technician", n(), "certification_expiry_key"),
    "n_technicians_created": ("technician", n(), "created_on_key"),
    "n_technicians_modified": ("technician", n(), "modified_on_key"),
    "parts_cost": ("work_order_parts", money_sum("part_cost"), None),
    "parts_used": ("work_order_parts", money_sum("quantity_used"), None),
    "n_work_order_part_lines": ("work_order_parts", n(), None),
    "n_work_order_part_lines_by_resolved_date": ("work_order_parts", n(), "resolved_date_key"),
    "n_work_orders": ("work_orders", n(), None),
    "n_open_work_orders": (
        "work_orders", n("f.work_order_status IN ('Open', 'Waiting for Parts')"), None,
    ),
    "n_completed_work_orders": ("work_orders", n(DONE), None),
    "labor_cost": ("work_orders", money_sum("labor_cost"), None),
    "service_duration_hours": ("work_orders", money_sum("duration_hours"), None),
    "mean_time_to_repair_hours": (
        "work_orders",
        div(f"sum(f.duration_hours) FILTER ({DONE})", n(f"{DONE} AND f.duration_hours IS NOT NULL")), None,
    ),
    "service_level_compliance": ("work_orders", div(n(IN_TARGET), n(DONE)), None),
    "n_resolved_work_orders": ("work_orders", n(DONE), "resolved_date_key"),
}

# Measures of dimensions without a date of their own: every year shows the same value.
TIMELESS = {
    "n_active_customers": ("customer", "f.status = 'Active'"),
    "n_active_suppliers": ("supplier", "f.status = 'Active'"),
    "n_assets": ("asset", "true"),
    "n_critical_assets": ("asset", "f.criticality = 'Critical'"),
    "n_assets_out_of_service": ("asset", "f.status = 'Out of Service'"),
    "n_active_employees": ("employee", "f.status = 'Active'"),
    "n_active_technicians": ("technician", "f.status = 'Active'"),
}


def _dated(measure: str) -> str:
    home, value, role = MEASURES[measure]
    table, active, join, attribute = HOMES[home]
    return with_star(
        f"SELECT d.calendar_year, d.calendar_month, {attribute}, {value} AS {measure} "
        f"FROM {table} f LEFT JOIN dim_date d ON f.{role or active} = d.date_key {join} GROUP BY 1, 2, 3"
    )


def _timeless(measure: str) -> str:
    home, condition = TIMELESS[measure]
    table, _, _, attribute = HOMES[home]
    return with_star(
        f"SELECT calendar_year, v.* FROM (SELECT DISTINCT calendar_year FROM dim_date) CROSS JOIN "
        f"(SELECT {attribute}, {n(condition)} AS {measure} FROM {table} f GROUP BY 1) v"
    )


def _bridge(measure: str, condition: str | None) -> str:
    return with_star(
        f"SELECT supplier_tier, product_category, {n(condition)} AS {measure} FROM bridge_supplier_product f "
        "LEFT JOIN dim_supplier s ON f.supplier_key = s.supplier_key "
        "LEFT JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1, 2"
    )


MONTHLY = (
    "SELECT d.calendar_year AS y, d.calendar_month AS m, x.customer_segment AS s, sum(f.line_revenue) AS v "
    "FROM fact_sales_order_line f JOIN dim_date d ON f.order_date_key = d.date_key "
    "LEFT JOIN dim_customer x ON f.customer_key = x.customer_key GROUP BY 1, 2, 3"
)
# A dense grid of months; the running total; months before the first sale of a year are blank.
YTD = with_star(
    "SELECT g.y AS calendar_year, g.m AS calendar_month, g.s AS customer_segment, "
    "CAST(sum(monthly.v) AS DOUBLE) AS total_revenue_ytd "
    "FROM (SELECT DISTINCT y, s, CAST(mm AS INTEGER) AS m FROM monthly, range(1, 13) r(mm)) g "
    "JOIN monthly ON monthly.y = g.y AND monthly.s IS NOT DISTINCT FROM g.s AND monthly.m <= g.m "
    "GROUP BY 1, 2, 3",
    monthly=MONTHLY,
)
LY = with_star(
    "SELECT CAST(y + 1 AS INTEGER) AS calendar_year, m AS calendar_month, s AS customer_segment, "
    "CAST(v AS DOUBLE) AS total_revenue_ly FROM monthly "
    "WHERE y + 1 IN (SELECT calendar_year FROM dim_date)",
    monthly=MONTHLY,
)


def measure_sql() -> dict[str, str]:
    found = {f"m_{name}": _dated(name) for name in MEASURES}
    found |= {f"m_{name}": _timeless(name) for name in TIMELESS}
    for name in ("n_customers_created", "n_customers_modified", "n_products_created", "n_products_modified"):
        found[f"m_{name}_supply_chain"] = found[f"m_{name}_service"] = _dated(name)
    for name in ("n_facilities_created", "n_facilities_modified"):
        found[f"m_{name}_service"] = _dated(name)
    found["m_n_supplier_product_assignments"] = _bridge("n_supplier_product_assignments", None)
    found["m_n_preferred_assignments"] = _bridge("n_preferred_assignments", "f.preferred_supplier")
    found["m_total_revenue_ytd"] = YTD
    found["m_total_revenue_ly"] = LY
    return found
