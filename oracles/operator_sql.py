"""SQL of every operator query."""

from __future__ import annotations

from oracles.measure_sql import CLOSED, IN_TARGET, div, n
from oracles.star_sql import (
    AS_OF,
    CHANNEL as CHANNEL_NUMBER,
    DATES,
    DECIMALS,
    dim_id,
    key,
    money,
    pad,
    plus_months,
    shown,
    with_star,
)

GOLD = [
    "dim_customer", "dim_product", "dim_supplier", "dim_facility", "dim_employee", "dim_technician",
    "dim_asset", "dim_sales_channel", "fact_sales_order", "fact_sales_order_line",
    "bridge_supplier_product", "fact_purchase_order_line", "fact_shipment", "fact_inventory_snapshot",
    "fact_work_order", "fact_work_order_part", "fact_asset_daily_status",
]
LOADED = "'2024-01-31 06:00:00'"
SALES_DATE = "LEFT JOIN dim_date d ON f.order_date_key = d.date_key"
SALES_CUSTOMER = "LEFT JOIN dim_customer c ON f.customer_key = c.customer_key"
SALES_PRODUCT = "LEFT JOIN dim_product p ON f.product_key = p.product_key"
SALES_CHANNEL = "LEFT JOIN dim_sales_channel h ON f.sales_channel_key = h.sales_channel_key"
MARGIN = "(sum(f.line_revenue) - sum(f.line_cost))"
REVENUE = "CAST(sum(f.line_revenue) AS DOUBLE)"
MARGIN_PCT = div(MARGIN, "sum(f.line_revenue)")
PRICE = div("sum(f.line_revenue)", "sum(f.quantity)")


def union(selects: list[str]) -> str:
    return with_star("\nUNION ALL\n".join(selects))


PRICED = "lines l JOIN dim_product p ON l.l_partkey = p.product_key"

STAR_JOIN = with_star(
    f"SELECT calendar_year, region_code, product_category, channel_group, {REVENUE} AS total_revenue, "
    f"CAST({MARGIN} AS DOUBLE) AS gross_margin, {MARGIN_PCT} AS gross_margin_pct, "
    "count(DISTINCT f.sales_order_key) AS n_orders_with_sales "
    f"FROM fact_sales_order_line f {SALES_DATE} {SALES_CUSTOMER} {SALES_PRODUCT} {SALES_CHANNEL} "
    "GROUP BY 1, 2, 3, 4"
)


def _star(fact: str, date: str | None, joins: dict[str, str], keys: list[str], values: str) -> str:
    """Measures of one fact by attributes; ``joins`` maps alias to (table, fact key, its key)."""
    on = " ".join(
        f"LEFT JOIN {table} {alias} ON f.{child} = {alias}.{parent}"
        for alias, (table, child, parent) in joins.items()
    )
    day = f"LEFT JOIN dim_date d ON f.{date} = d.date_key" if date else ""
    groups = ", ".join(str(i + 1) for i in range(len(keys)))
    return with_star(f"SELECT {', '.join(keys)}, {values} FROM {fact} f {day} {on} GROUP BY {groups}")


CUSTOMER = ("dim_customer", "customer_key", "customer_key")
PRODUCT = ("dim_product", "product_key", "product_key")
FACILITY = ("dim_facility", "facility_key", "facility_key")
SUPPLIER = ("dim_supplier", "supplier_key", "supplier_key")
CHANNEL = ("dim_sales_channel", "sales_channel_key", "sales_channel_key")
ASSET = ("dim_asset", "asset_key", "asset_key")
TECHNICIAN = ("dim_technician", "technician_key", "technician_key")


def star_sql() -> dict[str, str]:
    delivered = "f.shipment_status = 'Delivered'"
    in_time = f"{delivered} AND f.actual_delivery_date <= f.promised_delivery_date"
    done = "f.work_order_status = 'Completed'"
    return {
        "star_orders": _star(
            "fact_sales_order", "order_date_key", {"c": CUSTOMER, "h": CHANNEL},
            ["calendar_year", "country_code", "sales_channel_name"],
            f"count(*) AS n_orders, {div('sum(f.order_revenue)', 'count(f.order_revenue)')} AS average_order_value",
        ),
        "star_purchases": _star(
            "fact_purchase_order_line", "order_date_key", {"s": SUPPLIER, "p": PRODUCT, "x": FACILITY},
            ["calendar_year", "supplier_tier", "product_category", "facility_type"],
            "CAST(sum(purchased_value) AS DOUBLE) AS purchased_value, "
            "count(DISTINCT purchase_order_id) AS n_purchase_orders, "
            f"{div('sum(received_quantity)', 'sum(ordered_quantity)')} AS supplier_fill_rate, "
            f"{div(n(CLOSED + ' AND f.received_date <= f.expected_date'), n(CLOSED))} AS on_time_receipt_rate",
        ),
        "star_shipments": _star(
            "fact_shipment", "ship_date_key", {"x": FACILITY, "c": CUSTOMER, "h": CHANNEL},
            ["calendar_year", "x.region_code", "customer_segment", "channel_group"],
            "count(*) AS n_shipments, CAST(sum(freight_cost) AS DOUBLE) AS freight_cost, "
            f"{div(n(in_time), n(delivered))} AS on_time_delivery_rate, "
            f"{div(n('f.quality_hold'), n())} AS quality_hold_rate",
        ),
        "star_inventory": _star(
            "fact_inventory_snapshot", "snapshot_date_key", {"p": PRODUCT, "x": FACILITY},
            ["calendar_year", "product_family", "facility_type"],
            "CAST(sum(quantity_on_hand) - sum(quantity_allocated) AS DOUBLE) AS available_quantity, "
            "CAST(sum(inventory_value) AS DOUBLE) AS inventory_value, "
            f"{div(n('f.stockout_flag'), n())} AS stockout_rate",
        ),
        "star_assignments": _star(
            "bridge_supplier_product", None, {"s": SUPPLIER, "p": PRODUCT},
            ["supplier_tier", "product_category"],
            f"{n()} AS n_supplier_product_assignments, {n('f.preferred_supplier')} AS n_preferred_assignments",
        ),
        "star_work_orders": _star(
            "fact_work_order", "opened_date_key",
            {"a": ASSET, "t": TECHNICIAN, "c": CUSTOMER, "x": FACILITY, "p": PRODUCT},
            ["calendar_year", "asset_type", "specialty", "customer_segment", "facility_type", "product_category"],
            "count(*) AS n_work_orders, "
            f"{div(f'sum(f.duration_hours) FILTER ({done})', n(done))} AS mean_time_to_repair_hours, "
            f"{div(n(IN_TARGET), n(done))} AS service_level_compliance",
        ),
        "star_work_order_parts": _star(
            "fact_work_order_part", "opened_date_key",
            {
                "a": ASSET, "t": TECHNICIAN, "c": CUSTOMER, "x": FACILITY, "q": PRODUCT,
                "p": ("dim_product", "asset_product_key", "product_key"),
            },
            ["calendar_year", "asset_type", "skill_level", "risk_tier", "facility_type",
             "q.critical_spare", "p.product_category"],
            "CAST(sum(part_cost) AS DOUBLE) AS parts_cost, CAST(sum(quantity_used) AS DOUBLE) AS parts_used, "
            "count(*) AS n_work_order_part_lines",
        ),
        "star_asset_status": _star(
            "fact_asset_daily_status", "status_date_key", {"a": ASSET, "c": CUSTOMER, "x": FACILITY, "p": PRODUCT},
            ["CAST(full_date AS VARCHAR) AS full_date", "criticality", "customer_segment", "facility_type",
             "product_category"],
            div("sum(f.operating_hours)", "(sum(f.operating_hours) + sum(f.downtime_hours))")
            + f" AS asset_availability, {div('sum(f.health_score)', 'count(f.health_score)')} "
            "AS average_health_score, CAST(sum(f.alert_count) AS BIGINT) AS n_alerts",
        ),
        "star_technicians": _star(
            "dim_technician", None, {"e": ("dim_employee", "employee_key", "employee_key")},
            ["department", "specialty"], f"{n('f.status = ' + repr('Active'))} AS n_active_technicians",
        ),
    }


def _dates_of_shipments() -> str:
    names = {
        "n_shipments": "ship_date_key",
        "n_shipments_by_promised_delivery_date": "promised_delivery_date_key",
        "n_shipments_by_actual_delivery_date": "actual_delivery_date_key",
        "n_shipments_by_order_date": "order_date_key",
        "n_shipments_by_requested_date": "requested_date_key",
    }
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS role, {column} AS k FROM fact_shipment" for name, column in names.items()
    )
    values = ", ".join(f"nullif(count(*) FILTER (role = '{name}'), 0) AS {name}" for name in names)
    return with_star(
        f"SELECT calendar_year, calendar_quarter, {values} FROM ({parts}) LEFT JOIN dim_date ON k = date_key "
        "GROUP BY 1, 2"
    )


def _full_outer(left: str, right: str, keys: list[str], values: list[str]) -> str:
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    shown_keys = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)
    return f"SELECT {shown_keys}, {', '.join(values)} FROM ({left}) a FULL OUTER JOIN ({right}) b ON {on}"


def _drill_across() -> str:
    def by(fact: str, date: str, values: str) -> str:
        return (
            f"SELECT d.calendar_year, d.calendar_month, x.region_code, {values} FROM {fact} f "
            f"LEFT JOIN dim_date d ON f.{date} = d.date_key "
            "LEFT JOIN dim_facility x ON f.facility_key = x.facility_key GROUP BY 1, 2, 3"
        )

    keys = ["calendar_year", "calendar_month", "region_code"]
    buying = by(
        "fact_purchase_order_line", "order_date_key",
        "CAST(sum(purchased_value) AS DOUBLE) AS purchased_value, "
        "count(DISTINCT purchase_order_id) AS n_purchase_orders",
    )
    shipping = by(
        "fact_shipment", "ship_date_key",
        "count(*) AS n_shipments, CAST(sum(freight_cost) AS DOUBLE) AS freight_cost",
    )
    stock = by(
        "fact_inventory_snapshot", "snapshot_date_key",
        "CAST(sum(inventory_value) AS DOUBLE) AS inventory_value, "
        f"{div(n('f.stockout_flag'), n())} AS stockout_rate",
    )
    first = _full_outer(
        buying, shipping, keys, ["purchased_value", "n_purchase_orders", "n_shipments", "freight_cost"]
    )
    return with_star(
        _full_outer(
            first, stock, keys,
            ["purchased_value", "n_purchase_orders", "n_shipments", "freight_cost",
             "inventory_value", "stockout_rate"],
        )
    )


def _drill_across_sales() -> str:
    def by(fact: str, values: str) -> str:
        return (
            f"SELECT d.calendar_year, h.sales_channel_name, {values} FROM {fact} f {SALES_DATE} "
            f"{SALES_CHANNEL} GROUP BY 1, 2"
        )

    orders = by(
        "fact_sales_order",
        f"count(*) AS n_orders, {div('sum(f.order_revenue)', 'count(f.order_revenue)')} AS average_order_value",
    )
    sales = by(
        "fact_sales_order_line", f"{REVENUE} AS total_revenue, {MARGIN_PCT} AS gross_margin_pct"
    )
    return with_star(
        _full_outer(
            orders, sales, ["calendar_year", "sales_channel_name"],
            ["n_orders", "average_order_value", "total_revenue", "gross_margin_pct"],
        )
    )


def _drill_across_service() -> str:
    def by(fact: str, product: str, values: str) -> str:
        return (
            f"SELECT a.criticality, p.product_category, {values} FROM {fact} f "
            "LEFT JOIN dim_asset a ON f.asset_key = a.asset_key "
            f"LEFT JOIN dim_product p ON f.{product} = p.product_key GROUP BY 1, 2"
        )

    keys = ["criticality", "product_category"]
    jobs = by(
        "fact_work_order", "product_key",
        "count(*) AS n_work_orders, CAST(sum(f.labor_cost) AS DOUBLE) AS labor_cost",
    )
    parts = by(
        "fact_work_order_part", "asset_product_key", "CAST(sum(f.part_cost) AS DOUBLE) AS parts_cost"
    )
    status = by(
        "fact_asset_daily_status", "product_key",
        div("sum(f.operating_hours)", "(sum(f.operating_hours) + sum(f.downtime_hours))")
        + " AS asset_availability, CAST(sum(f.alert_count) AS BIGINT) AS n_alerts",
    )
    first = _full_outer(jobs, parts, keys, ["n_work_orders", "labor_cost", "parts_cost"])
    return with_star(
        _full_outer(
            first, status, keys,
            ["n_work_orders", "labor_cost", "parts_cost", "asset_availability", "n_alerts"],
        )
    )


def _sales_dashboard() -> str:
    def by(fact: str, role: str, values: str) -> str:
        return (
            f"SELECT d.calendar_year AS y, d.calendar_month AS m, c.customer_segment AS s, {values} FROM {fact} f "
            f"LEFT JOIN dim_date d ON f.{role} = d.date_key {SALES_CUSTOMER} GROUP BY 1, 2, 3"
        )

    frames = {
        "o": by(
            "fact_sales_order", "order_date_key",
            f"{n()} AS n_orders, {n(chr(39).join(['f.order_status = ', 'Open', '']))} AS n_open_orders, "
            f"{n(chr(39).join(['f.order_status = ', 'Completed', '']))} AS n_completed_orders, "
            f"{div('sum(f.order_revenue)', 'count(f.order_revenue)')} AS average_order_value, "
            f"{div(n(chr(39).join(['f.order_status = ', 'Cancelled', ''])), n())} AS cancellation_rate",
        ),
        "oq": by("fact_sales_order", "requested_date_key", f"{n()} AS n_orders_by_requested_date"),
        "l": by(
            "fact_sales_order_line", "order_date_key",
            f"{REVENUE} AS total_revenue, CAST(sum(f.line_cost) AS DOUBLE) AS total_cost, "
            f"CAST({MARGIN} AS DOUBLE) AS gross_margin, {MARGIN_PCT} AS gross_margin_pct, "
            f"CAST(sum(f.quantity) AS DOUBLE) AS units_sold, {n()} AS n_sales_lines, "
            f"count(DISTINCT f.sales_order_key) AS n_orders_with_sales, {PRICE} AS average_selling_price",
        ),
        "lq": by(
            "fact_sales_order_line", "requested_date_key",
            f"{REVENUE} AS total_revenue_by_requested_date, "
            "CAST(sum(f.quantity) AS DOUBLE) AS units_sold_by_requested_date",
        ),
        "ytd": "SELECT calendar_year AS y, calendar_month AS m, customer_segment AS s, total_revenue_ytd "
        "FROM ytd_rows",
        "ly": "SELECT calendar_year AS y, calendar_month AS m, customer_segment AS s, total_revenue_ly "
        "FROM ly_rows",
    }
    spine = " UNION ".join(f"SELECT y, m, s FROM ({f}) {a}_spine" for a, f in frames.items())
    joins = " ".join(
        f"LEFT JOIN ({f}) {a} ON {a}.y IS NOT DISTINCT FROM k.y AND {a}.m IS NOT DISTINCT FROM k.m "
        f"AND {a}.s IS NOT DISTINCT FROM k.s"
        for a, f in frames.items()
    )
    values = ", ".join(f"{a}.* EXCLUDE (y, m, s)" for a in frames)
    monthly = (
        f"SELECT d.calendar_year AS y, d.calendar_month AS m, c.customer_segment AS s, sum(f.line_revenue) AS v "
        f"FROM fact_sales_order_line f {SALES_DATE} {SALES_CUSTOMER} GROUP BY 1, 2, 3"
    )
    ytd = (
        "SELECT g.y AS calendar_year, g.m AS calendar_month, g.s AS customer_segment, "
        "CAST(sum(monthly.v) AS DOUBLE) AS total_revenue_ytd "
        "FROM (SELECT DISTINCT y, s, CAST(mm AS INTEGER) AS m FROM monthly, range(1, 13) r(mm)) g "
        "JOIN monthly ON monthly.y = g.y AND monthly.s IS NOT DISTINCT FROM g.s AND monthly.m <= g.m "
        "GROUP BY 1, 2, 3"
    )
    ly = (
        "SELECT CAST(y + 1 AS INTEGER) AS calendar_year, m AS calendar_month, s AS customer_segment, "
        "CAST(v AS DOUBLE) AS total_revenue_ly FROM monthly"
    )
    return with_star(
        f"SELECT k.y AS calendar_year, k.m AS calendar_month, k.s AS customer_segment, {values} "
        f"FROM ({spine}) k {joins}",
        monthly=monthly, ytd_rows=ytd, ly_rows=ly,
    )


def _levels(columns: list[str], values: str, fact: str, joins: str, by: list[str]) -> str:
    """One grouping after another, each from the rows themselves."""
    selects = []
    for depth in range(len(columns) + 1):
        kept = columns[:depth]
        labels = by + [c if c in kept else f"NULL AS {c}" for c in columns]
        keys = ", ".join(by + kept)
        selects.append(
            f"SELECT {', '.join(labels)}, {depth} AS level, {values} FROM {fact} f {joins} "
            + (f"GROUP BY {keys}" if keys else "")
        )
    return union(selects)


DAILY = (
    f"SELECT d.full_date AS day, sum(f.line_revenue) AS v FROM fact_sales_order_line f {SALES_DATE} GROUP BY 1"
)
QUARTERLY = (
    "SELECT d.calendar_year AS y, d.calendar_quarter AS q, p.product_category AS s, sum(f.line_revenue) AS v "
    f"FROM fact_sales_order_line f {SALES_DATE} {SALES_PRODUCT} GROUP BY 1, 2, 3"
)


def _quarterly() -> str:
    ytd = (
        "SELECT g.y, g.q, g.s, CAST(sum(r.v) AS DOUBLE) AS total_revenue_ytd "
        "FROM (SELECT DISTINCT y, s, CAST(qq AS INTEGER) AS q FROM quarters, range(1, 5) t(qq)) g "
        "JOIN quarters r ON r.y = g.y AND r.s IS NOT DISTINCT FROM g.s AND r.q <= g.q GROUP BY 1, 2, 3"
    )
    ly = "SELECT CAST(y + 1 AS INTEGER) AS y, q, s, CAST(v AS DOUBLE) AS total_revenue_ly FROM quarters"
    return with_star(
        "SELECT y AS calendar_year, q AS calendar_quarter, s AS product_category, total_revenue_ytd, "
        f"total_revenue_ly FROM ({_full_outer(ytd, ly, ['y', 'q', 's'], ['total_revenue_ytd', 'total_revenue_ly'])})",
        quarters=QUARTERLY,
    )


def _ly_daily() -> str:
    moved = (
        "SELECT full_date AS day, v FROM dim_date JOIN daily "
        "ON CAST(full_date - INTERVAL 12 MONTH AS DATE) = daily.day"
    )
    return with_star(
        "SELECT CAST(coalesce(a.day, b.day) AS VARCHAR) AS full_date, CAST(a.v AS DOUBLE) AS total_revenue, "
        f"CAST(b.v AS DOUBLE) AS total_revenue_ly FROM daily a FULL OUTER JOIN ({moved}) b ON a.day = b.day",
        daily=DAILY,
    )


YTD_DAILY = with_star(
    "SELECT CAST(full_date AS VARCHAR) AS full_date, "
    "CAST(sum(v) OVER (PARTITION BY calendar_year ORDER BY full_date) AS DOUBLE) AS total_revenue_ytd "
    "FROM dim_date LEFT JOIN daily ON full_date = day "
    "QUALIFY sum(v) OVER (PARTITION BY calendar_year ORDER BY full_date) IS NOT NULL",
    daily=DAILY,
)

# -- quality -----------------------------------------------------------------

DIM_KEYS = {
    "dim_customer": "customer_key", "dim_product": "product_key", "dim_facility": "facility_key",
    "dim_employee": "employee_key", "dim_technician": "technician_key", "dim_supplier": "supplier_key",
    "dim_sales_channel": "sales_channel_key", "dim_asset": "asset_key",
}
GRAINS = {
    "fact_sales_order": "sales_order_id", "fact_sales_order_line": "sales_order_line_id",
    "fact_purchase_order_line": "purchase_order_line_id", "fact_shipment": "shipment_id",
    "fact_inventory_snapshot": "inventory_snapshot_id", "fact_work_order": "work_order_id",
    "fact_work_order_part": "work_order_part_id", "fact_asset_daily_status": "asset_daily_status_id",
    "bridge_supplier_product": "supplier_product_id",
}
REFERENCES = [
    ("dim_employee", "facility_key", "dim_facility"),
    ("dim_technician", "employee_key", "dim_employee"),
    ("dim_technician", "facility_key", "dim_facility"),
    ("dim_asset", "customer_key", "dim_customer"),
    ("dim_asset", "product_key", "dim_product"),
    ("dim_asset", "facility_key", "dim_facility"),
    ("fact_sales_order", "customer_key", "dim_customer"),
    ("fact_sales_order", "sales_channel_key", "dim_sales_channel"),
    ("fact_sales_order_line", "sales_order_key", "fact_sales_order"),
    ("fact_sales_order_line", "product_key", "dim_product"),
    ("bridge_supplier_product", "supplier_key", "dim_supplier"),
    ("bridge_supplier_product", "product_key", "dim_product"),
    ("fact_purchase_order_line", "supplier_key", "dim_supplier"),
    ("fact_purchase_order_line", "product_key", "dim_product"),
    ("fact_purchase_order_line", "facility_key", "dim_facility"),
    ("fact_shipment", "sales_order_key", "fact_sales_order"),
    ("fact_shipment", "facility_key", "dim_facility"),
    ("fact_inventory_snapshot", "product_key", "dim_product"),
    ("fact_inventory_snapshot", "facility_key", "dim_facility"),
    ("fact_work_order", "asset_key", "dim_asset"),
    ("fact_work_order", "technician_key", "dim_technician"),
    ("fact_work_order_part", "work_order_key", "fact_work_order"),
    ("fact_work_order_part", "product_key", "dim_product"),
    ("fact_asset_daily_status", "asset_key", "dim_asset"),
]
DATE_KEYS = [
    ("fact_sales_order", "order_date_key"), ("fact_sales_order", "requested_date_key"),
    ("fact_sales_order_line", "order_date_key"), ("fact_sales_order_line", "requested_date_key"),
    ("fact_purchase_order_line", "order_date_key"), ("fact_purchase_order_line", "expected_date_key"),
    ("fact_purchase_order_line", "received_date_key"),
    ("fact_shipment", "ship_date_key"), ("fact_shipment", "promised_delivery_date_key"),
    ("fact_shipment", "actual_delivery_date_key"), ("fact_shipment", "order_date_key"),
    ("fact_shipment", "requested_date_key"),
    ("fact_inventory_snapshot", "snapshot_date_key"),
    ("fact_work_order", "opened_date_key"), ("fact_work_order", "resolved_date_key"),
    ("fact_work_order_part", "opened_date_key"), ("fact_work_order_part", "resolved_date_key"),
    ("fact_asset_daily_status", "status_date_key"),
]


def _check(table: str, name: str, counts: str, failed: str, details: str) -> str:
    return (
        f"SELECT 'gold.{table}' AS table_name, '{name}' AS validation_name, "
        f"CASE WHEN {failed} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CAST({failed} AS BIGINT) AS failed_row_count, {details} AS details FROM ({counts})"
    )


def _dup(table: str, column: str) -> str:
    return (
        f"SELECT count(*) FILTER (h > 1) AS dup, coalesce(sum(h) FILTER (k IS NULL), 0) AS nk "
        f"FROM (SELECT {column} AS k, count(*) AS h FROM {table} GROUP BY 1)"
    )


DIM_CHECKS = [
    _check(t, f"unique_nonnull_{k}", _dup(t, k), "(dup + nk)", "'duplicates=' || dup || ', null_keys=' || nk")
    for t, k in DIM_KEYS.items()
]
GRAIN_CHECKS = [
    _check(t, f"grain_unique_{k}", _dup(t, k), "dup", "'repeated_ids=' || dup")
    for t, k in GRAINS.items()
]


def _missing(child: str, column: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT count(*) AS bad FROM {child} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL)"
    )


PARENT_KEYS = {**DIM_KEYS, "fact_sales_order": "sales_order_key", "fact_work_order": "work_order_key"}
REFERENCE_CHECKS = [
    _check(
        child, f"fk_{column}_to_gold.{parent}.{PARENT_KEYS[parent]}",
        _missing(child, column, parent, PARENT_KEYS[parent]), "bad",
        f"'rows whose {column} no {parent} has: ' || bad",
    )
    for child, column, parent in REFERENCES
]
DATE_CHECKS = [
    _check(
        child, f"datekey_{column}_in_dim_date", _missing(child, column, "dim_date", "date_key"), "bad",
        f"'rows whose {column} is no day of the calendar: ' || bad",
    )
    for child, column in DATE_KEYS
]


def _amount(table: str, amount: str, quantity: str, unit: str) -> str:
    return _check(
        table, f"{amount}_correctness",
        f"SELECT count(*) FILTER (coalesce(abs({amount} - {quantity} * {unit}) > 0.005, true)) AS bad FROM {table}",
        "bad", "'decimal_type=true, mismatched_rows=' || bad",
    )


PURCHASED = _amount("fact_purchase_order_line", "purchased_value", "ordered_quantity", "unit_cost")
INVENTORY = _amount("fact_inventory_snapshot", "inventory_value", "quantity_on_hand", "standard_cost")
POSITIVE = _check(
    "fact_sales_order_line", "positive_quantity_and_revenue",
    "SELECT count(*) FILTER (line_revenue <= 0 OR quantity <= 0) AS bad FROM fact_sales_order_line",
    "bad", "'rows_with_nonpositive_quantity_or_revenue=' || bad",
)
NONNEGATIVE = _check(
    "fact_inventory_snapshot", "nonnegative_inventory_quantities",
    "SELECT count(*) FILTER (quantity_on_hand < 0 OR quantity_allocated < 0 OR safety_stock_quantity < 0) "
    "AS bad FROM fact_inventory_snapshot",
    "bad", "'rows_with_negative_inventory_fields=' || bad",
)

# -- load --------------------------------------------------------------------

BRONZE = {
    "facility": ("dim_facility", "nation"), "customer": ("dim_customer", "customer"),
    "product": ("dim_product", "part"), "supplier": ("dim_supplier", "supplier"),
    "employee": ("dim_employee", "customer"), "technician": ("dim_technician", "supplier"),
    "sales_channel": ("dim_sales_channel", "orders"), "asset": ("dim_asset", "orders"),
    "sales_order": ("fact_sales_order", "orders"),
    "sales_order_line": ("fact_sales_order_line", "lineitem"),
    "supplier_product": ("bridge_supplier_product", "lineitem"),
    "purchase_order_line": ("fact_purchase_order_line", "lineitem"),
    "shipment": ("fact_shipment", "lineitem"),
    "inventory_snapshot": ("fact_inventory_snapshot", "lineitem"),
    "work_order": ("fact_work_order", "lineitem"), "work_order_part": ("fact_work_order_part", "lineitem"),
    "asset_daily_status": ("fact_asset_daily_status", "events"), "date": ("dim_date", "calendar"),
}
# Landing tables: their keys, and what a code must be, if it is not null, to have a meaning.
LANDING = {
    "region": (["r_regionkey"], {}), "nation": (["n_nationkey"], {}), "customer": (["c_custkey"], {}),
    "supplier": (["s_suppkey"], {}), "part": (["p_partkey"], {}),
    "orders": (["o_orderkey"], {
        "o_orderstatus": "o_orderstatus IN ('F', 'O', 'P')",
        "o_orderpriority": f"coalesce({CHANNEL_NUMBER.format('o_orderpriority')} BETWEEN 1 AND 5, false)",
    }),
    "lineitem": (["l_orderkey", "l_linenumber"], {
        "l_returnflag": "l_returnflag IN ('A', 'N', 'R')", "l_linestatus": "l_linestatus IN ('F', 'O')",
    }),
    "events": (["event_id"], {}),
}
_KEYS = {
    "facility": "facility_key", "customer": "customer_key", "product": "product_key",
    "supplier": "supplier_key", "employee": "employee_key", "technician": "technician_key",
    "sales_channel": "sales_channel_key", "asset": "asset_key", "date": "date_key",
}


def _told(name: str, table: str, null_key: str, unbound: str, fit: str, keys: str) -> str:
    """Rows of a table by what becomes of them: one row a key stays of those with key and codes."""
    return (
        f"SELECT '{name}' AS table_name, count(*) AS raw_rows, count(*) FILTER ({null_key}) AS null_keys, "
        f"count(*) FILTER (NOT ({null_key}) AND ({unbound})) AS unbound_codes, "
        f"count(*) FILTER ({fit}) - count(DISTINCT {keys}) FILTER ({fit}) AS repeated_rows, "
        f"count(DISTINCT {keys}) FILTER ({fit}) AS conformed_rows FROM {table}"
    )


def _landing(table: str) -> tuple[str, str, str, str]:
    keys, codes = LANDING[table]
    null_key = " OR ".join(f"{k} IS NULL" for k in keys)
    unbound = " OR ".join(f"({c} IS NOT NULL AND NOT ({ok}))" for c, ok in codes.items()) or "false"
    return null_key, unbound, f"NOT ({null_key}) AND NOT ({unbound})", f"({', '.join(keys)})"


CONFORMED_LINES = with_star("SELECT * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate) FROM li")
BRONZE_LOAD = union([
    f"SELECT 'raw.{table}' AS table_name, 'landing.{table}' AS source_system, "
    f"'run-0001' AS pipeline_run_id, count(*) AS row_count FROM {table}"
    for table in LANDING
] + [
    f"SELECT 'bronze.{name}_raw' AS table_name, 'landing.{source}' AS source_system, "
    f"'run-0001' AS pipeline_run_id, count(*) AS row_count FROM {table}"
    for name, (table, source) in BRONZE.items()
])
SILVER_LOAD = union([
    _told(f"conformed.{table}", table, *_landing(table)) for table in LANDING
] + [
    _told(f"silver.{name}", table, f"{k} IS NULL", "false", f"{k} IS NOT NULL", k)
    for name, (table, _) in BRONZE.items()
    for k in [_KEYS.get(name, f"{name}_id")]
])


def _reasons(table: str) -> str:
    keys, codes = LANDING[table]
    null_key, _, fit, both = _landing(table)
    arms = "".join(f" WHEN {c} IS NOT NULL AND NOT ({ok}) THEN 'unbound code: {c}'" for c, ok in codes.items())
    return (
        f"SELECT '{table}' AS table_name, '{table}.parquet' AS source_file, reason AS reject_reason, "
        f"count(*) AS row_count FROM (SELECT CASE WHEN {null_key} THEN 'null key'{arms} END AS reason "
        f"FROM {table}) WHERE reason IS NOT NULL GROUP BY ALL UNION ALL "
        f"SELECT '{table}', '{table}.parquet', 'repeated key', n FROM (SELECT count(*) FILTER ({fit}) "
        f"- count(DISTINCT {both}) FILTER ({fit}) AS n FROM {table}) WHERE n > 0"
    )


QUARANTINE_REPORT = " UNION ALL ".join(map(_reasons, LANDING))
_RECEIVED = (
    "SELECT d.calendar_year AS y, d.calendar_quarter AS q, d.calendar_month AS m, x.supplier_tier AS s, "
    "f.purchase_order_id AS k, f.received_quantity AS u FROM fact_purchase_order_line f "
    "LEFT JOIN dim_date d ON f.received_date_key = d.date_key "
    "LEFT JOIN dim_supplier x ON f.supplier_key = x.supplier_key"
)
DISTINCT_YTD = with_star(
    "SELECT calendar_year, calendar_month, supplier_tier, max(t) AS n_purchase_orders_by_received_date_ytd, "
    "max(n) AS n_purchase_orders_by_received_date FROM ("
    "SELECT g.y AS calendar_year, g.m AS calendar_month, g.s AS supplier_tier, count(DISTINCT r.k) AS t, NULL AS n "
    "FROM (SELECT y, s, unnest(range(min(m), 13)) AS m FROM received WHERE y IS NOT NULL GROUP BY y, s) g "
    "JOIN received r ON r.y = g.y AND r.s IS NOT DISTINCT FROM g.s AND r.m <= g.m GROUP BY 1, 2, 3 "
    "UNION ALL SELECT y, m, s, NULL, count(DISTINCT k) FROM received GROUP BY 1, 2, 3) GROUP BY 1, 2, 3",
    received=_RECEIVED,
)
DISTINCT_LY = with_star(
    "SELECT y + 1 AS calendar_year, s AS supplier_tier, count(DISTINCT k) AS n_purchase_orders_by_received_date_ly, "
    "CAST(sum(u) AS DOUBLE) AS total_received_quantity_ly FROM received "
    "WHERE q IN (1, 2) AND y + 1 IN (SELECT calendar_year FROM dim_date) GROUP BY 1, 2",
    received=_RECEIVED,
)
CLUSTERED = {
    "fact_sales_order_line": ("order_date_key", "sales_order_line_key"),
    "fact_purchase_order_line": ("order_date_key", "purchase_order_line_key"),
    "fact_shipment": ("ship_date_key", "shipment_key"),
    "fact_inventory_snapshot": ("snapshot_date_key", "inventory_snapshot_key"),
    "fact_work_order": ("opened_date_key", "work_order_key"),
    "fact_work_order_part": ("opened_date_key", "work_order_part_key"),
    "fact_asset_daily_status": ("status_date_key", "asset_daily_status_key"),
}
def key_digest(column: str) -> str:
    return f"sum(CAST('0x' || substr(md5(':' || {column}), 1, 15) AS BIGINT) % 1000003)"


CLUSTERED_REWRITE = union([
    f"SELECT '{t}' AS table_name, count(*) AS row_count, min({d}) AS first_date_key, "
    f"max({d}) AS last_date_key, CAST({key_digest(k)} AS BIGINT) AS row_key_digest FROM {t}"
    for t, (d, k) in CLUSTERED.items()
])
CURVE_SCAN = with_star(
    "SELECT product_key, count(*) AS n_lines, CAST(sum(quantity) AS DOUBLE) AS units_sold, "
    f"CAST({key_digest('sales_order_line_key')} AS BIGINT) AS row_key_digest "
    "FROM fact_sales_order_line WHERE product_key BETWEEN 100 AND 199 GROUP BY product_key"
)
GUARDS = union([
    f"SELECT '{child} to {parent}' AS relationship, count(*) AS child_rows, count(*) AS joined_rows, "
    f"(SELECT count(*) - count(DISTINCT {k}) FROM {parent}) AS duplicate_parent_keys, "
    f"count(*) FILTER (f.{k} IS NOT NULL AND f.{k} NOT IN (SELECT {k} FROM {parent})) AS unmatched_rows "
    f"FROM {child} f"
    for child, parent, k in [
        ("fact_sales_order_line", "fact_sales_order", "sales_order_key"),
        ("fact_shipment", "fact_sales_order", "sales_order_key"),
        ("fact_inventory_snapshot", "dim_product", "product_key"),
        ("fact_work_order", "dim_asset", "asset_key"),
        ("fact_work_order_part", "fact_work_order", "work_order_key"),
        ("fact_asset_daily_status", "dim_asset", "asset_key"),
    ]
])


# The five primes of the 64-bit hash.
XX = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)


def _steps(start: str, *steps: str) -> str:
    """Selects over ``h`` (the hash so far, unsigned) and ``k``, each from the one before."""
    for step in steps:
        start = f"(SELECT c_custkey, k, {step} AS h FROM {start})"
    return start


def _mod(product: str) -> str:
    """A product or sum of 64-bit numbers, of which 64 bits stay."""
    return f"CAST(({product}) % 18446744073709551616::UHUGEINT AS UBIGINT)"


def _times(value: str, prime: int) -> str:
    return _mod(f"CAST({value} AS UHUGEINT) * {prime}::UHUGEINT")


def _turned(value: str, bits: int) -> str:
    """Rotated to the left."""
    return _mod(f"CAST({value} AS UHUGEINT) * {1 << bits}::UHUGEINT + CAST({value} AS UHUGEINT) // {1 << 64 - bits}::UHUGEINT")


def _plus(value: str, number: int) -> str:
    return _mod(f"CAST({value} AS UHUGEINT) + {number}::UHUGEINT")


_MIXED = (
    "xor(h, h >> 33)", _times("h", XX[1]), "xor(h, h >> 29)", _times("h", XX[2]), "xor(h, h >> 32)",
)
# A long hashed with seed 42, then an int (the salt) seeded with that.
_SEEDED = (
    "(SELECT c_custkey, CASE WHEN c_custkey < 0 THEN CAST(c_custkey + 18446744073709551616::HUGEINT AS UBIGINT) "
    f"ELSE CAST(c_custkey AS UBIGINT) END AS k, CAST({(42 + XX[4] + 8) % 2**64} AS UBIGINT) AS h FROM customer)"
)
_HASHED = _steps(
    _SEEDED,
    f"xor(h, {_times(_turned(_times('k', XX[1]), 31), XX[0])})",
    _plus(_times(_turned("h", 27), XX[0]), XX[3]),
    *_MIXED,
    _plus("h", XX[4] + 4),
    f"xor(h, {_mod(f'7::UHUGEINT * {XX[0]}::UHUGEINT')})",
    _plus(_times(_turned("h", 23), XX[1]), XX[2]),
    *_MIXED,
)
HASH_BUCKET = (
    "SELECT c_custkey, CAST(((s % 20) + 20) % 20 AS INTEGER) AS bucket FROM (SELECT c_custkey, CASE WHEN h >= "
    "9223372036854775808 THEN CAST(h AS HUGEINT) - 18446744073709551616::HUGEINT ELSE CAST(h AS HUGEINT) END AS s "
    f"FROM {_HASHED})"
)


def thousands(value: str, sign: str = "") -> str:
    return f"format('{sign}{{:,.2f}}', {value})"


FORMATTED = with_star(
    f"SELECT calendar_year, {thousands(REVENUE, '$')} AS total_revenue, "
    f"format('{{:.2f}}%', {MARGIN_PCT} * 100) AS gross_margin_pct, "
    "format('{:,}', CAST(sum(f.quantity) AS BIGINT)) AS units_sold, "
    f"{thousands(PRICE, '$')} AS average_selling_price "
    f"FROM fact_sales_order_line f {SALES_DATE} GROUP BY 1"
)


_SALES_MONTHS = (
    "SELECT d.calendar_year AS y, d.calendar_quarter AS q, d.calendar_month AS m, x.customer_segment AS s, "
    "sum(f.line_revenue) AS v FROM fact_sales_order_line f "
    "LEFT JOIN dim_date d ON f.order_date_key = d.date_key "
    "LEFT JOIN dim_customer x ON f.customer_key = x.customer_key GROUP BY 1, 2, 3, 4"
)


def _period_levels(segment: bool, shift: str, first: int) -> str:
    """Revenue and its shifted form at the total, year, quarter and month, level by level."""
    s = "s" if segment else "NULL"
    grains = [[], ["y"], ["y", "q"], ["y", "q", "m"]]
    parts = []
    for depth, grain in enumerate(grains):
        own = {c: (c if c in grain else "NULL") for c in "yqm"}
        now = (
            f"SELECT {s} AS s, {own['y']} AS y, {own['q']} AS q, {own['m']} AS m, sum(v) AS v, NULL AS w "
            f"FROM months GROUP BY ALL"
        )
        parts.append(f"SELECT s, y, q, m, {depth} AS level, v, w FROM ({now})")
        if depth < first:
            continue
        if shift == "ly":
            moved = now.replace("y AS y", "y + 1 AS y").replace("sum(v) AS v, NULL AS w", "NULL AS v, sum(v) AS w")
            parts.append(
                f"SELECT s, y, q, m, {depth}, v, w FROM ({moved}) WHERE y IN (SELECT calendar_year FROM dim_date)"
            )
        else:
            last = {1: "12", 2: "c.q * 3", 3: "c.m"}[depth]
            cells = {
                1: "SELECT DISTINCT calendar_year AS y, NULL AS q, NULL AS m FROM dim_date",
                2: "SELECT DISTINCT calendar_year AS y, calendar_quarter AS q, NULL AS m FROM dim_date",
                3: "SELECT DISTINCT calendar_year AS y, calendar_quarter AS q, calendar_month AS m FROM dim_date",
            }[depth]
            parts.append(
                f"SELECT {'months.s' if segment else 'NULL'} AS s, c.y, c.q, c.m, {depth}, NULL, sum(months.v) "
                f"FROM ({cells}) c JOIN months ON months.y = c.y AND months.m <= {last} GROUP BY ALL"
            )
    return with_star(
        f"SELECT {'s AS customer_segment, ' if segment else ''}CAST(y AS INTEGER) AS calendar_year, "
        "CAST(q AS INTEGER) AS calendar_quarter, CAST(m AS INTEGER) AS calendar_month, "
        "CAST(level AS INTEGER) AS level, CAST(max(v) AS DOUBLE) AS total_revenue, "
        f"CAST(max(w) AS DOUBLE) AS total_revenue_{shift} FROM ({' UNION ALL '.join(parts)}) "
        f"GROUP BY {'s, ' if segment else ''}y, q, m, level",
        months=_SALES_MONTHS,
    )


def _captioned(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for source, label in columns:
        value = source
        if source in DATES.get(table, []):
            value = f"CAST({source} AS VARCHAR)"
        elif source in DECIMALS.get(table, []):
            value = f"CAST({source} AS DOUBLE)"
        parts.append(f'{value} AS "{label}"')
    return with_star(f"SELECT {', '.join(parts)} FROM {table}")


ORDERS_MODEL = [
    ("sales_order_key", "Sales Order Key"), ("sales_order_id", "Sales Order ID"),
    ("customer_key", "Customer Key"), ("customer_id", "Customer ID"),
    ("sales_channel_key", "Sales Channel Key"), ("sales_channel_id", "Sales Channel ID"),
    ("order_date", "Order Date"), ("requested_date", "Requested Date"),
    ("currency_code", "Currency Code"), ("order_status", "Order Status"),
    ("order_revenue", "Order Revenue"), ("order_cost", "Order Cost"),
    ("gross_margin", "Gross Margin Value"), ("order_date_key", "Order Date Key"),
    ("requested_date_key", "Requested Date Key"),
]
PART_MODEL = [
    ("product_key", "Product Key"), ("product_id", "Product ID"), ("sku", "SKU"),
    ("product_name", "Product Name"), ("product_category", "Product Category"),
    ("product_family", "Product Family"), ("standard_cost", "Standard Cost"),
    ("critical_spare", "Critical Spare"), ("status", "Part Product Status"),
]

DAY = "CAST(o_orderdate AS DATE)"


def operator_sql() -> dict[str, str]:
    found = {
        "flagship": with_star(
            f"SELECT calendar_year, calendar_month, customer_segment, {REVENUE} AS total_revenue, "
            f"{MARGIN_PCT} AS gross_margin_pct, count(DISTINCT f.sales_order_key) AS n_orders_with_sales "
            f"FROM fact_sales_order_line f {SALES_DATE} {SALES_CUSTOMER} GROUP BY 1, 2, 3"
        ),
        "lineage_stamp": f"SELECT o_orderkey, {LOADED} AS ingestion_timestamp, 'run-0001' AS pipeline_run_id, "
        "'landing.orders' AS source_system FROM orders",
        "bronze_load": BRONZE_LOAD,
        "quarantine_report": QUARANTINE_REPORT,
        "silver_load": SILVER_LOAD,
        "gold_load": union([
            f"SELECT 'gold.{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (*GOLD, "dim_date")
        ]),
        "clustered_rewrite": CLUSTERED_REWRITE,
        "compacted_facts": CLUSTERED_REWRITE,
        "curve_clustered_scan": CURVE_SCAN,
        "hash_bucket_assign": HASH_BUCKET,
        "digest_bucket_assign": "SELECT c_custkey, CAST(CAST('0x' || substr(md5('7:' || c_custkey), 1, 15) AS BIGINT) "
        "% 20 AS INTEGER) AS bucket FROM customer",
        "code_lookup": "SELECT o_orderkey, CASE regexp_extract(o_orderpriority, '^([0-9]+)-', 1) WHEN '1' THEN 'Urgent' "
        "WHEN '2' THEN 'High' WHEN '3' THEN 'Medium' WHEN '4' THEN 'Not Specified' WHEN '5' THEN 'Low' END "
        "AS channel_name FROM orders",
        "business_id": f"SELECT o_orderkey, {dim_id('SO', 'o_orderkey')} AS order_id FROM orders",
        "date_key": f"SELECT event_id, {key('ts')} AS event_date_key FROM events",
        "offset_dates": with_star(
            "SELECT line_key, CAST(order_date + 30 AS VARCHAR) AS expected_date, "
            "CAST(ship_date + 2 + l_linenumber AS VARCHAR) AS promised_date, "
            "CAST(ship_date + 2 + l_linenumber + (p_size % 9) - 3 AS VARCHAR) AS actual_date FROM lines"
        ),
        "warranty_expiry": f"SELECT o_orderkey, CAST({plus_months(DAY, 36)} AS VARCHAR) AS warranty_expiry FROM orders",
        "order_status_rule": f"SELECT o_orderkey, CASE WHEN {DAY} > {AS_OF} - 30 THEN 'Open' "
        "WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Completed' END AS order_status FROM orders",
        "purchase_status_rule": with_star(
            "SELECT purchase_order_line_id, purchase_order_status FROM fact_purchase_order_line"
        ),
        "shipment_status_rule": with_star("SELECT shipment_id, shipment_status FROM fact_shipment"),
        "work_order_status_rule": with_star("SELECT work_order_id, work_order_status FROM fact_work_order"),
        "risk_tier_banding": "SELECT c_custkey, CASE WHEN c_acctbal < 2000 THEN 'High' "
        "WHEN c_acctbal < 5000 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM customer",
        "broadcast_price_join": with_star(
            "SELECT line_key, l_partkey AS product_key, CAST(qty AS DOUBLE) AS quantity, "
            f"CAST(p.standard_cost AS DOUBLE) AS standard_cost, CAST(list_price AS DOUBLE) AS list_price FROM {PRICED}"
        ),
        "line_revenue": with_star(
            f"SELECT line_key, CAST({money('qty * list_price * (1 - disc)')} AS DOUBLE) AS line_revenue FROM {PRICED}"
        ),
        "line_cost": with_star(
            f"SELECT line_key, CAST({money('qty * p.standard_cost')} AS DOUBLE) AS line_cost FROM {PRICED}"
        ),
        "unit_cost": with_star(
            "SELECT line_key, CAST("
            + money("p.standard_cost * CAST((85 + l_linenumber) / 100.0 AS DECIMAL(5,4))")
            + f" AS DOUBLE) AS unit_cost FROM {PRICED}"
        ),
        "received_quantity": with_star(
            "SELECT purchase_order_line_id, CAST(ordered_quantity AS DOUBLE) AS ordered_quantity, "
            "CAST(received_quantity AS DOUBLE) AS received_quantity FROM fact_purchase_order_line"
        ),
        "stockout_flag": with_star(
            "SELECT inventory_snapshot_id, safety_stock_quantity, reorder_point, stockout_flag "
            "FROM fact_inventory_snapshot"
        ),
        "work_order_duration": with_star(
            "SELECT work_order_id, CAST(duration_hours AS DOUBLE) AS duration_hours, "
            "CAST(ceil(duration_hours / 24) AS INTEGER) AS days_to_resolve, "
            "CAST(resolved_date AS VARCHAR) AS resolved_date FROM fact_work_order"
        ),
        "labor_cost": with_star(
            "SELECT work_order_id, CAST(labor_cost AS DOUBLE) AS labor_cost FROM fact_work_order"
        ),
        "part_cost": with_star(
            "SELECT work_order_part_id, CAST(quantity_used AS DOUBLE) AS quantity_used, CAST(part_cost AS DOUBLE) AS part_cost FROM fact_work_order_part"
        ),
        "downtime_hours": with_star(
            "SELECT asset_daily_status_id, CAST(operating_hours AS DOUBLE) AS operating_hours, "
            "CAST(downtime_hours AS DOUBLE) AS downtime_hours FROM fact_asset_daily_status"
        ),
        "purchased_value": with_star(
            "SELECT purchase_order_line_id, CAST(purchased_value AS DOUBLE) AS purchased_value "
            "FROM fact_purchase_order_line"
        ),
        "inventory_value": with_star(
            "SELECT inventory_snapshot_id, CAST(standard_cost AS DOUBLE) AS standard_cost, "
            "CAST(inventory_value AS DOUBLE) AS inventory_value FROM fact_inventory_snapshot"
        ),
        "order_gross_margin": with_star(
            "SELECT sales_order_id, CAST(gross_margin AS DOUBLE) AS gross_margin FROM fact_sales_order"
        ),
        "batch_assign": "SELECT event_id, event_id // 3 + 1 AS batch_id, event_id // 4 + 1 AS header_id FROM events",
        "display_name": with_star(
            "SELECT customer_key, concat_ws(' ', customer_segment, country_code, "
            f"{pad('', 'customer_key', 9)}) AS display_name FROM dim_customer"
        ),
        "preferred_supplier": with_star(
            "SELECT product_key, supplier_key, CAST(minimum_order_quantity AS DOUBLE) AS minimum_order_quantity FROM bridge_supplier_product "
            "WHERE preferred_supplier"
        ),
        "order_header_totals": with_star(
            "SELECT o_orderkey, o_orderpriority, CAST(order_revenue AS DOUBLE) AS order_revenue, "
            "CAST(order_cost AS DOUBLE) AS order_cost FROM orders JOIN totals ON o_orderkey = l_orderkey"
        ),
        "safe_left_join": GUARDS,
        "orphan_rows": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders "
        "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)",
        "star_join": STAR_JOIN,
        "far_star_join": STAR_JOIN,
        "filtered_rollup": with_star(
            f"SELECT calendar_year, product_category, {REVENUE} AS total_revenue, "
            f"CAST(sum(quantity) AS DOUBLE) AS units_sold, count(*) AS n_sales_lines "
            f"FROM fact_sales_order_line f {SALES_DATE} {SALES_CUSTOMER} {SALES_PRODUCT} "
            "WHERE customer_segment IN ('BUILDING', 'MACHINERY') AND risk_tier = 'High' "
            "AND calendar_year BETWEEN 1996 AND 1999 AND quantity >= 10 GROUP BY 1, 2"
        ),
        "far_filtered_rollup": with_star(
            f"SELECT calendar_year, product_category, {REVENUE} AS total_revenue, "
            f"CAST(sum(quantity) AS DOUBLE) AS units_sold, count(*) AS n_sales_lines "
            f"FROM fact_sales_order_line f {SALES_DATE} {SALES_CUSTOMER} {SALES_PRODUCT} "
            "WHERE customer_segment IN ('BUILDING', 'MACHINERY') AND risk_tier = 'High' "
            "AND calendar_year BETWEEN 1996 AND 1999 AND quantity >= 10 GROUP BY 1, 2"
        ),
        "filtered_rollup_blank": with_star(
            "SELECT kept, criticality, nullif(sum(alert_count), 0) AS n_alerts FROM ("
            "SELECT 'blank' AS kept, criticality, alert_count FROM fact_asset_daily_status f "
            "LEFT JOIN dim_asset a ON f.asset_key = a.asset_key LEFT JOIN dim_product p "
            "ON f.product_key = p.product_key WHERE p.product_category IS NULL UNION ALL "
            "SELECT 'all but the first', criticality, alert_count FROM fact_asset_daily_status f "
            "LEFT JOIN dim_asset a ON f.asset_key = a.asset_key LEFT JOIN dim_product p "
            "ON f.product_key = p.product_key WHERE p.product_category IS DISTINCT FROM "
            "(SELECT min(product_category) FROM dim_product)) GROUP BY 1, 2"
        ),
        "status_rollup": with_star(
            f"SELECT order_status, count(*) AS n_orders, {n('order_status = ' + repr('Open'))} AS n_open_orders, "
            f"{n('order_status = ' + repr('Completed'))} AS n_completed_orders, "
            f"{div(n('order_status = ' + repr('Cancelled')), n())} AS cancellation_rate "
            "FROM fact_sales_order GROUP BY 1"
        ),
        "date_role_join": _dates_of_shipments(),
        "date_role_switch": with_star(
            "SELECT calendar_year, supplier_tier, CAST(sum(purchased_value) AS DOUBLE) AS purchased_value, "
            f"{div('sum(received_quantity)', 'sum(ordered_quantity)')} AS supplier_fill_rate "
            "FROM fact_purchase_order_line f LEFT JOIN dim_date ON received_date_key = date_key "
            "LEFT JOIN dim_supplier s ON f.supplier_key = s.supplier_key GROUP BY 1, 2"
        ),
        "drill_across": _drill_across(),
        "drill_across_sales": _drill_across_sales(),
        "drill_across_service": _drill_across_service(),
        "snowflake_rollup": with_star(
            f"SELECT department, skill_level, {n()} AS n_work_orders, CAST(sum(f.labor_cost) AS DOUBLE) AS labor_cost, "
            f"{div(n(IN_TARGET), n('f.work_order_status = ' + repr('Completed')))} AS service_level_compliance "
            "FROM fact_work_order f LEFT JOIN dim_technician t ON f.technician_key = t.technician_key "
            "LEFT JOIN dim_employee e ON t.employee_key = e.employee_key GROUP BY 1, 2"
        ),
        "two_role_product": with_star(
            "SELECT p.product_category AS product_product_category, q.product_category AS "
            "part_product_product_category, CAST(sum(part_cost) AS DOUBLE) AS parts_cost, "
            "CAST(sum(quantity_used) AS DOUBLE) AS parts_used FROM fact_work_order_part f "
            "LEFT JOIN dim_product p ON f.asset_product_key = p.product_key "
            "LEFT JOIN dim_product q ON f.product_key = q.product_key GROUP BY 1, 2"
        ),
        "bridge_rollup": with_star(
            f"SELECT region_code, product_family, {n()} AS n_supplier_product_assignments, "
            f"{n('preferred_supplier')} AS n_preferred_assignments FROM bridge_supplier_product f "
            "LEFT JOIN dim_supplier s ON f.supplier_key = s.supplier_key "
            "LEFT JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1, 2"
        ),
        "unrelated_total": with_star(
            "SELECT customer_segment, (SELECT count(*) FROM dim_asset) AS n_assets, "
            "(SELECT count(*) FROM dim_asset WHERE criticality = 'Critical') AS n_critical_assets "
            "FROM (SELECT DISTINCT customer_segment FROM dim_customer)"
        ),
        "order_totals": with_star(
            "SELECT l_orderkey AS sales_order_key, CAST(order_revenue AS DOUBLE) AS order_revenue, "
            "CAST(order_cost AS DOUBLE) AS order_cost, CAST(requested_date AS VARCHAR) AS requested_date FROM totals"
        ),
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
        "GROUP BY 1, 2 HAVING count(*) > 1",
        "duplicate_exists": with_star(
            "SELECT 'lineitem' AS table_name, EXISTS (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber "
            "HAVING count(*) > 1) AS has_duplicates UNION ALL SELECT 'line', EXISTS (SELECT 1 FROM lines "
            "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'customer', "
            "EXISTS (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)"
        ),
        "row_count_audit": union([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in GOLD]),
        "calendar_rollup": _levels(
            ["calendar_year", "calendar_quarter", "calendar_month", "full_date"],
            f"{REVENUE} AS total_revenue, {MARGIN_PCT} AS gross_margin_pct, {PRICE} AS average_selling_price",
            "fact_sales_order_line",
            "LEFT JOIN (SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date) d "
            "ON f.order_date_key = d.date_key",
            [],
        ),
        "distinct_rollup": _levels(
            ["calendar_year", "calendar_quarter", "calendar_month"],
            "count(DISTINCT f.sales_order_key) AS n_orders_with_sales, count(*) AS n_sales_lines",
            "fact_sales_order_line", f"{SALES_DATE} {SALES_PRODUCT}", ["product_category"],
        ),
        "revenue_ytd_daily": YTD_DAILY,
        "revenue_ly_daily": _ly_daily(),
        "revenue_ytd_quarterly": _quarterly(),
        "conform_dedup": CONFORMED_LINES,
        "incremental_conform": CONFORMED_LINES,
        "sorted_month_labels": with_star(
            f"SELECT month_name, calendar_month, {REVENUE} AS total_revenue "
            f"FROM fact_sales_order_line f {SALES_DATE} GROUP BY 1, 2 ORDER BY 2"
        ),
        "calendar_bounds": with_star(
            "SELECT CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date FROM bounds"
        ),
        "calendar_days": with_star("SELECT CAST(full_date AS VARCHAR) AS full_date FROM days"),
        "calendar_refresh": shown("dim_date"),
        "formatted_metrics": FORMATTED,
        "model_orders": _captioned("fact_sales_order", ORDERS_MODEL),
        "model_part_product": _captioned("dim_product", PART_MODEL),
        "ytd_subtotals": _period_levels(True, "ytd", 1),
        "ly_subtotals": _period_levels(False, "ly", 1),
        "subtotals_by_requested_date": _levels(
            ["calendar_year", "calendar_month"],
            f"{n()} AS n_orders, {div('sum(f.order_revenue)', 'count(f.order_revenue)')} AS average_order_value",
            "fact_sales_order", "LEFT JOIN dim_date d ON f.requested_date_key = d.date_key", [],
        ),
        "ly_by_month_name": with_star(
            "SELECT CAST(y + 1 AS INTEGER) AS calendar_year, monthname(make_date(2000, m, 1)) AS month_name, "
            "s AS customer_segment, CAST(sum(v) AS DOUBLE) AS total_revenue_ly FROM months "
            "WHERE y + 1 IN (SELECT calendar_year FROM dim_date) GROUP BY ALL",
            months=_SALES_MONTHS,
        ),
        "ly_of_first_quarter": with_star(
            "SELECT CAST(y + 1 AS INTEGER) AS calendar_year, CAST(sum(v) AS DOUBLE) AS total_revenue_ly FROM months "
            "WHERE m <= 3 AND y + 1 IN (SELECT calendar_year FROM dim_date) GROUP BY ALL",
            months=_SALES_MONTHS,
        ),
        "ytd_to_second_quarter": with_star(
            "SELECT CAST(y AS INTEGER) AS calendar_year, CAST(sum(v) AS DOUBLE) AS total_revenue_ytd FROM months "
            "WHERE m <= 6 GROUP BY ALL",
            months=_SALES_MONTHS,
        ),
        "purchase_orders_ytd": DISTINCT_YTD,
        "purchase_orders_ly_half": DISTINCT_LY,
        "sales_dashboard": _sales_dashboard(),
        "sales_dashboard_stored": _sales_dashboard(),
        "check_unique": with_star(
            _check("line", "unique_line_key", _dup("lines", "line_key"), "dup", "'duplicates=' || dup")
        ),
        "check_dim_keys": union(DIM_CHECKS),
        "check_fact_grain": union(GRAIN_CHECKS),
        "check_foreign_keys": union(REFERENCE_CHECKS),
        "check_date_keys": union(DATE_CHECKS),
        "check_purchased_value": with_star(PURCHASED),
        "check_inventory_value": with_star(INVENTORY),
        "check_positive_sales": with_star(POSITIVE),
        "check_nonneg_inventory": with_star(NONNEGATIVE),
        "validation_summary": union(
            [*DIM_CHECKS, *GRAIN_CHECKS, *REFERENCE_CHECKS, *DATE_CHECKS, PURCHASED, INVENTORY, POSITIVE, NONNEGATIVE]
        ),
        "load_audit": union([
            f"SELECT 'run-0001' AS pipeline_run_id, 'landing' AS scale_profile, 'gold.{t}' AS table_name, "
            f"count(*) AS row_count, {LOADED} AS load_timestamp, 'Succeeded' AS status FROM {t}"
            for t in GOLD
        ]),
    }
    for table in (*GOLD, "dim_date"):
        found[table] = shown(table)
    return found | star_sql()
