"""The star as SQL common table expressions over the landing tables."""

from __future__ import annotations

import re


def pad(prefix: str, value: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({value} AS VARCHAR), {width}, '0')"


def dim_id(prefix: str, value: str) -> str:
    return pad(prefix, value, 12)


def row_id(prefix: str, value: str) -> str:
    return pad(prefix, value, 16)


def pair_id(prefix: str, value: str) -> str:
    return (
        f"'{prefix}' || lpad(split_part({value}, ':', 1), 16, '0') || ':' || split_part({value}, ':', 2)"
    )


def key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def rate(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS DECIMAL(5,4))"


def plus_months(day: str, months: int) -> str:
    return f"CAST({day} + INTERVAL {months} MONTH AS DATE)"


AS_OF = "DATE '2001-08-01'"
CHANNEL = "TRY_CAST(regexp_extract({0}, '^([0-9]+)-', 1) AS BIGINT)"
CRITICALITY = f"""CASE {CHANNEL} WHEN 1 THEN 'Critical' WHEN 2 THEN 'High'
    WHEN 3 THEN 'Medium' ELSE 'Low' END"""


def _pick(value: str, labels: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels))
    return f"CASE {value} {arms} END"


CTES: dict[str, str] = {}

# Rows with a code that has no meaning are rejected.
CTES["bound_orders"] = f"""
SELECT * FROM orders WHERE coalesce(o_orderstatus IN ('F', 'O', 'P'), true)
  AND (o_orderpriority IS NULL OR coalesce({CHANNEL.format('o_orderpriority')} BETWEEN 1 AND 5, false))"""

CTES["li"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
    l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
    l_shipdate NULLS FIRST) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    AND coalesce(l_returnflag IN ('A', 'N', 'R'), true) AND coalesce(l_linestatus IN ('F', 'O'), true))
WHERE rn = 1"""

CTES["lines"] = f"""
SELECT li.l_orderkey || ':' || li.l_linenumber AS line_key, li.l_orderkey, li.l_linenumber, li.l_partkey,
  li.l_suppkey, CAST(l_quantity AS DECIMAL(12,2)) AS qty, {money('l_extendedprice')} AS ext,
  {rate('l_discount')} AS disc, {rate('l_tax')} AS tax, l_returnflag, l_linestatus,
  CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date,
  {CRITICALITY.format('o_orderpriority')} AS priority, {money('p_retailprice')} AS cost,
  p_size, p_partkey IS NOT NULL AS priced, CAST(s_nationkey AS BIGINT) AS facility_key
FROM li LEFT JOIN bound_orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey"""

CTES["places"] = """
SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["supplier_days"] = """
SELECT l_suppkey AS k, min(ship_date) AS lo, max(ship_date) AS hi FROM lines GROUP BY 1"""
CTES["part_days"] = """
SELECT l_partkey AS k, min(ship_date) AS lo, max(ship_date) AS hi FROM lines GROUP BY 1"""

CTES["dim_facility"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS facility_key, {dim_id('FAC', 'n_nationkey')} AS facility_id,
  n_name AS facility_name,
  {_pick('n_nationkey % 3', ['Factory', 'Depot', 'Workshop'])} AS facility_type,
  r_name AS region_code, n_name AS country_code, n_name AS city,
  CAST(1000 + 100 * n_nationkey AS BIGINT) AS capacity_units, 'Active' AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM places LEFT JOIN (SELECT s_nationkey, min(lo) AS lo, max(hi) AS hi
  FROM supplier JOIN supplier_days ON s_suppkey = k GROUP BY 1) ON n_nationkey = s_nationkey"""

CTES["dim_customer"] = f"""
SELECT c_custkey AS customer_key, {dim_id('CUS', 'c_custkey')} AS customer_id, c_name AS customer_name,
  c_mktsegment AS customer_segment, c_mktsegment AS industry, r_name AS region_code,
  n_name AS country_code, n_name AS city, {money('c_acctbal')} AS annual_revenue,
  CASE WHEN {money('c_acctbal')} < 2000 THEN 'High' WHEN {money('c_acctbal')} < 5000 THEN 'Medium'
    ELSE 'Low' END AS risk_tier,
  CASE WHEN {money('c_acctbal')} < 0 THEN 'Inactive' ELSE 'Active' END AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM customer LEFT JOIN places ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
  FROM bound_orders GROUP BY 1) ON c_custkey = o_custkey"""

CTES["dim_product"] = f"""
SELECT p_partkey AS product_key, {dim_id('PRD', 'p_partkey')} AS product_id,
  {dim_id('SKU-', 'p_partkey')} AS sku, p_type AS product_category, p_brand AS product_family,
  p_name AS product_name, {money('p_retailprice')} AS standard_cost,
  {money(money('p_retailprice') + " * CAST('1.25' AS DECIMAL(5,4))")} AS list_price,
  p_size + 5 AS lead_time_days, CAST(p_size AS DECIMAL(12,2)) AS weight_kg,
  p_size >= 40 AS critical_spare,
  CASE WHEN p_size = 1 THEN 'Discontinued' ELSE 'Active' END AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM part LEFT JOIN part_days ON p_partkey = k"""

CTES["dim_supplier"] = f"""
SELECT s_suppkey AS supplier_key, {dim_id('SUP', 's_suppkey')} AS supplier_id, s_name AS supplier_name,
  r_name AS region_code, n_name AS country_code,
  CASE WHEN {money('s_acctbal')} >= 6000 THEN 'Preferred' WHEN {money('s_acctbal')} >= 2000
    THEN 'Approved' ELSE 'Conditional' END AS supplier_tier,
  lo AS contract_start_date, {key('lo')} AS contract_start_date_key,
  CASE WHEN {money('s_acctbal')} < 0 THEN 'On Hold' ELSE 'Active' END AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey LEFT JOIN supplier_days ON s_suppkey = k"""

CTES["dim_employee"] = f"""
SELECT c_custkey AS employee_key, {dim_id('EMP', 'c_custkey')} AS employee_id, c_name AS employee_name,
  c_mktsegment AS department, {_pick('c_custkey % 3', ['Junior', 'Experienced', 'Principal'])} AS job_level,
  CAST(c_nationkey AS BIGINT) AS facility_key, {dim_id('FAC', 'c_nationkey')} AS facility_id,
  lo AS hire_date, {key('lo')} AS hire_date_key,
  CASE WHEN {money('c_acctbal')} < 0 THEN 'Leave' ELSE 'Active' END AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM customer JOIN (SELECT user_id, min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi
  FROM events GROUP BY 1) ON c_custkey = user_id"""

CTES["dim_technician"] = f"""
SELECT s_suppkey AS technician_key, {dim_id('TEC', 's_suppkey')} AS technician_id,
  s_suppkey AS employee_key, {dim_id('EMP', 's_suppkey')} AS employee_id,
  CAST(s_nationkey AS BIGINT) AS facility_key, {dim_id('FAC', 's_nationkey')} AS facility_id,
  {_pick('s_suppkey % 3', ['Basic', 'Skilled', 'Expert'])} AS skill_level,
  {_pick('s_suppkey % 4', ['Power', 'Motion', 'Fluids', 'Software'])} AS specialty,
  {plus_months('lo', 36)} AS certification_expiry,
  {key(plus_months('lo', 36))} AS certification_expiry_key,
  CASE WHEN {money('s_acctbal')} < 0 THEN 'On Leave' ELSE 'Active' END AS status,
  lo AS created_on, {key('lo')} AS created_on_key, hi AS modified_on, {key('hi')} AS modified_on_key
FROM supplier LEFT JOIN supplier_days ON s_suppkey = k"""

CTES["dim_sales_channel"] = """
SELECT used AS sales_channel_key, 'CH' || lpad(CAST(used AS VARCHAR), 2, '0') AS sales_channel_id,
  n AS sales_channel_name, g AS channel_group, 'Active' AS status
FROM (SELECT DISTINCT TRY_CAST(regexp_extract(o_orderpriority, '^([0-9]+)-', 1) AS BIGINT) AS used FROM bound_orders
  WHERE o_orderpriority IS NOT NULL)
LEFT JOIN (VALUES (1, 'Urgent', 'Priority'), (2, 'High', 'Priority'), (3, 'Medium', 'Standard'),
  (4, 'Not Specified', 'Standard'), (5, 'Low', 'Standard')) AS t(k, n, g) ON used = k"""

CTES["dim_asset"] = f"""
SELECT o_orderkey AS asset_key, {row_id('AST', 'o_orderkey')} AS asset_id,
  {row_id('SN-', 'o_orderkey')} AS serial_number, o_custkey AS customer_key,
  {dim_id('CUS', 'o_custkey')} AS customer_id, first_part AS product_key,
  {dim_id('PRD', 'first_part')} AS product_id, CAST(c_nationkey AS BIGINT) AS facility_key,
  {dim_id('FAC', 'c_nationkey')} AS facility_id,
  {_pick('o_orderkey % 2', ['Machine', 'Vehicle'])} AS asset_type,
  od AS install_date, {key('od')} AS install_date_key,
  {plus_months('od', 36)} AS warranty_expiry, {key(plus_months('od', 36))} AS warranty_expiry_key,
  {CRITICALITY.format('o_orderpriority')} AS criticality,
  CASE WHEN o_orderstatus = 'P' THEN 'Out of Service' ELSE 'Active' END AS status,
  od AS created_on, {key('od')} AS created_on_key,
  coalesce(hi, od) AS modified_on, {key('coalesce(hi, od)')} AS modified_on_key
FROM (SELECT *, CAST(o_orderdate AS DATE) AS od FROM bound_orders)
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS first_part, max(ship_date) AS hi FROM lines GROUP BY 1)
  ON o_orderkey = l_orderkey
LEFT JOIN customer ON o_custkey = c_custkey"""

CTES["order_lines"] = f"""
SELECT line_key, l_orderkey, l_partkey, qty, ext, disc, ship_date,
  {money('ext * (1 - disc)')} AS line_revenue, {money('qty * cost')} AS line_cost
FROM lines WHERE priced"""

CTES["totals"] = f"""
SELECT l_orderkey, {money('sum(line_revenue)')} AS order_revenue, {money('sum(line_cost)')} AS order_cost,
  max(ship_date) AS requested_date
FROM order_lines GROUP BY 1"""

CTES["fact_sales_order"] = f"""
SELECT o_orderkey AS sales_order_key, {row_id('SO', 'o_orderkey')} AS sales_order_id,
  o_custkey AS customer_key, {dim_id('CUS', 'o_custkey')} AS customer_id,
  {CHANNEL.format('o_orderpriority')} AS sales_channel_key,
  'CH' || lpad(CAST({CHANNEL.format('o_orderpriority')} AS VARCHAR), 2, '0') AS sales_channel_id,
  CAST(o_orderdate AS DATE) AS order_date, {key('o_orderdate')} AS order_date_key,
  requested_date, {key('requested_date')} AS requested_date_key, 'USD' AS currency_code,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Cancelled' END AS order_status,
  order_revenue, order_cost, {money('order_revenue - order_cost')} AS gross_margin
FROM bound_orders JOIN totals ON o_orderkey = l_orderkey"""

CTES["fact_sales_order_line"] = f"""
SELECT line_key AS sales_order_line_key, {pair_id('SOL', 'line_key')} AS sales_order_line_id,
  l_orderkey AS sales_order_key, {row_id('SO', 'l_orderkey')} AS sales_order_id,
  l_partkey AS product_key, {dim_id('PRD', 'l_partkey')} AS product_id, qty AS quantity,
  {money('((200 * CAST(ext * 100 AS BIGINT) + CAST(qty * 100 AS BIGINT)) // (2 * CAST(qty * 100 AS BIGINT))) / 100.0')} AS unit_price,
  disc AS discount_percent, line_revenue, line_cost,
  customer_key, sales_channel_key, order_date_key, requested_date_key
FROM order_lines LEFT JOIN fact_sales_order ON l_orderkey = sales_order_key"""

CTES["pairs"] = """
SELECT l_partkey, l_suppkey, min(qty) AS min_qty, sum(qty) AS total_qty FROM lines GROUP BY 1, 2"""
CTES["bridge_supplier_product"] = f"""
SELECT {dim_id('SP', 'l_partkey')} || '-' || {dim_id('', 'l_suppkey')} AS supplier_product_id,
  l_partkey AS product_key, {dim_id('PRD', 'l_partkey')} AS product_id,
  l_suppkey AS supplier_key, {dim_id('SUP', 'l_suppkey')} AS supplier_id,
  'SPN-' || {dim_id('', 'l_partkey')} || '-' || {dim_id('', 'l_suppkey')} AS supplier_part_number,
  min_qty AS minimum_order_quantity,
  row_number() OVER (PARTITION BY l_partkey ORDER BY total_qty DESC, l_suppkey) = 1 AS preferred_supplier
FROM pairs"""

CTES["fact_purchase_order_line"] = f"""
SELECT line_key AS purchase_order_line_key, {pair_id('POL', 'line_key')} AS purchase_order_line_id,
  {row_id('PO', 'l_orderkey')} AS purchase_order_id, l_suppkey AS supplier_key,
  {dim_id('SUP', 'l_suppkey')} AS supplier_id, l_partkey AS product_key,
  {dim_id('PRD', 'l_partkey')} AS product_id, facility_key, {dim_id('FAC', 'facility_key')} AS facility_id,
  order_date, {key('order_date')} AS order_date_key,
  order_date + 30 AS expected_date, {key('order_date + 30')} AS expected_date_key,
  ship_date AS received_date, {key('ship_date')} AS received_date_key,
  qty AS ordered_quantity, rq AS received_quantity, cost AS unit_cost,
  CASE WHEN ship_date > {AS_OF} THEN 'Open' WHEN rq < qty THEN 'Partially Received' ELSE 'Received' END
    AS purchase_order_status,
  {money('qty * cost')} AS purchased_value
FROM (SELECT *, greatest(0, qty - CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END) AS rq
  FROM lines WHERE priced)"""

CTES["fact_shipment"] = f"""
SELECT line_key AS shipment_key, {pair_id('SHP', 'line_key')} AS shipment_id,
  l_orderkey AS sales_order_key, {row_id('SO', 'l_orderkey')} AS sales_order_id,
  facility_key, {dim_id('FAC', 'facility_key')} AS facility_id, l_returnflag AS carrier_name,
  ship_date, {key('ship_date')} AS ship_date_key,
  promised AS promised_delivery_date, {key('promised')} AS promised_delivery_date_key,
  actual AS actual_delivery_date, {key('actual')} AS actual_delivery_date_key,
  {money('ext * tax')} AS freight_cost, hold AS quality_hold,
  CASE WHEN hold THEN 'Quality Hold' WHEN actual > {AS_OF} THEN 'In Transit' ELSE 'Delivered' END
    AS shipment_status,
  o.customer_key, o.sales_channel_key, o.order_date_key, o.requested_date_key
FROM (SELECT *, ship_date + 2 + l_linenumber AS promised,
    ship_date + 2 + l_linenumber + (p_size % 9) - 3 AS actual,
    l_returnflag = 'R' AND l_linenumber = 1 AS hold FROM lines) s
LEFT JOIN fact_sales_order o ON s.l_orderkey = o.sales_order_key"""

CTES["fact_inventory_snapshot"] = f"""
SELECT line_key AS inventory_snapshot_key, {pair_id('INV', 'line_key')} AS inventory_snapshot_id,
  ship_date AS snapshot_date, {key('ship_date')} AS snapshot_date_key,
  facility_key, {dim_id('FAC', 'facility_key')} AS facility_id,
  l_partkey AS product_key, {dim_id('PRD', 'l_partkey')} AS product_id,
  qty AS quantity_on_hand, l_linenumber AS quantity_allocated, p_size AS safety_stock_quantity,
  p_size + 10 AS reorder_point, qty < p_size AS stockout_flag, cost AS standard_cost,
  {money('qty * cost')} AS inventory_value
FROM lines"""

CTES["fact_work_order"] = f"""
SELECT {pair_id('WO', 'line_key')} AS work_order_id, line_key AS work_order_key,
  l_orderkey AS asset_key, {row_id('AST', 'l_orderkey')} AS asset_id,
  l_suppkey AS technician_key, {dim_id('TEC', 'l_suppkey')} AS technician_id,
  ship_date AS opened_date, {key('ship_date')} AS opened_date_key, priority,
  {_pick('l_linenumber % 4', ['Planned', 'Repair', 'Survey', 'Setup'])} AS work_order_type,
  CAST(hours AS DECIMAL(10,2)) AS duration_hours, resolved AS resolved_date,
  {key('resolved')} AS resolved_date_key,
  CASE WHEN resolved > {AS_OF} THEN 'Open' WHEN l_linestatus = 'O' THEN 'Waiting for Parts'
    ELSE 'Completed' END AS work_order_status,
  {money('65 * hours')} AS labor_cost, a.customer_key, a.facility_key, a.product_key
FROM (SELECT *, ship_date + CAST(ceil(hours / 24) AS INTEGER) AS resolved FROM (
    SELECT * EXCLUDE (facility_key), 1 + qty + CASE WHEN priority = 'Critical' THEN 24 ELSE 0 END AS hours
    FROM lines WHERE l_returnflag = 'R')) w
LEFT JOIN dim_asset a ON w.l_orderkey = a.asset_key"""

CTES["fact_work_order_part"] = f"""
SELECT line_key AS work_order_part_key, {pair_id('WOP', 'line_key')} AS work_order_part_id,
  f.work_order_key, {pair_id('WO', 'f.work_order_key')} AS work_order_id,
  l_partkey AS product_key, {dim_id('PRD', 'l_partkey')} AS product_id, qty AS quantity_used,
  {money('qty * cost')} AS part_cost, o.asset_key, o.technician_key, o.opened_date_key,
  o.resolved_date_key, o.customer_key, o.facility_key, o.product_key AS asset_product_key
FROM lines JOIN (SELECT l_orderkey AS ok, arg_min(line_key, l_linenumber) AS work_order_key FROM lines
  WHERE l_returnflag = 'R' GROUP BY 1) f ON l_orderkey = ok
LEFT JOIN fact_work_order o ON f.work_order_key = o.work_order_key
WHERE l_returnflag = 'A' AND priced"""

CTES["fact_asset_daily_status"] = f"""
SELECT status_key AS asset_daily_status_key, {pair_id('ADS', 'status_key')} AS asset_daily_status_id,
  s.asset_key, {row_id('AST', 's.asset_key')} AS asset_id, status_date, {key('status_date')} AS status_date_key,
  CAST(hours AS DECIMAL(5,1)) AS operating_hours, CAST(24 - hours AS DECIMAL(5,1)) AS downtime_hours,
  CAST(hi AS DECIMAL(5,1)) AS health_score, CAST(lo AS DECIMAL(5,1)) AS temperature_c,
  CAST(alerts AS INTEGER) AS alert_count, a.customer_key, a.facility_key, a.product_key
FROM (SELECT user_id AS asset_key, CAST(ts AS DATE) AS status_date,
    user_id || ':' || CAST(CAST(ts AS DATE) AS VARCHAR) AS status_key,
    count(DISTINCT hour(ts)) AS hours, max({money('value')}) AS hi, min({money('value')}) AS lo,
    count(*) FILTER (event_type = 'error') AS alerts
  FROM events GROUP BY 1, 2, 3) s
LEFT JOIN dim_asset a ON s.asset_key = a.asset_key"""

DATES = {
    "dim_facility": ["created_on", "modified_on"],
    "dim_customer": ["created_on", "modified_on"],
    "dim_product": ["created_on", "modified_on"],
    "dim_supplier": ["contract_start_date", "created_on", "modified_on"],
    "dim_employee": ["hire_date", "created_on", "modified_on"],
    "dim_technician": ["certification_expiry", "created_on", "modified_on"],
    "dim_asset": ["install_date", "warranty_expiry", "created_on", "modified_on"],
    "fact_sales_order": ["order_date", "requested_date"],
    "fact_purchase_order_line": ["order_date", "expected_date", "received_date"],
    "fact_shipment": ["ship_date", "promised_delivery_date", "actual_delivery_date"],
    "fact_inventory_snapshot": ["snapshot_date"],
    "fact_work_order": ["opened_date", "resolved_date"],
    "fact_asset_daily_status": ["status_date"],
}
DECIMALS = {
    "dim_customer": ["annual_revenue"],
    "dim_product": ["standard_cost", "list_price", "weight_kg"],
    "fact_sales_order": ["order_revenue", "order_cost", "gross_margin"],
    "fact_sales_order_line": ["quantity", "unit_price", "discount_percent", "line_revenue", "line_cost"],
    "bridge_supplier_product": ["minimum_order_quantity"],
    "fact_purchase_order_line": ["ordered_quantity", "received_quantity", "unit_cost", "purchased_value"],
    "fact_shipment": ["freight_cost"],
    "fact_inventory_snapshot": ["quantity_on_hand", "standard_cost", "inventory_value"],
    "fact_work_order": ["duration_hours", "labor_cost"],
    "fact_work_order_part": ["quantity_used", "part_cost"],
    "fact_asset_daily_status": ["operating_hours", "downtime_hours", "health_score", "temperature_c"],
}

_spans = " UNION ALL ".join(
    f"SELECT min({day}) AS lo, max({day}) AS hi FROM {table}"
    for table, days in DATES.items()
    for day in days
)
CTES["bounds"] = f"""
SELECT make_date(CAST(least(2013, year(min(lo))) AS INTEGER), 1, 1) AS start_date,
  make_date(CAST(greatest(2052, 2024 + 5, year(max(hi))) AS INTEGER), 12, 31) AS end_date
FROM ({_spans})"""
CTES["days"] = """
SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS full_date FROM bounds"""
CTES["dim_date"] = f"""
SELECT full_date, {key('full_date')} AS date_key, CAST(year(full_date) AS INTEGER) AS calendar_year,
  CAST(quarter(full_date) AS INTEGER) AS calendar_quarter, CAST(month(full_date) AS INTEGER) AS calendar_month,
  monthname(full_date) AS month_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
  dayname(full_date) AS day_of_week, CAST(isodow(full_date) AS INTEGER) AS day_of_week_sort,
  isodow(full_date) > 5 AS is_weekend
FROM days"""


def with_star(select: str, **extra: str) -> str:
    """``select`` preceded by the star tables it uses, directly or through others."""
    known = {**CTES, **extra}
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(known[name])

    need(select)
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    return f"WITH {parts}\n{select}"


def shown(table: str, where: str = "") -> str:
    """Every column of a star table, dates as text and decimals as double."""
    swaps = [f"CAST({d} AS VARCHAR) AS {d}" for d in DATES.get(table, [])]
    swaps += [f"CAST({d} AS DOUBLE) AS {d}" for d in DECIMALS.get(table, [])]
    if table == "dim_date":
        swaps = ["CAST(full_date AS VARCHAR) AS full_date"]
    star = f"* REPLACE ({', '.join(swaps)})" if swaps else "*"
    return with_star(f"SELECT {star} FROM {table} {where}")
