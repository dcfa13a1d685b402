"""The catalogue of business measures.

A measure is a formula over plain aggregates of one home table: sums, row
counts with or without a condition, and exact distinct counts. Because formulas
stand on aggregates and never on other results, every grouping level, subtotal
and prior period is computed from its own rows.

Blank rules: counting nothing is NULL, a ratio without a denominator is NULL,
and NULL counts as zero when the other side of a sum or difference has a value.
A distinct count counts the blank as one value beside the others. A blank text
differs from every named one, and a blank date comes before every date, so a line
without a date of receipt counts as on time; a duration that lacks a date is no
duration and meets no target.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Base:
    """One plain aggregate: ``kind`` is sum, count or distinct, over ``value``."""

    kind: str
    name: str
    value: Column


class Aggregates:
    """Hands a formula the columns of its aggregates, and remembers which it used.

    ``suffix`` tells apart the same aggregate in several periods: it is part of the
    column a formula sees, not of the aggregate's own name.
    """

    def __init__(self, prefix: str, suffix: str = ""):
        self.prefix = prefix
        self.suffix = suffix
        self.bases: dict[str, Base] = {}

    def _use(self, kind: str, label: str, value: Column) -> Column:
        name = f"{self.prefix}__{kind}_{label}"
        self.bases.setdefault(name, Base(kind, name, value))
        return F.col(name + self.suffix)

    def sum(self, column: str) -> Column:
        return self._use("sum", column, F.col(column))

    def count(self) -> Column:
        return F.nullif(self._use("count", "rows", F.lit(True)), F.lit(0))

    def count_where(self, label: str, condition: Column) -> Column:
        return F.nullif(self._use("count", label, condition), F.lit(0))

    def count_values(self, column: str) -> Column:
        """Rows in which ``column`` has a value: what an average divides by."""
        return F.nullif(self._use("count", f"known_{column}", F.col(column).isNotNull()), F.lit(0))

    def sum_where(self, label: str, column: str, condition: Column) -> Column:
        return self._use("sum", label, F.when(condition, F.col(column)))

    def distinct(self, column: str) -> Column:
        """Values of a column, blank included: a struct around a NULL is a value of its own."""
        return F.nullif(self._use("distinct", column, F.struct(column)), F.lit(0))


Formula = Callable[[Aggregates], Column]

COUNT, MONEY, PERCENT = "#,##0", "$#,##0.00", "0.00%"
ONE_DECIMAL, TWO_DECIMALS = "#,##0.0", "#,##0.00"


@dataclass(frozen=True)
class Measure:
    """``date_role`` is the date key used in place of the active one; ``shift`` is ytd or ly."""

    caption: str
    home: str
    formula: Formula
    format: str
    date_role: str | None = None
    shift: str | None = None

    @property
    def name(self) -> str:
        words = self.caption.replace("#", "n").replace("(%)", "pct")
        for mark in "()":
            words = words.replace(mark, "")
        return words.lower().replace("-", "_").replace(" ", "_")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; NULL for a NULL or zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def blank_sum(left: Column, right: Column) -> Column:
    """Sum in which a blank counts as zero, but two blanks stay blank."""
    both_blank = left.isNull() & right.isNull()
    return F.when(~both_blank, F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0)))


def rows(a: Aggregates) -> Column:
    return a.count()


def total(column: str) -> Formula:
    return lambda a: a.sum(column)


def difference(left: str, right: str) -> Formula:
    return lambda a: blank_sum(a.sum(left), -a.sum(right))


def quotient(top: str, bottom: str) -> Formula:
    return lambda a: ratio(a.sum(top), a.sum(bottom))


def mean(column: str) -> Formula:
    """Exact sum over count, so the result does not depend on the order of rows."""
    return lambda a: ratio(a.sum(column), a.count_values(column))


def distinct(column: str) -> Formula:
    return lambda a: a.distinct(column)


def rows_with(column: str, *values: str) -> Formula:
    label = "_".join([column, *values]).lower().replace(" ", "_")
    return lambda a: a.count_where(label, F.col(column).isin(*values))


def rows_flagged(column: str) -> Formula:
    return lambda a: a.count_where(column, F.col(column))


def share_of_rows(part: Formula) -> Formula:
    return lambda a: ratio(part(a), a.count())


def gross_margin_share(a: Aggregates) -> Column:
    margin = difference("line_revenue", "line_cost")(a)
    return ratio(margin, a.sum("line_revenue"))


FIRST_DAY = "0001-01-01"


def not_after(left: str, right: str) -> Column:
    """Whether a date is not later than another; a blank comes before every date."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.coalesce(left, first) <= F.coalesce(right, first)


def on_time_receipts(a: Aggregates) -> Column:
    """Among lines no longer open, those received by the expected date."""
    closed = ~F.col("purchase_order_status").eqNullSafe("Open")
    in_time = closed & not_after("received_date", "expected_date")
    return ratio(a.count_where("closed_in_time", in_time), a.count_where("closed", closed))


def on_time_deliveries(a: Aggregates) -> Column:
    delivered = F.col("shipment_status") == "Delivered"
    in_time = delivered & not_after("actual_delivery_date", "promised_delivery_date")
    return ratio(
        a.count_where("delivered_in_time", in_time),
        rows_with("shipment_status", "Delivered")(a),
    )


def availability(a: Aggregates) -> Column:
    operating = a.sum("operating_hours")
    return ratio(operating, blank_sum(operating, a.sum("downtime_hours")))


def repair_time(a: Aggregates) -> Column:
    done = F.col("work_order_status") == "Completed"
    known = done & F.col("duration_hours").isNotNull()
    return ratio(
        a.sum_where("completed_hours", "duration_hours", done),
        a.count_where("completed_known", known),
    )


# Target days by priority; every other priority has five.
TARGET_DAYS = {"Critical": 2, "High": 3}
OTHER_TARGET_DAYS = 5


def service_level(a: Aggregates) -> Column:
    """Completed orders resolved within their target, in calendar days."""
    target = F.lit(OTHER_TARGET_DAYS)
    for priority, days in TARGET_DAYS.items():
        target = F.when(F.col("priority") == priority, days).otherwise(target)
    done = F.col("work_order_status") == "Completed"
    kept = done & (F.datediff("resolved_date", "opened_date") <= target)
    return ratio(
        a.count_where("completed_in_target", kept),
        rows_with("work_order_status", "Completed")(a),
    )


_CATALOGUE = (
    Measure("# Active Customers", "customer", rows_with("status", "Active"), COUNT),
    Measure("# Customers Created", "customer", rows, COUNT, "created_on_key"),
    Measure("# Customers Modified", "customer", rows, COUNT, "modified_on_key"),
    Measure("# Orders", "orders", rows, COUNT),
    Measure("# Open Orders", "orders", rows_with("order_status", "Open"), COUNT),
    Measure("# Completed Orders", "orders", rows_with("order_status", "Completed"), COUNT),
    Measure("Average Order Value", "orders", mean("order_revenue"), MONEY),
    Measure(
        "Cancellation Rate", "orders",
        share_of_rows(rows_with("order_status", "Cancelled")), PERCENT,
    ),
    Measure("# Orders by Requested Date", "orders", rows, COUNT, "requested_date_key"),
    Measure("# Products Created", "product", rows, COUNT, "created_on_key"),
    Measure("# Products Modified", "product", rows, COUNT, "modified_on_key"),
    Measure("Total Revenue", "sales", total("line_revenue"), MONEY),
    Measure("Total Cost", "sales", total("line_cost"), MONEY),
    Measure("Gross Margin", "sales", difference("line_revenue", "line_cost"), MONEY),
    Measure("Gross Margin (%)", "sales", gross_margin_share, PERCENT),
    Measure("Units Sold", "sales", total("quantity"), COUNT),
    Measure("# Sales Lines", "sales", rows, COUNT),
    Measure("# Orders with Sales", "sales", distinct("sales_order_key"), COUNT),
    Measure("Average Selling Price", "sales", quotient("line_revenue", "quantity"), MONEY),
    Measure("Total Revenue (ytd)", "sales", total("line_revenue"), MONEY, shift="ytd"),
    Measure("Total Revenue (ly)", "sales", total("line_revenue"), MONEY, shift="ly"),
    Measure(
        "Total Revenue by Requested Date", "sales",
        total("line_revenue"), MONEY, "requested_date_key",
    ),
    Measure(
        "Units Sold by Requested Date", "sales", total("quantity"), COUNT, "requested_date_key"
    ),
    Measure("# Facilities Created", "facility", rows, COUNT, "created_on_key"),
    Measure("# Facilities Modified", "facility", rows, COUNT, "modified_on_key"),
    Measure("Quantity on Hand", "inventory", total("quantity_on_hand"), COUNT),
    Measure("Allocated Quantity", "inventory", total("quantity_allocated"), COUNT),
    Measure(
        "Available Quantity", "inventory",
        difference("quantity_on_hand", "quantity_allocated"), COUNT,
    ),
    Measure("Inventory Value", "inventory", total("inventory_value"), MONEY),
    Measure("# Stockout Snapshots", "inventory", rows_flagged("stockout_flag"), COUNT),
    Measure("Stockout Rate", "inventory", share_of_rows(rows_flagged("stockout_flag")), PERCENT),
    Measure("Purchased Value", "purchase_orders", total("purchased_value"), MONEY),
    Measure("# Purchase Orders", "purchase_orders", distinct("purchase_order_id"), COUNT),
    Measure("Total Ordered Quantity", "purchase_orders", total("ordered_quantity"), COUNT),
    Measure("Total Received Quantity", "purchase_orders", total("received_quantity"), COUNT),
    Measure(
        "Supplier Fill Rate", "purchase_orders",
        quotient("received_quantity", "ordered_quantity"), PERCENT,
    ),
    Measure("On-Time Receipt Rate", "purchase_orders", on_time_receipts, PERCENT),
    Measure(
        "# Purchase Orders by Expected Date", "purchase_orders",
        distinct("purchase_order_id"), COUNT, "expected_date_key",
    ),
    Measure(
        "# Purchase Orders by Received Date", "purchase_orders",
        distinct("purchase_order_id"), COUNT, "received_date_key",
    ),
    Measure("# Shipments", "shipments", rows, COUNT),
    Measure("# Delivered Shipments", "shipments", rows_with("shipment_status", "Delivered"), COUNT),
    Measure("On-Time Delivery Rate", "shipments", on_time_deliveries, PERCENT),
    Measure("Freight Cost", "shipments", total("freight_cost"), MONEY),
    Measure("Quality Hold Rate", "shipments", share_of_rows(rows_flagged("quality_hold")), PERCENT),
    Measure(
        "# Shipments by Promised Delivery Date", "shipments", rows, COUNT,
        "promised_delivery_date_key",
    ),
    Measure(
        "# Shipments by Actual Delivery Date", "shipments", rows, COUNT,
        "actual_delivery_date_key",
    ),
    Measure("# Shipments by Order Date", "shipments", rows, COUNT, "order_date_key"),
    Measure("# Shipments by Requested Date", "shipments", rows, COUNT, "requested_date_key"),
    Measure("# Supplier Product Assignments", "supplier_products", rows, COUNT),
    Measure(
        "# Preferred Assignments", "supplier_products", rows_flagged("preferred_supplier"), COUNT
    ),
    Measure("# Active Suppliers", "supplier", rows_with("status", "Active"), COUNT),
    Measure("# Supplier Contracts Started", "supplier", rows, COUNT, "contract_start_date_key"),
    Measure("# Suppliers Created", "supplier", rows, COUNT, "created_on_key"),
    Measure("# Suppliers Modified", "supplier", rows, COUNT, "modified_on_key"),
    Measure("Operating Hours", "asset_daily_status", total("operating_hours"), ONE_DECIMAL),
    Measure("Downtime Hours", "asset_daily_status", total("downtime_hours"), ONE_DECIMAL),
    Measure("Asset Availability", "asset_daily_status", availability, PERCENT),
    Measure("Average Health Score", "asset_daily_status", mean("health_score"), ONE_DECIMAL),
    Measure(
        "Average Temperature Celsius", "asset_daily_status", mean("temperature_c"), ONE_DECIMAL
    ),
    Measure("# Alerts", "asset_daily_status", total("alert_count"), COUNT),
    Measure("# Assets", "asset", rows, COUNT),
    Measure("# Critical Assets", "asset", rows_with("criticality", "Critical"), COUNT),
    Measure("# Assets Out of Service", "asset", rows_with("status", "Out of Service"), COUNT),
    Measure("# Assets Installed", "asset", rows, COUNT, "install_date_key"),
    Measure("# Asset Warranties Expiring", "asset", rows, COUNT, "warranty_expiry_key"),
    Measure("# Assets Created", "asset", rows, COUNT, "created_on_key"),
    Measure("# Assets Modified", "asset", rows, COUNT, "modified_on_key"),
    Measure("# Active Employees", "employee", rows_with("status", "Active"), COUNT),
    Measure("# Employees Hired", "employee", rows, COUNT, "hire_date_key"),
    Measure("# Employees Created", "employee", rows, COUNT, "created_on_key"),
    Measure("# Employees Modified", "employee", rows, COUNT, "modified_on_key"),
    Measure("# Active Technicians", "technician", rows_with("status", "Active"), COUNT),
    Measure(
        "# Technician Certifications Expiring", "technician", rows, COUNT,
        "certification_expiry_key",
    ),
    Measure("# Technicians Created", "technician", rows, COUNT, "created_on_key"),
    Measure("# Technicians Modified", "technician", rows, COUNT, "modified_on_key"),
    Measure("Parts Cost", "work_order_parts", total("part_cost"), MONEY),
    Measure("Parts Used", "work_order_parts", total("quantity_used"), COUNT),
    Measure("# Work Order Part Lines", "work_order_parts", rows, COUNT),
    Measure(
        "# Work Order Part Lines by Resolved Date", "work_order_parts", rows, COUNT,
        "resolved_date_key",
    ),
    Measure("# Work Orders", "work_orders", rows, COUNT),
    Measure(
        "# Open Work Orders", "work_orders",
        rows_with("work_order_status", "Open", "Waiting for Parts"), COUNT,
    ),
    Measure(
        "# Completed Work Orders", "work_orders",
        rows_with("work_order_status", "Completed"), COUNT,
    ),
    Measure("Labor Cost", "work_orders", total("labor_cost"), MONEY),
    Measure("Service Duration Hours", "work_orders", total("duration_hours"), TWO_DECIMALS),
    Measure("Mean Time to Repair Hours", "work_orders", repair_time, TWO_DECIMALS),
    Measure("Service Level Compliance", "work_orders", service_level, PERCENT),
    Measure(
        "# Resolved Work Orders", "work_orders",
        rows_with("work_order_status", "Completed"), COUNT, "resolved_date_key",
    ),
)

MEASURES = {measure.name: measure for measure in _CATALOGUE}


def to_date(name: str) -> Measure:
    """A measure of the catalogue as its year to date."""
    return replace(MEASURES[name], caption=f"{MEASURES[name].caption} (ytd)", shift="ytd")


def last_year(name: str) -> Measure:
    """A measure of the catalogue as that of the same period a year before."""
    return replace(MEASURES[name], caption=f"{MEASURES[name].caption} (ly)", shift="ly")
