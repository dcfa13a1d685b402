"""The three models: their tables, relationships and column captions.

A model names gold tables, says over which keys a filter on a dimension reaches
a fact (active relationships), and which other date keys a query may switch to
(inactive ones). Names here are lower-case; captions are for display.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Model → model table → gold table.
MODEL_TABLES = {
    "commercial": {
        "customer": "dim_customer",
        "date": "dim_date",
        "orders": "fact_sales_order",
        "product": "dim_product",
        "sales_channel": "dim_sales_channel",
        "sales": "fact_sales_order_line",
    },
    "supply_chain": {
        "customer": "dim_customer",
        "date": "dim_date",
        "facility": "dim_facility",
        "inventory": "fact_inventory_snapshot",
        "product": "dim_product",
        "purchase_orders": "fact_purchase_order_line",
        "sales_channel": "dim_sales_channel",
        "shipments": "fact_shipment",
        "supplier_products": "bridge_supplier_product",
        "supplier": "dim_supplier",
    },
    "service": {
        "asset_daily_status": "fact_asset_daily_status",
        "asset": "dim_asset",
        "customer": "dim_customer",
        "date": "dim_date",
        "employee": "dim_employee",
        "facility": "dim_facility",
        "part_product": "dim_product",
        "product": "dim_product",
        "technician": "dim_technician",
        "work_order_parts": "fact_work_order_part",
        "work_orders": "fact_work_order",
    },
}

# The key of each table that others relate to.
PRIMARY_KEYS = {
    "customer": "customer_key",
    "date": "date_key",
    "product": "product_key",
    "part_product": "product_key",
    "sales_channel": "sales_channel_key",
    "supplier": "supplier_key",
    "facility": "facility_key",
    "employee": "employee_key",
    "technician": "technician_key",
    "asset": "asset_key",
}

# Child table, child key, parent table, state.
_RELATIONSHIPS = {
    "commercial": (
        ("orders", "customer_key", "customer", "active"),
        ("orders", "sales_channel_key", "sales_channel", "active"),
        ("sales", "product_key", "product", "active"),
        ("orders", "order_date_key", "date", "active"),
        ("orders", "requested_date_key", "date", "inactive"),
        ("sales", "customer_key", "customer", "active"),
        ("sales", "sales_channel_key", "sales_channel", "active"),
        ("sales", "order_date_key", "date", "active"),
        ("sales", "requested_date_key", "date", "inactive"),
        ("customer", "created_on_key", "date", "inactive"),
        ("customer", "modified_on_key", "date", "inactive"),
        ("product", "created_on_key", "date", "inactive"),
        ("product", "modified_on_key", "date", "inactive"),
    ),
    "supply_chain": (
        ("purchase_orders", "supplier_key", "supplier", "active"),
        ("purchase_orders", "product_key", "product", "active"),
        ("purchase_orders", "facility_key", "facility", "active"),
        ("shipments", "facility_key", "facility", "active"),
        ("inventory", "product_key", "product", "active"),
        ("inventory", "facility_key", "facility", "active"),
        ("supplier_products", "supplier_key", "supplier", "active"),
        ("supplier_products", "product_key", "product", "active"),
        ("purchase_orders", "order_date_key", "date", "active"),
        ("shipments", "ship_date_key", "date", "active"),
        ("inventory", "snapshot_date_key", "date", "active"),
        ("purchase_orders", "expected_date_key", "date", "inactive"),
        ("purchase_orders", "received_date_key", "date", "inactive"),
        ("shipments", "promised_delivery_date_key", "date", "inactive"),
        ("shipments", "actual_delivery_date_key", "date", "inactive"),
        ("shipments", "customer_key", "customer", "active"),
        ("shipments", "sales_channel_key", "sales_channel", "active"),
        ("shipments", "order_date_key", "date", "inactive"),
        ("shipments", "requested_date_key", "date", "inactive"),
        ("customer", "created_on_key", "date", "inactive"),
        ("customer", "modified_on_key", "date", "inactive"),
        ("product", "created_on_key", "date", "inactive"),
        ("product", "modified_on_key", "date", "inactive"),
        ("supplier", "contract_start_date_key", "date", "inactive"),
        ("supplier", "created_on_key", "date", "inactive"),
        ("supplier", "modified_on_key", "date", "inactive"),
        ("facility", "created_on_key", "date", "inactive"),
        ("facility", "modified_on_key", "date", "inactive"),
    ),
    "service": (
        ("technician", "employee_key", "employee", "active"),
        ("work_orders", "asset_key", "asset", "active"),
        ("work_orders", "technician_key", "technician", "active"),
        ("work_order_parts", "product_key", "part_product", "active"),
        ("asset_daily_status", "asset_key", "asset", "active"),
        ("work_orders", "opened_date_key", "date", "active"),
        ("work_orders", "resolved_date_key", "date", "inactive"),
        ("asset_daily_status", "status_date_key", "date", "active"),
        ("work_orders", "customer_key", "customer", "active"),
        ("work_orders", "facility_key", "facility", "active"),
        ("work_orders", "product_key", "product", "active"),
        ("work_order_parts", "asset_key", "asset", "active"),
        ("work_order_parts", "technician_key", "technician", "active"),
        ("work_order_parts", "customer_key", "customer", "active"),
        ("work_order_parts", "facility_key", "facility", "active"),
        ("work_order_parts", "asset_product_key", "product", "active"),
        ("work_order_parts", "opened_date_key", "date", "active"),
        ("work_order_parts", "resolved_date_key", "date", "inactive"),
        ("asset_daily_status", "customer_key", "customer", "active"),
        ("asset_daily_status", "facility_key", "facility", "active"),
        ("asset_daily_status", "product_key", "product", "active"),
        ("customer", "created_on_key", "date", "inactive"),
        ("customer", "modified_on_key", "date", "inactive"),
        ("product", "created_on_key", "date", "inactive"),
        ("product", "modified_on_key", "date", "inactive"),
        ("facility", "created_on_key", "date", "inactive"),
        ("facility", "modified_on_key", "date", "inactive"),
        ("employee", "hire_date_key", "date", "inactive"),
        ("employee", "created_on_key", "date", "inactive"),
        ("employee", "modified_on_key", "date", "inactive"),
        ("technician", "certification_expiry_key", "date", "inactive"),
        ("technician", "created_on_key", "date", "inactive"),
        ("technician", "modified_on_key", "date", "inactive"),
        ("asset", "install_date_key", "date", "inactive"),
        ("asset", "warranty_expiry_key", "date", "inactive"),
        ("asset", "created_on_key", "date", "inactive"),
        ("asset", "modified_on_key", "date", "inactive"),
    ),
}


@dataclass(frozen=True)
class Relationship:
    """Many child rows to one parent row, over one key on each side."""

    child: str
    child_key: str
    parent: str
    active: bool

    @property
    def parent_key(self) -> str:
        return PRIMARY_KEYS[self.parent]


RELATIONSHIPS = {
    model: tuple(
        Relationship(child, key, parent, state == "active")
        for child, key, parent, state in edges
    )
    for model, edges in _RELATIONSHIPS.items()
}


class UnrelatedError(ValueError):
    """No active relationship leads from a table to an attribute asked for."""


def path_to(model: str, home: str, target: str, date_role: str | None) -> list[Relationship] | None:
    """Relationships from ``home`` to ``target``; None when unrelated.

    ``date_role`` replaces the home table's own active date key for this query.
    """
    def usable(edge: Relationship) -> bool:
        if edge.parent == "date" and edge.child == home and date_role:
            return edge.child_key == date_role
        return edge.active

    open_paths: deque[list[Relationship]] = deque([[]])
    while open_paths:
        path = open_paths.popleft()
        table = path[-1].parent if path else home
        if table == target:
            return path
        open_paths.extend(
            [*path, edge] for edge in RELATIONSHIPS[model] if edge.child == table and usable(edge)
        )
    return None


# -- captions ----------------------------------------------------------------

# Captions that are not simply the column name in title case.
_CAPTIONS = {
    "date": {
        "full_date": "Date",
        "calendar_year": "Year",
        "calendar_quarter": "Quarter",
        "calendar_month": "Month Number",
        "month_name": "Month",
        "week_of_year": "Week of Year",
        "day_of_week": "Day of Week",
        "day_of_week_sort": "Day of Week Sort",
    },
    "orders": {"gross_margin": "Gross Margin Value"},
    "inventory": {
        "quantity_on_hand": "Quantity on Hand Value",
        "quantity_allocated": "Allocated Quantity Value",
        "standard_cost": "Snapshot Standard Cost",
        "inventory_value": "Inventory Value Source",
    },
    "purchase_orders": {"purchased_value": "Purchased Value Source"},
    "shipments": {"carrier_name": "Carrier", "freight_cost": "Freight Cost Value"},
    "asset_daily_status": {
        "operating_hours": "Operating Hours Value",
        "downtime_hours": "Downtime Hours Value",
        "temperature_c": "Temperature Celsius",
    },
    "work_order_parts": {"part_cost": "Part Cost Value"},
    "work_orders": {"labor_cost": "Labor Cost Value"},
}
_SHARED_CAPTIONS = {
    "region_code": "Region",
    "country_code": "Country",
    "weight_kg": "Weight Kilograms",
    "sku": "SKU",
}
# The status column is plain in these tables, else it carries the table's name.
_PLAIN_STATUS = {("supply_chain", "product"), ("supply_chain", "facility")}
# Gold columns a model table leaves out.
_HIDDEN = {
    "sales": {"sales_order_line_key"},
    "inventory": {"inventory_snapshot_key"},
    "purchase_orders": {"purchase_order_line_key"},
    "shipments": {"shipment_key", "sales_order_key"},
    "asset_daily_status": {"asset_daily_status_key"},
    "work_order_parts": {"work_order_part_key"},
    "part_product": {
        "list_price", "lead_time_days", "weight_kg",
        "created_on", "created_on_key", "modified_on", "modified_on_key",
    },
}


def caption(model: str, table: str, column: str) -> str:
    """Display name of a column in a model table."""
    if column == "status":
        named = table.replace("_", " ").title()
        return "Status" if (model, table) in _PLAIN_STATUS else f"{named} Status"
    special = _CAPTIONS.get(table, {}).get(column) or _SHARED_CAPTIONS.get(column)
    if special:
        return special
    words = (word.upper() if word == "id" else word.title() for word in column.split("_"))
    return " ".join(words)


def visible_columns(table: str, columns: list[str]) -> list[str]:
    return [name for name in columns if name not in _HIDDEN.get(table, set())]


def model_table(model: str, table: str, gold: DataFrame) -> DataFrame:
    """A gold table under the captions of a model."""
    return gold.select(
        *(
            F.col(name).alias(caption(model, table, name))
            for name in visible_columns(table, gold.columns)
        )
    )
