"""Stored aggregates give what the facts give, and are chosen only if they can."""

import pytest

from starloom.operators.lattice import Lattice, build_lattice, plain_name
from starloom.operators.rollup import MetricModel
from starloom.plans.measures import MEASURES
from starloom.plans.models import MODEL_TABLES
from starloom.plans.queries import QUERIES, model
from starloom.sources.store import TableStore

GRAINS = {
    "sales": [("order_date_key", "customer_key"), ("order_date_key", "customer_key", "product_key", "sales_channel_key")],
    "orders": [("order_date_key", "customer_key", "sales_channel_key"), ("requested_date_key", "customer_key")],
}
SALES = [m.name for m in MEASURES.values() if m.home == "sales" and not m.date_role and not m.shift]


@pytest.fixture(scope="module")
def navigated(spark, warehouse, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("lattice")))
    commercial = model(warehouse, "commercial")

    def version(table):
        return warehouse.store.stored(f"gold.{table}").path

    lattice = build_lattice(
        Lattice(store), commercial.table, lambda home: version(MODEL_TABLES["commercial"][home]), GRAINS
    )

    def open_model(broadcast_bytes=8 << 20):
        return MetricModel("commercial", warehouse.table, commercial.sizes, broadcast_bytes, lattice, version)

    return open_model


def reads(df, part):
    """Whether any file that a DataFrame reads has a path with this part."""
    return any(part in path for path in df.inputFiles())


def collected(df):
    return sorted((tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.collect()), key=repr)


CASES = {
    "by month and segment": ("rollup", SALES, ["date.calendar_year", "date.calendar_month", "customer.customer_segment"], {}),
    "in all": ("rollup", SALES, [], {}),
    "by category": ("rollup", SALES, ["product.product_category"], {"sales_channel.channel_group": "Priority"}),
    "filtered": ("rollup", SALES, ["customer.region_code"], {"date.calendar_year": lambda y: y.between(1995, 1997), "customer.risk_tier": "High"}),
    "blank kept": ("rollup", SALES, ["date.calendar_year"], {"customer.risk_tier": lambda t: t.isNull() | (t == "Low")}),
    "orders too": ("rollup", ["n_orders", "n_open_orders", "total_revenue", "n_orders_by_requested_date"], ["date.calendar_year"], {}),
    "shifted": ("rollup", ["total_revenue", "total_revenue_ytd", "total_revenue_ly"], ["date.calendar_year", "date.calendar_month"], {}),
    "subtotals": ("subtotals", ["n_orders_with_sales", "gross_margin_pct"], ["date.calendar_year", "date.calendar_quarter"], {}),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("near", [True, False])
def test_same_results_without_facts(warehouse, navigated, name, near):
    how, measures, by, filters = CASES[name]
    limit = 8 << 20 if near else 0
    found = getattr(navigated(limit), how)(measures, by, filters=filters)
    right = getattr(model(warehouse, "commercial", limit), how)(measures, by, filters=filters)
    assert found.columns == right.columns and collected(found) == collected(right)
    assert not reads(found, "fact_") and reads(found, "/lattice/")


def test_facts_are_read_where_no_node_has_it_all(warehouse, navigated):
    for by, filters in ((["date.calendar_year"], {"sales.quantity": lambda q: q >= 10}), (["sales.discount_percent"], {})):
        found = navigated().rollup(["total_revenue", "units_sold"], by, filters)
        assert reads(found, "fact_sales_order_line") and not reads(found, "/lattice/")
        assert collected(found) == collected(model(warehouse, "commercial").rollup(["total_revenue", "units_sold"], by, filters))


def test_the_smallest_node_is_chosen(navigated):
    lattice = navigated().lattice
    base = [b for b in navigated()._formulas([MEASURES["total_revenue"]], None)[0].popitem()[1].bases.values()]
    fact = lattice.nodes[0].fact if lattice.nodes[0].home == "sales" else next(n.fact for n in lattice.nodes if n.home == "sales")
    assert lattice.covering("sales", {"customer_key"}, base, fact).keys == GRAINS["sales"][0]
    assert lattice.covering("sales", {"product_key"}, base, fact).keys == GRAINS["sales"][1]
    assert lattice.covering("sales", {"requested_date_key"}, base, fact) is None
    assert plain_name(base[0]) == "sum_line_revenue"


def test_nodes_of_an_older_fact_are_not_read(spark, warehouse, navigated):
    lattice = navigated().lattice
    assert lattice.covering("sales", {"customer_key"}, [], "another version") is None
    stale = MetricModel("commercial", warehouse.table, lambda t: 1, 8 << 20, lattice, lambda table: "rewritten since")
    assert reads(stale.rollup(["total_revenue"], ["customer.region_code"]), "fact_sales_order_line")


def test_dashboard_reads_no_fact(warehouse):
    assert not reads(QUERIES["sales_dashboard_stored"](warehouse), "/fact_")
    assert reads(QUERIES["sales_dashboard"](warehouse), "/fact_")
