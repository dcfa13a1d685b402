"""Questions about a line's own columns join no lookups, and pairs of product and supplier travel by product once."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from starloom.plans.publish import Warehouse
from starloom.plans.queries import QUERIES
from starloom.sources import landing as bind
from starloom.sources.landing import Landing
from starloom.sources.store import TableStore

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"
PARTS = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
LINES = """l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double,
    l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""


@pytest.fixture(params=[False, True], ids=["keys once", "a key twice"])
def opened(request, spark, tmp_path):
    """A warehouse over rows of its own, of which a line may come twice."""
    when = datetime(1997, 3, 4)
    lines = [
        (order, n, part, supplier, 5.0 * n, 10.0, 0.0, 0.0, "N", "F", when)
        for order, part, supplier in ((1, 7, 3), (2, 7, 4), (3, 8, 3)) for n in (1, 2)
    ]
    if request.param:
        lines.append((1, 1, 7, 3, 99.0, 10.0, 0.0, 0.0, "N", "F", when))
    tables = {
        "region": ([(0, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(3, "S3", 0, 10.0), (4, "S4", 0, 9000.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(7, "a", "B", "T7", 1, 2.0), (8, "b", "B", "T8", 1, 2.0)], PARTS),
        "orders": ([(k, 1, "F", when, "5-LOW") for k in (1, 2, 3)], ORDERS),
        "lineitem": (lines, LINES),
        "events": ([], "event_id long, user_id long, ts timestamp, event_type string, value double"),
    }
    folder = tmp_path / "landing"
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    def open_at(name):
        return Warehouse(spark, Landing(spark, str(folder)), TableStore(spark, str(tmp_path / name)))

    return open_at


@pytest.mark.parametrize("query", ["star_assignments", "bridge_rollup"])
def test_assignments_join_no_lookups_to_lines(rows, opened, query):
    alone, after = opened("alone"), opened("after")
    after.line()
    assert rows(QUERIES[query](alone)) == rows(QUERIES[query](after)) != []
    assert "silver.line" not in alone.store
    assert "work.bare_line" not in after.store


def test_bare_lines_become_lines_with_lookups(rows, opened):
    alone, after = opened("alone"), opened("after")
    assert alone.publish_bare(["bridge_supplier_product", "dim_product"])
    assert not alone.publish_bare(["bridge_supplier_product", "fact_shipment"])
    assert ("work.bare_line" in alone.store) == (not alone.store.read("work.lineitem_repeated_keys").isEmpty())
    assert rows(alone.line()) == rows(after.line())
    for name in ("bridge_supplier_product", "dim_product"):
        assert alone.table(name).schema == after.table(name).schema
        assert rows(alone.table(name)) == rows(after.table(name))


PAIRS = [
    (1, 10, 5), (1, 10, 2), (1, 11, 7), (1, 12, 1), (2, None, 9), (2, 20, 3), (None, 10, 4), (3, 30, None), (3, 31, None),
]


def test_pairs_are_shuffled_by_product_once(spark):
    lines = spark.createDataFrame(
        [(p, s, q if q is None else D(q), date(1997, 1, 1)) for p, s, q in PAIRS],
        "l_partkey long, l_suppkey long, quantity decimal(12,2), ship_date date",
    )
    made = bind.supplier_product(None, lines)
    found = made.select("product_key", "supplier_key", "minimum_order_quantity", "preferred_supplier").collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted([
        (1, 10, D(2), True), (1, 11, D(7), False), (1, 12, D(1), False), (2, None, D(9), None), (2, 20, D(3), None),
        (3, 30, None, True), (3, 31, None, False),
    ], key=repr)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bind.supplier_product(None, lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [step for step in plan.splitlines() if "Exchange" in step]
    assert [("ReusedExchange" in step) for step in moved].count(False) == 2, plan
