"""Shuffles carry numbers: keys as text and derived columns are made after joins and rewrites."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import JoinGuardError
from starloom.operators.layout import rewrite_clustered
from starloom.plans.layers import _screened
from starloom.plans.publish import publish_guarded, publish_lines
from starloom.sources import landing as bind
from starloom.sources.store import TableStore

LINES = """l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, quantity decimal(12,2),
    extended_price decimal(18,2), discount decimal(5,4), tax decimal(5,4), l_returnflag string, l_linestatus string,
    ship_date date, order_date date, priority string, standard_cost decimal(18,2), part_size int, is_priced boolean,
    facility_key long"""
PARENTS = """sales_order_key long, asset_key long, customer_key long, sales_channel_key long, order_date_key int,
    requested_date_key int, facility_key long, product_key long, standard_cost decimal(18,2)"""


@pytest.fixture
def lines(spark):
    from datetime import date
    from decimal import Decimal as D

    rows = [
        (order, n, 7, 3, D(5 * n), D("10.50"), D("0.05"), D("0.02"), flag, "F", date(1997, 1, order),
         date(1996, 12, order), "Critical", D("2.25") if n < 3 else None, 20, n < 3, 4)
        for order in (1, 2) for n, flag in ((1, "R"), (2, "N"), (3, "R"))
    ]
    return spark.createDataFrame(rows, LINES).withColumn("line_key", bind.line_key())


def parents(spark, keys):
    rows = spark.createDataFrame([(k, k, 10 * k, 1, 19961201, 19970101, 4, 7, None) for k in keys], PARENTS)
    return lambda name: rows.drop("product_key") if name == "fact_sales_order" else rows


def below_joins(df):
    """What the optimised plan does below its first join."""
    return df._jdf.queryExecution().optimizedPlan().toString().partition("Join ")[2]


NAMES = {
    "fact_sales_order_line": "sales_order_line", "fact_shipment": "shipment",
    "fact_work_order": "work_order", "fact_inventory_snapshot": "inventory_snapshot",
}


@pytest.mark.parametrize("name", NAMES)
def test_publish_lines_is_the_entity_joined_to_its_parent(spark, rows, lines, name):
    landing = SimpleNamespace(as_of=F.lit("2001-08-01").cast("date"))
    gold = parents(spark, [1, 2]) if name != "fact_inventory_snapshot" else parents(spark, [7])
    if name == "fact_inventory_snapshot":
        opened = gold
        gold = lambda n: opened(n).withColumn("product_key", F.lit(7).cast("long"))
    build, _, _ = bind.ENTITIES[NAMES[name]]
    whole = publish_guarded(name, build(landing, lines), gold)
    late = publish_lines(name, landing, lines, gold)
    assert late.rows.schema.simpleString() == whole.rows.schema.simpleString()
    assert rows(late.rows) == rows(whole.rows)
    late.verify()
    assert not any(text in below_joins(late.rows) for text in ("concat_ws", "lpad", "date_add", "line_key"))


def test_publish_lines_refuses_lines_without_a_parent(spark, lines):
    landing = SimpleNamespace(as_of=F.lit("2001-08-01").cast("date"))
    late = publish_lines("fact_shipment", landing, lines, parents(spark, [1]))
    late.rows.collect()
    with pytest.raises(JoinGuardError, match="fact_shipment to fact_sales_order: 3 rows have a sales_order_key"):
        late.verify()


def test_order_ids_are_made_after_the_join(spark, lines):
    orders = spark.createDataFrame(
        [(1, 5, "O", "1-URGENT", datetime(1996, 12, 1)), (9, 5, "F", "2-HIGH", datetime(1996, 12, 2))],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp",
    )
    made = bind.sales_order(lambda table: orders, lines)
    found = made.select("sales_order_id", "customer_id", "sales_channel_id", "order_status").collect()
    assert [tuple(r) for r in found] == [("SO0000000000000001", "CUS000000000005", "CH01", "Open")]
    assert "lpad" not in below_joins(made)


def test_kept_rows_are_written_again_only_if_some_are_rejected(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.write("bronze.whole_raw", spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
    store.write("bronze.parted_raw", spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k long, v string"))
    whole = _screened(store, "bronze.whole_raw", "silver.whole", "quarantine.whole", ["k"]).first()
    parted = _screened(store, "bronze.parted_raw", "silver.parted", "quarantine.parted", ["k"]).first()
    assert (whole.raw_rows, whole.conformed_rows, parted.raw_rows, parted.conformed_rows) == (2, 2, 3, 1)
    assert store.stored("silver.whole").path == store.stored("bronze.whole_raw").path
    assert store.stored("silver.parted").path != store.stored("bronze.parted_raw").path
    assert store.read("quarantine.parted").count() == 2 and store.read("quarantine.whole").isEmpty()
    store.write("bronze.whole_raw", spark.createDataFrame([(3, "c")], "k long, v string"))
    store.drop_old_versions()
    assert sorted(store.read("silver.whole").collect()) == [(1, "a"), (2, "b")]


def test_made_columns_are_not_shuffled_by_a_clustered_rewrite(spark, rows, tmp_path):
    store, beside = (TableStore(spark, str(tmp_path / name)) for name in ("store", "beside"))
    keys = spark.range(50).select(
        F.concat_ws(":", F.col("id").cast("string"), F.lit("1")).alias("shipment_key"),
        (F.col("id") % 3).alias("sales_order_key"), (F.col("id") % 2).alias("facility_key"),
        (F.col("id") % 7).cast("int").alias("ship_date_key"),
    )
    whole = store.write("gold.fact_shipment", bind.with_text_ids(keys, "shipment"))
    shuffled = []

    def make(laid):
        shuffled.extend(laid.columns)
        return bind.with_text_ids(laid, "shipment")

    ids = bind.TEXT_IDS["shipment"]
    laid = rewrite_clustered(store, "gold.fact_shipment", "ship_date_key", "shipment_key", beside, ids, make)
    assert laid.columns == whole.columns and rows(laid) == rows(whole)
    assert shuffled == keys.columns
