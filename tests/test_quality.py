import pytest
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.sources.store import TableStore


def failing(df):
    return {(r.table_name, r.validation_name): r.failed_row_count for r in df.where("status = 'FAIL'").collect()}


@pytest.fixture
def broken(warehouse):
    """Gold tables of which some are replaced."""

    def tables(**changed):
        return lambda name: changed.get(name, warehouse.table(name))

    return tables


def test_clean_run_passes_all_63(spark, warehouse):
    results = quality.validation_summary(spark, warehouse.table).collect()
    assert len(results) == 63
    assert {r.status for r in results} == {"PASS"}
    assert len({(r.table_name, r.validation_name) for r in results}) == 63


def test_dimension_key_twice_and_missing(broken, warehouse):
    dim = warehouse.table("dim_customer")
    one = dim.where("customer_key = 1")
    nameless = one.withColumn("customer_key", F.lit(None).cast("bigint"))
    found = quality.check_dim_keys(broken(dim_customer=dim.union(one).union(nameless)))
    row = found.where("status = 'FAIL'").first()
    assert (row.table_name, row.failed_row_count) == ("gold.dim_customer", 2)
    assert row.details == "duplicates=1, null_keys=1"


def test_fact_grain(broken, warehouse):
    fact = warehouse.table("fact_shipment")
    found = quality.check_fact_grain(broken(fact_shipment=fact.union(fact.limit(1))))
    assert failing(found) == {("gold.fact_shipment", "grain_unique_shipment_id"): 1}


def test_foreign_key_unknown_counts_rows_and_null_passes(spark, broken, warehouse):
    fact = warehouse.table("fact_sales_order")
    key = F.col("sales_order_key")
    unknown = fact.withColumn(
        "customer_key",
        F.when(key % 3 == 0, 10**12).when(key % 3 == 1, F.lit(None)).otherwise(F.col("customer_key")),
    )
    found = quality.check_foreign_keys(spark, broken(fact_sales_order=unknown))
    expected = fact.where("sales_order_key % 3 = 0").count()
    name = "fk_customer_key_to_gold.dim_customer.customer_key"
    assert failing(found) == {("gold.fact_sales_order", name): expected}


def test_date_key_outside_the_calendar(spark, broken, warehouse):
    fact = warehouse.table("fact_inventory_snapshot")
    early = fact.withColumn("snapshot_date_key", F.lit(19000101))
    found = quality.check_date_keys(spark, broken(fact_inventory_snapshot=early))
    name = "datekey_snapshot_date_key_in_dim_date"
    assert failing(found) == {("gold.fact_inventory_snapshot", name): fact.count()}


def test_text_and_days_do_not_widen_the_rows_of_other_keys(spark, warehouse):
    """Keys that are numbers are not grouped beside a text, nor with a count for each date of a fact."""
    wanted = [*quality.foreign_key_references(), *quality.date_references()]
    plan = quality.check_references(spark, warehouse.table, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Aggregate [parent_no" in line and "key" in line for line in plan.splitlines()) == 3


def test_references_of_all_kinds_are_counted(spark):
    """Null, unknown and repeated keys, numbers and text on either side, counted by hand."""
    tables = {
        "p": spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "n long, t string"),
        "c": spark.createDataFrame(
            [(1, 9, "a"), (2, 2, "x"), (3, None, "x"), (None, 7, None), (3, 2, "1")], "x int, y long, t string"
        ),
        "d": spark.createDataFrame([(8, "b")], "x long, t string"),
        "e": spark.createDataFrame([], "x long"),
    }
    wanted = [("c", "x", "n", 2), ("c", "y", "n", 2), ("c", "t", "t", 3), ("d", "x", "n", 1), ("d", "t", "t", 0),
              ("c", "t", "n", 4), ("d", "x", "t", 1), ("e", "x", "n", 0)]
    references = [quality.Reference(c, col, "p", key, f"{col}_in_{key}", "rows lost") for c, col, key, _ in wanted]
    expected = {(f"gold.{c}", f"{col}_in_{key}", lost) for c, col, key, lost in wanted}
    found = quality.check_references(spark, tables.__getitem__, references).collect()
    assert {(r.table_name, r.validation_name, r.failed_row_count) for r in found} == expected
    assert all((r.status == "PASS") == (r.failed_row_count == 0) for r in found)


def test_repeated_text_keys_are_exact(spark, monkeypatch):
    """Keys held twice are told by their hashes first; with none, no text is grouped."""
    ids = [f"k{n}" for n in range(300)]
    for held, expected in ((ids, 0), ([*ids, None], 0), ([*ids, "k1", "k1", "k7"], 2), ([*ids, None, None, "k2"], 2)):
        df = spark.createDataFrame([(x,) for x in held], "id string")
        row = quality.check_unique(df, "id", "t").first()
        assert (row.failed_row_count, row.details) == (expected, f"duplicates={expected}")
    grouped, original = [], quality.duplicate_keys
    monkeypatch.setattr(quality, "duplicate_keys", lambda df, keys: (grouped.append(df.dtypes), original(df, keys))[1])
    quality.check_unique(spark.createDataFrame([(x,) for x in ids], "id string"), "id", "t").collect()
    assert grouped == [[("hashed", "bigint")]]


@pytest.mark.parametrize(
    "change, count",
    [
        ("CAST(purchased_value + 0.01 AS DECIMAL(18,2))", None),
        ("CAST(NULL AS DECIMAL(18,2))", None),
        ("CAST(purchased_value AS DOUBLE)", 1),
    ],
)
def test_purchased_value(broken, warehouse, change, count):
    fact = warehouse.table("fact_purchase_order_line")
    changed = fact.withColumn("purchased_value", F.expr(change))
    found = failing(quality.check_purchased_value(broken(fact_purchase_order_line=changed)))
    name = ("gold.fact_purchase_order_line", "purchased_value_correctness")
    assert found == {name: count or fact.count()}


def test_inventory_value(broken, warehouse):
    fact = warehouse.table("fact_inventory_snapshot")
    half = F.when(F.col("product_key") % 2 == 0, F.lit(0).cast("decimal(18,2)"))
    changed = fact.withColumn("inventory_value", half.otherwise(F.col("inventory_value")))
    found = failing(quality.check_inventory_value(broken(fact_inventory_snapshot=changed)))
    expected = fact.where("product_key % 2 = 0").count()
    assert found == {("gold.fact_inventory_snapshot", "inventory_value_correctness"): expected}


def test_signs(broken, warehouse):
    sales = warehouse.table("fact_sales_order_line")
    first = sales.agg(F.min("sales_order_line_key")).first()[0]
    at_first = F.col("sales_order_line_key") == first
    for column, value in (("quantity", F.lit(0)), ("line_revenue", F.lit(-1).cast("decimal(18,2)"))):
        changed = sales.withColumn(column, F.when(at_first, value).otherwise(F.col(column)))
        assert list(failing(quality.check_positive_sales(broken(fact_sales_order_line=changed))).values()) == [1]
    stock = warehouse.table("fact_inventory_snapshot")
    below = stock.withColumn("quantity_on_hand", F.lit(-1))
    found = failing(quality.check_nonneg_inventory(broken(fact_inventory_snapshot=below)))
    assert list(found.values()) == [stock.count()]


def test_gate_stores_the_evidence_before_it_raises(spark, warehouse, broken, tmp_path):
    store = TableStore(spark, str(tmp_path))
    dim = warehouse.table("dim_facility")
    with pytest.raises(quality.QualityError):
        quality.run_gate(spark, broken(dim_facility=dim.union(dim)), store)
    kept = store.read("gold.validation_summary")
    assert kept.count() == 63
    assert failing(kept) == {("gold.dim_facility", "unique_nonnull_facility_key"): 25}
