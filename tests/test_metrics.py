from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import time_intelligence as periods
from starloom.operators.formatting import formatted
from starloom.operators.rollup import MetricModel
from starloom.plans.measures import MEASURES
from starloom.plans.models import (
    MODEL_TABLES,
    RELATIONSHIPS,
    UnrelatedError,
    caption,
    model_table,
    path_to,
    visible_columns,
)
from starloom.plans.queries import SALES_STAR, STARS, model

MONTHLY = ["date.calendar_year", "date.calendar_month", "customer.customer_segment"]


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_inventory_of_models():
    edges = [e for found in RELATIONSHIPS.values() for e in found]
    assert len(edges) == 78
    assert sum(e.active for e in edges) == 39
    assert len(MEASURES) == 87
    assert sum(len(tables) for tables in MODEL_TABLES.values()) == 27


def test_every_inactive_relationship_is_some_measures_role():
    for name, edges in RELATIONSHIPS.items():
        for edge in edges:
            if not edge.active:
                assert any(
                    m.home == edge.child and m.date_role == edge.child_key for m in MEASURES.values()
                ), (name, edge)


def test_every_active_relationship_is_in_a_registered_star():
    used = set()
    stars = [*STARS.values(), ("commercial", ["total_revenue"], SALES_STAR)]
    for name, measures, axis in stars:
        for attribute in axis:
            hops = path_to(name, MEASURES[measures[0]].home, attribute.split(".")[0], None)
            used |= {(name, e) for e in hops}
    assert {(name, e) for name, edges in RELATIONSHIPS.items() for e in edges if e.active} == used


def test_paths():
    hops = path_to("service", "work_orders", "employee", None)
    assert [h.parent for h in hops] == ["technician", "employee"]
    assert path_to("service", "asset", "customer", None) is None
    assert path_to("commercial", "customer", "date", None) is None
    assert path_to("commercial", "customer", "date", "created_on_key")[0].child_key == "created_on_key"
    (swapped,) = path_to("commercial", "sales", "date", "requested_date_key")
    assert swapped.child_key == "requested_date_key"


def test_model_columns(warehouse):
    widths = {}
    for name, tables in MODEL_TABLES.items():
        for table, gold in tables.items():
            columns = visible_columns(table, warehouse.table(gold).columns)
            labels = [caption(name, table, c) for c in columns]
            assert len(set(labels)) == len(labels)
            widths[name, table] = len(labels)
    assert sum(widths.values()) == 363
    assert widths["commercial", "orders"] == 15 and widths["service", "part_product"] == 9
    part = model_table("service", "part_product", warehouse.table("dim_product"))
    assert "Part Product Status" in part.columns and "List Price" not in part.columns


@pytest.mark.parametrize("name", sorted(MODEL_TABLES))
def test_broadcast_and_preaggregated_joins_agree(warehouse, rows, name):
    """All measures of a model, with every dimension small and with none small."""
    axis = {
        "commercial": ["date.calendar_year", "customer.customer_segment"],
        "supply_chain": ["date.calendar_year"],
        "service": ["date.calendar_year"],
    }[name]
    homes = {"commercial": "orders sales", "supply_chain": "purchase_orders shipments inventory",
             "service": "work_orders work_order_parts asset_daily_status"}[name].split()
    axis = axis + {"commercial": [], "supply_chain": ["facility.region_code"], "service": ["asset.criticality"]}[name]
    asked = [m.name for m in MEASURES.values() if m.home in homes]
    near = model(warehouse, name).rollup(asked, axis)
    far = model(warehouse, name, broadcast_bytes=0).rollup(asked, axis)
    assert near.columns == far.columns == [a.split(".")[1] for a in axis] + asked
    assert rows(near) == rows(far)


def test_snowflake_with_either_table_too_large_to_broadcast(warehouse, rows):
    asked = ["n_work_orders", "labor_cost"]
    axis = ["employee.department", "technician.skill_level"]
    filters = {"employee.job_level": ["Principal", "Experienced"]}
    results = []
    for large in ((), ("dim_employee",), ("dim_technician",), ("dim_employee", "dim_technician")):
        service = MetricModel("service", warehouse.table, lambda t: 2 if t in large else 0, 1)
        results.append(rows(service.rollup(asked, axis, filters=filters)))
    assert results[0] and all(r == results[0] for r in results)


def test_parts_sum_to_the_whole(warehouse):
    com = model(warehouse, "commercial")
    parts = com.rollup(["total_revenue", "n_orders_with_sales"], MONTHLY)
    whole = com.rollup(["total_revenue", "n_orders_with_sales"], []).first()
    assert total(parts, "total_revenue") == whole.total_revenue
    assert total(parts, "n_orders_with_sales") >= whole.n_orders_with_sales


def test_year_to_date_ends_at_the_year(warehouse):
    com = model(warehouse, "commercial")
    december = com.rollup(["total_revenue_ytd"], MONTHLY).where("calendar_month = 12")
    yearly = com.rollup(["total_revenue"], [MONTHLY[0], MONTHLY[2]])
    ends = {(r[0], r[2]): r[3] for r in december.collect()}
    assert ends == {(r[0], r[1]): r[2] for r in yearly.collect()}


def test_last_year_is_the_year_before(warehouse):
    com = model(warehouse, "commercial")
    now = {(r[0], r[1]): r[2] for r in com.rollup(["total_revenue"], MONTHLY[:2]).collect()}
    before = com.rollup(["total_revenue_ly"], MONTHLY[:2]).collect()
    assert {(r[0] - 1, r[1]): r[2] for r in before} == now


def test_subtotals_are_recomputed(warehouse):
    com = model(warehouse, "commercial")
    levels = com.subtotals(["n_orders_with_sales", "gross_margin_pct"], ["date.calendar_year", "date.calendar_quarter"])
    found = {r.level: [] for r in levels.collect()}
    for r in levels.collect():
        found[r.level].append(r)
    plain = com.rollup(["n_orders_with_sales", "gross_margin_pct"], []).first()
    assert (found[0][0].n_orders_with_sales, found[0][0].gross_margin_pct) == tuple(plain)
    yearly = com.rollup(["n_orders_with_sales", "gross_margin_pct"], ["date.calendar_year"])
    assert sorted((r.calendar_year, r[3], r[4]) for r in found[1]) == sorted(map(tuple, yearly.collect()))


def test_conditional_measure_is_blank_for_other_members(warehouse):
    by_status = model(warehouse, "commercial").rollup(["n_open_orders", "n_orders"], ["orders.order_status"])
    found = {r.order_status: r.n_open_orders for r in by_status.collect()}
    assert found["Open"] and found["Completed"] is None


def test_unrelated_attribute_repeats_or_is_refused(warehouse):
    service = model(warehouse, "service")
    rows = service.rollup(["n_assets"], ["customer.customer_segment"]).collect()
    assert {r.n_assets for r in rows} == {warehouse.table("dim_asset").count()}
    with pytest.raises(UnrelatedError):
        service.rollup(["n_assets"], ["customer.customer_segment"], unrelated="error")
    with pytest.raises(UnrelatedError):
        service.rollup(["n_assets"], ["asset.asset_type", "customer.customer_segment"])
    assert path_to("service", "technician", "facility", None) is None


def test_unknown_names_are_refused(warehouse):
    com = model(warehouse, "commercial")
    for measures, by, role in (
        (["n_work_orders"], [], None),
        (["n_orders"], ["facility.region_code"], None),
        (["n_orders"], ["date.calendar_year"], "received_date_key"),
    ):
        with pytest.raises(ValueError):
            com.rollup(measures, by, date_role=role)
    with pytest.raises(ValueError):
        com.rollup(["n_orders"], [], filters={"custmer.risk_tier": "High"})
    with pytest.raises(UnrelatedError):
        com.subtotals(["n_active_customers"], ["date.calendar_year"])


def test_filters_on_unrelated_dimensions_do_not_filter(warehouse):
    service = model(warehouse, "service")
    every = service.rollup(["n_assets"], ["asset.asset_type"])
    some = service.rollup(["n_assets"], ["asset.asset_type"], filters={"customer.customer_segment": "none"})
    assert sorted(every.collect()) == sorted(some.collect())


def test_filter_on_a_snowflaked_dimension(warehouse):
    service = model(warehouse, "service")
    by = service.rollup(["n_work_orders"], ["employee.department"])
    wanted = {r.department: r.n_work_orders for r in by.collect()}
    kept = service.rollup(["n_work_orders"], [], filters={"employee.department": "BUILDING"}).first()
    assert kept.n_work_orders == wanted["BUILDING"]


def test_date_filter_reaches_the_scan_as_a_range(warehouse):
    com = model(warehouse, "commercial")
    kept = com.rollup(["n_orders"], [], filters={"date.calendar_year": 1997})
    assert kept.first().n_orders == warehouse.table("fact_sales_order").where("year(order_date) = 1997").count()
    nothing = com.rollup(["n_orders"], [], filters={"date.calendar_year": 1800})
    assert nothing.first().n_orders is None


def test_shifted_measures_refuse_what_they_cannot_mean(warehouse):
    com = model(warehouse, "commercial")
    with pytest.raises(ValueError):
        com.rollup(["total_revenue_ytd"], ["date.calendar_month"])
    with pytest.raises(ValueError):
        com.rollup(["total_revenue_ytd"], [], filters={"date.calendar_month": 2})
    later = com.rollup(["total_revenue_ly"], ["date.calendar_year"], filters={"date.calendar_year": 1996})
    first = com.rollup(["total_revenue"], ["date.calendar_year"], filters={"date.calendar_year": 1995})
    assert later.first().total_revenue_ly == first.first().total_revenue


def test_shifted_measures_under_calendar_filters(warehouse):
    com = model(warehouse, "commercial")
    sales = warehouse.table("fact_sales_order_line").withColumn("month", F.expr("floor(order_date_key / 100)"))

    def revenue(low, high):
        return total(sales.where(F.col("month").between(low, high)), "line_revenue")

    years = {"date.calendar_year": 1996}
    february = com.rollup(["total_revenue_ly"], [], {**years, "date.month_name": "February"})
    assert february.first().total_revenue_ly == revenue(199502, 199502)
    spring = com.rollup(["total_revenue_ly"], ["date.calendar_year"], {**years, "date.calendar_month": [3, 4]})
    assert spring.first().total_revenue_ly == revenue(199503, 199504)
    so_far = com.rollup(["total_revenue_ytd"], [], {**years, "date.calendar_month": [3, 4]})
    assert so_far.first().total_revenue_ytd == revenue(199601, 199604)
    named = com.rollup(["total_revenue_ytd"], ["date.month_name"], {**years, "date.month_name": "May"})
    assert [tuple(r) for r in named.collect()] == [("May", revenue(199601, 199605))]
    assert com.rollup(["total_revenue_ly"], []).first().total_revenue_ly == total(sales, "line_revenue")


def test_hot_member_without_key(spark, rows):
    """A third of the facts on one customer, a third on none: results stay whole on both join paths."""
    facts = spark.range(9000).select(
        F.col("id").alias("sales_order_key"),
        F.expr("CASE id % 3 WHEN 0 THEN 5 WHEN 2 THEN id % 40 END").alias("customer_key"),
        F.lit(19970101).alias("order_date_key"),
        F.lit("2.50").cast("decimal(18,2)").alias("line_revenue"),
    )
    customers = spark.range(30).select(
        F.col("id").alias("customer_key"), (F.col("id") % 4).cast("string").alias("customer_segment")
    )
    dates = spark.createDataFrame([(19970101, 1997)], "date_key int, calendar_year int")
    tables = {"fact_sales_order_line": facts, "dim_customer": customers, "dim_date": dates}
    expected = {}
    for i in range(9000):
        key = 5 if i % 3 == 0 else None if i % 3 == 1 else i % 40
        segment = str(key % 4) if key is not None and key < 30 else None
        expected[segment] = expected.get(segment, 0) + 1
    for limit in (0, 10**9):
        com = MetricModel("commercial", tables.__getitem__, lambda t: 1, limit)
        found = com.rollup(
            ["total_revenue", "n_orders_with_sales"],
            ["date.calendar_year", "customer.customer_segment"],
        )
        assert rows(found) == sorted(
            ((1997, s, n * Decimal("2.50"), n) for s, n in expected.items()), key=repr
        )


def test_year_to_date_fills_gaps(spark, rows):
    frame = spark.createDataFrame(
        [(2000, 2, "a", 10), (2000, 5, "a", 5), (2001, 12, "a", 1), (2000, 1, None, 7)],
        "calendar_year int, calendar_month int, segment string, v bigint",
    )
    found = periods.year_to_date(frame, ["calendar_year", "calendar_month"], ["segment"], ["v"])
    expected = [(2000, m, "a", 10 if m < 5 else 15) for m in range(2, 13)]
    expected += [(2001, 12, "a", 1)] + [(2000, m, None, 7) for m in range(1, 13)]
    assert rows(found) == sorted(expected, key=repr)


def test_last_year_by_day_maps_both_february_days(spark, rows):
    calendar = spark.sql(
        "SELECT explode(sequence(date'1999-01-01', date'2001-12-31')) AS full_date"
    ).withColumn("calendar_year", F.year("full_date"))
    frame = spark.createDataFrame(
        [(date(1999, 2, 28), 3), (date(2000, 2, 29), 9), (date(2001, 3, 1), 4)], "full_date date, v int"
    )
    found = periods.same_period_last_year(frame, ["full_date"], calendar)
    assert rows(found) == [(date(2000, 2, 28), 3), (date(2000, 2, 29), 3)]


def test_formats(spark):
    df = spark.sql("SELECT 1234.5D AS v, -1234.5D AS w, 12.34567D AS p, cast(null as double) AS n")
    row = df.select(
        formatted(F.col("v"), "$#,##0.00"), formatted(F.col("w"), "$#,##0.00"),
        formatted(F.col("p"), "0.00%"), formatted(F.col("v"), "#,##0.0"), formatted(F.col("n"), "#,##0"),
    ).first()
    assert tuple(row) == ("$1,234.50", "-$1,234.50", "1234.57%", "1,234.5", None)


def test_filters_see_the_blank_member(spark, warehouse):
    """Orders without a customer row are the blank member, with and without broadcasts."""
    facts = warehouse.table("fact_sales_order").limit(4).select("*")
    rows = facts.collect()
    lost = [r.customer_key for r in rows[:2]]

    def tables(name):
        if name == "fact_sales_order":
            return spark.createDataFrame(rows, facts.schema)
        if name == "dim_customer":
            return warehouse.table(name).where(~F.col("customer_key").isin(lost))
        return warehouse.table(name)

    kept = sum(r.customer_key not in lost for r in rows)
    for limit in (10**9, 0):
        com = MetricModel("commercial", tables, lambda _: 1, limit)

        def count(wanted):
            return com.rollup(["n_orders"], [], {"customer.risk_tier": wanted}).first().n_orders

        assert count(lambda t: t.isNull()) == 4 - kept
        high = count("High") or 0
        assert count(lambda t: ~t.eqNullSafe("High")) == 4 - high


def test_strict_queries_refuse_filters_out_of_reach(warehouse):
    service = model(warehouse, "service")
    with pytest.raises(UnrelatedError):
        service.rollup(["n_assets"], [], {"customer.risk_tier": "High"}, unrelated="error")


def test_blank_rules(spark, warehouse):
    """A blank key is one more value; a blank date of receipt is early, a blank status not open."""
    facts = warehouse.table("fact_purchase_order_line")
    two = facts.where("purchase_order_status != 'Open'").limit(2)
    blank = facts.limit(1).withColumns(
        {name: F.lit(None).cast(facts.schema[name].dataType)
         for name in ("purchase_order_id", "received_date", "purchase_order_status")}
    )
    rows = two.union(blank).union(blank)
    later = rows.withColumn(
        "received_date", F.when(F.col("received_date").isNotNull(), F.date_add("expected_date", 1))
    ).collect()

    def tables(name):
        return spark.createDataFrame(later, rows.schema) if name == "fact_purchase_order_line" else warehouse.table(name)

    found = MetricModel("supply_chain", tables, lambda _: 1).rollup(
        ["n_purchase_orders", "on_time_receipt_rate"], []
    ).first()
    known = {r.purchase_order_id for r in later} - {None}
    assert found.n_purchase_orders == len(known) + 1
    assert found.on_time_receipt_rate == 0.5
