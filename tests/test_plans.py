"""What the planner makes of the queries."""

import contextlib
import io
import re

import pytest

from starloom.plans.queries import QUERIES

# These run jobs of their own before they return a plan.
EAGER = {
    "bronze_load", "silver_load", "gold_load", "quarantine_report", "clustered_rewrite", "compacted_facts",
    "curve_clustered_scan", "validation_summary", "calendar_bounds", "calendar_days",
    "incremental_conform", "sales_dashboard_stored",
}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas")


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python(warehouse, name):
    text = plan(QUERIES[name](warehouse))
    assert not [word for word in UNWANTED if word in text]
    assert not ("Window" in text and re.search(r"SinglePartition[^\n]*\n[^\n]*Window", text))


def test_scan_reads_only_the_columns_asked_for(warehouse):
    text = plan(QUERIES["m_total_revenue"](warehouse), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    fact = next(s for s in schemas if "line_revenue" in s)
    assert [column.split(":")[0] for column in re.findall(r"\w+:\w+", fact)] == [
        "line_revenue", "customer_key", "order_date_key",
    ]


def test_filters_reach_the_scans(warehouse):
    text = plan(QUERIES["filtered_rollup"](warehouse), "formatted")
    assert "GreaterThanOrEqual(quantity,10.00)" in text
    assert "In(customer_segment, [BUILDING,MACHINERY])" in text
    assert re.search(r"order_date_key#\d+ >= .*[Ss]ubquery", text)


def test_rows_are_counted_before_they_are_shuffled(warehouse):
    """Dedup and guards aggregate on both sides of the exchange."""
    for name in ("conform_dedup", "safe_left_join", "check_foreign_keys"):
        text = plan(QUERIES[name](warehouse))
        assert "partial_min" in text or "partial_count" in text


def test_references_need_no_join(warehouse):
    """42 references are one grouping: only the short list of checks is joined."""
    for name in ("check_foreign_keys", "check_date_keys"):
        text = plan(QUERIES[name](warehouse))
        assert text.count("Join") == 1 and "SortMergeJoin" not in text


def test_repeated_keys_are_found_without_a_sort(warehouse):
    from starloom.operators.conform import duplicate_keys

    text = plan(duplicate_keys(warehouse.landing("lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "Sort" not in text and "partial_count" in text


def test_far_filters_come_before_the_grouping(spark, warehouse):
    """Without broadcasts, rows that a far filter drops are dropped before they are grouped."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(QUERIES["far_filtered_rollup"](warehouse))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    fact = [x for x in text.splitlines() if "FileScan" in x and "line_revenue" in x]
    assert len(fact) == 1
    lines = text.splitlines()
    partial = next(i for i, x in enumerate(lines) if "partial_sum(line_revenue" in x)
    # right below the first partial aggregate is the filter, and below that the scan: no exchange, no join
    assert "Filter" in lines[partial + 1] and "xxhash64(customer_key" in lines[partial + 1]
    assert fact[0].index("+- ") - lines[partial + 1].index("+- ") <= 6
    assert "LeftSemi" not in text


def test_filters_on_blanks_are_folded(warehouse):
    """Whether a filter keeps the blank member costs no job and leaves nothing in the plan."""
    from starloom.plans.queries import model

    keeping = model(warehouse, "service").rollup(["n_alerts"], ["asset.criticality"], {"date.calendar_year": lambda y: y.isNull()})
    assert "Subquery" not in plan(keeping)
    refusing = model(warehouse, "service").rollup(["n_alerts"], ["asset.criticality"], {"date.calendar_year": 1997})
    assert "Subquery" in plan(refusing)


def test_repeated_totals_meet_members_by_a_broadcast(warehouse):
    text = plan(QUERIES["m_n_assets"](warehouse))
    assert "collect_set" not in text and "BroadcastHashJoin" in text and "NestedLoop" not in text


def test_calendar_bounds_come_from_footers(warehouse):
    """Least and greatest dates of a fact are asked of file footers: no column is read."""
    from pyspark.sql import functions as F

    from starloom.operators.calendar import date_range
    from starloom.sources.footers import footer_session, opened_for_footers

    session = footer_session(warehouse.spark)
    fact = opened_for_footers(session, warehouse.store, "gold.fact_shipment")
    asked = date_range(fact, ["ship_date", "promised_delivery_date"], "x")
    text = plan(asked, "formatted")
    assert "PushedAggregation: [MIN(ship_date), MIN(promised_delivery_date)" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert schema.startswith("min(ship_date):date")
    plain = date_range(warehouse.table("fact_shipment"), ["ship_date", "promised_delivery_date"], "x")
    assert asked.first() == plain.first()
    counted = fact.agg(F.count("*"))
    assert "PushedAggregation: [COUNT(*)]" in plan(counted, "formatted")


def test_footers_without_values(spark, tmp_path):
    """A column that holds nothing in a file is read instead; an empty table has no bounds."""
    from pyspark.sql import functions as F

    from starloom.sources.footers import from_footers
    from starloom.sources.store import TableStore

    store = TableStore(spark, str(tmp_path))
    days = spark.range(10).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    store.write("gold.some", days.union(days.select(F.lit(None).cast("date")).limit(1)).repartition(11))
    store.write("gold.none", days.select(F.lit(None).cast("date").alias("d")))
    store.write("gold.empty", days.limit(0))

    def ask(opened):
        return [tuple(opened(f"gold.{n}").agg(F.min("d"), F.max("d"), F.count("*")).first()) for n in ("some", "none", "empty")]

    found = from_footers(store, ask)
    assert [str(x) for x in found[0]] == ["2020-01-01", "2020-01-10", "11"]
    assert found[1:] == [(None, None, 10), (None, None, 0)]
