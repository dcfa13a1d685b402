import os
import subprocess
import sys
import threading
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import JoinGuardError
from starloom.operators.layout import rewrite_clustered
from starloom.plans import publish as p
from starloom.sources.landing import Landing
from starloom.sources.store import TableStore, folder_state, size_shuffles, stamp_lineage

LOADED = datetime(2024, 1, 31, 6)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def content(df):
    ordered = df.select(*sorted(df.columns))
    return ordered.agg(F.count("*"), F.sum(F.xxhash64(*ordered.columns).cast("decimal(38,0)"))).first()


def test_publishing_twice_gives_equal_tables(spark, warehouse, store):
    again = p.Warehouse(spark, Landing(spark, warehouse.landing.folder), store)
    again.publish_all()
    for name in p.GOLD_TABLES:
        assert content(again.table(name)) == content(warehouse.table(name)), name


def test_publish_refuses_orphans_and_repeated_parents(spark, warehouse):
    lines = warehouse.entity("shipment")
    orders = warehouse.table("fact_sales_order")
    lacking = orders.where("sales_order_key % 2 = 0")
    with pytest.raises(JoinGuardError, match="lacks"):
        p.publish("fact_shipment", lines, lambda name: lacking)
    with pytest.raises(JoinGuardError, match="repeat"):
        p.publish("fact_shipment", lines, lambda name: orders.union(orders))


def gold_tables(warehouse):
    return {name for name in warehouse.store.snapshot() if name.startswith("gold.")}


def test_the_calendar_is_published_without_the_facts(spark, warehouse, store):
    """Its bounds are those of all tables, published or not; each table is written when it is asked for."""
    alone = p.Warehouse(spark, Landing(spark, warehouse.landing.folder, this_year=2060), store)
    assert alone.calendar_bounds().first().end_date.year == 2065 and not gold_tables(alone)
    days = alone.table("dim_date")
    assert gold_tables(alone) == {"gold.dim_date"}
    assert content(days.where("calendar_year <= 2052")) == content(warehouse.table("dim_date"))


def test_calendar_bounds_see_every_unpublished_entity(spark, warehouse, store, monkeypatch):
    """A date that one entity alone has moves the calendar, whether its table is stored or not."""
    late = p.Warehouse(spark, Landing(spark, warehouse.landing.folder), store)
    bound = late._bound
    for entity, dates in p.DATE_COLUMNS.items():
        shift = F.lit("2070-01-01").cast("date")
        moved = lambda name, e=entity, d=dates: bound(name).withColumn(d[-1], shift) if name == e else bound(name)
        monkeypatch.setattr(late, "_bound", moved)
        assert late.calendar_bounds().first().end_date.year == 2070, entity
    monkeypatch.setattr(late, "_bound", bound)
    late.table("fact_work_order")
    assert late.calendar_bounds().first() == warehouse.calendar_bounds().first()


def test_the_calendar_still_guards_tables_that_are_not_published(spark, warehouse, store, monkeypatch):
    lacking = p.Warehouse(spark, Landing(spark, warehouse.landing.folder), store)
    bound = lacking._bound
    monkeypatch.setattr(
        lacking, "_bound", lambda name: bound(name).where("asset_key % 2 = 0") if name == "asset" else bound(name)
    )
    with pytest.raises(JoinGuardError, match="to dim_asset: .* lacks"):
        lacking.table("dim_date")
    assert not gold_tables(lacking)


def test_warehouse_follows_the_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    before = folder_state(spark, f"{tmp_path}/t.parquet")
    assert folder_state(spark, f"{tmp_path}/t.parquet") == before
    spark.range(4).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert folder_state(spark, f"{tmp_path}/t.parquet") != before


def test_open_warehouse_is_reused(spark, warehouse):
    assert p.open_warehouse(spark, warehouse.landing.folder) is warehouse


def test_table_may_replace_itself(spark, store, rows):
    store.write("gold.t", spark.range(3).toDF("k"))
    store.write("gold.t", store.read("gold.t").where("k > 0"))
    assert rows(store.read("gold.t")) == [(1,), (2,)]
    store.register("gold", "starloom_test")
    assert rows(spark.sql("SELECT * FROM starloom_test.t")) == [(1,), (2,)]
    spark.sql("DROP DATABASE starloom_test CASCADE")


def test_clustered_rewrite_keeps_rows_and_sorts_files(spark, warehouse, store):
    fact = warehouse.table("fact_sales_order_line")
    store.write("gold.f", fact)
    rewritten = rewrite_clustered(store, "gold.f", "order_date_key", "sales_order_line_key")
    assert content(rewritten) == content(fact)
    in_order = rewritten.select("order_date_key", F.input_file_name().alias("file"))
    for (file,) in in_order.select("file").distinct().collect():
        days = [r.order_date_key for r in in_order.where(F.col("file") == file).collect()]
        assert days == sorted(days)


def test_lineage_columns(spark):
    row = stamp_lineage(spark.range(1), "src", "run-1", LOADED).select(
        F.col("ingestion_timestamp").cast("string"), "pipeline_run_id", "source_system"
    ).first()
    assert tuple(row) == ("2024-01-31 06:00:00", "run-1", "src")


def test_landing_tables_with_repeated_and_missing_keys(spark, warehouse, tmp_path):
    """Copies of whole landing tables and rows without keys change nothing."""
    folder = warehouse.landing.folder
    for table in p.LANDING_TABLES:
        raw = spark.read.parquet(f"{folder}/{table}.parquet")
        keyless = raw.limit(5).withColumn(raw.columns[0], F.lit(None).cast(raw.schema[0].dataType))
        dirty = raw.union(raw).union(keyless) if table != "lineitem" else raw.union(keyless)
        dirty.write.parquet(f"{tmp_path}/{table}.parquet")
    store = TableStore(spark, f"{tmp_path}/store")
    dirty = p.Warehouse(spark, Landing(spark, str(tmp_path)), store)
    for name in ("dim_customer", "dim_asset", "dim_employee", "fact_sales_order_line", "fact_asset_daily_status"):
        assert content(dirty.table(name)) == content(warehouse.table(name)), name


def test_shuffles_are_sized_for_large_inputs_only(spark):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size_shuffles(spark, 10**6)
    assert spark.conf.get(setting, None) is None
    try:
        size_shuffles(spark, 100 * 10**12)
        assert int(spark.conf.get(setting)) == 745_059
        size_shuffles(spark, 10**13)
        assert int(spark.conf.get(setting)) == 745_059
    finally:
        spark.conf.unset(setting)


def test_tasks_take_modest_parts_unless_the_session_says_more(spark, monkeypatch):
    from starloom.sources import store

    monkeypatch.setattr(store, "TASK_BYTES", 33 << 20)
    before = {name: spark.conf.get(name, None) for name in store.TASK_SETTINGS}
    try:
        first, second = store.TASK_SETTINGS
        spark.conf.unset(first)
        spark.conf.set(second, "48m")
        size_shuffles(spark, 10**6)
        assert (spark.conf.get(first), spark.conf.get(second)) == (str(33 << 20), "48m")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_gigabyte_is_shuffled_in_modest_parts(spark):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        size_shuffles(spark, 10**9)
        assert int(spark.conf.get(setting)) == 60
    finally:
        spark.conf.unset(setting)


def test_shuffle_files_go_with_their_job(tmp_path):
    """In a job of its own: a written table leaves no shuffle files behind, whatever the driver collects."""
    code = f"""
import gc, time
from pathlib import Path
from pyspark.sql import SparkSession
from starloom.sources.store import TableStore, size_shuffles
gc.disable()
conf = {{"spark.ui.enabled": "false", "spark.local.dir": "{tmp_path}/local", "spark.sql.shuffle.partitions": "3",
        "spark.sql.warehouse.dir": "{tmp_path}/tables"}}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
size_shuffles(spark, 10**6)
rows = spark.range(0, 100_000, 1, 4).groupBy("id").count()
stored = TableStore(spark, "{tmp_path}/store").write("a.t", rows)
until = time.time() + 20
while time.time() < until and any(Path("{tmp_path}/local").rglob("shuffle_*.data")):
    time.sleep(0.2)
print("left", len([*Path("{tmp_path}/local").rglob("shuffle_*.data")]), "rows", stored.count())
print("again", len(rows.limit(5).collect()), rows.count())
"""
    env = {name: value for name, value in os.environ.items() if name != "SPARK_LOCAL_DIRS"}
    found = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=240, cwd=Path(__file__).parent.parent, env=env
    )
    assert "left 0 rows 100000" in found.stdout and "again 5 100000" in found.stdout, found.stderr[-2000:]


def test_a_session_may_keep_its_shuffle_files(spark):
    from starloom.sources.store import SHUFFLE_CLEANUP

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    try:
        spark.conf.set(SHUFFLE_CLEANUP, "false")
        size_shuffles(spark, 10**6)
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
        spark.conf.unset(SHUFFLE_CLEANUP)
        size_shuffles(spark, 10**6)
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def test_fewer_jobs_run_at_once_the_more_they_read(spark):
    from starloom.sources import store

    fills = spark.sparkContext.defaultParallelism * store.TASK_BYTES
    assert store.jobs_at_once(spark, 0) == store.jobs_at_once(spark, fills) == store.JOBS_AT_ONCE
    assert store.jobs_at_once(spark, 2 * fills) == store.JOBS_AT_ONCE // 2
    assert store.jobs_at_once(spark, 10**15) == store.FEWEST_JOBS_AT_ONCE
    seen, most = [0, 0], threading.Lock()

    def job(name):
        with most:
            seen[0] += 1
            seen[1] = max(seen)
        time.sleep(0.05)
        with most:
            seen[0] -= 1
        return name

    assert store.side_by_side(job, "abcdef", 2) == list("abcdef") and seen[1] == 2


def test_tables_are_stored_with_the_smaller_codec(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("a.t", spark.range(10))
    assert list(tmp_path.glob("a/t/v*/*.zstd.parquet"))


def listing(folder):
    return sorted((str(f), f.stat().st_mtime_ns) for f in folder.rglob("*") if f.is_file())


def test_published_tables_outlive_the_session_that_wrote_them(spark, warehouse, tmp_path):
    from starloom.plans.queries import QUERIES

    folder, home = warehouse.landing.folder, tmp_path / "home"
    with pytest.raises(p.NotPublishedError):
        p.open_published(spark, folder, str(home)).table("dim_customer")
    p.publish_warehouse(spark, folder, str(home))
    before = listing(home)
    later = p.open_published(spark.newSession(), folder, str(home))
    for name in ("m_n_orders", "m_total_revenue_ytd", "check_unique"):
        assert content(QUERIES[name](later)) == content(QUERIES[name](warehouse)), name
    for name in p.GOLD_TABLES:
        assert content(later.table(name)) == content(warehouse.table(name)), name
    assert listing(home) == before
    p.publish_warehouse(spark, folder, str(home))  # nothing is left to do
    assert listing(home) == before
    with pytest.raises(p.NotPublishedError):
        p.open_published(spark, folder, str(home), as_of="1999-01-01").table("fact_shipment")
