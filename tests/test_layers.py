"""The layered load: rows kept and rejected, against SQL over the same dirty files."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from oracles.operator_sql import operator_sql
from starloom.operators.conform import conform, screen
from starloom.plans import layers
from starloom.plans import publish as p
from starloom.plans.queries import QUERIES
from starloom.sources.landing import Landing
from starloom.sources.store import TableStore
from tests.test_publish import content

LOADED = datetime(2024, 1, 31, 6)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"{tmp_path}/store")


def test_layered_load_ends_in_the_same_gold(spark, warehouse, store):
    manifest = {r.table_name: r for r in layers.load_bronze(warehouse.landing, store, "run-7", LOADED).collect()}
    assert len(manifest) == 26 and manifest["raw.lineitem"].row_count == warehouse.landing("lineitem").count()
    assert {"ingestion_timestamp", "pipeline_run_id", "source_system", "source_file"} <= set(store.read("raw.part").columns)
    assert {"ingestion_timestamp", "pipeline_run_id", "source_system"} <= set(store.read("bronze.customer_raw").columns)
    told = layers.load_silver(store).collect()
    assert len(told) == 26
    assert all(r.raw_rows == r.null_keys + r.unbound_codes + r.repeated_rows + r.conformed_rows for r in told)
    layers.load_gold(store)
    for name in p.GOLD_TABLES:
        assert content(store.read(f"gold.{name}")) == content(warehouse.table(name)), name


def test_intermediate_tables_of_a_load_are_deleted(spark, warehouse, store, tmp_path):
    layers.load_bronze(warehouse.landing, store, "run-7", LOADED)
    layers.load_silver(store)
    assert [name for name in store.snapshot() if name.startswith("work.")] == ["work.sources"]
    assert [f.name for f in (tmp_path / "store/work").iterdir() if any(f.iterdir())] == ["sources"]


def test_a_table_that_is_large_unpacked_is_not_broadcast(spark, store):
    """Half a million keys beside repeated texts are a small file, of which the keys count as a small share."""
    from starloom.sources.store import FILE_FACTOR, size_shuffles

    texts = {f"t{k}": F.repeat(F.lit("text "), 4) for k in range(3)}
    keys = spark.range(0, 500_000, 1, 1).select(F.xxhash64("id").alias("id"))
    lookup = store.write("a.lookup", keys.withColumns(texts)).select("id")
    rows = store.write("a.rows", keys.withColumn("more", F.rand(1)))
    before = spark.conf.get(FILE_FACTOR, None)

    def plan():
        return rows.join(lookup, "id")._jdf.queryExecution().sparkPlan().toString()

    try:
        spark.conf.unset(FILE_FACTOR)
        assert "Broadcast" in plan()
        size_shuffles(spark, 10**6)
        assert "Broadcast" not in plan()
        spark.conf.set(FILE_FACTOR, "1.0")
        size_shuffles(spark, 10**6)
        assert spark.conf.get(FILE_FACTOR) == "1.0"
    finally:
        spark.conf.unset(FILE_FACTOR) if before is None else spark.conf.set(FILE_FACTOR, before)


def test_few_rows_are_broadcast_by_their_number(spark, monkeypatch):
    from starloom.operators import joins

    lookup, hinted = spark.range(100), lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(joins.broadcast_if_few(lookup))
    monkeypatch.setattr(joins, "MOST_BROADCAST_ROWS", 99)
    assert not hinted(joins.broadcast_if_few(lookup))


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """Landing files: 3 lines without a key, 5 lines too many for theirs, 2 with unknown codes; odd orders."""
    folder = tmp_path_factory.mktemp("dirty")
    from tests.conftest import SMALL

    for table in p.LANDING_TABLES:
        raw = spark.read.parquet(f"{SMALL}/{table}.parquet")
        if table == "lineitem":
            raw = conform(raw, ["l_orderkey", "l_linenumber"]).orderBy("l_orderkey", "l_linenumber")
            first = raw.limit(10)
            null = F.lit(None).cast("bigint")
            extra = [
                first.limit(2).withColumn("l_orderkey", null),
                first.limit(1).withColumn("l_linenumber", F.lit(None).cast(raw.schema["l_linenumber"].dataType)),
                first.limit(2), first.limit(2), first.limit(1).withColumn("l_quantity", F.col("l_quantity") + 1),
                first.limit(1).withColumn("l_returnflag", F.lit("?")),
                first.limit(1).withColumn("l_linestatus", F.lit("x")),
                first.limit(1).withColumn("l_orderkey", null).withColumn("l_linestatus", F.lit("x")).limit(0),
            ]
            for part in extra:
                raw = raw.unionByName(part)
        if table == "orders":
            keys = raw.orderBy("o_orderkey").limit(4).withColumn("o_orderkey", -F.col("o_orderkey") - 5)
            raw = raw.unionByName(keys.withColumn("o_orderstatus", F.lit("Z"))).unionByName(
                raw.limit(3).withColumn("o_orderpriority", F.lit("9-NEVER"))
            )
        raw.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


def by_sql(folder, name):
    connection = duckdb.connect()
    for table in p.LANDING_TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    found = connection.sql(operator_sql()[name])
    return [dict(zip(found.columns, row)) for row in found.fetchall()]


def test_rejects_are_counted_from_landing(spark, dirty, store):
    landing = Landing(spark, dirty)
    layers.load_bronze(landing, store, "run-1", LOADED)
    told = {r.table_name: r.asDict() for r in layers.load_silver(store).collect()}
    lines = told["conformed.lineitem"]
    assert (lines["null_keys"], lines["repeated_rows"], lines["unbound_codes"]) == (3, 5, 2)
    assert told == {r["table_name"]: r for r in by_sql(dirty, "silver_load")}


def test_quarantine_tells_reason_and_file(spark, dirty, store):
    landing = Landing(spark, dirty)
    layers.load_raw(landing, store, "run-1", LOADED)
    layers.screen_sources(store)
    report = [r.asDict() for r in layers.rejected_rows(store).collect()]
    assert all(r["source_file"].endswith(".parquet") for r in report)
    plain = sorted((r["table_name"], r["reject_reason"], r["row_count"]) for r in report)
    assert plain == sorted((r["table_name"], r["reject_reason"], r["row_count"]) for r in by_sql(dirty, "quarantine_report"))
    assert ("lineitem", "unbound code: l_returnflag", 1) in plain and ("orders", "unbound code: o_orderpriority", 3) in plain
    rejects = store.read("quarantine.landing_lineitem")
    assert {"l_orderkey", "source_file", "pipeline_run_id", "reject_reason", "copies"} <= set(rejects.columns)


def test_dirty_files_give_one_gold_by_either_way(spark, dirty, store):
    layers.load_bronze(Landing(spark, dirty), store, "run-1", LOADED)
    layers.load_silver(store)
    layers.load_gold(store)
    direct = p.Warehouse(spark, Landing(spark, dirty), TableStore(spark, f"{store.folder}-direct"))
    for name in ("fact_sales_order_line", "fact_sales_order", "dim_asset", "dim_sales_channel"):
        assert content(store.read(f"gold.{name}")) == content(direct.table(name)), name
    rows = {r["table_name"]: r["raw_rows"] for r in by_sql(dirty, "silver_load")}
    assert rows["silver.sales_order"] == direct.table("fact_sales_order").count()


def test_screen_against_brute_force_on_a_hot_key(spark, store):
    import random

    r = random.Random(6)
    data = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else None if i % 10 == 1 else r.randrange(500)
        data.append((key, r.choice("abc?"), r.randrange(4), f"file{i % 7}"))
    df = spark.createDataFrame(data, "k int, code string, v int, place string").repartition(9)
    made = screen(df, ["k"], {"code": F.col("code").isin("a", "b", "c")}, store.write_work, place=["place"])
    best, lost = {}, {}
    for row in data:
        k, code, v, place = row
        if k is None or code == "?":
            reason = "null key" if k is None else "unbound code: code"
            lost[(*row, reason)] = lost.get((*row, reason), 0) + 1
        elif k not in best or (code, v, place) < best[k][1:]:
            best[k] = row
    for row in data:
        if row[0] is not None and row[1] != "?":
            mine = (*row, "repeated key")
            lost[mine] = lost.get(mine, 0) + 1
    for row in best.values():
        lost[(*row, "repeated key")] -= 1
    assert sorted(map(tuple, made.kept.collect())) == sorted(best.values())
    found = {}
    for x in made.rejected.collect():
        place = tuple(x[:5])
        found[place] = found.get(place, 0) + x.copies
    assert found == {k: n for k, n in lost.items() if n}
    assert [tuple(x) for x in conform(df.drop("place"), ["k"], {"code": F.col("code").isin("a", "b", "c")}).orderBy("k").collect()] == [
        x[:3] for x in sorted(best.values())
    ]


def test_screen_of_keys_alone_and_of_nothing(spark, store):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    made = screen(df, ["k"], {}, store.write_work)
    assert sorted(r.k for r in made.kept.collect()) == [1, 2]
    assert sorted((r.reject_reason, r.copies) for r in made.rejected.collect()) == [("null key", 1), ("repeated key", 1)]
    empty = screen(df.limit(0), ["k"], {}, store.write_work)
    assert empty.kept.collect() == [] and empty.rejected.collect() == []


def test_a_load_that_loses_rows_stops(spark, warehouse, store, monkeypatch):
    layers.load_raw(warehouse.landing, store, "run-1", LOADED)
    found = layers.screen
    monkeypatch.setattr(layers, "screen", lambda *a: found(*a)._replace(kept=found(*a).kept.limit(1)))
    with pytest.raises(layers.ReconciliationError, match="raw.lineitem|raw."):
        layers.screen_sources(store)


def test_registered_load_equals_sql_on_the_given_files(warehouse):
    assert QUERIES["quarantine_report"](warehouse).count() == 1
