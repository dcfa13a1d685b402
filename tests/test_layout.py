"""Layout of files: bin packing, compaction, the curve, and files left out by their ranges."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout
from starloom.plans import publish as p
from starloom.sources.manifest import Manifests
from starloom.sources.store import TableStore
from tests.test_publish import content


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"{tmp_path}/store")


def test_packing_is_first_fit_decreasing():
    r = random.Random(3)
    for _ in range(200):
        capacity = r.randint(1, 50)
        sizes = [r.randint(0, 60) for _ in range(r.randint(0, 40))]
        plain = []
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            need = min(sizes[k], capacity)
            for held in plain:
                if sum(min(sizes[x], capacity) for x in held) + need <= capacity:
                    held.append(k)
                    break
            else:
                plain.append([k])
        assert layout.pack(sizes, capacity) == plain


def files_of(store, name):
    stored = store.stored(name)
    if stored.listed:
        return {Path(r.path.removeprefix("file:")).name for r in store.spark.read.parquet(stored.path).collect()}
    return {f.name for f in Path(stored.path.removeprefix("file:")).glob("part-*.parquet")}


def uneven(spark, store, name="gold.t"):
    """Two large files and forty small ones of one table."""
    big = spark.range(0, 400_000, 1, 2).select("id", F.xxhash64("id").alias("v"))
    small = spark.range(400_000, 404_000, 1, 40).select("id", F.xxhash64("id").alias("v"))
    return store.write(name, big.union(small))


def test_only_small_files_are_rewritten(spark, store):
    rows = uneven(spark, store)
    before, old, sums = files_of(store, "gold.t"), store.stored("gold.t"), content(rows)
    made = layout.compact(store, "gold.t", file_bytes=400_000)
    assert (made.kept, made.merged) == (2, 40) and 1 <= made.written <= 3
    after = files_of(store, "gold.t")
    assert len(after) == 2 + made.written and len(after & before) == 2
    assert content(store.read("gold.t")) == sums and store.read("gold.t").schema == rows.schema
    assert store.size_in_bytes("gold.t") > 0
    assert content(store.spark.read.parquet(old.path)) == sums  # nothing was deleted
    again = layout.compact(store, "gold.t", file_bytes=400_000)
    assert again.merged == 0 and files_of(store, "gold.t") == after


def test_compaction_shuffles_no_row(spark, store, monkeypatch):
    """A file is read by the task that writes the one it goes into, in several jobs if there are many."""

    def refused(*_):
        raise AssertionError("rows are shuffled")

    rows = uneven(spark, store)
    sums = content(rows)
    for shuffle in ("repartition", "repartitionById", "repartitionByRange"):
        monkeypatch.setattr(type(rows), shuffle, refused)
    monkeypatch.setattr(layout, "MOST_MERGED_AT_ONCE", 3, raising=False)
    made = layout.compact(store, "gold.t", file_bytes=6_000)
    assert made.kept + made.merged == 42 and made.merged > 30 and made.written > 3
    assert len(files_of(store, "gold.t")) == made.kept + made.written and content(store.read("gold.t")) == sums


def test_compaction_beside_leaves_the_table(spark, store, tmp_path):
    uneven(spark, store)
    other = TableStore(spark, f"{tmp_path}/other")
    before = store.stored("gold.t")
    layout.compact(store, "gold.t", into=other, file_bytes=400_000)
    assert store.stored("gold.t") == before and content(other.read("gold.t")) == content(store.read("gold.t"))
    store.write("gold.e", spark.range(0).toDF("id"))
    assert layout.compact(store, "gold.e").merged == 0 and store.read("gold.e").count() == 0


def test_old_files_stay_while_a_list_or_a_manifest_names_them(spark, store):
    uneven(spark, store)
    manifests = Manifests(spark, store.folder)
    manifests.commit(store.snapshot(), {})
    layout.compact(store, "gold.t", file_bytes=400_000)
    manifests.commit(store.snapshot(), {})
    sums = content(store.read("gold.t"))
    assert store.drop_old_versions() == 0  # the list still holds two files of the first version
    store.write("gold.t", store.read("gold.t"))
    assert store.drop_old_versions(manifests.named_folders()) == 0
    for number in (1, 2):
        assert content(TableStore(spark, store.folder, at=manifests.read(number).tables).read("gold.t")) == sums
    assert store.drop_old_versions() == 3 and content(store.read("gold.t")) == sums


def test_a_reader_in_the_middle_of_a_compaction(spark, store):
    uneven(spark, store)
    Manifests(spark, store.folder).commit(store.snapshot(), {})
    reader = TableStore(spark, store.folder, at=Manifests(spark, store.folder).latest().tables)
    layout.compact(store, "gold.t", file_bytes=400_000)
    assert files_of(reader, "gold.t") != files_of(store, "gold.t")
    assert content(reader.read("gold.t")) == content(store.read("gold.t"))


def test_curve_interleaves(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(pairs, "a long, b long")
    found = {(r.a, r.b): r.z for r in df.select("a", "b", layout.curve([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    for a, b in pairs:
        bits = "".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}"))
        assert found[a, b] == int(bits, 2)


def test_boxes_are_halves_of_halves():
    r = random.Random(2)
    for _ in range(50):
        rows_at = {r.randrange(64): r.randint(1, 30) for _ in range(r.randint(0, 60))}
        made = layout.boxes(rows_at, 6, 40)
        assert set(made) == set(rows_at)
        for first in {f for f, _ in made.values()}:
            own = sorted(p for p, (f, _) in made.items() if f == first)
            assert sum(rows_at[p] for p in own) <= 40
            size = 1
            while own[0] // size != own[-1] // size:
                size *= 2
            inside = {p for p in rows_at if p // size == own[0] // size}
            assert inside == set(own)
    assert layout.boxes({5: 100, 6: 1}, 3, 30) == {5: (0, 4), 6: (4, 1)}


def test_a_filter_on_any_column_meets_few_files(spark, store):
    """Three independent columns: a filter on one alone meets about an eighth of the files."""
    spread = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).alias(c) for k, c in enumerate("abc")]
    rows = store.write("gold.s", spark.range(0, 60_000, 1, 4).select("id", *spread))
    layout.rewrite_curved(store, "gold.s", list("abc"), "id", file_bytes=store.size_in_bytes("gold.s") // 300)
    total = len(files_of(store, "gold.s"))
    assert total > 250 and content(store.read("gold.s")) == content(rows)
    for column in "abc":
        for value in (0, 370, 999):
            assert 0 < len(layout.files_where(store, "gold.s", {column: (value, value)})) < total / 4


def test_filtered_reads_of_a_curved_fact(spark, warehouse, store):
    fact = warehouse.table("fact_sales_order_line")
    store.write("gold.f", fact)
    columns = ["order_date_key", "customer_key", "product_key"]
    size = store.size_in_bytes("gold.f")
    layout.rewrite_curved(store, "gold.f", columns, "sales_order_line_key", file_bytes=size // 60)
    assert content(store.read("gold.f")) == content(fact)
    total = len(files_of(store, "gold.f"))
    for column in columns:
        value = fact.select(F.percentile_approx(column, 0.37)).first()[0]
        assert 0 < len(layout.files_where(store, "gold.f", {column: (value, value)})) < total
        few = layout.read_where(store, "gold.f", {column: (value, value)})
        assert content(few) == content(fact.where(F.col(column) == value))
    none = layout.read_where(store, "gold.f", {"product_key": (-5, -1), "order_date_key": (0, 99999999)})
    assert none.count() == 0 and none.columns == fact.columns
    other = layout.read_where(store, "gold.f", {"quantity": (1, 5)})
    assert content(other) == content(fact.where("quantity BETWEEN 1 AND 5"))


def test_curve_with_nulls_and_a_hot_value(spark, store):
    rows = spark.range(0, 6000, 1, 4).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("a"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("b")
    )
    store.write("gold.h", rows)
    layout.rewrite_curved(store, "gold.h", ["a", "b"], "id", file_bytes=max(1, store.size_in_bytes("gold.h") // 12))
    assert content(store.read("gold.h")) == content(rows)
    sizes = [r.row_count for r in spark.read.parquet(store.stored("gold.h").path).collect()]
    assert len(sizes) >= 8 and max(sizes) < 1000
    assert layout.read_where(store, "gold.h", {"a": (3, 3)}).count() == rows.where("a = 3").count()
    empty = store.write("gold.z", rows.limit(0))
    layout.rewrite_curved(store, "gold.z", ["a", "b"], "id")
    assert store.read("gold.z").count() == 0 and store.read("gold.z").schema == empty.schema


def test_compaction_keeps_ranges(spark, store):
    rows = spark.range(0, 5000, 1, 1).select("id", (F.col("id") % 100).alias("a"))
    store.write("gold.r", rows)
    layout.rewrite_curved(store, "gold.r", ["a"], "id", file_bytes=store.size_in_bytes("gold.r") // 20)
    made = layout.compact(store, "gold.r", file_bytes=store.size_in_bytes("gold.r"))
    assert made.merged > 0
    assert layout.read_where(store, "gold.r", {"a": (10, 12)}).count() == 150
    assert content(store.read("gold.r")) == content(rows)


def test_published_facts_compacted(spark, warehouse, tmp_path):
    """A compaction of a published home is one more manifest; the load's own stays readable."""
    home = str(tmp_path / "home")
    p.publish_warehouse(spark, warehouse.landing.folder, home)
    made = p.compact_published(spark, home, ["fact_shipment", "fact_work_order"], file_bytes=1 << 30)
    assert made.number == 2 and made.tables["gold.fact_shipment"].listed
    for number in (1, 2, None):
        opened = p.open_snapshot(spark, home, number)
        assert content(opened.table("fact_shipment")) == content(warehouse.table("fact_shipment"))
        assert content(opened.table("dim_customer")) == content(warehouse.table("dim_customer"))
