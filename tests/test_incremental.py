"""Loads that touch only what has changed: against a whole load, and by the files that stay."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout
from starloom.operators.conform import conform
from starloom.operators.incremental import conform_changes
from starloom.sources.manifest import Manifests
from starloom.sources.store import TableStore
from tests.test_publish import content

SCHEMA = "k int, line int, code string, v int"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"{tmp_path}/store")


def bound():
    return {"code": F.col("code").isin("a", "b")}


def files_of(store):
    return {r.path.rpartition("/")[2] for r in layout.listed_files(store, "conformed.t").collect()}


def load(spark, store, data):
    rows = spark.createDataFrame(data, SCHEMA).repartition(5, "k")
    made = conform_changes(store, "t", rows, ["k", "line"], bound())
    whole = conform(rows, ["k", "line"], bound())
    assert content(store.read("conformed.t")) == content(whole)
    assert store.read("conformed.t").columns == whole.columns
    return made


def sample(seed, n=400):
    r = random.Random(seed)
    rows = [(r.randrange(120), r.randrange(3), r.choice("ab"), r.randrange(9)) for _ in range(n)]
    return rows + [(None, 1, "a", 5), (7, None, "b", 1), (8, 1, "?", 1)] + [(3, 1, "a", 2)] * 150


def test_only_files_with_changed_keys_are_rewritten(spark, store):
    data = sample(1)
    first = load(spark, store, data)
    assert first.kept == first.replaced == 0 and first.written > 1
    before = files_of(store)
    assert load(spark, store, data) == (0, len(before), 0, 0) and files_of(store) == before
    key = next(x for x in data if x[0] is not None and x[0] != 3)[:2]
    changed = [(*x[:3], x[3] + 100) if x[:2] == key else x for x in data]
    made = load(spark, store, changed)
    assert (made.keys, made.replaced, made.written) == (1, 1, 1)
    assert made.kept == len(before) - 1 and len(files_of(store) & before) == made.kept


def test_rows_come_go_and_repeat(spark, store):
    data = sample(2)
    load(spark, store, data)
    r = random.Random(5)
    for step in range(3):
        data = [x for x in data if r.random() > 0.01]  # some go, copies among them
        data += [(1000 + step, 1, "a", 1), (1000 + step, 1, "b", 0), r.choice(data)]  # new keys, one more copy
        data += [(None, 2, "a", 1), (9, 2, "!", 1)]  # never kept
        made = load(spark, store, data)
        assert made.keys >= 1
    rejected_only = load(spark, store, data + [(None, None, "a", 1), (5, 1, "#", 1)])
    assert rejected_only.keys == 0
    load(spark, store, [])
    assert store.read("conformed.t").count() == 0
    load(spark, store, data)


def test_a_hot_key_changes(spark, store):
    data = sample(3) + [(50, 2, "a", k) for k in range(300)]
    load(spark, store, data)
    made = load(spark, store, data + [(50, 2, "a", -1)])
    assert made.keys == 1
    assert store.read("conformed.t").where("k = 50 AND line = 2").first().v == -1


def test_carried_over_by_the_manifest(spark, store):
    manifests = Manifests(spark, store.folder)
    data = sample(4)
    load(spark, store, data)
    manifests.commit(store.snapshot(), {})
    load(spark, store, [(*x[:3], 99) if x[0] == 11 else x for x in data])
    manifests.commit(store.snapshot(), {})
    old, new = (TableStore(spark, store.folder, at=manifests.read(n).tables).read("conformed.t") for n in (1, 2))
    assert old.where("k = 11 AND v = 99").isEmpty() and not new.where("k = 11 AND v = 99").isEmpty()
    assert content(old.where("k <> 11")) == content(new.where("k <> 11"))


def test_ranges_of_new_files(spark, store):
    """A table laid along a curve keeps ranges for every file after a change."""
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 40).alias("v"))
    conform_changes(store, "t", rows, ["k"])
    layout.rewrite_curved(store, "conformed.t", ["v"], "k", file_bytes=store.size_in_bytes("conformed.t") // 10)
    made = conform_changes(store, "t", rows.withColumn("v", F.when(F.col("k") == 80, 39).otherwise(F.col("v"))), ["k"])
    assert made.keys == 1 and made.kept > 3
    assert layout.read_where(store, "conformed.t", {"v": (39, 39)}).count() == 76
    assert layout.read_where(store, "conformed.t", {"v": (0, 0)}).count() == 74
