import random
import warnings

import pytest
from pyspark.sql import functions as F

from starloom.operators.conform import (
    DuplicateKeyError,
    conform,
    duplicate_keys,
    has_duplicates,
    require_unique,
    screen,
)
from starloom.operators.joins import (
    JoinGuardError,
    UnmatchedKeysWarning,
    guarded_left_join,
    join_guard,
    orphan_rows,
    require_no_orphans,
    safe_left_join,
)


def hot_rows(count=3000, seed=3):
    """A third of the rows under one key, a third without a key."""
    random.seed(seed)
    made = []
    for i in range(count):
        key = 7 if i % 3 == 0 else None if i % 3 == 1 else random.randrange(400)
        made.append((random.choice("xyz"), key, random.randrange(50), i % 5 or None))
    return made


def test_conform_matches_brute_force_on_a_hot_key(spark, rows):
    data = hot_rows()
    df = spark.createDataFrame(data, "tag string, key int, value int, part int")
    best = {}
    for tag, key, value, part in data:
        if key is None:
            continue
        rank = (tag, value, (part is not None, part or 0))
        if key not in best or rank < best[key][0]:
            best[key] = (rank, (tag, key, value, part))
    found = conform(df, ["key"])
    assert found.columns == df.columns
    assert rows(found) == sorted((row for _, row in best.values()), key=repr)
    assert rows(conform(df.orderBy(F.rand(1)), ["key"])) == rows(found)


def test_many_repeated_keys_are_told_by_a_filter_without_a_join(spark, rows, monkeypatch, capsys):
    data = [(i % 900, None if i % 7 == 0 else i % 5, str(i % 4)) for i in range(1300)]
    data += [(None, 1, "x"), (7, None, None)] * 3
    df = spark.createDataFrame(data, "key int, part int, tag string")
    codes = {"tag": F.col("tag") != "3"}
    want, screened = rows(conform(df, ["key", "part"], codes)), screen(df, ["key", "part"], codes, lambda _, d: d)
    monkeypatch.setattr("starloom.operators.conform.MOST_BROADCAST_KEYS", 0)
    found = conform(df, ["key", "part"], codes)
    assert rows(found) == want
    assert len(want) == len({(k, p) for k, p, tag in data if k is not None and p is not None and tag != "3"})
    again = screen(df, ["key", "part"], codes, lambda _, d: d)
    assert rows(again.kept) == rows(screened.kept) and rows(again.rejected) == rows(screened.rejected)
    capsys.readouterr()
    conform(df, ["key"]).explain()
    main = capsys.readouterr().out.partition("Subqueries")[0].partition("Initial Plan")[0]
    assert "Join" not in main.split("Subquery")[0]


def test_conform_of_keys_alone(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(conform(df, ["k"])) == [(1,)]


def test_uniqueness(spark, rows):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(duplicate_keys(twice, ["k"])) == [(1, 2)]
    assert has_duplicates(twice, ["k"]).first().has_duplicates
    assert not has_duplicates(twice, ["v"]).first().has_duplicates
    with pytest.raises(DuplicateKeyError):
        require_unique(twice, ["k"], "t")
    assert require_unique(twice, ["v"], "t") is twice


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")


def test_guarded_join_keeps_rows_and_order_of_columns(spark, parent, rows):
    child = spark.createDataFrame([("a", 1), ("b", 1), ("c", None)], "id string, k int")
    joined = safe_left_join(child, parent, "k", "child to parent")
    assert joined.columns == ["id", "k", "name"]
    assert rows(joined) == [("a", 1, "one"), ("b", 1, "one"), ("c", None, None)]


def test_guarded_join_rejects_repeated_parents_even_unused_ones(spark, parent):
    child = spark.createDataFrame([("a", 1)], "id string, k int")
    twice = parent.union(parent.where("k = 2"))
    with pytest.raises(JoinGuardError, match="repeat"):
        safe_left_join(child, twice, "k", "child to parent")


def test_guarded_join_mandatory_and_optional(spark, parent, rows):
    child = spark.createDataFrame([("a", 1), ("b", 9)], "id string, k int")
    with pytest.raises(JoinGuardError, match="1 rows"):
        safe_left_join(child, parent, "k", "child to parent")
    with pytest.warns(UnmatchedKeysWarning):
        joined = safe_left_join(child, parent, "k", "child to parent", mandatory=False)
    assert rows(joined) == [("a", 1, "one"), ("b", 9, None)]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        safe_left_join(child.where("k = 1"), parent, "k", "child to parent", mandatory=False)


def test_guard_counts_with_hot_and_missing_keys(spark):
    data = hot_rows()
    child = spark.createDataFrame(data, "tag string, key int, value int, part int")
    parent = spark.range(0, 200).select(F.col("id").cast("int").alias("key")).union(
        spark.createDataFrame([(7,)], "key int")
    )
    guard = join_guard(child, parent, "key").first()
    hot = sum(1 for r in data if r[1] == 7)
    assert guard.child_rows == len(data)
    assert guard.joined_rows == len(data) + hot
    assert guard.duplicate_parent_keys == 1
    assert guard.unmatched_rows == sum(1 for r in data if r[1] is not None and r[1] >= 200)


def test_orphans_ignore_null_keys(spark, parent, rows):
    child = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "id string, k int")
    assert rows(orphan_rows(child, "k", parent, "k")) == [("b", 9)]
    with pytest.raises(JoinGuardError):
        require_no_orphans(child, "k", parent, "k", "child to parent")
    kept = child.where("k = 1 OR k IS NULL")
    assert require_no_orphans(kept, "k", parent, "k", "child to parent") is kept


def test_guard_while_writing(spark, parent, rows, tmp_path):
    from starloom.sources.store import TableStore

    store = TableStore(spark, str(tmp_path))
    child = spark.createDataFrame([("a", 1), ("b", 1), ("c", None)], "id string, k int")
    made = guarded_left_join(child, parent, "k", "child to parent")
    assert rows(store.write("gold.t", *made)) == rows(safe_left_join(child, parent, "k", "child to parent"))
    lost = spark.createDataFrame([("a", 9), ("b", 1), ("c", 8)], "id string, k int")
    with pytest.raises(JoinGuardError, match="2 rows have a k the parent lacks"):
        store.write("gold.t", *guarded_left_join(lost, parent, "k", "child to parent"))
    with pytest.raises(JoinGuardError, match="lacks"):
        store.get("gold.new", lambda: guarded_left_join(lost, parent, "k", "child to parent"))
    assert "gold.new" not in store and store.read("gold.t").count() == 3
    again = TableStore(spark, str(tmp_path), reopen=True)
    assert "gold.new" not in again and again.read("gold.t").where("id = 'c' AND name IS NULL").count() == 1
    with pytest.warns(UnmatchedKeysWarning):
        store.write("gold.w", *guarded_left_join(lost, parent, "k", "child to parent", mandatory=False))
    assert rows(store.read("gold.w")) == [("a", 9, None), ("b", 1, "one"), ("c", 8, None)]
    with pytest.raises(JoinGuardError, match="repeat"):
        guarded_left_join(child, parent.union(parent), "k", "child to parent")
    store.write("gold.none", *guarded_left_join(child.limit(0), parent, "k", "child to parent"))
    assert store.read("gold.none").count() == 0


def test_guard_while_writing_reads_the_child_once(spark, tmp_path):
    """The child's file is scanned by one plan node and shuffled by one exchange."""
    spark.range(1000).select("id", (F.col("id") % 50).alias("k")).write.parquet(f"{tmp_path}/child")
    spark.range(60).select(F.col("id").alias("k"), F.lit("x").alias("name")).write.parquet(f"{tmp_path}/parent")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        child, parent = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent"))
        made = guarded_left_join(child, parent, "k", "child to parent")
        plan = made.rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet [id") == 1 and plan.count("Exchange hashpartitioning") == 2
        assert "CollectMetrics" in plan
        made.rows.write.parquet(f"{tmp_path}/out")
        made.verify()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
