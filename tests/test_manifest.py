"""Loads that become visible at once: snapshots, broken loads, conflicts, resuming."""

import pytest

from starloom.plans import publish as p
from starloom.sources.manifest import CommitConflictError, Manifests
from starloom.sources.store import TableStore
from tests.test_publish import content


@pytest.fixture
def home(tmp_path):
    return str(tmp_path / "home")


def commit_two(spark, home, value, after=None):
    store = TableStore(spark, f"{home}/load-{value}")
    for name in ("gold.a", "gold.b"):
        store.write(name, spark.range(value).toDF("k"))
    return store, Manifests(spark, home).commit(store.snapshot(), {"value": str(value)}, after)


def opened(spark, home, number=None):
    manifests = Manifests(spark, home)
    found = manifests.latest() if number is None else manifests.read(number)
    return TableStore(spark, home, at=found.tables)


def test_readers_see_a_whole_load_or_none_of_it(spark, home):
    commit_two(spark, home, 3)
    before = opened(spark, home)
    store = TableStore(spark, f"{home}/load-5")
    store.write("gold.a", spark.range(5).toDF("k"))
    midway = opened(spark, home)
    assert [midway.read(n).count() for n in ("gold.a", "gold.b")] == [3, 3]
    store.write("gold.b", spark.range(5).toDF("k"))
    assert opened(spark, home).read("gold.b").count() == 3  # written, not committed
    Manifests(spark, home).commit(store.snapshot(), {"value": "5"})
    assert [opened(spark, home).read(n).count() for n in ("gold.a", "gold.b")] == [5, 5]
    assert [before.read(n).count() for n in ("gold.a", "gold.b")] == [3, 3]
    assert [opened(spark, home, 1).read(n).count() for n in ("gold.a", "gold.b")] == [3, 3]


def test_manifests_keep_schemas_and_properties(spark, home):
    manifests = Manifests(spark, home)
    assert manifests.latest() is None and manifests.numbers() == []
    commit_two(spark, home, 1)
    commit_two(spark, home, 2)
    assert manifests.numbers() == [1, 2]
    assert manifests.latest(value="1").number == 1 and manifests.latest(value="9") is None
    store = opened(spark, home)
    assert store.read("gold.a").dtypes == [("k", "bigint")]
    assert "gold.a" in store and store.size_in_bytes("gold.a") > 0


def test_two_loads_from_one_manifest(spark, home):
    """The second to commit fails and leaves neither a manifest nor a draft behind."""
    commit_two(spark, home, 1)
    commit_two(spark, home, 2, after=1)
    with pytest.raises(CommitConflictError):
        commit_two(spark, home, 3, after=1)
    manifests = Manifests(spark, home)
    assert manifests.latest().properties == {"value": "2"}
    from pathlib import Path

    assert sorted(f.name for f in (Path(home) / "_manifests").iterdir() if not f.name.startswith(".")) == [
        "0000000001.json", "0000000002.json",
    ]


def test_a_home_may_be_copied_elsewhere(spark, home, tmp_path):
    import shutil

    commit_two(spark, home, 4)
    shutil.copytree(home, tmp_path / "copy")
    shutil.move(home, tmp_path / "gone")
    assert opened(spark, str(tmp_path / "copy")).read("gold.b").count() == 4


def test_old_versions_that_a_manifest_names_stay(spark, home):
    store, _ = commit_two(spark, home, 2)
    store.write("gold.a", spark.range(7).toDF("k"))
    store.write("gold.a", spark.range(8).toDF("k"))
    manifests = Manifests(spark, home)
    assert store.drop_old_versions(manifests.named_folders()) == 1
    assert opened(spark, home).read("gold.a").count() == 2
    assert store.read("gold.a").count() == 8


def test_a_broken_load_changes_nothing_and_goes_on(spark, warehouse, home, monkeypatch):
    folder = warehouse.landing.folder
    build = p.Warehouse._build

    def broken(self, name):
        if name == "fact_work_order_part":
            raise RuntimeError("lost")
        return build(self, name)

    monkeypatch.setattr(p.Warehouse, "_build", broken)
    with pytest.raises(RuntimeError, match="lost"):
        p.publish_warehouse(spark, folder, home)
    with pytest.raises(p.NotPublishedError):
        p.open_snapshot(spark, home)
    with pytest.raises(p.NotPublishedError):
        p.open_published(spark, folder, home).table("dim_customer")
    built = []
    monkeypatch.setattr(p.Warehouse, "_build", lambda self, name: (built.append(name), build(self, name))[1])
    p.publish_warehouse(spark, folder, home)
    assert "fact_work_order_part" in built and "dim_customer" not in built
    snapshot = p.open_snapshot(spark, home)
    for name in p.GOLD_TABLES:
        assert content(snapshot.table(name)) == content(warehouse.table(name)), name
