"""Bloom filters: no kept key is lost, few others pass, sizes are bounded."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import bloom


@pytest.mark.parametrize("keys", [0, 1, 500, 20_000])
def test_filter(spark, keys):
    bits = bloom.bits_for(keys)
    kept = spark.range(keys).select((F.col("id") * 7 + 3).alias("k"))
    words = bloom.filter_words(kept, "k", bits)
    assert len(words.first().words) == bits >> 6
    rows = spark.range(7 * 20_000 + 10)
    found = rows.where(bloom.may_hold(words.scalar(), F.col("id"), bits))
    assert kept.join(found, F.col("k") == F.col("id"), "left_anti").isEmpty()
    others = rows.count() - keys
    assert found.count() - keys <= 0.03 * others


def test_sizes():
    assert bloom.bits_for(0) == bloom.FEWEST_BITS and bloom.bits_for(10**12) == bloom.MOST_BITS
    assert bloom.bits_for(1000) == 16_384 and bloom.MOST_KEYS * 8 == bloom.MOST_BITS


def test_text_and_null_keys(spark):
    kept = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    bits = bloom.bits_for(3)
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "v string")
    found = rows.where(bloom.may_hold(bloom.filter_words(kept, "k", bits).scalar(), F.col("v"), bits))
    assert {"a", "b", None} <= {r.v for r in found.collect()}


def test_far_filters_by_either_way(warehouse, monkeypatch):
    """Beyond the largest filter a semi join does it, to the same result."""
    from starloom.plans.queries import QUERIES

    first = sorted(map(tuple, QUERIES["far_filtered_rollup"](warehouse).collect()), key=repr)
    monkeypatch.setattr(bloom, "MOST_KEYS", -1)
    again = QUERIES["far_filtered_rollup"](warehouse)
    assert sorted(map(tuple, again.collect()), key=repr) == first and first
    near = sorted(map(tuple, QUERIES["filtered_rollup"](warehouse).collect()), key=repr)
    assert near == first
