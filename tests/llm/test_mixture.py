"""Mixing: shares met, counts by inverted distribution, reproducible, shuffled."""

import hashlib
import math
from collections import Counter

import pytest

from starloom.llm import mixture


def test_distribution():
    for rate in (0.0, 0.3, 1.0, 7.5, 900.0):
        chances = mixture.distribution(rate)
        assert chances == sorted(chances) and abs(chances[-1] - 1) < 1e-9
        if 0 < rate < 50:
            assert math.isclose(chances[2], math.exp(-rate) * (1 + rate + rate**2 / 2))


def rows_of(n):
    return [(i, "w" * (i % 50 + 1), None, ["hot", "hot", "b", "c", None][i % 5]) for i in range(n)]


def test_shares(documents):
    rows = rows_of(4000)
    found = mixture.replicated(documents(rows), {"hot": 1.0, "b": 2.0}, other=1.0, epochs=2.0).collect()
    size = Counter()
    for r in found:
        size[r.source if r.source in ("hot", "b") else "other"] += len(r.text) + 1
    total = sum(len(t) + 1 for _, t, _, _ in rows) * 2.0
    for name, share in (("hot", 0.25), ("b", 0.5), ("other", 0.25)):
        assert abs(size[name] / total - share) < 0.03
    copies = Counter(r.doc_id for r in found)
    assert all(r.copies == copies[r.doc_id] and 1 <= r.copy <= r.copies for r in found)
    assert len({(r.doc_id, r.copy) for r in found}) == len(found)


def test_counts_by_hand(documents):
    rows = rows_of(500)
    found = mixture.replicated(documents(rows), {"hot": 1.0}, other=3.0, seed=9).collect()
    copies = Counter(r.doc_id for r in found)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes["hot" if source == "hot" else None] += len(text) + 1
    rates = mixture.rates(dict(sizes), {"hot": 1.0}, 3.0, 1.0)
    for doc, _, _, source in rows:
        u = int(hashlib.md5(f"9/{doc}".encode()).hexdigest()[:13], 16) / 2**52
        rate, k = rates["hot" if source == "hot" else None], 0
        below = math.exp(-rate)
        while below <= u:
            k += 1
            below += math.exp(-rate) * rate**k / math.factorial(k)
        assert copies[doc] == k


def test_large_rates_in_parts(spark, documents):
    """A rate of a million: bounded tables, copies as by hand, and their spread that of a Poisson number."""
    assert max(len(mixture.distribution(r / mixture.parts_of(r))) for r in (1e3, 1e6, 12345678.9)) < 1_000
    assert mixture.parts_of(255.9) == mixture.parts_of(0.0) == 1 and mixture.parts_of(1e6) == 3907
    rows = [(i, "tiny", None, "rare") for i in range(40)] + [(100 + i, "w" * 995, None, "b") for i in range(100)]
    docs = documents(rows)
    found = mixture.replicated(docs, {"rare": 1.0, "b": 1.0}, epochs=2.0).groupBy("doc_id").count().collect()
    copies = {r.doc_id: r["count"] for r in found}
    rate = mixture.rates({"rare": 200, "b": 99_600}, {"rare": 1.0, "b": 1.0}, 0.0, 2.0)["rare"]
    parts = mixture.parts_of(rate)
    assert parts > 1
    chances = mixture.distribution(rate / parts)
    for doc in range(40):
        draws = [f"1/{doc}", *(f"1/{doc}/part/{k}" for k in range(1, parts))]
        right = sum(
            sum(c <= int(hashlib.md5(d.encode()).hexdigest()[:13], 16) / 2**52 for c in chances) for d in draws
        )
        assert copies[doc] == right
    assert all(abs(copies[d] - rate) < 6 * rate**0.5 for d in range(40))


def test_many_copies_of_a_row(documents):
    """More copies than are made at a time: all numbers, once each."""
    rows = [(1, "x", None, "rare"), (2, "w" * 20_000, None, "b")]
    found = mixture.replicated(documents(rows), {"rare": 1.0, "b": 1.0}, epochs=2.0).where("doc_id = 1")
    numbers = sorted(r.copy for r in found.select("copy").collect())
    assert len(numbers) > 2 * mixture.CHUNK and numbers == list(range(1, len(numbers) + 1))


def test_rows_without_an_id_draw_for_themselves(documents):
    """A third of all rows, alike and without an id: their source meets its rate, as they don't go or stay as one."""
    rows = [(None, "same", None, "hot")] * 9_000 + [(i, "else", None, "b") for i in range(3_000)]
    found = mixture.replicated(documents(rows), {"hot": 1.0, "b": 1.0}, epochs=1.0)
    counts = {r.source: r["count"] for r in found.groupBy("source").count().collect()}
    assert abs(counts["hot"] - 6_000) < 400 and abs(counts["b"] - 6_000) < 400
    hot = found.where("source = 'hot'").select("copies", "copy").collect()
    assert {r.copies for r in hot} >= {1, 2, 3}
    assert sum(r.copy == 1 for r in hot) < 6_000


def test_shuffled_and_repeatable(documents):
    docs = documents(rows_of(600))
    first, again = (mixture.replicated(docs, {"hot": 1.0}, other=1.0).collect() for _ in range(2))
    assert first == again
    ids = [r.doc_id for r in first]
    rises = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 0.4 < rises / len(ids) < 0.6


def test_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    found = mixture.replicated(docs, {"x": 1.0}, other=1.0, epochs=30.0)
    assert set(docs.columns) | {"copy"} == set(found.columns)
    rows = found.collect()
    assert {(r.doc_id, r.text) for r in rows} == set(odd_rows)
    assert {(r.pool, r.score) for r in rows} == {("p", "x")}
    assert mixture.replicated(documents([]), {"x": 1.0}).collect() == []
    assert mixture.replicated(docs, {"x": 1.0}, other=0.0).collect() == []


def test_refused(documents):
    with pytest.raises(ValueError):
        mixture.replicated(documents([]), {})
    with pytest.raises(ValueError):
        mixture.rates({"a": 3}, {"a": -1.0}, 0.0, 1.0)
