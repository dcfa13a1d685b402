"""Whitening: exact covariance by plain loops, whitened values, odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n string, label int"


@pytest.fixture
def embeddings(spark):
    from starloom.llm.shared import reach_package

    reach_package(spark)
    return lambda rows: spark.createDataFrame([(i, v, "c", "n", 0) for i, v in rows], SCHEMA)


def vectors(count, length, seed=3):
    r = random.Random(seed)
    mixing = [[r.gauss(0, 0.2) for _ in range(length)] for _ in range(length)]
    rows = []
    for i in range(count):
        base = [r.gauss(0, 1 / (k + 1)) for k in range(length)]
        rows.append((i, [float(np.float32(sum(a * b for a, b in zip(base, m)))) for m in mixing]))
    return rows


def by_hand(rows):
    """Whole entries, sums, covariance in fractions, deviations."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, length = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(length)]
    centred = [[r[k] - Fraction(sums[k], n) for k in range(length)] for r in x]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(length)] for i in range(length)]
    far = [sum((n * r[k] - sums[k]) ** 2 for k in range(length)) for r in x]
    return x, sums, cov, far


def test_covariance_is_exact(embeddings):
    rows = vectors(300, 6)
    _, sums, cov, _ = by_hand(rows)
    model = whitening.fit(embeddings(rows).repartition(7))
    assert model.n == 300 and model.sums == sums
    assert model.covariance.tolist() == [[float(c) for c in row] for row in cov]


def test_whitened(embeddings):
    rows = vectors(250, 10)
    _, sums, cov, far = by_hand(rows)
    found = whitening.whitened(embeddings(rows).repartition(5)).collect()
    assert len(found) == 250 * 8
    matrix = np.array([[float(c) for c in row] for row in cov])
    values, columns = np.linalg.eigh(matrix)
    table = np.zeros((250, 8))
    for r in found:
        assert (r.n, int(r.deviation)) == (250, far[r.vec_id])
        assert math.isclose(r.explained, values[-r.component] / np.trace(matrix), rel_tol=1e-9)
        table[r.vec_id, r.component - 1] = r.whitened
    x = by_hand(rows)[0]
    centred = np.array([[float(a - Fraction(s, 250)) for a, s in zip(r, sums)] for r in x])
    for k in range(8):
        right = centred @ columns[:, -1 - k] / math.sqrt(values[-1 - k])
        assert min(np.abs(table[:, k] - right).max(), np.abs(table[:, k] + right).max()) < 1e-9
    error = np.abs(np.cov(table.T, bias=True) - np.eye(8)).max()
    assert abs(found[0].identity_error - error) < 1e-9 and error < 1e-9
    assert len({r.identity_error for r in found}) == 1


def test_squares_of_large_numbers():
    z = np.array([[1 << 40, -(1 << 39) + 7, 5], [-(1 << 41) + 1, 3, 12345678901], [0, -1, 1 << 22]], dtype=np.int64)
    plain = z.astype(object)
    right = []
    for i in range(3):
        for j in range(i, 3):
            own = plain[:, i] if i == j else plain[:, i] + plain[:, j]
            right.append(sum(int(v) ** 2 for v in own))
    assert whitening.pair_squares(z) == right
    left, n = [3, 0, 2], 10**9
    assert whitening.deviations(z, left, n) == [
        sum((n * int(v) - r) ** 2 for v, r in zip(row, left)) for row in plain
    ]


def test_odd_rows(embeddings):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [-inf, 0.0]),
        (7, [1.0, 2.0, 3.0]), (8, [0.5, 0.25]), (8, [0.5, 0.25]), (8, [-0.5, 0.125]), (None, [0.0, 3e38]), (9, [-3e38, 1.0]),
    ]
    found = whitening.whitened(embeddings(rows)).collect()
    assert sorted(((r.vec_id or 0, r.component) for r in found)) == sorted(
        (i, c) for i in (8, 8, 8, 0, 9) for c in (1, 2)
    )
    assert all(r.n == 5 and r.whitened is not None and r.deviation is not None for r in found)
    assert found[0].identity_error < 1e-4


def test_nothing_varies(embeddings):
    one = whitening.whitened(embeddings([(1, [0.5, 0.25, 1.0])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [
        (k, 1, 0, None, None, None) for k in (1, 2, 3)
    ]
    flat = whitening.whitened(embeddings([(1, [0.0, 1.0]), (2, [0.0, 2.0])])).collect()
    assert [(r.whitened is None, r.explained) for r in flat if r.component == 2] == [(True, 0.0)] * 2
    assert sorted(round(abs(r.whitened), 9) for r in flat if r.component == 1) == [1.0, 1.0]


def test_empty(embeddings):
    found = whitening.whitened(embeddings([]))
    assert found.collect() == [] and found.columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whitened(embeddings([(1, None)])).collect() == []


def test_a_third_of_the_rows_alike(embeddings):
    rows = vectors(200, 4) + [(k, [0.1, 0.2, 0.3, 0.4]) for k in range(1000, 1100)]
    _, sums, cov, _ = by_hand([(i, [float(np.float32(c)) for c in v]) for i, v in rows])
    model = whitening.fit(embeddings(rows))
    assert model.sums == sums and model.covariance.tolist() == [[float(c) for c in row] for row in cov]


def test_query_on_the_given_table(spark):
    from starloom.llm.queries import LLM_QUERIES
    from starloom.llm.shared import table
    from tests.conftest import SMALL

    rows = [(r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").collect()]
    _, _, _, far = by_hand(rows)
    found = LLM_QUERIES["op11_whitening"](spark, SMALL).collect()
    assert len(found) == 8 * len(rows) and {r.n for r in found} == {len(rows)}
    right = {i: f for (i, _), f in zip(rows, far)}
    assert all(r.deviation == right[r.vec_id] for r in found)
    assert found[0].identity_error < 1e-4
