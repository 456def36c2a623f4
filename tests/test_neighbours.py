"""Nearest-neighbour information against plain NumPy over all pairs."""

import math

import numpy as np
import pytest

from daygrain.operators import neighbours as N


def psi(m):
    return sum(1 / i for i in range(1, m)) - 0.5772156649015329


def whole(values):
    spread = float(np.float32(np.std(values))) or 1.0
    return [math.floor(v / spread * N.STEP + 0.5) for v in values]


def expected(x, y, k):
    rows = [(a, b) for a, b in zip(x, y) if a is not None and b is not None and not math.isnan(a) and not math.isnan(b)]
    if len(rows) <= k:
        return len(rows), None
    a, b = (np.array(whole([r[i] for r in rows]), dtype=np.int64) for i in (0, 1))
    total = 0.0
    for i in range(len(rows)):
        dx, dy = np.abs(a - a[i]), np.abs(b - b[i])
        eps = np.sort(np.maximum(dx, dy))[k]
        total += sum(psi(int(((d < eps) | (d == 0)).sum())) for d in (dx, dy))
    return len(rows), max(0.0, psi(len(rows)) + psi(k) - total / len(rows))


def table(seed, n):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=n)
    x = {
        "same": y, "near": y + 0.3 * rng.normal(size=n), "square": y * y, "noise": rng.normal(size=n), "const": np.full(n, 3.0),
        "whole": np.round(2 * y), "mostly_zero": np.where(rng.random(n) < 0.4, 0.0, y + rng.normal(size=n)), "against": -y / N.SLOPE,
    }
    rows = [[float(x[c][i]) for c in x] + [float(y[i])] for i in range(n)]
    rows += [rows[5]] * 7 + [rows[6]] * 2
    for i in range(0, n, 17):
        rows[i][1] = None
    rows[3][2], rows[4][3], rows[9][-1] = math.nan, None, None
    return list(x), rows


@pytest.mark.parametrize("k, strip", [(3, 16384), (3, 25), (1, 40), (5, 60)])
def test_equals_all_pairs(spark, k, strip):
    names, rows = table(1, 260)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"])).repartition(3)
    got = {r.feature: (r.n, r.mi) for r in N.mutual_information_knn(df, names, "y", k, strip).collect()}
    for j, name in enumerate(names):
        n, mi = expected([r[j] for r in rows], [r[-1] for r in rows], k)
        assert got[name][0] == n and got[name][1] == pytest.approx(mi, abs=1e-9), name


def test_more_information_scores_higher(spark):
    names, rows = table(2, 400)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"]))
    order = [r.feature for r in N.mutual_information_knn(df, ["noise", "near", "same", "const"], "y").collect()]
    assert order[:2] == ["same", "near"] and set(order[2:]) == {"noise", "const"}


def test_few_rows_nulls_and_empty(spark):
    schema = "a double, b int, y double"
    df = spark.createDataFrame([(1.0, 1, 1.0), (2.0, 5, 3.0), (None, 2, 2.0), (4.0, None, 9.0), (math.nan, 7, 7.0)], schema)
    got = {r.feature: (r.n, r.mi) for r in N.mutual_information_knn(df, ["a", "b"], "y").collect()}
    assert got["a"] == (3, None) and got["b"][0] == 4 and got["b"][1] is not None
    empty = {r.feature: (r.n, r.mi) for r in N.mutual_information_knn(df.where("false"), ["a", "b"], "y").collect()}
    assert empty == {"a": (0, None), "b": (0, None)}


def test_digamma(spark):
    rows = spark.range(1, 2000).select("id", N.digamma(N.F.col("id")).alias("psi")).collect()
    assert all(r.psi == pytest.approx(psi(r.id), abs=1e-11) for r in rows)
