"""Whitening against NumPy's eigenvectors in double precision and exact integers."""

import math

import numpy as np
import pytest

from daygrain.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, width int, c int, n int"


def frame(spark, rows, kind="float", parts=3):
    schema = SCHEMA.replace("array<float>", f"array<{kind}>")
    return spark.createDataFrame([(i, v, "own", 7, 8, 9) for i, v in rows], schema).repartition(parts)


def whole(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def expected(rows, components):
    """{(vec_id, x): (n, deviation, whitened of every sound component, explained)}, fitted on distinct vectors."""
    good = [(i, whole(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    _, sizes, turned = np.linalg.svd(centred, full_matrices=False)
    values, turned = sizes**2 / n, turned.T
    sound = int((sizes > sizes[0] * 1e-12).sum()) if n > 1 else 0
    k = min(sound, components)
    out = []
    for i, x in good:
        far = [n * a - s for a, s in zip(x, sums)]
        white = np.array(far) / n @ turned[:, :k] / np.sqrt(values[:k])
        out.append((i, n, sum(f * f for f in far), white))
    return out, values[:k] / values[:sound].sum()


def check(spark, rows, kind="float", components=16):
    got = whitening.whiten(frame(spark, rows, kind), components=components).collect()
    want, explained = expected(rows, components)
    k = len(explained)
    assert len(got) == len(want) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = np.ones(k)
    for j in range(k):
        pairs = [(by_id[i][j + 1].whitened, white[j]) for i, _, _, white in want]
        a, b = max(pairs, key=lambda p: abs(p[1]))
        signs[j] = math.copysign(1, a * b)
    for i, n, deviation, white in want:
        for j in range(k):
            r = by_id[i][j + 1]
            assert (r.n, int(r.deviation)) == (n, deviation)
            assert r.whitened * signs[j] == pytest.approx(white[j], abs=1e-8)
            assert r.explained == pytest.approx(explained[j], rel=1e-8)
            assert r.identity_error < 1e-8
    return by_id


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    spread = rng.standard_normal((width, width)) * np.geomspace(3, 0.2, width)
    return [(i, [float(np.float32(c)) for c in rng.standard_normal(width) @ spread]) for i in range(n)]


def test_equals_eigenvectors(spark):
    rows = vectors(1, 300, 20)
    got = check(spark, rows)
    assert {len(v) for v in got.values()} == {16}


def test_rows_without_numbers_give_nothing_and_copies_count_once(spark):
    rows = vectors(2, 80, 5)
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    copies = [(100 + i, rows[i % 7][1]) for i in range(200)]
    got = check(spark, rows + odd + copies)
    assert set(got) == {i for i, _ in rows + copies}
    assert next(iter(got[0].values())).n == len({whole(v) for _, v in rows})


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [v[0], 3.0, v[1], v[0], v[2]]) for i, v in vectors(3, 90, 3)]
    assert {len(v) for v in check(spark, rows).values()} == {3}
    few = vectors(4, 4, 8)
    assert {len(v) for v in check(spark, few).values()} == {3}


def test_small_variance_beside_a_large_one(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a * 1e5), float(a * 1e5 + b), float(c)]) for i, (a, b, c) in enumerate(rng.standard_normal((200, 3)))]
    check(spark, rows, "double")


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((30, 3)) * 1e14)]
    check(spark, rows, "double")
    beyond = [(500, [1e300, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows + beyond, "double"))
    assert got.where("vec_id = 500").count() == 0 and got.count() == 90


def test_every_width_has_its_own_fit(spark):
    a, b = vectors(7, 60, 4), [(1000 + i, v) for i, v in vectors(8, 50, 3)]
    got = whitening.whiten(frame(spark, a + b)).collect()
    assert {(r.vec_id >= 1000, r.n) for r in got} == {(False, 60), (True, 50)}
    assert len(got) == 60 * 4 + 50 * 3 and max(r.identity_error for r in got) < 1e-10


def test_empty_and_single(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).columns[0] == "vec_id"


def test_null_and_text_ids(spark):
    rows = vectors(9, 20, 2)
    named = spark.createDataFrame([(None if i == 3 else f"v{i}", v) for i, v in rows], "vec_id string, embedding array<double>")
    got = whitening.whiten(named).collect()
    assert len(got) == 40 and sum(r.vec_id is None for r in got) == 2


def test_triangular_solve():
    rng = np.random.default_rng(10)
    factor = np.triu(rng.standard_normal((70, 70))) + 20 * np.eye(70)
    rows = rng.standard_normal((9, 70))
    assert np.allclose(whitening.solved(rows, factor) @ factor, rows)
