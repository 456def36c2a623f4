"""Boosted trees against a plain NumPy fit that keeps all rows in memory."""

import numpy as np
import pytest

from daygrain.operators import boosting as B

FEATURES, TARGETS = ["a", "b", "c", "d"], ["y", "z"]


def rows_of(seed=1, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 2] = np.round(x[:, 2])
    x[::11, 3] = np.nan
    y = 3 * (x[:, 0] > 0.2) + x[:, 1] + 0.3 * x[:, 2] + 0.1 * rng.normal(size=n)
    z = np.where(np.isnan(x[:, 3]), 2.0, x[:, 3] ** 2) + 0.1 * rng.normal(size=n)
    return x, np.stack([y, z], axis=1)


def frame(spark, x, t, judged=None):
    rows = [[None if np.isnan(v) else float(v) for v in a] + [float(v) for v in b] + [bool(j)] for a, b, j in zip(x, t, judged if judged is not None else [False] * len(x))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, z double, later boolean").repartition(3)


class Plain:
    """Best-first trees on binned columns, one row of code for each rule."""

    def __init__(self, x, y, edges, p):
        self.p, self.bins = p, np.stack([np.searchsorted(e, np.nan_to_num(x[:, j], nan=-np.inf), "left") for j, e in enumerate(edges)], axis=1)
        self.pred, self.losses, self.splits = np.full(len(y), y.mean()), [], []
        for _ in range(p.rounds):
            self.losses.append(float(np.mean((self.pred - y) ** 2)))
            leaves = [(np.arange(len(y)), 0)]
            g = self.pred - y
            while len(leaves) < p.leaves:
                found = [self.best(rows, g) if not p.depth or depth < p.depth else None for rows, depth in leaves]
                if not any(found):
                    break
                at = max((i for i, f in enumerate(found) if f), key=lambda i: found[i][0])
                rows, depth = leaves.pop(at)
                _, j, b = found[at]
                self.splits.append(j)
                left = self.bins[rows, j] <= b
                leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
            for rows, _ in leaves:
                self.pred[rows] -= p.learning_rate * self.t(g[rows].sum()) / (len(rows) + p.l2)
        self.losses.append(float(np.mean((self.pred - y) ** 2)))

    def t(self, g):
        return np.sign(g) * max(abs(g) - self.p.l1, 0)

    def best(self, rows, g):
        score = lambda r: self.t(g[r].sum()) ** 2 / (len(r) + self.p.l2)
        out = None
        for j in range(self.bins.shape[1]):
            for b in range(int(self.bins[:, j].max())):
                left = self.bins[rows, j] <= b
                l, r = rows[left], rows[~left]
                if min(len(l), len(r)) < max(1, self.p.least_rows):
                    continue
                gain = (score(l) + score(r) - score(rows)) / 2
                if gain > 1e-9 and (out is None or gain > out[0] + 1e-9):
                    out = (gain, j, b)
        return out


@pytest.mark.parametrize("params, ahead, rewrite", [
    (B.Params(rounds=4, leaves=6, learning_rate=0.3, least_rows=5), 8, 8),
    (B.Params(rounds=5, leaves=9, learning_rate=0.5, least_rows=3, l1=2.0, l2=5.0, depth=3), 1, 2),
    (B.Params(rounds=3, leaves=2, learning_rate=1.0, least_rows=1), 3, 1),
])
def test_equals_plain_fit(spark, params, ahead, rewrite, monkeypatch):
    monkeypatch.setattr(B, "AHEAD", ahead)
    monkeypatch.setattr(B, "REWRITE", rewrite)
    x, t = rows_of()
    df = frame(spark, x, t)
    data = B.binned(df, FEATURES, TARGETS, bins=16, block_rows=64)
    growths, errors = B.train(data, [B.Job("m", y, params) for y in TARGETS])
    for k, target in enumerate(TARGETS):
        plain = Plain(x, t[:, k], data.edges, params)
        losses = [e[2] for e in errors if e[0] == k]
        assert losses == pytest.approx(plain.losses, rel=1e-9) and losses == sorted(losses, reverse=True)
    nodes = B.nodes_table(spark, data, growths)
    scored = {tuple(None if v is None else round(v, 9) for v in r[:4]): (r.p_y, r.p_z) for r in B.score(df, nodes, FEATURES, FEATURES, lambda m, y: f"p_{y}").collect()}
    for row, prediction in zip(x, Plain(x, t[:, 0], data.edges, params).pred):
        key = tuple(None if np.isnan(v) else round(float(v), 9) for v in row)
        assert scored[key][0] == pytest.approx(prediction, rel=1e-9)
    counts = {(r.target, r.feature): (r.splits, r.rank) for r in B.importance(nodes, FEATURES).collect()}
    plain = Plain(x, t[:, 0], data.edges, params)
    assert {f: counts["y", f][0] for f in FEATURES} == {f: plain.splits.count(j) for j, f in enumerate(FEATURES)}
    assert sorted(counts["y", f][1] for f in FEATURES) == [1, 2, 3, 4]


def test_judged_rows_are_not_learnt_from(spark):
    x, t = rows_of(2, 300)
    judged = np.arange(300) >= 240
    data = B.binned(frame(spark, x, t, judged), FEATURES, TARGETS, "later", bins=32)
    params = B.Params(rounds=10, leaves=5, learning_rate=0.3, least_rows=5)
    growths, errors = B.train(data, [B.Job("m", "y", params)])
    assert (data.rows, data.judged) == (240, 60)
    plain = Plain(x[:240], t[:240, 0], data.edges, params)
    assert [e[2] for e in errors] == pytest.approx(plain.losses, rel=1e-9)
    assert errors[-1][3] < errors[0][3] / 4


def test_drawn_rows_and_columns_are_repeatable_and_jobs_can_stop(spark):
    x, t = rows_of(3, 300)
    data = B.binned(frame(spark, x, t), FEATURES, TARGETS, bins=16, block_rows=50)
    params = B.Params(rounds=4, leaves=4, learning_rate=0.3, rows=0.5, columns=0.5, seed=7)
    first = B.train(data, [B.Job("m", "y", params)])[1]
    assert first == B.train(data, [B.Job("m", "y", params)])[1]
    assert first != B.train(data, [B.Job("m", "y", B.dataclasses.replace(params, seed=8))])[1]
    stopped, errors = B.train(data, [B.Job("a", "y", params), B.Job("b", "y", params)], lambda r, now: {1} if r == 2 else set())
    assert [len(g.trees) for g in stopped] == [4, 2] and stopped[1].stopped and not stopped[0].stopped
    assert [e for e in errors if e[0] == 0] == first


def test_constant_missing_and_empty(spark):
    x, t = rows_of(4, 60)
    x[:, 0], x[:, 1] = 1.0, np.nan
    data = B.binned(frame(spark, x, t), FEATURES, TARGETS, bins=8)
    growths, _ = B.train(data, [B.Job("m", "y", B.Params(rounds=2, leaves=4, least_rows=5))])
    used = {r.feature for r in B.nodes_table(spark, data, growths).where("feature is not null").collect()}
    assert used <= {"c", "d"}
    with pytest.raises(ValueError, match="no row"):
        B.binned(frame(spark, x, t).where("false"), FEATURES, TARGETS)
    with pytest.raises(ValueError, match="missing columns: [cd]"):
        B.read_trees(B.nodes_table(spark, data, growths), ["a", "b"])
