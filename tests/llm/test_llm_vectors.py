import math

import numpy as np
import pytest
from llm_fixtures import Sets

from daygrain.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, list int, copies string"


def rows_with_oddities():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=12)
        for _ in range(12):
            rows.append((rng.normal(size=12) * 0.05 * (c % 4) + centre, c % 3))
    rows += [(rng.normal(size=12), 1) for _ in range(40)]
    chain = np.zeros(12)
    for k in range(8):  # each is near the next only
        v = chain.copy()
        v[0], v[1] = math.cos(0.18 * k), math.sin(0.18 * k)
        rows.append((v, 2))
    out = [(i, [float(x) for x in v], label, 1, "c") for i, (v, label) in enumerate(rows)]
    out += [(900, out[0][1], 0, 1, ""), (901, [2 * x for x in out[0][1]], 0, 1, ""), (902, out[0][1], 7, 1, ""), (903, out[0][1], None, 1, "")]
    out += [(904, None, 0, 1, ""), (905, [0.0] * 12, 0, 1, ""), (906, [float("nan")] + [1.0] * 11, 0, 1, ""), (907, [None] + [1.0] * 11, 0, 1, "")]
    out += [(908, [float("inf")] * 12, 0, 1, ""), (909, [], 0, 1, ""), (910, [1.0, 2.0], 0, 1, ""), (None, out[0][1], 0, 1, ""), out[3], out[3]]
    return out


def plain(rows, cosine):
    sound = [
        i for i, (v, e, label, *_) in enumerate(rows)
        if v is not None and label is not None and e and len(e) == 12 and all(x is not None and math.isfinite(x) for x in e) and any(e)
    ]
    groups, links = Sets(range(len(rows))), [0] * len(rows)
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in sound}
    for n, a in enumerate(sound):
        for b in sound[n + 1:]:
            if rows[a][2] == rows[b][2] and x[a] @ x[b] / math.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= cosine:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    least = {}
    for i in sound:
        least[groups.find(i)] = min(least.get(groups.find(i), rows[i][0]), rows[i][0])
    return [(r[0], links[i], least[groups.find(i)] if i in x else r[0]) for i, r in enumerate(rows)]


def test_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = rows_with_oddities()
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.98, sample=100).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=key) == sorted(plain(rows, 0.98), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("often", [20, 8192])
def test_every_length_is_compared(spark, monkeypatch, often):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "OFTEN", often)
    rng = np.random.default_rng(8)
    rows = []
    for width, n in ((12, 90), (5, 60), (20, 40), (3, 6), (1, 2)):
        centres = rng.normal(size=(6, width))
        for k in range(n):
            rows.append((len(rows), [float(x) for x in centres[k % 6] + rng.normal(size=width) * 0.06], k % 2, 1, "c"))
    rows += [(500, rows[100][1], rows[100][2], 1, ""), (501, rows[100][1], 7, 1, "")]
    groups, links = Sets(range(len(rows))), [0] * len(rows)
    for a, (_, u, left, *_) in enumerate(rows):
        for b, (_, v, right, *_) in enumerate(rows[:a]):
            x, y = (np.array(e, np.float32).astype(float) for e in (u, v))
            if left == right and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    expected = {r[0]: (links[i], rows[groups.find(i)][0]) for i, r in enumerate(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.98).collect()}
    assert got == expected
    assert all(sum(got[r[0]][0] for r in rows if len(r[1]) == width) for width in (12, 5, 20))


def test_empty_tables(spark):
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    [row] = vectors.near_vectors(spark.createDataFrame([(1, None, 1, 1, "")], SCHEMA)).collect()
    assert tuple(row) == (1, 0, 1, True)


def test_probes_and_lookups_lose_nothing():
    rng = np.random.default_rng(1)
    points = vectors.unit(rng.normal(size=(600, 24)) + 3 * rng.normal(size=(20, 24))[rng.integers(0, 20, 600)])
    index = vectors.fitted(points, 16, 0.9)
    cell, codes, error = index.encode(points)
    probes = [set(p.tolist()) for p in index.probes(points, cell)]
    cosines = points @ points.T
    for i, j in zip(*np.nonzero(cosines >= 0.9)):
        assert cell[j] in probes[i]
        near = index.distances(points[i:i + 1], int(cell[j]), codes[j:j + 1])[0, 0]
        assert math.sqrt(max(near, 0)) - error[j] <= index.radius + vectors.SLACK
    assert (cosines >= 0.9).sum() > 2000
