import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import odd_documents

from daygrain.llm.repeats import anchors, gram, gram_hashes, merged, repeats, string_hashes


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        runs = []
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + length
                else:
                    runs.append([s, s + length])
        kept, at = b"", 0
        for a, e in runs:
            kept, at = kept + b[at:a], e
        out.append((i, len(b), sum(e - a for a, e in runs), [x for r in runs for x in r], hashlib.sha256(kept + b[at:]).hexdigest()))
    return out


def fixture():
    rng = random.Random(9)
    letters = lambda n, alphabet="abcdefgh ": "".join(rng.choice(alphabet) for _ in range(n))
    base = letters(900)
    rows = [(i, t) for i, t in odd_documents() if t is None or len(t) < 20_000]
    rows += [(500, base), (501, base), (502, base[100:700] + "zz"), (503, "q" * 130 + base[300:520]), (504, base[:450] + "#" + base[451:])]
    rows += [(520 + i, base[:200 + i] + rng.choice("XYZ") + base[205 + i:]) for i in range(12)]
    rows += [(550 + i, letters(rng.randrange(90), "mnop") + base[210:330] + letters(rng.randrange(90), "mnop")) for i in range(15)]
    rows += [(600, letters(700) + "é" * 80 + base[:61]), (None, base), (None, letters(300))]
    return rows


@pytest.mark.parametrize("length", [60, 100])
def test_equals_all_windows(spark, length):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, 3, "u") for i, t in rows], "doc_id long, text string, at int, unit string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, list(r.spans), r.kept_sha256) for r in repeats(docs, length).collect()]
    assert all(r.n_spans == len(r.spans) // 2 for r in repeats(docs.limit(20), length).collect())
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(plain(rows, length), key=key)


def test_long_text_repeats_itself(spark):
    rng = random.Random(1)
    part = "".join(rng.choice("abcdefghij") for _ in range(700_000))
    text = part + "|" + "".join(rng.choice("klmnop") for _ in range(1_200_000)) + "|" + part + "#"
    [row] = repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"), 400).collect()
    assert row.spans == [0, 700_000, 1_900_002, 2_600_002] or row.spans == [0, 700_000, 1_900_001, 2_600_001 + 1]


def test_empty_table(spark):
    assert repeats(spark.createDataFrame([], "doc_id long, text string"), 400).collect() == []


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    body = rng.integers(97, 100, 4000).astype(np.uint8)
    body[2500:3100] = body[300:900]
    length = 120
    text, at, first, last = anchors(body, np.array([0, 4000]), length)
    chosen = {}
    for p, a, b in zip(at, first, last):
        for d in range(a, b + 1):
            assert p - d not in chosen
            chosen[p - d] = d
    assert sorted(chosen) == list(range(4000 - length + 1))
    assert all(chosen[300 + s] == chosen[2500 + s] for s in range(600 - length + 1))


def test_hashes_depend_on_the_string_alone():
    body = np.frombuffer(b"xxhello worldyyhello worldz", np.uint8)
    h = string_hashes(body, np.array([2, 15, 0]), np.array([13, 26, 3]))
    assert (h[0] == h[1]).all() and (h[0] != h[2]).any()
    assert (string_hashes(body[2:], np.array([0]), np.array([11]))[0] == h[0]).all()
    g = gram_hashes(body, 11)
    assert g[2] == g[15] and len(set(g[:17].tolist())) == 16 and not g[17:].any()
    assert gram(400) == 100 and merged([(5, 9), (0, 5), (12, 13)]) == [(0, 9), (12, 13)]
