import numpy as np
import pytest
from llm_fixtures import near_duplicates as plain
from llm_fixtures import odd_documents, shingle_set

from daygrain.llm import minhash
from daygrain.llm.graph import components

SCHEMA = "doc_id long, text string, n long, rep string, sketch string"


@pytest.mark.parametrize("k,block", [(4, 1024), (5, 8)])
def test_equals_all_pairs(spark, monkeypatch, k, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = odd_documents()
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    got = minhash.near_duplicates(docs, k, 80).collect()
    assert len(got) == len(rows)
    expected = plain(rows, k, 80)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == expected[r.doc_id]
    assert len({v[1] for v in expected.values()}) < len(expected) - 8


def test_hot_group_of_distant_copies(spark, monkeypatch):
    """Copies that are near some others only: the first comparison leaves most open."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows, before = [], base
    for i in range(60):
        words = list(before if i % 4 else base)
        for j in rng.choice(len(words), rng.integers(1, 6), replace=False):
            words[j] = f"m{rng.integers(1000)}"
        before = words
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == plain(rows, 4, 80)
    assert 3 < len({v[1] for v in got.values()}) < 50


def two_texts():
    """Document 5 has three texts; each has a near copy of its own."""
    texts = [" ".join(f"{c}{i}" for i in range(80)) for c in "abc"]
    near = [t + " end" for t in texts]
    return [(5, texts[0]), (5, texts[1]), (5, texts[2]), (7, near[0]), (9, near[1]), (2, near[2]), (2, near[2]), (5, texts[0])]


def test_a_document_with_several_texts(spark):
    rows = [(i, t, t[0]) for i, t in two_texts()]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, c string"), 5, carried=("c",)).collect()
    expected = {"a": 5, "b": 5, "c": 2}
    assert sorted((r.doc_id, r.c, r.component_id, r.kept) for r in got) == sorted((i, c, expected[c], i == expected[c]) for i, _, c in rows)


def test_pipeline_judges_each_text_of_a_document(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, t, "x") for i, t in two_texts()], "doc_id long, text string, kept string")
    out = corpus_pipeline.without_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    texts = dict.fromkeys(two_texts())
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((i, t) for i, t in texts if (i, t[0]) in {(5, "a"), (5, "b"), (2, "c")})


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_estimates_follow_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        common = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
        n = int(2000 * (1 / share - 1) / 2)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in "ab")
        sketch = [minhash.registers(np.sort(x), np.array([0, len(x)]))[0] for x in (a, b)]
        errors.append(abs(((sketch[0] == sketch[1]).mean()) - share))
    assert max(errors) < 0.15
    assert 1e-5 < minhash.accidental(np.array([100_000]))[0] < 1e-3


def test_register_keeps_zeros_and_mantissa():
    bits = np.array([(5 << 57) | (1 << 40), (5 << 57) | (1 << 50), (9 << 57) | (3 << 55)], np.uint64)
    row = minhash.registers(np.sort(bits), np.array([0, 3]))[0]
    assert np.flatnonzero(row).tolist() == [5, 9]
    assert row[5] >> minhash.MANTISSA == 64 - 48 + 1 and row[9] >> minhash.MANTISSA == 1
    assert (minhash.filled(row[None, :]) != 0).all() and not minhash.filled(np.zeros((1, 128), np.uint16)).any()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 70)]
    star = [(1000, i) for i in range(1001, 1100)]
    links = spark.createDataFrame([*path, *star, (5, 5), (3, 2), (None, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(71)}, **{i: 1000 for i in range(1000, 1100)}}
    assert components(links.limit(0)).collect() == []


def test_sets_are_whole():
    import pyarrow as pa

    from daygrain.llm.text import text_sets

    texts = [t for _, t in odd_documents()]
    sets, bounds = text_sets(pa.array(texts, pa.string()), 4)
    assert np.diff(bounds).tolist() == [len(shingle_set(t, 4)) for t in texts]
