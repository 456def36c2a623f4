import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from llm_fixtures import odd_documents, spaced

from daygrain.llm import lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_base_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr(lattice, "SHARD_BYTES", 3000)
    rows = odd_documents()
    got = lattice.document_scores(spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3), MODEL).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            counts.update(spaced(t))
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + 1
    floor = total + 0.5 * (types + 1)
    expected = []
    for i, t in rows:
        w = spaced(t)
        base = sum(math.log10((counts[x] + 0.5) / floor) for x in [*w]) + math.log10((ends + 0.5) / floor)
        expected.append((i, held(i), len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total, base))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and -1e12 < a[6] < 0


def test_empty_and_unlearnt(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lattice.document_scores(empty, MODEL).collect() == []
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    [row] = lattice.document_scores(spark.createDataFrame([(held, "never seen")], "doc_id long, text string"), MODEL).collect()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and math.isfinite(row.score) and math.isfinite(row.base_score)


def test_all_segmentations_count():
    counts = {300: 5.0, 400: 2.0, 1000: 50.0}
    sp = lattice.vocabulary(MODEL)
    model = lattice.lattice(MODEL, counts)
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    total = sum(counts.get(i, 0) + 0.5 for i in usable)
    arcs = Counter()
    for i in usable:
        piece = sp.id_to_piece(i)
        arcs[bytes([int(piece[3:-1], 16)]) if sp.is_byte(i) else piece.encode()] += (counts.get(i, 0) + 0.5) / total
    words = ["hello", "naïve", "the", "日本語", "x", "", "Z" * 70, "the"]
    for word, found in zip(words, model.words([w.encode() for w in words]), strict=True):
        raw = ("▁" + word).encode()
        alpha = [1.0] + [0.0] * len(raw)
        for end in range(1, len(raw) + 1):
            alpha[end] = sum(alpha[a] * arcs[raw[a:end]] for a in range(max(0, end - 60), end))
        assert found == pytest.approx(math.log(alpha[-1]), rel=1e-9)


def test_frequent_words_are_likelier(spark):
    rows = [(i, "common words again and again " * 20 + f"rare{i}") for i in range(40)] + [(1000, "common again"), (1001, "qzxv jkwq")]
    got = {r.doc_id: r.score for r in lattice.document_scores(spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect()}
    assert got[1000] > got[1001] + 3
