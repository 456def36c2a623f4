import zlib

import numpy as np
import public_tokenizers
from llm_fixtures import odd_documents
from tokenizers import Tokenizer

from daygrain.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_and_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rows = [*odd_documents(), (300, "a<|endoftext|>b THE <|ENDOFTEXT|> it's can't 12,5 x.y.z ́mark o'clock's ...'s")]
    got = packing.pack(spark.createDataFrame([(i, t, "?") for i, t in rows], "doc_id long, text string, offset string"), PATH, 512).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 512)):
            cut = ids[s:s + 512]
            expected.append((i, k, s, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(expected, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(by) <= -(-sum(r.length for r in got) // 512) + 2 * -(-len(got) // 40)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_every_constraint_holds():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1000, 700)
    for rule in ("norm", "dot"):
        bins, offsets = packing.best_fit(lengths, 1000, 4, 1_200_000, (1.0, 0.3, 0.5), rule)
        for b in np.unique(bins):
            own = lengths[bins == b]
            assert own.sum() <= 1000 and len(own) <= 4 and (own * own).sum() <= 1_200_000
            assert sorted(offsets[bins == b]) == [0, *np.cumsum(own[np.argsort(offsets[bins == b])])[:-1]]


def test_best_fit_is_tight():
    lengths = np.array([600, 400, 500, 500, 999, 1, 300, 300, 400])
    bins, _ = packing.best_fit(lengths, 1000, 1000, 1000 * 1000, (1.0, 0.0, 0.0), "norm")
    assert len(set(bins)) == 4
