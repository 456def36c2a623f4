"""Grammar-compressed token files: round trips, ranges, order, checksums against the tokenizer itself."""

import tempfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import odd_documents
from tokenizers import Tokenizer

from daygrain.llm import repair, slots, token_files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
HOSTILE = ["<|endoftext|>", "A<|EndOfText|>b <|endoftext|> C.D", "don't 'll we've", "a.b,c;d 3.14 x!!", " né ﬁ", "é.́", "日本語、テキスト。",
           "tab\tnew\nline\x0bv\x0cf\x1cfs", "İSTANBUL ſ K", "ab" * 300_000, "x " * 200_000, " ", "", "A.B" * 50, "l'été d'élan qu'il's we'll a'b 'S x'", "ÉCOLE Straße İi ŉx ſt ǆ Ǆ ﬀ ÿŸ", "a$$$b c_d (e) f-g h/i j|k l<|m n>o [p] {q} ~r `s`", "x<|endoftext|>y", "c≠d e̸"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "own", i, 5) for i, t in rows], "doc_id long, text string, doc string, row long, size int").repartition(parts)


TOKENIZER = Tokenizer.from_file(VOCABULARY)


def tokens(text, end=2):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(2, 4), st.data())
def test_any_range_is_read_back(ids, least, data):
    ids = np.array(ids, np.int64)
    shard = repair.Shard(repair.to_bytes(repair.compressed(ids, 6, least=least, gain=0)))
    assert (shard.read() == ids).all() and shard.ids == len(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids) + 5))
    assert (shard.read(a, b) == ids[a:b]).all()


def test_repeats_become_rules():
    ids = np.tile(np.arange(50), 400)
    grammar = repair.compressed(ids, 50)
    assert len(grammar.symbols) < len(ids) / 20 and grammar.lengths.max() >= 8
    used = np.bincount(np.concatenate([grammar.symbols, grammar.left, grammar.right]), minlength=50 + len(grammar.left))
    assert (used[50:] >= 1).all()
    assert len(repair.to_bytes(grammar)) < len(ids) / 10
    one = repair.Shard(repair.to_bytes(repair.compressed(np.zeros(100_000, np.int64), 1)))
    assert one.symbols < 2000 and (one.read(777, 99_123) == 0).all()


def test_bits():
    rng = np.random.default_rng(0)
    for bits in (1, 3, 8, 13, 17, 31):
        numbers = rng.integers(0, 1 << bits, 70_001)
        body = memoryview(repair.packed(numbers, bits))
        assert (repair.unpacked(body, bits, 0, len(numbers)) == numbers).all()
        assert (repair.unpacked(body, bits, 65_530, 65_600) == numbers[65_530:65_600]).all()


@pytest.mark.parametrize("kept", [slots.KEPT, 5])
def test_words_equal_the_tokenizer(kept, monkeypatch):
    monkeypatch.setattr(slots, "KEPT", kept)
    texts = [t for _, t in odd_documents()] + HOSTILE + [" ".join(HOSTILE[:9])] * 3
    words = token_files.WordIds(VOCABULARY)
    for _ in range(2):
        ids, before = words.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == [tokens(t)[:-1] for t in texts]
    assert words.encode(pa.array([], pa.string()))[1].tolist() == [0]


WORDS = token_files.WordIds(VOCABULARY)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    ids, before = WORDS.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == [tokens(t)[:-1] for t in texts]


def test_words_are_encoded_without_offsets():
    """Words go to the tokenizer's fast call, many at a time, and are read as text as one by one."""

    class Fast:
        def encode_batch_fast(self, *args, **kwargs):
            return WORDS.bare.encode_batch_fast(*args, **kwargs)

    words = [w for t in HOSTILE for w in t.lower().encode().split()][:600] + [b"ab\xc3", b"\xff", b"\xe2\x82", "née".encode()]
    assert slots.decoded(words) == [w.decode("utf-8", "replace") for w in words] and slots.decoded([]) == [] and slots.decoded([b""]) == [""]
    signs = slots.in_signs([w for w in words if w])
    ids, sizes = slots.whole_words(Fast(), signs, WORDS.closing, 7)
    plain = [WORDS.bare.encode([w], is_pretokenized=True, add_special_tokens=False).ids for w in signs]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == plain


def test_slots_hold_many():
    table = slots.Slots()
    names = np.random.default_rng(1).integers(0, 1 << 63, 200_000, dtype=np.uint64)
    names = np.unique(names)
    for i in range(0, len(names), 7000):
        table.add(names[i:i + 7000])
    assert (table.find(names) == np.arange(len(names))).all() and (table.find(names + np.uint64(1)) < 0).sum() > 199_000


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, at = [], 0
    for i, t in rows:
        own = tokens(t)
        out.append((i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    return out


@pytest.mark.parametrize("limit", [token_files.SHARD_IDS, 500])
def test_files_hold_all_documents_in_order(spark, limit):
    rows = [(i, t) for i, t in odd_documents() if i is not None] + [(300 + i, t) for i, t in enumerate(HOSTILE[:9])] + [(None, "no id")]
    seen = set()
    rows = [r for r in rows if r not in seen and not seen.add(r)] + [(5, "again"), (5, "again")]
    path = tempfile.mkdtemp() + "/files"
    token_files.write(frame(spark, rows), path, VOCABULARY, shard_ids=limit)
    got = [tuple(r) for r in token_files.digests(spark, path).collect()]
    assert sorted(g[0] if g[0] is not None else -1 for g in got) == sorted(r[0] if r[0] is not None else -1 for r in rows)
    assert {(g[0], g[2], g[3]) for g in got} == {(e[0], e[2], e[3]) for e in expected(rows)}
    order = sorted(got, key=lambda g: g[1])
    assert [g[1] for g in order] == np.cumsum([0, *[g[2] for g in order[:-1]]]).tolist()
    ids = [-1 if g[0] is None else g[0] for g in order]
    assert ids == sorted(ids)
    if limit == 500:
        assert spark.read.parquet(f"{path}/shards").count() > 10
        stream = [y for g in order for y in next(tokens(t) for i, t in rows if i == g[0] and len(tokens(t)) == g[2] and zlib.crc32(np.array(tokens(t), "<u4").tobytes()) == g[3])]
        ranges = [(1, 0, 10), (2, 490, 1720), (3, len(stream) - 5, len(stream) + 9), (4, 30, 30), (5, -7, 3), (6, 1234, 1235)]
        back = token_files.read(spark, path, spark.createDataFrame(ranges, "name long, start long, stop long"))
        assert {r.name: r.ids for r in back.collect()} == {n: stream[max(a, 0):max(b, 0)] for n, a, b in ranges}


def test_empty_table(spark):
    path = tempfile.mkdtemp() + "/files"
    token_files.write(frame(spark, []), path, VOCABULARY)
    assert token_files.digests(spark, path).count() == 0


def test_one_id_on_most_rows_and_text_ids(spark):
    rows = [("hot", f"w{i} w{i % 7}") for i in range(400)] + [("a", "x"), ("z", None)]
    named = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    path = tempfile.mkdtemp() + "/files"
    token_files.write(named, path, VOCABULARY, shard_ids=100)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_files.digests(spark, path).collect())
    assert [g[2] for g in got] == sorted(r[0] for r in rows) and len({r[0] for r in spark.read.parquet(f"{path}/shards").select("part").collect()}) > 3


def test_hashes_depend_on_the_span_alone():
    rng = np.random.default_rng(2)
    body = rng.integers(97, 100, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 3000)
    ends = starts + rng.integers(1, 65, 3000)
    names = {}
    for a, b, h in zip(starts, ends, slots.span_hashes(body, starts, ends).tolist()):
        assert names.setdefault(body[a:b].tobytes(), h) == h
    assert len(set(names.values())) == len(names)
    assert slots.span_hashes(body[-3:], np.array([0, 2]), np.array([3, 3])).tolist() == slots.span_hashes(body, np.array([4997, 4999]), np.array([5000, 5000])).tolist()


def bits_one_by_one(numbers, bits):
    """The documented string of bits: the lowest bit of a number first, bytes filled from their lowest bit."""
    flags = [n >> k & 1 for n in numbers for k in range(bits)]
    flags += [0] * (-len(flags) % 8)
    return bytes(sum(f << k for k, f in enumerate(flags[i:i + 8])) for i in range(0, len(flags), 8))


@pytest.mark.parametrize("bits", [1, 2, 5, 7, 8, 9, 16, 17, 24, 31, 32])
def test_strings_of_bits_of_any_length(bits):
    rng = np.random.default_rng(bits)
    for n in (*range(20), 1003):
        numbers = rng.integers(0, 1 << bits, n)
        body = repair.packed(numbers, bits)
        assert body == bits_one_by_one(numbers.tolist(), bits)
        for a in range(0, n, 1 + n // 20):
            for b in (a, a + 1, (a + n) // 2, n):
                assert (repair.unpacked(memoryview(body), bits, a, b) == numbers[a:b]).all()


def test_bits_are_moved_as_numbers(monkeypatch):
    """Not bit by bit: that took most of the time of reading a shard."""
    def refused(*_, **__):
        raise AssertionError("bits one by one")

    numbers = np.arange(100_000) % 40_961
    monkeypatch.setattr(np, "unpackbits", refused)
    monkeypatch.setattr(np, "packbits", refused)
    assert (repair.unpacked(memoryview(repair.packed(numbers, 17)), 17, 7, 99_999) == numbers[7:99_999]).all()


def test_signs_of_lines_equal_those_of_words():
    words = [bytes([b]) for b in range(256) if b != 0x0A] + ["été".encode(), b"", "ŉ日本".encode()] + [bytes(b for b in range(256) if b != 0x0A)]
    assert slots.lines_in_signs(words) == slots.in_signs(words)
    assert slots.lines_in_signs([]) == []
