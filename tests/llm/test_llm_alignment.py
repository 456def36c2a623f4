"""Alignment of two tokenizers against plain Python on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import odd_documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from daygrain.llm import alignment, slots

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIRST, SECOND = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
FIRST.encode_special_tokens = True
SIGNS = slots.byte_of_sign()
HOSTILE = ["<|endoftext|> <s> </s> <0x0A> <unk>", " lead", "trail ", "  two  spaces  ", "\n\nnew\n line\r\n", "tab\t x", "a  b  c　 d\u0085 e",
           "▁", "a▁ b", "x ▁y", "﻿ a", "​ z", "don't WE'VE 's", "日本語、 テキスト。 é é 😀 👩‍👩‍👧", "\x00 \x1c a\x7f b", "a" * 3000,
           "ab c" * 900, "ﬁ ① Ａ", " ", "   ", "1234 5.678,9", "http://x.y/?q=" + "Zx9" * 60, "  q ᠎ r"]


def encoded(text):
    a = FIRST.encode(" " + text, add_special_tokens=False)
    b = SECOND.encode(text)
    raw_a = [bytes(SIGNS[c] for c in t) for t in a.tokens]
    raw_b = [bytes([int(SECOND.id_to_piece(i)[1:-1], 16)]) if SECOND.is_byte(i) else SECOND.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a.ids, raw_a, b, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])


def grouped(text):
    """[(ids of the first, ids of the second)]"""
    if not text:
        return []
    ids_a, raw_a, ids_b, raw_b = encoded(text)
    ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
    cuts = sorted(set(ends_a) & set(ends_b))
    out = [([], []) for _ in cuts]
    for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
        at = 0
        for i, e in zip(ids, ends):
            while e > cuts[at]:
                at += 1
            out[at][side].append(i)
    return out


def expected(rows):
    found = [grouped(t) for _, t in rows]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in found]
    counts = Counter(pair for own in links for pair in own)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, _), groups, own in zip(rows, found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "own", 1, 2) for i, t in rows], "doc_id long, text string, doc string, slice int, pairs int").repartition(parts)


def order(row):
    return [(v is None, v if v is not None else 0) for v in row]


@pytest.mark.parametrize("limit", [alignment.SLICE, 3000])
def test_equals_plain_python(spark, limit, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", limit)  # in the driver's process; workers keep the default for long texts
    rows = odd_documents() + [(300 + i, t) for i, t in enumerate(HOSTILE)] + [(400 + i, " ".join(HOSTILE[i:i + 5])) for i in range(len(HOSTILE))]
    got = [tuple(r) for r in alignment.aligned(frame(spark, rows), A, B).collect()]
    assert sorted(got, key=order) == sorted(expected(rows), key=order)
    assert sum(1 for g in got if g[1] == 0) >= 6


@pytest.mark.parametrize("kept, pairs, block", [(alignment.CHUNKS, alignment.PAIRS, slots.BLOCK), (20, 50, 100)])
def test_chunks_equal_whole_texts(kept, pairs, block, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNKS", kept)
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    monkeypatch.setattr(alignment, "BLOCK", block)
    aligner = alignment.Aligner(A, B)
    assert aligner.apart
    texts = [t for _, t in odd_documents()] + HOSTILE
    for i in range(0, len(texts), 9):
        aligner.trimmed()
        facts, told, key, weight = aligner.documents(pa.array(texts[i:i + 9]))
        for k, text in enumerate(texts[i:i + 9]):
            groups = grouped(text)
            own = Counter((a, b) for x, y in groups for a in x for b in y)
            mine = key >> 32 == k
            names = aligner.names.body[key[mine] & 0xFFFFFFFF]
            assert dict(zip(zip((names >> 32).tolist(), (names & 0xFFFFFFFF).tolist()), weight[mine].tolist())) == dict(own)
            if groups:
                assert b"".join(told[k])[:-1].decode() == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


ALIGNER = alignment.Aligner(A, B)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n  ▁ab.'1é日"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_any_text(texts):
    facts, _, _, _ = ALIGNER.documents(pa.array(texts, pa.string()))
    for text, fact in zip(texts, facts.tolist()):
        groups = grouped(text)
        assert fact[:4] == [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(len(x) * len(y) for x, y in groups)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=60), st.randoms())
def test_doubling_finds_the_common_ends(sizes, rng):
    total = sum(sizes)
    other = []
    while sum(other) < total:
        other.append(rng.randint(1, min(6, total - sum(other))))
    a, b = np.cumsum(sizes), np.cumsum(other)
    last = alignment.terminals(a, b)
    common = sorted(set(a.tolist()) & set(b.tolist()))
    wanted = [next(c for c in common if c >= e) for e in [*a.tolist(), *b.tolist()]]
    assert b[last].tolist() == wanted


def test_empty_table_text_ids_and_groups(spark):
    assert alignment.aligned(frame(spark, []), A, B).count() == 0
    named = spark.createDataFrame([("x:1", "Hello there"), (None, "Hello there"), ("y", None)], "doc_id string, text string")
    got = {r.doc_id: r for r in alignment.aligned(named, A, B).collect()}
    assert got["x:1"].n_links == got[None].n_links > 0 and got["y"].groups_sha256 == "" and got["x:1"].count_sum == 2 * got["x:1"].n_links
    listed = sorted((r.position, r.a, r.b) for r in alignment.groups(named, A, B).where("doc_id = 'x:1'").collect())
    assert [(a, b) for _, a, b in listed] == grouped("Hello there")
