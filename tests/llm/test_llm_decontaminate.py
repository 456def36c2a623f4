import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import LOWER, odd_documents, sentence

from daygrain.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, items, window):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for a in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if own := windows.get(tuple(w[a:a + n])):
                    hit.update(range(a, a + n))
                    found |= own
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None), len(found)))
    return out


@pytest.fixture
def tables(spark):
    import random

    rng = random.Random(3)
    rows = odd_documents()
    long = next(t for i, t in rows if i == 211)
    w = words(long)
    items = [
        (1, " ".join(w[500:560])), (2, " ".join(w[530:545]).upper()), (3, "one, two; three"), (3, " ".join(w[:12])), (4, None), (5, "..."),
        (6, sentence(rng, 30)), (7, "zürich ça"), (None, " ".join(words(rows[0][1])[20:34])), (8, " ".join(words(rows[0][1])[-10:])),
        (9, " ".join(words(rows[0][1])[-9:] + ["q"])), (10, "ab" * 500),
    ]
    return rows, items


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_equals_plain_search(spark, tables, monkeypatch, block):
    rows, items = tables
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (block,))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.contamination(docs, bench, 10).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    expected = plain(rows, items, 10)
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.n_items) for r in got], key=key) == sorted(expected, key=key)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    kept = decontaminate.decontaminated(docs, bench, 10)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([e[0] for e in expected if not e[2]], key=str)
    by = {r.doc_id: r for r in got}
    assert max(m.n_words for m in by[211].matches) == 60 and {(m.item_start, m.doc_start) for m in by[211].matches if m.n_words == 60} == {(0, 500)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.contamination(docs, bench).collect()] == [(1, 3, 0, 0)]
    assert decontaminate.decontaminated(docs, bench).count() == 1
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, rng.integers(0, 60))) for _ in range(30)] + ["w1 " * 40, "w1 " * 40, ""]
    hashes, bounds = decontaminate.words_of(pa.array(texts))
    shard = decontaminate.suffix_array(hashes, bounds, 64)
    suffix = lambda i: [*shard.codes[i:i + np.argmin(shard.codes[i:] != 0)].tolist(), 0]
    listed = [suffix(i) for i in shard.order.tolist()]
    assert listed == sorted(listed) and sorted(shard.order.tolist()) == list(range(len(shard.codes)))


def plain_matches(rows, items, window):
    out = set()
    for d, text in rows:
        w = words(text)
        for i, item in items:
            x = words(item)
            for s in range(len(x) - min(window, len(x)) + 1) if x else ():
                lengths = []
                for p in range(len(w)):
                    n = 0
                    while s + n < len(x) and p + n < len(w) and x[s + n] == w[p + n]:
                        n += 1
                    lengths.append(n)
                if lengths and max(lengths) >= min(window, len(x)):
                    out.add((d, i, s, lengths.index(max(lengths)), max(lengths)))
    return out


@pytest.mark.parametrize("shards", [1, 4])
def test_every_copy_has_its_own_longest_matches(spark, shards):
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join(["x", *passage[:n], "y", *passage[4:n - 1]])) for i, n in enumerate([30, 30, 22, 12, 11, 30, 9])] + [(7, "a b a b a b c"), (8, None)]
    items = [(1, " ".join(passage)), (2, " ".join(passage[5:] + passage[:12])), (3, "a b"), (4, "a b a b c a b a b c a b a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(shards)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    listed = [(r.doc_id, int(m.item_id), m.item_start, m.doc_start, m.n_words) for r in got for m in r.matches]
    assert len(listed) == len(set(listed)) and set(listed) == plain_matches(rows, items, 10)


def test_one_block_at_a_time(spark, tables, monkeypatch):
    """Only one block of items is alive while another is read, and no task runs two steps."""
    rows, items = tables
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (300,))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontaminate.item_blocks(bench, 10)
    assert iter(blocks) is blocks and sum(len(b.ids) for b in blocks) == len([t for _, t in items if t is not None])
    for out in (decontaminate.contamination(docs, bench, 10), decontaminate.decontaminated(docs, bench, 10)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
        assert out.count()
