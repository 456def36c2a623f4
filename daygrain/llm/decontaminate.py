"""Benchmark passages in training documents, found with suffix arrays over the training words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.text import LOWER, NOT_ALNUM, flat, pieces, word_hashes, word_spans
from daygrain.session import removed, shared_path

SHARD_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20


@dataclass
class Shard:
    """A suffix array over the words of some documents; code 0 stands after each document."""

    codes: np.ndarray
    order: np.ndarray
    keys: np.ndarray  # the first ``packed`` codes of each suffix, in suffix order
    vocabulary: np.ndarray
    packed: int
    width: int
    first: np.ndarray  # where each document begins in ``codes``
    counts: np.ndarray  # words of each document


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = flat(texts)
    body = LOWER[body]
    starts, ends, bounds = word_spans(body, offsets, NOT_ALNUM)
    return word_hashes(body, starts, ends), bounds


def suffix_array(hashes: np.ndarray, bounds: np.ndarray, depth: int) -> Shard:
    """Sort all suffixes by their first ``depth`` words or more; a document's end comes before every word.

    One sort by as many words as fit 63 bits, then prefix doubling over the suffixes that still tie.
    """
    docs = len(bounds) - 1
    vocabulary, code = np.unique(hashes, return_inverse=True)
    counts = np.diff(bounds)
    codes = np.zeros(len(hashes) + docs, np.int64)
    codes[np.arange(len(hashes)) + np.repeat(np.arange(docs), counts)] = code + 1
    first = bounds[:-1] + np.arange(docs)
    width = max(1, int(len(vocabulary)).bit_length())
    packed = max(1, 63 // width)
    n = len(codes)
    # beyond a document's end everything counts as its end
    room = np.repeat(first + counts, counts + 1) - np.arange(n)
    keys = np.zeros(n, np.int64)
    padded = np.concatenate([codes, np.zeros(packed, np.int64)])
    for j in range(packed):
        keys = (keys << width) | np.where(room > j, padded[j:n + j], 0)
    order = np.argsort(keys)
    ordered = keys[order]
    head = np.ones(n, bool)
    head[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known = packed
    while known < depth and n:
        at = np.flatnonzero(~head | np.concatenate([~head[1:], [False]]))
        if not len(at):
            break
        here = order[at]
        major = rank[here]
        minor = np.where(room[here] > known, rank[np.minimum(here + known, n - 1)] + 1, 0)
        again = np.lexsort((minor, major))
        order[at], major, minor = here[again], major[again], minor[again]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
        head[at] = fresh
        rank[order[at]] = np.maximum.accumulate(np.where(fresh, at, 0))
        known *= 2
    return Shard(codes, order, ordered, vocabulary, packed, width, first, counts)


def _narrow(shard: Shard, low, high, j, code):
    """Within [low, high) all suffixes agree on j words; the part whose next word is ``code``."""
    def bound(lo, hi, after):
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            at = shard.order[np.where(open_, mid, 0)] + j
            value = shard.codes[np.minimum(at, len(shard.codes) - 1)]
            less = (value <= code) if after else (value < code)
            lo = np.where(open_ & less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)

    start = bound(low, high, False)
    return start, bound(start, high, True)


@dataclass
class Items:
    """Test passages: word hashes of all items in a row; each word begins a suffix."""

    ids: list
    hashes: np.ndarray
    bounds: np.ndarray
    window: int

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def window_matches(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, low, high) of the test suffixes whose window occurs.

    Suffix array entries low..high begin with the suffix's window.  A window is ``items.window`` words, or all words of a shorter item.
    """
    none = np.zeros(0, np.int64)
    total = len(items.hashes)
    if not total or not len(shard.vocabulary):
        return none, none, none
    at = np.minimum(np.searchsorted(shard.vocabulary, items.hashes), len(shard.vocabulary) - 1)
    code = np.where(shard.vocabulary[at] == items.hashes, at + 1, -1)
    sizes = np.diff(items.bounds)
    room = np.repeat(items.bounds[1:], sizes) - np.arange(total)
    window = np.minimum(items.window, np.repeat(sizes, sizes))
    live = np.flatnonzero(room >= window)
    padded = np.concatenate([code, np.full(max(shard.packed, 1), -1)])
    # all of the first words at once
    taken = np.minimum(shard.packed, window[live])
    low_key = np.zeros(len(live), np.int64)
    good = np.ones(len(live), bool)
    for j in range(shard.packed):
        c = np.where(j < taken, padded[live + j], 0)
        good &= c >= 0
        low_key = (low_key << shard.width) | np.maximum(c, 0)
    span = np.int64(1) << ((shard.packed - taken) * shard.width)
    live, taken, low_key, span = live[good], taken[good], low_key[good], span[good]
    low = np.searchsorted(shard.keys, low_key)
    high = np.searchsorted(shard.keys, low_key + (span - 1), "right")
    keep = low < high
    live, low, high, taken = live[keep], low[keep], high[keep], taken[keep]
    # word by word to the end of the window
    length = taken.copy()
    going = np.flatnonzero(length < window[live])
    while len(going):
        j = length[going]
        c = padded[live[going] + j]
        start, stop = _narrow(shard, low[going], high[going], j, c)
        more = (start < stop) & (c > 0)
        going, start, stop = going[more], start[more], stop[more]
        low[going], high[going] = start, stop
        length[going] += 1
        going = going[length[going] < window[live[going]]]
    found = length >= window[live]
    return live[found], low[found], high[found]


def match_lengths(suffix: np.ndarray, position: np.ndarray, owner: np.ndarray, window: np.ndarray) -> np.ndarray:
    """How many words from ``position`` on equal the test suffix, for every place of every window.

    A match goes on as long as the item's next window lies one word further: its length is a window and the windows that
    follow in the run.
    """
    order = np.lexsort((suffix, position - suffix))
    s, p = suffix[order], position[order]
    ends = np.ones(len(order), bool)
    ends[:-1] = (s[1:] != s[:-1] + 1) | (p[1:] != p[:-1] + 1) | (owner[s[1:]] != owner[s[:-1]])
    last = np.flatnonzero(ends)
    out = np.empty(len(order), np.int64)
    out[order] = last[np.searchsorted(last, np.arange(len(order)))] - np.arange(len(order)) + window[s]
    return out


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = high - low
    first = np.cumsum(sizes) - sizes
    which = np.repeat(np.arange(len(low)), sizes)
    return which, np.arange(int(sizes.sum())) - first[which] + low[which]


@dataclass
class Found:
    """What one block of items has in one shard, text by text."""

    counts: np.ndarray
    n_hit: np.ndarray
    spans: list[list[int]]  # starts and ends of hit runs of words, in turn
    items: list[set]
    longest: list[list[dict]]


def search(texts: pa.Array, items: Items, earlier: list[list[int]] | None = None) -> Found:
    """Build the shard's suffix array and look up every suffix of the items; ``earlier`` spans count as hit."""
    hashes, bounds = words_of(texts)
    depth = int(np.diff(items.bounds).max()) if len(items.ids) else 1
    shard = suffix_array(hashes, bounds, depth)
    suffix, low, high = window_matches(shard, items)
    which, entry = _spread(low, high)
    position = shard.order[entry]
    sizes = np.diff(items.bounds)
    window = np.minimum(items.window, np.repeat(sizes, sizes))
    change = np.zeros(len(shard.codes) + 1, np.int64)
    np.add.at(change, position, 1)
    np.add.at(change, position + window[suffix[which]], -1)
    for d, spans in enumerate(earlier or ()):
        for a, b in zip(spans[::2], spans[1::2]):
            change[shard.first[d] + a] += 1
            change[shard.first[d] + b] -= 1
    hit = np.cumsum(change[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(hit)])
    n_hit = sums[shard.first + shard.counts] - sums[shard.first]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    owner = np.searchsorted(shard.first, edges[::2], "right") - 1
    spans = [[] for _ in range(len(texts))]
    for d, a, b in zip(owner.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        spans[d] += [a - int(shard.first[d]), b - int(shard.first[d])]
    found: list[set] = [set() for _ in range(len(texts))]
    doc = np.searchsorted(shard.first, position, "right") - 1
    for pair in np.unique(doc * max(len(items.ids), 1) + items.owner[suffix[which]]).tolist():
        d, i = divmod(pair, max(len(items.ids), 1))
        found[d].add(items.ids[i])
    # each text's own longest match of each suffix, the first of equals
    owner, suffixes = items.owner, suffix[which]
    length = match_lengths(suffixes, position, owner, window)
    order = np.lexsort((position, -length, suffixes, doc))
    first = np.ones(len(order), bool)
    first[1:] = (doc[order][1:] != doc[order][:-1]) | (suffixes[order][1:] != suffixes[order][:-1])
    best = order[first]
    longest: list[list[dict]] = [[] for _ in range(len(texts))]
    for s, d, p, n in zip(suffixes[best].tolist(), doc[best].tolist(), position[best].tolist(), length[best].tolist()):
        i = int(owner[s])
        longest[d].append({"item_id": items.ids[i], "item_start": s - int(items.bounds[i]), "doc_start": p - int(shard.first[d]), "n_words": n})
    return Found(shard.counts, n_hit, spans, found, longest)


def item_blocks(benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The test passages in blocks of about ``block_bytes`` of text, by a count of their bytes; an item is never cut.

    The driver holds one block at a time: several lie in the shared folder, a folder each, and are read when asked for.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-int(total) // block_bytes))
    spark, path = benchmark.sparkSession, None
    if count > 1:
        path = shared_path(spark, "benchmark-blocks")
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int"))
        dealt.repartition("block").write.partitionBy("block").parquet(path)
        rows = spark.read.schema(dealt.schema).parquet(path)
    for b in range(count):
        got = (rows.where(F.col("block") == b) if path else rows).select("item_id", "text").collect()
        hashes, bounds = words_of(pa.array([r["text"] for r in got], pa.string()))
        yield Items([r["item_id"] for r in got], hashes, bounds, window)
    if path:
        removed(spark, path)


def passes(rows: DataFrame, blocks: Iterator[Items], step) -> DataFrame:
    """``step(rows, items)`` for one block after the other; a task holds one block.

    What a pass carries to the next is written to the shared folder, and deleted when the next is written.
    """
    spark, before = rows.sparkSession, None
    items = next(blocks)
    for following in blocks:
        path = shared_path(spark, "decontamination-pass")
        made = step(rows, items)
        made.write.parquet(path)
        if before:
            removed(spark, before)
        rows, before, items = spark.read.schema(made.schema).parquet(path), path, following
    return step(rows, items)


_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("n_words", pa.int64())]))
_CARRIED = "doc_id {}, text string, n_words long, n_hit long, spans array<long>, items array<string>, unnamed boolean, " \
    "matches array<struct<item_id: string, item_start: long, doc_start: long, n_words: long>>"


def _step(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=SHARD_BYTES):
                old = {c: part.column(c).to_pylist() for c in ("spans", "items", "unnamed", "matches")}
                got = search(part.column("text"), items, old["spans"])
                names = [sorted(set(o) | {x for x in f if x is not None}) for o, f in zip(old["items"], got.items)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text"), pa.array(got.counts, pa.int64()), pa.array(got.n_hit, pa.int64()),
                        pa.array(got.spans, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string())),
                        pa.array([u or None in f for u, f in zip(old["unnamed"], got.items)], pa.bool_()),
                        pa.array([o + m for o, m in zip(old["matches"], got.longest)], _MATCH),
                    ],
                    ["doc_id", "text", "n_words", "n_hit", "spans", "items", "unnamed", "matches"],
                )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """What each document (doc_id, text) has of the benchmark's items (item_id, text).

    Returns doc_id, n_words, n_hit (words inside an occurrence of ``window`` consecutive item words; an item with
    fewer words is one window), n_items, items (their ids as sorted text), spans (starts and ends of hit runs, in
    words), matches (for each test suffix found in the document: its longest verbatim match there and the first place where
    that lies) and contaminated.

    Documents are cut into shards of about 2 MB of whole texts.  Each shard gets a suffix array over its words, in
    which every test suffix is binary-searched; matches never cross documents.  The pass is narrow: nothing is
    shuffled.  A benchmark over 4 MB makes several passes, all but the last of which run when this is called.  Defined results: a null, empty or wordless text has no words and is clean; null and wordless items
    match nothing; items that share an id count once; an item without id hits words and counts as one more item;
    repeated documents are reported row by row; an empty table gives no rows, an empty benchmark clean ones.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    nothing = F.array().cast("array<long>"), F.array().cast("array<string>")
    out = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        nothing[0].alias("spans"), nothing[1].alias("items"), F.lit(False).alias("unnamed"),
        F.from_json(F.lit("[]"), "array<struct<item_id: string, item_start: long, doc_start: long, n_words: long>>").alias("matches"),
    )
    out = passes(out, item_blocks(benchmark, window), lambda rows, items: rows.mapInArrow(_step(items), _CARRIED.format(kind)))
    return out.select(
        "doc_id", "n_words", "n_hit", (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        "items", "spans", "matches", (F.col("n_hit") > 0).alias("contaminated"),
    )


def _clean(items: Items):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, limit=SHARD_BYTES):
                yield part.filter(pa.array(search(part.column("text"), items).n_hit == 0))

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no word inside an occurrence of a benchmark window."""
    return passes(docs, item_blocks(benchmark, window), lambda rows, items: rows.mapInArrow(_clean(items), docs.schema))
