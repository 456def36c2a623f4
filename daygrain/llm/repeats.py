"""Verbatim repeats of at least a given number of bytes, anywhere in a corpus.

All suffixes of all texts can't be sorted together at scale, so the suffixes compared are those at anchors that the
content itself chooses: the smallest hash of a short string among those inside a window of ``length`` bytes.
Equal windows have the same anchor at the same place, so every repeated window is found at its anchor.  How far the
texts around equal anchors agree is found by binary search over hashes of ever closer extensions, for all suffixes
at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.bitmap import split_by
from daygrain.llm.text import flat, mixed, pieces
from daygrain.session import written

SPLIT = 7  # an interval of window places is cut into so many parts

_R = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_TABLE = np.random.default_rng(977).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def powers(which: int, n: int) -> np.ndarray:
    out = np.full(n + 1, _R[which], np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def gram_hashes(body: np.ndarray, size: int) -> np.ndarray:
    """The polynomial hash of the ``size`` bytes from each position on (zeros where they don't fit)."""
    n = len(body)
    out = np.zeros(n, np.uint64)
    if n < size:
        return out
    power = powers(0, size)
    level, reach = _TABLE[0][body], 1  # hashes of ``reach`` bytes
    total, done = None, 0
    rest = size
    while rest:
        if rest & 1:
            if total is None:
                total = level.copy()
            else:
                total[:n - done] = total[:n - done] * power[reach] + level[done:]
            done += reach
        rest >>= 1
        if rest:
            grown = level * power[reach]
            grown[:n - reach] += level[reach:]
            level, reach = grown, reach * 2
    out[:n - size + 1] = total[:n - size + 1]
    return out


def gram(length: int) -> int:
    """Bytes of the strings among which anchors are chosen."""
    return max(1, length // 4)


def anchors(body: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, first, last) of each anchor; it is chosen by the windows that start first..last bytes before it."""
    size = gram(length)
    spread = length - size + 1
    none = np.zeros(0, np.int64)
    n = len(body)
    if n < length:
        return none, none, none, none
    low = (mixed(gram_hashes(body, size)) & ~np.uint64(0xFFFFFFFF)) | np.arange(n, dtype=np.uint64)
    reach, best, done, rest = 1, None, 0, spread
    while rest:  # the smallest of ``spread`` neighbours, by doubling
        if rest & 1:
            if best is None:
                best = low.copy()
            else:
                best[:n - done] = np.minimum(best[:n - done], low[done:])
            done += reach
        rest >>= 1
        if rest:
            low = low.copy()
            low[:n - reach] = np.minimum(low[:n - reach], low[reach:])
            reach *= 2
    sizes = np.diff(offsets)
    last = np.repeat(offsets[1:], sizes) - length  # the last window of a position's text
    starts = np.flatnonzero(np.arange(n) <= last)
    at = (best[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return none, none, none, none
    cut = np.ones(len(at), bool)
    cut[1:] = at[1:] != at[:-1]
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(at)) - 1
    where = at[head]
    text = np.searchsorted(offsets, where, "right") - 1
    return text, where - offsets[text], where - starts[tail], where - starts[head]


def string_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two independent polynomial hashes of each string, from prefix hashes; shape (strings, 2)."""
    out = np.empty((len(starts), 2), np.uint64)
    if not len(starts):
        return out
    size = ends - starts
    for c in range(2):
        # prefix[i] = sum of body[j] * R^j for j < i; strings are brought to one scale by R^(n - start)
        power = powers(c, len(body))
        prefix = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(_TABLE[c][body] * power[:-1], out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * power[len(body) - starts]
        # R is odd, so R^n has an inverse modulo 2^64 and the scale can be taken out
        inverse = np.uint64(pow(int(power[len(body)]), -1, 1 << 64))
        out[:, c] = mixed(value * inverse + size.astype(np.uint64))
    return out


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = length - gram(length)
        for batch in batches:
            for part in pieces(batch):
                body, offsets = flat(part.column("text"))
                text, at, first, last = anchors(body, offsets, length)
                place = at + offsets[text]
                inner = string_hashes(body, place, place + gram(length))[:, 0]
                whole = (at >= side) & (place + length <= offsets[text + 1])
                outer = np.zeros((len(at), 2), np.uint64)
                outer[whole] = string_hashes(body, place[whole] - side, place[whole] + length)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("unit").take(pa.array(text)), pa.array(at), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                        pa.array(inner.view(np.int64)),
                        pa.array(outer[:, 0].view(np.int64), mask=~whole), pa.array(outer[:, 1].view(np.int64), mask=~whole),
                    ],
                    ["unit", "at", "first", "last", "inner", "outer", "check"],
                )

    return run


def _contexts(length: int):
    """The bytes around each anchor that a window through it can reach."""

    def run(batches):
        side = length - gram(length)
        for batch in batches:
            for part in pieces(batch):
                body, offsets = flat(part.column("text"))
                rows = part.column("places")
                owner = np.repeat(np.arange(part.num_rows), np.diff(rows.offsets.to_numpy()))
                fields = rows.flatten()
                at = fields.field("at").to_numpy()
                low = np.maximum(at - side, 0) + offsets[owner]
                high = np.minimum(at + length + offsets[owner], offsets[owner + 1])
                raw = body.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("unit").take(pa.array(owner)), fields.field("at"), fields.field("first"), fields.field("last"),
                        pa.array(at + offsets[owner] - low, pa.int32()),
                        pa.array([raw[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary()),
                    ],
                    ["unit", "at", "first", "last", "left", "context"],
                )

    return run


def _cells(length: int, width: int):
    """Cut each open interval [low, high] of window places into cells and hash what their windows share and span."""

    def run(batches):
        side = length - gram(length)
        for batch in batches:
            for part in pieces(batch, "context"):
                body, offsets = flat(part.column("context"))
                lists = part.column("open")
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                base = lists.flatten().field("low").to_numpy().astype(np.int64)
                size = _next(width)
                parts = -(-width // size)
                settled = np.repeat(lists.flatten().field("settled").to_numpy(zero_copy_only=False), parts)
                low = (base[:, None] + np.arange(parts)[None, :] * size).reshape(-1)
                limit = np.repeat(base + width - 1, parts)
                owner = np.repeat(owner, parts)
                high = np.minimum(np.minimum(low + size - 1, limit), side)
                first, last, left = (part.column(c).to_numpy().astype(np.int64)[owner] for c in ("first", "last", "left"))
                keep = (low <= high) & (low <= last) & (high >= first)
                owner, low, high, left, settled = owner[keep], low[keep], high[keep], left[keep], settled[keep]
                place = offsets[owner] + left
                # windows start low..high bytes before the anchor: what all have, and what any has
                inner = string_hashes(body, place - np.minimum(low, left), np.minimum(place + length - high, offsets[owner + 1]))
                fits = (high <= left) & (place + length - low <= offsets[owner + 1])
                outer = np.zeros((len(owner), 2), np.uint64)
                outer[fits] = string_hashes(body, place[fits] - high[fits], place[fits] + length - low[fits])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("unit").take(pa.array(owner)), part.column("at").take(pa.array(owner)),
                        pa.array(settled.astype(bool)), pa.array(low, pa.int32()), pa.array(high, pa.int32()),
                        pa.array(inner[:, 0].view(np.int64)),
                        pa.array(outer[:, 0].view(np.int64), mask=~fits), pa.array(outer[:, 1].view(np.int64), mask=~fits),
                    ],
                    ["unit", "at", "settled", "low", "high", "inner", "outer", "check"],
                )

    return run


def _next(width: int) -> int:
    """The width of the cells that an interval of ``width`` places is cut into."""
    return -(-width // SPLIT)


def _classes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(covered places, places to look at more closely) of nodes (unit, at, settled, low, high, inner, outer, check).

    Nodes with the same outer string have all their windows in common: covered.  A node whose inner string is unique
    has none in common.  Where an inner string has several outer ones, one node of each goes on; one that stands for
    covered nodes is settled: it goes on for the others' sake only.
    """
    keyed = nodes.where("outer IS NOT NULL")
    own = F.struct("unit", "at")
    classes = keyed.groupBy("low", "inner", "outer", "check").agg(
        F.count("*").alias("n"), F.min(own).alias("rep"), F.min("high").alias("high"), F.min("settled").alias("settled")
    )
    classes = written(classes, "repeat-classes")
    many = classes.where("n > 1").select("low", "inner", "outer", "check")
    covered = keyed.where("NOT settled").join(many, ["low", "inner", "outer", "check"], "left_semi").select("unit", "at", "low", "high")
    going = classes.select("low", "high", "inner", "rep.unit", "rep.at", F.expr("settled OR n > 1").alias("settled")).unionByName(
        nodes.where("outer IS NULL").select("low", "high", "inner", "unit", "at", "settled")
    )
    going = written(going, "repeat-nodes")
    groups = going.groupBy("low", "inner").agg(F.count("*").alias("n"), F.min("settled").alias("over")).where("n > 1 AND NOT over")
    open_groups = written(groups.select("low", "inner"), "repeat-groups")
    return covered, going.join(open_groups, ["low", "inner"], "left_semi")


def _rebuilt():
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                removed, spans, digests = [], [], []
                for text, runs in zip(part.column("text"), part.column("runs").to_pylist()):
                    raw = text.as_buffer().to_pybytes()
                    joined = merged([(r["a"], r["b"]) for r in runs])
                    digest, at = hashlib.sha256(), 0
                    for a, b in joined:
                        digest.update(raw[at:a])
                        at = b
                    digest.update(raw[at:])
                    spans.append(joined)
                    removed.append(sum(b - a for a, b in joined))
                    digests.append(digest.hexdigest())
                flat_spans = pa.array([[x for s in one for x in s] for one in spans], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("n_bytes"), pa.array(removed, pa.int64()), flat_spans,
                        pa.array([len(s) for s in spans], pa.int64()), pa.array(digests, pa.string()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "spans", "n_spans", "kept_sha256"],
                )

    return run


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """The bytes of each document (doc_id, text) that lie in a string of ``length`` bytes which starts elsewhere, too.

    Returns doc_id, n_bytes, n_removed, n_spans, spans (starts and ends of maximal runs, in UTF-8 bytes, in turn) and
    kept_sha256 (of the other bytes).  Another start may be in the same text, and may overlap; matches never cross
    texts.

    1.  Equal texts are one unit; a unit with copies is a repeat as a whole.
    2.  Anchors are chosen by content (see the module).  Those whose own string is unique are dropped.
    3.  For each place a window can have around an anchor, all units are asked at once whether their windows agree:
        equal outer strings cover an interval of places, a unique inner string clears it, and what is left is cut
        into parts and asked again, so a boundary is found in log(length) rounds.  Everything is a count by hash,
        combined before the shuffle; a string that a third of the corpus shares is one row a task.
    4.  Strings count as equal if two independent 64-bit polynomial hashes are; each of them is mixed with the
        length.  Texts move only for documents with boundaries to look at, and for those that lose bytes.

    Defined results: a null or empty text has no bytes and loses none; shorter texts than ``length`` lose none;
    repeated rows count as copies of each other; null doc_ids are rows like others; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("unit", F.unhex(F.md5("text")))
    long_rows = rows.where(F.octet_length("text") >= length)
    units = written(
        long_rows.groupBy("unit").agg(F.count("*").alias("copies"), F.min("doc_id").alias("keeper")), "repeat-units"
    )
    copied = units.where("copies > 1").select("unit")

    kind = "unit binary, at long, first int, last int, inner long, outer long, check long"
    anchored = written(long_rows.select("unit", "text").mapInArrow(_anchored(length), kind), "repeat-anchors")
    # written, both sides of the join are plain exchanges, and the engine splits the rows of a hot string
    shared = written(anchored.groupBy("inner").count().where("count > 1").select("inner"), "repeat-shared")
    nodes = anchored.join(shared, "inner", "left_semi").dropDuplicates(["unit", "at"])
    side = length - gram(length)
    nodes = written(nodes.select("*", F.lit(0).alias("low"), F.lit(side).alias("high"), F.lit(False).alias("settled")), "repeat-open")
    found, going = _classes(nodes)
    covered = [found]

    going = written(going.select("unit", "at", "low", "settled"), "repeat-going")
    places = going.join(nodes.select("unit", "at", "first", "last"), ["unit", "at"]).groupBy("unit").agg(
        F.collect_list(F.struct("at", "first", "last")).alias("places")
    )
    wanted = written(places.join(units, "unit"), "repeat-wanted")
    near, _ = split_by(rows, wanted.select("unit", F.col("keeper").alias("doc_id")), "unit", "doc_id")
    joined = near.alias("r").join(wanted.alias("w"), F.expr("r.unit = w.unit AND r.doc_id <=> w.keeper")).select("r.unit", "r.text", "w.places")
    contexts = written(
        joined.mapInArrow(_contexts(length), "unit binary, at long, first int, last int, left int, context binary"), "repeat-contexts"
    )
    width = side + 1
    while width > 1:
        opened = going.groupBy("unit", "at").agg(F.collect_list(F.struct("low", "settled")).alias("open"))
        cells = contexts.join(opened, ["unit", "at"]).mapInArrow(
            _cells(length, width), "unit binary, at long, settled boolean, low int, high int, inner long, outer long, check long"
        )
        found, going = _classes(written(cells, "repeat-cells"))
        covered.append(found)
        going = written(going.select("unit", "at", "low", "settled"), "repeat-going")
        width = _next(width)

    runs = covered[0]
    for more in covered[1:]:
        runs = runs.unionByName(more)
    runs = runs.join(copied, "unit", "left_anti").groupBy("unit").agg(
        F.collect_list(F.expr("struct(at - high AS a, at - low + CAST({} AS BIGINT) AS b)".format(length))).alias("runs")
    )
    runs = written(runs, "repeat-runs")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    schema = "doc_id {}, n_bytes long, n_removed long, spans array<long>, n_spans long, kept_sha256 string".format(
        docs.schema["doc_id"].dataType.simpleString()
    )
    touched = split_by(rows, runs, "unit")[0].join(runs, "unit").select("doc_id", "text", size, "runs").mapInArrow(_rebuilt(), schema)
    whole = rows.select("doc_id", "unit", size).join(copied, "unit", "left_semi").select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.array(F.lit(0).cast("long"), F.col("n_bytes")).alias("spans"),
        F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"),
    )
    rest = rows.select("doc_id", "unit", size, F.sha2("text", 256).alias("kept_sha256")).join(
        copied.unionByName(runs.select("unit")), "unit", "left_anti"
    ).select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.array().cast("array<long>").alias("spans"),
        F.lit(0).cast("long").alias("n_spans"), "kept_sha256",
    )
    return touched.unionByName(whole).unionByName(rest)
