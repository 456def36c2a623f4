"""Near-duplicate documents by HyperMinHash sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.bitmap import split_by
from daygrain.llm.graph import components
from daygrain.llm.text import mixed, pieces, text_sets
from daygrain.session import written

REGISTERS = 128
BAND = 4  # registers of 16 bits: the key of a band is one 64-bit number and needs no hash
MANTISSA = 10
BLOCK = 1024

_ORDER = np.stack([np.random.default_rng(7000 + j).permutation(REGISTERS) for j in range(REGISTERS)])


def registers(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of registers a set: the bucket's smallest hash as leading zeros + 1 and mantissa bits, 0 if empty."""
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    if not len(sets):
        return out
    bits = np.uint64(REGISTERS.bit_length() - 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    slot = owner * REGISTERS + (sets >> (np.uint64(64) - bits)).astype(np.int64)
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]  # sets are sorted, so the smallest hash of a bucket comes first
    rest = (sets[first] << bits) | np.uint64(1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62)
    mantissa = np.minimum(((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    out.reshape(-1)[slot[first]] = ((zeros + 1) << MANTISSA | mantissa).astype(np.uint16)
    return out


def filled(rows: np.ndarray) -> np.ndarray:
    """Empty registers borrow from the first full one of their own random order; alike sets borrow alike."""
    out = rows.copy()
    empty_row, empty_at = np.nonzero(rows == 0)
    some = rows.any(axis=1)
    keep = some[empty_row]
    empty_row, empty_at = empty_row[keep], empty_at[keep]
    for step in range(REGISTERS):
        if not len(empty_row):
            break
        got = rows[empty_row, _ORDER[empty_at, step]]
        out[empty_row, empty_at] = got
        left = got == 0
        empty_row, empty_at = empty_row[left], empty_at[left]
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    return np.ascontiguousarray(filled(rows)).view(np.int64).reshape(len(rows), REGISTERS // BAND)


def accidental(n: np.ndarray) -> np.ndarray:
    """The chance that registers of two unrelated sets of ``n`` shingles are equal."""
    load = np.maximum(np.asarray(n, float) / REGISTERS, 1.0)[..., None]
    edge = 2.0 ** -np.arange(0, 40)
    above = (1 - edge) ** load
    cell = np.diff(np.concatenate([above, np.ones_like(above[..., :1])], axis=-1), axis=-1)
    return (cell**2).sum(axis=-1) / (1 << MANTISSA)


def likely(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the collision-corrected Jaccard estimate of sketches leaves ``threshold`` possible (5 sigma)."""
    seen = ((left != 0) | (right != 0)).sum(axis=-1)
    same = ((left == right) & (left != 0)).sum(axis=-1)
    chance = accidental(np.minimum(n_left, n_right))
    seen = np.maximum(seen, 1)
    estimate = (same / seen - chance) / (1 - chance)
    margin = 5 * np.sqrt(threshold * (1 - threshold) / seen) + 1 / seen
    small, large = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    return (estimate >= threshold - margin) & (small >= threshold * large - 1e-9)


def set_names(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over the members name a set."""
    other = mixed(sets ^ np.uint64(0xD6E8FEB86659FD93))
    out = np.empty((len(bounds) - 1, 2), np.uint64)
    for c, values in enumerate((sets, other)):
        sums = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        out[:, c] = sums[bounds[1:]] - sums[bounds[:-1]]
    return out


def _sketches(k: int, carried: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                sets, bounds = text_sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), _binary(set_names(sets, bounds)),
                        _binary(registers(sets, bounds)), *[part.column(c) for c in carried],
                    ],
                    ["doc_id", "n", "name", "sketch", *carried],
                )

    return run


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if not len(column) or data is None:
        return np.zeros((0, width), kind)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind).reshape(len(column), width)


def _bands(batches):
    for batch in batches:
        keys = band_keys(_matrix(batch.column("sketch"), REGISTERS, np.uint16))
        bands = keys.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.tile(np.arange(bands, dtype=np.int32), len(keys))), pa.array(keys.reshape(-1)),
                pa.array(np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), bands)),
            ],
            ["band", "key", "rep"],
        )


def _estimates(threshold: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            ok = likely(
                _matrix(batch.column("sketch_a"), REGISTERS, np.uint16), _matrix(batch.column("sketch_b"), REGISTERS, np.uint16),
                n_a, n_b, threshold,
            )
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                sets, bounds = text_sets(part.column("text"), k)
                ends = (bounds * 8).astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(sets.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), _binary(set_names(sets, bounds)), body],
                    ["doc_id", "n", "name", "body"],
                )

    return run


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("body_a"), batch.column("body_b"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if len(y):
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                    ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _blocks(use):
    """Call ``use`` for each run of rows, sorted by (pivot, ci, cj), that makes a block."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("pivot", "ci", "cj")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(key)]
            for a, b in zip(edges[:-1], edges[1:]):
                now = tuple(key[a])
                if held and now != last:
                    yield from use(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(a, b - a))
                last = now
        if held:
            yield from use(pa.Table.from_batches(held).combine_chunks())

    return run


def _plausible(block: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of a block, of different labels, that the sketches leave possible."""
    column = lambda c: block.column(c).combine_chunks()
    rep, label, n, chunk = (block.column(c).to_numpy() for c in ("rep", "label", "n", "chunk"))
    sketch = _matrix(column("sketch"), REGISTERS, np.uint16)
    ci, cj, pivot = (block.column(c)[0].as_py() for c in ("ci", "cj", "pivot"))
    right = np.flatnonzero((chunk == cj) & (rep != pivot))
    firsts, seconds = [], []
    for i in np.flatnonzero((chunk == ci) & (rep != pivot)).tolist():
        j = right[(label[right] != label[i]) & ((rep[right] > rep[i]) | (ci != cj))]
        j = j[(n[j] >= threshold * n[i] - 1e-9) & (n[i] >= threshold * n[j] - 1e-9)]
        if len(j):
            j = j[likely(sketch[i][None, :], sketch[j], np.full(len(j), n[i]), n[j], threshold)]
            firsts.append(np.full(len(j), i)), seconds.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate(firsts) if firsts else none, np.concatenate(seconds) if seconds else none


def _active(threshold: float):
    """The rows of each block that have a plausible partner."""

    def use(block: pa.Table):
        if block.num_rows > 1:
            i, j = _plausible(block, threshold)
            if len(i):
                rows = pa.array(np.unique(np.concatenate([i, j])))
                yield from block.take(rows).drop_columns(["sketch"]).to_batches()

    return _blocks(use)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; shingles of one set only are left out, the others go by slices."""
    whole = np.concatenate(sets)
    names, at, counts = np.unique(whole, return_inverse=True, return_counts=True)
    new = np.cumsum(counts > 1) - 1
    keep = (counts > 1)[at]
    row, column = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[keep], new[at[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column)
    row, column = row[order], column[order]
    for start in range(0, int((counts > 1).sum()), 8192):
        a, b = np.searchsorted(column, [start, start + 8192])
        part = np.zeros((len(sets), 8192), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _forest(threshold: float, percent: int):
    """A spanning forest of each block's confirmed links."""

    def use(block: pa.Table):
        i, j = _plausible(block, threshold)
        if not len(i):
            return
        rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        i, j = at[:len(i)], at[len(i):]
        rep, n = (block.column(c).to_numpy()[rows] for c in ("rep", "n"))
        bodies = block.column("body").take(pa.array(rows)).combine_chunks()
        both = intersections([np.frombuffer(x.as_buffer(), np.uint64) for x in bodies])[i, j]
        good = 100 * both >= percent * (n[i] + n[j] - both)
        i, j = i[good], j[good]
        root = np.arange(len(rows))
        while len(i):
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        child = np.flatnonzero(root != np.arange(len(root)))
        if len(child):
            yield pa.RecordBatch.from_arrays([pa.array(rep[root[child]]), pa.array(rep[child])], ["a", "b"])

    return _blocks(use)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, carried: tuple[str, ...] = ()) -> DataFrame:
    """Components of documents whose sets of ``k``-word shingles have ``100 * both >= percent * either``.

    Returns doc_id, n_shingles, component_id and kept, one row for each row of ``docs`` (doc_id, text; other
    columns are not read, but for those named in ``carried``, which follow).  The component's id is its smallest doc_id.

    1.  Each text becomes the set of its distinct shingles and a sketch of 128 registers; each register keeps the
        leading zeros and 10 mantissa bits of the smallest hash in its bucket.  Texts with equal sets are one class.
    2.  32 bands of four compressed registers propose candidates.  A pair of similarity 0.8 shares no band with
        probability (1 - 0.8^4)^32 = 5e-8.
    3.  Within a bucket all classes are compared with its smallest, and the components of the confirmed links
        computed.  Then the classes that met one smallest class and still are several components are cut into blocks,
        and blocks compared with blocks: first by corrected estimates, then, for rows with a possible partner, on the
        full sets.  A block returns a spanning forest of its links, never its pairs.
    4.  Every link is confirmed on the full sets.

    No bucket is dropped or cut.  Defined results: a null, empty or blank text has the empty set and is linked with
    nothing; a text of fewer than ``k`` words is one shingle of all its words; repeated rows are linked (equal sets)
    and each keeps its row; rows that share a doc_id but not the set are linked only if their sets are; a null doc_id
    takes part in no link and its row is kept; an empty table gives no rows.
    """
    threshold = percent / 100
    narrow = docs.select("doc_id", "text")
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    sketched = written(
        docs.select("doc_id", "text", *carried).mapInArrow(_sketches(k, carried), f"doc_id long, n long, name binary, sketch binary{more}"),
        "sketches",
    )
    used = sketched.where("n > 0 AND doc_id IS NOT NULL")
    # a class has a number of its own: a doc_id that repeats with other texts stands in several
    classes = used.groupBy("n", "name").agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    banded = classes.select("rep", "sketch").mapInArrow(_bands, "band int, key long, rep long")
    buckets = banded.groupBy("band", "key").agg(F.min("rep").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    members = written(banded.join(buckets, ["band", "key"]), "buckets")

    def bodies_of(reps: DataFrame, name: str) -> DataFrame:
        """The full sets of the given classes, made again from the texts."""
        wanted = written(classes.select("rep", "doc_id", "n", "name").join(reps.distinct(), "rep", "left_semi"), f"{name}-wanted")
        likely_wanted, _ = split_by(narrow, wanted, "doc_id")
        texts = likely_wanted.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(k), "doc_id long, n long, name binary, body binary")
        # of a doc_id that repeats with other texts, the set tells which one is meant
        bodies = texts.join(wanted, ["doc_id", "n", "name"]).groupBy("rep").agg(F.min("body").alias("body"))
        return written(bodies, name)

    sketch = lambda side: classes.select(F.col("rep").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n").alias(f"n_{side}"))
    pairs = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.join(sketch("b"), "b").join(sketch("a"), "a").mapInArrow(_estimates(threshold), "a long, b long")
    pairs = written(pairs, "pairs")
    bodies = bodies_of(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), "sets")
    side = lambda c: bodies.select(F.col("rep").alias(c), F.col("body").alias(f"body_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    links = written(both.mapInArrow(_confirmed(percent), "a long, b long"), "links")
    labels = written(components(links), "labels")

    # the classes that met one pivot, in whatever bucket, once
    labelled = members.select("pivot", "rep").distinct().join(
        labels.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("label", F.coalesce("component", "rep")).drop("component")
    labelled = written(labelled, "labelled")
    open_groups = labelled.groupBy("pivot").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
    ).where("low < high AND size > 2").select("pivot", F.ceil(F.col("size") / BLOCK).cast("int").alias("chunks"))
    open_groups = written(open_groups, "open-groups")
    facts = classes.select("rep", "n", "sketch")
    blocks = (
        labelled.join(open_groups, "pivot").withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("ci", F.least("chunk", "other")).withColumn("cj", F.greatest("chunk", "other"))
        .join(facts, "rep").select("pivot", "ci", "cj", "rep", "label", "n", "chunk", "sketch")
    )

    def sorted_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition("pivot", "ci", "cj").sortWithinPartitions("pivot", "ci", "cj")

    columns = "pivot long, ci int, cj int, rep long, label long, n long, chunk int"
    active = written(sorted_blocks(blocks).mapInArrow(_active(threshold), columns), "active")
    full = active.join(bodies_of(active.select("rep"), "active-sets"), "rep").join(classes.select("rep", "sketch"), "rep")
    others = written(sorted_blocks(full).mapInArrow(_forest(threshold, percent), "a long, b long"), "more-links")
    final = written(components(links.unionByName(others)), "final")

    # from here on by doc_id: a component is called by its smallest
    linked_classes = final.withColumnRenamed("node", "rep").join(classes.select("rep", "doc_id"), "rep")
    called = written(linked_classes.groupBy("component").agg(F.min("doc_id").alias("component_id")), "called")
    found = final.join(called, "component").select(F.col("node").alias("rep"), "component_id")
    named = classes.select("n", "name", "rep", F.col("doc_id").alias("own")).join(found, "rep", "left").select(
        "n", "name", F.coalesce("component_id", "own").alias("component_id")
    )
    linked = sketched.select("doc_id", "n", "name", *carried).join(named, ["n", "name"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(component)
    return linked.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), *carried,
    )
