"""Near-duplicate vectors by product quantisation over inverted lists, confirmed by exact cosine."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.graph import components
from daygrain.session import written

SAMPLE = 20_480  # rows that fit the index
LISTS = 1024  # at most
HELD = 512  # vectors of the largest label that a list shall hold; a vector is sent to each list it asks
SUBSPACES = 16
CODES = 256
BLOCK = 1024
OFTEN = 8192  # vectors of one length that get an index; fewer are compared without
SLACK = 1e-7


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm; an empty cell takes a random point."""
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=k)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
        centres[~full] = points[rng.integers(0, len(points), int((~full).sum()))]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    out = np.empty(len(points), np.int64)
    for i in range(0, len(points), 4096):
        out[i:i + 4096] = np.argmin(half[None, :] - points[i:i + 4096] @ centres.T, axis=1)
    return out


@dataclass
class Index:
    """Coarse centres of the inverted lists, and codebooks of the residuals' subspaces."""

    centres: np.ndarray
    books: np.ndarray  # (subspaces, codes, dimensions of a subspace)
    radius: float  # unit vectors with the asked cosine are at most so far apart

    @property
    def width(self) -> int:
        return self.books.shape[2]

    def folded(self, points: np.ndarray) -> np.ndarray:
        """(rows, subspaces, width), zeros added behind the last dimension."""
        out = np.zeros((len(points), len(self.books) * self.width))
        out[:, :points.shape[1]] = points
        return out.reshape(len(points), len(self.books), self.width)

    def encode(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, distance to what the codes stand for) of unit vectors."""
        cell = nearest(points, self.centres)
        rest = self.folded(points - self.centres[cell])
        codes = np.stack([nearest(rest[:, s], self.books[s]) for s in range(len(self.books))], axis=1)
        back = np.stack([self.books[s][codes[:, s]] for s in range(len(self.books))], axis=1)
        return cell, codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(axis=(1, 2)))

    def probes(self, points: np.ndarray, cell: np.ndarray) -> list[np.ndarray]:
        """All lists that can hold a vector within the radius: those whose border with the own list is that near."""
        squares = ((points[:, None, :] - self.centres[None, :, :]) ** 2).sum(axis=2) if len(self.centres) <= 16 else (
            (points**2).sum(axis=1)[:, None] + (self.centres**2).sum(axis=1)[None, :] - 2 * points @ self.centres.T
        )
        gaps = np.sqrt(np.maximum(
            (self.centres**2).sum(axis=1)[:, None] + (self.centres**2).sum(axis=1)[None, :] - 2 * self.centres @ self.centres.T, 0
        ))
        own = squares[np.arange(len(points)), cell]
        border = (squares - own[:, None]) - 2 * gaps[cell] * (self.radius + SLACK)
        return [np.flatnonzero(row <= SLACK) for row in border]

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances: from exact queries to coded vectors of a list, by table lookup."""
        rest = self.folded(queries - self.centres[cell])
        out = np.zeros((len(queries), len(codes)))
        for s, book in enumerate(self.books):
            table = ((rest[:, s, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            out += table[:, codes[:, s]]
        return out


def fitted(points: np.ndarray, lists: int, cosine: float) -> Index:
    centres = kmeans(points, lists, 8, 11)
    index = Index(centres, np.zeros((SUBSPACES, 1, -(-points.shape[1] // SUBSPACES))), float(np.sqrt(2 - 2 * cosine)))
    rest = index.folded(points - centres[nearest(points, centres)])
    index.books = np.stack([kmeans(rest[:, s], min(CODES, len(points)), 6, 100 + s) for s in range(SUBSPACES)])
    return index


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _encoded(index: Index, width: int):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                points = unit(_matrix(part.column("vector"), width))
                cell, codes, error = index.encode(points)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"), part.column("rep"), part.column("copies"), part.column("vector"), pa.array(cell, pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                        pa.array([p.astype(np.int32) for p in index.probes(points, cell)], pa.list_(pa.int32())),
                    ],
                    ["label", "rep", "copies", "vector", "list", "codes", "error", "probes"],
                )

    return run


def _compared(index: Index | None, width: int | None, cosine: float):
    """Links of a block; without an index, by exact cosines alone."""
    def run(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        rep, copies = (table.column(c).to_numpy() for c in ("rep", "copies"))
        vectors = _matrix(table.column("vector"), width or len(table.column("vector")[0]))
        q, d = np.flatnonzero(asks), np.flatnonzero(~asks)
        none = pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(q) or not len(d):
            return none
        if index is None:
            near = unit(vectors[q]) @ unit(vectors[d]).T >= cosine - SLACK
        else:
            cell = int(table.column("list")[0].as_py())
            codes = np.frombuffer(b"".join(table.column("codes").take(pa.array(d)).to_pylist()), np.uint8).reshape(len(d), -1)
            error = table.column("error").to_numpy()[d]
            points = unit(vectors[q])
            near = np.sqrt(np.maximum(index.distances(points, cell, codes), 0)) - error[None, :] <= index.radius + SLACK
        i, j = np.nonzero(near & (rep[q][:, None] != rep[d][None, :]))
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        norms = np.sqrt((scaled * scaled).sum(axis=1))
        linked = np.zeros(len(i), bool)
        for s in range(0, len(i), 65536):
            a, b = q[i[s:s + 65536]], d[j[s:s + 65536]]
            linked[s:s + 65536] = (scaled[a] * scaled[b]).sum(axis=1) / (norms[a] * norms[b]) >= cosine
        i, j = i[linked], j[linked]
        if not len(i):
            return none
        counts = np.bincount(i, weights=copies[d][j], minlength=len(q)).astype(np.int64)
        # the block's own components: each node and its root stand for all links
        names, at = np.unique(np.concatenate([rep[q], rep[d]]), return_inverse=True)
        a, b = at[:len(q)][i], at[len(q):][j]
        root = np.arange(len(names))
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        touched = np.unique(np.concatenate([a, b]))
        return pa.table({
            "node": pa.array(np.concatenate([rep[q], names[touched]])), "n": pa.array(np.concatenate([counts, np.zeros(len(touched), np.int64)])),
            "root": pa.array(np.concatenate([rep[q], names[root[touched]]])),
        })

    return run


def _indexed(classes: DataFrame, width: int, cosine: float, sample: int) -> DataFrame:
    """Links between classes of one length, by an index of their own."""
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    drawn = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vector").toArrow().column("vector")
    index = fitted(unit(_matrix(drawn, width)), int(np.clip(-(-most // HELD), 1, LISTS)), cosine)
    kind = classes.schema["label"].dataType.simpleString()
    coded = written(
        classes.select("label", "rep", "copies", "vector").mapInArrow(
            _encoded(index, width),
            f"label {kind}, rep long, copies long, vector array<double>, list int, codes binary, error double, probes array<int>",
        ),
        "vector-codes",
    )
    return _met(coded, index, width, cosine)


def _met(coded: DataFrame, index: Index | None, width: int | None, cosine: float) -> DataFrame:
    """(node, n, root) of all blocks in which questions meet a list; without an index a list asks itself only."""
    nothing = F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error")
    if index is None:
        coded = coded.select("label", "rep", "copies", "vector", "list", *nothing, F.array("list").alias("probes"))
    asks = coded.select("label", "rep", "copies", "vector", F.explode("probes").alias("list"), *nothing)
    key = ["label", "list"]
    sizes = coded.groupBy(*key).count().withColumnRenamed("count", "held").join(
        asks.groupBy(*key).count().withColumnRenamed("count", "asked"), key
    ).select(*key, F.ceil(F.col("held") / BLOCK).cast("int").alias("held"), F.ceil(F.col("asked") / BLOCK).cast("int").alias("asked"))
    sizes = written(sizes, "vector-sizes")
    columns = [*key, "rep", "copies", "vector", "codes", "error"]
    questions = asks.join(sizes, key).select(
        *columns, F.lit(True).alias("asks"), F.pmod(F.xxhash64("rep"), "asked").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("held") - 1)).alias("j"),
    )
    held = coded.join(sizes, key).select(
        *columns, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("asked") - 1)).alias("i"),
        F.pmod(F.xxhash64("rep"), "held").cast("int").alias("j"),
    )
    return written(
        questions.unionByName(held).groupBy(*key, "i", "j").applyInArrow(_compared(index, width, cosine), "node long, n long, root long"),
        "vector-links",
    )


def near_vectors(vectors: DataFrame, cosine: float = 0.98, sample: int = SAMPLE) -> DataFrame:
    """Links between vectors (vec_id, embedding, label) of equal labels whose cosine is at least ``cosine``.

    Returns vec_id, n_links (other rows linked directly), component_id and kept, one row for each row.

    Equal vectors of a label are one class; only vectors of one length (number of components) are compared.  The most
    frequent length, and every other with ``OFTEN`` classes, has an index of its own (coarse centres, and codebooks of 16
    residual subspaces), fitted on at most ``sample`` classes; every class is indexed.  Classes of rarer lengths are
    compared in blocks without an index.  A class asks every list that can hold a link: the
    border between its list and the other is at most the link's distance away.  Table lookups give asymmetric
    distances to the codes; only pairs further apart than the distance plus the code's own error are dropped, so
    neither step loses a link.  The rest is compared exactly, in double precision.  Lists are cut into blocks, and
    blocks of questions meet blocks of a list; a block returns counts and a spanning forest, never its pairs.

    Defined results: vectors that are null, zero, hold null or non-finite components, or a null
    label or vec_id, have no links and are their own component; repeated rows are
    linked with each other; rows that share a vec_id are one node; an empty table gives no rows.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    alone = F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    usable = F.col("sound")
    classes = written(
        rows.where(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("width", F.size("vector")),
        "vector-classes",
    )
    # an index for the most frequent length and for every other that is frequent; all the rest is compared in blocks
    lengths = classes.groupBy("width").count().orderBy(F.desc("count"), F.desc("width"))
    first = lengths.limit(1).collect()
    if not first:
        return rows.select("vec_id", *alone)
    own = {r["width"] for r in [*first, *lengths.where(F.col("count") >= OFTEN).collect()]}
    found = [_indexed(classes.where(F.col("width") == width), width, cosine, sample) for width in sorted(own)]
    rest = classes.where(~F.col("width").isin(*own))
    if not rest.isEmpty():
        found.append(_met(rest.withColumn("list", F.col("width")), None, None, cosine))
    met = reduce(DataFrame.unionByName, found)
    counts = met.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    facts = classes.select("label", "vector", "rep", "copies").join(counts.withColumnRenamed("node", "rep"), "rep", "left").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left"
    ).select(
        "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = rows.where(usable).select("vec_id", "label", "vector").join(facts, ["label", "vector"]).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
    return linked.unionByName(rows.where(~usable).select("vec_id", *alone))
