"""Mutual information of continuous columns from nearest neighbours, for tables of any length.

The estimator: with ``eps`` the distance of a row to its k-th nearest other row in the (x, y) plane (the larger of the two
coordinate distances), and ``nx``, ``ny`` the other rows nearer than ``eps`` in one coordinate alone,

    mi = psi(n) + psi(k) - mean(psi(nx + 1)) - mean(psi(ny + 1)),   at least 0.

Coordinates are whole numbers: values over their standard deviation, in steps of 2^-32.  So distances are exact, equal
distances are equal on every machine, and the steps are as small as the noise that other programs add to break ties.

Where the work lies: equal points are one row with a weight.  Points are sorted along an oblique axis and cut into
strips, a task each; a strip answers its own points from neighbours in it, and a point whose k-th distance reaches
beyond asks the next strip, until no strip is near enough.  Coordinates are counted by running sums over sorted parts.  No task
holds a column, no pair of rows is made outside a strip.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.functions.numeric import nan_free
from daygrain.session import written

STEP = 2.0**32
SLOPE = 0.6180339887498949  # strips run along x + SLOPE * y, on which points with one equal coordinate still differ
REACH = 1.6181  # rows nearer than eps differ by less than this many eps along that axis
STRIP = 16384  # distinct points of a strip
CHUNK = 256  # points compared with their surroundings at once

NEAR = "array<struct<d:bigint,c:bigint>>"


def digamma(m: Column) -> Column:
    """psi of whole numbers from 1 on, as SQL computes it too: eight steps up, then the asymptotic series."""
    z = m.cast("double") + 8.0
    steps = sum((1.0 / (m.cast("double") + float(i)) for i in range(1, 8)), 1.0 / m.cast("double"))
    q = 1.0 / (z * z)
    return F.log(z) - 0.5 / z - q * (1 / 12.0 - q * (1 / 120.0 - q * (1 / 252.0 - q / 240.0))) - steps


def digamma_sql(m: str) -> str:
    """The same in SQL text."""
    steps = " + ".join(f"1.0 / (({m}) + {float(i)})" for i in range(8))
    z = f"(({m}) + 8.0)"
    q = f"(1.0 / ({z} * {z}))"
    return f"(ln({z}) - 0.5 / {z} - {q} * (1 / 12.0 - {q} * (1 / 120.0 - {q} * (1 / 252.0 - {q} / 240.0))) - ({steps}))"


def _nearest(own: np.ndarray, held: np.ndarray, weights: np.ndarray, k: int, limit: np.ndarray | None) -> list[list[dict]]:
    """The k nearest of ``held`` (x, y), sorted by y, to each of ``own``; a point is no neighbour of itself.

    ``limit`` bounds the distance that matters.  Without it the nearest in the order of y bound it: points of a strip
    that are near in y are near.
    """
    out: list[list[dict]] = [[] for _ in own]
    if not len(held):
        return out
    order = np.argsort(own[:, 1], kind="stable")
    place = np.searchsorted(held[:, 1], own[:, 1])
    if limit is None:
        around = np.clip(place[:, None] + np.arange(-k - 1, k + 2)[None, :], 0, len(held) - 1)
        found = np.abs(held[around] - own[:, None, :]).max(axis=2)
        twice = np.sort(np.where((found == 0) | (np.diff(around, axis=1, prepend=-1) == 0), np.iinfo(np.int64).max, found), axis=1)
        limit = twice[:, min(k, twice.shape[1]) - 1]
        limit = np.where(limit == np.iinfo(np.int64).max, np.iinfo(np.int64).max // 4, limit)
    low = np.searchsorted(held[:, 1], own[:, 1] - limit, "left")
    high = np.searchsorted(held[:, 1], own[:, 1] + limit, "right")
    for i in range(0, len(own), CHUNK):
        rows = order[i:i + CHUNK]
        a, b = int(low[rows].min()), int(high[rows].max())
        step = max(1, (1 << 22) // max(1, b - a))
        for s in range(0, len(rows), step):
            some = rows[s:s + step]
            far = np.maximum(np.abs(held[None, a:b, 0] - own[some, None, 0]), np.abs(held[None, a:b, 1] - own[some, None, 1]))
            far[far == 0] = np.iinfo(np.int64).max  # distinct points: only the point itself
            take = min(k, b - a)
            if not take:
                continue
            best = np.argpartition(far, take - 1, axis=1)[:, :take]
            for row, cols, all_ in zip(some.tolist(), best, far):
                out[row] = sorted(
                    ({"d": int(all_[c]), "c": int(weights[a + c])} for c in cols if all_[c] != np.iinfo(np.int64).max), key=lambda n: n["d"]
                )
    return out


def _points(batch: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column("x").to_numpy(), batch.column("y").to_numpy()], axis=1)


def _answered(k: int):
    """The strip of a task: points of each feature with their nearest in the strip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        names = table.column("f").to_numpy()
        for name in np.unique(names).tolist():
            part = table.filter(pa.array(names == name))
            points, weights = _points(part), part.column("w").to_numpy()
            order = np.argsort(points[:, 1], kind="stable")
            near = _nearest(points, points[order], weights[order], k, None)
            kind = pa.list_(pa.struct([("d", pa.int64()), ("c", pa.int64())]))
            yield from part.append_column("near", pa.array(near, kind)).to_batches()

    return run


def _asked(k: int):
    """The nearest points of a strip to questions from others."""

    def run(questions: pa.Table, strip: pa.Table) -> pa.Table:
        if not questions.num_rows or not strip.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("f", pa.int32()), ("x", pa.int64()), ("y", pa.int64()))} | {
                "near": pa.array([], pa.list_(pa.struct([("d", pa.int64()), ("c", pa.int64())])))
            })
        held, weights, own = _points(strip), strip.column("w").to_numpy(), _points(questions)
        order = np.argsort(held[:, 1], kind="stable")
        limit = questions.column("eps").fill_null(np.iinfo(np.int64).max // 4).to_numpy()
        near = _nearest(own, held[order], weights[order], k, limit)
        return questions.select(["f", "x", "y"]).append_column(
            "near", pa.array(near, pa.list_(pa.struct([("d", pa.int64()), ("c", pa.int64())])))
        )

    return run


def _kth(k: int) -> Column:
    """The distance of the k-th nearest other row: equal rows first, then the weights of the nearest points; null if unknown."""
    return F.expr(
        f"""aggregate(near, named_struct('n', w - 1, 'e', if(w - 1 >= {k}, 0L, cast(null as bigint))),
        (a, p) -> named_struct('n', a.n + p.c, 'e', if(a.e is null and a.n + p.c >= {k}, p.d, a.e)), a -> a.e)"""
    )


def kth_distances(points: DataFrame, k: int, strip: int = STRIP) -> DataFrame:
    """(f, x, y, w, eps) of distinct points (f, x, y, w) of each feature f: the distance to the k-th nearest other row.

    null where a feature has at most k rows.
    """
    points = written(points, "points")
    parts = max(1, -(-points.count() // strip))
    axis = F.col("x") + F.lit(SLOPE) * F.col("y")
    placed = points.select("f", "x", "y", "w", axis.alias("u")).repartitionByRange(parts, "f", "u", "x", "y").sortWithinPartitions(
        "f", "u", "x", "y"
    ).withColumn("part", F.spark_partition_id())
    held = written(placed.mapInArrow(_answered(k), f"f int, x bigint, y bigint, w bigint, u double, part int, near {NEAR}"), "strips")
    ends = held.groupBy("f", "part").agg(F.min("u").alias("lo"), F.max("u").alias("hi"))
    along = Window.partitionBy("f").orderBy("part")  # a row a strip
    chain = written(ends.select(
        "f", F.col("part").alias("at"), F.lag("part").over(along).alias("before"), F.lag("hi").over(along).alias("before_hi"),
        F.lead("part").over(along).alias("after"), F.lead("lo").over(along).alias("after_lo"),
    ), "strip-ends")
    shown = ["f", "x", "y", "w", "u", "near"]
    open_ = held.select(*shown, F.col("part").alias("left"), F.col("part").alias("right"))
    done = []
    while True:
        open_ = open_.withColumn("eps", _kth(k))
        lefts = chain.select("f", F.col("at").alias("left"), "before", "before_hi")
        rights = chain.select("f", F.col("at").alias("right"), "after", "after_lo")
        reach = F.col("eps") * REACH
        near = open_.join(lefts, ["f", "left"], "left").join(rights, ["f", "right"], "left").select(
            *shown, "eps",
            F.when(F.col("eps").isNull() | (F.col("before_hi") >= F.col("u") - reach), F.col("before")).alias("left"),
            F.when(F.col("eps").isNull() | (F.col("after_lo") <= F.col("u") + reach), F.col("after")).alias("right"),
        )
        near = written(near, "open-points")
        done.append(near.where("left is null and right is null").select("f", "x", "y", "w", "eps"))
        still = near.where("left is not null or right is not null")
        if still.isEmpty():
            break
        asks = still.select("f", "x", "y", "eps", F.explode(F.array("left", "right")).alias("to")).where("to is not null")
        strips = held.select(F.col("f").alias("of"), "part", "x", "y", "w")
        told = asks.groupBy("f", "to").cogroup(strips.groupBy("of", "part")).applyInArrow(_asked(k), f"f int, x bigint, y bigint, near {NEAR}")
        known = still.select(*shown, "left", "right").unionByName(told, allowMissingColumns=True)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
        # a side that needs no further strip has none; what is null stays null
        open_ = known.groupBy("f", "x", "y").agg(
            *[F.max(c).alias(c) for c in ("w", "u", "left", "right")], merged.alias("near")
        ).select(*shown, "left", "right")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights before each question in a sorted part, and (as kind 1) the part's total, for each feature and coordinate."""
    held: dict[int, int] = {}
    for batch in batches:
        group, kind = batch.column("g").to_numpy(), batch.column("kind").to_numpy()
        weight = np.where(kind == 1, batch.column("w").to_numpy(), 0)
        sums = np.cumsum(weight)
        edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        before = np.repeat(np.concatenate([[0], sums])[edge], np.diff(np.concatenate([edge, [len(group)]])))
        base = np.repeat([held.get(int(group[e]), 0) for e in edge], np.diff(np.concatenate([edge, [len(group)]])))
        sums = sums - before + base
        for e, stop in zip(edge, np.concatenate([edge[1:], [len(group)]])):
            held[int(group[e])] = int(sums[stop - 1])
        ask = pa.array(kind != 1)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).filter(ask) for c in ("g", "f", "x", "y", "kind", "w")), pa.array(sums).filter(ask)], ["g", "f", "x", "y", "kind", "w", "sum"]
        )
    if held:
        n = len(held)
        zeros = pa.array(np.zeros(n, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.int32()), pa.array(np.zeros(n, np.int32)), zeros, zeros, pa.array(np.ones(n, np.int32)), zeros,
                pa.array(list(held.values()), pa.int64()),
            ],
            ["g", "f", "x", "y", "kind", "w", "sum"],
        )


def counts_within(found: DataFrame, strip: int = STRIP) -> DataFrame:
    """(f, x, y, w, nx, ny): rows of a feature, the row itself included, nearer than ``eps`` in x alone, and in y alone.

    Rows with an equal coordinate count even where ``eps`` is 0.  Values and the two ends of every range are sorted
    together; the weights up to an end are a running sum over its part plus the totals of the parts before.
    """
    less = F.greatest(F.col("eps") - 1, F.lit(0))
    entries = F.array(*[
        F.struct((2 * F.col("f") + F.lit(i)).cast("int").alias("g"), F.lit(kind).alias("kind"), v.alias("v"))
        for i, c in enumerate("xy") for kind, v in ((0, F.col(c) - less), (1, F.col(c)), (2, F.col(c) + less))
    ])
    events = written(found.select("f", "x", "y", "w", F.explode(entries).alias("e")).select("f", "x", "y", "w", "e.*"), "coordinates")
    parts = max(1, -(-events.count() // (6 * strip)))
    order = ["g", "v", "kind", "x", "y"]
    placed = events.select(*order, "f", "w").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    sums = written(placed.mapInArrow(_running, "g int, f int, x bigint, y bigint, kind int, w bigint, sum bigint").withColumn(
        "part", F.spark_partition_id()
    ), "running-sums")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    totals = sums.where("kind = 1").select("g", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    ends = sums.where("kind <> 1").join(written(totals, "part-totals"), ["g", "part"])
    signed = (F.col("kind") - 1) * (F.col("base") + F.col("sum"))
    return ends.groupBy("f", "x", "y", "w").agg(
        F.sum(F.when(F.col("g") % 2 == 0, signed)).alias("nx"), F.sum(F.when(F.col("g") % 2 == 1, signed)).alias("ny")
    )


def scaled(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(f, x, y, w): distinct points of each feature (by its position) and the target, as whole numbers, with their rows.

    A row counts for a feature if both values are known.  Both are divided by their standard deviation over these rows,
    in single precision (a constant column by 1).
    """
    known = nan_free(df, [*features, target]).select(
        F.col(target).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    )
    spreads = known.agg(*[
        F.stddev_pop(F.when(F.col("y").isNotNull() & F.col(f"x{i}").isNotNull(), F.col(c))).cast("float").cast("double").alias(f"{c}_{i}")
        for i in range(len(features)) for c in (f"x{i}", "y")
    ]).first()

    def whole(c: str, i: int) -> Column:
        return F.floor(F.col(c) / F.lit(spreads[f"{c}_{i}"] or 1.0) * F.lit(STEP) + F.lit(0.5)).cast("bigint")

    entries = F.array(*[
        F.when(F.col(f"x{i}").isNotNull(), F.struct(F.lit(i).alias("f"), whole(f"x{i}", i).alias("x"), whole("y", i).alias("y")))
        for i in range(len(features))
    ])
    long = known.where("y is not null").select(F.explode(entries).alias("e")).where("e is not null").select("e.*")
    return long.groupBy("f", "x", "y").agg(F.count("*").alias("w"))


def mutual_information_knn(df: DataFrame, features: Sequence[str], target: str, k: int = 3, strip: int = STRIP) -> DataFrame:
    """(feature, n, mi) in nats, highest first: the nearest-neighbour estimate for each feature and the target.

    ``n`` counts the rows in which both values are known; a feature with at most ``k`` of them has no score (null), one
    without any is listed with n = 0.  A constant column scores 0.  Infinite values are not allowed.
    """
    features = list(features)
    found = written(kth_distances(scaled(df, features, target), k, strip), "kth-distances")
    counts = counts_within(found.where("eps is not null"), strip)
    sums = counts.groupBy("f").agg(F.sum(F.col("w") * (digamma(F.col("nx")) + digamma(F.col("ny")))).alias("terms"))
    rows = found.groupBy("f").agg(F.sum("w").alias("n"))
    named = df.sparkSession.createDataFrame(list(enumerate(features)), "f int, feature string")
    joined = named.join(rows, "f", "left").join(sums, "f", "left")
    mi = digamma(F.col("n")) + digamma(F.lit(k)) - F.col("terms") / F.col("n")
    return joined.select("feature", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("terms").isNotNull(), F.greatest(mi, F.lit(0.0))).alias("mi")).orderBy(
        F.desc_nulls_last("mi"), "feature"
    )
