"""Statistics over groups and whole tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.numeric import nan_free
from daygrain.operators.blocks import add_series_stats, attach
from daygrain.series import Series


def group_mean(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return nan_free(df, columns).groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def with_group_stats(df: DataFrame, series: Series, by: Sequence[str], column: str, mean: str, std: str) -> DataFrame:
    """Mean and sample standard deviation per (series, ``by``) put back on each row.

    Partial aggregation, then a join per time block; a window per group would have at most one
    task per group.
    """
    group = [*series.keys, *by]
    stats = nan_free(df, [column]).groupBy(*group).agg(F.avg(column).alias(mean), F.stddev_samp(column).alias(std))
    return attach(df, stats, series, group)


def exact_quantiles(
    df: DataFrame, series: Series, column: str, levels: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Exact quantiles (linear interpolation) per series, named by ``levels``.

    A mergeable sketch first brackets the wanted ranks (its rank error is at most n/accuracy), and only the values
    inside the brackets are ranked: a small share of a long series, and the result is exact.  Series of any length take
    this one path; a bracket without its rank is an error, never a missing row.
    """
    keys = list(series.keys)
    widths = _bracket_widths(accuracy)
    around = [min(max(p + side * width, 0.0), 1.0) for p in levels.values() for width in widths for side in (-1, 1)]
    values = nan_free(df, [column]).where(F.col(column).isNotNull()).select(*keys, series.time, column)
    bounds = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.percentile_approx(column, around, accuracy).alias("__around")
    )
    return _bracketed_quantiles(attach(values, bounds, series), keys, column, levels, widths)


def _bracket_widths(accuracy: int) -> list[float]:
    """Half widths of brackets, as shares of a series: from the sketch's error on, each four times the one before."""
    widths = [2.0 / accuracy]
    while widths[-1] < 1:
        widths.append(widths[-1] * 4)
    return widths


def _bracketed_quantiles(
    known: DataFrame, keys: Sequence[str], column: str, levels: dict[str, float], widths: Sequence[float]
) -> DataFrame:
    """Quantiles of rows that carry the size of their series and value brackets per level.

    The bracket used is the narrowest that holds the sketch's error and two more ranks.
    """

    def end(level: int, side: int) -> Column:
        at = lambda k: F.col("__around")[2 * (level * len(widths) + k) + side]
        chosen = F.when(F.lit(0.5 * widths[0]) + 2 / F.col("__n") <= widths[0], at(0))
        for k, width in enumerate(widths[1:-1], start=1):
            chosen = chosen.when(F.lit(0.5 * widths[0]) + 2 / F.col("__n") <= width, at(k))
        return chosen.otherwise(at(len(widths) - 1))

    brackets = F.array(*[
        F.struct(
            F.lit(name).alias("name"), (F.lit(p) * (F.col("__n") - 1)).alias("pos"),
            end(i, 0).alias("lo"), end(i, 1).alias("hi"),
        )
        for i, (name, p) in enumerate(levels.items())
    ])
    value = F.col(column)
    touched = known.select(*keys, value.alias("value"), F.explode(brackets).alias("b")).where("value <= b.hi")
    # values below the bracket only count: they become one null entry per level
    inside = F.when(F.col("value") >= F.col("b.lo"), F.col("value"))
    counted = touched.groupBy(*keys, "b.name", "b.pos", inside.alias("value")).agg(F.count(F.lit(1)).alias("times"))
    order = Window.partitionBy(*keys, "name").orderBy(F.col("value").asc_nulls_first())
    through = F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.select(*keys, "name", "pos", "value", through.alias("through"))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("through") > rank, F.col("value")))

    ends = ranked.groupBy(*keys, "name", "pos").agg(at(F.floor("pos")).alias("low"), at(F.ceil("pos")).alias("high"))
    share = F.col("pos") - F.floor("pos")
    quantile = F.col("low") + (F.col("high") - F.col("low")) * share
    missed = F.raise_error(F.lit("a quantile lies outside its bracket: raise the accuracy")).cast("double")
    named = ends.select(*keys, "name", F.coalesce(quantile, missed).alias("q"))
    return named.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in levels])


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature", value: str = "value") -> DataFrame:
    return nan_free(df, columns).select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), name, value
    )


def _ranges(df: DataFrame, columns: Sequence[str]) -> Column:
    """Min and max of all columns as one struct from one pass (a scalar subquery)."""
    pairs = [
        F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c)
        for c in columns
    ]
    return df.agg(F.struct(*pairs).alias("s")).scalar()


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin 1..bins of equal width; the maximum belongs to the last bin, a constant column to bin 1."""
    last = F.lit(bins).cast("bigint")
    equal_width = F.when(lo == hi, F.lit(1).cast("bigint")).otherwise(
        F.least(F.width_bucket(value, lo, hi, F.lit(bins)), last)
    )
    return F.when(value.isNotNull(), equal_width)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Counts per column and equal-width bin; bins are reduced before the shuffle."""
    known = nan_free(df, columns)
    packed = known.select(*[F.col(c).cast("double").alias(c) for c in columns]).withColumn("__r", _ranges(known, columns))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            _bin(F.col(c), F.col("__r")[c]["lo"], F.col("__r")[c]["hi"], bins).alias("bin"),
        )
        for c in columns
    ]
    long = packed.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.where(F.col("bin").isNotNull()).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))


def scatter_pairs(df: DataFrame, x: str, ys: Sequence[str]) -> DataFrame:
    """Points (x, feature, y) for scatter plots."""
    return unpivot(nan_free(df, [x]).withColumn("__x", F.col(x).cast("double")), ys, ["__x"], "feature", "y").withColumnRenamed("__x", "x")


def scatter_counts(df: DataFrame, x: str, ys: Sequence[str], bins: int = 50) -> DataFrame:
    """The same points counted on a bins x bins grid, so the output stays small."""
    columns = [x, *ys]
    known = nan_free(df, columns)
    packed = known.select(*[F.col(c).cast("double").alias(c) for c in columns]).withColumn("__r", _ranges(known, columns))

    def binned(c: str) -> Column:
        return _bin(F.col(c), F.col("__r")[c]["lo"], F.col("__r")[c]["hi"], bins)

    entries = [F.struct(F.lit(y).alias("feature"), binned(x).alias("x_bin"), binned(y).alias("y_bin")) for y in ys]
    long = packed.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.na.drop().groupBy("feature", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))


def _correlation(x: Column, y: Column) -> Column:
    """``corr`` as an aggregate that is null, not a division by zero, where a side does not vary."""
    shared_x, shared_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread_x, spread_y = F.regr_sxx(y, x), F.regr_syy(y, x)
    varies = (F.min(shared_x) < F.max(shared_x)) & (F.min(shared_y) < F.max(shared_y)) & (spread_x > 0) & (spread_y > 0)
    return F.when(varies, F.regr_sxy(y, x) / F.sqrt(spread_x) / F.sqrt(spread_y))


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target, strongest first; null pairs are skipped.

    A feature has none (null, last) if it or the target is constant over their common rows: that is seen by the least and
    greatest value, as merged sums of squares of equal values need not be exactly zero.
    """
    known = nan_free(df, [*features, target])
    wide = known.agg(*[_correlation(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in features]
    long = wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.select("feature", "r", F.abs("r").alias("abs_r")).orderBy(F.desc_nulls_last("abs_r"), "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (a, b, r) of the correlation matrix; each pair takes the rows that hold both values.

    Each task multiplies its rows as matrices, so a batch of rows serves all pairs at once, and only one row of sums a
    pair and task is shuffled.  Values are first shifted by a mean of their column, so large offsets cost no digits.  A
    pair with fewer than two rows or a constant side has no correlation (null).
    """
    columns = list(columns)
    values = nan_free(df, columns).select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    shifts = np.array([v or 0.0 for v in values.agg(*[F.avg(c) for c in values.columns]).first()])
    first, second = np.triu_indices(len(columns))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(columns), len(columns)))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))], axis=1) - shifts
            known = (~np.isnan(x)).astype(float)
            x = np.where(known > 0, x, 0.0)
            square = x * x
            for k, (left, right) in enumerate(
                ((known, known), (x, known), (known, x), (square, known), (known, square), (x, x))
            ):
                sums[k] += left.T @ right
        picked = sums[:, first, second]
        yield pa.RecordBatch.from_arrays(
            [pa.array(first, pa.int32()), pa.array(second, pa.int32()), *[pa.array(row) for row in picked]],
            ["i", "j", "n", "x", "y", "xx", "yy", "xy"],
        )

    names = ("n", "x", "y", "xx", "yy", "xy")
    parts = values.mapInArrow(products, "i int, j int, " + ", ".join(f"{n} double" for n in names))
    sums = parts.groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])
    spread_x, spread_y = F.expr("xx - x * x / n"), F.expr("yy - y * y / n")
    tiny = F.lit(1e-14)
    varies = (F.col("n") > 1) & (spread_x > tiny * F.col("xx")) & (spread_y > tiny * F.col("yy"))
    r = F.expr("xy - x * y / n") / F.sqrt(spread_x * spread_y)
    r = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    listed = F.array(*[F.lit(c) for c in columns])
    named = sums.select(listed[F.col("i")].alias("a"), listed[F.col("j")].alias("b"), r.alias("r"))
    return named.unionByName(named.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def top_features(scores: DataFrame, score: str, k: int | None = None, above: float | None = None) -> DataFrame:
    """Best ``k`` features with a score above the threshold; ties are broken by name."""
    kept = scores if above is None else scores.where(F.col(score) > above)
    ordered = kept.orderBy(F.desc_nulls_last(score), "feature")
    return ordered if k is None else ordered.limit(k)


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """Binned mutual information (nats) of each feature with the target, highest first.

    Both sides are cut into equal-width bins; the joint counts are at most bins x bins per
    feature, and the marginals are windows over that small table.  No features give no rows.
    """
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, mi double")
    joint = scatter_counts(df, target, features, bins)
    n = F.sum("n").over(Window.partitionBy("feature"))
    nx = F.sum("n").over(Window.partitionBy("feature", "x_bin"))
    ny = F.sum("n").over(Window.partitionBy("feature", "y_bin"))
    parts = joint.select("feature", "n", n.alias("total"), nx.alias("nx"), ny.alias("ny"))
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return parts.groupBy("feature").agg(F.sum(term).alias("mi")).orderBy(F.desc("mi"), "feature")


def yearly_mean(df: DataFrame, series: Series, column: str) -> DataFrame:
    return nan_free(df, [column]).groupBy(*series.keys, F.year(series.time).alias("year")).agg(F.avg(column).alias("mean"))


def linear_trend(yearly: DataFrame, series: Series, x: str = "year", y: str = "mean") -> DataFrame:
    """Least-squares line through the yearly means, with the fitted value of each year."""
    keys = list(series.keys)
    yearly = nan_free(yearly, [x, y])
    fit = yearly.groupBy(*keys).agg(
        F.regr_slope(y, F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(y, F.col(x).cast("double")).alias("intercept"),
    )
    joined = add_series_stats(yearly, fit, keys)
    return joined.withColumn("fitted", F.col("intercept") + F.col("slope") * F.col(x))


def polynomial_trend(yearly: DataFrame, series: Series, degree: int = 10, x: str = "year", y: str = "mean") -> DataFrame:
    """Least-squares polynomial through the means of each series (one row per period), at each of its points.

    The points of a series are one array, and its polynomials are orthogonal on them, each from the two before it
    (three-term recurrence), so no system of equations is solved.  A polynomial that vanishes on all points, as those of
    a degree above the number of points do, adds nothing.
    """
    keys = list(series.keys)
    rows = nan_free(yearly, [x, y]).select(*keys, x, y)
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(x).alias("at"), F.col(y).alias("value"))
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("p"))
    known = "filter(p, q -> q.x IS NOT NULL AND q.y IS NOT NULL)"
    ends = held.selectExpr(*keys, "p", f"array_min(transform({known}, q -> q.x)) AS lo", f"array_max(transform({known}, q -> q.x)) AS hi")
    state = ends.selectExpr(
        *keys, "p", "transform(p, q -> if(hi > lo, 2 * (q.x - lo) / (hi - lo) - 1, 0D)) AS t",
        "transform(p, q -> coalesce(q.y, 0D)) AS v", "transform(p, q -> if(q.x IS NOT NULL AND q.y IS NOT NULL, 1D, 0D)) AS w",
        "transform(p, q -> 0D) AS before", "transform(p, q -> 1D) AS now", "transform(p, q -> 0D) AS fitted", "0D AS norm_before",
    )
    dot = "aggregate(zip_with({}, {}, (a, b) -> coalesce(a * b, 0D)), 0D, (s, a) -> s + a)"
    for k in range(degree + 1):
        state = state.selectExpr("*", "zip_with(now, w, (a, b) -> coalesce(a, 0D) * b) AS weighed")
        state = state.selectExpr("*", f"{dot.format('weighed', 'now')} AS norm", f"{dot.format('weighed', 'v')} AS share")
        state = state.selectExpr(
            *keys, "p", "t", "v", "w", "now", "before", "weighed", "norm", "norm_before", "norm > 1e-20 * aggregate(w, 0D, (s, a) -> s + a) AS real",
            "share", "fitted",
        )
        state = state.selectExpr(
            "*", "if(real, share / norm, 0D) AS c", f"if(real, {dot.format('zip_with(weighed, t, (a, b) -> a * b)', 'now')} / norm, 0D) AS shift",
            "if(real AND norm_before > 0, norm / norm_before, 0D) AS back",
        )
        state = state.selectExpr(
            *keys, "p", "t", "v", "w", "zip_with(fitted, now, (f, a) -> f + c * a) AS fitted",
            "if(real, zip_with(zip_with(t, now, (a, b) -> (a - shift) * b), before, (a, b) -> a - back * b), transform(t, a -> 0D)) AS next",
            "now AS before", "norm AS norm_before",
        ).withColumnRenamed("next", "now")
    shown = state.selectExpr(*keys, "explode(zip_with(p, fitted, (q, f) -> struct(q.at AS at, q.value AS value, f AS fitted))) AS r")
    seen = F.when(F.col("r.at").isNotNull(), F.col("r.fitted"))
    return shown.select(*keys, F.col("r.at").alias(x), F.col("r.value").alias(y), seen.alias("fitted"))


def min_max_normalise(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) per series; a constant column gives null."""
    df = nan_free(df, columns)
    stats = df.groupBy(*series.keys).agg(
        *[F.min(c).alias(f"__min_{c}") for c in columns], *[F.max(c).alias(f"__max_{c}") for c in columns]
    )
    scaled = attach(df, stats, series)

    def norm(c: str) -> Column:
        low, high = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        return F.when(high != low, (F.col(c) - low) / (high - low))

    return scaled.select(*df.columns, *[norm(c).alias(f"{c}_norm") for c in columns])
