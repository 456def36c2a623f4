"""Row windows over series of any length.

``Window.partitionBy(keys)`` sends a whole series to one task, which fails when one series
holds a large part of the table.  Here a series is cut into time blocks and every block gets
copies of the few rows before and after it that its windows reach (the halo).  The halo is
found from the key and time columns alone: ``row_number() <= n`` is limited before the
shuffle, so only a handful of rows per block move.  The result equals the plain window.

Rows without a time belong to no position in a series; they are kept, as a group of their own.
The input is read twice (once for two columns only), so an expensive input should be written
first (``session.written``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from daygrain.series import Series

BLOCK = "__block"
HOME = "__home"


def lookup(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join the columns of ``small`` to ``df`` on ``on`` (null-safe), keeping one copy of ``on``."""
    right = small.select(*[F.col(c).alias(f"__on_{c}") for c in on], *[c for c in small.columns if c not in on])
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on])
    return df.join(right, condition, how).drop(*[f"__on_{c}" for c in on])


def with_block(df: DataFrame, series: Series) -> DataFrame:
    return df.withColumn(BLOCK, series.block(df))


def block_window(series: Series) -> WindowSpec:
    return Window.partitionBy(*series.keys, BLOCK).orderBy(*series.order())


def _edges(df: DataFrame, series: Series, rows: int, last: bool, entry: Column) -> DataFrame:
    """The last (or first) ``rows`` rows of each block as an array of entries sorted by time."""
    time = F.col(series.time)
    ranked = Window.partitionBy(*series.keys, BLOCK).orderBy(time.desc() if last else time.asc())
    return (
        with_block(df, series)
        .where(time.isNotNull())
        .select(*series.keys, BLOCK, series.time, entry.alias("__entry"))
        .withColumn("__rank", F.row_number().over(ranked))
        .where(F.col("__rank") <= rows)
        .groupBy(*series.keys, BLOCK)
        .agg(F.sort_array(F.collect_list("__entry")).alias("edge"))
    )


def _neighbours(edges: DataFrame, series: Series, rows: int, before: bool) -> DataFrame:
    """(keys, target, need): for each block the nearest ``rows`` entries of the blocks before (or after) it.

    Blocks are laid on a line by the running number of their entries, so a range frame of ``rows`` takes just the
    blocks that hold a needed entry: never more than ``rows`` entries and one block's surplus, however long the series.
    """
    along = Window.partitionBy(*series.keys).orderBy(F.col(BLOCK).asc() if before else F.col(BLOCK).desc())
    through = F.sum(F.size("edge")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = edges.select(*series.keys, BLOCK, "edge", through.alias("__through"))
    nothing = F.lit(None).cast(edges.schema["edge"].dataType)
    roles = F.array(
        F.struct(F.col("__through").alias("place"), F.col("edge").alias("edge"), F.lit(None).cast("bigint").alias("target")),
        F.struct(
            (F.col("__through") - F.size("edge")).alias("place"), nothing.alias("edge"), F.col(BLOCK).cast("bigint").alias("target")
        ),
    )
    line = placed.select(*series.keys, F.explode(roles).alias("r")).select(*series.keys, "r.*")
    near = Window.partitionBy(*series.keys).orderBy("place").rangeBetween(-(rows - 1), 0)
    gathered = line.select(*series.keys, "target", F.sort_array(F.flatten(F.collect_list("edge").over(near))).alias("all"))
    wanted = gathered.where(F.col("target").isNotNull() & (F.size("all") > 0))
    start = F.greatest(F.size("all") - rows, F.lit(0)) + 1 if before else F.lit(1)
    return wanted.select(*series.keys, "target", F.slice("all", start, F.lit(rows)).alias("need"))


def _entry(series: Series) -> Column:
    return F.struct(F.col(series.time).alias("at"), F.col(BLOCK).alias("source"))


def rows_before(df: DataFrame, series: Series, rows: int) -> DataFrame:
    """For every block that needs them, where its last ``rows`` preceding rows lie.

    One row per (series, source block, target block) with the lower time bound ``lo`` to copy.
    """
    needed = _neighbours(_edges(df, series, rows, True, _entry(series)), series, rows, True)
    return needed.select(
        *series.keys, "target", F.array_min(F.col("need.at")).alias("lo"),
        F.explode(F.array_distinct(F.col("need.source"))).alias(BLOCK),
    )


def runs_before(df: DataFrame, series: Series, rows: int, reach: str, sources: str) -> DataFrame:
    """As :func:`rows_before`, where each of the ``rows`` rows is needed with a run of rows of its own.

    The column ``reach`` holds the time at which a row's run begins, ``sources`` the blocks the run lies in.  One row
    per (series, source block, target block, needed row) with the bounds ``lo`` and ``hi`` of the run, ``hi`` being the
    needed row's time: what lies between two runs, such as an outage, is not copied.
    """
    entry = F.struct(F.col(series.time).alias("at"), F.col(reach).alias("reach"), F.col(sources).alias("sources"))
    needed = _neighbours(_edges(df, series, rows, True, entry), series, rows, True)
    runs = needed.select(*series.keys, "target", F.explode("need").alias("run"))
    return runs.select(
        *series.keys, "target", F.col("run.reach").alias("lo"), F.col("run.at").alias("hi"), F.explode("run.sources").alias(BLOCK)
    )


def rows_after(df: DataFrame, series: Series, rows: int) -> DataFrame:
    """As :func:`rows_before` for the ``rows`` rows that follow a block, with an upper bound ``hi``."""
    needed = _neighbours(_edges(df, series, rows, False, _entry(series)), series, rows, False)
    return needed.select(
        *series.keys, "target", F.array_max(F.col("need.at")).alias("hi"),
        F.explode(F.array_distinct(F.col("need.source"))).alias(BLOCK),
    )


def halo(df: DataFrame, series: Series, lookback: int = 0, lookahead: int = 0) -> DataFrame | None:
    """Copy instructions per source block: ``targets`` = array of (target, lo, hi)."""
    bounds = []
    if lookback:
        bounds.append(rows_before(df, series, lookback))
    if lookahead:
        bounds.append(rows_after(df, series, lookahead))
    return as_targets(bounds, df, series) if bounds else None


def as_targets(bounds: Sequence[DataFrame], df: DataFrame, series: Series) -> DataFrame:
    """Gather the instructions of a source block; only as many blocks as rows reached can want it."""
    unset = F.lit(None).cast(df.schema[series.time].dataType)
    full = [
        part.select(*series.keys, BLOCK, "target", *[
            F.col(c) if c in part.columns else unset.alias(c) for c in ("lo", "hi")
        ])
        for part in bounds
    ]
    merged = reduce(lambda a, b: a.unionByName(b), full)
    return merged.groupBy(*series.keys, BLOCK).agg(F.collect_list(F.struct("target", "lo", "hi")).alias("targets"))


def spread(df: DataFrame, series: Series, per_block: DataFrame | None, carry: Sequence[str] = ()) -> DataFrame:
    """Each row once for its own block (``__home``) and once per block whose halo it is in.

    ``per_block`` holds ``targets`` per (series, block) and may hold further columns to
    ``carry`` along, so one join serves both.
    """
    homed = with_block(df, series)
    if per_block is None:
        return homed.withColumn(HOME, F.col(BLOCK))
    time = F.col(series.time)

    def reaches(t: Column) -> Column:
        above = t["lo"].isNull() | (time >= t["lo"])
        below = t["hi"].isNull() | (time <= t["hi"])
        return above & below

    joined = lookup(homed, per_block, [*series.keys, BLOCK])
    copies = F.transform(F.filter("targets", reaches), lambda t: t["target"])
    blocks = F.array_distinct(F.concat(F.array(BLOCK), F.coalesce(copies, F.array().cast("array<bigint>"))))
    return joined.select(*df.columns, *carry, F.col(BLOCK).alias(HOME), F.explode(blocks).alias(BLOCK))


def only_home(df: DataFrame) -> DataFrame:
    return df.where(F.col(HOME).eqNullSafe(F.col(BLOCK))).drop(HOME, BLOCK)


def over_series(
    df: DataFrame,
    series: Series,
    build: Callable[[WindowSpec], Sequence[Column]],
    lookback: int = 0,
    lookahead: int = 0,
    per_block: DataFrame | None = None,
) -> DataFrame:
    """Add the window columns ``build(w)`` makes; ``w`` orders a series by time.

    ``lookback`` and ``lookahead`` are the numbers of rows the frames reach before and after
    the current row.  ``per_block`` takes a halo made earlier (``written(halo(...), name)``) for
    the same rows and at least the same reach, to use it for several calls.
    """
    reach = per_block if per_block is not None else halo(df, series, lookback, lookahead)
    return only_home(spread(df, series, reach).select("*", *build(block_window(series))))


def with_row_index(df: DataFrame, series: Series, index: str = "row_idx", total: str = "n_rows") -> DataFrame:
    """Dense 0-based position of each row in its series and the length of the series.

    Block counts are aggregated with partial combine; their running sum is a window over one
    row per block.  That one row then travels to its block as a header ahead of the data, so
    numbering takes a single shuffle of the data and no join, however many blocks there are.
    """
    by_block = Window.partitionBy(*series.keys).orderBy(BLOCK)
    whole = Window.partitionBy(*series.keys)
    homed = with_block(df, series)
    headers = homed.groupBy(*series.keys, BLOCK).agg(F.count(F.lit(1)).alias("__n")).select(
        *series.keys, BLOCK,
        F.coalesce(F.sum("__n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"),
        F.sum("__n").over(whole).alias("__total"),
    )
    both = homed.unionByName(headers, allowMissingColumns=True)
    group = Window.partitionBy(*series.keys, BLOCK)
    place = F.row_number().over(group.orderBy(F.col("__offset").asc_nulls_last(), *series.order()))
    numbered = both.select(
        *df.columns, "__offset",
        (place - 2 + F.max("__offset").over(group)).cast("bigint").alias(index),
        F.max("__total").over(group).alias(total),
    )
    return numbered.where(F.col("__offset").isNull()).drop("__offset")


def add_series_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Statistics per key next to a small frame; without keys, their single row as a scalar subquery."""
    if keys:
        return lookup(df, stats, keys, how)
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    packed = df.withColumn("__stats", row)
    return packed.select(*df.columns, *[F.col("__stats")[c].alias(c) for c in stats.columns])


def attach(df: DataFrame, stats: DataFrame, series: Series, on: Sequence[str] | None = None) -> DataFrame:
    """Put per-series (or per ``on``) statistics back on every row.

    A join on the series key alone would send a hot series to one task.  The statistics are
    first repeated per time block (one row per block of the group), so the join key is
    (group, block) and no join key has more rows than a block.
    """
    on = list(series.keys if on is None else on)
    if not on:
        return add_series_stats(df, stats, on)
    homed = with_block(df, series)
    per_block = lookup(homed.select(*on, BLOCK).distinct(), stats, on, "inner")
    return lookup(homed, per_block, [*on, BLOCK]).drop(BLOCK)
