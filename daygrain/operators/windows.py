"""Row-based window columns: lags, rolling statistics, targets.

A rolling statistic over a few rows is arithmetic on the value and its lags.  Lags are the
cheapest window function (one frame per distance, whatever the number of columns), and the
arithmetic is compiled with the rest of the projection, so this is several times faster than an
aggregate over a sliding frame per column.  Of longer windows the last values are one array, on
which the same arithmetic runs in the same order, so the two forms agree to the last bit.

A rolling window of n rows is null until all its n rows hold a value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from daygrain.constants import HORIZON, TARGETS
from daygrain.functions.numeric import float_divide, nan_free
from daygrain.operators.blocks import BLOCK, HOME, block_window, halo, only_home, over_series, spread, with_row_index
from daygrain.series import Series

UNROLLED = 31


# --- the last values of a column ------------------------------------------------------------


def past_name(column: str, k: int) -> str:
    return f"__past{k}_{column}"


Naming = Callable[[str, int], str]


def past(column: str, k: int, named: Naming = past_name) -> Column:
    """The value k rows earlier; needs :func:`past_block` with the same naming."""
    return F.col(named(column, k) if k else column)


def past_block(depth: Mapping[str, int], w: WindowSpec, named: Naming = past_name) -> list[Column]:
    """Hidden lag columns 1..depth of each named column."""
    return [F.lag(c, k).over(w).alias(named(c, k)) for c, d in depth.items() for k in range(1, d + 1)]


def last_values(column: str, rows: int, named: Naming = past_name) -> list[str]:
    """SQL names of the value and its lags, newest first."""
    return [f"`{named(column, k) if k else column}`" for k in range(rows)]


def over_recent(
    df: DataFrame, series: Series, depth: Mapping[str, int], columns: Sequence[Column], per_block: DataFrame | None = None
) -> DataFrame:
    """Add columns computed from the last values; ``depth`` says how far back each column is needed."""
    reach = per_block if per_block is not None else halo(df, series, max(depth.values()))
    rows = spread(df, series, reach).select("*", *past_block(depth, block_window(series)))
    return only_home(rows.select(*df.columns, HOME, BLOCK, *columns))


# The statistics below are SQL text over column names: one expression per statistic is parsed by
# the engine, where building it operator by operator costs a call into the JVM for each.


def _all_known(values: Sequence[str]) -> str:
    return " AND ".join(f"{v} IS NOT NULL" for v in values)


def _mean_and_std(values: Sequence[str], sizes: Sequence[int]) -> dict[int, tuple[Column, Column]]:
    """Mean and sample standard deviation of the first n values, for each n in ``sizes``.

    Both come from sums of distances to the first value: no loss for large offsets, and exactly
    0 deviation for equal values.
    """
    first, out = values[0], {}
    for n in sizes:
        away = [f"({v} - {first})" for v in values[1:n]]
        total, squares = " + ".join(away), " + ".join(f"{d} * {d}" for d in away)
        variance = f"({squares} - ({total}) * ({total}) / {n}D) / {n - 1}D"
        out[n] = (
            F.expr(f"{first} + ({total}) / {n}D"),
            F.expr(f"CASE WHEN {_all_known(values[:n])} THEN sqrt(greatest({variance}, 0D)) END"),
        )
    return out


def max_of(values: Sequence[str]) -> Column:
    return F.expr(f"CASE WHEN {_all_known(values)} THEN greatest({', '.join(values)}) END")


def min_of(values: Sequence[str]) -> Column:
    return F.expr(f"CASE WHEN {_all_known(values)} THEN least({', '.join(values)}) END")


def quantile_of(values: Sequence[str], p: float) -> Column:
    """Exact quantile with linear interpolation."""
    position = p * (len(values) - 1)
    low, share = int(position), position - int(position)
    ordered = f"sort_array(array({', '.join(values)}))"
    value = f"{ordered}[{low}]"
    if share:
        value = f"{value} + ({ordered}[{low + 1}] - {value}) * {share!r}D"
    return F.expr(f"CASE WHEN {_all_known(values)} THEN {value} END")


def rolling_mean(column: str, rows: int) -> Column:
    return _mean_and_std(last_values(column, rows), [rows])[rows][0]


def rolling_std(column: str, rows: int) -> Column:
    return _mean_and_std(last_values(column, rows), [rows])[rows][1]


def rolling_max(column: str, rows: int) -> Column:
    return max_of(last_values(column, rows))


def rolling_min(column: str, rows: int) -> Column:
    return min_of(last_values(column, rows))


def rolling_quantile(column: str, rows: int, p: float) -> Column:
    return quantile_of(last_values(column, rows), p)


def rolling_block(columns: Sequence[str], windows: Sequence[int], named: Naming = past_name) -> list[Column]:
    out = []
    for c in columns:
        by_size = _mean_and_std(last_values(c, max(windows), named), windows)
        for n in windows:
            mean, std = by_size[n]
            out += [mean.alias(f"{c}_roll{n}_mean"), std.alias(f"{c}_roll{n}_std")]
    return out


def difference(column: str, rows: int = 1) -> Column:
    """Change against the value ``rows`` earlier (1: daily change, 3 or 7: momentum)."""
    return past(column, 0) - past(column, rows)


def acceleration(column: str) -> Column:
    return (past(column, 0) - past(column, 1)) - (past(column, 1) - past(column, 2))


def volatility(column: str, rows: int) -> Column:
    """Coefficient of variation of the last rows."""
    mean, std = _mean_and_std(last_values(column, rows), [rows])[rows]
    return float_divide(std, mean)


def trend_strength(column: str, short: int = 7, long: int = 14) -> Column:
    means = _mean_and_std(last_values(column, long), [short, long])
    return means[short][0] - means[long][0]


def week_statistics(column: str, rows: int = 7) -> list[Column]:
    """Quantiles and position of a value within its last week, momentum and trend strength."""
    p25, p75 = rolling_quantile(column, rows, 0.25), rolling_quantile(column, rows, 0.75)
    high, low, value = rolling_max(column, rows), rolling_min(column, rows), F.col(column)
    return [
        p25.alias(f"{column}_rolling_p25"),
        p75.alias(f"{column}_rolling_p75"),
        (p75 - p25).alias(f"{column}_rolling_iqr"),
        float_divide(value, high + 0.001).alias(f"{column}_position_in_week"),
        (value - high).alias(f"{column}_relative_to_recent_max"),
        (value - low).alias(f"{column}_relative_to_recent_min"),
        difference(column, 3).alias(f"{column}_momentum_3d"),
        difference(column, 7).alias(f"{column}_momentum_7d"),
        trend_strength(column).alias(f"{column}_trend_strength"),
    ]


# --- window functions -----------------------------------------------------------------------


def recent_name(column: str, rows: int) -> str:
    return f"__recent{rows}_{column}"


def recent_block(columns: Sequence[str], windows: Sequence[int], w: WindowSpec) -> list[Column]:
    """Hidden arrays of the last values that are known, newest first, one for each column and window."""
    return [
        F.reverse(F.collect_list(c).over(w.rowsBetween(-(n - 1), 0))).alias(recent_name(c, n)) for c in columns for n in windows
    ]


def recent_mean_and_std(column: str, rows: int) -> tuple[Column, Column]:
    """As :func:`_mean_and_std`, over the array of :func:`recent_block`."""
    held = f"`{recent_name(column, rows)}`"
    away = f"transform(slice({held}, 2, {rows - 1}), v -> v - {held}[0])"
    total = f"aggregate({away}, 0D, (s, d) -> s + d)"
    squares = f"aggregate({away}, 0D, (s, d) -> s + d * d)"
    variance = f"({squares} - ({total}) * ({total}) / {rows}D) / {rows - 1}D"
    whole = f"size({held}) = {rows}"
    return (
        F.expr(f"CASE WHEN {whole} THEN {held}[0] + ({total}) / {rows}D END"),
        F.expr(f"CASE WHEN {whole} THEN sqrt(greatest({variance}, 0D)) END"),
    )


def lag_block(columns: Sequence[str], lags: Sequence[int], w: WindowSpec) -> list[Column]:
    return [F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in columns for k in lags]


def target_names(prefixes: Sequence[str] = tuple(TARGETS), horizon: int = HORIZON) -> list[str]:
    return [f"{p}_d{h}_forecast" for p in prefixes for h in range(1, horizon + 1)]


def add_lags(df: DataFrame, series: Series, columns: Sequence[str], lags: Sequence[int]) -> DataFrame:
    return over_series(df, series, lambda w: lag_block(columns, lags, w), lookback=max(lags))


def add_rolling(
    df: DataFrame, series: Series, columns: Sequence[str], windows: Sequence[int], unrolled: int = UNROLLED
) -> DataFrame:
    """Rolling mean and std of the listed columns that exist.

    Each window takes its own form: up to ``unrolled`` rows as arithmetic on lags, above as arithmetic on an array.
    The results do not depend on it.
    """
    present = [c for c in columns if c in df.columns]
    df = nan_free(df, present)
    short, long = [n for n in windows if n <= unrolled], [n for n in windows if n > unrolled]
    w = block_window(series)
    hidden = past_block({c: max(short) - 1 for c in present} if short else {}, w) + recent_block(present, long, w)
    rows = spread(df, series, halo(df, series, max(windows) - 1)).select("*", *hidden)
    out = []
    for c in present:
        known = _mean_and_std(last_values(c, max(short)), short) if short else {}
        for n in windows:
            mean, std = known[n] if n in known else recent_mean_and_std(c, n)
            out += [mean.alias(f"{c}_roll{n}_mean"), std.alias(f"{c}_roll{n}_std")]
    return only_home(rows.select(*df.columns, HOME, BLOCK, *out))


def add_targets(
    df: DataFrame, series: Series, targets: dict[str, str] = TARGETS, horizon: int = HORIZON
) -> DataFrame:
    """Values of the next ``horizon`` rows as target columns; null at the end of a series."""
    w, sources = block_window(series), list(dict.fromkeys(targets.values()))
    ahead = F.struct(*[F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(sources)])  # one lead a horizon serves all columns
    rows = spread(df, series, halo(df, series, lookahead=horizon)).select(
        "*", *[F.lead(ahead, h).over(w).alias(f"__ahead{h}") for h in range(1, horizon + 1)]
    )
    named = [F.expr(f"__ahead{h}.s{sources.index(source)} AS `{prefix}_d{h}_forecast`") for prefix, source in targets.items() for h in range(1, horizon + 1)]
    return only_home(rows).select(*df.columns, *named)


def add_position(df: DataFrame, series: Series, name: str = "day_index") -> DataFrame:
    return with_row_index(df, series, name, "__total").drop("__total")


def last_rows(df: DataFrame, series: Series, n: int) -> DataFrame:
    """The newest ``n`` rows of each series (limited per group before the shuffle)."""
    newest = Window.partitionBy(*series.keys).orderBy(*[c.desc() for c in series.order()])
    return df.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= n).drop("__r")


def first_rows(df: DataFrame, series: Series, n: int) -> DataFrame:
    oldest = Window.partitionBy(*series.keys).orderBy(*series.order())
    return df.withColumn("__r", F.row_number().over(oldest)).where(F.col("__r") <= n).drop("__r")


def latest_row(df: DataFrame, series: Series) -> DataFrame:
    """The newest row of each series, by aggregation: no sort, combined before the shuffle."""
    newest = df.groupBy(*series.keys).agg(
        F.max_by(F.struct(*df.columns), F.struct(series.time, *series.tie)).alias("__row")
    )
    return newest.select("__row.*")
