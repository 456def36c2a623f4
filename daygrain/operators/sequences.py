"""Fixed-length sequences of rows with the targets that belong to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from daygrain.constants import HORIZON
from daygrain.operators.blocks import attach, over_series, with_row_index
from daygrain.operators.windows import last_rows
from daygrain.series import Series


def sliding_sequences(
    df: DataFrame, series: Series, features: Sequence[str], targets: Sequence[str],
    lookback: int, horizon: int = HORIZON, gap: int = 1,
) -> DataFrame:
    """One row per sequence: ``x`` = array of feature arrays, ``y`` = targets of the anchor row.

    With ``gap=1`` the sequence of the row at position t holds rows t-lookback .. t-1; with
    ``gap=0`` it ends at row t itself.  A sequence must be whole and its anchor needs ``horizon``
    rows after it, so with ``gap=1`` a series of n rows gives n - lookback - horizon sequences.
    """
    entry = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate((series.time, *series.tie))],
        F.array(*[F.col(c).cast("double") for c in features]).alias("f"),
    )

    def build(w: WindowSpec) -> list[Column]:
        frame = w.rowsBetween(-(lookback - 1) - gap, -gap)
        return [
            F.transform(F.sort_array(F.collect_list(entry).over(frame)), lambda e: e["f"]).alias("x"),
            F.count(F.lit(1)).over(w.rowsBetween(1, horizon)).alias("__after"),
        ]

    narrow = df.select(*dict.fromkeys([*series.keys, series.time, *series.tie, *features, *targets]))
    rows = over_series(narrow, series, build, lookback=lookback, lookahead=horizon)
    whole = (F.size("x") == lookback) & (F.col("__after") >= horizon)
    target = F.array(*[F.col(c).cast("double") for c in targets])
    return rows.where(whole).select(*series.keys, series.time, *series.tie, "x", target.alias("y"))


def latest_sequence(df: DataFrame, series: Series, features: Sequence[str], lookback: int, gap: int = 0) -> DataFrame:
    """The newest sequence of each series for inference; leaves out the last ``gap`` rows."""
    entry = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate((series.time, *series.tie))],
        F.array(*[F.col(c).cast("double") for c in features]).alias("f"),
    )
    newest = last_rows(df.select(*dict.fromkeys([*series.keys, series.time, *series.tie, *features])), series, lookback + gap)
    rows = newest.groupBy(*series.keys).agg(
        F.max(series.time).alias("last_time"), F.sort_array(F.collect_list(entry)).alias("__all")
    )
    return rows.where(F.size("__all") == lookback + gap).select(
        *series.keys, "last_time", F.transform(F.slice("__all", 1, lookback), lambda e: e["f"]).alias("x")
    )


def split_sequences(
    sequences: DataFrame, rows: DataFrame, series: Series, lookback: int,
    horizon: int = HORIZON, test_ratio: float = 0.1,
) -> DataFrame:
    """Mark the sequences whose index lies before ``split - lookback - horizon`` as training."""
    lengths = rows.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("__rows"))
    numbered = with_row_index(sequences, series, "seq_idx", "n_seq")
    split = F.floor(F.col("__rows") * F.lit(1.0 - test_ratio)) - lookback - horizon
    return attach(numbered, lengths, series).withColumn("is_train", F.col("seq_idx") < split).drop("__rows")


def split_ordered(sequences: DataFrame, series: Series, test_size: float = 0.2) -> DataFrame:
    """Ordered split that rounds the size of the test part up."""
    numbered = with_row_index(sequences, series, "seq_idx", "n_seq")
    test = F.ceil(F.col("n_seq") * F.lit(test_size))
    return numbered.withColumn("is_train", F.col("seq_idx") < F.col("n_seq") - test)
