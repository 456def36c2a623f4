"""Chronological train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.blocks import with_row_index
from daygrain.series import Series


def chronological_split(
    df: DataFrame, series: Series, test_ratio: float = 0.1, validation_ratio: float | None = 0.2
) -> DataFrame:
    """Column ``part``: the first rows of each series train, then validate, the last rows test.

    Sizes are cut to whole rows as ``floor(n * (1 - ratio))``; the validation rows are the last
    part of the training rows.
    """
    numbered = with_row_index(df, series, "row_idx", "__total")
    train = F.floor(F.col("__total") * F.lit(1.0 - test_ratio))
    part = F.when(F.col("row_idx") >= train, "test")
    if validation_ratio is not None:
        part = part.when(F.col("row_idx") >= F.floor(train * F.lit(1.0 - validation_ratio)), "validation")
    return numbered.withColumn("part", part.otherwise("train")).drop("__total")
