"""Windows over time blocks must equal plain windows, whatever the blocks are."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daygrain import Series
from daygrain.operators import blocks as B
from daygrain.operators import windows as W
from daygrain.session import written

SCHEMA = "k string, date date, id int, v double"


def frame(spark, seed, hot=False):
    """Series of very different length, with gaps, repeated days and a null key."""
    rng = random.Random(seed)
    rows, n = [], 0
    sizes = {"a": 1, "b": 3, None: 40, "c": 90}
    if hot:
        sizes["hot"] = 600
    for key, size in sizes.items():
        day = dt.date(2000, 1, 1)
        for _ in range(size):
            day += dt.timedelta(days=rng.choice([0, 1, 1, 1, 2, 9, 200]))
            rows.append((key, day, n, None if rng.random() < 0.1 else rng.random()))
            n += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def build(w):
    return [
        F.lag("v", 7).over(w).alias("l7"),
        F.lead("v", 5).over(w).alias("f5"),
        F.max("v").over(w.rowsBetween(-3, 0)).alias("m4"),
    ]


@pytest.mark.parametrize("span", [0.5, 2, 7, 100, 5000])
@pytest.mark.parametrize("hot", [False, True])
def test_blocked_windows_equal_plain_windows(spark, span, hot):
    df = frame(spark, 7, hot)
    series = Series(("k",), "date", ("id",), span=span)
    plain = df.select("*", *build(Window.partitionBy("k").orderBy("date", "id")))
    blocked = B.over_series(df, series, build, lookback=7, lookahead=5)
    assert sorted(map(str, blocked.collect())) == sorted(map(str, plain.collect()))


def test_a_halo_can_be_written_once_and_reused(spark):
    df = frame(spark, 3)
    series = Series(("k",), "date", ("id",), span=5)
    table = written(B.halo(df, series, 7, 5), "halo")
    again = B.over_series(df, series, build, per_block=table)
    assert sorted(map(str, again.collect())) == sorted(map(str, B.over_series(df, series, build, 7, 5).collect()))


@pytest.mark.parametrize("span", [3, 64])
def test_row_index_counts_rows_of_a_series(spark, span):
    df = frame(spark, 11, True)
    got = B.with_row_index(df, Series(("k",), "date", ("id",), span=span))
    w = Window.partitionBy("k")
    plain = df.select(
        "*", (F.row_number().over(w.orderBy("date", "id")) - 1).cast("bigint").alias("row_idx"),
        F.count(F.lit(1)).over(w).alias("n_rows"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_rows_without_a_time_are_kept(spark):
    df = spark.createDataFrame([("a", None, 1, 1.0), ("a", dt.date(2020, 1, 1), 2, 2.0)], SCHEMA)
    got = B.over_series(df, Series(("k",), "date"), lambda w: [F.lag("v", 1).over(w).alias("l")], lookback=1)
    assert sorted((r.id, r.l) for r in got.collect()) == [(1, None), (2, None)]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert B.over_series(df, Series(("k",), "date"), build, 7, 5).count() == 0
    assert B.with_row_index(df, Series((), "date")).count() == 0


def test_attach_gives_every_row_its_statistic(spark):
    df = frame(spark, 5, True)
    for keys in (("k",), ()):
        series = Series(keys, "date", span=3)
        stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        got = B.attach(df, stats, series)
        plain = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_no_task_gets_a_whole_series(spark):
    """A single long series is cut into blocks of bounded size."""
    df = spark.range(20_000).select(
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("v")
    )
    series = Series((), "date", span=512)
    sizes = B.spread(df, series, B.halo(df, series, 13, 7)).groupBy(B.BLOCK).count().agg(F.max("count")).first()[0]
    assert sizes <= 512 + 13 + 7


def test_timestamps_and_numbers_order_a_series(spark):
    events = spark.range(500).select((F.col("id") * 37).alias("n"), F.timestamp_seconds(F.col("id") * 37).alias("ts"), "id")
    for time, span in (("ts", 0.01), ("n", 250)):
        got = W.add_lags(events, Series((), time, span=span), ["id"], [1, 3]).orderBy("id").collect()
        assert [r.id_lag3 for r in got] == [None] * 3 + list(range(497))
