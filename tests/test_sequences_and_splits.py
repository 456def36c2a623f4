import datetime as dt

import numpy as np
import pytest

from daygrain import Series
from daygrain.operators import sequences as seq
from daygrain.operators.splits import chronological_split
from daygrain.operators.windows import first_rows, last_rows, latest_row

DAY = dt.date(2020, 1, 1)


def frame(spark, sizes=(("a", 40), ("b", 12), ("c", 3))):
    rows = [(k, DAY + dt.timedelta(days=3 * i), float(i), float(100 + i)) for k, n in sizes for i in range(n)]
    return spark.createDataFrame(rows, "k string, date date, v double, y double")


@pytest.mark.parametrize("gap", [0, 1])
@pytest.mark.parametrize("span", [4, 1000])
def test_sequences_hold_the_rows_before_their_anchor(spark, gap, span):
    series, lookback, horizon = Series(("k",), "date", span=span), 5, 2
    got = seq.sliding_sequences(frame(spark), series, ["v"], ["y"], lookback, horizon, gap).collect()
    want = []
    for key, n in (("a", 40), ("b", 12), ("c", 3)):
        for t in range(lookback - 1 + gap, n - horizon):
            want.append((key, [float(i) for i in range(t - lookback + 1 - gap, t + 1 - gap)], 100.0 + t))
    assert sorted((r.k, [f[0] for f in r.x], r.y[0]) for r in got) == sorted(want)


def test_latest_sequence_uses_the_same_gap(spark):
    series = Series(("k",), "date")
    got = {r.k: [f[0] for f in r.x] for r in seq.latest_sequence(frame(spark), series, ["v"], 5, gap=1).collect()}
    assert got == {"a": [34.0, 35.0, 36.0, 37.0, 38.0], "b": [6.0, 7.0, 8.0, 9.0, 10.0]}


def test_split_is_ordered_and_complete(spark):
    rows = chronological_split(frame(spark), Series(("k",), "date", span=10)).collect()
    for key, n in (("a", 40), ("b", 12), ("c", 3)):
        parts = [r.part for r in sorted((r for r in rows if r.k == key), key=lambda r: r.date)]
        train = int(n * (1 - 0.1))
        learn = int(train * (1 - 0.2))
        assert parts == ["train"] * learn + ["validation"] * (train - learn) + ["test"] * (n - train)


def test_ordered_split_rounds_the_test_part_up(spark):
    series = Series(("k",), "date")
    made = seq.sliding_sequences(frame(spark, (("a", 40),)), series, ["v"], ["y"], 5, 2)
    flags = [r.is_train for r in seq.split_ordered(made, series).orderBy("date").collect()]
    assert flags == [True] * (33 - int(np.ceil(33 * 0.2))) + [False] * int(np.ceil(33 * 0.2))


def test_first_last_and_latest_rows(spark):
    df, series = frame(spark), Series(("k",), "date")
    assert {(r.k, r.v) for r in latest_row(df, series).collect()} == {("a", 39.0), ("b", 11.0), ("c", 2.0)}
    assert sorted(r.v for r in last_rows(df, series, 2).where("k = 'a'").collect()) == [38.0, 39.0]
    assert sorted(r.v for r in first_rows(df, series, 5).where("k = 'c'").collect()) == [0.0, 1.0, 2.0]
