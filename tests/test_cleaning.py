import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain import Series
from daygrain.functions import calendar as cal
from daygrain.functions import numeric as num
from daygrain.operators import cleaning as cl
from daygrain.operators import quality
from daygrain.plans.prepare import prepare
from daygrain.plans.reports import quality_report
from daygrain.sources import tables

DAY = dt.date(2020, 1, 1)


def days(n):
    return [DAY + dt.timedelta(days=i) for i in range(n)]


def test_null_columns_count_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"), 1), (2.0, 1.0, 1.0, 2)], "a double, b double, c double, d int")
    assert cl.columns_with_nulls(df) == ["b", "c"]
    assert cl.drop_null_columns(df, 0.5).columns == ["a", "b", "c", "d"]


def test_latest_times_count_ties_like_nlargest(spark):
    rows = [("a", DAY + dt.timedelta(days=d)) for d in (9, 9, 8, 7, 6)] + [("b", DAY), ("a", None)]
    kept = cl.drop_latest_times(spark.createDataFrame(rows, "k string, date date"), Series(("k",), "date"), 3)
    assert sorted((r.k, str(r.date)) for r in kept.collect()) == [("a", "2020-01-07"), ("a", "2020-01-08"), ("a", "None")]


def test_sentinels_become_the_mean_of_the_rest(spark):
    rows = [("a", days(4)[i], v, -999.0) for i, v in enumerate([1.0, -99.0, 3.0, -9999.0])]
    df = spark.createDataFrame(rows, "k string, date date, v double, only double")
    got = cl.sentinels_to_mean(df, Series(("k",), "date"), ["v", "only"]).orderBy("date").collect()
    assert [r.v for r in got] == [1.0, 2.0, 3.0, 2.0]
    assert all(r.only is None for r in got)


def test_strict_selection_names_what_is_missing(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="nope"):
        cl.select_strict(df, ["id", "nope"])
    assert cl.select_present(df, ["id", "nope"]).columns == ["id"]
    with pytest.raises(FileNotFoundError):
        tables.require_path(spark, "/no/such/place")


def test_numeric_columns_leave_out_targets(spark):
    df = spark.createDataFrame([(1, 1.0, "x", DAY, 2.0)], "a int, b double, c string, date date, t double")
    assert cl.numeric_columns(df, ["t"]) == ["a", "b"]


def test_scoring_input_takes_dicts_and_lists(spark):
    assert cl.to_frame(spark, {"a": 1}).collect()[0].a == 1
    assert cl.to_frame(spark, [{"a": 1}, {"a": 2}]).count() == 2
    with pytest.raises(TypeError):
        cl.to_frame(spark, 3)


def test_calendar_edges(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2020, 12, 31),)], "d date").orderBy("d")
    got = df.select(*[c.alias(n) for n, c in cal.calendar_columns("d").items()], F.dayofyear("d").alias("doy")).collect()
    assert (got[0].doy, got[1].week, got[1].weekday) == (366, 53, 6)
    parsed = spark.createDataFrame([("20200229",), ("20210229",), ("x",)], "t string").select(cal.parse_day("t").alias("d"))
    assert [r.d for r in parsed.collect()] == [dt.date(2020, 2, 29), None, None]


def test_division_follows_floating_point(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (None, 0.0), (1.0, None)]
    got = spark.createDataFrame(rows, "a double, b double").select(num.float_divide(F.col("a"), F.col("b")).alias("q"))
    assert [r.q for r in got.collect()] == [float("inf"), float("-inf"), None, 0.5, None, None]


def test_degree_days_keep_missing_missing(spark):
    got = spark.createDataFrame([(30.0,), (20.0,), (None,)], "t double").select(
        num.cooling_degrees(F.col("t")).alias("c"), num.heating_degrees(F.col("t")).alias("h")
    ).collect()
    assert [(r.c, r.h) for r in got] == [(4.0, 0.0), (0.0, 6.0), (None, None)]


def test_duplicates_and_report(spark):
    rows = [("a", DAY, 0.0), ("a", DAY, -999.0), ("b", DAY, 2.0)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    series = Series(("k",), "date")
    report = quality_report(df, series)
    assert sorted((r.k, r.has_duplicates, r.n_duplicates) for r in report["duplicates"].collect()) == [("a", True, 1), ("b", False, 0)]
    assert report["sentinels"].collect()[0].missing_flag_count == 1
    assert [(r.column_name, r.type) for r in report["types"].collect()][1] == ("date", "date")
    assert quality.zero_counts(df).collect()[0].zero_count == 1


def test_prepare_drops_fills_and_dates(spark):
    rows = [(d, 1.0 if i else -999.0, 0.5, 0.25, None, 3.0) for i, d in enumerate(days(6))]
    raw = spark.createDataFrame(rows, "DATE date, T2M double, EVLAND double, EVPTRNS double, LATE double, PSH double")
    got = prepare(raw, Series((), "date")).orderBy("date")
    assert got.columns == ["date", "t2m", "evland", "evptrns", "year", "month", "day", "week", "weekday", "season_num", "et_total"]
    first = got.collect()[0]
    assert got.count() == 3 and first.t2m == 1.0 and first.et_total == 0.75 and first.season_num == 0
