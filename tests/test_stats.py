import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daygrain import Series
from daygrain.operators import scaling, stats

RNG = np.random.default_rng(0)


def series_frame(spark, n=400):
    pdf = pd.DataFrame({
        "k": np.where(np.arange(n) % 3 == 0, "a", "b"),
        "date": [dt.date(1990, 1, 1) + dt.timedelta(days=20 * int(i)) for i in range(n)],
        "v": np.round(RNG.normal(0, 10, n), 1),
    })
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_are_exact(spark, accuracy):
    """accuracy 10 leaves wide brackets, 10,000 narrow ones, on the same path."""
    pdf, df = series_frame(spark)
    levels = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in stats.exact_quantiles(df, Series(("k",), "date", span=500), "v", levels, accuracy).collect()}
    for key, part in pdf.groupby("k"):
        for name, p in levels.items():
            assert got[key][name] == pytest.approx(part["v"].quantile(p), abs=1e-12)
    whole = stats.exact_quantiles(df, Series((), "date"), "v", levels, accuracy).collect()
    assert len(whole) == 1 and whole[0].p95 == pytest.approx(pdf["v"].quantile(0.95), abs=1e-12)


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(5000).select(F.lit(dt.date(2020, 1, 1)).alias("date"), F.when(F.col("id") < 4000, 1.0).otherwise(F.col("id")).alias("v"))
    got = stats.exact_quantiles(df, Series((), "date"), "v", {"low": 0.05, "mid": 0.5, "high": 0.9}, 20).collect()[0]
    assert (got.low, got.mid) == (1.0, 1.0) and got.high == pytest.approx(4499.1)


def test_polynomial_equals_numpy(spark):
    years = list(range(1981, 2026))
    means = [20 + 0.01 * (y - 2000) + np.sin(y / 3) for y in years]
    yearly = spark.createDataFrame(list(zip(["s"] * 45, years, map(float, means))), "k string, year int, mean double")
    got = stats.polynomial_trend(yearly, Series(("k",), "date"), 6).orderBy("year").toPandas()
    x = (np.array(years) - 2003) / 22
    np.testing.assert_allclose(got["fitted"], np.polyval(np.polyfit(x, means, 6), x), atol=1e-8)


def test_linear_trend_of_one_series(spark):
    yearly = spark.createDataFrame([(y, 2.0 * y + 1) for y in range(2000, 2010)], "year int, mean double")
    row = stats.linear_trend(yearly, Series((), "date")).first()
    assert row.slope == pytest.approx(2) and row.fitted == pytest.approx(row.mean)


def test_histogram_of_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (3.0, 5.0)], "v double, c double")
    got = {(r.column_name, r.bin): r.n for r in stats.histogram(df, ["v", "c"], 2).collect()}
    assert got == {("v", 1): 1, ("v", 2): 2, ("c", 1): 4}


def test_information_of_a_copy_is_its_entropy(spark):
    df = spark.range(400).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 100).alias("other"), (F.col("id") % 4).alias("y"))
    got = {r.feature: r.mi for r in stats.mutual_information(df, ["x", "other"], "y", 4).collect()}
    assert got["x"] == pytest.approx(np.log(4)) and got["other"] == pytest.approx(0, abs=1e-12)


def test_correlation_skips_null_pairs(spark):
    rows = [(float(i), None if i == 3 else 2.0 * i, float(-i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.feature: r.r for r in stats.correlations(df, ["b", "c"], "a").collect()}
    assert got["b"] == pytest.approx(1) and got["c"] == pytest.approx(-1)


def test_a_constant_has_no_correlation_and_comes_last(spark):
    # 0.1 in parts of different sizes: merged sums of squares are not exactly zero
    df = spark.range(0, 1000, 1, 7).select(
        F.col("id").cast("double").alias("t"), F.lit(0.1).alias("same"), F.when(F.col("id") < 5, F.col("id")).otherwise(F.col("id") % 7).cast("double").alias("some"),
        F.when(F.col("id") == 3, 2.0).alias("once"), F.lit(None).cast("double").alias("none"),
    )
    got = stats.correlations(df, ["same", "some", "once", "none"], "t").collect()
    assert [r.feature for r in got] == ["some", "none", "once", "same"] and [r.r for r in got][1:] == [None] * 3
    pdf = df.select("t", "some").toPandas()
    assert got[0].r == pytest.approx(pdf["t"].corr(pdf["some"]), abs=1e-12)
    # constant only on the rows that both hold, and a constant target
    pairs = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 2.0), (None, 6.0, 2.0), (3.0, 5.0, 2.0)], "t double, v double, s double")
    assert [r.r for r in stats.correlations(pairs, ["v"], "t").collect()] == [None] == [r.r for r in stats.correlations(pairs, ["t"], "s").collect()]
    assert [r.feature for r in stats.top_features(stats.correlations(df, ["same", "some"], "t"), "abs_r", 5, 0.0).collect()] == ["some"]


def test_scalers_round_trip_and_survive_constants(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d), float(d), 7.0) for d in range(1, 11)], "date date, v double, c double")
    whole = Series((), "date")
    for fit in (scaling.fit_min_max, scaling.fit_standard):
        fitted = fit(df, whole, ["v", "c"])
        scaled = scaling.scale(df, fitted, whole, ["v", "c"])
        assert {r.c for r in scaled.collect()} == {0.0}
        back = scaling.unscale(scaled, fitted, whole, ["v", "c"]).orderBy("date").collect()
        assert [r.v for r in back] == pytest.approx([float(d) for d in range(1, 11)])


def test_normalising_a_constant_gives_null(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d), 1.0) for d in (1, 2)], "date date, v double")
    assert [r.v_norm for r in stats.min_max_normalise(df, Series((), "date"), ["v"]).collect()] == [None, None]
