"""The feature table against a plain pandas computation, null runs included."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from daygrain import Series
from daygrain import constants as K
from daygrain.operators.windows import add_rolling, add_targets
from daygrain.plans.features import feature_columns, rain_features, temperature_features

KEY = "station"


def panel(n, seed, holes=()):
    rng = np.random.default_rng(seed)
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=int(i)) for i in np.cumsum(rng.integers(1, 4, n))]
    data = {c: rng.normal(20, 5, n) for c in K.TEMPERATURE_BASE if c != "month"}
    data["month"] = [d.month for d in days]
    df = pd.DataFrame({"date": days, **data})
    for i, column in holes:
        df.loc[i, column] = np.nan
    return df


def expected(df):
    """Stage one, drop, stage two on what is left, drop."""
    df = df.copy()
    df["dayofyear"] = [d.timetuple().tm_yday for d in df["date"]]
    one = {}
    for c in K.TEMPERATURE_BASE:
        if c != "month":
            for k in range(1, 8):
                one[f"{c}_lag{k}"] = df[c].shift(k)
    for c in K.TEMPERATURE_ROLLING:
        for n in (3, 7):
            one[f"{c}_roll{n}_mean"] = df[c].rolling(n).mean()
            one[f"{c}_roll{n}_std"] = df[c].rolling(n).std()
    left = pd.concat([df, pd.DataFrame(one)], axis=1).dropna().reset_index(drop=True)
    t = left["t2m"]
    month = left.groupby("month")["t2m"]
    two = pd.DataFrame({
        "t2m_volatility_7d": t.rolling(7).std() / t.rolling(7).mean(),
        "t2m_acceleration": t.diff().diff(),
        "t2m_monthly_avg": month.transform("mean"),
        "t2m_seasonal_trend": month.transform("std"),
        "t2m_is_extreme_hot": (t > t.quantile(0.95)).astype(int),
        "t2m_is_extreme_cold": (t < t.quantile(0.05)).astype(int),
        "t2m_rolling_p25": t.rolling(7).quantile(0.25),
        "t2m_trend_strength": t.rolling(7).mean() - t.rolling(14).mean(),
        "t2m_momentum_7d": t - t.shift(7),
        "t2m_volatility_3d_lag3": (t.rolling(3).std() / t.rolling(3).mean()).shift(3),
        "t2m_anomaly_lag2": (t - month.transform("mean")).shift(2),
    })
    return pd.concat([left, two], axis=1).dropna().reset_index(drop=True)


HOLES = [(30, "ts"), (31, "to3"), *[(i, "z0m") for i in range(60, 95)], (140, "month"), (141, "v2m")]


@pytest.mark.parametrize("span", [8, 40, 4000])
@pytest.mark.parametrize("holes", [(), HOLES])
def test_equals_pandas(spark, span, holes):
    frames = {"a": panel(220, 1, holes), "b": panel(120, 2), "tiny": panel(5, 3)}
    whole = pd.concat([f.assign(**{KEY: k}) for k, f in frames.items()]).sample(frac=1, random_state=0)
    # pandas turned month into a float column where it has a hole
    df = spark.createDataFrame(whole).withColumn("month", __import__("pyspark").sql.functions.expr("cast(nanvl(month, null) as int)"))
    got = temperature_features(df, Series((KEY,), "date", span=span)).toPandas()
    assert got.shape[1] == 392 + 1
    for key, frame in frames.items():
        want = expected(frame)
        have = got[got[KEY] == key].sort_values("date").reset_index(drop=True)
        assert list(have["date"]) == list(want["date"])
        for c in want.columns:
            if c != "date":
                np.testing.assert_allclose(have[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_each_complete_series_loses_twenty_rows(spark):
    df = spark.createDataFrame(pd.concat([panel(100, s).assign(**{KEY: str(s)}) for s in range(3)]))
    rows = temperature_features(df, Series((KEY,), "date", span=16)).groupBy(KEY).count().collect()
    assert [r["count"] for r in rows] == [80, 80, 80]


def test_statistics_can_stop_before_the_test_period(spark):
    df = spark.createDataFrame(panel(200, 4))
    series = Series((), "date")
    until = temperature_features(df, series, fit_until="2001-06-30")
    early = temperature_features(df.where("date <= '2001-06-30'"), series)
    pick = lambda t: {r.date: r.t2m_monthly_avg for r in t.select("date", "t2m_monthly_avg").collect()}
    full, short = pick(until), pick(early)
    assert len(full) < 180  # months seen only later have no statistics
    assert all(abs(full[d] - short[d]) < 1e-9 for d in short)


def test_targets_are_carried_and_excluded_from_features(spark):
    df = add_targets(spark.createDataFrame(panel(80, 5)), Series((), "date"), {"t2m": "t2m"})
    names = [f"t2m_d{h}_forecast" for h in range(1, 8)]
    got = temperature_features(df, Series((), "date"), carry=names)
    assert got.count() == 80 - 7 - 20
    assert not set(names) & set(feature_columns(got))
    assert len(feature_columns(got)) == 391


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="gwettop"):
        temperature_features(spark.createDataFrame(panel(30, 6)).drop("gwettop"), Series((), "date"))


def test_rain_lags_the_season_too(spark):
    pdf = panel(40, 7).assign(season_num=2, ps=1.0)
    got = rain_features(spark.createDataFrame(pdf), Series((), "date"))
    assert "season_num_lag7" in got.columns and "month_lag1" not in got.columns
    assert got.count() == 33


def test_rolling_skips_absent_columns_and_short_series(spark):
    pdf = panel(4, 8)[["date", "t2m"]]
    got = add_rolling(spark.createDataFrame(pdf), Series((), "date"), ["t2m", "nowhere"], [3, 7]).orderBy("date").collect()
    assert [r.t2m_roll3_mean is None for r in got] == [True, True, False, False]
    assert all(r.t2m_roll7_std is None for r in got)


def test_equal_values_have_no_deviation(spark):
    pdf = pd.DataFrame({"date": [dt.date(2020, 1, d) for d in range(1, 11)], "v": [0.1] * 10})
    got = add_rolling(spark.createDataFrame(pdf), Series((), "date", span=3), ["v"], [3, 7]).where("v_roll7_std is not null").collect()
    assert len(got) == 4 and all(r.v_roll7_std == 0.0 and r.v_roll3_mean == 0.1 for r in got)
