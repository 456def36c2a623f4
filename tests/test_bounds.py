"""What a task may hold, and forms that must agree to the last bit."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrain import Series
from daygrain.constants import TEMPERATURE_BASE
from daygrain.operators import blocks, cleaning, evaluate, predictions, quality, scaling, stats, store, windows
from daygrain.plans import features, prepare
from daygrain.sources import tables

DAY = dt.date(1970, 1, 1)


def test_an_outage_stays_out_of_the_blocks_after_it(spark, monkeypatch):
    """20,000 days, one base column missing for 10,000 of them: no block borrows the outage."""
    days, span = 20_000, 64
    base = [F.rand(i).alias(c) for i, c in enumerate(TEMPERATURE_BASE) if c != "month"]
    rows = spark.range(days).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"), F.lit(1).alias("month"), *base)
    rows = rows.withColumn("t2m", F.when(~F.datediff("date", F.lit(DAY)).between(5_000, 15_000), F.col("t2m")))
    sizes = []
    real = features.spread

    def seen(df, series, per_block, carry=()):
        out = real(df, series, per_block, carry)
        sizes.append(out.groupBy(blocks.BLOCK).count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(features, "spread", seen)
    table = features.temperature_features(rows, Series((), "date", span=span))
    assert max(sizes) <= span + 13 + 13 * 8
    assert table.select("date").where("date > '2011-01-25'").count() > 4_000


def test_edges_hold_the_reach_and_not_its_square(spark, monkeypatch):
    """Minute data, half-day blocks, 364 rows back: a block is offered few more entries than it needs."""
    rows = spark.range(8_000).select((F.lit(dt.datetime(2020, 1, 1)) + F.expr("make_interval(0, 0, 0, 0, 0, CAST(id AS INT))")).alias("t"))
    series = Series((), "t", span=0.005)
    reach = 364
    edges = blocks._edges(rows, series, reach, True, blocks._entry(series))
    needed = blocks._neighbours(edges, series, reach, True)
    assert needed.agg(F.max(F.size("need"))).first()[0] == reach
    places = blocks.rows_before(rows, series, reach)
    most = places.groupBy("target").count().agg(F.max("count")).first()[0]
    assert most <= reach / 7 + 2
    counts = places.join(blocks.with_block(rows, series), blocks.BLOCK).where("t >= lo").groupBy("target").count()
    assert counts.agg(F.max("count")).first()[0] == reach


def test_a_long_window_does_not_change_a_short_one(spark):
    rng = np.random.default_rng(1)
    values = [0.1] * 60 + [float(x) for x in rng.normal(20, 5, 440)]
    values[300] = None
    rows = spark.createDataFrame([(DAY + dt.timedelta(days=i), v) for i, v in enumerate(values)], "date date, v double")
    series = Series((), "date", span=50)
    short = {r.date: (r.v_roll7_mean, r.v_roll7_std) for r in windows.add_rolling(rows, series, ["v"], [7]).collect()}
    both = windows.add_rolling(rows, series, ["v"], [7, 365]).collect()
    assert {r.date: (r.v_roll7_mean, r.v_roll7_std) for r in both} == short
    arrays = windows.add_rolling(rows, series, ["v"], [7], unrolled=1).collect()
    assert {r.date: (r.v_roll7_mean, r.v_roll7_std) for r in arrays} == short
    known = [v for v in values[133:498] if v is not None]
    by = {r.date: r for r in both}
    assert by[DAY + dt.timedelta(days=499)].v_roll365_mean is None and len(known) == 364
    assert short[DAY + dt.timedelta(days=30)] == (0.1, 0.0)


def nan_and_null(spark):
    values = [3.0, -999.0, 8.0, 1.0, math.nan, 4.0, 7.0, 2.0, 9.0, 6.0]
    rows = [("s", DAY + dt.timedelta(days=i), v, float((7 * i) % 10)) for i, v in enumerate(values)]
    schema = "k string, date date, v double, w double"
    return spark.createDataFrame(rows, schema), spark.createDataFrame([(*r[:2], None if math.isnan(r[2]) else r[2], r[3]) for r in rows], schema)


SERIES = Series(("k",), "date")
ON_VALUES = {
    "value_ranges": lambda d: quality.value_ranges(d, ["v", "w"]), "sentinels_to_mean": lambda d: cleaning.sentinels_to_mean(d, SERIES, ["v"]),
    "histogram": lambda d: stats.histogram(d, ["v", "w"], 4), "correlations": lambda d: stats.correlations(d, ["v"], "w"),
    "correlation_matrix": lambda d: stats.correlation_matrix(d, ["v", "w"]), "mutual_information": lambda d: stats.mutual_information(d, ["v"], "w", 3),
    "scatter_counts": lambda d: stats.scatter_counts(d, "w", ["v"], 3), "scatter_pairs": lambda d: stats.scatter_pairs(d, "v", ["w"]),
    "yearly_mean": lambda d: stats.yearly_mean(d, SERIES, "v"), "group_mean": lambda d: stats.group_mean(d, ["k"], ["v"]),
    "group_stats": lambda d: stats.with_group_stats(d, SERIES, [], "v", "m", "s").select("m", "s"),
    "quantiles": lambda d: stats.exact_quantiles(d, SERIES, "v", {"a": 0.05, "b": 0.95}), "min_max": lambda d: stats.min_max_normalise(d, SERIES, ["v"]).select("date", "v_norm"),
    "fit_min_max": lambda d: scaling.fit_min_max(d, SERIES, ["v"]), "fit_standard": lambda d: scaling.fit_standard(d, SERIES, ["v"]),
    "linear": lambda d: stats.linear_trend(d.select("k", F.datediff("date", F.lit(DAY)).alias("year"), F.col("v").alias("mean")), SERIES).select("slope"),
    "polynomial": lambda d: stats.polynomial_trend(d.select("k", F.datediff("date", F.lit(DAY)).alias("year"), F.col("v").alias("mean")), SERIES, 2),
    "rolling": lambda d: windows.add_rolling(d, SERIES, ["v"], [3]).select("date", "v_roll3_mean", "v_roll3_std"),
    "metrics": lambda d: evaluate.horizon_metrics(forecasts(d)), "tolerance": lambda d: evaluate.within_tolerance(forecasts(d)),
    "summary": lambda d: evaluate.forecast_summary(forecasts(d), ["model"]),
}


def forecasts(d):
    return d.select(F.lit("m").alias("model"), F.lit(1).alias("horizon_day"), F.col("v").alias("forecast"), F.col("w").alias("actual"))


@pytest.mark.parametrize("name", ON_VALUES)
def test_nan_counts_as_missing(spark, name):
    with_nan, with_null = nan_and_null(spark)
    rounded = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    got, expected = (rounded(ON_VALUES[name](d).collect()) for d in (with_nan, with_null))
    assert got == expected and "nan" not in " ".join(got)


def test_nan_goes_when_a_table_is_read(spark, tmp_path):
    with_nan, _ = nan_and_null(spark)
    with_nan.write.parquet(f"{tmp_path}/p")
    assert tables.read_parquet(spark, f"{tmp_path}/p").where("isnan(v)").count() == 0
    assert tables.read_parquet(spark, f"{tmp_path}/p").where("v IS NULL").count() == 1


def test_a_null_key_survives_preparation(spark):
    rows = [(k, DAY + dt.timedelta(days=i), float(i), 1.0, 2.0) for k in ("a", None) for i in range(10)]
    raw = spark.createDataFrame(rows, "Station string, Date date, T2M double, EVLAND double, EVPTRNS double")
    got = prepare.prepare(raw, Series(("station",), "date"))
    assert sorted((str(r.station), r.n) for r in got.groupBy("station").agg(F.count("*").alias("n")).collect()) == [("None", 7), ("a", 7)]


def test_partitioned_writes_make_few_files(spark, tmp_path):
    rows = spark.range(2_000).select("id", (F.col("id") % 28).alias("year")).repartition(16)
    tables.write_parquet(rows, f"{tmp_path}/t", ["year"])
    assert len(list(tmp_path.glob("t/*/*.parquet"))) <= 40


def test_polynomial_above_the_number_of_points(spark):
    rows = [("s", i, float(i * i)) for i in range(5)] + [("one", 3, 2.0), ("none", 1, None)]
    got = stats.polynomial_trend(spark.createDataFrame(rows, "k string, year int, mean double"), Series(("k",), "date"), 10).collect()
    by = {(r.k, r.year): r.fitted for r in got}
    assert all(by["s", i] == pytest.approx(i * i, abs=1e-9) for i in range(5)) and by["one", 3] == pytest.approx(2.0) and len(got) == 7


def test_matrix_of_many_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1, (300, 60))
    x[:, 1] = x[:, 0] * 2 + 5
    rows = spark.createDataFrame([[float(v) if rng.random() > 0.02 else None for v in r] + [7.0] for r in x], [*[f"c{i}" for i in range(60)], "same"])
    got = {(r.a, r.b): r.r for r in stats.correlation_matrix(rows, rows.columns).collect()}
    expected = rows.toPandas().corr()
    assert len(got) == 61 * 61 and got["c0", "c1"] == pytest.approx(1.0, abs=1e-9) and got["same", "c3"] is None
    assert all(got[a, b] == pytest.approx(expected.loc[a, b], abs=1e-8) for a in rows.columns[:60] for b in rows.columns[:60])


def test_ensemble_needs_every_model(spark):
    rows = [(m, DAY, DAY, h, 1.0 * h) for m in ("a", "b", "c") for h in (1, 2) if (m, h) != ("c", 2)] + [("c", DAY, DAY, 2, math.nan)]
    got = predictions.ensemble_mean(spark.createDataFrame(rows, "model string, date date, target_date date, horizon_day int, forecast double"), Series((), "date"), ["a", "b", "c"])
    assert [r.horizon_day for r in got.collect()] == [1]


def test_an_upsert_reads_and_writes_its_months_only(spark, tmp_path):
    kind = "station int, date date, target_date date, horizon_day int, forecast double, actual double, model string"
    day = lambda m: dt.date(2020, m, 3)
    rows = lambda months, value: spark.createDataFrame([(1, day(m), day(m) + dt.timedelta(days=1), 1, value, None, "m") for m in months], kind)
    store.create_store(spark, "daily_store", ["station"], f"{tmp_path}/store", rows([1], 0.0))
    keys = ["station", *store.UPSERT_KEY]
    store.upsert_into(spark, "daily_store", rows(range(1, 13), 1.0), keys)
    assert spark.table("daily_store").schema["station"].dataType.simpleString() == "int"
    part = store._months(spark, "daily_store", rows([5], 2.0))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "2020-05" in plan and part.count() == 1
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("store/*/*.parquet")}
    store.upsert_into(spark, "daily_store", rows([5], 2.0), keys)
    truth = spark.createDataFrame([(1, day(5) + dt.timedelta(days=1), None), (1, day(6) + dt.timedelta(days=1), 9.0)], "station int, date date, v double")
    store.backfill_in(spark, "daily_store", truth, Series(("station",), "date"), "v")
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("store/*/*.parquet")}
    changed = {p[0].parent.name for p in set(before.items()) ^ set(after.items())}
    assert changed == {"origin_month=2020-05", "origin_month=2020-06"}
    got = {r.date.month: (r.forecast, r.actual) for r in spark.table("daily_store").collect()}
    assert got[5] == (2.0, None) and got[6] == (1.0, 9.0) and got[7] == (1.0, None)
    spark.sql("DROP TABLE daily_store")
