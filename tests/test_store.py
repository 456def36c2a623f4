import datetime as dt
import uuid

from pyspark.sql import functions as F

from daygrain import Series
from daygrain.operators import store as st
from daygrain.operators.merging import fill_actuals, outer_merge
from daygrain.operators.predictions import pick_forecast
from daygrain.session import shared_path

SCHEMA = "date date, target_date date, horizon_day int, forecast double, actual double, model string"
D = dt.date(2020, 1, 30)
SERIES = Series((), "date")


def rows(start, n, value, model="m"):
    return [(start + dt.timedelta(days=i), start + dt.timedelta(days=i + 1), 1, value, None, model) for i in range(n)]


def content(df):
    return sorted(tuple(r) for r in df.select("date", "target_date", "horizon_day", "forecast", "actual", "model").collect())


def test_upsert_replaces_matches_and_is_idempotent(spark):
    old = spark.createDataFrame(rows(D, 4, 1.0), SCHEMA)
    new = spark.createDataFrame(rows(D + dt.timedelta(days=2), 4, 2.0), SCHEMA)
    once = st.upsert(old, new)
    assert [r[3] for r in content(once)] == [1.0, 1.0, 2.0, 2.0, 2.0, 2.0]
    assert content(st.upsert(once, new)) == content(once)


def test_stored_table_touches_only_its_months(spark):
    name = f"store_{uuid.uuid4().hex}"
    path = shared_path(spark, name)
    st.create_store(spark, name, path=path)
    st.upsert_into(spark, name, spark.createDataFrame(rows(D, 5, 1.0), SCHEMA))
    before = {f: f for f in spark.read.parquet(path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    st.upsert_into(spark, name, spark.createDataFrame(rows(dt.date(2020, 2, 1), 1, 9.0), SCHEMA))
    spark.catalog.refreshTable(name)
    after = set(spark.read.parquet(path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    january = {f for f in before if "2020-01" in f}
    assert january and january <= after
    assert [r[3] for r in content(st.read_store(spark, name))] == [1.0, 1.0, 9.0, 1.0, 1.0]

    truth = spark.createDataFrame([(dt.date(2020, 2, 2), 7.0), (dt.date(2020, 2, 2), 7.0)], "date date, t2m double")
    st.backfill_in(spark, name, truth, SERIES, "t2m")
    filled = content(st.read_store(spark, name))
    assert [r[4] for r in filled] == [None, None, 7.0, None, None] and len(filled) == 5


def test_actuals_keep_what_they_had_without_a_match(spark):
    have = spark.createDataFrame([(D, D, 1, 1.0, 5.0, "m"), (D, D + dt.timedelta(days=1), 2, 1.0, 6.0, "m")], SCHEMA)
    truth = spark.createDataFrame([(D, 8.0)], "date date, t2m double")
    got = fill_actuals(have, truth, SERIES, "t2m").orderBy("horizon_day").collect()
    assert [r.actual for r in got] == [8.0, 6.0]


def test_outer_merge_suffixes_only_clashes(spark):
    a = spark.createDataFrame([(D, 1, 2)], "date date, x int, y int")
    b = spark.createDataFrame([(D, 3, 4), (D + dt.timedelta(days=1), 5, 6)], "date date, x int, z int")
    got = outer_merge(a, b, ["date"], ("_a", "_b"))
    assert got.columns == ["date", "x_a", "y", "x_b", "z"] and got.count() == 2


def test_forecast_column_falls_back_to_any_number(spark):
    df = spark.createDataFrame([(None, 2.0), (1.0, 3.0)], "value double, other double")
    assert [r.forecast for r in pick_forecast(df, ["value"], ["other"]).collect()] == [2.0, 1.0]
