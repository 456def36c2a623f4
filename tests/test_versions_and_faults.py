"""Versioned tables under failing and competing writers; documents that are set aside."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain import Series
from daygrain.operators import store as st
from daygrain.operators.versions import Conflict, Versions
from daygrain.session import shared_path
from daygrain.streaming.landing import fault, ingest_with_faults

SCHEMA = "date date, target_date date, horizon_day int, forecast double, actual double, model string"
D = dt.date(2020, 1, 30)
SERIES = Series((), "date")


def rows(start, n, value, model="m"):
    return [(start + dt.timedelta(days=i), start + dt.timedelta(days=i + 1), 1, value, None, model) for i in range(n)]


def frame(spark, *args):
    return spark.createDataFrame(rows(*args), SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect())


def test_versions_are_kept_and_months_shared(spark):
    store = st.versioned_store(spark, shared_path(spark, "v"))
    assert store.latest() == 0
    with pytest.raises(ValueError, match="no version"):
        store.read()
    assert st.upsert_version(store, frame(spark, D, 5, 1.0)) == 1
    assert st.upsert_version(store, frame(spark, dt.date(2020, 2, 1), 1, 9.0)) == 2
    one, two = store.manifest(1)["parts"], store.manifest(2)["parts"]
    assert set(two) == {"2020-01", "2020-02"} and one["2020-01"] == two["2020-01"] and one["2020-02"] != two["2020-02"]
    assert [r[3] for r in content(store.read(1))] == [1.0] * 5 and [r[3] for r in content(store.read())] == [1.0, 1.0, 9.0, 1.0, 1.0]
    assert store.read(parts=["2020-01"]).count() == 2
    truth = spark.createDataFrame([(dt.date(2020, 2, 2), 7.0)], "date date, t2m double")
    assert st.backfill_version(store, truth, SERIES, "t2m") == 3
    assert [r[4] for r in content(store.read())] == [None, None, 7.0, None, None]
    assert st.backfill_version(store, truth, SERIES, "t2m") == 3  # nothing new
    assert store.replace(frame(spark, dt.date(2021, 5, 1), 2, 3.0)) == 4 and store.read().count() == 2
    assert store.replace(frame(spark, D, 0, 0.0)) == 5 and store.read().count() == 0
    assert st.upsert_version(store, frame(spark, D, 1, 4.0)) == 6 and store.read().count() == 1
    assert len(store.clean(keep=1)) >= 3 and content(store.read()) == content(frame(spark, D, 1, 4.0))
    with pytest.raises(Exception):
        store.read(2)


def test_a_writer_that_dies_leaves_the_old_version(spark):
    store = Versions(spark, shared_path(spark, "v"), st.month_of)
    store.replace(frame(spark, D, 40, 1.0))
    before = content(store.read())
    bad = frame(spark, D, 40, 2.0).repartition(4).withColumn("forecast", F.when(F.col("date") < "2020-02-20", F.col("forecast")).otherwise(F.raise_error(F.lit("the writer dies")).cast("double")))
    for write in (lambda: store.replace(bad), lambda: st.upsert_version(store, bad)):
        with pytest.raises(Exception, match="the writer dies"):
            write()
        assert store.latest() == 1 and content(store.read()) == before
    store.clean()
    assert content(store.read()) == before


def test_two_writers_lose_nothing(spark):
    path = shared_path(spark, "v")
    one, two = st.versioned_store(spark, path), st.versioned_store(spark, path)
    one.replace(frame(spark, dt.date(2020, 1, 1), 60, 1.0))
    met = []

    def slow(month, value, other=None):
        def made(old):
            if other and not met:
                met.append(1)
                other()
            return old.withColumn("forecast", F.col("forecast") + value)

        return made

    # another month meanwhile: published on top of the other writer's version
    one.change(["2020-01"], slow("2020-01", 10.0, lambda: two.change(["2020-02"], slow("2020-02", 100.0))))
    assert {r[3] for r in content(one.read(parts=["2020-01"]))} == {11.0} and {r[3] for r in content(one.read(parts=["2020-02"]))} == {101.0}
    assert one.latest() == 3
    # the same month meanwhile: made again from the other writer's rows
    met.clear()
    one.change(["2020-01"], slow("2020-01", 10.0, lambda: two.change(["2020-01"], slow("2020-01", 1000.0))))
    assert {r[3] for r in content(one.read(parts=["2020-01"]))} == {1021.0}

    def always(old):
        two.change(["2020-01"], lambda x: x)
        return old

    with pytest.raises(Conflict):
        one.change(["2020-01"], always, tries=2)
    with pytest.raises(ValueError, match="other partitions"):
        one.change(["2020-02"], lambda old: frame(spark, dt.date(2020, 1, 1), 1, 5.0))


GOOD = '{"properties": {"parameter": {"T2M": {"20200101": 1.5, "2020": 2.0}, "TS": {}}}}'
DOCS = [("good", GOOD), ("null", None), ("blank", "  "), ("cut", GOOD[:40]), ("other", '{"messages": ["x"]}'), ("empty", '{"properties": {"parameter": {"T2M": {}}}}'),
        ("none", '{"properties": {"parameter": {}}}'), ("list", "[1, 2]"), ("text", "HTTP 500")]


def test_faults_are_named(spark):
    got = {r.k: r.why for r in spark.createDataFrame(DOCS, "k string, body string").select("k", fault().alias("why")).collect()}
    assert got["good"] is None and got["null"] == got["blank"] == "empty document" and got["cut"] == got["text"] == "not JSON"
    assert got["other"] == "no parameters" and got["empty"] == got["none"] == "no values" and got["list"] is not None


def test_every_document_is_in_one_sink_and_a_repeated_batch_doubles_nothing(spark):
    landing, out, aside, checkpoint = (shared_path(spark, n) for n in ("landing", "rows", "aside", "ckpt"))
    docs = spark.createDataFrame([(k, i, b) for i, (k, b) in enumerate(DOCS)], "site string, batch int, body string")
    docs.where("batch < 5").write.parquet(landing)
    run = lambda c: ingest_with_faults(spark, landing, out, aside, c, ("site",)).awaitTermination()
    run(checkpoint)
    docs.where("batch >= 5").write.mode("append").parquet(landing)
    run(checkpoint)
    state = lambda: (sorted(map(str, spark.read.parquet(out).collect())), sorted(map(str, spark.read.parquet(aside).collect())))
    first = state()
    assert len(first[0]) == 2 and len(first[1]) == len(DOCS) - 1
    run(checkpoint)  # nothing new
    assert state() == first
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/1")
    files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(files, False)  # as if the run had failed before its commit
    run(checkpoint)
    assert state() == first
