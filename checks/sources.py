"""Scans, landed responses, sinks and the forecast table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.common import KEYS, PANEL_SERIES, check, cols, daily_panel, r, shown, table, with_panel
from daygrain.operators.merging import fill_actuals
from daygrain.operators.predictions import persistence
from daygrain.operators.store import (
    backfill, backfill_in, backfill_version, create_store, read_store, upsert, upsert_into, upsert_version, versioned_store,
)
from daygrain.plans.ingest import ingest_responses
from daygrain.session import shared_path, written
from daygrain.sources import responses as R
from daygrain.streaming.landing import ingest_new_responses, ingest_with_faults, raw_table
from daygrain.sources import tables as S

K = ", ".join(KEYS)
ORDERS_CSV = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
)


def unique(name):
    return f"{name}_{uuid.uuid4().hex}"


@check(
    "s1_parquet_scan",
    f"SELECT * REPLACE ({r('o_totalprice')} AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders",
)
def s1(spark, sf):
    return shown(S.read_parquet(spark, f"{sf}/orders.parquet").withColumn("o_orderdate", F.to_date("o_orderdate")))


@check("s9_required_input", "SELECT * FROM nation")
def s9(spark, sf):
    nation = S.read_parquet(spark, S.require_path(spark, f"{sf}/nation.parquet"))
    return S.require_columns(nation, ["n_nationkey", "n_name", "n_regionkey"])


@check("s9_required_orders", f"SELECT o_orderkey, o_custkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice FROM orders")
def s9_orders(spark, sf):
    """A table that grows: the path and three columns are required before it is read."""
    orders = S.read_parquet(spark, S.require_path(spark, f"{sf}/orders.parquet"))
    return shown(S.require_columns(orders, ["o_orderkey", "o_custkey", "o_totalprice"]).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


def orders_csv(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return S.write_csv(orders, shared_path(spark, "orders") + ".csv")


@check("s2_csv_scan", f"SELECT o_orderkey, o_custkey, o_orderstatus, {cols(['o_totalprice:f'])}, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders")
def s2(spark, sf):
    return shown(S.read_csv(spark, orders_csv(spark, sf), ORDERS_CSV))


@check(
    "s3_load_by_extension",
    "SELECT kind, o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders "
    "CROSS JOIN (VALUES ('csv'), ('parquet')) t(kind) GROUP BY kind, o_orderstatus",
)
def s3(spark, sf):
    text = S.load_table(spark, orders_csv(spark, sf), schema=ORDERS_CSV)
    binary = S.load_table(spark, f"{sf}/orders.parquet")
    both = text.select(F.lit("csv").alias("kind"), "o_orderstatus", "o_orderkey").unionByName(
        binary.select(F.lit("parquet").alias("kind"), "o_orderstatus", "o_orderkey")
    )
    return both.groupBy("kind", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")
    )


@check("s4_table_scan", f"SELECT * REPLACE ({r('c_acctbal')} AS c_acctbal) FROM customer")
def s4(spark, sf):
    name = unique("customer_scan")
    S.replace_table(table(spark, sf, "customer"), name, path=shared_path(spark, name))
    return shown(spark.table(name))


# --- landed responses: one document per (series, year) in two batches -----------------------

BAD_DAY = "20019999"


def landed(spark, sf):
    """Batch 1 holds T2M and TS; batch 2 repeats T2M from 1998 on (other values, one bad day) and adds EVLAND."""
    panel = daily_panel(spark, sf, ("t2m", "ts", "evland")).withColumn("year", F.year("date"))
    day = F.date_format("date", "yyyyMMdd")

    def points(value):
        return F.collect_list(F.struct(day.alias("k"), value.alias("v")))

    yearly = panel.groupBy(*KEYS, "year").agg(
        points(F.col("t2m")).alias("t2m"), points(F.col("ts")).alias("ts"),
        points(F.col("t2m") + 100).alias("t2m_new"), points(F.col("evland")).alias("evland"),
    )
    bad = F.array(F.struct(F.lit(BAD_DAY).alias("k"), F.lit(-999.0).alias("v")))

    def body(*named):
        entries = F.array(*[F.struct(F.lit(n).alias("k"), F.map_from_entries(p).alias("v")) for n, p in named])
        return F.to_json(F.struct(F.struct(F.map_from_entries(entries).alias("parameter")).alias("properties")))

    first = yearly.select(*KEYS, F.lit(1).alias("batch"), body(("T2M", F.col("t2m")), ("TS", F.col("ts"))).alias("body"))
    second = yearly.where("year >= 1998").select(
        *KEYS, F.lit(2).alias("batch"),
        body(("T2M", F.concat("t2m_new", bad)), ("EVLAND", F.col("evland"))).alias("body"),
    )
    return first.unionByName(second)


LONG_SQL = f"""
SELECT {K}, 1 AS batch, 'T2M' AS param, date, t2m AS value FROM panel
UNION ALL SELECT {K}, 1, 'TS', date, ts FROM panel
UNION ALL SELECT {K}, 2, 'T2M', date, t2m + 100 FROM panel WHERE year(date) >= 1998
UNION ALL SELECT {K}, 2, 'T2M', NULL, -999 FROM (SELECT DISTINCT {K}, year(date) FROM panel WHERE year(date) >= 1998)
UNION ALL SELECT {K}, 2, 'EVLAND', date, evland FROM panel WHERE year(date) >= 1998
"""
LATEST_SQL = f"SELECT * FROM long QUALIFY batch = max(batch) OVER (PARTITION BY {K}, param)"
LONG_COLS = [*KEYS, "batch", "param", "date:d", "value:f"]


@check("s5_response_rows", with_panel(f"SELECT {cols(LONG_COLS)} FROM long", long=LONG_SQL))
def s5(spark, sf):
    return shown(R.response_rows(landed(spark, sf), keep=[*KEYS, "batch"]))


@check("s6_latest_batch", with_panel(f"SELECT {cols(LONG_COLS)} FROM latest", long=LONG_SQL, latest=LATEST_SQL))
def s6(spark, sf):
    return shown(R.latest_batch(R.response_rows(landed(spark, sf), keep=[*KEYS, "batch"]), PANEL_SERIES))


PIVOT_SQL = f"""
SELECT {K}, date, max(value) FILTER (param = 'T2M') AS "T2M", max(value) FILTER (param = 'TS') AS "TS",
max(value) FILTER (param = 'EVLAND') AS "EVLAND" FROM latest GROUP BY {K}, date
"""


@check(
    "c1_ingest_responses",
    with_panel(f"SELECT {cols([*KEYS, 'date:d', 'T2M:f', 'TS:f', 'EVLAND:f'])} FROM wide", long=LONG_SQL, latest=LATEST_SQL, wide=PIVOT_SQL),
)
def c1(spark, sf):
    return shown(ingest_responses(landed(spark, sf), PANEL_SERIES, ["T2M", "TS", "EVLAND"]))


@check(
    "c1_ingest_landing_folder",
    with_panel(f"SELECT {cols([*KEYS, 'date:d', 'T2M:f', 'TS:f', 'EVLAND:f'])} FROM wide", long=LONG_SQL, latest=LATEST_SQL, wide=PIVOT_SQL),
)
def c1_landing(spark, sf):
    """Two daily runs: the files of batch 1 land first, those of batch 2 later."""
    landing, rows, checkpoint = (shared_path(spark, n) for n in ("landing", "rows", "ingest"))
    responses = landed(spark, sf)
    for number in (1, 2):
        responses.where(F.col("batch") == number).write.mode("append").parquet(landing)
        run = ingest_new_responses(spark, landing, rows, checkpoint, KEYS)
        run.awaitTermination()
    return shown(raw_table(spark, rows, PANEL_SERIES, ["T2M", "TS", "EVLAND"]))


@check(
    "s8_set_aside",
    with_panel(
        f"""SELECT {K}, run, count(*) AS documents, sum(CAST(aside AS INTEGER)) AS set_aside FROM (
        SELECT {K}, year(date) AS y, year(date) % 5 = 0 AS aside, CASE WHEN year(date) < 1998 THEN 0 ELSE 1 END AS run FROM panel GROUP BY ALL)
        GROUP BY {K}, run""", ("t2m",)),
)
def s8_aside(spark, sf):
    """Documents of a year each, every fifth one broken in one of four ways, in two runs: each is in one of the two sinks."""
    landing, rows, aside, checkpoint = (shared_path(spark, n) for n in ("landing", "rows", "aside", "ingest"))
    yearly = landed(spark, sf).where("batch = 1").withColumn("year", F.expr(
        "int(left(map_keys(map_values(from_json(body, 'properties struct<parameter: map<string, map<string, double>>>').properties.parameter)[0])[0], 4))"
    ))
    kind = F.pmod(F.xxhash64(*KEYS, "year"), F.lit(4))
    broken = F.when(kind == 0, F.lit(None).cast("string")).when(kind == 1, F.substring("body", 1, 40)).when(kind == 2, '{"messages": []}').otherwise(
        '{"properties": {"parameter": {"T2M": {}}}}')
    documents = yearly.withColumn("body", F.when(F.col("year") % 5 == 0, broken).otherwise(F.col("body"))).withColumn("batch", F.col("year").cast("int"))
    for early in (True, False):
        documents.where((F.col("year") < 1998) == F.lit(early)).select(*KEYS, "batch", "body").write.mode("append").parquet(landing)
        ingest_with_faults(spark, landing, rows, aside, checkpoint, KEYS).awaitTermination()
    good = spark.read.parquet(rows).select(*KEYS, "batch", "run").distinct().withColumn("aside", F.lit(0))
    bad = spark.read.parquet(aside).select(*KEYS, "batch", "run").withColumn("aside", F.lit(1))
    return good.unionByName(bad).groupBy(*KEYS, "run").agg(F.count("*").alias("documents"), F.sum("aside").alias("set_aside"))


@check(
    "j1_align_parameters",
    with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f', 'ts:f', 'evland:f'])} FROM panel"),
)
def j1(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts", "evland"))
    rows = panel.unpivot([*KEYS, "date"], ["t2m", "ts", "evland"], "param", "value")
    return shown(R.align_parameters(rows, PANEL_SERIES, ["t2m", "ts", "evland"]))


@check(
    "s7_request_plan",
    """SELECT batch, count(*) AS n_params, string_agg(p_name, ',' ORDER BY p_partkey) AS parameters,
       CASE WHEN bool_or(p_size = 50) THEN '20010101' ELSE '19810101' END AS start_date
       FROM (SELECT *, (row_number() OVER (ORDER BY p_partkey) - 1) // 20 + 1 AS batch FROM part) GROUP BY batch""",
)
def s7(spark, sf):
    catalogue = table(spark, sf, "part").select("p_partkey", "p_name", (F.col("p_size") == 50).alias("late"))
    return R.request_plan(catalogue, "p_partkey", "p_name", is_late=F.col("late"))


AUDIT_SQL = """
SELECT concat('P', p_partkey) AS parameter, CASE WHEN p_size % 10 = 0 THEN 422 ELSE 200 END AS status_code,
CASE WHEN p_size % 10 = 0 OR p_size % 7 = 0 OR p_size % 11 = 0 THEN 0 ELSE 1 END AS ok,
CASE WHEN p_size % 10 = 0 THEN 'HTTP 422' WHEN p_size % 7 = 0 OR p_size % 11 = 0 THEN 'No data returned' ELSE 'OK' END AS message
FROM part
"""


def audit_input(spark, sf):
    name = F.concat(F.lit("P"), F.col("p_partkey"))
    series = (
        F.when(F.col("p_size") % 7 == 0, "")
        .when(F.col("p_size") % 11 == 0, F.concat(F.lit('"'), name, F.lit('":{}')))
        .otherwise(F.concat(F.lit('"'), name, F.lit('":{"20200101":'), F.col("p_retailprice"), F.lit("}")))
    )
    failed = F.col("p_size") % 10 == 0
    return table(spark, sf, "part").select(
        name.alias("parameter"), F.when(failed, 422).otherwise(200).alias("status_code"),
        F.when(failed, "Unprocessable").otherwise(
            F.concat(F.lit('{"properties":{"parameter":{'), series, F.lit("}}}"))
        ).alias("body"),
    )


@check("s8_response_audit", AUDIT_SQL)
def s8(spark, sf):
    return shown(R.audit_responses(audit_input(spark, sf)))


@check("s8_audit_counts", f"SELECT ok, message, count(*) AS n FROM ({AUDIT_SQL}) GROUP BY ok, message")
def s8_counts(spark, sf):
    return shown(R.audit_counts(R.audit_responses(audit_input(spark, sf))))


# --- sinks ----------------------------------------------------------------------------------

PANEL_COLS = [*KEYS, "date:d", "t2m:f", "ts:f", "prectotcorr:f"]


@check("k1_parquet_sink", with_panel(f"SELECT {cols(PANEL_COLS)}, CAST(year(date) AS INTEGER) AS year FROM panel"))
def k1(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts", "prectotcorr")).withColumn("year", F.year("date"))
    return shown(S.read_parquet(spark, S.write_parquet(panel, shared_path(spark, "panel"), ["year"])))


@check("k2_csv_sink", with_panel(f"SELECT {cols(PANEL_COLS)} FROM panel"))
def k2(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts", "prectotcorr"))
    path = S.write_csv(panel, shared_path(spark, "panel_csv"))
    return shown(S.read_csv(spark, path, panel.schema))


@check("k3_replace_table", with_panel(f"SELECT {cols(PANEL_COLS)} FROM panel WHERE t2m > 20"))
def k3(spark, sf):
    name = unique("panel_table")
    path = shared_path(spark, name)
    panel = daily_panel(spark, sf, ("t2m", "ts", "prectotcorr"))
    S.replace_table(panel, name, path=path)
    return shown(S.replace_table(panel.where("t2m > 20"), name, path=path))


SUMMARY = "SELECT count(*) AS total_rows, strftime(min(date), '%Y-%m-%d') AS min_date, strftime(max(date), '%Y-%m-%d') AS max_date FROM panel"


@check("k4_load_summary", with_panel(SUMMARY))
def k4(spark, sf):
    return shown(S.load_summary(daily_panel(spark, sf)))


# --- forecast table -------------------------------------------------------------------------

STORE_KEY = [*KEYS, "date", "target_date", "model"]
STORE_COLS = [*KEYS, "date:d", "target_date:d", "horizon_day", "forecast:f", "actual:f", "model"]
LONG_FORECAST = f"""
SELECT {K}, date, CAST(date + CAST(h AS INTEGER) AS DATE) AS target_date, CAST(h AS INTEGER) AS horizon_day, t2m AS forecast,
CAST(CASE WHEN h = 7 THEN -1 END AS DOUBLE) AS actual, 'persistence' AS model FROM panel CROSS JOIN range(1, 8) r(h)
"""
OLD_SQL = "SELECT * FROM pred WHERE NOT date BETWEEN DATE '2000-07-01' AND DATE '2000-12-15'"
NEW_SQL = "SELECT * REPLACE (forecast + 1 AS forecast) FROM pred WHERE date BETWEEN DATE '2000-06-25' AND DATE '2000-12-15'"
UPSERT_SQL = f"""
SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {' AND '.join(f'o.{c} = n.{c}' for c in STORE_KEY)})
UNION ALL SELECT * FROM new
"""
TRUTH_SQL = f"SELECT {K}, date AS target_date, t2m AS truth FROM panel WHERE day(date) % 10 <> 0"
FILL_SQL = f"""
SELECT s.* REPLACE (coalesce(t.truth, s.actual) AS actual) FROM store s LEFT JOIN truth t USING ({K}, target_date)
"""


def store_parts(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",))
    rows = persistence(panel, PANEL_SERIES, "t2m").withColumn("actual", F.when(F.col("horizon_day") == 7, -1.0))
    rows = rows.select(*KEYS, "date", "target_date", "horizon_day", "forecast", "actual", "model")
    old = rows.where("NOT date BETWEEN DATE'2000-07-01' AND DATE'2000-12-15'")
    new = rows.where("date BETWEEN DATE'2000-06-25' AND DATE'2000-12-15'").withColumn("forecast", F.col("forecast") + 1)
    truth = panel.where("day(date) % 10 <> 0").select(*KEYS, "date", "t2m")
    return old, new, truth


@check("k6_upsert", with_panel(f"SELECT {cols(STORE_COLS)} FROM store", pred=LONG_FORECAST, old=OLD_SQL, new=NEW_SQL, store=UPSERT_SQL))
def k6(spark, sf):
    old, new, _ = store_parts(spark, sf)
    return shown(upsert(old, new, STORE_KEY))


@check(
    "k7_backfill",
    with_panel(f"SELECT {cols(STORE_COLS)} FROM ({FILL_SQL})", pred=LONG_FORECAST, store=OLD_SQL, truth=TRUTH_SQL),
)
def k7(spark, sf):
    old, _, truth = store_parts(spark, sf)
    return shown(backfill(old, truth, PANEL_SERIES, "t2m"))


@check(
    "k5_forecast_table",
    with_panel(
        f"SELECT {cols(STORE_COLS)} FROM ({FILL_SQL})",
        pred=LONG_FORECAST,
        old=OLD_SQL, new=NEW_SQL, store=UPSERT_SQL, truth=TRUTH_SQL,
    ),
)
def k5(spark, sf):
    old, new, truth = store_parts(spark, sf)
    name = unique("forecast_store")
    create_store(spark, name, KEYS, shared_path(spark, name))
    create_store(spark, name, KEYS, shared_path(spark, name))
    upsert_into(spark, name, old, STORE_KEY)
    upsert_into(spark, name, new, STORE_KEY)
    upsert_into(spark, name, new, STORE_KEY)
    backfill_in(spark, name, truth, PANEL_SERIES, "t2m")
    return shown(read_store(spark, name))


@check(
    "k6_versioned_store",
    with_panel(
        f"SELECT {cols(STORE_COLS)} FROM ({FILL_SQL})",
        pred=LONG_FORECAST,
        old=OLD_SQL, new=NEW_SQL, store=UPSERT_SQL, truth=TRUTH_SQL,
    ),
)
def k6_versions(spark, sf):
    """The forecast table as versions: created, upserted twice, filled in; the first version is still what it was."""
    old, new, truth = (written(part, "part") for part in store_parts(spark, sf))
    store = versioned_store(spark, shared_path(spark, "versions"))
    first = store.replace(old)
    rows = store.read(first).count()
    upsert_version(store, new, STORE_KEY)
    upsert_version(store, new, STORE_KEY)
    backfill_version(store, truth, PANEL_SERIES, "t2m")
    if store.latest() < 3 or store.read(first).count() != rows:
        raise AssertionError("an earlier version changed")
    return shown(store.read())


@check(
    "j3_fill_actuals",
    with_panel(
        f"SELECT {cols(STORE_COLS)} FROM ({FILL_SQL})",
        pred=LONG_FORECAST, store="SELECT * REPLACE (CAST(NULL AS DOUBLE) AS actual) FROM pred", truth=TRUTH_SQL,
    ),
)
def j3(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",))
    _, _, truth = store_parts(spark, sf)
    rows = persistence(panel, PANEL_SERIES, "t2m").withColumn("actual", F.lit(None).cast("double"))
    return shown(fill_actuals(rows, truth, PANEL_SERIES, "t2m"))
