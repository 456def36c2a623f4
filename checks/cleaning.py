"""Projection, filters, cleaning, joins, scalar functions and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import KEYS, PANEL_SERIES, check, cols, daily_panel, panel_sql, r, shown, table, with_panel
from daygrain import constants as C
from daygrain.functions import calendar as cal
from daygrain.functions import numeric as num
from daygrain.operators import cleaning as cl
from daygrain.operators import quality as q
from daygrain.operators.merging import outer_merge, truth_for
from daygrain.operators.predictions import persistence, pick_forecast
from daygrain.operators.windows import over_recent, past, rolling_block
from daygrain.plans.prepare import prepare
from daygrain.plans.reports import column_profile
from daygrain.series import Series
from daygrain.sources.tables import load_summary

K = ", ".join(KEYS)


# --- the raw panel: sentinels, a column that starts late, upper-case names -------------------

RAW = ("t2m", "ts", "evland", "evptrns", "gwettop", "ws10m", "rhoa", "to3")
RAW_FIX = {
    "t2m": "CASE WHEN day(date) % 11 = 0 THEN -999 ELSE t2m END",
    "ts": "CASE WHEN day(date) % 11 = 5 THEN -99 WHEN day(date) = 20 THEN -9999 ELSE ts END",
    "evland": "CASE WHEN day(date) % 13 = 0 THEN -99.0 ELSE evland END",
    "to3": "CASE WHEN date >= DATE '1996-01-01' THEN to3 END",
}


def raw_panel(spark, sf):
    panel = daily_panel(spark, sf, RAW)
    return panel.withColumns({c: F.expr(e).cast("double") for c, e in RAW_FIX.items()})


def raw_sql():
    fixed = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in RAW_FIX.items())
    return f"SELECT * REPLACE ({fixed}) FROM ({panel_sql(RAW)})"


def with_raw(body, **more):
    ctes = "".join(f", {n} AS ({s})" for n, s in more.items())
    return f"WITH raw AS ({raw_sql()}){ctes} {body}"


def fcols(names):
    return [f"{c}:f" for c in names]


@check("p1_lower_names", f"SELECT * REPLACE ({r('c_acctbal')} AS c_acctbal) FROM customer")
def p1(spark, sf):
    customer = table(spark, sf, "customer")
    return shown(cl.lower_names(customer.toDF(*[c.upper() for c in customer.columns])))


@check("p7_numeric_columns", f"SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice FROM orders")
def p7(spark, sf):
    orders = table(spark, sf, "orders")
    return shown(orders.select(*cl.numeric_columns(orders, exclude=["o_custkey"])))


@check("p15_frame_from_rows", "SELECT * FROM region UNION ALL SELECT 99, 'one more'")
def p15(spark, sf):
    region = cl.to_frame(spark, table(spark, sf, "region"))
    return region.unionByName(cl.to_frame(spark, {"r_regionkey": 99, "r_name": "one more"}, region.schema))


@check("p15_frame_of_customers", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT -1, 'one more' UNION ALL SELECT -2, NULL")
def p15_customers(spark, sf):
    """A table as it is, a dict and a list of dicts, all brought to the table's columns."""
    customers = cl.to_frame(spark, table(spark, sf, "customer")).select("c_custkey", "c_name")
    more = cl.to_frame(spark, {"c_custkey": -1, "c_name": "one more"}, customers.schema)
    return customers.unionByName(more).unionByName(cl.to_frame(spark, [{"c_custkey": -2, "c_name": None}], customers.schema))


@check("p2_rename", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS day, {r('t2m')} AS temperature FROM panel"))
def p2(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",))
    return shown(cl.rename(panel, {"date": "day", "t2m": "temperature"}))


@check("p3_select_present", with_panel(f"SELECT {cols(['t2m:f', 'ts:f', 'ws10m:f'])} FROM panel"))
def p3(spark, sf):
    return shown(cl.select_present(daily_panel(spark, sf), ["t2m", "frost_days", "ts", "tsoil9", "ws10m"]))


@check("p4_select_strict", with_panel(f"SELECT {cols(['date:d', 'gwettop:f', 't2m_max:f'])} FROM panel"))
def p4(spark, sf):
    return shown(cl.select_strict(daily_panel(spark, sf), ["date", "gwettop", "t2m_max"]))


@check("p5_drop_listed", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f'])} FROM panel"))
def p5(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts")).withColumn("psh", F.lit(1.0)).withColumnRenamed("ts", "frost_days")
    return shown(cl.drop_listed(panel, [*C.INCOMPLETE_COLUMNS, *C.ZERO_COLUMNS]))


@check("p6_drop_null_columns", with_raw(f"SELECT {cols([*KEYS, 'date:d', *fcols([c for c in RAW if c != 'to3'])])} FROM raw"))
def p6(spark, sf):
    return shown(cl.drop_null_columns(raw_panel(spark, sf)))


LATEST = "rank() OVER (PARTITION BY {by} ORDER BY {t} DESC) > 3"


@check(
    "p8_drop_latest_times",
    f"SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders QUALIFY {LATEST.format(by='o_orderstatus', t='o_orderdate')}",
)
def p8(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))
    return shown(cl.drop_latest_times(orders, Series(("o_orderstatus",), "o_orderdate"), 3))


FLAGGED = "t2m IN (-999, -9999, -99) OR ts IN (-999, -9999, -99) OR evland IN (-999, -9999, -99)"


@check("p9_rows_with_sentinel", with_raw(f"SELECT {cols([*KEYS, 'date:d', 't2m:f', 'ts:f', 'evland:f'])} FROM raw WHERE {FLAGGED}"))
def p9(spark, sf):
    raw = raw_panel(spark, sf).select(*KEYS, "date", "t2m", "ts", "evland")
    return shown(cl.rows_with_sentinel(raw, ["t2m", "ts", "evland"]))


def mean_sql(c, by):
    return (
        f"CASE WHEN {c} IN (-999, -9999, -99) THEN avg({c}) FILTER ({c} NOT IN (-999, -9999, -99)) "
        f"OVER (PARTITION BY {by}) ELSE {c} END"
    )


@check(
    "p10_sentinels_to_mean",
    with_raw(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(mean_sql(c, K))} AS {c}" for c in ("t2m", "ts", "evland")) + " FROM raw"),
)
def p10(spark, sf):
    raw = raw_panel(spark, sf).select(*KEYS, "date", "t2m", "ts", "evland")
    return shown(cl.sentinels_to_mean(raw, PANEL_SERIES, ["t2m", "ts", "evland"]))


@check(
    "p10_sentinels_to_mean_one_series",
    with_raw(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r(mean_sql('t2m', '1'))} AS t2m FROM raw"),
)
def p10_global(spark, sf):
    raw = raw_panel(spark, sf).select(*KEYS, "date", "t2m")
    return shown(cl.sentinels_to_mean(raw, Series((), "date"), ["t2m"]))


@check("p11_drop_incomplete", with_raw(f"SELECT {cols([*KEYS, 'date:d', 'to3:f'])} FROM raw WHERE to3 IS NOT NULL"))
def p11(spark, sf):
    return shown(cl.drop_incomplete(raw_panel(spark, sf).select(*KEYS, "date", "to3"), ["to3"]))


@check("p12_between_days", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f'])} FROM panel WHERE date BETWEEN DATE '2000-01-01' AND DATE '2002-12-31'"))
def p12(spark, sf):
    return shown(cl.between_days(daily_panel(spark, sf, ("t2m",)), "date", "2000-01-01", "2002-12-31"))


@check(
    "p13_outside_days",
    with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f'])} FROM panel WHERE date NOT BETWEEN DATE '2001-10-01' AND DATE '2001-10-20' AND date <> DATE '1996-02-29'"),
)
def p13(spark, sf):
    return shown(cl.outside_days(daily_panel(spark, sf, ("t2m",)), "date", "2001-10-01", "2001-10-20", ["1996-02-29"]))


@check("p14_sum_column", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r('evland + evptrns')} AS et_total FROM panel"))
def p14(spark, sf):
    panel = daily_panel(spark, sf, ("evland", "evptrns"))
    return shown(cl.sum_column(panel, "et_total", ["evland", "evptrns"]).drop("evland", "evptrns"))


# --- joins ----------------------------------------------------------------------------------

BY_DAY = """
SELECT CAST(l_shipdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS n, min(l_quantity) AS low FROM lineitem GROUP BY 1
"""
BY_ORDER_DAY = """
SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS n, min(o_totalprice) AS price FROM orders GROUP BY 1
"""


@check(
    "j2_outer_merge",
    f"""SELECT strftime(coalesce(a.date, b.date), '%Y-%m-%d') AS date, {r('a.n')} AS n_ship, {r('low')} AS low,
        {r('b.n')} AS n_order, {r('price')} AS price FROM ({BY_DAY}) a FULL JOIN ({BY_ORDER_DAY}) b ON a.date = b.date""",
)
def j2(spark, sf):
    ship = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.min("l_quantity").alias("low")
    )
    ordered = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.min("o_totalprice").alias("price")
    )
    return shown(outer_merge(ship, ordered, ["date"], ("_ship", "_order")))


@check(
    "j4_truth_for_dates",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS target_date, {r('t2m')} AS actual FROM panel p
        WHERE EXISTS (SELECT 1 FROM panel f, range(1, 8) g(h) WHERE f.l_returnflag = p.l_returnflag
        AND f.l_linestatus = p.l_linestatus AND month(f.date) = 2 AND f.date + CAST(h AS INTEGER) = p.date)"""
    ),
)
def j4(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",))
    forecasts = persistence(panel.where("month(date) = 2"), PANEL_SERIES, "t2m")
    return shown(truth_for(panel, forecasts, PANEL_SERIES, "t2m").withColumnRenamed("__actual", "actual"))


@check(
    "j5_anti_join_delete",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)",
)
def j5(spark, sf):
    gone = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(gone, "o_orderkey", "left_anti")


FRAME3 = f"OVER (PARTITION BY {K} ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@check(
    "j6_blocks_side_by_side",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r('t2m')} AS t2m, {r('lag(t2m, 2) OVER w')} AS t2m_lag2,
        {r(f'CASE WHEN count(t2m) {FRAME3} = 3 THEN avg(t2m) {FRAME3} END')} AS t2m_roll3_mean,
        {r(f'CASE WHEN count(t2m) {FRAME3} = 3 THEN stddev_samp(t2m) {FRAME3} END')} AS t2m_roll3_std,
        {r('sin(2 * pi() * month(date) / 12)')} AS month_sin FROM panel WINDOW w AS (PARTITION BY {K} ORDER BY date)"""
    ),
)
def j6(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",))
    season = cal.cyclic(F.month("date"), 12.0)[0].alias("month_sin")
    columns = [past("t2m", 2).alias("t2m_lag2"), *rolling_block(["t2m"], [3]), season]
    return shown(over_recent(panel, PANEL_SERIES, {"t2m": 2}, columns))


@check("j7_append_rows", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000")
def j7(spark, sf):
    orders = table(spark, sf, "orders")
    more = orders.where("o_totalprice > 400000").select("o_orderstatus", "o_orderkey")
    return orders.select("o_orderkey", "o_orderstatus").unionByName(more)


@check("distinct_target_dates", with_panel(f"SELECT DISTINCT {K}, strftime(date + CAST(h AS INTEGER), '%Y-%m-%d') AS target_date FROM panel, range(1, 8) g(h)"))
def distinct_dates(spark, sf):
    rows = persistence(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m")
    return shown(rows.select(*KEYS, "target_date").distinct())


# --- scalar functions -----------------------------------------------------------------------


@check(
    "f1_parse_day",
    """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END, '%Y-%m-%d') AS day FROM orders""",
)
def f1(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "20019999").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return shown(rows.select("o_orderkey", cal.parse_day("text").alias("day")))


SEASON = "CASE WHEN month({d}) IN (12, 1, 2) THEN {a} WHEN month({d}) IN (3, 4, 5) THEN {b} ELSE {c} END"


@check(
    "f2_f6_calendar_columns",
    f"""SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
    week(o_orderdate) AS week, isodow(o_orderdate) - 1 AS weekday, dayofyear(o_orderdate) AS dayofyear,
    {SEASON.format(d='o_orderdate', a=0, b=1, c=2)} AS season_num,
    {SEASON.format(d='o_orderdate', a="'winter'", b="'summer'", c="'rainy'")} AS season FROM orders""",
)
def f2(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    named = cal.calendar_columns("date")
    return orders.select(
        "o_orderkey", *[c.alias(n) for n, c in named.items()], F.dayofyear("date").alias("dayofyear"),
        cal.season_name(F.month("date")).alias("season"),
    )


ENCODINGS = {
    "month_sin": "sin(2*pi()*m/12)", "month_cos": "cos(2*pi()*m/12)", "doy_sin": "sin(2*pi()*d/365)", "doy_cos": "cos(2*pi()*d/365)",
    "week_sin": "sin(2*pi()*d/7)", "week_cos": "cos(2*pi()*d/7)", "quarter_sin": "sin(2*pi()*(m-1)/3)",
    "quarter_cos": "cos(2*pi()*(m-1)/3)", "half_year_sin": "sin(2*pi()*(m-1)/6)", "half_year_cos": "cos(2*pi()*(m-1)/6)",
    "month_progress": "(d % 30) / 30.0",
}


@check(
    "f7_f9_seasonal_encodings",
    "SELECT o_orderkey, " + ", ".join(f"{r(e)} AS {n}" for n, e in ENCODINGS.items())
    + " FROM (SELECT o_orderkey, month(o_orderdate) AS m, dayofyear(o_orderdate) AS d FROM orders)",
)
def f7(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.month("o_orderdate").alias("m"), F.dayofyear("o_orderdate").alias("d")
    )
    named = {**cal.seasonal_encodings(F.col("m"), F.col("d")), **cal.frequency_encodings(F.col("m"), F.col("d"))}
    return shown(orders.select("o_orderkey", *[c.alias(n) for n, c in named.items()]))


@check(
    "f10_degree_days",
    with_raw(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r('CASE WHEN t IS NULL THEN NULL WHEN 26 - t > 0 THEN 26 - t ELSE 0 END')} AS hdd,
        {r('CASE WHEN t IS NULL THEN NULL WHEN t - 26 > 0 THEN t - 26 ELSE 0 END')} AS cdd
        FROM (SELECT *, CASE WHEN t2m <> -999 THEN t2m END AS t FROM raw)"""
    ),
)
def f10(spark, sf):
    rows = raw_panel(spark, sf).withColumn("t", F.when(F.col("t2m") != -999, F.col("t2m")))
    return shown(rows.select(
        *KEYS, "date", num.heating_degrees(F.col("t")).alias("hdd"), num.cooling_degrees(F.col("t")).alias("cdd")
    ))


GRAD = ("t2m", "ts", "t10m", "tsoil1", "tsoil2", "tsoil4", "v10m", "rhoa", "gwettop", "evptrns")
GRAD_SQL = {
    "temp_gradient_surface": "t2m - ts", "temp_gradient_soil": "tsoil1 - tsoil4", "temp_gradient_altitude": "t10m - t2m",
    "soil_temp_gradient_shallow": "tsoil1 - tsoil2", "soil_temp_gradient_deep": "tsoil2 - tsoil4",
}
INTER_SQL = {
    "wind_chill_factor": "t2m - v10m * 0.1", "heat_index_simple": "t2m + rhoa * 0.01", "temp_humidity_ratio": "t2m / (rhoa + 1)",
    "evaporation_potential": "t2m * v10m * 0.01", "soil_temp_moisture": "tsoil1 * gwettop", "surface_efficiency": "ts / (evptrns + 0.1)",
}


@check("f13_gradients", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(e)} AS {n}" for n, e in GRAD_SQL.items()) + " FROM panel", GRAD))
def f13(spark, sf):
    named = num.temperature_gradients()
    return shown(daily_panel(spark, sf, GRAD).select(*KEYS, "date", *[c.alias(n) for n, c in named.items()]))


@check("f14_interactions", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(e)} AS {n}" for n, e in INTER_SQL.items()) + " FROM panel", GRAD))
def f14(spark, sf):
    named = num.weather_interactions()
    return shown(daily_panel(spark, sf, GRAD).select(*KEYS, "date", *[c.alias(n) for n, c in named.items()]))


@check("f15_utc_day", "SELECT event_id, strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d') AS day FROM events")
def f15(spark, sf):
    zoned = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+07:00")).cast("timestamp")
    return shown(table(spark, sf, "events").select("event_id", cal.utc_day(zoned).alias("day")))


@check(
    "f16_days_ahead",
    "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 7, '%Y-%m-%d') AS target, dayname(CAST(o_orderdate AS DATE) + 7) AS name FROM orders",
)
def f16(spark, sf):
    target = cal.days_ahead(F.to_date("o_orderdate"), 7)
    return shown(table(spark, sf, "orders").select("o_orderkey", target.alias("target"), cal.day_name(target).alias("name")))


@check(
    "f17_pick_forecast",
    with_raw(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r('coalesce(to3, CASE WHEN t2m <> -999 THEN t2m END, ts)')} AS forecast FROM raw"),
)
def f17(spark, sf):
    rows = raw_panel(spark, sf).select(
        *KEYS, "date", F.col("to3").alias("forecast_raw"),
        F.when(F.col("t2m") != -999, F.col("t2m")).alias("prediction"), F.col("ts").alias("value"),
    )
    picked = pick_forecast(rows, ["forecast_raw", *C.FORECAST_KEYS])
    return shown(picked.select(*KEYS, "date", "forecast"))


# --- quality reports ------------------------------------------------------------------------

REPORTED = ("t2m", "ts", "evland", "gwettop", "ws10m", "to3")


def per_column(expr, name):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {expr.format(c=c)} AS {name} FROM raw" for c in REPORTED)


@check("a1_null_counts", with_raw(per_column("count(*) - count({c})", "missing_count")))
def a1(spark, sf):
    return q.null_counts(raw_panel(spark, sf), REPORTED)


@check("a2_sentinel_counts", with_raw(per_column("count(*) FILTER ({c} IN (-999, -9999, -99))", "missing_flag_count")))
def a2(spark, sf):
    return q.sentinel_counts(raw_panel(spark, sf), REPORTED)


@check(
    "a3_zero_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} = 0) AS zero_count FROM lineitem" for c in ("l_discount", "l_tax", "l_quantity")),
)
def a3(spark, sf):
    return q.zero_counts(table(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity"])


NUMERIC_LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@check(
    "a4_value_ranges",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max FROM lineitem" for c in NUMERIC_LINEITEM),
)
def a4(spark, sf):
    return shown(q.value_ranges(table(spark, sf, "lineitem")))


@check(
    "a5_duplicate_times",
    "SELECT o_orderstatus, CAST(count(*) > count(DISTINCT o_orderdate) AS INTEGER) AS has_duplicates, count(*) - count(DISTINCT o_orderdate) AS n_duplicates FROM orders GROUP BY 1",
)
def a5(spark, sf):
    return shown(q.duplicate_times(table(spark, sf, "orders"), Series(("o_orderstatus",), "o_orderdate")))


@check("a6_schema_report", """SELECT * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'),
('c_acctbal', 'double'), ('c_mktsegment', 'string')) t(column_name, type)""")
def a6(spark, sf):
    return q.schema_report(table(spark, sf, "customer"))


@check("a6_schema_and_counts", "SELECT column_name, type, rows, known FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS rows, count({c}) AS known FROM orders"
    for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderpriority", "string"))) + ")")
def a6_counts(spark, sf):
    """The schema of a whole table with the rows in which each column is known."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    nulls = q.null_counts(orders)
    rows = F.lit(orders.count()).cast("bigint")
    return q.schema_report(orders).join(nulls, "column_name").select("column_name", "type", rows.alias("rows"), (rows - F.col("missing_count")).alias("known"))


@check("a7_shape_and_range", "SELECT count(*) AS total_rows, strftime(min(o_orderdate), '%Y-%m-%d') AS min_date, strftime(max(o_orderdate), '%Y-%m-%d') AS max_date FROM orders")
def a7(spark, sf):
    return shown(load_summary(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))))


@check(
    "c8_column_profile",
    with_raw(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,
        count(*) FILTER ({c} IN (-999, -9999, -99)) AS missing_flag_count, count(*) FILTER ({c} = 0) AS zero_count,
        {r(f'min({c})')} AS min, {r(f'max({c})')} AS max FROM raw""" for c in REPORTED
    )),
)
def c8(spark, sf):
    return shown(column_profile(raw_panel(spark, sf), REPORTED))


# --- raw to clean ---------------------------------------------------------------------------

CLEAN = [c for c in RAW if c != "to3"]
CLEAN_MEAN = {c: mean_sql(c, K) for c in CLEAN}


@check(
    "c2_prepare",
    with_raw(
        f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(c)} AS {c}" for c in CLEAN)
        + f""", year(date) AS year, month(date) AS month, day(date) AS day, week(date) AS week, isodow(date) - 1 AS weekday,
        {SEASON.format(d='date', a=0, b=1, c=2)} AS season_num, {r('evland + evptrns')} AS et_total FROM filled""",
        kept=f"SELECT * FROM raw QUALIFY {LATEST.format(by=K, t='date')}",
        filled=f"SELECT {K}, date, " + ", ".join(f"{e} AS {c}" for c, e in CLEAN_MEAN.items()) + " FROM kept",
    ),
)
def c2(spark, sf):
    raw = raw_panel(spark, sf)
    upper = raw.withColumnsRenamed({c: c.upper() for c in [*RAW, "date"]}).withColumn("SZA", F.lit(1.0)).withColumn("FRSNO", F.lit(0.0))
    return shown(prepare(upper, PANEL_SERIES))
