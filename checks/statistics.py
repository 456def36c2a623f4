"""Statistics, scalers, feature selection and trends."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.common import DAILY_SERIES, KEYS, PANEL_SERIES, check, cols, daily_panel, r, shown, table, with_panel
from daygrain.operators import neighbours, scaling, stats
from daygrain.operators.windows import add_targets
from daygrain.plans.reports import selection_report, trend_report
from daygrain.series import Series

K = ", ".join(KEYS)
FEATURES = ("t2m", "t2m_max", "t2m_min", "ts", "evland", "evptrns", "gwettop", "prectotcorr", "ws10m")


@check("a8_yearly_mean", with_panel(f"SELECT {K}, year(date) AS year, {r('avg(t2m)')} AS mean FROM panel GROUP BY {K}, year(date)", ("t2m",)))
def a8(spark, sf):
    return shown(stats.yearly_mean(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m"))


@check("a8_group_mean", f"SELECT event_type, {r('avg(value)')} AS value FROM events GROUP BY event_type")
def a8_events(spark, sf):
    return shown(stats.group_mean(table(spark, sf, "events"), ["event_type"], ["value"]))


def bin_sql(c, bins, source):
    lo, hi = f"(SELECT min({c}) FROM {source})", f"(SELECT max({c}) FROM {source})"
    return f"least(CAST(floor(({c} - {lo}) / (({hi} - {lo}) / {bins})) AS BIGINT) + 1, {bins})"


HISTOGRAMS = ("l_quantity", "l_linenumber", "l_suppkey")


@check(
    "a11_histogram",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, {bin_sql(c, 50, 'lineitem')} AS bin, count(*) AS n FROM lineitem GROUP BY 2" for c in HISTOGRAMS),
)
def a11(spark, sf):
    return stats.histogram(table(spark, sf, "lineitem"), HISTOGRAMS, 50)


TARGETED = ("t2m", "ts", "evland", "gwettop", "ws10m", "prectotcorr")
WITH_TARGET = f"SELECT *, lead(t2m, 7) OVER (PARTITION BY {K} ORDER BY date) AS target FROM panel"


def with_target(spark, sf, measures=TARGETED):
    panel = add_targets(daily_panel(spark, sf, measures), PANEL_SERIES, {"t2m": "t2m"}, 7)
    others = [f"t2m_d{h}_forecast" for h in range(1, 7)]
    return panel.withColumnRenamed("t2m_d7_forecast", "target").drop(*others)


CORR_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, target) AS r FROM tgt" for c in TARGETED)


@check("a12_correlation_with_target", with_panel(f"SELECT feature, {r('r')} AS r, {r('abs(r)')} AS abs_r FROM ({CORR_SQL})", TARGETED, tgt=WITH_TARGET))
def a12(spark, sf):
    return shown(stats.correlations(with_target(spark, sf), TARGETED, "target"))


@check(
    "a13_correlation_matrix",
    with_panel(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM panel" for a in FEATURES for b in FEATURES), FEATURES),
)
def a13(spark, sf):
    return shown(stats.correlation_matrix(daily_panel(spark, sf, FEATURES), FEATURES))


YEARLY = f"SELECT {K}, year(date) AS year, avg(t2m) AS mean FROM panel GROUP BY {K}, year(date)"


@check(
    "a14_linear_trend",
    with_panel(
        f"""SELECT {K}, year, {r('mean')} AS mean, {r('slope')} AS slope, {r('intercept', 4)} AS intercept, {r('intercept + slope * year')} AS fitted
        FROM yearly JOIN (SELECT {K}, regr_slope(mean, year) AS slope, regr_intercept(mean, year) AS intercept FROM yearly GROUP BY {K}) USING ({K})""",
        ("t2m",), yearly=YEARLY),
)
def a14(spark, sf):
    yearly = stats.yearly_mean(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m")
    fitted = stats.linear_trend(yearly, PANEL_SERIES)
    rounded = shown(fitted.select(*KEYS, "year", "intercept"), 4)
    return shown(fitted.drop("intercept")).join(rounded, [*KEYS, "year"])


# the tables span seven calendar years, so a curve of degree 10 passes through every mean
@check("a15_polynomial_trend", with_panel(f"SELECT {K}, year, {r('mean', 5)} AS mean, {r('mean', 5)} AS fitted FROM yearly", ("t2m",), yearly=YEARLY))
def a15(spark, sf):
    yearly = stats.yearly_mean(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m")
    return shown(stats.polynomial_trend(yearly, PANEL_SERIES, 10), 5)


def quadratic_sql(points: str) -> str:
    """Least-squares parabola through (x, mean) of one series, by Cramer's rule on x mapped to [-1, 1]."""
    return f"""SELECT x, mean, (b0 * (a2 * a4 - a3 * a3) - a1 * (b1 * a4 - a3 * b2) + a2 * (b1 * a3 - a2 * b2)
      + (n * (b1 * a4 - a3 * b2) - b0 * (a1 * a4 - a3 * a2) + a2 * (a1 * b2 - b1 * a2)) * t
      + (n * (a2 * b2 - b1 * a3) - a1 * (a1 * b2 - b1 * a2) + b0 * (a1 * a3 - a2 * a2)) * t * t)
      / (n * (a2 * a4 - a3 * a3) - a1 * (a1 * a4 - a2 * a3) + a2 * (a1 * a3 - a2 * a2)) AS curve
    FROM (SELECT *, count(*) OVER () AS n, sum(t) OVER () AS a1, sum(t * t) OVER () AS a2, sum(t * t * t) OVER () AS a3,
      sum(t * t * t * t) OVER () AS a4, sum(mean) OVER () AS b0, sum(t * mean) OVER () AS b1, sum(t * t * mean) OVER () AS b2
      FROM (SELECT *, 2.0 * (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) - 1 AS t FROM ({points})))"""


MONTHS = "SELECT year(date) * 12 + month(date) AS x, avg(t2m) AS mean FROM panel GROUP BY 1"
YEARS = "SELECT year(date) AS x, avg(t2m) AS mean FROM panel GROUP BY 1"


@check(
    "a15_parabola_of_months",
    with_panel(f"SELECT x AS month, {r('mean', 5)} AS mean, {r('curve', 5)} AS fitted FROM ({quadratic_sql(MONTHS)})", ("t2m",), ()),
)
def a15_months(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",), ())
    monthly = panel.groupBy((F.year("date") * 12 + F.month("date")).alias("month")).agg(F.avg("t2m").alias("mean"))
    return shown(stats.polynomial_trend(monthly, DAILY_SERIES, 2, "month"), 5)


@check(
    "c9_trend_report",
    with_panel(
        f"""SELECT x AS year, {r('mean', 5)} AS mean, {r('slope', 5)} AS slope, {r('intercept', 4)} AS intercept,
        {r('intercept + slope * x', 5)} AS linear, {r('curve', 5)} AS polynomial
        FROM (SELECT *, regr_slope(mean, x) OVER () AS slope, regr_intercept(mean, x) OVER () AS intercept FROM ({quadratic_sql(YEARS)}))""",
        ("t2m",), ()),
)
def c9(spark, sf):
    report = trend_report(daily_panel(spark, sf, ("t2m",), ()), DAILY_SERIES, "t2m", 2)
    return shown(report.drop("intercept"), 5).join(shown(report.select("year", "intercept"), 4), "year")


MI_FEATURES = ("l_linenumber", "l_discount_cents", "l_tax_cents", "l_suppkey")
CENTS = "SELECT l_quantity, l_linenumber, l_suppkey, CAST(round(l_discount * 100) AS INTEGER) AS l_discount_cents, CAST(round(l_tax * 100) AS INTEGER) AS l_tax_cents FROM lineitem"


def mi_sql(c, bins):
    return f"""
    SELECT '{c}' AS feature, sum(n / total * ln(n * total / (nx * ny))) AS mi FROM (
      SELECT CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER () AS DOUBLE) AS total, CAST(sum(n) OVER (PARTITION BY bx) AS DOUBLE) AS nx,
      CAST(sum(n) OVER (PARTITION BY b) AS DOUBLE) AS ny
      FROM (SELECT {bin_sql('l_quantity', bins, 'cents')} AS bx, {bin_sql(c, bins, 'cents')} AS b, count(*) AS n FROM cents GROUP BY 1, 2))
    """


@check("a16_mutual_information", f"WITH cents AS ({CENTS}) SELECT feature, {r('mi')} AS mi FROM (" + " UNION ALL ".join(mi_sql(c, 20) for c in MI_FEATURES) + ")")
def a16(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_quantity", "l_linenumber", "l_suppkey", F.round(F.col("l_discount") * 100).cast("int").alias("l_discount_cents"),
        F.round(F.col("l_tax") * 100).cast("int").alias("l_tax_cents"),
    )
    return shown(stats.mutual_information(rows, MI_FEATURES, "l_quantity", 20))


NEAR_FEATURES = ("t2m_max", "t2m_min", "ts", "evptrns", "gwettop", "prectotcorr", "ws10m")


def near_points_sql(i, c):
    whole = "CAST(floor({0} / CAST(CAST(coalesce(nullif(s{1}, 0), 1) AS FLOAT) AS DOUBLE) * 4294967296.0 + 0.5) AS BIGINT)"
    return f"""SELECT '{c}' AS feature, date AS id, {whole.format(c, "x")} AS x, {whole.format("t2m", "y")} AS y
    FROM panel, (SELECT stddev_pop({c}) AS sx, stddev_pop(t2m) AS sy FROM panel)"""


@check(
    "a16_neighbour_information",
    with_panel(
        f"""SELECT feature, count(*) AS n, {r(f"greatest(0, any_value(whole) + {neighbours.digamma_sql('3')} - avg({neighbours.digamma_sql('nx')} + {neighbours.digamma_sql('ny')}))")} AS mi
        FROM counts JOIN (SELECT {neighbours.digamma_sql('count(*)')} AS whole FROM panel) ON true GROUP BY feature""",
        ("t2m", *NEAR_FEATURES), (),
        points=" UNION ALL ".join(near_points_sql(i, c) for i, c in enumerate(NEAR_FEATURES)),
        near="""SELECT a.feature, a.id, any_value(a.x) AS x, any_value(a.y) AS y, min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 4)[4] AS eps
        FROM points a JOIN points b USING (feature) GROUP BY a.feature, a.id""",
        counts="""SELECT a.feature, a.id, count(*) FILTER (abs(a.x - b.x) < a.eps OR a.x = b.x) AS nx,
        count(*) FILTER (abs(a.y - b.y) < a.eps OR a.y = b.y) AS ny FROM near a JOIN points b USING (feature) GROUP BY a.feature, a.id"""),
)
def a16_near(spark, sf):
    """The daily series of all rows, cut into strips of 600 points, so that neighbours are asked across strips."""
    daily = daily_panel(spark, sf, ("t2m", *NEAR_FEATURES), ())
    return shown(neighbours.mutual_information_knn(daily, NEAR_FEATURES, "t2m", 3, strip=600))


def norm(c, where=""):
    over = f"OVER (PARTITION BY {K})"
    return f"({c} - min({c}) {over}) / nullif(max({c}) {over} - min({c}) {over}, 0)"


@check(
    "a17_min_max_normalise",
    with_panel(
        f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(norm(c))} AS {c}_norm" for c in ("t2m", "ts", "gwettop"))
        + " FROM (SELECT * FROM panel WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')", ("t2m", "ts", "gwettop")),
)
def a17(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts", "gwettop")).where("date BETWEEN DATE'1996-01-01' AND DATE'2000-12-31'")
    return shown(stats.min_max_normalise(panel, PANEL_SERIES, ["t2m", "ts", "gwettop"]).drop("t2m", "ts", "gwettop"))


SCALED = ("t2m", "ts", "ws10m")
FITTED = "date < DATE '2000-01-01'"


def minmax_sql(c):
    over = f"OVER (PARTITION BY {K})"
    lo, hi = f"min({c}) FILTER ({FITTED}) {over}", f"max({c}) FILTER ({FITTED}) {over}"
    return f"({c} - {lo}) / CASE WHEN {hi} = {lo} THEN 1 ELSE {hi} - {lo} END"


def standard_sql(c):
    return f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"


@check("a18_min_max_scaler", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(minmax_sql(c))} AS {c}" for c in SCALED) + " FROM panel", SCALED))
def a18(spark, sf):
    panel = daily_panel(spark, sf, SCALED)
    fitted = scaling.fit_min_max(panel.where("date < DATE'2000-01-01'"), PANEL_SERIES, SCALED)
    return shown(scaling.scale(panel, fitted, PANEL_SERIES, SCALED))


@check("a18_inverse_scaling", with_panel(f"SELECT {cols([*KEYS, 'date:d', *[f'{c}:f' for c in SCALED]])} FROM panel", SCALED))
def a18_inverse(spark, sf):
    panel = daily_panel(spark, sf, SCALED)
    fitted = scaling.fit_min_max(panel, PANEL_SERIES, SCALED)
    return shown(scaling.unscale(scaling.scale(panel, fitted, PANEL_SERIES, SCALED), fitted, PANEL_SERIES, SCALED))


@check("a19_standard_scaler", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(standard_sql(c))} AS {c}" for c in SCALED) + " FROM panel", SCALED))
def a19(spark, sf):
    panel = daily_panel(spark, sf, SCALED)
    whole = Series((), "date")
    return shown(scaling.scale(panel, scaling.fit_standard(panel, whole, SCALED), whole, SCALED))


@check(
    "a21_scatter_pairs",
    with_panel(" UNION ALL ".join(f"SELECT {r('t2m')} AS x, '{y}' AS feature, {r(y)} AS y FROM panel" for y in ("gwettop", "evptrns", "prectotcorr")), ("t2m", "gwettop", "evptrns", "prectotcorr")),
)
def a21(spark, sf):
    ys = ["gwettop", "evptrns", "prectotcorr"]
    return shown(stats.scatter_pairs(daily_panel(spark, sf, ("t2m", *ys)), "t2m", ys))


@check(
    "a21_scatter_counts",
    " UNION ALL ".join(
        f"SELECT '{y}' AS feature, {bin_sql('l_quantity', 25, 'lineitem')} AS x_bin, {bin_sql(y, 25, 'lineitem')} AS y_bin, count(*) AS n FROM lineitem GROUP BY 2, 3"
        for y in ("l_linenumber", "l_suppkey")
    ),
)
def a21_counts(spark, sf):
    return stats.scatter_counts(table(spark, sf, "lineitem"), "l_quantity", ["l_linenumber", "l_suppkey"], 25)


# evland is left out: here it is gwettop times 100, and equal scores have no order of their own
TOP_FEATURES = ("t2m_max", "t2m_min", "ts", "evptrns", "gwettop", "prectotcorr", "ws10m")
TOP_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, t2m) AS r FROM panel" for c in TOP_FEATURES)


@check("t2_top_features", with_panel(f"SELECT feature, {r('abs(r)')} AS abs_r FROM ({TOP_SQL}) WHERE abs(r) > 0.01 ORDER BY abs(r) DESC, feature LIMIT 5", FEATURES))
def t2(spark, sf):
    panel = daily_panel(spark, sf, FEATURES)
    ranked = stats.correlations(panel, TOP_FEATURES, "t2m")
    return shown(stats.top_features(ranked.select("feature", "abs_r"), "abs_r", 5, 0.01))


@check("c5_selection_report", with_panel(
    f"SELECT a, b, {r('r')} AS r FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM panel" for a in FEATURES if a != "evland" for b in FEATURES if b != "evland") + ")", FEATURES))
def c5(spark, sf):
    return shown(selection_report(daily_panel(spark, sf, FEATURES), "t2m", TOP_FEATURES)["matrix"])


C5_FEATURES = tuple(c for c in FEATURES if c not in ("t2m", "evland"))


@check("c5_selection_ranking", with_panel(
    f"SELECT CAST(row_number() OVER (ORDER BY abs(c) DESC, feature) AS INTEGER) AS rank, feature, {r('c')} AS r, {r('abs(c)')} AS abs_r FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, t2m) AS c FROM panel" for c in C5_FEATURES) + ")", ("t2m", *C5_FEATURES)))
def c5_ranking(spark, sf):
    """The report's ranking by correlation."""
    ranking = selection_report(daily_panel(spark, sf, ("t2m", *C5_FEATURES)), "t2m", C5_FEATURES)["correlation"]
    return shown(ranking.select(F.row_number().over(Window.orderBy(F.desc("abs_r"), "feature")).alias("rank"), "feature", "r", "abs_r"))


def panel_mi_sql(c, bins):
    cells = f"SELECT {bin_sql(c, bins, 'panel')} AS y, {bin_sql('t2m', bins, 'panel')} AS x FROM panel"
    return f"""SELECT '{c}' AS feature, sum(n / total * ln(n * total / (nx * ny))) AS mi FROM (SELECT x, y, count(*) AS n, sum(count(*)) OVER () AS total,
    sum(count(*)) OVER (PARTITION BY x) AS nx, sum(count(*)) OVER (PARTITION BY y) AS ny FROM ({cells}) GROUP BY x, y)"""


WHOLE_VALUED = ("t2m_max", "t2m_min", "t2m_range", "prectotcorr", "ws10m")  # values on which both engines cut the bins alike


@check("c5_selection_information", with_panel(
    f"SELECT feature, {r('mi')} AS mi FROM (" + " UNION ALL ".join(panel_mi_sql(c, 20) for c in WHOLE_VALUED) + ") ORDER BY mi DESC, feature LIMIT 4",
    ("t2m", *WHOLE_VALUED)))
def c5_information(spark, sf):
    """The report's mutual information of the columns that correlate at all, the best four."""
    report = selection_report(daily_panel(spark, sf, ("t2m", *WHOLE_VALUED)), "t2m", WHOLE_VALUED, min_abs_r=-1.0, top_mi=4)
    return shown(report["mutual_information"])
