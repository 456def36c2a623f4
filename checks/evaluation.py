"""Splits, forecasts, ensembles, metrics and trained models."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.common import KEYS, PANEL_SERIES, check, cols, daily_panel, r, shown, with_panel
from checks.sources import unique
from checks.windows import INDEXED
from daygrain.operators import evaluate as ev
from daygrain.operators import feature_lists as lists
from daygrain.operators import models as M
from daygrain.operators import predictions as P
from daygrain.operators import sequences as seq
from daygrain.operators.splits import chronological_split
from daygrain.operators.stats import correlations
from daygrain.operators.store import read_store
from daygrain.operators.windows import add_targets, target_names
from daygrain.plans import forecasting as fc
from daygrain.session import shared_path, written

K = ", ".join(KEYS)
DAYS = range(1, 8)
OVER = f"WINDOW w AS (PARTITION BY {K} ORDER BY date)"

SPLIT_SQL = """SELECT *, CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT) AS cut,
CAST(floor(floor(n * CAST(0.9 AS DOUBLE)) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS vcut FROM idx"""


@check(
    "m1_chronological_split",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, i AS row_idx,
        CASE WHEN i >= cut THEN 'test' WHEN i >= vcut THEN 'validation' ELSE 'train' END AS part FROM split""",
        ("t2m",), idx=INDEXED, split=SPLIT_SQL),
)
def m1(spark, sf):
    return shown(chronological_split(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES).drop("t2m"))


def sequence_rows(spark, sf, lookback):
    panel = add_targets(daily_panel(spark, sf, ("t2m", "ts")), PANEL_SERIES, {"t2m": "t2m"})
    made = seq.sliding_sequences(panel, PANEL_SERIES, ["t2m", "ts"], ["t2m_d1_forecast"], lookback)
    return panel, made


@check(
    "m2_sequence_split",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, i - 7 AS seq_idx, CAST(i - 7 < cut - 7 - 7 AS INTEGER) AS is_train
        FROM split WHERE i BETWEEN 7 AND n - 8""", ("t2m",), idx=INDEXED, split=SPLIT_SQL),
)
def m2(spark, sf):
    panel, made = sequence_rows(spark, sf, 7)
    return shown(seq.split_sequences(made, panel, PANEL_SERIES, 7).select(*KEYS, "date", "seq_idx", "is_train"))


@check(
    "m2_ordered_split_of_30",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, i - 30 AS seq_idx,
        CAST(i - 30 < (n - 37) - CAST(ceil((n - 37) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS INTEGER) AS is_train
        FROM idx WHERE i BETWEEN 30 AND n - 8""", ("t2m",), idx=INDEXED),
)
def m2_30(spark, sf):
    _, made = sequence_rows(spark, sf, 30)
    return shown(seq.split_ordered(made, PANEL_SERIES).select(*KEYS, "date", "seq_idx", "is_train"))


# --- deterministic forecasts: three models whose scores SQL can repeat -----------------------

MODEL_VALUES = {"persistence": "t2m", "halfway": "(t2m + ts) / 2", "shifted": "t2m + 1"}
LONG_SQL = " UNION ALL ".join(
    f"""SELECT {K}, '{m}' AS model, date, CAST(date + CAST(h AS INTEGER) AS DATE) AS target_date, CAST(h AS INTEGER) AS horizon_day,
    {e} AS forecast FROM panel CROSS JOIN range(1, 8) g(h)""" for m, e in MODEL_VALUES.items()
)
ENSEMBLE_SQL = f"SELECT {K}, 'ensemble' AS model, date, target_date, horizon_day, avg(forecast) AS forecast FROM long GROUP BY {K}, date, target_date, horizon_day"
TRUE_SQL = f"SELECT f.*, p.t2m AS actual FROM (SELECT * FROM long UNION ALL SELECT * FROM ens) f JOIN panel p ON {' AND '.join(f'f.{k} = p.{k}' for k in KEYS)} AND p.date = f.target_date"
FORECAST_COLS = [*KEYS, "model", "date:d", "target_date:d", "horizon_day", "forecast:f"]
METRICS = dict(long=LONG_SQL, ens=ENSEMBLE_SQL, rows=TRUE_SQL)


def wide_scores(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts"))
    named = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).alias("v")) for m, e in MODEL_VALUES.items()])
    rows = panel.select(*KEYS, "date", F.explode(named).alias("m")).select(*KEYS, "date", "m.*")
    return rows.select(*KEYS, "date", "model", *[F.col("v").alias(n) for n in P.forecast_names()])


def long_forecasts(spark, sf):
    return P.to_long(wide_scores(spark, sf), PANEL_SERIES, P.forecast_names())


def judged(spark, sf):
    """Forecasts of the three models and their ensemble next to the true values."""
    rows = long_forecasts(spark, sf)
    both = rows.unionByName(P.ensemble_mean(rows, PANEL_SERIES, list(MODEL_VALUES)).select(*rows.columns))
    return ev.actual_vs_predicted(both, daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m")


@check("m11_forecast_rows", with_panel(f"SELECT {cols(FORECAST_COLS)} FROM long", ("t2m", "ts"), long=LONG_SQL))
def m11(spark, sf):
    return shown(long_forecasts(spark, sf))


@check("f18_horizon_from_position", with_panel(f"SELECT {cols(FORECAST_COLS)} FROM long WHERE model = 'persistence'", ("t2m", "ts"), long=LONG_SQL))
def f18(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",)).select(*KEYS, "date", F.lit("persistence").alias("model"), F.array_repeat("t2m", 7).alias("scores"))
    return shown(P.long_from_arrays(panel, PANEL_SERIES))


@check("m10_ensemble_mean", with_panel(f"SELECT {cols(FORECAST_COLS)} FROM ens", ("t2m", "ts"), long=LONG_SQL, ens=ENSEMBLE_SQL))
def m10(spark, sf):
    return shown(P.ensemble_mean(long_forecasts(spark, sf), PANEL_SERIES, list(MODEL_VALUES)))


@check("m18_actual_vs_predicted", with_panel(f"SELECT {cols([*FORECAST_COLS, 'actual:f'])} FROM rows", ("t2m", "ts"), **METRICS))
def m18(spark, sf):
    return shown(judged(spark, sf))


E = "(actual - forecast)"
METRIC_SQL = {
    "rmse": f"sqrt(avg({E} * {E}))", "mae": f"avg(abs({E}))",
    "r2": f"1 - sum({E} * {E}) / (count(*) * var_pop(actual))", "mape": f"avg(abs({E} / actual)) * 100",
}


def metric_list(digits=5, names=METRIC_SQL):
    return ", ".join(f"{r(METRIC_SQL[m], digits)} AS {m}" for m in names)


@check("m12_m15_horizon_metrics", with_panel(f"SELECT model, horizon_day, count(*) AS n, {metric_list()} FROM rows GROUP BY model, horizon_day", ("t2m", "ts"), **METRICS))
def m12(spark, sf):
    return shown(ev.horizon_metrics(judged(spark, sf)), 5)


@check(
    "m12_m15_overall_metrics",
    with_panel(
        f"""SELECT model, count(*) AS n, {metric_list(names=('rmse', 'mae', 'mape'))}, (SELECT {r('avg(h.r2)', 5)} FROM
        (SELECT model, horizon_day, {METRIC_SQL['r2']} AS r2 FROM rows GROUP BY 1, 2) h WHERE h.model = rows.model) AS r2
        FROM rows GROUP BY model""", ("t2m", "ts"), **METRICS),
)
def m12_overall(spark, sf):
    return shown(ev.overall_metrics(judged(spark, sf)), 5)


@check("m15_mape_with_eps", with_panel(f"SELECT model, horizon_day, {r(f'avg(abs({E} / (actual + 1e-8))) * 100', 5)} AS mape FROM rows GROUP BY model, horizon_day", ("t2m", "ts"), **METRICS))
def m15(spark, sf):
    return shown(ev.horizon_metrics(judged(spark, sf), eps=1e-8).select("model", "horizon_day", "mape"), 5)


TOL = "SELECT model, horizon_day, tolerance, avg(CASE WHEN abs(actual - forecast) <= tolerance THEN 1.0 ELSE 0.0 END) * 100 AS share FROM rows, (VALUES (0.5::DOUBLE), (1.0::DOUBLE), (1.5::DOUBLE), (2.0::DOUBLE)) v(tolerance) GROUP BY 1, 2, 3"


@check(
    "m16_within_tolerance",
    with_panel(
        f"""SELECT model, horizon_day, {cols(['tolerance:f', 'share:f'])} FROM tol UNION ALL
        SELECT model, 0, {r('tolerance')}, {r('avg(share)')} FROM tol GROUP BY model, tolerance""", ("t2m", "ts"), **METRICS, tol=TOL),
)
def m16(spark, sf):
    return shown(ev.within_tolerance(judged(spark, sf)).na.fill(0, ["horizon_day"]))


@check(
    "m17_compare_models",
    with_panel(
        "SELECT horizon_day, " + ", ".join(f"{r(f'1 - sum({E} * {E}) FILTER (model = ' + repr(m) + f') / (count(*) FILTER (model = {m!r}) * var_pop(actual) FILTER (model = {m!r}))', 5)} AS {m}" for m in (*MODEL_VALUES, "ensemble"))
        + " FROM rows GROUP BY horizon_day", ("t2m", "ts"), **METRICS),
)
def m17(spark, sf):
    return shown(ev.compare_models(judged(spark, sf), [*MODEL_VALUES, "ensemble"], "r2"), 5)


def compared_sql(metric):
    each = ", ".join(f"{r(f'max(x) FILTER (model = {m!r})', 5)} AS {m}" for m in (*MODEL_VALUES, "ensemble"))
    value = f"avg(abs({E} / (actual + 1e-8))) * 100" if metric == "mape_eps" else METRIC_SQL[metric]
    return with_panel(f"SELECT horizon_day, {each} FROM (SELECT model, horizon_day, {value} AS x FROM rows GROUP BY 1, 2) GROUP BY horizon_day", ("t2m", "ts"), **METRICS)


@check("m17_compare_models_rmse", compared_sql("rmse"))
def m17_rmse(spark, sf):
    return shown(ev.compare_models(judged(spark, sf), [*MODEL_VALUES, "ensemble"], "rmse"), 5)


@check("m17_compare_models_mae", compared_sql("mae"))
def m17_mae(spark, sf):
    return shown(ev.compare_models(judged(spark, sf), [*MODEL_VALUES, "ensemble"], "mae"), 5)


# the comparison divides by the actual value plus 1e-8, as its metric does
@check("m17_compare_models_mape", compared_sql("mape_eps"))
def m17_mape(spark, sf):
    return shown(ev.compare_models(judged(spark, sf), [*MODEL_VALUES, "ensemble"], "mape"), 5)


@check(
    "t4_best_and_worst_horizon",
    with_panel(
        f"""SELECT model, arg_min(horizon_day, rmse) AS best_day, {r('min(rmse)', 5)} AS best_rmse, arg_max(horizon_day, rmse) AS worst_day,
        {r('max(rmse)', 5)} AS worst_rmse FROM (SELECT model, horizon_day, {METRIC_SQL['rmse']} AS rmse FROM rows GROUP BY 1, 2) GROUP BY model""", ("t2m", "ts"), **METRICS),
)
def t4(spark, sf):
    return shown(ev.best_and_worst_horizon(ev.horizon_metrics(judged(spark, sf))), 5)


TRUE_PATH = f"SELECT {K}, date, h AS horizon_day, lead(t2m, CAST(h AS INTEGER)) OVER (PARTITION BY {K}, h ORDER BY date) AS forecast FROM panel, range(1, 8) g(h)"


@check(
    "a20_forecast_summary",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r('min(forecast)')} AS min_forecast, {r('max(forecast)')} AS max_forecast,
        {r('avg(forecast)')} AS mean_forecast, CASE WHEN max(forecast) FILTER (horizon_day = 7) > max(forecast) FILTER (horizon_day = 1)
        THEN 'increasing' ELSE 'decreasing' END AS trend,
        {r('abs(max(forecast) FILTER (horizon_day = 7) - max(forecast) FILTER (horizon_day = 1))')} AS change
        FROM (SELECT * FROM ahead WHERE forecast IS NOT NULL) GROUP BY {K}, date HAVING count(*) = 7""", ("t2m",), ahead=TRUE_PATH),
)
def a20(spark, sf):
    targets = add_targets(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, {"t2m": "t2m"}).na.drop()
    rows = P.to_long(targets.withColumn("model", F.lit("truth")), PANEL_SERIES, P.forecast_names())
    return shown(ev.forecast_summary(rows, [*KEYS, "date"]))


# evland is left out: here it is gwettop times 100, and equal scores have no order of their own
LISTED = ("t2m_max", "t2m_min", "ts", "evptrns", "gwettop", "prectotcorr", "ws10m")


@check(
    "m8_feature_list",
    with_panel(
        "SELECT CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank, feature FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, t2m) AS r FROM panel" for c in LISTED) + ")", ("t2m", *LISTED)),
)
def m8(spark, sf):
    ranked = correlations(daily_panel(spark, sf, ("t2m", *LISTED)), LISTED, "t2m").select("feature").collect()
    table = lists.feature_table(spark, [row.feature for row in ranked])
    return lists.from_json(lists.to_json(table))


# --- trained models -------------------------------------------------------------------------
# What a model predicts has no SQL twin.  Which rows it is judged on has, and so has what any sound model must show:
# every feature ranked once, errors ordered, and fewer errors than the forecast that tomorrow is like today.

BASE = ("t2m", "t2m_max", "t2m_min", "ts", "gwettop", "evptrns")
TARGETS = target_names(["t2m"])
small_forest = partial(M.random_forest, numTrees=8, maxDepth=4)
small_boost = partial(M.boosted_trees, maxIter=4, maxDepth=3, stepSize=0.3)
other_boost = partial(M.boosted_trees, maxIter=4, maxDepth=2, stepSize=0.5, subsamplingRate=0.8)


def modelling_table(spark, sf):
    """Lags and targets of the panel, written once because every fit reads it."""
    panel = add_targets(daily_panel(spark, sf, BASE), PANEL_SERIES, {"t2m": "t2m"})
    return written(panel.na.drop(), "modelling")


def parts(table):
    split = chronological_split(table, PANEL_SERIES)
    return split.where("part = 'train'"), split.where("part = 'validation'"), split.where("part = 'test'")


def beats_persistence(rows, test):
    """Rows a horizon, and whether the model beats persistence there."""
    naive = ev.horizon_metrics(
        test.select("t2m", F.explode(F.array(*[
            F.struct(F.lit(h).alias("horizon_day"), F.col(t).alias("actual")) for h, t in enumerate(TARGETS, start=1)
        ])).alias("e")).select(F.lit("naive").alias("model"), "e.*", F.col("t2m").alias("forecast"))
    ).select("horizon_day", F.col("rmse").alias("naive"))
    metrics = ev.horizon_metrics(rows).join(naive, "horizon_day")
    return shown(metrics.select("model", "horizon_day", "n", (F.col("rmse") < F.col("naive")).alias("beats_persistence")))


def judged_sql(*names):
    return with_panel(
        f"""SELECT model, CAST(h AS INTEGER) AS horizon_day, n, 1 AS beats_persistence
        FROM (SELECT count(*) AS n FROM idx WHERE i < n - 7 AND i >= CAST(floor((n - 7) * CAST(0.9 AS DOUBLE)) AS BIGINT)),
        range(1, 8) g(h), (VALUES {", ".join(f"('{n}')" for n in names)}) m(model)""", ("t2m",), idx=INDEXED)


def scored_with(spark, sf, name, make):
    train, _, test = parts(modelling_table(spark, sf))
    fitted = M.fit_horizons(train, BASE, TARGETS, make)
    return beats_persistence(M.score_long(test, fitted, BASE, name, list(KEYS), "date"), test)


@check("m3_feature_importance", f"""SELECT CAST(i AS INTEGER) AS rank, 1 AS in_order, 1 AS once, CAST({len(BASE)} AS BIGINT) AS features, 1 AS sums_to_one
FROM range(1, {len(BASE) + 1}) g(i)""")
def m3(spark, sf):
    train, _, _ = parts(modelling_table(spark, sf))
    model = M.fit_horizons(train, BASE, TARGETS[-1:], small_boost)[TARGETS[-1]]
    ranked = M.feature_importance(model, BASE, spark)
    along, whole = Window.orderBy("rank"), Window.partitionBy(F.lit(1))
    return shown(ranked.select(
        "rank", F.coalesce(F.lag("importance").over(along) >= F.col("importance"), F.lit(True)).alias("in_order"),
        (F.col("feature").isin(*BASE) & (F.count("*").over(Window.partitionBy("feature")) == 1)).alias("once"),
        F.count("*").over(whole).alias("features"), (F.abs(F.sum("importance").over(whole) - 1) < 1e-9).alias("sums_to_one"),
    ))


@check("m4_random_forest", judged_sql("randomforest"))
def m4(spark, sf):
    return scored_with(spark, sf, "randomforest", small_forest)


@check("m5_boosted_trees", judged_sql("boosted"))
def m5(spark, sf):
    return scored_with(spark, sf, "boosted", small_boost)


@check("m6_parameter_search", """SELECT CAST(i AS INTEGER) AS rank, 1 AS in_order, 1 AS tried_once, 1 AS has_error FROM range(1, 5) g(i)""")
def m6(spark, sf):
    train, validation, _ = parts(modelling_table(spark, sf))
    tried = M.search(train, validation, BASE, TARGETS, M.random_forest, {"numTrees": [4, 8], "maxDepth": [2, 4]}, "date")
    rows = [(i, t["params"]["numTrees"], t["params"]["maxDepth"], float(t["rmse"])) for i, t in enumerate(tried, start=1)]
    table = spark.createDataFrame(rows, "rank int, trees int, depth int, rmse double")
    return shown(table.select(
        "rank", F.coalesce(F.lag("rmse").over(Window.orderBy("rank")) <= F.col("rmse"), F.lit(True)).alias("in_order"),
        (F.count("*").over(Window.partitionBy("trees", "depth")) == 1).alias("tried_once"), (F.col("rmse") > 0).alias("has_error"),
    ))


# what a trained model predicts has no SQL twin; which rows get a prediction has
@check(
    "m7_m9_saved_models_score",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, 1 AS has_d1, 1 AS has_d2 FROM idx
        WHERE i < n - 7 AND i >= CAST(floor((n - 7) * CAST(0.9 AS DOUBLE)) AS BIGINT)""", ("t2m",), idx=INDEXED),
)
def m7(spark, sf):
    train, _, test = parts(modelling_table(spark, sf))
    path = shared_path(spark, "models")
    M.save_models(M.fit_horizons(train, BASE, TARGETS[:2], small_forest), path)
    scores = M.score(test, M.load_models(spark, path, TARGETS[:2]), BASE, [*KEYS, "date"])
    return shown(scores.select(*KEYS, "date", *[F.col(t).between(1, 50).alias(f"has_d{h}") for h, t in enumerate(TARGETS[:2], start=1)]))


@check(
    "m7_m9_all_saved_models_score",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {", ".join(f"1 AS has_d{h}" for h in DAYS)} FROM idx
        WHERE i < n - 7 AND i >= CAST(floor((n - 7) * CAST(0.9 AS DOUBLE)) AS BIGINT)""", ("t2m",), idx=INDEXED),
)
def m7_all(spark, sf):
    train, _, test = parts(modelling_table(spark, sf))
    path = shared_path(spark, "models")
    M.save_models(M.fit_horizons(train, BASE, TARGETS, small_forest), path)
    scores = M.score(test, M.load_models(spark, path, TARGETS), BASE, [*KEYS, "date"])
    return shown(scores.select(*KEYS, "date", *[F.col(t).between(1, 50).alias(f"has_d{h}") for h, t in enumerate(TARGETS, start=1)]))


@check("c6_train_and_evaluate", judged_sql("boosted", "ensemble", "randomforest"))
def c6(spark, sf):
    """Rank, search, refit with the best parameters, evaluate: all seven horizons."""
    panel = add_targets(daily_panel(spark, sf, BASE), PANEL_SERIES, {"t2m": "t2m"})
    makers = {"randomforest": partial(M.random_forest, numTrees=8), "boosted": partial(M.boosted_trees, maxIter=4, stepSize=0.3)}
    grids = {"randomforest": {"maxDepth": [2, 4]}, "boosted": {"maxDepth": [2, 3]}}
    _, _, rows = fc.train_and_evaluate(panel, PANEL_SERIES, BASE, TARGETS, makers, top_k=4, ranker=small_boost, grids=grids)
    _, _, test = parts(written(panel.na.drop(), "modelling"))
    return beats_persistence(rows, test)


@check(
    "c7_forecast_and_store",
    with_panel(
        f"""SELECT {K}, strftime(last, '%Y-%m-%d') AS date, strftime(last + CAST(h AS INTEGER), '%Y-%m-%d') AS target_date,
        CAST(h AS INTEGER) AS horizon_day, model, 1 AS has_forecast, 0 AS has_actual
        FROM (SELECT {K}, max(date) AS last FROM panel GROUP BY {K}), range(1, 8) g(h),
        (VALUES ('randomforest'), ('boosted'), ('ensemble')) m(model)""", ("t2m",)),
)
def c7(spark, sf):
    truth = daily_panel(spark, sf, BASE)
    panel = add_targets(truth, PANEL_SERIES, {"t2m": "t2m"})
    makers = {"randomforest": small_forest, "boosted": other_boost}
    fitted, used, _ = fc.train_and_evaluate(panel, PANEL_SERIES, BASE, TARGETS, makers)
    name = unique("forecasts")
    rows = fc.forecast_latest(truth, PANEL_SERIES, used, fitted)
    fc.save_forecast(spark, rows, truth, PANEL_SERIES, "t2m", name, shared_path(spark, name))
    return shown(read_store(spark, name).select(
        *KEYS, "date", "target_date", "horizon_day", "model", F.col("forecast").between(1, 50).alias("has_forecast"),
        F.col("actual").isNotNull().alias("has_actual"),
    ))
