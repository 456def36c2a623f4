"""Models trained on the feature store: all its columns, all horizons.

What a model predicts has no SQL twin.  Which rows it learns from and is judged on has: SQL builds the same store, splits it and
counts.  So has what any sound model must show: errors that fall, and fewer of them than the forecast that
tomorrow is like today.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.common import KEYS, PANEL_SERIES, check, panel_sql, shown
from checks.evaluation import beats_persistence
from checks.features import carried_sql, clean_panel
from checks.sources import unique
from daygrain.operators import boosting as B
from daygrain.operators import search as S
from daygrain.operators.artefact import Artefact, RangeScaler
from daygrain.operators.splits import chronological_split
from daygrain.operators.store import read_store
from daygrain.operators.windows import add_targets, target_names
from daygrain.plans import forecasting as fc
from daygrain.plans.features import feature_columns, temperature_features
from daygrain.session import shared_path, written

K = ", ".join(KEYS)
TARGETS = target_names(["t2m"])
# few and strong trees: the work of a full run is the same, only longer
QUICK = B.Params(rounds=3, leaves=6, learning_rate=0.6, least_rows=20)
BINS = 63


def store_table(spark, sf):
    """The feature store with its targets, split by time; written once because every pass reads it."""
    clean = add_targets(clean_panel(spark, sf), PANEL_SERIES, {"t2m": "t2m"})
    table = temperature_features(clean, PANEL_SERIES, carry=TARGETS)
    return written(chronological_split(written(table, "store"), PANEL_SERIES), "modelling")


def store_features(table):
    return [c for c in feature_columns(table) if c not in ("row_idx", "part")]


PARTS_SQL = f"""parts AS (SELECT *, CASE WHEN i >= cut THEN 'test' WHEN i >= CAST(floor(cut * CAST(0.8 AS DOUBLE)) AS BIGINT)
  THEN 'validation' ELSE 'train' END AS part FROM (SELECT *, CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT) AS cut FROM (
    SELECT {K}, date, t2m, row_number() OVER (PARTITION BY {K} ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY {K}) AS n FROM kept)))"""


def store_sql(body: str) -> str:
    return f"WITH kept AS ({carried_sql(TARGETS)}), {PARTS_SQL} {body}"


def long_scores(table, wide, name):
    """Forecast rows of scored columns p_<target>."""
    entries = F.array(*[
        F.struct(F.lit(h).alias("horizon_day"), F.col(f"p_{t}").alias("forecast"), F.col(t).alias("actual")) for h, t in enumerate(TARGETS, start=1)
    ])
    return wide.select(*KEYS, "date", F.explode(entries).alias("e")).select(F.lit(name).alias("model"), *KEYS, "date", "e.*")


@check(
    "m3_split_importance",
    store_sql("""SELECT CAST(i AS INTEGER) AS rank, (SELECT count(*) FROM parts WHERE part <> 'test') AS learnt_rows, 1 AS in_order, 1 AS once
    FROM range(1, 201) g(i)"""),
)
def m3_splits(spark, sf):
    """Columns by how often the trees of the last horizon split them: the first 200, those never split by name."""
    table = store_table(spark, sf)
    features = store_features(table)
    data = B.binned(table.where("part <> 'test'"), features, TARGETS[-1:], bins=BINS)
    growths, _ = B.train(data, [B.Job("boosted", TARGETS[-1], QUICK)])
    nodes = written(B.nodes_table(spark, data, growths), "nodes")
    ranked = B.importance(nodes, features).where("rank <= 200")
    learnt = nodes.where("round >= 0 and node = 0").groupBy("model").agg(F.min("rows").alias("learnt_rows"))
    along = Window.partitionBy("model").orderBy("rank")
    return shown(ranked.join(learnt, "model").select(
        "rank", "learnt_rows", F.coalesce(F.lag("splits").over(along) >= F.col("splits"), F.lit(True)).alias("in_order"),
        (F.count("*").over(Window.partitionBy("model", "feature")) == 1).alias("once"),
    ))


JUDGED = store_sql("""SELECT 'boosted' AS model, CAST(h AS INTEGER) AS horizon_day, (SELECT count(*) FROM parts WHERE part = 'test') AS n, 1 AS beats_persistence
FROM range(1, 8) g(h)""")


@check("m5_store_boosted_trees", JUDGED)
def m5_store(spark, sf):
    """All seven horizons in one training, judged on the test part."""
    table = store_table(spark, sf)
    features = store_features(table)
    data = B.binned(table.where("part <> 'test'"), features, TARGETS, bins=BINS)
    growths, _ = B.train(data, [B.Job("boosted", t, QUICK) for t in TARGETS])
    test = table.where("part = 'test'")
    nodes = written(B.nodes_table(spark, data, growths), "nodes")
    wide = B.score(test, nodes, features, [*KEYS, "date", "t2m", *TARGETS], lambda _, t: f"p_{t}")
    return beats_persistence(long_scores(table, wide, "boosted"), test)


@check(
    "m5_loss_by_round",
    store_sql("""SELECT target, CAST(r AS INTEGER) AS trees, (SELECT count(*) FROM parts WHERE part = 'train') AS learnt_rows,
    (SELECT count(*) FROM parts WHERE part = 'validation') AS judged_rows, 1 AS falls
    FROM range(0, 4) g(r), (VALUES """ + ", ".join(f"('{t}')" for t in TARGETS) + """) v(target)"""),
)
def m5_losses(spark, sf):
    """The training error after each round, which falls with every tree."""
    table = store_table(spark, sf).where("part <> 'test'").withColumn("later", F.col("part") == "validation")
    features = [c for c in store_features(table) if c != "later"]
    data = B.binned(table, features, TARGETS, "later", bins=BINS)
    _, errors = B.train(data, [B.Job("boosted", t, QUICK) for t in TARGETS])
    rows = spark.createDataFrame([(TARGETS[i], trees, data.rows, data.judged, float(e)) for i, trees, e, _ in errors],
                                 "target string, trees int, learnt_rows bigint, judged_rows bigint, error double")
    along = Window.partitionBy("target").orderBy("trees")
    return shown(rows.withColumn("falls", F.coalesce(F.lag("error").over(along) > F.col("error"), F.lit(True))).drop("error"))


NARROW = {
    "rounds": S.Range(2, 5, whole=True), "learning_rate": S.Range(0.05, 0.5, log=True), "depth": S.Range(2, 6, whole=True),
    "leaves": S.Range(3, 8, whole=True), "rows": S.SPACE["rows"], "columns": S.SPACE["columns"], "l1": S.SPACE["l1"], "l2": S.SPACE["l2"],
    "least_rows": S.SPACE["least_rows"],
}


@check(
    "m6_adaptive_search",
    store_sql("""SELECT CAST(i AS INTEGER) AS rank, (SELECT count(*) FROM parts WHERE part = 'validation') AS judged_rows,
    1 AS in_order, 1 AS tried_once, 1 AS in_range, 1 AS has_error FROM range(1, 9) g(i)"""),
)
def m6_adaptive(spark, sf):
    """Eight trials, four side by side, all horizons; proposals look at earlier trials from the fifth on."""
    table = store_table(spark, sf).where("part <> 'test'").withColumn("later", F.col("part") == "validation")
    features = [c for c in store_features(table) if c != "later"]
    data = B.binned(table, features, TARGETS, "later", bins=BINS)
    tried = S.trials_table(spark, S.search(data, TARGETS, NARROW, 8, 4, (2, 3), random=4), NARROW)
    along = Window.partitionBy("stopped").orderBy("rank")
    inside = F.lit(True)
    for name, r in NARROW.items():
        inside = inside & F.col(name).between(r.low, r.high)
    return shown(tried.select(
        "rank", F.lit(data.judged).cast("bigint").alias("judged_rows"), F.coalesce(F.lag("rmse").over(along) <= F.col("rmse"), F.lit(True)).alias("in_order"),
        (F.count("*").over(Window.partitionBy("trial")) == 1).alias("tried_once"), inside.alias("in_range"), (F.col("rmse") > 0).alias("has_error"),
    ))


@check(
    "m7_saved_artefact",
    store_sql(f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, 1 AS same_scores, 1 AS plausible FROM parts WHERE part = 'test'"""),
)
def m7_artefact(spark, sf):
    """Scaler, columns and trees saved and loaded again: the same scores, row by row."""
    table = store_table(spark, sf)
    features = store_features(table)
    learn, test = table.where("part <> 'test'"), table.where("part = 'test'")
    scaler = RangeScaler.fitted(learn, features)
    data = B.binned(scaler.transform(learn), features, TARGETS[:2], bins=BINS)
    growths, _ = B.train(data, [B.Job("boosted", t, QUICK) for t in TARGETS[:2]])
    made = Artefact(features, list(TARGETS[:2]), B.nodes_table(spark, data, growths), scaler=scaler)
    path = shared_path(spark, "artefact")
    made.save(path)
    before = made.score(test, "boosted", [*KEYS, "date"])
    after = Artefact.load(spark, path).score(test, "boosted", [*KEYS, "date"]).withColumnsRenamed({t: f"again_{t}" for t in TARGETS[:2]})
    both = before.join(after, [*KEYS, "date"])
    same = (F.col(TARGETS[0]) == F.col(f"again_{TARGETS[0]}")) & (F.col(TARGETS[1]) == F.col(f"again_{TARGETS[1]}"))
    return shown(both.select(*KEYS, "date", same.alias("same_scores"), F.col(TARGETS[0]).between(1, 50).alias("plausible")))


@check(
    "c6_store_train_and_evaluate",
    store_sql("""SELECT model, CAST(h AS INTEGER) AS horizon_day, (SELECT count(*) FROM parts WHERE part = 'test') AS n, 1 AS beats_persistence
    FROM range(1, 8) g(h), (VALUES ('first'), ('second'), ('ensemble')) m(model)"""),
)
def c6_store(spark, sf):
    """From the store to the judged ensemble: the 200 best columns, a search for one model, a second model, their mean."""
    table = store_table(spark, sf)
    result = fc.train_boosted(
        table.drop("part", "row_idx"), PANEL_SERIES, TARGETS, {"first": QUICK, "second": B.Params(rounds=3, leaves=5, learning_rate=0.6, columns=0.7, rows=0.8)},
        top_k=200, ranker=QUICK, space={"first": {"learning_rate": S.Range(0.3, 0.8, log=True), "leaves": S.Range(4, 8, whole=True)}}, trials=3, bins=BINS,
    )
    return beats_persistence(result.scores, table.where("part = 'test'"))


@check(
    "c7_store_forecast",
    store_sql(f"""SELECT {K}, strftime(last, '%Y-%m-%d') AS date, strftime(last + CAST(h AS INTEGER), '%Y-%m-%d') AS target_date,
    CAST(h AS INTEGER) AS horizon_day, 'boosted' AS model, 1 AS has_forecast, CAST(count(*) FILTER (days.date = last + CAST(h AS INTEGER)) AS INTEGER) AS has_actual
    FROM (SELECT {K}, max(date) AS last FROM parts GROUP BY {K}) CROSS JOIN range(1, 8) g(h)
    LEFT JOIN (SELECT {K}, date FROM ({panel_sql(("t2m",))})) days USING ({K}) GROUP BY {K}, last, h"""),
)
def c7_store(spark, sf):
    """The newest row of the training store forecast by a saved artefact, stored, and filled with the days that are known since."""
    table = store_table(spark, sf)
    features = store_features(table)
    data = B.binned(table, features, TARGETS, bins=BINS)
    growths, _ = B.train(data, [B.Job("boosted", t, QUICK) for t in TARGETS])
    path, name = shared_path(spark, "artefact"), unique("forecasts")
    Artefact(features, list(TARGETS), B.nodes_table(spark, data, growths)).save(path)
    rows = fc.forecast_with(Artefact.load(spark, path), table, PANEL_SERIES)
    fc.save_forecast(spark, rows, clean_panel(spark, sf), PANEL_SERIES, "t2m", name, shared_path(spark, name))
    return shown(read_store(spark, name).select(
        *KEYS, "date", "target_date", "horizon_day", "model", F.col("forecast").between(1, 50).alias("has_forecast"),
        F.col("actual").isNotNull().alias("has_actual"),
    ))
