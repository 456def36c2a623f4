"""Train, evaluate, forecast, and keep the forecast table."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import boosting, evaluate, models
from daygrain.operators.artefact import Artefact
from daygrain.operators.merging import fill_actuals
from daygrain.operators.predictions import ensemble_mean, horizon_of
from daygrain.operators.search import Range, Trial, search
from daygrain.operators.splits import chronological_split
from daygrain.operators.store import backfill_in, create_store, upsert_into
from daygrain.operators.windows import latest_row
from daygrain.plans.features import feature_columns
from daygrain.series import Series
from daygrain.session import written
from daygrain.sources.tables import require_columns


def train_and_evaluate(
    features_table: DataFrame, series: Series, features: Sequence[str], targets: Sequence[str],
    makers: Mapping[str, Callable[..., object]], top_k: int | None = None, ranker: Callable[[], object] | None = None,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
) -> tuple[dict[str, dict[str, Model]], list[str], DataFrame]:
    """Chronological split, optional top-k features by importance, one model set per maker.

    A maker with a grid in ``grids`` is searched on the validation part, the last fifth of the training rows, and its
    final models are fitted on all training rows with the best parameters.

    Returns the models, the features used, and the forecast rows of the test part (with the
    ensemble of all makers) ready for the metrics.  The table and the scores are written once to
    the shared folder: every fit reads the one, every metric the other.
    """
    needed = dict.fromkeys([*series.keys, series.time, *series.tie, *features, *targets])
    complete = features_table.select(*needed).na.drop()
    table = written(chronological_split(complete, series), "modelling")
    train, test = table.where("part <> 'test'"), table.where("part = 'test'")
    earlier, validation = table.where("part = 'train'"), table.where("part = 'validation'")
    chosen = list(features)
    if top_k is not None:
        last = targets[-1]
        ranked = models.fit_horizons(train, chosen, [last], ranker or models.boosted_trees)[last]
        order = models.feature_importance(ranked, chosen, table.sparkSession).limit(top_k).collect()
        chosen = [row.feature for row in order]
    best = {
        name: models.search(earlier, validation, chosen, targets, makers[name], grid, series.time)[0]["params"]
        for name, grid in (grids or {}).items()
    }
    fitted = {name: models.fit_horizons(train, chosen, targets, partial(make, **best.get(name, {}))) for name, make in makers.items()}
    rows = None
    for name, per_target in fitted.items():
        scored = models.score_long(test, per_target, chosen, name, list(series.keys), series.time)
        rows = scored if rows is None else rows.unionByName(scored)
    rows = written(rows, "scores")
    if len(fitted) > 1:
        rows = with_ensemble(rows, series, list(fitted))
    return fitted, chosen, rows


@dataclass
class Boosted:
    """What :func:`train_boosted` made: the artefact, the scores of the test part, the ranked columns and the trials by model."""

    artefact: Artefact
    scores: DataFrame
    ranking: DataFrame | None
    trials: dict[str, list[Trial]]


def train_boosted(
    store: DataFrame, series: Series, targets: Sequence[str], makers: Mapping[str, boosting.Params], features: Sequence[str] | None = None,
    top_k: int | None = 200, ranker: boosting.Params = boosting.Params(), space: Mapping[str, Mapping[str, Range]] | None = None, trials: int = 100,
    side_by_side: int = 4, rungs: Sequence[int] = (10, 30, 90, 270), bins: int = boosting.BINS,
) -> Boosted:
    """From a feature store with targets to judged models of all horizons.

    Rows are split by time.  The columns that trees of the last horizon split most often are kept (``top_k``); models with a
    ``space`` are searched on the validation part; all models and horizons are then trained in one run on everything before
    the test part.  The scores hold every model and their mean (``ensemble``).
    """
    chosen = list(features) if features is not None else feature_columns(store)
    needed = dict.fromkeys([*series.keys, series.time, *series.tie, *chosen, *targets])
    table = written(chronological_split(store.select(*needed).na.drop(), series).withColumn("__later", F.col("part") == "validation"), "modelling")
    learn, test = table.where("part <> 'test'"), table.where("part = 'test'")
    spark, ranking = store.sparkSession, None
    if top_k is not None:
        data = boosting.binned(learn, chosen, targets[-1:], bins=bins)
        grown, _ = boosting.train(data, [boosting.Job("ranker", targets[-1], ranker)])
        ranking = written(boosting.importance(boosting.nodes_table(spark, data, grown), chosen), "importance")
        chosen = [r.feature for r in ranking.where(F.col("rank") <= top_k).orderBy("rank").collect()]  # a row a column
    found, best = {}, dict(makers)
    if space:
        judged = boosting.binned(learn, chosen, targets, "__later", bins)
        for name, ranges in space.items():
            found[name] = search(judged, targets, ranges, trials, side_by_side, rungs, base=makers[name])
            best[name] = dataclasses.replace(found[name][0].params)
    data = boosting.binned(learn, chosen, targets, bins=bins)
    grown, _ = boosting.train(data, [boosting.Job(name, t, params) for name, params in best.items() for t in targets])
    nodes = written(boosting.nodes_table(spark, data, grown), "nodes")
    artefact = Artefact(chosen, list(targets), nodes, notes={n: dataclasses.asdict(p) for n, p in best.items()})
    rows = written(_long(artefact, test, series, list(targets)), "scores")
    if len(best) > 1:
        rows = with_ensemble(rows, series, list(best))
    return Boosted(artefact, rows, ranking, found)


def _long(artefact: Artefact, df: DataFrame, series: Series, known: Sequence[str] = ()) -> DataFrame:
    """Forecast rows of all models of an artefact in one pass; ``known`` names target columns that hold the actual values."""
    keep = [*series.keys, series.time]
    rows = artefact.prepared(df)
    label = lambda model, target: f"__p_{artefact.names.index(model)}_{target}"
    held = [F.col(t).alias(f"__a_{t}") for t in known]
    scored = boosting.score(rows.select("*", *held), artefact.boosted, artefact.features, [*keep, *[f"__a_{t}" for t in known]], label)
    entries = F.array(*[
        F.struct(
            F.lit(model).alias("model"), F.lit(horizon_of(t)).alias("horizon_day"), F.col(label(model, t)).alias("forecast"),
            (F.col(f"__a_{t}") if t in known else F.lit(None).cast("double")).alias("actual"),
        )
        for model in artefact.names for t in artefact.targets
    ])
    long = scored.select(*series.keys, F.col(series.time).alias("date"), F.explode(entries).alias("e"))
    return long.select(
        *series.keys, "e.model", "date", F.date_add("date", F.col("e.horizon_day")).alias("target_date"), "e.horizon_day", "e.forecast", "e.actual",
    )


def forecast_with(artefact: Artefact, store: DataFrame, series: Series) -> DataFrame:
    """Forecast rows of every boosted model of an artefact, and of their mean, from the newest row of each series."""
    require_columns(store, artefact.features)
    needed = dict.fromkeys([*series.keys, series.time, *series.tie, *artefact.features])
    newest = written(latest_row(store.select(*needed), series), "newest")
    rows = _long(artefact, newest, series).drop("actual")
    if len(artefact.names) > 1:
        rows = rows.unionByName(ensemble_mean(rows, series, artefact.names).select(*rows.columns))
    return rows


def with_ensemble(rows: DataFrame, series: Series, names: Sequence[str]) -> DataFrame:
    """Forecast rows of the single models and of their unweighted mean."""
    mean = ensemble_mean(rows, series, names)
    truth = rows.groupBy(*series.keys, "date", "horizon_day").agg(F.max("actual").alias("actual"))
    joined = mean.join(truth, [*series.keys, "date", "horizon_day"])
    return rows.unionByName(joined.select(*rows.columns))


def metrics_report(rows: DataFrame) -> dict[str, DataFrame]:
    per_horizon = evaluate.horizon_metrics(rows)
    return {
        "per_horizon": per_horizon,
        "overall": evaluate.overall_metrics(rows),
        "tolerance": evaluate.within_tolerance(rows),
        "extremes": evaluate.best_and_worst_horizon(per_horizon),
    }


def forecast_latest(
    features_table: DataFrame, series: Series, features: Sequence[str], fitted: Mapping[str, Mapping[str, Model]]
) -> DataFrame:
    """Forecast rows of every model and the ensemble from the newest row of each series."""
    require_columns(features_table, features)
    needed = dict.fromkeys([*series.keys, series.time, *series.tie, *features])
    newest = written(latest_row(features_table.select(*needed), series), "newest")
    rows = None
    for name, per_target in fitted.items():
        scored = models.score_long(newest, per_target, features, name, list(series.keys), series.time)
        rows = scored if rows is None else rows.unionByName(scored)
    rows = rows.drop("actual")
    if len(fitted) > 1:
        rows = rows.unionByName(ensemble_mean(rows, series, list(fitted)).select(*rows.columns))
    return rows


def save_forecast(
    spark: SparkSession, forecasts: DataFrame, truth: DataFrame, series: Series, value: str, table: str,
    path: str | None = None, since: str | None = None,
) -> None:
    """Fill known actual values, upsert the rows into the store, then back-fill older rows (from ``since`` on)."""
    create_store(spark, table, series.keys, path, forecasts)
    new = fill_actuals(forecasts.withColumn("actual", F.lit(None).cast("double")), truth, series, value)
    upsert_into(spark, table, written(new, "forecasts"), [*series.keys, "date", "target_date", "model"])
    backfill_in(spark, table, truth, series, value, since)
