"""Multi-horizon regressors: one Spark ML model per target column."""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.predictions import horizon_of

VECTOR = "__features"
LOADERS = {"GBTRegressionModel": GBTRegressionModel, "RandomForestRegressionModel": RandomForestRegressionModel}


def random_forest(**params) -> RandomForestRegressor:
    """Defaults follow the tuned forest: depth 9, at least 7 rows per leaf, sqrt of the features."""
    chosen = {
        "numTrees": 888, "maxDepth": 9, "minInstancesPerNode": 7, "featureSubsetStrategy": "sqrt", "seed": 42, **params,
    }
    return RandomForestRegressor(featuresCol=VECTOR, **chosen)


def boosted_trees(**params) -> GBTRegressor:
    """Gradient boosting; give each boosted model of an ensemble its own parameters."""
    chosen = {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "seed": 42, **params}
    return GBTRegressor(featuresCol=VECTOR, **chosen)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error").transform(df)


def fit_horizons(
    train: DataFrame, features: Sequence[str], targets: Sequence[str], make: Callable[[], object]
) -> dict[str, Model]:
    """One model per target, all on the same assembled rows."""
    with assembled(train, features, targets) as rows:
        return _fit(rows, targets, make)


@contextmanager
def assembled(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> Iterator[DataFrame]:
    """Complete rows as feature vectors and targets, held while models are fitted on them."""
    rows = assemble(df.select(*features, *targets).na.drop(), features).select(VECTOR, *targets)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, targets: Sequence[str], make: Callable[[], object]) -> dict[str, Model]:
    return {t: make().setLabelCol(t).setPredictionCol("prediction").fit(rows) for t in targets}


def score(df: DataFrame, models: Mapping[str, Model], features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and one prediction column per target, named like the target."""
    scored = assemble(df, features)
    for target, model in models.items():
        scored = model.copy().setPredictionCol(f"__p_{target}").transform(scored)
    return scored.select(*keep, *[F.col(f"__p_{t}").alias(t) for t in models])


def score_long(
    df: DataFrame, models: Mapping[str, Model], features: Sequence[str], name: str, keep: Sequence[str], time: str
) -> DataFrame:
    """Scores as forecast rows; the true value rides along when the target columns are present."""
    actual = [F.col(t).alias(f"__a_{t}") for t in models if t in df.columns]
    rows = df.select("*", *actual)
    kept = [*dict.fromkeys([*keep, time]), *[f"__a_{t}" for t in models if t in df.columns]]
    wide = score(rows, models, features, kept)
    entries = F.array(*[
        F.struct(
            F.lit(horizon_of(t)).alias("horizon_day"), F.col(t).alias("forecast"),
            (F.col(f"__a_{t}") if t in df.columns else F.lit(None).cast("double")).alias("actual"),
        )
        for t in models
    ])
    long = wide.select(*keep, F.col(time).alias("date"), F.explode(entries).alias("e"))
    return long.select(
        *keep, F.lit(name).alias("model"), "date", F.date_add("date", F.col("e.horizon_day")).alias("target_date"),
        "e.horizon_day", "e.forecast", "e.actual",
    )


def feature_importance(model: Model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Rank, name and importance of each feature; ties are broken by name."""
    pairs = sorted(zip(features, model.featureImportances.toArray()), key=lambda p: (-p[1], p[0]))
    rows = [(i, name, float(value)) for i, (name, value) in enumerate(pairs, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def pooled_rmse(rows: DataFrame) -> float:
    error = F.col("actual") - F.col("forecast")
    return rows.agg(F.sqrt(F.avg(error * error))).first()[0]


def search(
    train: DataFrame, validation: DataFrame, features: Sequence[str], targets: Sequence[str],
    make: Callable[..., object], grid: Mapping[str, Sequence], time: str,
) -> list[dict]:
    """Every combination of the grid, fitted on the training rows and ordered by the RMSE over all
    horizons of the (later) validation rows.  Ready-made splitters draw rows at random, which
    would let a model see days after those it is judged on."""
    tried = []
    with assembled(train, features, targets) as rows:
        for values in itertools.product(*grid.values()):
            params = dict(zip(grid, values))
            models = _fit(rows, targets, lambda: make(**params))
            judged = score_long(validation.na.drop(subset=list(targets)), models, features, "trial", [], time)
            tried.append({"params": params, "rmse": pooled_rmse(judged)})
    return sorted(tried, key=lambda t: t["rmse"])


def save_models(models: Mapping[str, Model], path: str) -> None:
    for target, model in models.items():
        model.write().overwrite().save(f"{path}/{target}")


def load_models(spark: SparkSession, path: str, targets: Sequence[str]) -> dict[str, Model]:
    """Models saved by :func:`save_models`; the class is read from each model's metadata."""
    loaded = {}
    for target in targets:
        meta = json.loads(spark.read.text(f"{path}/{target}/metadata").first()[0])
        loaded[target] = LOADERS[meta["class"].rsplit(".", 1)[-1]].load(f"{path}/{target}")
    return loaded
