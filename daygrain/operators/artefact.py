"""One saved artefact of a forecaster: columns it needs, scaling, models of all horizons, and a manifest that names them.

    <path>/manifest   one JSON text: columns, targets, and for each model its kind and where its parts lie
    <path>/scaler     (feature, low, high), if values are scaled
    <path>/<model>    nodes of boosted trees, or a saved model a target
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import keyword_only
from pyspark.ml import Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import boosting
from daygrain.operators import models as M
from daygrain.sources.tables import require_columns

FORMAT = 1


class StrictColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Passes rows on if all ``columns`` are there; otherwise the error names those that are missing."""

    columns = Param(Params._dummy(), "columns", "columns that must be there", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, self.getOrDefault(self.columns))
        return dataset


class RangeScaler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Each column to 0 at its ``lows`` and 1 at its ``highs``; a column whose bounds are equal is 0, as when it was fitted."""

    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    lows = Param(Params._dummy(), "lows", "values that become 0", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "values that become 1", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None, lows: Sequence[float] | None = None, highs: Sequence[float] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @staticmethod
    def fitted(train: DataFrame, columns: Sequence[str]) -> "RangeScaler":
        """Bounds of the training rows, found in one pass; a column without values keeps its scale."""
        ends = train.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("a", F.min), ("b", F.max))]).first()
        lows = [ends[f"a{i}"] if ends[f"a{i}"] is not None else 0.0 for i in range(len(columns))]
        highs = [ends[f"b{i}"] if ends[f"b{i}"] is not None else 1.0 for i in range(len(columns))]
        return RangeScaler(columns=list(columns), lows=lows, highs=highs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        made = {}
        for c, low, high in zip(self.getOrDefault(self.columns), self.getOrDefault(self.lows), self.getOrDefault(self.highs)):
            value = F.col(f"`{c}`").cast("double")
            made[c] = (value - low) / (high - low) if high > low else F.when(value.isNotNull(), F.lit(0.0))
        return dataset.withColumns(made)


@dataclass
class Artefact:
    """``boosted``: nodes of boosted trees (all models in one table); ``fitted``: Spark models by model and target."""

    features: list[str]
    targets: list[str]
    boosted: DataFrame | None = None
    fitted: Mapping[str, Mapping[str, Model]] = field(default_factory=dict)
    scaler: RangeScaler | None = None
    notes: Mapping[str, object] = field(default_factory=dict)

    @cached_property
    def names(self) -> list[str]:
        grown = [r.model for r in self.boosted.select("model").distinct().collect()] if self.boosted is not None else []
        return sorted([*grown, *self.fitted])

    def prepared(self, df: DataFrame) -> DataFrame:
        """The rows a model sees: all columns there, scaled if the artefact scales."""
        checked = StrictColumns(columns=self.features).transform(df)
        return self.scaler.transform(checked) if self.scaler else checked

    def score(self, df: DataFrame, model: str, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and a prediction a target, named like it."""
        kept = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)]  # not scaled, even if a feature
        rows = self.prepared(StrictColumns(columns=self.features).transform(df).select("*", *kept))
        held = [f"__k{i}" for i in range(len(keep))]
        if model in self.fitted:
            out = M.score(rows, self.fitted[model], self.features, held)
        else:
            out = boosting.score(rows, self.boosted.where(F.col("model") == model), self.features, held)
        return out.select(*[F.col(h).alias(c) for h, c in zip(held, keep)], *self.targets)

    def save(self, path: str) -> None:
        """Write all parts, the manifest last: an artefact without one is not complete."""
        spark = SparkSession.active()
        manifest = {"format": FORMAT, "features": self.features, "targets": self.targets, "scaled": self.scaler is not None, "notes": dict(self.notes), "models": {}}
        if self.scaler:
            self.scaler.write().overwrite().save(f"{path}/scaler")
        if self.boosted is not None:
            self.boosted.write.mode("overwrite").parquet(f"{path}/trees")
            for name in self.names:
                if name not in self.fitted:
                    manifest["models"][name] = {"kind": "trees", "place": "trees"}
        for name, per_target in self.fitted.items():
            M.save_models(per_target, f"{path}/{name}")
            manifest["models"][name] = {"kind": "models", "place": name, "targets": list(per_target)}
        text = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Artefact":
        manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        if manifest["format"] != FORMAT:
            raise ValueError(f"unknown format {manifest['format']}")
        parts = manifest["models"]
        grown = [n for n, m in parts.items() if m["kind"] == "trees"]
        return Artefact(
            manifest["features"], manifest["targets"], spark.read.parquet(f"{path}/trees") if grown else None,
            {n: M.load_models(spark, f"{path}/{m['place']}", m["targets"]) for n, m in parts.items() if m["kind"] == "models"},
            RangeScaler.load(f"{path}/scaler") if manifest["scaled"] else None, manifest["notes"],
        )
