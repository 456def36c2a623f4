"""Ranked feature lists: export and the accepted shapes of an import."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_feature_list(text: str) -> tuple[list[str], list[str] | None]:
    """Feature names and target names from JSON.

    Accepted: ``{"selected_features": [...], "target_names": [...]}``, ``{"0": name, ...}``, or
    a plain list.
    """
    content = json.loads(text)
    targets = None
    if isinstance(content, dict) and "selected_features" in content:
        features, targets = content["selected_features"], content.get("target_names")
    elif isinstance(content, dict):
        features = [content[k] for k in sorted(content, key=int)]
    else:
        features = content
    if not features:
        raise ValueError("no selected features")
    return list(features), targets


def feature_table(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(features, start=1)), "rank int, feature string")


def to_json(ranked: DataFrame) -> DataFrame:
    """One row: JSON object from 0-based position to name (a list of column names, so small)."""
    entries = F.sort_array(F.collect_list(F.struct((F.col("rank") - 1).alias("i"), "feature")))
    return ranked.agg(
        F.to_json(
            F.map_from_entries(F.transform(entries, lambda e: F.struct(e["i"].cast("string"), e["feature"])))
        ).alias("json")
    )


def from_json(lists: DataFrame, column: str = "json") -> DataFrame:
    """(rank, feature) rows of JSON objects from position to name."""
    return lists.select(F.explode(F.from_json(column, "map<string,string>")).alias("i", "feature")).select(
        (F.col("i").cast("int") + 1).alias("rank"), "feature"
    )
