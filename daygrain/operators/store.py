"""The forecast table: declared schema, upsert by key, back-fill of actual values.

Parquet has no MERGE, so a change is computed as a new frame, written to a staging folder, and
moved over the partitions it touches.  The table is partitioned by the month of the origin date:
an upsert rewrites only the months it brings, never the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.blocks import lookup
from daygrain.operators.merging import fill_actuals, truth_for
from daygrain.operators.versions import Versions
from daygrain.series import Series
from daygrain.session import shared_path

UPSERT_KEY = ("date", "target_date", "model")
MONTH = "origin_month"
STORE_COLUMNS = ("date", "target_date", "horizon_day", "forecast", "actual", "model")


def create_store(
    spark: SparkSession, table: str, keys: Sequence[str] = (), path: str | None = None, like: DataFrame | None = None
) -> None:
    """Create the forecast table if it does not exist yet, in the warehouse or at a given path.

    Key columns have the types they have in ``like``; without it they are text.
    """
    kind = lambda k: like.schema[k].dataType.simpleString() if like is not None else "STRING"
    extra = "".join(f"{k} {kind(k)}, " for k in keys)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({extra}date DATE, target_date DATE, horizon_day INT, forecast DOUBLE, "
        f"actual DOUBLE, model STRING, {MONTH} STRING) USING parquet PARTITIONED BY ({MONTH}){place}"
    )


def read_store(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(MONTH)


def month_of(date: str = "date") -> Column:
    return F.date_format(date, "yyyy-MM")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] = UPSERT_KEY) -> DataFrame:
    """Old rows whose key is not in ``new``, then all of ``new``."""
    kept = lookup(old, new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new.select(*old.columns))


def backfill(store: DataFrame, truth: DataFrame, series: Series, value: str) -> DataFrame:
    return fill_actuals(store, truth, series, value).select(*store.columns)


def _months(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """The stored rows of the origin months that occur in ``rows``; other partitions are not read."""
    wanted = [r[0] for r in rows.select(month_of()).distinct().collect()]  # a row a month; as literals they prune
    return spark.table(table).where(F.col(MONTH).isin(wanted)).drop(MONTH)


def _replace_months(spark: SparkSession, table: str, changed: DataFrame) -> None:
    """Write the change beside the table, then move it over the partitions it holds.

    The rebalance hint lets the engine write few files per month and still split a large month.
    """
    staged = shared_path(spark, "staged")
    changed.withColumn(MONTH, month_of()).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(staged)
    target = spark.table(table)
    ready = spark.read.schema(target.schema).parquet(staged).select(*target.columns)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ready.hint("rebalance", MONTH).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def upsert_into(spark: SparkSession, table: str, new: DataFrame, keys: Sequence[str] = UPSERT_KEY) -> None:
    """Upsert into the stored table, reading and rewriting only the origin months in ``new``."""
    _replace_months(spark, table, upsert(_months(spark, table, new), new, keys))


def backfill_in(
    spark: SparkSession, table: str, truth: DataFrame, series: Series, value: str, since: str | None = None
) -> None:
    """Write new actual values into the stored table; only origin months with a change are rewritten.

    ``since`` (a date) leaves older forecasts alone: their months are not even read.
    """
    store = spark.table(table)
    if since is not None:
        store = store.where((F.col(MONTH) >= since[:7]) & (F.col("date") >= F.lit(since).cast("date")))
    known = truth_for(truth, store, series, value)
    stale = lookup(store, known, [*series.keys, "target_date"], "inner").where(
        F.col("__actual").isNotNull() & ~F.col("actual").eqNullSafe(F.col("__actual"))
    )
    _replace_months(spark, table, backfill(_months(spark, table, stale), truth, series, value))


# --- the same table as numbered versions (operators.versions): a reader never meets a half-written month -----------------


def versioned_store(spark: SparkSession, path: str) -> Versions:
    return Versions(spark, path, month_of)


def upsert_version(store: Versions, new: DataFrame, keys: Sequence[str] = UPSERT_KEY) -> int:
    """Upsert as a new version; only the origin months of ``new`` are read and written, and two writers lose nothing."""
    return store.change(store.parts_of(new), lambda old: upsert(old, new, keys), like=new)


def backfill_version(store: Versions, truth: DataFrame, series: Series, value: str, since: str | None = None) -> int:
    """New actual values as a new version; months without a change keep their files."""
    rows = store.read()
    if since is not None:
        rows = store.read(parts=[p for p in store.manifest()["parts"] if p >= since[:7]]).where(F.col("date") >= F.lit(since).cast("date"))
    known = truth_for(truth, rows, series, value)
    stale = lookup(rows, known, [*series.keys, "target_date"], "inner").where(
        F.col("__actual").isNotNull() & ~F.col("actual").eqNullSafe(F.col("__actual"))
    )
    months = store.parts_of(stale)
    return store.change(months, lambda old: backfill(old, truth, series, value)) if months else store.latest()
