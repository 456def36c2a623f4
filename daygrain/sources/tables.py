"""Reading and writing tables: Parquet, CSV and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.functions.numeric import nan_free


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """NaN, the missing value of array libraries, becomes null."""
    return nan_free(spark.read.parquet(path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Give a schema for anything large: inference reads the file twice."""
    reader = spark.read.option("header", True)
    return nan_free(reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path))


def load_table(
    spark: SparkSession, path: str, format: str | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Read by extension: ``.csv`` as CSV, everything else as Parquet."""
    kind = format or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    return read_csv(spark, path, schema) if kind == "csv" else read_parquet(spark, path)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that lists the columns it lacks."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns {absent}; present are {df.columns}")
    return df


def require_path(spark: SparkSession, path: str) -> str:
    """The path itself, or FileNotFoundError; works on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        raise FileNotFoundError(path)
    return path


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition together, so each gets few files; the engine still splits a large one."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite a Parquet folder; partition by year or series so later reads can prune."""
    _gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Create or replace a catalog table from a query, in the warehouse or at a given path."""
    writer = _gathered(df, partition_by).write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def load_summary(df: DataFrame, time: str = "date") -> DataFrame:
    """Row count and date range of a table, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(time).alias("min_date"), F.max(time).alias("max_date")
    )
