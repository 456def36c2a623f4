"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small local inputs: keep all cores busy instead of merging shuffle partitions to 1 MB
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "12g",
}

RUN_FOLDER = "daygrain.run.folder"


def local_session(cores: str | int = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session it provides."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("daygrain")
    shuffle = "8" if cores == "*" else str(cores)
    settings = {**LOCAL_DEFAULTS, "spark.sql.shuffle.partitions": shuffle, **extra}
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="daygrain-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below the folder of the run at hand."""
    below = spark.conf.get(RUN_FOLDER, None) or shared_dir(spark)
    return f"{below.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Tables that are written for reuse inside this block lie in one folder, which is deleted at its end.

    Results that still read them must have been written elsewhere by then.
    """
    before, path = spark.conf.get(RUN_FOLDER, None), shared_path(spark, "run")
    spark.conf.set(RUN_FOLDER, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(RUN_FOLDER)
        else:
            spark.conf.set(RUN_FOLDER, before)
        removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    For results used several times: they are computed once, stay columnar, survive the loss of
    executors, and later plans know their true size, so a small one is broadcast and a large
    one is not.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
