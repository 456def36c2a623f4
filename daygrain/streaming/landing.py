"""The daily ingest as an incremental job: each run takes the response files that are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daygrain.series import Series
from daygrain.sources.responses import align_parameters, latest_batch, parameter_map, response_rows


def ingest_new_responses(
    spark: SparkSession, landing: str, rows: str, checkpoint: str, keys: Sequence[str] = (),
    key_type: str = "string", body: str = "body", batch: str = "batch",
) -> StreamingQuery:
    """Parse the Parquet files of responses that landed since the last run into long rows, and stop.

    The checkpoint remembers which files were taken and the file sink commits whole batches, so a
    run that is repeated after a failure neither loses nor doubles rows.
    """
    schema = ", ".join([*[f"{k} {key_type}" for k in keys], f"{batch} int", f"{body} string"])
    landed = spark.readStream.schema(schema).parquet(landing)
    parsed = response_rows(landed, body, [*keys, batch])
    return (
        parsed.writeStream.format("parquet").option("path", rows).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def fault(body: str = "body") -> Column:
    """Why a document yields no row, or null if it yields one."""
    params = parameter_map(body)
    filled = F.exists(F.map_values(params), lambda points: F.coalesce(F.size(points), F.lit(0)) > 0)
    broken = F.get_json_object(F.col(body), "$").isNull()
    return (
        F.when(F.col(body).isNull() | (F.trim(F.col(body)) == ""), "empty document").when(broken, "not JSON")
        .when(params.isNull(), "no parameters").when(F.coalesce(filled, F.lit(False)), F.lit(None)).otherwise("no values")
    )


def ingest_with_faults(
    spark: SparkSession, landing: str, rows: str, aside: str, checkpoint: str, keys: Sequence[str] = (),
    key_type: str = "string", body: str = "body", batch: str = "batch",
) -> StreamingQuery:
    """As :func:`ingest_new_responses`, with a second sink: documents that yield no row are set aside with the reason.

    Both sinks lie in folders by the run's batch id, which a repeated batch overwrites: nothing is doubled, and every document
    is in exactly one of the two.  Rows carry the batch id as ``run``.
    """
    schema = ", ".join([*[f"{k} {key_type}" for k in keys], f"{batch} int", f"{body} string"])
    landed = spark.readStream.schema(schema).parquet(landing)

    def both(docs: DataFrame, run: int) -> None:
        judged = docs.withColumn("fault", fault(body))
        response_rows(judged.where("fault is null"), body, [*keys, batch]).write.mode("overwrite").parquet(f"{rows}/run={run}")
        judged.where("fault is not null").write.mode("overwrite").parquet(f"{aside}/run={run}")

    return landed.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def raw_table(spark: SparkSession, rows: str, series: Series, params: Sequence[str], batch: str = "batch") -> DataFrame:
    """The wide raw table of everything ingested so far; a later batch replaces a parameter as a whole."""
    return align_parameters(latest_batch(spark.read.parquet(rows), series, batch), series, params)
