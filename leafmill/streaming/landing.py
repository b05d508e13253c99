"""Incremental runs as a stream over a landing folder: each batch does what is not done, under content hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import pending
from ..operators.pages import heuristics, route, structured


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The published keys; none before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def run_available(spark: SparkSession, landing: str, out: str, checkpoint: str, schema: str, work: Callable[[DataFrame], DataFrame], keys: str = "doc_id string, sha256 string") -> StreamingQuery:
    """Process what has landed since the last call, then stop.

    A row whose keys are published already is left out, so a file landed twice, or a batch run again after a failure,
    changes nothing. work maps the batch's rows to rows that keep the keys.
    """
    names = [k.split()[0] for k in keys.split(",")]

    def batch(df: DataFrame, _: int) -> None:
        todo = pending(df.dropDuplicates(names), published(spark, out, keys), names)
        work(todo).write.mode("append").parquet(out)

    stream = spark.readStream.schema(schema).parquet(landing)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def page_routes(batch: DataFrame) -> DataFrame:
    """(doc_id, sha256, route, structured) of a batch of page texts."""
    d = batch.withColumn("h", heuristics(F.col("text")))
    return d.select("doc_id", "sha256", route(F.col("h")).alias("route"), structured(F.col("h")).alias("structured"))


def event_counts(spark: SparkSession, path: str, schema: str, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts of events by window and type; rows later than the watermark are left out."""
    s = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return s.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
