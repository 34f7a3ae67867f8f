"""Incremental ingest: new volume files become articles, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.corpus import extract_corpus


def stream_volumes(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Organised volume lines as a stream."""
    s = spark.readStream.schema(schemas.ORGANISED).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return s.select(F.concat_ws("_", F.col("edition").cast("string"), F.col("volume").cast("string"), "source_file").alias("volume_id"), F.col("edition").alias("edition_year"), F.col("volume").alias("volume_num"), "text")


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Extracts the articles of what is new since the last run, as the batch job
    does, and appends them; a batch that is run again replaces its own folder, so
    nothing is written twice."""
    def write(batch: DataFrame, number: int) -> None:
        extract_corpus(batch)["articles"].write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream_volumes(spark, path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
