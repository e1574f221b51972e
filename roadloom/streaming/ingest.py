"""Readings as a stream of files: partitioned storage and hourly means as they close."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import READINGS


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """Typed readings from Parquet files that arrive below ``path``."""
    return spark.readStream.schema(READINGS).option("maxFilesPerTrigger", str(files_per_batch)).parquet(path)


def store(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to a table partitioned by day; runs what is there and stops.

    The checkpoint makes each file count once, however often this is called.
    """
    dated = stream.withColumn("analysis_date", F.to_date("measurement_tstamp"))
    return dated.writeStream.partitionBy("analysis_date").format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def hourly_means(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Mean speed above zero of each segment and hour; an hour is given out once lateness has passed."""
    timed = stream.where("speed > 0").withColumn("at", F.col("measurement_tstamp").cast("timestamp")).withWatermark("at", lateness)
    found = timed.groupBy("tmc_code", F.window("at", "1 hour").alias("w")).agg(F.avg("speed").alias("avg_speed"), F.count(F.lit(1)).alias("readings"))
    return found.select("tmc_code", F.col("w.start").alias("hour_start"), "avg_speed", "readings")
