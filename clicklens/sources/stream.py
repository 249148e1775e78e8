"""Stream sources: the ad-log topic, or files replayed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.model import AD_TOPIC, EVENTS_SCHEMA


def ad_line_stream(spark: SparkSession, servers: str, topic: str = AD_TOPIC,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic of ad-log lines -> ``(value string, arrival_ts timestamp)``.

    Offsets are tracked in the query checkpoint (not committed to a shared
    consumer group), so every query reads the whole topic on its own.
    Needs the spark-sql-kafka package on the classpath.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("arrival_ts"))


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream, oldest first (by modification time)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(folder)


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The driver's ``events`` table read as a stream."""
    return file_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet",
                       max_files_per_trigger=max_files_per_trigger)
