"""Batch and stream sinks: managed tables, JDBC, console, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_table(df: DataFrame, name: str, path: str | None = None,
                    partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Drop-and-replace a catalog table (``path`` makes it an external table
    on shared storage). ``partition_by`` lets later reads prune partitions."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append a run's rows to a shared result table (the file-table form of a
    JDBC append: every run adds its rows, earlier runs stay)."""
    df.write.mode("append").format(fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", batchsize: int = 10_000, num_partitions: int | None = None) -> None:
    """Append rows over JDBC: one connection per task, batched inserts.

    ``num_partitions`` caps concurrent connections (Spark coalesces first).
    """
    w = df.write.mode(mode).option("batchsize", str(batchsize))
    if num_partitions is not None:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url, table, properties=properties or {})


def show(df: DataFrame, n: int = 20) -> None:
    """Console print of a small result (the reference's ``print``)."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, output_mode: str = "update", trigger: str | None = None,
                   checkpoint: str | None = None):
    """Print a stream's output per micro-batch."""
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", "false")
    if trigger:
        w = w.trigger(processingTime=trigger)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def to_kafka(df: DataFrame, servers: str, topic: str, value_col: str = "value",
             key_col: str | None = None) -> None:
    """Publish rows as Kafka records (needs the spark-sql-kafka package)."""
    cols = [F.col(value_col).cast("string").alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    (df.select(*cols).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
