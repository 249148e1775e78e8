"""JDBC source: a table or query read in parallel by numeric bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 1, fetchsize: int = 10_000) -> DataFrame:
    """Read ``table`` (or ``(select ...) t``); with ``column`` and bounds the
    read is split into ``num_partitions`` range queries on that column.

    The bounds only decide the split: rows outside them are still read by
    the first and last partitions.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=props)
