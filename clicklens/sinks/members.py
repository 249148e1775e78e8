"""A set that grows for ever, stored in hash buckets: a batch opens only the buckets its keys fall in.

A key's bucket is a hash of it. Members are files under ``bucket=<k>/batch_id=<b>``;
a batch overwrites the partitions that it writes and no other, so a replay
rewrites the same files. Of a batch's keys the driver sees bucket numbers only,
at most as many as there are buckets; the join behind is exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL, BUCKET_COL = "batch_id", "bucket"
BUCKETS = 256


class BucketedSet:
    """``buckets`` is fixed for the life of the set."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: T.DataType | None = None,
                 buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType([T.StructField(key, key_type or T.StringType())])
        self._stored = T.StructType([*self.schema.fields, T.StructField(BUCKET_COL, T.IntegerType()),
                                     T.StructField(BATCH_COL, T.LongType())])
        # An empty member file, so that a read of any buckets finds a folder.
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(
            f"{self.path}/{BUCKET_COL}=-1/{BATCH_COL}=-1")

    def bucket(self, key: Column | str | None = None) -> Column:
        key = self.key if key is None else key
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def add(self, df: DataFrame, batch_id: int) -> None:
        """The keys of ``df`` as members since batch ``batch_id``: one file for each bucket, however many tasks made them."""
        (df.select(F.col(self.key).cast(self.schema[0].dataType)).distinct()
         .withColumns({BUCKET_COL: self.bucket(), BATCH_COL: F.lit(int(batch_id)).cast("long")})
         .repartition(BUCKET_COL)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET_COL, BATCH_COL).parquet(self.path))

    def among(self, buckets: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """(key, first_batch_id) of the members in some buckets, added before a batch."""
        some = "*" if buckets is None else "{" + ",".join(map(str, sorted({-1, *buckets}))) + "}"
        found = (self.spark.read.schema(self._stored).option("basePath", self.path)
                 .parquet(f"{self.path}/{BUCKET_COL}={some}"))
        if before is not None:
            found = found.where(F.col(BATCH_COL) < before)
        return found.groupBy(self.key).agg(F.min(BATCH_COL).alias(f"first_{BATCH_COL}"))

    def read(self) -> DataFrame:
        return self.among()
