"""What one micro-batch leaves for the next: a small table in two folders that take turns.

Batch ``b`` reads what batch ``b - 1`` wrote and writes the folder that batch
``b - 2`` used, so a batch opens one folder and replaces one, however long the
stream has run. A replayed batch reads what its first run read and writes the
same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL, ROW_COL = "batch_id", "is_row"


class Carried:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._stored = T.StructType([*schema.fields, T.StructField(ROW_COL, T.BooleanType()),
                                     T.StructField(BATCH_COL, T.LongType())])

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/turn={batch_id % 2}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        """``df`` as what batch ``batch_id`` leaves; a row of its own marks the folder, also of an empty state."""
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], F.lit(True).alias(ROW_COL))
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields],
                                          F.lit(False).alias(ROW_COL))
        (rows.unionByName(mark).withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").parquet(self._folder(batch_id)))

    def read(self, batch_id: int) -> DataFrame:
        """The state that batch ``batch_id`` begins with; none for the first."""
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        before = self.spark.read.schema(self._stored).parquet(self._folder(batch_id - 1))
        return before.where(F.col(ROW_COL) & (F.col(BATCH_COL) == batch_id - 1)).select(*self.schema.fieldNames())

    def latest(self) -> DataFrame:
        """The state after the last batch."""
        both = self.spark.read.schema(self._stored).parquet(f"{self.path}/turn=*")
        last = both.agg(F.max(BATCH_COL)).first()[0]
        return both.where(F.col(ROW_COL) & (F.col(BATCH_COL) == last)).select(*self.schema.fieldNames())
