"""KeyedSnapshot: the reference's key-value result store as a versioned table.

Each micro-batch overwrites its own ``batch_id=<b>`` folder, so a replayed batch
replaces exactly what it wrote before and nothing is counted twice. Readers merge the partitions:

* ``set``    (absolute upsert, like HSET): per key, the rows of the latest
  batch that wrote the key;
* ``add``    (increment, like HINCRBY): per key, the sum of all batch deltas;
* ``member`` (idempotent set add, like SADD): each key once, with the first
  batch that added it;
* ``log``    (append): every row of every batch, equal rows too.

``read(upto=b)`` gives the state as of the end of batch ``b``, which is what
a batch needs to see of its predecessors. ``days`` and ``buckets`` keep to the
partitions of those days and hash buckets, for stores that are partitioned so.

``compact(b)`` folds the state as of batch ``b`` into a base
(``<path>_base/upto=<b>``) and deletes what lies before the previous base. Reads
list the folder names once and open the newest base and the batches after it,
by path, so their cost follows the state and the batches since, not the
stream's age. A read from before the oldest base raises; a log is never folded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "batch_id"
BASE_COL = "upto"
BUCKET_COL = "bucket"
MODES = ("set", "add", "member", "log")


class KeyedSnapshot:
    """``by_day``: the store also has a ``day`` partition level (a column of the schema).
    ``bucketed``: (columns, number) of a hash bucket level below it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, mode: str = "set",
                 by_day: bool = False, bucketed: tuple[Sequence[str], int] | None = None):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if BATCH_COL in schema.fieldNames():
            raise ValueError(f"{BATCH_COL} is the store's own column")
        missing = [k for k in keys if k not in schema.fieldNames()]
        if missing:
            raise ValueError(f"keys not in schema: {missing}")
        self.spark, self.path, self.keys, self.schema, self.mode = spark, path.rstrip("/"), list(keys), schema, mode
        self.values = [f for f in schema.fieldNames() if f not in self.keys]
        self.base_path = f"{self.path}_base"
        self.bucketed = bucketed
        self.levels = ["day"] * by_day + [BUCKET_COL] * bool(bucketed)
        own = [T.StructField(BUCKET_COL, T.IntegerType())] if bucketed else []
        self._stored = T.StructType(schema.fields + own + [T.StructField(BATCH_COL, T.LongType())])

    def bucket(self) -> Column:
        """The hash bucket of a row with the store's bucket columns."""
        columns, n = self.bucketed
        return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")

    # ------------------------------------------------------------------ write
    def write(self, df: DataFrame, batch_id: int) -> None:
        """Store ``df`` as batch ``batch_id`` (replaces an earlier write of that batch)."""
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.bucketed:
            out = out.withColumn(BUCKET_COL, self.bucket())
        out.write.mode("overwrite").partitionBy(*self.levels).parquet(f"{self.path}/{BATCH_COL}={int(batch_id)}")

    def compact(self, upto: int) -> None:
        """Fold the state as of batch ``upto`` into a base; delete what the previous base replaced.

        A replay of batch ``upto`` still finds the previous base and the batches
        after it, so it folds the same rows again.
        """
        if self.mode == "log":
            return
        previous = max((b for b in self._ids(self.base_path, BASE_COL) if b < upto), default=None)
        (self._merged(upto).write.mode("overwrite").partitionBy(*self.levels)
         .parquet(f"{self.base_path}/{BASE_COL}={int(upto)}"))
        if previous is not None:
            self._delete(self.path, BATCH_COL, lambda b: b <= previous)
            self._delete(self.base_path, BASE_COL, lambda b: b < previous)

    # ---------------------------------------------------------------- folders
    def _folder(self, path: str):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _ids(self, path: str, col: str) -> list[int]:
        """Numbers of the committed ``col=<n>`` folders."""
        root, fs = self._folder(path)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        ids = [int(n.partition("=")[2]) for n in names if n.startswith(f"{col}=")]
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return [i for i in ids if fs.exists(child(f"{path}/{col}={i}/_SUCCESS"))]

    def _delete(self, path: str, col: str, drop) -> None:
        root, fs = self._folder(path)
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for i in self._ids(path, col):
            if drop(i):
                fs.delete(child(f"{path}/{col}={i}"), True)

    # ------------------------------------------------------------------- read
    def _open(self, path: str, col: str, ids: Iterable[int]) -> DataFrame | None:
        ids = sorted(ids)
        if not ids:
            return None
        schema = self._stored if col == BATCH_COL else T.StructType([*self._stored.fields,
                                                                     T.StructField(col, T.LongType())])
        return self.spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{col}={i}" for i in ids])

    def versions(self, upto: int | None = None) -> DataFrame:
        """Stored rows with their batch id as of batch ``upto``: newest base and later batches."""
        bases = self._ids(self.base_path, BASE_COL)
        base = max((b for b in bases if upto is None or b <= upto), default=None)
        if bases and base is None:
            raise ValueError(f"batch {upto} lies before the oldest base {min(bases)} of {self.path}")
        later = [b for b in self._ids(self.path, BATCH_COL)
                 if (upto is None or b <= upto) and (base is None or b > base)]
        parts = self._open(self.path, BATCH_COL, later)
        if base is not None:
            old = self._open(self.base_path, BASE_COL, [base]).drop(BASE_COL)
            parts = old if parts is None else old.unionByName(parts)
        return self.spark.createDataFrame([], self._stored) if parts is None else parts

    def _merged(self, upto: int | None, days: Sequence | None = None, buckets: Sequence | None = None) -> DataFrame:
        """Merged state that keeps a ``batch_id`` column (so it can be merged again)."""
        s = self.versions(upto)
        if days is not None:
            s = s.where(F.col("day").isin(list(days)))
        if buckets is not None:
            s = s.where(F.col(BUCKET_COL).isin(list(buckets)))
        if self.mode == "log":
            return s
        if self.mode == "add":
            own = [F.first(BUCKET_COL).alias(BUCKET_COL)] if self.bucketed else []
            return s.groupBy(*self.keys).agg(*own, *[F.sum(v).cast(self.schema[v].dataType).alias(v)
                                               for v in self.values],
                                             F.max(BATCH_COL).alias(BATCH_COL))
        if self.mode == "member":
            return s.groupBy(*self.keys).agg(*[F.min_by(v, BATCH_COL).alias(v) for v in self.values],
                                             F.min(BATCH_COL).alias(BATCH_COL))
        latest = F.max(BATCH_COL).over(Window.partitionBy(*self.keys))
        return s.withColumn("_latest", latest).where(F.col(BATCH_COL) == F.col("_latest")).drop("_latest")

    def read(self, upto: int | None = None, days: Sequence | None = None,
             buckets: Sequence | None = None) -> DataFrame:
        m = self._merged(upto, days, buckets)
        if self.mode == "member":
            return m.select(*self.schema.fieldNames(), F.col(BATCH_COL).alias(f"first_{BATCH_COL}"))
        return m.select(*self.schema.fieldNames())
