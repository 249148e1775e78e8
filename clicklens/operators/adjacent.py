"""Next row of the same session, without putting a hot session in one task.

Small inputs take the plain plan, ``lead() over (partition by session order by
...)``: one shuffle by session. Whether an input is small is read from the sizes
of the files under the plan, no row of it.

Any other input is cut by its own order: rows are range-partitioned by session
and full order key, so the cut points come from the data (Spark's sampled
quantiles), and a hot session, a NULL session (all anonymous visitors) or a burst
of one timestamp is cut like anything else. Inside a partition the next row is
the row behind; Arrow batches are shifted by one as they pass, with one row held
back. Only the last row of a partition has its neighbour elsewhere: the first
row of the next one. Those edge rows, two for each partition, are ranked by
partition number. The rows are written once and both the inner rows and the
edges are read from there, so they always are of the same cut. The result is
exactly the plain ``lead``, for any cut.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.config import shared_dir
from clicklens.operators.lookup import file_bytes

# Bytes of input files up to which the plain plan is taken: a session in it, however hot, fits a task.
PLAIN_BYTES = 256 << 20


def _lead(df: DataFrame, session: str, order: Sequence[str], value: str, next_col: str) -> DataFrame:
    """The neighbour comes as a struct around its value, so that NULL means "no neighbour" only."""
    row = F.lead(F.struct(F.col(value).alias("v"))).over(Window.partitionBy(session).orderBy(*order))
    out = df.withColumn("_next", row)
    return out.withColumns({next_col: F.col("_next")["v"], "has_next": F.col("_next").isNotNull()}).drop("_next")


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def _shifted(df: DataFrame, session: str, value: str, next_col: str) -> DataFrame:
    """Sorted partitions with ``next_col`` and ``has_next`` inside each, its number, and marks on its edges."""
    schema = T.StructType([*df.schema.fields, T.StructField(next_col, df.schema[value].dataType),
                           T.StructField("has_next", T.BooleanType()), T.StructField("_part", T.IntegerType()),
                           T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())])

    def run(batches):
        part, held, first = TaskContext.get().partitionId(), None, True

        def out(rows, after, last=False):
            nonlocal first
            n = rows.num_rows
            if last:
                has = pa.array([False] * n)
                behind = pa.nulls(n, rows.column(value).type)
            else:
                has = _same(rows.column(session), after.column(session))
                behind = pc.if_else(has, after.column(value), pa.scalar(None, after.column(value).type))
            marks = [first] + [False] * (n - 1)
            first = False
            return pa.RecordBatch.from_arrays(
                [*rows.columns, behind, has, pa.array([part] * n, pa.int32()), pa.array(marks),
                 pa.array([last] * n)], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield out(held, batch.slice(0, 1))
            if batch.num_rows > 1:
                yield out(batch.slice(0, batch.num_rows - 1), batch.slice(1))
            held = batch.slice(batch.num_rows - 1)
        if held is not None:
            yield out(held, None, True)

    return df.mapInArrow(run, schema)


def _by_range(df: DataFrame, session: str, order: Sequence[str], value: str, next_col: str) -> DataFrame:
    spark = df.sparkSession
    cut = df.repartitionByRange(session, *order).sortWithinPartitions(session, *order)
    shifted = _shifted(cut, session, value, next_col)
    path = shared_dir(spark, "adjacent")
    shifted.write.parquet(path)
    rows = spark.read.schema(shifted.schema).parquet(path)
    # Two rows of each partition at most, so the window without a key stays small.
    after = F.lead(F.struct(F.col(session).alias("s"), F.col(value).alias("v"))).over(
        Window.orderBy("_part", "_last"))
    edges = rows.where("_first or _last").withColumn("_after", after).where("_last")
    has = F.col("_after").isNotNull() & F.col("_after.s").eqNullSafe(F.col(session))
    edges = edges.withColumns({next_col: F.when(has, F.col("_after.v")), "has_next": has}).drop("_after")
    return rows.where("not _last").unionByName(edges).drop("_part", "_first", "_last")


def with_next(df: DataFrame, session: str, order: Sequence[str], value: str,
              next_col: str = "next_value", plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    """``df`` plus ``next_col``: ``value`` of the next row of the session in
    ``order`` (NULL on the session's last row, or where that value is NULL) and
    ``has_next``.

    ``order`` must be a total order inside a session (add a unique id last).
    ``plain_bytes`` chooses the plan only, never the result; an input of unknown
    size is a large one.
    """
    plan = _lead if file_bytes(df) <= plain_bytes else _by_range
    return plan(df, session, order, value, next_col)
