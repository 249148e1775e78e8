"""Membership joins (keep / drop rows by a key list) with a checked broadcast.

A side is broadcast by hint only when its size is bounded or was measured: it
is a top-n result or a parameter list whose rows fit ``MAX_BROADCAST_BYTES``, or
all files it is made from are small, or ``checked_side`` has materialised it and
its table is small. Any other side (a
blacklist that grows for ever) gets no hint: Catalyst's statistics and AQE's
runtime sizes decide, and fall back to a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.config import shared_dir

# Bytes up to which a side is broadcast: of a materialised side's files, or of a
# bounded number of rows at the width of a lookup row (a few ids and counts).
MAX_BROADCAST_BYTES = 16 << 20
ROW_BYTES = 256
# How much larger than its compressed file a column may be in memory, for sides that are not materialised.
UNPACKED = 4


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files (or stored partitions) that ``df`` is made from, as the optimizer knows
    them; a source of unknown size counts as huge."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _side(small: DataFrame, max_rows: int | None) -> DataFrame:
    if max_rows is not None and max_rows * ROW_BYTES <= MAX_BROADCAST_BYTES:
        return F.broadcast(small)
    return small


def drop_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
            max_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (left anti join)."""
    return df.join(_side(keys, max_rows), on=on, how="left_anti")


def attach(df: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner",
           max_rows: int | None = None) -> DataFrame:
    """Join columns of a lookup table onto ``df``."""
    return df.join(_side(small, max_rows), on=on, how=how)


def checked_side(side: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``side`` with a broadcast hint if it is at most ``max_bytes``; joined by shuffle otherwise.

    A side whose input files are small needs no other check: it is an aggregate
    or a choice of their rows. Any other side becomes a table in the shared folder
    and its files are measured: it is computed once, before the join that needs
    it, so the other side is not shuffled only to find that it need not be.
    """
    if file_bytes(side) * UNPACKED <= max_bytes:
        return F.broadcast(side)
    spark = side.sparkSession
    path = shared_dir(spark, "sides")
    side.write.parquet(path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(root).getLength()
    stored = spark.read.schema(side.schema).parquet(path)
    return F.broadcast(stored) if size <= max_bytes else stored
