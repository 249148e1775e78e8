"""Helpers shared by the operators: names, ASCII folding, written tables."""

from __future__ import annotations

import ctypes
import string

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.config import shared_dir


#: glibc's call that returns freed memory to the system; None where the C library has none.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lowered and every other character as it was.

    ``lower`` maps all of Unicode, so it serves only texts without a character
    beyond ASCII (as many bytes as characters); the rest goes through
    ``translate``.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, keys: list[Column], gone: DataFrame, twice: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` are no row of ``gone``; of those in ``twice``, one for each of its rows.

    Keys are compared by position and null-safely; ``docs`` keeps its columns, whatever their names.
    """
    own = fresh(docs, *[f"own_{i}" for i in range(len(keys))])
    names = [f"{name}_there" for name in own]
    names = fresh(docs, *names)
    gone = gone.toDF(*names)
    same = None
    for a, b in zip(own, names):
        equal = F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))
        same = equal if same is None else same & equal
    marked = docs.withColumns(dict(zip(own, keys)))
    if twice is None or twice.isEmpty():
        return marked.join(gone, same, "left_anti").drop(*own)
    twice = twice.toDF(*names)
    once = marked.join(gone.unionByName(twice), same, "left_anti")
    one = marked.join(twice, same, "left_semi").dropDuplicates(own)
    return once.unionByName(one).drop(*own)


def written(df: DataFrame, *name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``.

    Cuts the lineage: whatever reads the result again, also after an executor
    is lost, reads the files and does not run ``df`` a second time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", *name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(batch, col: int, limit: int = 8 << 20):
    """An Arrow batch in slices of about ``limit`` bytes of its string column, one row at least."""
    # A worker keeps what it once freed; hand it back, so that idle ones stay small.
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)
    size, start = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            size, start = 0, i
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)
