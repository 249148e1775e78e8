"""Batch sources: tables, typed projection, time range, parameters, local rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, source: str, schema: T.StructType | None = None,
         fmt: str = "parquet") -> DataFrame:
    """A whole table: a catalog name (``db.table``) or a path in ``fmt``.

    With a schema the read skips inference; Catalyst prunes columns and
    pushes filters into the file scan either way.
    """
    if "/" not in source and ":" not in source:
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def typed(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Project to a declared schema: cast every field, keep extra columns named in ``keep``."""
    cols = [F.col(c) for c in keep if c not in schema.fieldNames()]
    cols += [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols)


def _blank(v: str | None) -> bool:
    return v is None or v.strip() == ""


def time_range(df: DataFrame, start: str | None = None, end: str | None = None,
               column: str = "action_time") -> DataFrame:
    """Inclusive ``start <= column <= end``; a NULL or blank bound is skipped.

    The predicate is on the stored column, so it reaches the parquet scan
    as a pushed filter (and prunes partitions when the table is partitioned).
    """
    dtype = dict(df.dtypes)[column]
    cond = None
    for bound, op in ((start, "ge"), (end, "le")):
        if _blank(bound):
            continue
        lit = F.lit(bound.strip()).cast(dtype)
        c = F.col(column) >= lit if op == "ge" else F.col(column) <= lit
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def param(doc: str, key: str, default: str | None = None) -> str | None:
    """One value of a JSON parameter document (the job's condition file)."""
    import json
    v = json.loads(doc).get(key, default)
    return None if v is None else str(v)


def param_column(doc_col: str, key: str) -> F.Column:
    """Same lookup when the parameter documents are a column."""
    return F.from_json(F.col(doc_col), "map<string,string>").getItem(key)


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """Local rows (dimension tables written by a loader) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)
