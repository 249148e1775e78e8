"""Exact deduplication by a tree merge of sorted digest runs (DataFrame functions only).

Every input partition is one *run*: its rows as (digest, best row, count),
sorted and pre-aggregated where they lie. Runs then meet in rounds: round k
joins the runs of ``fan_in ** k`` neighbouring partitions, so after
``log(partitions) / log(fan_in)`` rounds one entry for each digest is left. An
entry of a round comes from at most ``fan_in`` entries of the round before, so
a text that fills a third of the corpus is never one task's load. The verdict
goes back down the same tree, again with at most ``fan_in`` children for an entry.

Entries are equal only if the SHA-256, a second, independent hash and the byte
length of the normalised text all agree; that check is part of the merge key of
every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import ascii_lower, without, written

KEY = ["digest", "check", "n_bytes"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, check, n_bytes, run, row) of every row; a null text counts as empty."""
    folded = docs.select(F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    return folded.select(
        "id", F.unhex(F.sha2("t", 256)).alias("digest"), F.xxhash64("t").alias("check"),
        F.octet_length("t").alias("n_bytes"), F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 fan_in: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lowering A-Z. ``keep`` names
    the identifier that stays, ``smallest`` or ``largest``. Defined cases: a
    null text is an empty text; a null identifier loses against any other and
    stays only in a group without one; of rows with the same identifier and
    text the first read stays and the others go; an empty table gives an empty
    result; other columns are not read, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: smallest or largest, not {keep!r}")
    if fan_in < 2:
        raise ValueError("fan_in: 2 at least")
    small = keep == "smallest"
    pick = F.min if small else F.max
    rows = written(digests(docs, id_col, text_col), "exact", "digests")
    first = F.struct((F.col("id").isNull() if small else F.col("id").isNotNull()).alias("order"), F.col("id"),
                     (F.col("row") if small else -F.col("row")).alias("row"))
    level = rows.groupBy(*KEY, "run").agg(pick(first).alias("best"), F.count(F.lit(1)).alias("n"))
    levels = [written(level, "exact", "run")]
    last = rows.agg(F.max("run")).first()[0] or 0
    while last > 0:
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        merged = up.groupBy(*KEY, "run").agg(pick("best").alias("best"), F.sum("n").alias("n"))
        levels.append(written(merged, "exact", "run"))
        last //= fan_in
    known = levels[-1]
    for child in reversed(levels[:-1]):
        child = child.select(*KEY, F.col("run").alias("child"), F.floor(F.col("run") / fan_in).cast("int").alias("run"))
        known = child.join(known, [*KEY, "run"]).drop("run").withColumnRenamed("child", "run")
    best = F.col("best")["row"]
    return rows.join(known, [*KEY, "run"]).select(
        F.col("id").alias(id_col), F.col("best")["id"].alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == (best if small else -best)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 fan_in: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.

    Rows are taken out by identifier and digest. Where a whole pair of them is
    repeated, one of its rows stays.
    """
    groups = written(exact_groups(docs, id_col, text_col, keep, fan_in)
                     .select(F.col(id_col).alias("id"), "keep_id", "kept", F.col("text_sha256").alias("sha")),
                     "exact", "groups").where(~F.col("kept"))
    again = F.col("id").eqNullSafe(F.col("keep_id"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    return without(docs, [F.col(id_col), sha], groups.where(~again).select("id", "sha").distinct(),
                   groups.where(again).select("id", "sha").distinct())
