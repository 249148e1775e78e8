"""Top-k operators.

``top_n``: global top-k, planned as TakeOrderedAndProject (each task keeps
its own k best, the driver merges k x tasks rows).

``top_n_per_group``: ``row_number() <= n`` over a window. Catalyst turns the
filter into a WindowGroupLimit that runs *before* the shuffle as well as after
it, so a group holding a third of all rows still sends at most
``n x map tasks`` rows to the one task that ranks it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _limit_groups(df: DataFrame, n: int) -> None:
    """Spark limits groups before the shuffle up to a threshold on ``n`` (1000 by
    default); raise it for a larger ``n``, so that no group is sent whole."""
    conf = df.sparkSession.conf
    if int(conf.get(GROUP_LIMIT)) < n:
        conf.set(GROUP_LIMIT, str(n))


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (add a unique last key for determinism)."""
    return df.orderBy(*_cols(order)).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                    n: int, rank_col: str | None = "rk") -> DataFrame:
    """Rows ranked ``1..n`` inside each group; ties broken by ``order``'s last keys."""
    _limit_groups(df, n)
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    rk = rank_col or "_rk"
    out = df.withColumn(rk, F.row_number().over(w)).where(F.col(rk) <= n)
    return out if rank_col else out.drop(rk)


def nth_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                  n: int) -> DataFrame:
    """The ``n``-th row of each group in ``order`` (groups with fewer rows give none).

    Same plan shape as ``top_n_per_group``: at most ``n`` rows per group and
    map task cross the shuffle.
    """
    _limit_groups(df, n)
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == n).drop("_rk")
