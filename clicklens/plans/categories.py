"""Top categories by clicks, orders and payments, and the most active
sessions inside each top category.

Plans (see ``explain`` in tests/test_plans.py):

* ``top_categories``: scan (3 list columns + click id) -> project, explode ->
  partial HashAggregate per category -> tiny shuffle -> final aggregate ->
  TakeOrderedAndProject. A hot category costs nothing extra: the map-side
  aggregate collapses it to one row per task before the shuffle.
* ``top_sessions_per_category``: clicks semi-joined to the top list
  (broadcast: it holds at most ``n`` rows) -> partial/final count per
  (category, session) -> WindowGroupLimit (partial, before the shuffle) ->
  shuffle by category -> final WindowGroupLimit -> row_number filter.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.functions.columns import CLICK, ORDER, PAY, action_category_ids, action_kind
from clicklens.model import TOP_CATEGORIES, TOP_SESSIONS
from clicklens.operators.lookup import attach
from clicklens.operators.topk import top_n, top_n_per_group


def new_task_id() -> str:
    """Run id written on every result row of one run (driver-side constant)."""
    return str(uuid.uuid4())


def category_actions(visits: DataFrame, keep: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per (visit, counted category): ``keep..., category_id, action``.

    A click counts its one category; an order or pay row counts every id of
    its list, duplicates included; search rows count nowhere.
    """
    keep = [c for c in keep if c in visits.columns]
    return visits.select(*keep, action_kind().alias("action"),
                         F.explode(action_category_ids()).alias("category_id"))


def category_action_counts(visits: DataFrame) -> DataFrame:
    """Long form: ``(category_id, action, action_count)``."""
    return (category_actions(visits, keep=())
            .groupBy("category_id", "action").agg(F.count(F.lit(1)).alias("action_count")))


def category_action_map(visits: DataFrame) -> DataFrame:
    """The accumulator's histogram as one value per category:
    ``(category_id, actions)`` with ``actions`` = JSON ``{"click":n,...}``
    (kinds in name order; at most three entries per category)."""
    entries = F.array_sort(F.collect_list(F.struct("action", "action_count")))
    return (category_action_counts(visits).groupBy("category_id")
            .agg(F.to_json(F.map_from_entries(entries)).alias("actions")))


def category_counts(visits: DataFrame) -> DataFrame:
    """Wide form: one row per category with click, order and pay counts (0 when absent)."""
    a = F.col("action")
    return (category_actions(visits, keep=())
            .groupBy("category_id")
            .agg(F.count(F.when(a == CLICK, 1)).alias("click_count"),
                 F.count(F.when(a == ORDER, 1)).alias("order_count"),
                 F.count(F.when(a == PAY, 1)).alias("pay_count")))


def category_counts_pivot(visits: DataFrame) -> DataFrame:
    """The wide form through ``pivot`` on the long form (same result)."""
    p = (category_actions(visits, keep=())
         .groupBy("category_id").pivot("action", [CLICK, ORDER, PAY]).count())
    return p.select("category_id", *[F.coalesce(F.col(k), F.lit(0).cast("long")).alias(f"{k}_count")
                                     for k in (CLICK, ORDER, PAY)])


def top_categories(visits: DataFrame, n: int = TOP_CATEGORIES, task_id: str | None = None) -> DataFrame:
    """``(task_id, category_id, click_count, order_count, pay_count)``, the ``n`` best
    by click, then order, then pay count (descending), category id last."""
    task_id = task_id or new_task_id()
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return (top_n(category_counts(visits), order, n)
            .select(F.lit(task_id).alias("task_id"), "category_id",
                    "click_count", "order_count", "pay_count"))


def top_list(stored: DataFrame, task_id: str | None = None, all_runs: bool = False) -> DataFrame:
    """``(category_id, task_id)`` from a stored ranking table.

    The list of the run ``task_id``, by default of the latest run (the largest
    task id). With ``all_runs``, of every run: one task id per category (the
    largest), as a job that reads the whole table would see it.
    """
    if all_runs:
        return stored.groupBy("category_id").agg(F.max("task_id").alias("task_id"))
    if task_id is not None:
        return stored.where(F.col("task_id") == task_id).select("category_id", "task_id")
    # One row: the id of the latest run.
    latest = F.broadcast(stored.agg(F.max("task_id").alias("task_id")))
    return stored.join(latest, "task_id", "left_semi").select("category_id", "task_id")


def with_task_ids(counts: DataFrame, top: DataFrame, top_rows: int | None = TOP_CATEGORIES) -> DataFrame:
    """``counts`` (with ``category_id``) and the task id of each category, ``""`` where ``top`` has none."""
    out = attach(counts, top.select("category_id", "task_id"), "category_id", how="left", max_rows=top_rows)
    return out.withColumn("task_id", F.coalesce("task_id", F.lit("")))


def visits_in_top_categories(visits: DataFrame, top: DataFrame,
                             top_rows: int | None = TOP_CATEGORIES) -> DataFrame:
    """Click rows whose category is in ``top``, with that category's task id.

    ``top_rows`` is the proven bound on ``top``'s size (a top-n result); only
    then is it broadcast by hint.
    """
    clicks = (visits.where(F.col("click_category_id") != -1)
              .select(*[c for c in ("event_id",) if c in visits.columns], "session_id",
                      F.col("click_category_id").cast("string").alias("category_id")))
    return attach(clicks, top.select("category_id", "task_id"), "category_id", max_rows=top_rows)


def category_session_counts(visits: DataFrame, top: DataFrame,
                            top_rows: int | None = TOP_CATEGORIES) -> DataFrame:
    """``(task_id, category_id, session_id, click_count)`` for the top categories."""
    return (visits_in_top_categories(visits, top, top_rows)
            .groupBy("task_id", "category_id", "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(visits: DataFrame, top: DataFrame | None = None,
                              n: int = TOP_SESSIONS, top_rows: int | None = TOP_CATEGORIES,
                              task_id: str | None = None) -> DataFrame:
    """The ``n`` sessions with most clicks in each top category.

    ``top`` defaults to this run's ``top_categories`` computed in the same plan.
    """
    if top is None:
        top = top_categories(visits, task_id=task_id)
        top_rows = TOP_CATEGORIES
    counts = category_session_counts(visits, top, top_rows)
    return top_n_per_group(counts, ["category_id"],
                           [F.desc("click_count"), F.asc("session_id")], n, rank_col=None)
