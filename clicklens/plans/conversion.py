"""Page-to-page conversion along a target flow.

For every session, visits are ordered by ``(action_time, event_id)``; each
visit and the next one form a transition. A transition counts when it is a
consecutive pair of the target flow. Rate = transitions ``a -> b`` / all
visits of page ``a``.

Plan: one scan of four columns -> ``with_next`` (``lead`` by session for
small inputs, ranges of the visits for all others, see ``operators.adjacent``) -> one partial/final aggregate keyed by the source
page, which yields the page totals and the pair counts together (the flow's
pairs are a parameter, so each is a conditional count) -> one row per seen
pair. No whole session is ever in one task, and nothing is collected to the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.model import DEFAULT_FLOW
from clicklens.operators.adjacent import PLAIN_BYTES, with_next


def flow_pages(flow: str | Sequence[int]) -> list[int]:
    if isinstance(flow, str):
        return [int(p) for p in flow.split(",") if p.strip() != ""]
    return [int(p) for p in flow]


def flow_pairs(flow: str | Sequence[int]) -> list[tuple[int, int]]:
    """Consecutive pairs of the flow, each once, in flow order."""
    pages = flow_pages(flow)
    out: list[tuple[int, int]] = []
    for pair in zip(pages, pages[1:]):
        if pair not in out:
            out.append(pair)
    return out


def _is_target(frm: Column, to: Column, pairs: list[tuple[int, int]]) -> Column:
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [(frm == a) & (to == b) for a, b in pairs])


def _next_page(visits: DataFrame, next_col: str, plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    return with_next(visits.select("session_id", "action_time", "event_id", "page_id"),
                     "session_id", ["action_time", "event_id"], "page_id", next_col, plain_bytes)


def page_transitions(visits: DataFrame, plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    """Every adjacent visit pair: ``(session_id, event_id, from_page, to_page)``
    (``event_id`` of the first visit of the pair)."""
    nx = _next_page(visits, "to_page", plain_bytes)
    return (nx.where(F.col("to_page").isNotNull())
            .select("session_id", "event_id", F.col("page_id").alias("from_page"), "to_page"))


def target_transitions(visits: DataFrame, flow: str | Sequence[int] = DEFAULT_FLOW,
                       plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    """The transitions that are consecutive pairs of the flow."""
    t = page_transitions(visits, plain_bytes)
    return t.where(_is_target(F.col("from_page"), F.col("to_page"), flow_pairs(flow)))


def target_transition_counts(visits: DataFrame, flow: str | Sequence[int] = DEFAULT_FLOW,
                             plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    """``(from_page, to_page, pair_count)``; pairs never seen are absent."""
    return (target_transitions(visits, flow, plain_bytes)
            .groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("pair_count")))


def target_page_visits(visits: DataFrame, flow: str | Sequence[int] = DEFAULT_FLOW) -> DataFrame:
    """``(page_id, page_count)``: all visits of each page of the flow."""
    return (visits.where(F.col("page_id").isin(sorted(set(flow_pages(flow)))))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("page_count")))


def page_conversion(visits: DataFrame, flow: str | Sequence[int] = DEFAULT_FLOW,
                    percent: bool = False, plain_bytes: int = PLAIN_BYTES) -> DataFrame:
    """``(from_page, to_page, pair_count, page_count, rate)`` (+ ``rate_pct`` int,
    truncated, when ``percent``). A flow of fewer than two pages has no pairs:
    the result is empty. ``plain_bytes`` only changes how sessions are spread over
    tasks, never the result."""
    pairs = flow_pairs(flow)
    sources = sorted({a for a, _ in pairs})
    targets = sorted({b for _, b in pairs})
    if not pairs:
        fields = ["from_page long", "to_page long", "pair_count long", "page_count long", "rate double"]
        return visits.sparkSession.createDataFrame([], ", ".join(fields + ["rate_pct int"] * percent))
    nx = _next_page(visits, "next_page", plain_bytes)
    frm, nxt = F.col("page_id"), F.col("next_page")
    hit = _is_target(frm, nxt, pairs)
    # One aggregate per source page gives its visit total and, per target page
    # of the flow, how many of its visits went there next (a pair outside the
    # flow counts 0); the counts are then turned into one row per seen pair.
    g = (nx.where(frm.isin(sources))
         .groupBy(frm.alias("from_page"))
         .agg(F.count(F.lit(1)).alias("page_count"),
              *[F.count(F.when(hit & (nxt == b), 1)).alias(f"_to{b}") for b in targets]))
    per_target = F.explode(F.array(*[F.struct(F.lit(b).cast("long").alias("to_page"),
                                              F.col(f"_to{b}").alias("pair_count")) for b in targets]))
    out = (g.select("from_page", "page_count", per_target.alias("_p"))
           .select("from_page", F.col("_p.to_page").alias("to_page"), F.col("_p.pair_count").alias("pair_count"),
                   "page_count")
           .where(F.col("pair_count") > 0)
           .withColumn("rate", F.col("pair_count").cast("double") / F.col("page_count")))
    if percent:
        out = out.withColumn("rate_pct", (F.col("pair_count") / F.col("page_count") * 100).cast("int"))
    return out
