"""Registered queries: name -> (Spark query, DuckDB oracle SQL or None).

Every query reads the driver's tables (through the fixture views) in full.
Parameters follow FIXTURES.md: reference defaults where the data allows,
test values (threshold 2, trend 6 h / 1 h / 1 h besides the default 60 s /
10 s / 10 s) where it does not. The oracle's constants are written out here,
not taken from the code that they check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens import oracle as O
from clicklens.config import shared_dir, use_utc
from clicklens.model import (CATEGORY_TOP10_SCHEMA, DEFAULT_FLOW, TOP_CATEGORIES, TOP_SESSIONS,
                             VISIT_COLUMNS)
from clicklens.plans import ads
from clicklens.plans import categories as cat
from clicklens.plans import conversion as conv
from clicklens.sinks.hash_source import read_hash
from clicklens.sinks.tables import append_rows, overwrite_table
from clicklens.sources import fixtures as fx
from clicklens.functions.columns import key_columns
from clicklens.sources.stream import event_stream, file_stream
from clicklens.sources.tables import param_column, time_range
from clicklens.streaming import ads_streams as streams

# Fixed run id, so that Spark and the oracle write the same task id.
TASK_ID = "run-1"
FLOW = DEFAULT_FLOW
RANGE_START, RANGE_END = "2024-01-05 00:00:00", "2024-01-20 23:59:59"

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = (run, sql)
        return run
    return deco


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


# ---------------------------------------------------------------- visit log

_VISIT_COLS = ", ".join(VISIT_COLUMNS)


@register("visits_typed", O.with_(O.VISITS) + f"select {_VISIT_COLS} from visits")
def _visits_typed(spark, sf):
    """The visit log as declared rows."""
    return fx.visits(spark, sf)


@register("visits_date_range", O.with_(O.VISITS) + f"""
select {_VISIT_COLS} from visits
where action_time >= timestamp '{RANGE_START}' and action_time <= timestamp '{RANGE_END}'""")
def _visits_date_range(spark, sf):
    """Inclusive action-time range (pushed to the scan)."""
    return time_range(fx.visits(spark, sf), RANGE_START, RANGE_END)


@register("category_actions_exploded", O.with_(O.VISITS, O.ACTIONS) +
          "select event_id, category_id, action from actions")
def _category_actions(spark, sf):
    """One row per counted (visit, category): click, each order id, each pay id."""
    return cat.category_actions(fx.visits(spark, sf))


@register("category_action_counts", O.with_(O.VISITS, O.ACTIONS) +
          "select category_id, action, count(*) as action_count from actions group by category_id, action")
def _category_action_counts(spark, sf):
    """Long form: count per (category, action kind)."""
    return cat.category_action_counts(fx.visits(spark, sf))


@register("category_action_map", O.with_(O.VISITS, O.ACTIONS) + """
select category_id, to_json(map_from_entries(list(struct_pack(k := action, v := n) order by action))) as actions
from (select category_id, action, count(*) as n from actions group by category_id, action)
group by category_id""")
def _category_action_map(spark, sf):
    """The category histogram as one JSON map per category."""
    return cat.category_action_map(fx.visits(spark, sf))


@register("category_action_pivot", O.with_(O.VISITS, O.ACTIONS, O.CATEGORY_COUNTS) +
          "select * from category_counts")
def _category_action_pivot(spark, sf):
    """Wide form through pivot: click, order and pay counts per category."""
    return cat.category_counts_pivot(fx.visits(spark, sf))


@register("top10_categories", O.with_(O.VISITS, O.ACTIONS, O.CATEGORY_COUNTS,
                                      O.top_categories_cte(TASK_ID, TOP_CATEGORIES)) +
          "select * from top_categories")
def _top10_categories(spark, sf):
    """Q1: top 10 categories by click, order, pay counts."""
    return cat.top_categories(fx.visits(spark, sf), TOP_CATEGORIES, TASK_ID)


_TOP_CLICKS = """
top_clicks as (
  select v.event_id, v.session_id, cast(v.click_category_id as varchar) as category_id, t.task_id
  from visits v join top_categories t on cast(v.click_category_id as varchar) = t.category_id
  where v.click_category_id <> -1
)"""
_Q2_BASE = (O.VISITS, O.ACTIONS, O.CATEGORY_COUNTS, O.top_categories_cte(TASK_ID, TOP_CATEGORIES), _TOP_CLICKS)


@register("visits_in_top_categories", O.with_(*_Q2_BASE) + "select * from top_clicks")
def _visits_in_top(spark, sf):
    """Click rows whose category is in this run's top 10, with the run's task id."""
    v = fx.visits(spark, sf)
    return cat.visits_in_top_categories(v, cat.top_categories(v, TOP_CATEGORIES, TASK_ID))


_CS_COUNTS = """
cs_counts as (
  select task_id, category_id, session_id, count(*) as click_count
  from top_clicks group by task_id, category_id, session_id
)"""


@register("category_session_counts", O.with_(*_Q2_BASE, _CS_COUNTS) + "select * from cs_counts")
def _category_session_counts(spark, sf):
    """Clicks per (category, session) inside the top 10 categories."""
    v = fx.visits(spark, sf)
    return cat.category_session_counts(v, cat.top_categories(v, TOP_CATEGORIES, TASK_ID))


@register("top10_sessions_per_category", O.with_(*_Q2_BASE, _CS_COUNTS) + f"""
select task_id, category_id, session_id, click_count from (
  select *, row_number() over (partition by category_id order by click_count desc, session_id) as rk
  from cs_counts) where rk <= {TOP_SESSIONS}""")
def _top10_sessions(spark, sf):
    """Q2: top 10 sessions by clicks inside each top category."""
    return cat.top_sessions_per_category(fx.visits(spark, sf), n=TOP_SESSIONS, task_id=TASK_ID)


_RUNS = f"""
runs as (
  select 'run-1' as task_id, category_id from top_first
  union all select 'run-2', category_id from top_second
)"""


def _run_cte(name: str, start: str, end: str) -> str:
    """Q1's top 10 over a range of days."""
    return f"""
{name} as (
  select category_id from (
    select category_id, count(*) filter (where action = 'click') as c, count(*) filter (where action = 'order') as o,
           count(*) filter (where action = 'pay') as p
    from actions join visits using (event_id)
    where action_time >= timestamp '{start}' and action_time <= timestamp '{end}' group by category_id)
  order by c desc, o desc, p desc, category_id limit 10
)"""


# Two runs over different days, so that the union of their lists is larger than one list.
RUN_1 = ("2024-01-01 00:00:00", "2024-01-06 23:59:59")
RUN_2 = ("2024-01-20 00:00:00", "2024-01-25 23:59:59")
_STORED = (O.VISITS, O.ACTIONS, _run_cte("top_first", *RUN_1), _run_cte("top_second", *RUN_2), _RUNS)


def _sessions_of(listed: str) -> str:
    return f"""
select task_id, category_id, session_id, click_count from (
  select *, row_number() over (partition by category_id order by click_count desc, session_id) as rk
  from (select t.task_id, t.category_id, v.session_id, count(*) as click_count
        from visits v join ({listed}) t on cast(v.click_category_id as varchar) = t.category_id
        where v.click_category_id <> -1 group by 1, 2, 3)) where rk <= 10"""


def _stored_runs(spark, v):
    path = shared_dir(spark, "tables", "category_top10")
    for run, days in (("run-1", RUN_1), ("run-2", RUN_2)):
        append_rows(cat.top_categories(time_range(v, *days), TOP_CATEGORIES, run), path)
    return spark.read.schema(CATEGORY_TOP10_SCHEMA).parquet(path)


@register("top10_sessions_from_stored_runs", O.with_(*_STORED) + _sessions_of(
    "select category_id, max(task_id) as task_id from runs group by category_id"))
def _top10_sessions_stored(spark, sf):
    """Q2 as the reference runs it: two runs of Q1 append to a result table;
    the session job reads the list of all runs back (one task id per
    category, the largest) and ranks sessions in those categories."""
    v = fx.visits(spark, sf)
    return cat.top_sessions_per_category(v, cat.top_list(_stored_runs(spark, v), all_runs=True), TOP_SESSIONS,
                                         top_rows=None)


@register("top10_sessions_latest_run", O.with_(*_STORED) + _sessions_of(
    "select category_id, task_id from runs where task_id = 'run-2'"))
def _top10_sessions_latest(spark, sf):
    """Q2 against the latest stored run (the default list)."""
    v = fx.visits(spark, sf)
    return cat.top_sessions_per_category(v, cat.top_list(_stored_runs(spark, v)), TOP_SESSIONS)


@register("category_session_task_ids", O.with_(O.VISITS, O.ACTIONS, O.CATEGORY_COUNTS,
                                               O.top_categories_cte("run-1", 10)) + """
select coalesce(t.task_id, '') as task_id, c.category_id, c.session_id, c.click_count
from (select cast(click_category_id as varchar) as category_id, session_id, count(*) as click_count
      from visits where click_category_id <> -1 group by 1, 2) c
left join top_categories t using (category_id)""")
def _category_session_task_ids(spark, sf):
    """Click counts of all (category, session), with the run's task id or ``""`` outside its top 10 (left outer)."""
    v = fx.visits(spark, sf)
    counts = (v.where(F.col("click_category_id") != -1)
              .groupBy(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
              .agg(F.count(F.lit(1)).alias("click_count")))
    return cat.with_task_ids(counts, cat.top_categories(v, TOP_CATEGORIES, TASK_ID))


# ---------------------------------------------------------- page conversion

_PAIRS = O.target_pairs_sql([(1, 2), (2, 3), (3, 4), (4, 5), (5, 6)])
_PAGES = "1, 2, 3, 4, 5, 6"


@register("page_transitions", O.with_(O.VISITS, O.transitions_cte()) +
          "select * from transitions where to_page is not null")
def _page_transitions(spark, sf):
    """Every adjacent visit pair of a session, in (action_time, event_id) order."""
    return conv.page_transitions(fx.visits(spark, sf))


@register("target_pairs", O.with_(O.VISITS, O.transitions_cte()) +
          f"select * from transitions where to_page is not null and ({_PAIRS})")
def _target_pairs(spark, sf):
    """The adjacent pairs that are consecutive pages of the target flow."""
    return conv.target_transitions(fx.visits(spark, sf), FLOW)


_PAIR_COUNTS = f"""
pair_counts as (
  select from_page, to_page, count(*) as pair_count from transitions
  where to_page is not null and ({_PAIRS}) group by from_page, to_page
)"""
_PAGE_COUNTS = f"""
page_counts as (
  select page_id, count(*) as page_count from visits where page_id in ({_PAGES}) group by page_id
)"""


@register("target_transition_counts", O.with_(O.VISITS, O.transitions_cte(), _PAIR_COUNTS) +
          "select * from pair_counts")
def _target_transition_counts(spark, sf):
    """Count of each target pair."""
    return conv.target_transition_counts(fx.visits(spark, sf), FLOW)


@register("target_page_visits", O.with_(O.VISITS, _PAGE_COUNTS) + "select * from page_counts")
def _target_page_visits(spark, sf):
    """All visits of each page of the target flow (the rate's denominator)."""
    return conv.target_page_visits(fx.visits(spark, sf), FLOW)


_RATES = """
rates as (
  select p.from_page, p.to_page, p.pair_count, c.page_count,
         cast(p.pair_count as double) / c.page_count as rate,
         cast(trunc(p.pair_count / c.page_count * 100) as integer) as rate_pct
  from pair_counts p join page_counts c on p.from_page = c.page_id
)"""


@register("page_conversion_rate", O.with_(O.VISITS, O.transitions_cte(), _PAIR_COUNTS, _PAGE_COUNTS, _RATES) +
          "select from_page, to_page, pair_count, page_count, rate from rates")
def _page_conversion_rate(spark, sf):
    """Q3: conversion rate of each consecutive pair of the target flow."""
    return conv.page_conversion(fx.visits(spark, sf), FLOW)


@register("page_conversion_pct", O.with_(O.VISITS, O.transitions_cte(), _PAIR_COUNTS, _PAGE_COUNTS, _RATES) +
          "select * from rates")
def _page_conversion_pct(spark, sf):
    """Q3 with the truncated whole-percent rate."""
    return conv.page_conversion(fx.visits(spark, sf), FLOW, percent=True)


# ------------------------------------------------------------------ ad clicks

# Fixture parameters (FIXTURES.md section 4): the reference's 60 s / 10 s / 10 s
# trend and threshold 100 leave nothing to see in the fixture data.
TREND_W, TREND_S, TREND_B = "6 hours", "1 hour", "1 hour"
THRESHOLD = 2
TOP_N_ADS = 3

_LINE_VIEWS = (O.CLICKS, O.LINES, O.LINE_CLICKS)


@register("ad_line_parse", O.with_(*_LINE_VIEWS) + "select * from parsed")
def _ad_line_parse(spark, sf):
    """Ad-log lines split into their five fields (those that can be read)."""
    return ads.parse_lines(fx.ad_lines(spark, sf))[0]


@register("quarantined_lines", O.with_(*_LINE_VIEWS) + """
select event_id, batch_id, value from lines where event_id not in (select event_id from parsed)""")
def _quarantined_lines(spark, sf):
    """The lines no job can read (too short, or a time that is no number), stored by a stream job of their own."""
    folder = shared_dir(spark, "replay", "lines")
    lines = fx.ad_lines(spark, sf)
    lines.write.parquet(folder)
    job = streams.quarantine_job(spark, file_stream(spark, folder, lines.schema))
    streams.run_to_end(job.query)
    return streams.log_read(job.stores["quarantined"])


_DAILY = """
daily as (
  select cast(ts as date) as day, area, city, adid, count(*) as click_count
  from clicks group by cast(ts as date), area, city, adid
)"""


@register("daily_ad_totals", O.with_(O.CLICKS, _DAILY) + "select * from daily")
def _daily_ad_totals(spark, sf):
    """Q4: clicks per (day, area, city, ad)."""
    return ads.daily_totals(fx.clicks(spark, sf))


_TOP_ADS = f"""
area_counts as (
  select cast(ts as date) as day, area, adid, count(*) as click_count
  from clicks group by cast(ts as date), area, adid
),
top_ads as (
  select day, area, adid, click_count, cast(rk as integer) as rk from (
    select *, row_number() over (partition by day, area order by click_count desc, adid) as rk
    from area_counts) where rk <= {TOP_N_ADS}
)"""


@register("top3_ads_per_area", O.with_(O.CLICKS, _TOP_ADS) + "select * from top_ads")
def _top3_ads(spark, sf):
    """Q5: best three ads per (day, area)."""
    return ads.top_ads_per_area(fx.clicks(spark, sf), TOP_N_ADS)


_TOP_ADS_JSON = """
select concat('top3_ads_per_day:', cast(day as varchar)) as hash_key, area as field,
       to_json(map_from_entries(list(struct_pack(k := adid, v := click_count) order by rk))) as value
from top_ads group by day, area"""


@register("top3_ads_json", O.with_(O.CLICKS, _TOP_ADS) + _TOP_ADS_JSON)
def _top3_ads_json(spark, sf):
    """Q5 key-value form: ``{"ad":count,...}`` per (day, area) in rank order."""
    return ads.top_ads_json(ads.top_ads_per_area(fx.clicks(spark, sf), TOP_N_ADS))


@register("trend_buckets", O.with_(O.CLICKS) + """
select adid, date_trunc('hour', ts) as bucket_start, count(*) as click_count
from clicks group by adid, date_trunc('hour', ts)""")
def _trend_buckets(spark, sf):
    """Clicks per ad and one-hour bucket."""
    return ads.trend_buckets(fx.clicks(spark, sf), TREND_B)


def _trend_cte(source: str, window: int, slide: int, bucket: int) -> str:
    """Per sliding window and ad, clicks per bucket; widths in seconds."""
    return f"""
trend as (
  select ws as window_start, ws + to_seconds({window}) as window_end, adid, bucket_start, count(*) as click_count
  from (select adid, time_bucket(to_seconds({bucket}), ts, timestamp '1970-01-01') as bucket_start,
               unnest([time_bucket(to_seconds({slide}), ts, timestamp '1970-01-01') - to_seconds(i * {slide})
                       for i in range(0, {window // slide})]) as ws
        from {source})
  group by ws, adid, bucket_start
)"""


_TREND = _trend_cte("clicks", 21600, 3600, 3600)
_TREND_DEFAULT = _trend_cte("clicks", 60, 10, 10)
_TREND_JSON = """
select window_start, window_end, 'time:advert:click:trend' as hash_key, adid as field,
       to_json(list(map_from_entries([struct_pack(k := strftime(bucket_start, '%M:%S'), v := click_count)])
                    order by bucket_start)) as value
from trend group by window_start, window_end, adid"""


@register("trend_sliding", O.with_(O.CLICKS, _TREND) + "select * from trend")
def _trend_sliding(spark, sf):
    """Q6: per sliding window and ad, clicks per bucket (6 h / 1 h / 1 h)."""
    return ads.trend(fx.clicks(spark, sf), TREND_W, TREND_S, TREND_B)


@register("trend_sliding_default", O.with_(O.CLICKS, _TREND_DEFAULT) + "select * from trend")
def _trend_sliding_default(spark, sf):
    """Q6 at the reference's own widths: 60 s windows every 10 s, 10 s buckets."""
    return ads.trend(fx.clicks(spark, sf))


@register("trend_json", O.with_(O.CLICKS, _TREND_DEFAULT) + _TREND_JSON)
def _trend_json(spark, sf):
    """Q6 key-value form: ``[{"mm:ss":count},...]`` per window and ad, at the reference's widths."""
    return ads.trend_json(ads.trend(fx.clicks(spark, sf)))


_BAN_BATCH = f"""
per_batch as (
  select cast(ts as date) as day, uid, adid, batch_id, count(*) as n
  from clicks group by cast(ts as date), uid, adid, batch_id
),
bans as (
  select uid, min(batch_id) as ban_batch from (
    select *, sum(n) over (partition by day, uid, adid order by batch_id
                           rows between unbounded preceding and current row) as running
    from per_batch) where running >= {THRESHOLD} group by uid
),
accepted as (
  select c.* from clicks c left join bans b on c.uid = b.uid
  where b.ban_batch is null or c.batch_id <= b.ban_batch
)"""


@register("user_day_ad_counts", O.with_(O.CLICKS, _BAN_BATCH) + """
select cast(ts as date) as day, uid, adid, count(*) as click_count
from accepted group by cast(ts as date), uid, adid""")
def _user_day_ad_counts(spark, sf):
    """Q7 counter hash: counted clicks per (day, user, ad)."""
    return ads.user_day_ad_counts(ads.accepted_per_batch(fx.clicks(spark, sf), THRESHOLD))


@register("banned_users", O.with_(O.CLICKS, _BAN_BATCH) + "select uid, ban_batch from bans")
def _banned_users(spark, sf):
    """Q7 blacklist: user and the batch at whose end they were banned."""
    return ads.ban_batches(fx.clicks(spark, sf), THRESHOLD)


@register("clicks_accepted_per_batch", O.with_(O.CLICKS, _BAN_BATCH) + "select * from accepted")
def _accepted_per_batch(spark, sf):
    """Q7a: clicks the live (per micro-batch) ban job counts."""
    return ads.accepted_per_batch(fx.clicks(spark, sf), THRESHOLD)


_BAN_EVENT = f"""
nth as (
  select * from (
    select uid, ts, event_id,
           row_number() over (partition by cast(ts as date), uid, adid order by ts, event_id) as r
    from clicks) where r = {THRESHOLD}
),
ev_bans as (
  select uid, ts as ban_ts, event_id as ban_event_id from (
    select *, row_number() over (partition by uid order by ts, event_id) as r2 from nth) where r2 = 1
),
accepted_ev as (
  select c.* from clicks c left join ev_bans b on c.uid = b.uid
  where b.ban_ts is null or c.ts < b.ban_ts or (c.ts = b.ban_ts and c.event_id <= b.ban_event_id)
)"""


@register("banned_users_per_event", O.with_(O.CLICKS, _BAN_EVENT) + "select * from ev_bans")
def _banned_users_per_event(spark, sf):
    """Q7b blacklist: user and the click that banned them."""
    return ads.ban_events(fx.clicks(spark, sf), THRESHOLD)


@register("clicks_accepted_per_event", O.with_(O.CLICKS, _BAN_EVENT) + "select * from accepted_ev")
def _accepted_per_event(spark, sf):
    """Q7b: clicks accepted when every click is checked as it arrives."""
    return ads.accepted_per_event(fx.clicks(spark, sf), THRESHOLD)


# ---------------------------------------------------------------- streaming

# Clicks this much older than the newest one are set aside by the bounded totals.
LATENESS = "3 days"


def _parts(spark) -> int:
    """State partitions of the fixture streams: one per core (the data is small)."""
    return max(1, spark.sparkContext.defaultParallelism)


def _click_stream(spark, sf):
    return fx.clicks_from_events(event_stream(spark, sf), fx.read_table(spark, sf, "nation"),
                                 fx.read_table(spark, sf, "region"))


def _replayed(spark, sf, start, shape=None):
    """The stores of a job after all micro-batches of the clicks."""
    base, last = shared_dir(spark, "streams", "replayed"), []

    def job(stream):
        last[:] = [start(stream, base)]
        return last[0]

    fx.replayed(spark, sf, job, shape)
    return last[0].stores


@register("daily_ad_totals_stream", O.with_(O.CLICKS, _DAILY) + "select * from daily")
def _daily_ad_totals_stream(spark, sf):
    """Q4 as a stream (update mode) into the keyed snapshot, read back."""
    job = streams.daily_totals_job(spark, _click_stream(spark, sf), state_partitions=_parts(spark))
    streams.run_to_end(job.query)
    return job.stores["totals"].read()


@register("daily_ad_totals_kv_stream", O.with_(O.CLICKS, _DAILY) + """
select 'date:area:city:ads' as hash_key, concat_ws(':', cast(day as varchar), area, city, adid) as field,
       cast(click_count as varchar) as value from daily""")
def _daily_ad_totals_kv_stream(spark, sf):
    """Q4's key-value hash as the stream writes it, over all micro-batches."""
    stores = _replayed(spark, sf, lambda c, base: streams.daily_totals_job(
        spark, c, base=base, state_partitions=_parts(spark)))
    return stores["kv"].read()


@register("daily_ad_totals_delta_stream", O.with_(O.CLICKS, _DAILY) + "select * from daily")
def _daily_ad_totals_delta_stream(spark, sf):
    """Q4 variant: stateless stream, per-batch increments summed by the snapshot."""
    job = streams.daily_totals_job(spark, _click_stream(spark, sf), state="delta",
                                   state_partitions=_parts(spark))
    streams.run_to_end(job.query)
    return job.stores["totals"].read()


@register("daily_ad_totals_emissions_stream", O.with_(O.CLICKS) + """
select b.batch_id - f.first as emission, cast(c.ts as date) as day, c.area, c.city, c.adid, count(*) as click_count
from (select unnest(range(min(batch_id), max(batch_id) + 1)) as batch_id from clicks) b
join clicks c on c.batch_id <= b.batch_id, (select min(batch_id) as first from clicks) f
group by all""")
def _daily_ad_totals_emissions(spark, sf):
    """Q4 as the reference emits it: all running totals after every micro-batch (complete mode)."""
    return _replayed(spark, sf, lambda c, base: streams.emissions_job(
        spark, c, base=base, state_partitions=_parts(spark)))["emissions"].read()


@register("daily_ad_totals_hash_stream", O.with_(O.CLICKS, _DAILY) + """
select 'date:area:city:ads' as hash_key, concat_ws(':', cast(day as varchar), area, city, adid) as field,
       cast(click_count as varchar) as value from daily""")
def _daily_ad_totals_hash(spark, sf):
    """Q4's hash through the data source whose partitions write by themselves and whose batches commit once."""
    out = shared_dir(spark, "streams", "hash")

    def job(stream, base):
        return streams.StreamJob(streams.hash_job(spark, stream, out, f"{base}/checkpoint",
                                                  state_partitions=_parts(spark)))

    _replayed(spark, sf, job)
    return read_hash(spark, out)


# Every tenth click arrives two batches (ten days) after its time.
_ARRIVALS = """
arrivals as (
  select *, batch_id + case when event_id % 10 = 0 then 2 else 0 end as arrival,
         ts + case when event_id % 10 = 0 then interval 10 day else interval 0 day end as arrival_ts
  from clicks
),
marks as (
  select a.arrival, (select max(ts) from arrivals b where b.arrival < a.arrival) - interval 3 day as mark
  from (select distinct arrival from arrivals) a
),
late as (select a.* from arrivals a join marks m using (arrival) where m.mark is not null and a.ts < m.mark)"""


def _arrived(spark, sf, start):
    """The stores of a job after the clicks came in order of arrival, one micro-batch for each."""
    base, folder = shared_dir(spark, "streams", "arrived"), shared_dir(spark, "replay", "arrivals")
    clicks = fx.clicks(spark, sf)
    late = F.col("event_id") % 10 == 0
    arrival_ts = F.when(late, F.col("ts") + F.expr("interval 10 days")).otherwise(F.col("ts"))
    first, last = clicks.agg(F.min("batch_id"), F.max("batch_id")).first()
    job = None
    for b in range(first, last + 3):
        some = clicks.where((F.col("batch_id") == b) & ~late | (F.col("batch_id") == b - 2) & late)
        some = some.withColumn("arrival_ts", arrival_ts)
        some.write.mode("append").parquet(folder)
        job = start(file_stream(spark, folder, some.schema), base)
        streams.run_to_end(job.query)
    return job.stores


def _bounded(spark, sf):
    return _arrived(spark, sf, lambda c, base: streams.daily_totals_job(
        spark, c.drop("arrival_ts"), base=base, max_lateness=LATENESS))


@register("daily_ad_totals_bounded_stream", O.with_(O.CLICKS, _ARRIVALS) + """
select cast(ts as date) as day, area, city, adid, count(*) as click_count
from arrivals where event_id not in (select event_id from late) group by 1, 2, 3, 4""")
def _daily_ad_totals_bounded_stream(spark, sf):
    """Q4 without clicks that come more than 3 days late; those are in ``late_clicks``."""
    return _bounded(spark, sf)["totals"].read()


@register("late_clicks", O.with_(O.CLICKS, _ARRIVALS) +
          "select event_id, ts, area, city, uid, adid, batch_id from late")
def _late_clicks(spark, sf):
    """The side store of the bounded totals: the clicks that came too late."""
    return streams.log_read(_bounded(spark, sf)["late"])


@register("top3_ads_per_area_bounded_stream", O.with_(O.CLICKS, _TOP_ADS) + "select * from top_ads")
def _top3_ads_bounded_stream(spark, sf):
    """Q5 over many micro-batches: only the touched days are read, only touched (day, area) groups ranked."""
    return _replayed(spark, sf, lambda c, base: streams.top_ads_job(spark, c, TOP_N_ADS, base=base))["ranks"].read()


@register("top3_ads_json_stream", O.with_(O.CLICKS, _TOP_ADS) + _TOP_ADS_JSON)
def _top3_ads_json_stream(spark, sf):
    """Q5's hash as the stream leaves it, over clicks of which every tenth comes ten days late."""
    return _arrived(spark, sf, lambda c, base: streams.top_ads_job(spark, c, TOP_N_ADS, base=base))["kv"].read()


@register("top3_ads_per_area_stream", O.with_(O.CLICKS, _TOP_ADS) + "select * from top_ads")
def _top3_ads_stream(spark, sf):
    """Q5 as a stream, read back."""
    job = streams.top_ads_job(spark, _click_stream(spark, sf), TOP_N_ADS, state_partitions=_parts(spark))
    streams.run_to_end(job.query)
    return job.stores["ranks"].read()


@register("trend_sliding_stream", O.with_(O.CLICKS, _TREND) + "select * from trend")
def _trend_stream(spark, sf):
    """Q6 as a stream over many micro-batches: panes are stored, windows (open ones too) expanded on read."""
    stores = _replayed(spark, sf, lambda c, base: streams.trend_job(spark, c, TREND_W, TREND_S, TREND_B, base=base))
    return streams.trend_windows(stores["panes"].read(), TREND_W, TREND_S)


# The watermark of the windowed trend stays this much behind the newest click.
TREND_LATENESS = "1 day"
_TREND_MARK = "(select max(ts) - interval 1 day from clicks)"


def _trend_windows(spark, sf):
    return _replayed(spark, sf, lambda c, base: streams.trend_windows_job(
        spark, c, TREND_W, TREND_S, TREND_B, TREND_LATENESS, base=base, state_partitions=_parts(spark)))


@register("trend_closed_windows_stream", O.with_(O.CLICKS, _TREND) +
          f"select * from trend where window_end <= {_TREND_MARK}")
def _trend_closed_windows(spark, sf):
    """Q6 by watermark, two aggregations in a chain: the windows that are closed, each emitted once."""
    return _trend_windows(spark, sf)["closed"].read()


@register("trend_open_windows_stream", O.with_(O.CLICKS, _TREND) +
          f"select * from trend where window_end > {_TREND_MARK}")
def _trend_open_windows(spark, sf):
    """The other windows of the same job, as far as they are filled: what its two operators keep as state."""
    return _trend_windows(spark, sf)["open"].read()


_ARRIVED_TREND = """
arrived_panes as (
  select adid, date_trunc('hour', arrival_ts) as pane, date_trunc('hour', ts) as bucket_start, count(*) as click_count
  from arrivals group by all
)"""


def _arrived_trend(spark, sf):
    return _arrived(spark, sf, lambda c, base: streams.trend_job(
        spark, c, TREND_W, TREND_S, TREND_B, base=base, window_col="arrival_ts"))


@register("trend_arrival_stream", O.with_(O.CLICKS, _ARRIVALS, _ARRIVED_TREND) + """
select ws as window_start, ws + interval 6 hour as window_end, adid, bucket_start,
       cast(sum(click_count) as bigint) as click_count
from (select adid, bucket_start, click_count, unnest([pane - to_hours(i) for i in range(0, 6)]) as ws from arrived_panes)
group by ws, adid, bucket_start""")
def _trend_arrival(spark, sf):
    """Q6 over arrival time, as the reference's window is: late clicks show as old buckets of the present window."""
    return streams.trend_windows(_arrived_trend(spark, sf)["panes"].read(), TREND_W, TREND_S)


def _trend_hash_sql(panes: str) -> str:
    """Per ad, its buckets in the last window, of those begun up to the newest pane, that holds a click of it."""
    return f"""
select 'time:advert:click:trend' as hash_key, adid as field,
       to_json(list(map_from_entries([struct_pack(k := strftime(bucket_start, '%M:%S'), v := n)])
                    order by bucket_start)) as value
from (select adid, bucket_start, cast(sum(click_count) as bigint) as n
      from (select *, max(pane) over (partition by adid) as own, max(pane) over () as newest from {panes})
      where pane >= least(own, newest - interval 5 hour) group by adid, bucket_start)
group by adid"""


@register("trend_hash_arrival_stream", O.with_(O.CLICKS, _ARRIVALS, _ARRIVED_TREND) + _trend_hash_sql("arrived_panes"))
def _trend_hash_arrival(spark, sf):
    """Q6's hash over arrival time, with late clicks among the present ones."""
    return _arrived_trend(spark, sf)["kv"].read()


@register("trend_hash_stream", O.with_(O.CLICKS, _ARRIVALS) + _trend_hash_sql("""(
  select adid, date_trunc('hour', ts) as pane, date_trunc('hour', ts) as bucket_start, count(*) as click_count
  from arrivals group by all)"""))
def _trend_hash(spark, sf):
    """Q6's hash over event time; the last two micro-batches bring old clicks only and leave it as it is."""
    return _arrived(spark, sf, lambda c, base: streams.trend_job(
        spark, c, TREND_W, TREND_S, TREND_B, base=base))["kv"].read()


@register("clicks_accepted_stream", O.with_(O.CLICKS, _BAN_BATCH) + "select * from accepted")
def _accepted_stream(spark, sf):
    """Q7a live: clicks replayed one micro-batch per ``batch_id``; the ban of
    batch b applies from batch b+1."""
    stores = _replayed(spark, sf, lambda c, base: streams.ban_job(spark, c, THRESHOLD, base=base))
    return streams.log_read(stores["accepted"])


@register("clicks_accepted_per_event_stream", O.with_(O.CLICKS, _BAN_EVENT) + "select * from accepted_ev")
def _accepted_per_event_stream(spark, sf):
    """Q7b live: each click is checked against the ones before it, in ts order within a batch."""
    stores = _replayed(spark, sf, lambda c, base: streams.per_event_ban_job(spark, c, THRESHOLD, base=base))
    return streams.log_read(stores["accepted"])


# ------------------------------------------------------- jobs from raw lines

def _clicks_from_lines(spark, sf):
    return ads.clicks_from_lines(fx.ad_lines(spark, sf))


def _on_lines(cte: str) -> str:
    return cte.replace("from clicks", "from line_clicks")


@register("daily_ad_totals_from_lines", O.with_(*_LINE_VIEWS, _on_lines(_DAILY)) + "select * from daily")
def _daily_from_lines(spark, sf):
    """Q4 from raw ad-log lines."""
    return ads.daily_totals(_clicks_from_lines(spark, sf))


@register("top3_ads_from_lines", O.with_(*_LINE_VIEWS, _on_lines(_TOP_ADS)) + "select * from top_ads")
def _top3_from_lines(spark, sf):
    """Q5 from raw ad-log lines."""
    return ads.top_ads_per_area(_clicks_from_lines(spark, sf), TOP_N_ADS)


@register("trend_from_lines", O.with_(*_LINE_VIEWS, _trend_cte("line_clicks", 60, 10, 10)) + "select * from trend")
def _trend_from_lines(spark, sf):
    """Q6 from raw ad-log lines, at the reference's widths."""
    return ads.trend(_clicks_from_lines(spark, sf))


def _line_stream(stream):
    """Clicks of a stream of lines; no id, as in the reference's topic."""
    return ads.clicks_from_lines(stream)


def _only_lines(clicks):
    return fx.ad_lines_from_clicks(clicks).select("value")


_LINE_COLS = "ts, area, city, uid, adid"
_LINE_BAN = _on_lines(_BAN_BATCH).replace("select c.* from clicks c", "select c.* from line_clicks c")


def _lines_ban(spark, sf, job):
    return _replayed(spark, sf, lambda lines, base: job(spark, _line_stream(lines), THRESHOLD, base=base), _only_lines)


@register("clicks_accepted_from_lines_stream", O.with_(*_LINE_VIEWS, _LINE_BAN) +
          f"select {_LINE_COLS} from accepted")
def _accepted_from_lines(spark, sf):
    """Q7a live from raw lines: the accepted log (equal clicks all count)."""
    return streams.log_read(_lines_ban(spark, sf, streams.ban_job)["accepted"])


@register("ban_counters_stream", O.with_(*_LINE_VIEWS, _LINE_BAN) + """
select 'date:user:advert:clickcount' as hash_key,
       concat_ws(':', cast(cast(ts as date) as varchar), uid, adid) as field, cast(count(*) as varchar) as value
from accepted group by cast(ts as date), uid, adid""")
def _ban_counters_stream(spark, sf):
    """Q7a's counter hash as the live job leaves it, from raw lines."""
    return ads.counters_kv(_lines_ban(spark, sf, streams.ban_job)["counters"].read())


@register("blacklist_stream", O.with_(*_LINE_VIEWS, _LINE_BAN) +
          "select distinct 'blacklist' as set_key, uid as member from bans")
def _blacklist_stream(spark, sf):
    """Q7a's blacklist set as the live job leaves it, from raw lines."""
    return ads.blacklist_members(_lines_ban(spark, sf, streams.ban_job)["blacklist"].read())


# Without ids, clicks equal in every field can stand for each other.
_LINE_BAN_EVENT = """
ordered as (
  select *, row_number() over (partition by uid order by ts, area, city, adid) as place from line_clicks
),
nth as (
  select uid, place, row_number() over (partition by cast(ts as date), uid, adid order by place) as r from ordered
),
ev_bans as (select uid, min(place) as ban from nth where r = 2 group by uid),
accepted_ev as (select o.* from ordered o left join ev_bans b using (uid) where b.ban is null or o.place <= b.ban)"""


@register("clicks_accepted_per_event_from_lines_stream", O.with_(*_LINE_VIEWS, _LINE_BAN_EVENT) +
          f"select {_LINE_COLS} from accepted_ev")
def _accepted_per_event_from_lines(spark, sf):
    """Q7b live from raw lines, in (ts, other fields) order."""
    return streams.log_read(_lines_ban(spark, sf, streams.per_event_ban_job)["accepted"])


# -------------------------------------------------------- documents and keys

@register("param_documents", """
select event_id, cast(user_id as varchar) as user, cast(event_type as varchar) as kind, cast(null as varchar) as missing
from events""")
def _param_documents(spark, sf):
    """Parameters looked up in a column of JSON documents (one for each event)."""
    e = fx.read_table(spark, sf, "events")
    doc = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")))
    docs = e.select("event_id", doc.alias("doc"))
    return docs.select("event_id", *[param_column("doc", k).alias(k) for k in ("user", "kind", "missing")])


@register("imported_total_keys", O.with_(O.CLICKS, _DAILY) + """
select cast(day as varchar) as day, area, city, adid, cast(click_count as varchar) as value from daily""")
def _imported_total_keys(spark, sf):
    """Composite string keys of the totals hash, taken apart again."""
    kv = ads.daily_totals_kv(ads.daily_totals(fx.clicks(spark, sf)))
    return kv.select(*key_columns("field", ":", ["day", "area", "city", "adid"]), "value")


# -------------------------------------------------------------------- sinks

@register("table_overwrite_roundtrip", O.with_(O.VISITS) + f"select {_VISIT_COLS} from visits")
def _table_roundtrip(spark, sf):
    """The visit log saved as a catalog table (drop and replace, twice) and read back."""
    v = fx.visits(spark, sf)
    path = shared_dir(spark, "tables", "user_visit_action")
    overwrite_table(v, "clicklens_user_visit_action", path=path, partition_by=["date"])
    overwrite_table(v, "clicklens_user_visit_action", path=path, partition_by=["date"])
    return spark.table("clicklens_user_visit_action").select(*VISIT_COLUMNS)


@register("keyed_snapshot_roundtrip", O.with_(O.CLICKS, _DAILY) + """
select 'date:area:city:ads' as hash_key,
       concat_ws(':', cast(day as varchar), area, city, adid) as field,
       cast(click_count as varchar) as value
from daily""")
def _snapshot_roundtrip(spark, sf):
    """Absolute upserts of the whole totals hash as two versions, the second
    one written twice (a replayed batch), then compacted: the read-back equals
    one clean run. Partial updates are unit-tested in tests/test_streaming.py."""
    from clicklens.sinks.snapshot import KeyedSnapshot
    from clicklens.streaming.ads_streams import KV_SCHEMA
    kv = ads.daily_totals_kv(ads.daily_totals(fx.clicks(spark, sf)))
    store = KeyedSnapshot(spark, shared_dir(spark, "snapshots", "totals"), ["hash_key", "field"], KV_SCHEMA, "set")
    store.write(kv, 0)
    store.compact(0)
    store.write(kv, 1)
    store.write(kv, 1)   # replay of batch 1
    return store.read()
