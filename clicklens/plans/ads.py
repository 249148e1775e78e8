"""Ad-click jobs as DataFrame -> DataFrame functions (batch and stream share them).

Input: typed clicks ``(ts, area, city, uid, adid[, event_id, batch_id])``;
``clicks_from_lines`` turns ad-log lines into that form.

* ``daily_totals``: running count per (day, area, city, ad).
* ``top_ads_per_area``: count per (day, area, ad), best ``n`` per (day, area).
* ``trend``: per sliding window and ad, counts of the clicks in each bucket.
  Clicks are first counted per (ad, bucket) (map-side partial aggregate),
  and only that small result is expanded into the ``window / slide``
  windows each bucket falls in; raw clicks are never multiplied.
* ``ban``: users whose clicks on one ad in one day reach a threshold are
  banned. Per batch (live job): counted in full up to the batch of the ban,
  dropped afterwards. Per event (the commented-out variant): dropped after the
  threshold-th click itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.functions.columns import (
    ad_line_columns, ad_line_fields, ad_line_is_complete, clock_label, day_of, floor_time,
    interval_seconds, is_millis, map_json, millis_to_ntz, pair_list_json,
)
from clicklens.model import BAN_THRESHOLD, TOP_ADS, TREND_BUCKET, TREND_SLIDE, TREND_WINDOW
from clicklens.operators.lookup import checked_side
from clicklens.operators.topk import top_n_per_group

# Key-value names of the reference's result hashes (fixed values).
TOTALS_HASH = "date:area:city:ads"
TOP_ADS_HASH_PREFIX = "top3_ads_per_day:"
TREND_HASH = "time:advert:click:trend"
COUNTER_HASH = "date:user:advert:clickcount"
BLACKLIST_SET = "blacklist"


# ------------------------------------------------------------------ parsing

def parse_lines(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ad-log lines into ``(time, area, cid, uid, adid)``.

    Returns ``(parsed, quarantined)``: lines with fewer than five fields or a
    ``time`` that is no number go to the second frame instead of failing the
    job. Other columns are kept.
    """
    keep = [c for c in lines.columns if c != value]
    parts = ad_line_fields(value)
    df = lines.withColumn("_parts", parts)
    ok = F.coalesce(ad_line_is_complete(F.col("_parts")) & is_millis(F.get("_parts", F.lit(0))), F.lit(False))
    parsed = df.where(ok).select(*keep, *ad_line_columns(F.col("_parts")))
    quarantined = df.where(~ok).select(*keep, value)
    return parsed, quarantined


def clicks_from_ad_clicks(parsed: DataFrame) -> DataFrame:
    """Typed clicks from parsed lines (``time`` is epoch millis as text)."""
    keep = [c for c in parsed.columns if c not in ("time", "area", "cid", "uid", "adid")]
    return parsed.select(*keep, millis_to_ntz("time").alias("ts"), "area",
                         F.col("cid").alias("city"), "uid", "adid")


def clicks_from_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    return clicks_from_ad_clicks(parse_lines(lines, value)[0])


# ------------------------------------------------------------ daily totals

def daily_totals(clicks: DataFrame) -> DataFrame:
    """``(day, area, city, adid, click_count)``."""
    return (clicks.groupBy(day_of("ts").alias("day"), "area", "city", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def daily_totals_kv(totals: DataFrame) -> DataFrame:
    """Key-value form: hash ``date:area:city:ads``, field ``day:area:city:ad``."""
    return totals.select(
        F.lit(TOTALS_HASH).alias("hash_key"),
        F.concat_ws(":", F.col("day").cast("string"), "area", "city", "adid").alias("field"),
        F.col("click_count").cast("string").alias("value"))


# ------------------------------------------------------- top ads per area

def area_ad_counts(clicks: DataFrame) -> DataFrame:
    """``(day, area, adid, click_count)``, cities merged."""
    return (clicks.groupBy(day_of("ts").alias("day"), "area", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def rank_area_ads(counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Best ``n`` ads per (day, area) by count, ad id breaking ties: adds ``rk``."""
    return top_n_per_group(counts, ["day", "area"], [F.desc("click_count"), F.asc("adid")], n, "rk")


def top_ads_per_area(clicks: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """``(day, area, adid, click_count, rk)``."""
    return rank_area_ads(area_ad_counts(clicks), n)


def top_ads_json(ranked: DataFrame) -> DataFrame:
    """Key-value form: hash ``top3_ads_per_day:<day>``, field area, value
    ``{"ad":count,...}`` in rank order. Each list holds at most ``n`` entries."""
    g = (ranked.groupBy("day", "area")
         .agg(F.sort_array(F.collect_list(F.struct("rk", "adid", "click_count"))).alias("_l")))
    entries = F.transform("_l", lambda e: F.struct(e.getField("adid").alias("k"),
                                                   e.getField("click_count").alias("v")))
    return g.select(F.concat(F.lit(TOP_ADS_HASH_PREFIX), F.col("day").cast("string")).alias("hash_key"),
                    F.col("area").alias("field"), map_json(entries).alias("value"))


# ------------------------------------------------------------------- trend

def _check_trend(window: str, slide: str, bucket: str) -> tuple[int, int, int]:
    w, s, b = interval_seconds(window), interval_seconds(slide), interval_seconds(bucket)
    if s % b or w % b or w % s:
        raise ValueError("window and slide must be multiples of the bucket, window of the slide")
    return w, s, b


def trend_buckets(clicks: DataFrame, bucket: str = TREND_BUCKET) -> DataFrame:
    """``(adid, bucket_start, click_count)``: clicks per ad and time bucket."""
    b = interval_seconds(bucket)
    return (clicks.groupBy("adid", floor_time("ts", b).alias("bucket_start"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def _epoch_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            ts.cast("timestamp_ntz"))


def _from_epoch_seconds(sec: Column) -> Column:
    return F.timestamp_add("SECOND", sec, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def trend(clicks: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
          bucket: str = TREND_BUCKET) -> DataFrame:
    """``(window_start, window_end, adid, bucket_start, click_count)``.

    A bucket ``[t, t+B)`` lies in every window ``[s, s+W)`` with ``s`` a
    multiple of the slide and ``t+B-W <= s <= t``: the same windows as
    ``window(ts, W, slide)`` gives each of its clicks.
    """
    return bucket_windows(trend_buckets(clicks, bucket), window, slide, bucket)


def bucket_windows(buckets: DataFrame, window: str, slide: str, bucket: str) -> DataFrame:
    """Every row (adid, bucket_start, click_count) in the windows that its bucket lies in."""
    w, s, b = _check_trend(window, slide, bucket)
    t = _epoch_seconds(F.col("bucket_start"))
    first = F.ceil((t + F.lit(b - w)) / F.lit(s)) * s
    last = F.floor(t / F.lit(s)) * s
    starts = F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(s).cast("long")))
    return (buckets
            .select("adid", "bucket_start", "click_count", starts.alias("_ws"))
            .select(_from_epoch_seconds(F.col("_ws")).alias("window_start"),
                    _from_epoch_seconds(F.col("_ws") + F.lit(w)).alias("window_end"),
                    "adid", "bucket_start", "click_count"))


def trend_json(flat: DataFrame) -> DataFrame:
    """List form per (window, ad): ``[{"mm:ss":count}, ...]`` in time order
    (sorted by the bucket's timestamp, labelled afterwards). Lists hold at
    most ``window / bucket`` entries."""
    g = (flat.groupBy("window_start", "window_end", "adid")
         .agg(F.sort_array(F.collect_list(F.struct("bucket_start", "click_count"))).alias("_l")))
    entries = F.transform("_l", lambda e: F.struct(clock_label(e.getField("bucket_start")).alias("k"),
                                                   e.getField("click_count").alias("v")))
    return g.select("window_start", "window_end", F.lit(TREND_HASH).alias("hash_key"),
                    F.col("adid").alias("field"), pair_list_json(entries).alias("value"))


# --------------------------------------------------------------------- ban

def _reaching(clicks: DataFrame, threshold: int) -> DataFrame:
    """(day, uid, adid) whose clicks reach ``threshold``: a partial count first, so few keys are left."""
    return user_day_ad_counts(clicks).where(F.col("click_count") >= threshold).select("day", "uid", "adid")


def ban_batches(clicks: DataFrame, threshold: int = BAN_THRESHOLD) -> DataFrame:
    """``(uid, ban_batch)``: first batch at whose end some (day, user, ad)
    running count reaches ``threshold``.

    Clicks are counted per (day, user, ad, batch) where they are read; the
    running sum goes over those counts, at most one row for each batch of a day.
    """
    key = ["day", "uid", "adid"]
    per_batch = (clicks.groupBy(day_of("ts").alias("day"), "uid", "adid", "batch_id")
                 .agg(F.count(F.lit(1)).alias("n")))
    running = F.sum("n").over(Window.partitionBy(*key).orderBy("batch_id")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (per_batch.withColumn("running", running).where(F.col("running") >= threshold)
            .groupBy("uid").agg(F.min("batch_id").alias("ban_batch")))


def _split_by_ban(clicks: DataFrame, bans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clicks of users without a ban, clicks of banned users with their ban).

    The bans are materialised first. If they are few enough they are broadcast
    and no click is shuffled; otherwise both sides are joined by shuffle, where
    AQE splits the clicks of a hot user.
    """
    bans = checked_side(bans)
    return clicks.join(bans, "uid", "left_anti"), clicks.join(bans, "uid")


def accepted_per_batch(clicks: DataFrame, threshold: int = BAN_THRESHOLD,
                       bans: DataFrame | None = None) -> DataFrame:
    """Clicks the live job counts: all clicks of a user up to and including
    the batch that bans them, none after."""
    bans = checked_side(ban_batches(clicks, threshold) if bans is None else bans)
    j = clicks.join(bans, "uid", "left")
    return (j.where(F.col("ban_batch").isNull() | (F.col("batch_id") <= F.col("ban_batch")))
            .select(*clicks.columns))


def user_day_ad_counts(accepted: DataFrame) -> DataFrame:
    """``(day, uid, adid, click_count)``: the counter hash over counted clicks."""
    return (accepted.groupBy(day_of("ts").alias("day"), "uid", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def counters_kv(counts: DataFrame) -> DataFrame:
    """Key-value form of the counters: hash ``date:user:advert:clickcount``, field ``day:user:ad``."""
    return counts.select(F.lit(COUNTER_HASH).alias("hash_key"),
                         F.concat_ws(":", F.col("day").cast("string"), "uid", "adid").alias("field"),
                         F.col("click_count").cast("string").alias("value"))


def blacklist_members(banned: DataFrame) -> DataFrame:
    """Set form of the banned users: ``(set_key, member)``, each user once."""
    return banned.select(F.lit(BLACKLIST_SET).alias("set_key"), F.col("uid").alias("member")).distinct()


def first_bans(clicks: DataFrame, reach: DataFrame, place: Column, threshold: int) -> DataFrame:
    """``(uid, ban, equals)``: the place of the click that bans each user, and how
    many of the clicks equal to it are accepted.

    ``reach`` has the keys (day, uid, adid) that reach the threshold and ``need``,
    the clicks it takes. It is materialised, and broadcast if small, so that only
    those keys' clicks are ranked, at most ``threshold`` for each key and map task
    crossing the shuffle.
    """
    key = ["day", "uid", "adid"]
    reach = checked_side(reach)
    c = (clicks.select(day_of("ts").alias("day"), "uid", "adid", place.alias("ban"))
         .join(reach, key, "left_semi"))
    ranked = top_n_per_group(c, key, ["ban"], threshold, "nth")
    w = Window.partitionBy(*key).orderBy("ban")
    nth = (ranked.withColumn("equals", F.col("nth") - F.rank().over(w) + 1)
           .join(reach, key).where(F.col("nth") == F.col("need")))
    first = F.min(F.struct("ban", "equals"))
    return nth.groupBy("uid").agg(first.alias("_b")).select("uid", "_b.ban", "_b.equals")


def accepted_up_to(clicks: DataFrame, bans: DataFrame, place: Column) -> DataFrame:
    """Clicks before each user's ban and, of those equal to the banning click, ``equals``."""
    free, banned = _split_by_ban(clicks, bans)
    banned = banned.withColumn("_place", place)
    before = banned.where(F.col("_place") < F.col("ban"))
    nth = F.row_number().over(Window.partitionBy("uid", "_place").orderBy(F.lit(0)))
    at = banned.where(F.col("_place") == F.col("ban")).withColumn("_nth", nth).where("_nth <= equals")
    cols = clicks.columns
    return free.select(*cols).unionByName(before.select(*cols)).unionByName(at.select(*cols))


def ban_events(clicks: DataFrame, threshold: int = BAN_THRESHOLD) -> DataFrame:
    """``(uid, ban_ts, ban_event_id)``: earliest threshold-th click of the user
    over all (day, ad), in ``(ts, event_id)`` order; keys are counted first and
    only those that reach the threshold are ranked."""
    reach = _reaching(clicks, threshold).withColumn("need", F.lit(threshold))
    bans = first_bans(clicks, reach, F.struct("ts", "event_id"), threshold)
    return bans.select("uid", F.col("ban.ts").alias("ban_ts"), F.col("ban.event_id").alias("ban_event_id"))


def accepted_per_event(clicks: DataFrame, threshold: int = BAN_THRESHOLD) -> DataFrame:
    """Clicks accepted by a per-event check: everything up to and including
    the click that makes a counter reach ``threshold``."""
    j = clicks.join(checked_side(ban_events(clicks, threshold)), "uid", "left")
    ts, bt = F.col("ts"), F.col("ban_ts")
    keep = (bt.isNull() | (ts < bt) | ((ts == bt) & (F.col("event_id") <= F.col("ban_event_id"))))
    return j.where(keep).select(*clicks.columns)
