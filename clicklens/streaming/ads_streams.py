"""The four ad-click streaming jobs on Structured Streaming.

Each job = a stream of typed clicks -> the batch function of ``plans.ads`` ->
a ``foreachBatch`` write into stores keyed by the micro-batch id, so a batch
replayed after a failure rewrites the same version instead of adding twice. A
restarted query continues from its checkpoint.

* totals: count per (day, area, city, ad). ``state="spark"`` keeps the running
  totals in the state store (``update`` mode); ``state="delta"`` stores each
  batch's own counts and sums them on read; ``max_lateness`` keeps the totals of
  open days only, carried from batch to batch: a day behind the watermark leaves
  for the ``closed`` log, a click behind it for the ``late`` log.
  ``emissions_job`` emits all totals after every batch (``complete`` mode);
  ``hash_job`` sends them to a data source that commits by batch.
* top ads: each batch's counts per (day, area, ad) go to a store partitioned by
  day and a bucket of (day, area); only the groups that the batch touched are
  ranked again, and only their buckets read.
* trend: each batch's counts per (ad, slide pane, bucket) go to a store; windows
  are expanded from it on read, open ones too. No click is too late: an old one
  shows as an old bucket. The trend hash follows the newest window of all batches
  so far, which never goes back. ``trend_windows_job`` is the same by watermark:
  two aggregations in a chain, closed windows appended, open ones in the state.
* ban: a batch drops the clicks of users banned before it, counts the rest per
  (day, user, ad), and bans the users whose counter reached the threshold, from
  the next batch on (``ban_job``) or after that very click
  (``per_event_ban_job``). All in the JVM; counters are read for the batch's
  days only, members for the buckets of its users. The accepted clicks are a log,
  so equal clicks all count.

The jobs default to ``availableNow`` (process what is there, then stop);
pass ``trigger="5 seconds"`` (``model.TOTALS_TRIGGER``) for a live job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicklens.config import shared_dir
from clicklens.functions.columns import day_of, floor_time, interval_seconds
from clicklens.model import BAN_THRESHOLD, TOP_ADS, TREND_BUCKET, TREND_SLIDE, TREND_WINDOW
from clicklens.operators.lookup import drop_in
from clicklens.plans import ads
from clicklens.sinks.carried import Carried
from clicklens.sinks.hash_source import NAME as HASH_SOURCE
from clicklens.sinks.hash_source import use_hash_source
from clicklens.sinks.members import BucketedSet
from clicklens.sinks.snapshot import KeyedSnapshot

AVAILABLE_NOW = "available_now"
# Every this many micro-batches a job folds its snapshots into a base version.
COMPACT_EVERY = 50


def _compacting(sink, stores, every: int):
    """Run ``sink``, then every ``every`` batches compact ``stores`` as of this
    batch. A replayed batch rewrites the same base, so this stays idempotent."""
    def run(df: DataFrame, batch_id: int) -> None:
        sink(df, batch_id)
        if every and (batch_id + 1) % every == 0:
            for s in stores:
                s.compact(batch_id)
    return run


def _start(df: DataFrame, mode: str, sink, checkpoint: str, trigger: str, stores=(),
           compact_every: int = COMPACT_EVERY, state_partitions: int | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query. ``state_partitions``: number of state
    store partitions (default: the session's ``spark.sql.shuffle.partitions``);
    a query keeps the number it first started with for its checkpoint's life."""
    sink = _compacting(sink, list(stores), compact_every)
    return _run(df.sparkSession, df.writeStream.outputMode(mode).foreachBatch(sink), checkpoint, trigger,
                state_partitions)


def _run(spark: SparkSession, w, checkpoint: str, trigger: str, state_partitions: int | None) -> StreamingQuery:
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == AVAILABLE_NOW else w.trigger(processingTime=trigger)
    if state_partitions is None:
        return w.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))   # read once, when the query starts
    try:
        return w.start()
    finally:
        spark.conf.set(key, old)


def run_to_end(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query; fail loudly if it failed. There is
    no time limit unless the caller sets one."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} still running after {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@dataclass(frozen=True)
class View:
    """A store's rows in another form, made when they are read."""
    read: Callable[[], DataFrame]


@dataclass
class StreamJob:
    query: StreamingQuery
    stores: dict[str, KeyedSnapshot | BucketedSet | View] = field(default_factory=dict)


def _fields(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _log_schema(clicks: DataFrame) -> T.StructType:
    """The input's columns; its own ``batch_id`` is stored as ``source_batch``."""
    return T.StructType([T.StructField("source_batch" if f.name == "batch_id" else f.name, f.dataType)
                         for f in clicks.schema.fields])


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("batch_id", "source_batch")


def log_read(store: KeyedSnapshot) -> DataFrame:
    """The rows of a click log under the input's column names."""
    return store.read().withColumnRenamed("source_batch", "batch_id")


KV_SCHEMA = _fields(("hash_key", T.StringType()), ("field", T.StringType()), ("value", T.StringType()))

# ------------------------------------------------------------------ totals

TOTALS_SCHEMA = _fields(("day", T.DateType()), ("area", T.StringType()), ("city", T.StringType()),
                        ("adid", T.StringType()), ("click_count", T.LongType()))
NEWEST_SCHEMA = _fields(("newest", T.TimestampNTZType()))


def split_late(batch: DataFrame, newest: dt.datetime | None, lateness: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late) clicks of a batch: late ones are older than the newest
    click of all earlier batches less ``lateness``. Nothing is lost: the caller
    stores both."""
    if newest is None:
        return batch, batch.where("false")
    mark = F.lit(newest - dt.timedelta(seconds=interval_seconds(lateness))).cast("timestamp_ntz")
    late = F.coalesce(F.col("ts").cast("timestamp_ntz") < mark, F.lit(False))
    return batch.where(~late), batch.where(late)


def _newest(mark: Carried, batch: DataFrame, batch_id: int, column) -> tuple[dt.datetime | None, dt.datetime | None]:
    """(newest time before the batch, and with it); the latter is carried on and never goes back."""
    before = mark.read(batch_id).agg(F.max("newest")).first()[0]
    own = batch.agg(F.max(column)).first()[0]
    now = max((x for x in (before, own) if x is not None), default=None)
    mark.write(batch.sparkSession.range(1).select(F.lit(now).cast("timestamp_ntz").alias("newest")), batch_id)
    return before, now


def _bounded_totals_job(spark: SparkSession, clicks: DataFrame, trigger: str, base: str, max_lateness: str,
                        state_partitions: int | None) -> StreamJob:
    keys = ["day", "area", "city", "adid"]
    newest = Carried(spark, f"{base}/newest", NEWEST_SCHEMA)
    days = Carried(spark, f"{base}/open", TOTALS_SCHEMA)
    closed = KeyedSnapshot(spark, f"{base}/closed", keys, TOTALS_SCHEMA, "log")
    late = KeyedSnapshot(spark, f"{base}/late", [], _log_schema(clicks), "log")
    lateness = dt.timedelta(seconds=interval_seconds(max_lateness))

    def add(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            before, now = _newest(newest, df, batch_id, F.col("ts").cast("timestamp_ntz"))
            on_time, too_late = split_late(df, before, max_lateness)
            late.write(_renamed(too_late), batch_id)
            total = (days.read(batch_id).unionByName(ads.daily_totals(on_time)).groupBy(*keys)
                     .agg(F.sum("click_count").alias("click_count")).persist())
            # No click of a day that ends at or before the watermark will be on time again.
            over = F.lit(False) if now is None else F.coalesce(F.col("day") < F.lit((now - lateness).date()), F.lit(False))
            days.write(total.where(~over), batch_id)
            closed.write(total.where(over), batch_id)
            total.unpersist()
        finally:
            df.unpersist()

    q = _start(clicks, "append", add, f"{base}/checkpoint", trigger, state_partitions=state_partitions)
    totals = View(lambda: closed.read().unionByName(days.latest()))
    return StreamJob(q, {"totals": totals, "late": late, "closed": closed, "open": View(days.latest)})


def daily_totals_job(spark: SparkSession, clicks: DataFrame, trigger: str = AVAILABLE_NOW,
                     base: str | None = None, max_lateness: str | None = None, state: str = "spark",
                     state_partitions: int | None = None) -> StreamJob:
    """Stores: ``totals`` and ``kv``, their key-value hash. With ``max_lateness`` also ``late`` (clicks that came too
    late and are not counted), ``closed`` and ``open`` (totals of days behind the watermark, and of the others)."""
    base = base or shared_dir(spark, "streams", "daily_totals")
    keys = ["day", "area", "city", "adid"]
    if max_lateness:
        job = _bounded_totals_job(spark, clicks, trigger, base, max_lateness, state_partitions)
    elif state == "delta":
        store = KeyedSnapshot(spark, f"{base}/totals", keys, TOTALS_SCHEMA, "add", by_day=True)
        q = _start(clicks, "append", lambda df, batch_id: store.write(ads.daily_totals(df), batch_id),
                   f"{base}/checkpoint", trigger, [store], state_partitions=state_partitions)
        job = StreamJob(q, {"totals": store})
    else:
        store = KeyedSnapshot(spark, f"{base}/totals", keys, TOTALS_SCHEMA, "set")
        q = _start(ads.daily_totals(clicks), "update", store.write, f"{base}/checkpoint", trigger, [store],
                   state_partitions=state_partitions)
        job = StreamJob(q, {"totals": store})
    totals = job.stores["totals"]
    return StreamJob(job.query, job.stores | {"kv": View(lambda: ads.daily_totals_kv(totals.read()))})


EMISSION_SCHEMA = _fields(("emission", T.LongType()), *[(f.name, f.dataType) for f in TOTALS_SCHEMA.fields])


def emissions_job(spark: SparkSession, clicks: DataFrame, trigger: str = AVAILABLE_NOW, base: str | None = None,
                  state_partitions: int | None = None) -> StreamJob:
    """Totals as the reference prints them: every key after every batch (``complete`` mode).

    Store: ``emissions``, a log with the number of the batch that emitted a row."""
    base = base or shared_dir(spark, "streams", "emissions")
    store = KeyedSnapshot(spark, f"{base}/emissions", [], EMISSION_SCHEMA, "log")

    def sink(df: DataFrame, batch_id: int) -> None:
        store.write(df.withColumn("emission", F.lit(batch_id).cast("long")), batch_id)

    q = _start(ads.daily_totals(clicks), "complete", sink, f"{base}/checkpoint", trigger,
               state_partitions=state_partitions)
    return StreamJob(q, {"emissions": store})


def hash_job(spark: SparkSession, clicks: DataFrame, path: str, checkpoint: str, trigger: str = AVAILABLE_NOW,
             state_partitions: int | None = None) -> StreamingQuery:
    """Totals as hash fields into the ``clicklens_hash`` data source at ``path``: every partition writes by itself,
    every batch commits once (``sinks.hash_source.read_hash`` reads it). All totals after every batch, as the
    reference sets them: sources written in Python take no update mode."""
    use_hash_source(spark)
    kv = ads.daily_totals_kv(ads.daily_totals(clicks))
    w = kv.writeStream.outputMode("complete").format(HASH_SOURCE).option("path", path)
    return _run(spark, w, checkpoint, trigger, state_partitions)


# ---------------------------------------------------------------- top ads

TOP_SCHEMA = _fields(("day", T.DateType()), ("area", T.StringType()), ("adid", T.StringType()),
                     ("click_count", T.LongType()), ("rk", T.IntegerType()))
AREA_COUNT_SCHEMA = _fields(("day", T.DateType()), ("area", T.StringType()), ("adid", T.StringType()),
                            ("click_count", T.LongType()))
AREA_BUCKETS = 64


def top_ads_job(spark: SparkSession, clicks: DataFrame, n: int = TOP_ADS, trigger: str = AVAILABLE_NOW,
                base: str | None = None, state_partitions: int | None = None) -> StreamJob:
    """Stores: ``counts`` (increments, by day and bucket of the group), ``ranks`` and ``kv`` of the groups that changed."""
    base = base or shared_dir(spark, "streams", "top_ads")
    counts = KeyedSnapshot(spark, f"{base}/counts", ["day", "area", "adid"], AREA_COUNT_SCHEMA, "add", by_day=True,
                           bucketed=(["day", "area"], AREA_BUCKETS))
    ranks = KeyedSnapshot(spark, f"{base}/ranks", ["day", "area"], TOP_SCHEMA, "set")
    kv = KeyedSnapshot(spark, f"{base}/kv", ["hash_key", "field"], KV_SCHEMA, "set")

    def sink(df: DataFrame, batch_id: int) -> None:
        delta = ads.area_ad_counts(df).persist()
        try:
            counts.write(delta, batch_id)
            days, buckets = delta.agg(F.collect_set("day"), F.collect_set(counts.bucket())).first()
            touched = delta.select("day", "area").distinct()
            current = counts.read(upto=batch_id, days=days, buckets=buckets).join(touched, ["day", "area"], "left_semi")
            ranked = ads.rank_area_ads(current, n).persist()
            ranks.write(ranked, batch_id)
            kv.write(ads.top_ads_json(ranked), batch_id)
            ranked.unpersist()
        finally:
            delta.unpersist()

    q = _start(clicks, "append", sink, f"{base}/checkpoint", trigger, [counts, ranks, kv],
               state_partitions=state_partitions)
    return StreamJob(q, {"ranks": ranks, "kv": kv, "counts": counts})


# ------------------------------------------------------------------ trend

PANE_SCHEMA = _fields(("day", T.DateType()), ("adid", T.StringType()), ("pane_start", T.TimestampNTZType()),
                      ("bucket_start", T.TimestampNTZType()), ("click_count", T.LongType()))


def trend_panes(clicks: DataFrame, slide: str, bucket: str, window_col: str = "ts") -> DataFrame:
    """Clicks per ad, pane of ``window_col`` (as wide as the slide) and bucket of ``ts``."""
    pane = floor_time(window_col, interval_seconds(slide))
    return (clicks.groupBy("adid", pane.alias("pane_start"),
                           floor_time("ts", interval_seconds(bucket)).alias("bucket_start"))
            .agg(F.count(F.lit(1)).alias("click_count"))
            .withColumn("day", F.to_date("pane_start")))


def trend_windows(panes: DataFrame, window: str, slide: str) -> DataFrame:
    """``(window_start, window_end, adid, bucket_start, click_count)``: every pane in its windows."""
    w, s = interval_seconds(window), interval_seconds(slide)
    back = F.explode(F.sequence(F.lit(0), F.lit(w - s), F.lit(s)))
    return (panes.select("*", back.alias("_back"))
            .select((F.timestamp_add("SECOND", -F.col("_back"), F.col("pane_start"))).alias("window_start"),
                    (F.timestamp_add("SECOND", F.lit(w) - F.col("_back"), F.col("pane_start"))).alias("window_end"),
                    "adid", "bucket_start", "click_count")
            .groupBy("window_start", "window_end", "adid", "bucket_start")
            .agg(F.sum("click_count").alias("click_count")))


HASH_TREND_SCHEMA = T.StructType([*KV_SCHEMA.fields, T.StructField("last_pane", T.TimestampNTZType())])


def _days_between(first: dt.datetime, last: dt.datetime) -> set[dt.date]:
    return {first.date() + dt.timedelta(days=i) for i in range((last.date() - first.date()).days + 1)}


def _trend_hash(panes: KeyedSnapshot, delta: DataFrame, batch_id: int, before: dt.datetime, now: dt.datetime,
                span: dt.timedelta) -> DataFrame:
    """(hash_key, field, value, last_pane) of the ads whose value may have changed.

    An ad's value is its buckets in the last window, of those begun up to
    ``now``, that holds a click of it: in the newest window, or else in the one that
    begins with the ad's last pane. Ads of the window of ``before`` may have left it.
    """
    days = _days_between(before - span, before) | _days_between(now - span, now)
    days |= set(delta.agg(F.collect_set("day")).first()[0])
    current = panes.read(upto=batch_id, days=sorted(days))
    inside = F.col("pane_start").between(F.lit(before - span), F.lit(before)) | (
        F.col("pane_start").between(F.lit(now - span), F.lit(now)))
    touched = current.where(inside).select("adid").unionByName(delta.select("adid")).distinct()
    last = F.max("pane_start").over(Window.partitionBy("adid"))
    newest = F.lit(now - span).cast("timestamp_ntz")
    shown = (current.join(touched, "adid", "left_semi").withColumn("window_start", last)
             .where(F.col("pane_start") >= F.least(newest, "window_start"))
             .groupBy("window_start", F.col("window_start").alias("window_end"), "adid", "bucket_start")
             .agg(F.sum("click_count").alias("click_count")))
    return ads.trend_json(shown).select("hash_key", "field", "value", F.col("window_start").alias("last_pane"))


def trend_job(spark: SparkSession, clicks: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
              bucket: str = TREND_BUCKET, trigger: str = AVAILABLE_NOW, base: str | None = None,
              window_col: str = "ts", state_partitions: int | None = None) -> StreamJob:
    """Stores: ``panes`` (increments, by day; ``trend_windows`` expands them) and ``kv`` (the trend
    hash: per ad, its buckets in the last window that holds a click of it).

    Buckets always use the click's own time ``ts``. The sliding window is over
    ``window_col``: ``ts``, or an arrival time such as the Kafka record
    timestamp, which is what the reference's window is over; then an old click
    shows as an old bucket of the present window. The newest pane is carried
    from batch to batch and never goes back: a batch of old clicks leaves the hash
    of newer ones as it is.
    """
    ads._check_trend(window, slide, bucket)
    base = base or shared_dir(spark, "streams", "trend")
    panes = KeyedSnapshot(spark, f"{base}/panes", ["day", "adid", "pane_start", "bucket_start"], PANE_SCHEMA, "add",
                          by_day=True)
    kv = KeyedSnapshot(spark, f"{base}/kv", ["hash_key", "field"], HASH_TREND_SCHEMA, "set")
    newest = Carried(spark, f"{base}/newest", NEWEST_SCHEMA)
    span = dt.timedelta(seconds=interval_seconds(window) - interval_seconds(slide))

    def sink(df: DataFrame, batch_id: int) -> None:
        delta = trend_panes(df, slide, bucket, window_col).persist()
        try:
            panes.write(delta, batch_id)
            before, now = _newest(newest, delta, batch_id, "pane_start")
            if now is None:
                return
            # A batch without clicks has no pane; what it would show is in the hash already.
            made = _trend_hash(panes, delta, batch_id, before or now, now, span)
            known = kv.read(upto=batch_id - 1).select("hash_key", "field", F.col("last_pane").alias("_known"))
            made = made.join(known, ["hash_key", "field"], "left")
            kv.write(made.where(F.col("_known").isNull() | (F.col("last_pane") >= F.col("_known"))), batch_id)
        finally:
            delta.unpersist()

    q = _start(clicks, "append", sink, f"{base}/checkpoint", trigger, [panes, kv], state_partitions=state_partitions)
    hashed = View(lambda: kv.read().select("hash_key", "field", "value"))
    return StreamJob(q, {"panes": panes, "kv": hashed})


CLOSED_SCHEMA = _fields(("window_start", T.TimestampNTZType()), ("window_end", T.TimestampNTZType()),
                        ("adid", T.StringType()), ("bucket_start", T.TimestampNTZType()), ("click_count", T.LongType()))


def trend_windows_job(spark: SparkSession, clicks: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
                      bucket: str = TREND_BUCKET, lateness: str = "0 seconds", trigger: str = AVAILABLE_NOW,
                      base: str | None = None, state_partitions: int | None = None) -> StreamJob:
    """The trend by watermark: buckets per ad, then sliding windows over the buckets, two stateful operators in a chain.

    A bucket leaves the first operator's state when the watermark (the newest
    click less ``lateness``) passes its end, a window the second one's likewise,
    so the state holds ``window + lateness`` of time. Clicks behind the watermark
    are dropped by Spark and counted in the query's progress (``monitor.BatchLog``
    has them); ``trend_job`` is the form that keeps them.

    Stores: ``closed`` (each closed window once, a log) and ``open`` (windows not
    closed yet, as far as they are filled: the state of both operators as the last
    checkpoint has it).
    """
    ads._check_trend(window, slide, bucket)
    base = base or shared_dir(spark, "streams", "trend_windows")
    closed = KeyedSnapshot(spark, f"{base}/closed", [], CLOSED_SCHEMA, "log")
    buckets = (clicks.select("adid", F.col("ts").cast("timestamp").alias("at")).withWatermark("at", lateness)
               .groupBy(F.window("at", bucket).alias("part"), "adid").agg(F.count(F.lit(1)).alias("click_count")))
    windows = (buckets.groupBy(F.window(F.window_time("part"), window, slide).alias("whole"), "adid",
                               F.col("part.start").alias("bucket_start"))
               .agg(F.sum("click_count").alias("click_count"))
               .select(F.col("whole.start").alias("window_start"), F.col("whole.end").alias("window_end"), "adid",
                       "bucket_start", "click_count"))
    q = _start(windows, "append", closed.write, f"{base}/checkpoint", trigger, state_partitions=state_partitions)

    def still_open() -> DataFrame:
        parts, wholes = (spark.read.format("statestore").option("path", f"{base}/checkpoint")
                         .option("operatorId", i).load().select("key.*", "value.*") for i in (0, 1))
        # Keys of the state: (bucket, ad) of the first aggregation, (window, ad, bucket's start) of the second.
        parts, wholes = sorted((parts, wholes), key=lambda state: len(state.columns))
        begun = wholes.toDF("whole", "adid", "bucket_start", "click_count").select(
            F.col("whole.start").alias("window_start"), F.col("whole.end").alias("window_end"), "adid", "bucket_start",
            "click_count")
        fresh = parts.toDF("part", "adid", "click_count").select(
            "adid", F.col("part.start").cast("timestamp_ntz").alias("bucket_start"), "click_count")
        fresh = ads.bucket_windows(fresh, window, slide, bucket)
        return begun.select(*[F.col(f.name).cast(f.dataType) for f in CLOSED_SCHEMA.fields]).unionByName(fresh)

    return StreamJob(q, {"closed": closed, "open": View(still_open)})


# -------------------------------------------------------------------- ban

COUNTER_SCHEMA = _fields(("day", T.DateType()), ("uid", T.StringType()), ("adid", T.StringType()),
                         ("click_count", T.LongType()))
KEY = ["day", "uid", "adid"]


Stores = dict[str, KeyedSnapshot | BucketedSet]


def _ban_stores(spark: SparkSession, clicks: DataFrame, base: str) -> Stores:
    return {"counters": KeyedSnapshot(spark, f"{base}/counters", KEY, COUNTER_SCHEMA, "add", by_day=True),
            "blacklist": BucketedSet(spark, f"{base}/blacklist", "uid"),
            "accepted": KeyedSnapshot(spark, f"{base}/accepted", [], _log_schema(clicks), "log")}


def _counts_before(stores: Stores, delta: DataFrame, days: Sequence, batch_id: int) -> DataFrame:
    """``delta`` (counts of this batch) with ``before``, the count of earlier batches."""
    before = stores["counters"].read(upto=batch_id - 1, days=days).withColumnRenamed("click_count", "before")
    return delta.join(before, KEY, "left").withColumn("before", F.coalesce("before", F.lit(0).cast("long")))


def _not_banned(batch: DataFrame, batch_id: int, stores: Stores) -> tuple[DataFrame, list]:
    """(clicks of users not banned before the batch, the batch's days).

    The members read are those in the buckets of the batch's users. No broadcast
    hint: a bucket has no size bound; AQE sizes it at runtime.
    """
    banned = stores["blacklist"]
    days, buckets = batch.agg(F.collect_set(day_of("ts")), F.collect_set(banned.bucket("uid"))).first()
    if not batch_id:
        return batch, days
    return drop_in(batch, banned.among(buckets, before=batch_id).select("uid"), "uid"), days


def ban_step(batch: DataFrame, batch_id: int, stores: Stores, threshold: int = BAN_THRESHOLD) -> None:
    """One micro-batch of the ban job (idempotent for a given ``batch_id``).

    Reads only the state as of the previous batch, so a replay sees exactly
    what the first run saw and rewrites the same three partitions. A hot
    user's clicks are counted where they are read.
    """
    batch = batch.persist()
    try:
        ok, days = _not_banned(batch, batch_id, stores)
        delta = ads.user_day_ad_counts(ok).persist()
        total = _counts_before(stores, delta, days, batch_id)
        new_bans = total.where(F.col("click_count") + F.col("before") >= threshold).select("uid").distinct()
        stores["accepted"].write(_renamed(ok), batch_id)
        stores["blacklist"].add(new_bans, batch_id)
        stores["counters"].write(delta, batch_id)
        delta.unpersist()
    finally:
        batch.unpersist()


def ban_step_per_event(batch: DataFrame, batch_id: int, stores: Stores, threshold: int = BAN_THRESHOLD,
                       tie: Sequence[str] | None = None) -> None:
    """One micro-batch of the per-click ban: a click is accepted unless its user
    was banned by an earlier one, in (``ts``, ``tie``) order within the batch.

    ``tie`` defaults to ``event_id``, or else to all columns: clicks equal in all
    of them can stand for each other, and as many of them are accepted as it
    takes to reach the threshold. Only clicks of keys that reach it are ranked.
    """
    tie = list(tie or (["event_id"] if "event_id" in batch.columns else [c for c in batch.columns if c != "ts"]))
    place = F.struct("ts", *tie)
    batch = batch.persist()
    try:
        ok, days = _not_banned(batch, batch_id, stores)
        counted = ads.user_day_ad_counts(ok)
        reach = (_counts_before(stores, counted, days, batch_id)
                 .where(F.col("click_count") + F.col("before") >= threshold)
                 .select(*KEY, (F.lit(threshold) - F.col("before")).alias("need"))).persist()
        bans = ads.first_bans(ok, reach, place, threshold).persist()
        accepted = ads.accepted_up_to(ok, bans, place).persist()
        stores["accepted"].write(_renamed(accepted), batch_id)
        stores["blacklist"].add(bans.select("uid"), batch_id)
        stores["counters"].write(ads.user_day_ad_counts(accepted), batch_id)
        for df in (reach, bans, accepted):
            df.unpersist()
    finally:
        batch.unpersist()


def _ban_job(step, spark, clicks, threshold, trigger, base, compact_every, state_partitions) -> StreamJob:
    stores = _ban_stores(spark, clicks, base)
    q = _start(clicks, "append", lambda df, batch_id: step(df, batch_id, stores, threshold), f"{base}/checkpoint",
               trigger, [stores["counters"]], compact_every, state_partitions)
    return StreamJob(q, stores)


def ban_job(spark: SparkSession, clicks: DataFrame, threshold: int = BAN_THRESHOLD,
            trigger: str = AVAILABLE_NOW, base: str | None = None, compact_every: int = COMPACT_EVERY,
            state_partitions: int | None = None) -> StreamJob:
    """Live ban per micro-batch. Stores: ``accepted`` (log), ``counters`` (increments per day, user and ad)
    and ``blacklist`` (users with the batch that banned them)."""
    return _ban_job(ban_step, spark, clicks, threshold, trigger, base or shared_dir(spark, "streams", "ban"),
                    compact_every, state_partitions)


def per_event_ban_job(spark: SparkSession, clicks: DataFrame, threshold: int = BAN_THRESHOLD,
                      trigger: str = AVAILABLE_NOW, base: str | None = None, compact_every: int = COMPACT_EVERY,
                      state_partitions: int | None = None) -> StreamJob:
    """Live ban per click (the reference's commented variant); the same stores."""
    return _ban_job(ban_step_per_event, spark, clicks, threshold, trigger,
                    base or shared_dir(spark, "streams", "ban_per_event"), compact_every, state_partitions)


# ------------------------------------------------------------------- lines

def quarantine_job(spark: SparkSession, lines: DataFrame, trigger: str = AVAILABLE_NOW,
                   base: str | None = None) -> StreamJob:
    """Stores the ad lines that no job can read (``quarantined``, a log)."""
    base = base or shared_dir(spark, "streams", "quarantine")
    bad = ads.parse_lines(lines)[1]
    store = KeyedSnapshot(spark, f"{base}/quarantined", [], _log_schema(bad), "log")
    q = _start(bad, "append", lambda df, batch_id: store.write(_renamed(df), batch_id), f"{base}/checkpoint", trigger)
    return StreamJob(q, {"quarantined": store})
