"""Streams against their batch twins; replay and restart keep totals right."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.plans import ads
from clicklens.sinks.snapshot import KeyedSnapshot
from clicklens.sources import fixtures as fx
from clicklens.sources.stream import file_stream
from clicklens.streaming import ads_streams as S

from paths import SF001
from stream_tools import write_batches

SCHEMA = ("event_id long, ts timestamp_ntz, area string, city string, uid string, "
          "adid string, batch_id long")


MEMBERS = T.StructType([T.StructField("uid", T.StringType())])


def rows_of(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_daily_totals_stream_equals_batch_over_many_batches(spark, scratch):
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 200).cast("long"))
    n = write_batches(c, "batch_id", f"{scratch}/in")
    assert n > 2
    stream = file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1)
    job = S.daily_totals_job(spark, stream, base=f"{scratch}/job")
    S.run_to_end(job.query)
    assert job.query.lastProgress is not None
    cols = ["day", "area", "city", "adid", "click_count"]
    assert rows_of(job.stores["totals"].read(), cols) == rows_of(ads.daily_totals(c), cols)


def test_restart_continues_totals(spark, scratch):
    c = fx.clicks(spark, SF001)
    first, second = c.where("event_id < 500"), c.where("event_id >= 500")
    first.coalesce(1).write.parquet(f"{scratch}/in")
    base = f"{scratch}/job"
    S.run_to_end(S.daily_totals_job(spark, file_stream(spark, f"{scratch}/in", c.schema), base=base).query)
    second.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    job = S.daily_totals_job(spark, file_stream(spark, f"{scratch}/in", c.schema), base=base)  # same checkpoint
    S.run_to_end(job.query)
    cols = ["day", "area", "city", "adid", "click_count"]
    assert rows_of(job.stores["totals"].read(), cols) == rows_of(ads.daily_totals(c), cols)


def test_snapshot_replay_is_idempotent(spark, scratch):
    schema = S.COUNTER_SCHEMA
    store = KeyedSnapshot(spark, f"{scratch}/counters", ["day", "uid", "adid"], schema, "add")
    d = dt.date(2024, 1, 1)
    b0 = spark.createDataFrame([(d, "u", "1", 2), (d, "v", "1", 1)], schema)
    b1 = spark.createDataFrame([(d, "u", "1", 3)], schema)
    store.write(b0, 0)
    store.write(b1, 1)
    store.write(b1, 1)   # replay
    got = {r["uid"]: r["click_count"] for r in store.read().collect()}
    assert got == {"u": 5, "v": 1}
    assert {r["uid"]: r["click_count"] for r in store.read(upto=0).collect()} == {"u": 2, "v": 1}
    members = KeyedSnapshot(spark, f"{scratch}/members", ["uid"], MEMBERS, "member")
    assert members.read().count() == 0      # nothing written yet
    members.write(spark.createDataFrame([("u",)], MEMBERS), 3)
    members.write(spark.createDataFrame([("u",), ("w",)], MEMBERS), 4)
    assert sorted(tuple(r) for r in members.read().collect()) == [("u", 3), ("w", 4)]


import pytest


def test_ban_stream_equals_batch_twin(spark, scratch):
    th = 2
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(1, t, "N", "c", "u1", "1", 0), (2, t, "N", "c", "u1", "1", 0), (3, t, "N", "c", "u1", "1", 0),
            (4, t, "N", "c", "u2", "1", 0),
            (5, t, "N", "c", "u1", "2", 1), (6, t, "N", "c", "u2", "2", 1), (7, t, "N", "c", "u3", "1", 1),
            (8, t, "N", "c", "u2", "1", 2), (9, t, "N", "c", "u2", "3", 2), (10, t, "N", "c", "u3", "1", 2)]
    c = spark.createDataFrame(rows, SCHEMA)
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.ban_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1), th,
                          base=f"{scratch}/job")
    S.run_to_end(job.query)
    acc = {r["event_id"] for r in job.stores["accepted"].read().collect()}
    assert acc == {r["event_id"] for r in ads.accepted_per_batch(c, th).collect()}
    counts = {(r["uid"], r["adid"]): r["click_count"] for r in job.stores["counters"].read().collect()}
    assert counts == {(r["uid"], r["adid"]): r["click_count"]
                      for r in ads.user_day_ad_counts(ads.accepted_per_batch(c, th)).collect()}
    # u1 is banned at the end of batch 0 and dropped from batch 1 on; u2 and u3
    # reach the threshold in batch 2, where all their clicks still count.
    assert acc == {1, 2, 3, 4, 6, 7, 8, 9, 10}
    assert sorted(tuple(r) for r in job.stores["blacklist"].read().collect()) == [
        ("u1", 0), ("u2", 2), ("u3", 2)]


WINDOW_COLS = ["window_start", "window_end", "adid", "bucket_start", "click_count"]


def test_trend_stream_holds_every_window_and_late_click(spark, scratch):
    """Open windows are there, and a click of an old batch shows in its old buckets."""
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.col("event_id") % 3)      # no order in time at all
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.trend_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                      "6 hours", "2 hours", "1 hour", base=f"{scratch}/job")
    S.run_to_end(job.query)
    got = S.trend_windows(job.stores["panes"].read(), "6 hours", "2 hours")
    assert rows_of(got, WINDOW_COLS) == rows_of(ads.trend(c, "6 hours", "2 hours", "1 hour"), WINDOW_COLS)
    assert job.stores["kv"].read().count() > 0


def test_trend_hash_has_the_newest_window(spark, scratch):
    c = fx.clicks(spark, SF001)
    c.coalesce(1).write.parquet(f"{scratch}/in")
    job = S.trend_job(spark, file_stream(spark, f"{scratch}/in", c.schema), "6 hours", "1 hour", "1 hour",
                      base=f"{scratch}/job")
    S.run_to_end(job.query)
    all_windows = ads.trend(c, "6 hours", "1 hour", "1 hour")
    newest = c.agg(F.max(F.date_trunc("hour", "ts"))).first()[0] - dt.timedelta(hours=5)
    want = ads.trend_json(all_windows.where(F.col("window_start") == F.lit(newest)))
    cols = ["hash_key", "field", "value"]
    got = rows_of(job.stores["kv"].read(), cols)
    assert set(rows_of(want, cols)) <= set(got) and rows_of(want, cols)
    assert len(got) == c.select("adid").distinct().count()       # the others keep their last window


def trend_hash(spark, scratch, batches, window_col="ts"):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, t + dt.timedelta(seconds=s), "N", "c", "u", ad, b, t + dt.timedelta(seconds=a))
            for b, batch in enumerate(batches) for i, (ad, s, a) in enumerate(batch)]
    c = spark.createDataFrame(rows, SCHEMA + ", arrival_ts timestamp_ntz")
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.trend_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                      base=f"{scratch}/job", window_col=window_col)
    S.run_to_end(job.query)
    return {r["field"]: r["value"] for r in job.stores["kv"].read().collect()}


def test_trend_hash_never_goes_back(spark, scratch):
    """A batch of old clicks leaves the newest window's value; an ad seen in it alone gets its own last window."""
    noon = 43_200
    got = trend_hash(spark, scratch, [[("1", noon + 5, 0), ("1", noon + 15, 0)],
                                      [("1", noon - 3600, 0), ("2", noon - 3595, 0), ("2", noon - 3580, 0)]])
    assert got == {"1": '[{"00:00":1},{"00:10":1}]', "2": '[{"00:20":1}]'}


def test_trend_hash_over_arrival_shows_the_old_bucket(spark, scratch):
    noon = 43_200
    got = trend_hash(spark, scratch, [[("1", noon + 5, noon + 5)],
                                      [("1", noon - 3590, noon + 25), ("2", noon, noon + 25)],
                                      [("3", noon + 200, noon + 200)]], "arrival_ts")
    assert got["3"] == '[{"03:20":1}]'
    # Ads that left the present window keep the last one that held a click of theirs.
    assert got["2"] == '[{"00:00":1}]' and got["1"] == '[{"00:10":1}]'


def test_snapshot_compaction_keeps_every_mode_equal(spark, scratch):
    d = dt.date(2024, 1, 1)
    batches = [[(d, "u", "1", 1), (d, "v", "1", 2)], [(d, "u", "1", 3)], [(d, "w", "2", 1)],
               [(d, "u", "1", 5), (d, "v", "1", 1)], [(d, "w", "2", 4)]]
    for mode in ("set", "add", "member", "log"):
        schema = S.COUNTER_SCHEMA if mode != "member" else MEMBERS
        keys = {"member": ["uid"], "log": []}.get(mode, ["day", "uid", "adid"])
        day = mode in ("add", "log")
        plain = KeyedSnapshot(spark, f"{scratch}/{mode}/plain", keys, schema, mode)
        comp = KeyedSnapshot(spark, f"{scratch}/{mode}/comp", keys, schema, mode, by_day=day)
        for b, rows in enumerate(batches):
            df = spark.createDataFrame(rows if mode != "member" else [(r[1],) for r in rows], schema)
            plain.write(df, b)
            comp.write(df, b)
            if b == 2:
                comp.compact(2)
        comp.write(spark.createDataFrame(batches[3] if mode != "member" else [(r[1],) for r in batches[3]],
                                         schema), 3)   # replay after the compaction
        for upto in (None, 2, 3):
            a = sorted(tuple(r) for r in plain.read(upto).collect())
            b = sorted(tuple(r) for r in comp.read(upto).collect())
            assert a == b, (mode, upto)
        if mode != "log":
            with pytest.raises(ValueError, match="oldest base"):
                comp.read(1)
    got = {r["uid"]: r["click_count"] for r in KeyedSnapshot(
        spark, f"{scratch}/add/comp", ["day", "uid", "adid"], S.COUNTER_SCHEMA, "add", by_day=True).read().collect()}
    assert got == {"u": 9, "v": 3, "w": 5}


def test_a_log_keeps_equal_rows_and_a_replayed_batch_once(spark, scratch):
    log = KeyedSnapshot(spark, f"{scratch}/log", [], MEMBERS, "log")
    twice = spark.createDataFrame([("u",), ("u",)], MEMBERS)
    for b in (0, 1, 1):
        log.write(twice, b)
    assert log.read().count() == 4
    with pytest.raises(ValueError):
        KeyedSnapshot(spark, f"{scratch}/x", [], spark.range(1).withColumn("batch_id", F.lit(1)).schema, "log")


def test_reads_open_only_the_days_asked_for(spark, scratch):
    store = KeyedSnapshot(spark, f"{scratch}/days", ["day", "uid", "adid"], S.COUNTER_SCHEMA, "add", by_day=True)
    days = [dt.date(2024, 1, i) for i in range(1, 6)]
    store.write(spark.createDataFrame([(d, "u", "1", 1) for d in days], S.COUNTER_SCHEMA), 0)
    some = store.read(days=days[:2])
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan or "day" in plan.split("PartitionFilters:")[1].split("]")[0]


@pytest.mark.parametrize("job", ["ban_job", "per_event_ban_job"])
def test_ban_stream_with_frequent_compaction(spark, scratch, job):
    c = fx.clicks(spark, SF001).orderBy("ts").withColumn("batch_id", F.floor(F.unix_millis(
        F.col("ts").cast("timestamp")) / 200_000_000).cast("long"))
    write_batches(c, "batch_id", f"{scratch}/in")
    job_ = getattr(S, job)(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1), 2,
                           base=f"{scratch}/job", compact_every=3)
    S.run_to_end(job_.query)
    want = ads.accepted_per_batch(c, 2) if job == "ban_job" else ads.accepted_per_event(c, 2)
    assert rows_of(S.log_read(job_.stores["accepted"]), c.columns) == rows_of(want, c.columns)


LINE_SCHEMA = "ts timestamp_ntz, area string, city string, uid string, adid string"


@pytest.mark.parametrize("job", ["ban_job", "per_event_ban_job"])
def test_ban_jobs_take_parsed_lines_and_count_equal_clicks(spark, scratch, job):
    """No event id, as in the real topic: equal clicks all count, in one batch and across batches."""
    ms = 1_704_110_400_000
    first = [f"{ms} N c u1 7"] * 2 + [f"{ms} N c u2 7", "short line", f"x{ms} N c u3 7"]
    second = [f"{ms} N c u1 7"] * 3 + [f"{ms} N c u2 7"]
    for batch in (first, second):
        spark.createDataFrame([(v,) for v in batch], "value string").coalesce(1).write.mode("append").parquet(
            f"{scratch}/in")
    lines = file_stream(spark, f"{scratch}/in", spark.read.parquet(f"{scratch}/in").schema, max_files_per_trigger=1)
    got = getattr(S, job)(spark, ads.clicks_from_lines(lines), 4, base=f"{scratch}/job")
    S.run_to_end(got.query)
    users = sorted(r["uid"] for r in got.stores["accepted"].read().collect())
    # u1 reaches 4 in the second batch: the live job counts all five, the per-click one stops at four.
    assert users == ["u1"] * (5 if job == "ban_job" else 4) + ["u2"] * 2
    assert [tuple(r) for r in got.stores["blacklist"].read().collect()] == [("u1", 1)]
    counts = {(r["uid"], r["adid"]): r["click_count"] for r in got.stores["counters"].read().collect()}
    assert counts == {("u1", "7"): users.count("u1"), ("u2", "7"): 2}


def test_one_user_with_a_third_of_all_rows(spark, scratch):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(i, t + dt.timedelta(seconds=i), "N", "c", "hot" if i % 3 == 0 else f"u{i}", "1", i // 1000)
            for i in range(3000)]
    c = spark.createDataFrame(rows, SCHEMA)
    write_batches(c, "batch_id", f"{scratch}/in")
    for name, batch in (("ban_job", ads.accepted_per_batch), ("per_event_ban_job", ads.accepted_per_event)):
        job = getattr(S, name)(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1), 500,
                               base=f"{scratch}/{name}")
        S.run_to_end(job.query)
        got = rows_of(S.log_read(job.stores["accepted"]), c.columns)
        assert got == rows_of(batch(c, 500), c.columns) and len(got) < 3000


def test_per_event_ban_stream_equals_batch(spark, scratch):
    th = 2
    t = dt.datetime(2024, 1, 1, 12)
    s = dt.timedelta(seconds=1)
    rows = [(1, t, "N", "c", "u1", "1", 0), (2, t + s, "N", "c", "u2", "1", 0),
            (3, t + 2 * s, "N", "c", "u1", "1", 0),          # u1 banned by this click (accepted)
            (4, t + 3 * s, "N", "c", "u1", "2", 0),          # same batch, after the ban: dropped
            (5, t + 4 * s, "N", "c", "u2", "2", 1), (6, t + 5 * s, "N", "c", "u1", "3", 1),
            (7, t + 6 * s, "N", "c", "u2", "1", 2), (8, t + 7 * s, "N", "c", "u2", "1", 2)]
    c = spark.createDataFrame(rows, SCHEMA)
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.per_event_ban_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                              th, base=f"{scratch}/job")
    S.run_to_end(job.query)
    acc = {r["event_id"] for r in job.stores["accepted"].read().collect()}
    assert acc == {r["event_id"] for r in ads.accepted_per_event(c, th).collect()}
    assert acc == {1, 2, 3, 5, 7}


def test_top_ads_stream_ranks_running_totals(spark, scratch):
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 250).cast("long"))
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.top_ads_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1), 3,
                        base=f"{scratch}/job")
    S.run_to_end(job.query)
    cols = ["day", "area", "adid", "click_count", "rk"]
    assert rows_of(job.stores["ranks"].read(), cols) == rows_of(ads.top_ads_per_area(c, 3), cols)
    kv = {(r["hash_key"], r["field"]) for r in job.stores["kv"].read().collect()}
    assert len(kv) == ads.top_ads_per_area(c, 3).select("day", "area").distinct().count()


@pytest.mark.parametrize("job", ["ban_job", "daily_totals_job"])
def test_crash_mid_batch_then_restart(spark, scratch, monkeypatch, job):
    """A batch that dies after writing part of its output is run again on
    restart (its offsets are logged, its commit is not); state and outputs
    end exactly as in a clean run."""
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 200).cast("long"))
    write_batches(c, "batch_id", f"{scratch}/in")
    src = lambda: file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1)
    start = (lambda: S.ban_job(spark, src(), 2, base=f"{scratch}/job", state_partitions=2)) if job == "ban_job" \
        else (lambda: S.daily_totals_job(spark, src(), base=f"{scratch}/job", state_partitions=2))
    real_write = KeyedSnapshot.write
    calls = {"n": 0}

    def crashing_write(self, df, batch_id):
        real_write(self, df, batch_id)
        if batch_id == 2:
            calls["n"] += 1
            if calls["n"] == 1:
                raise RuntimeError("simulated crash after a partial batch")

    monkeypatch.setattr(KeyedSnapshot, "write", crashing_write)
    first = start()
    with pytest.raises(Exception):
        S.run_to_end(first.query)
    monkeypatch.setattr(KeyedSnapshot, "write", real_write)
    again = start()                     # same checkpoint and output folders
    S.run_to_end(again.query)
    if job == "ban_job":
        acc = sorted(r["event_id"] for r in again.stores["accepted"].read().collect())
        assert acc == sorted(r["event_id"] for r in ads.accepted_per_batch(c, 2).collect())
        cols = ["day", "uid", "adid", "click_count"]
        assert rows_of(again.stores["counters"].read(), cols) == rows_of(
            ads.user_day_ad_counts(ads.accepted_per_batch(c, 2)), cols)
    else:
        cols = ["day", "area", "city", "adid", "click_count"]
        assert rows_of(again.stores["totals"].read(), cols) == rows_of(ads.daily_totals(c), cols)


def test_trend_stream_over_arrival_time(spark, scratch):
    """Window over an arrival-time column, buckets over event time: with
    arrivals one hour after the clicks, each bucket lands one window later."""
    c = fx.clicks(spark, SF001).withColumn("arrival_ts", F.col("ts") + F.expr("interval 1 hour"))
    c.coalesce(1).write.parquet(f"{scratch}/in")
    job = S.trend_job(spark, file_stream(spark, f"{scratch}/in", c.schema), "6 hours", "1 hour", "1 hour",
                      base=f"{scratch}/job", window_col="arrival_ts", state_partitions=2)
    S.run_to_end(job.query)
    got = S.trend_windows(job.stores["panes"].read(), "6 hours", "1 hour").select(
        F.col("window_start").alias("ws"), "adid", F.col("bucket_start").alias("b"), "click_count")
    shifted = (ads.trend(c, "6 hours", "1 hour", "1 hour")
               .select((F.col("window_start") + F.expr("interval 1 hour")).alias("ws"), "adid",
                       F.col("bucket_start").alias("b"), "click_count"))
    cols = ["ws", "adid", "b", "click_count"]
    assert rows_of(got, cols) == rows_of(shifted, cols) != []


def test_bounded_totals_set_late_clicks_aside(spark, scratch):
    """With max_lateness, a click older than the newest one before less the lateness is stored, not lost."""
    t = dt.datetime(2024, 1, 10, 12)
    rows = [(1, t, "N", "c", "u1", "1", 0), (2, t, "N", "c", "u2", "1", 1),
            (3, t - dt.timedelta(days=2), "N", "c", "u3", "1", 1), (4, t, "N", "c", "u3", "1", 2),
            (5, t - dt.timedelta(minutes=59), "N", "c", "u3", "1", 2)]
    c = spark.createDataFrame(rows, SCHEMA)
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.daily_totals_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                             base=f"{scratch}/job", max_lateness="1 hour", state_partitions=2)
    S.run_to_end(job.query)
    got = {(str(r["day"]), r["adid"]): r["click_count"] for r in job.stores["totals"].read().collect()}
    assert got == {("2024-01-10", "1"): 4}
    assert rows_of(S.log_read(job.stores["late"]), c.columns) == [rows[2]]


def test_bounded_totals_keep_open_days_only_and_two_folders(spark, scratch):
    """Whatever the number of batches, a batch opens one folder of each carried state and closed days have left it."""
    import os
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(i, t + dt.timedelta(hours=8 * i), "N", "c", "u", str(i % 2), i) for i in range(24)]
    c = spark.createDataFrame(rows, SCHEMA)
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.daily_totals_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                             base=f"{scratch}/job", max_lateness="1 hour", state_partitions=2)
    S.run_to_end(job.query)
    cols = ["day", "area", "city", "adid", "click_count"]
    assert rows_of(job.stores["totals"].read(), cols) == rows_of(ads.daily_totals(c), cols)
    days = {r["day"] for r in job.stores["open"].read().collect()}
    assert days == {(t + dt.timedelta(hours=8 * 23)).date()}
    local = f"{scratch}/job".replace("file://", "").replace("file:", "")
    for state in ("newest", "open"):
        assert sorted(os.listdir(f"{local}/{state}")) == ["turn=0", "turn=1"]


def test_a_replayed_batch_carries_the_same_state(spark, scratch):
    from clicklens.sinks.carried import Carried
    schema = T.StructType([T.StructField("n", T.LongType())])
    state = Carried(spark, f"{scratch}/state", schema)
    for batch in (0, 1, 1, 2, 2, 3):          # 1 and 2 are run twice
        before = state.read(batch).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        state.write(spark.range(1).select(F.lit(before + 10 ** batch).alias("n")), batch)
    assert [r["n"] for r in state.latest().collect()] == [1111]
    state.write(spark.createDataFrame([], schema), 4)
    assert state.latest().count() == 0 and state.read(5).count() == 0


def test_members_are_read_from_the_buckets_asked_for(spark, scratch):
    from clicklens.sinks.members import BucketedSet
    members = BucketedSet(spark, f"{scratch}/members", "uid", buckets=16)
    assert members.read().count() == 0 and members.among([3]).count() == 0
    members.add(spark.createDataFrame([(f"u{i}",) for i in range(200)], MEMBERS), 0)
    members.add(spark.createDataFrame([("u5",), ("v",), ("v",)], MEMBERS), 4)
    members.add(spark.createDataFrame([("u5",), ("v",), ("v",)], MEMBERS), 4)     # replay
    got = {r["uid"]: r["first_batch_id"] for r in members.read().collect()}
    assert len(got) == 201 and got["u5"] == 0 and got["v"] == 4
    bucket = spark.createDataFrame([("v",)], MEMBERS).select(members.bucket()).first()[0]
    near = members.among([bucket])
    assert all(f"bucket={bucket}/" in f or "bucket=-1/" in f for f in near.inputFiles())
    assert near.where("uid = 'v'").count() == 1
    assert members.among([bucket], before=4).where("uid = 'v'").count() == 0


def test_a_batch_reads_only_the_buckets_of_its_groups(spark, scratch):
    c = fx.clicks(spark, SF001)
    base = f"{scratch}/job"
    c.where("event_id < 600").coalesce(1).write.parquet(f"{scratch}/in")
    job = S.top_ads_job(spark, file_stream(spark, f"{scratch}/in", c.schema), 3, base=base)
    S.run_to_end(job.query)
    counts = job.stores["counts"]
    one = c.where("event_id < 600").select(F.to_date("ts").alias("day"), "area").limit(1)
    day, bucket = one.select("day", counts.bucket()).first()
    files = counts.read(days=[day], buckets=[bucket])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in files and "bucket" in files.split("PartitionFilters: ")[1].split("]")[0]


def test_emissions_hold_every_key_after_every_batch(spark, scratch):
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 300).cast("long"))
    n = write_batches(c, "batch_id", f"{scratch}/in")
    job = S.emissions_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                          base=f"{scratch}/job", state_partitions=2)
    S.run_to_end(job.query)
    cols = ["day", "area", "city", "adid", "click_count"]
    for b in range(n):
        got = job.stores["emissions"].read().where(F.col("emission") == b)
        assert rows_of(got, cols) == rows_of(ads.daily_totals(c.where(F.col("batch_id") <= b)), cols)


def test_hash_source_commits_by_batch(spark, scratch):
    """Partitions write files of their own; a batch counts when its list is written, and once."""
    from clicklens.sinks.hash_source import HashReader, HashWriter, read_hash
    out = f"{scratch}/hash"
    writer = HashWriter(out)

    def rows(*pairs):
        return iter([{"hash_key": "h", "field": f, "value": v} for f, v in pairs])

    first = [writer.write(rows(("a", "1"), ("b", "1"))), writer.write(rows())]
    assert read_hash(spark, out).count() == 0                     # nothing is committed yet
    writer.commit(first, 0)
    lost = writer.write(rows(("a", "9")))
    writer.abort([lost, None], 1)
    for _ in range(2):                                            # batch 1 runs again
        writer.commit([writer.write(rows(("a", "2"), ("c", "1")))], 1)
    assert {r["field"]: r["value"] for r in read_hash(spark, out).collect()} == {"a": "2", "b": "1", "c": "1"}
    assert len(HashReader(out).partitions()) == 2


def test_hash_stream_equals_the_totals(spark, scratch):
    from clicklens.sinks.hash_source import read_hash
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 300).cast("long"))
    write_batches(c, "batch_id", f"{scratch}/in")
    S.run_to_end(S.hash_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                            f"{scratch}/hash", f"{scratch}/checkpoint", state_partitions=2))
    cols = ["hash_key", "field", "value"]
    assert rows_of(read_hash(spark, f"{scratch}/hash"), cols) == rows_of(ads.daily_totals_kv(ads.daily_totals(c)), cols)


def test_closed_and_open_windows_are_all_windows(spark, scratch):
    """Chained aggregations: what the watermark passed is emitted once and has left the state, the rest is the state."""
    c = fx.clicks(spark, SF001).withColumn("batch_id", F.floor(F.col("event_id") / 250).cast("long"))
    write_batches(c, "batch_id", f"{scratch}/in")
    job = S.trend_windows_job(spark, file_stream(spark, f"{scratch}/in", c.schema, max_files_per_trigger=1),
                              "6 hours", "2 hours", "1 hour", "12 hours", base=f"{scratch}/job", state_partitions=2)
    S.run_to_end(job.query)
    mark = c.agg(F.max("ts")).first()[0] - dt.timedelta(hours=12)
    every = ads.trend(c, "6 hours", "2 hours", "1 hour")
    closed, still = job.stores["closed"].read(), job.stores["open"].read()
    assert rows_of(closed, WINDOW_COLS) == rows_of(every.where(F.col("window_end") <= F.lit(mark)), WINDOW_COLS) != []
    assert rows_of(still, WINDOW_COLS) == rows_of(every.where(F.col("window_end") > F.lit(mark)), WINDOW_COLS) != []


def test_live_trigger_with_batch_log_and_orderly_stop(spark, scratch):
    """A processing-time trigger picks up files as they come; the log has rows, late rows and lag of every batch."""
    import time
    from clicklens.streaming.monitor import BatchLog, stop
    t = dt.datetime(2024, 1, 10, 12)
    click = lambda i, ts: (i, ts, "N", "c", "u", "1", 0)
    parts = [[click(1, t), click(2, t)], [click(3, t + dt.timedelta(hours=3))],
             [click(4, t - dt.timedelta(days=1)), click(5, t + dt.timedelta(hours=4))]]
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([], SCHEMA).write.parquet(f"{scratch}/in")
    log = BatchLog().attach(spark)
    try:
        job = S.trend_windows_job(spark, file_stream(spark, f"{scratch}/in", schema), "2 hours", "1 hour", "1 hour",
                                  "30 minutes", trigger="200 milliseconds", base=f"{scratch}/job", state_partitions=2)
        seen = 0
        for part in parts:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
            seen += len(part)
            until = time.monotonic() + 60
            while sum(b.rows for b in log.of(job.query)) < seen and time.monotonic() < until:
                time.sleep(0.1)
        assert job.query.isActive
        stop(job.query)
        assert not job.query.isActive
        until = time.monotonic() + 20
        while str(job.query.id) not in log.ended and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        log.detach(spark)
    batches = log.of(job.query)
    assert sum(b.rows for b in batches) == 5 and log.late_rows(job.query) == 1
    assert all(b.lag_seconds > 0 for b in batches if b.rows) and log.ended[str(job.query.id)] is None
    assert {r["bucket_start"] for r in job.stores["closed"].read().collect()} == {t}


def test_compaction_drops_what_the_previous_base_replaced(spark, scratch):
    import os
    d = dt.date(2024, 1, 1)
    plain = KeyedSnapshot(spark, f"{scratch}/plain", ["day", "uid", "adid"], S.COUNTER_SCHEMA, "add")
    comp = KeyedSnapshot(spark, f"{scratch}/comp", ["day", "uid", "adid"], S.COUNTER_SCHEMA, "add")
    for b in range(10):
        df = spark.createDataFrame([(d, f"u{b % 3}", "1", b + 1)], S.COUNTER_SCHEMA)
        plain.write(df, b)
        comp.write(df, b)
        if b in (3, 7):
            comp.compact(b)
    for upto in (None, 9, 7, 5):
        assert sorted(tuple(r) for r in comp.read(upto).collect()) == \
            sorted(tuple(r) for r in plain.read(upto).collect()), upto
    with pytest.raises(ValueError):
        comp.read(2)
    local = comp.path.replace("file://", "").replace("file:", "")
    kept = sorted(int(n.split("=")[1]) for n in os.listdir(local) if n.startswith("batch_id="))
    assert kept == [4, 5, 6, 7, 8, 9]       # up to the previous base (3) is gone
    bases = sorted(n for n in os.listdir(local + "_base") if n.startswith("upto="))
    assert bases == ["upto=3", "upto=7"]


def test_bucketed_set_writes_a_file_for_each_bucket_and_batch_however_many_tasks(spark, scratch):
    from collections import Counter

    from clicklens.sinks.members import BucketedSet
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")   # as many write tasks as shuffle partitions, as with large batches
    try:
        members = BucketedSet(spark, f"{scratch}/set", "uid", buckets=3)
        for b in (0, 1):
            members.add(spark.range(b * 200, b * 200 + 300, 1, 8).select(F.col("id").cast("string").alias("uid")), b)
        members.add(spark.range(200, 500, 1, 8).select(F.col("id").cast("string").alias("uid")), 1)   # a replay
    finally:
        spark.conf.set(key, old)
    stored = spark.read.parquet(f"{scratch}/set").where("batch_id >= 0").select("bucket", "batch_id", F.input_file_name().alias("f"))
    files = Counter((r.bucket, r.batch_id) for r in stored.distinct().collect())
    assert files == {(k, b): 1 for k in range(3) for b in (0, 1)}
    assert {(int(r.uid), r.first_batch_id) for r in members.read().collect()} == {(i, int(i >= 300)) for i in range(500)}
