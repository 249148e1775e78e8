"""Ad-click jobs on hand-made clicks (FIXTURES.md section 5)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clicklens.plans import ads

SCHEMA = ("event_id long, ts timestamp_ntz, area string, city string, uid string, "
          "adid string, batch_id long")
D1 = dt.datetime(2024, 1, 1, 23, 59, 50)


def clicks(spark, rows):
    """rows: (event_id, ts, area, uid, adid, batch_id); city = area + '-c'."""
    return spark.createDataFrame([(e, t, a, a + "-c", u, ad, b) for e, t, a, u, ad, b in rows], SCHEMA)


def test_daily_totals_and_late_click(spark):
    c = clicks(spark, [(1, D1, "N", "u1", "1", 0), (2, D1 + dt.timedelta(seconds=20), "N", "u1", "1", 0),
                       (3, D1 - dt.timedelta(hours=1), "N", "u2", "1", 1)])  # late: yesterday's click in batch 1
    got = {(str(r["day"]), r["adid"]): r["click_count"] for r in ads.daily_totals(c).collect()}
    assert got == {("2024-01-01", "1"): 2, ("2024-01-02", "1"): 1}
    kv = ads.daily_totals_kv(ads.daily_totals(c)).collect()
    assert {r["field"] for r in kv} == {"2024-01-01:N:N-c:1", "2024-01-02:N:N-c:1"}
    assert {r["hash_key"] for r in kv} == {"date:area:city:ads"}


def test_top_ads_and_json(spark):
    rows, e = [], 0
    for ad, n in [("2", 35), ("5", 20), ("1", 20), ("9", 3)]:
        for _ in range(n):
            e += 1
            rows.append((e, D1, "N", "u", ad, 0))
    ranked = ads.top_ads_per_area(clicks(spark, rows), 3)
    assert [(r["adid"], r["click_count"], r["rk"]) for r in ranked.orderBy("rk").collect()] == [
        ("2", 35, 1), ("1", 20, 2), ("5", 20, 3)]
    js = ads.top_ads_json(ranked).first()
    assert js["hash_key"] == "top3_ads_per_day:2024-01-01" and js["field"] == "N"
    assert js["value"] == '{"2":35,"1":20,"5":20}'


def test_trend_hour_turn_and_windows(spark):
    t = dt.datetime(2024, 1, 1, 10, 59, 50)
    c = clicks(spark, [(1, t, "N", "u", "1", 0), (2, t + dt.timedelta(seconds=12), "N", "u", "1", 0),
                       (3, t + dt.timedelta(seconds=15), "N", "u", "1", 0)])
    flat = ads.trend(c, "60 seconds", "10 seconds", "10 seconds")
    # every bucket is in window/slide = 6 windows
    assert flat.groupBy("bucket_start").count().where("count <> 6").count() == 0
    js = {r["window_start"]: r["value"] for r in ads.trend_json(flat).collect()}
    both = dt.datetime(2024, 1, 1, 10, 59, 10)
    assert json.loads(js[both]) == [{"59:50": 1}, {"00:00": 2}]   # time order, not text order


def test_trend_rejects_misaligned_buckets():
    with pytest.raises(ValueError):
        ads._check_trend("60 seconds", "15 seconds", "10 seconds")


def test_ban_per_batch_same_batch_counted(spark):
    th = 2
    rows = [(i, D1, "N", "u1", "1", 0) for i in range(th + 3)]           # ban reached inside batch 0
    rows += [(10, D1, "N", "u1", "2", 1), (11, D1, "N", "u2", "1", 1)]   # u1 dropped from batch 1
    c = clicks(spark, rows)
    acc = {r["event_id"] for r in ads.accepted_per_batch(c, th).collect()}
    assert acc == set(range(th + 3)) | {11}
    assert [tuple(r) for r in ads.ban_batches(c, th).collect()] == [("u1", 0)]
    counts = {(r["uid"], r["adid"]): r["click_count"]
              for r in ads.user_day_ad_counts(ads.accepted_per_batch(c, th)).collect()}
    assert counts == {("u1", "1"): th + 3, ("u2", "1"): 1}


def test_ban_per_event(spark):
    th = 3
    t = [D1 + dt.timedelta(seconds=s) for s in range(6)]
    rows = [(1, t[0], "N", "u1", "1", 0), (2, t[1], "N", "u1", "2", 0), (3, t[1], "N", "u1", "1", 0),
            (5, t[2], "N", "u1", "1", 0),   # 3rd click on ad 1: ban, still accepted
            (4, t[2], "N", "u1", "2", 0),   # same second, lower event id: before the ban
            (6, t[3], "N", "u1", "2", 0), (7, t[4], "N", "u2", "1", 0)]
    c = clicks(spark, rows)
    acc = {r["event_id"] for r in ads.accepted_per_event(c, th).collect()}
    assert acc == {1, 2, 3, 4, 5, 7}
    ban = ads.ban_events(c, th).first()
    assert (ban["uid"], ban["ban_event_id"]) == ("u1", 5)


def test_parse_lines_quarantine(spark):
    lines = spark.createDataFrame([("1704067200000 N c 5 6",), ("1704067200000 N c 5",), (None,)], "value string")
    ok, bad = ads.parse_lines(lines)
    assert [tuple(r) for r in ok.collect()] == [("1704067200000", "N", "c", "5", "6")]
    assert bad.count() == 2
    typed = ads.clicks_from_lines(lines).first()
    assert typed["ts"] == dt.datetime(2024, 1, 1) and typed["city"] == "c"


@pytest.mark.parametrize("w,s,b", [("60 seconds", "10 seconds", "10 seconds"), ("6 hours", "1 hour", "1 hour"),
                                   ("1 hour", "10 minutes", "5 minutes"), ("2 minutes", "1 minute", "30 seconds")])
def test_trend_equals_spark_sliding_window(spark, w, s, b):
    """Bucket counts expanded into windows == Spark's own sliding window per click."""
    from clicklens.functions.columns import floor_time, interval_seconds
    from clicklens.sources import fixtures as fx
    c = fx.clicks(spark, "/root/testdata/sf0.001")
    ours = ads.trend(c, w, s, b)
    spark_w = (c.groupBy(F.window("ts", w, s).alias("win"), "adid",
                         floor_time("ts", interval_seconds(b)).alias("bucket_start"))
               .agg(F.count(F.lit(1)).alias("click_count"))
               .select(F.col("win.start").alias("window_start"), F.col("win.end").alias("window_end"),
                       "adid", "bucket_start", "click_count"))
    cols = ["window_start", "window_end", "adid", "bucket_start", "click_count"]
    a = sorted(tuple(r) for r in ours.select(*cols).collect())
    z = sorted(tuple(r) for r in spark_w.select(*cols).collect())
    assert len(a) > 0 and a == z
