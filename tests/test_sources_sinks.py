"""Sources, sinks and stream wiring not covered elsewhere."""

import datetime as dt

from pyspark.sql import functions as F

from clicklens.model import VISIT_SCHEMA
from clicklens.plans import ads
from clicklens.sinks.tables import console_stream, overwrite_table, show
from clicklens.sources import fixtures as fx
from clicklens.sources.tables import from_rows, scan, typed
from clicklens.streaming import ads_streams as S

from paths import SF001


def test_scan_path_and_catalog(spark, scratch):
    ev = scan(spark, f"{SF001}/events.parquet")
    assert "event_type" in ev.columns
    v = fx.visits(spark, SF001)
    overwrite_table(v, "t_visits", path=f"{scratch}/t", partition_by=["date"])
    overwrite_table(v, "t_visits", path=f"{scratch}/t", partition_by=["date"])   # drop and replace
    t = scan(spark, "t_visits")
    assert t.count() == v.count()
    # the date filter prunes partitions of the written table
    plan = t.where(F.col("date") == "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_typed_projection_and_rows(spark):
    v = fx.visits(spark, SF001)
    t = typed(v.withColumn("action_time", F.col("action_time").cast("string")), VISIT_SCHEMA, keep=["event_id"])
    assert t.columns == ["event_id"] + VISIT_SCHEMA.fieldNames()
    assert dict(t.dtypes)["action_time"] == "string"
    rows = from_rows(spark, [(1, "Lyon", "EU")], "city_id long, city_name string, area string")
    assert rows.first()["city_name"] == "Lyon"
    show(rows, 1)


def test_processing_time_trigger_and_console(spark, scratch):
    c = fx.clicks(spark, SF001)
    c.coalesce(1).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(c.schema).parquet(f"{scratch}/in")
    job = S.daily_totals_job(spark, stream, trigger="1 second", base=f"{scratch}/job", state_partitions=2)
    job.query.processAllAvailable()
    job.query.stop()
    cols = ["day", "area", "city", "adid", "click_count"]
    got = sorted(tuple(r) for r in job.stores["totals"].read().select(*cols).collect())
    assert got == sorted(tuple(r) for r in ads.daily_totals(c).select(*cols).collect())
    q = console_stream(ads.daily_totals(stream), output_mode="complete", trigger="1 second",
                       checkpoint=f"{scratch}/console")
    q.processAllAvailable()
    q.stop()


def test_line_stream_quarantines_short_lines(spark, scratch):
    # A text file cannot hold a line end inside a line.
    lines = fx.ad_lines(spark, SF001).select("value").where("not contains(value, '\n')")
    bad = spark.createDataFrame([("1704067200000 AFRICA NATION_0 5",), ("",)], "value string")
    lines.coalesce(1).write.text(f"{scratch}/lines")
    bad.coalesce(1).write.mode("append").text(f"{scratch}/lines")
    stream = spark.readStream.text(f"{scratch}/lines")
    clicks = ads.clicks_from_lines(stream)
    job = S.daily_totals_job(spark, clicks, base=f"{scratch}/job", state_partitions=2)
    S.run_to_end(job.query)
    want = ads.daily_totals(ads.clicks_from_lines(lines))
    cols = ["day", "area", "city", "adid", "click_count"]
    assert sorted(tuple(r) for r in job.stores["totals"].read().select(*cols).collect()) == \
        sorted(tuple(r) for r in want.select(*cols).collect())
    broken = ads.parse_lines(lines)[1].count()
    assert broken > 0 and ads.parse_lines(spark.read.text(f"{scratch}/lines"))[1].count() == broken + 2
    assert job.stores["totals"].read().where(F.col("day") == dt.date(2024, 1, 1)).count() > 0
