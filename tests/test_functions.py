import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicklens.functions import columns as C


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


@pytest.mark.parametrize("text,expected", [
    ("1,2,", ["1", "2"]),
    (",", []),
    (",,,", []),
    ("", [""]),
    ("1,,2", ["1", "", "2"]),
    (",1", ["", "1"]),
    ("13,17,11,14", ["13", "17", "11", "14"]),
    (None, None),
])
def test_java_split(spark, text, expected):
    assert one(spark, C.java_split("v"), [(text,)], "v string") == [expected]


def test_action_cascade(spark):
    rows = [(3, "4,5", None), (-1, "4", "5"), (-1, None, "6"), (-1, None, None), (None, "7", None)]
    df = spark.createDataFrame(rows, "click_category_id long, order_category_ids string, pay_category_ids string")
    got = df.select(C.action_kind(), C.action_category_ids()).collect()
    assert [tuple(r) for r in got] == [
        ("click", ["3"]), ("order", ["4"]), ("pay", ["6"]), (None, None), ("order", ["7"])]


def test_ad_line_fields(spark):
    df = spark.createDataFrame([("1553252856544 AREA city 5 6",), ("1 2 3 4",)], "value string")
    parts = C.ad_line_fields("value")
    got = df.select(C.ad_line_is_complete(parts).alias("ok"), *C.ad_line_columns(parts)).collect()
    assert tuple(got[0]) == (True, "1553252856544", "AREA", "city", "5", "6")
    assert got[1]["ok"] is False and got[1]["adid"] is None


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59, 50, 123456),), (None,)], "ts timestamp_ntz")
    r = df.select(C.ntz_epoch_millis("ts").alias("ms"), C.floor_time("ts", 10).alias("b"),
                  C.floor_time("ts", 3600).alias("h"), C.clock_label("ts").alias("l")).collect()
    assert r[0]["ms"] == 1704106790123
    assert r[0]["b"] == dt.datetime(2024, 1, 1, 10, 59, 50)
    assert r[0]["h"] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert r[0]["l"] == "59:50"
    assert r[1]["b"] is None  # NULL stays, the row is not dropped
    back = spark.createDataFrame([("1704106790123",)], "t string").select(C.millis_to_ntz("t")).first()[0]
    assert back == dt.datetime(2024, 1, 1, 10, 59, 50, 123000)


def test_json_forms(spark):
    df = spark.createDataFrame([([("2", 35), ("5", 20)],)], "l array<struct<k:string,v:bigint>>")
    assert df.select(C.map_json("l")).first()[0] == '{"2":35,"5":20}'
    df = spark.createDataFrame([([("30:10", 5), ("30:20", 7)],)], "l array<struct<k:string,v:bigint>>")
    assert df.select(C.pair_list_json("l")).first()[0] == '[{"30:10":5},{"30:20":7}]'


def test_interval_seconds():
    assert C.interval_seconds("60 seconds") == 60
    assert C.interval_seconds("1 hour") == 3600
    assert C.interval_seconds("6 hours") == 21600
    with pytest.raises(ValueError):
        C.interval_seconds("soon")


def test_param_lookup(spark):
    from clicklens.sources.tables import param, param_column
    assert param('{"targetPageFlow": "1,2,3"}', "targetPageFlow") == "1,2,3"
    df = spark.createDataFrame([('{"targetPageFlow": "1,2,3"}',)], "doc string")
    assert df.select(param_column("doc", "targetPageFlow")).first()[0] == "1,2,3"


def test_time_range(spark):
    from clicklens.sources.tables import time_range
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 5, 9)], "action_time timestamp_ntz")
    assert time_range(df, "2024-01-05 00:00:00", " ").count() == 2
    assert time_range(df, None, "2024-01-05 00:00:00").count() == 2
    assert time_range(df, "", None).count() == 3
    assert df.select(F.lit(1)).count() == 3


def _java_split(s):
    """Java's String.split(",") with limit 0: split, drop trailing empty strings;
    no separator at all gives the input itself."""
    if s is None:
        return None
    if "," not in s:
        return [s]
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_matches_java_rules(spark):
    from hypothesis import given, settings, strategies as st
    samples = []

    @settings(max_examples=200, deadline=None, database=None)
    @given(st.text(alphabet="1,", max_size=8))
    def collect(s):
        samples.append(s)

    collect()
    rows = [(s,) for s in sorted(set(samples))]
    got = spark.createDataFrame(rows, "v string").select("v", C.java_split("v").alias("p")).collect()
    for r in got:
        assert r["p"] == _java_split(r["v"]), r["v"]


def test_key_columns_round_trip(spark):
    df = spark.createDataFrame([("2024-01-01:MIDDLE EAST:NATION_4:3",)], "field string")
    r = df.select(*C.key_columns("field", ":", ["day", "area", "city", "adid"])).first()
    assert tuple(r) == ("2024-01-01", "MIDDLE EAST", "NATION_4", "3")


def test_scale_conf():
    from clicklens.config import scale_conf
    c = scale_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts >= 3 * 8000
    assert 100 * (1 << 40) * 0.3 / parts <= 256 * (1 << 20)       # <= 256 MB per shuffle partition
    small = scale_conf(2 << 20, executors=1, cores_per_executor=8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert "RocksDB" in c["spark.sql.streaming.stateStore.providerClass"]
