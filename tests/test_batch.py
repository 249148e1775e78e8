"""Visit-log jobs on hand-made rows (FIXTURES.md section 5) and brute-force checks."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clicklens.operators.adjacent import with_next
from clicklens.plans import categories as cat
from clicklens.plans import conversion as conv

SCHEMA = ("event_id long, session_id string, page_id long, action_time timestamp_ntz, "
          "click_category_id long, order_category_ids string, pay_category_ids string")
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def visits(spark, rows):
    """rows: (event_id, session, page, seconds, click, orders, pays)."""
    return spark.createDataFrame(
        [(e, s, p, T0 + dt.timedelta(seconds=t), c, o, y) for e, s, p, t, c, o, y in rows], SCHEMA)


def counts(df):
    return {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
            for r in cat.category_counts(df).collect()}


def test_cascade_and_lists(spark):
    v = visits(spark, [
        (1, "a", 1, 0, 3, "4,5", None),      # click beats order
        (2, "a", 1, 1, -1, "4", "5"),        # order beats pay
        (3, "a", 1, 2, -1, "13,13", None),   # duplicate counted twice
        (4, "a", 1, 3, -1, "1,2,", None),    # trailing comma
        (5, "a", 1, 4, -1, ",", None),       # only commas: nothing
        (6, "a", 1, 5, -1, "", None),        # empty: category ''
        (7, "a", 1, 6, -1, None, "1,,2"),    # inner empty
        (8, "a", 1, 7, -1, None, None),      # search row: nowhere
    ])
    got = counts(v)
    assert got["3"] == (1, 0, 0)
    assert got["4"] == (0, 1, 0)
    assert "5" not in got
    assert got["13"] == (0, 2, 0)
    assert got["1"] == (0, 1, 1) and got["2"] == (0, 1, 1)
    assert got[""] == (0, 1, 1)
    assert set(got) == {"3", "4", "13", "1", "2", ""}
    pivot = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
             for r in cat.category_counts_pivot(v).collect()}
    assert pivot == got


def test_top_categories_order_and_ties(spark):
    rows, e = [], 0
    for c, n_click, n_order in [(1, 3, 0), (2, 3, 1), (3, 5, 0), (4, 1, 0), (5, 1, 0)]:
        for _ in range(n_click):
            e += 1
            rows.append((e, "s", 1, e, c, None, None))
        for _ in range(n_order):
            e += 1
            rows.append((e, "s", 1, e, -1, str(c), None))
    top = cat.top_categories(visits(spark, rows), n=4, task_id="t").collect()
    assert [r["category_id"] for r in top] == ["3", "2", "1", "4"]
    assert {r["task_id"] for r in top} == {"t"}


def test_top_sessions(spark):
    rows, e = [], 0
    for sess, c, n in [("x", 1, 3), ("y", 1, 3), ("z", 1, 1), ("x", 2, 2), ("w", 9, 5)]:
        for _ in range(n):
            e += 1
            rows.append((e, sess, 1, e, c, None, None))
    v = visits(spark, rows)
    top = spark.createDataFrame([("1", "t"), ("2", "t")], "category_id string, task_id string")
    got = cat.top_sessions_per_category(v, top, n=2).orderBy("category_id", F.desc("click_count"),
                                                              "session_id").collect()
    assert [(r["category_id"], r["session_id"], r["click_count"]) for r in got] == [
        ("1", "x", 3), ("1", "y", 3), ("2", "x", 2)]
    stored = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "category_id string, task_id string")
    assert sorted(tuple(r) for r in cat.top_list(stored, all_runs=True).collect()) == [("1", "b"), ("2", "a")]
    assert [tuple(r) for r in cat.top_list(stored).collect()] == [("1", "b")]      # the latest run
    assert cat.top_list(stored, "a").count() == 2


def test_conversion_edges(spark):
    v = visits(spark, [
        (1, "one", 1, 0, -1, None, None),    # one-visit session: no pair, counts in total
        (3, "s", 1, 5, -1, None, None),      # same second as event 2: event_id decides
        (2, "s", 2, 5, -1, None, None),
        (4, "s", 3, 6, -1, None, None),
        (5, "r", 2, 0, -1, None, None),      # pair 2 -> 1 is not in flow order
        (6, "r", 1, 1, -1, None, None),
        (7, "m", 1, 0, -1, None, None),      # 1 -> 9 -> 2: no pair
        (8, "m", 9, 1, -1, None, None),
        (9, "m", 2, 2, -1, None, None),
    ])
    got = {(r["from_page"], r["to_page"]): (r["pair_count"], r["page_count"], r["rate"], r["rate_pct"])
           for r in conv.page_conversion(v, "1,2,3", percent=True).collect()}
    # s is ordered 2(e2) -> 1(e3) -> 3(e4); r is 2 -> 1; m is 1 -> 9 -> 2: no flow pair anywhere
    assert got == {}
    v2 = visits(spark, [(1, "s", 1, 0, -1, None, None), (2, "s", 2, 1, -1, None, None),
                        (3, "s", 3, 2, -1, None, None), (4, "t", 1, 0, -1, None, None),
                        (5, "t", 1, 1, -1, None, None), (6, "u", 2, 0, -1, None, None)])
    got = {(r["from_page"], r["to_page"]): (r["pair_count"], r["page_count"], r["rate_pct"])
           for r in conv.page_conversion(v2, "1,2,3,2", percent=True).collect()}
    assert got == {(1, 2): (1, 3, 33), (2, 3): (1, 2, 50)}
    assert conv.flow_pairs("1,2,3,2,3") == [(1, 2), (2, 3), (3, 2)]


def plain_lead(v, order):
    return v.withColumn("nxt", F.lead("page_id").over(Window.partitionBy("session_id").orderBy(*order)))


def test_with_next_equals_plain_lead_for_any_plan(spark):
    """Hot sessions (a NULL one too), NULL pages, bursts and one shared
    timestamp: the result is the plain per-session lead for any cut."""
    rnd = random.Random(7)
    rows = []
    for e in range(3000):
        s = rnd.choice(["burst"] * 3 + [None] * 4 + ["a", "b", "c", "d"])
        t = 100 if s == "burst" else rnd.randint(0, 400)
        rows.append((e, s, rnd.choice([1, 2, 3, None]), t, -1, None, None))
    v = visits(spark, rows).select("session_id", "action_time", "event_id", "page_id").repartition(3)
    order = ["action_time", "event_id"]
    want = sorted(map(str, plain_lead(v, order).collect()))
    from clicklens.operators.adjacent import PLAIN_BYTES
    some = v.where("event_id < 40")
    for df, plain_bytes in ((v, 0), (v, 1 << 70), (v.repartition(7), 0), (v.coalesce(1), PLAIN_BYTES)):
        got = with_next(df, "session_id", order, "page_id", "nxt", plain_bytes=plain_bytes)
        assert sorted(map(str, got.drop("has_next").collect())) == want
        # Only a session's last row has no next one, whatever the pages.
        assert got.where(~F.col("has_next")).count() == v.select("session_id").distinct().count()
    got = with_next(some, "session_id", order, "page_id", "nxt", plain_bytes=0).drop("has_next")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain_lead(some, order).collect()))
    assert with_next(v.where("false"), "session_id", order, "page_id", "nxt", plain_bytes=0).count() == 0


def test_a_hot_session_is_cut_even_within_one_timestamp(spark):
    v = visits(spark, [(e, "hot", e % 5, 7, -1, None, None) for e in range(2000)]).select(
        "session_id", "action_time", "event_id", "page_id")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")       # the rows are few: AQE would put them together again
    try:
        spread = v.repartitionByRange("session_id", "action_time", "event_id")
        per = [r["n"] for r in spread.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(key, "true")
    assert len(per) >= 3 and max(per) <= 1200


def test_conversion_result_does_not_depend_on_the_cut(spark):
    from clicklens.sources import fixtures as fx
    v = fx.visits(spark, "/root/testdata/sf0.01")
    cols = ["from_page", "to_page", "pair_count", "page_count", "rate", "rate_pct"]
    base = sorted(tuple(r) for r in conv.page_conversion(v, percent=True).select(*cols).collect())
    hot = sorted(tuple(r) for r in conv.page_conversion(v, percent=True, plain_bytes=0).select(*cols).collect())
    assert len(base) == 5 and base == hot
    n = conv.page_transitions(v, plain_bytes=0).count()
    assert n == conv.page_transitions(v).count() == v.count() - v.select("session_id").distinct().count()


def test_flow_of_one_page_has_no_pairs(spark):
    v = visits(spark, [(1, "s", 1, 0, -1, None, None), (2, "s", 2, 1, -1, None, None)])
    for flow in ("1", "", []):
        out = conv.page_conversion(v, flow, percent=True)
        assert out.columns == ["from_page", "to_page", "pair_count", "page_count", "rate", "rate_pct"]
        assert out.count() == 0


def test_lookup_joins_hint_only_bounded_or_measured_sides(spark):
    from clicklens.operators.lookup import MAX_BROADCAST_BYTES, ROW_BYTES, attach, checked_side, drop_in
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # only our hint may broadcast
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(0, 1000, 100).withColumnRenamed("id", "k")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(attach(big, small, "k", max_rows=10))
        dropped = drop_in(big, small, "k", max_rows=None)             # no bound: no hint
        assert dropped.count() == 990
        assert "BroadcastHashJoin" not in plan(dropped)
        too_many = MAX_BROADCAST_BYTES // ROW_BYTES + 1
        assert "BroadcastHashJoin" not in plan(attach(big, small, "k", max_rows=too_many))
        assert "BroadcastHashJoin" in plan(big.join(checked_side(small), "k"))
        assert "Scan parquet" not in plan(checked_side(small))         # small input: not written first
        over = big.join(checked_side(small, max_bytes=10), "k")
        assert "Scan parquet" in plan(over).replace("FileScan", "Scan")
        assert "BroadcastHashJoin" not in plan(over) and over.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
