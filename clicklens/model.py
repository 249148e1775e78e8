"""Declared schemas of the visit log, the ad-click log and the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per user action in a session; exactly one kind of action per row.
# "No click" is -1 in the click columns; "no order / pay / search" is NULL;
# order and pay lists are comma-joined ids in one string.
VISIT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# The visit log as this repo reads it: `event_id` breaks ties inside one
# second and `action_time` is a real timestamp instead of a string.
VISIT_COLUMNS = ["event_id", "date", "user_id", "session_id", "page_id", "action_time",
                 "search_keyword", "click_category_id", "click_product_id",
                 "order_category_ids", "order_product_ids", "pay_category_ids",
                 "pay_product_ids", "city_id"]

USER_INFO_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_INFO_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO_SCHEMA = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# Parsed ad-log line: `epochMillis area city uid adid`, all strings.
AD_CLICK_SCHEMA = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("cid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("adid", T.StringType()),
])

CATEGORY_TOP10_SCHEMA = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("click_count", T.LongType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("pay_count", T.LongType()),
])

# Schema of the driver's `events` table (streams need it up front).
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Columns of the driver's dimension tables that the click view uses.
NATION_SCHEMA = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
])
REGION_SCHEMA = T.StructType([
    T.StructField("r_regionkey", T.IntegerType()),
    T.StructField("r_name", T.StringType()),
])
TABLE_SCHEMAS = {"events": EVENTS_SCHEMA, "nation": NATION_SCHEMA, "region": REGION_SCHEMA}

# Fixed values of the reference jobs (defaults of the public functions).
TOP_CATEGORIES = 10          # categories kept by the category ranking
TOP_SESSIONS = 10            # sessions kept per top category
TOP_ADS = 3                  # ads kept per (day, area)
DEFAULT_FLOW = "1,2,3,4,5,6"  # target page flow
BAN_THRESHOLD = 100          # clicks per (day, user, ad) that ban a user
TREND_WINDOW = "60 seconds"
TREND_SLIDE = "10 seconds"
TREND_BUCKET = "10 seconds"
TOTALS_TRIGGER = "5 seconds"
TOP_ADS_TRIGGER = "3 seconds"
AD_TOPIC = "ads_log"
