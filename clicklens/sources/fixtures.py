"""The visit log and the ad-click log as views over the driver's tables.

The reference reads a Hive visit table and a Kafka topic of ad lines, both
filled by unseeded mockers. Here both are derived, row for row, from the
``events`` table (plus ``nation`` / ``region`` for area and city names), so
every query's work grows with the input. The same SQL, written for DuckDB,
is the oracle's view (``clicklens.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.functions.columns import ntz_epoch_millis
from clicklens.model import TABLE_SCHEMAS

# Fixed values of the fixture rule (shared with the oracle views).
N_CATEGORIES = 20
N_PAGES = 10
N_ADS = 6
N_CITIES = 25
BATCH_DAYS = 5           # days per replayed micro-batch of the ad stream; batches begin at noon
NOON_MS, BATCH_MS = 43_200_000, BATCH_DAYS * 86_400_000


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; known tables are read with their declared schema (no inference)."""
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(sf_dir, name))


def _k(props: Column) -> Column:
    return F.regexp_extract(props, "([0-9]+)", 1).cast("long")


def _ids(event_id: Column, k: Column) -> Column:
    a = (k % N_CATEGORIES + 1).cast("string")
    b = ((k + 7) % N_CATEGORIES + 1).cast("string")
    c = ((k + 11) % N_CATEGORIES + 1).cast("string")
    m = event_id % 3
    return (F.when(m == 0, a)
            .when(m == 1, F.concat(a, F.lit(","), b))
            .otherwise(F.concat(a, F.lit(","), b, F.lit(","), c)))


def visits_from_events(events: DataFrame) -> DataFrame:
    """Visit log: one row per event, one action kind per row; an ``error`` event is a plain page visit."""
    e = F.col("event_type")
    k = F.col("_k")
    ids = F.col("_ids")
    return (events
            .withColumn("_k", _k(F.col("props")))
            .withColumn("_ids", _ids(F.col("event_id"), k))
            .select(
                "event_id",
                F.col("ts").cast("date").cast("string").alias("date"),
                "user_id",
                F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"),
                ((F.col("event_id") * 31 + F.col("user_id") * 17) % N_PAGES + 1).alias("page_id"),
                F.col("ts").alias("action_time"),
                F.when(e == "view", F.concat(F.lit("kw"), (k % 6).cast("string"))).alias("search_keyword"),
                F.when(e == "click", k % N_CATEGORIES + 1).otherwise(F.lit(-1).cast("long")).alias("click_category_id"),
                F.when(e == "click", k + 1).otherwise(F.lit(-1).cast("long")).alias("click_product_id"),
                F.when(e == "purchase", ids).alias("order_category_ids"),
                F.when(e == "purchase", ids).alias("order_product_ids"),
                F.when(e == "signup", ids).alias("pay_category_ids"),
                F.when(e == "signup", ids).alias("pay_product_ids"),
                (F.col("user_id") % N_CITIES).alias("city_id"),
            ))


def clicks_from_events(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Ad clicks: one row per click event with area (region) and city (nation).

    ``nation`` and ``region`` are fixed-size dimension tables (25 and 5 rows
    at every scale factor), so their join is broadcast by hint. Without it,
    Spark's size estimate for a join (the product of its inputs) can make
    the dimension side look larger than a small fact table.
    """
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_nationkey").cast("long").alias("_nk"),
                   F.col("r_name").alias("area"), F.col("n_name").alias("city")))
    c = (events.where(F.col("event_type") == "click")
         .select("event_id", "ts", "user_id", "props")
         .withColumn("_nk", F.col("user_id") % N_CITIES))
    return (c.join(F.broadcast(geo), "_nk")
            .select("event_id", "ts", "area", "city",
                    F.col("user_id").cast("string").alias("uid"),
                    (_k(F.col("props")) % N_ADS + 1).cast("string").alias("adid"),
                    batch_of("ts").alias("batch_id")))


def batch_of(ts: Column | str) -> Column:
    """The micro-batch of a click: ``BATCH_DAYS`` days from noon, so a calendar day can span two."""
    return F.floor((ntz_epoch_millis(ts) + NOON_MS) / BATCH_MS).cast("long")


def ad_lines_from_clicks(clicks: DataFrame) -> DataFrame:
    """Ad-log lines ``epochMillis area city uid adid``; spaces in names become ``_``.

    Some lines are broken, as real ones are: a time that is no number, a line
    cut after the city, a line end behind the last field.
    """
    e = F.col("event_id")
    head = [ntz_epoch_millis("ts").cast("string"), F.regexp_replace("area", " ", "_"),
            F.regexp_replace("city", " ", "_")]
    whole = F.concat_ws(" ", *head, F.col("uid"), F.col("adid"))
    value = (F.when(e % 97 == 0, F.concat(F.lit("x"), whole))
             .when(e % 89 == 0, F.concat_ws(" ", *head))
             .when(e % 83 == 0, F.concat(whole, F.lit("\n")))
             .otherwise(whole))
    return clicks.select("event_id", value.alias("value"), "batch_id")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_events(read_table(spark, sf_dir, "events"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_from_events(read_table(spark, sf_dir, "events"),
                              read_table(spark, sf_dir, "nation"),
                              read_table(spark, sf_dir, "region"))


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_lines_from_clicks(clicks(spark, sf_dir))


def replayed(spark: SparkSession, sf_dir: str, job, shape=None) -> None:
    """Run a stream job over the clicks, one micro-batch per ``batch_id``, in order.

    ``job(stream)`` starts the job on a stream of the rows written so far, always
    with the same checkpoint. A batch is written by an ordinary job that reads
    its own time range only (pushed to the scan), as as many files as the job
    likes; the driver sees the first and the last batch number. ``shape`` turns
    the clicks into the stream's rows.
    """
    from clicklens.config import shared_dir
    from clicklens.sources.stream import file_stream
    from clicklens.streaming.ads_streams import run_to_end
    shape = shape or (lambda df: df)
    events = read_table(spark, sf_dir, "events")
    first, last = (events.where(F.col("event_type") == "click").agg(F.min("ts"), F.max("ts"))
                   .select(*[batch_of(c) for c in ("min(ts)", "max(ts)")]).first())
    folder = shared_dir(spark, "replay")
    geo = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    schema = shape(clicks_from_events(events, *geo)).schema
    for b in range(first, last + 1) if first is not None else ():
        low, high = (F.timestamp_millis(F.lit(x * BATCH_MS - NOON_MS)).cast(events.schema["ts"].dataType)
                     for x in (b, b + 1))
        part = events.where((F.col("ts") >= low) & (F.col("ts") < high))
        shape(clicks_from_events(part, *geo)).write.mode("append").parquet(folder)
        run_to_end(job(file_stream(spark, folder, schema)).query)
