"""Column functions: every one returns a JVM-side expression (no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of visit action, in the priority of the exclusive cascade.
CLICK, ORDER, PAY = "click", "order", "pay"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c: Column | str, sep: str = ",") -> Column:
    """Split like Java's ``String.split``: trailing empty strings are dropped.

    ``'1,2,'`` -> ``[1, 2]``; ``','`` -> ``[]``; ``''`` -> ``['']``;
    ``'1,,2'`` -> ``['1', '', '2']``; NULL stays NULL. A line end is a
    character like any other (``\\z``, not ``$``, is the end of the text).
    """
    c = _c(c)
    s = re.escape(sep)
    only_seps = c.rlike(rf"^({s})+\z")
    trimmed = F.regexp_replace(c, rf"({s})+\z", "")
    return F.when(only_seps, F.array().cast("array<string>")).otherwise(F.split(trimmed, s))


def action_kind(click_category: Column | str = "click_category_id",
                order_ids: Column | str = "order_category_ids",
                pay_ids: Column | str = "pay_category_ids") -> Column:
    """Exclusive cascade: a click if the click id is not -1, else an order if
    the order list is present, else a pay if the pay list is present.

    A NULL click id is read as "no click" (the reference cannot hold one).
    """
    return (F.when(_c(click_category) != -1, F.lit(CLICK))
            .when(_c(order_ids).isNotNull(), F.lit(ORDER))
            .when(_c(pay_ids).isNotNull(), F.lit(PAY)))


def action_category_ids(click_category: Column | str = "click_category_id",
                        order_ids: Column | str = "order_category_ids",
                        pay_ids: Column | str = "pay_category_ids") -> Column:
    """Category ids the row counts for, as strings, duplicates kept."""
    return (F.when(_c(click_category) != -1, F.array(_c(click_category).cast("string")))
            .when(_c(order_ids).isNotNull(), java_split(order_ids))
            .when(_c(pay_ids).isNotNull(), java_split(pay_ids)))


AD_LINE_FIELDS = ["time", "area", "cid", "uid", "adid"]


def ad_line_fields(value: Column | str = "value") -> Column:
    """Array of the space-separated fields of an ad-log line (Java split rules)."""
    return java_split(value, " ")


def ad_line_is_complete(parts: Column) -> Column:
    """A line is usable when it has at least the five fields."""
    return F.size(parts) >= len(AD_LINE_FIELDS)


def ad_line_columns(parts: Column) -> list[Column]:
    """The five typed fields of a split ad-log line (NULL where missing)."""
    return [F.try_element_at(parts, F.lit(i + 1)).alias(name)
            for i, name in enumerate(AD_LINE_FIELDS)]


def ntz_epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a wall-clock (``timestamp_ntz``) value,
    independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(ts))


def ntz_epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch, truncated toward minus infinity."""
    return F.floor(ntz_epoch_micros(ts) / F.lit(1000)).cast("long")


def millis_to_ntz(ms: Column | str) -> Column:
    """Epoch milliseconds (number or numeric string) to a UTC wall clock; NULL for any other text."""
    return F.timestamp_add("MILLISECOND", _c(ms).try_cast("long"), _epoch_ntz())


def is_millis(text: Column | str) -> Column:
    """Whether a text is a whole number of milliseconds (sign and digits only)."""
    return _c(text).rlike(r"^[+-]?[0-9]+\z") & _c(text).try_cast("long").isNotNull()


def day_of(ts: Column | str) -> Column:
    """Calendar day of a timestamp in the session zone (UTC in this repo)."""
    return F.to_date(_c(ts))


def floor_time(ts: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket holding ``ts``, aligned to the epoch,
    as a ``timestamp_ntz`` (NULL stays NULL; no row is dropped)."""
    us = int(seconds) * 1_000_000
    micros = ntz_epoch_micros(_c(ts).cast("timestamp_ntz"))
    return F.timestamp_add("MICROSECOND", F.floor(micros / F.lit(us)).cast("long") * F.lit(us), _epoch_ntz())


def clock_label(ts: Column | str) -> Column:
    """``mm:ss`` of a timestamp (the trend's bucket label)."""
    return F.date_format(_c(ts), "mm:ss")


def map_json(entries: Column | str) -> Column:
    """``array<struct<k, v>>`` in rank order -> JSON object ``{"k":v,...}``."""
    return F.to_json(F.map_from_entries(_c(entries)))


def pair_list_json(entries: Column | str) -> Column:
    """``array<struct<k, v>>`` -> JSON array of one-field objects ``[{"k":v},...]``."""
    return F.to_json(F.transform(_c(entries), lambda e: F.create_map(e.getField("k"), e.getField("v"))))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """``'60 seconds'`` / ``'1 hour'`` / ``'6 hours'`` -> whole seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", text)
    if not m or m.group(2).lower() not in _UNIT_SECONDS:
        raise ValueError(f"not a whole-unit interval: {text!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2).lower()]


def key_columns(key: Column | str, sep: str, names: list[str]) -> list[Column]:
    """Columns of a composite string key (``'2024-01-01:AREA:CITY:3'``), for
    keys imported from a key-value store; keys built here stay real columns."""
    return [F.split_part(_c(key), F.lit(sep), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
