"""Event-time helpers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval_sql(span: timedelta) -> str:
    return f"interval {micros(span)} microseconds"


def time_bucket(at: Column, width: timedelta) -> Column:
    """Number of the bucket that holds the time; rounds down before 1970 too."""
    us = F.unix_micros(at)
    w = F.lit(micros(width))
    return F.call_function("div", us - F.pmod(us, w), w)


def bucket_and_previous(bucket: Column) -> Column:
    """The bucket and the one before it, for a span no longer than a bucket."""
    return F.array(bucket, bucket - 1)
