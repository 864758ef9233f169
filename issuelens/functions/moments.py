"""Dates and times from epoch seconds, always read as UTC whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds as a UTC wall-clock timestamp; null stays null."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return start + F.make_dt_interval(secs=seconds)


def utc_to_epoch(moment: Column) -> Column:
    """A UTC wall-clock timestamp as whole epoch seconds."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("SECOND", start, moment)


def date_to_epoch(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * 86400


def publish_fields(moment: Column) -> dict[str, Column]:
    """Calendar fields of a timestamp; Monday is weekday 0."""
    return {
        "pub_date": F.date_format(moment, "yyyy-MM-dd"),
        "pub_year": F.year(moment),
        "pub_month": F.month(moment),
        "publish_hour": F.hour(moment),
        "publish_weekday": F.weekday(moment),
    }


def minutes(seconds: str) -> Column:
    return F.round(F.col(seconds) / F.lit(60.0), 1)


def days_between(start: str, end: str) -> Column:
    """Days from one epoch second to another, with fraction."""
    return (F.col(end) - F.col(start)) / F.lit(86400.0)
