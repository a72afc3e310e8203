"""Event time, day buckets and the warehouse's date and hour keys."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formats of imported and published timestamps ---------------
IMPORT_FORMAT = "yyyy-MM-dd HH:mm:ss"
PUBLISH_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DAY_FORMAT = "yyyy-MM-dd"


def event_time(c: Column, fmt: str | None = None) -> Column:
    """Permissive parse: NULL when the text is no timestamp, whatever ANSI mode says."""
    return F.try_to_timestamp(c) if fmt is None else F.try_to_timestamp(c, F.lit(fmt))


def date_key(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def hour_key(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def day_bucket(ts: Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def target_hour(as_of: datetime) -> datetime:
    """Start of the last complete hour before ``as_of``."""
    return as_of.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)


def timestamp_literal(moment: datetime) -> Column:
    """UTC literal; independent of the time zone of the Python process."""
    return F.to_timestamp(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")))
