"""Column expressions on local time, periods and storage buckets."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width and number of storage buckets, and the zone of the meters.
BUCKET_SECONDS = 10_000_000
BUCKET_COUNT = 20
WEATHER_BUCKET_COUNT = 4
METER_ZONE = "Europe/Madrid"


def assemble_timestamp(year: Column, month: Column, day: Column, hour: Column | None = None) -> Column:
    """Timestamp out of date parts (text or numbers); an impossible date gives null."""
    part = lambda column: column.try_cast("int")
    hours = F.lit(0) if hour is None else part(hour)
    return F.try_make_timestamp(part(year), part(month), part(day), hours, F.lit(0), F.lit(0).cast("decimal(16,6)"))


def is_clock_change(local: Column) -> Column:
    """Local hour 2 of the last Sunday in March or October, which clock changes skip or repeat."""
    return (
        F.month(local).isin(3, 10)
        & (F.hour(local) == 2)
        & (F.dayofweek(local) == 1)
        & (F.dayofmonth(local) > 24)
    )


def localise(local: Column, zone: str = METER_ZONE) -> Column:
    """Instant of a naive local time. Drop clock-change hours first: they have no single instant."""
    return F.to_utc_timestamp(local, zone)


def epoch_seconds(instant: Column) -> Column:
    """Whole seconds since 1970, rounded down; naive times count as UTC."""
    return F.unix_seconds(instant.cast("timestamp"))


def time_bucket(start: Column, width: int = BUCKET_SECONDS, count: int = BUCKET_COUNT) -> Column:
    """Storage bucket of an epoch second; floors, so that times before 1970 get a bucket from 0 too."""
    return F.pmod(F.floor(start / F.lit(width)), F.lit(count))


def buckets_between(start: datetime, end: datetime, width: int = BUCKET_SECONDS,
                    count: int = BUCKET_COUNT) -> list[int]:
    """Buckets that ``[start, end)`` can fall in: pass them to a filter so that partitions are pruned."""
    seconds = [int(t.replace(tzinfo=t.tzinfo or timezone.utc).timestamp()) for t in (start, end)]
    first, last = seconds[0] // width, (seconds[1] - 1) // width
    return sorted({slot % count for slot in range(first, min(last, first + count - 1) + 1)})


def period_end(start: Column, freq: str) -> Column:
    """End of a period: one hour on, 365 days on, or the last day of the month at the same time of day."""
    if freq == "PT1H":
        return start + F.expr("interval 1 hour")
    if freq == "P1Y":
        return start + F.expr("interval 365 days")
    if freq == "P1M":
        rest = F.datediff(F.last_day(start), start)
        return start + F.make_interval(F.lit(0), F.lit(0), F.lit(0), rest)
    raise ValueError(f"unknown period {freq!r}")


def truncate_to(start: Column, freq: str) -> Column:
    """Start of the period that holds ``start``; an empty ``freq`` keeps the native step."""
    units = {"PT1H": "hour", "P1D": "day", "P1M": "month", "P1Y": "year"}
    return F.date_trunc(units[freq], start) if freq else start


def format_time(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
