"""Time columns. All work on zone-free timestamps and ignore the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.schema import ZONE

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz(value: datetime | str) -> Column:
    """A zone-free timestamp literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``."""
    return (later - earlier).cast("interval second").cast("bigint")


def micros_between(later: Column, earlier: Column) -> Column:
    """Microseconds from ``earlier`` to ``later``."""
    seconds = (later - earlier).cast("interval second").cast("decimal(20, 6)")
    return (seconds * 1_000_000).cast("bigint")


def more_than(later: Column, earlier: Column, seconds: int) -> Column:
    """Whether more than ``seconds`` passed, to the microsecond."""
    return micros_between(later, earlier) > seconds * 1_000_000


def epoch_seconds(ts: Column) -> Column:
    return seconds_between(ts, F.expr(EPOCH))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.expr(EPOCH) + seconds.cast("interval second")


def from_epoch_micros(micros: Column) -> Column:
    return F.expr(EPOCH) + (micros.cast("decimal(20, 0)") / 1_000_000).cast("decimal(18, 6)").cast("interval second")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of the wall clock, whole seconds only."""
    return epoch_seconds(ts) * F.lit(1000).cast("bigint")


def instant(ts: Column) -> Column:
    """Zone-free UTC wall clock -> instant, as the streaming watermark wants it."""
    return F.timestamp_micros(micros_between(ts, F.expr(EPOCH)))


def wall_clock(ts: Column) -> Column:
    """Instant -> zone-free UTC wall clock."""
    return from_epoch_micros(F.unix_micros(ts))


def localtime(ts: Column, zone: str = ZONE) -> Column:
    """UTC wall clock -> wall clock of ``zone``, to the microsecond.

    Goes through an instant because the zone rules of ``from_utc_timestamp`` are looked up
    once per task; ``convert_timezone`` parses both zone names again for every row."""
    there = F.from_utc_timestamp(F.timestamp_seconds(epoch_seconds(ts)), zone)
    return ts + (F.unix_seconds(there) - epoch_seconds(ts)).cast("interval second")


def slot_end(ts: Column, seconds: int) -> Column:
    """End of the half-open slot ``(end - seconds, end]`` that holds ``ts``."""
    just_before = epoch_seconds(ts - F.expr("INTERVAL '0.000001' SECOND"))
    return from_epoch_seconds((F.floor(just_before / seconds) + 1) * seconds)


def day_number(year: Column, month: Column, day: Column) -> Column:
    """Sortable integer day (20171105), so that a range of days is one comparison."""
    return year * 10000 + month * 100 + day


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))
