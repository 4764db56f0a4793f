"""Instants, wall clocks and service days. All functions assume the session clock UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"


def localise(wall: Column, zone: str = LOCAL_ZONE) -> Column:
    """The instant of a wall clock (earlier offset in an overlap, the offset before it in a gap)."""
    return F.to_utc_timestamp(wall.cast("timestamp"), zone)


def wall_clock(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(wall_clock(instant, zone))


def local_hour(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.hour(wall_clock(instant, zone))


def service_wall(day: Column, seconds: Column) -> Column:
    """Wall clock of a service day's midnight plus seconds, which may pass 86,400."""
    return F.timestamp_add("SECOND", seconds, day.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, cut off towards zero."""
    return F.timestamp_diff("SECOND", earlier, later)


def fractional_seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def iso_day(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def clock_seconds(text: Column) -> Column:
    """H:MM:SS, hours may pass 24, to seconds; null for a blank or malformed text."""
    parts = F.split(F.trim(text), ":")
    good = F.trim(text).rlike(r"\A\d{1,3}:\d{2}:\d{2}\z")
    part = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    return F.when(good, part(1) * 3600 + part(2) * 60 + part(3))


def epoch_or_null(seconds: Column) -> Column:
    """Epoch seconds to an instant; 0 means absent."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def stamped(rows: DataFrame, as_of: datetime, known: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """Adds created_at and updated_at: as_of, but created_at as `known` (by keys) has it for rows that were there before."""
    now = F.lit(as_of).cast("timestamp")
    if known is None:
        return rows.withColumns({"created_at": now, "updated_at": now})
    before = known.select(*keys, F.col("created_at").alias("_created"))
    return rows.join(before, keys, "left").withColumns({"created_at": F.coalesce("_created", now), "updated_at": now}).drop("_created")
