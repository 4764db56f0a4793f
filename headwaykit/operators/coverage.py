"""When the collector was running, and how much of each trip it covered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import LOCAL_ZONE, localise


def coverage_windows(snapshots: DataFrame, ts: str, gap_s: int = 90, slot_s: int = 3600) -> DataFrame:
    """Sessions of snapshots: a step of more than gap_s starts a new window. A step of exactly gap_s stays inside.

    Snapshots are sessionised slot by slot; what is ordered as a whole afterwards are sessions, of which a slot has
    slot_s / gap_s at most, not snapshots.
    """
    slot = F.floor(F.unix_micros(ts) / F.lit(slot_s * 1_000_000)).cast("long").alias("_slot")
    parts = snapshots.where(F.col(ts).isNotNull()).groupBy(slot, F.session_window(F.col(ts), f"{gap_s} seconds")).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"), F.count("*").alias("_n"))
    line = Window.partitionBy(F.lit(0)).orderBy("_a")
    apart = F.unix_micros("_a") - F.unix_micros(F.lag("_b").over(line)) > gap_s * 1_000_000
    numbered = parts.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_no", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("_no").agg(F.min("_a").alias("window_start"), F.max("_b").alias("window_end"), F.sum("_n").alias("snapshot_count")).drop("_no")


def affected_trips(trips: DataFrame, days: DataFrame, columns: list[str]) -> DataFrame:
    """Trips whose coverage is to be computed again: of one of the days (a table with service_date), or with a null in one of the columns."""
    named = days.select("service_date").distinct().withColumn("_hit", F.lit(True))
    unknown = reduce(Column.__or__, [F.col(c).isNull() for c in columns], F.lit(False))
    return trips.join(named, "service_date", "left").where(F.coalesce("_hit", F.lit(False)) | unknown).drop("_hit")


def overlap_seconds(intervals: DataFrame, keys: list[str], start: str, end: str, windows: DataFrame, slot_s: int = 3600) -> DataFrame:
    """Per interval the seconds that the (disjoint) windows cover, 0 if none. start and end are instants.

    Both sides are entered in hourly slots, so the theta join is an equality on the slot; an overlap that
    spans several slots is counted in the slot where it begins only.
    """
    us = lambda c: F.unix_micros(c)
    slots = lambda a, b: F.sequence(F.floor(a / F.lit(slot_s * 1_000_000)).cast("long"), F.floor(b / F.lit(slot_s * 1_000_000)).cast("long"))
    left = intervals.select(*keys, us(start).alias("_a"), us(end).alias("_b")).where("_a < _b").withColumn("_slot", F.explode(slots(F.col("_a"), F.col("_b"))))
    right = windows.select(us("window_start").alias("_c"), us("window_end").alias("_d")).where("_c < _d").withColumn("_slot", F.explode(slots(F.col("_c"), F.col("_d"))))
    begin, stop = F.greatest("_a", "_c"), F.least("_b", "_d")
    met = left.join(right, "_slot").where((begin < stop) & (F.floor(begin / F.lit(slot_s * 1_000_000)) == F.col("_slot")))
    sums = met.groupBy(*keys).agg((F.sum(stop - begin) / F.lit(1e6)).alias("covered_seconds"))
    return intervals.join(sums, keys, "left").withColumn("covered_seconds", F.coalesce("covered_seconds", F.lit(0.0)))


def trip_coverage(trips: DataFrame, windows: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Adds collector_coverage_seconds and percent (two places, 0 for a trip without length) to trips with local start and end."""
    timed = trips.withColumns({"_start": localise(F.col("scheduled_start_local"), zone), "_end": localise(F.col("scheduled_end_local"), zone)})
    rows = overlap_seconds(timed, ["feed_checksum", "service_date", "trip_id"], "_start", "_end", windows).withColumnRenamed("covered_seconds", "collector_coverage_seconds")
    length = (F.unix_micros("_end") - F.unix_micros("_start")) / F.lit(1e6)
    percent = F.round((100.0 * F.col("collector_coverage_seconds") / length).cast("decimal(38,10)"), 2).cast("double")
    return rows.withColumns({"scheduled_duration_seconds": length, "collector_coverage_percent": F.when(length > 0, percent).otherwise(0.0)}).drop("_start", "_end")
