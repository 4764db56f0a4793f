"""Observations matched to the nearest scheduled stop of their trip and sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import LOCAL_ZONE, local_date, localise, seconds_between, service_wall, wall_clock
from headwaykit.operators.dedup import keep_by_priority

#: What a match carries of its event, so that nothing later needs to join the events again.
CARRIED = ["vehicle_id", "route_id", "direction_id", "stop_id", "current_status", "current_stop_sequence", "vehicle_timestamp"]

GRAIN = ["feed_checksum", "service_date", "trip_id", "stop_sequence", "stop_id"]


def match_schedule(events: DataFrame, stop_instances: DataFrame, zone: str = LOCAL_ZONE, max_days: int = 1) -> DataFrame:
    """One match per event: nearest in time, then the later service date, then the smaller checksum.

    Candidates are instances of the event's trip and sequence at most max_days from its local date. Each
    event is entered for the 2 * max_days + 1 dates it can belong to, so the join is an equality on trip,
    sequence and date and does not grow with the length of the schedule. What of CARRIED the events have goes
    along in `seen`.
    """
    eligible = events.where("schedule_relationship = 'SCHEDULED' and trip_id is not null and vehicle_timestamp is not null and current_stop_sequence > 0")
    day = local_date(F.col("vehicle_timestamp"), zone)
    near_days = F.explode(F.transform(F.array(*[F.lit(d) for d in range(-max_days, max_days + 1)]), lambda d: F.date_add(day, d)))
    seen = F.struct(*[F.col(c) for c in CARRIED if c in events.columns]).alias("seen")
    dated = eligible.select("event_key", F.col("ingestion_timestamp").alias("event_ingestion_timestamp"), "vehicle_timestamp", "trip_id", F.col("current_stop_sequence").alias("stop_sequence"), seen, near_days.alias("service_date"))
    scheduled = stop_instances.where("trip_id is not null and stop_sequence is not null").select(
        "trip_id", "stop_sequence", "service_date", "feed_checksum", F.coalesce("scheduled_arrival_local", "scheduled_departure_local").alias("scheduled_local_time")
    ).where("scheduled_local_time is not null")
    seconds = F.abs(seconds_between(F.col("vehicle_timestamp"), localise(F.col("scheduled_local_time"), zone)))
    candidates = dated.join(scheduled, ["trip_id", "stop_sequence", "service_date"]).withColumn("difference_seconds", seconds.cast("double"))
    payload = F.struct("event_ingestion_timestamp", "feed_checksum", "service_date", "trip_id", "stop_sequence", "scheduled_local_time", "difference_seconds", "seen")
    order = F.struct("difference_seconds", -F.unix_date("service_date"), "feed_checksum")
    return candidates.groupBy("event_key").agg(F.min_by(payload, order).alias("m")).select("event_key", "m.*")


def union_matches(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Matches of two sources, one per event: the primary's, the newest within a source."""
    both = primary.withColumn("match_source", F.lit("primary")).unionByName(secondary.withColumn("match_source", F.lit("secondary")))
    return keep_by_priority(both, ["event_key"], "match_source", ["primary", "secondary"], "created_at", ["feed_checksum", "service_date"])


def observed(matches: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Matches with CARRIED of their events: as they carry it themselves or, from `events`, by a join."""
    if "seen" in matches.columns and set(CARRIED) <= set(matches.schema["seen"].dataType.names):
        return matches.select(*[c for c in matches.columns if c != "seen"], *[F.col(f"seen.{c}").alias(c) for c in CARRIED])
    if events is None:
        raise ValueError("the matches do not carry their events")
    seen = events.select("event_key", F.col("ingestion_timestamp").alias("event_ingestion_timestamp"), *[c for c in CARRIED if c in events.columns])
    return matches.drop("seen").join(seen, ["event_key", "event_ingestion_timestamp"])


def match_wall_clocks(events: DataFrame, trip_instances: DataFrame, stop_times: DataFrame, zone: str = LOCAL_ZONE, max_days: int = 1) -> DataFrame:
    """The other matching rule: trips' instances and their stop times apart, differences between wall clocks.

    A clock change between two wall clocks is not seen, so the difference can be off by it. Ties go to the later
    service date, then the smaller checksum.
    """
    eligible = events.where("trip_id is not null and vehicle_timestamp is not null and current_stop_sequence is not null")
    local = wall_clock(F.col("vehicle_timestamp"), zone)
    near_days = F.explode(F.transform(F.array(*[F.lit(d) for d in range(-max_days, max_days + 1)]), lambda d: F.date_add(F.to_date(local), d)))
    dated = eligible.select("event_key", "event_ingestion_timestamp", "trip_id", F.col("current_stop_sequence").alias("stop_sequence"), F.unix_micros(local).alias("_at"), near_days.alias("service_date"))
    seconds = F.coalesce("arrival_seconds", "departure_seconds")
    timed = stop_times.where(seconds.isNotNull()).select("feed_checksum", "trip_id", "stop_sequence", seconds.alias("_seconds"))
    running = dated.join(trip_instances.select("feed_checksum", "service_date", "trip_id"), ["trip_id", "service_date"])
    met = running.join(timed, ["feed_checksum", "trip_id", "stop_sequence"])
    scheduled = service_wall(F.col("service_date"), F.col("_seconds"))
    met = met.withColumn("difference_seconds", F.abs(F.col("_at") - F.unix_micros(scheduled)) / F.lit(1e6)).withColumn("scheduled_local_time", scheduled.cast("timestamp_ntz"))
    payload = F.struct("event_ingestion_timestamp", "feed_checksum", "service_date", "trip_id", "stop_sequence", "scheduled_local_time", "difference_seconds")
    order = F.struct("difference_seconds", -F.unix_date("service_date"), "feed_checksum")
    return met.groupBy("event_key").agg(F.min_by(payload, order).alias("m")).select("event_key", "m.*")
