"""Service calendars to active services, trip and stop instances, schedule summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import iso_day, service_wall

DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SERVICE = ["feed_checksum", "service_date", "service_id"]


def active_services(feeds: DataFrame, calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """(feed, date, service) for each date of each feed's validity: weekday flag within range, plus added (1), minus removed (2)."""
    dates = feeds.where("feed_start_date <= feed_end_date").select("feed_checksum", F.explode(F.sequence("feed_start_date", "feed_end_date")).alias("service_date"))
    flag = F.element_at(F.array(*DAYS), iso_day(F.col("service_date")))
    regular = dates.join(calendar, "feed_checksum").where((F.col("service_date").between(F.col("start_date"), F.col("end_date"))) & (flag == 1)).select(*SERVICE)
    changes = calendar_dates.join(dates, ["feed_checksum", "service_date"], "left_semi")
    added = changes.where("exception_type = 1").select(*SERVICE)
    removed = changes.where("exception_type = 2").select(*SERVICE)
    return regular.unionByName(added).distinct().join(removed, SERVICE, "left_anti")


def trip_instances(active: DataFrame, trips: DataFrame) -> DataFrame:
    return active.join(trips, ["feed_checksum", "service_id"]).select("feed_checksum", "service_date", "trip_id", "route_id", "service_id", "direction_id")


def stop_instances(instances: DataFrame, stop_times: DataFrame) -> DataFrame:
    at = lambda c: service_wall(F.col("service_date"), F.col(c)).cast("timestamp_ntz")
    return instances.join(stop_times, ["feed_checksum", "trip_id"]).select(
        "feed_checksum", "service_date", "trip_id", "stop_sequence", "stop_id", "route_id", "direction_id",
        at("arrival_seconds").alias("scheduled_arrival_local"), at("departure_seconds").alias("scheduled_departure_local"), "arrival_seconds", "departure_seconds",
    )


def trip_schedule_summary(stops: DataFrame) -> DataFrame:
    return stops.groupBy("feed_checksum", "service_date", "trip_id").agg(
        F.min(F.coalesce("scheduled_departure_local", "scheduled_arrival_local")).alias("scheduled_start_local"),
        F.max(F.coalesce("scheduled_arrival_local", "scheduled_departure_local")).alias("scheduled_end_local"), F.count("*").alias("scheduled_stop_count"),
    )
