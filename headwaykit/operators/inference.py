"""Arrival and departure intervals of trip-stops from the order of status observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import seconds_between
from headwaykit.operators.dedup import only_value
from headwaykit.operators.matching import GRAIN, observed

INCOMING, STOPPED, IN_TRANSIT = 0, 1, 2


def infer_stops(matches: DataFrame, events: DataFrame | None = None, affected: DataFrame | None = None) -> DataFrame:
    """One row per (feed, date, trip, sequence, stop) with arrival and departure bounds.

    Sequence comes from the match, stop from the event. affected (feed_checksum, service_date, trip_id)
    limits the work to those trips, which are recomputed whole. Rows are placed by trip once: the window
    over neighbours and the aggregate per stop both use that placement.
    """
    picked = matches
    if affected is not None:
        picked = picked.join(affected.select("feed_checksum", "service_date", "trip_id").distinct(), ["feed_checksum", "service_date", "trip_id"], "left_semi")
    seen = observed(picked, events).select(
        "event_key", "feed_checksum", "service_date", "trip_id", "stop_sequence", "scheduled_local_time", "vehicle_id", "route_id", "direction_id", "stop_id",
        F.col("current_status").alias("status"), F.col("vehicle_timestamp").alias("ts"),
    )
    trip = ["feed_checksum", "service_date", "trip_id"]
    rows = seen.where("ts is not null and stop_id is not null and stop_sequence is not null").repartition(*trip)
    line = Window.partitionBy(*trip, "vehicle_id").orderBy("ts", "event_key")
    here = F.struct("ts", "status", "stop_sequence", "stop_id")
    near = rows.withColumns({"p": F.lag(here).over(line), "n": F.lead(here).over(line)})
    moving = lambda side: F.col(f"{side}.status").isin(INCOMING, IN_TRANSIT)
    same_stop = (F.col("p.stop_sequence") == F.col("stop_sequence")) & (F.col("p.stop_id") == F.col("stop_id"))
    stopped = F.col("status") == STOPPED
    transition, earlier = moving("p") & same_stop, F.col("p.stop_sequence") < F.col("stop_sequence")
    near = near.withColumns({
        "lower": F.when(transition | earlier, F.col("p.ts")),
        "method": F.when(transition, "SAME_STOP_TRANSITION").when(earlier, "PREVIOUS_STOP").otherwise("UNBOUNDED"),
        "upper": F.when(moving("n") & (F.col("n.stop_sequence") >= F.col("stop_sequence")), F.col("n.ts")),
        "period": stopped & ~F.coalesce((F.col("p.status") == STOPPED) & same_stop, F.lit(False)),
    })
    at = F.when(stopped, F.struct("ts", "event_key"))
    grouped = near.groupBy(*GRAIN).agg(
        F.max("route_id").alias("route_id"), F.max("direction_id").alias("direction_id"),
        only_value(F.col("vehicle_id")).alias("vehicle_id"), F.count_distinct("vehicle_id").alias("vehicle_count"),
        F.min("scheduled_local_time").alias("scheduled_local_time"),
        F.count("*").alias("total_observation_count"), F.count_if(stopped).alias("stopped_observation_count"), F.count_if("period").alias("stopped_period_count"),
        F.min_by(F.struct("ts", "lower", "method"), at).alias("first"), F.max_by(F.struct("ts", "upper"), at).alias("last"),
    )
    bounds = grouped.withColumns({
        "arrival_lower_bound": F.col("first.lower"), "arrival_upper_bound": F.col("first.ts"), "arrival_estimate": F.col("first.ts"),
        "arrival_bound_method": F.coalesce("first.method", F.lit("NO_STOP_OBSERVATION")),
        "departure_lower_bound": F.col("last.ts"), "departure_upper_bound": F.col("last.upper"), "departure_estimate": F.col("last.upper"),
    }).drop("first", "last")
    return bounds.withColumns({
        "arrival_uncertainty_seconds": seconds_between(F.col("arrival_upper_bound"), F.col("arrival_lower_bound")),
        "departure_uncertainty_seconds": seconds_between(F.col("departure_upper_bound"), F.col("departure_lower_bound")),
        "inference_quality": F.when(F.col("vehicle_count") > 1, "MULTIPLE_VEHICLES").when(F.col("stopped_observation_count") == 0, "NO_STOP_OBSERVATION")
        .when(F.col("stopped_period_count") > 1, "MULTIPLE_STOP_PERIODS")
        .when(F.col("arrival_lower_bound").isNotNull() & F.col("departure_upper_bound").isNotNull(), "COMPLETE").otherwise("PARTIAL"),
    })
