"""Deviations from the schedule, realtime and historical, and what follows from them per stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import LOCAL_ZONE, fractional_seconds, is_weekend, iso_day, local_hour, localise, seconds_between, service_wall
from headwaykit.operators.matching import GRAIN, observed


def stop_performance(stop_events: DataFrame, stop_instances: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Adds the scheduled instants and six deviations (estimate, lower, upper of arrival and departure); null where a side is."""
    scheduled = stop_instances.select(
        *GRAIN, localise(F.col("scheduled_arrival_local"), zone).alias("scheduled_arrival"), localise(F.col("scheduled_departure_local"), zone).alias("scheduled_departure")
    )
    joined = stop_events.join(scheduled, GRAIN, "left")
    arrival = F.coalesce("scheduled_arrival", localise(F.col("scheduled_local_time"), zone))
    joined = joined.withColumn("scheduled_arrival", arrival)
    add = {}
    for what in ("arrival", "departure"):
        for part, column in (("", "estimate"), ("_lower", "lower_bound"), ("_upper", "upper_bound")):
            add[f"{what}_deviation{part}_seconds"] = seconds_between(F.col(f"{what}_{column}"), F.col(f"scheduled_{what}"))
    return joined.withColumns(add)


def match_quality(matches: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Per stop the median and largest distance of its matches."""
    return observed(matches, events).groupBy(*GRAIN).agg(
        F.percentile("difference_seconds", 0.5).alias("schedule_match_median_difference_seconds"),
        F.max("difference_seconds").alias("schedule_match_max_difference_seconds"),
    )


def stop_features(performance: DataFrame, matches: DataFrame, events: DataFrame | None = None, zone: str = LOCAL_ZONE, max_uncertainty_s: int = 60, max_median_s: int = 3600) -> DataFrame:
    anomaly = F.coalesce(F.col("schedule_match_median_difference_seconds") > max_median_s, F.lit(False))
    joined = performance.join(match_quality(matches, events), GRAIN, "left").withColumn("schedule_match_anomaly", anomaly)
    eligible = (
        F.col("arrival_deviation_seconds").isNotNull() & (F.col("arrival_uncertainty_seconds") <= max_uncertainty_s)
        & F.col("inference_quality").isin("COMPLETE", "PARTIAL") & ~F.col("schedule_match_anomaly")
    )
    return joined.withColumns({
        "service_hour": local_hour(F.col("scheduled_arrival"), zone), "day_of_week": iso_day(F.col("service_date")),
        "is_weekend": is_weekend(F.col("service_date")), "scoring_eligible": F.coalesce(eligible, F.lit(False)),
    })


def historical_events(history: DataFrame) -> DataFrame:
    """Departure from a stop is the move towards the next one of the trip."""
    line = Window.partitionBy("service_date", "trip_id").orderBy("stop_sequence", "stop_id")
    return history.withColumns({"next_stop_id": F.lead("stop_id").over(line), "departure_timestamp": F.lead("move_timestamp").over(line)})


def historical_performance(events: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    at = lambda c: localise(service_wall(F.col("service_date"), F.col(c)), zone)
    timed = events.withColumns({"scheduled_arrival": at("scheduled_arrival_seconds"), "scheduled_departure": at("scheduled_departure_seconds")})
    return timed.withColumns({
        "arrival_delay_seconds": seconds_between(F.col("stop_timestamp"), F.col("scheduled_arrival")),
        "departure_delay_seconds": seconds_between(F.col("departure_timestamp"), F.col("scheduled_departure")),
        "dwell_estimate_seconds": seconds_between(F.col("departure_timestamp"), F.col("stop_timestamp")),
    })


def historical_features(performance: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    sensible = F.coalesce(F.col("departure_timestamp") >= F.col("stop_timestamp"), F.lit(False))
    return performance.withColumns({
        "service_hour": local_hour(F.col("scheduled_arrival"), zone), "is_weekend": is_weekend(F.col("service_date")),
        "has_schedule": F.col("scheduled_arrival").isNotNull(), "has_sensible_stop_timing": sensible,
        "baseline_eligible": F.col("arrival_delay_seconds").isNotNull() & sensible,
    })


def clock_features(history: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The other history rule: fractional deviations, hour of the schedule's clock, trips typed by the form of their id."""
    events = historical_events(history)
    at = lambda c: localise(service_wall(F.col("service_date"), F.col(c)), zone)
    return events.select(
        "service_date", "trip_id", "stop_sequence", "stop_id", "route_id", "direction_id", "vehicle_id",
        F.when(F.col("trip_id").startswith("ADDED-"), "ADDED").when(F.col("trip_id").startswith("NONREV"), "NONREV").otherwise("PLANNED").alias("trip_type"),
        fractional_seconds(F.col("stop_timestamp"), at("scheduled_arrival_seconds")).alias("arrival_deviation_seconds"),
        fractional_seconds(F.col("departure_timestamp"), at("scheduled_departure_seconds")).alias("departure_deviation_seconds"),
        F.floor(F.pmod("scheduled_arrival_seconds", F.lit(86_400)) / 3600).cast("int").alias("service_hour"),
        iso_day(F.col("service_date")).alias("day_of_week"), is_weekend(F.col("service_date")).alias("is_weekend"),
    )
