"""Stop results summed up by trip, route hour and route day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwaykit.operators.matching import observed

TRIP = ["feed_checksum", "service_date", "trip_id"]


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * F.try_divide(part, whole)


def rounded_percent(part: Column, whole: Column) -> Column:
    """Rounded half up in decimals to two places."""
    return F.round(percent(part, whole).cast("decimal(38,10)"), 2).cast("double")


def _share_counts() -> dict[str, Column]:
    label = F.col("stop_classification")
    return {
        "inferred_stop_count": F.count("*"), "observed_stop_count": F.count_if(label != "NOT_EVALUABLE"), "anomalous_stop_count": F.count_if("is_anomalous"),
        "certain_late_stop_count": F.count_if(label == "CERTAIN_LATE"), "possible_late_stop_count": F.count_if(label == "POSSIBLE_LATE"),
        "avg_arrival_deviation_seconds": F.avg(F.when(label != "NOT_EVALUABLE", F.col("arrival_deviation_seconds"))),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def trip_anomalies(scores: DataFrame, min_observed: int = 5, min_anomalous: int = 3, min_percent: float = 50) -> DataFrame:
    normal = F.count_if(F.col("stop_classification") == "NORMAL").alias("normal_stop_count")
    rows = scores.groupBy(*TRIP).agg(F.max("route_id").alias("route_id"), F.max("direction_id").alias("direction_id"), *_named(_share_counts()), normal)
    rows = rows.withColumn("anomaly_percent", percent(F.col("anomalous_stop_count"), F.col("observed_stop_count")))
    sustained = (F.col("anomalous_stop_count") >= min_anomalous) & (F.col("anomaly_percent") >= min_percent)
    return rows.withColumn("trip_classification", F.when(F.col("observed_stop_count") < min_observed, "INSUFFICIENT_COVERAGE").when(sustained, "SUSTAINED_LATE").otherwise("NORMAL"))


def route_hourly(scores: DataFrame, min_stops: int = 10, min_trips: int = 3, min_percent: float = 50) -> DataFrame:
    """Rows with a null route or direction are no route's."""
    known = scores.where("route_id is not null and direction_id is not null")
    trips = F.count_distinct(F.when(F.col("stop_classification") != "NOT_EVALUABLE", F.col("trip_id"))).alias("distinct_trip_count")
    rows = known.groupBy("service_date", "route_id", "direction_id", "service_hour").agg(*_named(_share_counts()), trips)
    rows = rows.withColumn("anomaly_rate_percent", percent(F.col("anomalous_stop_count"), F.col("observed_stop_count")))
    thin = (F.col("observed_stop_count") < min_stops) | (F.col("distinct_trip_count") < min_trips)
    return rows.withColumn("route_hour_classification", F.when(thin, "INSUFFICIENT_COVERAGE").when(F.col("anomaly_rate_percent") >= min_percent, "SUSTAINED_LATE").otherwise("NORMAL"))


def route_daily(trips: DataFrame) -> DataFrame:
    label = F.col("trip_classification")
    rows = trips.where("route_id is not null and direction_id is not null").groupBy("service_date", "route_id", "direction_id").agg(
        F.count("*").alias("observed_trip_count"), F.count_if(label != "INSUFFICIENT_COVERAGE").alias("evaluable_trip_count"),
        F.count_if(label == "SUSTAINED_LATE").alias("sustained_late_trip_count"), F.count_if(label == "NORMAL").alias("normal_trip_count"),
        F.count_if(label == "INSUFFICIENT_COVERAGE").alias("insufficient_coverage_trip_count"),
    )
    return rows.withColumns({
        "sustained_anomaly_rate_percent": percent(F.col("sustained_late_trip_count"), F.col("evaluable_trip_count")),
        "insufficient_coverage_rate_percent": percent(F.col("insufficient_coverage_trip_count"), F.col("observed_trip_count")),
    })


STATUSES = ["CERTAIN_LATE", "CERTAIN_EARLY", "POSSIBLE_LATE", "POSSIBLE_EARLY"]


def _status_counts() -> list[Column]:
    status = F.col("anomaly_status")
    return [F.count_if(status == s).alias(f"{s.lower()}_stop_count") for s in ("NORMAL", *STATUSES)]


def signed_trip_summary(scores: DataFrame) -> DataFrame:
    """Per trip; a stop that cannot be scored counts as anomalous here, as in the rule this states."""
    odd, score = F.col("anomaly_status") != "NORMAL", F.col("anomaly_score")
    return scores.groupBy(*TRIP).agg(
        F.max("route_id").alias("route_id"), F.max("direction_id").alias("direction_id"), F.count("*").alias("observed_stop_count"), *_status_counts(),
        F.count_if(odd).alias("anomalous_stop_count"), (F.lit(100.0) * F.count_if(odd) / F.count("*")).alias("anomaly_stop_pct"),
        F.max(F.when(score > 0, score)).alias("max_late_anomaly_score"), F.min(F.when(score < 0, score)).alias("max_early_anomaly_score"),
        F.min(F.when(odd, F.col("stop_sequence"))).alias("first_anomalous_stop_sequence"), F.max(F.when(odd, F.col("stop_sequence"))).alias("last_anomalous_stop_sequence"),
    )


def signed_trip_class(summary: DataFrame) -> DataFrame:
    late = F.col("certain_late_stop_count") + F.col("possible_late_stop_count")
    early = F.col("certain_early_stop_count") + F.col("possible_early_stop_count")
    sustained = (F.col("anomalous_stop_count") >= 3) & (F.col("anomaly_stop_pct") >= 50)
    label = (
        F.when(F.col("observed_stop_count") < 5, "INSUFFICIENT_COVERAGE").when(sustained & (late > early), "SUSTAINED_LATE").when(sustained & (early > late), "SUSTAINED_EARLY")
        .when(sustained, "SUSTAINED_MIXED").when(F.col("anomalous_stop_count") > 0, "ISOLATED_OR_WEAK").otherwise("NORMAL")
    )
    return summary.withColumn("trip_anomaly_status", label)


def signed_route_hour(scores: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Per route, direction and hour; stops that cannot be scored are neither normal nor anomalous.

    Percentiles are exact unless an accuracy is given; then sketches give them within 1/accuracy of rank.
    """
    status = F.col("anomaly_status")
    scored, odd = F.count_if(status != "UNSCORABLE"), F.count_if(status.isin(STATUSES))
    at = (lambda c, p: F.percentile_approx(c, p, accuracy)) if accuracy else F.percentile
    mid = lambda c, p=0.5, n=1: F.round(at(c, p).cast("decimal(38,10)"), n).cast("double")
    return scores.groupBy("service_date", "route_id", "direction_id", "service_hour").agg(
        F.count("*").alias("observed_stop_events"), F.count_distinct("trip_id").alias("observed_trips"), *_status_counts(),
        F.count_if(status == "UNSCORABLE").alias("unscorable_stop_count"), odd.alias("anomalous_stop_count"),
        rounded_percent(F.count_if(status == "CERTAIN_LATE"), scored).alias("certain_late_pct"),
        rounded_percent(F.count_if(status == "CERTAIN_EARLY"), scored).alias("certain_early_pct"), rounded_percent(odd, scored).alias("anomaly_stop_pct"),
        mid("arrival_deviation_seconds").alias("median_arrival_deviation_seconds"), mid("arrival_deviation_seconds", 0.9).alias("p90_arrival_deviation_seconds"),
        mid("baseline_median").alias("historical_median_seconds"), mid(F.abs("anomaly_score"), 0.5, 2).alias("median_abs_anomaly_score"),
        F.round(F.max(F.abs("anomaly_score")).cast("decimal(38,10)"), 2).cast("double").alias("max_abs_anomaly_score"),
        mid("arrival_uncertainty_seconds").alias("median_arrival_uncertainty_seconds"),
        F.count_if(F.col("baseline_type") == "PRIMARY").alias("primary_baseline_count"), F.count_if(F.col("baseline_type") == "FALLBACK").alias("fallback_baseline_count"),
        rounded_percent(F.count_if(F.col("baseline_type") == "FALLBACK"), F.count("*")).alias("fallback_baseline_pct"),
    )


def signed_route_hour_class(rows: DataFrame) -> DataFrame:
    late, early, share = F.col("certain_late_pct"), F.col("certain_early_pct"), F.col("anomaly_stop_pct")
    label = (
        F.when((F.col("observed_stop_events") < 10) | (F.col("observed_trips") < 3), "INSUFFICIENT_COVERAGE").when((share >= 50) & (late > early), "ANOMALOUS_LATE")
        .when((share >= 50) & (early > late), "ANOMALOUS_EARLY").when(share >= 50, "ANOMALOUS_MIXED").when(share > 0, "ELEVATED").otherwise("NORMAL")
    )
    return rows.withColumn("route_hour_status", label)


def signed_route_daily(trips: DataFrame) -> DataFrame:
    label = F.col("trip_anomaly_status")
    evaluable, thin = F.count_if(label != "INSUFFICIENT_COVERAGE"), F.count_if(label == "INSUFFICIENT_COVERAGE")
    return trips.groupBy("service_date", "route_id").agg(
        F.count("*").alias("observed_trips"), evaluable.alias("evaluable_trips"),
        *[F.count_if(label == s).alias(f"{s.lower()}_trips") for s in ("NORMAL", "ISOLATED_OR_WEAK", "SUSTAINED_LATE", "SUSTAINED_EARLY", "INSUFFICIENT_COVERAGE")],
        rounded_percent(F.count_if(label.isin("SUSTAINED_LATE", "SUSTAINED_EARLY")), evaluable).alias("sustained_anomaly_pct"),
        rounded_percent(thin, F.count("*")).alias("insufficient_coverage_pct"),
        F.round(F.percentile("observed_stop_count", 0.5).cast("decimal(38,10)"), 1).cast("double").alias("median_observed_stops"),
    )


def trip_realtime_summary(matches: DataFrame, events: DataFrame | None, trip_instances: DataFrame) -> DataFrame:
    summary = observed(matches, events).groupBy(*TRIP).agg(
        F.min("vehicle_timestamp").alias("first_observation"), F.max("vehicle_timestamp").alias("last_observation"), F.count("*").alias("observation_count"),
        F.count_distinct("vehicle_id").alias("distinct_vehicle_count"), F.min("current_stop_sequence").alias("first_stop_sequence"), F.max("current_stop_sequence").alias("last_stop_sequence"),
    )
    return trip_instances.select(*TRIP, "route_id", "direction_id").join(summary, TRIP)


def trip_operations(trip_instances: DataFrame, schedule: DataFrame, realtime: DataFrame) -> DataFrame:
    """Every scheduled trip with what was seen of it, observed or not."""
    base = trip_instances.select(*TRIP, "route_id", "direction_id").join(schedule, TRIP)
    seen = realtime.drop("route_id", "direction_id").withColumn("_seen", F.lit(True))
    return base.join(seen, TRIP, "left").withColumns({
        "realtime_observed": F.coalesce("_seen", F.lit(False)),
        "observation_count": F.coalesce("observation_count", F.lit(0)), "distinct_vehicle_count": F.coalesce("distinct_vehicle_count", F.lit(0)),
    }).drop("_seen")
