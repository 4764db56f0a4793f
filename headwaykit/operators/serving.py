"""What a dashboard asks of the summaries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.operators.dedup import keep_first
from headwaykit.operators.rollups import percent

CLASS_ORDER = ["SUSTAINED_LATE", "NORMAL", "INSUFFICIENT_COVERAGE"]


def service_dates(daily: DataFrame, routes: list[str] | None = None) -> DataFrame:
    rows = daily.where(F.col("route_id").isin(routes)) if routes else daily
    return rows.select("service_date").distinct().orderBy(F.desc("service_date"))


def latest_date(daily: DataFrame, before: date | None = None) -> date | None:
    """Newest service date, strictly before a day if one is given."""
    rows = daily.where(F.col("service_date") < F.lit(before)) if before else daily
    return rows.agg(F.max("service_date")).first()[0]


def route_totals(daily: DataFrame, day: date) -> DataFrame:
    """Directions summed, rates as ratios of sums, worst first."""
    sums = daily.where(F.col("service_date") == F.lit(day)).groupBy("route_id").agg(
        F.sum("observed_trip_count").alias("observed_trips"), F.sum("evaluable_trip_count").alias("evaluable_trips"), F.sum("sustained_late_trip_count").alias("sustained_late_trips")
    )
    rate = percent(F.col("sustained_late_trips"), F.col("evaluable_trips"))
    return sums.withColumn("sustained_rate_percent", rate).orderBy(F.desc_nulls_last("sustained_rate_percent"), "route_id")


def route_hours(hourly: DataFrame, route: str, day: date | None = None) -> DataFrame:
    rows = hourly.where(F.col("route_id") == route)
    rows = rows.where(F.col("service_date") == F.lit(day)) if day else rows
    return rows.orderBy("service_date", "direction_id", "service_hour")


def route_trips(trips: DataFrame, route: str, day: date | None = None, label: str | None = None) -> DataFrame:
    """By class, then share of anomalous stops, then id."""
    rows = trips.where(F.col("route_id") == route)
    rows = rows.where(F.col("service_date") == F.lit(day)) if day else rows
    rows = rows.where(F.col("trip_classification") == label) if label else rows
    return rows.orderBy(*trip_order())


def trip_order() -> list[Column]:
    place = F.coalesce(*[F.when(F.col("trip_classification") == c, F.lit(i)) for i, c in enumerate(CLASS_ORDER)], F.lit(len(CLASS_ORDER)))
    return [place, F.desc_nulls_last("anomaly_percent"), F.col("trip_id").asc()]


def named(rows: DataFrame, names: DataFrame, key: str, name: str, fallback: str) -> DataFrame:
    """Rows with a name from a dimension, the fallback column where it has none."""
    return rows.join(names, key, "left").withColumn(name, F.coalesce(name, fallback))


def parent_named(stops: DataFrame) -> DataFrame:
    """Stop names with the parent station's where a stop has none of its own."""
    parents = stops.select(F.col("stop_id").alias("parent_station"), F.col("stop_name").alias("_parent"))
    return stops.join(parents, "parent_station", "left").withColumn("stop_name", F.coalesce("stop_name", "_parent", "stop_id")).drop("_parent")


def kpis(daily: DataFrame) -> DataFrame:
    sums = daily.agg(F.sum("observed_trip_count").alias("observed_trips"), F.sum("sustained_late_trip_count").alias("sustained_late_trips"), F.sum("evaluable_trip_count").alias("_e"))
    return sums.withColumn("sustained_rate_percent", F.coalesce(percent(F.col("sustained_late_trips"), F.col("_e")), F.lit(0.0))).drop("_e")


def dominant(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The most frequent label per key, the first by name on a tie."""
    counts = rows.groupBy(*keys, label).agg(F.count("*").alias("n"))
    return keep_first(counts, keys, [F.desc("n"), F.col(label).asc()])


def heatmap(hourly: DataFrame) -> DataFrame:
    known = F.when(F.col("route_hour_classification") != "INSUFFICIENT_COVERAGE", F.col("anomaly_rate_percent"))
    return hourly.select("service_date", "route_id", "direction_id", "service_hour", known.alias("anomaly_rate_percent")).where("anomaly_rate_percent is not null")


def readable_label(value: Column) -> Column:
    """An enumeration's name as words, each with a capital."""
    return F.initcap(F.lower(F.replace(value, F.lit("_"), F.lit(" "))))


def hour_label(hour: Column) -> Column:
    """0 to 23 on a clock of twelve hours; an empty text for null."""
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.when(hour.isNull(), "").otherwise(F.concat_ws(" ", twelve.cast("int").cast("string"), F.when(hour < 12, "AM").otherwise("PM")))


def date_totals(daily: DataFrame) -> DataFrame:
    """Observed and evaluable trips per date, and whether it is the one a dashboard opens with: the newest that has evaluable trips."""
    sums = daily.groupBy("service_date").agg(F.sum("observed_trips").alias("observed_trips"), F.sum("evaluable_trips").alias("evaluable_trips"))
    best = Window.partitionBy(F.lit(0)).orderBy((F.col("evaluable_trips") > 0).desc(), F.desc("service_date"))  # a row per date
    return sums.withColumn("is_default", F.row_number().over(best) == 1)


def signed_kpis(daily: DataFrame, day: date) -> DataFrame:
    """Of one date: trips, and the rates of sustained anomalies (late and early) and of thin coverage."""
    rows = daily.where(F.col("service_date") == F.lit(day))
    sums = rows.agg(
        F.sum("observed_trips").alias("observed_trips"), F.sum("evaluable_trips").alias("evaluable_trips"),
        F.sum(F.col("sustained_late_trips") + F.col("sustained_early_trips")).alias("_odd"), F.sum("insufficient_coverage_trips").alias("_thin"),
    )
    return sums.withColumns({"sustained_anomaly_pct": percent(F.col("_odd"), F.col("evaluable_trips")), "insufficient_coverage_pct": percent(F.col("_thin"), F.col("observed_trips"))}).drop("_odd", "_thin")


def trips_with_headsign(classified: DataFrame, trips: DataFrame) -> DataFrame:
    """Classified trips with the headsign of their feed's trip, null where it has none."""
    return classified.join(trips.select("feed_checksum", "trip_id", "trip_headsign"), ["feed_checksum", "trip_id"], "left")


def direction_labels(instances: DataFrame, trips: DataFrame) -> DataFrame:
    """direction_label per route and direction: the headsign of most trips, blank ones not counted, and the direction."""
    rows = instances.join(trips.where(F.trim("trip_headsign") != "").select("feed_checksum", "trip_id", "trip_headsign"), ["feed_checksum", "trip_id"])
    top = dominant(rows, ["route_id", "direction_id"], "trip_headsign")
    return top.withColumn("direction_label", F.format_string("%s (Dir %d)", "trip_headsign", "direction_id"))


def stops_with_station(scores: DataFrame, stops: DataFrame) -> DataFrame:
    """Scored stops with station_name: that of the parent station, else the stop's own, else its id."""
    own = stops.select("feed_checksum", "stop_id", F.col("stop_name").alias("_own"), "parent_station")
    parent = stops.select("feed_checksum", F.col("stop_id").alias("parent_station"), F.col("stop_name").alias("_parent"))
    joined = scores.join(own, ["feed_checksum", "stop_id"], "left").join(parent, ["feed_checksum", "parent_station"], "left")
    return joined.withColumn("station_name", F.coalesce("_parent", "_own", "stop_id")).drop("_own", "_parent", "parent_station")


def ranked(rows: DataFrame, order: list[Column], name: str = "place", within: list[str] | None = None) -> DataFrame:
    """The place of each row in the order, from 1: for small results whose order is the point."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*(within or [F.lit(0)])).orderBy(*order)))


def freshness(rows: DataFrame, group: str, ts: str, as_of: datetime) -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.max(ts).alias("_last")).select(
        group, "n", F.unix_micros("_last").alias("last_us"), (F.unix_seconds(F.lit(as_of)) - F.unix_seconds("_last")).alias("age_seconds")
    )
