"""p3, p4, p6 and p7: percentiles, runs, nearest matches, batches against history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.llm.history import known_already, known_by_batches
from headwaykit.llm.nearest import nearest_stops
from headwaykit.llm.quantiles import BASELINE_KEY, deviating_baselines, packed, percentile_columns, summarise, visits_once
from headwaykit.llm.runs import collapse_runs
from headwaykit.operators.panes import arrival_batches
from headwaykit.session import scratch
from headwaykit.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    checked = deviating_baselines(table(spark, folder, "historical_stop_features"), table(spark, folder, "historical_stop_baselines_fallback"))
    return checked.where("off").select("route_id", "direction_id", "stop_id", F.col("is_weekend").cast("int").alias("is_weekend"))


def p3_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    once = visits_once(table(spark, folder, "historical_stop_features"), BASELINE_KEY)
    packs = packed(summarise(once, BASELINE_KEY, "arrival_deviation_seconds"), BASELINE_KEY)
    shares = {"p25_seconds": 0.25, "median_seconds": 0.5, "p75_seconds": 0.75, "p90_seconds": 0.9}
    return packs.select(*BASELINE_KEY, F.col("n").alias("arrival_count"), *percentile_columns(F.col("buffers"), F.col("n"), shares))


def p3_within_bound(spark: SparkSession, folder: str) -> DataFrame:
    """Per group of p3_percentiles its number of values, and whether each percentile's true rank is within the known error of the one asked for."""
    shares = {"p25_seconds": 0.25, "median_seconds": 0.5, "p75_seconds": 0.75, "p90_seconds": 0.9}
    once = visits_once(table(spark, folder, "historical_stop_features"), BASELINE_KEY)
    given = p3_percentiles(spark, folder).select(*[F.col(c).alias(f"_{c}") for c in BASELINE_KEY], *shares)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in BASELINE_KEY])
    value = F.col("arrival_deviation_seconds")
    ranks = [F.struct(F.count_if(value < F.col(name)).alias("below"), F.count_if(value <= F.col(name)).alias("upto")).alias(f"_r_{name}") for name in shares]
    held = once.join(given, same).groupBy(*BASELINE_KEY).agg(F.count("*").alias("arrival_count"), *ranks)
    n = F.col("arrival_count")
    error = F.greatest(F.ceil(F.log2(n / F.lit(256.0))), F.lit(0)) / F.lit(512.0) + 1 / n
    within = reduce(lambda a, b: a & b, [(F.col(f"_r_{name}.below") / n <= share + error) & (F.col(f"_r_{name}.upto") / n >= share - error) for name, share in shares.items()])
    return held.select("route_id", "direction_id", "stop_id", "is_weekend", "arrival_count", within.alias("within_bound"))


def p4_runs(spark: SparkSession, folder: str) -> DataFrame:
    return collapse_runs(table(spark, folder, "temp_vehicle_events_stage"))


def _seconds(column: str):
    return F.floor(F.col(column) / F.lit(1_000_000)).cast("long")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_runs(spark, folder).where("n >= 3").select("vehicle_id", "trip_id", _seconds("t0").alias("run_start_s"), _seconds("t1").alias("run_end_s"))


def p4_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Every run as one event with count and duration."""
    return p4_runs(spark, folder).select(
        "vehicle_id", "trip_id", _seconds("t0").alias("run_start_s"), "n", ((F.col("t1") - F.col("t0")) / 1e6).alias("duration_s"), F.col("status").cast("string").alias("status"), F.col("sequence").cast("string").alias("sequence")
    )


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    matched = nearest_stops(table(spark, folder, "temp_schedule_match_events"), table(spark, folder, "gtfs_stop_instances"))
    return matched.select("event_key", F.date_format("service_date", "yyyy-MM-dd").alias("service_date"), "stop_sequence")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return known_already(table(spark, folder, "temp_vehicle_events_stage"), table(spark, folder, "vehicle_event_registry"))


def p7_by_batches(spark: SparkSession, folder: str) -> DataFrame:
    """p7_found by four batches of arrival: each against the points and keys that those before it stored."""
    batches = arrival_batches(table(spark, folder, "temp_vehicle_events_stage"), 4)
    return known_by_batches(batches, table(spark, folder, "vehicle_event_registry"), scratch(spark, "points"), scratch(spark, "keys"))


QUERIES = {
    "p3_found": p3_found,
    "p3_percentiles": p3_percentiles,
    "p3_within_bound": p3_within_bound,
    "p4_found": p4_found,
    "p4_collapsed": p4_collapsed,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_by_batches": p7_by_batches,
}

_RUNS = """
with keyed as (
  select *, right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) as ek from temp_vehicle_events_stage
  where vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null),
once as (
  select * exclude (rn) from (select *, row_number() over (partition by ek order by ingestion_timestamp, stage_row) as rn from keyed) where rn = 1),
stepped as (
  select vehicle_id, trip_id, epoch_us(vehicle_timestamp) as t, stage_row, current_status as st, current_stop_sequence as sq,
    coalesce(epoch_us(vehicle_timestamp) - lag(epoch_us(vehicle_timestamp)) over w > 600000000, true) as fresh
  from once window w as (partition by vehicle_id, trip_id order by vehicle_timestamp, stage_row)),
grouped as (
  select *, sum(fresh::int) over (partition by vehicle_id, trip_id order by t, stage_row rows unbounded preceding) as g from stepped),
filled as (
  select vehicle_id, trip_id, g, t, stage_row,
    last_value(st ignore nulls) over w as st, last_value(sq ignore nulls) over w as sq
  from grouped window w as (partition by vehicle_id, trip_id, g order by t, stage_row rows between unbounded preceding and current row)),
edged as (
  select *, (row_number() over w = 1 or st is distinct from lag(st) over w or sq is distinct from lag(sq) over w) as edge
  from filled window w as (partition by vehicle_id, trip_id, g order by t, stage_row)),
runs as (
  select *, sum(edge::int) over (partition by vehicle_id, trip_id, g order by t, stage_row rows unbounded preceding) as r from edged),
collapsed as (
  select vehicle_id, trip_id, min(t) as t0, max(t) as t1, count(*) as n, any_value(st) as status, any_value(sq) as sequence from runs group by vehicle_id, trip_id, g, r)
"""

SQL = {
    "p3_found": """
with visits as (
  select any_value(route_id) as route_id, any_value(direction_id) as direction_id, stop_id, any_value(is_weekend) as is_weekend, any_value(arrival_deviation_seconds) as v
  from historical_stop_features where arrival_deviation_seconds is not null and not isnan(arrival_deviation_seconds)
  group by service_date, trip_id, stop_sequence, stop_id),
shares as (
  select b.route_id, b.direction_id, b.stop_id, b.is_weekend,
    avg((v <= arrival_median_seconds)::int) as fm, avg((v <= arrival_p25_seconds)::int) as fq
  from historical_stop_baselines_fallback b
  join visits h on h.route_id = b.route_id and h.direction_id = b.direction_id and h.stop_id = b.stop_id and h.is_weekend = b.is_weekend group by all)
select route_id, direction_id, stop_id, is_weekend::int as is_weekend from shares where abs(fm - 0.5) > 0.1 or abs(fq - 0.25) > 0.1""",
    "p3_within_bound": """
with visits as (
  select any_value(route_id) as route_id, any_value(direction_id) as direction_id, stop_id, any_value(is_weekend) as is_weekend
  from historical_stop_features where arrival_deviation_seconds is not null and not isnan(arrival_deviation_seconds)
  group by service_date, trip_id, stop_sequence, stop_id)
select route_id, direction_id, stop_id, is_weekend, count(*) as arrival_count, true as within_bound from visits group by all""",
    "p4_found": _RUNS + "select vehicle_id, trip_id, t0 // 1000000 as run_start_s, t1 // 1000000 as run_end_s from collapsed where n >= 3",
    "p4_collapsed": _RUNS + "select vehicle_id, trip_id, t0 // 1000000 as run_start_s, n, (t1 - t0) / 1e6 as duration_s, status::varchar as status, sequence::varchar as sequence from collapsed",
    "p6_found": """
with stops as (
  select distinct trip_id, service_date, stop_sequence,
    timezone('America/New_York', coalesce(scheduled_arrival_local, scheduled_departure_local)) as scheduled from gtfs_stop_instances),
pairs as (
  select event_key, e.trip_id, vehicle_timestamp, service_date, stop_sequence,
    abs(epoch_us(vehicle_timestamp) - epoch_us(scheduled)) as d
  from (select distinct event_key, trip_id, vehicle_timestamp from temp_schedule_match_events) e join stops s on s.trip_id = e.trip_id)
select event_key, strftime(service_date, '%Y-%m-%d') as service_date, stop_sequence
from (select *, row_number() over (partition by event_key, trip_id, vehicle_timestamp order by d, service_date, stop_sequence) as rn from pairs where d <= 600000000)
where rn = 1""",
    "p7_found": """
with s as (
  select *, right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) as ek, epoch_us(vehicle_timestamp) as t from temp_vehicle_events_stage),
r as (select distinct right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) as ek from vehicle_event_registry),
same_key as (
  select stage_row from (select stage_row, ek, row_number() over (partition by ek order by ingestion_timestamp, stage_row) as rn from s) where rn > 1 or ek in (select ek from r)),
near as (
  select distinct b.stage_row from s a join s b on a.vehicle_id = b.vehicle_id and a.trip_id = b.trip_id
    and (a.ingestion_timestamp, a.stage_row) < (b.ingestion_timestamp, b.stage_row)
    and a.t between b.t - 2000000 and b.t + 2000000
    and 2 * 6371008.8 * asin(sqrt(least(1.0, power(sin(radians(b.latitude - a.latitude) / 2), 2)
        + cos(radians(a.latitude)) * cos(radians(b.latitude)) * power(sin(radians(b.longitude - a.longitude) / 2), 2)))) <= 50)
select stage_row from same_key union select stage_row from near""",
}
SQL["p7_by_batches"] = SQL["p7_found"]
