"""p1, p2 and p5: stops and trips, late events, mixed timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.operators.dwell import stops_and_trips
from headwaykit.operators.panes import arrival_batches, corrected_by_batches, corrected_periods
from headwaykit.operators.timestamps import raw_instants, schedule_instants
from headwaykit.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    seconds = lambda c: F.floor(F.col(c) / F.lit(1_000_000)).cast("long")
    return stops_and_trips(table(spark, folder, "temp_vehicle_events_stage")).select(
        "vehicle_id", "kind", seconds("start_us").alias("start_s"), seconds("end_us").alias("end_s")
    )


def p1_stops_and_trips(spark: SparkSession, folder: str) -> DataFrame:
    return stops_and_trips(table(spark, folder, "temp_vehicle_events_stage")).select(
        "vehicle_id", "kind", F.timestamp_micros("start_us").cast("string").alias("start"), F.timestamp_micros("end_us").cast("string").alias("end"),
        "duration_s", F.round("distance_m", 1).alias("distance_m"), "pings",
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    periods = corrected_periods(table(spark, folder, "temp_vehicle_events_stage"))
    return periods.where(F.col("corrected_count") > F.col("published_count")).select("route_id", "period_start_s")


def p2_corrected_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Half-hour windows every quarter of an hour: panes of a quarter, two to a window."""
    return corrected_periods(table(spark, folder, "temp_vehicle_events_stage"), window_s=1800, slide_s=900).select(
        "route_id", "period_start_s", "published_count", "corrected_count", "too_late_count"
    )


def p2_increments(spark: SparkSession, folder: str) -> DataFrame:
    """p2_corrected_counts by increments: eight batches in order of arrival, keys of earlier ones included."""
    batches = arrival_batches(table(spark, folder, "temp_vehicle_events_stage"), 8)
    return corrected_by_batches(batches, window_s=1800, slide_s=900).select(
        "route_id", "period_start_s", "published_count", "corrected_count", "too_late_count"
    )


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_instants(table(spark, folder, "temp_vehicle_events_stage_raw"), table(spark, folder, "feed_sources"))
    features = schedule_instants(table(spark, folder, "realtime_stop_features"))
    named = lambda df, name: df.where("instant_us is not null").select(
        F.lit(name).alias("tbl"), F.col("id").alias("row_id"), F.floor(F.col("instant_us") / F.lit(1000)).cast("long").alias("instant_ms")
    )
    return named(raw, "temp_vehicle_events_stage_raw").unionByName(named(features, "realtime_stop_features"))


FIRST = """
first as (
  select * exclude (rn) from (
    select *, row_number() over (partition by ek order by ingestion_timestamp, stage_row) as rn from (
      select *, right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) as ek from temp_vehicle_events_stage))
  where rn = 1)"""

QUERIES = {
    "p1_found": p1_found,
    "p1_stops_and_trips": p1_stops_and_trips,
    "p2_found": p2_found,
    "p2_corrected_counts": p2_corrected_counts,
    "p2_increments": p2_increments,
    "p5_found": p5_found,
}

SQL = {
    "p2_found": f"""
with {FIRST}, timed as (
  select route_id, cast(floor(epoch_us(coalesce(vehicle_timestamp, feed_timestamp)) / 900000000.0) as bigint) * 900 as period_start_s, epoch_us(ingestion_timestamp) as arrived
  from first where route_id is not null)
select distinct route_id, period_start_s from timed
where arrived > (period_start_s + 900 + 300) * 1000000 and arrived <= (period_start_s + 900 + 7200) * 1000000""",
    "p2_corrected_counts": f"""
with {FIRST}, timed as (
  select route_id, cast(floor(epoch_us(coalesce(vehicle_timestamp, feed_timestamp)) / 900000000.0) as bigint) * 900 as pane, epoch_us(ingestion_timestamp) as arrived
  from first where route_id is not null),
spread as (
  select route_id, pane - 900 * k as period_start_s, arrived - (pane - 900 * k + 1800) * 1000000 as late
  from timed, (values (0), (1)) as v(k) where pane is not null)
select route_id, period_start_s,
  count(*) filter (where late <= 300000000) as published_count,
  count(*) filter (where late <= 7200000000) as corrected_count,
  count(*) filter (where late > 7200000000) as too_late_count
from spread group by all""",
}
SQL["p2_increments"] = SQL["p2_corrected_counts"]

# The spellings that the test tables have, one case each; readings of a wall clock by the offsets a day before and after it.
SQL["p5_found"] = r"""
with src as (
  select 'temp_vehicle_events_stage_raw' as tbl, raw_id as row_id, vehicle_timestamp as txt, zone, coalesce(day_first, false) as df, epoch_us(ingestion_timestamp) as near, null::date as sd
  from temp_vehicle_events_stage_raw left join feed_sources using (source)
  union all
  select 'realtime_stop_features', feature_row, scheduled_arrival, 'America/New_York', false, epoch_us(arrival_estimate), service_date from realtime_stop_features),
clean as (select *, regexp_replace(txt, '^[\s\x{A0}"'']+|[\s\x{A0}"'']+$', '', 'g') as t from src),
read as (
  select *,
    case
      when regexp_full_match(t, '\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d.*') then try_strptime(replace(t[1:19], 'T', ' '), '%Y-%m-%d %H:%M:%S')
      when regexp_full_match(t, '\d{2}\.\d{2}\.\d{4} \d\d:\d\d') then try_strptime(t, '%d.%m.%Y %H:%M')
      when regexp_full_match(t, '([A-Za-z]+, )?\d\d [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d [A-Z]+') then try_strptime(regexp_extract(t, '\d\d [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d'), '%d %b %Y %H:%M:%S')
      when regexp_full_match(t, '[A-Za-z]+ \d{1,2}, \d{4} at \d{1,2}:\d\d [APap][Mm]') then try_strptime(t, '%B %d, %Y at %I:%M %p')
      when regexp_full_match(t, '\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d\d:\d\d [APap][Mm]') then if(df, try_strptime(t, '%d/%m/%Y %I:%M:%S %p'), try_strptime(t, '%m/%d/%Y %I:%M:%S %p'))
      when regexp_full_match(t, '\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d\d:\d\d') then if(df, try_strptime(t, '%d/%m/%Y %H:%M:%S'), try_strptime(t, '%m/%d/%Y %H:%M:%S'))
      when regexp_full_match(t, '\d{14}') then try_strptime(t, '%Y%m%d%H%M%S')
      when regexp_full_match(t, '\d{8}T\d{6}Z') then try_strptime(t, '%Y%m%dT%H%M%SZ')
      when sd is not null and regexp_full_match(t, '\d{1,2}:\d\d(:\d\d)?')
        then sd::timestamp + to_seconds(split_part(t, ':', 1)::int * 3600 + split_part(t, ':', 2)::int * 60 + coalesce(try_cast(split_part(t, ':', 3) as int), 0))
      when sd is not null and regexp_full_match(t, '\d{1,2}:\d\d [APap][Mm]')
        then sd::timestamp + to_seconds((split_part(t, ':', 1)::int % 12 + if(lower(t) like '%pm', 12, 0)) * 3600 + regexp_extract(t, ':(\d\d)', 1)::int * 60)
      when sd is not null and regexp_full_match(t, '\d{2,6}|[1-9]') then sd::timestamp + to_seconds(t::int)
    end as wall,
    case
      when regexp_full_match(t, '/Date\(\d{13}\)/') then regexp_extract(t, '\d+')::bigint * 1000
      when regexp_full_match(t, '\d{10}(\.\d+)?') then t[1:10]::bigint * 1000000 + coalesce(try_cast(rpad(split_part(t, '.', 2), 6, '0') as bigint), 0)
      when regexp_full_match(t, '\d{13}') then t::bigint * 1000
      when regexp_full_match(t, '\d{16}') then t::bigint
    end as instant,
    coalesce(try_cast(rpad(regexp_extract(t, ':\d\d:\d\d[.,](\d+)', 1), 6, '0') as bigint), 0) as part,
    case
      when regexp_matches(t, '\d[+-]\d\d:?\d\d$') and t like '%:%'
        then (if(regexp_extract(t, '([+-])\d\d:?\d\d$', 1) = '-', -1, 1)) * (regexp_extract(t, '[+-](\d\d):?\d\d$', 1)::int * 3600 + right(t, 2)::int * 60)
      when regexp_matches(t, '\d ?(Z|UTC|GMT)$') then 0
      else case regexp_extract(t, ' ([A-Z]{3})$', 1) when 'EST' then -18000 when 'EDT' then -14400 when 'CST' then -21600 when 'CDT' then -18000 when 'IST' then 19800 end
    end as ahead,
    coalesce(nullif(regexp_extract(t, '\[(.+)\]$', 1), ''), zone) as z,
    sd is not null and regexp_full_match(t, '\d{1,2}:\d\d [APap][Mm]') as half
  from clean),
walls as (
  select *, unnest(if(half, [wall, wall + interval 1 day], [wall])) as w from read where instant is null and ahead is null and wall is not null and z is not null),
around as (
  select *, epoch_us(w - interval 1 day) - epoch_us(timezone(z, w - interval 1 day)) as o1, epoch_us(w + interval 1 day) - epoch_us(timezone(z, w + interval 1 day)) as o2 from walls),
holding as (
  select *, timezone(z, make_timestamptz(epoch_us(w) - o1)) = w as h1, timezone(z, make_timestamptz(epoch_us(w) - o2)) = w as h2 from around),
several as (
  select tbl, row_id, near, part, unnest(case when h1 and h2 then [epoch_us(w) - o1, epoch_us(w) - o2] when h2 and not h1 then [epoch_us(w) - o2] else [epoch_us(w) - o1] end) as us from holding),
chosen as (
  select tbl, row_id, us + part as us from several
  qualify row_number() over (partition by tbl, row_id order by if(near is null, 0, abs(us + part - near)), us) = 1)
select tbl, row_id, us // 1000 as instant_ms from chosen
union all
select tbl, row_id, coalesce(instant, epoch_us(wall) + part - ahead::bigint * 1000000) // 1000 from read where instant is not null or (ahead is not null and wall is not null)"""

# The rule ping by ping, as a state per vehicle: the stretch at hand (pings, sums, first and last time) and one ping elsewhere that waits.
SQL["p1_found"] = """
with recursive fixes as (
  select *, row_number() over (partition by ek order by ingestion_timestamp, stage_row) as rn from (
    select *, coalesce(right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64), 'row:' || stage_row) as ek from temp_vehicle_events_stage
    where vehicle_id is not null and vehicle_timestamp is not null and latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude))),
pings as (
  select vehicle_id, epoch_us(vehicle_timestamp) as t, latitude as lat, longitude as lon, row_number() over (partition by vehicle_id order by vehicle_timestamp, stage_row) as i from fixes where rn = 1),
steps as (
  select vehicle_id, i, t, 0 as segment, 1 as n, lat as slat, lon as slon, t as t0, t as t1, null::bigint as pt, null::double as plat, null::double as plon, null::bigint as c0, null::bigint as c1, null::int as cn, 0 as cs
  from pings where i = 1
  union all
  select vehicle_id, i, t, segment + silent::int,
    case when restart then 1 when near then n + 1 when pt is null then n when pnear then 2 else 1 end,
    case when restart then lat when near then slat + lat when pt is null then slat when pnear then plat + lat else plat end,
    case when restart then lon when near then slon + lon when pt is null then slon when pnear then plon + lon else plon end,
    case when restart then t when near or pt is null then t0 else pt end,
    case when restart or near then t when pt is null then t1 when pnear then t else pt end,
    case when restart or near then null when pt is null then t when pnear then null else t end,
    case when restart or near then null when pt is null then lat when pnear then null else lat end,
    case when restart or near then null when pt is null then lon when pnear then null else lon end,
    case when closes then t0 end, case when closes then t1 end, case when closes then n end, segment
  from (
    select *, restart or not near and pt is not null as closes from (
      select s.vehicle_id, p.i, p.t, p.lat, p.lon, s.segment, s.n, s.slat, s.slon, s.t0, s.t1, s.pt, s.plat, s.plon, p.t - s.t > 1800000000 as silent, p.t - s.t > 1800000000 as restart,
        2 * 6371008.8 * asin(sqrt(least(1.0, power(sin(radians(p.lat - s.slat / s.n) / 2), 2) + cos(radians(s.slat / s.n)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.slon / s.n) / 2), 2)))) <= 75 as near,
        coalesce(2 * 6371008.8 * asin(sqrt(least(1.0, power(sin(radians(p.lat - s.plat) / 2), 2) + cos(radians(s.plat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.plon) / 2), 2)))) <= 75, false) as pnear
      from steps s join pings p on p.vehicle_id = s.vehicle_id and p.i = s.i + 1))),
runs as (
  select vehicle_id, c0 as t0, c1 as t1, cn as n, cs as segment from steps where c0 is not null
  union all
  select vehicle_id, t0, t1, n, segment from steps qualify row_number() over (partition by vehicle_id order by i desc) = 1),
stops as (
  select vehicle_id, t0, t1, segment, lag(t1) over w as before, lag(segment) over w as segment_before from runs where n > 1 and t1 - t0 >= 180000000 window w as (partition by vehicle_id order by t0))
select vehicle_id, 'stop' as kind, t0 // 1000000 as start_s, t1 // 1000000 as end_s from stops
union all
select vehicle_id, 'trip', before // 1000000, t0 // 1000000 from stops where segment_before = segment"""
