"""Queries of what surrounds the pipeline: the chain in one piece, sources and sinks, monitoring, dashboards."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.keys import with_event_key
from headwaykit.operators import baselines, calendar, coverage, dedup, history, matching, quality, rollups, scoring, serving, upsert
from headwaykit.plans.reference_queries import ASSERTIONS, BLOCKS, E_SQL, TRIP_COUNTS, _instances, _operations, _scores, _signed, _windows, epoch, query, sql, text
from headwaykit.plans.views import VISIT, Views
from headwaykit.session import scratch, written
from headwaykit.sources import history_files, schedule_feeds, snapshots

_like = lambda block, old, new: BLOCKS[block][1].replace(f"from {old}", f"from {new}")

BLOCKS |= {
    # The live chain: features scored against baselines of eligible history.
    "feat": (["dev", "mq"], """select *, coalesce(arrival_deviation_seconds is not null and arrival_uncertainty_seconds <= 60 and inference_quality in ('COMPLETE', 'PARTIAL') and not sma, false) as eligible from (
        select d.*, coalesce(q.med > 3600, false) as sma, extract(hour from timezone('America/New_York', scheduled_arrival)) as service_hour, isodow(d.service_date) >= 6 as is_weekend
        from dev d left join mq q on q.feed_checksum = d.feed_checksum and q.service_date = d.service_date and q.trip_id = d.trip_id and q.stop_sequence = d.stop_sequence and q.stop_id = d.stop_id)"""),
    "elig": (["hfeat"], "select *, arrival_delay_seconds as dev from hfeat where baseline_eligible and service_hour is not null"),
    "cbl": (["elig"], _like("bl", "vis", "elig")),
    "csc": (["feat", "cbl"], """select *, cls in ('CERTAIN_LATE', 'POSSIBLE_LATE') as anom from (select *,
        case when not eligible or high is null then 'NOT_EVALUABLE' when arrival_deviation_lower_seconds > high then 'CERTAIN_LATE' when arrival_deviation_upper_seconds > high then 'POSSIBLE_LATE' else 'NORMAL' end as cls from (
        select v.*, v.arrival_deviation_seconds as dev, coalesce(h.lvl, f.lvl) as lvl, coalesce(h.n, f.n) as n, coalesce(h.high, f.high) as high from feat v
        left join (from cbl where lvl = 'HOURLY') h on h.route_id = v.route_id and h.direction_id = v.direction_id and h.stop_id = v.stop_id and h.is_weekend = v.is_weekend and h.service_hour = v.service_hour
        left join (from cbl where lvl = 'FALLBACK') f on f.route_id = v.route_id and f.direction_id = v.direction_id and f.stop_id = v.stop_id and f.is_weekend = v.is_weekend))"""),
    "ctrips": (["csc"], _like("trips", "sc", "csc")),
    "cdaily": (["ctrips"], _like("daily", "trips", "ctrips")),
    "chourly": (["csc"], _like("hourly", "sc", "csc")),
    "tsd": (["ts"], """select service_date, route_id, count(*) as observed_trips, count(*) filter (where trip_anomaly_status <> 'INSUFFICIENT_COVERAGE') as evaluable_trips,
        count(*) filter (where trip_anomaly_status in ('SUSTAINED_LATE', 'SUSTAINED_EARLY')) as odd, count(*) filter (where trip_anomaly_status = 'INSUFFICIENT_COVERAGE') as thin from ts group by all"""),
    # Made from the test tables: what a feed says about trips and stops.
    "heads": ([], "select distinct feed_checksum, trip_id, case when length(trip_id) % 5 = 0 then ' ' else 'To ' || right(trip_id, 1) end as trip_headsign from gtfs_stop_instances"),
    "places": ([], """select distinct feed_checksum, stop_id, case when stop_id::int % 3 > 0 then 'Stop ' || stop_id end as stop_name, 'P' || (stop_id::int % 20) as parent_station from gtfs_stop_instances
        union all select distinct feed_checksum, 'P' || (stop_id::int % 20), 'Station ' || (stop_id::int % 20), null from gtfs_stop_instances where stop_id::int % 20 > 4"""),
    "mu": (["m"], """select * exclude (rn) from (select *, row_number() over (partition by event_key order by case match_source when 'primary' then 0 else 1 end, ingestion_timestamp desc, feed_checksum, service_date) as rn from (
        select *, 'primary' as match_source from m where stop_sequence % 2 = 0 union all select *, 'secondary' from m)) where rn = 1"""),
}


def _headsigns(v: Views) -> DataFrame:
    sign = F.when(F.length("trip_id") % 5 == 0, " ").otherwise(F.concat(F.lit("To "), F.right("trip_id", F.lit(1))))
    return v.schedule().select("feed_checksum", "trip_id", sign.alias("trip_headsign")).distinct()


def _places(v: Views) -> DataFrame:
    n = F.col("stop_id").cast("int")
    rows, place = v.schedule(), F.concat(F.lit("P"), (n % 20).cast("string"))
    own = rows.select("feed_checksum", "stop_id", F.when(n % 3 > 0, F.concat(F.lit("Stop "), "stop_id")).alias("stop_name"), place.alias("parent_station")).distinct()
    parents = rows.where(n % 20 > 4).select("feed_checksum", place.alias("stop_id"), F.concat(F.lit("Station "), (n % 20).cast("string")).alias("stop_name"), F.lit(None).cast("string").alias("parent_station")).distinct()
    return own.unionByName(parents)


# --- The chain: observations to matches, stops, deviations, features; history to baselines; scores and roll-ups ------


def _chain(v: Views) -> DataFrame:
    eligible = v.historical_features().where("baseline_eligible")
    return scoring.score_stops(v.features(), baselines.stop_baselines(eligible, "arrival_delay_seconds"))


@query("chain_baselines", "select lvl as baseline_level, route_id, direction_id, stop_id, is_weekend, service_hour::varchar as service_hour, n as observation_count, q1 as q1_delay_seconds, med as median_delay_seconds, q3 as q3_delay_seconds from cbl", "cbl")
def _(v: Views) -> DataFrame:
    rows = baselines.stop_baselines(v.historical_features().where("baseline_eligible"), "arrival_delay_seconds")
    return rows.select("baseline_level", *baselines.KEYS, text("service_hour"), "observation_count", "q1_delay_seconds", "median_delay_seconds", "q3_delay_seconds")


@query("chain_scores", """select feed_checksum, service_date::varchar as service_date, trip_id, stop_sequence, stop_id, lvl as baseline_level, n::varchar as baseline_observation_count, cls as stop_classification,
    cls = 'CERTAIN_LATE' as is_certain_late, lvl is not null as baseline_found, case when anom then dev - high end as seconds_above_upper_fence from csc""", "csc")
def _(v: Views) -> DataFrame:
    return _chain(v).select("feed_checksum", text("service_date"), "trip_id", "stop_sequence", "stop_id", "baseline_level", text("baseline_observation_count"), "stop_classification", "is_certain_late", "baseline_found", "seconds_above_upper_fence")


@query("chain_trips", f"select feed_checksum, service_date::varchar as service_date, trip_id, route_id, {', '.join(TRIP_COUNTS)}, normal_stop_count, anomaly_percent, trip_classification from ctrips", "ctrips")
def _(v: Views) -> DataFrame:
    return rollups.trip_anomalies(_chain(v)).select("feed_checksum", text("service_date"), "trip_id", "route_id", *TRIP_COUNTS, "normal_stop_count", "anomaly_percent", "trip_classification")


@query("chain_route_hourly", f"select service_date::varchar as service_date, route_id, direction_id, service_hour::varchar as service_hour, {', '.join(TRIP_COUNTS)}, distinct_trip_count, anomaly_rate_percent, route_hour_classification from chourly", "chourly")
def _(v: Views) -> DataFrame:
    return rollups.route_hourly(_chain(v)).select(text("service_date"), "route_id", "direction_id", text("service_hour"), *TRIP_COUNTS, "distinct_trip_count", "anomaly_rate_percent", "route_hour_classification")


@query("chain_route_daily", "select service_date::varchar as service_date, * exclude (service_date) from cdaily", "cdaily")
def _(v: Views) -> DataFrame:
    return rollups.route_daily(rollups.trip_anomalies(_chain(v))).withColumn("service_date", F.col("service_date").cast("string"))


# --- Sources and sinks ------------------------------------------------------------------------------------------


def _raw_files(v: Views) -> DataFrame:
    """Past visits as a raw daily file has them: dates as numbers, epochs with fractions, directions as truth values."""
    rows = v.raw_history()
    return rows.select(
        F.date_format("service_date", "yyyyMMdd").cast("int").alias("service_date"), "trip_id", "stop_sequence", "stop_id", "route_id", (F.col("direction_id") == 1).alias("direction_id"), "vehicle_id",
        (F.unix_seconds("stop_timestamp") + 0.75).alias("stop_timestamp"), (F.unix_seconds("move_timestamp") + 0.25).alias("move_timestamp"), F.col("scheduled_arrival_seconds").cast("string").alias("scheduled_arrival_time"),
        F.col("scheduled_departure_seconds").cast("double").alias("scheduled_departure_time"), "travel_time_seconds", "dwell_time_seconds", F.lit("left out").alias("not_in_contract"),
    )


@query("d16_history_contract", f"""select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, route_id, direction_id, {E_SQL("stop_ts", "stop_us")}, {E_SQL("move_ts", "move_us")}, sas::varchar as scheduled_arrival_seconds,
    sds::varchar as scheduled_departure_seconds, travel_time_seconds::varchar as travel_time_seconds, null::varchar as branch_route_id, 27 as columns from hist""".replace("epoch_us(stop_ts)", "(epoch_us(stop_ts) // 1000000 * 1000000)").replace("epoch_us(move_ts)", "(epoch_us(move_ts) // 1000000 * 1000000)"), "hist")
def _(v: Views) -> DataFrame:
    rows = history.canonical_history(_raw_files(v))
    return rows.select(
        text("service_date"), "trip_id", "stop_sequence", "stop_id", "route_id", "direction_id", epoch("stop_timestamp", "stop_us"), epoch("move_timestamp", "move_us"), text("scheduled_arrival_seconds"),
        text("scheduled_departure_seconds"), text("travel_time_seconds"), "branch_route_id", F.lit(len(rows.columns)).alias("columns"),
    )


@query("d16_history_counts", """select count(*) as read, count(*) filter (where service_date is null or trip_id is null or stop_sequence is null or stop_id is null) as keyless,
    count(*) filter (where rn > 1 and not (service_date is null or trip_id is null or stop_sequence is null or stop_id is null)) as repeated,
    count(*) filter (where rn = 1 and not (service_date is null or trip_id is null or stop_sequence is null or stop_id is null)) as stored, count(distinct service_date) as service_dates
    from (select *, row_number() over (partition by service_date, trip_id, stop_sequence, stop_id) as rn from (
      select * replace (case when travel_time_seconds % 50 = 7 then null else trip_id end as trip_id) from rawh))""", "rawh")
def _(v: Views) -> DataFrame:
    gap = F.when(F.col("travel_time_seconds") % 50 == 7, None).otherwise(F.col("trip_id"))
    return history.history_counts(_raw_files(v).withColumn("trip_id", gap))


@query("s13_partitioned_sink", "select service_date::varchar as service_date, count(*) as n, sum(stop_sequence)::bigint as sequences from hist group by service_date", "hist")
def _(v: Views) -> DataFrame:
    """History stored by date, one date stored again, and read back."""
    path = scratch(v.spark, "history")
    history.store_history(_raw_files(v), path, files=8)
    stored = history_files.scan_partitioned(v.spark, path)
    again = written(stored.where(F.col("service_date") == F.lit(stored.agg(F.min("service_date")).first()[0])), "again")
    history_files.write_partitioned(again, path, "service_date", files=8)
    return history_files.scan_partitioned(v.spark, path).groupBy("service_date").agg(F.count("*").alias("n"), F.sum("stop_sequence").alias("sequences")).withColumn("service_date", F.col("service_date").cast("string"))


@query("s14_refreshed_copy", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def _(v: Views) -> DataFrame:
    """A clustered copy of an outside table, refreshed twice."""
    path, rows = scratch(v.spark, "copy"), v.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    history_files.replace_table(rows.limit(5), path)
    return history_files.replace_table(rows, path, partition="l_returnflag", cluster=["l_orderkey"])


@query("s9_loaded_with_schema", "select o_orderkey, o_orderstatus, try_cast(o_orderpriority as int)::varchar as o_orderpriority, o_custkey::varchar as o_custkey, null::varchar as o_note from orders")
def _(v: Views) -> DataFrame:
    """Truncate and load under an explicit schema: wrong values and missing columns are null."""
    schema = "o_orderkey bigint, o_orderstatus string, o_orderpriority int, o_custkey string, o_note string"
    rows = history_files.replace_table(v.table("orders"), scratch(v.spark, "loaded"), schema)
    return rows.withColumn("o_orderpriority", F.col("o_orderpriority").cast("string"))


@query("s20_rebuilt_windows", "select epoch_us(w0) as start_us, epoch_us(w1) as end_us, snapshot_count from cw", "cw")
def _(v: Views) -> DataFrame:
    rows = history_files.replace_table(_windows(v), scratch(v.spark, "windows"))
    return rows.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "snapshot_count")


@query("s21_sorted_export", "select service_date::varchar as service_date, trip_id, stop_sequence, row_number() over (partition by service_date order by trip_id, stop_sequence, stop_id) as place from hist", "hist")
def _(v: Views) -> DataFrame:
    """An export by date, sorted inside: the place of each row, as its file has it."""
    path = scratch(v.spark, "export")
    rows = v.history().select("service_date", "trip_id", "stop_sequence", "stop_id")
    history_files.export_sorted(rows.repartition(1), path, "service_date", ["trip_id", "stop_sequence", "stop_id"])
    stored = v.spark.read.parquet(path).select("service_date", "trip_id", "stop_sequence", "stop_id")
    line = Window.partitionBy("service_date").orderBy("trip_id", "stop_sequence", "stop_id")
    return stored.select(text("service_date"), "trip_id", "stop_sequence", F.row_number().over(line).alias("place"))


@query("s16_upsert_stored", """with u as (select o_orderkey, o_custkey, 'Z' as o_orderstatus, -o_totalprice as o_totalprice from orders where o_orderkey % 3 = 0)
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey not in (select o_orderkey from u) union all select * from u""")
def _(v: Views) -> DataFrame:
    """Orders stored by status, every third one restated and thereby moved to another partition."""
    path, rows = scratch(v.spark, "orders"), v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    upsert.upsert(path, rows, ["o_orderkey"], "o_orderstatus")
    upsert.upsert(path, rows.where("o_orderkey % 3 = 0").withColumns({"o_totalprice": -F.col("o_totalprice"), "o_orderstatus": F.lit("Z")}), ["o_orderkey"], "o_orderstatus")
    return v.spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("o_orderstatus").cast("string"), "o_totalprice")


_BATCHED = """b as (select *, day(ingestion_timestamp) % 2 as batch from keyed where ingestion_timestamp is not null),
    first as (select ek, min(batch) as batch from b where ek is not null and ek not in (select right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) from vehicle_event_registry) group by ek)"""


@query("d3_registry_flow", f"with keyed as ({BLOCKS['keyed'][1]}), {_BATCHED} select batch, count(*) as new_keys from first group by batch")
def _(v: Views) -> DataFrame:
    """Two loads against the registry: only newly registered keys flow on."""
    path = scratch(v.spark, "registry")
    key = F.lower(F.hex(dedup.event_identity(F.col("event_key"), F.lit(0)))).alias("event_key")
    upsert.register(path, v.table("vehicle_event_registry").select(key), ["event_key"])
    stage = v.table("temp_vehicle_events_stage").where("event_key is not null and ingestion_timestamp is not null").withColumn("batch", F.day("ingestion_timestamp") % 2)
    flowed = [upsert.register(path, stage.where(F.col("batch") == n).select(key), ["event_key"]).withColumn("batch", F.lit(n)) for n in (0, 1)]
    return flowed[0].unionByName(flowed[1]).groupBy("batch").agg(F.count("*").alias("new_keys"))


@query("s15_file_registry", f"""with keyed as ({BLOCKS['keyed'][1]}), {_BATCHED},
    f as (select strftime(ingestion_timestamp, '%Y-%m-%d') as object_name, ek, ingestion_timestamp, stage_row from b),
    n as (select ek, ingestion_timestamp, stage_row, row_number() over (partition by ek order by ingestion_timestamp, stage_row) = 1 and ek is not null and ek in (select ek from first) as fresh from f)
    select strftime(ingestion_timestamp, '%Y-%m-%d') as object_name, count(*) as row_count, count(*) filter (where fresh) as new_row_count from n group by 1""")
def _(v: Views) -> DataFrame:
    """Files (here: days of arrival) registered with their rows and how many of them were new."""
    stage = v.table("temp_vehicle_events_stage").where("ingestion_timestamp is not null").withColumn("source_file", F.date_format("ingestion_timestamp", "yyyy-MM-dd"))
    fresh = dedup.dedup_events(stage, v.table("vehicle_event_registry"))
    return upsert.register_files(scratch(v.spark, "files"), stage, fresh).select("object_name", "row_count", "new_row_count")


@query("s4_snapshot_decode", """select stage_row, entity_id, vehicle_id, trip_id, route_id, coalesce(schedule_relationship, 'SCHEDULED') as schedule_relationship, coalesce(direction_id, 0) as direction_id,
    case when longitude is not null then latitude::float::double end as latitude, case when latitude is not null then longitude::float::double end as longitude, stop_id, nullif(current_stop_sequence, 0)::varchar as current_stop_sequence,
    coalesce(current_status, 2) as current_status, (nullif(epoch_us(vehicle_timestamp) // 1000000, 0) * 1000000)::varchar as vehicle_us
    from (select * replace (stage_row::varchar as entity_id) from temp_vehicle_events_stage) where ingestion_timestamp is not null and coalesce(schedule_relationship, 'SCHEDULED') in ('SCHEDULED', 'ADDED', 'UNSCHEDULED', 'CANCELED')""")
def _(v: Views) -> DataFrame:
    """Staged rows as snapshot files, one per time of arrival, and decoded again."""
    rows = v.table("temp_vehicle_events_stage").where("ingestion_timestamp is not null and coalesce(schedule_relationship, 'SCHEDULED') in ('SCHEDULED', 'ADDED', 'UNSCHEDULED', 'CANCELED')").withColumns({
        "entity_id": F.col("stage_row").cast("string"), "path": F.date_format("ingestion_timestamp", "yyyyMMdd'T'HHmmss'Z.pb'"),
        "vehicle_timestamp_raw": F.unix_seconds("vehicle_timestamp"), "feed": F.coalesce(F.unix_seconds("feed_timestamp"), F.lit(0)),
    })
    out = snapshots.decode_snapshots(snapshots.encode_snapshots(rows, "path", "feed"))
    return out.select(
        F.col("entity_id").cast("long").alias("stage_row"), "entity_id", "vehicle_id", "trip_id", "route_id", "schedule_relationship", "direction_id", "latitude", "longitude", "stop_id", text("current_stop_sequence"),
        "current_status", epoch("vehicle_timestamp", "vehicle_us"),
    )


@query("d1_event_key", """select stage_row, sha256(case when v is not null and v <> 0 then coalesce(vehicle_id, 'None') || '|' || v || '|' || coalesce(trip_id, 'None')
    else coalesce(vehicle_id, 'None') || '|' || coalesce(f::varchar, 'None') || '|' || coalesce(trip_id, 'None') || '|' || coalesce(entity_id, 'None') end) as event_key
    from (select *, epoch_us(vehicle_timestamp) // 1000000 * (stage_row % 7 > 0)::int as v, epoch_us(feed_timestamp) // 1000000 as f from temp_vehicle_events_stage)""")
def _(v: Views) -> DataFrame:
    raw = v.table("temp_vehicle_events_stage").drop("event_key").withColumns({
        "vehicle_timestamp_raw": F.unix_seconds("vehicle_timestamp") * (F.col("stage_row") % 7 > 0).cast("int"), "feed_timestamp_raw": F.unix_seconds("feed_timestamp"),
    })
    return with_event_key(raw).select("stage_row", "event_key")


def _feed(v: Views) -> str:
    """The nations (25 rows) as stops and trips of a zipped feed in the landing zone, loaded once."""
    path = scratch(v.spark, "feeds")
    nations = sorted(v.table("nation").select("n_nationkey", "n_name", "n_regionkey").collect())
    sevens = lambda r: [int(d < 5) for d in range(7)] if r % 2 else [int(d >= 4) for d in range(7)]
    content = schedule_feeds.feed_zip({
        "feed_info": (["feed_version", "feed_start_date", "feed_end_date"], [("spring", "20260301", "20260314")]),
        "routes": (["route_id", "route_type"], [(f"r{r}", 1) for r in range(5)]),
        "stops": (["stop_id", "stop_name", "stop_lat", "parent_station"], [(f"n{n}", name if n % 4 else "", n / 2, f"n{r}") for n, name, r in nations]),
        "trips": (["trip_id", "route_id", "service_id", "direction_id"], [(f"t{n}", f"r{r}", f"s{r}", n % 2) for n, _, r in nations]),
        "stop_times": (["trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time"], [(f"t{n}", k + 1, f"n{(n + k) % 25}", f"{20 + k * 2}:{n:02d}:00", f"{20 + k * 2}:{n:02d}:30") for n, _, _ in nations for k in range(4)]),
        "calendar": (["service_id", *calendar.DAYS, "start_date", "end_date"], [(f"s{r}", *sevens(r), "20260302", "20260312") for r in range(5)]),
        "calendar_dates": (["service_id", "date", "exception_type"], [("s1", "20260303", 2), ("s2", "20260303", 1)]),
    })
    zips = v.spark.createDataFrame([("feed.zip", content)], "path string, content binary").select("path", F.timestamp_seconds(F.lit(0)).alias("modificationTime"), "content", F.sha2("content", 256).alias("feed_checksum"))
    schedule_feeds.load_feed(schedule_feeds.next_feed(zips), path)
    assert schedule_feeds.next_feed(zips, v.spark.read.parquet(f"{path}/feeds")).isEmpty()
    return path


@query("s10_stop_dimension", "select 'n' || n_nationkey as stop_id, case when n_nationkey % 4 > 0 then n_name end as stop_name, n_nationkey / 2 as stop_lat, 'n' || n_regionkey as parent_station from nation")
def _(v: Views) -> DataFrame:
    return schedule_feeds.loaded_table(v.spark, _feed(v), "stops").select("stop_id", "stop_name", "stop_lat", "parent_station")


@query("j16_parent_names", """select 'n' || c.n_nationkey as stop_id, coalesce(case when c.n_nationkey % 4 > 0 then c.n_name end, case when p.n_nationkey % 4 > 0 then p.n_name end, 'n' || c.n_nationkey) as stop_name
    from nation c left join nation p on p.n_nationkey = c.n_regionkey""")
def _(v: Views) -> DataFrame:
    return serving.parent_named(schedule_feeds.loaded_table(v.spark, _feed(v), "stops")).select("stop_id", "stop_name")


@query("s11_feed_tables", """select * from (values ('calendar', 5), ('calendar_dates', 2), ('routes', 5)) t(member, n) union all select m, count(*) * k from nation, (values ('stops', 1), ('trips', 1), ('stop_times', 4)) t(m, k) group by m, k""")
def _(v: Views) -> DataFrame:
    path = _feed(v)
    counts = [schedule_feeds.loaded_table(v.spark, path, m).agg(F.count("*").alias("n")).select(F.lit(m).alias("member"), "n") for m in schedule_feeds.LOADED]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


_INSTANCES = """d as (select unnest(generate_series(date '2026-03-01', date '2026-03-14', interval 1 day))::date as day),
    a as (select day, r from d, (select distinct n_regionkey as r from nation) where (day between date '2026-03-02' and date '2026-03-12' and case when r % 2 = 1 then isodow(day) <= 5 else isodow(day) >= 5 end and not (r = 1 and day = date '2026-03-03')) or (r = 2 and day = date '2026-03-03')),
    i as (select day, 't' || n_nationkey as trip_id, n_nationkey as n, n_regionkey as r from a join nation on n_regionkey = r)"""


def _feed_instances(v: Views) -> tuple[DataFrame, DataFrame]:
    path = _feed(v)
    load = lambda m: schedule_feeds.loaded_table(v.spark, path, m)
    active = calendar.active_services(load("feeds"), load("calendar"), load("calendar_dates"))
    trips = calendar.trip_instances(active, load("trips"))
    return trips, calendar.stop_instances(trips, load("stop_times"))


@query("d6_trip_instances", f"with {_INSTANCES} select day::varchar as service_date, trip_id, 'r' || r as route_id, 's' || r as service_id, n % 2 as direction_id from i")
def _(v: Views) -> DataFrame:
    return _feed_instances(v)[0].select(text("service_date"), "trip_id", "route_id", "service_id", "direction_id")


@query("j14_stop_instances", f"""with {_INSTANCES} select day::varchar as service_date, trip_id, k + 1 as stop_sequence, 'n' || ((n + k) % 25) as stop_id, (20 + 2 * k) * 3600 + n * 60 as arrival_seconds,
    epoch_us(day::timestamp + to_seconds((20 + 2 * k) * 3600 + n * 60 + 30)) as departure_us from i, (values (0), (1), (2), (3)) t(k)""")
def _(v: Views) -> DataFrame:
    return _feed_instances(v)[1].select(text("service_date"), "trip_id", "stop_sequence", "stop_id", "arrival_seconds", F.unix_micros(F.col("scheduled_departure_local").cast("timestamp")).alias("departure_us"))


@query("s1_recursive_scan", "select count(*) as n, sum(l_orderkey)::bigint as keys, false as has_folder_column from lineitem")
def _(v: Views) -> DataFrame:
    """A table stored in folders by line number, read without regard to them."""
    path = scratch(v.spark, "folders")
    v.table("lineitem").select("l_orderkey", "l_linenumber").write.partitionBy("l_linenumber").parquet(path)
    rows = history_files.scan_recursive(v.spark, path)
    return rows.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys")).withColumn("has_folder_column", F.lit("l_linenumber" in rows.columns))


@query("s2_pruned_dates", """select service_date::varchar as service_date, count(*) as n from hist
    where service_date between (select min(service_date) from hist) and (select min(service_date) + 2 from hist) group by service_date""", "hist")
def _(v: Views) -> DataFrame:
    """History by date folders; a range of dates reads theirs only."""
    path = scratch(v.spark, "dates")
    history_files.write_partitioned(v.history(), path, "service_date", files=2)
    rows = history_files.scan_partitioned(v.spark, path)
    first = rows.agg(F.min("service_date")).first()[0]  # one value
    return history_files.in_dates(rows, "service_date", str(first), str(first + timedelta(days=2))).groupBy(text("service_date")).agg(F.count("*").alias("n"))


@query("s3_file_facts", "select count(*) as rows, 22 as columns from historical_stop_features")
def _(v: Views) -> DataFrame:
    """What footers tell, without reading rows."""
    paths = v.spark.createDataFrame([(p,) for p in v.table("historical_stop_features").inputFiles()], "path string")
    return history_files.all_file_facts(paths).agg(F.sum("rows").alias("rows"), F.max("columns").cast("int").alias("columns"))


@query("s7_candidate_files", """with f as (select distinct 'snap/' || strftime(ingestion_timestamp, '%Y-%m-%d') || '/' || strftime(ingestion_timestamp, '%Y%m%dT%H%M%SZ') || '.pb' as path, date_trunc('second', ingestion_timestamp) as arrived
      from temp_vehicle_events_stage where ingestion_timestamp is not null)
    select path, epoch_us(arrived) as at_us from f where epoch_us(arrived) // 1000000 % 4 > 0 and arrived >= (select max(arrived) - interval 2 day from f) order by arrived, path limit 100""")
def _(v: Views) -> DataFrame:
    """Names of snapshots with their times; every fourth second is registered already, and a look back of two days, the oldest hundred."""
    at = F.col("ingestion_timestamp")
    names = v.table("temp_vehicle_events_stage").where(at.isNotNull()).select(F.concat(F.lit("snap/"), F.date_format(at, "yyyy-MM-dd"), F.lit("/"), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit(".pb")).alias("path"), F.unix_seconds(at).alias("s")).distinct()
    registered = names.where("s % 4 = 0").select(F.col("path").alias("object_name"))
    newest = F.timestamp_seconds(F.lit(names.agg(F.max("s")).first()[0]))  # one value
    files = snapshots.candidate_files(names.select("path"), registered, newest - F.expr("interval 2 days"), 100)
    return files.select("path", F.unix_micros("ingestion_timestamp").alias("at_us"))


@query("s24_history_files", "select count(distinct content) as files, sum(n)::bigint as bytes from (select n_comment as content, max(octet_length(encode(n_comment))) as n from (select case when n_nationkey % 5 = 0 then 'same' else n_name end as n_comment from nation) group by 1)")
def _(v: Views) -> DataFrame:
    """Files taken once by their content, whatever their names, also over two goes."""
    from headwaykit.sources.landing import new_history_files

    path = scratch(v.spark, "taken")
    content = F.when(F.col("n_nationkey") % 5 == 0, "same").otherwise(F.col("n_name"))
    files = v.table("nation").select(F.col("n_nationkey").cast("string").alias("path"), F.encode(content, "UTF-8").alias("content"))
    both = new_history_files(files.where("path < '3'"), path).unionByName(new_history_files(files, path))
    return both.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query("f17_blank_as_null", """select feature_row, try_cast(nullif(trim(scheduled_arrival), '') as int)::varchar as seconds, nullif(trim(scheduled_arrival), '') is null as is_blank from realtime_stop_features""")
def _(v: Views) -> DataFrame:
    given = F.nullif(F.trim("scheduled_arrival"), F.lit(""))
    whole = F.when(given.rlike(r"\A[+-]?\d+\z"), given.try_cast("int"))
    return v.table("realtime_stop_features").select("feature_row", whole.cast("string").alias("seconds"), given.isNull().alias("is_blank"))


@query("f12_stamped", """select feature_row, (case when feature_row % 2 = 0 then timestamptz '2026-01-01 00:00:00+00' else timestamptz '2026-02-01 00:00:00+00' end)::varchar as created, (timestamptz '2026-02-01 00:00:00+00')::varchar as updated from realtime_stop_features""".replace("::varchar as created", "::date::varchar as created").replace("::varchar as updated", "::date::varchar as updated"))
def _(v: Views) -> DataFrame:
    """Rows stamped by two runs: those of the first keep their time of creation."""
    from headwaykit.functions.timeutil import stamped

    rows = v.table("realtime_stop_features").select("feature_row")
    first = stamped(rows.where("feature_row % 2 = 0"), datetime(2026, 1, 1, tzinfo=timezone.utc))
    return stamped(rows, datetime(2026, 2, 1, tzinfo=timezone.utc), first, ["feature_row"]).select("feature_row", text(F.to_date("created_at"), "created"), text(F.to_date("updated_at"), "updated"))


# --- Streams, run to the end of their input ----------------------------------------------------------------------------


def _stage_stream(v: Views) -> tuple[DataFrame, str]:
    """The staged rows as a stream of files, three micro-batches and more, and a place for what it leaves."""
    path = scratch(v.spark, "stream")
    rows = v.table("temp_vehicle_events_stage").where("ingestion_timestamp is not null")
    rows.repartitionByRange(3, "ingestion_timestamp").write.parquet(f"{path}/in")
    return v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), path


@query("t1_landed_events", "select event_key, 1 as copies from ev where ingestion_timestamp is not null and event_key is not null", "ev")
def _(v: Views) -> DataFrame:
    """Micro-batches landed one after the other, and the whole stream a second time."""
    from headwaykit.streaming.live import land_events

    stream, path = _stage_stream(v)
    for check in ("a", "b"):
        land_events(stream, f"{path}/table", f"{path}/{check}").awaitTermination()
    return v.spark.read.parquet(f"{path}/table").where("length(event_key) = 64").groupBy("event_key").agg(F.count("*").cast("int").alias("copies"))


@query("t3_pane_updates", None)
def _(v: Views) -> DataFrame:
    """p2's half-hour windows, kept up to date by micro-batches: each window as it was last given out."""
    from headwaykit.streaming.live import pane_updates

    stream, path = _stage_stream(v)
    give = lambda windows, number: windows.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/given/n={number}")
    pane_updates(stream, f"{path}/state", give, f"{path}/check", window_s=1800, slide_s=900).awaitTermination()
    counts = ["published_count", "corrected_count", "too_late_count"]
    last = v.spark.read.parquet(f"{path}/given").groupBy("route_id", "period_start_s").agg(F.max_by(F.struct(*counts), "_batch").alias("w"))
    return last.select("route_id", "period_start_s", "w.*").where("corrected_count + too_late_count > 0")


@query("t5_live_scores", "select feed_checksum, service_date::varchar as service_date, trip_id, stop_sequence, stop_id, cls as stop_classification from csc", "csc")
def _(v: Views) -> DataFrame:
    """The live chain on the stream: every micro-batch's trips matched, inferred and scored again."""
    from headwaykit.streaming.live import live_scores

    stream, path = _stage_stream(v)
    base = written(baselines.stop_baselines(v.historical_features().where("baseline_eligible"), "arrival_delay_seconds"), "baselines")
    live_scores(stream, f"{path}/events", lambda spark: v.schedule(), lambda spark: base, f"{path}/scores", f"{path}/check").awaitTermination()
    return v.spark.read.parquet(f"{path}/scores").select("feed_checksum", text("service_date"), "trip_id", "stop_sequence", "stop_id", "stop_classification")


# --- Matching, predicates, functions -----------------------------------------------------------------------------


@query("j3_wall_clock_match", """select event_key, feed_checksum, service_date::varchar as service_date, trip_id, stop_sequence, diff as difference_seconds from (
    select *, row_number() over (partition by event_key order by diff, service_date desc, feed_checksum) as rn from (
      select e.event_key, i.feed_checksum, i.service_date, e.trip_id, e.current_stop_sequence as stop_sequence,
        abs(epoch_us(timezone('America/New_York', e.vehicle_timestamp)) - epoch_us(i.service_date::timestamp + to_seconds(t.s))) / 1e6 as diff
      from temp_schedule_match_events e join (select distinct feed_checksum, service_date, trip_id from gtfs_stop_instances) i on i.trip_id = e.trip_id
        and i.service_date between cast(timezone('America/New_York', e.vehicle_timestamp) as date) - 1 and cast(timezone('America/New_York', e.vehicle_timestamp) as date) + 1
      join (select distinct feed_checksum, trip_id, stop_sequence, coalesce(arrival_seconds, departure_seconds) as s from gtfs_stop_instances) t
        on t.feed_checksum = i.feed_checksum and t.trip_id = i.trip_id and t.stop_sequence = e.current_stop_sequence where t.s is not null)) where rn = 1""")
def _(v: Views) -> DataFrame:
    """Trips' instances and stop times apart, differences between wall clocks."""
    rows = v.schedule()
    trips = rows.select("feed_checksum", "service_date", "trip_id").distinct()
    times = rows.select("feed_checksum", "trip_id", "stop_sequence", "arrival_seconds", "departure_seconds").distinct()
    return matching.match_wall_clocks(v.table("temp_schedule_match_events"), trips, times).select("event_key", "feed_checksum", text("service_date"), "trip_id", "stop_sequence", "difference_seconds")


@query("filter_affected_trips", """select t.feed_checksum, t.service_date::varchar as service_date, t.trip_id from ti t left join rt r on r.feed_checksum = t.feed_checksum and r.service_date = t.service_date and r.trip_id = t.trip_id
    where t.service_date in (select service_date from m where ingestion_timestamp >= (select max(ingestion_timestamp) - interval 30 minute from m)) or r.o0 is null or r.q0 is null""", "ti", "rt")
def _(v: Views) -> DataFrame:
    since = v.matches().agg(F.max("event_ingestion_timestamp")).first()[0]  # one value
    days = v.matches().where(F.col("event_ingestion_timestamp") >= F.lit(since) - F.expr("interval 30 minutes"))
    return coverage.affected_trips(_operations(v), days, ["first_observation", "first_stop_sequence"]).select("feed_checksum", text("service_date"), "trip_id")


@query("filter_planned_visits", """select route_id, direction_id, stop_id, is_weekend, count(*) as n, quantile_cont(arrival_deviation_seconds, 0.5) as median_seconds from historical_stop_features
    where trip_type = 'SCHEDULED' and arrival_deviation_seconds is not null and not isnan(arrival_deviation_seconds) group by all""")
def _(v: Views) -> DataFrame:
    rows = baselines.metric_baselines(baselines.planned_visits(v.table("historical_stop_features"), ["SCHEDULED"]), baselines.KEYS, ["arrival_deviation_seconds"])
    return rows.select(*baselines.KEYS, F.col("observation_count").alias("n"), F.col("arrival_deviation_seconds_median").alias("median_seconds"))


@query("a16_duplicate_counts", """select count(*) as duplicate_groups, coalesce(sum(n), 0)::bigint as duplicate_rows, coalesce(max(n), 0) as most_rows from (
    select count(*) as n from historical_stop_features group by service_date, trip_id, stop_sequence, stop_id having count(*) > 1)""")
def _(v: Views) -> DataFrame:
    return dedup.duplicate_counts(v.table("historical_stop_features"), VISIT)


@query("a17_kept_row", """select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, epoch_us(updated_at)::varchar as kept_us, first_us::varchar as first_us, headway::varchar as headway_branch_seconds from (
    select *, row_number() over (partition by service_date, trip_id, stop_sequence, stop_id order by (headway is not null)::int + (vehicle_id is not null)::int + (observed_arrival is not null)::int desc, updated_at desc) as rn,
      min(epoch_us(observed_arrival)) over (partition by service_date, trip_id, stop_sequence, stop_id) as first_us
    from (select *, case when stop_sequence % 3 = 0 and day(updated_at) % 2 = 0 then null else headway_branch_seconds end as headway from historical_stop_features)) where rn = 1""")
def _(v: Views) -> DataFrame:
    """Of a visit's rows the one with most values, then the later one, but with the earliest arrival of all."""
    rows = v.table("historical_stop_features").select(
        *VISIT, "vehicle_id", "observed_arrival", "updated_at", F.when((F.col("stop_sequence") % 3 == 0) & (F.day("updated_at") % 2 == 0), None).otherwise(F.col("headway_branch_seconds")).alias("headway_branch_seconds")
    )
    folded = dedup.fold_rows(rows, VISIT, ["observed_arrival"], ["updated_at"])
    return folded.select(text("service_date"), "trip_id", "stop_sequence", "stop_id", epoch("updated_at", "kept_us"), epoch("observed_arrival", "first_us"), text("headway_branch_seconds"))


@query("o4_sorted_sample", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id from hist order by service_date, trip_id, stop_sequence, stop_id limit 20", "hist")
def _(v: Views) -> DataFrame:
    return quality.sorted_sample(v.history(), VISIT).select(text("service_date"), "trip_id", "stop_sequence", "stop_id")


@query("q16_schema", """select row_number() over () as position, column_name, case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'BOOLEAN' then 'boolean'
    when 'DATE' then 'date' when 'TIMESTAMP WITH TIME ZONE' then 'timestamp' when 'TIMESTAMP' then 'timestamp_ntz' else column_type end as kind from (describe select * from historical_stop_features)""")
def _(v: Views) -> DataFrame:
    return quality.schema_of(v.table("historical_stop_features"))


@query("f18_labels", """select distinct current_status::varchar as current_status, local_hour, h.status_name as status_name, list_reduce(list_transform(string_split(lower(h.status_name), '_'), lambda w: upper(w[1]) || w[2:]), lambda a, b: a || ' ' || b) as label,
    case when local_hour is null then '' else (case when local_hour % 12 = 0 then 12 else local_hour % 12 end) || ' ' || (case when local_hour < 12 then 'AM' else 'PM' end) end as hour_label from (
    select current_status, extract(hour from timezone('America/New_York', vehicle_timestamp)) as local_hour, case current_status when 0 then 'INCOMING_AT' when 1 then 'STOPPED_AT' when 2 then 'IN_TRANSIT_TO' else 'UNKNOWN' end as status_name from ev) h""", "ev")
def _(v: Views) -> DataFrame:
    from headwaykit.functions.timeutil import local_hour

    name, hour = quality.status_name(F.col("current_status")), local_hour(F.col("vehicle_timestamp"))
    return v.events().select(text("current_status"), hour.cast("long").alias("local_hour"), name.alias("status_name"), serving.readable_label(name).alias("label"), serving.hour_label(hour).alias("hour_label")).distinct()


# --- Monitoring ----------------------------------------------------------------------------------------------------

_RECENT = "(select * from ev where ingestion_timestamp >= (select max(ingestion_timestamp) from ev) - interval {0} minute)".format


@query("t9_recent_order", f"""select count(*) filter (where no > 1 and a is not null) as step_count, count(*) filter (where b < a) as out_of_order_count from (select vehicle_timestamp as b, lag(vehicle_timestamp) over w as a, row_number() over w as no
    from {_RECENT(120)} where vehicle_id is not null window w as (partition by vehicle_id order by ingestion_timestamp, stage_row))""", "ev")
def _(v: Views) -> DataFrame:
    return quality.out_of_order(quality.recent(v.events(), 120), ["ingestion_timestamp", "stage_row"])


@query("t9_recent_transitions", f"""select count(*) as step_count, count(*) filter (where b < a) as backward_count, 100.0 * count(*) filter (where b < a) / nullif(count(*), 0) as backward_percent from (
    select current_stop_sequence as b, lag(current_stop_sequence) over (partition by vehicle_id, trip_id order by vehicle_timestamp, event_key) as a
    from {_RECENT(1440)} where vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null) where a is not null and b is not null""", "ev")
def _(v: Views) -> DataFrame:
    rows = quality.recent(v.events(), 1440).where("vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null")
    return quality.transitions(rows, ["vehicle_timestamp", "event_key"])


@query("t10_match_freshness", """select match_source, count(*) as n, epoch_us(max(ingestion_timestamp)) as last_us, (select max(epoch_us(ingestion_timestamp)) from ev) // 1000000 - epoch_us(max(ingestion_timestamp)) // 1000000 as age_seconds from mu group by match_source""", "mu")
def _(v: Views) -> DataFrame:
    m = v.matches().withColumn("created_at", F.col("event_ingestion_timestamp"))
    both = matching.union_matches(m.where("stop_sequence % 2 = 0"), m)
    return serving.freshness(both, "match_source", "event_ingestion_timestamp", v.events().agg(F.max("ingestion_timestamp")).first()[0])


@query("t10_event_freshness", "select count(*) as n, epoch_us(max(ingestion_timestamp)) as last_us, (epoch_us(timestamptz '2027-01-01 00:00:00+00') - epoch_us(max(ingestion_timestamp))) // 1000000 as age_seconds from ev", "ev")
def _(v: Views) -> DataFrame:
    return serving.freshness(v.events().withColumn("_all", F.lit(1)), "_all", "ingestion_timestamp", datetime(2027, 1, 1, tzinfo=timezone.utc)).drop("_all")


# --- Dashboards ------------------------------------------------------------------------------------------------------


def _daily(v: Views) -> DataFrame:
    return rollups.route_daily(rollups.trip_anomalies(_scores(v)))


def _signed_trips(v: Views) -> DataFrame:
    return rollups.signed_trip_class(rollups.signed_trip_summary(_signed(v)))


@query("v1_dates_in_order", "select service_date::varchar as service_date, row_number() over (order by service_date desc) as place from (select distinct service_date from daily where route_id in (select distinct route_id from daily order by 1 limit 8))", "daily")
def _(v: Views) -> DataFrame:
    """Dates of eight routes, newest first."""
    routes = [r[0] for r in _daily(v).select("route_id").distinct().orderBy("route_id").limit(8).collect()]
    return serving.ranked(serving.service_dates(_daily(v), routes), [F.desc("service_date")]).select(text("service_date"), "place")


@query("v2_totals_in_order", """select *, row_number() over (order by sustained_rate_percent desc nulls last, route_id) as place from (select route_id, 100.0 * sum(sustained_late_trip_count) / nullif(sum(evaluable_trip_count), 0) as sustained_rate_percent
    from daily where service_date = (select max(service_date) from daily) group by route_id)""", "daily")
def _(v: Views) -> DataFrame:
    rows = serving.route_totals(_daily(v), serving.latest_date(_daily(v))).select("route_id", "sustained_rate_percent")
    return serving.ranked(rows, [F.desc_nulls_last("sustained_rate_percent"), F.col("route_id").asc()])


@query("v4_trips_in_order", """select route_id, service_date::varchar as service_date, trip_id, row_number() over (partition by route_id, service_date order by case trip_classification when 'SUSTAINED_LATE' then 0 when 'NORMAL' then 1 when 'INSUFFICIENT_COVERAGE' then 2 else 3 end,
    anomaly_percent desc nulls last, trip_id) as place from trips""", "trips")
def _(v: Views) -> DataFrame:
    rows = rollups.trip_anomalies(_scores(v))
    return serving.ranked(rows, serving.trip_order(), within=["route_id", "service_date"]).select("route_id", text("service_date"), "trip_id", "place")


@query("v7_date_totals", """select service_date::varchar as service_date, o as observed_trips, e as evaluable_trips, service_date = (select service_date from (select service_date, sum(evaluable_trips) as e from tsd group by 1) order by (e > 0) desc, service_date desc limit 1) as is_default
    from (select service_date, sum(observed_trips)::bigint as o, sum(evaluable_trips)::bigint as e from tsd group by service_date)""", "tsd")
def _(v: Views) -> DataFrame:
    return serving.date_totals(rollups.signed_route_daily(_signed_trips(v))).withColumn("service_date", F.col("service_date").cast("string"))


@query("v7_kpis", """select sum(observed_trips)::bigint as observed_trips, sum(evaluable_trips)::bigint as evaluable_trips, 100.0 * sum(odd) / nullif(sum(evaluable_trips), 0) as sustained_anomaly_pct, 100.0 * sum(thin) / nullif(sum(observed_trips), 0) as insufficient_coverage_pct
    from tsd where service_date = (select max(service_date) from tsd)""", "tsd")
def _(v: Views) -> DataFrame:
    rows = rollups.signed_route_daily(_signed_trips(v))
    return serving.signed_kpis(rows, serving.latest_date(rows))


@query("v7_trip_table", """select t.feed_checksum, t.service_date::varchar as service_date, t.trip_id, h.trip_headsign, cls as trip_classification from (select feed_checksum, service_date, trip_id, trip_classification as cls from ctrips) t
    left join heads h on h.feed_checksum = t.feed_checksum and h.trip_id = t.trip_id""", "ctrips", "heads")
def _(v: Views) -> DataFrame:
    return serving.trips_with_headsign(rollups.trip_anomalies(_chain(v)), _headsigns(v)).select("feed_checksum", text("service_date"), "trip_id", "trip_headsign", "trip_classification")


@query("v7_direction_labels", """select route_id, direction_id, trip_headsign || ' (Dir ' || direction_id || ')' as direction_label, n from (select *, row_number() over (partition by route_id, direction_id order by n desc, trip_headsign) as rn from (
    select t.route_id, t.direction_id, trip_headsign, count(*) as n from ti t join heads h on h.feed_checksum = t.feed_checksum and h.trip_id = t.trip_id where trim(trip_headsign) <> '' group by all)) where rn = 1""", "ti", "heads")
def _(v: Views) -> DataFrame:
    return serving.direction_labels(_instances(v), _headsigns(v)).select("route_id", "direction_id", "direction_label", "n")


@query("v7_stop_table", """select s.feed_checksum, s.service_date::varchar as service_date, s.trip_id, s.stop_sequence, s.stop_id, coalesce(p.stop_name, c.stop_name, s.stop_id) as station_name, s.cls as stop_classification from csc s
    left join places c on c.feed_checksum = s.feed_checksum and c.stop_id = s.stop_id left join places p on p.feed_checksum = c.feed_checksum and p.stop_id = c.parent_station""", "csc", "places")
def _(v: Views) -> DataFrame:
    rows = serving.stops_with_station(_chain(v), _places(v))
    return rows.select("feed_checksum", text("service_date"), "trip_id", "stop_sequence", "stop_id", "station_name", "stop_classification")


# --- Assertions --------------------------------------------------------------------------------------------------------

#: What each assertion counts, over the blocks that state its table.
_CHECKS = {
    "matches_unique": "select event_key from m group by event_key having count(*) > 1",
    "matches_valid": "select 1 from m where event_key is null or feed_checksum is null or service_date is null or trip_id is null or diff < 0",
    "matches_have_events": "select 1 from m where event_key not in (select event_key from ev where event_key is not null)",
    "stops_unique": "select 1 from stops group by feed_checksum, service_date, trip_id, stop_sequence, stop_id having count(*) > 1",
    "stops_quality": "select 1 from stops where inference_quality is null or inference_quality not in ('COMPLETE', 'PARTIAL', 'MULTIPLE_VEHICLES', 'MULTIPLE_STOP_PERIODS', 'NO_STOP_OBSERVATION')",
    "stops_uncertainty": "select 1 from stops where arrival_uncertainty_seconds < 0 union all select 1 from stops where departure_uncertainty_seconds < 0",
    "scores_class": "select 1 from sc where cls is null or cls not in ('CERTAIN_LATE', 'POSSIBLE_LATE', 'NORMAL', 'NOT_EVALUABLE')",
    "scores_fence": "select 1 from sc where cls = 'CERTAIN_LATE' and not coalesce(dev_lower > high, false)",
    "route_hour_unique": "select 1 from hourly group by service_date, route_id, direction_id, service_hour having count(*) > 1",
    "route_hour_rate": "select 1 from hourly where anomaly_rate_percent < 0 or anomaly_rate_percent > 100",
    "baselines_unique": "select 1 from bl group by lvl, route_id, direction_id, stop_id, is_weekend, service_hour having count(*) > 1",
    "baselines_valid": "select 1 from bl where not coalesce(n >= 30 and q1 <= med and med <= q3 and iqr >= 0, false)",
    "history_unique": "select 1 from hist group by service_date, trip_id, stop_sequence, stop_id having count(*) > 1",
}

_counted = lambda checks: " union all ".join(f"select '{name}' as assertion, count(*) as violations from ({body})" for name, body in checks.items())
assert list(_CHECKS) == ASSERTIONS


def assertions_sql() -> str:
    return sql(_counted(_CHECKS), "m", "ev", "stops", "sc", "hourly", "bl", "hist")


_DIRTY = {
    "events_unique": "select ek from keyed where ek is not null group by ek having count(*) > 1",
    "events_known": "select 1 from keyed where vehicle_id is null or trip_id is null or vehicle_timestamp is null",
    "events_status": "select 1 from keyed where current_status is null or current_status not in (0, 1)",
    "events_position": "select 1 from keyed where latitude < -90 or latitude > 90 union all select 1 from keyed where longitude < -80 or longitude > -60",
    "events_order": "select 1 from keyed where not coalesce(vehicle_timestamp <= ingestion_timestamp and feed_timestamp <= ingestion_timestamp, false)",
    "events_scheduled": "select 1 from keyed k where not exists (select 1 from gtfs_stop_instances g where g.trip_id = k.trip_id)",
    "visits_unique": "select 1 from historical_stop_features group by service_date, trip_id, stop_sequence, stop_id having count(*) > 1",
    "visits_timed": "select 1 from historical_stop_features where not coalesce(observed_departure >= observed_arrival, false)",
    "instances_unique": "select 1 from gtfs_stop_instances group by service_date, trip_id, stop_sequence having count(*) > 1",
}


@query("q_assertions_dirty", _counted(_DIRTY), "keyed")
def _(v: Views) -> DataFrame:
    """The same kinds of assertions over the raw tables, which violate them."""
    stage = v.table("temp_vehicle_events_stage").withColumn("ek", dedup.event_identity(F.col("event_key"), F.col("stage_row")))
    visits, instances = v.table("historical_stop_features"), v.schedule()
    north, east = quality.within(stage, "latitude", -90, 90), quality.within(stage, "longitude", -80, -60)
    checks = {
        "events_unique": quality.unique(stage, ["ek"]),
        "events_known": quality.never_null(stage, ["vehicle_id", "trip_id", "vehicle_timestamp"]),
        "events_status": quality.one_of(stage, "current_status", [0, 1]),
        "events_position": north.unionByName(east),
        "events_order": quality.holds(stage, (F.col("vehicle_timestamp") <= F.col("ingestion_timestamp")) & (F.col("feed_timestamp") <= F.col("ingestion_timestamp"))),
        "events_scheduled": quality.references(stage, instances, ["trip_id"]),
        "visits_unique": quality.unique(visits, VISIT),
        "visits_timed": quality.holds(visits, F.col("observed_departure") >= F.col("observed_arrival")),
        "instances_unique": quality.unique(instances, ["service_date", "trip_id", "stop_sequence"]),
    }
    return quality.violations(checks)

