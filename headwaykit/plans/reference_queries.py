"""Queries of the reference pipeline over the test tables, each with SQL that states the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import clock_seconds, epoch_or_null, fractional_seconds, is_weekend, iso_day, local_date, local_hour, localise, seconds_between
from headwaykit.operators import baselines, calendar, coverage, dedup, matching, performance, quality, rollups, scoring, serving, upsert
from headwaykit.operators.inference import infer_stops
from headwaykit.operators.matching import GRAIN
from headwaykit.plans.views import VISIT, Views
from headwaykit.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# --- SQL building blocks: name -> (names it needs, body) -------------------------------------------------

BLOCKS: dict[str, tuple[list[str], str]] = {
    "keyed": ([], "select *, right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) as ek from temp_vehicle_events_stage"),
    "ev": (["keyed"], """select * exclude (rn, event_key, ek), ek as event_key from (select *, row_number() over (partition by ek
        order by ingestion_timestamp, feed_timestamp nulls last, entity_id nulls last, stage_row) as rn from keyed) where rn = 1"""),
    "cand": (["ev"], """select e.event_key, e.ingestion_timestamp, s.feed_checksum, s.service_date, e.trip_id, s.stop_sequence,
        coalesce(s.scheduled_arrival_local, s.scheduled_departure_local) as slt,
        abs(datesub('second', timezone('America/New_York', coalesce(s.scheduled_arrival_local, s.scheduled_departure_local)), e.vehicle_timestamp)) as diff
        from ev e join gtfs_stop_instances s on s.trip_id = e.trip_id and s.stop_sequence = e.current_stop_sequence
          and abs(datediff('day', s.service_date, cast(timezone('America/New_York', e.vehicle_timestamp) as date))) <= 1
        where e.schedule_relationship = 'SCHEDULED' and e.vehicle_timestamp is not null and e.current_stop_sequence > 0
          and coalesce(s.scheduled_arrival_local, s.scheduled_departure_local) is not null"""),
    "m": (["cand"], """select * exclude (rn) from (select *, row_number() over (partition by event_key order by diff, service_date desc, feed_checksum) as rn from cand) where rn = 1"""),
    "obs": (["m"], """select m.event_key, m.feed_checksum, m.service_date, m.trip_id, m.stop_sequence, e.stop_id, e.vehicle_id, e.route_id, e.direction_id, m.slt,
        e.current_status as st, e.vehicle_timestamp as ts
        from m join ev e on e.event_key = m.event_key and e.ingestion_timestamp = m.ingestion_timestamp
        where e.vehicle_timestamp is not null and e.stop_id is not null"""),
    "nb": (["obs"], """select *, lag(ts) over w as pts, lag(st) over w as pst, lag(stop_sequence) over w as pseq, lag(stop_id) over w as pstop,
        lead(ts) over w as nts, lead(st) over w as nst, lead(stop_sequence) over w as nseq
        from obs window w as (partition by feed_checksum, service_date, trip_id, vehicle_id order by ts, event_key)"""),
    "nbx": (["nb"], """select *, case when pst in (0, 2) and pseq = stop_sequence and pstop = stop_id then 'SAME_STOP_TRANSITION' when pseq < stop_sequence then 'PREVIOUS_STOP' else 'UNBOUNDED' end as method,
        case when nst in (0, 2) and nseq >= stop_sequence then nts end as upper_ts,
        (st = 1 and not coalesce(pst = 1 and pseq = stop_sequence and pstop = stop_id, false)) as new_period,
        row_number() over (partition by feed_checksum, service_date, trip_id, stop_sequence, stop_id, st = 1 order by ts, event_key) as first_no,
        row_number() over (partition by feed_checksum, service_date, trip_id, stop_sequence, stop_id, st = 1 order by ts desc, event_key desc) as last_no from nb"""),
    "stops": (["nbx"], """select *, case when vehicle_count > 1 then 'MULTIPLE_VEHICLES' when stopped_observation_count = 0 then 'NO_STOP_OBSERVATION' when stopped_period_count > 1 then 'MULTIPLE_STOP_PERIODS'
        when arrival_lower is not null and departure_upper is not null then 'COMPLETE' else 'PARTIAL' end as inference_quality,
        datesub('second', arrival_lower, arrival) as arrival_uncertainty_seconds, datesub('second', departure_lower, departure_upper) as departure_uncertainty_seconds from (
        select feed_checksum, service_date, trip_id, stop_sequence, stop_id, max(route_id) as route_id, max(direction_id) as direction_id,
        case when count(distinct vehicle_id) = 1 then max(vehicle_id) end as vehicle_id, count(distinct vehicle_id) as vehicle_count, min(slt) as slt,
        count(*) as total_observation_count, count(*) filter (where st = 1) as stopped_observation_count, count(*) filter (where new_period) as stopped_period_count,
        max(ts) filter (where st = 1 and first_no = 1) as arrival, max(case when method <> 'UNBOUNDED' then pts end) filter (where st = 1 and first_no = 1) as arrival_lower,
        coalesce(max(method) filter (where st = 1 and first_no = 1), 'NO_STOP_OBSERVATION') as method,
        max(ts) filter (where st = 1 and last_no = 1) as departure_lower, max(upper_ts) filter (where st = 1 and last_no = 1) as departure_upper
        from nbx group by all)"""),
    "perf": (["stops"], """select p.*, timezone('America/New_York', coalesce(s.scheduled_arrival_local, p.slt)) as scheduled_arrival, timezone('America/New_York', s.scheduled_departure_local) as scheduled_departure
        from stops p left join gtfs_stop_instances s on s.feed_checksum = p.feed_checksum and s.service_date = p.service_date and s.trip_id = p.trip_id and s.stop_sequence = p.stop_sequence and s.stop_id = p.stop_id"""),
    "dev": (["perf"], """select *, datesub('second', scheduled_arrival, arrival) as arrival_deviation_seconds, datesub('second', scheduled_arrival, arrival_lower) as arrival_deviation_lower_seconds,
        datesub('second', scheduled_arrival, arrival) as arrival_deviation_upper_seconds, datesub('second', scheduled_departure, departure_upper) as departure_deviation_seconds,
        datesub('second', scheduled_departure, departure_lower) as departure_deviation_lower_seconds, datesub('second', scheduled_departure, departure_upper) as departure_deviation_upper_seconds from perf"""),
    "mq": (["m"], """select m.feed_checksum, m.service_date, m.trip_id, m.stop_sequence, e.stop_id, median(diff) as med, max(diff) as most
        from m join ev e on e.event_key = m.event_key and e.ingestion_timestamp = m.ingestion_timestamp group by all"""),
    "rawh": ([], """select service_date, trip_id, stop_sequence, stop_id, route_id, direction_id, vehicle_id, observed_arrival as stop_ts,
        make_timestamptz((epoch_us(observed_arrival) // 1000000 - coalesce(travel_time_seconds, 60)) * 1000000) as move_ts,
        epoch_us(scheduled_arrival) // 1000000 - epoch_us(timezone('America/New_York', service_date::timestamp)) // 1000000 as sas,
        epoch_us(scheduled_departure) // 1000000 - epoch_us(timezone('America/New_York', service_date::timestamp)) // 1000000 as sds,
        travel_time_seconds, dwell_time_seconds, headway_branch_seconds, headway_trunk_seconds from historical_stop_features"""),
    "hist": (["rawh"], """select * exclude (rn) from (select *, row_number() over (partition by service_date, trip_id, stop_sequence, stop_id order by stop_ts nulls last, move_ts nulls last) as rn from rawh
        where service_date is not null and trip_id is not null and stop_sequence is not null and stop_id is not null) where rn = 1"""),
    "hperf": (["hist"], """select *, datesub('second', scheduled_arrival, stop_ts) as arrival_delay_seconds, datesub('second', scheduled_departure, departure_ts) as departure_delay_seconds,
        datesub('second', stop_ts, departure_ts) as dwell_estimate_seconds from (
        select *, timezone('America/New_York', service_date::timestamp + to_seconds(sas)) as scheduled_arrival, timezone('America/New_York', service_date::timestamp + to_seconds(sds)) as scheduled_departure,
        lead(move_ts) over w as departure_ts, lead(stop_id) over w as next_stop_id from hist window w as (partition by service_date, trip_id order by stop_sequence, stop_id))"""),
    "hfeat": (["hperf"], """select *, extract(hour from timezone('America/New_York', scheduled_arrival)) as service_hour, isodow(service_date) >= 6 as is_weekend, coalesce(departure_ts >= stop_ts, false) as sensible,
        arrival_delay_seconds is not null and coalesce(departure_ts >= stop_ts, false) as baseline_eligible from hperf"""),
    "vis": ([], """select *, dev - unsure as dev_lower, coalesce(dev is not null and unsure <= 60, false) as eligible from (
        select 'H' as feed_checksum, service_date, trip_id, stop_sequence, stop_id, route_id, direction_id, service_hour, isodow(service_date) >= 6 as is_weekend,
        case when not isnan(arrival_deviation_seconds) then floor(arrival_deviation_seconds)::bigint end as dev, (stop_sequence * 7 + length(trip_id) + day(service_date)) % 90 as unsure
        from (select *, row_number() over (partition by service_date, trip_id, stop_sequence, stop_id order by updated_at) as rn from historical_stop_features) where rn = 1)"""),
    "bl": (["vis"], """select *, q3 - q1 as iqr, q1 - 1.5::double * (q3 - q1) as low, q3 + 1.5::double * (q3 - q1) as high from (
        select 'HOURLY' as lvl, route_id, direction_id, stop_id, is_weekend, service_hour, count(*) as n, quantile_disc(dev, 0.25) as q1, quantile_disc(dev, 0.5) as med, quantile_disc(dev, 0.75) as q3
        from vis where dev is not null group by all having count(*) >= 30
        union all select 'FALLBACK', route_id, direction_id, stop_id, is_weekend, null, count(*), quantile_disc(dev, 0.25), quantile_disc(dev, 0.5), quantile_disc(dev, 0.75)
        from vis where dev is not null group by route_id, direction_id, stop_id, is_weekend having count(*) >= 30)"""),
    "sc": (["bl"], """select *, cls in ('CERTAIN_LATE', 'POSSIBLE_LATE') as anom from (select *,
        case when not eligible or high is null then 'NOT_EVALUABLE' when dev_lower > high then 'CERTAIN_LATE' when dev > high then 'POSSIBLE_LATE' else 'NORMAL' end as cls from (
        select v.*, coalesce(h.lvl, f.lvl) as lvl, coalesce(h.n, f.n) as n, coalesce(h.med, f.med) as med, coalesce(h.high, f.high) as high from vis v
        left join (from bl where lvl = 'HOURLY') h on h.route_id = v.route_id and h.direction_id = v.direction_id and h.stop_id = v.stop_id and h.is_weekend = v.is_weekend and h.service_hour = v.service_hour
        left join (from bl where lvl = 'FALLBACK') f on f.route_id = v.route_id and f.direction_id = v.direction_id and f.stop_id = v.stop_id and f.is_weekend = v.is_weekend))"""),
    "trips": (["sc"], """select *, case when observed_stop_count < 5 then 'INSUFFICIENT_COVERAGE' when anomalous_stop_count >= 3 and anomaly_percent >= 50 then 'SUSTAINED_LATE' else 'NORMAL' end as trip_classification from (
        select feed_checksum, service_date, trip_id, max(route_id) as route_id, max(direction_id) as direction_id, count(*) as inferred_stop_count,
        count(*) filter (where cls <> 'NOT_EVALUABLE') as observed_stop_count, count(*) filter (where anom) as anomalous_stop_count, count(*) filter (where cls = 'CERTAIN_LATE') as certain_late_stop_count,
        count(*) filter (where cls = 'POSSIBLE_LATE') as possible_late_stop_count, count(*) filter (where cls = 'NORMAL') as normal_stop_count,
        100.0 * count(*) filter (where anom) / nullif(count(*) filter (where cls <> 'NOT_EVALUABLE'), 0) as anomaly_percent,
        avg(dev) filter (where cls <> 'NOT_EVALUABLE') as avg_dev from sc group by feed_checksum, service_date, trip_id)"""),
    "daily": (["trips"], """select *, 100.0 * sustained_late_trip_count / nullif(evaluable_trip_count, 0) as sustained_anomaly_rate_percent, 100.0 * insufficient_coverage_trip_count / observed_trip_count as insufficient_coverage_rate_percent from (
        select service_date, route_id, direction_id, count(*) as observed_trip_count, count(*) filter (where trip_classification <> 'INSUFFICIENT_COVERAGE') as evaluable_trip_count,
        count(*) filter (where trip_classification = 'SUSTAINED_LATE') as sustained_late_trip_count, count(*) filter (where trip_classification = 'NORMAL') as normal_trip_count,
        count(*) filter (where trip_classification = 'INSUFFICIENT_COVERAGE') as insufficient_coverage_trip_count from trips where route_id is not null and direction_id is not null group by all)"""),
    "hourly": (["sc"], """select *, case when observed_stop_count < 10 or distinct_trip_count < 3 then 'INSUFFICIENT_COVERAGE' when anomaly_rate_percent >= 50 then 'SUSTAINED_LATE' else 'NORMAL' end as route_hour_classification from (
        select service_date, route_id, direction_id, service_hour, count(*) as inferred_stop_count, count(*) filter (where cls <> 'NOT_EVALUABLE') as observed_stop_count,
        count(distinct case when cls <> 'NOT_EVALUABLE' then trip_id end) as distinct_trip_count, count(*) filter (where anom) as anomalous_stop_count,
        count(*) filter (where cls = 'CERTAIN_LATE') as certain_late_stop_count, count(*) filter (where cls = 'POSSIBLE_LATE') as possible_late_stop_count,
        100.0 * count(*) filter (where anom) / nullif(count(*) filter (where cls <> 'NOT_EVALUABLE'), 0) as anomaly_rate_percent, avg(dev) filter (where cls <> 'NOT_EVALUABLE') as avg_dev
        from sc where route_id is not null and direction_id is not null group by service_date, route_id, direction_id, service_hour)"""),
    "mb": (["vis"], """select route_id, direction_id, stop_id, is_weekend, service_hour, count(dev) as n, quantile_cont(dev, 0.5) as med, quantile_cont(dev, 0.25) as p25, quantile_cont(dev, 0.75) as p75 from vis group by all having count(dev) >= 30"""),
    "mf": (["vis"], """select route_id, direction_id, stop_id, is_weekend, count(dev) as n, quantile_cont(dev, 0.5) as med, quantile_cont(dev, 0.25) as p25, quantile_cont(dev, 0.75) as p75 from vis group by all having count(dev) >= 30"""),
    "sg": (["mb", "mf"], """select *, p75 - p25 as iqr, case when p75 - p25 <= 0 then null when dev > p75 then (dev - p75) / (p75 - p25) when dev < p25 then -(p25 - dev) / (p75 - p25) else 0 end as score,
        case when p75 - p25 <= 0 or p75 is null then 'UNSCORABLE' when dev - unsure > p75 + 1.5 * (p75 - p25) then 'CERTAIN_LATE' when dev < p25 - 1.5 * (p75 - p25) then 'CERTAIN_EARLY'
          when dev > p75 + 1.5 * (p75 - p25) then 'POSSIBLE_LATE' when dev - unsure < p25 - 1.5 * (p75 - p25) then 'POSSIBLE_EARLY' else 'NORMAL' end as status from (
        select v.*, case when h.n is not null then 'PRIMARY' else 'FALLBACK' end as btype, coalesce(h.med, f.med) as med, coalesce(h.p25, f.p25) as p25, coalesce(h.p75, f.p75) as p75 from (from vis where eligible) v
        left join mb h on h.route_id = v.route_id and h.direction_id = v.direction_id and h.stop_id = v.stop_id and h.is_weekend = v.is_weekend and h.service_hour = v.service_hour
        left join mf f on f.route_id = v.route_id and f.direction_id = v.direction_id and f.stop_id = v.stop_id and f.is_weekend = v.is_weekend where h.n is not null or f.n is not null)"""),
    "ts": (["sg"], """select *, case when observed_stop_count < 5 then 'INSUFFICIENT_COVERAGE' when anomalous_stop_count >= 3 and anomaly_stop_pct >= 50 then
          case when cl + pl > ce + pe then 'SUSTAINED_LATE' when ce + pe > cl + pl then 'SUSTAINED_EARLY' else 'SUSTAINED_MIXED' end
          when anomalous_stop_count > 0 then 'ISOLATED_OR_WEAK' else 'NORMAL' end as trip_anomaly_status from (
        select feed_checksum, service_date, trip_id, max(route_id) as route_id, max(direction_id) as direction_id, count(*) as observed_stop_count, count(*) filter (where status = 'NORMAL') as normal_stop_count,
        count(*) filter (where status = 'CERTAIN_LATE') as cl, count(*) filter (where status = 'CERTAIN_EARLY') as ce, count(*) filter (where status = 'POSSIBLE_LATE') as pl, count(*) filter (where status = 'POSSIBLE_EARLY') as pe,
        count(*) filter (where status <> 'NORMAL') as anomalous_stop_count, 100.0 * count(*) filter (where status <> 'NORMAL') / count(*) as anomaly_stop_pct,
        max(score) filter (where score > 0) as max_late_anomaly_score, min(score) filter (where score < 0) as max_early_anomaly_score,
        min(stop_sequence) filter (where status <> 'NORMAL') as first_anomalous_stop_sequence, max(stop_sequence) filter (where status <> 'NORMAL') as last_anomalous_stop_sequence from sg group by feed_checksum, service_date, trip_id)"""),
    "ti": ([], "select distinct feed_checksum, service_date, trip_id, max(route_id) as route_id, max(direction_id) as direction_id from gtfs_stop_instances group by all"),
    "tss": ([], """select feed_checksum, service_date, trip_id, min(coalesce(scheduled_departure_local, scheduled_arrival_local)) as s0, max(coalesce(scheduled_arrival_local, scheduled_departure_local)) as s1, count(*) as scheduled_stop_count
        from gtfs_stop_instances group by all"""),
    "rt": (["m"], """select m.feed_checksum, m.service_date, m.trip_id, min(e.vehicle_timestamp) as o0, max(e.vehicle_timestamp) as o1, count(*) as observation_count, count(distinct e.vehicle_id) as distinct_vehicle_count,
        min(e.current_stop_sequence) as q0, max(e.current_stop_sequence) as q1 from m join ev e on e.event_key = m.event_key and e.ingestion_timestamp = m.ingestion_timestamp group by all"""),
    "snap": ([], "select distinct ingestion_timestamp as ts from temp_vehicle_events_stage where ingestion_timestamp is not null"),
    "cw": (["snap"], """select min(ts) as w0, max(ts) as w1, count(*) as snapshot_count from (select ts, sum(fresh) over (order by ts rows unbounded preceding) as g from (
        select ts, case when lag(ts) over (order by ts) is null or ts - lag(ts) over (order by ts) > interval 90 second then 1 else 0 end as fresh from snap)) group by g"""),
}


def sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in BLOCKS[name][0]:
                add(need)
            order.append(name)

    for name in needs:
        add(name)
    return ("with " + ",\n".join(f"{n} as ({BLOCKS[n][1]})" for n in order) + "\n" if order else "") + final


def query(name: str, statement: str | None = None, *needs: str):
    def register(f: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Views(spark, folder))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if statement:
            SQL[name] = sql(statement, *needs)
        return f

    return register


def text(c: str | Column, name: str | None = None) -> Column:
    """Dates and integers that may be null as text, so that results compare alike everywhere."""
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("string").alias(name or c)


def epoch(c: str, name: str) -> Column:
    return F.unix_micros(c).cast("string").alias(name)


E_SQL = "epoch_us({0})::varchar as {1}".format

# --- S, P, W, A: reading, dedup, profiles ----------------------------------------------------------------


@query("d2_dedup_events", "select event_key, stage_row from ev", "ev")
def _(v: Views) -> DataFrame:
    return v.events().select("event_key", "stage_row")


@query("s15_insert_only", """select event_key, stage_row from ev where event_key not in
    (select right(regexp_replace(lower(event_key), '[^0-9a-f]', '', 'g'), 64) from vehicle_event_registry)""", "ev")
def _(v: Views) -> DataFrame:
    return dedup.dedup_events(v.table("temp_vehicle_events_stage"), v.table("vehicle_event_registry")).select("event_key", "stage_row")


@query("s16_upsert_merged", """with u as (select o_orderkey, o_custkey, o_orderstatus, -o_totalprice as o_totalprice from orders where o_orderkey % 3 = 0)
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey not in (select o_orderkey from u) union all select * from u""")
def _(v: Views) -> DataFrame:
    """Every third order restated, merged into the table by key."""
    stored = v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return upsert.merged(stored, stored.where("o_orderkey % 3 = 0").withColumn("o_totalprice", -F.col("o_totalprice")), ["o_orderkey"])


@query("s19_update_from", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when o_orderstatus = 'F' then o_totalprice else l_extendedprice end as l_extendedprice
    from lineitem left join orders on o_orderkey = l_orderkey and o_orderstatus = 'F'""")
def _(v: Views) -> DataFrame:
    updates = v.table("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("l_extendedprice"))
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return upsert.update_from(rows, updates, ["l_orderkey"], ["l_extendedprice"])


@query("w4_canonical_rows", """select * exclude (rn) from (select l_orderkey, l_linenumber, epoch_us(l_shipdate) as shipped, l_suppkey, l_partkey, l_quantity, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate, l_suppkey, l_partkey, l_quantity, l_extendedprice) as rn from lineitem) where rn = 1""")
def _(v: Views) -> DataFrame:
    kept = dedup.canonical_rows(v.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"])
    return kept.select("l_orderkey", "l_linenumber", F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("shipped"), "l_suppkey", "l_partkey", "l_quantity")


@query("w5_priority_dedup", """select event_key, match_source, diff::double as difference_seconds from (select *, row_number() over (partition by event_key order by case match_source when 'primary' then 0 else 1 end, ingestion_timestamp desc, feed_checksum, service_date) as rn from (
    select *, 'primary' as match_source from m where stop_sequence % 2 = 0 union all select *, 'secondary' from m)) where rn = 1""", "m")
def _(v: Views) -> DataFrame:
    m = v.matches().withColumn("created_at", F.col("event_ingestion_timestamp"))
    return matching.union_matches(m.where("stop_sequence % 2 = 0"), m).select("event_key", "match_source", "difference_seconds")


@query("a17_fold_rows", """select user_id, min(ts_us) as first_us, max(filled) as filled from (select user_id, epoch_us(ts) as ts_us, (value is not null)::int + (props is not null)::int + 3 as filled from events) group by user_id""")
def _(v: Views) -> DataFrame:
    rows = v.table("events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("first_us"), "event_id", "event_type", "value", "props")
    folded = dedup.fold_rows(rows, ["user_id"], ["first_us"], ["event_id"])
    return folded.select("user_id", "first_us", (F.col("value").isNotNull().cast("int") + F.col("props").isNotNull().cast("int") + 3).alias("filled"))


@query("a4_only_value", "select trip_id, case when count(distinct vehicle_id) = 1 then max(vehicle_id) end as vehicle_id, count(distinct vehicle_id) as vehicles from ev where trip_id is not null group by trip_id", "ev")
def _(v: Views) -> DataFrame:
    return v.events().where("trip_id is not null").groupBy("trip_id").agg(dedup.only_value(F.col("vehicle_id")).alias("vehicle_id"), F.count_distinct("vehicle_id").alias("vehicles"))


@query("a6_discrete_quantiles", "select l_suppkey, quantile_disc(l_extendedprice, 0.25) as q1, quantile_disc(l_extendedprice, 0.5) as q2, quantile_disc(l_extendedprice, 0.75) as q3, quantile_disc(l_extendedprice, 0.9) as q9 from lineitem group by l_suppkey")
def _(v: Views) -> DataFrame:
    q = F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75, 0.9], 10_000)
    return v.table("lineitem").groupBy("l_suppkey").agg(q.alias("q")).select("l_suppkey", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "q2", "q3", "q9"))])


@query("a7_exact_percentiles", """select l_suppkey, quantile_cont(l_extendedprice, 0.5) filter (where l_returnflag = 'R') as median_returned, quantile_cont(l_quantity, 0.95) as p95_quantity from lineitem group by l_suppkey""")
def _(v: Views) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    return v.table("lineitem").groupBy("l_suppkey").agg(F.percentile(returned, 0.5).alias("median_returned"), F.percentile("l_quantity", 0.95).alias("p95_quantity"))


@query("w6_lead_next_stop", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, next_stop_id from hperf", "hperf")
def _(v: Views) -> DataFrame:
    return performance.historical_events(v.history()).select(text("service_date"), "trip_id", "stop_sequence", "stop_id", "next_stop_id")


@query("o3_top_latency", """select event_key, vehicle_id, (epoch_us(feed_timestamp) - epoch_us(vehicle_timestamp)) / 1e6 as latency_seconds from ev where feed_timestamp is not null and vehicle_timestamp is not null
    order by latency_seconds desc, event_key limit 5""", "ev")
def _(v: Views) -> DataFrame:
    return quality.worst_latency(v.events())


@query("o5_union_distinct", "select trip_id from temp_vehicle_events_stage where trip_id is not null union select trip_id from gtfs_stop_instances")
def _(v: Views) -> DataFrame:
    return v.table("temp_vehicle_events_stage").where("trip_id is not null").select("trip_id").union(v.table("gtfs_stop_instances").select("trip_id")).distinct()


@query("j9_trips_without_schedule", "select distinct trip_id from temp_schedule_match_events e where not exists (select 1 from gtfs_stop_instances g where g.trip_id = e.trip_id)")
def _(v: Views) -> DataFrame:
    return v.table("temp_schedule_match_events").select("trip_id").distinct().join(v.schedule(), "trip_id", "left_anti")


@query("filter_trip_types", "select case when trip_id like 'ADDED-%' then 'ADDED' when trip_id like 'NONREV%' then 'NONREV' else 'PLANNED' end as trip_type, count(*) as n from ev where trip_id is not null group by all", "ev")
def _(v: Views) -> DataFrame:
    kind = F.when(F.col("trip_id").startswith("ADDED-"), "ADDED").when(F.col("trip_id").startswith("NONREV"), "NONREV").otherwise("PLANNED")
    return v.events().where("trip_id is not null").groupBy(kind.alias("trip_type")).agg(F.count("*").alias("n"))


@query("f_time_functions", """select stage_row, datesub('second', vehicle_timestamp, ingestion_timestamp) as whole_seconds, (epoch_us(ingestion_timestamp) - epoch_us(vehicle_timestamp)) / 1e6 as seconds,
    extract(hour from timezone('America/New_York', vehicle_timestamp)) as local_hour, cast(timezone('America/New_York', vehicle_timestamp) as date)::varchar as local_date,
    isodow(cast(timezone('America/New_York', vehicle_timestamp) as date)) as iso_day, isodow(cast(timezone('America/New_York', vehicle_timestamp) as date)) >= 6 as weekend
    from temp_vehicle_events_stage where vehicle_timestamp is not null""")
def _(v: Views) -> DataFrame:
    day = local_date(F.col("vehicle_timestamp"))
    return v.table("temp_vehicle_events_stage").where("vehicle_timestamp is not null").select(
        "stage_row", seconds_between(F.col("ingestion_timestamp"), F.col("vehicle_timestamp")).alias("whole_seconds"), fractional_seconds(F.col("ingestion_timestamp"), F.col("vehicle_timestamp")).alias("seconds"),
        local_hour(F.col("vehicle_timestamp")).cast("long").alias("local_hour"), text(day, "local_date"), iso_day(day).cast("long").alias("iso_day"), is_weekend(day).alias("weekend"),
    )


@query("f3_localise", "select distinct epoch_us(timezone('America/New_York', scheduled_departure_local)) as departure_us, epoch_us(service_date::timestamp + to_seconds(departure_seconds)) as wall_us from gtfs_stop_instances")
def _(v: Views) -> DataFrame:
    from headwaykit.functions.timeutil import service_wall

    wall = service_wall(F.col("service_date"), F.col("departure_seconds"))
    return v.table("gtfs_stop_instances").select(F.unix_micros(localise(F.col("scheduled_departure_local"))).alias("departure_us"), F.unix_micros(wall).alias("wall_us")).distinct()


@query("f19_clock_texts", """select feature_row, (split_part(trim(scheduled_arrival), ':', 1)::int * 3600 + split_part(trim(scheduled_arrival), ':', 2)::int * 60 + split_part(trim(scheduled_arrival), ':', 3)::int)::bigint as seconds
    from realtime_stop_features where regexp_full_match(trim(scheduled_arrival), '\\d{1,3}:\\d{2}:\\d{2}')""")
def _(v: Views) -> DataFrame:
    seconds = clock_seconds(F.col("scheduled_arrival")).cast("long")
    return v.table("realtime_stop_features").select("feature_row", seconds.alias("seconds")).where("seconds is not null")


@query("f10_epoch_or_null", "select stage_row, epoch_us(to_timestamp(nullif(s, 0)))::varchar as at_us from (select stage_row, (epoch_us(feed_timestamp) // 1000000) * (stage_row % 4 > 0)::int as s from temp_vehicle_events_stage)")
def _(v: Views) -> DataFrame:
    raw = F.unix_seconds("feed_timestamp") * (F.col("stage_row") % 4 > 0).cast("int")
    return v.table("temp_vehicle_events_stage").select("stage_row", F.unix_micros(epoch_or_null(raw)).cast("string").alias("at_us"))


# --- D: the pipeline ---------------------------------------------------------------------------------------


@query("d7_match_schedule", "select event_key, feed_checksum, service_date::varchar as service_date, trip_id, stop_sequence, diff::double as difference_seconds, epoch_us(slt) as scheduled_us from m", "m")
def _(v: Views) -> DataFrame:
    return v.matches().select("event_key", "feed_checksum", text("service_date"), "trip_id", "stop_sequence", "difference_seconds", F.unix_micros(F.col("scheduled_local_time").cast("timestamp")).alias("scheduled_us"))


D9 = ["feed_checksum", "trip_id", "stop_sequence", "stop_id", "route_id", "vehicle_id", "vehicle_count", "total_observation_count", "stopped_observation_count", "inference_quality"]


@query("d9_infer_stops", f"""select service_date::varchar as service_date, {', '.join(D9)}, direction_id::varchar as direction_id, method as arrival_bound_method, {E_SQL('arrival_lower', 'a0')}, {E_SQL('arrival', 'a1')},
    {E_SQL('departure_lower', 'd0')}, {E_SQL('departure_upper', 'd1')}, arrival_uncertainty_seconds::varchar as arrival_uncertainty_seconds, departure_uncertainty_seconds::varchar as departure_uncertainty_seconds from stops""", "stops")
def _(v: Views) -> DataFrame:
    return v.stops().select(
        text("service_date"), *D9, text("direction_id"), "arrival_bound_method", epoch("arrival_lower_bound", "a0"), epoch("arrival_estimate", "a1"), epoch("departure_lower_bound", "d0"),
        epoch("departure_upper_bound", "d1"), text("arrival_uncertainty_seconds"), text("departure_uncertainty_seconds"),
    )


DEV = [f"{w}_deviation{p}_seconds" for w in ("arrival", "departure") for p in ("", "_lower", "_upper")]


@query("d10_stop_performance", f"select feed_checksum, service_date::varchar as service_date, trip_id, stop_sequence, stop_id, {', '.join(f'{c}::varchar as {c}' for c in DEV)} from dev", "dev")
def _(v: Views) -> DataFrame:
    return v.performance().select("feed_checksum", text("service_date"), "trip_id", "stop_sequence", "stop_id", *map(text, DEV))


@query("d11_stop_features", """select d.feed_checksum, d.service_date::varchar as service_date, d.trip_id, d.stop_sequence, d.stop_id, med as schedule_match_median_difference_seconds, most::double as schedule_match_max_difference_seconds,
    coalesce(med > 3600, false) as schedule_match_anomaly, extract(hour from timezone('America/New_York', scheduled_arrival))::varchar as service_hour, isodow(d.service_date)::varchar as day_of_week, isodow(d.service_date) >= 6 as is_weekend,
    coalesce(arrival_deviation_seconds is not null and arrival_uncertainty_seconds <= 60 and inference_quality in ('COMPLETE', 'PARTIAL') and not coalesce(med > 3600, false), false) as scoring_eligible
    from dev d left join mq q on q.feed_checksum = d.feed_checksum and q.service_date = d.service_date and q.trip_id = d.trip_id and q.stop_sequence = d.stop_sequence and q.stop_id = d.stop_id""", "dev", "mq")
def _(v: Views) -> DataFrame:
    return v.features().select(
        "feed_checksum", text("service_date"), "trip_id", "stop_sequence", "stop_id", "schedule_match_median_difference_seconds", "schedule_match_max_difference_seconds", "schedule_match_anomaly",
        text("service_hour"), text("day_of_week"), "is_weekend", "scoring_eligible",
    )


@query("d12_score_stops", """select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, lvl as baseline_level, n::varchar as baseline_observation_count, med::varchar as median_delay_seconds, high as upper_anomaly_fence_seconds,
    cls as stop_classification, anom as is_anomalous, case when anom then dev - high end as seconds_above_upper_fence from sc""", "sc")
def _(v: Views) -> DataFrame:
    return scoring.score_stops(v.visits(), v.baselines()).select(
        text("service_date"), "trip_id", "stop_sequence", "stop_id", "baseline_level", text("baseline_observation_count"), text("median_delay_seconds"), "upper_anomaly_fence_seconds",
        "stop_classification", "is_anomalous", "seconds_above_upper_fence",
    )


def _scores(v: Views) -> DataFrame:
    return scoring.score_stops(v.visits(), v.baselines())


TRIP_COUNTS = ["inferred_stop_count", "observed_stop_count", "anomalous_stop_count", "certain_late_stop_count", "possible_late_stop_count"]


@query("d13_trip_anomalies", f"select service_date::varchar as service_date, trip_id, route_id, direction_id, {', '.join(TRIP_COUNTS)}, normal_stop_count, anomaly_percent, avg_dev as avg_arrival_deviation_seconds, trip_classification from trips", "trips")
def _(v: Views) -> DataFrame:
    return rollups.trip_anomalies(_scores(v)).select(text("service_date"), "trip_id", "route_id", "direction_id", *TRIP_COUNTS, "normal_stop_count", "anomaly_percent", "avg_arrival_deviation_seconds", "trip_classification")


@query("d14_route_hourly", f"select service_date::varchar as service_date, route_id, direction_id, service_hour, {', '.join(TRIP_COUNTS)}, distinct_trip_count, anomaly_rate_percent, avg_dev as avg_arrival_deviation_seconds, route_hour_classification from hourly", "hourly")
def _(v: Views) -> DataFrame:
    return rollups.route_hourly(_scores(v)).withColumn("service_date", F.col("service_date").cast("string"))


@query("d15_route_daily", "select service_date::varchar as service_date, * exclude (service_date) from daily", "daily")
def _(v: Views) -> DataFrame:
    return rollups.route_daily(rollups.trip_anomalies(_scores(v))).withColumn("service_date", F.col("service_date").cast("string"))


@query("d16_canonical_history", f"select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, route_id, {E_SQL('stop_ts', 'stop_us')}, {E_SQL('move_ts', 'move_us')}, sas::varchar as scheduled_arrival_seconds from hist", "hist")
def _(v: Views) -> DataFrame:
    return v.history().select(text("service_date"), "trip_id", "stop_sequence", "stop_id", "route_id", epoch("stop_timestamp", "stop_us"), epoch("move_timestamp", "move_us"), text("scheduled_arrival_seconds"))


@query("d18_historical_performance", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, arrival_delay_seconds::varchar as arrival_delay_seconds, departure_delay_seconds::varchar as departure_delay_seconds, dwell_estimate_seconds::varchar as dwell_estimate_seconds from hperf", "hperf")
def _(v: Views) -> DataFrame:
    return v.historical_features().select(text("service_date"), "trip_id", "stop_sequence", "stop_id", *map(text, ("arrival_delay_seconds", "departure_delay_seconds", "dwell_estimate_seconds")))


@query("d19_historical_features", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, service_hour::varchar as service_hour, is_weekend, sensible as has_sensible_stop_timing, baseline_eligible from hfeat", "hfeat")
def _(v: Views) -> DataFrame:
    return v.historical_features().select(text("service_date"), "trip_id", "stop_sequence", "stop_id", text("service_hour"), "is_weekend", "has_sensible_stop_timing", "baseline_eligible")


@query("d20_stop_baselines", "select lvl as baseline_level, route_id, direction_id, stop_id, is_weekend, service_hour::varchar as service_hour, n as observation_count, q1 as q1_delay_seconds, med as median_delay_seconds, q3 as q3_delay_seconds, iqr as iqr_delay_seconds, low as lower_anomaly_fence_seconds, high as upper_anomaly_fence_seconds from bl", "bl")
def _(v: Views) -> DataFrame:
    return v.baselines().withColumn("service_hour", F.col("service_hour").cast("string"))


MART = """count(*) as stop_event_count, count(distinct trip_id) as trip_count, count(distinct stop_id) as stop_count, avg(departure_delay_seconds) as avg_delay_seconds,
    quantile_disc(departure_delay_seconds, 0.5) as median_delay_seconds, quantile_disc(departure_delay_seconds, 0.9) as p90_delay_seconds, avg(abs(departure_delay_seconds)) as avg_abs_delay_seconds"""


@query("d21_historical_route_daily", f"select service_date::varchar as service_date, route_id, direction_id, {MART} from hfeat where departure_delay_seconds is not null group by 1, 2, 3", "hfeat")
def _(v: Views) -> DataFrame:
    return baselines.delay_marts(v.historical_features(), ["service_date", "route_id", "direction_id"], "departure_delay_seconds").withColumn("service_date", F.col("service_date").cast("string"))


@query("d21_historical_route_hourly", f"select service_date::varchar as service_date, route_id, direction_id, service_hour, {MART} from hfeat where departure_delay_seconds is not null group by 1, 2, 3, 4", "hfeat")
def _(v: Views) -> DataFrame:
    return baselines.delay_marts(v.historical_features(), ["service_date", "route_id", "direction_id", "service_hour"], "departure_delay_seconds").withColumn("service_date", F.col("service_date").cast("string"))


METRICS = ["arrival_deviation_seconds", "departure_deviation_seconds", "dwell_time_seconds", "travel_time_seconds", "headway_branch_seconds", "headway_trunk_seconds"]


def _metric_sql(m: str) -> str:
    x = f"case when not isnan({m}::double) then {m}::double end"
    return f"count({x}) as {m}_count, quantile_cont({x}, 0.5) as {m}_median, quantile_cont({x}, 0.25) as {m}_p25, quantile_cont({x}, 0.75) as {m}_p75"


@query("d22_metric_baselines", f"select route_id, direction_id, stop_id, is_weekend, count(*) as observation_count, {', '.join(map(_metric_sql, METRICS))} from historical_stop_features group by all")
def _(v: Views) -> DataFrame:
    return baselines.metric_baselines(v.table("historical_stop_features"), baselines.KEYS, METRICS)


@query("d22_metric_baselines_hourly", f"select route_id, direction_id, stop_id, is_weekend, service_hour, count(*) as observation_count, {', '.join(map(_metric_sql, METRICS))} from historical_stop_features group by all")
def _(v: Views) -> DataFrame:
    return baselines.metric_baselines(v.table("historical_stop_features"), [*baselines.KEYS, "service_hour"], METRICS)


def _signed(v: Views) -> DataFrame:
    visits = v.visits()
    side = lambda keys: baselines.metric_baselines(visits, keys, ["arrival_deviation_seconds"])
    return scoring.signed_scores(visits.where("scoring_eligible"), side([*baselines.KEYS, "service_hour"]), side(baselines.KEYS))


@query("d23_signed_scores", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, btype as baseline_type, med as baseline_median, score as anomaly_score, status as anomaly_status from sg", "sg")
def _(v: Views) -> DataFrame:
    return _signed(v).select(text("service_date"), "trip_id", "stop_sequence", "stop_id", "baseline_type", "baseline_median", "anomaly_score", "anomaly_status")


@query("d24_signed_trips", """select service_date::varchar as service_date, trip_id, route_id, observed_stop_count, normal_stop_count, cl as certain_late_stop_count, ce as certain_early_stop_count, pl as possible_late_stop_count, pe as possible_early_stop_count,
    anomalous_stop_count, anomaly_stop_pct, max_late_anomaly_score, max_early_anomaly_score, first_anomalous_stop_sequence::varchar as first_anomalous_stop_sequence, last_anomalous_stop_sequence::varchar as last_anomalous_stop_sequence, trip_anomaly_status from ts""", "ts")
def _(v: Views) -> DataFrame:
    rows = rollups.signed_trip_class(rollups.signed_trip_summary(_signed(v)))
    return rows.drop("feed_checksum", "direction_id").withColumns({c: F.col(c).cast("string") for c in ("service_date", "first_anomalous_stop_sequence", "last_anomalous_stop_sequence")})


R2 = "round((100.0 * {0} / nullif({1}, 0))::decimal(38,10), 2)::double as {2}".format


@query("d25_signed_route_hour", f"""select *, case when observed_stop_events < 10 or observed_trips < 3 then 'INSUFFICIENT_COVERAGE' when anomaly_stop_pct >= 50 then case when certain_late_pct > certain_early_pct then 'ANOMALOUS_LATE' when certain_early_pct > certain_late_pct then 'ANOMALOUS_EARLY' else 'ANOMALOUS_MIXED' end
    when anomaly_stop_pct > 0 then 'ELEVATED' else 'NORMAL' end as route_hour_status from (
    select service_date::varchar as service_date, route_id, direction_id, service_hour, count(*) as observed_stop_events, count(distinct trip_id) as observed_trips,
    {', '.join(f"count(*) filter (where status = '{s}') as {s.lower()}_stop_count" for s in ('NORMAL', 'CERTAIN_LATE', 'CERTAIN_EARLY', 'POSSIBLE_LATE', 'POSSIBLE_EARLY', 'UNSCORABLE'))},
    count(*) filter (where status not in ('NORMAL', 'UNSCORABLE')) as anomalous_stop_count,
    {R2("count(*) filter (where status = 'CERTAIN_LATE')", "count(*) filter (where status <> 'UNSCORABLE')", "certain_late_pct")}, {R2("count(*) filter (where status = 'CERTAIN_EARLY')", "count(*) filter (where status <> 'UNSCORABLE')", "certain_early_pct")},
    {R2("count(*) filter (where status not in ('NORMAL', 'UNSCORABLE'))", "count(*) filter (where status <> 'UNSCORABLE')", "anomaly_stop_pct")},
    round(quantile_cont(dev, 0.5)::decimal(38,10), 1)::double as median_arrival_deviation_seconds, round(quantile_cont(dev, 0.9)::decimal(38,10), 1)::double as p90_arrival_deviation_seconds, round(quantile_cont(med, 0.5)::decimal(38,10), 1)::double as historical_median_seconds,
    round(quantile_cont(abs(score), 0.5)::decimal(38,10), 2)::double as median_abs_anomaly_score, round(max(abs(score))::decimal(38,10), 2)::double as max_abs_anomaly_score, round(quantile_cont(unsure, 0.5)::decimal(38,10), 1)::double as median_arrival_uncertainty_seconds,
    count(*) filter (where btype = 'PRIMARY') as primary_baseline_count, count(*) filter (where btype = 'FALLBACK') as fallback_baseline_count, {R2("count(*) filter (where btype = 'FALLBACK')", "count(*)", "fallback_baseline_pct")}
    from sg group by 1, 2, 3, 4)""", "sg")
def _(v: Views) -> DataFrame:
    return rollups.signed_route_hour_class(rollups.signed_route_hour(_signed(v))).withColumn("service_date", F.col("service_date").cast("string"))


@query("d26_signed_route_daily", f"""select service_date::varchar as service_date, route_id, count(*) as observed_trips, count(*) filter (where trip_anomaly_status <> 'INSUFFICIENT_COVERAGE') as evaluable_trips,
    {', '.join(f"count(*) filter (where trip_anomaly_status = '{s}') as {s.lower()}_trips" for s in ('NORMAL', 'ISOLATED_OR_WEAK', 'SUSTAINED_LATE', 'SUSTAINED_EARLY', 'INSUFFICIENT_COVERAGE'))},
    {R2("count(*) filter (where trip_anomaly_status in ('SUSTAINED_LATE', 'SUSTAINED_EARLY'))", "count(*) filter (where trip_anomaly_status <> 'INSUFFICIENT_COVERAGE')", "sustained_anomaly_pct")},
    {R2("count(*) filter (where trip_anomaly_status = 'INSUFFICIENT_COVERAGE')", "count(*)", "insufficient_coverage_pct")}, round(quantile_cont(observed_stop_count, 0.5)::decimal(38,10), 1)::double as median_observed_stops from ts group by 1, 2""", "ts")
def _(v: Views) -> DataFrame:
    return rollups.signed_route_daily(rollups.signed_trip_class(rollups.signed_trip_summary(_signed(v)))).withColumn("service_date", F.col("service_date").cast("string"))


def _instances(v: Views) -> DataFrame:
    return v.schedule().groupBy("feed_checksum", "service_date", "trip_id").agg(F.max("route_id").alias("route_id"), F.max("direction_id").alias("direction_id"))


@query("d27_trip_realtime_summary", f"""select r.feed_checksum, r.service_date::varchar as service_date, r.trip_id, t.route_id, t.direction_id, {E_SQL('o0', 'first_us')}, {E_SQL('o1', 'last_us')}, observation_count, distinct_vehicle_count, q0::bigint as first_stop_sequence, q1::bigint as last_stop_sequence
    from rt r join ti t on t.feed_checksum = r.feed_checksum and t.service_date = r.service_date and t.trip_id = r.trip_id""", "rt", "ti")
def _(v: Views) -> DataFrame:
    rows = rollups.trip_realtime_summary(v.matches(), v.events(), _instances(v))
    return rows.select("feed_checksum", text("service_date"), "trip_id", "route_id", "direction_id", epoch("first_observation", "first_us"), epoch("last_observation", "last_us"), "observation_count", "distinct_vehicle_count", F.col("first_stop_sequence").cast("long").alias("first_stop_sequence"), F.col("last_stop_sequence").cast("long").alias("last_stop_sequence"))


def _operations(v: Views) -> DataFrame:
    trips = _instances(v)
    return rollups.trip_operations(trips, calendar.trip_schedule_summary(v.schedule()), rollups.trip_realtime_summary(v.matches(), v.events(), trips))


@query("d28_trip_operations", """select t.feed_checksum, t.service_date::varchar as service_date, t.trip_id, t.route_id, epoch_us(s0) as start_us, epoch_us(s1) as end_us, scheduled_stop_count, r.trip_id is not null as realtime_observed, coalesce(observation_count, 0) as observation_count, coalesce(distinct_vehicle_count, 0) as distinct_vehicle_count
    from ti t join tss s on s.feed_checksum = t.feed_checksum and s.service_date = t.service_date and s.trip_id = t.trip_id left join rt r on r.feed_checksum = t.feed_checksum and r.service_date = t.service_date and r.trip_id = t.trip_id""", "ti", "tss", "rt")
def _(v: Views) -> DataFrame:
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return _operations(v).select("feed_checksum", text("service_date"), "trip_id", "route_id", us("scheduled_start_local").alias("start_us"), us("scheduled_end_local").alias("end_us"), "scheduled_stop_count", "realtime_observed", "observation_count", "distinct_vehicle_count")


def _windows(v: Views) -> DataFrame:
    return coverage.coverage_windows(v.table("temp_vehicle_events_stage").select("ingestion_timestamp").distinct(), "ingestion_timestamp")


@query("d29_coverage_windows", "select epoch_us(w0) as start_us, epoch_us(w1) as end_us, snapshot_count from cw", "cw")
def _(v: Views) -> DataFrame:
    return _windows(v).select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "snapshot_count")


@query("d30_trip_coverage", """select feed_checksum, service_date::varchar as service_date, trip_id, dur as scheduled_duration_seconds, cov as collector_coverage_seconds, case when dur > 0 then round((100.0 * cov / dur)::decimal(38,10), 2)::double else 0 end as collector_coverage_percent from (
    select feed_checksum, service_date, trip_id, (epoch_us(any_value(b)) - epoch_us(any_value(a))) / 1e6 as dur, coalesce(sum((epoch_us(least(b, w1)) - epoch_us(greatest(a, w0))) / 1e6) filter (where w0 is not null), 0) as cov
    from (select feed_checksum, service_date, trip_id, timezone('America/New_York', s0) as a, timezone('America/New_York', s1) as b from tss) t left join cw on w0 < b and w1 > a and a < b and w0 < w1 group by feed_checksum, service_date, trip_id)""", "tss", "cw")
def _(v: Views) -> DataFrame:
    trips = calendar.trip_schedule_summary(v.schedule())
    return coverage.trip_coverage(trips, _windows(v)).select("feed_checksum", text("service_date"), "trip_id", "scheduled_duration_seconds", "collector_coverage_seconds", "collector_coverage_percent")


@query("d31_clock_features", """select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, case when trip_id like 'ADDED-%' then 'ADDED' when trip_id like 'NONREV%' then 'NONREV' else 'PLANNED' end as trip_type,
    (epoch_us(stop_ts) - epoch_us(scheduled_arrival)) / 1e6 as arrival_deviation_seconds, (epoch_us(departure_ts) - epoch_us(scheduled_departure)) / 1e6 as departure_deviation_seconds, floor((sas % 86400) / 3600)::bigint::varchar as service_hour, isodow(service_date) as day_of_week from hperf""", "hperf")
def _(v: Views) -> DataFrame:
    return performance.clock_features(v.history()).select(text("service_date"), "trip_id", "stop_sequence", "stop_id", "trip_type", "arrival_deviation_seconds", "departure_deviation_seconds", text("service_hour"), F.col("day_of_week").cast("long").alias("day_of_week"))


def _calendar(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A small service calendar derived from orders and suppliers: a service per supplier, feeds of ten days."""
    feeds = v.spark.sql("select f as feed_checksum, date'2026-03-01' + 10 * i as feed_start_date, date'2026-03-10' + 10 * i as feed_end_date from (values ('A', 0), ('B', 1)) as t(f, i)")
    days = [((F.col("s_suppkey") + i) % 3 > 0).cast("int").alias(d) for i, d in enumerate(calendar.DAYS)]
    spans = v.table("supplier").select(F.explode(F.array(F.lit("A"), F.lit("B"))).alias("feed_checksum"), F.col("s_suppkey").cast("string").alias("service_id"), *days, F.lit("2026-03-03").cast("date").alias("start_date"), F.lit("2026-03-18").cast("date").alias("end_date"))
    changes = v.table("orders").where("o_orderkey % 11 = 0").select(F.explode(F.array(F.lit("A"), F.lit("B"))).alias("feed_checksum"), (F.col("o_custkey") % 40).cast("string").alias("service_id"), F.date_add(F.lit("2026-03-01").cast("date"), (F.col("o_orderkey") % 20).cast("int")).alias("service_date"), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2).alias("exception_type"))
    return feeds, spans, changes


CALENDAR_SQL = """with f as (select f as feed, date '2026-03-01' + 10 * i as a, date '2026-03-10' + 10 * i as b from (values ('A', 0), ('B', 1)) t(f, i)),
d as (select feed, unnest(generate_series(a, b, interval 1 day))::date as day from f),
c as (select feed, s_suppkey from supplier, (values ('A'), ('B')) t(feed)),
x as (select feed, (o_custkey % 40)::varchar as service, date '2026-03-01' + (o_orderkey % 20)::int as day, o_orderkey % 2 = 0 as added from orders, (values ('A'), ('B')) t(feed) where o_orderkey % 11 = 0),
r as (select d.feed, d.day, s_suppkey::varchar as service from d join c on c.feed = d.feed where d.day between date '2026-03-03' and date '2026-03-18' and (s_suppkey + isodow(d.day) - 1) % 3 > 0
  union select x.feed, x.day, x.service from x join d on d.feed = x.feed and d.day = x.day where added)
select feed as feed_checksum, day::varchar as service_date, service as service_id from r where not exists (select 1 from x where x.feed = r.feed and x.day = r.day and x.service = r.service and not x.added)"""


@query("d5_active_services", CALENDAR_SQL)
def _(v: Views) -> DataFrame:
    return calendar.active_services(*_calendar(v)).select("feed_checksum", text("service_date"), "service_id")


@query("d6_trip_schedule_summary", "select feed_checksum, service_date::varchar as service_date, trip_id, epoch_us(s0) as start_us, epoch_us(s1) as end_us, scheduled_stop_count from tss", "tss")
def _(v: Views) -> DataFrame:
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return calendar.trip_schedule_summary(v.schedule()).select("feed_checksum", text("service_date"), "trip_id", us("scheduled_start_local").alias("start_us"), us("scheduled_end_local").alias("end_us"), "scheduled_stop_count")


# --- T: streaming-shaped behaviour in batch form ---------------------------------------------------------


@query("t4_affected_trips", f"""select service_date::varchar as service_date, {', '.join(D9)} from stops where (feed_checksum, service_date, trip_id) in (select (feed_checksum, service_date, trip_id) from m where ingestion_timestamp >= (select max(ingestion_timestamp) - interval 30 minute from m))""", "stops")
def _(v: Views) -> DataFrame:
    """Trips touched in the last half hour, recomputed whole."""
    since = v.matches().agg(F.max("event_ingestion_timestamp")).first()[0]
    recent = v.matches().where(F.col("event_ingestion_timestamp") >= F.lit(since) - F.expr("interval 30 minutes"))
    return infer_stops(v.matches(), v.events(), recent).select(text("service_date"), *D9)


@query("t8_gap_sessions", """select user_id, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us, count(*) as n from (select *, sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) as g from (
    select *, case when lag(ts) over (partition by user_id order by ts, event_id) is null or ts - lag(ts) over (partition by user_id order by ts, event_id) > interval 21600 second then 1 else 0 end as fresh from events)) group by user_id, g""")
def _(v: Views) -> DataFrame:
    rows = v.table("events").withColumn("at", F.col("ts").cast("timestamp"))
    return rows.groupBy("user_id", F.session_window("at", "21600 seconds")).agg(F.unix_micros(F.min("at")).alias("start_us"), F.unix_micros(F.max("at")).alias("end_us"), F.count("*").alias("n")).drop("session_window")


@query("t10_freshness", "select route_id, count(*) as n, epoch_us(max(ingestion_timestamp)) as last_us, (select epoch_us(max(ingestion_timestamp)) from ev) // 1000000 - epoch_us(max(ingestion_timestamp)) // 1000000 as age_seconds from ev where route_id is not null group by route_id", "ev")
def _(v: Views) -> DataFrame:
    return serving.freshness(v.events().where("route_id is not null"), "route_id", "ingestion_timestamp", v.events().agg(F.max("ingestion_timestamp")).first()[0])


@query("t_route_hour_windows", "select route_id, epoch_us(date_trunc('hour', vehicle_timestamp)) as hour_us, count(*) as n from ev where vehicle_timestamp is not null and route_id is not null group by all", "ev")
def _(v: Views) -> DataFrame:
    rows = v.events().where("route_id is not null and vehicle_timestamp is not null")
    return rows.groupBy("route_id", F.window("vehicle_timestamp", "1 hour")).agg(F.count("*").alias("n")).select("route_id", F.unix_micros("window.start").alias("hour_us"), "n")


# --- Q: profiles and assertions ----------------------------------------------------------------------------


@query("q1_overview", "select count(*) as row_count, count(distinct service_date) as day_count, min(service_date)::varchar as first_date, max(service_date)::varchar as last_date, count(distinct (service_date, trip_id)) as trip_count from hist", "hist")
def _(v: Views) -> DataFrame:
    return quality.overview(v.history())


@query("q2_missing_counts", "select * from (select 'vehicle_id' as column_name, count(*) filter (where vehicle_id is null or trim(vehicle_id) = '') as missing_count from rawh union all select 'stop_timestamp', count(*) filter (where stop_ts is null) from rawh union all select 'travel_time_seconds', count(*) filter (where travel_time_seconds is null) from rawh union all select 'move_timestamp', count(*) filter (where move_ts is null) from rawh)", "rawh")
def _(v: Views) -> DataFrame:
    return quality.missing_counts(v.raw_history(), ["vehicle_id", "stop_timestamp", "travel_time_seconds", "move_timestamp"])


@query("q3_duplicate_keys", "select service_date::varchar as service_date, trip_id, stop_sequence, stop_id, count(*) as row_count from historical_stop_features group by all having count(*) > 1")
def _(v: Views) -> DataFrame:
    return dedup.duplicate_keys(v.table("historical_stop_features"), VISIT).withColumn("service_date", F.col("service_date").cast("string"))


@query("q4_file_dates", """with f as (select service_date as file_date, 'f' || service_date::varchar as source_file from (select distinct service_date from historical_stop_features) union all select date '2000-01-01', 'f2000-01-01'),
    r as (select 'f' || (case when stop_sequence = 3 then service_date + 1 else service_date end)::varchar as source_file, service_date from historical_stop_features)
    select f.source_file, f.file_date::varchar as file_date, r.service_date::varchar as service_date, count(r.service_date) as row_count from f left join r on r.source_file = f.source_file where r.service_date is null or r.service_date <> f.file_date group by all""")
def _(v: Views) -> DataFrame:
    rows = v.table("historical_stop_features")
    files = rows.select(F.col("service_date").alias("file_date")).distinct().union(v.spark.sql("select date'2000-01-01'")).withColumn("source_file", F.concat(F.lit("f"), F.col("file_date").cast("string")))
    moved = F.when(F.col("stop_sequence") == 3, F.date_add("service_date", 1)).otherwise(F.col("service_date"))
    sourced = rows.select("service_date", F.concat(F.lit("f"), moved.cast("string")).alias("source_file"))
    return quality.mismatched_dates(sourced, files).select("source_file", text("file_date"), text("service_date"), "row_count")


def _profile_sql(metric: str) -> str:
    x = f"case when not isnan({metric}::double) then {metric}::double end"
    return f"select '{metric}' as metric, count({x}) as n, min({x}) as least, avg({x}) as mean, max({x}) as most, quantile_cont({x}, 0.5) as p50, quantile_cont({x}, 0.95) as p95, quantile_cont({x}, 0.99) as p99, count(*) filter (where {x} < 0) as negative_count from historical_stop_features"


@query("q5_metric_profile", " union all ".join(map(_profile_sql, METRICS)))
def _(v: Views) -> DataFrame:
    return quality.metric_profile(v.table("historical_stop_features"), METRICS)


@query("q8_trips_by_date", "select service_date::varchar as service_date, count(*) as row_count, count(distinct trip_id) as trip_count from hist group by service_date", "hist")
def _(v: Views) -> DataFrame:
    return quality.trips_by_date(v.history()).withColumn("service_date", F.col("service_date").cast("string"))


@query("q9_status_histogram", "select current_status::varchar as current_status, count(*) as event_count, case current_status when 0 then 'INCOMING_AT' when 1 then 'STOPPED_AT' when 2 then 'IN_TRANSIT_TO' else 'UNKNOWN' end as status_name from ev group by current_status", "ev")
def _(v: Views) -> DataFrame:
    return quality.status_histogram(v.events()).withColumn("current_status", F.col("current_status").cast("string"))


@query("q10_status_coverage", """select count(*) as trip_stops, count(*) filter (where s) as with_stopped, count(*) filter (where t) as with_transit, count(*) filter (where s and t) as with_both, count(*) filter (where s and not t) as stopped_only, count(*) filter (where t and not s) as transit_only
    from (select coalesce(bool_or(st = 1), false) as s, coalesce(bool_or(st in (0, 2)), false) as t from obs group by feed_checksum, service_date, trip_id, stop_sequence, stop_id)""", "obs")
def _(v: Views) -> DataFrame:
    rows = v.matches().select("event_key", *GRAIN[:-1]).join(v.events().where("vehicle_timestamp is not null and stop_id is not null").select("event_key", "stop_id", F.coalesce("current_status", F.lit(-1)).alias("current_status")), "event_key")
    return quality.status_coverage(rows, GRAIN)


@query("q11_stopped_periods", "select count(*) filter (where stopped_period_count = 1) as one_period, count(*) filter (where stopped_period_count > 1) as several_periods, max(stopped_period_count) as most_periods from stops", "stops")
def _(v: Views) -> DataFrame:
    return quality.stopped_periods(v.stops())


@query("q12_backward_steps", """select count(*) as step_count, count(*) filter (where b < a) as backward_count, 100.0 * count(*) filter (where b < a) / count(*) as backward_percent from (select current_stop_sequence as b, lag(current_stop_sequence) over (partition by vehicle_id, trip_id order by vehicle_timestamp, event_key) as a
    from ev where vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null) where a is not null and b is not null""", "ev")
def _(v: Views) -> DataFrame:
    return quality.transitions(v.events().where("vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null"), ["vehicle_timestamp", "event_key"])


@query("q13_observation_gaps", """select count(*) as gap_count, avg(g) as mean_gap, quantile_cont(g, 0.5) as p50_gap, quantile_cont(g, 0.95) as p95_gap, max(g) as most_gap from (select (epoch_us(vehicle_timestamp) - epoch_us(lag(vehicle_timestamp) over (partition by vehicle_id, trip_id order by vehicle_timestamp, event_key))) / 1e6 as g
    from ev where vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null) where g > 0 and g <= 60""", "ev")
def _(v: Views) -> DataFrame:
    return quality.observation_gaps(v.events().where("vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null"), ["vehicle_timestamp", "event_key"])


@query("q14_event_quality", """select count(*) as event_count, count(*) filter (where vehicle_id is null or trim(vehicle_id) = '') as missing_vehicle_id, count(*) filter (where trip_id is null or trim(trip_id) = '') as missing_trip_id, count(*) filter (where route_id is null or trim(route_id) = '') as missing_route_id,
    count(*) filter (where stop_id is null or trim(stop_id) = '') as missing_stop_id, count(*) filter (where latitude is null or longitude is null) as missing_position, count(*) filter (where latitude not between -90 and 90 or longitude not between -180 and 180) as invalid_position,
    count(*) filter (where l < 0) as negative_latency, avg(l) as mean_latency, max(l) as most_latency, quantile_cont(l, 0.5) as p50_latency, quantile_cont(l, 0.95) as p95_latency from (select *, (epoch_us(feed_timestamp) - epoch_us(vehicle_timestamp)) / 1e6 as l from ev)""", "ev")
def _(v: Views) -> DataFrame:
    return quality.event_quality(v.events())


@query("q14_out_of_order", """select count(*) filter (where first_no > 1 and a is not null) as step_count, count(*) filter (where b < a) as out_of_order_count from (select vehicle_timestamp as b, lag(vehicle_timestamp) over w as a, row_number() over w as first_no
    from ev where vehicle_id is not null window w as (partition by vehicle_id order by ingestion_timestamp, stage_row))""", "ev")
def _(v: Views) -> DataFrame:
    return quality.out_of_order(v.events(), ["ingestion_timestamp", "stage_row"])


def _violations(v: Views) -> DataFrame:
    """The standing assertions over the pipeline's tables, with the number of rows that violate each."""
    # Each table is looked at several times: written once.
    scores, base, matches, history = (written(df, "checked") for df in (_scores(v), v.baselines(), v.matches(), v.history()))
    stops, hourly = written(infer_stops(matches), "checked"), rollups.route_hourly(scores)
    fence = F.col("upper_anomaly_fence_seconds")
    checks = {
        "matches_unique": quality.unique(matches, ["event_key"]),
        "matches_valid": quality.never_null(matches, ["event_key", "feed_checksum", "service_date", "trip_id"]).select("event_key").union(quality.within(matches, "difference_seconds", 0).select("event_key")),
        "matches_have_events": quality.references(matches, v.events(), ["event_key"]),
        "stops_unique": quality.unique(stops, GRAIN),
        "stops_quality": quality.one_of(stops, "inference_quality", ["COMPLETE", "PARTIAL", "MULTIPLE_VEHICLES", "MULTIPLE_STOP_PERIODS", "NO_STOP_OBSERVATION"]),
        "stops_uncertainty": quality.within(stops, "arrival_uncertainty_seconds", 0).unionByName(quality.within(stops, "departure_uncertainty_seconds", 0)),
        "scores_class": quality.one_of(scores, "stop_classification", ["CERTAIN_LATE", "POSSIBLE_LATE", "NORMAL", "NOT_EVALUABLE"]),
        "scores_fence": quality.holds(scores.where("is_certain_late"), F.col("arrival_deviation_lower_seconds") > fence),
        "route_hour_unique": quality.unique(hourly, ["service_date", "route_id", "direction_id", "service_hour"]),
        "route_hour_rate": quality.within(hourly, "anomaly_rate_percent", 0, 100),
        "baselines_unique": quality.unique(base, ["baseline_level", *baselines.KEYS, "service_hour"]),
        "baselines_valid": quality.holds(base, (F.col("observation_count") >= 30) & (F.col("q1_delay_seconds") <= F.col("median_delay_seconds")) & (F.col("median_delay_seconds") <= F.col("q3_delay_seconds")) & (F.col("iqr_delay_seconds") >= 0)),
        "history_unique": quality.unique(history, VISIT),
    }
    return quality.violations(checks)


ASSERTIONS = ["matches_unique", "matches_valid", "matches_have_events", "stops_unique", "stops_quality", "stops_uncertainty", "scores_class", "scores_fence", "route_hour_unique", "route_hour_rate", "baselines_unique", "baselines_valid", "history_unique"]
query("q_assertions")(_violations)  # its SQL is in service_queries


# --- V: serving --------------------------------------------------------------------------------------------


def _daily(v: Views) -> DataFrame:
    return rollups.route_daily(rollups.trip_anomalies(_scores(v)))


@query("v1_service_dates", "select distinct service_date::varchar as service_date from daily order by 1 desc", "daily")
def _(v: Views) -> DataFrame:
    return serving.service_dates(_daily(v)).select(text("service_date"))


@query("v2_route_daily_totals", """select route_id, sum(observed_trip_count)::bigint as observed_trips, sum(evaluable_trip_count)::bigint as evaluable_trips, sum(sustained_late_trip_count)::bigint as sustained_late_trips,
    100.0 * sum(sustained_late_trip_count) / nullif(sum(evaluable_trip_count), 0) as sustained_rate_percent from daily where service_date = (select max(service_date) from daily) group by route_id""", "daily")
def _(v: Views) -> DataFrame:
    rows = _daily(v)
    return serving.route_totals(rows, serving.latest_date(rows))


@query("v3_route_hours", "select service_date::varchar as service_date, direction_id, service_hour, observed_stop_count, anomaly_rate_percent, route_hour_classification from hourly where route_id = (select min(route_id) from hourly)", "hourly")
def _(v: Views) -> DataFrame:
    rows = rollups.route_hourly(_scores(v))
    route = rows.agg(F.min("route_id")).first()[0]
    return serving.route_hours(rows, route).select(text("service_date"), "direction_id", "service_hour", "observed_stop_count", "anomaly_rate_percent", "route_hour_classification")


@query("v4_route_trips", "select service_date::varchar as service_date, trip_id, trip_classification, anomaly_percent from trips where route_id = (select min(route_id) from hourly)", "trips", "hourly")
def _(v: Views) -> DataFrame:
    route = rollups.route_hourly(_scores(v)).agg(F.min("route_id")).first()[0]
    return serving.route_trips(rollups.trip_anomalies(_scores(v)), route).select(text("service_date"), "trip_id", "trip_classification", "anomaly_percent")


@query("v5_trip_stops", """select s.trip_id, s.stop_sequence, coalesce(n.n_name, s.stop_id) as stop_name, s.cls as stop_classification from sc s left join nation n on n.n_nationkey = s.stop_id::int % 40""", "sc")
def _(v: Views) -> DataFrame:
    names = v.table("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("stop_name"))
    rows = _scores(v).withColumn("k", (F.col("stop_id").cast("int") % 40))
    return serving.named(rows, names, "k", "stop_name", "stop_id").select("trip_id", "stop_sequence", "stop_name", "stop_classification")


@query("v6_system_kpis", "select sum(observed_trip_count)::bigint as observed_trips, sum(sustained_late_trip_count)::bigint as sustained_late_trips, coalesce(100.0 * sum(sustained_late_trip_count) / nullif(sum(evaluable_trip_count), 0), 0) as sustained_rate_percent from daily", "daily")
def _(v: Views) -> DataFrame:
    return serving.kpis(_daily(v))


@query("v7_dominant_label", """select route_id, direction_id, stop_id, n from (select *, row_number() over (partition by route_id, direction_id order by n desc, stop_id) as rn from (select route_id, direction_id, stop_id, count(*) as n from gtfs_stop_instances group by all)) where rn = 1""")
def _(v: Views) -> DataFrame:
    return serving.dominant(v.schedule(), ["route_id", "direction_id"], "stop_id")


@query("v8_masked_heatmap", "select service_date::varchar as service_date, route_id, direction_id, service_hour, anomaly_rate_percent from hourly where route_hour_classification <> 'INSUFFICIENT_COVERAGE'", "hourly")
def _(v: Views) -> DataFrame:
    return serving.heatmap(rollups.route_hourly(_scores(v))).withColumn("service_date", F.col("service_date").cast("string"))
