"""Snapshot and feed files, sinks, upserts, streams."""

import io
import struct
import zipfile
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from headwaykit.operators import calendar
from headwaykit.operators.upsert import insert_only, upsert
from headwaykit.sources.history_files import ask, export_sorted, file_facts, in_dates, scan_partitioned, scan_recursive, write_partitioned
from headwaykit.sources.schedule_feeds import feed_files, feed_table, new_feeds, register_feeds, stop_dimension
from headwaykit.sources.snapshots import candidate_files, decode_snapshots, snapshot_files
from headwaykit.streaming.live import emit, land_events, once_within, pane_stream, pane_updates, recompute_scopes, session_stream, to_memory

UTC = timezone.utc


def varint(n):
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def snapshot(entities, stamp=1_772_000_000):
    return field(1, field(1, "2.0") + field(3, stamp)) + b"".join(field(2, e) for e in entities)


def vehicle(id="v1", trip="t1", status=1, ts=1_772_000_010, position=True):
    body = field(1, field(1, trip) + field(4, 1) + field(5, "Red") + field(6, 1)) + (field(2, field(1, 42.5) + field(2, -71.25)) if position else b"")
    body += field(3, 7) + field(4, status) + field(5, ts) + field(7, "stop") + field(8, field(1, id))
    return field(1, "e" + id) + field(4, body)


def test_snapshots(spark, tmp_path):
    day = tmp_path / "ingestion_date=2026-02-25"
    day.mkdir()
    (day / "vehicles_20260225T061320Z.pb").write_bytes(snapshot([vehicle(), vehicle("v2", position=False), field(1, "alert only") + field(5, b"")]))
    (day / "20260225T061325Z.pb").write_bytes(snapshot([field(1, "e") + field(4, b"")]))
    (day / "20260225T061330Z.pb").write_bytes(b"\xff\xff\xff")
    (day / "notes.pb").write_bytes(b"")
    files = snapshot_files(spark, str(tmp_path))
    rows = {r.entity_id: r for r in decode_snapshots(files).where("problem is null").collect()}
    assert set(rows) == {"ev1", "ev2", "e"}
    one, bare = rows["ev1"], rows["e"]
    assert (one.vehicle_id, one.trip_id, one.route_id, one.schedule_relationship, one.direction_id, one.stop_id, one.current_stop_sequence, one.current_status) == ("v1", "t1", "Red", "ADDED", 1, "stop", 7, 1)
    assert (one.latitude, one.longitude, one.vehicle_timestamp_raw, one.feed_timestamp_raw) == (42.5, -71.25, 1_772_000_010, 1_772_000_000)
    assert rows["ev2"].latitude is None
    assert (bare.vehicle_id, bare.schedule_relationship, bare.direction_id, bare.current_status, bare.vehicle_timestamp) == (None, "SCHEDULED", 0, 2, None)
    assert decode_snapshots(files).where("problem is not null").count() == 1
    found = [r.path.rsplit("/", 1)[1] for r in candidate_files(files.select("path"), None).collect()]
    assert found == ["vehicles_20260225T061320Z.pb", "20260225T061325Z.pb", "20260225T061330Z.pb"]
    done = files.where("path like '%061325%'").select(F.col("path").alias("object_name"))
    assert candidate_files(files.select("path"), done, F.lit("2026-02-25 06:13:22").cast("timestamp")).count() == 1
    assert candidate_files(files.select("path"), None, max_files=2).count() == 2


def feed(tmp_path, name, members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for member, text in members.items():
            z.writestr(member, text)
    (tmp_path / name).write_bytes(buffer.getvalue())


MEMBERS = {
    "stops.txt": "﻿stop_id,stop_name,stop_lat,parent_station\ns1, First ,42.0,\n,Nameless,1,\ns2,,bad,s1\n",
    "trips.txt": "route_id,service_id,trip_id,direction_id\nr,wk,t1,0\nr,we,t2,1\n",
    "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,23:59:00,24:00:30,s1,1\nt1,25:10:00,,s2,2\n",
    "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nwk,1,1,1,1,1,0,0,20260302,20260306\nwe,0,0,0,0,0,1,1,20260301,20260331\n",
    "calendar_dates.txt": "service_id,date,exception_type\nwk,20260303,2\nwe,20260303,1\nwk,20260401,1\n",
    "routes.txt": "route_id,route_type\nr,1\n",
    "feed_info.txt": "feed_version,feed_start_date,feed_end_date\nspring,20260301,20260308\n",
}


def test_schedule_feed_to_instances(spark, tmp_path):
    feed(tmp_path, "a.zip", MEMBERS)
    files = feed_files(spark, str(tmp_path))
    stops = {r.stop_id: r for r in stop_dimension(files).collect()}
    assert set(stops) == {"s1", "s2"} and stops["s1"].stop_name == "First" and stops["s2"].stop_lat is None
    feeds = register_feeds(files)
    assert (feeds.first().feed_version, feeds.first().feed_start_date) == ("spring", date(2026, 3, 1))
    active = calendar.active_services(feeds, feed_table(files, "calendar"), feed_table(files, "calendar_dates"))
    got = {(r.service_date.day, r.service_id) for r in active.collect()}
    assert got == {(2, "wk"), (4, "wk"), (5, "wk"), (6, "wk"), (1, "we"), (7, "we"), (8, "we"), (3, "we")}
    instances = calendar.trip_instances(active, feed_table(files, "trips"))
    times = calendar.stop_instances(instances, feed_table(files, "stop_times")).where("service_date = date'2026-03-02'").orderBy("stop_sequence").collect()
    assert [str(t.scheduled_departure_local) for t in times] == ["2026-03-03 00:00:30", "None"] and str(times[1].scheduled_arrival_local) == "2026-03-03 01:10:00"
    summary = calendar.trip_schedule_summary(calendar.stop_instances(instances, feed_table(files, "stop_times"))).where("service_date = date'2026-03-02'").first()
    assert str(summary.scheduled_start_local) == "2026-03-03 00:00:30" and summary.scheduled_stop_count == 2
    assert new_feeds(files, feeds).count() == 0
    feed(tmp_path, "b.zip", {"trips.txt": MEMBERS["trips.txt"]})
    with pytest.raises(Exception, match="holds no routes"):
        feed_table(feed_files(spark, str(tmp_path)), "routes").count()


def test_history_sink_and_scans(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.range(100).select("id", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("service_date"))
    assert write_partitioned(rows, path, "service_date", 2) == 100
    write_partitioned(rows.where("service_date = date'2026-01-02' and id < 10"), path, "service_date")
    assert scan_partitioned(spark, path).count() == 75 + 3
    assert scan_recursive(spark, path).columns == ["id"]
    kept = in_dates(scan_partitioned(spark, path), "service_date", "2026-01-02", "2026-01-03")
    assert kept.count() == 28 and "PartitionFilters: [isnotnull(service_date" in kept._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        write_partitioned(rows.where("false"), path, "service_date")
    assert sum(f["rows"] for f in file_facts([str(p) for p in (tmp_path / "h").rglob("*.parquet")])) == 78
    export_sorted(rows, str(tmp_path / "e"), "service_date", ["id"])
    assert scan_partitioned(spark, str(tmp_path / "e")).count() == 100
    rows.createOrReplaceTempView("asked")
    assert ask(spark, "select * from asked where id > :least and array_contains(:days, day(service_date))", least=50, days=[1, 2]).count() == 24


def test_upsert_and_insert_only(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "trip string, stop int, v int, day string")
    for _ in range(2):  # a repeated call changes nothing
        upsert(path, make([("a", 1, 1, "x"), ("a", 2, 1, "x"), ("b", 1, 1, "x"), ("c", 1, 1, "y")]), ["trip", "stop"], "day")
    upsert(path, make([("a", 1, 2, "x"), ("d", 1, 2, "x")]), ["trip", "stop"], "day")
    read = lambda: {(r.trip, r.stop): r.v for r in spark.read.parquet(path).collect()}
    assert read() == {("a", 1): 2, ("a", 2): 1, ("b", 1): 1, ("c", 1): 1, ("d", 1): 2}
    upsert(path, make([("a", 9, 3, "x")]), ["trip", "stop"], "day", scope=["trip"])
    assert read() == {("a", 9): 3, ("b", 1): 1, ("c", 1): 1, ("d", 1): 2}
    insert_only(path, make([("a", 9, 8, "x"), ("e", 1, 8, "z")]), ["trip", "stop"], "day")
    assert read() == {("a", 9): 3, ("b", 1): 1, ("c", 1): 1, ("d", 1): 2, ("e", 1): 8}
    with pytest.raises(ValueError):
        upsert(path, make([("a", 1, 1, "x"), ("a", 1, 2, "x")]), ["trip", "stop"], "day")


EVENTS = "event_key string, trip_id string, route_id string, vehicle_timestamp timestamp, feed_timestamp timestamp, ingestion_timestamp timestamp"


def write_events(spark, path, number, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(path))


def minute(m):
    return datetime(2026, 3, 1, 12, tzinfo=UTC) + timedelta(minutes=m)


def event(n, m, late=0, route="r", trip="t"):
    return (f"{n:064x}", trip, route, minute(m), minute(m), minute(m + late))


def read_stream(spark, path):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_panes_are_corrected_by_late_events(spark, tmp_path):
    path, check = tmp_path / "in", str(tmp_path / "check")
    given = []

    def changed():
        given.clear()
        write = lambda batch, _: given.extend((r.window.start.minute, r.n) for r in batch.collect())
        emit(pane_stream(read_stream(spark, path)), write, check).awaitTermination()
        return set(given)

    write_events(spark, path, 0, [event(1, 1), event(2, 2), event(3, 20)])
    assert changed() == {(0, 2), (15, 1)}
    write_events(spark, path, 1, [event(4, 3, 30), event(5, 400)])
    assert (0, 3) in changed()
    write_events(spark, path, 2, [event(6, 4, 500)])  # beyond the lateness: ignored
    assert changed() == set()


def test_panes_of_a_stream_count_an_event_once(spark, tmp_path):
    path, given, kept = tmp_path / "in", {}, {}
    write = lambda batch, _: given.update({r.window.start.minute: r.n for r in batch.collect()})
    keep = lambda windows, _: kept.update({r.period_start_s % 3600 // 60: (r.published_count, r.corrected_count, r.corrections) for r in windows.collect()})
    again = lambda late: (event(1, 1)[0].upper(), *event(1, 1, late)[1:])
    for number, rows in enumerate(([event(1, 1), event(2, 2)], [again(30), event(3, 20)], [again(60), event(4, 3, 25), (None, *event(5, 4)[1:])])):
        write_events(spark, path, number, rows)
        emit(pane_stream(read_stream(spark, path)), write, str(tmp_path / "c1")).awaitTermination()
        numbered = read_stream(spark, path).withColumn("stage_row", F.xxhash64("event_key", "ingestion_timestamp"))
        pane_updates(numbered, str(tmp_path / "ledger"), keep, str(tmp_path / "c2")).awaitTermination()
    assert given == {0: 4, 15: 1}
    assert kept == {0: (3, 4, 1), 15: (1, 1, 0)}


def test_stream_dedup_and_sessions(spark, tmp_path):
    path = tmp_path / "in"
    write_events(spark, path, 0, [event(1, 1), event(2, 2)])
    write_events(spark, path, 1, [(event(1, 1)[0].upper(), *event(1, 1, 5)[1:]), event(3, 3)])
    to_memory(once_within(read_stream(spark, path)), "once", "append").awaitTermination()
    assert spark.table("once").count() == 3
    to_memory(session_stream(read_stream(spark, path), "ingestion_timestamp", "trip_id"), "sessions", "append").awaitTermination()
    assert {r.snapshot_count for r in spark.table("sessions").collect()} <= {3, 4, 1}


def test_landing_is_idempotent_and_scopes_are_recomputed(spark, tmp_path):
    path, table = tmp_path / "in", str(tmp_path / "events")
    write_events(spark, path, 0, [event(1, 1, trip="a"), event(2, 2, trip="b")])
    land_events(read_stream(spark, path), table, str(tmp_path / "c1")).awaitTermination()
    write_events(spark, path, 1, [(event(1, 1)[0].upper(), *event(1, 1, 9, trip="a")[1:]), event(3, 5, trip="a"), event(3, 5, 7, trip="a")])
    land_events(read_stream(spark, path), table, str(tmp_path / "c1")).awaitTermination()
    land_events(read_stream(spark, path), table, str(tmp_path / "other")).awaitTermination()  # replay
    assert {(r.event_key, r.ingestion_timestamp.minute) for r in spark.read.parquet(table).collect()} == {(event(n, 0)[0], m) for n, m in ((1, 1), (2, 2), (3, 5))}
    load = lambda s, scopes: s.read.parquet(table).join(scopes, ["trip_id"], "left_semi")
    compute = lambda rows: rows.groupBy("trip_id").agg(F.count("*").alias("n"), F.min(F.to_date("ingestion_timestamp")).alias("day"))
    out = str(tmp_path / "out")
    for check in ("c2", "c3"):
        recompute_scopes(read_stream(spark, path), ["trip_id"], load, compute, out, ["trip_id"], "day", str(tmp_path / check)).awaitTermination()
        assert {(r.trip_id, r.n) for r in spark.read.parquet(out).collect()} == {("a", 2), ("b", 1)}
