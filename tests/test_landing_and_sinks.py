"""Landing zone, registries, sinks, exact percentiles, lines cut by time: hand-made and dirty cases."""

import random
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import stamped
from headwaykit.operators import coverage, history, matching, quality, serving, upsert
from headwaykit.operators.percentiles import exact_percentiles
from headwaykit.sources import history_files, landing, schedule_feeds, snapshots

UTC = timezone.utc
START = datetime(2026, 3, 1, 5, 0, tzinfo=UTC)


def test_write_once_and_poll(spark, tmp_path):
    path = str(tmp_path / "a" / "x.pb")
    assert landing.write_once(spark, path, b"one") and not landing.write_once(spark, path, b"two")
    assert (tmp_path / "a" / "x.pb").read_bytes() == b"one"
    times = iter([START + timedelta(seconds=s) for s in (0, 1, 5, 5, 5, 9)])
    bodies, waits, problems = iter([b"a", None, b"c"]), [], []

    def fetch():
        body = next(bodies)
        if body is None:
            raise OSError("no answer")
        return body

    assert landing.poll(spark, fetch, str(tmp_path / "z"), 5, 3, lambda: next(times), waits.append, problems.append) == 2
    assert sorted(p.name for p in (tmp_path / "z").rglob("*.pb")) == ["20260301T050000Z.pb", "20260301T050005Z.pb"] and len(problems) == 1 and waits == [4.0, 5.0]
    files = snapshots.snapshot_files(spark, str(tmp_path / "z"), since=date(2026, 3, 1))
    assert snapshots.candidate_files(files.select("path"), None).first().ingestion_timestamp is not None
    assert snapshots.snapshot_files(spark, str(tmp_path / "z"), since=date(2026, 3, 2)).count() == 0


def test_jobs_run_alone_and_again(spark, tmp_path):
    lock, runs, waits = str(tmp_path / "lock"), [], []

    def job():
        runs.append(1)
        with pytest.raises(BlockingIOError):
            landing.run_job(spark, lambda: None, lock)
        if len(runs) == 1:
            raise ValueError("once")
        return "done"

    assert landing.run_job(spark, job, lock, 1, 60, waits.append) == "done" and waits == [60] and len(runs) == 2
    with pytest.raises(ValueError):
        landing.run_job(spark, lambda: int("x"), lock, 0)
    assert not (tmp_path / "lock").exists()


def test_files_and_keys_are_registered_once(spark, tmp_path):
    files = spark.createDataFrame([("a", b"1"), ("b", b"1"), ("c", b"2")], "path string, content binary")
    assert {r.object_name for r in landing.new_history_files(files, str(tmp_path / "f")).collect()} == {"a", "c"}
    assert landing.new_history_files(files, str(tmp_path / "f")).count() == 0
    keys = spark.createDataFrame([("k1", "f"), ("k1", "f"), (None, "g")], "event_key string, source_file string")
    fresh = upsert.register(str(tmp_path / "k"), keys, ["event_key"])
    assert fresh.count() == 2 and upsert.register(str(tmp_path / "k"), keys.where("event_key is not null"), ["event_key"]).count() == 0
    assert {(r.object_name, r.row_count, r.new_row_count) for r in upsert.register_files(str(tmp_path / "r"), keys, fresh).collect()} == {("f", 2, 1), ("g", 1, 1)}


def test_a_row_may_move_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, day string")
    upsert.upsert(path, rows((1, "a", "x"), (2, "b", "y"), (3, "c", "z")), ["k"], "day")
    upsert.upsert(path, rows((1, "moved", "y"), (4, "new", "w")), ["k"], "day")
    want = {(1, "moved", "y"), (2, "b", "y"), (3, "c", "z"), (4, "new", "w")}
    assert {tuple(r) for r in spark.read.schema("k int, v string, day string").parquet(path).collect()} == want
    upsert.upsert(path, rows((9, "whole", "y")), ["k"], "day", scope=["day"])
    assert {r.k for r in spark.read.parquet(path).collect()} == {3, 4, 9}
    with pytest.raises(ValueError):
        upsert.upsert(path, rows((1, "a", "x"), (1, "b", "x")), ["k"], "day")


def test_replaced_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "x"), ("bad", "y")], "a string, b string")
    assert history_files.replace_table(rows, path, "a int, c double").collect() == [(1, None), (None, None)]
    doubled = history_files.replace_table(spark.read.parquet(path).union(spark.read.parquet(path)), path)  # from itself
    assert doubled.count() == 4 and history_files.replace_table(rows.where("false"), path, "a int").count() == 0


def test_history_contract(spark, tmp_path):
    raw = spark.createDataFrame(
        [(20260301, True, "t", 1, "s", 1772370000.9, "7"), (20260301, False, "t", 1, "s", 1772369000.2, "bad"), (99999999, None, "t", 2, "s", None, None), (20260302, None, None, 1, "s", None, None)],
        "service_date int, direction_id boolean, trip_id string, stop_sequence int, stop_id string, stop_timestamp double, travel_time_seconds string",
    )
    rows = history.canonical_history(raw).collect()
    assert len(rows) == 1 and rows[0].asDict().keys() == {name for _, name, _ in history.CONTRACT} and len(history.CONTRACT) == 27
    assert (rows[0].service_date, rows[0].direction_id, rows[0].travel_time_seconds, rows[0].stop_timestamp.microsecond) == (date(2026, 3, 1), 0, None, 0)
    counts = {"read": 4, "keyless": 2, "repeated": 1, "stored": 1}
    assert history.store_history(raw, str(tmp_path / "h"), files=2) == counts
    assert {k: v for k, v in history.history_counts(raw).first().asDict().items() if k in counts} == counts
    with pytest.raises(ValueError):
        history.store_history(raw, str(tmp_path / "h2"), first="2027-01-01")


def test_feeds_load_in_order_and_whole(spark, tmp_path):
    zips, path = tmp_path / "zips", str(tmp_path / "tables")
    zips.mkdir()
    members = lambda tag: {"routes": (["route_id"], [(tag,)]), "stops": (["stop_id"], [(tag,)]), "trips": (["trip_id"], [(tag,)]), "stop_times": (["trip_id", "stop_sequence"], [(tag, 1)])}
    (zips / "1.zip").write_bytes(schedule_feeds.feed_zip(members("one") | {"feed_info": (["feed_version"], [("v1",), ("second row",)])}))
    files = schedule_feeds.feed_files(spark, str(zips))
    first = schedule_feeds.load_feed(schedule_feeds.next_feed(files), path).collect()
    assert len(first) == 1 and first[0].feed_version == "v1"
    broken = members("two")
    del broken["stop_times"]
    (zips / "2.zip").write_bytes(schedule_feeds.feed_zip(broken))
    files = schedule_feeds.feed_files(spark, str(zips))
    with pytest.raises(Exception, match="holds no stop_times"):
        schedule_feeds.load_feed(schedule_feeds.next_feed(files, spark.read.parquet(f"{path}/feeds")), path)
    assert [r.route_id for r in schedule_feeds.loaded_table(spark, path, "routes").collect()] == ["one"]


def test_answers_are_remembered_for_a_while(spark):
    now = [0.0]
    ask = history_files.Answers(spark, 120, clock=lambda: now[0], most_rows=3)
    spark.range(2).createOrReplaceTempView("remembered")
    assert len(ask("select id from remembered where id >= :least", least=0)) == 2
    spark.range(3).createOrReplaceTempView("remembered")
    assert len(ask("select id from remembered where id >= :least", least=0)) == 2 and len(ask("select id from remembered where id >= :least", least=1)) == 2
    now[0] = 121.0
    assert len(ask("select id from remembered where id >= :least", least=0)) == 3
    with pytest.raises(ValueError):
        ask("select * from range(9)")


@pytest.mark.parametrize("keys", [[], ["g"], ["g", "h"]])
def test_exact_percentiles(spark, keys):
    rng = random.Random(len(keys))
    rows = [(rng.choice(("a", "b", None)), rng.choice((1, 2)), rng.choice((None, float("nan"), float(rng.randrange(20)), rng.gauss(0, 1)))) for _ in range(3000)] + [("one", 1, 5.0), ("none", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    groups = {}
    for g, h, v in rows:
        if v is not None and v == v:
            groups.setdefault(tuple({"g": g, "h": h}[k] for k in keys), []).append(v)
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {tuple(r[k] for k in keys): (r.n, r.q) for r in exact_percentiles(df, keys, "v", shares).collect()}
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        assert got[key][0] == len(values) and np.allclose(got[key][1], np.quantile(values, shares))
    assert exact_percentiles(df.where("false"), keys, "v", shares).count() == 0


def test_the_row_before_across_slots(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), START + timedelta(seconds=rng.randrange(10) * 30_000 + rng.randrange(3)) if rng.random() < 0.95 else None, n) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, at timestamp, n int")
    want = {}
    for k in "ab":
        line = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or START, r[2]))
        want |= {b[2]: (a[2] if a else None) for a, b in zip([None, *line], line)}
    for slot in (2, 21_600, 10**7):
        got = quality.with_previous(df, ["k"], ["at", "n"], ["n"], slot).collect()
        assert {r.n: (r.before.n if r.before else None) for r in got} == want


def test_sessions_over_slots(spark):
    at = [0, 30, 3590, 3610, 3700, 3791, 7195, 7200, 7285, 10_000]
    df = spark.createDataFrame([(START + timedelta(seconds=s),) for s in at] + [(None,)], "ts timestamp")
    got = sorted(((r.window_start - START.replace(tzinfo=None)).seconds, (r.window_end - START.replace(tzinfo=None)).seconds, r.snapshot_count) for r in coverage.coverage_windows(df, "ts").collect())
    assert got == [(0, 30, 2), (3590, 3700, 3), (3791, 3791, 1), (7195, 7285, 3), (10_000, 10_000, 1)]


def test_labels_stamps_and_places(spark):
    row = spark.range(1).select(serving.readable_label(F.lit("IN_TRANSIT_TO")), *[serving.hour_label(F.lit(h).cast("int")) for h in (0, 11, 12, 23, None)]).first()
    assert list(row) == ["In Transit To", "12 AM", "11 AM", "12 PM", "11 PM", ""]
    first = stamped(spark.createDataFrame([(1,)], "k int"), datetime(2026, 1, 1, tzinfo=UTC))
    got = {r.k: (r.created_at.month, r.updated_at.month) for r in stamped(spark.createDataFrame([(1,), (2,)], "k int"), datetime(2026, 2, 1, tzinfo=UTC), first, ["k"]).collect()}
    assert got == {1: (1, 2), 2: (2, 2)}


def test_wall_clock_matches_differ_over_a_clock_change(spark):
    # 03:30 EDT after the change of 8 March; the schedule says 01:30 EST. An hour apart, two by the clocks.
    at = datetime(2026, 3, 8, 7, 30, tzinfo=UTC)
    events = spark.createDataFrame([("e", at, "t", 1, at), ("none", at, "t", 9, at)], "event_key string, event_ingestion_timestamp timestamp, trip_id string, current_stop_sequence int, vehicle_timestamp timestamp")
    trips = spark.createDataFrame([("f", date(2026, 3, 8), "t"), ("f", date(2026, 3, 7), "t")], "feed_checksum string, service_date date, trip_id string")
    times = spark.createDataFrame([("f", "t", 1, 5400, None)], "feed_checksum string, trip_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    got = matching.match_wall_clocks(events, trips, times).collect()
    assert [(r.event_key, r.service_date, r.difference_seconds) for r in got] == [("e", date(2026, 3, 8), 7200.0)]


def test_affected_trips(spark):
    trips = spark.createDataFrame([(date(2026, 1, 1), 1, 5), (date(2026, 1, 2), 2, 5), (date(2026, 1, 3), 3, None), (None, 4, 5)], "service_date date, n int, x int")
    days = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 1),), (None,)], "service_date date")
    assert sorted(r.n for r in coverage.affected_trips(trips, days, ["x"]).collect()) == [1, 3]


def test_snapshots_survive_encoding(spark):
    row = dict(entity_id="e", vehicle_id=None, trip_id="t", route_id=None, schedule_relationship="ADDED", direction_id=1, latitude=42.5, longitude=-71.25, stop_id="s", current_stop_sequence=300, current_status=1, vehicle_timestamp_raw=1_772_000_000)
    out = list(snapshots.decode(snapshots.encode(5, [row, row | {"latitude": None}])))
    assert out[0] == ("e", None, "t", None, "ADDED", 1, 42.5, -71.25, "s", 300, 1, 1_772_000_000, 5) and out[1][6:8] == (None, None)
