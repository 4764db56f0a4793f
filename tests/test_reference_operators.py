"""Hand-made cases of the reference pipeline: every branch, ties, thresholds, clock changes."""

from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import clock_seconds, epoch_or_null, localise, seconds_between, service_wall
from headwaykit.operators import baselines, coverage, dedup, inference, matching, performance, quality, rollups, scoring, serving

UTC = timezone.utc
T0 = datetime(2026, 3, 2, 15, 0, tzinfo=UTC)


def at(s):
    return T0 + timedelta(seconds=s)


OBS = "event_key string, s int, vehicle_id string, status int, stop_sequence int, stop_id string"


def infer(spark, obs):
    df = spark.createDataFrame(obs, OBS).withColumn("ts", F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.col("s")))
    events = df.select("event_key", F.col("ts").alias("ingestion_timestamp"), F.col("ts").alias("vehicle_timestamp"), "vehicle_id", F.lit("r").alias("route_id"), F.lit(0).alias("direction_id"), "stop_id", F.col("status").alias("current_status"))
    matches = df.select("event_key", F.col("ts").alias("event_ingestion_timestamp"), F.lit("f").alias("feed_checksum"), F.lit(date(2026, 3, 2)).alias("service_date"), F.lit("t").alias("trip_id"), "stop_sequence", F.lit(datetime(2026, 3, 2, 10)).alias("scheduled_local_time"))
    rel = lambda t: None if t is None else int((t.replace(tzinfo=UTC) - T0).total_seconds())
    return {(r.stop_sequence, r.stop_id): (r.inference_quality, r.arrival_bound_method, rel(r.arrival_lower_bound), rel(r.arrival_estimate), rel(r.departure_lower_bound), rel(r.departure_upper_bound)) for r in inference.infer_stops(matches, events).collect()}


@pytest.mark.parametrize(
    "obs,want",
    [
        ([("a", 0, "v", 1, 1, "x")], ("PARTIAL", "UNBOUNDED", None, 0, 0, None)),
        ([("a", 0, "v", 2, 1, "x"), ("b", 30, "v", 1, 1, "x"), ("c", 60, "v", 1, 1, "x"), ("d", 90, "v", 2, 2, "y")], ("COMPLETE", "SAME_STOP_TRANSITION", 0, 30, 60, 90)),
        ([("z", 0, "v", 1, 0, "w"), ("b", 30, "v", 1, 1, "x")], ("PARTIAL", "PREVIOUS_STOP", 0, 30, 30, None)),
        ([("z", 0, "v", 2, 5, "w"), ("b", 30, "v", 1, 1, "x")], ("PARTIAL", "UNBOUNDED", None, 30, 30, None)),
        ([("z", 0, "v", 2, 1, "q"), ("b", 30, "v", 1, 1, "x")], ("PARTIAL", "UNBOUNDED", None, 30, 30, None)),
        ([("a", 0, "v", 1, 1, "x"), ("b", 30, "u", 1, 1, "x")], ("MULTIPLE_VEHICLES", "UNBOUNDED", None, 0, 30, None)),
        ([("a", 0, "v", 1, 1, "x"), ("b", 30, "v", 2, 1, "x"), ("c", 60, "v", 1, 1, "x")], ("MULTIPLE_STOP_PERIODS", "UNBOUNDED", None, 0, 60, None)),
        ([("a", 0, "v", 2, 1, "x")], ("NO_STOP_OBSERVATION", "NO_STOP_OBSERVATION", None, None, None, None)),
        ([("a", 0, None, 2, 1, "x"), ("b", 30, None, 1, 1, "x"), ("c", 60, None, 0, 1, "x")], ("COMPLETE", "SAME_STOP_TRANSITION", 0, 30, 30, 60)),
        ([("b", 30, "v", 1, 1, "x"), ("c", 60, "v", 2, 0, "w")], ("PARTIAL", "UNBOUNDED", None, 30, 30, None)),
    ],
)
def test_stop_inference_branches(spark, obs, want):
    assert infer(spark, obs)[(1, "x")] == want


def test_match_ties_and_days(spark):
    events = spark.createDataFrame(
        [("e1", at(0), datetime(2026, 3, 2, 17, 0, tzinfo=UTC), "t", 1, "SCHEDULED"), ("e2", at(0), datetime(2026, 3, 2, 17, 0, tzinfo=UTC), "u", 1, "SCHEDULED"), ("e3", at(0), at(0), "t", 0, "SCHEDULED"), ("e4", at(0), at(0), "t", 1, "ADDED"), ("e5", at(0), datetime(2026, 3, 5, 17, 0, tzinfo=UTC), "t", 1, "SCHEDULED")],
        "event_key string, ingestion_timestamp timestamp, vehicle_timestamp timestamp, trip_id string, current_stop_sequence int, schedule_relationship string",
    )
    local = lambda d, h: datetime(2026, 3, d, h)
    rows = [("b", date(2026, 3, 2), "t", 1, local(2, 12), None), ("a", date(2026, 3, 2), "t", 1, None, local(2, 12)), ("a", date(2026, 3, 1), "t", 1, local(2, 12), None), ("a", date(2026, 2, 28), "t", 1, local(2, 12), None), ("a", date(2026, 3, 1), "u", 1, local(2, 11), None), ("a", date(2026, 3, 3), "u", 1, local(2, 13), None)]
    schedule = spark.createDataFrame(rows, "feed_checksum string, service_date date, trip_id string, stop_sequence int, scheduled_arrival_local timestamp_ntz, scheduled_departure_local timestamp_ntz")
    got = {r.event_key: (r.feed_checksum, r.service_date, r.difference_seconds) for r in matching.match_schedule(events, schedule).collect()}
    assert got == {"e1": ("a", date(2026, 3, 2), 0.0), "e2": ("a", date(2026, 3, 3), 3600.0)}


def test_service_seconds_and_clock_changes(spark):
    rows = [(date(2026, 3, 8), 0), (date(2026, 3, 8), 9000), (date(2026, 3, 7), 90_000), (date(2026, 11, 1), 5400), (date(2026, 3, 7), 86_399), (date(2026, 3, 7), 86_400)]
    df = spark.createDataFrame(rows, "d date, s int").select(localise(service_wall(F.col("d"), F.col("s"))).cast("string").alias("t"))
    assert [r.t for r in df.collect()] == ["2026-03-08 05:00:00", "2026-03-08 07:30:00", "2026-03-08 06:00:00", "2026-11-01 05:30:00", "2026-03-08 04:59:59", "2026-03-08 05:00:00"]


def test_seconds_are_cut_off_towards_zero(spark):
    t = lambda x: datetime(2026, 1, 1, tzinfo=UTC) + timedelta(seconds=x)
    df = spark.createDataFrame([(t(2.1), t(0.9)), (t(0.9), t(2.1))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(seconds_between(F.col("a"), F.col("b"))).collect()] == [1, -1]
    texts = spark.createDataFrame([("25:00:30",), (" 7:05:00 ",), ("",), ("x",), (None,)], "t string").select(clock_seconds(F.col("t")))
    assert [r[0] for r in texts.collect()] == [90_030, 25_500, None, None, None]
    assert spark.range(2).select(epoch_or_null(F.col("id")).cast("string").alias("t")).collect()[0].t is None


@pytest.mark.parametrize("lower,upper,fence,eligible,want", [(10, 10, 10.0, True, "NORMAL"), (11, 11, 10.0, True, "CERTAIN_LATE"), (10, 11, 10.0, True, "POSSIBLE_LATE"), (11, 11, None, True, "NOT_EVALUABLE"), (11, 11, 10.0, False, "NOT_EVALUABLE")])
def test_scores_at_the_fence(spark, lower, upper, fence, eligible, want):
    keys = "route_id string, direction_id int, stop_id string, is_weekend boolean, service_hour int"
    f = spark.createDataFrame([("r", 0, "s", False, 8, upper, lower, upper, eligible)], keys + ", arrival_deviation_seconds long, arrival_deviation_lower_seconds long, arrival_deviation_upper_seconds long, scoring_eligible boolean")
    b = spark.createDataFrame([("FALLBACK", "r", 0, "s", False, None, 30, 1, 2, 3, 2, 0.0, fence)], "baseline_level string, " + keys + ", observation_count long, q1_delay_seconds long, median_delay_seconds long, q3_delay_seconds long, iqr_delay_seconds long, lower_anomaly_fence_seconds double, upper_anomaly_fence_seconds double")
    got = scoring.score_stops(f, b).first()
    assert (got.stop_classification, got.baseline_level) == (want, "FALLBACK")


def test_hourly_baseline_goes_before_fallback_and_needs_support(spark):
    rows = [("r", 0, "s", False, 8, float(x)) for x in range(30)] + [("r", 0, "s", False, 9, 100.0)] * 29 + [("r", None, "s", False, 9, 1.0)] * 40
    df = spark.createDataFrame(rows, "route_id string, direction_id int, stop_id string, is_weekend boolean, service_hour int, x double")
    got = {(r.baseline_level, r.service_hour): r for r in baselines.stop_baselines(df, "x").collect()}
    assert set(got) == {("HOURLY", 8), ("FALLBACK", None)}
    assert (got[("HOURLY", 8)].q1_delay_seconds, got[("HOURLY", 8)].median_delay_seconds, got[("HOURLY", 8)].observation_count) == (7.0, 14.0, 30)


SCORE = "feed_checksum string, service_date date, trip_id string, route_id string, direction_id int, service_hour int, stop_classification string, is_anomalous boolean, arrival_deviation_seconds long"


def scored(spark, per_trip):
    rows = [("f", date(2026, 3, 2), t, "r", 0, 8, c, c.endswith("LATE"), 5) for t, classes in per_trip.items() for c in classes]
    return spark.createDataFrame(rows, SCORE)


def test_trip_and_route_thresholds(spark):
    late, ok, no = "CERTAIN_LATE", "NORMAL", "NOT_EVALUABLE"
    df = scored(spark, {"four": [late] * 4, "five": [late] * 3 + [ok] * 2, "half": [late] * 3 + [ok] * 3, "less": [late] * 3 + [ok] * 4, "two": [late] * 2 + [ok] * 3, "none": [no] * 9})
    trips = rollups.trip_anomalies(df)
    got = {r.trip_id: (r.trip_classification, r.anomaly_percent) for r in trips.collect()}
    assert {k: v[0] for k, v in got.items()} == {"four": "INSUFFICIENT_COVERAGE", "five": "SUSTAINED_LATE", "half": "SUSTAINED_LATE", "less": "NORMAL", "two": "NORMAL", "none": "INSUFFICIENT_COVERAGE"}
    assert got["none"][1] is None
    hour = rollups.route_hourly(df).first()
    assert (hour.observed_stop_count, hour.distinct_trip_count, hour.route_hour_classification) == (27, 5, "SUSTAINED_LATE")
    thin = rollups.route_hourly(scored(spark, {"a": [late] * 5, "b": [late] * 5})).first()
    assert thin.route_hour_classification == "INSUFFICIENT_COVERAGE"
    day = rollups.route_daily(trips).first()
    assert (day.observed_trip_count, day.evaluable_trip_count, day.sustained_late_trip_count, day.sustained_anomaly_rate_percent) == (6, 4, 2, 50.0)
    assert serving.kpis(rollups.route_daily(trips.where("trip_id = 'none'"))).first().sustained_rate_percent == 0.0
    assert [r.trip_id for r in serving.route_trips(trips, "r").collect()][:3] == ["five", "half", "less"]


def test_coverage_overlaps(spark):
    w = spark.createDataFrame([(at(0), at(90)), (at(7000), at(8000))], "window_start timestamp, window_end timestamp")
    spans = {"before": (-100, -50), "touch": (-50, 0), "start": (-50, 30), "inside": (10, 20), "end": (60, 120), "cover": (-10, 9000), "empty": (10, 10)}
    df = spark.createDataFrame([(k, at(a), at(b)) for k, (a, b) in spans.items()], "k string, a timestamp, b timestamp")
    got = {r.k: r.covered_seconds for r in coverage.overlap_seconds(df, ["k"], "a", "b", w).collect()}
    assert got == {"before": 0, "touch": 0, "start": 30, "inside": 10, "end": 30, "cover": 1090, "empty": 0}


def test_coverage_windows_at_the_gap(spark):
    df = spark.createDataFrame([(at(x),) for x in (0, 90, 181, 200)], "ts timestamp")
    assert sorted(r.snapshot_count for r in coverage.coverage_windows(df, "ts").collect()) == [2, 2]


def test_folding_priorities_and_duplicates(spark):
    rows = spark.createDataFrame([("a", 5, None, 1), ("a", 3, None, None), ("b", None, 2, 2), (None, 1, 1, 1)], "k string, move int, x int, y int")
    assert {tuple(r) for r in dedup.fold_rows(rows, ["k"], ["move"], ["y"]).collect()} == {("a", 3, None, 1), ("b", None, 2, 2)}
    assert [tuple(r) for r in dedup.duplicate_keys(rows, ["k"]).collect()] == [("a", 2)]
    m = lambda n: spark.createDataFrame([("e", "f", date(2026, 3, n), at(n))], "event_key string, feed_checksum string, service_date date, created_at timestamp")
    assert matching.union_matches(m(1), m(2)).first().match_source == "primary"


def test_signed_scores(spark):
    keys = "route_id string, direction_id int, stop_id string, is_weekend boolean, service_hour int"
    x = [(100, 5, "CERTAIN_LATE", 4.0), (100, 80, "POSSIBLE_LATE", 4.0), (15, 5, "NORMAL", 0.0), (-90, 5, "CERTAIN_EARLY", -5.0), (-15, 5, "NORMAL", -1.25), (-18, 5, "POSSIBLE_EARLY", -1.4)]
    f = spark.createDataFrame([("r", 0, "s", False, 8, a, u) for a, u, _, _ in x], keys + ", arrival_deviation_seconds long, arrival_uncertainty_seconds long")
    b = spark.createDataFrame([("r", 0, "s", False, 30, 15.0, 10.0, 30.0)], "route_id string, direction_id int, stop_id string, is_weekend boolean, arrival_deviation_seconds_count long, arrival_deviation_seconds_median double, arrival_deviation_seconds_p25 double, arrival_deviation_seconds_p75 double")
    hourly = b.where("false").withColumn("service_hour", F.lit(8))
    got = {r.arrival_deviation_seconds * 1000 + r.arrival_uncertainty_seconds: (r.anomaly_status, r.anomaly_score) for r in scoring.signed_scores(f, hourly, b).collect()}
    for a, u, status, score in x:
        want = (a - 30) / 20 if a > 30 else (a - 10) / 20 if a < 10 else 0.0
        assert got[a * 1000 + u] == (status, pytest.approx(want))


def test_names_and_assertions(spark):
    stops = spark.createDataFrame([("p", "Park", None), ("p1", None, "p"), ("q", None, None)], "stop_id string, stop_name string, parent_station string")
    assert {r.stop_id: r.stop_name for r in serving.parent_named(stops).collect()} == {"p": "Park", "p1": "Park", "q": "q"}
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", -1.0), (2, None, None)], "k int, c string, x double")
    assert quality.unique(df, ["k"]).count() == 1 and quality.one_of(df, "c", ["a"]).count() == 2 and quality.within(df, "x", 0, 9).count() == 1
    assert quality.never_null(df, ["c", "x"]).count() == 1 and quality.holds(df, F.col("x") > 0).count() == 2 and quality.references(df, df.where("k = 1"), ["k"]).count() == 1


def test_results_do_not_depend_on_row_order(spark):
    rows = [(i, f"{i % 7:064x}", at(i % 5), at(i % 3), f"e{i % 2}") for i in range(40)]

    @settings(max_examples=5, deadline=None)
    @given(st.permutations(rows))
    def check(order):
        df = spark.createDataFrame(order, "stage_row long, event_key string, ingestion_timestamp timestamp, feed_timestamp timestamp, entity_id string").repartition(3)
        assert {r.stage_row for r in dedup.dedup_events(df).collect()} == expected

    expected = {min((r[2], r[3], r[4], r[0]) for r in rows if r[1] == k)[3] for k in {r[1] for r in rows}}
    check()


def test_historical_features_end_of_trip_and_clock_rule(spark):
    h = spark.createDataFrame(
        [(date(2026, 3, 2), "ADDED-1", 1, "a", "r", 0, "v", at(0), at(-60), 36_000, 36_030), (date(2026, 3, 2), "ADDED-1", 2, "b", "r", 0, "v", at(300), at(90), 90_000, None)],
        "service_date date, trip_id string, stop_sequence int, stop_id string, route_id string, direction_id int, vehicle_id string, stop_timestamp timestamp, move_timestamp timestamp, scheduled_arrival_seconds int, scheduled_departure_seconds int",
    )
    rows = {r.stop_sequence: r for r in performance.historical_features(performance.historical_performance(performance.historical_events(h))).collect()}
    assert (rows[1].arrival_delay_seconds, rows[1].departure_delay_seconds, rows[1].dwell_estimate_seconds, rows[1].baseline_eligible) == (0, 60, 90, True)
    assert rows[2].departure_timestamp is None and rows[2].baseline_eligible is False
    clock = {r.stop_sequence: r for r in performance.clock_features(h).collect()}
    assert (clock[1].trip_type, clock[1].service_hour, clock[2].service_hour) == ("ADDED", 10, 1)


def test_checkpoint_folder_is_kept_once_set(spark):
    from headwaykit.session import checkpoint_dir, scratch, written

    assert scratch(spark, "x").startswith(checkpoint_dir(spark)) and checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    kept = written(spark.createDataFrame([(1, None)], "a int, b string"), "y")
    assert kept.collect() == [(1, None)] and all("headwaykit-" in f for f in kept.inputFiles())


def test_what_an_application_wrote_can_be_cleared(tmp_path):
    from headwaykit import session

    class Context:
        applicationId, _dir = "app-1", str(tmp_path)
        getCheckpointDir = lambda self: self._dir

    class Fake:
        sparkContext = Context()

    assert session.scratch(Fake(), "x").startswith(f"{tmp_path}/headwaykit-app-1/x-")
