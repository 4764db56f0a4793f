"""Stops and trips, late events, timestamps: hand-made cases and brute force."""

import random
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headwaykit.functions.geo import grid_cells, haversine
from headwaykit.functions.keys import canonical_key, first_arrivals, sieved, with_event_key
from headwaykit.functions.zones import installed_zones
from headwaykit.operators.dwell import CELL_EDGE, ChunkEncoder, VehicleStitcher, cell_runs, dwelling, margins, stops_and_trips, stops_and_trips_of_rows
from headwaykit.operators.panes import apply_batch, arrival_batches, compose_windows, corrected_by_batches, corrected_periods, pane_counts
from headwaykit.operators.timestamps import Normaliser, to_instants

PINGS = "stage_row long, event_key string, ingestion_timestamp timestamp, vehicle_id string, vehicle_timestamp timestamp, latitude double, longitude double, route_id string, feed_timestamp timestamp"
START = datetime(2026, 3, 1, 22, 0, tzinfo=timezone.utc)


def key(n: int) -> str:
    return f"{n:064x}"


def ping(n, vehicle, second, metres_north, metres_east=0.0, **more):
    at = START + timedelta(seconds=second)
    row = dict(stage_row=n, event_key=key(n), ingestion_timestamp=at, vehicle_id=vehicle, vehicle_timestamp=at, latitude=42 + metres_north / 111195, longitude=-71 + metres_east / 82600, route_id="r", feed_timestamp=at)
    return row | more


def frame(spark, rows):
    names = [c.split()[0] for c in PINGS.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], PINGS)


def found(spark, rows, **options):
    got = stops_and_trips(frame(spark, rows), **options).collect()
    zero = int(START.timestamp()) * 1_000_000
    return sorted((r.vehicle_id, r.kind, (r.start_us - zero) // 1_000_000, (r.end_us - zero) // 1_000_000) for r in got)


def test_stop_outlier_trip_and_silence(spark):
    rows = [ping(n, "v", 30 * n, 0) for n in range(8)]  # a stop of 210 s
    rows[4] |= {"latitude": 0.0, "longitude": 0.0}  # one fix elsewhere does not end it
    rows += [ping(10 + n, "v", 240 + 30 * n, 300 * (n + 1)) for n in range(4)]
    rows += [ping(20 + n, "v", 360 + 60 * n, 1500) for n in range(4)]  # a stop of 180 s
    rows += [ping(30 + n, "v", 2400 + 60 * n, 1500) for n in range(4)]  # after a silence, the same place
    rows += [dict(rows[0], stage_row=99, event_key=key(0).upper() + "\n")]  # sent again
    assert found(spark, rows) == [("v", "stop", 0, 210), ("v", "stop", 360, 540), ("v", "stop", 2400, 2580), ("v", "trip", 210, 360)]


def test_two_fixes_elsewhere_end_a_stop_and_short_stays_are_none(spark):
    rows = [ping(n, "v", 20 * n, 0) for n in range(6)] + [ping(10, "v", 130, 500), ping(11, "v", 140, 900)] + [ping(20 + n, "v", 160 + 20 * n, 0) for n in range(6)]
    assert found(spark, rows) == []


def test_trip_distance_leaves_out_impossible_fixes(spark):
    rows = [ping(n, "v", 60 * n, 0) for n in range(4)] + [ping(10 + n, "v", 240 + 60 * n, 500 * (n + 1)) for n in range(5)] + [ping(20 + n, "v", 540 + 60 * n, 3000) for n in range(4)]
    rows[6] |= {"latitude": 0.0, "longitude": 0.0}
    got = [r for r in stops_and_trips(frame(spark, rows)).collect() if r.kind == "trip"]
    assert len(got) == 1 and abs(got[0].distance_m - 3000) < 30


def test_chunks_equal_one_pass(spark):
    random.seed(5)
    rows, n = [], 0
    for vehicle in ("a", "b", "c"):
        at, place = 0, 0.0
        while at < 4 * 86_400:
            for _ in range(random.randint(1, 60)):
                n += 1
                wrong = random.random() < 0.03
                rows.append(ping(n, vehicle, at, place + random.gauss(0, 10) + wrong * 9e5, random.gauss(0, 10)))
                at += random.choice((5, 40, 200, 900))
            if random.random() < 0.2:
                at += 4000
            place += random.choice((220, 800))
    random.shuffle(rows)
    want = []
    zero = int(START.timestamp()) * 1_000_000
    for vehicle in ("a", "b", "c"):
        own = sorted((int(r["vehicle_timestamp"].timestamp()) * 1_000_000, r["stage_row"], r["latitude"], r["longitude"]) for r in rows if r["vehicle_id"] == vehicle)
        for kind, a, b in stops_and_trips_of_rows([(t, x, y) for t, _, x, y in own], 75.0, 180_000_000, 1_800_000_000):
            want.append((vehicle, kind, (a - zero) // 1_000_000, (b - zero) // 1_000_000))
    for chunk in (1800, 10_000, 86_400):
        assert found(spark, rows, chunk_s=chunk) == sorted(want), chunk
    assert len(want) > 50


def track(seed, n=600, paces=(0, 0, 0, 5, 20, 80, 100, 140, 200)):
    """A vehicle that drives, crawls, stands (for long, sometimes), falls silent and is wrongly placed now and then."""
    rng = random.Random(seed)
    t, y, rows, pace = 0, 0.0, [], 0
    for _ in range(n):
        if rng.random() < 0.05:
            pace = rng.choice(paces)
        t += rng.choice((5, 5, 20, 60)) if pace else rng.choice((20, 60, 300))
        t += 2500 if rng.random() < 0.005 else 0
        y += pace
        away = rng.choice((300, rng.uniform(5e5, 3e6))) if rng.random() < 0.03 else 0
        rows.append((t * 1_000_000, 42 + (y + rng.gauss(0, 8) + away) / 111195, -71 + rng.gauss(0, 8) / 82600))
    return rows


def runs_by_hand(rows):
    """Which pings are part of a dwell, by the plain rule over cells, ping by ping."""
    t, lat, lon = (np.array(c) for c in zip(*rows))
    start, segment, *cell = cell_runs(t, lat, lon, 75 * CELL_EDGE, 1_800_000_000)
    n = np.diff(np.append(start, len(t)))
    ends = [(int(t[a]), int(t[b - 1])) for a, b in zip(start, np.append(start[1:], len(t)))]
    beside = lambda i, j: abs(cell[1][i] - cell[1][j]) <= 1 and (cell[0][i] != cell[0][j] or abs(cell[2][i] - cell[2][j]) <= 1)

    def far(i, way):
        last, elsewhere, j = i, 0, i + way
        while 0 <= j < len(n) and segment[j] == segment[i]:
            if beside(i, j):
                last, elsewhere = j, 0
            else:
                elsewhere += n[j]
                if elsewhere > 1:
                    break
            j += way
        return last

    stay = [ends[far(i, 1)][1] - ends[far(i, -1)][0] >= 180_000_000 for i in range(len(n))]
    alone = [0 < i < len(n) - 1 and n[i] == 1 and stay[i - 1] and stay[i + 1] and segment[i - 1] == segment[i + 1] for i in range(len(n))]
    return start, (segment, *cell), [bool(a or b) for a, b in zip(stay, alone)], t


@pytest.mark.parametrize("seed", range(12))
def test_dwells_are_what_the_plain_rule_says(seed):
    start, cells, want, t = runs_by_hand(track(seed))
    assert dwelling(start, len(t), t, cells, 180_000_000).tolist() == want


def encoded(rows, chunk_us, **more):
    """The records of a vehicle's chunks, each fed with the pings it sees in uneven batches."""
    encoder = ChunkEncoder(75.0, 180_000_000, 1_800_000_000, 60.0, chunk_us, **more)
    seen = sum(margins(180_000_000, 1_800_000_000))
    for chunk in range((rows[0][0] - seen) // chunk_us, (rows[-1][0] + seen) // chunk_us + 1):
        part = [r for r in rows if chunk * chunk_us - seen <= r[0] <= (chunk + 1) * chunk_us + seen]
        if not part:
            continue
        encoder.load({name: pa.array(c) for name, c in zip(("t", "latitude", "longitude"), zip(*part))})
        encoder.start(("v", chunk))
        for a in range(0, len(part), 37):
            encoder.feed(a, min(a + 37, len(part)))
        encoder.finish()
    return encoder.take()


def stitched(batch):
    stitch = VehicleStitcher(75.0, 180_000_000, 1_800_000_000, 60.0)
    stitch.start(("v",))
    batch = pa.Table.from_batches([batch]).sort_by([("t0", "ascending"), ("seq", "ascending")]).combine_chunks().to_batches()[0]
    stitch.load({name: batch.column(k) for k, name in enumerate(batch.schema.names)})
    stitch.feed(0, batch.num_rows)
    stitch.finish()
    return [(r[1], r[2], r[3]) for r in stitch.rows], [(r[4], r[5]) for r in stitch.rows]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_change_no_row(seed):
    rows = track(seed, paces=(0, 0, 0, 120, 140, 200))
    want = stops_and_trips_of_rows(rows, 75.0, 180_000_000, 1_800_000_000)
    whole, facts = stitched(encoded(rows, 1 << 50))
    assert whole == want
    for hours in (1, 3, 7, 24):
        got, more = stitched(encoded(rows, hours * 3_600_000_000))
        assert got == want and [n for _, n in more] == [n for _, n in facts] and all(abs(a - b) < 0.01 for (a, _), (b, _) in zip(more, facts))
    for held in (50, 200):  # worked off piece by piece
        assert stitched(encoded(rows, 1 << 50, held=held))[0] == want


@pytest.mark.parametrize("metres", [20, 60, 80, 100, 140, 160, 300])
def test_a_moving_vehicle_melts_into_few_records(metres):
    rows = [(i * 5_000_000, 42 + i * metres / 111195, -71.0) for i in range(4000)]
    records = encoded(rows, 86_400_000_000)
    assert records.num_rows <= 3
    assert abs(sum(records.column(records.schema.get_field_index("path")).to_pylist()) - 3999 * metres) < 0.01 * 4000 * metres


def test_stops_of_dirty_and_empty_tables(spark):
    nulls = [ping(1, None, 0, 0), ping(2, "v", 0, 0, vehicle_timestamp=None), ping(3, "v", 0, 0, latitude=None), ping(4, "v", 0, 0, longitude=float("nan")), ping(5, "v", 0, 0, event_key=None)]
    assert found(spark, nulls) == [] and found(spark, []) == []
    rows = [ping(n, "v", 100 * n, 0, event_key=None) for n in range(3)]
    assert found(spark, rows) == [("v", "stop", 0, 200)]  # rows without a key are events of their own
    extra = frame(spark, rows).withColumns({"t": F.lit("x"), "day": F.lit("y"), "_event": F.lit(1)})
    assert stops_and_trips(extra).count() == 1


def test_grid_neighbourhood_holds_within_a_band():
    rng = np.random.default_rng(3)
    lat, lon = rng.uniform(-60, 60, 4000), rng.uniform(-179, 179, 4000)
    lat2, lon2 = lat + rng.normal(0, 4e-4, 4000), lon + rng.normal(0, 4e-4, 4000)
    b, r, c = grid_cells(lat, lon, 75 * 1.07)
    b2, r2, c2 = grid_cells(lat2, lon2, 75 * 1.07)
    for i in range(4000):
        if b[i] == b2[i] and haversine(lat[i], lon[i], lat2[i], lon2[i]) <= 150:
            assert abs(r[i] - r2[i]) <= 2 and abs(c[i] - c2[i]) <= 2


@pytest.mark.parametrize("text", ["{k}", " {k}", "{k}\n", "{K}", "sha256:{k}", "{a}-{b}"])
def test_keys_however_written(spark, text):
    k = "0123456789abcdef" * 4
    df = spark.createDataFrame([(text.format(k=k, K=k.upper(), a=k[:20], b=k[20:]),)], "k string").select(F.lower(F.hex(canonical_key(F.col("k")))))
    assert df.first()[0] == k


def test_event_key_parts(spark):
    rows = [("v", "t", "e", 5, 7), (None, "t", "e", 5, 7), ("v", None, "e", 0, 7), ("v", "t", "e", None, 7)]
    df = with_event_key(spark.createDataFrame(rows, "vehicle_id string, trip_id string, entity_id string, vehicle_timestamp_raw long, feed_timestamp_raw long"))
    import hashlib

    want = ["v|5|t", "None|5|t", "v|7|None|e", "v|7|t|e"]
    assert [r.event_key for r in df.collect()] == [hashlib.sha256(w.encode()).hexdigest() for w in want]


def test_first_arrival_wins(spark):
    rows = [ping(2, "later", 10, 0, event_key=key(1)), ping(3, "first", 0, 0, event_key=key(1).upper()), ping(1, "tie", 0, 0, event_key="x")]
    assert sorted(r.vehicle_id for r in first_arrivals(frame(spark, rows), ["vehicle_id"]).collect()) == ["first", "tie"]


@pytest.mark.parametrize("words", [1, 64, 1 << 17])
def test_sieve_keeps_every_key_of_the_batch(spark, words):
    batch = spark.createDataFrame([(key(i),) for i in range(0, 300, 3)] + [(None,)], "k string")
    history = spark.createDataFrame([(key(i), i) for i in range(2000)] + [(None, -1)], "event_key string, n int")
    got = {r.n for r in sieved(history, F.col("event_key"), batch, F.col("k"), words).collect()}
    assert got >= set(range(0, 300, 3)) and -1 not in got
    assert words < 1 << 17 or len(got) < 110
    assert sieved(history, F.col("event_key"), batch.where("false"), F.col("k"), words).count() == 0


def test_a_pane_has_a_row_for_all_that_is_too_late(spark):
    rows = [ping(i, "v", 0, 0, ingestion_timestamp=START + timedelta(seconds=20_000 + i)) for i in range(50)]
    assert [r.n for r in pane_counts(frame(spark, rows), 900, 900).collect()] == [50]


def arrivals(spark, n=400, seed=1):
    random.seed(seed)
    rows = []
    for i in range(n):
        at = random.randint(0, 4 * 3600)
        late = random.choice((5, 200, 1000, 5000, 9000))
        rows.append(ping(i, "v", at, 0, route_id=random.choice(("r", "q", None)), ingestion_timestamp=START + timedelta(seconds=at + late)))
        if random.random() < 0.3:
            rows.append(dict(rows[-1], stage_row=10_000 + i, ingestion_timestamp=START + timedelta(seconds=at + late + 60)))
        if random.random() < 0.1:
            rows[-1]["vehicle_timestamp"] = None
    return rows


@pytest.mark.parametrize("window,slide", [(900, 900), (1800, 900), (2700, 1200)])
def test_corrected_periods_against_brute_force(spark, window, slide):
    rows = arrivals(spark)
    first = {}
    for r in sorted(rows, key=lambda r: (r["ingestion_timestamp"], r["stage_row"])):
        first.setdefault(r["event_key"], r)
    want = {}
    for r in first.values():
        t = (r["vehicle_timestamp"] or r["feed_timestamp"]).timestamp()
        if r["route_id"] is None:
            continue
        k = (t // slide) * slide
        while k > t - window:
            late = r["ingestion_timestamp"].timestamp() - (k + window)
            c = want.setdefault((r["route_id"], int(k)), [0, 0, 0])
            c[0] += late <= 300
            c[1] += late <= 7200
            c[2] += late > 7200
            k -= slide
    got = {(r.route_id, r.period_start_s): [r.published_count, r.corrected_count, r.too_late_count] for r in corrected_periods(frame(spark, rows), window, slide).collect()}
    assert got == want


def test_panes_batch_by_batch_equal_all_at_once(spark):
    rows = [dict(r, event_key=key(i)) for i, r in enumerate(arrivals(spark, 200))]
    rows.sort(key=lambda r: r["ingestion_timestamp"])
    state, last = pane_counts(frame(spark, []), 1800, 900), {}
    for part in (rows[:100], rows[100:150], rows[150:]):
        state, changed = apply_batch(state, pane_counts(frame(spark, part), 1800, 900), 1800, 900)
        state = spark.createDataFrame(state.collect(), state.schema)
        last |= {(r.route_id, r.period_start_s): tuple(r) for r in compose_windows(changed, 1800, 900, "route_id", 300, 7200).collect()}
    got = sorted(map(tuple, compose_windows(state, 1800, 900, "route_id", 300, 7200).collect()), key=str)
    assert got == sorted(map(tuple, corrected_periods(frame(spark, rows), 1800, 900).collect()), key=str)


def test_keys_sent_again_in_later_batches_count_once(spark):
    rows = arrivals(spark, 120)
    late = [dict(r, stage_row=1000 + i, event_key=r["event_key"].upper(), ingestion_timestamp=r["ingestion_timestamp"] + timedelta(minutes=40)) for i, r in enumerate(rows[:60])]
    whole = frame(spark, rows + late)
    want = sorted(map(tuple, corrected_periods(whole, 1800, 900).collect()), key=str)
    parts = arrival_batches(whole, 4)
    assert sum(p.count() for p in parts) == len(rows) + len(late)
    assert sorted(map(tuple, corrected_by_batches(parts, 1800, 900).collect()), key=str) == want
    assert sorted(map(tuple, corrected_by_batches(parts[::-1], 1800, 900).collect()), key=str) == want  # out of order
    assert corrected_by_batches(arrival_batches(whole.where("false"), 4)).count() == 0


CASES = [
    ("2026-03-01T10:00:00-05:00", "2026-03-01 15:00:00"), ("2026-03-01 10:00:00", "2026-03-01 15:00:00"), ('"2026-03-01 10:00:00.1239"', "2026-03-01 15:00:00.123900"),
    ("20260301100000", "2026-03-01 15:00:00"), ("20260301T150000Z", "2026-03-01 15:00:00"), ("1772377200", "2026-03-01 15:00:00"), ("1772377200.5", "2026-03-01 15:00:00.500000"),
    ("1772377200123", "2026-03-01 15:00:00.123000"), ("1772377200123456", "2026-03-01 15:00:00.123456"), ("/Date(1772377200000)/", "2026-03-01 15:00:00"),
    ("3/1/2026 10:00:00 AM", "2026-03-01 15:00:00"), ("01.03.2026 10:00", "2026-03-01 15:00:00"), ("March 1, 2026 at 10:00 am", "2026-03-01 15:00:00"),
    ("Sun, 01 Mar 2026 15:00:00 GMT", "2026-03-01 15:00:00"), ("01 Mar 2026 09:00:00 CST", "2026-03-01 15:00:00"), ("2026-03-01T20:30:00[Asia/Kolkata]\xa0", "2026-03-01 15:00:00"),
    ("2026-03-08 02:30:00", "2026-03-08 07:30:00"), ("2026-02-30 10:00:00", None), ("2026-13-01T00:00:00Z", None), ("0", None), ("", None), (None, None), ("N/A", None),
    ("1/0/1900 0:00", None), ("10:00:00", None), ("2026-03-01T10:00:00[Nowhere/Land]", None), ("0000-00-00 00:00:00", None), ("12/31/2026 12:00:00 AM", "2026-12-31 05:00:00"),
]


def test_texts_to_instants(spark):
    rows = [(i, t, "America/New_York", False, datetime(2026, 3, 1, 15, tzinfo=timezone.utc), "clash") for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "row long, txt string, z string, df boolean, near timestamp, text string")
    got = {r.id: r.s for r in to_instants(df, "row", "txt", "z", "df", "near").selectExpr("id", "cast(timestamp_micros(instant_us) as string) s").collect()}
    assert [got[i] if got[i] is None else (got[i] + (".000000" if "." not in got[i] else "000000"))[:26] for i in range(len(CASES))] == [w if w is None else (w + (".000000" if "." not in w else ""))[:26] for _, w in CASES]


def test_overlap_takes_the_nearest_reading_and_service_clocks_pass_midnight(spark):
    near = lambda h: datetime(2026, 11, 1, h, 31, tzinfo=timezone.utc)
    day = date(2026, 11, 1)
    rows = [(1, "2026-11-01 01:30:00", near(5), day), (2, "2026-11-01 01:30:00", near(6), day), (3, "24:30:00", near(6), day), (4, "88200", near(6), day), (5, "12:30 AM", datetime(2026, 11, 2, 5, 31, tzinfo=timezone.utc), day), (6, "12:30 AM", None, day), (7, "10:00:00", None, None)]
    df = spark.createDataFrame(rows, "id long, t string, near timestamp, d date").withColumns({"z": F.lit("America/New_York"), "df": F.lit(False)})
    got = {r.id: r.s for r in to_instants(df, "id", "t", "z", "df", "near", "d").selectExpr("id", "cast(timestamp_micros(instant_us) as string) s").collect()}
    assert got == {1: "2026-11-01 05:30:00", 2: "2026-11-01 06:30:00", 3: "2026-11-02 05:30:00", 4: "2026-11-02 05:30:00", 5: "2026-11-02 05:30:00", 6: "2026-11-01 04:30:00", 7: None}


def test_zone_tables_against_zoneinfo():
    from zoneinfo import ZoneInfo

    zones = installed_zones()
    rng = np.random.default_rng(0)
    for name in ("America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "UTC", "Africa/Casablanca", "Europe/Dublin", "Etc/GMT+5"):
        utc = rng.integers(-4_000_000_000, 30_000_000_000, 3000)
        info = ZoneInfo(name)
        local = np.array([int((d := datetime.fromtimestamp(int(u), info)).replace(tzinfo=timezone.utc).timestamp()) for u in utc])
        first, second = zones.readings(local, name, 1)
        assert ((first == utc) | (second == utc)).all()
    assert "-" in zones.version


#: Texts that only letters tell from others of the same classes, each with a good one of its kind.
LOOKALIKES = [
    ("2024-01-01X10:00:00Z", "2024-01-01T10:00:00Z"), ("/Data(1772377200000)/", "/Date(1772377200000)/"), ("March 1, 2026 xx 10:00 am", "March 1, 2026 at 10:00 am"),
    ("March 1, 2026 10:00 xm", "March 1, 2026 10:00 am"), ("01 Mar 2026 09:00:00 QQQ", "01 Mar 2026 09:00:00 CST"), ("01 Mxx 2026 09:00:00 CST", "01 Mar 2026 09:00:00 CST"),
    ("20260301X100000Z", "20260301T100000Z"), ("2026-03-01 10:00:00 Q", "2026-03-01 10:00:00 Z"), ("2026-03-01T10:00:00[No/Where]", "2026-03-01T10:00:00[Asia/Kolkata]"),
    ("2026-13-01T10:00:00Z", "2026-12-01T10:00:00Z"), ("10:99:00 xm", "10:59:00 am"),
]


@pytest.mark.parametrize("order", [1, -1])
def test_texts_are_read_whatever_stands_before_them(order):
    read = lambda texts, by: by(pa.array(texts), pa.array(["America/New_York"] * len(texts)), *(np.zeros(len(texts), t) for t in (bool, np.int64, bool)), np.zeros(len(texts), np.int64))
    zones = installed_zones()
    alone = {t: [x.tolist() for x in read([t], Normaliser(True, zones))] for pair in LOOKALIKES for t in pair}
    assert all(alone[good][1] == [True] and alone[bad][1] == [False] for bad, good in LOOKALIKES)
    texts = [t for pair in LOOKALIKES for t in pair[::order]]
    value, known = read(texts, Normaliser(True, zones))  # all in one batch
    assert [[[v], [k]] for v, k in zip(value.tolist(), known.tolist()) if k] == [alone[t] for t in texts if alone[t][1][0]]
    assert known.tolist() == [alone[t][1][0] for t in texts]
    by = Normaliser(True, zones)  # one after the other
    assert [[x.tolist() for x in read([t], by)][1] for t in texts] == [alone[t][1] for t in texts]


def test_years_from_1_to_9999_and_very_long_texts():
    read = lambda t: Normaliser(False, installed_zones())(pa.array([t]), pa.array(["America/New_York"]), *(np.zeros(1, x) for x in (bool, np.int64, bool, np.int64)))
    seconds = lambda t: (lambda v, k: v[0] / 1e6 if k[0] else None)(*read(t))
    want = lambda *a: datetime(*a, tzinfo=timezone.utc).timestamp()
    assert seconds("2100-01-01T00:00:00Z") == want(2100, 1, 1) and seconds("9999-12-31T23:59:59Z") == want(9999, 12, 31, 23, 59, 59) and seconds("0001-01-01T00:00:00Z") == want(1, 1, 1)
    assert seconds("2800-07-01 12:00:00") == want(2800, 7, 1, 16) and seconds("9998-01-01 12:00:00") == want(9998, 1, 1, 17) and seconds("1899-07-01 12:00:00") == want(1899, 7, 1, 17)
    assert seconds("2026-03-01T10:00:00." + "1" * 500 + "Z") == want(2026, 3, 1, 10) + 0.111111 and seconds("x" * 100_000) is None and seconds("\u0662\u0660\u0662\u0666-03-01T10:00:00Z") == want(2026, 3, 1, 10)
    assert seconds("9" * 19) is not None and seconds("2026-03-01T10:00:00[Etc/GMT+5]") == want(2026, 3, 1, 15)


def test_empty_timestamps(spark):
    df = spark.createDataFrame([], "id long, t string, near timestamp, z string, df boolean")
    assert to_instants(df, "id", "t", "z", "df", "near").count() == 0
