"""Stops and trips from location pings.

A vehicle's pings are laid on a hierarchical metric grid and encoded as runs of one cell. A run is part of a
dwell if the vehicle, from before it to after it, stayed in the neighbourhood of its cell for the least
time of a stop, one ping elsewhere not counted (hysteresis). That needs a few pings around a run
only, so it comes out the same wherever the work is cut. Dwells in a row are then classified by true distance: a
stretch within the radius of its own mean, long enough, is a stop. All else melts into motion
records with their length, and a second stream per vehicle, which holds one record at a time, joins stops by trips.

Vehicles are cut by time into chunks that see some of each other's pings. A dwell over a cut belongs to
one of the two chunks unless it goes on for over an hour on both sides; then each side gives its
part, and the parts are joined by the distance of their means.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.arrow import Machine, sorted_stream
from headwaykit.functions.geo import grid_cells, haversine, haversines
from headwaykit.functions.keys import first_arrivals

#: Edge of a cell as a multiple of the radius: positions within one radius of a place are in one neighbourhood of cells LEVEL levels up.
CELL_EDGE, LEVEL = 2.14 / 4, 2

#: Pings held at once before what is settled is worked off.
HELD = 1_000_000

#: A record is a list: start, end (microseconds), pings, sums of latitude and longitude, first and last position, path inside.
T0, T1, N, SLAT, SLON, LAT0, LON0, LAT1, LON1, PATH = range(10)


class Path:
    """Length of the way through positions; one that no vehicle could reach in time is left out, the first one too, unless the next one confirms it.

    first and last are the ends of the way. A record of several pings is confirmed by itself.
    """

    def __init__(self, max_speed: float) -> None:
        self.max_speed = max_speed
        self.reset()

    def reset(self) -> None:
        self.length, self.first, self.last, self.doubtful, self.sure = 0.0, None, None, None, False

    def _reachable(self, a: tuple, t: int, lat: float, lon: float) -> float | None:
        d = haversine(a[1], a[2], lat, lon)
        return d if d <= self.max_speed * (max(0, t - a[0]) / 1e6 + 1) else None

    def add(self, rec: list) -> None:
        t, lat, lon = rec[T0], rec[LAT0], rec[LON0]
        if self.last is None:
            self.first, self.sure = (lat, lon), rec[N] > 1
        else:
            d = self._reachable(self.last, t, lat, lon)
            if d is None and self.doubtful is not None and self._reachable(self.doubtful, t, lat, lon) is not None:
                if not self.sure:
                    self.first = self.doubtful[1:]
                d = haversine(self.doubtful[1], self.doubtful[2], lat, lon)
            if d is None and rec[N] == 1:
                self.doubtful = (rec[T1], rec[LAT1], rec[LON1])
                return
            self.length += d or 0.0
            self.sure = True
        self.length += rec[PATH]
        self.last, self.doubtful = (rec[T1], rec[LAT1], rec[LON1]), None

    def follow(self, t: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        """add of many pings; at once where each can be reached from the one before."""
        steps = haversines(lat[:-1], lon[:-1], lat[1:], lon[1:])
        self.add(ping(int(t[0]), float(lat[0]), float(lon[0])))
        if self.doubtful is None and (steps <= self.max_speed * (np.diff(t) / 1e6 + 1)).all():
            self.length, self.sure = self.length + float(steps.sum()), self.sure or len(steps) > 0
            self.last = (int(t[-1]), float(lat[-1]), float(lon[-1]))
            return
        for one in zip(t[1:].tolist(), lat[1:].tolist(), lon[1:].tolist()):
            self.add(ping(*one))


def ping(t: int, lat: float, lon: float) -> list:
    return [t, t, 1, lat, lon, lat, lon, lat, lon, 0.0]


class Dwell:
    """Splits dwells into stretches within the radius of their own mean: pings, or records of several, in order."""

    def __init__(self, radius: float, silence_us: int, sink) -> None:
        self.radius, self.silence, self.sink = radius, silence_us, sink
        self.reset()

    def reset(self) -> None:
        self.cur = self.pend = self.prev = None

    def near(self, run: list, rec: list) -> bool:
        n, m = run[N], rec[N]
        return haversine(run[SLAT] / n, run[SLON] / n, rec[SLAT] / m, rec[SLON] / m) <= self.radius

    @staticmethod
    def join(run: list, rec: list) -> None:
        run[T1], run[LAT1], run[LON1] = rec[T1], rec[LAT1], rec[LON1]
        run[N] += rec[N]
        run[SLAT] += rec[SLAT]
        run[SLON] += rec[SLON]

    def flush(self) -> None:
        for rec in (self.cur, self.pend):
            if rec is not None:
                self.sink.run(rec)
        self.cur = self.pend = None

    def feed(self, rec: list) -> None:
        if self.prev is not None and rec[T0] - self.prev > self.silence:
            self.flush()
            self.sink.silence()
        self.prev = rec[T1] if self.prev is None else max(self.prev, rec[T1])
        cur = self.cur
        if cur is None:
            self.cur = rec
        elif self.near(cur, rec):
            self.join(cur, rec)
            self.pend = None
        elif self.pend is None and rec[N] == 1:
            self.pend = rec
        else:
            self.sink.run(cur)
            pend, self.pend = self.pend, None
            if pend is None:
                self.cur = rec
            elif self.near(pend, rec):
                self.join(pend, rec)
                self.cur = pend
            elif rec[N] == 1:
                self.cur, self.pend = pend, rec
            else:
                self.sink.run(pend)
                self.cur = rec

    def feed_all(self, t: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        """feed of pings without a silence between; those that all join the current stretch at once."""
        i, n, block = 0, len(t), 16
        while i < n:
            cur = self.cur
            if cur is None or self.pend is not None or block < 16:
                self.feed(ping(int(t[i]), float(lat[i]), float(lon[i])))
                i, block = i + 1, 16
                continue
            y, x = lat[i : i + block], lon[i : i + block]
            slat, slon = np.cumsum(np.concatenate(([cur[SLAT]], y))), np.cumsum(np.concatenate(([cur[SLON]], x)))
            count = cur[N] + np.arange(len(y))
            far = np.flatnonzero(haversines(slat[:-1] / count, slon[:-1] / count, y, x) > self.radius)
            k = int(far[0]) if len(far) else len(y)
            if k:
                i += k
                cur[T1], cur[LAT1], cur[LON1], cur[N] = int(t[i - 1]), float(y[k - 1]), float(x[k - 1]), cur[N] + k
                cur[SLAT], cur[SLON], self.prev = float(slat[k]), float(slon[k]), int(t[i - 1])
            block = min(block * 2, 4096) if k == len(y) else 0


def cell_runs(t: np.ndarray, lat: np.ndarray, lon: np.ndarray, edge: float, silence: int) -> tuple[np.ndarray, ...]:
    """(start index, segment, band, row, column) of the runs of consecutive pings in one cell, LEVEL levels up; a silence begins a new segment and run."""
    band, row, column = grid_cells(lat, lon, edge)
    row, column = row >> LEVEL, column >> LEVEL
    gap = np.diff(t) > silence
    new = np.concatenate(([True], gap | (np.diff(band) != 0) | (np.diff(row) != 0) | (np.diff(column) != 0)))
    start = np.flatnonzero(new)
    segment = np.concatenate(([0], np.cumsum(gap)))
    return start, segment[start], band[start], row[start], column[start]


def reach(t0: np.ndarray, t1: np.ndarray, n: np.ndarray, cells: tuple[np.ndarray, ...], enough: int) -> np.ndarray:
    """How long (from t0, `enough` ends the search) the vehicle stays in the neighbourhood of each run's cell, one ping elsewhere not counted."""
    segment, band, row, column = cells
    until, pending, looking, d = t1.copy(), np.zeros(len(t0), dtype=bool), np.flatnonzero(t1 - t0 < enough), 1
    while len(looking):
        looking = looking[looking + d < len(t0)]
        j = looking + d
        same = segment[j] == segment[looking]
        looking, j = looking[same], j[same]
        beside = (np.abs(row[j] - row[looking]) <= 1) & np.where(band[j] == band[looking], np.abs(column[j] - column[looking]) <= 1, True)
        until[looking] = np.where(beside, t1[j], until[looking])
        go = np.where(beside, t1[j] - t0[looking] < enough, ~pending[looking] & (n[j] == 1))
        pending[looking] = ~beside
        looking, d = looking[go], d + 1
    return until - t0


def dwelling(start: np.ndarray, size: int, t: np.ndarray, cells: tuple[np.ndarray, ...], least: int) -> np.ndarray:
    """Which runs are part of a dwell of at least that time, single pings elsewhere between two of them included."""
    end = np.append(start[1:], size)
    t0, t1, n = t[start], t[end - 1], end - start
    ahead = reach(t0, t1, n, cells, least)
    back = reach(-t1[::-1], -t0[::-1], n[::-1], tuple(c[::-1] for c in cells), least)[::-1]
    stay = ahead + back - (t1 - t0) >= least
    segment = cells[0]
    alone = np.zeros(len(stay), dtype=bool)
    alone[1:-1] = (n[1:-1] == 1) & stay[:-2] & stay[2:] & (segment[:-2] == segment[2:])
    return stay | alone


RECORD_FIELDS = [
    ("vehicle_id", pa.string()), ("t0", pa.int64()), ("t1", pa.int64()), ("seq", pa.int64()), ("kind", pa.int64()), ("n", pa.int64()),
    ("slat", pa.float64()), ("slon", pa.float64()), ("lat0", pa.float64()), ("lon0", pa.float64()), ("lat1", pa.float64()), ("lon1", pa.float64()),
    ("path", pa.float64()), ("silent", pa.bool_()),
]

#: Kinds of records: a stop; a part of a dwell that goes on beyond a cut; motion.
STOP, PART, MOTION = range(3)


class ChunkEncoder(Machine):
    """First stream: pings of one (vehicle, chunk), with those of its neighbours near the cuts, to stops, motion records and parts of dwells."""

    fields = RECORD_FIELDS

    def __init__(self, radius: float, min_stop_us: int, silence_us: int, max_speed: float, chunk_us: int, held: int = HELD) -> None:
        super().__init__()
        self.radius, self.min_stop, self.silence_us, self.chunk, self.held = radius, min_stop_us, silence_us, chunk_us, held
        self.side, self.margin = margins(min_stop_us, silence_us)
        self.dwell, self.way = Dwell(radius, silence_us, self), Path(max_speed)

    def load(self, columns: dict[str, pa.Array]) -> None:
        self.columns = [columns[c].to_numpy(zero_copy_only=False) for c in ("t", "latitude", "longitude")]

    def start(self, key: tuple) -> None:
        super().start(key)
        self.low, self.high = key[1] * self.chunk, (key[1] + 1) * self.chunk
        self.begin()

    def begin(self) -> None:
        self.parts: list[list[np.ndarray]] = [[], [], []]
        self.count, self.limit, self.seq = 0, self.held, 0
        self.motion = None

    def feed(self, i: int, j: int) -> None:
        for part, column in zip(self.parts, self.columns):
            part.append(column[i:j])
        self.count += j - i
        if self.count > self.limit:
            self.settle()

    def settle(self) -> None:
        """Works off what is far enough from the last ping, as if the chunk were cut there, and keeps what the rest must see of it."""
        t, lat, lon = (np.concatenate(p) for p in self.parts)
        cut = int(t[-1]) - self.side - self.margin
        if cut > self.low:
            self.work(t, lat, lon, self.low, min(cut, self.high))
            self.low = min(cut, self.high)
            keep = t >= self.low - self.side - self.margin
            t, lat, lon = t[keep], lat[keep], lon[keep]
        self.parts, self.count = [[t], [lat], [lon]], len(t)
        self.limit = max(self.held, 2 * self.count)

    def finish(self) -> None:
        if self.count and self.low < self.high:
            self.work(*(np.concatenate(p) for p in self.parts), self.low, self.high)
        self._end_motion()
        self.begin()

    def work(self, t: np.ndarray, lat: np.ndarray, lon: np.ndarray, low: int, high: int) -> None:
        """Emits what belongs to the time from low to before high."""
        start, *cells = cell_runs(t, lat, lon, self.radius * CELL_EDGE, self.silence_us)
        stay = dwelling(start, len(t), t, tuple(cells), self.min_stop)
        segment = cells[0]
        # Dwells in a row: pings start[first] to before end[last].
        edge = np.concatenate(([True], (stay[1:] != stay[:-1]) | (segment[1:] != segment[:-1])))
        first = np.flatnonzero(edge)
        bounds = np.append(start[first], len(t)).tolist()
        for p, q, dwell, part in zip(bounds, bounds[1:], stay[first].tolist(), segment[first].tolist()):
            begin, end, open_left, open_right = self._owned(t, p, q, low, high) if dwell else (*np.searchsorted(t[p:q], (low, high)), False, False)
            if begin >= end:
                continue
            rows = slice(p + int(begin), p + int(end))
            if self.motion is not None and int(t[rows.start]) - self.motion[T1] > self.silence_us:
                self.motion_silent = True
            if dwell:
                self._classify(t[rows], lat[rows], lon[rows], open_left, open_right)
            else:
                self._move(t[rows], lat[rows], lon[rows])

    def _owned(self, t: np.ndarray, p: int, q: int, low: int, high: int) -> tuple[int, int, bool, bool]:
        """(from, to, open left, open right) of a dwell's pings p to q that belong to low..high.

        Of a dwell over a cut: all to the left chunk if it goes on for less than `side` after the cut, else all to the right one
        if it began less than that before, else each its side. Both chunks see enough to decide alike.
        """
        a, b, size = int(t[p]), int(t[q - 1]), q - p
        begin, end, open_left, open_right = 0, size, False, False
        if a < low:
            if b < low + self.side:
                return 0, 0, False, False
            if a <= low - self.side:
                begin, open_left = int(np.searchsorted(t[p:q], low)), True
        if b >= high:
            if a >= high or b >= high + self.side and a > high - self.side:
                return 0, 0, False, False
            if b >= high + self.side:
                end, open_right = int(np.searchsorted(t[p:q], high)), True
        return begin, end, open_left, open_right

    def _classify(self, t: np.ndarray, lat: np.ndarray, lon: np.ndarray, open_left: bool, open_right: bool) -> None:
        self.closed, self.loose = 0, 2 if open_left else 0
        self.dwell.reset()
        self.dwell.feed_all(t, lat, lon)
        if open_right:
            self.loose = self.closed + 2
        self.dwell.flush()

    def run(self, rec: list) -> None:
        self.closed += 1
        if self.closed <= self.loose:
            self._end_motion()
            self._emit(rec, PART)
        elif rec[N] > 1 and rec[T1] - rec[T0] >= self.min_stop:
            self._end_motion()
            self._emit(rec, STOP)
        else:
            self._begin_motion(rec)
            self.way.add(rec)

    def silence(self) -> None:
        """Dwells have none inside."""

    def _move(self, t: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        self._begin_motion([int(t[0]), int(t[-1]), len(t), 0.0, 0.0, float(lat[0]), float(lon[0]), float(lat[-1]), float(lon[-1]), 0.0])
        self.way.follow(t, lat, lon)

    def _begin_motion(self, rec: list) -> None:
        """Begins a motion record, or lengthens the one at hand; the way is for the caller to add."""
        if self.motion is None:
            self.motion, self.motion_silent = list(rec), False
            self.way.reset()
            return
        self.motion[T1] = rec[T1]
        self.motion[N] += rec[N]

    def _end_motion(self) -> None:
        if self.motion is not None:
            self.motion[PATH] = self.way.length
            self.motion[LAT0], self.motion[LON0] = self.way.first
            _, self.motion[LAT1], self.motion[LON1] = self.way.last
            self._emit(self.motion, MOTION, self.motion_silent)
            self.motion = None

    def _emit(self, rec: list, kind: int, silent: bool = False) -> None:
        self.seq += 1
        self.rows.append((self.key[0], rec[T0], rec[T1], self.key[1] * 10**9 + self.seq, kind, rec[N], rec[SLAT], rec[SLON], rec[LAT0], rec[LON0], rec[LAT1], rec[LON1], rec[PATH], silent))


def margins(min_stop_us: int, silence_us: int) -> tuple[int, int]:
    """(side, margin): a dwell is split at a cut only if it lasts `side` or more on both sides; what is `margin` away from all pings seen is known for certain."""
    margin = min_stop_us + 2 * silence_us + 1
    return max(margin, 3_600_000_000), margin


FOUND_FIELDS = [
    ("vehicle_id", pa.string()), ("kind", pa.string()), ("start_us", pa.int64()), ("end_us", pa.int64()),
    ("distance_m", pa.float64()), ("pings", pa.int64()), ("latitude", pa.float64()), ("longitude", pa.float64()),
]


class VehicleStitcher(Machine):
    """Second stream: the records of one vehicle to its stops and trips."""

    fields = FOUND_FIELDS

    def __init__(self, radius: float, min_stop_us: int, silence_us: int, max_speed: float) -> None:
        super().__init__()
        self.min_stop, self.way = min_stop_us, Path(max_speed)
        self.dwell = Dwell(radius, silence_us, self)

    def load(self, columns: dict[str, pa.Array]) -> None:
        names = ("t0", "t1", "n", "slat", "slon", "lat0", "lon0", "lat1", "lon1", "path")
        self.records = list(map(list, zip(*(columns[c].to_pylist() for c in names))))
        self.kind, self.silent = columns["kind"].to_pylist(), columns["silent"].to_pylist()

    def start(self, key: tuple) -> None:
        super().start(key)
        self.dwell.reset()
        self.stop, self.between = None, 0
        self.way.reset()

    def feed(self, i: int, j: int) -> None:
        for rec, kind, silent in zip(self.records[i:j], self.kind[i:j], self.silent[i:j]):
            if kind == PART:
                self.dwell.feed(rec)
                continue
            self.dwell.flush()
            if self.dwell.prev is not None and rec[T0] - self.dwell.prev > self.dwell.silence:
                self.silence()
            self.dwell.prev = rec[T1]
            if kind == STOP:
                self.run(rec)
                continue
            if silent:
                self.silence()
            self.between += rec[N]
            self.way.add(rec)

    def silence(self) -> None:
        self.stop = None
        self.way.reset()

    def run(self, rec: list) -> None:
        self.way.add(rec)
        if rec[N] < 2 or rec[T1] - rec[T0] < self.min_stop:
            self.between += rec[N]
            return
        if self.stop is not None:
            self.rows.append((self.key[0], "trip", self.stop, rec[T0], self.way.length, self.between, None, None))
        self.rows.append((self.key[0], "stop", rec[T0], rec[T1], 0.0, rec[N], rec[SLAT] / rec[N], rec[SLON] / rec[N]))
        self.stop, self.between = rec[T1], 0
        self.way.reset()
        self.way.last = (rec[T1], rec[LAT1], rec[LON1])

    def finish(self) -> None:
        self.dwell.flush()


def stops_and_trips(
    pings: DataFrame,
    radius_m: float = 75.0,
    min_stop_s: int = 180,
    silence_s: int = 1800,
    max_speed_ms: float = 60.0,
    chunk_s: int = 86_400,
) -> DataFrame:
    """Stops and trips per vehicle: vehicle_id, kind, start_us, end_us, duration_s, distance_m, pings, latitude, longitude.

    pings: event_key, stage_row, ingestion_timestamp, vehicle_id, vehicle_timestamp, latitude, longitude;
    other columns are ignored. Each event counts once, by its first row that has vehicle, time and
    position; rows that lack one (or whose position is NaN or infinite) are left out; pings at one time go in order
    of stage_row. A stop is a stay within radius_m of the mean of its pings for min_stop_s or more; one
    ping elsewhere or a silence of up to silence_s does not end it, two pings in a row elsewhere do. A
    trip joins two stops without a longer silence between; its distance leaves out pings that no vehicle
    could reach (max_speed_ms). chunk_s only sets how the work is cut. It changes nothing, but for a stay or a
    crawl that goes on for over an hour on both sides of a cut: it is looked at part by part, and two parts are
    one stop if their means lie within the radius. A task holds a million of a
    vehicle's pings, or those of about four hours where these are more. An empty table, or a vehicle that never stops, gives no rows.
    """
    infinite = lambda c: F.abs(c) == float("inf")
    usable = pings.where(
        F.col("vehicle_id").isNotNull() & F.col("vehicle_timestamp").isNotNull()
        & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & ~F.isnan("latitude") & ~F.isnan("longitude") & ~infinite("latitude") & ~infinite("longitude")
    )
    once = first_arrivals(usable, ["vehicle_id", "vehicle_timestamp", "stage_row", "latitude", "longitude"])
    args = (radius_m, min_stop_s * 1_000_000, silence_s * 1_000_000, max_speed_ms)
    chunk_us, seen = chunk_s * 1_000_000, sum(margins(*args[1:3]))
    chunk_of = lambda us: F.floor(us / F.lit(chunk_us)).cast("long")
    fixes = once.select("vehicle_id", F.unix_micros("vehicle_timestamp").alias("t"), "stage_row", "latitude", "longitude").withColumn(
        "chunk", F.explode(F.sequence(chunk_of(F.col("t") - seen), chunk_of(F.col("t") + seen)))
    )
    records = sorted_stream(fixes, ["vehicle_id", "chunk"], ["t", "stage_row"], partial(ChunkEncoder, *args, chunk_us), RECORD_FIELDS)
    found = sorted_stream(records, ["vehicle_id"], ["t0", "seq"], partial(VehicleStitcher, *args), FOUND_FIELDS)
    return found.withColumn("duration_s", (F.col("end_us") - F.col("start_us")) / 1e6)


def stops_and_trips_of_rows(rows: list[tuple[int, float, float]], radius: float, min_stop_us: int, silence_us: int) -> list[tuple[str, int, int]]:
    """The same over one vehicle's sorted (microseconds, latitude, longitude) without any cut; the tests' yardstick."""
    encoder = ChunkEncoder(radius, min_stop_us, silence_us, 60.0, 1 << 61, held=1 << 60)
    stitch = VehicleStitcher(radius, min_stop_us, silence_us, 60.0)
    t, lat, lon = (np.array(c) for c in zip(*rows))
    encoder.key = ("v", 0)
    encoder.begin()
    encoder.work(t, lat, lon, -(1 << 61), 1 << 61)
    encoder._end_motion()
    stitch.start(("v",))
    batch = encoder.take() if encoder.size() else None
    if batch is not None:
        stitch.load({name: batch.column(k) for k, name in enumerate(batch.schema.names)})
        stitch.feed(0, batch.num_rows)
    stitch.finish()
    return [(r[1], r[2], r[3]) for r in stitch.rows]
