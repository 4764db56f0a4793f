"""Runs of equal consecutive events, collapsed to one event each by a sorted state machine.

Events are cut into chunks of (vehicle, trip, six hours), so no entity is one task. The machine holds
the run's anchor (its status and stop sequence) against each event; runs that nothing before or after
the chunk can change are final, those at its ends go on as partial runs to a second pass of the same
machine per entity.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.arrow import Machine, sorted_stream
from headwaykit.functions.keys import first_arrivals

FIELDS = [
    ("vehicle_id", pa.string()), ("trip_id", pa.string()), ("t0", pa.int64()), ("t1", pa.int64()), ("n", pa.int64()),
    ("status", pa.int64()), ("sequence", pa.int64()), ("last", pa.int64()), ("apart", pa.bool_()), ("final", pa.bool_()),
]


class RunMachine(Machine):
    """Collapses (t0, t1, n, status, sequence, last); a None takes the value before it in the sequence.

    sequence is the run's anchor, last the value of its last event. In the first pass a chunk's start knows
    neither the values nor the anchor before it. Until an event comes that begins a run whatever the anchor is (after a
    gap, with another status, or further than twice the tolerance from the event before it), only equal
    events are put together, which any anchor would take or leave as one; these runs stay partial, and so does the first one
    that begins for certain. apart marks a partial run whose neighbour before it was final.
    """

    fields = FIELDS

    def __init__(self, gap_us: int, tolerance: int, last_pass: bool) -> None:
        super().__init__()
        self.gap, self.tolerance, self.last_pass = gap_us, tolerance, last_pass

    def load(self, columns: dict[str, pa.Array]) -> None:
        get = lambda name: columns[name].to_pylist()
        if self.last_pass:
            self.rec = list(zip(get("t0"), get("t1"), get("n"), get("status"), get("sequence"), get("last"), get("apart")))
            self.final = get("final")
        else:
            t, sequence = get("t"), get("current_stop_sequence")
            self.rec = list(zip(t, t, [1] * len(t), get("current_status"), sequence, sequence, [False] * len(t)))

    def start(self, key: tuple) -> None:
        super().start(key)
        self.cur = self.prev = self.status = self.sequence = None
        self.status_known = self.sequence_known = self.last_pass
        self.exact = self.tolerance > 0 and not self.last_pass
        self.head, self.dropped = True, False

    def close(self, more: bool) -> None:
        """Ends the current run; more: another run of the chunk follows."""
        *run, settled = self.cur
        final = self.last_pass or more and not self.head
        self.rows.append((*self.key[:2], *run, final))
        if settled:
            self.head = False
        self.dropped = final

    def feed(self, i: int, j: int) -> None:
        if self.last_pass and self.final[i]:
            self.rows += [(*self.key[:2], *rec, True) for rec in self.rec[i:j]]
            return
        for t0, t1, n, status, sequence, last, apart in self.rec[i:j]:
            fresh = self.prev is not None and t0 - self.prev > self.gap or apart
            if fresh:
                self.status = self.sequence = None
                self.status_known = self.sequence_known = True
            known = self.status_known and self.sequence_known
            self.prev = t1
            if status is not None:
                self.status_known = True
            else:
                status = self.status
            if sequence is not None:
                self.sequence_known = True
            else:
                sequence = self.sequence
            if last is None:
                last = sequence
            cur = self.cur
            if cur is not None and not fresh and cur[3] == status and self.alike(cur[4], sequence, 0 if self.exact else self.tolerance):
                cur[1], cur[5] = t1, last
                cur[2] += n
            else:
                if cur is not None:
                    self.close(True)
                if fresh or known and (self.status != status or not self.alike(self.sequence, sequence, 2 * self.tolerance)):
                    self.exact = False
                settled = self.status_known and self.sequence_known and not self.exact
                self.cur = [t0, t1, n, status, sequence, last, apart or self.dropped, settled]
            self.status, self.sequence = status, last

    @staticmethod
    def alike(a: int | None, b: int | None, tolerance: int) -> bool:
        return a is b if a is None or b is None else abs(a - b) <= tolerance

    def finish(self) -> None:
        if self.cur is not None:
            self.close(False)
        self.cur = None


def collapse_runs(events: DataFrame, max_step_s: int = 600, sequence_tolerance: int = 0, chunk_s: int = 21_600) -> DataFrame:
    """Maximal runs per (vehicle_id, trip_id): t0, t1 (microseconds), n, status, sequence.

    events: event_key, stage_row, ingestion_timestamp, vehicle_id, trip_id, vehicle_timestamp,
    current_status, current_stop_sequence; other columns are ignored. Each event counts once, by its
    first row that has vehicle, trip and time; rows that lack one are left out; events at one time go in
    order of stage_row. A step over max_step_s starts a new sequence. A null takes the value before it in
    its sequence, at the start of one it stays null, and null equals null only. An event belongs to a run
    if its status is the anchor's and its stop sequence differs from the anchor's by at most
    sequence_tolerance. chunk_s only sets how the work is cut and changes nothing. An empty table gives no rows.
    """
    usable = events.where("vehicle_id is not null and trip_id is not null and vehicle_timestamp is not null")
    once = first_arrivals(usable, ["vehicle_id", "trip_id", "vehicle_timestamp", "stage_row", "current_status", "current_stop_sequence"])
    steps = once.select(
        "vehicle_id", "trip_id", F.unix_micros("vehicle_timestamp").alias("t"), "stage_row",
        F.col("current_status").cast("long").alias("current_status"), F.col("current_stop_sequence").cast("long").alias("current_stop_sequence"),
    ).withColumn("chunk", F.floor(F.col("t") / F.lit(chunk_s * 1_000_000)).cast("long"))
    machine = partial(RunMachine, max_step_s * 1_000_000, sequence_tolerance)
    chunks = sorted_stream(steps, ["vehicle_id", "trip_id", "chunk"], ["t", "stage_row"], partial(machine, False), FIELDS)
    # Final runs pass through by chunk, so that an entity's second pass holds only the partial ones.
    part = F.when(F.col("final"), F.floor(F.col("t0") / F.lit(chunk_s * 1_000_000))).otherwise(-1).cast("long")
    joined = sorted_stream(chunks.withColumn("part", part), ["vehicle_id", "trip_id", "part"], ["t0"], partial(machine, True), FIELDS)
    return joined.drop("last", "apart", "final")
