"""Per-period aggregates by event time, corrected as late events arrive, by stream slicing.

Events are counted into panes: the non-overlapping slices between window borders (the greatest common
divisor of window length and slide). A late event changes one pane; a window is the sum of its panes
and only the windows over a changed pane are put together and given out again. An event counts once over
all batches: a ledger of first arrivals goes from batch to batch beside the panes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.keys import first_arrivals, sieved
from headwaykit.session import written


def pane_seconds(window_s: int, slide_s: int) -> int:
    return math.gcd(window_s, slide_s)


def event_epoch(vehicle_time: Column, feed_time: Column) -> Column:
    """Event time in microseconds: the vehicle's clock, else the feed's."""
    return F.unix_micros(F.coalesce(vehicle_time, feed_time))


def _place(window_s: int, slide_s: int) -> list[Column]:
    pane = pane_seconds(window_s, slide_s)
    us = event_epoch(F.col("vehicle_timestamp"), F.col("feed_timestamp"))
    return [
        (F.floor(us / F.lit(pane * 1_000_000)) * pane).cast("long").alias("pane_start_s"),
        F.ceil(F.unix_micros("ingestion_timestamp") / F.lit(1_000_000)).cast("long").alias("arrived_s"),
    ]


def pane_counts(events: DataFrame, window_s: int, slide_s: int, group: str = "route_id", correct_until_s: int = 7200) -> DataFrame:
    """(group, pane_start_s, arrived_s, n): events by pane and by the moment of their first arrival.

    Each event counts once, by its first arrival. arrived_s is rounded up to full seconds, so an event
    that came within a limit of full seconds stays within it. Rows without event time or group are out.
    """
    once = first_arrivals(events, [group, "vehicle_timestamp", "feed_timestamp", "ingestion_timestamp"])
    placed = once.select(group, *_place(window_s, slide_s)).withColumn("n", F.lit(1).cast("long"))
    return pane_sums(placed, group, window_s, correct_until_s)


def pane_sums(placed: DataFrame, group: str = "route_id", window_s: int = 900, correct_until_s: int = 7200) -> DataFrame:
    """(group, pane_start_s, arrived_s, n): what rows with a place and a number n, a ledger's say, add up to.

    What comes when all windows over its pane are closed is put to the second after that, so a pane has
    window_s + correct_until_s + 2 rows at most past its start, however many events come how late.
    """
    counting = F.col(group).isNotNull() & F.col("pane_start_s").isNotNull() & F.col("arrived_s").isNotNull()
    arrived = F.least("arrived_s", F.col("pane_start_s") + (window_s + correct_until_s + 1)).alias("arrived_s")
    return placed.where(counting).groupBy(group, "pane_start_s", arrived).agg(F.sum("n").alias("n"))


def new_arrivals(batch: DataFrame, known: DataFrame | None, window_s: int, slide_s: int, group: str = "route_id") -> DataFrame:
    """A batch's ledger: (_event, ingestion_timestamp, stage_row, group, pane_start_s, arrived_s, n).

    A row with n = 1 for each event that no ledger before (`known`, those of all earlier batches in one)
    has. An event that is known but came earlier than known, since batches are out of order, is moved: n = 1
    where it belongs, n = -1 where it was. Events without group or time have their row too, as they are spent.
    """
    order, place = ["ingestion_timestamp", "stage_row"], [group, "pane_start_s", "arrived_s"]
    once = first_arrivals(batch, [group, "vehicle_timestamp", "feed_timestamp", *order], identity="_event")
    now = once.select("_event", *order, group, *_place(window_s, slide_s))
    row = F.struct(*order, *place)
    if known is None:
        return now.withColumn("n", F.lit(1).cast("long"))
    before = sieved(known.where("n > 0"), F.col("_event"), now, F.col("_event")).select("_event", row.alias("_before"))
    # A moved event has several rows in the ledgers; the earliest holds.
    both = now.select("_event", row.alias("_now")).join(before, "_event", "left").groupBy("_event").agg(F.min("_now").alias("_now"), F.min("_before").alias("_before"))
    at = lambda c: F.struct(*[F.col(f"{c}.{o}") for o in order])
    fresh = both.where(F.col("_before").isNull() | (at("_now") < at("_before")))
    entry = lambda c, n: F.struct(F.col(c).alias("at"), F.lit(n).cast("long").alias("n"))
    entries = F.when(F.col("_before").isNull(), F.array(entry("_now", 1))).otherwise(F.array(entry("_now", 1), entry("_before", -1)))
    return fresh.select("_event", F.explode(entries).alias("_e")).select("_event", "_e.at.*", "_e.n")


def compose_windows(panes: DataFrame, window_s: int, slide_s: int, group: str, publish_after_s: int, correct_until_s: int) -> DataFrame:
    """Windows of the given panes: first published count, corrected count, what was too late, last correction.

    A pane's rows are spread to the windows that cover it (window_s / pane of them at most) and summed,
    so any set of changed panes recomposes just the windows over them. With a column `touched`, as apply_batch
    gives it, windows over no touched pane are left out: their other panes may be missing. Panes of n = 0 count nothing: a
    window of such panes only, whose events were moved, is given with zeros.
    """
    pane = pane_seconds(window_s, slide_s)
    first = F.ceil((F.col("pane_start_s") + pane - window_s) / F.lit(slide_s)).cast("long") * slide_s
    last = F.floor(F.col("pane_start_s") / F.lit(slide_s)).cast("long") * slide_s
    spread = panes.withColumn("period_start_s", F.explode(F.sequence(first, last, F.lit(slide_s).cast("long"))))
    late = F.col("arrived_s") - (F.col("period_start_s") + window_s)
    on_time, accepted = late <= publish_after_s, late <= correct_until_s
    correcting = F.when(accepted & ~on_time & (F.col("n") != 0), F.col("arrived_s"))
    marked = "touched" in panes.columns
    windows = spread.groupBy(group, "period_start_s").agg(
        F.sum(F.when(on_time, F.col("n")).otherwise(0)).alias("published_count"),
        F.sum(F.when(accepted, F.col("n")).otherwise(0)).alias("corrected_count"),
        F.sum(F.when(accepted, 0).otherwise(F.col("n"))).alias("too_late_count"),
        F.count_distinct(correcting).alias("corrections"),
        F.max(correcting).alias("last_correction_s"),
        *([F.max("touched").alias("_touched")] if marked else []),
    )
    return windows.where("_touched").drop("_touched") if marked else windows


def corrected_periods(
    events: DataFrame,
    window_s: int = 900,
    slide_s: int = 900,
    group: str = "route_id",
    publish_after_s: int = 300,
    correct_until_s: int = 7200,
) -> DataFrame:
    """Counts of events per group and window, as published and as corrected by late events.

    A window is published publish_after_s after its end and corrected until correct_until_s after it;
    what comes later is counted as too late only. Null groups, and events without any time, do not
    count; a repeated event counts at its first arrival. An empty table gives no rows.
    """
    panes = pane_counts(events, window_s, slide_s, group, correct_until_s)
    return compose_windows(panes, window_s, slide_s, group, publish_after_s, correct_until_s)


def apply_batch(state: DataFrame | None, batch_panes: DataFrame, window_s: int, slide_s: int, group: str = "route_id") -> tuple[DataFrame, DataFrame]:
    """(new state, panes of the windows to give out again) after a batch's pane counts are added to the state.

    batch_panes must hold no event of an earlier batch again: pane_sums of new_arrivals gives them so. The
    state is a log of such counts, to which the batch's are added and nothing is rewritten; where it is
    stored by batch, a file's bounds on pane_start_s tell whether it is read at all: panes outside the
    batch's are not. Only panes that a window of a changed pane also covers are given, `touched` where the batch
    changed them, so the rest of the history is neither shuffled nor recomposed.
    """
    pane = pane_seconds(window_s, slide_s)
    reach = window_s - pane
    around = F.sequence(F.col("pane_start_s") - reach, F.col("pane_start_s") + reach, F.lit(pane).cast("long"))
    near = (
        batch_panes.select(group, F.col("pane_start_s").alias("_pane"), F.explode(around).alias("pane_start_s"))
        .groupBy(group, "pane_start_s")
        .agg(F.max(F.col("_pane") == F.col("pane_start_s")).alias("touched"))
    )
    if state is None:
        log = concerned = batch_panes
    else:
        span = batch_panes.agg(F.min("pane_start_s").alias("a"), F.max("pane_start_s").alias("b")).first()
        log = state.unionByName(batch_panes)
        concerned = log.where(F.col("pane_start_s").between((span["a"] or 0) - reach, (span["b"] or 0) + reach))
    changed = concerned.join(near, [group, "pane_start_s"]).groupBy(group, "pane_start_s", "arrived_s").agg(F.sum("n").alias("n"), F.max("touched").alias("touched"))
    return log, changed


def arrival_batches(events: DataFrame, parts: int) -> list[DataFrame]:
    """The events in at most `parts` batches by ingestion time, of about equal size; one ingestion_timestamp is not split."""
    at = F.unix_micros("ingestion_timestamp")
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = sorted(set(events.agg(F.percentile_approx(at, shares, 1_000).alias("c")).first()["c"] or [])) if parts > 1 else []
    number = sum((F.coalesce(at > F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
    return [events.where(number == i) for i in range(len(cuts) + 1)]


def corrected_by_batches(
    batches: list[DataFrame],
    window_s: int = 900,
    slide_s: int = 900,
    group: str = "route_id",
    publish_after_s: int = 300,
    correct_until_s: int = 7200,
) -> DataFrame:
    """corrected_periods of all batches together, by increments: each window as it was last given out.

    Ledgers, panes and windows of each batch are written to the checkpoint folder. A batch sieves the
    ledgers before it by its keys and, of the panes, reads those about its own.
    """
    if not batches:
        raise ValueError("no batches")
    known = state = given = None
    for number, batch in enumerate(batches):
        ledger = written(new_arrivals(batch, known, window_s, slide_s, group), "ledger")
        sums = written(pane_sums(ledger, group, window_s, correct_until_s), "panes")
        state, changed = apply_batch(state, sums, window_s, slide_s, group)
        windows = written(compose_windows(changed, window_s, slide_s, group, publish_after_s, correct_until_s).withColumn("_batch", F.lit(number)), "windows")
        known = ledger if known is None else known.unionByName(ledger)
        given = windows if given is None else given.unionByName(windows)
    columns = [c for c in given.columns if c not in (group, "period_start_s", "_batch")]
    last = given.groupBy(group, "period_start_s").agg(F.max_by(F.struct(*columns), "_batch").alias("_last"))
    return last.select(group, "period_start_s", "_last.*").where("corrected_count + too_late_count > 0")
