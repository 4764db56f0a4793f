"""Records paired with the nearest record in time of the same entity, within a tolerance.

The right side's instants become nearest-neighbour intervals: from the midpoint to the one before (or
the tolerance, if that is nearer) to the midpoint to the one after. The intervals of an entity do not
overlap, so the pairing is a range join: each interval is entered in the time slots it touches, each
left record looks into its one slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def neighbour_intervals(right: DataFrame, entity: str, instant: str, payload: list[str], tolerance_us: int, block_us: int = 86_400_000_000) -> DataFrame:
    """(entity, lo2, hi2, payload): twice the interval's bounds in microseconds, lo2 <= 2t < hi2 (the last one closed by +1).

    Neighbours further than twice the tolerance do not matter, so the window runs over blocks of time
    with copies of what is that near their borders, not over an entity's whole history. Rows of one
    instant count once, by their smallest payload. A record midway between two belongs to the later.
    """
    reach = 2 * tolerance_us
    once = (
        right.where(F.col(entity).isNotNull() & F.col(instant).isNotNull())
        .groupBy(entity, F.col(instant).alias("_at"))
        .agg(F.min(F.struct(*payload)).alias("_payload"))
    )
    block = lambda c: F.floor(c / F.lit(block_us)).cast("long")
    copies = once.withColumn("_own", block(F.col("_at"))).withColumn("_block", F.explode(F.sequence(block(F.col("_at") - reach), block(F.col("_at") + reach))))
    order = Window.partitionBy(entity, "_block").orderBy("_at")
    before, after = F.lag("_at").over(order), F.lead("_at").over(order)
    at = F.col("_at")
    return (
        copies.withColumn("lo2", F.greatest(2 * (at - tolerance_us), F.coalesce(before + at, 2 * (at - tolerance_us))))
        .withColumn("hi2", F.least(2 * (at + tolerance_us) + 1, F.coalesce(after + at, 2 * (at + tolerance_us) + 1)))
        .where("_own = _block")
        .select(entity, at.alias("matched_us"), "lo2", "hi2", *[F.col(f"_payload.{c}").alias(c) for c in payload])
    )


def match_nearest(left: DataFrame, right: DataFrame, entity: str, left_us: str, right_us: str, payload: list[str], tolerance_s: int, slot_s: int = 1800) -> DataFrame:
    """Left rows with the payload of the nearest right record of their entity, matched_us and distance_us.

    Times are microseconds. Left rows without entity or time, and those with nothing near enough, are
    left out; a distance of just the tolerance is near enough; repeated left rows each get their match.
    payload's and the added columns' names must not be among left's.
    """
    tolerance = tolerance_s * 1_000_000
    slot = lambda c: F.floor(c / F.lit(2 * slot_s * 1_000_000)).cast("long")
    intervals = neighbour_intervals(right, entity, right_us, payload, tolerance)
    index = intervals.withColumn("_slot", F.explode(F.sequence(slot(F.col("lo2")), slot(F.col("hi2") - 1))))
    probes = left.where(F.col(entity).isNotNull() & F.col(left_us).isNotNull()).withColumn("_slot", slot(2 * F.col(left_us)))
    return (
        probes.join(index, [entity, "_slot"])
        .where((2 * F.col(left_us) >= F.col("lo2")) & (2 * F.col(left_us) < F.col("hi2")))
        .withColumn("distance_us", F.abs(F.col(left_us) - F.col("matched_us")))
        .drop("_slot", "lo2", "hi2")
    )


def nearest_stops(events: DataFrame, schedule: DataFrame, zone: str = "America/New_York", tolerance_s: int = 600) -> DataFrame:
    """Each event (once, however often its row is repeated) with its nearest scheduled stop of the trip."""
    local = F.coalesce("scheduled_arrival_local", "scheduled_departure_local")
    stops = schedule.select(
        "trip_id", F.unix_micros(F.to_utc_timestamp(local.cast("timestamp"), zone)).alias("_scheduled_us"), "service_date", "stop_sequence"
    )
    once = events.select("event_key", "trip_id", F.unix_micros("vehicle_timestamp").alias("_event_us")).distinct()
    return match_nearest(once, stops, "trip_id", "_event_us", "_scheduled_us", ["service_date", "stop_sequence"], tolerance_s)
