"""New batches against all history: the same key, or nearly the same observation.

Nearly the same: same vehicle and trip, at most 2 s and 50 m apart. Both differences are metrics, so
each distance to a fixed pivot bounds them from below: two observations within reach differ by no more
than it in their distance to the pivot. The pivot-distance table holds, for every accepted point, its
distance in time to the epoch and in space to the fixed pivots, with the slots of the first two as
partition keys. A batch joins only the slots it touches, drops what the remaining pivot distances rule
out, verifies the true distance and appends its own points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.geo import distance_m
from headwaykit.functions.keys import canonical_key, event_identity, sieved
from headwaykit.session import written

#: Pivots (latitude, longitude), far from each other as seen from anywhere on the ground.
PIVOTS = ((0.0, 0.0), (0.0, 90.0), (89.0, 0.0))

#: Slots are a few times the reach: wider ones hold more pairs, narrower ones repeat more rows.
TIME_SLOTS, SPACE_SLOTS = 6, 8

#: Rounding in a haversine of up to half the Earth, in metres; added to the pruning bounds only.
SLACK_M = 0.01


def first_keys(records: DataFrame, registry: DataFrame | None) -> DataFrame:
    """stage_row of the records that first bring a key which is not in the registry; records without key among them.

    registry: `event_key` however written, or `key` as append_keys stores it. One aggregate by key over the
    records, combined before the shuffle, so copies cost nothing extra. The registry is read through a sieve of
    the records' keys: what they cannot meet is not shuffled.
    """
    # Both readers of `seen` below need all its columns, so they share its shuffle.
    seen = records.groupBy(event_identity(F.col("event_key"), F.col("stage_row")).alias("_key")).agg(
        F.min(F.struct(F.unix_micros("ingestion_timestamp").alias("i"), F.col("stage_row").alias("r"))).alias("_order")
    )
    if registry is not None:
        old = registry.select((F.col("key") if "key" in registry.columns else canonical_key(F.col("event_key"))).alias("_key"))
        asked = seen.where("_order is not null")
        seen = seen.join(sieved(old, F.col("_key"), asked, F.col("_key")), "_key", "left_anti")
    return seen.select(F.col("_order.r").alias("stage_row"))


def _is_whole() -> Column:
    given = [F.col(c).isNotNull() for c in ("vehicle_id", "trip_id", "vehicle_timestamp", "latitude", "longitude")]
    return reduce(Column.__and__, [*given, ~F.isnan("latitude"), ~F.isnan("longitude")])


def pivot_points(records: DataFrame, seconds: float, metres: float) -> DataFrame:
    """One row per distinct observation with its first record and its pivot distances.

    Records that repeat an observation exactly are represented by the first, so groups of copies never
    meet each other in a join.
    """
    points = records.where(_is_whole()).groupBy("vehicle_id", "trip_id", F.unix_micros("vehicle_timestamp").alias("t"), "latitude", "longitude").agg(
        F.min(F.struct(F.unix_micros("ingestion_timestamp").alias("i"), F.col("stage_row").alias("r"))).alias("first")
    )
    far = lambda p: distance_m(F.col("latitude"), F.col("longitude"), F.lit(p[0]), F.lit(p[1]))
    return points.withColumns({f"d{k}": far(p) for k, p in enumerate(PIVOTS)})


def _slot(distance: Column, width: float) -> Column:
    return F.floor(distance / F.lit(width)).cast("long")


def _entered(points: DataFrame, slot: str, distance: str, reach: float, width: float) -> DataFrame:
    """Each point in the slots within reach of it, two at most. As an array of two, of which no filter goes below the aggregate that all readers of the points share."""
    first, last = _slot(F.col(distance) - reach, width), _slot(F.col(distance) + reach, width)
    both = points.select("*", F.posexplode(F.array(first, last)).alias("_side", slot))
    return both.where((F.col("_side") == 0) | (first != last)).drop("_side")


def near_earlier(new: DataFrame, known: DataFrame, seconds: float, metres: float) -> DataFrame:
    """Points of `new` (vehicle_id, trip_id, t, latitude, longitude) with an earlier, different point of `known` within reach.

    Each new point lies in one slot of time and one of distance to the first pivot; each known point is
    entered in the slots within reach of it (at most two by two).
    """
    us, wide_t, wide_d = int(seconds * 1_000_000), seconds * 1_000_000 * TIME_SLOTS, metres * SPACE_SLOTS
    reach = metres + SLACK_M
    index = _entered(_entered(known, "_ts", "t", us, wide_t), "_ds", "d0", reach, wide_d).alias("k")
    probe = new.withColumn("_ts", _slot(F.col("t"), wide_t)).withColumn("_ds", _slot(F.col("d0"), wide_d)).alias("n")
    keys = [F.col(f"n.{c}") == F.col(f"k.{c}") for c in ("vehicle_id", "trip_id", "_ts", "_ds")]
    pruned = [F.abs(F.col(f"n.d{i}") - F.col(f"k.d{i}")) <= reach for i in range(len(PIVOTS))]
    true = distance_m(F.col("n.latitude"), F.col("n.longitude"), F.col("k.latitude"), F.col("k.longitude")) <= metres
    condition = (F.col("k.first") < F.col("n.first")) & (F.abs(F.col("n.t") - F.col("k.t")) <= us)
    for part in (*keys, *pruned, true):
        condition = condition & part
    return probe.join(index, condition, "left_semi").select("n.first")


def known_already(
    records: DataFrame,
    registry: DataFrame | None = None,
    known_points: DataFrame | None = None,
    seconds: float = 2.0,
    metres: float = 50.0,
) -> DataFrame:
    """stage_row of the records that repeat, exactly or nearly, something before them.

    Before them: the registry's keys, the points of known_points (earlier batches), and the records that
    come first by (ingestion_timestamp, stage_row). stage_row names a record: the same row given again is the same
    record, so it changes nothing. A null key repeats no key;
    a record that lacks vehicle, trip, time or position is near nothing. Earlier records count whether or
    not they were repeats. Empty tables give no rows; other columns are ignored.
    """
    points = written(pivot_points(records, seconds, metres), "points")  # read three times below
    known = points if known_points is None else points.unionByName(known_points)
    alone = points.select(F.col("first.r").alias("stage_row"), F.lit(1).alias("point"))
    near = near_earlier(points, known, seconds, metres).select(F.col("first.r").alias("stage_row"), F.lit(2).alias("point"))
    fresh = first_keys(records, registry).select("stage_row", F.lit(4).alias("point"))
    # All marks of a record in one aggregate: is it the first of its point (1), near an earlier one (2), the first of its key (4), whole (8)?
    base = records.select("stage_row", F.when(_is_whole(), 8).otherwise(0).alias("point"))
    bits = base.unionByName(alone).unionByName(near).unionByName(fresh).groupBy("stage_row").agg(F.bit_or("point").alias("bits"))
    bit = lambda n: F.col("bits").bitwiseAND(n) != 0
    return bits.where(~bit(4) | bit(8) & (~bit(1) | bit(2))).select("stage_row")


def append_points(batch: DataFrame, path: str, seconds: float = 2.0, metres: float = 50.0) -> None:
    """Adds a batch's points to the stored pivot-distance table, partitioned by day."""
    day = F.floor(F.col("t") / F.lit(86_400_000_000)).cast("long")
    pivot_points(batch, seconds, metres).withColumn("day", day).write.mode("append").partitionBy("day").parquet(path)


def append_keys(batch: DataFrame, path: str) -> None:
    """Adds a batch's keys to the stored registry, in their canonical bytes (`key`), of whatever spelling they were. Null keys go."""
    batch.select(canonical_key(F.col("event_key")).alias("key")).where("key is not null").distinct().write.mode("append").parquet(path)


def stored_points(spark, path: str, batch: DataFrame, seconds: float = 2.0) -> DataFrame:
    """The stored points of the days a batch touches: partitions of other days are not read."""
    us = int(seconds * 1_000_000)
    span = batch.agg(F.min(F.unix_micros("vehicle_timestamp")).alias("a"), F.max(F.unix_micros("vehicle_timestamp")).alias("b")).first()
    table = spark.read.parquet(path)
    if span["a"] is None:
        return table.where("false").drop("day")
    return table.where(F.col("day").between((span["a"] - us) // 86_400_000_000, (span["b"] + us) // 86_400_000_000)).drop("day")


def known_by_batches(batches: list[DataFrame], registry: DataFrame | None, points: str, keys: str, seconds: float = 2.0, metres: float = 50.0) -> DataFrame:
    """known_already of all batches, one after the other against what is stored: each appends its points and keys for the next.

    batches in order of ingestion. points and keys are the places of the stored tables. A batch reads the stored
    points of its days and sieves the stored keys; the registry of before, if any, is sieved alike.
    """
    found = None
    for number, batch in enumerate(batches):
        spark = batch.sparkSession
        stored = registry
        if number:
            own = spark.read.parquet(keys)
            old = None if registry is None else registry.select((F.col("key") if "key" in registry.columns else canonical_key(F.col("event_key"))).alias("key"))
            stored = own if old is None else own.unionByName(old)
        repeats = known_already(batch, stored, stored_points(spark, points, batch, seconds) if number else None, seconds, metres)
        found = written(repeats, "repeats") if found is None else found.unionByName(written(repeats, "repeats"))
        append_points(batch, points, seconds, metres)
        append_keys(batch, keys)
    if found is None:
        raise ValueError("no batches")
    return found
