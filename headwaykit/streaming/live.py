"""The pipeline on streams: what the batch functions give, kept up to date by micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headwaykit.functions.keys import canonical_key, event_identity
from headwaykit.operators.dedup import keep_first
from headwaykit.operators.inference import infer_stops
from headwaykit.operators.matching import GRAIN, match_schedule
from headwaykit.operators.panes import apply_batch, compose_windows, new_arrivals, pane_sums
from headwaykit.operators.performance import stop_features, stop_performance
from headwaykit.operators.scoring import score_stops
from headwaykit.operators.upsert import _exists, insert_only, upsert
from headwaykit.session import written


def once_within(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Events once each, as long as their copies come within the delay of event time. State is bounded by it."""
    keyed = events.withColumn("_key", canonical_key(F.col("event_key")))
    return keyed.withWatermark("ingestion_timestamp", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def pane_stream(events: DataFrame, group: str = "route_id", period: str = "15 minutes", lateness: str = "2 hours") -> DataFrame:
    """Counts per group and period of event time, corrected by late events up to `lateness`, later ones ignored.

    Each event counts once: keys are kept for good, since a copy may come at any time; events without
    key count each. Spark's own window aggregate, late by the watermark; of copies in one micro-batch any
    may be the one that counts. pane_updates counts by first arrival and by panes.
    """
    alone = F.encode(F.concat(F.lit("row:"), F.expr("uuid()")), "UTF-8")
    once = events.withColumn("_key", F.coalesce(canonical_key(F.col("event_key")), alone)).dropDuplicates(["_key"])
    timed = once.where(F.col(group).isNotNull()).withColumn("event_time", F.coalesce("vehicle_timestamp", "feed_timestamp"))
    return timed.withWatermark("event_time", lateness).groupBy(group, F.window("event_time", period)).agg(F.count("*").alias("n"))


def pane_updates(
    events: DataFrame,
    path: str,
    give: Callable[[DataFrame, int], None],
    checkpoint: str,
    window_s: int = 900,
    slide_s: int = 900,
    group: str = "route_id",
    publish_after_s: int = 300,
    correct_until_s: int = 7200,
) -> StreamingQuery:
    """What corrected_periods gives, on a stream: hands the windows that a micro-batch changes to `give`.

    The ledgers of first arrivals and the panes' counts are stored in `path` by micro-batch; a batch that
    is run again reads those before it only and writes its own anew. The events need stage_row. A window with
    zeros is withdrawn.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession

        def before(kind: str) -> DataFrame | None:
            place = f"{path}/{kind}"
            return spark.read.parquet(place).where(F.col("batch") < number).drop("batch") if _exists(spark, place) else None

        def store(rows: DataFrame, kind: str) -> DataFrame:
            own = f"{path}/{kind}/batch={number}"
            rows.write.mode("overwrite").parquet(own)
            return spark.read.schema(rows.schema).parquet(own)

        ledger = store(new_arrivals(batch, before("ledgers"), window_s, slide_s, group), "ledgers")
        state = before("panes")
        sums = store(pane_sums(ledger, group, window_s, correct_until_s), "panes")
        _, changed = apply_batch(state, sums, window_s, slide_s, group)
        give(compose_windows(changed, window_s, slide_s, group, publish_after_s, correct_until_s), number)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_stream(snapshots: DataFrame, ts: str, by: str, gap_s: int = 90) -> DataFrame:
    """Coverage windows per collector (`by`) on a stream: a session closes once the gap is past."""
    return snapshots.withWatermark(ts, f"{gap_s} seconds").groupBy(by, F.session_window(ts, f"{gap_s} seconds")).agg(F.count("*").alias("snapshot_count"))


def keep_earliest(batch: DataFrame) -> DataFrame:
    """Of an event's copies the one that arrived first, under its key's canonical form; a row without key stands for itself."""
    row = F.xxhash64(*sorted(batch.columns))
    keyed = batch.withColumn("_key", event_identity(F.col("event_key"), row))
    first = keep_first(keyed, ["_key"], [F.col("ingestion_timestamp").asc_nulls_last(), row.asc()])
    return first.withColumn("event_key", F.lower(F.hex("_key"))).drop("_key")


def land_events(stream: DataFrame, path: str, checkpoint: str, partition: str = "ingestion_date") -> StreamingQuery:
    """Adds each micro-batch's new events to a stored table; a batch that is run again adds nothing.

    Of an event's copies in a batch the earliest is kept, under its key's canonical form, so that keys
    however written are held against the stored ones. A row without key stands for itself.
    """

    def write(batch: DataFrame, _: int) -> None:
        dated = keep_earliest(batch).withColumn(partition, F.to_date("ingestion_timestamp"))
        insert_only(path, dated, ["event_key"], partition)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recompute_scopes(
    stream: DataFrame,
    scope: list[str],
    load: Callable[[SparkSession, DataFrame], DataFrame],
    compute: Callable[[DataFrame], DataFrame],
    path: str,
    keys: list[str],
    partition: str,
    checkpoint: str,
) -> StreamingQuery:
    """For the scopes (whole trips, say) that a micro-batch touches: load all their rows, compute, replace their results.

    load(spark, scopes) reads the rows of the given scopes; the same batch functions serve batch and stream.
    """

    def write(batch: DataFrame, _: int) -> None:
        scopes = batch.select(*scope).dropna().distinct()
        if scopes.isEmpty():
            return
        upsert(path, compute(load(batch.sparkSession, scopes)), keys, partition, scope)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_scores(
    stream: DataFrame,
    events: str,
    schedule: Callable[[SparkSession], DataFrame],
    baselines: Callable[[SparkSession], DataFrame],
    scores: str,
    checkpoint: str,
    observe: Callable[[DataFrame, int], None] = lambda changed, number: None,
) -> StreamingQuery:
    """The live chain on a stream: new events are landed, their trips matched, inferred and scored again, whole, and stored.

    events and scores are the places of the stored tables; schedule and baselines load theirs, as they are when a batch
    comes. observe gets the scores a batch changed. A batch that is run again lands nothing and stores the same scores.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed = written(keep_earliest(batch), "batch")
        insert_only(events, keyed.withColumn("ingestion_date", F.to_date("ingestion_timestamp")), ["event_key"], "ingestion_date")
        trips = written(keyed.select("trip_id").dropna().distinct(), "trips")
        if trips.isEmpty():
            return
        known = spark.read.parquet(events).join(trips, "trip_id", "left_semi")
        timetable = schedule(spark)
        matches = match_schedule(known, timetable)
        features = stop_features(stop_performance(infer_stops(matches), timetable), matches)
        changed = written(score_stops(features, baselines(spark)), "scores")
        upsert(scores, changed, GRAIN, "service_date", ["trip_id"])
        observe(changed, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def emit(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Hands each micro-batch's changed rows to `write`, which must bear being given a batch twice."""
    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_memory(stream: DataFrame, name: str, mode: str) -> StreamingQuery:
    """Into a table in memory, for a look at small results."""
    return stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
