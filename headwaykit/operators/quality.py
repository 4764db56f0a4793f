"""Profiles of events and history, and assertions whose result must be empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import fractional_seconds
from headwaykit.operators.dedup import duplicate_keys
from headwaykit.operators.percentiles import exact_percentiles

STATUS_NAMES = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}


def status_name(status: Column) -> Column:
    return F.coalesce(*[F.when(status == code, F.lit(name)) for code, name in STATUS_NAMES.items()], F.lit("UNKNOWN"))


def overview(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count("*").alias("row_count"), F.count_distinct("service_date").alias("day_count"), F.min("service_date").cast("string").alias("first_date"),
        F.max("service_date").cast("string").alias("last_date"), F.count_distinct("service_date", "trip_id").alias("trip_count"),
    )


def missing_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls, NaN and blanks per column, one row per column."""
    kinds = dict(rows.dtypes)
    test = lambda c: F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.trim(c) == "" if kinds[c] == "string" else F.lit(False))
    counted = rows.agg(*[F.count_if(test(c)).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "missing_count")


def metric_profile(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """count, min, avg, max, exact p50/p95/p99 and negative count per metric. No metric is one task: see exact_percentiles."""
    one = lambda m: F.struct(F.lit(m).alias("metric"), F.when(~F.isnan(F.col(m).cast("double")), F.col(m).cast("double")).alias("v"))
    values = rows.select(F.explode(F.array(*map(one, metrics))).alias("m")).select("m.*")
    facts = values.groupBy("metric").agg(
        F.count("v").alias("n"), F.min("v").alias("least"), F.avg("v").alias("mean"), F.max("v").alias("most"), F.count_if(F.col("v") < 0).alias("negative_count")
    )
    q = exact_percentiles(values, ["metric"], "v", [0.5, 0.95, 0.99]).drop("n")
    return facts.join(q, "metric", "left").select(*facts.columns, *[F.col("q")[i].alias(p) for i, p in enumerate(("p50", "p95", "p99"))])


def trips_by_date(history: DataFrame) -> DataFrame:
    return history.groupBy("service_date").agg(F.count("*").alias("row_count"), F.count_distinct("trip_id").alias("trip_count"))


def status_histogram(events: DataFrame) -> DataFrame:
    return events.groupBy("current_status").agg(F.count("*").alias("event_count")).withColumn("status_name", status_name(F.col("current_status")))


def status_coverage(events: DataFrame, keys: list[str]) -> DataFrame:
    """Of the trip-stops: how many were seen stopped, in transit, both, or only one of them."""
    per_stop = events.groupBy(*keys).agg(F.max((F.col("current_status") == 1).cast("int")).alias("s"), F.max(F.col("current_status").isin(0, 2).cast("int")).alias("t"))
    return per_stop.agg(
        F.count("*").alias("trip_stops"), F.count_if(F.expr("s = 1")).alias("with_stopped"), F.count_if(F.expr("t = 1")).alias("with_transit"), F.count_if(F.expr("s = 1 and t = 1")).alias("with_both"),
        F.count_if(F.expr("s = 1 and t = 0")).alias("stopped_only"), F.count_if(F.expr("t = 1 and s = 0")).alias("transit_only"),
    )


def stopped_periods(stop_events: DataFrame) -> DataFrame:
    return stop_events.agg(F.count_if(F.expr("stopped_period_count = 1")).alias("one_period"), F.count_if(F.expr("stopped_period_count > 1")).alias("several_periods"), F.max("stopped_period_count").alias("most_periods"))


def with_previous(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], slot_s: int = 21_600) -> DataFrame:
    """keys, columns, and `before`, the columns' values on the row before in the order of its keys (null on the first).

    order begins with an instant. Lines are cut by time, so no key is one task: inside a slot a window gives the row
    before, a slot's first row has the last one of the slot before it that has any. Keys must not be null.
    """
    slot = F.coalesce(F.floor(F.unix_micros(order[0]) / F.lit(slot_s * 1_000_000)).cast("long"), F.lit(-(2**62)))
    placed = rows.select(*keys, slot.alias("_slot"), F.struct(*order).alias("_order"), F.struct(*columns).alias("_here"))
    line = Window.partitionBy(*keys, "_slot").orderBy("_order")
    inner = placed.select(*keys, "_slot", "_here", F.lag("_here").over(line).alias("_before"))
    lasts = placed.groupBy(*keys, "_slot").agg(F.max_by("_here", "_order").alias("_last"))  # a row per key and slot
    prior = lasts.select(*keys, "_slot", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slot")).alias("_earlier"))
    joined = inner.join(prior, [*keys, "_slot"])
    return joined.select(*keys, *[F.col(f"_here.{c}").alias(c) for c in columns], F.coalesce("_before", "_earlier").alias("before"))


def transitions(events: DataFrame, order: list[str]) -> DataFrame:
    """Steps between a vehicle's observations of one trip: how many, how many go back in sequence, and the rate."""
    steps = with_previous(events, ["vehicle_id", "trip_id"], order, ["current_stop_sequence"])
    steps = steps.select(F.col("current_stop_sequence").alias("now"), F.col("before.current_stop_sequence").alias("before")).where("now is not null and before is not null")
    return steps.agg(F.count("*").alias("step_count"), F.count_if(F.expr("now < before")).alias("backward_count")).withColumn("backward_percent", 100.0 * F.try_divide("backward_count", "step_count"))


def observation_gaps(events: DataFrame, order: list[str], longest_s: float = 60) -> DataFrame:
    steps = with_previous(events, ["vehicle_id", "trip_id"], order, ["vehicle_timestamp"])
    gaps = steps.select(fractional_seconds(F.col("vehicle_timestamp"), F.col("before.vehicle_timestamp")).alias("gap")).where((F.col("gap") > 0) & (F.col("gap") <= longest_s))
    facts = gaps.agg(F.count("*").alias("gap_count"), F.avg("gap").alias("mean_gap"), F.max("gap").alias("most_gap"))
    return _one_row(facts, gaps, "gap", {"p50_gap": 0.5, "p95_gap": 0.95})


def _one_row(facts: DataFrame, values: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row of facts with exact percentiles beside it, null if there are no values."""
    q = exact_percentiles(values, [], column, list(shares.values())).select(F.col("q"), F.lit(1).alias("_one"))
    joined = facts.withColumn("_one", F.lit(1)).join(q, "_one", "left")
    return joined.select(*facts.columns, *[F.col("q")[i].alias(name) for i, name in enumerate(shares)])


def event_quality(events: DataFrame) -> DataFrame:
    """Missing ids, missing and invalid positions, latency between vehicle and feed clock, in one row."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    rows = events.withColumn("_latency", fractional_seconds(F.col("feed_timestamp"), F.col("vehicle_timestamp")))
    latency = F.col("_latency")
    invalid = ~F.col("latitude").between(-90, 90) | ~F.col("longitude").between(-180, 180)
    facts = rows.agg(
        F.count("*").alias("event_count"), *[F.count_if(blank(c)).alias(f"missing_{c}") for c in ("vehicle_id", "trip_id", "route_id", "stop_id")],
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("missing_position"), F.count_if(invalid).alias("invalid_position"),
        F.count_if(latency < 0).alias("negative_latency"), F.avg(latency).alias("mean_latency"), F.max(latency).alias("most_latency"),
    )
    return _one_row(facts, rows, "_latency", {"p50_latency": 0.5, "p95_latency": 0.95})


def out_of_order(events: DataFrame, order: list[str]) -> DataFrame:
    """Vehicles' events whose own clock goes back in order of arrival."""
    steps = with_previous(events.where("vehicle_id is not null"), ["vehicle_id"], order, ["vehicle_timestamp"])
    steps = steps.select(F.col("vehicle_timestamp").alias("now"), F.col("before.vehicle_timestamp").alias("before"))
    return steps.agg(F.count_if(F.expr("before is not null")).alias("step_count"), F.count_if(F.expr("now < before")).alias("out_of_order_count"))


def recent(events: DataFrame, minutes: int, ts: str = "ingestion_timestamp") -> DataFrame:
    """The rows of the last minutes up to the newest one; of none, none."""
    newest = events.agg(F.max(ts)).first()[0]  # one value
    return events.where(F.col(ts) >= F.lit(newest) - F.expr(f"interval {int(minutes)} minutes")) if newest is not None else events.where("false")


def schema_of(rows: DataFrame) -> DataFrame:
    """One row per column: its place, name and type."""
    return rows.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema.fields, 1)], "position int, column_name string, kind string")


def sorted_sample(rows: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first n rows in order: a look at a table."""
    return rows.orderBy(*order).limit(n)


def worst_latency(events: DataFrame, n: int = 5) -> DataFrame:
    latency = fractional_seconds(F.col("feed_timestamp"), F.col("vehicle_timestamp"))
    return events.select("event_key", "vehicle_id", latency.alias("latency_seconds")).where("latency_seconds is not null").orderBy(F.desc("latency_seconds"), "event_key").limit(n)


def mismatched_dates(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows by file whose own date is not the file's, and files that no row came from."""
    counts = rows.groupBy("source_file", "service_date").agg(F.count("*").alias("row_count"))
    joined = files.join(counts, "source_file", "left")
    return joined.where("service_date is null or service_date <> file_date").select("source_file", "file_date", "service_date", F.coalesce("row_count", F.lit(0)).alias("row_count"))


# Assertions: each returns what violates it.


def unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(rows, keys)


def never_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return rows.where(condition)


def one_of(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return rows.where(F.col(column).isNull() | ~F.col(column).isin(allowed))


def within(rows: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows outside the closed range; null is not outside."""
    out = F.lit(False)
    if low is not None:
        out = out | (F.col(column) < low)
    if high is not None:
        out = out | (F.col(column) > high)
    return rows.where(out)


def holds(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows of which the condition is false or unknown."""
    return rows.where(~F.coalesce(condition, F.lit(False)))


def references(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(target.select(*keys), keys, "left_anti")


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(assertion, violations): how many rows each assertion gives."""
    counts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("assertion"), "violations") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, counts)
