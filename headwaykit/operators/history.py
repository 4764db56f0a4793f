"""Past visits from raw daily files: the column contract, one row per visit, and the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from headwaykit.operators.dedup import canonical_rows
from headwaykit.sources.history_files import in_dates, write_partitioned

VISIT = ["service_date", "trip_id", "stop_sequence", "stop_id"]

#: The raw files' columns, their names here, and how they are read.
CONTRACT = [
    ("service_date", "service_date", "yyyymmdd"),
    ("route_id", "route_id", "string"),
    ("branch_route_id", "branch_route_id", "string"),
    ("trunk_route_id", "trunk_route_id", "string"),
    ("trip_id", "trip_id", "string"),
    ("stop_id", "stop_id", "string"),
    ("parent_station", "parent_station", "string"),
    ("stop_sequence", "stop_sequence", "int"),
    ("direction_id", "direction_id", "int"),
    ("direction", "direction", "string"),
    ("direction_destination", "direction_destination", "string"),
    ("vehicle_id", "vehicle_id", "string"),
    ("vehicle_label", "vehicle_label", "string"),
    ("vehicle_consist", "vehicle_consist", "string"),
    ("stop_count", "stop_count", "int"),
    ("start_time", "start_seconds", "int"),
    ("move_timestamp", "move_timestamp", "epoch"),
    ("stop_timestamp", "stop_timestamp", "epoch"),
    ("travel_time_seconds", "travel_time_seconds", "long"),
    ("dwell_time_seconds", "dwell_time_seconds", "long"),
    ("headway_branch_seconds", "headway_branch_seconds", "long"),
    ("headway_trunk_seconds", "headway_trunk_seconds", "long"),
    ("scheduled_arrival_time", "scheduled_arrival_seconds", "long"),
    ("scheduled_departure_time", "scheduled_departure_seconds", "long"),
    ("scheduled_travel_time", "scheduled_travel_time_seconds", "long"),
    ("scheduled_headway_branch", "scheduled_headway_branch_seconds", "long"),
    ("scheduled_headway_trunk", "scheduled_headway_trunk_seconds", "long"),
]


def _read(raw: DataFrame, name: str, kind: str) -> Column:
    if name not in raw.columns:
        return F.lit(None).cast({"yyyymmdd": "date", "epoch": "timestamp"}.get(kind, kind))
    column = F.col(name)
    if kind == "yyyymmdd":
        return F.to_date(F.try_to_timestamp(column.cast("string"), F.lit("yyyyMMdd")))
    if kind == "epoch":  # whole seconds
        return F.timestamp_seconds(column.cast("long"))
    return column.try_cast(kind)  # a boolean direction is 0 or 1


def contract(raw: DataFrame) -> DataFrame:
    """The raw rows under the contract: every column by name and type, null where a file lacks it or has a malformed value; others are dropped."""
    return raw.select(*[_read(raw, source, kind).alias(name) for source, name, kind in CONTRACT])


def canonical_history(raw: DataFrame, first: str | None = None, last: str | None = None, seen: dict[str, Observation] | None = None) -> DataFrame:
    """One row per visit in a range of service dates: earliest stop, then move, then a hash of the row.

    Rows without a part of the visit's key are left out. seen gets observations of how many rows came and stayed,
    counted while the result is written, not by passes of their own.
    """
    rows = in_dates(contract(raw), "service_date", first, last)
    keyless = ~(F.col(VISIT[0]).isNotNull() & F.col(VISIT[1]).isNotNull() & F.col(VISIT[2]).isNotNull() & F.col(VISIT[3]).isNotNull())
    if seen is not None:
        seen["read"] = Observation()
        rows = rows.observe(seen["read"], F.count("*").alias("rows"), F.count_if(keyless).alias("keyless"))
    kept = canonical_rows(rows, VISIT, ["stop_timestamp", "move_timestamp"])
    if seen is not None:
        seen["kept"] = Observation()
        kept = kept.observe(seen["kept"], F.count("*").alias("rows"))
    return kept


def store_history(raw: DataFrame, path: str, first: str | None = None, last: str | None = None, files: int = 32) -> dict[str, int]:
    """Writes canonical_history by service date and gives its counts: read, keyless, repeated, stored. Refuses to store nothing."""
    seen: dict[str, Observation] = {}
    stored = write_partitioned(canonical_history(raw, first, last, seen), path, "service_date", files)
    read = seen["read"].get
    return {"read": read["rows"], "keyless": read["keyless"], "repeated": read["rows"] - read["keyless"] - stored, "stored": stored}


def history_counts(raw: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The counts of store_history in one row, without storing."""
    rows = in_dates(contract(raw), "service_date", first, last)
    per = rows.groupBy(*VISIT).agg(F.count("*").alias("n"))
    keyed = F.col(VISIT[0]).isNotNull() & F.col(VISIT[1]).isNotNull() & F.col(VISIT[2]).isNotNull() & F.col(VISIT[3]).isNotNull()
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read"), F.coalesce(F.sum(F.when(~keyed, F.col("n"))), F.lit(0)).alias("keyless"),
        F.coalesce(F.sum(F.when(keyed, F.col("n") - 1)), F.lit(0)).alias("repeated"), F.count_if(keyed).alias("stored"),
        F.count_distinct(F.when(keyed, F.col("service_date"))).alias("service_dates"),
    )
