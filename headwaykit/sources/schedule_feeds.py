"""Zipped schedule feeds as tables, one per member file, versioned by the zip's SHA-256."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import clock_seconds
from headwaykit.session import written

#: Member file, columns and, of these, which must not be blank.
MEMBERS: dict[str, tuple[str, list[str]]] = {
    "routes": ("route_id string, agency_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string", ["route_id"]),
    "stops": ("stop_id string, stop_name string, stop_lat double, stop_lon double, location_type int, parent_station string, platform_code string, wheelchair_boarding int", ["stop_id"]),
    "trips": ("trip_id string, route_id string, service_id string, trip_headsign string, direction_id int, block_id string, shape_id string, wheelchair_accessible int", ["trip_id"]),
    "stop_times": ("trip_id string, stop_sequence int, stop_id string, arrival_time string, departure_time string, pickup_type int, drop_off_type int, timepoint int", ["trip_id"]),
    "calendar": ("service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string", ["service_id"]),
    "calendar_dates": ("service_id string, date string, exception_type int", ["service_id"]),
    "feed_info": ("feed_version string, feed_start_date string, feed_end_date string", []),
}


def feed_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "modificationTime", "content", F.sha2("content", 256).alias("feed_checksum"))


def _member(batches: Iterator[pa.RecordBatch], member: str, columns: list[str], required: bool) -> Iterator[pa.RecordBatch]:
    names = ["feed_checksum", "source_object", *columns]

    def out(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in zip(*rows)], names=names)

    for batch in batches:
        for checksum, path, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                if member not in archive.namelist():
                    if required:
                        raise ValueError(f"{path} holds no {member}")
                    continue
                rows = []
                with archive.open(member) as raw:
                    for row in csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline="")):
                        rows.append([checksum, path, *((row.get(c) or "").strip() or None for c in columns)])
                        if member == "feed_info.txt":
                            break  # its first row counts
                        if len(rows) >= 20_000:
                            yield out(rows)
                            rows = []
                if rows:
                    yield out(rows)


def feed_table(files: DataFrame, member: str, required: bool = True) -> DataFrame:
    """A member's rows of every feed: blanks as null, numbers as numbers (null if malformed), rows without their id left out."""
    ddl, keys = MEMBERS[member]
    pairs = [c.split() for c in ddl.split(", ")]
    names = [n for n, _ in pairs]
    schema = "feed_checksum string, source_object string, " + ", ".join(f"{n} string" for n in names)
    read = partial(_member, member=f"{member}.txt", columns=names, required=required)
    rows = files.select("feed_checksum", "path", "content").mapInArrow(read, schema)
    typed = rows.select("feed_checksum", "source_object", *[F.col(n).try_cast(kind).alias(n) for n, kind in pairs])
    typed = typed.dropna(subset=keys) if keys else typed
    day = lambda c: F.to_date(F.try_to_timestamp(c, F.lit("yyyyMMdd")))
    if member == "stop_times":
        typed = typed.withColumns({"arrival_seconds": clock_seconds(F.col("arrival_time")), "departure_seconds": clock_seconds(F.col("departure_time"))})
    dates = {"calendar": ["start_date", "end_date"], "feed_info": ["feed_start_date", "feed_end_date"]}.get(member, [])
    typed = typed.withColumns({c: day(F.col(c)) for c in dates}) if dates else typed
    return typed.withColumn("service_date", day(F.col("date"))).drop("date") if member == "calendar_dates" else typed


def new_feeds(files: DataFrame, registered: DataFrame) -> DataFrame:
    return files.join(registered.select("feed_checksum"), "feed_checksum", "left_anti")


def register_feeds(files: DataFrame) -> DataFrame:
    """feed_checksum, file_path, feed_version, start and end date: the first row of feed_info, nulls if the feed has none. One row per feed."""
    info = feed_table(files, "feed_info", required=False)
    first = info.groupBy("feed_checksum").agg(*[F.min(c).alias(c) for c in ("feed_version", "feed_start_date", "feed_end_date")])  # copies of a feed are equal
    return files.groupBy("feed_checksum").agg(F.min("path").alias("file_path")).join(first, "feed_checksum", "left")


def next_feed(files: DataFrame, registered: DataFrame | None = None) -> DataFrame:
    """The oldest feed that is not registered (by time of its file, then name), or none."""
    rows = files if registered is None else new_feeds(files, registered)
    return rows.orderBy("modificationTime", "path").limit(1)


LOADED = ("routes", "stops", "trips", "stop_times", "calendar", "calendar_dates")


def load_feed(feed: DataFrame, path: str) -> DataFrame:
    """Loads one feed's six tables below path, all or nothing: a feed counts as loaded once it is registered, which comes last.

    What a failed load left is overwritten when the feed is loaded again. Gives the registry's new rows.
    """
    spark = feed.sparkSession
    one = written(feed, "feed")  # read once from the landing zone, not once per member
    for member in LOADED:
        table = feed_table(one, member, required=member not in ("calendar", "calendar_dates"))
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feed_checksum").parquet(f"{path}/{member}")
    rows = written(register_feeds(one), "registered")
    rows.write.mode("append").parquet(f"{path}/feeds")
    return spark.read.schema(rows.schema).parquet(f"{path}/feeds").join(rows.select("feed_checksum"), "feed_checksum", "left_semi")


def loaded_table(spark: SparkSession, path: str, member: str) -> DataFrame:
    """A loaded table, of registered feeds only."""
    feeds = spark.read.parquet(f"{path}/feeds").select("feed_checksum").distinct()
    return spark.read.parquet(f"{path}/{member}").join(feeds, "feed_checksum", "left_semi")


def feed_zip(members: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A feed's zip from columns and rows of its members: for small feeds, as samples and tests need them."""
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, (columns, rows) in members.items():
            text = io.StringIO()
            csv.writer(text).writerows([columns, *rows])
            archive.writestr(zipfile.ZipInfo(f"{name}.txt", (2026, 1, 1, 0, 0, 0)), text.getvalue())
    return content.getvalue()


def stop_dimension(files: DataFrame) -> DataFrame:
    """Stops by (feed_checksum, stop_id); of the same feed in several files the last file's row."""
    stops = feed_table(files, "stops")
    columns: list[Column] = [F.max_by(c, F.struct("source_object", "stop_name")).alias(c) for c in stops.columns if c not in ("feed_checksum", "stop_id")]
    return stops.groupBy("feed_checksum", "stop_id").agg(*columns)
