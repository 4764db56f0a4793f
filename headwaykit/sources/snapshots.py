"""Vehicle-position snapshots (GTFS-realtime protobuf files) as rows, and which files are still to be read."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the trip descriptor's schedule_relationship.
RELATIONSHIPS = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}

ROWS = (
    "source_file string, entity_id string, vehicle_id string, trip_id string, route_id string, schedule_relationship string, direction_id int, latitude double, longitude double, "
    "stop_id string, current_stop_sequence int, current_status int, vehicle_timestamp_raw long, feed_timestamp_raw long, problem string"
)


def _varint(data: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("a varint is too long")


def fields(data: memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(field number, value) of a message: integers, or the bytes of strings, messages and fixed-width values."""
    at, end = 0, len(data)
    while at < end:
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 2, 5):
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            if at + size > end:
                raise ValueError("the message is cut short")
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


def message(data: memoryview | None) -> dict[int, int | memoryview]:
    """Last value by field number."""
    return dict(fields(data)) if data is not None else {}


def _text(value) -> str | None:
    return bytes(value).decode("utf-8", "replace") or None if value is not None else None


def _float(value) -> float | None:
    return struct.unpack("<f", value)[0] if value is not None else None


def decode(content: bytes) -> Iterator[tuple]:
    """Rows of a snapshot's entities that hold a vehicle. Absent or empty texts and a sequence of 0 are null; absent enums have their defaults."""
    header, entities = {}, []
    for number, value in fields(memoryview(content)):
        if number == 1:
            header = message(value)
        elif number == 2:
            entities.append(value)
    for raw in entities:
        entity = message(raw)
        if 4 not in entity:
            continue
        vehicle = message(entity[4])
        trip, position, who = message(vehicle.get(1)), message(vehicle.get(2)), message(vehicle.get(8))
        where = (_float(position.get(1)) or 0.0, _float(position.get(2)) or 0.0) if 2 in vehicle else (None, None)
        yield (
            _text(entity.get(1)), _text(who.get(1)), _text(trip.get(1)), _text(trip.get(5)), RELATIONSHIPS.get(trip.get(4, 0), "UNKNOWN"), trip.get(6, 0), *where,
            _text(vehicle.get(7)), vehicle.get(3) or None, vehicle.get(4, 2), vehicle.get(5, 0), header.get(3, 0),
        )


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 6 + [pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in ROWS.split(", ")]
    for batch in batches:
        rows = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                rows += [(path, *row, None) for row in decode(content)]
            except (ValueError, IndexError, struct.error) as problem:
                rows.append((path, *[None] * 13, str(problem)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)


def ingestion_time(path: Column) -> Column:
    """Instant in a file's name (yyyyMMddTHHmmssZ), null if there is none."""
    stamp = F.regexp_extract(path, r"(\d{8}T\d{6}Z)[^/]*$", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmssX"))


def candidate_files(files: DataFrame, registry: DataFrame | None, since: Column | None = None, max_files: int | None = None) -> DataFrame:
    """Files (with `path`) that carry a time, are not registered, and are not older than `since`; oldest first, at most max_files (0 or None: all)."""
    timed = files.withColumn("ingestion_timestamp", ingestion_time(F.col("path"))).where("ingestion_timestamp is not null")
    if registry is not None:
        timed = timed.join(registry.select(F.col("object_name").alias("path")), "path", "left_anti")
    if since is not None:
        timed = timed.where(F.col("ingestion_timestamp") >= since)
    ordered = timed.orderBy("ingestion_timestamp", "path")
    return ordered.limit(max_files) if max_files else ordered


def dated_folders(spark: SparkSession, path: str, since: date) -> list[str]:
    """The folders below path that are of a day (a name with yyyy-mm-dd or yyyymmdd in it) and not before `since`: only they are listed further."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.listStatus(root):
        named = re.search(r"(\d{4})-?(\d{2})-?(\d{2})", status.getPath().getName())
        if status.isDirectory() and named and "".join(named.groups()) >= since.strftime("%Y%m%d"):
            found.append(status.getPath().toString())
    return sorted(found)


def snapshot_files(spark: SparkSession, path: str, stream: bool = False, since: date | None = None) -> DataFrame:
    """Snapshot files below a folder, with `since` only in its folders of that day or later; a stream of them takes each file once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = (spark.readStream.schema(schema) if stream else spark.read).format("binaryFile")
    reader = reader.option("pathGlobFilter", "*.pb").option("recursiveFileLookup", "true")
    if since is None or stream:
        return reader.load(path)
    folders = dated_folders(spark, path, since)
    return reader.load(folders) if folders else spark.createDataFrame([], schema)


def _uint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _put(number: int, value) -> bytes:
    """A field: integers as varints, floats in four bytes, texts and messages with their length; nothing for None."""
    if value is None:
        return b""
    if isinstance(value, int):
        return _uint(number << 3) + _uint(value)
    if isinstance(value, float):
        return _uint(number << 3 | 5) + struct.pack("<f", value)
    data = value.encode() if isinstance(value, str) else value
    return _uint(number << 3 | 2) + _uint(len(data)) + data


def encode(feed_seconds: int | None, rows: list[dict]) -> bytes:
    """A snapshot of the rows, as decode reads it."""
    codes = {name: code for code, name in RELATIONSHIPS.items()}
    out = [_put(1, _put(1, "2.0") + _put(3, feed_seconds))]
    for r in rows:
        trip = _put(1, r["trip_id"]) + _put(4, codes.get(r["schedule_relationship"], 0)) + _put(5, r["route_id"]) + _put(6, r["direction_id"])
        place = None if r["latitude"] is None or r["longitude"] is None else _put(1, r["latitude"]) + _put(2, r["longitude"])
        who = _put(8, _put(1, r["vehicle_id"])) if r["vehicle_id"] is not None else b""
        vehicle = _put(1, trip) + _put(2, place) + _put(3, r["current_stop_sequence"]) + _put(4, r["current_status"]) + _put(5, r["vehicle_timestamp_raw"]) + _put(7, r["stop_id"]) + who
        out.append(_put(2, _put(1, r["entity_id"]) + _put(4, vehicle)))
    return b"".join(out)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content = [encode(seconds, rows) for seconds, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["path", "content"])


def encode_snapshots(rows: DataFrame, path: str, feed_seconds: str) -> DataFrame:
    """(path, content): one snapshot for each value of `path`, of all its rows (a snapshot is small: one look at a fleet)."""
    columns = ["entity_id", "vehicle_id", "trip_id", "route_id", "schedule_relationship", "direction_id", "latitude", "longitude", "stop_id", "current_stop_sequence", "current_status", "vehicle_timestamp_raw"]
    looks = rows.groupBy(F.col(path).alias("path")).agg(F.max(feed_seconds).alias("feed"), F.collect_list(F.struct(*columns)).alias("rows"))
    return looks.mapInArrow(_encode, "path string, content binary")


def decode_snapshots(files: DataFrame) -> DataFrame:
    """Rows of the files (path, content), with vehicle, feed and ingestion times; a broken file gives one row that names its problem."""
    seconds = lambda c: F.timestamp_seconds(F.nullif(F.col(c), F.lit(0).cast("long")))
    rows = files.select("path", "content").mapInArrow(_decode, ROWS)
    return rows.withColumns({
        "vehicle_timestamp": seconds("vehicle_timestamp_raw"), "feed_timestamp": seconds("feed_timestamp_raw"), "ingestion_timestamp": ingestion_time(F.col("source_file")),
    })
