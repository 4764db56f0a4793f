"""The landing zone: snapshots polled into files that are never rewritten, history files taken once, jobs run one at a time."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.operators.upsert import register


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_once(spark: SparkSession, path: str, content: bytes) -> bool:
    """Creates a file unless there is one; what is there stays as it is. Returns whether it was created."""
    place, files = _place(spark, path)
    if files.exists(place):
        return False
    try:
        out = files.create(place, False)
    except Exception as problem:  # another writer was first
        if files.exists(place):
            return False
        raise problem
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return True


def snapshot_path(root: str, at: datetime) -> str:
    """Place of a snapshot: a folder per UTC day, its time in its name, as ingestion_time reads it."""
    at = at.astimezone(timezone.utc)
    return f"{root.rstrip('/')}/{at:%Y-%m-%d}/{at:%Y%m%dT%H%M%SZ}.pb"


def poll(
    spark: SparkSession,
    fetch: Callable[[], bytes],
    root: str,
    cadence_s: float = 5.0,
    most: int | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    wait: Callable[[float], None] = time.sleep,
    failed: Callable[[Exception], None] = lambda problem: None,
) -> int:
    """Lands what `fetch` gives (an HTTP body, say) every cadence_s, `most` times (for good if None; 1 for once). Returns how many files were new.

    A failed fetch is reported and skipped, so one bad answer does not end the collection. The cadence is kept from start
    to start; two answers within one second land once.
    """
    landed = tried = 0
    while most is None or tried < most:
        begun = clock()
        try:
            landed += write_once(spark, snapshot_path(root, begun), fetch())
        except Exception as problem:
            failed(problem)
        tried += 1
        if most is None or tried < most:
            wait(max(0.0, cadence_s - (clock() - begun).total_seconds()))
    return landed


def new_history_files(files: DataFrame, registry: str, read: str = "content") -> DataFrame:
    """Registers files (path, content) by SHA-256 and gives those whose content was not known: object_name, checksum, bytes.

    A file that comes again under another name, or twice in one go, is taken once.
    """
    facts = files.select(F.sha2(read, 256).alias("checksum"), F.struct(F.col("path").alias("object_name"), F.octet_length(read).cast("long").alias("bytes")).alias("f"))
    once = facts.groupBy("checksum").agg(F.min("f").alias("f")).select("f.object_name", "checksum", "f.bytes")
    return register(registry, once, ["checksum"])


@contextmanager
def alone(spark: SparkSession, lock: str):
    """Runs its block unless another run holds the lock file; then BlockingIOError. The lock goes with the block."""
    if not write_once(spark, lock, datetime.now(timezone.utc).isoformat().encode()):
        raise BlockingIOError(f"another run holds {lock}")
    try:
        yield
    finally:
        place, files = _place(spark, lock)
        files.delete(place, False)


def run_job(spark: SparkSession, job: Callable[[], object], lock: str, retries: int = 1, delay_s: float = 60.0, wait: Callable[[float], None] = time.sleep) -> object:
    """Runs a job, one at a time, and again after a delay if it fails, `retries` times at most."""
    with alone(spark, lock):
        for left in range(retries, -1, -1):
            try:
                return job()
            except Exception:
                if not left:
                    raise
                wait(delay_s)
