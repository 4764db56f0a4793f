"""Parquet history: scans, file facts, and the partitioned sink."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_recursive(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder, folder names ignored."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def scan_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A folder of name=value folders; the names become columns and prune the scan."""
    return spark.read.parquet(path)


def file_facts(paths: list[str]) -> list[dict]:
    """Rows, row groups and columns from the footers alone."""
    import pyarrow.parquet as pq

    facts = []
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        facts.append({"path": path, "rows": meta.num_rows, "row_groups": meta.num_row_groups, "columns": meta.num_columns})
    return facts


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        facts = file_facts([p.removeprefix("file://").removeprefix("file:") for p in batch.column(0).to_pylist()])
        if facts:
            yield pa.RecordBatch.from_pylist([{**f, "path": p} for f, p in zip(facts, batch.column(0).to_pylist())], schema=pa.schema([("path", pa.string()), ("rows", pa.int64()), ("row_groups", pa.int64()), ("columns", pa.int64())]))


def all_file_facts(files: DataFrame) -> DataFrame:
    """file_facts of many files (`path`, on a file system all workers mount), read where the tasks run."""
    return files.select("path").repartition("path").mapInArrow(_facts, "path string, rows long, row_groups long, columns long")


def in_dates(rows: DataFrame, column: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Optional inclusive range of dates; on a partition column it prunes files."""
    rows = rows.where(F.col(column) >= F.lit(first).cast("date")) if first else rows
    return rows.where(F.col(column) <= F.lit(last).cast("date")) if last else rows


def write_partitioned(rows: DataFrame, path: str, partition: str, files: int = 32) -> int:
    """Overwrites just the partitions that the rows touch; refuses to write none. Returns the number of rows.

    A value's rows are spread over `files` files at most by a hash of the row, so one large day is not one task and a task
    that is run again places its rows as before. Rows are counted while they are written.
    """
    from pyspark.sql import Observation

    seen = Observation()
    spread = rows.withColumn("_file", F.pmod(F.xxhash64(*rows.columns), F.lit(files))).repartition(partition, "_file").drop("_file")
    counted = spread.observe(seen, F.count("*").alias("n"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    if not seen.get["n"]:
        raise ValueError("there are no rows to write")
    return seen.get["n"]


def conform(rows: DataFrame, schema: str) -> DataFrame:
    """The columns of a DDL schema, in its order and types; a column the rows lack is null, a malformed value too."""
    fields = StructType.fromDDL(schema).fields
    typed = lambda f: (F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
    return rows.select(*map(typed, fields))


def replace_table(rows: DataFrame, path: str, schema: str | None = None, partition: str | None = None, cluster: list[str] | None = None) -> DataFrame:
    """Truncate and load: the table at path becomes the rows, read back as they are stored.

    Written beside the table and moved in at the end, so the rows may come from the table itself and a failure
    before that leaves it as it was. cluster sorts inside files, as a clustered copy of an external table has it.
    """
    spark = rows.sparkSession
    loaded = conform(rows, schema) if schema else rows
    loaded = loaded.repartitionByRange(*cluster).sortWithinPartitions(*([partition] if partition else []), *cluster) if cluster else loaded
    side = f"{path.rstrip('/')}__next"
    writer = loaded.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(side)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (side, path))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"cannot move {side} to {path}")
    return spark.read.schema(loaded.schema).parquet(path)


def export_sorted(rows: DataFrame, path: str, partition: str, order: list[str]) -> None:
    """Sorted export by partition: files of a range each, sorted inside."""
    rows.repartitionByRange(partition, *order).sortWithinPartitions(partition, *order).write.mode("overwrite").partitionBy(partition).parquet(path)


def ask(spark: SparkSession, statement: str, **parameters) -> DataFrame:
    """A parameterised query: values are bound, not pasted; lists bind as arrays."""
    bound = {k: F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else v for k, v in parameters.items()}
    return spark.sql(statement, args=bound)


class Answers:
    """ask with a memory: the rows of small results, kept for a while (two minutes) under statement and parameters."""

    def __init__(self, spark: SparkSession, keep_s: float = 120.0, most_rows: int = 100_000, clock=time.monotonic) -> None:
        self.spark, self.keep_s, self.most_rows, self.clock = spark, keep_s, most_rows, clock
        self.known: dict[tuple, tuple[float, list]] = {}

    def __call__(self, statement: str, **parameters) -> list:
        key = (statement, repr(sorted(parameters.items())))
        now = self.clock()
        self.known = {k: v for k, v in self.known.items() if now - v[0] < self.keep_s}
        if key not in self.known:
            rows = ask(self.spark, statement, **parameters).limit(self.most_rows + 1).collect()
            if len(rows) > self.most_rows:
                raise ValueError(f"more than {self.most_rows} rows: not for a dashboard")
            self.known[key] = (now, rows)
        return self.known[key][1]
