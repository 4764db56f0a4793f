"""Merging rows into stored Parquet tables: insert only, update or insert, replace by scope.

Parquet has no row-level update, so the partitions that new rows touch are rewritten: read, merged,
written to a folder beside the table, then moved in by dynamic partition overwrite. A failure before the
last step leaves the table as it was; one in it can leave some partitions new and some old, and a repeated call
then gives the whole new table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.functions.keys import sieved
from headwaykit.operators.dedup import duplicate_keys
from headwaykit.session import written


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def new_rows(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not stored. Stored rows are read, but only those whose key may be among the new ones are shuffled."""
    key = F.xxhash64(*keys)
    return rows.join(sieved(stored.select(*keys), key, rows, key), keys, "left_anti")


def insert_only(path: str, rows: DataFrame, keys: list[str], partition: str) -> None:
    """Appends the rows whose key is not stored; the first batch that brings a key wins."""
    spark = rows.sparkSession
    if _exists(spark, path):
        rows = new_rows(spark.read.parquet(path), rows, keys)
    rows.write.mode("append").partitionBy(partition).parquet(path)


def register(path: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the rows whose key is not registered and gives just those: only they flow on.

    Of rows with one key in a batch, one is registered. The new rows are written once, so what is registered and what
    flows on are the same; a batch that is run again after it was registered gives none.
    """
    spark = rows.sparkSession
    once = rows.dropDuplicates(keys)
    fresh = written(new_rows(spark.read.parquet(path), once, keys) if _exists(spark, path) else once, "fresh")
    fresh.write.mode("append").parquet(path)
    return fresh


def register_files(path: str, rows: DataFrame, fresh: DataFrame, source: str = "source_file") -> DataFrame:
    """Registers the files that the rows came from: object_name, row_count and how many of their rows are among the fresh ones."""
    new = fresh.groupBy(F.col(source).alias("object_name")).agg(F.count("*").alias("new_row_count"))
    files = rows.groupBy(F.col(source).alias("object_name")).agg(F.count("*").alias("row_count")).join(new, "object_name", "left")
    return register(path, files.withColumn("new_row_count", F.coalesce("new_row_count", F.lit(0))), ["object_name"])


def upsert(path: str, rows: DataFrame, keys: list[str], partition: str, scope: list[str] | None = None, keys_stay: bool = False) -> None:
    """Replaces stored rows of equal keys (or of equal scope, if given) and adds the rest.

    Keys must be unique among the rows. Partitions that hold rows of the same keys (or scope) are rewritten too, so a row
    may move from one partition to another; finding them reads the table's key columns. Where a key never leaves its
    partition, keys_stay saves that. The values of rewritten partitions are few (dates), and are passed to the
    scan as literals.
    """
    spark = rows.sparkSession
    rows = written(rows, "upsert")
    if not duplicate_keys(rows, keys).isEmpty():
        raise ValueError("the new rows repeat a key")
    if not _exists(spark, path):
        rows.write.partitionBy(partition).parquet(path)
        return
    by = scope or keys
    touched = {r[0] for r in rows.select(partition).distinct().collect()}
    table = spark.read.parquet(path)
    if not keys_stay:
        key = F.xxhash64(*by)
        met = sieved(table.select(*by, F.col(partition).alias("_old")), key, rows, key).join(rows.select(*by).distinct(), by, "left_semi")
        touched |= {r[0] for r in met.select("_old").distinct().collect()}
    place = F.col(partition)
    stored = table.where(place.isin([t for t in touched if t is not None]) | (place.isNull() if None in touched else F.lit(False)))
    kept = stored.join(rows.select(*by).distinct(), by, "left_anti")
    side = f"{path.rstrip('/')}__next"
    kept.unionByName(rows.select(*kept.columns)).write.mode("overwrite").partitionBy(partition).parquet(side)
    whole = spark.read.schema(table.schema).parquet(side)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A partition that its last row left is not overwritten by anything.
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    left = {r[0] for r in whole.select(partition).distinct().collect()}
    for value in touched - left:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"), True)
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(side), True)


def update_from(rows: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with `columns` taken from updates where there is a row for their key."""
    new = updates.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows.join(new, keys, "left")
    return joined.withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*rows.columns)


def merged(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table after an upsert, as a plan: for reports and tests."""
    return stored.join(rows.select(*keys), keys, "left_anti").unionByName(rows.select(*stored.columns))
