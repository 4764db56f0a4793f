"""Keeping one row of several: by rank, by source priority, by folding, and against stored keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.functions.keys import event_identity


def keep_first(rows: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. Planned with a limit per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_events(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Earliest ingestion per event key (then feed time, entity, row), without those whose key is stored already."""
    last = lambda c: F.col(c).asc_nulls_last()
    keyed = raw.withColumn("_key", event_identity(F.col("event_key"), F.col("stage_row")))
    first = keep_first(keyed, ["_key"], [last("ingestion_timestamp"), last("feed_timestamp"), last("entity_id"), last("stage_row")])
    if existing is not None:
        stored = existing.where("event_key is not null").select(event_identity(F.col("event_key"), F.lit(0)).alias("_key"))
        first = first.join(stored, "_key", "left_anti")
    return first.withColumn("event_key", F.lower(F.hex("_key"))).drop("_key")


def keep_by_priority(rows: DataFrame, keys: list[str], source: str, priority: list[str], newest: str, ties: list[str]) -> DataFrame:
    """Row of the best source, the newest within it."""
    place = F.coalesce(*[F.when(F.col(source) == name, F.lit(i)) for i, name in enumerate(priority)], F.lit(len(priority)))
    return keep_first(rows, keys, [place.asc(), F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]])


def canonical_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key that has no null part: earliest by `order` with nulls last, ties by a hash of the whole row."""
    whole = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")) for c in sorted(rows.columns)])
    return keep_first(rows.dropna(subset=keys), keys, [*[F.col(c).asc_nulls_last() for c in order], whole.asc()])


def fold_rows(rows: DataFrame, keys: list[str], earliest: list[str], ties: list[str]) -> DataFrame:
    """One row per key: the one with most values set, but with the earliest of the given times of all."""
    others = [c for c in rows.columns if c not in keys]
    filled = sum((F.col(c).isNotNull().cast("int") for c in others), F.lit(0))
    best = F.max_by(F.struct(*others), F.struct(filled, *[F.col(c) for c in ties])).alias("_best")
    folded = rows.dropna(subset=keys).groupBy(*keys).agg(best, *[F.min(c).alias(f"_min_{c}") for c in earliest])
    return folded.select(*keys, *[F.col(f"_min_{c}").alias(c) if c in earliest else F.col(f"_best.{c}").alias(c) for c in others])


def only_value(column: Column) -> Column:
    """A group's value if it has just one, else null."""
    return F.when(F.count_distinct(column) == 1, F.max(column))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on several rows, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicate_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """In one row: keys on several rows, the rows they are on, and the most rows of one."""
    return duplicate_keys(rows, keys).agg(
        F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.max("row_count"), F.lit(0)).alias("most_rows")
    )
