"""Mergeable percentiles by deterministic buffer collapsing.

A summary is a set of sorted buffers of at most k values, each with a weight 2**level. Two full
buffers of one level collapse into one of the next: their merged values at every second position,
starting at the first and the second in turn by level. Summaries merge by pooling their buffers and
collapsing again, so parts and days can be combined. One collapse to level h moves a rank by at most
2**(h-1); with n values that adds up to at most n * levels / (2k), where levels = log2(n / k).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY = "level int, vals array<double>"


class Summary:
    """Buffers by level. Level 0 holds single values: up to k wait before they are a buffer."""

    __slots__ = ("k", "full", "loose")

    def __init__(self, k: int) -> None:
        self.k = k
        self.full: dict[int, np.ndarray] = {}
        self.loose: list[np.ndarray] = []

    def add(self, values: np.ndarray) -> None:
        """Adds single values; they are sorted in blocks of k, what is left waits."""
        self.loose.append(values)
        if sum(map(len, self.loose)) >= self.k:
            pool = np.concatenate(self.loose)
            whole = len(pool) // self.k * self.k
            for i in range(0, whole, self.k):
                self.push(0, np.sort(pool[i : i + self.k]))
            self.loose = [pool[whole:]] if whole < len(pool) else []

    def push(self, level: int, buffer: np.ndarray) -> None:
        """Adds a full sorted buffer, collapsing as a binary counter carries."""
        while level in self.full:
            merged = np.sort(np.concatenate((self.full.pop(level), buffer)), kind="stable")
            buffer = merged[level % 2 :: 2]
            level += 1
        self.full[level] = buffer

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """(level, values); loose values have level 0 and fewer than k values."""
        yield from self.full.items()
        if self.loose and sum(map(len, self.loose)):
            yield 0, np.sort(np.concatenate(self.loose))

    def merge(self, level: int, values: np.ndarray) -> None:
        if len(values) > self.k or level and len(values) != self.k:
            raise ValueError(f"a buffer of {len(values)} values at level {level} is not of summaries of {self.k}")
        if level == 0 and len(values) < self.k:
            self.add(values)
        else:
            self.push(level, values)


def error_bound(n: int, k: int) -> float:
    """Largest possible rank error as a share of n."""
    levels = max(0, int(np.ceil(np.log2(max(n, 1) / k))))
    return levels / (2 * k)


def _output(groups: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*groups)) if groups else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, kinds)], names=names)


def _build(batches: Iterator[pa.RecordBatch], k: int, limit: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Partial summaries of a task's rows. Beyond `limit` values in memory they are given out and begun anew."""
    summaries: dict[tuple, Summary] = defaultdict(lambda: Summary(k))
    held, kinds = 0, None

    def out() -> pa.RecordBatch:
        rows = [(*key, level, values) for key, s in summaries.items() for level, values in s.rows()]
        summaries.clear()
        return _output(rows, [*names, "level", "vals"], [*kinds, pa.int32(), pa.list_(pa.float64())])

    for batch in batches:
        if kinds is None:
            kinds = [batch.schema.field(c).type for c in names]
        keys = {c: batch.column(i).to_pandas() for i, c in enumerate(names)}
        frame = pd.DataFrame(keys, columns=names)
        values = batch.column(len(names)).to_numpy(zero_copy_only=False)
        order = frame.groupby(names, sort=False, dropna=False).indices if names else {(): np.arange(len(values))}
        columns = [batch.column(i) for i in range(len(names))]
        for index in order.values():
            first = int(index[0])
            summaries[tuple(c[first].as_py() for c in columns)].add(values[index])
        held += len(values)
        if held >= limit:  # held counts values read: an upper bound of what the summaries keep
            yield out()
            held = 0
    if kinds is not None and summaries:
        yield out()


def _merge(batches: Iterator[pa.RecordBatch], k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Merges the buffers of each group; rows come sorted by group and level, so smaller ones collapse first."""
    state, open_key, kinds, ready = None, None, None, []
    for batch in batches:
        if kinds is None:
            kinds = [batch.schema.field(c).type for c in names]
        columns = [batch.column(i).to_pylist() for i in range(len(names))]
        levels, lists = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1)
        for i in range(batch.num_rows):
            key = tuple(c[i] for c in columns)
            if key != open_key:
                if open_key is not None:
                    ready += [(*open_key, level, values) for level, values in state.rows()]
                state, open_key = Summary(k), key
            state.merge(levels[i], np.asarray(lists[i].values))
        if len(ready) > 5_000:
            yield _output(ready, [*names, "level", "vals"], [*kinds, pa.int32(), pa.list_(pa.float64())])
            ready = []
    if open_key is not None:
        ready += [(*open_key, level, values) for level, values in state.rows()]
    if ready:
        yield _output(ready, [*names, "level", "vals"], [*kinds, pa.int32(), pa.list_(pa.float64())])


def _schema(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in names), SUMMARY])


def summarise(rows: DataFrame, groups: list[str], value: str, k: int = 256, held: int = 4_000_000, fan_in: int = 16) -> DataFrame:
    """One summary per group: rows (groups, level, vals).

    Each task makes partial summaries first, so what is shuffled is a few buffers per task and group,
    however many rows a group has; those of a group merge in fan_in parts, then in one. Null and NaN are no values; a group without values has no rows; null
    is a group key like any other. Columns other than those named are ignored.
    """
    used = rows.select(*groups, F.col(value).cast("double").alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    partial_rows = used.mapInArrow(partial(_build, k=k, limit=held, names=groups), _schema(rows, groups))
    part = partial_rows.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    return merge_summaries(merge_summaries(part, [*groups, "_part"], k).drop("_part"), groups, k)


def merge_summaries(summaries: DataFrame, groups: list[str], k: int = 256) -> DataFrame:
    """Merges summaries (of parts, days, earlier runs) into one per group; k must be that of the parts, else ValueError."""
    placed = summaries.repartition(*groups).sortWithinPartitions(*groups, "level") if groups else summaries.repartition(1).sortWithinPartitions("level")
    return placed.select(*groups, "level", "vals").mapInArrow(partial(_merge, k=k, names=groups), _schema(summaries, groups))


def packed(summaries: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group: n, and buffers as an array of (weight, vals). Its size is bounded: k values a level."""
    return summaries.groupBy(*groups).agg(
        F.sum(F.pow(F.lit(2.0), F.col("level")) * F.size("vals")).cast("long").alias("n"),
        F.collect_list(F.struct(F.pow(F.lit(2.0), F.col("level")).cast("long").alias("weight"), F.col("vals"))).alias("buffers"),
    )


def rank_share(buffers: Column, n: Column, value: Column) -> Column:
    """Estimated share of a group's values that are at most `value`."""
    below = F.aggregate(
        buffers, F.lit(0).cast("long"),
        lambda acc, b: acc + b["weight"] * F.size(F.filter(b["vals"], lambda v: v <= value)).cast("long"),
    )
    return below / n


def percentile_columns(buffers: Column, n: Column, shares: dict[str, float]) -> list[Column]:
    """For each name the smallest kept value whose estimated rank reaches the share."""
    pairs = F.array_sort(F.flatten(F.transform(buffers, lambda b: F.transform(b["vals"], lambda v: F.struct(v.alias("v"), b["weight"].alias("w"))))))

    def pick(share: float) -> Column:
        need = F.greatest(F.ceil(F.lit(share) * n), F.lit(1))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("v"))
        return F.aggregate(
            pairs, start,
            lambda acc, p: F.when(acc["seen"] >= need, acc).otherwise(F.struct((acc["seen"] + p["w"]).alias("seen"), p["v"].alias("v"))),
            lambda acc: acc["v"],
        )

    return [pick(share).alias(name) for name, share in shares.items()]


VISIT_KEY = ["service_date", "trip_id", "stop_sequence", "stop_id"]
BASELINE_KEY = ["route_id", "direction_id", "stop_id", "is_weekend"]


def visits_once(visits: DataFrame, keep: list[str]) -> DataFrame:
    """Each visit once, by its latest delivery; a later delivery without a value does not hide an earlier one."""
    value = F.when(~F.isnan("arrival_deviation_seconds"), F.col("arrival_deviation_seconds"))
    order = F.struct(F.col("updated_at"), value)
    groups = [c for c in keep if c not in VISIT_KEY]
    return visits.where(value.isNotNull()).groupBy(*VISIT_KEY).agg(
        F.max_by(F.struct(*[F.col(c) for c in groups], value.alias("arrival_deviation_seconds")), order).alias("_v")
    ).select(*[c for c in keep if c in VISIT_KEY], "_v.*")


def deviating_baselines(visits: DataFrame, baselines: DataFrame, k: int = 256, tolerance: float = 0.1) -> DataFrame:
    """The stored baselines with the estimated F at their median and lower quartile, and whether either is off."""
    once = visits_once(visits, BASELINE_KEY)
    packs = packed(summarise(once, BASELINE_KEY, "arrival_deviation_seconds", k), BASELINE_KEY)
    joined = baselines.join(packs, BASELINE_KEY)
    at = lambda c: rank_share(F.col("buffers"), F.col("n"), F.col(c))
    return joined.select(
        *BASELINE_KEY, "n", at("arrival_median_seconds").alias("share_at_median"), at("arrival_p25_seconds").alias("share_at_p25")
    ).withColumn("off", (F.abs(F.col("share_at_median") - 0.5) > tolerance) | (F.abs(F.col("share_at_p25") - 0.25) > tolerance))
