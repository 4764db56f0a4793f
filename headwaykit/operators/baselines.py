"""Robust summaries of past deviations: quartiles and fences per stop, with support."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["route_id", "direction_id", "stop_id", "is_weekend"]


def quartile_baseline(rows: DataFrame, keys: list[str], value: str, min_support: int = 30) -> DataFrame:
    """observation_count and discrete quartiles of `value` per key, where there are min_support values or more.

    One sketch per group gives the three quartiles; it merges before the shuffle, so group size does not matter.
    """
    known = rows.where(F.col(value).isNotNull()).dropna(subset=keys)
    sketch = F.percentile_approx(value, [0.25, 0.5, 0.75], 10_000)
    summary = known.groupBy(*keys).agg(F.count("*").alias("observation_count"), sketch.alias("q")).where(F.col("observation_count") >= min_support)
    return summary.select(*keys, "observation_count", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1_delay_seconds", "median_delay_seconds", "q3_delay_seconds"))])


def with_fences(summary: DataFrame, k: float = 1.5) -> DataFrame:
    iqr = F.col("q3_delay_seconds") - F.col("q1_delay_seconds")
    return summary.withColumns({
        "iqr_delay_seconds": iqr, "lower_anomaly_fence_seconds": F.col("q1_delay_seconds") - k * iqr, "upper_anomaly_fence_seconds": F.col("q3_delay_seconds") + k * iqr,
    })


def stop_baselines(features: DataFrame, value: str, min_support: int = 30, k: float = 1.5) -> DataFrame:
    """Hourly and fallback baselines in one table; service_hour is null for the fallback."""
    hourly = quartile_baseline(features, [*KEYS, "service_hour"], value, min_support).withColumn("baseline_level", F.lit("HOURLY"))
    fallback = quartile_baseline(features, KEYS, value, min_support).withColumns({"baseline_level": F.lit("FALLBACK"), "service_hour": F.lit(None).cast("int")})
    return with_fences(hourly.unionByName(fallback), k)


def metric_baselines(features: DataFrame, keys: list[str], metrics: list[str], accuracy: int | None = None) -> DataFrame:
    """For each metric its count and interpolated median, p25 and p75, in one pass; NaN is no value.

    Exact unless an accuracy is given: exact percentiles keep a group's distinct values in its task. With an accuracy
    they are discrete, within 1/accuracy of rank, from sketches that do not grow with the group.
    """
    out = []
    for metric in metrics:
        value = F.col(metric).cast("double")
        value = F.when(~F.isnan(value), value)
        spread = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy) if accuracy else F.percentile(value, [0.25, 0.5, 0.75])
        out += [F.count(value).alias(f"{metric}_count"), *[spread[i].alias(f"{metric}_{n}") for i, n in ((1, "median"), (0, "p25"), (2, "p75"))]]
    return features.groupBy(*keys).agg(F.count("*").alias("observation_count"), *out)


def planned_visits(features: DataFrame, kinds: list[str]) -> DataFrame:
    """The other eligibility rule: visits of planned trips (trip_type one of kinds) with an arrival deviation."""
    x = F.col("arrival_deviation_seconds")
    return features.where(F.col("trip_type").isin(kinds) & x.isNotNull() & ~F.isnan(x.cast("double")))


def delay_marts(features: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Departure-delay summary per route and day (or hour): counts, mean, median, p90, mean of absolute values."""
    known = features.where(F.col(value).isNotNull()).dropna(subset=keys)
    sketch = F.percentile_approx(value, [0.5, 0.9], 10_000)
    return known.groupBy(*keys).agg(
        F.count("*").alias("stop_event_count"), F.count_distinct("trip_id").alias("trip_count"), F.count_distinct("stop_id").alias("stop_count"),
        F.avg(value).alias("avg_delay_seconds"), sketch[0].alias("median_delay_seconds"), sketch[1].alias("p90_delay_seconds"),
        F.avg(F.abs(value)).alias("avg_abs_delay_seconds"),
    )

