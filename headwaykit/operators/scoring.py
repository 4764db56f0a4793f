"""Deviations held against baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwaykit.operators.baselines import KEYS

BASELINE_COLUMNS = ["observation_count", "q1_delay_seconds", "median_delay_seconds", "q3_delay_seconds", "iqr_delay_seconds", "lower_anomaly_fence_seconds", "upper_anomaly_fence_seconds"]


def with_baseline(features: DataFrame, baselines: DataFrame) -> DataFrame:
    """Joins the hourly baseline, else the fallback, column by column. The planner broadcasts what is small by its statistics."""
    def side(level: str) -> DataFrame:
        return baselines.where(F.col("baseline_level") == level)

    hourly = side("HOURLY").select(*KEYS, "service_hour", F.lit("HOURLY").alias("_hourly"), *[F.col(c).alias(f"_h_{c}") for c in BASELINE_COLUMNS])
    fallback = side("FALLBACK").select(*KEYS, F.lit("FALLBACK").alias("_fallback"), *[F.col(c).alias(f"_f_{c}") for c in BASELINE_COLUMNS])
    joined = features.join(hourly, [*KEYS, "service_hour"], "left").join(fallback, KEYS, "left")
    pick = {f"baseline_{c}" if c == "observation_count" else c: F.coalesce(f"_h_{c}", f"_f_{c}") for c in BASELINE_COLUMNS}
    drop = [f"_{s}_{c}" for s in "hf" for c in BASELINE_COLUMNS] + ["_hourly", "_fallback"]
    return joined.withColumns({"baseline_level": F.coalesce("_hourly", "_fallback"), **pick}).drop(*drop)


def score_stops(features: DataFrame, baselines: DataFrame) -> DataFrame:
    """Adds the class of each stop by where its possible deviations lie against the upper fence."""
    rows = with_baseline(features, baselines)
    fence = F.col("upper_anomaly_fence_seconds")
    label = (
        F.when(~F.col("scoring_eligible") | fence.isNull(), "NOT_EVALUABLE").when(F.col("arrival_deviation_lower_seconds") > fence, "CERTAIN_LATE")
        .when(F.col("arrival_deviation_upper_seconds") > fence, "POSSIBLE_LATE").otherwise("NORMAL")
    )
    late = F.col("stop_classification").isin("CERTAIN_LATE", "POSSIBLE_LATE")
    return rows.withColumns({"baseline_found": F.col("baseline_level").isNotNull(), "stop_classification": label}).withColumns({
        "is_anomalous": late, "is_certain_late": F.col("stop_classification") == "CERTAIN_LATE",
        "seconds_above_upper_fence": F.when(late, F.col("arrival_deviation_seconds") - fence),
    })


def signed_scores(features: DataFrame, primary: DataFrame, fallback: DataFrame, metric: str = "arrival_deviation_seconds", min_support: int = 30, k: float = 1.5) -> DataFrame:
    """The other scoring rule: signed distance outside the interquartile range in units of it, and both directions.

    A baseline counts if it has min_support values of the metric; rows without one are left out.
    """
    stats = [f"{metric}_{n}" for n in ("count", "median", "p25", "p75")]

    def side(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return df.where(F.col(f"{metric}_count") >= min_support).select(*keys, F.lit(name.upper()).alias(f"_{name}"), *[F.col(c).alias(f"_{name}_{c}") for c in stats])

    joined = features.join(side(primary, "primary", [*KEYS, "service_hour"]), [*KEYS, "service_hour"], "left").join(side(fallback, "fallback", KEYS), KEYS, "left")
    pick: dict[str, Column] = {"baseline_type": F.coalesce("_primary", "_fallback")}
    for c, name in zip(stats, ("count", "median", "p25", "p75")):
        pick[f"baseline_{name}"] = F.when(F.col("_primary").isNotNull(), F.col(f"_primary_{c}")).otherwise(F.col(f"_fallback_{c}"))
    rows = joined.withColumns(pick).where("baseline_type is not null")
    rows = rows.drop(*[c for c in rows.columns if c.startswith(("_primary", "_fallback"))])
    x, p25, p75, iqr = F.col(metric), F.col("baseline_p25"), F.col("baseline_p75"), F.col("baseline_p75") - F.col("baseline_p25")
    lower, upper = x - F.col("arrival_uncertainty_seconds"), x
    low_fence, high_fence = p25 - k * iqr, p75 + k * iqr
    unscorable = iqr.isNull() | (iqr <= 0)
    score = F.when(unscorable, F.lit(None)).when(x > p75, (x - p75) / iqr).when(x < p25, -(p25 - x) / iqr).otherwise(0.0)
    status = (
        F.when(unscorable, "UNSCORABLE").when(lower > high_fence, "CERTAIN_LATE").when(upper < low_fence, "CERTAIN_EARLY")
        .when((upper > high_fence) & (lower <= high_fence), "POSSIBLE_LATE").when((lower < low_fence) & (upper >= low_fence), "POSSIBLE_EARLY").otherwise("NORMAL")
    )
    return rows.withColumns({"lower_fence": low_fence, "upper_fence": high_fence, "anomaly_score": score, "anomaly_status": status})
