"""Exact percentiles of groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.session import written


def exact_percentiles(rows: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, n, q): interpolated percentiles (the n-th value from 0 at share * (count - 1)), exact. Null and NaN are no values.

    Distinct values are counted, placed by ranges of (keys, value), and ranked by sums over the ranges before
    them; only the values at the wanted ranks meet. The ranges are written once, so that all readers see the
    same ones. A group of one or all rows is spread like any other. Keys may be null.
    """
    v = F.col(value).cast("double")
    counts = rows.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    ranged = written(counts.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    per_part = ranged.groupBy(*keys, "_part").agg(F.sum("_c").alias("_s"))  # a row per group and range
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    placed = per_part.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
        (F.sum("_s").over(group.orderBy("_part")) - F.col("_s")).alias("_before"), F.sum("_s").over(group).alias("n"),
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("_inside", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rank = F.col("_before") + F.col("_inside")
    held = lambda r: F.max(F.when((rank <= r) & (r < rank + F.col("_c")), F.col("_v")))
    parts = []
    for i, share in enumerate(shares):
        at = F.lit(float(share)) * (F.col("n") - 1)
        parts += [held(F.floor(at)).alias(f"_low{i}"), held(F.ceil(at)).alias(f"_high{i}")]
    found = ranked.join(placed, same).groupBy(*keys).agg(F.max("n").alias("n"), *parts).where("n is not null")  # no values, no row

    def between(i: int, share: float):
        at = F.lit(float(share)) * (F.col("n") - 1)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return F.when(F.floor(at) == F.ceil(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return found.select(*keys, "n", F.array(*[between(i, s) for i, s in enumerate(shares)]).alias("q"))
