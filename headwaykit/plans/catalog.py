"""All named queries of the library, but for those of optional subpackages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headwaykit.plans import pipeline_queries, reference_queries, service_queries

MODULES = [pipeline_queries, reference_queries]
reference_queries.SQL["q_assertions"] = service_queries.assertions_sql()
reference_queries.SQL["t3_pane_updates"] = pipeline_queries.SQL["p2_corrected_counts"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return reference_queries.QUERIES["chain_trips"](spark, folder)
