"""The test tables as the inputs of the reference pipeline: events, schedule, history, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.functions.timeutil import LOCAL_ZONE, is_weekend, localise
from headwaykit.operators import inference, matching, performance
from headwaykit.operators.baselines import stop_baselines
from headwaykit.operators.dedup import canonical_rows, dedup_events
from headwaykit.sources.tables import table

VISIT = ["service_date", "trip_id", "stop_sequence", "stop_id"]


class Views:
    """Lazy frames over one folder of test tables; each is built once per Views."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self._made = spark, folder, {}

    def table(self, name: str) -> DataFrame:
        return self._once(name, lambda: table(self.spark, self.folder, name))

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def events(self) -> DataFrame:
        return self._once("_events", lambda: dedup_events(self.table("temp_vehicle_events_stage")))

    def schedule(self) -> DataFrame:
        """Each instance once per feed."""
        return self.table("gtfs_stop_instances")

    def matches(self) -> DataFrame:
        return self._once("_matches", lambda: matching.match_schedule(self.events(), self.schedule()))

    def stops(self) -> DataFrame:
        return self._once("_stops", lambda: inference.infer_stops(self.matches(), self.events()))

    def performance(self) -> DataFrame:
        return self._once("_performance", lambda: performance.stop_performance(self.stops(), self.schedule()))

    def features(self) -> DataFrame:
        return self._once("_features", lambda: performance.stop_features(self.performance(), self.matches(), self.events()))

    def raw_history(self) -> DataFrame:
        """Past visits in the form of a raw history file, repeated rows included."""
        def make() -> DataFrame:
            visits = self.table("historical_stop_features")
            midnight = localise(F.col("service_date").cast("timestamp"), LOCAL_ZONE)
            since = lambda c: (F.unix_seconds(c) - F.unix_seconds(midnight)).cast("int")
            return visits.select(
                "service_date", "trip_id", "stop_sequence", "stop_id", "route_id", "direction_id", "vehicle_id", F.col("observed_arrival").alias("stop_timestamp"),
                F.timestamp_seconds(F.unix_seconds("observed_arrival") - F.coalesce("travel_time_seconds", F.lit(60))).alias("move_timestamp"),
                since("scheduled_arrival").alias("scheduled_arrival_seconds"), since("scheduled_departure").alias("scheduled_departure_seconds"),
                "travel_time_seconds", "dwell_time_seconds", "headway_branch_seconds", "headway_trunk_seconds",
            )

        return self._once("_raw_history", make)

    def history(self) -> DataFrame:
        return self._once("_history", lambda: canonical_rows(self.raw_history(), VISIT, ["stop_timestamp", "move_timestamp"]))

    def historical_features(self) -> DataFrame:
        return self._once("_hf", lambda: performance.historical_features(performance.historical_performance(performance.historical_events(self.history()))))

    def visits(self) -> DataFrame:
        """Past visits as features to be scored: each once, deviations in whole seconds, an uncertainty of their own."""
        def make() -> DataFrame:
            once = canonical_rows(self.table("historical_stop_features"), VISIT, ["updated_at"])
            x = F.col("arrival_deviation_seconds")
            deviation = F.when(~F.isnan(x), F.floor(x)).cast("long")
            unsure = F.pmod(F.col("stop_sequence") * 7 + F.length("trip_id") + F.day("service_date"), F.lit(90)).cast("long")
            return once.select(
                F.lit("H").alias("feed_checksum"), *VISIT, "route_id", "direction_id", "service_hour", is_weekend(F.col("service_date")).alias("is_weekend"),
                deviation.alias("arrival_deviation_seconds"), (deviation - unsure).alias("arrival_deviation_lower_seconds"), deviation.alias("arrival_deviation_upper_seconds"),
                unsure.alias("arrival_uncertainty_seconds"), (deviation.isNotNull() & (unsure <= 60)).alias("scoring_eligible"),
            )

        return self._once("_visits", make)

    def baselines(self) -> DataFrame:
        return self._once("_baselines", lambda: stop_baselines(self.visits(), "arrival_deviation_seconds"))

