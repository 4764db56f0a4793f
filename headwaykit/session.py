"""Session factory with the settings every operator assumes (UTC clock, adaptive execution)."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "headwaykit", master: str | None = None, **conf: str) -> SparkSession:
    """A session on `master` (the cluster's default if None); `conf` overrides the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's own setting; on one machine, where it is unset, a folder that goes with the process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local") or "cluster" in context.master:
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="headwaykit-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/headwaykit-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the application's own folder of the shared checkpoint folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application wrote with `written` and to `scratch` places. Frames that read from there cannot be used any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read from there: a cut in the lineage that outlives executors."""
    place = scratch(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)
