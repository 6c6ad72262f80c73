"""A session with the settings the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "pelagos", master: str | None = None, **more: str) -> SparkSession:
    """UTC, adaptive plans; the cluster's own settings stay."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """df written to the folder in ``spark.checkpoint.dir`` and read from there: rounds of joins do not pile up in its plan.

    Only a local session without that setting gets a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="pelagos"))
    return df.checkpoint()
