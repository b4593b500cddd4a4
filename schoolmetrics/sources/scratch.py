"""Intermediate results that outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Taken from `spark.checkpoint.dir`. Only a local-mode session without that setting gets
    a temporary folder; on a cluster the setting is required, since executors must share it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="schoolmetrics-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute once into the checkpoint folder, keeping partitions and row order, and cut the lineage."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)
