"""Where cut lineage and intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, a folder that all executors share.

    Only a local master, whose executor is the driver, may do without the setting.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    wanted = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not wanted:
        # In local-cluster mode executors are processes of their own.
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        wanted = tempfile.mkdtemp(prefix="precis-")
    context.setCheckpointDir(wanted)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
