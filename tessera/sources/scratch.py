"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where the session leaves it unset a folder
    below the warehouse on a cluster and a temporary one in local mode."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir")
    if given:
        return given
    if sc.getCheckpointDir() is None:
        local = sc.master.startswith("local[") or sc.master == "local"
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
