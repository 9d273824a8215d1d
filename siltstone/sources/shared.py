"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpointing(spark: SparkSession) -> SparkSession:
    """``spark`` with a checkpoint folder: that of ``spark.checkpoint.dir``. Where it is unset local mode takes a temporary folder, and a cluster is refused."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siltstone-"))
    return spark


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder's path below the checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpointing(spark).sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"
