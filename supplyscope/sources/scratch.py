"""Intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path for one run.

    It lies under the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session, where every task runs on this machine, may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='supplyscope-')}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that a report uses several times, and go on from the written table.

    The work behind it is done once, whatever executors are lost later, and later joins start from a
    table of known size. Runs a job. Clearing the scratch folder after a run is left to its owner.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
