"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the folder set on its context.  Where both are unset a local
    session, as in tests, gets a folder of its own; on a cluster that would be another folder on each machine,
    so it is an error there."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = getattr(shared_folder, "own", None)
        if own is None:
            own = shared_folder.own = tempfile.mkdtemp(prefix="marisight-")
        folder = f"file://{own}"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once as Parquet to the shared folder and read again: its lineage ends here, so a lost
    executor costs no recomputation and every reader sees the same rows.

    Results are read from these tables when an action runs, so nothing deletes them before; they go with
    the folder, which belongs to whoever set it (a folder per application is the usual choice)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
