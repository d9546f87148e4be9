"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir`` or the folder set on its context; a folder of its own for a local
    session that has neither, an error on a cluster, where that would be another folder on each machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='marisight-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df checkpointed in the shared folder: its lineage ends here, and a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to the shared folder and read again: what is read several times, a few columns at a
    time.  The files stay until the folder's owner clears it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, where its files give fewer: for costly expressions over a table in
    a single row group.  Tables of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
