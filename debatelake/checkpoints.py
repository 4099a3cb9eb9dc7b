"""Written intermediate results, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; only in local mode there is a default."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/checkpoints/debatelake"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through files in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
