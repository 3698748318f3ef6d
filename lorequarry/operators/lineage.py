"""Cutting lineage in the cluster's shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names, in setCheckpointDir or spark.checkpoint.dir.

    Only a local session, whose driver runs all tasks, gets one made where none is named.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lorequarry-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once to the cluster's shared checkpoint folder and go on from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a shared folder and what is in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
