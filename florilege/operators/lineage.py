"""Cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors must share; a temporary one only where the session names none
    and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="florilege-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder and read back: rows are computed once, and later reads see the same
    ones whatever executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
