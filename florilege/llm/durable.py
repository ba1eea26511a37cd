"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="florilege-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark finds it in."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def readable(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that tasks can open with ``pyarrow.fs``."""
    found = qualified(spark, path)
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The written tables of one computation, deleted when the block ends: its result must be written elsewhere by then.

    Until then a lost executor costs no rerun of what is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, shared_path(spark, "scratch"), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)

    def put(self, df: DataFrame, name: str) -> str:
        """The path of ``df``, written."""
        self.n += 1
        path = f"{self.folder}/{self.n:03d}-{name}"
        df.write.parquet(path)
        return path

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.put(df, name))
