"""Incremental ingest of batch files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders by a hash of the key that the known keys are kept in.
BUCKETS = 64


def ingest_batches(spark: SparkSession, folder: str, schema: str, keys: list[str], out: str, checkpoint: str, arrived: str | None = None, late: str = "1 day", buckets: int = BUCKETS) -> int:
    """Append the rows of new Parquet batch files in ``folder`` to ``out`` once a key; returns the rows of ``out``.

    Files that earlier calls read are skipped by the stream's checkpoint. The keys seen are a table beside it, by batch and
    bucket; a batch's keys are looked up in their buckets only, so nothing is held in a state between batches and calls.
    A batch writes its rows, its keys and its count to folders of its own name, over what a broken run left there, and
    does not look at its own keys: a repeated or restarted batch brings no key twice. The result adds up counts, a row a batch.

    Of rows of one key in a batch one is taken, the first by all columns; null keys equal each other. With the event time
    column ``arrived``, batches whose keys all arrived ``late`` before the newest are forgotten, and their keys may come again.
    ``out`` has a column ``batch`` besides those of ``schema``."""
    known, counts = f"{checkpoint}/known-keys", f"{checkpoint}/batch-counts"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.createDataFrame([], schema).select(*keys).schema.fields)

    def table(path: str, columns: str) -> DataFrame:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            return spark.read.schema(columns).parquet(path)
        return spark.createDataFrame([], columns)

    def take(rows: DataFrame, number: int) -> None:
        name = f"{rows.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        whole = F.struct(*rows.columns)
        one = rows.groupBy(*keys).agg(F.min(whole).alias("row")).select("row.*").withColumn("bucket", bucket)
        one = one.persist()
        asked = [r.bucket for r in one.select("bucket").distinct().collect()]  # at most ``buckets``
        before = table(known, f"{kinds}, batch string, bucket int").where(F.col("bucket").isin(asked) & (F.col("batch") != name)).alias("old")
        same = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in ["bucket", *keys]]
        one.alias("new").join(before, same, "left_anti").drop("bucket").write.mode("overwrite").parquet(f"{out}/batch={name}")
        fresh = spark.read.schema(schema).parquet(f"{out}/batch={name}")
        fresh.select(*keys, bucket.alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{known}/batch={name}")
        newest = F.max(arrived).cast("timestamp") if arrived else F.lit(None).cast("timestamp")
        fresh.agg(F.count("*").alias("n"), newest.alias("newest")).write.mode("overwrite").parquet(f"{counts}/batch={name}")
        one.unpersist()
        if arrived:
            _forget(spark, table(counts, "n long, newest timestamp, batch string"), known, late)

    query = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table(counts, "n long, newest timestamp, batch string").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _forget(spark: SparkSession, counts: DataFrame, known: str, late: str) -> None:
    """Delete the known keys of batches that lie ``late`` behind the newest one; a row a batch is read."""
    last = counts.agg(F.max("newest")).first()[0]
    if last is None:
        return
    for r in counts.where(F.col("newest") < F.lit(last) - F.expr(f"INTERVAL {late}")).select("batch").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{known}/batch={r.batch}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
