"""A training-corpus pipeline over ``documents``: each stage's result is written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.llm.durable import durable
from florilege.llm.mixing import mix_documents, quality_domains
from florilege.llm.near_dedup import drop_near_duplicates
from florilege.llm.packing import pack_documents
from florilege.llm.pii import pseudonymise
from florilege.llm.toxicity import train_toxicity, with_toxicity

#: Documents with this score or a higher one are rejected.
TOXIC_FROM = 0.5
#: Shingle similarity, in percent, from which documents are near duplicates.
NEAR_PERCENT = 80
#: A deployment passes its own secret.
PII_KEY = "florilege-demo-key"
#: Target weights of the label domains. Good documents stay as many as they are; poor ones are thinned out to their weight.
MIXTURE, KEEP_WHOLE = {"good": 0.95, "poor": 0.05}, "good"


#: Rows that go to a Python worker at a time, where the session has Spark's own number: an executor and its workers then hold
#: some megabytes of text a task instead of some tens.
BATCH_KEY, BATCH_ROWS, SPARKS_OWN = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"


def _small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_KEY, SPARKS_OWN) == SPARKS_OWN:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted to the labels does not call toxic.

    Null and empty texts score as the model's bias and long ones whole; repeated rows fare alike; without labels of both
    classes all documents stay, and an empty table stays empty."""
    _small_batches(spark)
    model = train_toxicity(docs, _labels(spark, sf_dir))
    return with_toxicity(docs, model, score_col="__toxicity").where(F.col("__toxicity") < TOXIC_FROM).drop("__toxicity")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, and one row of those that repeat an id.

    Null ids and texts without words have no duplicates and stay; an empty table stays empty."""
    _small_batches(spark)
    return drop_near_duplicates(docs, percent=NEAR_PERCENT)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with private data replaced by pseudonyms; ``n_chars`` follows the text.

    Rows change by themselves, whatever their ids; null and empty texts, and a null ``n_chars``, stay."""
    out = pseudonymise(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled at the rates that bring the label domains to their target weights.

    Every row is drawn by itself, by a hash of its id and text, null ones included; without two labelled domains all
    stay, and an empty table stays empty."""
    return mix_documents(docs, quality_domains(_labels(spark, sf_dir)), MIXTURE, keep_whole=KEEP_WHOLE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths: rows of pieces, one for a null or empty text, none for an empty table."""
    _small_batches(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: Models, hashes and a tokenizer are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs, name)
    return docs
