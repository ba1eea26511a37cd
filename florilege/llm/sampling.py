"""Bounded samples of labelled rows to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

_RANGE = 1 << 30


def sample_of_classes(labelled: DataFrame, class_col: str, per_class: int) -> DataFrame:
    """``per_class`` rows of ``labelled(id, class_col)`` for each class, those of the smallest hashes of their ids; all of a
    class that has no more. Two passes over the table for all classes.

    A row a class, its count, goes to the driver. Hashes are even, so about twice the rows that are asked for lie below
    a bound that follows from the count; only these are ranked, however large a class is. (A class that repeats few ids
    very often may give fewer rows.)"""
    rows = labelled.where(F.col(class_col).isNotNull() & F.col("id").isNotNull())
    counts = rows.groupBy(class_col).count().collect()
    if not counts:
        return rows.select("id", class_col)
    bounds = [x for r in counts for x in (F.lit(r[0]), F.lit(min(_RANGE, int(_RANGE * (2 * per_class + 50) / r[1]) + 1)))]
    rows = rows.withColumn("__hash", F.pmod(F.xxhash64("id"), F.lit(_RANGE))).where(F.col("__hash") < F.try_element_at(F.create_map(*bounds), F.col(class_col)))
    ranked = rows.withColumn("__rank", F.row_number().over(W.partitionBy(class_col).orderBy("__hash", "id")))
    return ranked.where(F.col("__rank") <= per_class).select("id", class_col)


def existing(labelled: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``labelled(id, ..)`` whose document is there, so that a sample is not filled with ids without one."""
    return labelled.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")


def first_of_classes(rows: DataFrame, class_col: str, per_class: int, *key: str) -> DataFrame:
    """At most ``per_class`` of ``rows`` for each class, those of the smallest hashes of ``key``: a bound on rows, however
    often an id or a row repeats. Spark keeps no more of a task before the shuffle."""
    rank = F.row_number().over(W.partitionBy(class_col).orderBy(F.xxhash64(*key), *key))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= per_class).drop("__rank")
