"""Filters and flags."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "==": operator.eq, "!=": operator.ne}


def exclude_matching(df: DataFrame, col: str, regex: str) -> DataFrame:
    """Rows whose text doesn't match ``regex`` in any case; null doesn't match."""
    return df.where(~F.coalesce(F.col(col).rlike(f"(?i){regex}"), F.lit(False)))


def completeness_filter(df: DataFrame, tag_a: str, ok_a: str, tag_b: str, ok_b: str) -> DataFrame:
    """Both tags present: both must say complete. One present: it decides. None: the row goes. Blank is absent."""
    a, b = (F.nullif(F.trim(F.col(c)), F.lit("")) for c in (tag_a, tag_b))
    return df.where((a.isNotNull() | b.isNotNull()) & F.coalesce(a == ok_a, F.lit(True)) & F.coalesce(b == ok_b, F.lit(True)))


def exclude_referenced(df: DataFrame, key: str, ref_col: str) -> DataFrame:
    """Rows whose key stands in no row's ``ref_col``."""
    refs = df.where(F.col(ref_col).isNotNull()).select(F.col(ref_col).alias("__ref")).distinct()
    return df.join(refs, F.col(key) == F.col("__ref"), "left_anti")


def threshold_hits(df: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    return df.where(reduce(operator.and_, (_COMPARE[op](F.col(c), F.lit(v)) for c, (op, v) in limits.items())))


def range_status(df: DataFrame, col: str, lo, hi, note: str, name: str = "status") -> DataFrame:
    """Rows outside the range, labelled."""
    return df.where((F.col(col) < lo) | (F.col(col) > hi)).withColumn(name, F.lit(note))


def all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(reduce(operator.and_, (F.col(c).isNull() for c in cols)))


def value_in(df: DataFrame, col: str, values: DataFrame, negate: bool = False) -> DataFrame:
    """Rows whose value is in the first column of ``values``. Null is in no set."""
    some = values.select(F.col(values.columns[0]).alias("__value")).distinct()
    return df.join(some, F.col(col) == F.col("__value"), "left_anti" if negate else "left_semi")


def drop_numeric_text(df: DataFrame, col: str) -> DataFrame:
    return df.where(~F.coalesce(F.col(col).rlike("^[0-9]+$"), F.lit(False)))


def flag_tag(df: DataFrame, list_col: str, tag: str, name: str, sep: str = ",") -> DataFrame:
    return df.withColumn(name, F.coalesce(F.array_contains(F.split(list_col, sep), tag), F.lit(False)))


def check_flag(df: DataFrame, wanted: str, found: str, name: str) -> DataFrame:
    """True where ``wanted`` holds but ``found`` has nothing: a row to be reviewed."""
    return df.withColumn(name, F.col(wanted) & F.coalesce(F.col(found) == "", F.lit(True)))


def presence_flags(df: DataFrame, cols: list[str], prefix: str = "has_") -> DataFrame:
    return df.withColumns({prefix + c: F.col(c).isNotNull() for c in cols})


def exclude_prefix(df: DataFrame, col: str, prefixes: list[str]) -> DataFrame:
    starts = reduce(operator.or_, (F.col(col).startswith(p) for p in prefixes))
    return df.where(~F.coalesce(starts, F.lit(False)))


def date_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Both ends included; on a timestamp column the condition is pushed down to the scan."""
    kind = df.schema[col].dataType.simpleString()
    if kind == "timestamp":
        return df.where((F.col(col) >= F.lit(lo).cast("timestamp")) & (F.col(col) < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp")))
    return df.where(F.col(col).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))


def title_query(df: DataFrame, col: str, require: list[str], exclude: list[str]) -> DataFrame:
    """Rows whose text has all of ``require`` and none of ``exclude``, in any case."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    wanted: Column = reduce(operator.and_, (text.contains(t.lower()) for t in require), F.lit(True))
    return df.where(reduce(operator.and_, (~text.contains(t.lower()) for t in exclude), wanted))
