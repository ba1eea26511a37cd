"""Projections: choosing, renaming, recoding and casting columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_TOKENS = ("", "NA", "N/A", "na", "n/a", "-", "null", "NULL", "None", "none", "missing", "not applicable", "not collected", "unknown")


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose whole name matches ``pattern``, in their order."""
    return df.select(*[c for c in df.columns if re.fullmatch(pattern, c)])


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def recode(df: DataFrame, col: str, mapping: dict, strict: bool = False) -> DataFrame:
    """Replace values by ``mapping``. Unknown values become null, or fail the job if ``strict``; null stays null."""
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    new = F.try_element_at(table, F.col(col))
    if strict:
        unknown = F.raise_error(F.concat(F.lit(f"{col}: no code for "), F.col(col).cast("string")))
        new = F.when(F.col(col).isNull() | new.isNotNull(), new).otherwise(unknown)
    return df.withColumn(col, new)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def cast_matching(df: DataFrame, pattern: str, kind: str, fill=None) -> DataFrame:
    """Cast the columns whose name matches; what can't be cast and null become ``fill``."""
    found = [c for c in df.columns if re.fullmatch(pattern, c)]
    return df.withColumns({c: F.coalesce(F.col(c).try_cast(kind), F.lit(fill).cast(kind)) for c in found})


def with_constant(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def normalize_nulls(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS, cols: list[str] | None = None) -> DataFrame:
    """Cells that equal a token become null; of non-string columns the text form counts."""
    return df.withColumns({c: F.when(~F.col(c).cast("string").isin(*tokens), F.col(c)) for c in cols or df.columns})
