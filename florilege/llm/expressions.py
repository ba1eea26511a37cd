"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer does."""
    return F.transform(F.array(value), body)[0]


def named(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]
