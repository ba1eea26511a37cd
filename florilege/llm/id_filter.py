"""A bounded filter that tells most rows whose id is in no small set from the others, before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.expressions import all_of

#: Bits of the filter: 8 MB are broadcast, however many ids there are.
FILTER_BITS = 1 << 26
_BLOCK = 1 << 15


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def filter_blocks(ids: DataFrame, id_col: str) -> DataFrame:
    """The filter of the ids as ``(block, bits)``: a bitmap of 32,768 bits a row, at most 2,048 rows."""
    bit = ids.where(F.col(id_col).isNotNull()).select(_bit(F.col(id_col)).alias("bit"))
    return bit.groupBy(F.floor(F.col("bit") / _BLOCK).cast("int").alias("__block")).agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(_BLOCK))).alias("__bits"))


def with_maybe(df: DataFrame, blocks: DataFrame, key: Column, name: str = "__maybe") -> DataFrame:
    """``df`` with a flag: false only where the key is surely not among the filter's ids. A null key is in no set."""
    rows = df.withColumn("__bit", _bit(key)).withColumn("__block_of", F.floor(F.col("__bit") / _BLOCK).cast("int"))
    at = F.pmod("__bit", F.lit(_BLOCK)).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))
    found = rows.join(F.broadcast(blocks), F.col("__block_of") == F.col("__block"), "left")  # at most 8 MB
    return found.select(*all_of(df), (there & key.isNotNull()).alias(name))
