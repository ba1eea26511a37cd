"""Window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from florilege.operators.lineage import checkpointed


def _ordered(order: list[str | Column]) -> list[Column]:
    return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order]


def pick_best(df: DataFrame, group: list[str], order: list[str | Column], tiebreak: str) -> DataFrame:
    """The best row of each group: names in ``order`` sort descending with nulls last, ``tiebreak`` ascending at the end.

    A group is sorted in one task; collapse exact copies and leave out the null group before."""
    w = W.partitionBy(*group).orderBy(*_ordered(order), F.asc(tiebreak))
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def tie_count(df: DataFrame, group: list[str], criteria: list[str], tiebreak: str) -> DataFrame:
    """Best rows with ``tied``: whether the next row of the group equals them on all criteria."""
    w = W.partitionBy(*group).orderBy(*_ordered(criteria), F.asc(tiebreak))
    both = F.struct(*criteria)
    ranked = df.withColumn("__rank", F.row_number().over(w)).withColumn("__next", F.lead(F.struct(both.alias("v"))).over(w))
    tied = F.col("__next").isNotNull() & F.col("__next.v").eqNullSafe(both)
    return ranked.where("__rank = 1").withColumn("tied", tied).drop("__rank", "__next")


def cumulative_share(df: DataFrame, part: list[str], order: list[Column], value: str) -> DataFrame:
    """Running total of ``value`` and its percentage of the partition's total, null where that is 0."""
    w = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(value).over(w)).withColumn("cum_percent", F.try_divide(100 * F.col("running"), F.sum(value).over(W.partitionBy(*part))))


def dedup_keep_first(df: DataFrame, cols: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each combination of ``cols``; plain names in ``order`` sort ascending."""
    w = W.partitionBy(*cols).orderBy(*(F.asc(c) if isinstance(c, str) else c for c in order))
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def duplicated_all(df: DataFrame, cols: list[str]) -> DataFrame:
    """All rows of combinations that repeat."""
    more = df.groupBy(*cols).agg(F.count("*").alias("__n")).where("__n > 1")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols]
    return df.alias("l").join(more.alias("r"), same, "left_semi")


def in_ranges(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """``df`` with ``__range``, the number of its range of (``by``, ``order``): equal rows share one, and no range holds
    much more than the others. Written once, since the bounds are sampled."""
    return checkpointed(df.repartitionByRange(*by, order).withColumn("__range", F.spark_partition_id()))


def _over_ranges(ranged: DataFrame, by: list[str], order: list[Column], other: Column, total: Column, row: Column, name: str) -> DataFrame:
    """``ranged`` with the struct of ``total`` over the ranges that ``other`` puts first and ``row`` over the rows of the own
    range up to each one, within ``by``. The first window has a row a range and group, the second one range."""
    whole = ranged.groupBy(*by, "__range").agg(total.alias("__whole"))
    done = W.partitionBy(*by).orderBy(other).rowsBetween(W.unboundedPreceding, -1)
    ahead = whole.withColumn("__ahead", (F.min if name == "least" else F.sum)("__whole").over(done)).drop("__whole")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*by, "__range"]]
    joined = ranged.alias("l").join(ahead.alias("r"), same).select("l.*", "r.__ahead")
    return joined.withColumn("__own", row.over(W.partitionBy(*by, "__range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def running_total(ranged: DataFrame, by: list[str], order: str, n: str, name: str) -> DataFrame:
    """Sum of ``n`` over the rows of ``by`` up to each one in ``order``; ``ranged`` comes from ``in_ranges`` and has no two rows
    alike in both. No task sees more than a range."""
    out = _over_ranges(ranged, by, [F.col(order)], F.col("__range"), F.sum(n), F.sum(n), "sum")
    return out.withColumn(name, F.col("__own") + F.coalesce("__ahead", F.lit(0))).drop("__own", "__ahead")


def running_least(ranged: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """Minimum of ``value`` over the rows of ``by`` from each one on in ``order``, like ``running_total``."""
    out = _over_ranges(ranged, by, [F.desc(order)], F.desc("__range"), F.min(value), F.min(value), "least")
    return out.withColumn(name, F.least("__own", "__ahead")).drop("__own", "__ahead")


def bh_adjust(df: DataFrame, p: str, by: list[str], id_col: str) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each ``by`` group; a null p does not count and stays null.

    Rows are counted by p first, ranks are sums of these counts by ranges of p, and equal p-values share one result;
    ``id_col`` is not needed for it. Without ``by`` all rows are one group."""
    if not by:
        return bh_adjust(df.withColumn("__all", F.lit(0)), p, ["__all"], id_col).drop("__all")
    counts = in_ranges(df.where(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count("*").alias("__t")), by, p)
    upto = running_total(counts, by, p, "__t", "__upto")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by]
    total = counts.groupBy(*by).agg(F.sum("__t").alias("__m"))
    raw = upto.alias("l").join(total.alias("r"), same).select("l.*", (F.col(p) * F.col("__m") / F.col("__upto")).alias("__raw"))
    least = running_least(raw, by, p, "__raw", "__least").select(*by, p, F.least(F.lit(1.0), "__least").alias("p_adjusted"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by] + [F.col(f"l.{p}") == F.col(f"r.{p}")]
    return df.alias("l").join(least.alias("r"), same, "left").select("l.*", "r.p_adjusted")


def _with_average_rank(counts: DataFrame, by: list[str], value: str, n: str) -> DataFrame:
    """Counts by (``by``, ``value``) with ``__r``, the average rank of the ``n`` rows of each value."""
    upto = running_total(in_ranges(counts, by, value), by, value, n, "__upto")
    return upto.withColumn("__r", F.col("__upto") - (F.col(n) - 1) / 2)


def rank_sum(df: DataFrame, group: str, value: str, by: list[str], first: str, second: str) -> DataFrame:
    """Rank-sum statistic U of group ``first`` against ``second`` within each ``by``, and its normal-approximation p. Rows are
    counted by value first, ranks come from these counts by ranges of values."""
    rows = df.where(F.col(group).isin(first, second) & F.col(value).isNotNull())
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("__t"), F.count_if(F.col(group) == first).alias("__a"))
    t = F.col("__t").cast("double")
    agg = _with_average_rank(counts, by, value, "__t").groupBy(*by).agg(F.sum("__a").alias("n1"), F.sum(F.col("__t") - F.col("__a")).alias("n2"), F.sum(F.col("__a") * F.col("__r")).alias("r1"), F.sum(t * (t * t - 1)).alias("ties"))
    agg = agg.withColumn("u", F.when(F.col("n1") > 0, F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2))
    n = (F.col("n1") + F.col("n2")).cast("double")
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12.0 * ((n + 1) - F.col("ties") / F.greatest(n * (n - 1), F.lit(1.0))))
    z = F.abs((F.col("u") - F.col("n1") * F.col("n2") / 2) / F.nullif(sd, F.lit(0.0)))
    return agg.withColumn("p", normal_tail(z) * 2).select(*by, "n1", "n2", "u", "p")


def signed_rank(df: DataFrame, group: str, value: str, by: list[str], pair_id: str, first: str, second: str) -> DataFrame:
    """Signed-rank statistic of the paired differences ``first`` - ``second``: the sum of positive ranks. Differences are
    counted by size first, ranks come from these counts by ranges of sizes."""
    pairs = df.groupBy(*by, pair_id).agg(*(F.max(F.when(F.col(group) == g, F.col(value))).alias(n) for g, n in ((first, "__a"), (second, "__b"))))
    diff = pairs.withColumn("__d", F.col("__a") - F.col("__b")).where("__d <> 0").withColumn("__abs", F.abs("__d"))
    counts = diff.groupBy(*by, "__abs").agg(F.count("*").alias("__t"), F.count_if(F.col("__d") > 0).alias("__up"))
    return _with_average_rank(counts, by, "__abs", "__t").groupBy(*by).agg(F.sum("__t").alias("n"), F.sum(F.col("__up") * F.col("__r")).alias("w"))


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / (2 * 3.141592653589793) ** 0.5 * poly


def knn(pairs: DataFrame, k: int, a: str = "a", b: str = "b", dist: str = "dist") -> DataFrame:
    """The ``k`` nearest partners of each row of a pair table that lists each pair once."""
    ends = F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)), F.struct(F.col(b).alias(a), F.col(a).alias(b)))
    both = pairs.select(F.explode(ends).alias("e"), dist).select("e.*", dist)  # the pairs are made once
    w = W.partitionBy(a).orderBy(dist, b)
    return both.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def windowed_gc(df: DataFrame, id_col: str, seq: str, width: int, step: int, g: str = "G", c: str = "C") -> DataFrame:
    """Share and skew of two letters in windows along each sequence; a row a window, the last one may be shorter."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(seq) - 1, F.lit(0)), F.lit(step))
    w = df.select(id_col, seq, F.explode(starts).alias("start")).select(id_col, "start", F.substring(F.col(seq), F.col("start") + 1, F.lit(width)).alias("s"))
    n = {x: F.length("s") - F.length(F.replace("s", F.lit(x))) for x in (g, c)}
    both = n[g] + n[c]
    return w.select(id_col, F.col("start").cast("long").alias("start"), F.when(F.length("s") > 0, both / F.length("s")).alias("gc"), F.when(both > 0, (n[g] - n[c]) / both).otherwise(0.0).alias("skew"))


def top_n(df: DataFrame, part: list[str], order: list[Column], n: int) -> DataFrame:
    w = W.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
