"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from florilege.operators.lineage import checkpointed
from florilege.operators.windows import in_ranges, running_total


def group_count(df: DataFrame, key: list[str], name: str = "n") -> DataFrame:
    """Every row with the size of its group. Counts are pre-aggregated, so a frequent key costs a row a task."""
    counts = df.groupBy(*key).agg(F.count("*").alias(name))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
    return df.alias("l").join(counts.alias("r"), same).select("l.*", f"r.{name}")


def over_threshold(df: DataFrame, key: str, item: str, n: int) -> DataFrame:
    """Keys with more than ``n`` distinct items."""
    return df.groupBy(key).agg(F.countDistinct(item).alias("n_items")).where(F.col("n_items") > n)


def distinct_list(df: DataFrame, key: str, item: str, sep: str = ",", keys: DataFrame | None = None) -> DataFrame:
    """Sorted distinct items of each key as a string, and their number; '' and 0 for keys of ``keys`` without any."""
    found = df.where(F.col(item).isNotNull()).select(key, item).distinct()
    found = found.groupBy(key).agg(F.array_sort(F.collect_list(F.col(item).cast("string"))).alias("l"))
    found = found.select(key, F.array_join("l", sep).alias("items"), F.size("l").cast("long").alias("n_items"))
    if keys is None:
        return found
    return keys.join(found, key, "left").na.fill({"items": "", "n_items": 0})


def list_unique(df: DataFrame, key: str, item: str, sep: str = ",") -> DataFrame:
    """Items of each key in order, as a string; fails if an item repeats within a key."""
    found = df.groupBy(key).agg(F.array_sort(F.collect_list(F.col(item).cast("string"))).alias("l"))
    repeats = F.size("l") != F.size(F.array_distinct("l"))
    items = F.when(repeats, F.raise_error(F.concat(F.lit(f"repeated {item} for "), F.col(key).cast("string")))).otherwise(F.array_join("l", sep))
    return found.select(key, items.alias("items"))


def distinct_per_level(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values of each column, a row a column."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("value")) for c in cols))).alias("x")).select("x.*")
    return long.groupBy("level").agg(count("value").alias("n_distinct"))


def resolve_category(df: DataFrame, key: str, cat: str, rules: dict[tuple[str, ...], str], default: str = "undefined") -> DataFrame:
    """One category for each key: its only one, or that of the rule for its sorted set of categories, else ``default``."""
    found = df.select(key, cat).distinct().groupBy(key).agg(F.array_sort(F.collect_list(cat)).alias("s"))
    out = F.when(F.size("s") == 1, F.col("s")[0])
    for some, name in rules.items():
        out = out.when(F.col("s") == F.array(*map(F.lit, sorted(some))), name)
    return found.select(key, out.otherwise(default).alias(cat))


def chain_hits(df: DataFrame, part: list[str], start: str, end: str, query_length: str, length: str, identity: str) -> DataFrame:
    """Hits of a pair folded in order of start, end, query length, length and identity. From an empty chain that ends at 0,
    a hit that starts right after the chain's end extends it: the length becomes that end, the identity the mean of the
    chain's and its own (its own, if the chain has none). Another hit takes the chain's place if it is longer.

    One row a pair: ``start``, ``end``, ``length``, ``identity`` and ``coverage``, the share of the query times the
    identity. A pair's hits meet in one array: aligners report a few a pair."""
    names = {"s": start, "e": end, "q": query_length, "l": length, "i": identity}
    hit = F.struct(*(F.col(c).cast("double" if n == "i" else "long").alias(n) for n, c in names.items()))
    hits = df.groupBy(*part).agg(F.array_sort(F.collect_list(hit)).alias("h"))

    def fold(chain: Column, hit: Column) -> Column:
        mean = F.when(chain["i"] == 0, hit["i"]).otherwise((chain["i"] + hit["i"]) / 2)
        joined = F.struct(chain["s"].alias("s"), hit["e"].alias("e"), hit["q"].alias("q"), hit["e"].alias("l"), mean.alias("i"))
        return F.when(hit["s"] == chain["e"] + 1, joined).when(chain["l"] < hit["l"], hit).otherwise(chain)

    none = F.struct(*(F.lit(0).cast("double" if n == "i" else "long").alias(n) for n in names))
    best = hits.select(*part, F.aggregate("h", none, fold).alias("c"))
    coverage = F.try_divide(F.col("c.l"), F.col("c.q")) * F.col("c.i")
    return best.select(*part, F.col("c.s").alias("start"), F.col("c.e").alias("end"), F.col("c.l").alias("length"), F.col("c.i").alias("identity"), coverage.alias("coverage"))


def argmax_by(df: DataFrame, key: list[str], value: str, payload: list[str]) -> DataFrame:
    """For each key the row of ``payload`` with the largest value; the smallest payload wins ties."""
    best = df.groupBy(*key).agg(F.max(value).alias("__best"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key] + [F.col(f"l.{value}") == F.col("r.__best")]
    top = df.alias("l").join(best.alias("r"), same).select("l.*")
    return top.groupBy(*key, value).agg(F.min(F.struct(*payload)).alias("__p")).select(*key, value, "__p.*")


def quantiles(df: DataFrame, value: Column, probabilities: dict[str, float], by: list[Column] | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation) of ``value`` by ``by``, a column each; nulls don't count.

    Rows are counted by value first, so a value of most rows is one row from there on. The counted values are numbered by
    ranges: a value covers the ranks of its rows, and a wanted rank is looked up among them. No task sees a whole group.
    Without ``by`` one row, of nulls for an empty table."""
    keys = [f"__k{i}" for i in range(len(by or []))]
    rows = df.select(*(c.alias(k) for c, k in zip(by or [], keys, strict=True)), value.cast("double").alias("v"), F.lit(0).alias("__all")).where("v is not null")
    group = keys or ["__all"]
    upto = running_total(in_ranges(rows.groupBy(*group, "v").agg(F.count("*").alias("m")), group, "v"), group, "v", "m", "upto")
    upto = checkpointed(upto.select(*group, "v", "m", "upto"))
    total = upto.groupBy(*group).agg(F.max("upto").alias("n"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in group]
    placed = upto.alias("l").join(total.alias("r"), same).select("l.*", "n")
    at = [(F.col("n") - 1) * F.lit(p) for p in probabilities.values()]
    holds = lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("m"))
    ends = [end for x in at for end in (F.floor(x), F.ceil(x))]
    found = placed.where(F.exists(F.array(*ends), holds))
    value_at = [x for i, (lo, hi) in enumerate(zip(ends[::2], ends[1::2], strict=True)) for x in (F.max(F.when(holds(lo), F.col("v"))).alias(f"lo{i}"), F.max(F.when(holds(hi), F.col("v"))).alias(f"hi{i}"))]
    out = found.groupBy(*keys).agg(F.max("n").alias("n"), *value_at)
    share = [x - F.floor(x) for x in at]
    between = lambda lo, hi, x: F.when(lo == hi, lo).otherwise(lo + (hi - lo) * x)  # equal ends may be infinite
    return out.select(*keys, *(between(F.col(f"lo{i}"), F.col(f"hi{i}"), x).alias(name) for i, (name, x) in enumerate(zip(probabilities, share, strict=True))))


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def iqr_bounds(df: DataFrame, value: Column, k: float) -> DataFrame:
    """One row: ``low`` and ``high``, ``k`` interquartile ranges outside of the quartiles."""
    q = quantiles(df, value, {"q1": 0.25, "q3": 0.75})
    return q.select((F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("low"), (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("high"))


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, log: bool = False, name: str = "outlier") -> DataFrame:
    """Every row with ``low``, ``high`` and a flag outside of ``k`` interquartile ranges around the quartiles."""
    value = F.log10(col) if log else F.col(col)
    return df.crossJoin(F.broadcast(iqr_bounds(df, value, k))).withColumn(name, (value < F.col("low")) | (value > F.col("high")))  # one row of bounds


def summarize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Minimum, quartiles, mean, maximum and number of nulls of each column, a row a column."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols))).alias("x")).select("x.*")
    q = quantiles(long, F.col("v"), _QUARTILES, [F.col("column")]).withColumnRenamed("__k0", "column")
    rest = long.groupBy("column").agg(F.min("v").alias("min"), F.avg("v").alias("mean"), F.max("v").alias("max"), F.count_if(F.col("v").isNull()).alias("n_null"))
    return rest.join(q, "column", "left").select("column", "min", "q1", "median", "q3", "mean", "max", "n_null")


def hierarchy_rollup(df: DataFrame, levels: list[str]) -> DataFrame:
    """Counts at every level of a hierarchy; ``depth`` tells how many levels a row keeps."""
    n = F.lit(len(levels)) - F.bit_count(F.grouping_id())
    return df.rollup(*levels).agg(F.count("*").alias("n"), n.cast("long").alias("depth"))


def count_by_location(df: DataFrame, lat: str, lng: str, digits: int = 2) -> DataFrame:
    return df.groupBy(F.round(lat, digits).alias("lat"), F.round(lng, digits).alias("lng")).agg(F.count("*").alias("n"))


def violations_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that repeat, with their counts: no rows where the key is unique."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    bad = violations_unique(df, key).first()  # one row at most
    if bad is not None:
        raise ValueError(f"key {key} repeats: {bad.asDict()}")
    return df


def _share(df: DataFrame, col: str) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("percent", 100 * F.col("n") / F.col("total"))  # one row of total


def percent_of_total(df: DataFrame, col: str) -> DataFrame:
    return _share(df, col).drop("total")


def representatives(df: DataFrame, col: str, cum_pct: float, other: str = "Others") -> DataFrame:
    """Values by descending share with their cumulative share; values up to ``cum_pct`` keep their name, the rest is
    ``other``. The window runs over the counts, a row a value; use it for columns of few values."""
    w = W.orderBy(F.desc("n"), col).rowsBetween(W.unboundedPreceding, 0)
    out = _share(df, col).withColumn("cum_percent", 100 * F.sum("n").over(w) / F.col("total"))
    return out.withColumn("label", F.when(F.col("cum_percent") <= cum_pct, F.col(col).cast("string")).otherwise(other)).drop("total")


def relative_abundance(df: DataFrame, sample: str, value: str, name: str = "abundance") -> DataFrame:
    """Share of each row in its sample's sum; 0 where the sum is 0."""
    sums = df.groupBy(sample).agg(F.sum(value).alias("__sum"))
    share = F.when(F.col("__sum") == 0, F.lit(0.0)).otherwise(F.col(value) / F.col("__sum"))
    return df.join(sums, sample).withColumn(name, share).drop("__sum")


def alpha_diversity(df: DataFrame, sample: str, taxon: str, count: str) -> DataFrame:
    """Chao1 (bias-corrected), Shannon and Simpson indices of each sample."""
    n = df.groupBy(sample, taxon).agg(F.sum(count).cast("double").alias("n")).where("n > 0")
    agg = n.groupBy(sample).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("nl"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("s"), F.count_if(F.col("n") == 1).alias("f1"), F.count_if(F.col("n") == 2).alias("f2"))
    chao = F.col("s") + F.col("f1") * (F.col("f1") - 1) / (2 * (F.col("f2") + 1))
    return agg.select(sample, chao.alias("chao1"), (F.log("t") - F.col("nl") / F.col("t")).alias("shannon"), (1 - F.col("nn") / (F.col("t") * F.col("t"))).alias("simpson"))


def stack_to_rank(df: DataFrame, sample: str, ranks: list[str], level: str, value: str, keep: list[str], other: str = "Others") -> DataFrame:
    """Sums by sample and label: kept names of the rank ``level`` or, where it is empty, the lowest rank above it that isn't."""
    upto = ranks[: ranks.index(level) + 1]
    name = F.coalesce(*(F.nullif(F.col(r), F.lit("")) for r in reversed(upto)))
    label = F.when(name.isin(*keep), name).otherwise(other)
    return df.groupBy(sample, label.alias("label")).agg(F.sum(value).alias(value))


def histogram(df: DataFrame, expr: Column, width: float, name: str = "bin") -> DataFrame:
    return df.groupBy((F.floor(expr / width) * width).cast("double").alias(name)).agg(F.count("*").alias("n"))


def density2d(df: DataFrame, x: Column, y: Column, width_x: float, width_y: float) -> DataFrame:
    return df.groupBy(F.floor(x / width_x).alias("x_bin"), F.floor(y / width_y).alias("y_bin")).agg(F.count("*").alias("n"))


def coverage_report(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """One row: rows in all and those that satisfy each predicate."""
    return df.agg(F.count("*").alias("total"), *(F.count_if(p).alias(n) for n, p in predicates.items()))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles of each group and the outermost values within 1.5 interquartile ranges of them."""
    q = quantiles(df, F.col(value), _QUARTILES, [F.col(group)]).withColumnRenamed("__k0", group)
    low, high = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = df.join(q, group).where((F.col(value) >= low) & (F.col(value) <= high))
    return inside.groupBy(group, "q1", "median", "q3").agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))


def common_member(df: DataFrame, family: str, cls: str, item: str) -> DataFrame:
    """For each family the smallest item that is in every one of its classes."""
    classes = df.groupBy(family).agg(F.countDistinct(cls).alias("__all"))
    each = df.groupBy(family, item).agg(F.countDistinct(cls).alias("__in"))
    return each.join(classes, family).where("__in = __all").groupBy(family).agg(F.min(item).alias("representative"))


def pivot_attributes(df: DataFrame, key: str, name: str, value: str, names: list[str], synonyms: dict[str, str] | None = None) -> DataFrame:
    """Attribute rows as one wide row a key; synonyms are resolved first, the smallest of several values stays."""
    canonical = F.col(name)
    if synonyms:
        canonical = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in synonyms.items() for x in p)), F.col(name)), F.col(name))
    return df.select(key, canonical.alias("__name"), value).groupBy(key).pivot("__name", names).agg(F.min(value))
