"""Document fingerprints by one-permutation MinHash, with Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from florilege.llm.expressions import let, named

BINS, BIN_BITS = 256, 8
WIDTH = 5
#: Low-order bits kept of each bin, two hexadecimal digits of the fingerprint.
BITS, DIGITS = 8, 2
#: Ranges of ids, dealt out for the search of the next document: at least so many for each shuffle partition, and more
#: where a range would have more rows than this.
RANGES_A_PARTITION, RANGE_ROWS = 4, 1_000_000

_BLANKS = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, in lower case."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_BLANKS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+", -1)))


def _shingles(w: Column) -> Column:
    """Hashes of the five-word shingles; the whole sequence is the only shingle of one to four words."""
    each = F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(WIDTH))))
    return F.when(F.size(w) >= WIDTH, each).when(F.size(w) > 0, F.array(F.xxhash64(F.size(w), F.array_join(w, " ")))).otherwise(F.array().cast("array<long>"))


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS).cast("int") + BINS // 2


def _bins(firsts: Column) -> Column:
    """The smallest hash of each bin, null for bins without one. ``firsts``: those of the other bins, in order."""
    none = F.lit(None).cast("long")

    def placed(h: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(firsts, i - 1)))
        return F.concat(F.array_repeat(none, _bin(h) - before - 1), F.array(h))

    return F.concat(F.flatten(F.transform(firsts, placed)), F.array_repeat(none, F.lit(BINS - 1) - _bin(F.get(firsts, F.size(firsts) - 1))))


def _packed(firsts: Column) -> Column:
    """Optimal densification: an empty bin tries bins drawn by a universal hash of its number and the attempt until one is
    not empty, and takes its value. After eight times the attempts that are needed on average, the few bins still
    empty take the value whose hash with their number is smallest. Of each value low bits of a hash with its bin's
    number are kept, so that one value in many bins agrees with another by chance in few of them."""

    def dense(bins: Column) -> Column:
        def borrowed(j: Column) -> Column:
            mean = F.ceil(F.lit(BINS) / F.size(firsts)).cast("int")

            def tried(after: int, upto: int) -> Column:
                tries = F.sequence(mean * after + 1, mean * upto)
                return F.aggregate(tries, F.lit(None).cast("long"), lambda v, t: F.coalesce(v, F.get(bins, F.pmod(F.xxhash64(j, t), F.lit(BINS)).cast("int"))))

            return F.coalesce(tried(0, 1), tried(1, 3), tried(3, 8), F.array_min(F.transform(firsts, lambda v: F.struct(F.xxhash64(v, j), v.alias("v"))))["v"])

        def kept(j: Column) -> Column:
            low = F.xxhash64(F.coalesce(F.get(bins, j), borrowed(j)), j).bitwiseAND(F.lit((1 << BITS) - 1))
            return F.substring(F.hex(low + (1 << BITS)), 2, DIGITS)

        return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), kept), ""))

    return let(_bins(firsts), dense)


def _firsts(ordered: Column) -> Column:
    """Bins are the hashes' high bits, so in ascending order the first hash of each bin is its smallest one."""
    return F.filter(ordered, lambda h, i: (i == 0) | (F.shiftright(h, 64 - BIN_BITS) != F.shiftright(F.get(ordered, i - 1), 64 - BIN_BITS)))


def fingerprint(text: Column) -> Column:
    """Packed bits as hexadecimal digits; the empty string for a null text or one without words. Equal texts give equal fingerprints."""
    hashes = let(words(text), _shingles)
    return let(F.sort_array(hashes), lambda h: F.when(F.size(h) == 0, "").otherwise(let(_firsts(h), _packed)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles: the share of bins with equal bits, less what is equal by chance.
    Two fingerprints without shingles are alike, one with and one without are not."""
    part = lambda s, k: F.conv(F.substring(s, k * 8 + 1, F.lit(8)), 16, 10).cast("long")

    def add(n: Column, k: Column) -> Column:
        """Bytes of four that differ: a byte's bits are folded into its lowest."""
        x = part(a, k).bitwiseXOR(part(b, k))
        two = x.bitwiseOR(F.shiftright(x, 1))
        return n + let(two, lambda y: let(y.bitwiseOR(F.shiftright(y, 2)), lambda z: F.bit_count(z.bitwiseOR(F.shiftright(z, 4)).bitwiseAND(F.lit(0x01010101)))))

    differ = F.aggregate(F.sequence(F.lit(0), F.lit(BINS * DIGITS // 8 - 1)), F.lit(0), add)
    chance = 1 / (1 << BITS)
    share = (F.lit(BINS) - differ) / BINS
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.greatest(F.lit(0.0), (share - chance) / (1 - chance)))


def _bounds_below(value: Column, bounds: list, kind: T.DataType) -> Column:
    """How many of the sorted ``bounds`` are below ``value``: a step over every so many of them, then one within."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))

    def array(values: list) -> Column:
        if isinstance(kind, T.IntegralType):
            return F.split(F.lit(",".join(map(str, values))), ",").cast(T.ArrayType(kind))  # folded to a constant
        return F.array(*map(F.lit, values))

    below = lambda some: F.size(F.filter(some, lambda b: b < value))
    return let(below(array(bounds[::step])), lambda c: F.when(c == 0, 0).otherwise((c - 1) * step + below(F.slice(array(bounds), (c - 1) * step + 1, F.lit(step)))))


def with_next(rows: DataFrame, id_col: str, text_col: str, derived: dict[str, Column]) -> DataFrame:
    """``rows`` with ``derived`` columns of the text, and ``next_<c>`` for the text and each of them: the value in the next
    row by descending ``id_col`` (the first row's after the last; null ids come last; ties in descending order of a hash
    of the text).

    Rows are dealt by ranges of the id, whose bounds are approximate percentiles, so each range has about the same number
    of rows, and ranges grow in number with the rows. The last row of a range finds its next one in a copy of the first
    row of the range below it: one row a range. Derived columns are computed once a row, after its range is known.
    """
    spark = rows.sparkSession
    least = RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, least, -(-rows.count() // RANGE_ROWS))
    bounds = rows.agg(F.percentile_approx(id_col, [k / n for k in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    bucket = F.when(F.col(id_col).isNull(), -1).otherwise(_bounds_below(F.col(id_col), sorted(set(bounds)), rows.schema[id_col].dataType))
    rows = rows.withColumn("__bucket", bucket.cast("int")).withColumn("__hash", F.xxhash64(text_col)).withColumn("__copy", F.lit(0))
    tops = rows.groupBy("__bucket").agg(F.max(F.struct(id_col, "__hash")).alias("top")).collect()
    order = sorted(((r["__bucket"], r["top"][0], r["top"]["__hash"]) for r in tops), key=lambda x: -x[0])
    above = [(order[k - 1][0], i, h) for k, (_, i, h) in enumerate(order)]  # a range's first row also ends the range above; the first ends the last
    schema = T.StructType([T.StructField("__into", T.IntegerType()), T.StructField("__top", rows.schema[id_col].dataType), T.StructField("__top_hash", T.LongType())])
    heads = spark.createDataFrame(above, schema)
    copies = rows.join(F.broadcast(heads), F.col(id_col).eqNullSafe(F.col("__top")) & (F.col("__hash") == F.col("__top_hash")))
    copies = copies.withColumn("__bucket", F.col("__into")).withColumn("__copy", F.lit(1)).drop("__into", "__top", "__top_hash")
    both = rows.unionByName(copies).withColumns(derived)
    if n > least:
        both = both.repartition(-(-n // RANGES_A_PARTITION), "__bucket")
    ordered = W.partitionBy("__bucket").orderBy("__copy", F.desc_nulls_last(id_col), F.desc("__hash"))
    both = both.select("*", *(F.lead(c).over(ordered).alias(f"next_{c}") for c in [text_col, *derived]))
    return both.where("__copy = 0").drop("__bucket", "__hash", "__copy")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of an edited copy: its last half replaced by the start of the next document.

    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``. Null text
    is the empty text; very long texts count whole. Repeated ids are ordered by a hash of their texts, null ids come
    last; a single document is its own next one; an empty table gives no rows. Text is shuffled once. ``id_col`` must hold
    numbers, since documents follow each other by it.
    """
    if not isinstance(docs.schema[id_col].dataType, T.NumericType):
        raise ValueError("ids must be numbers")
    rows = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, "id", "text", {"fingerprint": fingerprint(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited"))
    rows = rows.select("*", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
