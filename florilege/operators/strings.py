"""Joins of strings by similarity that lose no pair: shared grams, rarest first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from florilege.functions.sequence import kmers
from florilege.functions.similarity import ratio, sorted_tokens, token_set, token_set_ratio, wratio
from florilege.functions.text import levenshtein_ratio
from florilege.operators.lineage import checkpointed


#: Scorers for which a join is known.
SCORERS = (levenshtein_ratio, ratio, token_set_ratio, wratio)


class Bounds:
    """What a string of length n shares with any string at ``least`` or more: the other's length is at least ``shortest``
    n, ``chars`` n characters and ``grams`` n - 1 pairs of neighbours are common."""

    def __init__(self, least: float, edits: bool):
        if not 0 < least <= 100:
            raise ValueError("scores must lie above 0 and up to 100")
        if edits:  # of max(n, m) characters at most (1 - least) are changed, each spoils two neighbours
            self.shortest = self.chars = least / 100
            self.grams = 2 * self.chars - 1
        else:  # what is left out spoils two neighbours, what is put in one; the extremes are the shortest and the longest partner
            self.shortest = self.chars = least / (200 - least)
            self.grams = min(2 * self.chars - 1, 2 - 1 / self.chars)


#: One part of a score: the string that it compares, what its least score promises, and whether tokens may change places.
Part = tuple[Callable[[str], Column], Bounds, bool]


def _sides(rows: DataFrame, name: str, side: str, parts: list[Part]) -> DataFrame:
    """A row a string and part: its length and, for a part, how many common pairs of neighbours and characters are promised."""
    each = []
    for k, (string, bounds, inside) in enumerate(parts):
        text = string(name)
        words = F.size(F.split(text, " ")) if inside else F.lit(1)
        pairs = F.ceil(F.length(text) * bounds.grams - 1 - 2 * (words - 1) - 1e-9)
        chars = F.ceil(F.length(text) * bounds.chars - 1e-9)
        each.append(F.struct(F.lit(k).alias("part"), text.alias("s"), F.length(text).alias("n"), pairs.cast("int").alias("pairs"), chars.cast("int").alias("chars"), F.lit(inside).alias("inside")))
    return rows.select(F.lit(side).alias("side"), F.col(name).alias("id"), F.explode(F.array(*each)).alias("x")).select("side", "id", "x.*").where("n > 0")


def near_strings(queries: DataFrame, terms: DataFrame, parts: list[Part]) -> DataFrame:
    """Pairs ``(query, term)`` of distinct ``query`` and ``term`` that may reach what one of ``parts`` promises; none that does
    is missing. Where tokens may change places only neighbours inside of a token count.

    Two strings that are that alike share pairs of neighbouring characters, so each has one of them among its rarest ones;
    how many are needed follows from the length. Where a length promises none, characters take their place, but only for
    pairs with such a short string. The k-th copy of a gram is a gram of its own. Keys of a string are at most its length;
    rare is what few terms have, so frequent grams are no keys of long strings."""
    rows = _sides(queries, "query", "a", parts).unionByName(_sides(terms, "term", "b", parts))
    short = F.col("pairs") <= 0
    neighbours = F.when(F.col("inside"), F.filter(kmers(F.col("s"), 2), lambda g: ~g.contains(" "))).otherwise(kmers(F.col("s"), 2))
    bags = F.array(F.struct(F.col("chars").alias("need"), kmers(F.col("s"), 1).alias("grams")), F.struct(F.col("pairs").alias("need"), F.when(~short, neighbours).otherwise(F.array().cast("array<string>")).alias("grams")))
    bags = rows.select("side", "part", "id", "n", short.alias("short"), F.posexplode(bags).alias("size", "bag")).where(F.size("bag.grams") > 0)
    each = bags.select("side", "part", "id", "n", "short", "size", (F.size("bag.grams") - F.col("bag.need") + 1).alias("keep"), F.explode("bag.grams").alias("g"))
    each = each.groupBy("side", "part", "id", "n", "short", "size", "keep", "g").count()
    each = checkpointed(each.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).drop("count"))
    counts = each.where("side = 'b'").groupBy("part", "size", "g", "k").agg(F.count("*").alias("terms"))
    rank = F.row_number().over(W.partitionBy("side", "part", "id", "size").orderBy(F.coalesce("terms", F.lit(0)), "g", "k"))
    keys = each.join(counts, ["part", "size", "g", "k"], "left").withColumn("rank", rank).where("rank <= keep")
    # who meets whom: long strings by neighbours, and by characters each short one and the other side
    other = {"a": ("ss", "sl", "ls"), "b": ("ss", "ls", "sl")}
    roles = lambda side: F.when(F.col("size") == 1, F.array(F.lit("ll"))).when(F.col("short"), F.array(F.lit(other[side][0]), F.lit(other[side][1]))).otherwise(F.array(F.lit(other[side][2])))
    a, b = (keys.where(F.col("side") == x).select("part", "g", "k", F.explode(roles(x)).alias("role"), F.col("id").alias(name), F.col("n").alias(f"n{x}")) for x, name in (("a", "query"), ("b", "term")))
    shortest = F.element_at(F.array(*(F.lit(bounds.shortest) for _, bounds, _ in parts)), F.col("part") + 1)
    reach = (F.col("nb") >= F.col("na") * shortest - 1e-9) & (F.col("na") >= F.col("nb") * shortest - 1e-9)
    return a.join(b, ["part", "role", "g", "k"]).where(reach).select("query", "term").distinct()


def covering_tokens(queries: DataFrame, terms: DataFrame, least: float) -> DataFrame:
    """Pairs ``(query, term)`` of ``queries(query, tokens)`` and ``terms(term, tokens)``, distinct tokens, whose common tokens,
    joined, have a ratio of ``least`` or more to all tokens of one of them; none that has it is missing.

    The common tokens then hold a share of that side's length, so one of them is among its rarest tokens, those before which
    too much would be missing. These keys meet all tokens of the other side."""
    share = least / (200 - least)

    def sides(rows: DataFrame, name: str, counts: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
        each = rows.select(F.col(name), F.length(F.array_join("tokens", " ")).alias("n"), F.explode("tokens").alias("t"))
        own = each.groupBy("t").agg(F.count("*").alias("rows")) if counts is None else counts
        rest = F.sum(F.length("t") + 1).over(W.partitionBy(name).orderBy(F.coalesce("rows", F.lit(0)), "t").rowsBetween(0, W.unboundedFollowing)) - 1
        keys = each.join(own, "t", "left").withColumn("rest", rest).where(F.col("rest") >= F.col("n") * share - 1e-9)
        return each.select(name, "t"), keys.select(name, "t"), own

    all_b, keys_b, counts = sides(terms, "term", None)
    all_a, keys_a, _ = sides(queries, "query", counts)
    return keys_a.join(all_b, "t").select("query", "term").union(all_a.join(keys_b, "t").select("query", "term")).distinct()


def _joined_set(column: str) -> Column:
    return F.array_join(token_set(F.lower(column)), " ")


def _sets(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(name, token_set(F.lower(name)).alias("tokens"))


def similar_pairs(queries: DataFrame, terms: DataFrame, scorer: Callable[[Column, Column], Column], least: float) -> DataFrame:
    """``(query, term, score)`` of all pairs of ``queries(query)`` and ``terms(term)``, distinct strings, that ``scorer`` gives
    ``least`` or more: ``levenshtein_ratio``, ``ratio``, ``token_set_ratio`` or ``wratio``. No pair is missing and no pair without
    a common gram or token is scored: each part of a score has its own join."""

    def part(string: Callable[[str], Column], least: float, edits: bool = False, inside: bool = False) -> Part:
        return string, Bounds(min(least, 100.0), edits), inside

    covering = None
    if scorer is levenshtein_ratio:
        parts = [part(F.col, least, edits=True)]
    elif scorer is ratio:
        parts = [part(F.lower, least)]
    elif scorer is token_set_ratio:
        parts, covering = [part(_joined_set, least, inside=True)], least
    elif scorer is wratio:
        parts = [part(F.lower, least)]
        if least <= 95:
            parts += [part(lambda c: sorted_tokens(F.lower(c)), least / 0.95), part(_joined_set, least / 0.95, inside=True)]
            covering = least / 0.95
    else:
        raise ValueError("no join is known for this scorer")
    blank = [rows.where(sorted_tokens(F.col(c)) == "") for rows, c in ((queries, "query"), (terms, "term"))]
    pairs = blank[0].join(blank[1], sorted_tokens(F.col("query")) == sorted_tokens(F.col("term"))).select("query", "term")  # no grams
    pairs = pairs.union(near_strings(queries, terms, parts))
    if covering is not None:
        pairs = pairs.union(covering_tokens(_sets(queries, "query"), _sets(terms, "term"), covering))
    return pairs.distinct().withColumn("score", scorer(F.col("query"), F.col("term"))).where(F.col("score") >= least)
