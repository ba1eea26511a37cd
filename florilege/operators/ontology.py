"""Hierarchies of terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.operators.lineage import checkpointed


def ancestors(edges: DataFrame, on_cycle: str = "stop") -> DataFrame:
    """``(id, ancestor, depth)`` from ``edges(id, parent)``: every pair of a term and a term above it with the shortest
    distance, and each term with itself at 0. On a cycle each term has the others above it once; ``on_cycle="raise"`` fails.

    Pointers are doubled: once all pairs up to a distance m are known, those at m joined with all from 1 to m give the
    pairs up to 2m, since each shortest way passes a term at distance m. So rounds grow with the logarithm of the depth,
    which has no limit. Each round's pairs are a written table; a term that meets itself is on a cycle."""
    up = edges.where("id is not null and parent is not null").select("id", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct()
    known, far = checkpointed(up), 1
    ends = known.select("id").union(known.select("ancestor")).distinct().select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth"))
    while True:
        if on_cycle == "raise" and (loop := known.where("id = ancestor").first()) is not None:
            raise ValueError(f"{loop.id} is its own ancestor")
        last = known.where(F.col("depth") == far)
        if last.isEmpty():
            return known.where("id <> ancestor").union(ends)
        steps = known.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next"), F.col("depth").alias("more"))
        found = last.select("id", "ancestor").join(steps, "ancestor").groupBy("id", F.col("next").alias("ancestor")).agg((F.min("more") + far).alias("depth"))
        new = checkpointed(found.join(known, ["id", "ancestor"], "left_anti"))
        known, far = known.union(new), 2 * far


def ancestor_levels(ids: DataFrame, key: str, id_col: str, closure: DataFrame, levels: list[int], sep: str = ",") -> DataFrame:
    """For each key and level the ancestors of its ids that are so far from the root, sorted and joined."""
    height = closure.groupBy("id").agg(F.max("depth").alias("height"))
    placed = closure.join(height.select(F.col("id").alias("ancestor"), "height"), "ancestor")
    found = ids.select(key, id_col).distinct().join(placed, F.col(id_col) == F.col("id"))
    lists = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("height") == n, F.col("ancestor")))), sep).alias(f"level{n}") for n in levels]
    return found.groupBy(key).agg(*lists)


def attach_terms(ids: DataFrame, key: str, id_col: str, terms: DataFrame, sep: str = ",") -> DataFrame:
    """For each key the names of its ids, in order of the ids."""
    found = ids.select(key, id_col).distinct().join(terms.select(F.col("id").alias(id_col), "name"), id_col)
    pairs = F.array_sort(F.collect_list(F.struct(id_col, "name")))
    return found.groupBy(key).agg(F.array_join(F.transform(pairs, lambda p: p["name"]), sep).alias("names"))


def vocabulary_in_use(terms: DataFrame, df: DataFrame, col: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """The terms that ``col``, a delimited list of ids, refers to, and the ids without a term."""
    used = df.select(F.explode(F.split(col, sep)).alias("id")).select(F.trim("id").alias("id")).where("id <> ''").distinct()
    return terms.join(used, "id", "left_semi"), used.join(terms, "id", "left_anti")


def lineage_table(ids: DataFrame, id_col: str, closure: DataFrame, terms: DataFrame, ranks: list[str]) -> DataFrame:
    """A row an id: name and id of its ancestor of each rank. ``terms``: (id, name, rank)."""
    found = ids.select(F.col(id_col).alias("id")).distinct().join(closure, "id")
    named = found.join(terms.select(F.col("id").alias("ancestor"), "name", "rank"), "ancestor")
    aggs = [x for r in ranks for x in (F.min(F.when(F.col("rank") == r, F.col("name"))).alias(r), F.min(F.when(F.col("rank") == r, F.col("ancestor"))).alias(f"{r}_id"))]
    return named.groupBy("id").agg(*aggs)
