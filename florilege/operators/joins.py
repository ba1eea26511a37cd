"""Joins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions.text import normalize_term
from florilege.operators.aggregates import assert_unique
from florilege.operators.lineage import checkpointed
from florilege.operators.neighbours import pairs_within
from florilege.operators.strings import SCORERS, similar_pairs


def validated_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", validate: str = "m:1", distinct: bool = False) -> DataFrame:
    """Equi-join that fails if a side declared unique (``1`` in ``1:1``, ``m:1``, ``1:m``) repeats a key."""
    if validate.startswith("1"):
        assert_unique(left, on)
    if validate.endswith("1"):
        assert_unique(right, on)
    out = left.join(right, on, how)
    return out.distinct() if distinct else out


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str, str, str]], how: str = "left") -> DataFrame:
    """Chain of joins with dimensions ``(frame, fact key, its key, suffix)``; names that clash get the suffix.

    Spark broadcasts the dimensions that its statistics show to be small."""
    out = fact
    for dim, key, own, suffix in dims:
        clash = {c: c + suffix for c in dim.columns if c in out.columns}
        dim = dim.withColumnsRenamed(clash)
        own = clash.get(own, own)
        out = out.join(dim, out[key] == dim[own], how)
        if own != key:
            out = out.drop(own)
    return out


def join_distinct(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left").distinct()


def prune_to(frames: dict[str, DataFrame], survivors: DataFrame, keys: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Each frame restricted to the rows that survivors still refer to. ``keys``: (own key, survivors' key) by frame."""
    out = {}
    for name, df in frames.items():
        own, theirs = keys[name]
        alive = survivors.where(F.col(theirs).isNotNull()).select(F.col(theirs).alias("__alive")).distinct()
        out[name] = df.join(alive, F.col(own) == F.col("__alive"), "left_semi")
    return out


def remove_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    gone = ids.select(F.col(ids.columns[0]).alias("__gone")).distinct()
    return df.join(gone, F.col(key) == F.col("__gone"), "left_anti")


def dictionary_join(df: DataFrame, item: str, mapping: DataFrame, query: str, value: str, strict: bool = False) -> DataFrame:
    """Look up ``item`` as it is, then normalised. ``matched``: exact, normalised, or none; ``strict`` fails on none.

    ``mapping`` has one row a query; of queries with one normal form the smallest value counts."""
    exact = mapping.groupBy(F.col(query).alias("__q")).agg(F.min(value).alias("__exact"))
    loose = mapping.groupBy(normalize_term(F.col(query)).alias("__n")).agg(F.min(value).alias("__loose"))
    out = df.join(exact, F.col(item) == F.col("__q"), "left").join(loose, normalize_term(F.col(item)) == F.col("__n"), "left")
    matched = F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__loose").isNotNull(), "normalised").otherwise("none")
    found = F.coalesce("__exact", "__loose")
    if strict:
        found = F.when(F.col(item).isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col(item))))
    return out.select(*df.columns, found.alias(value), matched.alias("matched"))


def apply_corrections(df: DataFrame, key: str, corrections: DataFrame, before: str, after: str) -> DataFrame:
    """``key`` replaced by its curated value where there is one."""
    some = corrections.groupBy(F.col(before).alias("__before")).agg(F.min(after).alias("__after"))
    joined = df.join(some, F.col(key) == F.col("__before"), "left")
    return joined.withColumn(key, F.coalesce("__after", key)).drop("__before", "__after")


def carry_forward(df: DataFrame, prev: DataFrame, key: str, cols: list[str], flag: str) -> DataFrame:
    """Flagged rows that the previous release has take its values and lose the flag."""
    old = prev.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in cols))
    joined = df.join(old, F.col(key) == F.col("__key"), "left")
    take = F.col(flag) & F.col("__key").isNotNull()
    new = {c: F.when(take, F.col(f"__{c}")).otherwise(F.col(c)) for c in cols} | {flag: F.col(flag) & ~F.coalesce(take, F.lit(False))}
    return joined.withColumns(new).select(*df.columns)


def group_pairs(df: DataFrame, keys: list[str], id_col: str, size: str) -> DataFrame:
    """Unordered pairs of rows that share a value of one of ``keys``: ``query`` is the smaller, ``subject`` the larger.

    The pairs are the output, so groups should be small; a large one is dealt to blocks of pairs, see ``pairs_within``. Null
    keys make no group. Rows that share several keys are a pair by the first of them only, so pairs are not shuffled; only
    where an id is of several rows they are made distinct."""
    own = df.select(F.struct(F.col(size), F.col(id_col), F.array(*(F.col(k).cast("string") for k in keys)).alias("__keys")).alias("row")).distinct()
    long = own.select("row", F.posexplode("row.__keys").alias("by", "value")).where("value is not null")
    pairs = pairs_within(long, ["by", "value"], "row")
    before = F.exists(F.sequence(F.lit(0), F.lit(len(keys) - 1)), lambda j: (j < F.col("by")) & (F.get("x.__keys", j) == F.get("y.__keys", j)))
    found = pairs.where(~F.coalesce(before, F.lit(False))).select(F.col(f"x.{id_col}").alias("query"), F.col(f"y.{id_col}").alias("subject"))
    repeated = own.groupBy(f"row.{id_col}").count().where("count > 1").first() is not None  # one row at most
    return found.distinct() if repeated else found


#: Tolerances that a bucket of ``crowded_ids`` is wide: wider ones copy fewer rows to a neighbour and compare more.
BUCKET = 4


def crowded_ids(df: DataFrame, part: list[str], start: str, stop: str, tol: int, order: list[str], id_col: str) -> DataFrame:
    """The ids (``__id``) of rows with another one of higher priority (lower ``order``) in the same part whose start and stop
    both lie within ``tol``.

    A band join: rows meet in buckets of starts; a row near a border of its bucket is also put into the next one."""
    rank, width = F.struct(*order, id_col), BUCKET * (tol + 1)
    slim = df.select(*part, F.col(start).alias("__start"), F.col(stop).alias("__stop"), rank.alias("__rank"))
    at = lambda x: F.floor(x / width)
    right = slim.select(*(F.col(p).alias(f"__{p}") for p in part), F.col("__start").alias("__s"), F.col("__stop").alias("__e"), F.col("__rank").alias("__r"), F.explode(F.sequence(at(F.col("__start") - tol), at(F.col("__start") + tol))).alias("__b"))
    same = [F.col(p) == F.col(f"__{p}") for p in part]
    near = (F.abs(F.col("__start") - F.col("__s")) <= tol) & (F.abs(F.col("__stop") - F.col("__e")) <= tol) & (F.col("__r") < F.col("__rank"))
    return slim.withColumn("__own", at(F.col("__start"))).join(right, [*same, F.col("__own") == F.col("__b"), near], "left_semi").select(F.col(f"__rank.{id_col}").alias("__id"))


def proximity_dedup(df: DataFrame, part: list[str], start: str, stop: str, tol: int, order: list[str], id_col: str) -> DataFrame:
    """Rows that are not among ``crowded_ids``; rows that are removed still remove others."""
    return df.join(crowded_ids(df, part, start, stop, tol, order, id_col), F.col(id_col) == F.col("__id"), "left_anti")


#: Share of the sketches (one of so many) and most of their hashes by which ``similarity_join`` tells frequent hashes.
SAMPLED, MOST_HOT = 16, 100_000


def _rare_first(rows: DataFrame, t: float) -> DataFrame:
    """``(id, digest, rare)``: of each sketch as many of its hashes as must include a shared one at Jaccard ``t``, in an order
    that all sketches follow: hashes by size, and after them those that are frequent in a sample, the most frequent last.
    Any order is exact; the sample only tells which hashes would bring very many sketches together."""
    kind, hashes = rows.schema["id"].dataType.simpleString(), rows.schema["s"].dataType.simpleString()
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0).select(F.explode("s").alias("h"))
    counts = some.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(MOST_HOT).toArrow()
    hot = counts.column("h").to_numpy()
    place = np.argsort(hot.astype("U") if hot.dtype == object else hot)
    shared = rows.sparkSession.sparkContext.broadcast((hot[place].astype("U") if hot.dtype == object else hot[place], (len(hot) - place)))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = shared.value
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                values = batch.column(1).flatten()
                flat = values.to_numpy(zero_copy_only=False)
                flat = flat.astype("U") if flat.dtype == object else flat
                n = np.asarray(batch.column(1).value_lengths().fill_null(0))
                ends = np.cumsum(n)
                late = np.zeros(len(flat), np.int64)
                if len(hot):
                    found = np.minimum(np.searchsorted(hot, flat), len(hot) - 1)
                    late = np.where(hot[found] == flat, rank[found], 0)
                keep = n - np.ceil(t * n - 1e-9).astype(int) + 1
                picks, digests = [], []
                for i, (a, b) in enumerate(zip(ends - n, ends, strict=True)):
                    picks.append(a + np.argsort(late[a:b], kind="stable")[: keep[i]] if late[a:b].any() else np.arange(a, min(b, a + keep[i])))
                    digests.append(hashlib.md5(flat[a:b].tobytes() if flat.dtype.kind == "i" else ",".join(flat[a:b]).encode()).hexdigest())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in picks])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), values.take(pa.array(np.concatenate([*picks, np.empty(0, int)]).astype(int))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string()), lists], names=["id", "digest", "rare"])

    return rows.mapInArrow(rare, f"id {kind}, digest string, rare {hashes}").where(F.size("rare") > 0)


def similarity_join(sketches: DataFrame, id_col: str, sketch: str, k: int, max_dist: float, s: int) -> DataFrame:
    """Pairs ``(a, b, dist)`` of sorted arrays of distinct hashes within ``max_dist``.

    1. Equal sketches are one class, for which its smallest id stands: copies meet nobody twice.
    2. At a cutoff with Jaccard t, two sketches share ``ceil(t n)`` of the ``n`` hashes of each, so they share one of the
       first ``n - ceil(t n) + 1`` of them, in any order that is the same for all. Frequent hashes come last in it, so a
       hash of very many sketches is used only where a sketch has not enough others.
    3. Only these hashes are written and shuffled. Sketches meet by them, a hot one in blocks of pairs; the sketches of those
       that met are read again, and the exact distance is computed for each pair once.

    ``sketches`` is read three times, the last time for the ids that met: a cheap sketch is best not written before. The
    result lists all pairs, those of copies too. Null ids and empty sketches are in no pair."""
    from math import exp

    from florilege.functions.sequence import sketch_distance

    t = exp(-k * max_dist) / (2 - exp(-k * max_dist))
    rows = sketches.select(F.col(id_col).alias("id"), F.col(sketch).alias("s")).where(F.col("id").isNotNull())
    heads = checkpointed(_rare_first(rows, t))
    members = checkpointed(heads.select("id", "digest").join(heads.groupBy("digest").agg(F.min("id").alias("first")), "digest").select("id", "first"))
    met = heads.join(members.where("id = first").select("id"), "id", "left_semi").select("id", F.explode("rare").alias("h"))
    met = checkpointed(met.join(met.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "h").select("id", "h"))
    pairs = checkpointed(pairs_within(met, ["h"], "id").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    whole = checkpointed(rows.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi"))
    both = pairs.join(whole.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(whole.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    near = both.select("a", "b", sketch_distance(F.col("sa"), F.col("sb"), k, s).alias("dist")).where(F.col("dist") <= max_dist)
    left, right = members.select(F.col("first").alias("a"), F.col("id").alias("ia")), members.select(F.col("first").alias("b"), F.col("id").alias("ib"))
    apart = near.join(left, "a").join(right, "b").select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "dist")
    copies = pairs_within(members, ["first"], "id").select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(0.0).alias("dist"))
    return apart.union(copies)


def all_distances(sketches: DataFrame, id_col: str, sketch: str, k: int, s: int, pack: int = 1024) -> DataFrame:
    """``(a, b, dist)`` of all pairs of sorted sketches that share a hash, each once; all others are at distance 1.

    Its rows may be as many as all pairs, so its time grows with the square of the collection. Sketches are written once, in
    packs of about ``pack``; each two packs meet in one task, which holds the shared hashes of some of their pairs at a time.
    Null ids are in no pair; ids are unique."""
    from florilege.functions.hashing import pack_jaccards
    from florilege.functions.sequence import jaccard_distance

    rows = checkpointed(sketches.select(F.col(id_col).alias("id"), F.col(sketch).alias("s")).where(F.col("id").isNotNull()))
    kind, parts = rows.schema["id"].dataType.simpleString(), -(-rows.count() // pack) or 1
    packs = rows.where(F.size("s") > 0).groupBy(F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("id", "s")).alias("rows"))
    packs = checkpointed(packs).repartition(min(parts, 64), "part")
    b = packs.select(F.col("part").alias("part_b"), F.col("rows").alias("rows_b"))
    both = packs.hint("shuffle_replicate_nl").join(b, F.col("part") <= F.col("part_b")).select("rows", "rows_b", (F.col("part") == F.col("part_b")).alias("same"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, same in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                x, y = x.values, y.values
                for i, j, shared in pack_jaccards(x.field("s"), y.field("s"), s, same.as_py()):
                    yield pa.RecordBatch.from_arrays([x.field("id").take(pa.array(i)), y.field("id").take(pa.array(j)), pa.array(shared)], names=["x", "y", "j"])

    found = both.mapInArrow(meet, f"x {kind}, y {kind}, j double")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), jaccard_distance(F.col("j"), k).alias("dist"))


def canonical_pairs(pairs: DataFrame, a: str = "a", b: str = "b", payload: str = "dist") -> DataFrame:
    """One row an unordered pair, self pairs dropped; of several values the smallest."""
    return pairs.where(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(F.min(payload).alias(payload))


def find_contained(hits: DataFrame, query: str, subject: str, coverage: str, least: float, size: str) -> DataFrame:
    """Queries covered by a larger subject, each with its best one (highest coverage, then largest, then first)."""
    best = hits.where(F.col(coverage) >= least).groupBy(query).agg(F.min(F.struct((-F.col(coverage)).alias("c"), (-F.col(size)).alias("n"), F.col(subject).alias("s"))).alias("m"))
    return best.select(query, F.col("m.s").alias(subject), (-F.col("m.c")).alias(coverage))


def inclusions(contained: DataFrame, query: str, subject: str, sep: str = ",") -> DataFrame:
    """Subjects with the list of what they contain, leaving out those that are themselves contained."""
    roots = contained.alias("x").join(contained.select(F.col(query).alias("__q")), F.col(subject) == F.col("__q"), "left_anti")
    return roots.groupBy(subject).agg(F.array_join(F.array_sort(F.collect_list(F.col(query).cast("string"))), sep).alias("inclusions"), F.count("*").alias("n"))


def containment_join(df: DataFrame, pairs: DataFrame, id_col: str, seq: str, k: int) -> DataFrame:
    """For each pair the share of the query's distinct k-mers that the subject has."""
    from florilege.functions.sequence import kmers

    each = df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(kmers(F.col(seq), k))).alias("m"))
    sizes = each.groupBy("id").agg(F.count("*").alias("n"))
    asked = pairs.join(each.select(F.col("id").alias("query"), "m"), "query")
    shared = asked.join(each.select(F.col("id").alias("subject"), "m"), ["subject", "m"]).groupBy("query", "subject").agg(F.count("*").alias("shared"))
    out = pairs.join(shared, ["query", "subject"], "left").join(sizes.select(F.col("id").alias("query"), "n"), "query")
    return out.select("query", "subject", (F.coalesce("shared", F.lit(0)) / F.col("n")).alias("containment"))


def contained_in(queries: DataFrame, query: str, subjects: DataFrame, subject: str, seq: str, k: int, least: float) -> DataFrame:
    """``(query, subject, containment)``: the share of each query's distinct k-mers that a subject has, from ``least`` on.

    K-mers meet by a join, so only pairs that share one are ever made; they are counted within tasks before the shuffle. A
    query without a k-mer is contained in nothing."""
    from florilege.functions.sequence import kmers

    asked = checkpointed(queries.select(F.col(query).alias("query"), F.explode(F.array_distinct(kmers(F.col(seq), k))).alias("m")))
    sizes = asked.groupBy("query").agg(F.count("*").alias("n"))
    each = subjects.select(F.col(subject).alias("subject"), F.explode(F.array_distinct(kmers(F.col(seq), k))).alias("m"))
    shared = each.join(asked, "m").groupBy("query", "subject").agg(F.count("*").alias("shared"))
    share = F.col("shared") / F.col("n")
    return shared.join(sizes, "query").where(share >= least).select("query", "subject", share.alias("containment"))


def fuzzy_cascade(queries: DataFrame, query: str, rungs: list[tuple[DataFrame, str, object, float]]) -> DataFrame:
    """Best match of each query on the first rung that has one. A rung: vocabulary, its term column, scorer of two string
    columns (0 to 100), and the least score; of equal scores the smallest term.

    A rung scored by ``levenshtein_ratio``, ``ratio``, ``token_set_ratio`` or ``wratio`` misses no match, wherever a term is
    misspelt. Of a scorer of the caller's own nothing is known, so only terms that share a token with the query are scored.
    Null queries and terms match nothing."""
    left, out = queries.select(F.col(query).alias("query")).where("query is not null").distinct(), None
    tokens = lambda c: F.explode(F.array_distinct(F.split(normalize_term(F.col(c)), " ")))
    for k, (vocab, term, scorer, least) in enumerate(rungs):
        terms = vocab.select(F.col(term).alias("term")).where("term is not null").distinct()
        left = checkpointed(left)
        if scorer in SCORERS:
            hits = similar_pairs(left, checkpointed(terms), scorer, least)
        else:
            pairs = left.select("query", tokens("query").alias("t")).join(terms.select("term", tokens("term").alias("t")), "t").select("query", "term").distinct()
            hits = pairs.withColumn("score", scorer(F.col("query"), F.col("term"))).where(F.col("score") >= least)
        best = hits.groupBy("query").agg(F.min(F.struct((-F.col("score")).alias("s"), "term")).alias("m"))
        best = checkpointed(best.select("query", F.col("m.term").alias("term"), (-F.col("m.s")).alias("score"), F.lit(k + 1).cast("long").alias("rung")))
        out = best if out is None else out.unionByName(best)
        left = left.join(best.select("query"), "query", "left_anti")
    return out


def reduce_to_leaves(ids: DataFrame, ancestors: DataFrame, key: str, id_col: str) -> DataFrame:
    """Of several ids of a key those that are no ancestor of another one. ``ancestors``: (id, ancestor)."""
    pairs = ids.select(key, id_col).distinct()
    up = pairs.join(ancestors.where("id <> ancestor"), F.col(id_col) == F.col("id")).select(F.col(key).alias("__key"), F.col("ancestor").alias("__up"))
    return pairs.join(up, (F.col(key) == F.col("__key")) & (F.col(id_col) == F.col("__up")), "left_anti")


def release_diff(new: DataFrame, old: DataFrame, key: str, ignore: list[str] | None = None, reasons: list[tuple[DataFrame, str, str]] | None = None) -> DataFrame:
    """``(key, status, changed, reason)``: rows added, removed (with the first reason whose table has the key) or changed
    (with the sorted list of columns that differ, null-safely)."""
    cols = sorted(c for c in new.columns if c in old.columns and c != key and c not in (ignore or []))
    n, o = new.alias("n"), old.alias("o")
    joined = n.join(o, F.col(f"n.{key}") == F.col(f"o.{key}"), "full")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")), F.lit(c)) for c in cols)))
    status = F.when(F.col(f"o.{key}").isNull(), "Added").when(F.col(f"n.{key}").isNull(), "Removed").when(F.size(changed) > 0, "Changed")
    out = joined.select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), status.alias("status"), F.when(status == "Changed", F.array_join(changed, ",")).otherwise("").alias("changed")).where("status is not null")
    reason: Column = F.lit(None).cast("string")
    for k, (table, col, text) in enumerate(reasons or []):
        seen = table.select(F.col(col).alias(f"__r{k}")).distinct()
        out = out.join(seen, F.col(key) == F.col(f"__r{k}"), "left")
        reason = F.coalesce(reason, F.when(F.col(f"__r{k}").isNotNull(), text))
    return out.select(key, "status", "changed", F.when(F.col("status") == "Removed", F.coalesce(reason, F.lit("not retrieved"))).otherwise("").alias("reason"))


def upsert_features(base: DataFrame, overlay: DataFrame, record: str, symbol: str) -> DataFrame:
    """``overlay`` replaces rows with its record and symbol (in any case) and adds the others."""
    new = overlay.select(F.col(record).alias("__rec"), F.lower(symbol).alias("__sym")).distinct()
    kept = base.join(new, (F.col(record) == F.col("__rec")) & (F.lower(symbol) == F.col("__sym")), "left_anti")
    return kept.unionByName(overlay)


def harmonize_symbol(df: DataFrame, symbol: str, source: str, reference: str, other: str, prefix: str, name: str = "symbol2") -> DataFrame:
    """Lower-case symbols; those of source ``other`` get ``prefix`` if the reference source has them with it."""
    known = df.where((F.col(source) == reference) & F.col(symbol).startswith(prefix)).select(F.expr(f"substring(`{symbol}`, {len(prefix) + 1})").alias("__known")).distinct()
    joined = df.join(known, F.col(symbol) == F.col("__known"), "left")
    add = (F.col(source) == other) & F.col("__known").isNotNull()
    return joined.withColumn(name, F.when(add, F.concat(F.lit(prefix), F.lower(symbol))).otherwise(F.lower(symbol))).drop("__known")


def family_members(df: DataFrame, family: str, item: str, prefixes: dict[str, str], sep: str = ",") -> DataFrame:
    """A row a family, and for each name the sorted list of its members with that prefix."""
    lists = [F.array_join(F.array_sort(F.collect_list(F.when(F.col(item).startswith(p), F.col(item)))), sep).alias(n) for n, p in prefixes.items()]
    return df.groupBy(family).agg(*lists)


def attach_representatives(families: DataFrame, representatives: DataFrame, family: str) -> DataFrame:
    return families.join(representatives, family, "full")


def extend_mapping(queries: DataFrame, prev: DataFrame, query: str, matcher, version: str) -> DataFrame:
    """``prev`` and, for queries that it doesn't have, what ``matcher`` makes of them, stamped with ``version``."""
    new = queries.select(query).where(F.col(query).isNotNull()).distinct().join(prev.select(query), query, "left_anti")
    return prev.unionByName(matcher(new).withColumn("version", F.lit(version)), allowMissingColumns=True)


