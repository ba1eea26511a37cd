"""Sampling rates that mix documents to target weights of domains, with Spark SQL functions only."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.durable import Scratch, durable
from florilege.llm.expressions import all_of, let, named
from florilege.llm.fingerprints import words
from florilege.llm.sampling import existing, sample_of_classes

BUCKETS = 1 << 14
#: The classifier is fitted on at most so many labelled documents of each domain, over their whole texts.
SAMPLE_DOCUMENTS = 1500
#: Words' evidence is averaged and counts as that of so many independent words at most: posteriors stay soft.
EVIDENCE_WORDS = 60.0
ITERATIONS, TOLERANCE = 40, 1e-4
#: Pull of the rates to 1, beside which targets weigh 1: among rates that meet the targets the least changed are found.
SHRINK = 1e-3
#: Rates are fitted on the documents added up in cells of posteriors this wide; a cell has the mean of its documents.
CELL = 1 / 200


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


class Domains:
    """A naive Bayes classifier of texts by the hashed words of labelled samples, as column expressions.

    ``labelled``: ``(id, domain)``. Its table holds, for each of ``BUCKETS`` buckets and domain, the log of the words'
    share in the domain's sample over their share in the whole sample: a bounded number, which becomes a constant of the
    plan. Domains without a labelled document are left out of ``names``; with none at all there is no evidence."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text"):
        labelled = labelled.where(F.col("id").isNotNull() & F.col("domain").isin(domains))
        found = {r["domain"]: r["count"] for r in labelled.groupBy("domain").count().collect()}  # a row a domain
        self.text_col = text_col
        self.told_apart = len(found) > 1
        self.names = sorted(found) if self.told_apart else sorted(domains)
        self.prior = [(found.get(d, 0) + 1.0) / (sum(found.get(x, 0) for x in self.names) + len(self.names)) for d in self.names]
        k = range(len(self.names))
        picked = sample_of_classes(existing(labelled, docs.select(named(id_col).alias("id")), "id"), "domain", SAMPLE_DOCUMENTS)
        texts = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text")).join(F.broadcast(picked), "id")  # a bounded sample
        seen = texts.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
        counts = seen.groupBy(_bucket(F.col("word")).alias("bucket")).agg(*(F.sum((F.col("domain") == d).cast("long")).alias(f"c{j}") for j, d in enumerate(self.names)))
        rows = {r["bucket"]: [float(r[f"c{j}"]) for j in k] for r in counts.collect()}  # at most BUCKETS rows
        totals = [sum(c[j] for c in rows.values()) for j in k]
        whole = sum(totals) or 1.0
        self.tables = [["0"] * BUCKETS for _ in k]
        for b, c in rows.items():
            share = (sum(c) + 1.0) / (whole + BUCKETS)
            for j in k:
                self.tables[j][b] = f"{math.log((c[j] + 20.0 * share) / (totals[j] + 20.0) / share):.5g}"

    def membership(self) -> Column:
        """``(n, p)``: the number of words of the text and its posteriors in the order of ``names``. A text without words
        has the labelled shares of the domains (equal ones if nothing is labelled)."""
        tables = [F.split(F.lit(",".join(t)), ",").cast("array<double>") for t in self.tables]  # folded to constants

        def scored(buckets: Column) -> Column:
            n = F.size(buckets)
            scale = F.least(n, F.lit(EVIDENCE_WORDS)) / F.greatest(n, F.lit(1))
            added = lambda table: F.aggregate(buckets, F.lit(0.0), lambda s, b: s + F.get(table, b))
            sums = [added(t) * scale + math.log(p) for t, p in zip(tables, self.prior, strict=True)]
            return F.struct(n.cast("long").alias("n"), let(F.array(*sums), soft).alias("p"))

        def soft(logits: Column) -> Column:
            parts = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
            return let(parts, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y)))

        return let(F.transform(words(named(self.text_col).cast("string")), _bucket), scored)


def fit_rates(members: DataFrame, weights: list[float], keep_whole: int | None = None) -> tuple[Callable[[list[Column]], Column], list[float], list[float]]:
    """Nonnegative rates whose expected tokens of each domain meet their targets, by projected gradient.

    ``members``: ``(n_tokens, p0, p1, ...)``. Targets are ``weights`` (scaled to 1) of a budget: all tokens or, with
    ``keep_whole``, so many that this domain's target is what it has. Minimised is the sum over domains of the squared
    gap to the target over the domain's tokens, and a small pull to rate 1. With steps scaled by each document's
    tokens, a step only needs one number for each domain: one aggregate a round over the cells of the posteriors, of
    which the driver gets a row of that many numbers. The rate is a function of a document's posteriors. Returned with
    it are the expected totals over all documents and the targets; a warning tells if they are apart. A domain of which
    no document has a share can't be met and is left out.
    """
    k = range(len(weights))
    sums = [F.coalesce(F.sum(F.col("n_tokens") * F.col(f"p{j}")), F.lit(0.0)).alias(f"t{j}") for j in k]
    first = members.agg(*sums).first()
    have = [float(x) for x in first]
    share = [w / (sum(weights) or 1.0) for w in weights]
    budget = sum(have) if keep_whole is None else have[keep_whole] / max(share[keep_whole], 1e-9)
    targets = [budget * s for s in share]
    whole = max(sum(have), 1.0)
    gaps_of = lambda expected: [(e - t) / h if h > 1e-6 * whole else 0.0 for e, t, h in zip(expected, targets, have, strict=True)]
    steps: list[list[float]] = []

    def rate(p: list[Column]) -> Column:
        """The steps taken so far, each projected to rates of at least 0."""
        out: Column = F.lit(1.0)
        if steps:
            pulls = F.split(F.lit(",".join(f"{g!r}" for s in steps for g in s)), ",").cast("array<double>")  # a constant
            pull = lambda i: sum((F.get(pulls, i * len(weights) + j) * p[j] for j in k), F.lit(0.0))
            out = F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), lambda r, i: F.greatest(F.lit(0.0), r * (1 - SHRINK) + SHRINK - pull(i)))
        return out

    def total(table: DataFrame) -> list[float]:
        r = rate([F.col(f"p{j}") for j in k])
        return [float(x or 0) for x in table.agg(*(F.sum(F.col("n_tokens") * F.col(f"p{j}") * r) for j in k)).first()]

    with Scratch(members.sparkSession) as tables:
        cell = [F.round(F.col(f"p{j}") / CELL).cast("int").alias(f"c{j}") for j in k[1:]] or [F.lit(0).alias("c1")]
        cells = members.groupBy(*cell).agg(F.sum(F.col("n_tokens").cast("double")).alias("n_tokens"), *sums)
        cells = tables.write(cells.select("n_tokens", *(F.try_divide(F.col(f"t{j}"), F.col("n_tokens")).alias(f"p{j}") for j in k)).where("n_tokens > 0"), "cells")
        expected = have
        for _ in range(ITERATIONS):
            gaps = gaps_of(expected)
            if max(map(abs, gaps), default=0.0) < TOLERANCE:
                break
            steps.append(gaps)
            expected = total(cells)
    expected = total(members)
    gap = max(map(abs, gaps_of(expected)), default=0.0)
    if gap > 0.01:
        warnings.warn(f"the rates miss a target by {gap:.3f} of its domain's tokens: no nonnegative rates meet it, or more rounds are needed", stacklevel=2)
    return rate, expected, targets


def _rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str, text_col: str, keep_whole: str | None, tables: Scratch) -> tuple[Domains, DataFrame, Callable[[list[Column]], Column]]:
    model = Domains(docs, labelled, sorted(targets), id_col, text_col)
    k = range(len(model.names))
    rows = docs.select(named(id_col).alias("id"), model.membership().alias("m"))
    members = tables.write(rows.select("id", F.col("m.n").alias("n_tokens"), *(F.col("m.p")[j].alias(f"p{j}") for j in k)), "members")
    if not model.told_apart:
        return model, members, lambda p: F.lit(1.0)
    whole = model.names.index(keep_whole) if keep_whole in model.names else None
    return model, members, fit_rates(members, [targets[d] for d in model.names], whole)[0]


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", keep_whole: str | None = None) -> DataFrame:
    """``(id, n_tokens, domain, posterior, rate)`` for each row: words, likeliest domain and its posterior, sampling rate.
    ``labelled``: ``(id, domain)`` rows; ``targets``: weight by domain, in which only these domains are told apart.

    A domain without a labelled document is left out; with fewer than two others nothing can be told apart and all
    rates are 1. Null and empty texts have no tokens and rate by the domains' shares; null and repeated ids are rows
    like others; texts count whole, whatever their length; an empty table gives no rows. The result is a written table.
    """
    with Scratch(docs.sparkSession) as tables:
        model, members, rate = _rates(docs, labelled, targets, id_col, text_col, keep_whole, tables)
        p = [F.col(f"p{j}") for j in range(len(model.names))]
        best = F.greatest(*p) if len(p) > 1 else p[0]
        domain = F.lit(model.names[-1])
        for j in reversed(range(len(p) - 1)):
            domain = F.when(p[j] == best, model.names[j]).otherwise(domain)
        return durable(members.select(F.col("id").alias(id_col), "n_tokens", domain.alias("domain"), best.alias("posterior"), rate(p).alias("rate")), "rates")


def quality_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, domain)`` of a label table: ``toxic``, else ``good`` or ``poor`` by its quality. Several labels: the worst."""
    worst = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return worst.select("id", F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "good").when(F.col("quality") <= 0, "poor").alias("domain"))


def _taken(docs: DataFrame, rate: Column, key: list[Column], settled: float) -> DataFrame:
    """Each row as often as its rate says; ``key`` draws the part of a row below 1. The rate is computed once a row: it
    stands in the generator alone, and rows that are taken no time are left out by what it makes."""
    chance = F.pmod(F.xxhash64(*key, F.lit(77)), F.lit(1 << 30)) / float(1 << 30)
    near = lambda r: F.when(r.isNull() | (F.abs(r - 1) <= settled), 1.0).otherwise(r)
    times = let(rate, lambda r: let(near(r), lambda r: F.floor(r).cast("int") + F.when(chance < r - F.floor(r), 1).otherwise(0)))
    copies = let(times, lambda n: F.when(n > 0, F.sequence(F.lit(1), n)))
    rows = docs.select(F.struct(*all_of(docs)).alias("row"), F.explode_outer(copies).alias("copy")).where("copy is not null")
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", keep_whole: str | None = None, settled: float = 0.1) -> DataFrame:
    """``docs`` with each row taken as often as its rate of ``mixing_rates`` says on average: the whole part of the rate, and
    once more if a hash of its id and text falls below the rest. Rates within ``settled`` of 1 are taken as 1.

    A row's rate is computed from its own text, so no rows move. Null, empty and very long texts, and null or repeated
    ids, are drawn like others, each row by itself; an empty table stays empty, and columns may have any name.
    """
    with Scratch(docs.sparkSession) as tables:
        model, _, rate = _rates(docs, labelled, targets, id_col, text_col, keep_whole, tables)
    found = let(model.membership(), lambda m: rate([m["p"][j] for j in range(len(model.names))]))
    return _taken(docs, found, [named(id_col), named(text_col)], settled)


def sample_at_rates(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", settled: float = 0.1) -> DataFrame:
    """``docs`` taken as often as ``rates(id, rate)``, one row an id, say: see ``mix_documents``. Rows with a null id or
    without a rate are taken once."""
    per_id = rates.where(named(id_col).isNotNull()).select(named(id_col).alias("__id"), F.col("rate").alias("__rate"))
    joined = docs.join(per_id, named(id_col) == F.col("__id"), "left")
    whole = joined.select(*all_of(docs), "__rate")
    return _taken(whole, F.col("__rate"), [named(id_col)], settled).drop("__rate")
