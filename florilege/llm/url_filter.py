"""URL verdicts from rules and, where no rule fits, from a tree of path templates; Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from florilege.llm.durable import Scratch, durable

#: Levels that every path is followed to; below, only nodes whose labels disagree are split further, as deep as they go.
DEPTH = 4
#: The segments below a node that is not split.
REST = "**"
#: A segment stays as it is if so many of its parent's URLs have it and they are at least this share; others are variable.
LEAST_URLS, LEAST_SHARE = 5, 0.02
#: Branches are similar if the share of blocked labels in each differs from its siblings' by less than so many deviations.
DEVIATIONS = 1.96
#: A template is rejected if (blocked + weight * prior) / (labelled + weight) reaches the threshold; without labels it isn't.
PRIOR, PRIOR_WEIGHT, REJECT_FROM = 0.3, 2.0, 0.6
MERGED = "~"


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)``: the host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; the
    path is what follows up to ``?``, ``#`` or the end. Both are empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, both null if none does. A rule ``host/path`` fits its host and
    all its subdomains where the path starts with the rule's. ``rules``: verdicts by rule."""
    rule = verdict = None
    for text in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, rules[text]) if verdict is None else verdict.when(fits, rules[text])
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _variable(segment: Column) -> Column:
    """The wildcard of a variable segment, with its ending if it has one."""
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))


def path_templates(urls: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """``urls(host, path, blocked, ...)`` with ``p1`` to ``pN``, the segments of their path template (null below its end).

    Level by level, the segments of each node of each host are counted; those that few of its URLs share become a
    wildcard. Counts are pre-aggregated, and only segments frequent enough to stay, a bounded number a node, are joined
    back from a written table, one of ``tables`` if they are given. From level ``DEPTH`` on a node is split only while its
    URLs have labels of both kinds, so branches that differ at any depth are told apart; what lies below another node is
    ``REST``. The number of levels is that of the longest path down to which labels disagree.
    """
    write = tables.write if tables else durable
    rows = write(urls.withColumn("__parts", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("__open", F.lit(True)), "urls")
    longest, above, d = rows.agg(F.coalesce(F.max(F.size("__parts")), F.lit(0))).first()[0], ["host"], 0
    while d < max(longest, 1):
        d += 1
        rows = rows.withColumn("__s", F.when(F.col("__open"), F.get("__parts", d - 1)))
        counts = rows.where(F.col("__s").isNotNull()).groupBy(*above, "__s").agg(F.count("*").alias("__n"))
        totals = rows.groupBy(*above).agg(F.count("*").alias("__total"))
        often = counts.where((F.col("__n") >= LEAST_URLS) & ~F.col("__s").rlike("^[0-9]+$"))
        same = [F.col(f"often.{c}").eqNullSafe(F.col(f"totals.{c}")) for c in above]
        kept = often.alias("often").join(totals.alias("totals"), same).where(F.col("__n") >= F.col("__total") * LEAST_SHARE)
        kept = write(kept.select(*(F.col(f"often.{c}").alias(f"__{c}") for c in above), F.col("__s").alias("__kept")), "segments")
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in above] + [F.col("__s") == F.col("__kept")]
        rows = rows.join(kept, same, "left")
        rest = ~F.col("__open") & (F.size("__parts") >= d) & (F.lit(d > DEPTH) & (F.col(above[-1]) != REST))
        segment = F.when(F.col("__s").isNotNull(), F.coalesce("__kept", _variable(F.col("__s")))).when(rest, REST)
        rows = rows.withColumn(f"p{d}", segment).drop(*(f"__{c}" for c in above), "__kept", "__s")
        above.append(f"p{d}")
        if d >= DEPTH and d < longest:
            mixed = rows.where("__open").groupBy(*above).agg(F.min("blocked").alias("__least"), F.max("blocked").alias("__most")).where("__least <> __most")
            mixed = write(mixed.select(*(F.col(c).alias(f"__{c}") for c in above), F.lit(True).alias("__mixed")), "mixed")
            rows = rows.join(mixed, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in above], "left")
            rows = rows.withColumn("__open", F.col("__open") & F.col("__mixed").isNotNull() & (F.size("__parts") > d)).drop(*(f"__{c}" for c in above), "__mixed")
        rows = write(rows, "urls")
        if d > DEPTH and rows.where("__open").isEmpty():
            break
    return rows.drop("__parts", "__open")


def _levels(urls: DataFrame) -> list[str]:
    found = {int(c[1:]) for c in urls.columns if c[0] == "p" and c[1:].isdigit()}
    return [f"p{d}" for d in sorted(found)]


def judge_templates(urls: DataFrame) -> DataFrame:
    """The templates of ``urls(host, p1.., blocked)`` with their ``template`` and whether it is ``rejected``.

    ``blocked`` is a label, null where there is none. From the leaves up, a labelled branch whose share of blocked labels
    does not differ significantly from that of its labelled siblings is merged with the others like it. Rows here are
    templates, of which a node has a bounded number.
    """
    levels = _levels(urls)
    leaves = urls.groupBy("host", *levels).agg(F.count("blocked").alias("labelled"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("bad"))
    tree = leaves.select("*", *(F.col(c).alias(f"q{c}") for c in levels))
    for d in range(len(levels), 0, -1):
        upper = ["host", *(f"q{c}" for c in levels[: d - 1])]
        own, all_ = W.partitionBy(*upper, f"q{levels[d - 1]}"), W.partitionBy(*upper)
        n, k = F.sum("labelled").over(own), F.sum("bad").over(own)
        tree = tree.withColumns({"__n": n, "__k": k, "__all_n": F.sum("labelled").over(all_), "__all_k": F.sum("bad").over(all_)})
        rest, pooled = F.col("__all_n") - F.col("__n"), F.col("__all_k") / F.col("__all_n")
        gap = F.abs(F.col("__k") / F.col("__n") - (F.col("__all_k") - F.col("__k")) / rest)
        width = DEVIATIONS * F.sqrt(pooled * (1 - pooled) * (1 / F.col("__n") + 1 / rest))
        similar = F.when((F.col("__n") > 0) & (rest > 0), gap <= width).otherwise(F.lit(False))
        q = f"q{levels[d - 1]}"
        tree = tree.withColumn(q, F.when(F.col(q).isNotNull() & similar, F.lit(MERGED)).otherwise(F.col(q))).drop("__n", "__k", "__all_n", "__all_k")
    merged = W.partitionBy("host", *(f"q{c}" for c in levels))
    labelled, bad = F.sum("labelled").over(merged), F.sum("bad").over(merged)
    rejected = (labelled > 0) & ((bad + PRIOR_WEIGHT * PRIOR) / (labelled + PRIOR_WEIGHT) >= REJECT_FROM)
    template = F.concat(F.lit("/"), F.concat_ws("/", *(f"q{c}" for c in levels)))
    return tree.select("host", *levels, template.alias("template"), rejected.alias("rejected"))


def filter_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, template)`` for every row: the verdict (``block`` or ``allow``) is that of the
    longest rule that fits, else ``block`` if the template tree, labelled by the rules' verdicts, rejects its template.

    Null urls and those without ``://`` have an empty host and path, no rule, and are judged by the template of the empty
    path. Rows that repeat are judged row by row, and long urls whole; an empty table gives no rows; other columns are
    ignored, whatever their names.
    The result is a written table; the others are deleted.
    """
    host, path = split_url(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    with Scratch(pages.sparkSession) as tables:
        urls = tables.write(urls.select("*", rule.alias("rule"), verdict.alias("__verdict")).withColumn("blocked", F.col("__verdict") == "block"), "urls")
        urls = path_templates(urls, tables)
        judged = tables.write(judge_templates(urls), "judged")
        levels = _levels(judged)
        same = [F.col(f"u.{c}").eqNullSafe(F.col(f"j.{c}")) for c in ["host", *levels]]
        out = urls.alias("u").join(judged.alias("j"), same, "left")
        verdict = F.coalesce("u.__verdict", F.when(F.col("j.rejected"), "block").otherwise("allow"))
        return durable(out.select(F.col("u.__id").alias(id_col), "u.host", "u.path", "u.rule", verdict.alias("verdict"), "j.template"), "judged-urls")
