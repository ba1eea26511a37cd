"""The registered queries over the catalogue operators, with the SQL that states the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.functions import sequence as seq
from florilege.functions import text as tx
from florilege.operators import aggregates as ag
from florilege.operators import columns as co
from florilege.operators import filters as fi
from florilege.operators import joins as jo
from florilege.operators import sets as st
from florilege.operators import windows as wi
from florilege.operators.lineage import shared_folder
from florilege.sources.readers import flatten_json, read_batches
from florilege.sources.writers import write_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The driver tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under its name, with its SQL."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from florilege.plans import composites, exchange, models  # noqa: F401  (they register their queries)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


# projections


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def p1_select_columns(t):
    return co.select_columns(t.orders, ["o_orderkey", "o_orderstatus"])


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def p2_select_matching(t):
    return co.select_matching(t.lineitem, ".*key")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer")
def p3_rename_map(t):
    return co.rename_map(t.customer.select("c_custkey", "c_name", "c_mktsegment"), {"c_custkey": "id", "c_name": "name"})


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS o_orderstatus FROM orders")
def p4_recode(t):
    return co.recode(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "finished", "O": "open"})


@query("SELECT s_suppkey, s_name FROM supplier")
def p5_drop_columns(t):
    return co.drop_columns(t.supplier, ["s_nationkey", "s_acctbal"])


@query("SELECT event_id, coalesce(TRY_CAST(event_type AS BIGINT), -1) AS event_type, coalesce(TRY_CAST(user_id AS BIGINT), -1) AS user_id FROM events")
def p6_cast_matching(t):
    return co.cast_matching(t.events.select("event_id", "event_type", "user_id"), "(event_type|user_id)", "bigint", -1)


@query("SELECT p_partkey, 'catalogue' AS origin, 1 AS release FROM part")
def p7_with_constant(t):
    return co.with_constant(t.part.select("p_partkey"), origin="catalogue", release=1)


@query("SELECT doc_id, CASE WHEN lang NOT IN ('es', '-') THEN lang END AS lang, CASE WHEN source NOT IN ('es', '-') THEN source END AS source FROM documents")
def s2_normalize_nulls(t):
    return co.normalize_nulls(t.documents.select("doc_id", "lang", "source"), ("es", "-"), ["lang", "source"])


# filters


@query("SELECT p_partkey, p_name FROM part WHERE NOT (lower(p_type) LIKE '%steel%' AND lower(p_type) NOT LIKE '%economy%steel%')")
def f1_exclude_matching(t):
    return fi.exclude_matching(t.part, "p_type", "^(?!.*economy.*steel).*steel").select("p_partkey", "p_name")


@query("""WITH t AS (SELECT o.o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS a, min(l_linestatus) AS b
    FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND l_quantity > 10 GROUP BY 1, 2)
    SELECT o_orderkey FROM t WHERE (nullif(a, '') IS NOT NULL OR b IS NOT NULL) AND coalesce(nullif(a, '') = 'F', true) AND coalesce(b = 'F', true)""")
def f2_completeness_filter(t):
    lines = t.lineitem.where("l_quantity > 10").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("b"))
    tagged = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("a")).join(lines, "o_orderkey", "left")
    return fi.completeness_filter(tagged, "a", "F", "b", "F").select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT m FROM (SELECT min(o_orderkey) AS m, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus) WHERE n > 1)""")
def f3_exclude_referenced(t):
    first = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("first"))
    rows = t.orders.join(first, ["o_custkey", "o_orderstatus"]).withColumn("duplicate_of", F.when(F.col("first") != F.col("o_orderkey"), F.col("first")))
    return fi.exclude_referenced(rows, "o_orderkey", "duplicate_of").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity >= 40 AND l_discount < 0.03")
def f4_threshold_hits(t):
    return fi.threshold_hits(t.lineitem, {"l_quantity": (">=", 40), "l_discount": ("<", 0.03)}).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("SELECT doc_id, n_chars, 'length out of range' AS status FROM documents WHERE n_chars < 200 OR n_chars > 10000")
def f5_range_status(t):
    return fi.range_status(t.documents.select("doc_id", "n_chars"), "n_chars", 200, 10000, "length out of range")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL AND l.toxic IS NULL")
def f6_all_null(t):
    return fi.all_null(t.documents.join(t.labels, "doc_id", "left"), ["quality", "toxic"]).select("doc_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def f7_value_in(t):
    return fi.value_in(t.customer, "c_custkey", t.orders.where("o_totalprice > 400000").select("o_custkey")).select("c_custkey")


@query("SELECT event_id, event_type AS k FROM events WHERE user_id % 2 = 0 UNION ALL SELECT event_id, 'x' || user_id FROM events WHERE user_id % 6 = 1")
def f8_drop_numeric_text(t):
    text = F.when(F.col("user_id") % 2 == 0, F.col("event_type")).when(F.col("user_id") % 6 == 1, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    return fi.drop_numeric_text(t.events.select("event_id", text.alias("k")), "k")


@query("""WITH u AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags FROM events GROUP BY 1)
    SELECT user_id, tags, list_contains(string_split(tags, ','), 'click') AS has_click, list_contains(string_split(tags, ','), 'click') AND NOT list_contains(string_split(tags, ','), 'purchase') AS review FROM u""")
def f9_flag_tag(t):
    tags = ag.distinct_list(t.events, "user_id", "event_type").select("user_id", F.col("items").alias("tags"))
    found = fi.flag_tag(tags, "tags", "click", "has_click").withColumn("found", F.when(F.array_contains(F.split("tags", ","), "purchase"), "purchase").otherwise(""))
    return fi.check_flag(found, "has_click", "found", "review").drop("found")


@query("SELECT d.doc_id, l.quality IS NOT NULL AS has_quality, l.toxic IS NOT NULL AS has_toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def f10_presence_flags(t):
    return fi.presence_flags(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), ["quality", "toxic"]).drop("quality", "toxic")


@query("SELECT p_partkey, p_brand FROM part WHERE NOT (p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#2%')")
def f11_exclude_prefix(t):
    return fi.exclude_prefix(t.part, "p_brand", ["Brand#1", "Brand#2"]).select("p_partkey", "p_brand")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
def f12_date_range(t):
    return fi.date_range(t.orders, "o_orderdate", "1995-01-01", "1995-12-31").select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE lower(text) LIKE '%licen%' AND lower(text) NOT LIKE '%apache%' AND lower(text) NOT LIKE '%reserved%'")
def f13_title_query(t):
    return fi.title_query(t.documents, "text", ["licen"], ["apache", "reserved"]).select("doc_id")


# joins


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j1_validated_join(t):
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return jo.validated_join(t.orders, right, ["o_custkey"], validate="m:1").select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT DISTINCT coalesce(d.doc_id, l.doc_id) AS doc_id, lang, quality FROM documents d FULL JOIN (SELECT * FROM labels WHERE toxic = 0 UNION ALL SELECT -doc_id, quality, toxic FROM labels WHERE toxic = 1) l ON d.doc_id = l.doc_id")
def j2_full_join_distinct(t):
    return jo.validated_join(t.documents.select("doc_id", "lang"), t.labels.select(F.when(F.col("toxic") == 1, -F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"), "quality"), ["doc_id"], "full", "1:1", distinct=True)


@query("""SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def j3_star_join(t):
    dims = [(t.customer, "o_custkey", "c_custkey", "_c"), (t.nation, "c_nationkey", "n_nationkey", "_n"), (t.region, "n_regionkey", "r_regionkey", "_r")]
    return jo.star_join(t.orders, dims).select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT DISTINCT o_custkey, l_returnflag FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def j4_join_distinct(t):
    left = t.orders.select(F.col("o_orderkey").alias("k"), "o_custkey")
    return jo.join_distinct(left, t.lineitem.select(F.col("l_orderkey").alias("k"), "l_returnflag"), ["k"]).select("o_custkey", "l_returnflag").distinct()


@query("SELECT c_custkey AS id, 'customer' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT l_orderkey, 'line' FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def j5_prune_to(t):
    kept = t.orders.where("o_orderstatus = 'P'")
    out = jo.prune_to({"customer": t.customer, "line": t.lineitem}, kept, {"customer": ("c_custkey", "o_custkey"), "line": ("l_orderkey", "o_orderkey")})
    return out["customer"].select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind")).union(out["line"].select("l_orderkey", F.lit("line")))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def j6_remove_ids(t):
    return jo.remove_ids(t.documents.select("doc_id"), t.labels.where("toxic = 1").select("doc_id"), "doc_id")


_NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH m AS (SELECT DISTINCT CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) ELSE p_name END AS q FROM part WHERE p_partkey % 5 <> 4),
    e AS (SELECT q, min('t:' || lower(q)) AS v FROM m GROUP BY 1), n AS (SELECT {_NORM.format("q")} AS k, min('t:' || lower(q)) AS v FROM m GROUP BY 1)
    SELECT p_partkey, coalesce(e.v, n.v) AS tag, CASE WHEN e.v IS NOT NULL THEN 'exact' WHEN n.v IS NOT NULL THEN 'normalised' ELSE 'none' END AS matched
    FROM part LEFT JOIN e ON p_name = e.q LEFT JOIN n ON {_NORM.format("p_name")} = n.k""")
def j7_dictionary_join(t):
    mapping = t.part.where("p_partkey % 5 <> 4").select(F.when(F.col("p_partkey") % 5 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("q")).distinct()
    mapping = mapping.withColumn("tag", F.concat(F.lit("t:"), F.lower("q")))
    return jo.dictionary_join(t.part.select("p_partkey", "p_name"), "p_name", mapping, "q", "tag").drop("p_name")


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def j8_apply_corrections(t):
    fixes = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_mktsegment").alias("was"), F.lit("CONSTRUCTION").alias("becomes")).distinct()
    return jo.apply_corrections(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", fixes, "was", "becomes")


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 AND l.doc_id IS NOT NULL THEN l.quality ELSE -1 END AS quality, (d.doc_id % 3 = 0) AND l.doc_id IS NULL AS todo FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j9_carry_forward(t):
    rows = t.documents.select("doc_id", F.lit(-1).alias("quality"), (F.col("doc_id") % 3 == 0).alias("todo"))
    return jo.carry_forward(rows, t.labels, "doc_id", ["quality"], "todo")


@query("""WITH g AS (SELECT s_suppkey, s_acctbal, 'n' || s_nationkey AS v FROM supplier UNION ALL SELECT s_suppkey, s_acctbal, 'b' || CAST(floor(s_acctbal / 50) AS BIGINT) FROM supplier)
    SELECT DISTINCT x.s_suppkey AS query, y.s_suppkey AS subject FROM g x JOIN g y ON x.v = y.v AND (x.s_acctbal < y.s_acctbal OR (x.s_acctbal = y.s_acctbal AND x.s_suppkey < y.s_suppkey))""")
def j10_group_pairs(t):
    rows = t.supplier.withColumn("nation", F.col("s_nationkey")).withColumn("band", F.floor(F.col("s_acctbal") / 50))
    return jo.group_pairs(rows, ["nation", "band"], "s_suppkey", "s_acctbal")


@query("""WITH h AS (SELECT l_suppkey AS part, l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) AS e, l_orderkey * 8 + l_linenumber AS id FROM lineitem),
    d AS (SELECT DISTINCT part, s, e, id FROM h)
    SELECT * FROM d x WHERE NOT EXISTS (SELECT 1 FROM d y WHERE x.part = y.part AND abs(x.s - y.s) <= 10 AND abs(x.e - y.e) <= 10 AND (y.s < x.s OR (y.s = x.s AND y.id < x.id)))""")
def j11_proximity_dedup(t):
    hits = t.lineitem.select(F.col("l_suppkey").alias("part"), F.col("l_partkey").alias("s"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("e"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")).distinct()
    # several rows may share an id; their whole row is their identity here
    hits = hits.withColumn("key", F.struct("id", "part", "s", "e"))
    return jo.proximity_dedup(hits, ["part"], "s", "e", 10, ["s", "id"], "key").drop("key")


@query("SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, min(l_discount) AS dist FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1, 2")
def j13_canonical_pairs(t):
    return jo.canonical_pairs(t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_discount").alias("dist")))


@query("""WITH h AS (SELECT DISTINCT l_orderkey AS q, l_partkey AS s, round(100 - 100 * l_discount, 2) AS cov, p_size AS n FROM lineitem JOIN part ON l_partkey = p_partkey),
    r AS (SELECT q, s, cov, row_number() OVER (PARTITION BY q ORDER BY cov DESC, n DESC, s) AS k FROM h WHERE cov >= 97) SELECT q, s, cov FROM r WHERE k = 1""")
def j14_find_contained(t):
    hits = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("q"), F.col("l_partkey").alias("s"), F.round(100 - 100 * F.col("l_discount"), 2).alias("cov"), F.col("p_size").alias("n")).distinct()
    return jo.find_contained(hits, "q", "s", "cov", 97, "n")


@query("""WITH k AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, length(text) - 18), lambda i: substr(text, i, 20))) AS m FROM benchmark), n AS (SELECT item_id, count(*) AS n FROM k GROUP BY 1),
    d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, length(text) - 18), lambda i: substr(text, i, 20))) AS m FROM documents), c AS (SELECT item_id, doc_id, count(*) AS c FROM k JOIN d ON k.m = d.m GROUP BY 1, 2)
    SELECT item_id AS query, doc_id AS subject, round(c / n, 6) AS containment FROM c JOIN n USING (item_id) WHERE c / n >= 0.2""")
def j15_containment_join(t):
    return jo.contained_in(t.benchmark, "item_id", t.documents, "doc_id", "text", 20, 0.2).withColumn("containment", F.round("containment", 6))


@query("""WITH n AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 <> 0),
    o AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 <> 0)
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'Added' WHEN n.o_orderkey IS NULL THEN 'Removed' ELSE 'Changed' END AS status,
    CASE WHEN o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL THEN 'o_totalprice' ELSE '' END AS changed,
    CASE WHEN n.o_orderkey IS NULL THEN CASE WHEN o.o_orderstatus = 'F' THEN 'removed during filtering' ELSE 'not retrieved' END ELSE '' END AS reason
    FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey WHERE n.o_orderkey IS NULL OR o.o_orderkey IS NULL OR n.o_totalprice IS DISTINCT FROM o.o_totalprice""")
def j18_release_diff(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = base.where("o_orderkey % 10 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return jo.release_diff(new, base.where("o_orderkey % 11 <> 0"), "o_orderkey", reasons=[(base.where("o_orderstatus = 'F'"), "o_orderkey", "removed during filtering")])


@query("""WITH b AS (SELECT user_id, event_type, event_id FROM events WHERE event_id % 2 = 0), v AS (SELECT user_id, upper(event_type) AS event_type, event_id FROM events WHERE event_id % 5 = 0)
    SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.user_id = b.user_id AND lower(v.event_type) = lower(b.event_type)) UNION ALL SELECT * FROM v""")
def j19_upsert_features(t):
    rows = t.events.select("user_id", "event_type", "event_id")
    return jo.upsert_features(rows.where("event_id % 2 = 0"), rows.where("event_id % 5 = 0").withColumn("event_type", F.upper("event_type")), "user_id", "event_type")


@query("""WITH s AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS src, CASE WHEN user_id % 4 = 0 THEN 'bla' || event_type ELSE event_type END AS sym FROM events),
    k AS (SELECT DISTINCT substr(sym, 4) AS v FROM s WHERE src = 'a' AND sym LIKE 'bla%')
    SELECT event_id, src, sym, CASE WHEN src = 'b' AND k.v IS NOT NULL THEN 'bla' || lower(sym) ELSE lower(sym) END AS symbol2 FROM s LEFT JOIN k ON sym = k.v""")
def j20_harmonize_symbol(t):
    rows = t.events.select("event_id", F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("src"), F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("bla"), "event_type")).otherwise(F.col("event_type")).alias("sym"))
    return jo.harmonize_symbol(rows, "sym", "src", "a", "b", "bla")


@query("""WITH f AS (SELECT o_custkey AS family, CASE WHEN o_orderkey % 2 = 0 THEN 'R' ELSE 'B' END || o_orderkey AS item FROM orders),
    l AS (SELECT family, coalesce(string_agg(CASE WHEN item LIKE 'R%' THEN item END, ',' ORDER BY item), '') AS refs, coalesce(string_agg(CASE WHEN item LIKE 'B%' THEN item END, ',' ORDER BY item), '') AS others FROM f GROUP BY 1),
    r AS (SELECT c_custkey AS family, c_name AS rep FROM customer WHERE c_custkey % 3 = 0) SELECT coalesce(l.family, r.family) AS family, refs, others, rep FROM l FULL JOIN r ON l.family = r.family""")
def j21_family_members(t):
    rows = t.orders.select(F.col("o_custkey").alias("family"), F.concat(F.when(F.col("o_orderkey") % 2 == 0, "R").otherwise("B"), F.col("o_orderkey").cast("string")).alias("item"))
    lists = jo.family_members(rows, "family", "item", {"refs": "R", "others": "B"})
    return jo.attach_representatives(lists, t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("family"), F.col("c_name").alias("rep")), "family")


@query("""WITH prev AS (SELECT DISTINCT p_type AS query, lower(p_type) AS tag, 'v1' AS version FROM part WHERE p_size < 5)
    SELECT * FROM prev UNION ALL SELECT DISTINCT p_type, lower(p_type), 'v2' FROM part WHERE p_type NOT IN (SELECT query FROM prev)""")
def j22_extend_mapping(t):
    names = t.part.select(F.col("p_type").alias("query"), "p_size")
    match = lambda df: df.withColumn("tag", F.lower("query"))
    prev = match(names.where("p_size < 5").select("query").distinct()).withColumn("version", F.lit("v1"))
    return jo.extend_mapping(names, prev, "query", match, "v2")


# aggregations


@query("SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders")
def a1_group_count(t):
    return ag.group_count(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "n_orders")


@query("SELECT user_id, count(DISTINCT json_extract_string(props, '$.k')) AS n_items FROM events GROUP BY 1 HAVING count(DISTINCT json_extract_string(props, '$.k')) > 8")
def a2_over_threshold(t):
    return ag.over_threshold(t.events.select("user_id", F.get_json_object("props", "$.k").alias("k")), "user_id", "k", 8)


@query("""WITH l AS (SELECT o_custkey AS c_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS items, count(DISTINCT o_orderpriority) AS n_items FROM orders GROUP BY 1)
    SELECT c.c_custkey, coalesce(items, '') AS items, coalesce(n_items, 0) AS n_items FROM customer c LEFT JOIN l ON c.c_custkey = l.c_custkey""")
def a3_distinct_list(t):
    return ag.distinct_list(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "o_orderpriority", keys=t.customer.select("c_custkey"))


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS items FROM nation GROUP BY 1")
def a4_list_unique(t):
    return ag.list_unique(t.nation, "n_regionkey", "n_name")


@query("SELECT 'p_brand' AS level, count(DISTINCT p_brand) AS n_distinct FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part")
def a5_distinct_per_level(t):
    return ag.distinct_per_level(t.part, ["p_brand", "p_type", "p_size"])


@query("""WITH s AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS s FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN s NOT LIKE '%,%' THEN s WHEN s = 'A,R' THEN 'done' ELSE 'undefined' END AS l_returnflag FROM s""")
def a6_resolve_category(t):
    return ag.resolve_category(t.lineitem, "l_orderkey", "l_returnflag", {("R", "A"): "done"})


@query("""WITH RECURSIVE h AS (SELECT l_suppkey, l_partkey % 10 AS subject, l_partkey % 60 + 1 AS s, l_partkey % 60 + CAST(l_quantity AS BIGINT) AS e, (l_suppkey % 7 + 1) * 100 AS q, CAST(l_quantity AS BIGINT) - l_linenumber % 2 AS l, round(100 - 100 * l_discount, 2) AS i FROM lineitem),
    n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, subject ORDER BY s, e, q, l, i) AS k FROM h),
    c AS (SELECT DISTINCT l_suppkey, subject, 0::BIGINT AS k, 0::BIGINT AS s, 0::BIGINT AS e, 0::BIGINT AS q, 0::BIGINT AS l, 0::DOUBLE AS i FROM h UNION ALL SELECT c.l_suppkey, c.subject, n.k, CASE WHEN n.s = c.e + 1 THEN c.s WHEN c.l < n.l THEN n.s ELSE c.s END, CASE WHEN n.s = c.e + 1 OR c.l < n.l THEN n.e ELSE c.e END, CASE WHEN n.s = c.e + 1 OR c.l < n.l THEN n.q ELSE c.q END,
        CASE WHEN n.s = c.e + 1 THEN n.e WHEN c.l < n.l THEN n.l ELSE c.l END, CASE WHEN n.s = c.e + 1 THEN CASE WHEN c.i = 0 THEN n.i ELSE (c.i + n.i) / 2 END WHEN c.l < n.l THEN n.i ELSE c.i END FROM c JOIN n ON n.l_suppkey = c.l_suppkey AND n.subject = c.subject AND n.k = c.k + 1)
    SELECT l_suppkey, subject, s AS start, e AS "end", l AS length, round(i, 6) AS identity, round(l / q * i, 5) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, subject ORDER BY k DESC) AS last FROM c) WHERE last = 1""")
def a7_chain_hits(t):
    start = F.col("l_partkey") % 60
    hits = t.lineitem.select("l_suppkey", (F.col("l_partkey") % 10).alias("subject"), (start + 1).alias("s"), (start + F.col("l_quantity").cast("long")).alias("e"), ((F.col("l_suppkey") % 7 + 1) * 100).alias("q"), (F.col("l_quantity").cast("long") - F.col("l_linenumber") % 2).alias("l"), F.round(100 - 100 * F.col("l_discount"), 2).alias("i"))
    return ag.chain_hits(hits, ["l_suppkey", "subject"], "s", "e", "q", "l", "i").withColumns({"identity": F.round("identity", 6), "coverage": F.round("coverage", 5)})


@query("""WITH r AS (SELECT o_custkey, o_totalprice, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) SELECT o_custkey, o_totalprice, o_orderkey FROM r WHERE k = 1""")
def a8_argmax_by(t):
    return ag.argmax_by(t.orders, ["o_custkey"], "o_totalprice", ["o_orderkey"])


@query("""WITH q AS (SELECT quantile_cont(log10(l_extendedprice), 0.25) AS q1, quantile_cont(log10(l_extendedprice), 0.75) AS q3 FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(q1 - 0.5 * (q3 - q1), 6) AS low, round(q3 + 0.5 * (q3 - q1), 6) AS high, log10(l_extendedprice) < q1 - 0.5 * (q3 - q1) OR log10(l_extendedprice) > q3 + 0.5 * (q3 - q1) AS outlier FROM lineitem, q""")
def a9_iqr_outliers(t):
    out = ag.iqr_outliers(t.lineitem, "l_extendedprice", 0.5, log=True)
    return out.select("l_orderkey", "l_linenumber", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "outlier")


_SUMMARY = "SELECT '{0}' AS \"column\", min({0})::DOUBLE AS min, quantile_cont({0}::DOUBLE, 0.25) AS q1, quantile_cont({0}::DOUBLE, 0.5) AS median, quantile_cont({0}::DOUBLE, 0.75) AS q3, round(avg({0}), 4) AS mean, max({0})::DOUBLE AS max, count(*) - count({0}) AS n_null FROM part"


@query(" UNION ALL ".join(_SUMMARY.format(c) for c in ("p_size", "p_retailprice")))
def a10_summarize(t):
    return ag.summarize(t.part, ["p_size", "p_retailprice"]).withColumn("mean", F.round("mean", 4))


@query("""SELECT r_name, n_name, c_mktsegment, count(*) AS n, CASE WHEN GROUPING(r_name) = 1 THEN 0 WHEN GROUPING(n_name) = 1 THEN 1 WHEN GROUPING(c_mktsegment) = 1 THEN 2 ELSE 3 END::BIGINT AS depth
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""")
def a11_hierarchy_rollup(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return ag.hierarchy_rollup(rows, ["r_name", "n_name", "c_mktsegment"])


@query("SELECT round(c_acctbal / 100, 1) AS lat, round(c_custkey / 1000.0, 1) AS lng, count(*) AS n FROM customer GROUP BY 1, 2")
def a12_count_by_location(t):
    rows = t.customer.select((F.col("c_acctbal") / 100).alias("y"), (F.col("c_custkey") / 1000.0).alias("x"))
    return ag.count_by_location(rows, "y", "x", 1)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def a13_violations_unique(t):
    return ag.violations_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), w AS (SELECT source, n, 100.0 * n / sum(n) OVER () AS percent, 100.0 * sum(n) OVER (ORDER BY n DESC, source ROWS UNBOUNDED PRECEDING) / sum(n) OVER () AS cum FROM c)
    SELECT source, n, round(percent, 6) AS percent, round(cum, 6) AS cum_percent, CASE WHEN cum <= 70 THEN source ELSE 'Others' END AS label FROM w""")
def a14_representatives(t):
    return ag.representatives(t.documents, "source", 70).withColumns({c: F.round(c, 6) for c in ("percent", "cum_percent")})


@query("SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS abundance FROM orders")
def a15_relative_abundance(t):
    return ag.relative_abundance(t.orders, "o_custkey", "o_totalprice").select("o_orderkey", F.round("abundance", 8).alias("abundance"))


@query("""WITH n AS (SELECT c_mktsegment, c_nationkey, count(*)::DOUBLE AS n FROM customer GROUP BY 1, 2), a AS (SELECT c_mktsegment, sum(n) AS t, sum(n * ln(n)) AS nl, sum(n * n) AS nn, count(*) AS s, count_if(n = 1) AS f1, count_if(n = 2) AS f2 FROM n GROUP BY 1)
    SELECT c_mktsegment, round(s + f1 * (f1 - 1) / (2.0 * (f2 + 1)), 6) AS chao1, round(ln(t) - nl / t, 6) AS shannon, round(1 - nn / (t * t), 6) AS simpson FROM a""")
def a16_alpha_diversity(t):
    out = ag.alpha_diversity(t.customer.withColumn("one", F.lit(1)), "c_mktsegment", "c_nationkey", "one")
    return out.select("c_mktsegment", *(F.round(c, 6).alias(c) for c in ("chao1", "shannon", "simpson")))


@query("""SELECT c_mktsegment, CASE WHEN nm IN ('AFRICA', 'ASIA', 'NATION_3') THEN nm ELSE 'Others' END AS label, sum(one)::BIGINT AS one
    FROM (SELECT c_mktsegment, coalesce(nullif(CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE n_name END, ''), r_name) AS nm, 1 AS one FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY 1, 2""")
def a17_stack_to_rank(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.withColumn("n_name", F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.col("n_name"))).withColumn("one", F.lit(1))
    return ag.stack_to_rank(rows, "c_mktsegment", ["r_name", "n_name"], "n_name", "one", ["AFRICA", "ASIA", "NATION_3"])


@query("SELECT year(o_orderdate)::DOUBLE AS bin, count(*) AS n FROM orders GROUP BY 1")
def a18_histogram(t):
    return ag.histogram(t.orders, F.year("o_orderdate"), 1)


@query("SELECT CAST(floor(log10(o_totalprice) / 0.25) AS BIGINT) AS x_bin, CAST(floor(year(o_orderdate) / 2.0) AS BIGINT) AS y_bin, count(*) AS n FROM orders GROUP BY 1, 2")
def a18_density2d(t):
    return ag.density2d(t.orders, F.log10("o_totalprice"), F.year("o_orderdate"), 0.25, 2.0)


@query("SELECT count(*) AS total, count_if(quality IS NOT NULL)::BIGINT AS with_label, count_if(toxic = 1)::BIGINT AS toxic, count_if(regexp_matches(text, 'Licen[sc]e'))::BIGINT AS licensed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def a19_coverage_report(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    return ag.coverage_report(rows, {"with_label": F.col("quality").isNotNull(), "toxic": F.col("toxic") == 1, "licensed": F.col("text").rlike("Licen[sc]e")})


@query("SELECT lang, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY 1")
def a20_percent_of_total(t):
    return ag.percent_of_total(t.documents, "lang").withColumn("percent", F.round("percent", 6))


@query("""WITH q AS (SELECT p_brand, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS median, quantile_cont(p_retailprice, 0.75) AS q3 FROM part GROUP BY 1)
    SELECT q.p_brand, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, min(p_retailprice) AS whisker_low, max(p_retailprice) AS whisker_high FROM part JOIN q ON part.p_brand = q.p_brand
    WHERE p_retailprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
def a21_box_stats(t):
    return ag.box_stats(t.part, "p_brand", "p_retailprice").withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("""WITH c AS (SELECT l_suppkey, count(DISTINCT l_returnflag) AS a FROM lineitem GROUP BY 1), e AS (SELECT l_suppkey, l_linenumber, count(DISTINCT l_returnflag) AS b FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, min(l_linenumber) AS representative FROM e JOIN c USING (l_suppkey) WHERE a = b GROUP BY 1""")
def a22_common_member(t):
    return ag.common_member(t.lineitem, "l_suppkey", "l_returnflag", "l_linenumber")


@query("""WITH e AS (SELECT user_id, CASE WHEN event_type = 'view' THEN 'click' ELSE event_type END AS t, value FROM events) SELECT user_id, min(CASE WHEN t = 'click' THEN value END) AS click, min(CASE WHEN t = 'purchase' THEN value END) AS purchase FROM e GROUP BY 1""")
def s10_pivot_attributes(t):
    return ag.pivot_attributes(t.events, "user_id", "event_type", "value", ["click", "purchase"], {"view": "click"})


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def s11_flatten_json(t):
    return flatten_json(t.events.select("event_id", "props"), "props", "k bigint").drop("props")


@query("SELECT DISTINCT * FROM (SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 2 <> 0)")
def s3_read_batches(t):
    """All documents' languages in two batch files that overlap, written as delimited text and read back."""
    rows, batches = t.documents.select("doc_id", "lang"), f"{shared_folder(t.spark)}/batches-{uuid.uuid4().hex}"
    write_table(rows.where("doc_id % 2 = 0 or doc_id % 3 = 0"), f"{batches}/0")
    write_table(rows.where("doc_id % 2 <> 0"), f"{batches}/1")
    return read_batches(t.spark, [f"{batches}/0", f"{batches}/1"], "doc_id long, lang string")


@query("SELECT 'o_clerk' AS \"column\", 'string' AS type_a, NULL AS type_b, 'added' AS status UNION ALL SELECT 'o_custkey', NULL, 'bigint', 'removed' UNION ALL SELECT 'o_orderkey', 'bigint', 'bigint', 'same' UNION ALL SELECT 'o_totalprice', 'string', 'double', 'retyped'")
def u4_schema_diff(t):
    old = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return st.schema_diff(old.drop("o_custkey").withColumns({"o_totalprice": F.col("o_totalprice").cast("string"), "o_clerk": F.lit("x")}), old)


# windows


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderdate DESC NULLS LAST, o_orderkey) AS k FROM orders) WHERE k = 1""")
def w1_pick_best(t):
    return wi.pick_best(t.orders, ["o_custkey"], ["o_totalprice", "o_orderdate"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER w AS k, lead(o_orderpriority) OVER w AS nx, lead(o_orderkey) OVER w AS nk FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority DESC NULLS LAST, o_orderkey))
    SELECT o_custkey, o_orderkey, nk IS NOT NULL AND nx IS NOT DISTINCT FROM o_orderpriority AS tied FROM r WHERE k = 1""")
def w2_tie_count(t):
    return wi.tie_count(t.orders, ["o_custkey"], ["o_orderpriority"], "o_orderkey").select("o_custkey", "o_orderkey", "tied")


@query("""WITH c AS (SELECT *, coalesce(length(text), 0) AS n FROM conversations) SELECT conv_id, turn, sum(n) OVER w::BIGINT AS running, round(100.0 * sum(n) OVER w / nullif(sum(n) OVER (PARTITION BY conv_id), 0), 6) AS cum_percent FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING)""")
def w3_cumulative_share(t):
    rows = t.conversations.withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    out = wi.cumulative_share(rows, ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")], "n")
    return out.select("conv_id", "turn", "running", F.round("cum_percent", 6).alias("cum_percent"))


@query("SELECT l_orderkey, l_returnflag, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey) AS k FROM lineitem) WHERE k = 1")
def w4_dedup_keep_first(t):
    return wi.dedup_keep_first(t.lineitem.select("l_orderkey", "l_returnflag", "l_partkey"), ["l_orderkey", "l_returnflag"], ["l_partkey"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def w5_duplicated_all(t):
    return wi.duplicated_all(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""WITH p AS (SELECT p_partkey, p_brand, p_size / 60.0 AS p FROM part), r AS (SELECT *, p * count(*) OVER (PARTITION BY p_brand) / row_number() OVER (PARTITION BY p_brand ORDER BY p, p_partkey) AS raw FROM p)
    SELECT p_partkey, round(least(1.0, min(raw) OVER (PARTITION BY p_brand ORDER BY p DESC, p_partkey DESC ROWS UNBOUNDED PRECEDING)), 8) AS p_adjusted FROM r""")
def w6_bh_adjust(t):
    rows = t.part.select("p_partkey", "p_brand", (F.col("p_size") / 60.0).alias("p"))
    return wi.bh_adjust(rows, "p", ["p_brand"], "p_partkey").select("p_partkey", F.round("p_adjusted", 8).alias("p_adjusted"))


@query("""WITH r AS (SELECT o_orderpriority, o_orderstatus, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS r FROM orders WHERE o_orderstatus IN ('F', 'O'))
    SELECT o_orderpriority, count_if(o_orderstatus = 'F')::BIGINT AS n1, count_if(o_orderstatus = 'O')::BIGINT AS n2, round(sum(CASE WHEN o_orderstatus = 'F' THEN r END) - count_if(o_orderstatus = 'F') * (count_if(o_orderstatus = 'F') + 1) / 2.0, 3) AS u FROM r GROUP BY 1""")
def w7_rank_sum(t):
    return wi.rank_sum(t.orders, "o_orderstatus", "o_totalprice", ["o_orderpriority"], "F", "O").select("o_orderpriority", "n1", "n2", F.round("u", 3).alias("u"))


@query("""WITH r AS (SELECT o_orderpriority, o_orderstatus, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) AS t FROM orders WHERE o_orderstatus IN ('F', 'O')),
    a AS (SELECT o_orderpriority, count_if(o_orderstatus = 'F')::DOUBLE AS n1, count_if(o_orderstatus = 'O')::DOUBLE AS n2, sum(CASE WHEN o_orderstatus = 'F' THEN r END) AS r1, sum(t * t - 1)::DOUBLE AS ties FROM r GROUP BY 1), u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sd FROM a),
    z AS (SELECT o_orderpriority, abs((u - n1 * n2 / 2) / sd) AS z FROM u), k AS (SELECT *, 1 / (1 + 0.2316419 * z) AS t FROM z) SELECT o_orderpriority, round(2 * exp(-z * z / 2) / sqrt(2 * pi()) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))), 6) AS p FROM k""")
def w7_rank_sum_p(t):
    return wi.rank_sum(t.orders, "o_orderstatus", "o_totalprice", ["o_orderpriority"], "F", "O").select("o_orderpriority", F.round("p", 6).alias("p"))


@query("""WITH p AS (SELECT l_returnflag, l_suppkey, max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS a, max(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS b FROM lineitem GROUP BY 1, 2),
    d AS (SELECT l_returnflag, a - b AS d FROM p WHERE a - b <> 0), r AS (SELECT l_returnflag, d, rank() OVER (PARTITION BY l_returnflag ORDER BY abs(d)) + (count(*) OVER (PARTITION BY l_returnflag, abs(d)) - 1) / 2.0 AS r FROM d)
    SELECT l_returnflag, count(*) AS n, round(coalesce(sum(CASE WHEN d > 0 THEN r END), 0), 3) AS w FROM r GROUP BY 1""")
def w7_signed_rank(t):
    return wi.signed_rank(t.lineitem, "l_linestatus", "l_quantity", ["l_returnflag"], "l_suppkey", "F", "O").withColumn("w", F.round("w", 3))


@query("""WITH g AS (SELECT doc_id, coalesce(text, '') AS s, unnest(range(0, greatest(length(text), 1), 200)) AS start FROM documents), w AS (SELECT doc_id, start, substr(s, CAST(start + 1 AS BIGINT), 400) AS s FROM g),
    n AS (SELECT doc_id, start, length(s) AS l, length(s) - length(replace(s, 'e', '')) AS a, length(s) - length(replace(s, 't', '')) AS b FROM w)
    SELECT doc_id, start, round(CASE WHEN l > 0 THEN (a + b) / l END, 6) AS gc, round(CASE WHEN a + b > 0 THEN (a - b) / (a + b) ELSE 0 END, 6) AS skew FROM n""")
def w9_windowed_gc(t):
    out = wi.windowed_gc(t.documents, "doc_id", "text", 400, 200, "e", "t")
    return out.select("doc_id", "start", F.round("gc", 6).alias("gc"), F.round("skew", 6).alias("skew"))


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def o1_multi_sort(t):
    return st.multi_sort(t.supplier, [F.desc("s_acctbal"), F.asc("s_suppkey")]).select("s_suppkey", "s_name")


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def o2_top_n(t):
    return wi.top_n(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


# sets


@query("SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer")
def u1_union_distinct(t):
    return st.union_distinct(t.orders.select(F.col("o_custkey").alias("id")), t.customer.select(F.col("c_custkey").alias("id")))


@query("SELECT c_custkey AS id, c_mktsegment AS segment, -1 AS size FROM customer UNION ALL SELECT p_partkey, 'none', p_size FROM part")
def u2_union_fill(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return st.union_fill(a, t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size")), {"segment": "none", "size": -1})


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'only b' WHEN b.k IS NULL THEN 'only a' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer) b ON a.k = b.k")
def u3_key_sets(t):
    return st.key_sets(t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")), "k")


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS kept, count(*) OVER (PARTITION BY text) AS n_copies FROM documents WHERE text IS NOT NULL")
def u5_exact_dedup(t):
    return st.exact_dedup(t.documents, "doc_id", "text")


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000.0) AS BIGINT) AS batch FROM orders")
def u6_assign_batch(t):
    return st.assign_batch(t.orders.select("o_orderkey"), "o_orderkey", size=1000)


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL")
def u7_distinct_ids(t):
    return st.distinct_ids(t.lineitem, "l_suppkey")


@query("""SELECT s_suppkey AS id, s_acctbal AS balance, 'x' AS tool, 'suppliers' AS source FROM supplier UNION ALL SELECT c_custkey, c_acctbal, 'y', 'customers' FROM customer""")
def u8_harmonize_reports(t):
    return st.harmonize_reports({
        "suppliers": (t.supplier.select("s_suppkey", "s_acctbal"), {"s_suppkey": "id", "s_acctbal": "balance"}, {"tool": "x"}),
        "customers": (t.customer.select("c_custkey", "c_acctbal"), {"c_custkey": "id", "c_acctbal": "balance"}, {"tool": "y"}),
    })


# scalars


@query("SELECT doc_id, split_part(text, ' ', 1) AS first, split_part(text, ' ', 3) AS third FROM documents")
def x1_nth_token(t):
    return t.documents.select("doc_id", tx.nth_token(F.col("text"), " ").alias("first"), tx.nth_token(F.col("text"), " ", 3).alias("third"))


@query("SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages")
def x2_strip_suffix(t):
    return t.pages.select("page_id", tx.strip_suffix(F.col("url"), "[?#].*").alias("url"))


@query("""SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN 'Q' || l.quality ELSE '' END AS label, concat_ws(',', d.lang, CASE WHEN l.quality = 1 THEN 'good' END, CASE WHEN l.toxic = 1 THEN 'toxic' END) AS tags FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def x3_x4_labels(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    tags = tx.join_non_null([F.col("lang"), F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")])
    return rows.select("doc_id", tx.prefix_if_present(F.col("quality"), "Q").alias("label"), tags.alias("tags"))


@query("SELECT c_custkey, 'GCF_' || lpad(c_custkey::VARCHAR, 8, '0') AS acc FROM customer")
def x5_pad_id(t):
    return t.customer.select("c_custkey", tx.pad_id(F.col("c_custkey"), "GCF_", 8).alias("acc"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi, CASE WHEN l_linestatus = 'O' THEN -1 ELSE 1 END AS strand FROM lineitem")
def x6_x7_ranges(t):
    lo, hi = tx.ordered_range(F.col("l_partkey"), F.col("l_suppkey"))
    strand = tx.strand_code(F.when(F.col("l_linestatus") == "O", "-").otherwise("+"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", lo.alias("lo"), hi.alias("hi"), strand.alias("strand"))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE coalesce(CASE WHEN user_id % 2 = 0 THEN event_type END, CASE WHEN user_id % 3 <> 0 THEN 'u' || user_id END, 'e' || event_id) END AS name FROM events""")
def x8_resolve_name(t):
    gene = F.when(F.col("user_id") % 2 == 0, F.col("event_type")).otherwise("")
    product = F.when(F.col("user_id") % 3 == 0, "hypothetical protein").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    name = tx.resolve_name(F.col("event_type"), gene, product, F.concat(F.lit("e"), F.col("event_id").cast("string")), ("hypothetical protein",), ("view",))
    return t.events.select("event_id", name.alias("name"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.z') AS z FROM events")
def x9_pick_keys(t):
    return t.events.select("event_id", *tx.pick_keys(F.col("props"), ["k", "z"]))


_COUNT = "(length(u) - length(regexp_replace(u, '[{0}]', '', 'gi')))"


@query(f"""WITH u AS (SELECT doc_id, n_chars, length(text) AS len, text AS u FROM documents) SELECT doc_id, round(CASE WHEN {_COUNT.format("GCSATWU")} = 0 THEN 0 ELSE {_COUNT.format("GCS")} / {_COUNT.format("GCSATWU")} END, 8) AS gc, len <> n_chars AS mismatch FROM u""")
def x10_x11_gc(t):
    return t.documents.select("doc_id", F.round(seq.gc_fraction(F.col("text")), 8).alias("gc"), seq.length_mismatch(F.col("text"), F.col("n_chars")).alias("mismatch"))


@query("SELECT c_custkey, regexp_matches(c_name, '^\\w+#\\d+$') AS valid FROM customer")
def x12_valid_id(t):
    return t.customer.select("c_custkey", tx.valid_id(F.col("c_name"), r"^\w+#\d+$").alias("valid"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(100 * (l_quantity - l_linenumber) / nullif(p_size, 0), 6) AS coverage FROM lineitem JOIN part ON l_partkey = p_partkey")
def x13_hit_coverage(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round(tx.hit_coverage(F.col("l_quantity"), F.col("l_linenumber"), F.col("p_size")), 6).alias("coverage"))


@query("SELECT doc_id, CASE WHEN n_chars < 300 THEN 'short' WHEN n_chars > 5000 THEN 'long' WHEN lang = 'en' THEN 'plain' ELSE 'undefined' END AS kind FROM documents")
def x14_categorize(t):
    return t.documents.select("doc_id", tx.categorize([(F.col("n_chars") < 300, "short"), (F.col("n_chars") > 5000, "long"), (F.col("lang") == "en", "plain")], "undefined").alias("kind"))


@query("SELECT d.doc_id, coalesce(l.quality::VARCHAR, d.lang) AS v FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def x15_prefer(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", tx.prefer(F.col("quality").cast("string"), F.col("lang")).alias("v"))


@query("SELECT p_partkey, unnest(list_distinct(string_split(p_type, ' '))) AS item FROM part")
def x16_split_list(t):
    return t.part.select("p_partkey", F.explode(tx.split_list(F.col("p_type"), " ")).alias("item"))


@query("SELECT p_partkey, concat_ws(' ', nullif(trim(p_name), ''), nullif(trim(p_brand), ''), CASE WHEN p_size > 10 THEN p_type END) AS terms FROM part")
def x17_row_terms(t):
    return t.part.select("p_partkey", tx.row_terms([F.col("p_name"), F.col("p_brand"), F.when(F.col("p_size") > 10, F.col("p_type"))]).alias("terms"))


@query(f"SELECT p_partkey, {_NORM.format('p_brand')} AS term FROM part")
def x18_normalize_term(t):
    return t.part.select("p_partkey", tx.normalize_term(F.col("p_brand")).alias("term"))


@query("SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, round(log10(o_totalprice), 6) AS lg, round(o_totalprice, 1) AS r FROM orders")
def x19_numbers(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), F.round(F.log10("o_totalprice"), 6).alias("lg"), F.round("o_totalprice", 1).alias("r"))


@query("SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'grade:good' END, 'source:' || d.source, 'lang:' || d.lang) AS lowest FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def x20_lowest_rank(t):
    rows = t.documents.join(t.labels, "doc_id", "left").withColumn("grade", F.when(F.col("quality") == 1, "good").otherwise(""))
    return rows.select("doc_id", tx.lowest_rank(["lang", "source", "grade"], with_rank=True).alias("lowest"))


@query("""WITH p AS (SELECT s_suppkey, s_name, s_acctbal / 200 AS y1, s_suppkey % 180 AS x1, s_nationkey * 3.0 AS y2, s_nationkey * 7.0 AS x2 FROM supplier),
    d AS (SELECT *, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2)))) AS km FROM p)
    SELECT s_suppkey, round(km, 3) AS km, round(100.0 * (1 - levenshtein(s_name, 'Supplier#000000001') / greatest(length(s_name), 18)::DOUBLE), 4) AS sim, km > 20 AND 100.0 * (1 - levenshtein(s_name, 'Supplier#000000001') / greatest(length(s_name), 18)::DOUBLE) < 95 AS review FROM d""")
def x21_x22_places(t):
    text = F.concat_ws(";", (F.col("s_acctbal") / 200).cast("string"), (F.col("s_suppkey") % 180).cast("string"))
    lat, lng = tx.parse_latlng(text)
    rows = t.supplier.select("s_suppkey", "s_name", tx.haversine_km(lat, lng, F.col("s_nationkey") * 3.0, F.col("s_nationkey") * 7.0).alias("km"), tx.levenshtein_ratio(F.col("s_name"), F.lit("Supplier#000000001")).alias("sim"))
    return rows.select("s_suppkey", F.round("km", 3).alias("km"), F.round("sim", 4).alias("sim"), tx.needs_location_review(F.col("km"), F.col("sim"), alike=95).alias("review"))


@query("SELECT p_partkey, CASE WHEN p_size / 1000.0 <= 0.0001 THEN '****' WHEN p_size / 1000.0 <= 0.001 THEN '***' WHEN p_size / 1000.0 <= 0.01 THEN '**' WHEN p_size / 1000.0 <= 0.05 THEN '*' ELSE 'ns' END AS stars FROM part")
def x25_p_stars(t):
    return t.part.select("p_partkey", tx.p_stars(F.col("p_size") / 1000.0).alias("stars"))


@query("SELECT 'doc|' || doc_id AS id, text FROM documents WHERE NOT contains(text, 'Licensed') UNION ALL SELECT 'bench|' || item_id, text FROM benchmark WHERE NOT contains(text, 'Licensed')")
def x27_tag_and_merge(t):
    return st.tag_and_merge({"doc": t.documents.select(F.col("doc_id").alias("id"), "text"), "bench": t.benchmark.select(F.col("item_id").alias("id"), "text")}, "id", "text", "Licensed")
