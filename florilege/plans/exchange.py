"""Registered queries of sources and sinks: the given tables through each format and back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from florilege.operators.lineage import shared_folder
from florilege.plans.catalogue import query
from florilege.sources import readers as rd
from florilege.sources import writers as wr
from florilege.streaming.ingest import ingest_batches


def _folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


_LETTERS = "upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'))"


@query(f"SELECT 'd' || doc_id AS id, lang || ' ' || source AS description, {_LETTERS} AS seq FROM documents")
def s4_read_fasta(t):
    """All documents' letters as a sequence collection."""
    seq = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    wr.write_fasta(t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.concat_ws(" ", "lang", "source").alias("description"), seq.alias("seq")), path := _folder(t, "fasta"))
    return rd.read_fasta(t.spark, path)


def _records(t):
    """All orders as annotated records: a line item is a feature, its words are qualifiers."""
    words = F.map_from_arrays(F.array(F.lit("gene"), F.lit("note")), F.array(F.array(F.col("l_returnflag")), F.array(F.col("l_shipdate").cast("date").cast("string"), F.col("l_linestatus"))))
    lo, hi = F.least("l_partkey", "l_suppkey"), F.greatest("l_partkey", "l_suppkey")
    item = F.struct(F.lit("CDS").alias("type"), lo.cast("long").alias("start"), hi.cast("long").alias("end"), F.when(F.col("l_partkey") > F.col("l_suppkey"), -1).otherwise(1).alias("strand"), words.alias("qualifiers"))
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(item).alias("features"))
    rows = t.orders.join(items, "o_orderkey", "left")
    return rows.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderpriority").alias("description"), F.translate(F.upper("o_orderpriority"), "0123456789- .", "").alias("seq"), F.coalesce("features", F.array().cast(rd.FEATURES)).alias("features"))


@query("""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT 'o' || o_orderkey AS id, regexp_replace(o_orderpriority, '\\.+$', '') AS description, upper(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) AS seq, coalesce(n, 0) AS n_features FROM orders LEFT JOIN n ON o_orderkey = l_orderkey""")
def s5_read_annotated(t):
    wr.write_annotated(_records(t), path := _folder(t, "flat"))
    return rd.read_annotated(t.spark, path).select("id", "description", "seq", F.size("features").cast("long").alias("n_features"))


@query("""SELECT 'o' || l_orderkey AS id, 'CDS' AS type, least(l_partkey, l_suppkey)::BIGINT AS start, greatest(l_partkey, l_suppkey)::BIGINT AS "end", CASE WHEN l_partkey > l_suppkey THEN -1 ELSE 1 END AS strand, l_returnflag AS gene, strftime(l_shipdate, '%Y-%m-%d') || '|' || l_linestatus AS notes FROM lineitem""")
def s5_feature_rows(t):
    wr.write_annotated(_records(t), path := _folder(t, "flat"))
    rows = rd.feature_rows(rd.read_annotated(t.spark, path))
    return rows.select("id", "type", "start", "end", "strand", F.col("qualifiers")["gene"][0].alias("gene"), F.array_join(F.col("qualifiers")["note"], "|").alias("notes"))


@query("""SELECT 'o' || l_orderkey AS id, l_returnflag AS gene, NULL::VARCHAR AS product, NULL::VARCHAR AS locus_tag, strftime(l_shipdate, '%Y-%m-%d') AS note, least(l_partkey, l_suppkey)::BIGINT AS start, greatest(l_partkey, l_suppkey)::BIGINT AS "end", CASE WHEN l_partkey > l_suppkey THEN -1 ELSE 1 END AS strand FROM lineitem""")
def c8_qualifiers(t):
    """The qualifiers of all line items, read from annotated records."""
    wr.write_annotated(_records(t), path := _folder(t, "flat"))
    return rd.qualifier_table(rd.read_annotated(t.spark, path), ("gene", "product", "locus_tag", "note"))


@query("""WITH o AS (SELECT 'o' || o_orderkey AS id, upper(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) AS s, CASE o_orderstatus WHEN 'F' THEN 'circular' WHEN 'O' THEN 'linear' END AS topology FROM orders),
    n AS (SELECT *, length(regexp_replace(s, '[^GCS]', '', 'g')) AS gc, length(regexp_replace(s, '[^GCSATWU]', '', 'g')) AS n FROM o) SELECT id, round(CASE WHEN n = 0 THEN 0 ELSE gc / n END, 6) AS gc, length(s) AS length, topology FROM n""")
def c8_topology(t):
    """GC content, length and topology of all orders' records."""
    from florilege.plans.composites import record_table

    shape = F.when(F.col("o_orderstatus") == "F", "circular").when(F.col("o_orderstatus") == "O", "linear")
    rows = _records(t).join(t.orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), shape.alias("topology")), "id")
    wr.write_annotated(rows, path := _folder(t, "flat"))
    return record_table(rd.read_annotated(t.spark, path))


@query("SELECT l_orderkey AS query, l_partkey AS subject, l_extendedprice AS score FROM lineitem")
def s6_read_hits(t):
    path = _folder(t, "hits")
    t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice").write.csv(path, sep="\t")
    return rd.read_hits(t.spark, path, [("query", "long"), ("subject", "long"), ("score", "double")])


@query("""SELECT min(o_orderkey) OVER (PARTITION BY o_custkey)::VARCHAR AS group_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, o_orderkey::VARCHAR AS member FROM orders""")
def s7_read_dup_groups(t):
    """Customers' orders as a report of groups."""
    ids = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: k.cast("string"))
    lines = t.orders.groupBy("o_custkey").agg(ids.alias("ids")).select(F.concat(F.size("ids").cast("string"), F.lit("\t"), F.array_join("ids", ", ")).alias("value"))
    lines.write.text(path := _folder(t, "groups"))
    return rd.read_dup_groups(t.spark, path).withColumn("place", F.col("place").cast("long"))


@query("""SELECT 'c' || c_custkey AS id, c_name AS name, c_acctbal < 0 AS obsolete, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, n_name, false, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name, false, NULL FROM region""")
def s8_read_ontology(t):
    """Customers, nations and regions as the stanzas of an ontology."""
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    terms = t.customer.select(key("c", "c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") < 0).alias("obsolete"), key("n", "c_nationkey").alias("parent"))
    terms = terms.union(t.nation.select(key("n", "n_nationkey"), "n_name", F.lit(False), key("r", "n_regionkey"))).union(t.region.select(key("r", "r_regionkey"), "r_name", F.lit(False), F.lit(None).cast("string")))
    lines = F.array(F.lit("[Term]"), F.concat(F.lit("id: "), F.col("id")), F.concat(F.lit("name: "), F.col("name")), F.concat(F.lit("is_a: "), F.col("parent"), F.lit(" ! parent")), F.when(F.col("obsolete"), F.lit("is_obsolete: true")))
    terms.select(F.concat(F.array_join(F.array_compact(lines), "\n"), F.lit("\n")).alias("value")).write.text(path := _folder(t, "ontology"))
    found, edges = rd.read_ontology(t.spark, path)
    return found.join(edges, "id", "left")


@query("SELECT DISTINCT user_id, event_type FROM events")
def s9_ingest_batches(t):
    """All events' users and kinds from three batches that overlap, the last one brought by a second call."""
    rows, folder, work = t.events.select("user_id", "event_type"), _folder(t, "arrivals"), _folder(t, "ingest")
    args = (f"{folder}/*", "user_id long, event_type string", ["user_id", "event_type"], f"{work}/out", f"{work}/checkpoint")
    for k, part in enumerate((rows.where("user_id % 3 <> 0"), rows.where("user_id % 3 <> 1"), rows)):
        part.write.parquet(f"{folder}/{k}")
        if k:
            ingest_batches(t.spark, *args)
    return t.spark.read.parquet(f"{work}/out").drop("batch")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def k3_write_by_key(t):
    wr.write_by_key(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_mktsegment", path := _folder(t, "by-key"))
    return t.spark.read.parquet(path)


_CATALOGUE = ({"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_partkey"]}, [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey")])


@query("""SELECT 'customer unique by c_custkey' AS rule, count(*) AS bad FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1 OR c_custkey IS NULL) UNION ALL SELECT 'orders unique by o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL)
    UNION ALL SELECT 'lineitem unique by l_orderkey, l_partkey', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1 OR l_orderkey IS NULL OR l_partkey IS NULL) UNION ALL SELECT 'orders.o_custkey in customer.c_custkey', count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'lineitem.l_orderkey in orders.o_orderkey', count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'lineitem.l_suppkey in supplier.s_suppkey', count(*) FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""")
def k5_violations(t):
    return wr.violations({n: getattr(t, n) for n in ("customer", "orders", "lineitem", "supplier")}, *_CATALOGUE)


@query("SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def k5_publish(t):
    """Two releases, the second made from the first, read back through the pointer."""
    path = _folder(t, "catalogue")
    wr.publish(t.spark, {"customer": t.customer, "orders": t.orders.select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 0).alias("o_totalprice"))}, path, {"customer": ["c_custkey"]})
    old = {n: rd.read_published(t.spark, path, n) for n in ("customer", "orders")}
    new = old["orders"].drop("o_totalprice").join(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    wr.publish(t.spark, {"customer": old["customer"], "orders": new}, path, {"customer": ["c_custkey"], "orders": ["o_orderkey"]})
    orders, customer = (rd.read_published(t.spark, path, n) for n in ("orders", "customer"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey", "o_totalprice", "c_name")
