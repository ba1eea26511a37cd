"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.llm.durable import durable, shared_path
from florilege.llm.embedding_dedup import near_embeddings
from florilege.llm.fingerprints import edited_fingerprints
from florilege.llm.expressions import let
from florilege.llm.hard_negatives import mine_hard_negatives
from florilege.llm.language import predict_language, train_language
from florilege.llm.line_dedup import drop_common_lines
from florilege.llm.mixing import mixing_rates, quality_domains
from florilege.llm.near_dedup import near_duplicates
from florilege.llm.packing import pack_documents
from florilege.llm.periodic_runs import collapse_runs
from florilege.llm.pii import pseudonymise
from florilege.llm.token_files import read_token_digests, write_token_files
from florilege.llm.toxicity import score_toxicity, train_toxicity
from florilege.llm.url_filter import filter_urls


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Target weights of the labels' domains.
MIXTURE = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
#: The key of the registered queries; a deployment passes its own secret.
PII_KEY = "florilege-demo-key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(id_col: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at Jaccard 0.85 or more of their five-word shingles, with their components."""
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from the labelled documents outside the held-out fifth."""
    docs = _table(spark, sf_dir, "documents")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"), _fold("id", 5) != 0)
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited copies."""
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of one label linked at cosine 0.93 or more."""
    return near_embeddings(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for all page URLs."""
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from the documents outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents")
    model = train_language(docs, _fold("id", 4) != 2)
    held_out = F.coalesce(_fold("doc_id", 4) == 2, F.lit(False))
    return predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_domain_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling rates of all documents for the target weights of the label domains."""
    return mixing_rates(_table(spark, sf_dir, "documents"), quality_domains(_table(spark, sf_dir, "labels")), MIXTURE)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' token ids written to binary files with Elias-Fano boundaries, and read back."""
    folder = shared_path(spark, "token-files")
    manifest = durable(write_token_files(_table(spark, sf_dir, "documents"), folder), "manifest")
    return read_token_digests(spark, folder, manifest)


def op9_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into sequences of power-of-two lengths."""
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with private data replaced by keyed pseudonyms, and the kinds that were replaced."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY, kinds_col="kinds").select("doc_id", "text", F.size("kinds").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    out = drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which repeat a stretch of theirs to their end, and the texts
    with each run cut to one period."""
    found = collapse_runs(_table(spark, sf_dir, "documents").select("doc_id", _repeating("doc_id", "text").alias("text")))
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.try_element_at("runs", F.lit(1)), lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))
    found = found.select("doc_id", F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"), best.alias("best"), "runs", "text")
    lines = F.concat(F.lit(""), *[F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")])
    return found.select(
        "doc_id", "n_runs", *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), _sha256("text").alias("collapsed_sha256"),
    )


def _sha256(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _repeating(id_col: str, text_col: str) -> Column:
    """The text; where crc32 of the id is divisible by 10, its words with those from a place on repeating a first stretch."""
    h = F.crc32(F.col(id_col).cast("string"))

    def planted(w: Column) -> Column:
        n, g = F.size(w), F.expr(f"crc32(cast({id_col} as string)) div 10")

        def of(s: Column) -> Column:
            a, p = s["a"], s["p"]
            return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

        a = F.pmod(g, n)
        return F.when(n > 0, let(F.struct(a.alias("a"), F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)).cast("long").alias("q")), lambda s: of(F.struct(s["a"].alias("a"), (s["q"] + 1).alias("p")))))

    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(let(words, planted), F.col(text_col))).otherwise(F.col(text_col))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100, by integer inner products."""
    rows = _table(spark, sf_dir, "embeddings")
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.when(~wrong, F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)))
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), whole.alias("embedding"))
    return mine_hard_negatives(rows, F.pmod("vec_id", F.lit(100)) == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_minhash_near_dedup, op2_toxicity, op3_fingerprints, op4_lattice_near_dedup, op5_url_filter, op6_language_id, op7_domain_mixing, op8_token_files, op9_binary_packing, op10_pii_pseudonyms, op11_line_dedup, op12_periodic_runs, op13_hard_negatives]
    return {f.__name__: f for f in found}


#: Components of ``links(a, b)`` among ``nodes(id)``: the smallest id that each one reaches.
_COMPONENTS = """sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach(id, low) AS (SELECT id, id FROM nodes UNION SELECT b, low FROM reach JOIN sides ON reach.id = sides.a), top AS (SELECT id, min(low) AS component_id FROM reach GROUP BY 1)"""

_OP1 = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS h FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)), nodes AS (SELECT doc_id AS id FROM documents), {_COMPONENTS}
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN top ON d.doc_id = top.id"""

_OP4 = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= 0.93), nodes AS (SELECT vec_id AS id FROM embeddings), {_COMPONENTS}
    SELECT vec_id, (SELECT count(*) FROM sides WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN top ON vec_id = id"""


_OP11 = """WITH l AS MATERIALIZED (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
    k AS MATERIALIZED (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
    common AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN common c ON k.k = c.k GROUP BY doc_id"""

_OP13 = """WITH v AS MATERIALIZED (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score FROM v a, v b WHERE a.id % 100 = 0 AND a.id <> b.id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id, positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 5"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that it can express: op1 by all shared shingles, op4 and op13 by all pairs, op11 by grouped
    lines. The others rest on models, keyed permutations, fingerprints or a tokenizer, and are held against brute force in the tests."""
    return {"op1_minhash_near_dedup": _OP1, "op4_lattice_near_dedup": _OP4, "op11_line_dedup": _OP11, "op13_hard_negatives": _OP13}
