"""Sources: delimited tables, sequence collections, annotated records, hit tables, reports, ontologies, JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.operators.columns import NULL_TOKENS, normalize_nulls

FEATURES = "array<struct<type:string,start:long,end:long,strand:int,qualifiers:map<string,array<string>>>>"


def read_table(spark: SparkSession, path: str | list[str], schema: str, sep: str = "\t", null_tokens: tuple[str, ...] = NULL_TOKENS, header: bool = True) -> DataFrame:
    """Columns are read as strings, null tokens dropped, then cast; what can't be cast is null."""
    kinds = spark.createDataFrame([], schema).schema
    names = [f.name for f in kinds.fields]
    text = spark.read.schema(", ".join(f"`{n}` string" for n in names)).csv(path, sep=sep, header=header, enforceSchema=True)
    return normalize_nulls(text, null_tokens).select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in kinds.fields))


def read_batches(spark: SparkSession, paths: list[str], schema: str, **options) -> DataFrame:
    """Batch files appended, rows that repeat in full dropped."""
    return read_table(spark, paths, schema, **options).dropDuplicates()


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(id, description, seq)``: the id is the header's first word; lines of a sequence are joined."""
    text = spark.read.option("lineSep", "\n>").text(path)
    record = F.regexp_replace("value", "^>", "")
    head = F.split_part(record, F.lit("\n"), F.lit(1))
    body = F.regexp_replace(F.substring(record, F.length(head) + 1, F.length(record)), r"\s", "")
    return text.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.trim(F.regexp_extract(head, r"^\S+\s*(.*?)\r?$", 1)).alias("description"), body.alias("seq")).where("id <> ''")


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, where ``value`` is evaluated once however often it is named."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _features(table: Column) -> Column:
    """The feature table's lines as structs; qualifiers that repeat keep all their values."""

    def qualifier(q: Column) -> Column:
        at = F.locate("=", q)
        name = F.trim(F.when(at > 0, F.substring(q, F.lit(1), at - 1)).otherwise(q))
        value = F.when(at > 0, F.substring(q, at + 1, F.length(q))).otherwise("")
        joined = _let(F.regexp_replace(value, r"[^\S\n]*+\n\s*+", "\n"), lambda v: F.when(name == "translation", F.replace(v, F.lit("\n"), F.lit(""))).otherwise(F.replace(v, F.lit("\n"), F.lit(" "))))
        return F.struct(name.alias("name"), F.btrim(F.when(value.contains("\n"), joined).otherwise(value), F.lit('"')).alias("value"))

    def several(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
        values = lambda names: F.transform(names, lambda n: F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]))
        return _let(names, lambda names: F.when(F.size(names) == F.size(pairs), F.map_from_arrays(names, F.transform(pairs, lambda p: F.array(p["value"])))).otherwise(F.map_from_arrays(names, values(names))))

    def placed(kind: Column, place: Column, pairs: Column) -> Column:
        numbers = F.transform(F.regexp_extract_all(place, F.lit(r"\d+"), F.lit(0)), lambda n: n.cast("long"))
        ends = _let(numbers, lambda n: F.struct(F.coalesce(F.array_min(n), F.lit(0)).cast("long").alias("lo"), F.coalesce(F.array_max(n), F.lit(0)).cast("long").alias("hi")))
        row = lambda e: F.struct(kind.alias("type"), e["lo"].alias("start"), e["hi"].alias("end"), F.when(place.contains("complement"), -1).otherwise(1).alias("strand"), _let(pairs, several).alias("qualifiers"))
        return _let(ends, row)

    def feature(parts: Column) -> Column:
        pairs = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), qualifier)
        head = lambda h: _let(F.split_part(h, F.lit(" "), F.lit(1)), lambda kind: _let(F.regexp_replace(F.substring(h, F.length(kind) + 1, F.length(h)), r"\s", ""), lambda place: placed(kind, place, pairs)))
        return _let(parts[0], head)

    blocks = F.split(F.regexp_replace(table, r"\n++$", ""), r"\n(?= {5}\S)")
    return F.when(F.trim(table) == "", F.array().cast(FEATURES)).otherwise(F.transform(blocks, lambda block: _let(F.split(F.trim(block), r"\n\s+/"), feature)))


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """Flat-file records ended by ``//``: ``(id, description, seq, features, topology)``, features with multimaps of qualifiers.

    Spark splits files at records by ranges of bytes, so one large file is read by many tasks. Columns are expressions:
    what is not asked for is not parsed, and a filter on the id is applied before the rest. Text without a LOCUS is left out."""
    text = spark.read.option("lineSep", "\n//\n").text(path)
    locus, version = (F.regexp_extract("value", rf"(?m)^{word}\s++(\S++)", 1) for word in ("LOCUS", "VERSION"))
    title = F.regexp_extract("value", r"(?m)^DEFINITION\s++(.*+(?:\n {12}.*+)*+)", 1)
    table = F.regexp_extract("value", r"(?m)^FEATURES.*+\n((?: .*+\n?+)*+)", 1)
    origin = F.regexp_instr("value", F.lit(r"(?m)^ORIGIN"))
    letters = F.regexp_replace(F.regexp_replace(F.substring("value", origin, F.length("value")), r"^[^\n]*+", ""), "[^A-Za-z]", "")
    return text.where(locus != "").select(
        F.coalesce(F.nullif(version, F.lit("")), locus).alias("id"), F.regexp_replace(F.regexp_replace(F.nullif(title, F.lit("")), r"[^\S\n]*+\n\s*+", " "), r"\.+$", "").alias("description"),
        F.when(origin > 0, F.upper(letters)).otherwise("").alias("seq"), _features(table).alias("features"),
        F.nullif(F.lower(F.regexp_extract("value", r"(?mi)^LOCUS\s.*?\b(circular|linear)\b", 1)), F.lit("")).alias("topology"),
    )


def feature_rows(records: DataFrame) -> DataFrame:
    """A row per feature. ``explode`` would have Spark ask first whether there are any, and parse them for it once more."""
    return records.select("id", F.explode_outer("features").alias("f")).where("f is not null").select("id", "f.*")


#: Qualifiers of a feature that get a column of their own.
QUALIFIERS = ("gene", "product", "locus_tag", "protein_id", "codon_start", "transl_table", "GO_process")


def qualifier_table(records: DataFrame, names: tuple[str, ...] = QUALIFIERS) -> DataFrame:
    """A row per feature: the first value of each of ``names``, null where it has none, and start, end and strand."""
    rows = feature_rows(records)
    return rows.select("id", *(F.get(F.try_element_at("qualifiers", F.lit(n)), 0).alias(n) for n in names), "start", "end", "strand")


def read_hits(spark: SparkSession, path: str, header: list[tuple[str, str]]) -> DataFrame:
    """Alignment rows without a header line; ``header``: (name, type)."""
    return spark.read.schema(", ".join(f"`{n}` {t}" for n, t in header)).csv(path, sep="\t")


def read_dup_groups(spark: SparkSession, path: str) -> DataFrame:
    """``n<tab>id, id, ...`` as ``(group_id, place, member)``; a group is named by its first member."""
    ids = F.split(F.split_part("value", F.lit("\t"), F.lit(2)), r",\s*")
    return spark.read.text(path).where("value <> ''").select(ids[0].alias("group_id"), F.posexplode(ids).alias("place", "member"))


def read_ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Stanzas as ``terms(id, name, obsolete)`` and ``edges(id, parent)``."""
    stanza = spark.read.option("lineSep", "\n\n").text(path).where(F.col("value").contains("[Term]"))
    lines = F.split("value", "\n")
    values = lambda tag: F.transform(F.filter(lines, lambda x: x.startswith(f"{tag}: ")), lambda x: F.regexp_replace(F.substring(x, len(tag) + 3, 1 << 30), r"\s*!.*$", ""))
    rows = stanza.select(F.get(values("id"), 0).alias("id"), F.get(values("name"), 0).alias("name"), F.coalesce(F.get(values("is_obsolete"), 0) == "true", F.lit(False)).alias("obsolete"), values("is_a").alias("parents"))
    return rows.select("id", "name", "obsolete"), rows.select("id", F.explode("parents").alias("parent"))


def flatten_json(df: DataFrame, col: str, schema: str) -> DataFrame:
    """``df`` with the fields of a JSON column; null where the text is no such object."""
    return df.withColumn("__json", F.from_json(col, schema)).select(*df.columns, "__json.*")


def read_published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the release that ``publish`` made current last."""
    pointer = spark.read.text(f"{path}/CURRENT").first()  # one line
    return spark.read.parquet(f"{path}/releases/{pointer.value}/{name}")
