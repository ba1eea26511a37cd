"""Sinks: delimited tables, sequence collections, one output a key, nested JSON, published tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, sep: str = "\t", numeric_null: int | None = None) -> None:
    """Arrays are joined by commas; null becomes blank or, in number columns, ``numeric_null``."""
    cols = {}
    for name, kind in df.dtypes:
        c = F.array_join(name, ",") if kind.startswith("array") else F.col(name)
        cols[name] = F.coalesce(c, F.lit(numeric_null)) if numeric_null is not None and kind in ("int", "bigint", "double", "float") else c
    df.withColumns(cols).write.csv(path, sep=sep, header=True, nullValue="", emptyValue="")


def write_fasta(df: DataFrame, path: str, id_col: str = "id", description: str | None = "description", seq: str = "seq") -> None:
    head = F.concat_ws(" ", F.concat(F.lit(">"), id_col), *([F.nullif(F.col(description), F.lit(""))] if description else []))
    df.select(F.concat_ws("\n", head, F.col(seq)).alias("value")).write.text(path)


def write_by_key(df: DataFrame, key: str, path: str, format: str = "parquet") -> None:
    """A folder for each value of ``key``."""
    df.write.partitionBy(key).format(format).save(path)


def to_feature_json(features: DataFrame, plots: DataFrame, key: str) -> DataFrame:
    """A row a record: its features and plots as one JSON object, each sorted."""
    lists = []
    for df, name in ((features, "features"), (plots, "plots")):
        rest = [c for c in df.columns if c != key]
        lists.append(df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name)))
    return lists[0].join(lists[1], key, "full").select(key, F.to_json(F.struct(F.col("features").alias("features"), F.col("plots").alias("plots"))).alias("json"))


def write_annotated(df: DataFrame, path: str) -> None:
    """Flat-file records of ``(id, description, seq, features)`` and, if there, ``topology``, as ``read_annotated`` gives them,
    each ended by ``//``."""
    shape = F.concat_ws(" ", F.lit(""), F.concat(F.length(F.coalesce("seq", F.lit(""))).cast("string"), F.lit(" bp    DNA")), F.col("topology") if "topology" in df.columns else F.lit(None))
    quoted = lambda q: F.transform(F.map_entries(q), lambda e: F.transform(e["value"], lambda v: F.concat(F.lit(" " * 21 + "/"), e["key"], F.lit('="'), v, F.lit('"'))))

    def block(f: Column) -> Column:
        span = F.concat(f["start"].cast("string"), F.lit(".."), f["end"].cast("string"))
        place = F.when(f["strand"] < 0, F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(span)
        return F.array_join(F.concat(F.array(F.concat(F.lit(" " * 5), F.rpad(f["type"], 16, " "), place)), F.flatten(quoted(f["qualifiers"]))), "\n")

    seq = F.regexp_replace(F.coalesce("seq", F.lit("")), "(.{60})", "$1\n")
    lines = F.array(
        F.concat(F.lit("LOCUS       "), F.col("id"), shape), F.concat(F.lit("DEFINITION  "), F.col("description")), F.concat(F.lit("VERSION     "), F.col("id")), F.lit("FEATURES             Location/Qualifiers"),
        F.nullif(F.array_join(F.transform("features", block), "\n"), F.lit("")), F.lit("ORIGIN"), F.nullif(seq, F.lit("")), F.lit("//"),
    )
    df.select(F.array_join(F.array_compact(lines), "\n").alias("value")).write.text(path)


def violations(tables: dict[str, DataFrame], keys: dict[str, list[str]], references: list[tuple[str, str, str, str]]) -> DataFrame:
    """``(rule, bad)``: for each table of ``keys`` how many keys repeat or hold a null, and for each reference ``(table, column,
    other table, its column)`` how many rows refer to nothing. A null refers to nobody and is right."""
    found = []
    for name, cols in keys.items():
        bad = tables[name].groupBy(*cols).agg(F.count("*").alias("n")).where(F.greatest(F.col("n") > 1, *(F.col(c).isNull() for c in cols)))
        found.append(bad.agg(F.count("*").alias("bad")).select(F.lit(f"{name} unique by {', '.join(cols)}").alias("rule"), "bad"))
    for name, col, other, its in references:
        known = tables[other].select(F.col(its).alias("__known")).distinct()
        bad = tables[name].where(F.col(col).isNotNull()).join(known, F.col(col) == F.col("__known"), "left_anti")
        found.append(bad.agg(F.count("*").alias("bad")).select(F.lit(f"{name}.{col} in {other}.{its}").alias("rule"), "bad"))
    out = found[0]
    for some in found[1:]:
        out = out.union(some)
    return out


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri() if "://" in target else hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    files.rename(hadoop.Path(source), hadoop.Path(target), how)


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]] | None = None, references: list[tuple[str, str, str, str]] | None = None, keep: int = 2) -> str:
    """Publish the catalogue's tables as one release, whose name is returned; ``read_published`` reads the last one.

    Tables are written to a folder of their own, checked there for ``violations`` of keys and references, and only then one
    pointer is moved, in one step. Until that readers see the release before, whole, and a table may be made from it; a
    failure or a violation leaves it in place. The last ``keep`` releases stay, so that a reader may finish."""
    release = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/releases/{release}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
        if keys or references:
            written = {name: spark.read.parquet(f"{folder}/{name}") for name in tables}
            if bad := violations(written, keys or {}, references or []).where("bad > 0").collect():  # a row a rule
                raise ValueError("; ".join(f"{r.rule}: {r.bad}" for r in bad))
    except Exception:
        files.delete(hadoop.Path(folder), True)
        raise
    stream = files.create(hadoop.Path(f"{path}/CURRENT-{release}"), True)
    stream.write(bytearray(release.encode()))
    stream.close()
    _move(spark, f"{path}/CURRENT-{release}", f"{path}/CURRENT")
    older = sorted(x.getPath().getName() for x in files.listStatus(hadoop.Path(f"{path}/releases")))
    for name in older[: max(0, len(older) - keep)]:
        files.delete(hadoop.Path(f"{path}/releases/{name}"), True)
    return release
