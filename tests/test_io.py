"""Sources, sinks and incremental ingest."""

import datetime

import pytest
from pyspark.sql import functions as F

from florilege.sources import readers as rd
from florilege.sources import writers as wr
from florilege.streaming.ingest import ingest_batches

RECORD = """LOCUS       AB01 24 bp DNA
DEFINITION  A small
            record.
VERSION     AB01.1
FEATURES             Location/Qualifiers
     source          1..24
                     /organism="E. coli"
     CDS             complement(3..20)
                     /gene="tetA"
                     /db_xref="X:1"
                     /db_xref="X:2"
ORIGIN
        1 acgtacgtac gtacgtacgt acgt
//
"""


def test_tables_and_null_tokens(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tname\n1\tx\n2\tNA\nbad\ty\n")
    (tmp_path / "b.tsv").write_text("id\tname\n1\tx\n")
    got = rd.read_batches(spark, [f"{tmp_path}/a.tsv", f"{tmp_path}/b.tsv"], "id long, name string")
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "x"), (2, None), (None, "y")]


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "in.fa").write_text(">a.1 first one\nACGT\nAC\n>b.1\nGG\n")
    df = rd.read_fasta(spark, f"{tmp_path}/in.fa")
    want = [("a.1", "first one", "ACGTAC"), ("b.1", "", "GG")]
    assert sorted(map(tuple, df.collect())) == want
    wr.write_fasta(df.coalesce(1), f"{tmp_path}/out")
    assert sorted(map(tuple, rd.read_fasta(spark, f"{tmp_path}/out/part-*").collect())) == want


def test_annotated_records(spark, tmp_path):
    (tmp_path / "r.gb").write_text(RECORD + RECORD.replace("AB01", "AB02"))
    got = rd.read_annotated(spark, f"{tmp_path}/r.gb").orderBy("id").collect()
    assert [r.id for r in got] == ["AB01.1", "AB02.1"] and got[0].seq == "ACGTACGTACGTACGTACGTACGT" and got[0].description == "A small record"
    flat = rd.feature_rows(rd.read_annotated(spark, f"{tmp_path}/r.gb")).where("id = 'AB01.1' and type = 'CDS'").first()
    assert (flat.start, flat.end, flat.strand, flat.qualifiers["db_xref"]) == (3, 20, -1, ["X:1", "X:2"])


def test_reports_and_ontology(spark, tmp_path):
    (tmp_path / "dups").write_text("2\ta, b\n3\tc, d, e\n")
    assert rd.read_dup_groups(spark, f"{tmp_path}/dups").where("group_id = 'c'").count() == 3
    (tmp_path / "hits").write_text("q\ts\t99.5\n")
    assert rd.read_hits(spark, f"{tmp_path}/hits", [("qseqid", "string"), ("sseqid", "string"), ("pident", "double")]).first().pident == 99.5
    (tmp_path / "o.obo").write_text("format-version: 1.2\n\n[Term]\nid: D:1\nname: disease\n\n[Term]\nid: D:2\nname: flu\nis_a: D:1 ! disease\n\n[Typedef]\nid: part_of\n")
    terms, edges = rd.read_ontology(spark, f"{tmp_path}/o.obo")
    assert sorted(r.id for r in terms.collect()) == ["D:1", "D:2"] and [tuple(r) for r in edges.collect()] == [("D:2", "D:1")]
    js = rd.flatten_json(spark.createDataFrame([('{"a": 1}',), ("x",)], "j string"), "j", "a int")
    assert sorted((r.a for r in js.collect()), key=repr) == [1, None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k1", [1, 2], None), ("k2", [], 3)], "k string, l array<int>, n int")
    wr.write_table(df.coalesce(1), f"{tmp_path}/t", numeric_null=-1)
    text = next(p for p in (tmp_path / "t").glob("part-*")).read_text()
    assert "k1\t1,2\t-1" in text
    wr.write_by_key(df, "k", f"{tmp_path}/by")
    assert (tmp_path / "by" / "k=k1").exists()
    js = wr.to_feature_json(df.select("k", "n"), df.select("k", F.lit(1).alias("p")), "k").where("k = 'k2'").first().json
    assert js == '{"features":[{"n":3}],"plots":[{"p":1}]}'
    wr.publish(spark, {"x": df}, f"{tmp_path}/cat")
    assert rd.read_published(spark, f"{tmp_path}/cat", "x").count() == 2


def test_a_failed_release_leaves_the_one_before(spark, tmp_path):
    path, good = f"{tmp_path}/cat", spark.createDataFrame([(1, 1), (2, None)], "k int, up int")
    first = wr.publish(spark, {"x": good, "y": good.select("k")}, path, {"x": ["k"]}, [("x", "up", "y", "k")])
    broken = good.withColumn("k", F.when(F.col("k") > 0, F.raise_error(F.lit("broken"))).otherwise(F.col("k")))
    repeated, orphan = good.union(good), spark.createDataFrame([(1, 7)], "k int, up int")
    for bad, says in ((broken, "broken"), (repeated, "x unique by k: 2"), (orphan, "x.up in y.k: 1"), (spark.createDataFrame([(None, 1)], "k int, up int"), "x unique by k: 1")):
        with pytest.raises(Exception, match=says):
            wr.publish(spark, {"y": good.select("k"), "x": bad}, path, {"x": ["k"]}, [("x", "up", "y", "k")])
        assert sorted(map(tuple, rd.read_published(spark, path, "x").collect()), key=str) == [(1, 1), (2, None)]
        assert [p.name for p in (tmp_path / "cat" / "releases").iterdir()] == [first]
    for k in range(3):  # from the release that is replaced
        last = wr.publish(spark, {"x": rd.read_published(spark, path, "x").withColumn("k", F.col("k") + 1)}, path)
    assert sorted(r.k for r in rd.read_published(spark, path, "x").collect()) == [4, 5]
    assert len(list((tmp_path / "cat" / "releases").iterdir())) == 2 and (tmp_path / "cat" / "CURRENT").read_text() == last


def test_one_file_of_many_records_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "many.gb").write_text("".join(RECORD.replace("AB01", f"R{k}") for k in range(300)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = rd.read_annotated(spark, f"{tmp_path}/many.gb")
        assert df.rdd.getNumPartitions() > 3
        assert sorted(r.id for r in df.collect()) == sorted(f"R{k}.1" for k in range(300))
        plan = df.where("id = 'R7.1'").select("description")._jdf.queryExecution().optimizedPlan().toString()
        assert "ORIGIN" not in plan and "complement" not in plan and plan.index("Filter") > plan.index("Project")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_annotated_records_with_odd_parts(spark, tmp_path):
    many = "".join(f"            line {k}\n" for k in range(3000))
    long_ = f"LOCUS       L1 9 bp\nDEFINITION  start\n{many}VERSION     L1.1\nFEATURES             Location/Qualifiers\n" + "".join(f"     gene            {k}..{k + 1}\n                     /locus_tag=\"t{k}\"\n                     /pseudo\n" for k in range(2000)) + "ORIGIN\n        1 acgt\n//\n"
    cds = 'LOCUS       T1\nFEATURES             Location/Qualifiers\n     CDS             join(5..9,\n                     20..30)\n                     /translation="MK\n                     LV"\n                     /note="two\n                     lines"\n//\n'
    (tmp_path / "odd.gb").write_text(long_ + "no record\n//\n" + cds)
    got = {r.id: r for r in rd.read_annotated(spark, f"{tmp_path}/odd.gb").collect()}
    assert got.keys() == {"L1.1", "T1"}
    assert len(got["L1.1"].features) == 2000 and got["L1.1"].description.endswith("line 2999") and got["L1.1"].features[5].qualifiers == {"locus_tag": ["t5"], "pseudo": [""]}
    f = got["T1"].features[0]
    assert (f.type, f.start, f.end, f.strand, f.qualifiers) == ("CDS", 5, 30, 1, {"translation": ["MKLV"], "note": ["two lines"]}) and got["T1"].seq == "" and got["T1"].description is None


def test_features_are_parsed_once(spark, tmp_path):
    odd = RECORD.replace('/gene="tetA"', '/gene="a=b"\n                     /pseudo\n                     /note="x\n                     y"\n                     /note="z"')
    (tmp_path / "r.gb").write_text(odd + RECORD.replace("AB01", "AB02").replace("     source          1..24\n                     /organism=\"E. coli\"\n", "") + "LOCUS       AB03 4 bp\nORIGIN\n        1 acgt\n//\n")
    records = rd.read_annotated(spark, f"{tmp_path}/r.gb")
    for df in (rd.feature_rows(records).select("id", "type", "start", F.col("qualifiers")["note"]), rd.qualifier_table(records, ("gene", "note", "pseudo"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("complement") == 1  # one expression parses a place
    got = {(r.id, r.gene): (r.note, r.pseudo, r.start, r.end, r.strand) for r in rd.qualifier_table(records, ("gene", "note", "pseudo")).collect()}
    assert got == {("AB01.1", None): (None, None, 1, 24, 1), ("AB01.1", "a=b"): ("x y", "", 3, 20, -1), ("AB02.1", "tetA"): (None, None, 3, 20, -1)}
    assert rd.feature_rows(records).where("id = 'AB01.1' and type = 'CDS'").first().qualifiers == {"gene": ["a=b"], "pseudo": [""], "note": ["x y", "z"], "db_xref": ["X:1", "X:2"]}


def test_ingest_skips_known_keys(spark, tmp_path):
    args = (f"{tmp_path}/in", "k int, v string", ["k"], f"{tmp_path}/out", f"{tmp_path}/cp")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(f"{tmp_path}/in/b0")
    spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/b0")
    args = (f"{tmp_path}/in/b0", *args[1:])
    assert ingest_batches(spark, *args) == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string").write.mode("append").parquet(f"{tmp_path}/in/b0")
    assert ingest_batches(spark, *args) == 3


def test_ingest_of_repeated_and_broken_batches(spark, tmp_path):
    import shutil

    put = lambda rows, k: spark.createDataFrame(rows, "k int, v string, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    day = lambda d: datetime.datetime(2024, 1, d)
    args = (spark, f"{tmp_path}/in/*", "k int, v string, at timestamp", ["k"], f"{tmp_path}/out", f"{tmp_path}/cp")
    out = lambda: sorted(((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str)
    put([(1, "a", day(1)), (1, "b", day(1)), (None, "n", day(1)), (None, "m", day(1))], 0)
    assert ingest_batches(*args) == 2 and out() == [(1, "a"), (None, "m")]
    assert ingest_batches(*args) == 2
    put([(1, "z", day(2)), (2, "c", day(2)), (None, "q", day(2))], 1)
    assert ingest_batches(*args) == 3
    # a run that broke after its rows were written and before it was committed
    (tmp_path / "cp" / "commits" / "1").unlink()
    for crc in (tmp_path / "cp" / "commits").glob(".1.crc"):
        crc.unlink()
    assert ingest_batches(*args) == 3 and out() == [(1, "a"), (2, "c"), (None, "m")]
    # a lost checkpoint of the stream: all files come again
    for part in ("commits", "offsets", "sources", "metadata"):
        path = tmp_path / "cp" / part
        shutil.rmtree(path) if path.is_dir() else path.unlink()
    for crc in (tmp_path / "cp").glob(".metadata.crc"):
        crc.unlink()
    assert ingest_batches(*args) == 3 and len(out()) == 3


def test_ingest_forgets_old_keys(spark, tmp_path):
    args = (spark, f"{tmp_path}/in/*", "k int, at timestamp", ["k"], f"{tmp_path}/out", f"{tmp_path}/cp", "at", "2 days")
    for n, (k, d) in enumerate([(1, 1), (1, 2), (2, 9), (1, 9)]):
        spark.createDataFrame([(k, datetime.datetime(2024, 1, d))], "k int, at timestamp").write.parquet(f"{tmp_path}/in/{n}")
        total = ingest_batches(*args)
    assert total == 3  # on day 9 key 1 is new again
