"""Stores that operators write and read back: bundles, staged batches, JSON arrays, target databases, reports, buckets."""
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from foldframe.operators import sinks as SK
from foldframe.operators import staging as SG
from foldframe.sources import bundles as BN
from foldframe.sources import reports as R


def test_bundles_keep_every_structure_in_order(spark, tmp_path):
    rows = [(f"s{i % 37}", i, f"line {i} of s{i % 37}" if i % 11 else "") for i in range(500)] + [("single", 0, "é only")]
    lines = spark.createDataFrame(rows, "name string, ord int, line string").repartition(7)
    for mb in (16, 0.0005):
        path = str(tmp_path / f"b{mb}")
        BN.write_bundles(lines, path, "name", ["ord"], bundle_mb=mb)
        files = glob.glob(f"{path}/text/*/part-*")
        assert len(files) == 1 if mb == 16 else 5 < len(files) < 38  # never one file a structure
        got = {r["name"]: r["lines"] for r in BN.read_bundles(spark, path, "name").collect()}
        want = {n: [t for a, _, t in sorted(rows, key=lambda x: x[1]) if a == n] for n in {r[0] for r in rows}}
        assert got == want
        m = {r["name"]: (r["bundle"], r["first_line"], r["n_lines"]) for r in spark.read.parquet(f"{path}/manifest").collect()}
        for name, (bundle, first, n) in m.items():
            with open(glob.glob(f"{path}/text/bundle={bundle}/part-*")[0], encoding="utf-8") as f:
                assert f.read().split("\n")[first:first + n] == want[name]
    BN.write_bundles(lines.where("false"), str(tmp_path / "none"), "name", ["ord"])
    assert BN.read_bundles(spark, str(tmp_path / "none"), "name").collect() == []


def test_atom_lines_and_ca_lines(spark):
    rows = [(1, "A", 2, "CA", "GLY", 5, 1.5, 0.0, -2.25), (1, "A", 1, "N", "ALA", 4, 0.5, 0.0, 0.0), (1, "A", 1, "CA", "ALA", 3, 9.0, 8.0, 7.0)]
    a = spark.createDataFrame(rows, "sid int, chain string, resi int, atom string, resn string, serial int, x double, y double, z double")
    a = a.withColumn("occ", F.lit(2.0)).withColumn("b", F.lit(69.9))
    full = [r["line"] for r in SK.atom_lines(a, ["sid"], ["resi", "serial"]).orderBy("ord").collect()]
    assert full == ["ATOM      3  CA  ALA A   1       9.000   8.000   7.000  2.00    69", "ATOM      4  N   ALA A   1       0.500   0.000   0.000  2.00    69",
                    "ATOM      5  CA  GLY A   2       1.500   0.000  -2.250  2.00    69", "END"]
    ca = [r["line"] for r in SK.ca_lines(a.where("atom = 'CA'"), ["sid"]).orderBy("ord").collect()]
    assert ca == ["ATOM      1  CA  ALA A   1       9.000   8.000   7.000  1.00  0.00", "ATOM      2  CA  GLY A   2       1.500   0.000  -2.250  1.00  0.00", "END"]


def test_failed_batches_are_recorded_and_only_they_are_staged_again(spark, tmp_path):
    path = str(tmp_path / "stage")
    files = spark.createDataFrame([(i, "o" + str(i % 2), i // 10, f"text {i}") for i in range(40)], "file_id int, organism string, batch long, content string")
    bad = F.when(F.col("file_id").isin(3, 21), F.lit("cannot be read"))
    first = {(r["organism"], r["batch"]): (r["state"], r["n_files"], r["error"]) for r in SG.stage_batches(files, path, bad).collect()}
    assert len(first) == 8 and {k for k, v in first.items() if v[0] == SG.FAILED} == {("o1", 0), ("o1", 2)}
    assert first["o1", 0] == (SG.FAILED, 5, "cannot be read") and first["o0", 0] == (SG.STAGED, 5, None)
    assert SG.read_staged(spark, path).count() == 30
    # an attempt that wrote its data but died before its ledger rows: the data do not count, and are replaced
    files.where("batch = 0 and organism = 'o1'").withColumn("content", F.lit("half")).write.mode("append").partitionBy("organism", "batch").parquet(f"{path}/data")
    assert SG.read_staged(spark, path).count() == 30
    again = {(r["organism"], r["batch"]): (r["state"], r["attempt"]) for r in SG.stage_batches(files, path, F.lit(None).cast("string")).collect()}
    assert again == {("o1", 0): (SG.STAGED, 2), ("o1", 2): (SG.STAGED, 2)}
    got = sorted((r["file_id"], r["organism"], r["batch"], r["content"], r["attempt"]) for r in SG.read_staged(spark, path).collect())
    assert got == [(i, "o" + str(i % 2), i // 10, f"text {i}", 2 if i % 2 and i // 10 in (0, 2) else 1) for i in range(40)]
    assert SG.stage_batches(files, path, F.lit(None).cast("string")).collect() == [] and SG.read_ledger(spark, path).count() == 10


def test_batches_share_files_and_a_dead_attempt_is_replaced(spark, tmp_path):
    """400 batches of two files do not become 400 folders; an attempt without its ledger rows does not count."""
    path = str(tmp_path / "stage")
    files = spark.createDataFrame([(i, "o" + str(i % 2), i // 4, f"text {i}") for i in range(800)], "file_id int, organism string, batch long, content string").repartition(4)
    SG.stage_batches(files, path, F.when(F.col("file_id") == 5, F.lit("cannot be read")))
    assert len(glob.glob(f"{path}/data/**/part-*.parquet", recursive=True)) <= 8
    files.withColumn("content", F.lit("half")).write.partitionBy("organism").parquet(f"{path}/data/attempt=2")  # died before its ledger rows
    assert SG.read_staged(spark, path).count() == 798
    SG.stage_batches(files, path, F.lit(None).cast("string"))
    got = sorted((r["file_id"], r["organism"], r["batch"], r["content"], r["attempt"]) for r in SG.read_staged(spark, path).collect())
    assert got == [(i, "o" + str(i % 2), i // 4, f"text {i}", 2 if i in (5, 7) else 1) for i in range(800)]


def test_json_array_is_one_document_with_its_types(spark, tmp_path):
    values = ['{"cath":"1","n":69,"o":{"a":1}}', '{"x": [1, 2.5, null, true], "s": "a]b"}', "[1,[2]]", "not json", '"t"']
    hits = spark.createDataFrame(list(enumerate(values)), "qid int, metadata string").repartition(3)
    path = str(tmp_path / "a")
    SK.write_json_array(hits.select("qid", SK.metadata_json("metadata").alias("line")), path, ["qid"])
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))
    assert json.loads(text) == [json.loads(v) if i != 3 else v for i, v in enumerate(values)]
    back = [r["line"] for r in SK.read_json_array(spark, path).collect()]
    assert sorted(back) == sorted(json.dumps(json.loads(v), separators=(",", ":"), sort_keys=True) if i != 3 else '"not json"' for i, v in enumerate(values))
    SK.write_json_array(hits.where("false").select("qid", F.col("metadata").alias("line")), path, ["qid"])
    assert json.loads("".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))) == [] and SK.read_json_array(spark, path).collect() == []


@pytest.mark.parametrize("rows, message", [
    ([(0, "a", [1.0, 2.0]), (1, "b", None)], "without a vector, the first has dbindex 1"),
    ([(0, "a", [1.0, 2.0]), (1, "b", [1.0])], "different lengths"),
    ([(0, "a", [1.0]), (2, "b", [1.0])], "index differ"),
    ([(0, "a", [1.0]), (0, "b", [1.0])], "index differ")])
def test_broken_target_databases_are_not_handed_out(spark, tmp_path, rows, message):
    path = str(tmp_path / "t")
    spark.createDataFrame([(*r, "AC") for r in rows], "dbindex long, name string, embedding array<double>, seq string").write.parquet(path)
    with pytest.raises(ValueError, match=message):  # whatever columns are read afterwards
        R.read_targets(spark, path).select("name")


def test_reports_in_bundles_and_as_files(spark, tmp_path):
    means = spark.createDataFrame([("p", 71.5, 2), ("q", 0.0, 0)], "structure string, mean_plddt double, n_hits long")
    counts = spark.createDataFrame([("p", "1.10,x", 3), ("p", None, 1)], "structure string, cath_id string, count long")
    lines = R.report_lines(means, counts)
    R.write_reports(lines, str(tmp_path / "b"))
    back = R.read_reports(spark, str(tmp_path / "b"))
    assert sorted(map(tuple, R.report_counts(back).collect())) == [("", 1, "p"), ("1.10,x", 3, "p")]
    assert sorted(map(tuple, R.report_headers(back).collect())) == [("p", 71.5), ("q", 0.0)]
    R.write_report_files(lines.where("line not like '1.10%'"), str(tmp_path / "f"))
    assert sorted(os.listdir(tmp_path / "f"))[-2:] == ["structure=p", "structure=q"]
    assert sorted(map(tuple, R.read_report_headers(spark, str(tmp_path / "f")).collect())) == [("p", 71.5), ("q", 0.0)]
    assert [(r["count"], r["structure"]) for r in R.read_report_counts(spark, str(tmp_path / "f")).collect()] == [(1, "p")]


def test_domain_lists_in_both_layouts(spark, tmp_path):
    (tmp_path / "long.csv").write_text("1abc,1abcA,A,2,2,120,1-30_50-60:1_2|-5-0:999_999\n2xyz,2xyzB,B,1,1,9,(3A)-9B:4_4\n")
    got = sorted((r["target"], r["n_residues"], r["dom"], r["seg"], r["first"], r["last"], r["label"], r["masked"])
                 for r in R.read_boundaries(spark, str(tmp_path / "long.csv")).collect())
    assert got == [("1abcA", 120, 1, 1, 1, 30, "1_2", False), ("1abcA", 120, 1, 2, 50, 60, "1_2", False), ("1abcA", 120, 2, 1, -5, 0, "999_999", True),
                   ("2xyzB", 9, 1, 1, 3, 9, "4_4", False)]
    (tmp_path / "short.csv").write_text("target,nres\nAF-X,70\nAF-Y,147\n")
    assert sorted(map(tuple, R.read_target_sizes(spark, str(tmp_path / "short.csv")).collect())) == [("AF-X", 70), ("AF-Y", 147)]


def test_object_store_keeps_the_latest_object(spark, tmp_path):
    rows = [(1, "a-b", "data/x.html", "old"), (2, "a-b", "data/x.html", "new\n\nlines\n"), (3, "a-b", "data/y", None), (4, "c", "data/x.html", "é")]
    SK.copy_to_store(spark.createDataFrame(rows, "page_id long, bucket string, object_key string, content string"), str(tmp_path / "s"), "page_id")
    got = sorted(map(tuple, SK.read_store(spark, str(tmp_path / "s")).collect()))
    assert got == [("a-b", "data/x.html", "new\n\nlines\n"), ("a-b", "data/y", ""), ("c", "data/x.html", "é")]


def test_structure_files_are_read_whole_and_named(spark, tmp_path):
    from foldframe.sources import structures as ST

    for org, name, text in (("ecoli", "p1.pdb", "ATOM 1\nENDMDL\nATOM 2\n"), ("ecoli", "p2", "x"), ("human", "q.pdb", "\n"), ("human", "empty.pdb", "")):
        (tmp_path / org).mkdir(exist_ok=True)
        (tmp_path / org / name).write_text(text)
    got = sorted(tuple(r) for r in ST.read_structures(spark, f"{tmp_path}/*/*").select("organism", "file_name", "structure_id", "content").collect())
    assert got == [("ecoli", "p1.pdb", "p1", "ATOM 1\nENDMDL\nATOM 2\n"), ("ecoli", "p2.pdb", "p2", "x"), ("human", "q.pdb", "q", "\n")]  # no row for a file without a byte


def test_payload_of_a_hit_without_one(spark):
    from foldframe.operators import search as S

    hits = spark.createDataFrame([(0, 1), (0, 2)], "qid long, dbindex long")
    assert sorted((r["dbindex"], r["seq"]) for r in S.join_payload(hits, spark.createDataFrame([(1, "AC")], "dbindex long, seq string")).collect()) == [(1, "AC"), (2, None)]


def test_scratch_is_released(spark, monkeypatch):
    from foldframe import session
    from foldframe.sources.store import written

    monkeypatch.setattr(session, "_SCRATCH", [])  # only what this test writes
    t = written(spark.range(5), "gone")
    assert t.count() == 5 and session.release_scratch(spark) == 1 and session.release_scratch(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(t.inputFiles()[0]).count()
