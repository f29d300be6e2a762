"""Bad lines, short reports and mismatching lists do not end a job, with ANSI mode on and off."""
import pytest
from pyspark.sql import functions as F

from foldframe.functions import text as TX
from foldframe.operators import geometry as G
from foldframe.sources import structures as ST


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old)


def test_aligner_report_with_missing_parts(ansi):
    rows = [("Aligned length= 12, RMSD=   1.50, Seq_ID=n_identical/n_aligned= 0.250\nTM-score= 0.5 (a)\nTM-score= 0.75 (b)\n",),
            ("TM-score= 0.5000 (a)\n",), ("nothing",), (None,), ("RMSD= x, TM-score= y",)]
    got = [tuple(r) for r in ansi.createDataFrame(rows, "r string").select(*TX.aligner_fields("r")).collect()]
    assert got == [(12, 1.5, 0.25, 0.5, 0.75), (None, None, None, 0.5, None)] + [(None,) * 5] * 3


def test_alignment_lines(ansi):
    rows = [('x\n(":" denotes residue pairs of d < 5.0)\nAB-\n:.\nA-C\nlast',), ("none",)]
    got = [r[0] for r in ansi.createDataFrame(rows, "r string").select(TX.alignment_lines("r")).collect()]
    assert got == ["AB-\n:.\nA-C", None]


def test_report_mean_without_number(ansi):
    got = ansi.createDataFrame([("#f Results. mean plddt: 71.5",), ("#f Results.",), ("mean plddt: ?",)], "l string").select(TX.report_mean("l")).collect()
    assert [r[0] for r in got] == [71.5, None, None]


def test_records_that_cannot_be_read(ansi):
    good = "ATOM      1  CA  ALA A   5      11.000  12.000  13.000  1.00 50.00"
    lines = [good, "ATOM  123456  CA  ALA A   5      11.000  12.000  13.000  1.00 50.00", "ATOM      x  CA  ALA A   5      11.000  12.000  13.000",
             "ATOM      2  CA  ALA A   ?       1.0     bad"]
    df = ansi.createDataFrame(list(enumerate(lines)), "n int, line string")
    got = {r["n"]: r for r in ST.parse_records(df).collect()}
    assert (got[0]["serial"], got[0]["x"], got[0]["b"]) == (1, 11.0, 50.0)
    assert (got[1]["serial"], got[1]["resi"], got[1]["chain"], got[1]["z"], got[1]["b"]) == (123456, 5, "A", 13.0, 50.0)
    assert got[2]["serial"] is None and got[2]["occ"] is None and got[3]["resi"] is None
    assert {r["n"] for r in ST.bad_records(df).collect()} == {2, 3}


def test_input_chains_mismatch(ansi):
    inputs = ansi.createDataFrame([(1, i) for i in range(3)] + [(2, 0), (2, 1)], "g int, o int")
    lists = ansi.createDataFrame([(1, "A,B"), (2, "C")], "g int, ids string")
    got = sorted((r["g"], r["o"], r["chain"], r["status"]) for r in ST.join_input_chains(inputs, lists, "g", "o", "ids").collect())
    assert [x[2:] for x in got] == [("A", "length_mismatch"), ("B", "length_mismatch"), (None, "length_mismatch"), ("C", "ok"), ("C", "ok")]


def test_error_rows_isolates_the_bad_rows_of_a_batch(spark):
    from foldframe.operators import slots as SL

    calls = spark.sparkContext.accumulator(0)

    def fn(values):
        calls.add(1)
        if values.isin(["x"]).any():
            raise ValueError("bad value")
        return values.str.len().astype(float)

    df = spark.createDataFrame([(i, "x" if i in (3, 40) else "a" * (i % 5)) for i in range(64)], "i int, t string").coalesce(1)
    got = {r["i"]: (r["result"], r["status"], r["error"]) for r in SL.error_rows(df, fn, "t", "double").collect()}
    assert got == {i: (None, "error", "ValueError: bad value") if i in (3, 40) else (float(i % 5), "ok", None) for i in range(64)}
    assert calls.value < 30  # not one call a row
    with pytest.raises(Exception, match="bad value"):
        SL.error_rows(df, fn, "t", "double", policy="fail").collect()


def test_components_of_a_long_path(spark):
    nodes = spark.range(64).select(F.lit(1).alias("k"), F.col("id").alias("node"))
    edges = spark.range(63).select(F.lit(1).alias("k"), F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    for limit in (G.GROUP_EDGES, 3):  # in one group, and contracted by joins
        assert {r["component"] for r in G.connected_components(nodes, edges, ["k"], group_edges=limit).collect()} == {0}
