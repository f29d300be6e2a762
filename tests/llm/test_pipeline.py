"""The pipeline's stages: what they keep, on planted cases and on awkward rows; the registered queries on the small tables."""
import os
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from foldframe.llm import queries as llm


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(r.choices(words, k=n))
    passage = text(70)
    docs = [(i, text(120)) for i in range(120)]
    docs += [(200, docs[5][1]), (201, docs[5][1].upper()), (202, docs[7][1] + " tail"), (203, text(30) + " " + passage + " " + text(20)),
             (204, text(25) + " " + passage + " " + text(20)), (205, None), (206, ""), (None, text(40)), (207, "été " * 30)]
    toxic = [(300 + i, text(60) + " vilest " + text(40) + " vilest") for i in range(40)]
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs + toxic]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in docs[:120]] + [(i, 0, 1) for i, _ in toxic[:25]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, dict(docs + toxic), passage


def test_stages(spark, sf_dir):
    d, text, passage = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, d)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    clean, exact, near, cut = kept
    assert not any(i is not None and i >= 300 for i in clean) and len(clean) == 129
    assert 201 in exact and 5 not in exact and 200 not in exact and len(exact) == 126  # 5 = 200 = 201, and null = empty
    assert 206 in exact and 205 not in exact
    assert 7 in near and 202 not in near and len(near) <= 125
    assert passage in cut[203] and passage[10:-10] not in cut[204]
    assert cut[20] == text[20]
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, d).collect()
    assert {p.doc_id for p in pieces} == set(cut) and all(len(p.ids) == 4 * p.length for p in pieces)


def test_clashing_columns_pass_unchanged(spark, sf_dir):
    """Columns with the names of helper columns keep their values in the stages that return documents."""
    d, text, _ = sf_dir
    names = ["_id", "_sha", "_norm", "k0", "kept", "_k0", "id", "text_sha256"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    docs = docs.select(*[F.concat(F.lit(n), F.coalesce("doc_id", F.lit(-1))).alias(n) for n in names], "*")
    columns = docs.columns
    plain = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs, plain = (spark.createDataFrame((x := stage(spark, t, d)).collect(), x.schema) for t in (docs, plain))
        assert docs.columns == columns
        rows = docs.collect()
        assert all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in rows for n in names)
        assert sorted(map(str, docs.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert corpus_pipeline.STAGES[4][1](spark, docs, d).columns == corpus_pipeline.STAGES[4][1](spark, plain, d).columns


def test_run_equals_its_stages(spark, sf_dir):
    d = sf_dir[0]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((x := stage(spark, docs, d)).collect(), x.schema)
    digest = lambda df: sorted(str((r.doc_id, r.piece, r.length, r.ids_crc32)) for r in df.collect())
    assert digest(docs) == digest(corpus_pipeline.run(spark, d))


def test_stages_on_an_empty_table(spark, sf_dir):
    d = sf_dir[0]
    docs = spark.read.parquet(f"{d}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        assert docs.collect() == []
        docs = spark.read.parquet(f"{d}/documents.parquet").where("false")


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in llm.queries()} == {f"op{n}" for n in range(1, 14)} and set(llm.queries()) | {"pipeline"} <= names


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_exact_dedup_as_sql(spark):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = db.execute(llm.oracle_sql()["op7_exact_dedup"]).fetchall()
    got = llm.queries()["op7_exact_dedup"](spark, SF_SMALL).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
