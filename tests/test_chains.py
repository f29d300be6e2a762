"""Multi-domain search: blocks, division, enumeration, categories on a small fixture."""
from foldframe.operators import chains as C


def test_blocks_are_islands_of_equal_names(spark):
    t = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "a"), (6, "c")], "dbindex long, chain string")
    got = {r["dbindex"]: (r["nhd"], r["hd_ord"]) for r in C.chain_blocks(t).collect()}
    assert got == {0: (2, 1), 1: (2, 2), 2: (0, 1), 3: (3, 1), 4: (3, 2), 5: (3, 3), 6: (0, 1)}


def _scored(spark, rows):
    return spark.createDataFrame(rows, "query_chain string, chain string, block long, nqd long, nhd long, qd_ord int, hd_ord int, "
                                       "query string, hd_name string, score double, metadata string")


def test_categories_and_paths(spark):
    def row(q, h, s, nhd=3):
        return ("Q", "H", 0, 2, nhd, q, h, f"q{q}", f"h{h}", s, None)

    sc = _scored(spark, [row(1, 1, 0.9), row(1, 2, 0.8), row(2, 2, 0.7), row(2, 3, 0.6), row(1, 3, 0.0)])
    paths = C.match_info(C.match_category(C.enumerate_paths(sc, C.division(sc))))
    got = {r["match_info"]: r["match_category"] for r in paths.collect()}
    assert got == {"q1:h1:0.9,q2:h2:0.7": 2, "q1:h1:0.9,q2:h3:0.6": 1, "q1:h2:0.8,q2:h3:0.6": 2}


def test_exact_and_unordered(spark):
    def row(q, h, s):
        return ("Q", "H", 0, 2, 2, q, h, f"q{q}", f"h{h}", s, '{"cath": "1"}')

    sc = _scored(spark, [row(1, 1, 0.5), row(2, 2, 0.5), row(1, 2, 0.5), row(2, 1, 0.5)])
    got = {r["match_info"]: (r["match_category"], r["hit_metadata"]) for r in
           C.match_info(C.match_category(C.enumerate_paths(sc, C.division(sc)))).collect()}
    assert got["q1:h1:0.5,q2:h2:0.5"][0] == 3 and got["q1:h2:0.5,q2:h1:0.5"][0] == 0
    assert got["q1:h1:0.5,q2:h2:0.5"][1] == '[{"cath": "1"},{"cath": "1"}]'


def test_division_needs_every_query_domain(spark):
    def row(q, h, s):
        return ("Q", "H", 0, 2, 3, q, h, f"q{q}", f"h{h}", s, None)

    sc = _scored(spark, [row(1, 1, 0.9), row(1, 2, 0.8), row(2, 1, 0.0)])
    assert C.division(sc).count() == 0


def test_run_starts_across_ranges(spark):
    from foldframe.operators.indexing import run_starts

    names = ["a", "a", "a", "b", "b", "a", "c", "c", "c", "c", "c"]
    rows = [(i, n) for i, n in enumerate(names)] + [(13, "c")]  # a gap breaks a run too
    t = spark.createDataFrame(rows, "dbindex long, chain string")
    for rr in (1, 2, 3, 1 << 16):
        got = {r["dbindex"]: r["run_start"] for r in run_starts(t, "dbindex", "chain", range_rows=rr).collect()}
        assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6, 13: 13}, rr


def test_run_bounds_against_a_loop(spark):
    """Random runs, gaps and null names; ranges and nodes so small that runs cross many of both."""
    import random

    from foldframe.operators.indexing import run_bounds

    r = random.Random(4)
    rows, i = [], 0
    for _ in range(60):
        name = r.choice(["a", "b", None])
        for _ in range(r.randint(1, 12)):
            rows.append((i, name))
            i += 1
        i += r.choice([0, 0, 0, 1, 9])
    want, start = {}, 0
    for k, (at, name) in enumerate(rows):
        if k and (rows[k - 1][0] != at - 1 or rows[k - 1][1] != name):
            want |= {a: (rows[start][0], rows[k - 1][0]) for a, _ in rows[start:k]}
            start = k
    want |= {a: (rows[start][0], rows[-1][0]) for a, _ in rows[start:]}
    t = spark.createDataFrame(rows, "dbindex long, chain string").repartition(3)
    for rr, fan in ((1, 2), (3, 2), (5, 7), (1 << 16, 1 << 16)):
        got = {x["dbindex"]: (x["run_start"], x["run_end"]) for x in run_bounds(t, "dbindex", "chain", range_rows=rr, fan=fan).collect()}
        assert got == want, (rr, fan)


def test_paths_against_permutations(spark):
    """Every assignment, and no prefix that cannot be completed survives a level."""
    import itertools
    import random

    r = random.Random(1)
    rows, want = [], set()
    for b in range(12):
        nqd, nhd = r.randint(2, 4), r.randint(4, 6)
        score = {(q, h): round(r.random(), 3) if r.random() < 0.45 else 0.0 for q in range(1, nqd + 1) for h in range(1, nhd + 1)}
        rows += [("Q", "H", b, nqd, nhd, q, h, f"q{q}", f"h{h}", s, None) for (q, h), s in score.items()]
        want |= {(b, p) for p in itertools.permutations(range(1, nhd + 1), nqd) if all(score[q + 1, h] > 0 for q, h in enumerate(p))}
    sc = _scored(spark, rows)
    got = [(x["block"], tuple(s["hd_ord"] for s in x["path"])) for x in C.enumerate_paths(sc, C.division(sc)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_prefixes_without_completion_are_dropped():
    # three domains for two hit domains; the last two want the same one
    assert C.has_assignment([[1, 2], [1, 3], [3, 2]], []) and not C.has_assignment([[1, 2], [1, 2], [1, 2]], [])
    assert not C.has_assignment([[2], [2, 3]], [3]) and C.has_assignment([[2, 4], [2]], [3])
    import itertools
    import random

    r = random.Random(2)
    for _ in range(300):
        options = [[h for h in range(5) if r.random() < 0.4] for _ in range(r.randint(0, 4))]
        used = [h for h in range(5) if r.random() < 0.2]
        brute = any(len(set(p)) == len(p) and not set(p) & set(used) for p in itertools.product(*options))
        assert C.has_assignment(options, used) == brute


def test_store_joins_without_an_exchange(spark):
    """Joins on the index read the store's buckets; no step gathers the table in one partition."""
    t = spark.createDataFrame([(i, f"c{i // 4}") for i in range(40)], "dbindex long, chain string")
    store = C.chain_store(t)
    assert {(r["dbindex"], r["block"], r["nhd"], r["hd_ord"]) for r in store.collect()} == {(i, i // 4 * 4, 4, i % 4 + 1) for i in range(40)}
    hits = spark.createDataFrame([(q, q * 3 % 40) for q in range(40)], "qid long, dbindex long").hint("merge")
    plan = hits.join(store, "dbindex")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def test_dense_index_without_one_task_window(spark):
    from foldframe.operators.indexing import dense_index

    df = spark.createDataFrame([(g, i) for g in ("x", "y") for i in range(50)], "g string, i long")
    got = {(r["g"], r["i"]): r["rn"] for r in dense_index(df, ["i"], ["g"], partitions=7).collect()}
    assert got == {(g, i): i + 1 for g in ("x", "y") for i in range(50)}


def test_dense_index_on_a_shuffled_input(spark):
    """Input whose row order changes between evaluations (it comes out of a shuffle)."""
    from pyspark.sql import functions as F

    from foldframe.operators.indexing import dense_index

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13, "k")
    df = df.withColumn("k2", F.col("k")).repartition(11)
    got = dense_index(df, ["k"], out="rn", partitions=9).select("k", "rn")
    assert got.where(F.col("rn") != F.col("k") + 1).count() == 0
    assert got.count() == 5000


def test_pairs_of_long_blocks_are_not_exchanged_with_both_vectors(spark):
    """Every domain of a chain meets every entry of a block of 40; no exchange carries what the aligner reads of both."""
    import re

    t = spark.createDataFrame([(i, "a" if i < 40 else "b", f"n{i}.pdb", [float(i)], i, None) for i in range(44)],
                              "dbindex long, chain string, name string, embedding array<float>, length int, metadata string")
    q = spark.createDataFrame([(i, f"q{i}", f"c{i // 2}", [float(-i)], i) for i in range(6)], "qid long, query string, query_chain string, q_embedding array<float>, q_len int")
    cands = spark.createDataFrame([("c0", "a", 0, 2, 40), ("c2", "a", 0, 2, 40), ("c1", "b", 40, 2, 4)], "query_chain string, chain string, block long, nqd long, nhd long")
    qdoms = C.query_domains(q.select("qid", "query", "query_chain"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = C.candidate_pairs(cands, qdoms, C.chain_store(t), q)
        got = sorted((r["qid"], r["dbindex"], r["hd_ord"], r["hd_name"], r["q_embedding"][0], r["t_embedding"][0]) for r in pairs.collect())
        plan = pairs._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted([(i, d, d + 1, f"n{d}", -i, d) for i in (0, 1, 4, 5) for d in range(40)] + [(i, d, d - 39, f"n{d}", -i, d) for i in (2, 3) for d in range(40, 44)])
    moved = re.findall(r"\n\(\d+\) Exchange\nInput[^:]*: \[([^\]]*)\]", plan)
    assert moved and not any("q_embedding" in x and "t_embedding" in x for x in moved)


def test_pairs_of_small_groups_and_cells(spark, monkeypatch):
    """A query domain goes to a group once, whatever the number of its blocks there; groups, cells, spans and batches of a few
    rows give the pairs of a loop, for blocks that cross runs, vectors of unlike length or none, and no candidates."""
    import random

    r = random.Random(3)
    start, rows = {}, []
    for name, n in zip("abcdefgh", (3, 1, 9, 2, 30, 5, 4, 7)):
        start[name] = (len(rows), n if n > 1 else 0)
        rows += [(len(rows) + i, name, f"n{len(rows) + i}.pdb", [float(i)] * 3, i, None) for i in range(n)]
    schema = "dbindex long, chain string, name string, embedding array<float>, length int, metadata string"
    store = C.chain_store(spark.createDataFrame(rows, schema))
    q = spark.createDataFrame([(i, f"q{i}", f"c{i // 3}", [float(-i)] * 3, i) for i in range(12)], "qid long, query string, query_chain string, q_embedding array<float>, q_len int")
    qdoms = C.query_domains(q.select("qid", "query", "query_chain"))
    picked = [(f"c{c}", b, start[b][0], 3, start[b][1]) for c in range(4) for b in r.sample("acdefgh", 5)]
    cands = spark.createDataFrame(picked, "query_chain string, chain string, block long, nqd long, nhd long")
    dealt, cells = C.dealt_pairs(cands, qdoms, store, q)
    assert dealt.where("side = 1").count() == 12 and dealt.where("side = 0").count() == 60 * cells
    want = sorted((i, d, rows[d][1], d - s + 1, 3, n) for c, _, s, _, n in picked for i in range(12) if f"c{i // 3}" == c for d in range(s, s + n))
    for bits, held, task, batch in ((10, 1 << 17, 1 << 22, 1 << 12), (1, 4, 40, 7), (2, 16, 10, 1)):
        for k, v in (("RUN_BITS", bits), ("HELD_ENTRIES", held), ("TASK_PAIRS", task), ("BATCH_PAIRS", batch)):
            monkeypatch.setattr(C, k, v)
        for packed in (False, True):
            got = C.candidate_pairs(cands, qdoms, store, q, packed=packed)
            assert sorted((x["qid"], x["dbindex"], x["chain"], x["hd_ord"], x["nqd"], x["nhd"]) for x in got.collect()) == want
    assert C.candidate_pairs(cands.where("false"), qdoms, store, q).collect() == []
    # unlike lengths and nulls pass as they are; binary vectors are read as the lists are
    odd = [(i, n, name, None if i == 0 else [float(i)] * (1 + (i == 1)), k, m) for i, n, name, _, k, m in rows]
    few = C.candidate_pairs(cands.where("chain = 'a'"), qdoms, C.chain_store(spark.createDataFrame(odd, schema)), q).collect()
    assert {x["dbindex"]: x["t_embedding"] for x in few} == {0: None, 1: [1.0, 1.0], 2: [2.0]}


def test_packed_vectors_are_read_as_lists():
    import numpy as np
    import pyarrow as pa

    from foldframe.operators.search import _arrow_vectors

    v = np.arange(12, dtype=np.float32).reshape(4, 3)
    lists, packed = pa.array(list(v), pa.list_(pa.float32())), pa.array([x.tobytes() for x in v], pa.binary())
    for a, n in ((0, 4), (1, 2), (3, 1), (4, 0)):
        assert _arrow_vectors(packed.slice(a, n)).tolist() == _arrow_vectors(lists.slice(a, n)).tolist()


def test_division_reads_buckets_where_they_lie(spark):
    from foldframe.sources.store import bucketed

    rows = [("Q", "H", b, 2, 3, q, h, f"q{q}", f"h{h}", s, None) for b, q, h, s in
            [(0, 1, 1, 0.9), (0, 2, 1, 0.8), (1, 1, 1, 0.9), (1, 1, 1, 0.9), (1, 2, 3, 0.8), (2, 1, 1, 0.5), (2, 1, 2, 0.5), (3, 1, 1, 0.5), (3, 2, 2, 0.0)]]
    sc = _scored(spark, rows)
    kept = C.division(bucketed(sc, "scored", "query_chain", "chain", "block"))
    assert [r["block"] for r in C.division(sc).collect()] == [r["block"] for r in kept.collect()] == [1]
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
