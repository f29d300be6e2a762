"""Exact cosine search: block-size independence and brute force on a small fixture."""
import numpy as np

from foldframe.operators import search as S


def _vectors(spark, n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    lens = rng.integers(50, 400, size=n)
    q = spark.createDataFrame([(i, v[i].tolist(), int(lens[i])) for i in range(n)], "qid long, q_embedding array<float>, q_len int")
    t = spark.createDataFrame([(i, v[i].tolist(), int(lens[i])) for i in range(n)], "dbindex long, embedding array<float>, length int")
    return v.astype(np.float64), lens, q, t


def brute_topk(v, lens, k, mincov=None):
    n = len(v)
    nv = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = nv @ nv.T
    out = {}
    for i in range(n):
        cand = []
        for j in range(n):
            if i == j:
                continue
            sc = s[i, j]
            if mincov is not None and not lens[i] >= lens[j] * mincov:
                sc = 0.0
            cand.append((-round(sc, 4), j))
        cand.sort()
        out[i] = [j for _, j in cand[:k]]
    return out


def _ranked(df):
    got = {}
    for r in df.orderBy("qid", "emb_rank").collect():
        got.setdefault(r["qid"], []).append(r["dbindex"])
    return got


def test_topk_equals_brute_force_and_ignores_block_sizes(spark):
    v, lens, q, t = _vectors(spark, 60)
    exp = brute_topk(v, lens, 5)
    for opts in [dict(), dict(work_elements=64), dict(query_block_rows=7, target_block_rows=11, work_elements=40),
                 dict(query_block_rows=1, target_block_rows=1)]:
        got = _ranked(S.vector_search(q, t, 5, exclude_self=True, **opts))
        assert got == exp, opts


def test_length_mask_before_ranking(spark):
    v, lens, q, t = _vectors(spark, 40, seed=9)
    exp = brute_topk(v, lens, 4, mincov=0.7)
    assert _ranked(S.vector_search(q, t, 4, mincov=0.7, exclude_self=True, query_block_rows=9)) == exp


def test_k_larger_than_table_returns_all(spark):
    v, lens, q, t = _vectors(spark, 6)
    got = _ranked(S.vector_search(q, t, 50, exclude_self=True))
    assert all(len(x) == 5 for x in got.values())


def test_threshold_join_brute_force(spark):
    v, lens, q, t = _vectors(spark, 50, seed=5)
    nv = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = nv @ nv.T
    exp = {(i, j) for i in range(50) for j in range(50) if i != j and round(s[i, j], 4) >= 0.3}
    got = {(r["qid"], r["dbindex"]) for r in S.threshold_join(q, t, 0.3, exclude_self=True, query_block_rows=8, target_block_rows=13).collect()}
    assert got == exp


def test_metadata_default(spark):
    hits = spark.createDataFrame([(0, 1), (0, 2)], "qid long, dbindex long")
    t = spark.createDataFrame([(1, '{"cath": "3.40.50.300"}'), (2, None)], "dbindex long, metadata string")
    got = {r["dbindex"]: r["metadata"] for r in S.join_metadata(hits, t).collect()}
    assert got == {1: '{"cath": "3.40.50.300"}', 2: "{ }"}


def test_rank_does_not_depend_on_partitions_or_blocks(spark):
    """Scores at a rounding tie (0.03125) and just above it rank by the same rule everywhere."""
    def unit(c):
        return [c, float(np.sqrt(1 - c * c))]

    q = spark.createDataFrame([(9, [1.0, 0.0], 10)], "qid long, q_embedding array<double>, q_len int")
    rows = [(0, unit(0.03125), 10), (1, unit(0.03131), 10)]
    for n in (1, 2, 8):
        t = spark.createDataFrame(rows, "dbindex long, embedding array<double>, length int").repartition(n, "dbindex")
        for block in (1, 65536):
            assert [r["dbindex"] for r in S.vector_search(q, t, 1, target_block_rows=block).collect()] == [0]
            kept = S.filter_min_cosine(S.vector_search(q, t, 5, target_block_rows=block), 0.0313)
            joined = S.threshold_join(q, t, 0.0313, target_block_rows=block)
            pushed = S.vector_search(q, t, 5, min_score=0.0313, target_block_rows=block)
            assert {r["dbindex"] for r in kept.collect()} == {r["dbindex"] for r in joined.collect()} == {r["dbindex"] for r in pushed.collect()} == {0, 1}


def _clusters(spark, n=240, dim=6, groups=8, seed=2):
    """Tight clusters far apart, a zero vector and a lone one."""
    rng = np.random.default_rng(seed)
    centre = np.eye(dim).repeat(2, axis=0)[:groups] * np.tile([1, -1], groups)[:groups, None]
    v = (centre[rng.integers(0, groups, n)] + rng.normal(scale=0.02, size=(n, dim))).astype(np.float32)
    v[5], v[6] = 0, rng.normal(size=dim)
    lens = rng.integers(50, 400, size=n)
    q = spark.createDataFrame([(i, v[i].tolist(), int(lens[i])) for i in range(n)], "qid long, q_embedding array<float>, q_len int")
    t = spark.createDataFrame([(i, v[i].tolist(), int(lens[i])) for i in range(n)], "dbindex long, embedding array<float>, length int")
    return q, t


def test_pairs_of_far_pivots_are_skipped_and_nothing_is_lost(spark):
    q, t = _clusters(spark)
    for k, least, cov in ((4, None, None), (4, 0.5, None), (None, 0.9, None), (3, None, 0.7), (300, None, None)):
        whole = S.BlockSearch(q, t)
        many = S.BlockSearch(q, t, query_block_rows=16, target_block_rows=20)
        a, b = (x.search(k, least, cov, exclude_self=True) for x in (whole, many))
        if k is not None:
            a, b = S.topk(a, k), S.topk(b, k)
        want, got = (sorted((r["qid"], r["dbindex"], r["score_key"]) for r in x.collect()) for x in (a, b))
        assert got == want and want
        assert whole.skipped == 0 and len(many.pivots) == 12
        if (k, cov) != (300, None):
            assert many.skipped > 0.3 * many.pairs, (k, least, cov, many.skipped, many.pairs)


def test_search_of_empty_tables(spark):
    q, t = _clusters(spark, 20)
    for a, b in ((q.where("false"), t), (q, t.where("false")), (q.where("false"), t.where("false"))):
        assert S.vector_search(a, b, 3).collect() == [] and S.threshold_join(a, b, 0.1).collect() == []


def test_no_shuffle_of_rows_per_block(spark):
    """Once there are as many blocks of queries as partitions, a block sends each query's best rows on once."""
    q, t = _clusters(spark)
    s = S.BlockSearch(q, t, query_block_rows=4, target_block_rows=20)
    assert s.groups == 1
    near = np.ones((len(s.pivots), len(s.pivots)), dtype=bool)
    assert s.score(near, 3, None, None, True).count() == 3 * 240


def test_small_blocks_share_what_they_are_sent(spark, monkeypatch):
    """A target goes once to each unit of blocks, not to each block; units are no more than the budget for copies allows."""
    q, t = _clusters(spark)
    want = sorted((r["qid"], r["dbindex"]) for r in S.vector_search(q, t, 3, exclude_self=True).collect())
    for rows, units in ((1, 1), (5 * 240, 5)):
        monkeypatch.setattr(S, "SENT_ROWS", rows)
        s = S.BlockSearch(q, t, query_block_rows=4, target_block_rows=20)
        everything = np.ones((len(s.pivots), len(s.pivots)), dtype=bool)
        sent = {p: (a, b) for p, a, b in s._units_seen(everything)}
        assert int(s.blocks.sum()) > 50 and s.units == units and set(sent.values()) == {(0, units - 1)}
        got = s.search(3, exclude_self=True)
        assert sorted((r["qid"], r["dbindex"]) for r in S.topk(got, 3).collect()) == want


def test_found_pairs_leave_the_task_in_pieces(monkeypatch):
    """Threshold mode never holds the pairs of a batch of targets: all 600 x 900 reach the minimum here."""
    monkeypatch.setattr(S, "PIECE_PAIRS", 1_000)
    v = np.ones((900, 4))
    ids, lens = np.arange(900), np.full(900, 10)
    scorer = S._Scorer(ids[:600], v[:600], lens[:600], None, 0.5, None, True, work=6_000)
    sizes = [b.num_rows for b in scorer.feed(ids, v, lens)]
    assert sum(sizes) + scorer.result().num_rows == 600 * 899 and max(sizes) <= 2_000


def test_single_precision_drops_no_pair():
    """Scores just around the k-th best and the minimum, masks, vectors without a length: the same as scoring all pairs."""
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=(1, 16)) + 1e-5 * rng.normal(size=(150, 16)), rng.normal(size=(150, 16)), np.zeros((3, 16)), np.full((1, 16), np.inf)])
    ids, lens = np.arange(len(v)), rng.integers(1, 400, len(v))
    with np.errstate(all="ignore"):
        s = np.nan_to_num(np.einsum("ij,kj->ik", v, v) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1)), nan=0.0)
    for k, least, cov in ((5, None, None), (5, None, 0.7), (40, 0.1, 0.7), (None, 0.1, None), (None, -0.2, 0.7), (400, None, None)):
        key = S.score_keys(s if cov is None else np.where(lens[:, None] >= lens[None, :] * cov, s, 0.0))
        rows = [[(-key[i, j], j) for j in ids if j != i and (least is None or key[i, j] >= S.least_key(least))] for i in ids]
        want = {(i, j) for i in ids for _, j in sorted(rows[i])[:k]}
        scorer = S._Scorer(ids, v, lens, k, least, cov, True, work=2_048)
        got = [b for a in range(0, len(v), 70) for b in scorer.feed(ids[a:a + 70], v[a:a + 70], lens[a:a + 70])] + scorer.result().to_batches()
        pairs = [(q, t) for b in got for q, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want, (k, least, cov)


def test_queries_search_once(spark, monkeypatch):
    """Queries that read their hits several times (two tables, two files, bounds of ranges and rows) search once."""
    from conftest import SF_SMALL
    from pyspark.sql import functions as F

    from foldframe.plans import q_io, q_search, q_summary

    real = q_search.masked_hits
    for query in (q_summary.q_sink_summary, q_summary.q_sink_report, q_io.q_sink_metadata_json):
        seen = spark.sparkContext.accumulator(0)

        def counted(s, sf, **opts):
            hits = real(s, sf, **opts)

            def count(batches):
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            return hits.mapInArrow(count, hits.schema)

        monkeypatch.setattr(q_search, "masked_hits", counted)
        query(spark, SF_SMALL).collect()
        assert seen.value == real(spark, SF_SMALL).agg(F.count(F.lit(1))).first()[0]


def test_groups_are_no_more_than_keep_the_cores_busy(spark, monkeypatch):
    """Each group of targets sends all queries and their best rows once more, so its number follows the cores and not the
    number of shuffle partitions, which grows with the tables."""
    q, t = _clusters(spark)
    want = sorted((r["qid"], r["dbindex"]) for r in S.vector_search(q, t, 3, exclude_self=True).collect())
    monkeypatch.setattr(S, "SPLIT_PAIRS", 100)
    most = 2 * spark.sparkContext.defaultParallelism
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (partitions, "700"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            s = S.BlockSearch(q, t)
            assert s.units == 1 and s.groups == most
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sorted((r["qid"], r["dbindex"]) for r in S.topk(s.search(3, exclude_self=True), 3).collect()) == want
