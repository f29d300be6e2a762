"""URL filter, embedding whitening and hard-negative mining against brute force, on awkward rows and on empty tables."""
import math
import os
import random

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from foldframe.llm import hard_negatives, queries, sql, url_filter, vectors, whitening

# --------------------------------------------------------------------------- urls
URLS = ["https://www.casino-win.example.com/en/1", "HTTP://A.EXAMPLE.ORG/es/x?y#z", "http://example.org/es/", "http://badexample.org/es/", "http://x.org",
        "http://x.org?/fr/", "http://a.com/fr/1", "http://com/fr/", "http://a.com/FR/", "http://a.com/de/", "http://com.de/de/", "x.org/fr/", "", None, "://", "a://b://c/d",
        "http://example.org/en/1?x", "http://example.org/en/2", "http://É.ÀB.org/é?", "http://host\nb.org/pa\nth#f", "http://" + "ab." * 30000 + "org/" + "x/é" * 30000,
        "https://tidy-garden.example.net/en/5", "https://tidy-garden.example.net/en/5"]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    tail = rest[cut:]
    end = min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def brute_rule(host, path):
    fits = []
    for verdict, rule in url_filter.RULES:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(u, i if i != 5 else None, "h", "p", 1) for i, u in enumerate(URLS)]
    return spark.createDataFrame(rows, "url string, page_id long, host string, path string, _url int").repartition(3)


def test_url_parts_and_rules(pages):
    got = url_filter.url_filter(pages, steps=3).collect()
    want = {(None if i == 5 else i): u for i, u in enumerate(URLS)}
    assert len(got) == len(URLS)
    for r in got:
        assert (r.host, r.path) == brute_parts(want[r.page_id])
        rule, verdict = brute_rule(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or ("block" if r.p_block > url_filter.CUT else "allow"))


def test_url_model_is_the_minimum_and_does_not_depend_on_partitions(spark):
    r = random.Random(3)
    rows = [(f"http://{r.choice(['good', 'fine', 'bad', 'awful'])}{r.randint(0, 20)}.net/{r.randint(0, 9)}",) for _ in range(120)]
    table = spark.createDataFrame(rows, "url string").withColumn("blocked", F.col("url").rlike("bad|awful"))
    settings = dict(sample=400, buckets=256, ridge=1e-2)
    assert url_filter.fit(table.coalesce(1), steps=3, **settings) == url_filter.fit(table.repartition(5), steps=3, **settings)
    one = url_filter.fit(table, steps=40, **settings)
    host, path = url_filter.url_parts(F.col("url"))
    found = table.distinct().select(url_filter.buckets_of(host, path, 256).alias("b"), "blocked", url_filter.margin(url_filter.buckets_of(host, path, 256), one).alias("m")).collect()
    x = np.zeros((len(found), 257))
    for i, f in enumerate(found):
        x[i, [b - 1 for b in f.b]] = 1 / math.sqrt(len(f.b))
        assert len(set(f.b)) == len(f.b)
    x[:, 256] = 1
    y, w, ridge = np.array([f.blocked for f in found], float), np.zeros(257), np.full(257, 1e-2)
    ridge[256] = 0
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + np.diag(ridge) + 1e-12 * np.eye(257), x.T @ (p - y) / len(y) + ridge * w)
    assert np.abs(x @ w - np.array([f.m for f in found])).max() < 0.05
    assert np.allclose(x @ np.array(one), [f.m for f in found])


def test_url_held_out_accuracy(spark):
    """Hosts of words in pairs that the table does not have, on ends and paths that tell nothing."""
    r = random.Random(8)
    rows = [(k, f"http://{r.choice(['', 'shop.', 'the'])}{r.choice(words)}{r.choice('-x0')}{r.choice(words)}.{r.choice(['io', 'example.net'])}/en/{k}", k % 2 == 0)
            for k in range(600) for words in [url_filter.JUNK_WORDS if k % 2 == 0 else url_filter.PLAIN_WORDS]]
    got = url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string, junk boolean").drop("junk"), rules=()).collect()
    right = sum((g.verdict == "block") == (g.page_id % 2 == 0) for g in got)
    assert right >= 0.95 * len(rows) and all(g.rule is None for g in got)


def test_url_table_bounds_and_empty_tables(spark, pages):
    big = spark.range(3000).select(F.concat(F.lit("http://h/"), "id").alias("url"), (F.col("id") % 3 == 0).alias("blocked"))
    some = url_filter.labelled_sample(big.union(big), 200)
    assert sorted(map(tuple, some.groupBy("blocked").count().collect())) == [(False, 100), (True, 100)]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, url_filter.labelled_sample(big.repartition(7), 200).collect()))
    assert url_filter.url_filter(pages.where("false"), steps=1).collect() == []
    no_labels = url_filter.url_filter(pages, big.where("false")).where("rule is null").select("verdict").distinct().collect()
    assert [r.verdict for r in no_labels] == ["allow"]
    only_one = url_filter.url_filter(pages, big.where("blocked"), steps=5).where("rule is null").select("verdict").distinct().collect()
    assert [r.verdict for r in only_one] == ["block"]


# --------------------------------------------------------------------------- whitening
def _embeddings(spark, rows, kind="float"):
    return spark.createDataFrame([("x", i, v, 7) for i, v in rows], f"_vector string, vec_id long, embedding array<{kind}>, size int").repartition(4)


def brute_whitened(v):
    x = np.floor(64 * np.asarray(v, float)).astype(object) + 1_000_000
    n = len(x)
    S = x.sum(axis=0)
    a = n * x - S
    z = (a / n).astype(float)
    e, U = np.linalg.eigh(z.T @ z / n)
    return n, (a * a).sum(axis=1), z, e[::-1], U[:, ::-1]


def _whitened(df, **kw):
    out = whitening.whiten(df, **kw)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    return out.collect()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_equals_eigenvectors(spark, kind):
    rng = np.random.default_rng(4)
    v = (rng.normal(size=(300, 12)) @ np.diag(np.geomspace(0.5, 40, 12))).astype(np.float32)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    bad = [(900, None), (901, [float("nan")] * 12), (902, [1.0] * 11 + [float("inf")]), (903, [1.0, None] * 6), (904, [1.0] * 5), (905, [])]
    extra = [(7, rows[7][1]), (None, rows[8][1]), (7, rows[7][1])]
    got = _whitened(_embeddings(spark, rows + bad + extra, kind), many=10)
    n, dev, z, e, U = brute_whitened([r for _, r in rows + extra])
    assert len(got) == n * 10 and {g.n for g in got} == {n} and max(g.identity_error for g in got) < 1e-9
    assert not {g.vec_id for g in got} & {b for b, _ in bad} and sum(g.vec_id is None for g in got) == 10 and sum(g.vec_id == 7 for g in got) == 30
    by = {}
    for g in got:
        by.setdefault(g.vec_id, {})[g.component] = g
    want = z @ U[:, :10] / np.sqrt(e[:10])
    sign = np.sign([[by[i][c + 1].whitened * want[i, c] for c in range(10)] for i in range(300)]).sum(axis=0)
    assert all(abs(s) > 290 for s in sign)
    for i in range(300):
        assert by[i][1].deviation == dev[i]
        assert np.allclose([by[i][c + 1].whitened for c in range(10)], want[i] * np.sign(sign), atol=1e-8)
        assert np.allclose([by[i][c + 1].explained for c in range(10)], e[:10] / e.sum(), rtol=1e-9)


def test_whitening_of_equal_deviations_and_missing_directions(spark):
    """A cube's corners: all eigenvalues are equal; two entries never vary, one copies another."""
    corners = [[float(a), float(b), float(c), 3.0, 3.0, float(a)] for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    got = _whitened(_embeddings(spark, list(enumerate(corners))))
    assert {g.component for g in got} == {1, 2, 3} and max(g.identity_error for g in got) < 1e-9
    assert sorted({round(g.explained, 9) for g in got}) == [0.25, 0.5]


def test_whitening_of_little_and_of_large_numbers(spark):
    assert _whitened(_embeddings(spark, [(1, [1.0, 2.0])])) == []
    assert _whitened(_embeddings(spark, [(i, [1.0, 2.0]) for i in range(5)])) == []
    assert _whitened(_embeddings(spark, [])) == [] and _whitened(_embeddings(spark, [(1, None), (2, [])])) == []
    v = [[1e6 * i, -1e6 + i * i] for i in range(10)]
    got = {(g.vec_id, g.component): g.deviation for g in _whitened(_embeddings(spark, list(enumerate(v)), "double"))}
    dev = brute_whitened(v)[1]
    assert all(got[i, 1] == dev[i] for i in range(10))
    with pytest.raises(Exception, match="deviation does not fit"):
        whitening.whiten(_embeddings(spark, [(i, [1e9 * i, 1.0]) for i in range(10)], "double")).collect()


# --------------------------------------------------------------------------- hard negatives
def brute_mined(rows, every, positives, negatives):
    """rows: (id, label, integer vector); anchors that occur more than once are mined once."""
    out = []
    for a in {(i, lab, tuple(x)) for i, lab, x in rows if i % every == 0}:
        s = sorted((-int(np.dot(np.array(x, object), np.array(a[2], object))), i, lab) for i, lab, x in rows if (i, lab, tuple(x)) != a)
        pos = [(i, -t) for t, i, lab in s if lab == a[1]][:positives]
        for p, ps in pos:
            neg = [(i, -t) for t, i, lab in s if lab != a[1] and 50 * ps <= -100 * t <= 95 * ps][:negatives]
            out += [(a[0], p, k + 1, i, ps, t) for k, (i, t) in enumerate(neg)]
    return sorted(out)


def _mined(df, **kw):
    out = hard_negatives.mine(df, **kw)
    assert out.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted(map(tuple, out.collect()))


def _labelled(spark, rows):
    return spark.createDataFrame([(1, i, v, lab, "s") for i, lab, v in rows], "block int, vec_id long, embedding array<double>, label int, anchor string").repartition(3)


@pytest.mark.parametrize("block_bytes", [1, 5 * 8 * 4, 4 << 20])
def test_hard_negatives_equal_brute_force(spark, block_bytes):
    r = random.Random(6)
    # few values: many ties, zero and negative scores; repeated ids with other vectors, repeated rows, repeated anchors
    rows = [(r.randint(-20, 60), r.randint(0, 2), [r.choice((-1.0, 0.0, 0.5, 1.0)) for _ in range(4)]) for _ in range(70)]
    rows += [(0, 1, [1.0, 0.5, 0.0, 0.0])] * 3 + [(0, 1, [0.0] * 4), (7, 1, [1.0, 0.5, 0.0, 0.0]), (7, 1, [1.0, 0.5, 0.0, 0.0])] + [(2 ** 62, 2, [1.0] * 4), (-(2 ** 62), 0, [1.0] * 4)]
    bad = [(10, None, [1.0] * 4), (20, 1, None), (30, 1, [1.0, None, 1.0, 1.0]), (40, 1, [float("nan")] * 4), (50, 1, [1.0] * 3), (None, 1, [1.0] * 4), (60, 1, [float("-inf")] * 4)]
    want = brute_mined([(i, lab, [math.floor(256 * c) for c in v]) for i, lab, v in rows], 10, 5, 3)
    assert len(want) > 50
    assert _mined(_labelled(spark, rows + bad), every=10, block_bytes=block_bytes) == want


def test_hard_negatives_of_other_sizes_and_without_anchors(spark):
    r = random.Random(2)
    rows = [(i, r.randint(0, 4), [r.uniform(-3e5, 3e5) for _ in range(6)]) for i in range(60)]
    whole = [(i, lab, [math.floor(256 * c) for c in v]) for i, lab, v in rows]
    assert _mined(_labelled(spark, rows), every=7, positives=2, negatives=6) == brute_mined(whole, 7, 2, 6)
    assert _mined(_labelled(spark, rows).where("vec_id % 50 <> 0")) == [] and _mined(_labelled(spark, rows).where("false")) == []
    assert _mined(_labelled(spark, [(0, 1, [1.0]), (1, 2, [1.0])])) == []  # no positive


def test_exact_products_of_large_integers():
    a = np.array([[1 << 30, -(1 << 29)]])
    assert hard_negatives.inner_products(a, a).tolist() == [[(1 << 60) + (1 << 58)]]
    with pytest.raises(ValueError):
        hard_negatives.inner_products(a * 2, a * 2)
    with pytest.raises(ValueError):
        vectors.scaled(np.array([1e30]), 256)


def test_windows_are_exact():
    for score in range(-50, 300):
        low, high = hard_negatives.window(score)
        assert [t for t in range(-400, 400) if 50 * score <= 100 * t <= 95 * score] == list(range(low, high + 1))


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_hard_negatives_as_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = sorted(db.execute(sql.HARD_NEGATIVES).fetchall())
    got = queries.queries()["op13_hard_negatives"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == want and want
