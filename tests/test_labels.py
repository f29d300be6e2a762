"""Label cleaning against a sequential specification written from the rules (R3-R6)."""
import random
from collections import Counter

from pyspark.sql import functions as F

from foldframe.operators import labels as L


# ---------------------------------------------------------------- sequential specification
def spec_runs(lab):
    runs, i = [], 0
    while i < len(lab):
        j = i
        while j + 1 < len(lab) and lab[j + 1] == lab[i]:
            j += 1
        runs.append((i, j))
        i = j + 1
    return runs


def spec_run_lengths(lab, exact=False):
    out = [0] * len(lab)
    for k, (s, e) in enumerate(spec_runs(lab)):
        n = e - s + 1
        v = n if (exact or k == 0) else max(n - 1, 1)
        for p in range(s, e + 1):
            out[p] = v
    return out


def spec_absorb_small(lab, min_size):
    counts = Counter(x for x in lab if x != 0)
    small = {x for x, c in counts.items() if c < min_size}
    out = list(lab)
    for i in range(1, len(lab)):
        if lab[i] in small:
            out[i] = out[i - 1]
    return out


def spec_terminals(lab, counts, t):
    n = len(lab)
    d = list(lab)
    i = next((p for p in range(n) if counts[p] >= t or d[p] == 0), None)
    if i is None or i == n - 1:
        return None
    d[: i + 1] = [d[i + 1]] * (i + 1)
    j = next((p for p in range(n - 1, -1, -1) if counts[p] >= t or d[p] == 0), None)
    if j is None or j == 0:
        return None
    d[j:] = [d[j - 1]] * (n - j)
    return d


def spec_internal(lab, counts, t):
    n = len(lab)
    long_pos = [p for p in range(n) if counts[p] >= t]
    if not long_pos:
        return None
    fl, ll = long_pos[0], long_pos[-1]
    short = [p for p in range(n) if counts[p] < t and fl < p < ll]
    out = list(lab)
    groups = []
    for p in short:
        if groups and groups[-1][-1] == p - 1:
            groups[-1].append(p)
        else:
            groups.append([p])
    for g in groups:
        s, e = g[0], g[-1]
        mid = s + (e - s) // 2
        for p in range(s, mid):
            out[p] = lab[s - 1]
        for p in range(mid, e + 1):
            out[p] = lab[e + 1]
    return out


def spec_clean(lab, min_dom, min_frag):
    if len(set(lab)) <= 1:
        return list(lab), False
    a = spec_absorb_small(lab, min_dom)
    counts = spec_run_lengths(a)
    t = spec_terminals(a, counts, min_frag)
    if t is None:
        return a, True
    r = spec_internal(t, counts, min_frag)
    if r is None:
        return a, True
    return r, False


def random_chain(rng):
    n = rng.randint(1, 60)
    lab = []
    while len(lab) < n:
        lab += [rng.choice([0, 1, 2, 3, 4])] * rng.randint(1, 8)
    return lab[:n]


def chains_df(spark, chains):
    rows = [(sid, p, p + 1, int(v)) for sid, lab in enumerate(chains) for p, v in enumerate(lab)]
    return spark.createDataFrame(rows, "sid long, pos int, resi int, domain_id int")


def collect_chains(df, n, col="domain_id"):
    out = [[] for _ in range(n)]
    for r in df.orderBy("sid", "pos").select("sid", col).collect():
        out[r["sid"]].append(r[col])
    return out


def test_run_lengths_off_by_one(spark):
    chains = [[1, 1, 1, 1, 1, 1, 5, 5, 5, 5, 5, 2, 2, 2, 2, 2], [3], [1, 2, 2, 3]]
    got = collect_chains(L.run_lengths(chains_df(spark, chains), ["sid"]), len(chains), "run_len")
    assert got[0] == [6] * 6 + [4] * 10
    assert got == [spec_run_lengths(c) for c in chains]
    exact = collect_chains(L.run_lengths(chains_df(spark, chains), ["sid"], exact=True), len(chains), "run_len")
    assert exact[0] == [6] * 6 + [5] * 10


def test_clean_labels_matches_spec(spark):
    rng = random.Random(11)
    chains = [random_chain(rng) for _ in range(300)]
    # hand cases: only zeros, one domain, short run at each end, two short runs side by side,
    # a small domain at position 0 and after a 0 stretch, a chain with no long run
    chains += [[0] * 10, [1] * 12, [2, 1, 1, 1, 1, 1, 1, 1], [1] * 8 + [2], [1] * 6 + [2, 3] + [1] * 6,
               [1] * 6 + [2, 3, 4] + [1] * 6, [5, 5] + [1] * 8, [1] * 8 + [0, 0, 0] + [7, 7] + [1] * 8, [1, 2, 1, 2, 1, 2]]
    for min_dom, min_frag in [(6, 3), (4, 2), (10, 5)]:
        df = L.clean_labels(chains_df(spark, chains), ["sid"], min_dom, min_frag)
        got = collect_chains(df, len(chains))
        err = collect_chains(df, len(chains), "clean_error")
        for i, c in enumerate(chains):
            exp, bad = spec_clean(c, min_dom, min_frag)
            assert got[i] == exp, (min_dom, min_frag, c)
            assert all(e == bad for e in err[i]), (c, bad)


def test_renumber_and_range_string_golden(spark):
    # 2xdqA: residues 6-459 with 163-191 absent; runs re-typed from the published index file
    runs = [(6, 18, 1), (19, 156, 2), (157, 162, 3), (192, 295, 3), (296, 459, 1)]
    rows, pos = [], 0
    for a, b, d in runs:
        for r in range(a, b + 1):
            rows.append((0, pos, r, d, 1.0, 90.0))
            pos += 1
    df = spark.createDataFrame(rows, "sid long, pos int, resi int, domain_id int, conf double, b double")
    assert len(rows) == 425
    rs = L.range_string(L.renumber_first_seen(df, ["sid"]), ["sid"]).first()["dom_str"]
    assert rs == "6-18_296-459,19-156,157-162_192-295"
    summ = L.segment_summary(df, ["sid"]).first()
    assert (summ["nres"], summ["nres_domain"], summ["nres_non_domain"], summ["ndom"]) == (425, 425, 0, 3)
    sizes = {r["domain_id"]: r["nres"] for r in L.domain_stats(df.withColumn("aa", F.lit("A")), ["sid"]).collect()}
    assert sorted(sizes.values()) == [110, 138, 177]


def test_renumber_first_seen(spark):
    df = chains_df(spark, [[0, 7, 7, 3, 0, 7, 9]])
    assert collect_chains(L.renumber_first_seen(df, ["sid"]), 1)[0] == [0, 1, 1, 2, 0, 1, 3]


def test_shuffle_ids_is_a_repeatable_permutation(spark):
    df = chains_df(spark, [[0, 1, 1, 2, 3, 3, 0]])
    a = collect_chains(L.shuffle_ids(df, ["sid"], 5), 1)[0]
    b = collect_chains(L.shuffle_ids(df, ["sid"], 5), 1)[0]
    assert a == b and a[0] == 0 and a[-1] == 0 and sorted(set(a) - {0}) == [1, 2, 3]


def test_quality_filter_four_cases(spark):
    d = spark.createDataFrame([(1, 0.9, 80.0), (2, 0.4, 90.0), (3, 0.8, 40.0)], "domain_id int, dom_conf double, dom_plddt double")
    ids = lambda df: sorted(r[0] for r in df.select("domain_id").collect())
    assert ids(L.quality_filter(d)) == [1, 2, 3]
    assert ids(L.quality_filter(d, conf_min=0.5)) == [1, 3]
    assert ids(L.quality_filter(d, plddt_min=50)) == [1, 2]
    assert ids(L.quality_filter(d, 0.5, 50)) == [1]


def test_iterate_resegment_halves_large_domains(spark):
    lab = [0] + [1] * 24 + [2] * 6
    df = chains_df(spark, [lab])
    out = L.renumber_first_seen(L.iterate_resegment(df, ["sid"], L.halving_segmenter, 5), ["sid"])
    got = collect_chains(out, 1)[0]
    # 1 (from position 1): 12 | 0 | 11; 12 (from 1): 6 | 0 | 5; 11 (from 14): 5 | 0 | 5; 6 (from 1): 3 | 0 | 2; 2 starts at 25: whole
    assert got == [0, *[1] * 3, 0, *[2] * 2, 0, *[3] * 5, 0, *[4] * 5, 0, *[5] * 5, *[6] * 6]


def _parts(spark, table, **kw):
    """A segmenter that looks its answers up, and a count of its calls."""
    calls = []

    def segmenter(df, keys):
        calls.append(sorted({r["domain_id"] for r in df.select("domain_id").collect()}))
        answer = spark.createDataFrame([(k, *v) for k, v in table.items()], "key string, sub int, conf double")
        d = df.withColumn("key", F.concat_ws("@", "domain_id", F.col("pos").cast("string")))
        return d.drop("conf").join(answer, "key", "left").select(*keys, "pos", "sub", "conf")

    return segmenter, calls


def test_resegment_without_domain_and_with_new_confidences(spark):
    """Half of a domain comes back without a part: it gets label 0 and the new confidence; a domain that comes back whole
    keeps label and confidence and is never asked again; only parts of the last round are sent on."""
    rows = [(0, p, p, 1 if p < 8 else 2, 0.5) for p in range(16)]
    df = spark.createDataFrame(rows, "sid int, pos int, resi int, domain_id int, conf double")
    table = {f"1@{p}": (0 if p < 2 else 1 if p < 3 else 2, 0.25 * (p >= 2)) for p in range(8)} | {f"2@{p}": (5, 0.9) for p in range(8, 16)}
    table |= {f"1/2@{p}": (0, 0.0) for p in range(3, 8)}
    segmenter, calls = _parts(spark, table)
    got = {r["pos"]: (r["domain_id"], r["conf"]) for r in L.iterate_resegment(df, ["sid"], segmenter, 4).collect()}
    assert calls == [["1", "2"], ["1/2"]]  # round 3 has nothing to do
    assert {p for p, v in got.items() if v[0] == 0} == {0, 1, 3, 4, 5, 6, 7} and got[0] == (0, 0.0) and got[2][1] == 0.25
    assert len({v[0] for v in got.values()} - {0}) == 2 and {got[p][1] for p in range(8, 16)} == {0.5}
    short = df.where("pos < 8")
    assert L.iterate_resegment(short, ["sid"], segmenter, 4).where("domain_id = 0").count() == 0  # chain not longer than twice the average


def test_sequence_codes_and_one_hot(spark):
    from foldframe.operators import atoms as A

    df = spark.createDataFrame([("ARNV",), ("XB-.",), ("",), ("A?~V",), (None,)], "s string").coalesce(1)
    got = [r["c"] for r in df.select(A.encode_sequence("s").alias("c")).collect()]
    assert got == [[0, 1, 2, 19], [20, 20, 21, 21], [], [0, None, None, 19], None]
    hot = [r["h"] for r in df.select(A.one_hot(A.encode_sequence("s")).alias("h")).collect()]
    assert hot[:2] == [[1, 2, 4, 1 << 19], [0, 0, 0, 0]]


def test_mean_pool_is_one_vector_a_group(spark):
    from foldframe.operators import summary as SU

    rows = [("a", [1.0, 2.0, 3.0]), ("a", [2.0, 4.0, 0.5]), ("b", [0.1, 0.2, 0.3]), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v array<double>")
    got = {r["g"]: (r["n"], r["pooled"]) for r in SU.mean_pool(df.repartition(3), ["g"], "v").collect()}
    assert got["a"] == (2, [1.5, 3.0, 1.75]) and got["b"][0] == 1 and all(abs(x - y) < 1e-11 for x, y in zip(got["b"][1], [0.1, 0.2, 0.3]))


def test_background_sets_the_label_to_zero(spark):
    df = spark.createDataFrame([(1, 2, 0.9, False), (1, 3, 0.1, True), (2, 2, 0.5, False), (2, 1, 0.5, False)], "r int, class int, score double, background boolean")
    assert {r["r"]: r["label"] for r in L.argmax_label(df, ["r"]).collect()} == {1: 0, 2: 1}
    assert {r["r"]: r["label"] for r in L.argmax_label(df, ["r"], background=None).collect()} == {1: 2, 2: 1}


def test_domains_expand_to_residue_lists(spark):
    from foldframe.operators import boundaries as BD

    have = [("x", i) for i in (1, 2, 4, 5, 6, 9, 10, 20)] + [("y", 3)]
    res = spark.createDataFrame(have, "sid string, resi int")
    ranges = spark.createDataFrame([("x", 1, 1, 3, 7), ("x", 1, 2, 9, 10), ("x", 2, 1, 7, 3), ("x", 3, 1, 12, 15), ("x", 4, 1, 1, 2), ("x", 4, 2, 9, 30), ("y", 1, 1, 1, 5)],
                                   "sid string, dom int, seg int, first int, last int")
    got = {(r["sid"], r["dom"]): tuple(r)[2:] for r in BD.expand_domains(ranges, res, ["sid"]).select(
        "sid", "dom", "status", "residues", "n_present", "first", "last", "first_idx", "last_idx").collect()}
    assert got["x", 1] == ("ok", [4, 5, 6, 9, 10], 5, 4, 10, 2, 6)
    assert got["x", 2] == ("first_not_below_last", None, None, None, None, None, None)
    assert got["x", 3][0] == "start_not_found" and got["x", 4][0] == "end_not_found"
    assert got["y", 1] == ("ok", [3], 1, 3, 3, 0, 0)
