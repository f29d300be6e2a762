"""Grid-cell distance joins and components against brute force."""
import random

import numpy as np

from foldframe.operators import geometry as G


def test_contacts_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    pts = {}
    for sid in range(3):
        xyz = rng.uniform(-20, 20, size=(80, 3))
        for i, (x, y, z) in enumerate(xyz):
            rows.append((sid, i, float(x), float(y), float(z)))
            pts[(sid, i)] = np.array([x, y, z])
    df = spark.createDataFrame(rows, "sid long, resi int, x double, y double, z double")
    got = {(r["sid"], r["i"], r["j"]) for r in G.contacts(df, ["sid"], 8.0).collect()}
    exp = {(s, i, j) for (s, i) in pts for (s2, j) in pts if s == s2 and i < j and np.linalg.norm(pts[(s, i)] - pts[(s, j)]) <= 8.0}
    assert got == exp


def test_hbonds_strict_and_separation(spark):
    rows = [(0, 1, "N", 0.0, 0.0, 0.0), (0, 5, "O", 3.0, 0.0, 0.0), (0, 2, "O", 1.0, 0.0, 0.0), (0, 9, "O", 3.5, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "sid long, resi int, atom string, x double, y double, z double")
    got = {(r["resi_n"], r["resi_o"]) for r in G.hbonds(df, ["sid"]).collect()}
    assert got == {(1, 5)}  # 2 is too close in sequence, 9 sits on the (exclusive) cutoff


def test_bins_exclusive_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 5.0, 10.0, 15.0, 89.0, 90.0, 95.0, 1000.0, -1.0]], "v double")
    got = {r["bin"]: r["count"] for r in G.bins(df, "v", 0.0, 90.0, 10).collect()}
    assert got == {0: 1, 1: 1, 8: 1, 9: 2}


def _union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}


def test_components_equal_union_find(spark):
    rnd = random.Random(4)
    rows_n, rows_e, exp = [], [], {}
    for sid in range(4):
        nodes = list(range(40))
        edges = [(a, b) for a, b in ((rnd.randrange(40), rnd.randrange(40)) for _ in range(30)) if a < b]
        exp[sid] = _union_find(nodes, edges)
        rows_n += [(sid, n) for n in nodes]
        rows_e += [(sid, a, b) for a, b in edges]
    n = spark.createDataFrame(rows_n, "sid long, node int")
    e = spark.createDataFrame(rows_e, "sid long, i int, j int")
    e = e.unionByName(spark.createDataFrame([(0, 3, 99), (9, 1, 2)], e.schema))  # ends that are no nodes
    for limit in (G.GROUP_EDGES, 71, 1):  # all in groups, some and all contracted by joins
        got = {(r["sid"], r["node"]): r["component"] for r in G.connected_components(n, e, ["sid"], "node", group_edges=limit).collect()}
        assert got == {(s, k): v for s in exp for k, v in exp[s].items()}, limit


def test_split_domains_zero_and_singletons(spark):
    res = spark.createDataFrame([(0, 1, 1), (0, 2, 1), (0, 3, 0), (0, 4, 1)], "sid long, resi int, domain_id int")
    edges = spark.createDataFrame([(0, 1, 2)], "sid long, i int, j int")
    got = {r["resi"]: r["domain_id"] for r in G.split_domains(res, edges, ["sid"]).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 2}
