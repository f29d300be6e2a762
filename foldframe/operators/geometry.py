"""Geometry: residue contacts, backbone hydrogen bonds, distance bins, connected components.

Distance joins are never nested loops: points are put on a grid of cubes whose edge is the
cutoff, every point is copied into its 27 neighbour cells on one side, and the join is an
equi-join on (structure, cell) followed by the exact distance test. The number of partners of
a point is bounded by what fits in 27 cells of the cutoff's size, so the pair table grows
linearly with the number of points.
"""
from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.store import written

_OFFSETS = [list(o) for o in itertools.product((-1, 0, 1), repeat=3)]


def _cells(df: DataFrame, cutoff: float, prefix: str = "") -> DataFrame:
    return df.withColumn("_cx", F.floor(F.col(prefix + "x") / cutoff)).withColumn(
        "_cy", F.floor(F.col(prefix + "y") / cutoff)).withColumn("_cz", F.floor(F.col(prefix + "z") / cutoff))


def distance_join(left: DataFrame, right: DataFrame, keys, cutoff: float, inclusive: bool = True,
                  lsuffix: str = "_i", rsuffix: str = "_j") -> DataFrame:
    """All (left, right) point pairs of the same structure with distance ``<= cutoff``
    (``< cutoff`` when ``inclusive`` is false). Both sides need ``x, y, z``; other columns get suffixes."""
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    l = _cells(left, cutoff).select(*keys, "_cx", "_cy", "_cz", *[F.col(c).alias(c + lsuffix) for c in lcols])
    r = _cells(right, cutoff).select(*keys, "_cx", "_cy", "_cz", *[F.col(c).alias(c + rsuffix) for c in rcols])
    offs = F.array(*[F.array(*[F.lit(v) for v in o]) for o in _OFFSETS])
    r = r.select("*", F.explode(offs).alias("_o")).select(
        *keys, *[F.col(c + rsuffix) for c in rcols],
        (F.col("_cx") + F.col("_o")[0]).alias("_cx"), (F.col("_cy") + F.col("_o")[1]).alias("_cy"),
        (F.col("_cz") + F.col("_o")[2]).alias("_cz"))
    j = l.join(r, [*keys, "_cx", "_cy", "_cz"]).drop("_cx", "_cy", "_cz")
    dx = F.col("x" + lsuffix) - F.col("x" + rsuffix)
    dy = F.col("y" + lsuffix) - F.col("y" + rsuffix)
    dz = F.col("z" + lsuffix) - F.col("z" + rsuffix)
    d = F.sqrt(dx * dx + dy * dy + dz * dz)
    j = j.withColumn("dist", d)
    return j.where(F.col("dist") <= cutoff) if inclusive else j.where(F.col("dist") < cutoff)


def contacts(residues: DataFrame, keys, cutoff: float = 8.0, node: str = "resi") -> DataFrame:
    """Residue pairs (``i < j``) of one structure whose points are within ``cutoff`` (``<=``)."""
    pts = residues.select(*keys, node, "x", "y", "z")
    j = distance_join(pts, pts, keys, cutoff, inclusive=True)
    return j.where(F.col(node + "_i") < F.col(node + "_j")).select(
        *keys, F.col(node + "_i").alias("i"), F.col(node + "_j").alias("j"), "dist")


def hbonds(backbone: DataFrame, keys, cutoff: float = 3.5, min_sep: int = 3) -> DataFrame:
    """N-O pairs closer than ``cutoff`` (strict) whose residues are at least ``min_sep`` apart."""
    n = backbone.where(F.col("atom") == "N").select(*keys, "resi", "x", "y", "z")
    o = backbone.where(F.col("atom") == "O").select(*keys, "resi", "x", "y", "z")
    j = distance_join(n, o, keys, cutoff, inclusive=False, lsuffix="_n", rsuffix="_o")
    return j.where(F.abs(F.col("resi_n") - F.col("resi_o")) >= min_sep).select(*keys, "resi_n", "resi_o", "dist")


def bins(values: DataFrame, col: str, lo: float, hi: float, n: int, keys=()) -> DataFrame:
    """Histogram over ``n`` equal-width bins from ``lo`` to ``hi`` (lower edges), the last bin open
    to +inf; both edges exclusive, so a value on an edge is in no bin."""
    w = (hi - lo) / (n - 1)
    k = F.floor((F.col(col) - lo) / w)
    kk = F.least(k, F.lit(n - 1))
    lower = F.lit(lo) + kk * F.lit(w)
    upper = F.when(kk == n - 1, F.lit(float("inf"))).otherwise(F.lit(lo) + (kk + 1) * F.lit(w))
    ok = (F.col(col) > lower) & (F.col(col) < upper) & (k >= 0)
    b = values.where(ok).select(*keys, kk.cast("int").alias("bin"))
    return b.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))


def same_label_edges(edges: DataFrame, labels: DataFrame, keys, node: str = "resi", label: str = "domain_id") -> DataFrame:
    """Edges whose two ends carry the same nonzero label (the intersection of the contact graph with
    the same-domain graph, as a join rather than a materialised same-domain pair table)."""
    li = labels.select(*keys, F.col(node).alias("i"), F.col(label).alias("_li"))
    lj = labels.select(*keys, F.col(node).alias("j"), F.col(label).alias("_lj"))
    e = edges.join(li, [*keys, "i"]).join(lj, [*keys, "j"])
    return e.where((F.col("_li") == F.col("_lj")) & (F.col("_li") != 0)).drop("_li", "_lj")


#: Edges (both directions) of a structure that is solved in one group; larger ones are contracted by joins.
GROUP_EDGES = 1 << 22


def smallest_reachable(nodes: np.ndarray, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """For each node (sorted, distinct) the smallest node its edges lead to: union-find on arrays.

    Every root takes the smallest root next to it, then paths are halved until each node points at its root."""
    a, b = np.searchsorted(nodes, src), np.searchsorted(nodes, dst)
    root = np.arange(len(nodes))
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, up := root[root]):
            root = up
    return nodes[root]


def _grouped_components(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node, component`` by one union-find a structure; ends of edges that are no nodes are left out."""
    struct = T.StructType([*[nodes.schema[k] for k in keys], T.StructField("node", nodes.schema["node"].dataType), T.StructField("component", nodes.schema["node"].dataType)])
    schema = to_arrow_schema(struct)

    def run(n: pa.Table, e: pa.Table) -> pa.Table:
        ids = np.unique(n.column("node").to_numpy())
        src, dst = e.column("i").to_numpy(), e.column("j").to_numpy()
        known = np.isin(src, ids) & np.isin(dst, ids)
        comp = smallest_reachable(ids, src[known], dst[known])
        first = [pa.chunked_array([n.column(k).take(pa.array([0] * len(ids), pa.int64())).combine_chunks()]) for k in keys] if len(ids) else [n.column(k) for k in keys]
        return pa.Table.from_arrays([*first, pa.array(ids), pa.array(comp)], names=schema.names).cast(schema)

    return nodes.groupBy(*keys).cogroup(edges.groupBy(*keys)).applyInArrow(run, struct)


def _contracted_components(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """The same for structures of any size, by star contraction.

    A round connects, for each node, its larger neighbours to its smallest one (large star), then its smaller ones and
    itself to the smallest (small star); components keep being connected and become stars around their smallest node in
    about log(n) rounds. Each round is written to the checkpoint folder; the driver reads one row a round."""
    k = [F.col(c) for c in keys]
    ends = nodes.select(*keys, F.col("node").alias("v"))
    cur = edges.join(ends.withColumnRenamed("v", "i"), [*keys, "i"], "left_semi").join(ends.withColumnRenamed("v", "j"), [*keys, "j"], "left_semi")
    cur = written(cur.where("i <> j").select(*keys, F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).distinct(), "stars")
    before = None
    while True:
        both = cur.unionByName(cur.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(low, [*keys, "u"])
        small = small.where("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(*keys, "u", F.col("m").alias("v")))
        cur = written(small.where("u <> v").distinct(), "stars")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*k, "u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = cur.select(*keys, F.col("u").alias("node"), F.col("v").alias("_root"))
    return nodes.join(found, [*keys, "node"], "left").select(*keys, "node", F.coalesce("_root", "node").alias("component"))


def connected_components(nodes: DataFrame, edges: DataFrame, keys, node: str = "node", group_edges: int = GROUP_EDGES) -> DataFrame:
    """Component of every node = smallest node id reachable through ``edges`` (``i``, ``j``).

    Structures are solved side by side, each by one union-find over its edges, without a loop on the driver; only those
    with more than ``group_edges`` edges (or nodes), which would not fit a group, are contracted by joins. Both give the
    same components; nodes are never collected to the driver. Both inputs are read twice: pass written tables."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nodes = nodes.select(*keys, F.col(node).alias("node")).distinct()
    edges = edges.select(*keys, "i", "j")
    sizes = nodes.select(*keys, F.lit(1).alias("_n")).unionByName(edges.select(*keys, F.lit(1).alias("_n"))).groupBy(*keys).agg(F.sum("_n").alias("_n"))
    huge = written(sizes.where(F.col("_n") > group_edges).select(*keys), "huge-structures")
    if huge.limit(1).count() == 0:
        out = _grouped_components(nodes, edges, keys)
    else:
        part = [t.join(huge, keys, how) for how in ("left_anti", "left_semi") for t in (nodes, edges)]
        out = _grouped_components(*part[:2], keys).unionByName(_contracted_components(*part[2:], keys))
    return out.withColumnRenamed("node", node)


def number_components(comp: DataFrame, keys) -> DataFrame:
    """Components numbered 1..n per structure in order of their smallest node."""
    w = Window.partitionBy(*keys).orderBy("component")
    return comp.withColumn("new_id", F.dense_rank().over(w).cast("int"))


def split_domains(residues: DataFrame, edges: DataFrame, keys, node: str = "resi", label: str = "domain_id") -> DataFrame:
    """New domain ids from the connected components of (contact edges within one domain).

    Residues with label 0 get 0; a labelled residue without such an edge is its own component
    (the distance map's diagonal is a self edge)."""
    labelled = residues.where(F.col(label) != 0).select(*keys, F.col(node).alias("node"))
    comp = number_components(connected_components(labelled, edges, keys, "node"), keys)
    out = residues.join(comp.select(*keys, F.col("node").alias(node), "new_id"), [*keys, node], "left")
    return out.withColumn(label, F.coalesce("new_id", F.lit(0)).cast("int")).drop("new_id")
