"""Registered queries: contacts, hydrogen bonds, bins, domain-graph components (atoms x labels views)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry as G
from ..sources.store import written
from . import q_atoms as QA
from . import views as VW
from .registry import register

KEYS = ["sid", "chain"]
CUT = 8.0


def ca(spark, sf):
    return QA.clean_atoms(spark, sf).where(F.col("atom") == "CA").select(*KEYS, "resi", "x", "y", "z")


def residue_labels(spark, sf):
    """All clean CA residues with the label of the same (structure, residue number) from the label view; 0 without one."""
    lab = VW.labels_v(spark, sf).select("sid", "resi", "domain_id", "conf")
    labelled = ca(spark, sf).join(lab, ["sid", "resi"], "left").withColumn("domain_id", F.coalesce("domain_id", F.lit(0)))
    # read several times downstream (node list, contacts, edge labels): materialised once in the checkpoint folder
    return written(labelled, "residue-labels")


SQL_CA = QA.SQL_CLEAN + """,
ca AS (SELECT sid, chain, resi, x, y, z FROM clean WHERE atom = 'CA'),
cont AS (
  SELECT a.sid, a.chain, a.resi AS i, b.resi AS j,
         sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist
  FROM ca a JOIN ca b ON a.sid = b.sid AND a.chain = b.chain AND a.resi < b.resi)"""

SQL_LAB = SQL_CA + ",\n" + VW.SQL_LABELS_V + """,
rl AS (SELECT c.*, coalesce(l.domain_id, 0) AS domain_id, l.conf FROM ca c LEFT JOIN labels_v l ON c.sid = l.sid AND c.resi = l.resi),
sedges AS (
  SELECT e.sid, e.chain, e.i, e.j FROM cont e
  JOIN rl li ON li.sid = e.sid AND li.chain = e.chain AND li.resi = e.i
  JOIN rl lj ON lj.sid = e.sid AND lj.chain = e.chain AND lj.resi = e.j
  WHERE e.dist <= 8.0 AND li.domain_id = lj.domain_id AND li.domain_id <> 0)"""


@register("range_join_contacts", SQL_CA + """
SELECT sid, chain, i, j, dist FROM cont WHERE dist <= 8.0""")
def q_range_join_contacts(spark, sf):
    return G.contacts(ca(spark, sf), KEYS, CUT)


@register("range_join_hbonds", QA.SQL_CLEAN + """
SELECT n.sid, n.chain, n.resi AS resi_n, o.resi AS resi_o,
       sqrt((n.x - o.x) * (n.x - o.x) + (n.y - o.y) * (n.y - o.y) + (n.z - o.z) * (n.z - o.z)) AS dist
FROM clean n JOIN clean o ON n.sid = o.sid AND n.chain = o.chain AND n.atom = 'N' AND o.atom = 'O'
WHERE abs(n.resi - o.resi) >= 3
  AND sqrt((n.x - o.x) * (n.x - o.x) + (n.y - o.y) * (n.y - o.y) + (n.z - o.z) * (n.z - o.z)) < 3.5""")
def q_range_join_hbonds(spark, sf):
    return G.hbonds(QA.clean_atoms(spark, sf), KEYS)


@register("agg_distance_bins", VW.with_ctes(VW.SQL_ATOMS_V) + """,
edges AS (SELECT CAST(k AS INTEGER) AS bin, 10.0 * k AS lower,
                 CASE WHEN k = 9 THEN 'infinity'::DOUBLE ELSE 10.0 * (k + 1) END AS upper FROM range(10) t(k))
SELECT e.bin, CAST(count(*) AS BIGINT) AS count FROM atoms_v a JOIN edges e ON a.b > e.lower AND a.b < e.upper
GROUP BY e.bin""")
def q_agg_distance_bins(spark, sf):
    b = G.bins(VW.atoms_v(spark, sf), "b", 0.0, 90.0, 10)
    return b.select("bin", F.col("count").cast("long").alias("count"))


@register("join_labels_to_atoms", QA.SQL_CLEAN + ",\n" + VW.SQL_LABELS_V + """
SELECT c.sid, c.chain, c.resi, c.atom, coalesce(l.domain_id, 0) AS domain_id, l.conf
FROM clean c LEFT JOIN labels_v l ON c.sid = l.sid AND c.resi = l.resi""")
def q_join_labels_to_atoms(spark, sf):
    lab = VW.labels_v(spark, sf).select("sid", "resi", "domain_id", "conf")
    # an atom of a residue without a label row is in no domain (0)
    j = QA.clean_atoms(spark, sf).select(*KEYS, "resi", "atom").join(lab, ["sid", "resi"], "left")
    return j.withColumn("domain_id", F.coalesce("domain_id", F.lit(0)))


def domain_edges(res):
    """Contacts within a domain; only labelled residues can end up on such an edge, so contacts among them suffice."""
    labelled = res.where(F.col("domain_id") != 0)
    return G.same_label_edges(G.contacts(labelled.select(*KEYS, "resi", "x", "y", "z"), KEYS, CUT), labelled, KEYS)


@register("set_intersect_edges", SQL_LAB + """
SELECT sid, chain, i, j FROM sedges""")
def q_set_intersect_edges(spark, sf):
    return domain_edges(residue_labels(spark, sf)).select(*KEYS, "i", "j")


@register("graph_components", SQL_LAB + """,
nodes AS (SELECT sid, chain, resi FROM rl WHERE domain_id <> 0),
und AS (SELECT sid, chain, i AS a, j AS b FROM sedges UNION SELECT sid, chain, j, i FROM sedges),
reach AS (
  WITH RECURSIVE r(sid, chain, node, root) AS (
    SELECT sid, chain, resi, resi FROM nodes
    UNION
    SELECT r.sid, r.chain, u.b, r.root FROM r JOIN und u ON u.sid = r.sid AND u.chain = r.chain AND u.a = r.node)
  SELECT sid, chain, node, min(root) AS comp FROM r GROUP BY sid, chain, node),
num AS (SELECT sid, chain, node, dense_rank() OVER (PARTITION BY sid, chain ORDER BY comp) AS new_id FROM reach)
SELECT l.sid, l.chain, l.resi, CAST(coalesce(n.new_id, 0) AS INTEGER) AS domain_id
FROM rl l LEFT JOIN num n ON l.sid = n.sid AND l.chain = n.chain AND l.resi = n.node""")
def q_graph_components(spark, sf):
    res = residue_labels(spark, sf)
    return G.split_domains(res, written(domain_edges(res), "domain-edges"), KEYS).select(*KEYS, "resi", "domain_id")
