"""Registered queries: vector search, ranking, hit filters, metadata, class counts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import EMPTY_METADATA
from ..functions import names as N
from ..functions import vectors as V
from ..operators import search as S
from ..operators import summary as SU
from . import views as VW
from .registry import register

# Parameters for the embedding view: distinct vectors reach cosine ~0.5 at most.
K = 20
MINCOS = 0.2
MINCOV = 0.7


def _queries(spark, sf):
    return VW.queries_v(spark, sf)


def _targets(spark, sf):
    return VW.targets_v(spark, sf)


def _r(c):
    """Output doubles are not rounded: rounding at a decimal tie can differ between engines."""
    return F.col(c) if isinstance(c, str) else c


SQL_SCORES = VW.with_ctes(VW.SQL_TARGETS_V, VW.SQL_QUERIES_V, """scores AS (
  SELECT q.qid, t.dbindex, q.q_len, t.length AS t_len,
         list_dot_product(CAST(q.q_embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[]))
         / (sqrt(list_dot_product(CAST(q.q_embedding AS DOUBLE[]), CAST(q.q_embedding AS DOUBLE[])))
            * sqrt(list_dot_product(CAST(t.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])))) AS raw
  FROM queries_v q JOIN targets_v t ON q.qid <> t.dbindex)""")

SQL_TOPK_RAW = SQL_SCORES + f""", ranked AS (
  SELECT qid, dbindex, raw AS score,
         row_number() OVER (PARTITION BY qid ORDER BY round(raw, 4) DESC, dbindex) - 1 AS emb_rank
  FROM scores)
SELECT qid, dbindex, CAST(emb_rank AS BIGINT) AS emb_rank, score AS emb_score FROM ranked WHERE emb_rank < {K}"""

SQL_MASKED_HITS = SQL_SCORES + f""", masked AS (
  SELECT qid, dbindex, q_len, t_len, CASE WHEN q_len >= t_len * {MINCOV} THEN raw ELSE 0.0 END AS score FROM scores),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 4) DESC, dbindex) - 1 AS emb_rank FROM masked),
hits AS (SELECT * FROM ranked WHERE emb_rank < {K} AND round(score, 4) >= {MINCOS})
"""


def masked_hits(spark, sf, **opts):
    """The single-path search: mask by length, top-k, then the cosine threshold."""
    hits = S.vector_search(_queries(spark, sf), _targets(spark, sf), K, mincov=MINCOV, exclude_self=True, min_score=MINCOS, **opts)
    return S.filter_min_cosine(hits, MINCOS)


@register("fn_cosine", VW.with_ctes(VW.SQL_TARGETS_V) + """
SELECT a.dbindex,
       list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
             / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
                * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))) AS cosine,
       list_dot_product(
             list_transform(CAST(a.embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))),
             list_transform(CAST(b.embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))) AS normalized_dot
FROM targets_v a JOIN targets_v b ON b.dbindex = a.dbindex + 1""")
def q_fn_cosine(spark, sf):
    t = _targets(spark, sf).select("dbindex", "embedding")
    nxt = t.select((F.col("dbindex") - 1).alias("dbindex"), F.col("embedding").alias("next_embedding"))
    j = t.join(nxt, "dbindex")
    return j.select(
        "dbindex",
        _r(V.cosine("embedding", "next_embedding")).alias("cosine"),
        _r(V.dot(V.l2_normalize("embedding"), V.l2_normalize("next_embedding"))).alias("normalized_dot"),
    )


@register("join_vector_search", SQL_SCORES + f"""
SELECT qid, dbindex, raw AS score FROM scores WHERE round(raw, 4) >= {MINCOS}""")
def q_join_vector_search(spark, sf):
    pairs = S.threshold_join(_queries(spark, sf), _targets(spark, sf), MINCOS, exclude_self=True)
    return pairs.select("qid", "dbindex", _r("score").alias("score"))


@register("win_topk", SQL_TOPK_RAW)
def q_win_topk(spark, sf):
    hits = S.vector_search(_queries(spark, sf), _targets(spark, sf), K, exclude_self=True)
    return hits.select("qid", "dbindex", "emb_rank", _r("score").alias("emb_score"))


@register("limit_blocked_topk", SQL_TOPK_RAW)
def q_limit_blocked_topk(spark, sf):
    # blocks of 128: many pivots and many blocks of queries, whose best rows are merged
    hits = S.vector_search(_queries(spark, sf), _targets(spark, sf), K, exclude_self=True, query_block_rows=128, target_block_rows=128)
    return hits.select("qid", "dbindex", "emb_rank", _r("score").alias("emb_score"))


@register("mask_length_coverage", SQL_SCORES + f""", masked AS (
  SELECT qid, dbindex, CASE WHEN q_len >= t_len * {MINCOV} THEN raw ELSE 0.0 END AS score FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 4) DESC, dbindex) - 1 AS emb_rank FROM masked)
SELECT qid, dbindex, CAST(emb_rank AS BIGINT) AS emb_rank, score AS emb_score FROM ranked WHERE emb_rank < {K}""")
def q_mask_length_coverage(spark, sf):
    hits = S.vector_search(_queries(spark, sf), _targets(spark, sf), K, mincov=MINCOV, exclude_self=True)
    return hits.select("qid", "dbindex", "emb_rank", _r("score").alias("emb_score"))


@register("filter_min_cosine", SQL_MASKED_HITS + """
SELECT qid, dbindex, CAST(emb_rank AS BIGINT) AS emb_rank, score AS emb_score FROM hits""")
def q_filter_min_cosine(spark, sf):
    return masked_hits(spark, sf).select("qid", "dbindex", "emb_rank", _r("score").alias("emb_score"))


@register("win_rank_kept", SQL_MASKED_HITS + """
SELECT qid, dbindex, CAST(emb_rank AS BIGINT) AS emb_rank,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY round(score, 4) DESC, dbindex) - 1 AS BIGINT) AS kept_rank
FROM hits""")
def q_win_rank_kept(spark, sf):
    return S.rank_kept(masked_hits(spark, sf)).select("qid", "dbindex", "emb_rank", "kept_rank")


@register("join_metadata", SQL_MASKED_HITS + f"""
SELECT h.qid, h.dbindex, CAST(h.emb_rank AS BIGINT) AS emb_rank, coalesce(t.metadata, '{EMPTY_METADATA}') AS metadata
FROM hits h LEFT JOIN targets_v t ON h.dbindex = t.dbindex""")
def q_join_metadata(spark, sf):
    hits = S.join_metadata(masked_hits(spark, sf), _targets(spark, sf))
    return hits.select("qid", "dbindex", "emb_rank", "metadata")


SQL_PAYLOAD = """payload AS (
  SELECT t.dbindex, t.name, regexp_replace(d.text, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS seq
  FROM targets_v t LEFT JOIN documents d ON t.dbindex = d.doc_id)"""


@register("join_target_payload", SQL_MASKED_HITS + ", " + SQL_PAYLOAD + """
SELECT h.qid, h.dbindex, replace(p.name, '.pdb', '') AS target,
       CAST(length(p.seq) AS DOUBLE) AS t_seq_len, md5(p.seq) AS t_seq_md5
FROM hits h LEFT JOIN payload p ON h.dbindex = p.dbindex""")
def q_join_target_payload(spark, sf):
    docs = VW.table(spark, sf, "documents").select(F.col("doc_id").alias("dbindex"), "text")
    payload = _targets(spark, sf).select("dbindex", "name").join(docs, "dbindex", "left").select(
        "dbindex", "name", F.regexp_replace("text", "[^ACDEFGHIKLMNPQRSTVWY]", "").alias("seq"))
    hits = S.join_payload(masked_hits(spark, sf).select("qid", "dbindex"), payload)
    return hits.select("qid", "dbindex", N.base_name("name").alias("target"),
                       F.length("seq").cast("double").alias("t_seq_len"), F.md5("seq").alias("t_seq_md5"))


@register("agg_class_counts", SQL_MASKED_HITS + f"""
SELECT q.query_chain, json_extract_string(coalesce(t.metadata, '{EMPTY_METADATA}'), '$.cath') AS cath_id,
       CAST(count(*) AS BIGINT) AS count
FROM hits h JOIN queries_v q ON h.qid = q.qid LEFT JOIN targets_v t ON h.dbindex = t.dbindex
GROUP BY 1, 2""")
def q_agg_class_counts(spark, sf):
    hits = S.join_metadata(masked_hits(spark, sf), _targets(spark, sf))
    hits = hits.join(_queries(spark, sf).select("qid", "query_chain"), "qid")
    return SU.class_counts(hits, "query_chain")


@register("agg_mean_plddt", SQL_MASKED_HITS + """
SELECT q.query_chain, coalesce(avg(h.plddt), 0.0) AS mean_plddt, CAST(count(h.qid) AS BIGINT) AS n_hits
FROM (SELECT DISTINCT query_chain FROM queries_v) q
LEFT JOIN (SELECT hits.qid, qv.query_chain, (qv.q_len % 1000) / 8.0 AS plddt
           FROM hits JOIN queries_v qv ON hits.qid = qv.qid) h ON q.query_chain = h.query_chain
GROUP BY 1""")
def q_agg_mean_plddt(spark, sf):
    qv = _queries(spark, sf)
    hits = masked_hits(spark, sf).join(qv.select("qid", "query_chain", ((F.col("q_len") % 1000) / 8.0).alias("plddt")), "qid")
    structures = qv.select("query_chain").distinct()
    return SU.mean_plddt(structures, hits, "query_chain").select(
        "query_chain", _r("mean_plddt").alias("mean_plddt"), "n_hits")
