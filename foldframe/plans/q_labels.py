"""Registered queries: domain labels along a chain (runs, cleaning, ranges, summaries)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formats as FM
from ..functions import names as N
from ..operators import atoms as A
from ..operators import labels as L
from ..sources.store import written
from . import views as VW
from .registry import register

KEYS = ["sid"]
MIN_DOM = VW.VIEW_MIN_DOMAIN
MIN_FRAG = VW.VIEW_MIN_FRAGMENT
SHUFFLE_SEED = 7
CONF_MIN = 0.5
PLDDT_MIN = 50.0

W = "PARTITION BY sid ORDER BY pos"
ALL = "PARTITION BY sid"


# ----------------------------------------------------------------- SQL building blocks (DuckDB)
def sql_run_len(src: str, p: str) -> str:
    """CTEs ``{p}r2`` (run id) and ``{p}rl`` (run length, first run true length, later max(L-1,1))."""
    return f"""{p}r1 AS (SELECT *, CASE WHEN lag(domain_id) OVER ({W}) IS NULL OR lag(domain_id) OVER ({W}) <> domain_id
                              THEN 1 ELSE 0 END AS chg FROM {src}),
{p}r2 AS (SELECT * EXCLUDE (chg), sum(chg) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM {p}r1),
{p}r3 AS (SELECT *, count(*) OVER (PARTITION BY sid, run) AS n_run FROM {p}r2),
{p}rl AS (SELECT * EXCLUDE (n_run, run), CAST(CASE WHEN run = 1 THEN n_run ELSE greatest(n_run - 1, 1) END AS INTEGER) AS run_len
          FROM {p}r3)"""


def sql_absorb_small(src: str, p: str, min_size: int) -> str:
    return f"""{p}a1 AS (SELECT *, count(*) OVER (PARTITION BY sid, domain_id) AS tot, min(pos) OVER ({ALL}) AS p0 FROM {src}),
{p}as AS (SELECT * EXCLUDE (domain_id, tot, p0),
          CAST(last_value(CASE WHEN domain_id = 0 OR tot >= {min_size} OR pos = p0 THEN domain_id END IGNORE NULLS)
               OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS domain_id FROM {p}a1)"""


def sql_clean_short(src: str, p: str, t: int, internal: bool = True) -> str:
    """Terminal (and internal) cleaning of ``src``; result CTE ``{p}cs`` with ``domain_id, clean_error``."""
    s = sql_run_len(src, p) + f""",
{p}t1 AS (SELECT *, min(CASE WHEN run_len >= {t} OR domain_id = 0 THEN pos END) OVER ({ALL}) AS i_n,
                 max(pos) OVER ({ALL}) AS hi, min(pos) OVER ({ALL}) AS lo FROM {p}rl),
{p}t2 AS (SELECT *, max(CASE WHEN pos = i_n + 1 THEN domain_id END) OVER ({ALL}) AS nxt FROM {p}t1),
{p}t3 AS (SELECT *, coalesce(i_n < hi, false) AS ok_n,
                 CASE WHEN i_n < hi AND pos <= i_n THEN nxt ELSE domain_id END AS d1 FROM {p}t2),
{p}t4 AS (SELECT *, max(CASE WHEN run_len >= {t} OR d1 = 0 THEN pos END) OVER ({ALL}) AS j_c FROM {p}t3),
{p}t5 AS (SELECT *, max(CASE WHEN pos = j_c - 1 THEN d1 END) OVER ({ALL}) AS prv FROM {p}t4),
{p}t6 AS (SELECT *, ok_n AND coalesce(j_c > lo, false) AS ok_t,
                 CASE WHEN j_c > lo AND pos >= j_c THEN prv ELSE d1 END AS d2 FROM {p}t5),
{p}t7 AS (SELECT * EXCLUDE (i_n, hi, lo, nxt, ok_n, d1, j_c, prv, d2), domain_id AS orig,
                 CASE WHEN ok_t THEN d2 ELSE domain_id END AS lab FROM {p}t6)"""
    if not internal:
        return s + f""",
{p}cs AS (SELECT * EXCLUDE (orig, lab, ok_t, run_len, domain_id), CAST(lab AS INTEGER) AS domain_id, NOT ok_t AS clean_error FROM {p}t7)"""
    return s + f""",
{p}s1 AS (SELECT *, min(CASE WHEN run_len >= {t} THEN pos END) OVER ({ALL}) AS fl,
                 max(CASE WHEN run_len >= {t} THEN pos END) OVER ({ALL}) AS ll FROM {p}t7),
{p}s2 AS (SELECT *, coalesce(run_len < {t} AND pos > fl AND pos < ll, false) AS si FROM {p}s1),
{p}s3 AS (SELECT *,
   last_value(CASE WHEN NOT si THEN lab END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS llab,
   last_value(CASE WHEN NOT si THEN pos END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lpos,
   first_value(CASE WHEN NOT si THEN lab END IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rlab,
   first_value(CASE WHEN NOT si THEN pos END IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rpos
   FROM {p}s2),
{p}s4 AS (SELECT *, CASE WHEN si THEN CASE WHEN pos < (lpos + 1) + ((rpos - 1) - (lpos + 1)) // 2 THEN llab ELSE rlab END
                        ELSE lab END AS d3,
                 (NOT ok_t) OR fl IS NULL AS bad FROM {p}s3),
{p}cs AS (SELECT * EXCLUDE (orig, lab, ok_t, run_len, fl, ll, si, llab, lpos, rlab, rpos, d3, bad, domain_id),
          CAST(CASE WHEN bad THEN orig ELSE d3 END AS INTEGER) AS domain_id, bad AS clean_error FROM {p}s4)"""


def sql_clean_labels(src: str, p: str, min_dom: int, min_frag: int) -> str:
    """Result CTE ``{p}cl``: full cleaning, only for chains with more than one distinct label."""
    return f"""{p}m0 AS (SELECT *, count(DISTINCT domain_id) OVER ({ALL}) > 1 AS multi, domain_id AS orig0 FROM {src}),
""" + sql_absorb_small(f"{p}m0", p, min_dom) + ",\n" + sql_clean_short(f"{p}as", p, min_frag) + f""",
{p}cl AS (SELECT * EXCLUDE (domain_id, clean_error, multi, orig0),
          CAST(CASE WHEN multi THEN domain_id ELSE orig0 END AS INTEGER) AS domain_id,
          multi AND clean_error AS clean_error FROM {p}cs)"""


def sql_renumber(src: str, p: str) -> str:
    return f"""{p}n1 AS (SELECT *, min(pos) OVER (PARTITION BY sid, domain_id) AS first_pos, domain_id <> 0 AS nz FROM {src}),
{p}rn AS (SELECT * EXCLUDE (first_pos, nz, domain_id),
          CAST(CASE WHEN nz THEN dense_rank() OVER (PARTITION BY sid, nz ORDER BY first_pos) ELSE 0 END AS INTEGER) AS domain_id
          FROM {p}n1)"""


def sql_domain_strings(src: str, p: str) -> str:
    """``{p}ds(sid, domain_id, dom_str)`` and ``{p}rs(sid, dom_str)``."""
    return f"""{p}g1 AS (SELECT sid, domain_id, pos, resi,
                 resi - row_number() OVER (PARTITION BY sid, domain_id ORDER BY pos) AS isl FROM {src} WHERE domain_id <> 0),
{p}g2 AS (SELECT sid, domain_id, isl, min(pos) AS seg_pos, max(resi) AS b, count(*) AS n FROM {p}g1 GROUP BY sid, domain_id, isl),
{p}g3 AS (SELECT *, CASE WHEN n > 1 THEN CAST(b - n + 1 AS VARCHAR) || '-' || CAST(b AS VARCHAR)
                        ELSE CAST(b AS VARCHAR) END AS segment FROM {p}g2),
{p}ds AS (SELECT sid, domain_id, string_agg(segment, '_' ORDER BY seg_pos) AS dom_str FROM {p}g3 GROUP BY sid, domain_id),
{p}rs AS (SELECT sid, string_agg(dom_str, ',' ORDER BY
             list_transform(regexp_extract_all(dom_str, '(\\d+)', 1), lambda x: CAST(x AS BIGINT))) AS dom_str
          FROM {p}ds GROUP BY sid)"""


BASE = VW.with_ctes(VW.SQL_LABELS_V)
PIPE = BASE + ",\n" + sql_clean_labels("labels_v", "c_", MIN_DOM, MIN_FRAG) + ",\n" + sql_renumber("c_cl", "f_")


# ----------------------------------------------------------------- Spark side
def labels(spark, sf):
    return VW.labels_v(spark, sf)


def cleaned(spark, sf):
    """Clean then renumber: the labels every segmentation output is made from."""
    return L.renumber_first_seen(L.clean_labels(labels(spark, sf), KEYS, MIN_DOM, MIN_FRAG), KEYS)


def segmented(spark, sf):
    """The same, written once for outputs that read the labels more than once (summaries, statistics)."""
    return written(cleaned(spark, sf), "segmented")


@register("win_runs", BASE + ",\n" + sql_run_len("labels_v", "x_") + """
SELECT sid, pos, CAST(run AS BIGINT) AS run FROM x_r2""")
def q_win_runs(spark, sf):
    return L.runs(labels(spark, sf), KEYS).select("sid", "pos", F.col("run").cast("long").alias("run"))


@register("win_run_length", BASE + ",\n" + sql_run_len("labels_v", "x_") + """
SELECT sid, pos, run_len FROM x_rl""")
def q_win_run_length(spark, sf):
    return L.run_lengths(labels(spark, sf), KEYS).select("sid", "pos", "run_len")


@register("win_absorb_small_domains", BASE + ",\n" + sql_absorb_small("labels_v", "x_", MIN_DOM) + """
SELECT sid, pos, domain_id FROM x_as""")
def q_win_absorb_small_domains(spark, sf):
    return L.absorb_small_domains(labels(spark, sf), KEYS, MIN_DOM).select("sid", "pos", "domain_id")


@register("win_absorb_terminals", BASE + ",\n" + sql_clean_short("labels_v", "x_", MIN_FRAG, internal=False) + """
SELECT sid, pos, domain_id, clean_error FROM x_cs""")
def q_win_absorb_terminals(spark, sf):
    d = L.run_lengths(labels(spark, sf), KEYS)
    d = L.absorb_terminals(d, KEYS, MIN_FRAG)
    return d.select("sid", "pos", F.col("domain_id").cast("int").alias("domain_id"), "clean_error")


@register("win_split_internal", BASE + ",\n" + sql_clean_short("labels_v", "x_", MIN_FRAG) + """
SELECT sid, pos, domain_id, clean_error FROM x_cs""")
def q_win_split_internal(spark, sf):
    return L.clean_short_runs(labels(spark, sf), KEYS, MIN_FRAG).select("sid", "pos", "domain_id", "clean_error")


@register("win_clean_labels", BASE + ",\n" + sql_clean_labels("labels_v", "c_", MIN_DOM, MIN_FRAG) + """
SELECT sid, pos, domain_id, clean_error FROM c_cl""")
def q_win_clean_labels(spark, sf):
    return L.clean_labels(labels(spark, sf), KEYS, MIN_DOM, MIN_FRAG).select("sid", "pos", "domain_id", "clean_error")


@register("win_renumber_first_seen", BASE + ",\n" + sql_renumber("labels_v", "x_") + """
SELECT sid, pos, domain_id FROM x_rn""")
def q_win_renumber_first_seen(spark, sf):
    return L.renumber_first_seen(labels(spark, sf), KEYS).select("sid", "pos", "domain_id")


@register("win_shuffle_ids", BASE + f""",
ids AS (SELECT DISTINCT sid, domain_id FROM labels_v WHERE domain_id <> 0),
perm AS (SELECT sid, domain_id, row_number() OVER (PARTITION BY sid ORDER BY (domain_id * 2654435761 + {SHUFFLE_SEED}) % 4294967296, domain_id) AS new_id FROM ids)
SELECT l.sid, l.pos, CAST(coalesce(p.new_id, 0) AS INTEGER) AS domain_id
FROM labels_v l LEFT JOIN perm p ON l.sid = p.sid AND l.domain_id = p.domain_id""")
def q_win_shuffle_ids(spark, sf):
    return L.shuffle_ids(labels(spark, sf), KEYS, SHUFFLE_SEED).select("sid", "pos", "domain_id")


@register("win_range_string", PIPE + ",\n" + sql_domain_strings("f_rn", "g_") + """
SELECT sid, dom_str FROM g_rs""")
def q_win_range_string(spark, sf):
    return L.range_string(segmented(spark, sf), KEYS)


@register("agg_segment_summary", PIPE + ",\n" + sql_domain_strings("f_rn", "g_") + """,
agg AS (SELECT sid, count(*) AS nres, count(*) FILTER (WHERE domain_id <> 0) AS nres_domain,
               count(DISTINCT CASE WHEN domain_id <> 0 THEN domain_id END) AS ndom, avg(conf) AS conf FROM f_rn GROUP BY sid)
SELECT a.sid, CAST(a.nres AS BIGINT) AS nres, CAST(a.nres_domain AS BIGINT) AS nres_domain,
       CAST(a.nres - a.nres_domain AS BIGINT) AS nres_non_domain, CAST(a.ndom AS BIGINT) AS ndom, a.conf,
       coalesce(r.dom_str, '') AS dom_str
FROM agg a LEFT JOIN g_rs r ON a.sid = r.sid""")
def q_agg_segment_summary(spark, sf):
    s = L.segment_summary(segmented(spark, sf), KEYS)
    return s.select("sid", *[F.col(c).cast("long").alias(c) for c in ("nres", "nres_domain", "nres_non_domain", "ndom")],
                    "conf", "dom_str")


SQL_DOMAIN_STATS = PIPE + ",\n" + sql_domain_strings("f_rn", "g_") + """,
st AS (SELECT sid, domain_id, count(*) AS nres, avg(conf) AS dom_conf, avg(b) AS dom_plddt,
              string_agg(CASE resn """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in A.RESIDUE_LETTERS.items()) + """ ELSE 'X' END, '' ORDER BY pos) AS seq
       FROM f_rn WHERE domain_id <> 0 GROUP BY sid, domain_id),
dst AS (SELECT s.*, dense_rank() OVER (PARTITION BY s.sid ORDER BY s.domain_id) AS domain_no, g.dom_str
        FROM st s JOIN g_ds g ON s.sid = g.sid AND s.domain_id = g.domain_id)"""


def domain_table(spark, sf):
    d = segmented(spark, sf).withColumn("aa", A.residue_letter("resn"))
    return L.domain_stats(d, KEYS)


@register("agg_domain_stats", SQL_DOMAIN_STATS + """
SELECT sid, domain_id, CAST(domain_no AS BIGINT) AS domain_no, CAST(nres AS BIGINT) AS nres, dom_conf, dom_plddt, seq, dom_str
FROM dst""")
def q_agg_domain_stats(spark, sf):
    d = domain_table(spark, sf)
    return d.select("sid", "domain_id", F.col("domain_no").cast("long").alias("domain_no"), F.col("nres").cast("long").alias("nres"),
                    "dom_conf", "dom_plddt", "seq", "dom_str")


@register("filter_domain_quality", SQL_DOMAIN_STATS + f"""
SELECT sid, domain_id FROM dst WHERE dom_conf >= {CONF_MIN} AND dom_plddt >= {PLDDT_MIN}""")
def q_filter_domain_quality(spark, sf):
    return L.quality_filter(domain_table(spark, sf), CONF_MIN, PLDDT_MIN).select("sid", "domain_id")


@register("fn_domain_name", SQL_DOMAIN_STATS + """
SELECT sid, domain_id, 'S' || lpad(CAST(sid AS VARCHAR), 6, '0') || '_' || lpad(CAST(domain_no AS VARCHAR), 2, '0') AS name FROM dst""")
def q_fn_domain_name(spark, sf):
    d = domain_table(spark, sf)
    base = F.concat(F.lit("S"), F.lpad(F.col("sid").cast("string"), 6, "0"))
    return d.select("sid", "domain_id", N.domain_name(base, "domain_no").alias("name"))


@register("sink_domain_lines", SQL_DOMAIN_STATS + """
SELECT 'S' || lpad(CAST(sid AS VARCHAR), 6, '0') || chr(9) || CAST(domain_no AS VARCHAR) || chr(9)
       || CAST(nres AS VARCHAR) || chr(9) || printf('%.3f', dom_conf) || chr(9) || printf('%.3f', dom_plddt) || chr(9)
       || CAST(domain_id AS VARCHAR) || chr(9) || dom_str AS line
FROM dst WHERE dom_conf >= """ + f"{CONF_MIN} AND dom_plddt >= {PLDDT_MIN}")
def q_sink_domain_lines(spark, sf):
    from ..operators import sinks as SK

    d = L.quality_filter(domain_table(spark, sf), CONF_MIN, PLDDT_MIN).withColumn("name", F.concat(F.lit("S"), F.lpad(F.col("sid").cast("string"), 6, "0")))
    return SK.roundtrip_text(spark, d.select(SK.domain_line(d).alias("line")), "domain_lines")


@register("agg_domain_sizes", BASE + f"""
SELECT sid, domain_id, CAST(count(*) AS BIGINT) AS size, count(*) < {MIN_DOM} AS small
FROM labels_v WHERE domain_id <> 0 GROUP BY sid, domain_id""")
def q_agg_domain_sizes(spark, sf):
    d = L.domain_sizes(labels(spark, sf), KEYS, min_size=MIN_DOM)
    return d.select("sid", "domain_id", F.col("size").cast("long").alias("size"), "small")


@register("agg_pair_confidence", PIPE + """
SELECT sid, domain_id, CAST(count(*) * count(*) AS BIGINT) AS n_pairs, sum(sqrt(conf)) * sum(sqrt(conf)) AS pair_sum,
       (sum(sqrt(conf)) * sum(sqrt(conf))) / (count(*) * count(*)) AS pair_mean
FROM f_rn WHERE domain_id <> 0 GROUP BY sid, domain_id""")
def q_agg_pair_confidence(spark, sf):
    """Sum over same-domain residue pairs of sqrt(conf_i * conf_j) = (sum sqrt conf)^2: an aggregate, no pair table."""
    d = cleaned(spark, sf).where(F.col("domain_id") != 0)
    g = d.groupBy("sid", "domain_id").agg(F.sum(F.sqrt("conf")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return g.select("sid", "domain_id", (F.col("_n") * F.col("_n")).cast("long").alias("n_pairs"),
                    (F.col("_s") * F.col("_s")).alias("pair_sum"), (F.col("_s") * F.col("_s") / (F.col("_n") * F.col("_n"))).alias("pair_mean"))


@register("agg_argmax_label", """
WITH s AS (SELECT l_orderkey AS rid, l_linenumber - 1 AS cls, max(l_quantity) AS score,
                  max(CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 1 ELSE 0 END) AS bg FROM lineitem GROUP BY 1, 2),
b AS (SELECT rid, arg_max(cls, score * 1000 - cls) AS best, max(bg) AS bg FROM s GROUP BY rid)
SELECT rid, CAST(CASE WHEN bg = 1 THEN 0 ELSE best END AS INTEGER) AS label FROM b""")
def q_agg_argmax_label(spark, sf):
    """Class with the highest score per residue (ties: smaller class); 0 where the background score, a flag on a row of the
    residue, says so."""
    li = VW.table(spark, sf, "lineitem")
    s = li.select(F.col("l_orderkey").alias("rid"), (F.col("l_linenumber") - 1).alias("class"), F.col("l_quantity").alias("score"),
                  ((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "A")).alias("background"))
    return L.argmax_label(s, ["rid"]).select("rid", F.col("label").cast("int").alias("label"))
