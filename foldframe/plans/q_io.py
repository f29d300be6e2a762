"""Registered queries: sources, sinks, field projection, text functions, slots, re-segmentation."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EMPTY_METADATA, HIT_FIELDS
from ..functions import formats as FM
from ..functions import names as N
from ..functions import text as TX
from ..operators import boundaries as BD
from ..operators import indexing as IX
from ..operators import labels as L
from ..operators import search as S
from ..operators import sinks as SK
from ..operators import slots as SL
from ..operators import staging as SG
from ..session import scratch_path
from ..sources import bundles as BN
from ..sources import reports as RP
from ..sources import structures as ST
from ..sources.store import written
from . import q_atoms as QA
from . import q_chains as QC
from . import q_labels as QL
from . import q_search as QS
from . import views as VW
from .registry import register

ALPHABET = "ACDEFGHIKLMNPQRSTVWY"
STAGE_BAD = 97          # every file whose number leaves 13 cannot be read at the first attempt
STAGE_BATCH = 16        # view-sized batches (the original's default is 500, see constants)
COMPACT_MB = 0.05       # view-sized bundles (the original's default is 128 MB)
FILE_STATS_MB = 0.5
SIG_MINTM = 0.25
RESEG_AVG = 10          # view-sized average domain (the original's default is 200)


def _seq(col="text"):
    return F.regexp_replace(F.col(col), f"[^{ALPHABET}]", "")


def _sql_seq(col="text"):
    return f"regexp_replace({col}, '[^{ALPHABET}]', '', 'g')"


def _sql_counts(expr):
    return " || ',' || ".join(f"CAST(strlen({expr}) - strlen(replace({expr}, '{c}', '')) AS VARCHAR)" for c in ALPHABET)


# ------------------------------------------------------------------ sources
@register("src_structures", VW.with_ctes(VW.SQL_PAGES_V) + """
SELECT file_id,
       CASE WHEN ends_with(string_split(path, '/')[-1], '.pdb') THEN string_split(path, '/')[-1]
            ELSE string_split(path, '/')[-1] || '.pdb' END AS file_name,
       regexp_replace(string_split(path, '/')[-1], '\\.pdb$', '') AS structure_id,
       string_split(path, '/')[-2] AS organism
FROM pages_v""")
def q_src_structures(spark, sf):
    p = ST.name_structures(VW.pages_v(spark, sf).select("file_id", "path"))
    return p.select("file_id", "file_name", "structure_id", "organism")


@register("src_first_model", """
WITH c AS (SELECT conv_id, string_agg(CASE WHEN role = 'assistant' THEN text || chr(10) || 'ENDMDL' ELSE text END, chr(10)
                                      ORDER BY turn) AS content FROM conversations GROUP BY conv_id),
l AS (SELECT conv_id, string_split(content, chr(10)) AS lines FROM c),
p AS (SELECT conv_id, lines, list_position(list_transform(lines, lambda x: starts_with(x, 'END')), true) AS idx FROM l),
f AS (SELECT conv_id, CASE WHEN idx IS NOT NULL THEN lines[1:idx - 1] ELSE lines END AS first FROM p)
SELECT conv_id, CAST(len(first) AS BIGINT) AS n_lines, md5(array_to_string(first, chr(10))) AS first_model_md5 FROM f""")
def q_src_first_model(spark, sf):
    """Conversations as files: one line block per turn, an ``ENDMDL`` record after each assistant
    turn; only the lines before the first ``END*`` record count."""
    cv = VW.table(spark, sf, "conversations")
    piece = F.when(F.col("role") == "assistant", F.concat(F.col("text"), F.lit("\nENDMDL"))).otherwise(F.col("text"))
    files = cv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("_t")).select(
        "conv_id", F.array_join(F.transform("_t", lambda x: x["p"]), "\n").alias("content"))
    first = ST.first_model_lines("content")
    return files.select("conv_id", F.size(first).cast("long").alias("n_lines"),
                        F.md5(F.array_join(first, "\n")).alias("first_model_md5"))


HITS_TSV_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                                ["query", "dom_str", "dom_conf", "dom_plddt", "emb_rank", "target", "emb_score", "q_len", "t_len",
                                 "ali_len", "seq_id", "q_tm", "t_tm", "max_tm", "rmsd", "metadata"]])


def aligned_hits(spark, sf):
    """Single-path search hits with the stand-in aligner's scores and every field of the hit table."""
    hits = QS.masked_hits(spark, sf)
    q = VW.queries_v(spark, sf).select("qid", "query", "dom_str", "dom_conf", "dom_plddt", "q_embedding")
    t = VW.targets_v(spark, sf).select("dbindex", N.base_name("name").alias("target"), F.col("embedding").alias("t_embedding"),
                                       "metadata")
    pairs = hits.join(q, "qid").join(t, "dbindex")
    keep = ["qid", "dbindex", "emb_rank", "score", "q_len", "t_len", "query", "dom_str", "dom_conf", "dom_plddt", "target", "metadata"]
    schema = ("qid long, dbindex long, emb_rank long, score double, q_len int, t_len int, query string, dom_str string, "
              "dom_conf double, dom_plddt double, target string, metadata string, " + SL.ALIGNMENT_SCHEMA)
    scored = SL.pair_scores(pairs, SL.cosine_scorer_arrow(keep=keep), schema, arrow=True)
    return scored.withColumn("metadata", F.coalesce("metadata", F.lit(EMPTY_METADATA)))


SQL_ALIGNED = QS.SQL_MASKED_HITS + """,
al AS (
  SELECT h.qid, h.dbindex, h.emb_rank, h.score, h.q_len, h.t_len, q.query, q.dom_str, q.dom_conf, q.dom_plddt,
         replace(t.name, '.pdb', '') AS target, coalesce(t.metadata, '{ }') AS metadata,
         round(list_dot_product(CAST(q.q_embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[]))
           / (sqrt(list_dot_product(CAST(q.q_embedding AS DOUBLE[]), CAST(q.q_embedding AS DOUBLE[])))
              * sqrt(list_dot_product(CAST(t.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])))), 4) AS tm
  FROM hits h JOIN queries_v q ON h.qid = q.qid JOIN targets_v t ON h.dbindex = t.dbindex),
al2 AS (SELECT *, CAST(floor(CAST(least(q_len, t_len) AS DOUBLE) * tm * 2) AS INTEGER) AS len_ali, 0.0 AS rmsd, 1.0 AS seq_id,
               tm AS qtm, tm AS ttm FROM al)"""

SQL_HIT_TEXT = """
SELECT query, dom_str, printf('%.4f', dom_conf) AS dom_conf, printf('%.4f', dom_plddt) AS dom_plddt,
       CAST(emb_rank AS VARCHAR) AS emb_rank, target, printf('%.4f', score) AS emb_score, CAST(q_len AS VARCHAR) AS q_len,
       CAST(t_len AS VARCHAR) AS t_len, CAST(len_ali AS VARCHAR) AS ali_len, printf('%.4f', seq_id) AS seq_id,
       printf('%.4f', qtm) AS q_tm, printf('%.4f', ttm) AS t_tm, printf('%.4f', greatest(qtm, ttm)) AS max_tm,
       printf('%.2f', rmsd) AS rmsd, metadata
FROM al2"""


def written_hits(spark, sf):
    h = aligned_hits(spark, sf)
    return SK.roundtrip_csv(spark, h.select(*SK.hit_columns(h, HIT_FIELDS)), "hits", sep="\t")


@register("sink_hits_tsv", SQL_ALIGNED + SQL_HIT_TEXT)
def q_sink_hits_tsv(spark, sf):
    return written_hits(spark, sf)


@register("src_hits_tsv", SQL_ALIGNED + """
SELECT query, CAST(emb_rank AS INTEGER) AS emb_rank, target, CAST(printf('%.4f', score) AS DOUBLE) AS emb_score,
       q_len, t_len, len_ali AS ali_len, CAST(printf('%.4f', greatest(qtm, ttm)) AS DOUBLE) AS max_tm, metadata FROM al2""")
def q_src_hits_tsv(spark, sf):
    h = aligned_hits(spark, sf)
    path = scratch_path(spark, "hits_tsv")
    h.select(*SK.hit_columns(h, HIT_FIELDS)).write.mode("overwrite").option("sep", "\t").option("header", True) \
        .option("quote", "").csv(path)
    typed = T.StructType([T.StructField(f.name, {"emb_rank": T.IntegerType(), "q_len": T.IntegerType(), "t_len": T.IntegerType(),
                                                 "ali_len": T.IntegerType(), "emb_score": T.DoubleType(),
                                                 "max_tm": T.DoubleType()}.get(f.name, T.StringType())) for f in HITS_TSV_SCHEMA])
    r = RP.read_hits_tsv(spark, path, typed)
    return r.select("query", "emb_rank", "target", "emb_score", "q_len", "t_len", "ali_len", "max_tm", "metadata")


@register("project_output_fields", SQL_ALIGNED + """
SELECT query, target, CAST(emb_rank AS VARCHAR) AS emb_rank, printf('%.4f', score) AS emb_score,
       printf('%.4f', greatest(qtm, ttm)) AS max_tm, metadata FROM al2""")
def q_project_output_fields(spark, sf):
    h = aligned_hits(spark, sf)
    return h.select(*SK.hit_columns(h, "query,target,emb_rank,emb_score,max_tm,metadata"))


@register("filter_aligned_coverage", SQL_ALIGNED + f"""
SELECT qid, dbindex, len_ali, t_len FROM al2 WHERE len_ali >= t_len * {QS.MINCOV}""")
def q_filter_aligned_coverage(spark, sf):
    return S.aligned_coverage(aligned_hits(spark, sf), QS.MINCOV).select("qid", "dbindex", "len_ali", "t_len")


@register("split_significant", SQL_ALIGNED + f""",
fl AS (SELECT qid, dbindex, emb_rank, greatest(qtm, ttm) AS max_tm, greatest(qtm, ttm) >= {SIG_MINTM} AS significant FROM al2),
ins AS (SELECT qid, dbindex, row_number() OVER (ORDER BY qid, emb_rank) - 1 AS insig_no FROM fl WHERE NOT significant)
SELECT f.qid, f.dbindex, f.max_tm, f.significant, CAST(i.insig_no AS DOUBLE) AS insig_no
FROM fl f LEFT JOIN ins i ON f.qid = i.qid AND f.dbindex = i.dbindex""")
def q_split_significant(spark, sf):
    """Significant / insignificant routing, with the batch path's global counter of insignificant hits."""
    # the flagged hits are read twice (to number the insignificant ones, and to join the numbers): written once
    hits = S.split_significant(aligned_hits(spark, sf), SIG_MINTM).select("qid", "dbindex", "emb_rank", "max_tm", "significant")
    flagged = S.number_insignificant(written(hits, "flagged-hits"))
    return flagged.select("qid", "dbindex", "max_tm", "significant", F.col("insig_no").cast("double").alias("insig_no"))


# ------------------------------------------------------------------ sinks
@register("sink_segment_tsv", QL.PIPE + ",\n" + QL.sql_domain_strings("f_rn", "g_") + """,
agg AS (SELECT sid, count(*) AS nres, count(*) FILTER (WHERE domain_id <> 0) AS nres_domain,
               count(DISTINCT CASE WHEN domain_id <> 0 THEN domain_id END) AS ndom, avg(conf) AS conf FROM f_rn GROUP BY sid)
SELECT 'S' || lpad(CAST(a.sid AS VARCHAR), 6, '0') AS filename, CAST(a.nres AS VARCHAR) AS nres,
       CAST(a.nres_domain AS VARCHAR) AS nres_dom, CAST(a.nres - a.nres_domain AS VARCHAR) AS nres_ndr,
       CAST(a.ndom AS VARCHAR) AS ndom, printf('%.4f', a.conf) AS pIoU, CAST(NULL AS VARCHAR) AS runtime,
       coalesce(r.dom_str, '') AS result
FROM agg a LEFT JOIN g_rs r ON a.sid = r.sid""")
def q_sink_segment_tsv(spark, sf):
    s = L.segment_summary(QL.segmented(spark, sf), QL.KEYS)
    s = s.withColumn("filename", F.concat(F.lit("S"), F.lpad(F.col("sid").cast("string"), 6, "0")))
    cols = F.split(SK.segment_line(s), "\t")
    out = s.select(*[cols[i].alias(n) for i, n in enumerate(SK.segment_header().split("\t"))])
    return SK.roundtrip_csv(spark, out, "segments", sep="\t")


@register("sink_chain_match_tsv", QC.SQL_PATHS + """
SELECT query_chain, CAST(nqd AS VARCHAR) AS nqd, chain AS hit_chain, CAST(nhd AS VARCHAR) AS nhd,
       CAST(match_category AS VARCHAR) AS match_category, array_to_string(info, ',') AS match_info,
       '[' || array_to_string(meta, ',') || ']' AS hit_metadata FROM cat""")
def q_sink_chain_match_tsv(spark, sf):
    m = QC.chain_matches(spark, sf).withColumnRenamed("chain", "hit_chain")
    out = m.select(*[F.col(c).cast("string").alias(c) for c in ["query_chain", "nqd", "hit_chain", "nhd", "match_category",
                                                                 "match_info", "hit_metadata"]])
    return SK.roundtrip_csv(spark, out, "chain_matches", sep="\t")


@register("sink_metadata_json", QS.SQL_MASKED_HITS + """
SELECT CAST(json(t.metadata) AS VARCHAR) AS line FROM hits h JOIN targets_v t ON h.dbindex = t.dbindex
WHERE t.metadata IS NOT NULL AND t.metadata <> '{ }'""")
def q_sink_metadata_json(spark, sf):
    """The metadata of all hits that have some, as one JSON array in the order of the hits, read back value by value."""
    hits = SK.with_metadata(S.join_metadata(QS.masked_hits(spark, sf), VW.targets_v(spark, sf)))
    path = scratch_path(spark, "hit-metadata")
    SK.write_json_array(hits.select("qid", "emb_rank", SK.metadata_json("metadata").alias("line")), path, ["qid", "emb_rank"])
    return SK.read_json_array(spark, path)


@register("sink_atom_records", QA.SQL_CLEAN + ",\n" + VW.SQL_LABELS_V + """,
recs AS (
  SELECT 'S' || lpad(CAST(c.sid AS VARCHAR), 6, '0') AS name, row_number() OVER (PARTITION BY c.sid ORDER BY c.chain, c.resi, c.serial) AS ord,
         printf('ATOM  %5d  %-4s%s %-1s%4d    %8.3f%8.3f%8.3f%6.2f%6d', c.serial, c.atom, c.resn, c.chain, c.resi,
                c.x, c.y, c.z, CAST(coalesce(l.domain_id, 0) AS DOUBLE), CAST(trunc(c.b) AS BIGINT)) AS line
  FROM clean c LEFT JOIN labels_v l ON c.sid = l.sid AND c.resi = l.resi
  UNION ALL
  SELECT 'S' || lpad(CAST(sid AS VARCHAR), 6, '0') || '_' || chain, n,
         printf('ATOM  %5d  CA  %3s A%4d    %8.3f%8.3f%8.3f  1.00  0.00', n, resn, n, x, y, z)
  FROM (SELECT *, row_number() OVER (PARTITION BY sid, chain ORDER BY resi) AS n FROM clean WHERE atom = 'CA'))
SELECT name, CAST(ord AS INTEGER) AS ord, line FROM recs UNION ALL SELECT name, CAST(max(ord) + 1 AS INTEGER), 'END' FROM recs GROUP BY name""")
def q_sink_atom_records(spark, sf):
    """Each structure's atoms with the residue's domain id in the occupancy column and a truncated integer b-factor, and
    each chain's CA-only form, in a bundled store; read back structure by structure, in record order."""
    lab = VW.labels_v(spark, sf).select("sid", "resi", "domain_id")
    a = QA.clean_atoms(spark, sf).join(lab, ["sid", "resi"], "left").withColumn("domain_id", F.coalesce("domain_id", F.lit(0)))
    a = written(a, "labelled-atoms")  # read by both forms
    name = F.concat(F.lit("S"), F.lpad(F.col("sid").cast("string"), 6, "0"))
    full = SK.atom_lines(a, ["sid"], ["chain", "resi", "serial"], occ_col="domain_id").select(name.alias("name"), "ord", "line")
    ca = SK.ca_lines(a.where(F.col("atom") == "CA"), QA.KEYS).select(F.concat_ws("_", name, "chain").alias("name"), "ord", "line")
    path = scratch_path(spark, "atom-records")
    BN.write_bundles(written(full.unionByName(ca), "atom-lines"), path, "name", ["ord"])
    back = BN.read_bundles(spark, path, "name")
    return back.select("name", F.posexplode("lines").alias("ord", "line")).withColumn("ord", F.col("ord") + 1)


@register("sink_fasta", QA.SQL_CLEAN + f""",
sq AS (SELECT sid, chain, string_agg({QA._letters_case} ELSE 'X' END, '' ORDER BY resi) AS seq FROM clean WHERE atom = 'CA'
       GROUP BY sid, chain)
SELECT '>S' || lpad(CAST(sid AS VARCHAR), 6, '0') || '_' || chain AS line FROM sq UNION ALL SELECT seq FROM sq""")
def q_sink_fasta(spark, sf):
    from ..operators import atoms as A

    ca = QA.clean_atoms(spark, sf).where(F.col("atom") == "CA").withColumn("aa", A.residue_letter("resn"))
    sq = A.ordered_sequence(ca, QA.KEYS).withColumn(
        "name", F.concat(F.lit("S"), F.lpad(F.col("sid").cast("string"), 6, "0"), F.lit("_"), F.col("chain")))
    return SK.roundtrip_text(spark, sq.select(SK.fasta_text(sq, "name", "seq").alias("line")), "fasta")


@register("sink_residue_index", QL.PIPE + """
SELECT string_agg(CAST(resi AS VARCHAR) || ':' || CAST(domain_id AS VARCHAR), ',' ORDER BY pos) AS line FROM f_rn GROUP BY sid""")
def q_sink_residue_index(spark, sf):
    idx = SK.residue_index_line(QL.cleaned(spark, sf), QL.KEYS)
    return SK.roundtrip_text(spark, idx.select("line"), "residue_index")


@register("sink_object_store", """
WITH o AS (SELECT page_id, lower(replace(regexp_extract(url, '^[a-z]+://(.*)/[^/]*$', 1), '/', '-')) AS bucket,
                  'data/' || string_split(url, '/')[-1] AS object_key, html FROM pages)
SELECT bucket, object_key, CAST(length(arg_max(coalesce(html, ''), page_id)) AS BIGINT) AS n_chars, md5(arg_max(coalesce(html, ''), page_id)) AS content_md5
FROM o GROUP BY bucket, object_key""")
def q_sink_object_store(spark, sf):
    """Pages copied to a store by the name rules (a page with the name of an earlier one replaces it) and read back; the
    store's path is the setting ``foldframe.object.store``, a scratch folder where it is unset."""
    p = VW.table(spark, sf, "pages")
    folder = F.regexp_extract("url", r"^[a-z]+://(.*)/[^/]*$", 1)
    objects = p.select("page_id", N.bucket_name(folder).alias("bucket"), F.concat(F.lit("data/"), N.file_name("url")).alias("object_key"), F.col("html").alias("content"))
    base = spark.conf.get("foldframe.object.store", None) or scratch_path(spark, "object-store")
    SK.copy_to_store(objects, base, "page_id")
    return SK.read_store(spark, base).select("bucket", "object_key", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("content_md5"))


SQL_TARGET_BUILD = VW.with_ctes(VW.SQL_FILES_V) + f""",
s AS (SELECT path, substr({_sql_seq('content')}, 1, 2000) AS seq FROM files_v),
k AS (SELECT path, seq, row_number() OVER (ORDER BY path) - 1 AS dbindex FROM s WHERE length(seq) > 0)"""


def built_targets(spark, sf):
    """Target database from structure files: sorted by file name, residues cut to 2000, empty
    ones skipped, embedded by the model slot, numbered densely (no single-task window)."""
    f = VW.files_v(spark, sf).select("path", F.substring(_seq("content"), 1, 2000).alias("seq")).where(F.length("seq") > 0)
    f = IX.dense_index(f, ["path"]).withColumn("dbindex", F.col("rn") - 1).drop("rn")
    emb = SL.batch_model(f, SL.composition_model(keep=("dbindex", "path", "seq")),
                         "dbindex long, path string, seq string, embedding array<float>")
    t = emb.select("dbindex", F.col("path").alias("name"), "seq", F.length("seq").cast("int").alias("length"), "embedding")
    path = scratch_path(spark, "targets")
    t.write.mode("overwrite").parquet(path)
    return RP.read_targets(spark, path)


def _counts_from_embedding():
    return F.array_join(F.transform("embedding", lambda x: F.round(x * F.col("length")).cast("int").cast("string")), ",")


@register("sink_targets", SQL_TARGET_BUILD + f"""
SELECT CAST(dbindex AS BIGINT) AS dbindex, path AS name, CAST(length(seq) AS INTEGER) AS length, {_sql_counts('seq')} AS composition
FROM k""")
def q_sink_targets(spark, sf):
    t = built_targets(spark, sf)
    return t.select("dbindex", "name", "length", _counts_from_embedding().alias("composition"))


@register("src_targets", VW.with_ctes(VW.SQL_TARGETS_V) + """
SELECT dbindex, name, length, coalesce(metadata, '{ }') AS metadata FROM targets_v""")
def q_src_targets(spark, sf):
    path = scratch_path(spark, "targets_v")
    VW.targets_v(spark, sf).select("dbindex", "name", "embedding", "length", "metadata").write.mode("overwrite").parquet(path)
    return RP.read_targets(spark, path).select("dbindex", "name", "length", "metadata")


@register("udf_batch_model", f"""
SELECT doc_id, CAST(length({_sql_seq()}) AS INTEGER) AS length, {_sql_counts(_sql_seq())} AS composition FROM documents""")
def q_udf_batch_model(spark, sf):
    """The model slot over whole documents: one model load per task, Arrow batches."""
    d = VW.table(spark, sf, "documents").select("doc_id", _seq().alias("seq"))
    emb = SL.batch_model(d, SL.composition_model(keep=("doc_id", "seq")), "doc_id long, seq string, embedding array<float>")
    emb = emb.withColumn("length", F.length("seq").cast("int"))
    return emb.select("doc_id", "length", _counts_from_embedding().alias("composition"))


def _residue_count(texts):
    """Residue letters of each text of a batch; a text without any is an error."""
    n = texts.fillna("").str.count(f"[{ALPHABET}]")
    if (n == 0).any():
        raise ValueError("no residues")
    return n.astype(float)


@register("udf_error_rows", f"""
SELECT doc_id, CASE WHEN length({_sql_seq()}) > 0 THEN CAST(length({_sql_seq()}) AS DOUBLE) END AS result,
       CASE WHEN length({_sql_seq()}) > 0 THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN length({_sql_seq()}) > 0 THEN NULL ELSE 'ValueError: no residues' END AS error
FROM documents""")
def q_udf_error_rows(spark, sf):
    d = VW.table(spark, sf, "documents").select("doc_id", "text")
    r = SL.error_rows(d, _residue_count, "text", "double", policy="collect")
    return r.select("doc_id", "result", "status", "error")


@register("sink_batch_stage", VW.with_ctes(VW.SQL_FILES_V) + f"""
, b AS (SELECT file_id, organism, CAST((row_number() OVER (PARTITION BY organism ORDER BY path) - 1) // {STAGE_BATCH} AS BIGINT) AS batch
        FROM files_v)
SELECT file_id, organism, batch,
       CAST(1 + max(CASE WHEN file_id % {STAGE_BAD} = 13 THEN 1 ELSE 0 END) OVER (PARTITION BY organism, batch) AS INTEGER) AS attempt
FROM b""")
def q_sink_batch_stage(spark, sf):
    """Files staged in batches per organism. Some files cannot be read at the first attempt: their batches are recorded as
    failed and the others are staged; the second attempt, with those files repaired, stages what the first left out."""
    files = VW.files_v(spark, sf)
    f = IX.dense_index(files.select("file_id", "path", "organism"), ["path"], ["organism"])
    f = f.withColumn("batch", F.floor((F.col("rn") - 1) / STAGE_BATCH).cast("long")).select("file_id", "organism", "batch")
    f = written(f.join(files.select("file_id", "content"), "file_id"), "batched-files")
    path = scratch_path(spark, "staged")
    SG.stage_batches(f, path, F.when(F.col("file_id") % STAGE_BAD == 13, F.lit("file cannot be read")))
    SG.stage_batches(f, path, F.lit(None).cast("string"))
    return SG.read_staged(spark, path).select("file_id", "organism", "batch", "attempt")


SQL_COMPACT = VW.with_ctes(VW.SQL_FILES_V) + f""",
st AS (SELECT organism, sum(size) AS total_bytes, count(*) AS n_files,
              greatest(1, CAST(ceil(sum(size) / (1024.0 * 1024.0) / {COMPACT_MB}) AS BIGINT)) AS partitions
       FROM files_v GROUP BY organism),
st2 AS (SELECT *, CAST(ceil(n_files / partitions) AS BIGINT) AS files_per_partition FROM st)"""


@register("sink_compact", SQL_COMPACT + """
, pl AS (SELECT f.file_id, f.organism, f.path, coalesce(f.content, '') AS content,
                CAST((row_number() OVER (PARTITION BY f.organism ORDER BY f.path) - 1) // s.files_per_partition AS BIGINT) AS bucket
         FROM files_v f JOIN st2 s ON f.organism = s.organism)
SELECT file_id, organism, bucket, md5(string_agg(content || chr(10), '' ORDER BY path) OVER (PARTITION BY organism, bucket
       ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS bundle_md5 FROM pl""")
def q_sink_compact(spark, sf):
    """Bundle small files: bucket by name order, one output file per bucket (each content and a newline); the bundles are
    read back, and each file comes with the digest of the bundle it went into."""
    files = VW.files_v(spark, sf)
    f = files.select("file_id", "path", "organism", "size")  # the contents are joined once, for writing
    plan = SK.compaction_plan(f, COMPACT_MB, group_cols=("organism",))
    f = IX.dense_index(f, ["path"], ["organism"]).join(plan.select("organism", "files_per_partition"), "organism")
    f = f.withColumn("bucket", F.floor((F.col("rn") - 1) / F.col("files_per_partition")).cast("long"))
    f = written(f.select("file_id", "organism", "bucket", "rn"), "bundle-plan")
    path = scratch_path(spark, "compact")
    # a bucket is one file: its rows go to one partition, in order; the writer ends each with a newline
    (f.join(files.select("file_id", "content"), "file_id")
      .repartition("organism", "bucket").sortWithinPartitions("organism", "bucket", "rn")
      .select("organism", "bucket", F.coalesce("content", F.lit("")).alias("value"))
      .write.mode("overwrite").partitionBy("organism", "bucket").text(path))
    back = spark.read.text(path, wholetext=True)
    if "bucket" not in back.columns:  # nothing was written
        back = back.withColumns({"organism": F.lit(None), "bucket": F.lit(None)})
    return f.select("file_id", "organism", "bucket").join(
        back.select(F.col("organism").cast("string").alias("organism"), F.col("bucket").cast("long").alias("bucket"), F.md5(F.col("value").cast("binary")).alias("bundle_md5")), ["organism", "bucket"])


@register("agg_file_stats", VW.with_ctes(VW.SQL_PAGES_V) + f"""
SELECT CAST(sum(size) AS BIGINT) AS total_bytes, CAST(count(*) AS BIGINT) AS n_files,
       greatest(1, CAST(ceil(sum(size) / (1024.0 * 1024.0) / {FILE_STATS_MB}) AS BIGINT)) AS partitions,
       CAST(ceil(count(*) / greatest(1, CAST(ceil(sum(size) / (1024.0 * 1024.0) / {FILE_STATS_MB}) AS BIGINT))) AS BIGINT)
         AS files_per_partition
FROM pages_v""")
def q_agg_file_stats(spark, sf):
    st = SK.compaction_plan(VW.pages_v(spark, sf), FILE_STATS_MB)
    return st.select(F.col("total_bytes").cast("long").alias("total_bytes"), F.col("n_files").cast("long").alias("n_files"),
                     F.col("partitions").cast("long").alias("partitions"),
                     F.col("files_per_partition").cast("long").alias("files_per_partition"))


# ------------------------------------------------------------------ names and text functions
@register("fn_base_name", VW.with_ctes(VW.SQL_FILES_V) + """
SELECT file_id, replace(string_split(path, '/')[-1], '.pdb', '') AS base_name FROM files_v""")
def q_fn_base_name(spark, sf):
    return VW.files_v(spark, sf).select("file_id", N.base_name("path").alias("base_name"))


@register("fn_metadata_json", """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def q_fn_metadata_json(spark, sf):
    from ..operators import summary as SU

    return VW.table(spark, sf, "events").select("event_id", SU.metadata_value("props", "k").alias("k"))


SQL_RANGES = """
WITH r AS (
  SELECT p_partkey,
         CASE p_partkey % 4
           WHEN 0 THEN CAST(p_size AS VARCHAR) || '-' || CAST(p_size + p_partkey % 50 AS VARCHAR)
           WHEN 1 THEN '-' || CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 5 AS VARCHAR)
           WHEN 2 THEN '-' || CAST(p_size + 5 AS VARCHAR) || '--' || CAST(p_size AS VARCHAR)
           ELSE '(' || CAST(p_size AS VARCHAR) || 'A)-' || CAST(p_size + 7 AS VARCHAR) || 'B' END AS range
  FROM part)"""


def part_ranges(spark, sf):
    p = VW.table(spark, sf, "part")
    s, k = F.col("p_size").cast("string"), F.col("p_partkey")
    r = (F.when(k % 4 == 0, F.concat(s, F.lit("-"), (F.col("p_size") + k % 50).cast("string")))
         .when(k % 4 == 1, F.concat(F.lit("-"), s, F.lit("-"), (F.col("p_size") + 5).cast("string")))
         .when(k % 4 == 2, F.concat(F.lit("-"), (F.col("p_size") + 5).cast("string"), F.lit("--"), s))
         .otherwise(F.concat(F.lit("("), s, F.lit("A)-"), (F.col("p_size") + 7).cast("string"), F.lit("B"))))
    return p.select("p_partkey", r.alias("range"))


@register("fn_parse_boundary", SQL_RANGES + """
SELECT p_partkey, range,
       CAST(regexp_extract(regexp_replace(regexp_replace(range, '[A-Z]', '', 'g'), '[()]', '', 'g'), '^(-?\\d+)-(-?\\d+)$', 1) AS INTEGER) AS first,
       CAST(regexp_extract(regexp_replace(regexp_replace(range, '[A-Z]', '', 'g'), '[()]', '', 'g'), '^(-?\\d+)-(-?\\d+)$', 2) AS INTEGER) AS last
FROM r""")
def q_fn_parse_boundary(spark, sf):
    r = part_ranges(spark, sf)
    p = TX.parse_boundary("range")
    return r.select("p_partkey", "range", p["first"].alias("first"), p["last"].alias("last"))


SQL_BOUNDARY_LISTS = SQL_RANGES + """,
d AS (SELECT p_partkey, p_partkey // 3 AS grp, p_size,
             range || CASE WHEN p_partkey % 5 = 0 THEN '_' || CAST(p_size + 100 AS VARCHAR) || '-' || CAST(p_size + 110 AS VARCHAR) ELSE '' END AS rng,
             CASE WHEN p_partkey % 7 = 0 THEN '999_999' ELSE CAST(p_partkey AS VARCHAR) || '_' || CAST(p_partkey % 10 AS VARCHAR) END AS label
      FROM r JOIN part USING (p_partkey)),
t AS (SELECT grp, 'T' || CAST(grp AS VARCHAR) || 'A' AS target, count(*) AS n_domains, count(DISTINCT p_partkey % 10) AS n_superfamilies,
             sum(p_size) AS n_residues FROM d GROUP BY grp),
n AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY p_partkey) AS dom FROM d),
x AS (SELECT n.*, unnest(range(1, len(string_split(rng, '_')) + 1)) AS seg FROM n),
y AS (SELECT grp, dom, seg, label, string_split(rng, '_')[seg] AS range FROM x)"""


def boundary_lists(spark, sf):
    """Domains of three parts each as one target: ranges (some discontinuous), labels (some masked), counts."""
    k = F.col("p_partkey")
    r = part_ranges(spark, sf).join(VW.table(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    two = F.when(k % 5 == 0, F.concat(F.lit("_"), (F.col("p_size") + 100).cast("string"), F.lit("-"), (F.col("p_size") + 110).cast("string"))).otherwise(F.lit(""))
    label = F.when(k % 7 == 0, F.lit(RP.MASKED_LABEL)).otherwise(F.concat(k.cast("string"), F.lit("_"), (k % 10).cast("string")))
    d = r.select(F.floor(k / 3).cast("long").alias("grp"), "p_partkey", "p_size", F.concat("range", two, F.lit(":"), label).alias("d"))
    t = d.groupBy("grp").agg(F.count(F.lit(1)).alias("n_domains"), F.count_distinct(F.col("p_partkey") % 10).alias("n_superfamilies"),
                             F.sum("p_size").alias("n_residues"), F.array_sort(F.collect_list(F.struct("p_partkey", "d"))).alias("_d"))
    code = F.concat(F.lit("T"), F.col("grp").cast("string"))
    return t.select(F.lower(code).alias("pdb"), F.concat(code, F.lit("A")).alias("target"), F.lit("A").alias("chain"), "n_domains", "n_superfamilies",
                    "n_residues", F.array_join(F.transform("_d", lambda x: x["d"]), "|").alias("ranges"))


@register("src_boundaries_csv", SQL_BOUNDARY_LISTS + """
SELECT t.target, CAST(t.n_domains AS BIGINT) AS n_domains, CAST(t.n_superfamilies AS BIGINT) AS n_superfamilies,
       CAST(t.n_residues AS BIGINT) AS n_residues, CAST(t.n_residues AS BIGINT) AS nres, CAST(y.dom AS INTEGER) AS dom, CAST(y.seg AS INTEGER) AS seg,
       y.range, y.label, y.label = '999_999' AS masked,
       CAST(regexp_extract(regexp_replace(regexp_replace(range, '[A-Z]', '', 'g'), '[()]', '', 'g'), '^(-?\\d+)-(-?\\d+)$', 1) AS INTEGER) AS first,
       CAST(regexp_extract(regexp_replace(regexp_replace(range, '[A-Z]', '', 'g'), '[()]', '', 'g'), '^(-?\\d+)-(-?\\d+)$', 2) AS INTEGER) AS last
FROM y JOIN t USING (grp)""")
def q_src_boundaries_csv(spark, sf):
    """Domain lists in both layouts, written as CSV and read back: the seven documented columns, exploded to one row per
    range of each domain, with the residue count of the short ``target,nres`` list."""
    lists = boundary_lists(spark, sf)
    long_, short = scratch_path(spark, "boundaries"), scratch_path(spark, "target-sizes")
    lists = written(lists, "boundary-lists")
    lists.select(*RP.BOUNDARY_COLUMNS).write.option("quote", "").csv(long_)
    lists.select("target", F.col("n_residues").alias("nres")).write.option("header", True).csv(short)
    r = RP.read_boundaries(spark, long_).join(RP.read_target_sizes(spark, short), "target")
    return r.select("target", "n_domains", "n_superfamilies", "n_residues", "nres", "dom", "seg", "range", "label", "masked", "first", "last")


@register("fn_expand_boundaries", QA.SQL_CLEAN + """,
res AS (SELECT DISTINCT sid, chain, resi FROM clean WHERE atom = 'CA'),
idx AS (SELECT *, row_number() OVER (PARTITION BY sid, chain ORDER BY resi) - 1 AS i FROM res),
rs AS (SELECT s_suppkey AS sid, 1 AS dom, 1 AS seg, s_suppkey % 7 + 1 AS first, 20 + s_suppkey % 11 AS last FROM supplier
       UNION ALL SELECT s_suppkey, 2, 1, 25 + s_suppkey % 5, 33 + s_suppkey % 4 FROM supplier
       UNION ALL SELECT s_suppkey, 2, 2, 38 + s_suppkey % 5, 48 + s_suppkey % 4 FROM supplier
       UNION ALL SELECT s_suppkey, 3, 1, 10 + s_suppkey % 9, 15 FROM supplier),
rg AS (SELECT c.chain, rs.* FROM rs JOIN (SELECT DISTINCT sid, chain FROM res) c ON c.sid = rs.sid),
lo AS (SELECT rg.sid, rg.chain, rg.dom, rg.seg, min(res.resi) AS a FROM rg JOIN res ON res.sid = rg.sid AND res.chain = rg.chain
       AND res.resi BETWEEN rg.first AND rg.first + 3 GROUP BY ALL),
hi AS (SELECT rg.sid, rg.chain, rg.dom, rg.seg, max(res.resi) AS b FROM rg JOIN res ON res.sid = rg.sid AND res.chain = rg.chain
       AND res.resi BETWEEN rg.last - 3 AND rg.last GROUP BY ALL),
pl AS (SELECT rg.*, lo.a, hi.b,
              CASE WHEN rg.first >= rg.last THEN 'first_not_below_last' WHEN lo.a IS NULL THEN 'start_not_found'
                   WHEN hi.b IS NULL THEN 'end_not_found' ELSE 'ok' END AS status
       FROM rg LEFT JOIN lo USING (sid, chain, dom, seg) LEFT JOIN hi USING (sid, chain, dom, seg)),
dm AS (SELECT sid, chain, dom, coalesce(min_by(status, seg) FILTER (WHERE status <> 'ok'), 'ok') AS status,
              CASE WHEN count(*) FILTER (WHERE status <> 'ok') = 0 THEN least(min(a), min(b)) END AS first,
              CASE WHEN count(*) FILTER (WHERE status <> 'ok') = 0 THEN greatest(max(a), max(b)) END AS last
       FROM pl GROUP BY sid, chain, dom),
pt AS (SELECT sid, chain, dom, seg, unnest(range(a, b + 1)) AS resi FROM pl),
ls AS (SELECT pt.sid, pt.chain, pt.dom, string_agg(CAST(pt.resi AS VARCHAR), ',' ORDER BY pt.seg, pt.resi) AS residues, count(res.resi) AS n_present
       FROM pt LEFT JOIN res ON res.sid = pt.sid AND res.chain = pt.chain AND res.resi = pt.resi GROUP BY ALL)
SELECT dm.sid, dm.chain, CAST(dm.dom AS INTEGER) AS dom, dm.status, CASE WHEN dm.status = 'ok' THEN coalesce(ls.residues, '') END AS residues,
       CAST(CASE WHEN dm.status = 'ok' THEN coalesce(ls.n_present, 0) END AS DOUBLE) AS n_present, CAST(dm.first AS DOUBLE) AS first,
       CAST(dm.last AS DOUBLE) AS last, CAST(f.i AS DOUBLE) AS first_idx, CAST(l.i AS DOUBLE) AS last_idx
FROM dm LEFT JOIN ls USING (sid, chain, dom)
LEFT JOIN idx f ON f.sid = dm.sid AND f.chain = dm.chain AND f.resi = dm.first
LEFT JOIN idx l ON l.sid = dm.sid AND l.chain = dm.chain AND l.resi = dm.last""")
def q_fn_expand_boundaries(spark, sf):
    """Three domains of each structure (the second in two ranges, the third often the wrong way round), moved onto the
    residues of every chain and expanded to residue lists."""
    sid = F.col("s_suppkey")
    spans = [(1, 1, sid % 7 + 1, sid % 11 + 20), (2, 1, sid % 5 + 25, sid % 4 + 33), (2, 2, sid % 5 + 38, sid % 4 + 48), (3, 1, sid % 9 + 10, F.lit(15))]
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dom"), F.lit(g).alias("seg"), a.cast("int").alias("first"), b.cast("int").alias("last")) for d, g, a, b in spans]))
    s = VW.table(spark, sf, "supplier").select(sid.alias("sid"), each.alias("r")).select("sid", "r.*")
    res = written(QA.clean_atoms(spark, sf).where(F.col("atom") == "CA").select("sid", "chain", "resi"), "residues")
    rg = s.join(res.select("sid", "chain").distinct(), "sid")
    out = BD.expand_domains(rg, res, ["sid", "chain"])
    return out.select("sid", "chain", "dom", "status", F.array_join(F.transform("residues", lambda x: x.cast("string")), ",").alias("residues"),
                      *[F.col(c).cast("double").alias(c) for c in ("n_present", "first", "last", "first_idx", "last_idx")])


SQL_ALIGNER_TEXT = """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_linenumber = 7 THEN '' ELSE printf('Aligned length= %4d, RMSD= %6.2f, Seq_ID=n_identical/n_aligned= %5.3f',
              CAST(l_quantity AS INTEGER), l_discount * 10, l_tax * 10) || chr(10) END
         || printf('TM-score= %.4f (if normalized by length of Chain_1)', (l_partkey % 10000) / 10000.0) || chr(10)
         || printf('TM-score= %.4f (if normalized by length of Chain_2)', (l_suppkey % 10000) / 10000.0) || chr(10)
         || CASE WHEN l_linenumber = 6 THEN '' ELSE '(":" denotes residue pairs of d <  5.0 Angstrom)' || chr(10) || l_returnflag || 'CD-E' || chr(10)
              || ': . ' || l_linestatus || chr(10) || l_returnflag || '--' || chr(10) || 'end' || chr(10) END AS report
  FROM lineitem),
p AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         TRY_CAST(TRY_CAST(split_part(split_part(report, 'Aligned length=', 2), ',', 1) AS DOUBLE) AS INTEGER) AS len_ali,
         TRY_CAST(split_part(split_part(report, 'RMSD=', 2), ',', 1) AS DOUBLE) AS rmsd,
         TRY_CAST(split_part(split_part(report, 'n_identical/n_aligned=', 2), chr(10), 1) AS DOUBLE) AS seq_id,
         TRY_CAST(split_part(split_part(report, 'TM-score=', 2), '(', 1) AS DOUBLE) AS qtm,
         TRY_CAST(split_part(split_part(report, 'TM-score=', 3), '(', 1) AS DOUBLE) AS ttm,
         CASE WHEN contains(report, '(":" denotes residue pairs')
              THEN array_to_string(string_split(split_part(report, '(":" denotes residue pairs', 2), chr(10))[2:4], chr(10)) END AS alignment
  FROM t)"""


def aligner_reports(spark, sf):
    li = VW.table(spark, sf, "lineitem")
    aligned = F.format_string("Aligned length= %4d, RMSD= %6.2f, Seq_ID=n_identical/n_aligned= %5.3f\n",
                              F.col("l_quantity").cast("int"), F.col("l_discount") * 10, F.col("l_tax") * 10)
    tm = F.concat(F.format_string("TM-score= %.4f (if normalized by length of Chain_1)\n", (F.col("l_partkey") % 10000) / 10000.0),
                  F.format_string("TM-score= %.4f (if normalized by length of Chain_2)\n", (F.col("l_suppkey") % 10000) / 10000.0))
    lines = F.concat(F.lit('(":" denotes residue pairs of d <  5.0 Angstrom)\n'), "l_returnflag", F.lit("CD-E\n: . "), "l_linestatus", F.lit("\n"),
                     "l_returnflag", F.lit("--\nend\n"))
    rep = F.concat(F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(aligned), tm, F.when(F.col("l_linenumber") == 6, F.lit("")).otherwise(lines))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", rep.alias("report"))


@register("fn_parse_aligner_report", SQL_ALIGNER_TEXT + """
SELECT * REPLACE (CAST(len_ali AS DOUBLE) AS len_ali) FROM p""")
def q_fn_parse_aligner_report(spark, sf):
    r = aligner_reports(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *TX.aligner_fields("report"),
                                          TX.alignment_lines("report").alias("alignment"))
    return r.withColumn("len_ali", F.col("len_ali").cast("double"))


@register("fn_max_tm", SQL_ALIGNER_TEXT + """
SELECT l_orderkey, l_linenumber, l_partkey, greatest(qtm, ttm) AS max_tm FROM p""")
def q_fn_max_tm(spark, sf):
    r = aligner_reports(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *TX.aligner_fields("report"))
    return r.select("l_orderkey", "l_linenumber", "l_partkey", F.greatest("qtm", "ttm").alias("max_tm"))


# ------------------------------------------------------------------ joins over inputs
@register("join_input_chains", """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
                  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
lst AS (SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'A'
                               ELSE string_agg(o_orderstatus, ',' ORDER BY o_orderkey) END AS chains
        FROM orders GROUP BY o_custkey)
SELECT o.o_custkey, o.o_orderkey,
       CASE WHEN len(string_split(l.chains, ',')) = 1 THEN l.chains ELSE string_split(l.chains, ',')[o.pos] END AS chain,
       CASE WHEN len(string_split(l.chains, ',')) IN (1, o.n) THEN 'ok' ELSE 'length_mismatch' END AS status
FROM o JOIN lst l ON o.o_custkey = l.o_custkey""")
def q_join_input_chains(spark, sf):
    """Inputs (a customer's orders, by key) joined by position with a comma list of chain ids; a
    single id is used for every input; any other length difference is flagged."""
    o = VW.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    lists = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("_l")).select(
        "o_custkey", F.when(F.col("o_custkey") % 3 == 0, F.lit("A")).otherwise(
            F.array_join(F.transform("_l", lambda x: x["o_orderstatus"]), ",")).alias("chains"))
    return ST.join_input_chains(o.select("o_custkey", "o_orderkey"), lists, "o_custkey", "o_orderkey", "chains")


@register("anti_join_processed", """
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_anti_join_processed(spark, sf):
    """Restartable job: inputs that already have an output (a labels row) are skipped."""
    d = VW.table(spark, sf, "documents").select("doc_id")
    done = VW.table(spark, sf, "labels").select("doc_id")
    return ST.unprocessed(d, done, "doc_id")


@register("sort_natural", """
WITH b AS (SELECT DISTINCT p_brand FROM part)
SELECT p_brand, CAST(row_number() OVER (ORDER BY list_transform(regexp_extract_all(p_brand, '(\\d+)', 1),
                                                                 lambda x: CAST(x AS BIGINT)), p_brand) AS BIGINT) AS nat_rank
FROM b""")
def q_sort_natural(spark, sf):
    b = VW.table(spark, sf, "part").select("p_brand").distinct().withColumn("_k", L.natural_key("p_brand"))
    return IX.dense_index(b, ["_k", "p_brand"], out="nat_rank").select("p_brand", "nat_rank")


@register("agg_mean_pool", """
WITH e AS (SELECT label, unnest(range(1, 65)) AS dim, embedding FROM embeddings),
d AS (SELECT label, dim, count(*) AS n, sum(CAST(round(CAST(embedding[dim] AS DOUBLE) * 1099511627776) AS HUGEINT)) AS s FROM e GROUP BY label, dim)
SELECT label, CAST(max(n) AS BIGINT) AS n, CAST(count(*) AS INTEGER) AS width, md5(string_agg(CAST(s AS VARCHAR), ',' ORDER BY dim)) AS sums_md5,
       max(s * 1.0 / 1099511627776 / n) AS largest, min(s * 1.0 / 1099511627776 / n) AS least FROM d GROUP BY label""")
def q_agg_mean_pool(spark, sf):
    """One mean vector per group (here: embeddings by label); its exact component sums as a digest, its extremes as values."""
    from ..operators import summary as SU

    e = VW.table(spark, sf, "embeddings").select("label", "embedding")
    sums = SU.vector_sums(e, ["label"], "embedding").select("label", F.md5(F.array_join(F.transform("sums", lambda x: x.cast("string")), ",")).alias("sums_md5"))
    return SU.mean_pool(e, ["label"], "embedding").join(sums, "label").select(
        "label", "n", F.size("pooled").alias("width"), "sums_md5", F.array_max("pooled").alias("largest"), F.array_min("pooled").alias("least"))


# ------------------------------------------------------------------ iteration
def _sql_reseg_round(src: str, p: str) -> str:
    """One round: ``did`` names a domain ('0': none), ``act`` marks the parts that the last round made."""
    return f"""{p}a AS (SELECT *, count(*) OVER (PARTITION BY sid, did) AS sz, min(pos) OVER (PARTITION BY sid, did) AS p0,
                row_number() OVER (PARTITION BY sid, did ORDER BY pos) AS rn FROM {src}),
{p}b AS (SELECT *, act AND sz > {RESEG_AVG} AS sel,
                CASE WHEN p0 % 5 = 0 OR rn <= sz // 2 THEN 1 WHEN rn = sz // 2 + 1 AND sz >= 4 THEN 0 ELSE 2 END AS sub FROM {p}a),
{p}c AS (SELECT *, count(*) OVER (PARTITION BY sid, did, sub) AS psz, sel AND p0 % 5 <> 0 AS cut FROM {p}b),
{p}r AS (SELECT sid, pos, resi, CASE WHEN cut THEN CASE WHEN sub = 0 THEN '0' ELSE did || '/' || CAST(sub AS VARCHAR) END ELSE did END AS did,
                CASE WHEN cut THEN CASE WHEN sub = 0 THEN 0.0 ELSE psz / 64.0 END ELSE conf END AS conf, cut AND sub <> 0 AS act FROM {p}c)"""


@register("iterate_resegment", QL.PIPE + f""",
i0 AS (SELECT sid, pos, resi, CAST(domain_id AS VARCHAR) AS did, conf,
              domain_id <> 0 AND count(*) OVER (PARTITION BY sid) > {2 * RESEG_AVG} AS act FROM f_rn),
""" + _sql_reseg_round("i0", "i1") + ",\n" + _sql_reseg_round("i1r", "i2") + ",\n" + _sql_reseg_round("i2r", "i3") + """,
i4 AS (SELECT sid, pos, resi, conf, CAST(CASE WHEN did = '0' THEN 0 ELSE dense_rank() OVER (PARTITION BY sid ORDER BY did) END AS INTEGER) AS domain_id
       FROM i3r),
""" + QL.sql_renumber("i4", "z_") + """
SELECT sid, pos, domain_id, conf FROM z_rn""")
def q_iterate_resegment(spark, sf):
    d = QL.cleaned(spark, sf).select("sid", "pos", "resi", "domain_id", "conf")
    d = L.iterate_resegment(d, QL.KEYS, L.halving_segmenter, RESEG_AVG)
    return L.renumber_first_seen(d, QL.KEYS).select("sid", "pos", "domain_id", "conf")
