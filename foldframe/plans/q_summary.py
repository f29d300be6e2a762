"""Registered queries: per-structure reports and per-organism summaries (search hits -> files -> tables)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as S
from ..operators import summary as SU
from ..session import scratch_path
from ..sources import reports as RP
from ..sources.store import written
from . import q_search as QS
from . import views as VW
from .registry import register

# Structures are the query chains of the embedding view; organism is a column of the view.
SQL_REPORT_BASE = QS.SQL_MASKED_HITS + """,
structs AS (SELECT DISTINCT query_chain AS structure, organism FROM queries_v),
hq AS (SELECT q.query_chain AS structure, q.dom_plddt AS plddt,
              json_extract_string(coalesce(t.metadata, '{ }'), '$.cath') AS cath_id
       FROM hits h JOIN queries_v q ON h.qid = q.qid LEFT JOIN targets_v t ON h.dbindex = t.dbindex),
means AS (SELECT s.structure, s.organism, coalesce(avg(h.plddt), 0.0) AS mean_plddt, count(h.plddt) AS n_hits
          FROM structs s LEFT JOIN hq h ON s.structure = h.structure GROUP BY s.structure, s.organism),
counts AS (SELECT structure, cath_id, count(*) AS count FROM hq GROUP BY structure, cath_id)"""


def hits_with_fields(spark, sf):
    hits = S.join_metadata(QS.masked_hits(spark, sf), VW.targets_v(spark, sf))
    q = VW.queries_v(spark, sf).select("qid", F.col("query_chain").alias("structure"), "organism",
                                       F.col("dom_plddt").alias("plddt"))
    return hits.join(q, "qid")


def structures(spark, sf):
    return VW.queries_v(spark, sf).select(F.col("query_chain").alias("structure"), "organism").distinct()


def report_tables(spark, sf):
    # both tables read the hits, some queries in jobs of their own: searched once
    h = written(hits_with_fields(spark, sf).select("structure", "plddt", "metadata"), "report-hits")
    means = SU.mean_plddt(structures(spark, sf).select("structure"), h, "structure")
    counts = SU.class_counts(h, "structure")
    return means, counts


def written_reports(spark, sf):
    """Write the report of every structure to a fresh bundled store; return its folder."""
    means, counts = report_tables(spark, sf)
    path = scratch_path(spark, "reports")
    RP.write_reports(RP.report_lines(means, counts), path)
    return path


@register("sink_report", SQL_REPORT_BASE + """
SELECT '#' || structure || '_search.tsv Results. mean plddt: '
       || CASE WHEN n_hits > 0 THEN CAST(mean_plddt AS VARCHAR) ELSE '0' END AS line FROM means
UNION ALL SELECT 'cath_id,count' FROM means
UNION ALL SELECT coalesce(cath_id, '') || ',' || CAST(count AS VARCHAR) FROM counts""")
def q_sink_report(spark, sf):
    return RP.read_reports(spark, written_reports(spark, sf)).select(F.explode("lines").alias("line"))


@register("src_report_counts", SQL_REPORT_BASE + """
SELECT structure, cath_id, CAST(count AS BIGINT) AS count FROM counts""")
def q_src_report_counts(spark, sf):
    df = RP.report_counts(RP.read_reports(spark, written_reports(spark, sf)))
    # an empty class name was written for hits without one; read it back as null
    return df.select("structure", F.when(F.col("cath_id") == "", None).otherwise(F.col("cath_id")).alias("cath_id"), "count")


@register("src_report_header", SQL_REPORT_BASE + """
SELECT structure, mean_plddt FROM means""")
def q_src_report_header(spark, sf):
    return RP.report_headers(RP.read_reports(spark, written_reports(spark, sf)))


@register("agg_class_totals", SQL_REPORT_BASE + """
SELECT s.organism, c.cath_id, CAST(sum(c.count) AS BIGINT) AS count
FROM counts c JOIN structs s ON c.structure = s.structure GROUP BY s.organism, c.cath_id""")
def q_agg_class_totals(spark, sf):
    _, counts = report_tables(spark, sf)
    return SU.class_totals(counts.join(structures(spark, sf), "structure"), ("organism",))


@register("agg_organism_stats", SQL_REPORT_BASE + """
SELECT organism, avg(mean_plddt) AS mean_plddt, stddev_samp(mean_plddt) AS stddev_plddt FROM means GROUP BY organism""")
def q_agg_organism_stats(spark, sf):
    means, _ = report_tables(spark, sf)
    return SU.organism_stats(means.join(structures(spark, sf), "structure"))


@register("sink_summary", SQL_REPORT_BASE + """
SELECT 'stats' AS summary, organism, CAST(NULL AS VARCHAR) AS cath_id, CAST(NULL AS DOUBLE) AS count, avg(mean_plddt) AS mean_plddt,
       stddev_samp(mean_plddt) AS stddev_plddt FROM means GROUP BY organism
UNION ALL
SELECT 'class_totals', s.organism, c.cath_id, CAST(sum(c.count) AS DOUBLE), NULL, NULL
FROM counts c JOIN structs s ON c.structure = s.structure GROUP BY s.organism, c.cath_id""")
def q_sink_summary(spark, sf):
    """Both summary tables as CSV in two separate folders, read back as one table; the stats table (a row for each organism)
    is one file, cut after the aggregate, which keeps its own tasks."""
    means, counts = report_tables(spark, sf)
    means = means.join(structures(spark, sf), "structure")
    stats = SU.organism_stats(means)
    totals = SU.class_totals(counts.join(structures(spark, sf), "structure"), ("organism",))
    base = scratch_path(spark, "summary")
    stats.repartition(1).write.mode("overwrite").option("header", True).csv(f"{base}/stats")
    totals.write.mode("overwrite").option("header", True).csv(f"{base}/class_totals")
    back_stats = spark.read.schema(stats.schema).option("header", True).csv(f"{base}/stats")
    back_totals = spark.read.schema(totals.schema).option("header", True).csv(f"{base}/class_totals")
    nothing = F.lit(None)
    return back_stats.select(F.lit("stats").alias("summary"), "organism", nothing.cast("string").alias("cath_id"), nothing.cast("double").alias("count"),
                             "mean_plddt", "stddev_plddt").unionByName(
        back_totals.select(F.lit("class_totals").alias("summary"), "organism", "cath_id", F.col("count").cast("double").alias("count"),
                           nothing.cast("double").alias("mean_plddt"), nothing.cast("double").alias("stddev_plddt")))


@register("filter_has_hits", """
SELECT d.doc_id, l.doc_id IS NOT NULL AS has_output,
       CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 1 THEN CAST(d.n_chars % 100 AS DOUBLE) ELSE 0.0 END AS mean_plddt
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_filter_has_hits(spark, sf):
    """Documents as structures; a labels row is a search output whose hits are the rows with
    quality 1. No output: no report (null); an empty output: mean 0."""
    d = VW.table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = VW.table(spark, sf, "labels").select("doc_id", "quality")
    outputs = lab.select("doc_id")
    hits = lab.where(F.col("quality") == 1).join(d, "doc_id").select("doc_id", (F.col("n_chars") % 100).cast("double").alias("plddt"))
    reports = SU.mean_plddt(outputs, hits, "doc_id").select("doc_id", "mean_plddt")
    return d.join(reports.withColumn("has_output", F.lit(True)), "doc_id", "left").select(
        "doc_id", F.coalesce("has_output", F.lit(False)).alias("has_output"), "mean_plddt")
