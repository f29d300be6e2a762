"""Views of the driver tables that stand in for structure data.

There is no structure data among the driver tables, so every registered query
runs its operator over one of these views. Each view exists twice: as a
DataFrame (what the engine runs) and as a SQL common table expression (what
the DuckDB oracle runs). Both are written from the same rules:

``atoms_v``    lineitem  -> one row per atom record
``labels_v``   events    -> one row per residue with a domain label
``targets_v``  embeddings left join documents -> target database rows
``files_v``    documents -> structure files (path, size, organism)
``pages_v``    pages     -> structure files named by URL

Every double a view emits has few decimals so that fixed-width text renders
and parses back to the same value in both engines; values that get averaged
(confidence, pLDDT) are multiples of a power of two, so their sums are exact
in any order and both engines produce the same mean.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import RESIDUE_LETTERS

# --- fixed values: residue names used by the atom view ----------------------
# The 20 standard names in the order of RESIDUE_LETTERS, then one special
# residue (read as MET) and one excluded residue.
VIEW_RESIDUE_NAMES = list(RESIDUE_LETTERS) + ["MSE", "UNK"]
VIEW_ATOM_NAMES = ["N", "CA", "C", "O"]
VIEW_HYDROGEN = "1HB"  # a hydrogen whose name starts in column 13 with a digit
# Label view thresholds: runs there are 1-8 residues long.
VIEW_MIN_DOMAIN = 6
VIEW_MIN_FRAGMENT = 3

# between a query chain's name and its domain number in the views
QUERY_DOMAIN_SUFFIX = "_dom"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --------------------------------------------------------------------------- atoms
def atoms_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    resn = F.element_at(F.array(*[F.lit(n) for n in VIEW_RESIDUE_NAMES]), (F.col("l_partkey") % 22 + 1).cast("int"))
    atom = F.when(F.col("l_partkey") % 97 == 0, F.lit(VIEW_HYDROGEN)).otherwise(
        F.element_at(F.array(*[F.lit(n) for n in VIEW_ATOM_NAMES]), (F.col("l_linenumber") % 4 + 1).cast("int")))
    hetatm = resn.isin("MSE", "UNK") | (F.col("l_linenumber") == 7)
    return li.select(
        F.col("l_suppkey").alias("sid"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("serial"),
        F.col("l_partkey").alias("aux"),
        (F.col("l_partkey") % 50 + 1).cast("int").alias("resi"),
        atom.alias("atom"),
        resn.alias("resn"),
        F.col("l_linestatus").alias("chain"),
        F.when(hetatm, F.lit("HETATM")).otherwise(F.lit("ATOM")).alias("type"),
        F.col("l_quantity").alias("x"),
        (F.floor("l_extendedprice") / 1000).alias("y"),
        F.round(F.col("l_discount") * 100).alias("z"),
        F.col("l_tax").alias("occ"),
        ((F.floor(F.col("l_extendedprice") * 100) % 10000) / 100).alias("b"),
        F.when(atom.rlike("^[0-9]"), F.substring(atom, 1, 1)).otherwise(F.lit(" ")).alias("name_col13"),
    )


SQL_ATOMS_V = f"""atoms_v AS (
  SELECT l_suppkey AS sid,
         l_orderkey * 8 + l_linenumber AS serial,
         l_partkey AS aux,
         CAST(l_partkey % 50 + 1 AS INTEGER) AS resi,
         CASE WHEN l_partkey % 97 = 0 THEN '{VIEW_HYDROGEN}'
              ELSE {_sql_list(VIEW_ATOM_NAMES)}[CAST(l_linenumber % 4 + 1 AS INTEGER)] END AS atom,
         {_sql_list(VIEW_RESIDUE_NAMES)}[CAST(l_partkey % 22 + 1 AS INTEGER)] AS resn,
         l_linestatus AS chain,
         CASE WHEN {_sql_list(VIEW_RESIDUE_NAMES)}[CAST(l_partkey % 22 + 1 AS INTEGER)] IN ('MSE', 'UNK')
                   OR l_linenumber = 7 THEN 'HETATM' ELSE 'ATOM' END AS type,
         l_quantity AS x,
         floor(l_extendedprice) / 1000 AS y,
         round(l_discount * 100) AS z,
         l_tax AS occ,
         (floor(l_extendedprice * 100) % 10000) / 100 AS b,
         CASE WHEN l_partkey % 97 = 0 THEN '1' ELSE ' ' END AS name_col13
  FROM lineitem)"""


# --------------------------------------------------------------------------- labels
def labels_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    pos = F.row_number().over(w) - 1
    base = ev.select("user_id", "event_id", "event_type", "value", pos.alias("pos"))
    dom = F.when((F.col("event_type") == "error") & (F.col("pos") % 3 == 0), F.lit(0)).otherwise(
        ((F.col("pos") / (F.col("user_id") % 7 + 2)).cast("long") * 7 + F.col("user_id")) % 5
    )
    resn = F.element_at(F.array(*[F.lit(n) for n in RESIDUE_LETTERS]), (F.col("event_id") % 20 + 1).cast("int"))
    return base.select(
        F.col("user_id").alias("sid"),
        F.col("pos").cast("int").alias("pos"),
        (F.col("pos") + 1 + 3 * F.floor(F.col("pos") / 20)).cast("int").alias("resi"),
        dom.cast("int").alias("domain_id"),
        (F.floor(F.least(F.greatest(F.col("value"), F.lit(0.0)), F.lit(100.0)) * 10.24) / 1024).alias("conf"),
        (F.floor(F.col("value") * 4) / 4).alias("b"),
        resn.alias("resn"),
        F.col("event_type"),
    )


SQL_LABELS_V = f"""labels_b AS (
  SELECT user_id, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
  FROM events),
labels_v AS (
  SELECT user_id AS sid,
         CAST(pos AS INTEGER) AS pos,
         CAST(pos + 1 + 3 * (pos // 20) AS INTEGER) AS resi,
         CAST(CASE WHEN event_type = 'error' AND pos % 3 = 0 THEN 0
                   ELSE ((pos // (user_id % 7 + 2)) * 7 + user_id) % 5 END AS INTEGER) AS domain_id,
         floor(least(greatest(value, 0.0), 100.0) * 10.24) / 1024 AS conf,
         floor(value * 4) / 4 AS b,
         {_sql_list(RESIDUE_LETTERS)}[CAST(event_id % 20 + 1 AS INTEGER)] AS resn,
         event_type
  FROM labels_b)"""


# --------------------------------------------------------------------------- targets
def targets_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = e.join(d, e.vec_id == d.doc_id, "left")
    chain = F.concat(F.lit("c"), F.lpad(F.floor(F.col("vec_id") / 4).cast("string"), 5, "0"), F.lit("A"))
    meta = F.when(F.col("n_chars").isNull() | (F.col("vec_id") % 7 == 3), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('{"cath": "3.40.50.'), F.col("label").cast("string"), F.lit('"}'))
    )
    return j.select(
        F.col("vec_id").alias("dbindex"),
        F.concat(chain, F.lpad((F.col("vec_id") % 4 + 1).cast("string"), 2, "0"), F.lit(".pdb")).alias("name"),
        chain.alias("chain"),
        F.col("embedding"),
        F.coalesce(F.col("n_chars"), F.lit(1000)).cast("int").alias("length"),
        meta.alias("metadata"),
        F.col("label"),
    )


SQL_TARGETS_V = """targets_v AS (
  SELECT e.vec_id AS dbindex,
         'c' || lpad(CAST(e.vec_id // 4 AS VARCHAR), 5, '0') || 'A'
             || lpad(CAST(e.vec_id % 4 + 1 AS VARCHAR), 2, '0') || '.pdb' AS name,
         'c' || lpad(CAST(e.vec_id // 4 AS VARCHAR), 5, '0') || 'A' AS chain,
         e.embedding,
         CAST(coalesce(d.n_chars, 1000) AS INTEGER) AS length,
         CASE WHEN d.n_chars IS NULL OR e.vec_id % 7 = 3 THEN NULL
              ELSE '{"cath": "3.40.50.' || CAST(e.label AS VARCHAR) || '"}' END AS metadata,
         e.label
  FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id)"""


def queries_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target is also a query domain; its chain pairs vectors 2 by 2."""
    t = targets_v(spark, sf_dir)
    qchain = F.concat(F.lit("q"), F.lpad(F.floor(F.col("dbindex") / 2).cast("string"), 5, "0"))
    return t.select(
        F.col("dbindex").alias("qid"),
        F.concat(qchain, F.lit(QUERY_DOMAIN_SUFFIX + "_"), F.lpad((F.col("dbindex") % 2 + 1).cast("string"), 2, "0")).alias("query"),
        qchain.alias("query_chain"),
        F.col("embedding").alias("q_embedding"),
        F.col("length").alias("q_len"),
        # per-domain fields a segmentation would have produced
        F.concat((F.col("dbindex") * 10 + 1).cast("string"), F.lit("-"),
                 (F.col("dbindex") * 10 + F.col("length") % 50 + 20).cast("string")).alias("dom_str"),
        ((F.col("length") % 97) / 128.0).alias("dom_conf"),
        ((F.col("length") % 1000) / 8.0).alias("dom_plddt"),
        (F.floor(F.col("dbindex") / 2) % 3).cast("string").alias("_org"),
    ).withColumn("organism", F.concat(F.lit("org"), F.col("_org"))).drop("_org")


SQL_QUERIES_V = f"""queries_v AS (
  SELECT dbindex AS qid,
         'q' || lpad(CAST(dbindex // 2 AS VARCHAR), 5, '0') || '{QUERY_DOMAIN_SUFFIX}_'
             || lpad(CAST(dbindex % 2 + 1 AS VARCHAR), 2, '0') AS query,
         'q' || lpad(CAST(dbindex // 2 AS VARCHAR), 5, '0') AS query_chain,
         embedding AS q_embedding,
         length AS q_len,
         CAST(dbindex * 10 + 1 AS VARCHAR) || '-' || CAST(dbindex * 10 + length % 50 + 20 AS VARCHAR) AS dom_str,
         (length % 97) / 128.0 AS dom_conf,
         (length % 1000) / 8.0 AS dom_plddt,
         'org' || CAST((dbindex // 2) % 3 AS VARCHAR) AS organism
  FROM targets_v)"""


# --------------------------------------------------------------------------- files
def files_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdb")).alias("path"),
        F.col("source").alias("organism"),
        F.col("n_chars").alias("size"),
        F.col("text").alias("content"),
    )


SQL_FILES_V = """files_v AS (
  SELECT doc_id AS file_id, source || '/' || CAST(doc_id AS VARCHAR) || '.pdb' AS path,
         source AS organism, n_chars AS size, text AS content
  FROM documents)"""


def pages_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").alias("file_id"),
        F.col("url").alias("path"),
        F.length("html").cast("long").alias("size"),
        F.col("html").alias("content"),
    )


SQL_PAGES_V = """pages_v AS (
  SELECT page_id AS file_id, url AS path, CAST(length(html) AS BIGINT) AS size, html AS content FROM pages)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
