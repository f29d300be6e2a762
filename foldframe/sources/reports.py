"""Per-structure reports, hit tables, boundary lists and target databases as files.

Report layout (one file per structure):
    #<name>_search.tsv Results. mean plddt: <mean>
    cath_id,count
    <cath>,<count>
    ...
A structure without hits writes ``mean plddt: 0`` and the header line only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..constants import EMPTY_METADATA
from ..functions import formats as FM
from ..functions import text as TX
from ..operators.boundaries import explode_ranges
from .bundles import read_bundles, write_bundles
from .store import written

REPORT_COUNTS_SCHEMA = StructType([StructField("cath_id", StringType()), StructField("count", LongType())])


def report_lines(means: DataFrame, counts: DataFrame, key: str = "structure") -> DataFrame:
    """Text lines of every report with an ordinal: header (0), column names (1), rows (2...).

    ``means``: (key, mean_plddt, n_hits); ``counts``: (key, cath_id, count)."""
    mean_txt = F.when(F.col("n_hits") > 0, FM.py_repr("mean_plddt")).otherwise(F.lit("0"))
    head = means.select(key, F.lit(0).alias("ord"), F.concat(F.lit("#"), F.col(key), F.lit("_search.tsv Results. mean plddt: "),
                                                             mean_txt).alias("line"))
    cols = means.select(key, F.lit(1).alias("ord"), F.lit("cath_id,count").alias("line"))
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy(F.col("cath_id").asc_nulls_first()))
    rows = counts.select(key, (F.lit(1) + rank).alias("ord"),
        F.concat_ws(",", F.coalesce(F.col("cath_id"), F.lit("")), F.col("count").cast("string")).alias("line"))
    return head.unionByName(cols).unionByName(rows)


def write_reports(lines: DataFrame, path: str, key: str = "structure") -> None:
    """The reports of all structures as bundles: few text files and a manifest, not one small file a structure."""
    write_bundles(written(lines, "report-lines"), path, key, ["ord"])


def read_reports(spark: SparkSession, path: str, key: str = "structure") -> DataFrame:
    """``structure, lines`` of written reports."""
    return read_bundles(spark, path, key)


def report_counts(reports: DataFrame, key: str = "structure") -> DataFrame:
    """``cath_id, count`` rows of each report: ``#`` lines skipped, the header dropped; a header-only report gives none."""
    body = F.filter("lines", lambda x: ~x.startswith("#") & (x != ""))
    row = reports.select(key, F.explode(F.slice(body, F.lit(2), F.greatest(F.size(body) - 1, F.lit(0)))).alias("_l"))
    parts = F.split("_l", ",")
    return row.select(F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ",").alias("cath_id"),
                      F.element_at(parts, -1).try_cast("long").alias("count"), key)


def report_headers(reports: DataFrame, key: str = "structure") -> DataFrame:
    """Mean pLDDT from the first line of each report."""
    return reports.select(key, TX.report_mean(F.try_element_at("lines", F.lit(1))).alias("mean_plddt"))


def write_report_files(lines: DataFrame, path: str, key: str = "structure", partitions: int | None = None) -> None:
    """One report file per structure (``key=<value>/part-*.txt``), the original's layout; for few structures."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(n, key).sortWithinPartitions(key, "ord").select(key, "line")
          .write.mode("overwrite").partitionBy(key).text(path))


def read_report_counts(spark: SparkSession, path: str) -> DataFrame:
    """``cath_id,count`` rows of every report: ``#`` lines skipped, one header per file dropped,
    header-only files give no rows. The structure comes from the partition folder."""
    df = spark.read.schema(REPORT_COUNTS_SCHEMA).option("header", True).option("comment", "#").csv(path)
    return df.withColumn("structure", F.regexp_extract(F.col("_metadata.file_path"), r"structure=([^/]+)/", 1))


def read_report_headers(spark: SparkSession, path: str) -> DataFrame:
    """Mean pLDDT from the first line of every report file."""
    df = spark.read.text(path, wholetext=True)
    first = F.element_at(F.split(F.col("value"), "\n"), 1)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"structure=([^/]+)/", 1).alias("structure"),
                     TX.report_mean(first).alias("mean_plddt"))


def read_hits_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Hit TSV with a header row, tab separated, no quoting; columns by name."""
    return spark.read.schema(schema).option("header", True).option("sep", "\t").option("quote", "").csv(path)


BOUNDARY_COLUMNS = ["pdb", "target", "chain", "n_domains", "n_superfamilies", "n_residues", "ranges"]
MASKED_LABEL = "999_999"


def read_boundaries(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Domain lists in the documented seven columns: one row per range of each domain, with the domain's ``label`` and
    whether it is ``masked``. Domains are delimited by ``|``, their ranges by ``_``, the label follows ``:``."""
    schema = StructType([StructField(c, LongType() if c.startswith("n_") else StringType()) for c in BOUNDARY_COLUMNS])
    t = spark.read.schema(schema).option("header", header).option("quote", "").csv(path)
    keys = BOUNDARY_COLUMNS[:-1]
    return explode_ranges(t, "ranges", keys, domain_sep=r"\|").withColumn("masked", F.coalesce(F.col("label") == MASKED_LABEL, F.lit(False)))


def read_target_sizes(spark: SparkSession, path: str) -> DataFrame:
    """The short layout: a header row, then ``target,nres``."""
    schema = StructType([StructField("target", StringType()), StructField("nres", LongType())])
    return spark.read.schema(schema).option("header", True).option("quote", "").csv(path)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Open a target database and check it: required columns, one vector of one length per entry, every entry numbered
    once from 0, lengths derived from the sequence when absent, metadata defaulting to ``'{ }'``.

    The check is a pass of its own over the index and the vectors' sizes, made before the table is handed out: an
    expression in a column would be pruned away with that column."""
    t = spark.read.parquet(path)
    need = {"dbindex", "name", "embedding"}
    missing = need - set(t.columns)
    if missing:
        raise ValueError(f"target database lacks column(s): {sorted(missing)}")
    width = F.size("embedding")
    none = F.col("embedding").isNull()
    c = t.agg(F.count(F.lit(1)).alias("n"), F.sum(none.cast("long")).alias("no_vector"), F.min(F.when(none, F.col("dbindex"))).alias("first"),
              F.min(F.when(~none, width)).alias("least"), F.max(F.when(~none, width)).alias("most"), F.count("dbindex").alias("numbered"),
              F.min("dbindex").alias("lo"), F.max("dbindex").alias("hi"), F.sum(F.col("dbindex").cast("decimal(38,0)")).alias("total")).first()
    if c["no_vector"]:
        raise ValueError(f"{c['no_vector']} target(s) without a vector, the first has dbindex {c['first']}")
    if c["least"] != c["most"]:
        raise ValueError(f"vectors of different lengths: {c['least']} to {c['most']}")
    # n numbers between 0 and n - 1 with the sum of 0 .. n - 1; numbers that occur twice would need others to be missing
    if c["n"] and (c["numbered"] != c["n"] or c["lo"] != 0 or c["hi"] != c["n"] - 1 or c["total"] != c["n"] * (c["n"] - 1) // 2):
        raise ValueError(f"vectors and index differ: {c['n']} entries, {c['numbered']} numbered from {c['lo']} to {c['hi']}")
    if "length" not in t.columns:
        t = t.withColumn("length", F.length("seq"))
    if "metadata" not in t.columns:
        t = t.withColumn("metadata", F.lit(None).cast("string"))
    return t.withColumn("metadata", F.coalesce("metadata", F.lit(EMPTY_METADATA)))
