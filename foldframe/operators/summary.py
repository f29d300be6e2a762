"""Per-structure reports and per-organism summaries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EMPTY_METADATA


def class_counts(hits: DataFrame, structure_col: str, metadata_col: str = "metadata", key: str = "cath") -> DataFrame:
    """Hits per fold class per structure; the class is a key of the metadata JSON."""
    cath = F.get_json_object(F.coalesce(F.col(metadata_col), F.lit(EMPTY_METADATA)), f"$.{key}")
    return hits.groupBy(F.col(structure_col), cath.alias("cath_id")).agg(F.count(F.lit(1)).alias("count"))


def mean_plddt(structures: DataFrame, hits: DataFrame, structure_col: str, value_col: str = "plddt") -> DataFrame:
    """Mean pLDDT over the hits of each structure; 0 when a structure has no hits (it still reports)."""
    per = hits.groupBy(structure_col).agg(F.avg(value_col).alias("m"), F.count(F.lit(1)).alias("n"))
    return structures.join(per, structure_col, "left").select(
        structure_col,
        F.coalesce(F.col("m"), F.lit(0.0)).alias("mean_plddt"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_hits"),
    )


def class_totals(class_counts_df: DataFrame, group_cols=("organism",)) -> DataFrame:
    """Sum of per-structure class counts over an organism."""
    return class_counts_df.groupBy(*group_cols, "cath_id").agg(F.sum(F.col("count").cast("long")).alias("count"))


def organism_stats(reports: DataFrame, group_col: str = "organism", value_col: str = "mean_plddt",
                   exclude_zero: bool = False) -> DataFrame:
    """Mean and sample standard deviation of per-structure means (unweighted, zeros included by default)."""
    r = reports.where(F.col(value_col) != 0) if exclude_zero else reports
    return r.groupBy(group_col).agg(
        F.avg(value_col).alias("mean_plddt"), F.stddev_samp(value_col).alias("stddev_plddt"))


#: Components are added as whole numbers of this fraction, so that a sum is the same in any order.
POOL_UNIT = 2.0 ** -40


def vector_sums(df: DataFrame, group_cols, vector_col: str) -> DataFrame:
    """``group_cols, n, sums``: rows and the component sums (in units of ``POOL_UNIT``, ``array<decimal>``) of each group.

    Partial sums per (group, dimension) are formed where the rows are read, so a large group never sits in one task; a
    group's sums are put together in the order of the dimensions afterwards. Null vectors are not counted; a null
    component counts as 0."""
    fixed = F.round(F.coalesce(F.col("_v").cast("double"), F.lit(0.0)) / F.lit(POOL_UNIT)).cast("decimal(28,0)")
    e = df.select(*group_cols, F.posexplode(vector_col).alias("dim", "_v"))
    per = e.groupBy(*group_cols, "dim").agg(F.sum(fixed).cast("decimal(38,0)").alias("s"), F.count(F.lit(1)).alias("n"))
    one = per.groupBy(*group_cols).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("dim", "s"))).alias("_d"))
    return one.select(*group_cols, "n", F.transform("_d", lambda x: x["s"]).alias("sums"))


def mean_pool(df: DataFrame, group_cols, vector_col: str) -> DataFrame:
    """The mean vector of each group, as one ``array<double>`` (``pooled``)."""
    n = F.col("n").cast("double")
    return vector_sums(df, group_cols, vector_col).select(
        *group_cols, "n", F.transform("sums", lambda s: s.cast("double") * F.lit(POOL_UNIT) / n).alias("pooled"))


def metadata_value(metadata, key: str):
    """Value of ``key`` in a metadata JSON string (null when absent)."""
    c = F.col(metadata) if isinstance(metadata, str) else metadata
    return F.get_json_object(c, f"$.{key}")
