"""Bundled text store: the lines of many structures in few text files, and a manifest that says where each one is.

One file a structure does not survive a proteome: a folder of millions of small files is slow to write, list and read.
Here structures are dealt to bundles of about ``bundle_mb`` by a hash of their key; a bundle is one text file with its
structures one after the other, each in its own order, and the manifest (Parquet) has a row for each structure:
``bundle``, ``first_line`` (from 0) and ``n_lines``. Reading joins the manifest, not the lines: a bundle meets the list of
its structures and is cut into them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUNDLE_MB = 16


def write_bundles(lines: DataFrame, path: str, key: str, order: list[str], col: str = "line", bundle_mb: float = BUNDLE_MB) -> None:
    """Write ``col`` (text without line feeds) of each structure ``key`` in ``order``, which should be total in a structure.

    The manifest comes from counts, so the lines are sorted once, for writing. ``lines`` is read three times (size, manifest,
    text): pass a written table if it is costly."""
    size = lines.agg(F.sum(F.octet_length(col) + 1)).first()[0] or 0
    n = max(1, -(-size // int(bundle_mb * 1024 * 1024)))
    bundle = F.pmod(F.xxhash64(key), F.lit(n)).alias("bundle")
    counts = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n_lines")).select(key, bundle, "n_lines")
    before = Window.partitionBy("bundle").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    manifest = counts.withColumn("first_line", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    dealt = lines.select(bundle, key, *[c for c in order if c != key], F.coalesce(col, F.lit("")).alias("value"))
    (dealt.repartition("bundle").sortWithinPartitions("bundle", key, *order).select("bundle", "value")
        .write.mode("overwrite").partitionBy("bundle").text(f"{path}/text"))


def read_bundles(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``key, lines`` (array, in the order they were written), a row for each structure."""
    manifest = spark.read.parquet(f"{path}/manifest")
    listed = manifest.groupBy("bundle").agg(F.collect_list(F.struct(F.col(key).alias("k"), "first_line", "n_lines")).alias("list"))
    text = spark.read.text(f"{path}/text", wholetext=True)
    if "bundle" not in text.columns:  # nothing was written
        text = text.withColumn("bundle", F.lit(None).cast("long"))
    cut = text.join(listed, "bundle").select("list", F.split("value", "\n").alias("all"))
    one = F.transform("list", lambda e: F.struct(e["k"].alias(key), F.slice("all", (e["first_line"] + 1).cast("int"), e["n_lines"].cast("int")).alias("lines")))
    return cut.select(F.inline(one))
