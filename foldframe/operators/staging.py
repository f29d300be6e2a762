"""Staging of files in batches, with a ledger that says which batches are there.

A batch with a file that cannot be staged is recorded as failed and the others go on; a rerun stages only what the ledger
does not have. The data of an attempt are written before its ledger rows: a batch counts as staged when its row is there,
so an attempt that dies between the two is repeated by the next one, which has the same number and replaces its folder.

An attempt has a folder, with one for each organism in it; a batch is a column, in whose order the rows of a file lie. A
folder for each batch would be as slow to write and list as the small files that are staged.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import written

LEDGER = "organism string, batch long, n_files long, state string, error string, attempt int"
STAGED, FAILED = "staged", "failed"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All attempts; no rows before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger")


def stage_batches(files: DataFrame, path: str, fault: Column) -> DataFrame:
    """Stage the batches of ``files`` (``organism, batch`` and what is to be written) that are not staged yet.

    ``fault`` is null for a file that can be staged, else what is wrong with it. Returns the ledger rows of this attempt."""
    spark = files.sparkSession
    ledger = read_ledger(spark, path)
    attempt = (ledger.agg(F.max("attempt")).first()[0] or 0) + 1
    have = ledger.where(F.col("state") == STAGED).select("organism", "batch")
    todo = files.withColumn("_fault", fault).join(have, ["organism", "batch"], "left_anti")
    batches = todo.groupBy("organism", "batch").agg(F.count(F.lit(1)).alias("n_files"), F.min("_fault").alias("error"))
    state = F.when(F.col("error").isNull(), F.lit(STAGED)).otherwise(F.lit(FAILED))
    rows = written(batches.select("organism", F.col("batch").cast("long").alias("batch"), "n_files", state.alias("state"), "error", F.lit(attempt).alias("attempt")), "attempt")
    good = todo.join(rows.where(F.col("state") == STAGED).select("organism", "batch"), ["organism", "batch"], "left_semi").drop("_fault")
    good = good.sortWithinPartitions("organism", "batch")
    good.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("organism").parquet(f"{path}/data/attempt={attempt}")
    rows.write.mode("append").parquet(f"{path}/ledger")
    return rows


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Files of the batches that the ledger calls staged, with the ``attempt`` that staged them."""
    ledger = read_ledger(spark, path)
    done = ledger.where(F.col("state") == STAGED).select("organism", "batch", "attempt")
    attempts = [r["attempt"] for r in ledger.select("attempt").distinct().collect()]  # a row an attempt
    data = spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/attempt={n}" for n in sorted(attempts) or [1]])
    data = data.withColumn("organism", F.col("organism").cast("string")).withColumn("batch", F.col("batch").cast("long"))
    return data.join(done, ["organism", "batch", "attempt"])
