"""Tables that an operator writes for itself in the shared checkpoint folder."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """``df`` in as many buckets by ``columns`` as a shuffle has partitions, sorted by them, one file a bucket.

    Only a catalog table can be read as buckets, so the session needs a catalog it may write to (the built-in one will
    do). The files lie in the checkpoint folder, not in the warehouse; the entry is dropped as soon as it is resolved."""
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, *columns)  # as the buckets are dealt: one file for each
    dealt.write.format("parquet").bucketBy(n, *columns).sortBy(*columns).option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out
