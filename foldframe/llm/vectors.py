"""Rows with a usable vector, and their components as numpy arrays (operators on embeddings)."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Whole numbers up to here are exact as doubles, and so are sums of them.
EXACT = 1 << 53


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and has finite entries only; entries become doubles unless they are floats."""
    kind = df.schema[vector].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        df = df.withColumn(vector, F.col(f"`{vector}`").cast("array<double>"))
    inf = float("inf")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf))
    return df.where(F.col(vector).isNotNull() & finite)


def of_usual_size(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vector has the most frequent number of entries (the larger of two as frequent), and that number.

    A shorter vector lacks entries, so it counts as one with null entries; 0 for a table without vectors."""
    sizes = df.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = top["size"] if top else 0
    return df.where(F.size(vector) == size), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of ``size`` finite entries as the rows of a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def scaled(vectors: np.ndarray, factor: int) -> np.ndarray:
    """floor(factor * entry) as 64-bit integers."""
    x = np.floor(vectors * factor)
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        raise ValueError("an entry of a vector is too large for a 64-bit integer")
    return x.astype(np.int64)


def task_sums(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], width: int, exact: bool = False) -> list:
    """Sums by place of the arrays (``width`` numbers) that ``partial`` makes of each task's batches.

    Each task sends one row a place, combined before the shuffle: the driver gets ``width`` numbers, whatever the table's
    size. ``exact``: integers, added without overflow."""
    kind = "long" if exact else "double"
    schema = to_arrow_schema(T.StructType.fromDDL(f"at int, x {kind}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(partial(batches), type=schema.field("x").type)], schema=schema)

    sums = df.mapInArrow(run, f"at int, x {kind}").groupBy("at").agg(F.sum(F.col("x").cast("decimal(28,0)") if exact else "x").alias("x"))
    out = [0] * width
    for r in sums.collect():
        out[r["at"]] = int(r["x"]) if exact else r["x"]
    return out
