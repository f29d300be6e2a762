"""Helpers shared by the operators of this folder: input columns, written tables, ranks without a hot window."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foldframe.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Rows that one ranking window holds on average; more rows make more windows, not larger ones.
CELL_ROWS = 4096


#: Documents of one Arrow batch: the JVM's buffers and a worker's copies hold batches whole, and texts can be long.
BATCH_ROWS = 1000


def ready(df: DataFrame) -> DataFrame:
    """Checkpoint folder, shipped package and batch size for the session of ``df``."""
    ensure_checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string`` of any table; a null text is empty, other columns are not read."""
    return ready(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                              F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def binary_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text binary`` (UTF-8) of any table; a null text is empty."""
    return texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Memory that is free in this worker goes back to the system: Spark keeps workers for later tasks, and one that keeps
    what its largest task took counts against the executor ever after."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], ddl: str, keep: list[str] | None = None,
                done: Callable[[], None] = give_back) -> DataFrame:
    """``fn`` turns the columns of one Arrow batch (lists) into output columns (lists or arrays); ``done`` ends a task.

    The columns in ``keep`` pass unchanged, before the others, as ``k0``, ``k1``, ... whatever their names are."""
    keep = keep or []
    new = T.StructType.fromDDL(ddl)
    struct = T.StructType([*[T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)], *new.fields])
    schema = to_arrow_schema(struct)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                col = dict(zip(names, batch.columns))
                out = fn({n: c.to_pylist() for n, c in col.items() if n not in keep})
                arrays = [*[col[c].cast(f.type) for c, f in zip(keep, schema)], *[pa.array(out[f.name], type=f.type) for f in list(schema)[len(keep):]]]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                del batch, col, out, arrays
        done()

    return df.mapInArrow(run, struct)


def ranked(df: DataFrame, group: list[str], order: list[str | Column], spread: Column, rows: int, out: str = "rank") -> DataFrame:
    """0-based rank of each row in its group, whatever the size of the group.

    Rows of a group are dealt to cells by ``spread`` (a non-negative hash); windows run inside a cell only, and a
    running sum over the cells of a group (one row for each cell) gives every cell its first rank. ``order`` breaks
    ties inside a cell, so the rank is fixed by the data."""
    cells = max(1, rows // CELL_ROWS)
    d = df.withColumn("_cell", F.pmod(spread, F.lit(cells)).cast("long"))
    keys = [*group, "_cell"]
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_of{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    local = Window.partitionBy(*keys).orderBy(*order)
    d = d.withColumn("_local", F.row_number().over(local) - 1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_of{i}"))
    return d.join(first, same).select(*df.columns, (F.col("_first") + F.col("_local")).cast("long").alias(out))
