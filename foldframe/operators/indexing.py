"""Dense row numbers over a sorted table without a single-partition window.

``row_number()`` over a window with no (or a very large) partition key runs in one task.
Here the table is range-partitioned on the sort key, every partition counts its rows per group
(a table with one row per partition and group), prefix sums of those counts give each
partition's offset, and the final number is offset + row number inside the partition.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written


def dense_index(df: DataFrame, order_cols, group_cols=(), out: str = "rn", partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order_cols`` order, restarting per ``group_cols``.

    ``order_cols`` must give a total order inside a group."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *group_cols, *order_cols).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
    d = d.withColumn("_lrn", F.row_number().over(local))
    # The counts below and the rows they are joined to must see the same partitioning. Range
    # bounds come from sampling the input, whose row order after a shuffle is not fixed, so a
    # second evaluation could cut the ranges elsewhere: materialise the numbered rows once.
    d = written(d, "numbered")
    counts = d.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_cnt"))
    ow = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(ow), F.lit(0))).drop("_cnt")
    # offsets has one row per (partition, group): a size bounded by partitions x groups
    d = d.join(F.broadcast(offsets) if not group_cols else offsets, ["_pid", *group_cols])
    return d.withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long")).drop("_pid", "_lrn", "_off")


#: Entries that one window of the scan over an index holds, and ranges that one node of the carry tree holds: two levels
#: cover 2^48 entries.
RANGE_ROWS = FAN = 1 << 16


def _carried(ranges: DataFrame, fan: int) -> DataFrame:
    """``_rng, _before, _after``: the largest ``s`` of the ranges before and the smallest ``e`` of those after each range.

    A tree: windows run over the ``fan`` ranges of a node, the nodes' totals are the root's rows, and what the root
    carries comes back to the nodes by an equi-join."""
    def scans(d: DataFrame, node: str, key: str) -> DataFrame:
        up = Window.partitionBy(node).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        down = Window.partitionBy(node).orderBy(F.col(key).desc()).rowsBetween(Window.unboundedPreceding, -1)
        return d.withColumn("_before", F.max("s").over(up)).withColumn("_after", F.min("e").over(down))

    d = ranges.select("_rng", "s", "e", F.floor(F.col("_rng") / fan).alias("_node"))
    nodes = d.groupBy("_node").agg(F.max("s").alias("s"), F.min("e").alias("e")).withColumn("_root", F.col("_node") * 0)
    above = scans(nodes, "_root", "_node").select("_node", F.col("_before").alias("_nb"), F.col("_after").alias("_na"))
    return scans(d, "_node", "_rng").join(above, "_node").select(
        "_rng", F.coalesce("_before", "_nb").alias("_before"), F.coalesce("_after", "_na").alias("_after"))


def run_bounds(df: DataFrame, order_col: str, key_col: str, start: str = "run_start", end: str = "run_end",
               range_rows: int = RANGE_ROWS, fan: int = FAN) -> DataFrame:
    """For a table keyed by an integer ``order_col``: first and last ``order_col`` of the current run of equal
    ``key_col`` values (runs break at a gap in ``order_col`` or a new key).

    The rows are exchanged once, into ranges of ``range_rows`` consecutive values; windows run inside a range. What
    crosses ranges is a written table with one row a range (its edges, its last inner start and first inner end), whose
    carries run up a tree (``_carried``) and come back by a join on the range the rows are dealt by already. No step
    is keyed by ``key_col``, so a name that a third of the table has is no hot key."""
    d = df.withColumn("_rng", F.floor(F.col(order_col) / range_rows))
    w = Window.partitionBy("_rng").orderBy(order_col)
    down = Window.partitionBy("_rng").orderBy(F.col(order_col).desc())
    here, key = F.col(order_col), F.col(key_col)
    d = d.withColumn("_fresh", (F.lag(order_col).over(w) != here - 1) | ~F.lag(key_col).over(w).eqNullSafe(key))
    d = d.withColumn("_last", (F.lag(order_col).over(down) != here + 1) | ~F.lag(key_col).over(down).eqNullSafe(key))
    first_row, last_row = F.lag(order_col).over(w).isNull(), F.lag(order_col).over(down).isNull()
    d = d.withColumn("_s", F.when(~first_row & F.col("_fresh"), here)).withColumn("_e", F.when(~last_row & F.col("_last"), here))
    grow = Window.unboundedPreceding
    d = d.withColumn("_ls", F.max("_s").over(w.rowsBetween(grow, 0))).withColumn("_le", F.min("_e").over(down.rowsBetween(grow, 0)))
    d = d.drop("_fresh", "_last")
    edges = d.groupBy("_rng").agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi"), F.min_by(key_col, order_col).alias("lk"),
                                  F.max_by(key_col, order_col).alias("hk"), F.max("_s").alias("s"), F.min("_e").alias("e"))
    edges = written(edges, "range-edges")  # read several times below; a row a range
    prev = edges.select((F.col("_rng") + 1).alias("_rng"), F.col("hi").alias("phi"), F.col("hk").alias("phk"))
    nxt = edges.select((F.col("_rng") - 1).alias("_rng"), F.col("lo").alias("nlo"), F.col("lk").alias("nlk"))
    joined = edges.join(prev, "_rng", "left").join(nxt, "_rng", "left")
    opens = F.coalesce((F.col("phi") == F.col("lo") - 1) & F.col("phk").eqNullSafe(F.col("lk")), F.lit(False))  # goes on from the range before
    stays = F.coalesce((F.col("nlo") == F.col("hi") + 1) & F.col("nlk").eqNullSafe(F.col("hk")), F.lit(False))  # goes on in the range after
    joined = joined.select("_rng", opens.alias("opens"), stays.alias("stays"), "lo", "hi",
                           F.coalesce("s", F.when(~opens, F.col("lo"))).alias("s"), F.coalesce("e", F.when(~stays, F.col("hi"))).alias("e"))
    carry = joined.join(_carried(joined, fan), "_rng")
    carry = carry.select("_rng", F.when(F.col("opens"), F.col("_before")).otherwise(F.col("lo")).alias("_first"),
                         F.when(F.col("stays"), F.col("_after")).otherwise(F.col("hi")).alias("_final"))
    d = d.join(carry, "_rng")
    return d.withColumns({start: F.coalesce("_ls", "_first"), end: F.coalesce("_le", "_final")}).drop("_rng", "_s", "_e", "_ls", "_le", "_first", "_final")


def run_starts(df: DataFrame, order_col: str, key_col: str, out: str = "run_start", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``run_bounds`` without the ends."""
    return run_bounds(df, order_col, key_col, out, "_run_end", range_rows).drop("_run_end")
