"""Domain boundary strings -> residue ranges -> residues of a structure."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX

MAX_SHIFT = 3  # an end point missing from the structure may move inwards by at most 3 residues


def explode_ranges(df: DataFrame, col: str, keys, domain_sep: str = ",", segment_sep: str = "_") -> DataFrame:
    """One row per (domain, segment) of a boundary string, with parsed first/last residue."""
    d = df.select(*keys, F.explode(TX.split_domains_str(col, domain_sep, segment_sep)).alias("_r"))
    p = TX.parse_boundary(F.col("_r.range"))
    return d.select(*keys, F.col("_r.dom").alias("dom"), F.col("_r.seg").alias("seg"), F.col("_r.range").alias("range"),
                    F.col("_r.label").alias("label"), p["first"].alias("first"), p["last"].alias("last"))


def expand_to_residues(ranges: DataFrame, residues: DataFrame, keys, max_shift: int = MAX_SHIFT) -> DataFrame:
    """Move each end point inwards to the nearest residue present in the structure (at most
    ``max_shift`` steps); ``status`` says which end could not be placed, or that first >= last.

    The search window is a 4-row explode per end joined to the residue table: no range join."""
    rk = [*keys, "dom", "seg"]  # one row per (structure, domain, segment)
    res = residues.select(*keys, F.col("resi").alias("_p")).distinct()
    lo = ranges.select(*rk, F.explode(F.sequence(F.col("first"), F.col("first") + max_shift)).alias("_p"))
    hi = ranges.select(*rk, F.explode(F.sequence(F.col("last") - max_shift, F.col("last"))).alias("_p"))
    lo = lo.join(res, [*keys, "_p"]).groupBy(*rk).agg(F.min("_p").alias("first_adj"))
    hi = hi.join(res, [*keys, "_p"]).groupBy(*rk).agg(F.max("_p").alias("last_adj"))
    out = ranges.join(lo, rk, "left").join(hi, rk, "left")
    status = (F.when(F.col("first") >= F.col("last"), "first_not_below_last")
              .when(F.col("first_adj").isNull(), "start_not_found")
              .when(F.col("last_adj").isNull(), "end_not_found").otherwise("ok"))
    return out.withColumn("status", status)


def expand_domains(ranges: DataFrame, residues: DataFrame, keys, max_shift: int = MAX_SHIFT) -> DataFrame:
    """One row per domain: its residue list and where it lies in the structure.

    ``ranges``: ``keys, dom, seg, first, last``; ``residues``: the residues ``keys, resi`` that the structure has. The ends of
    each range move onto present residues (``expand_to_residues``); ``residues`` of the result lists every number of every
    range in the order of the segments (missing ones too), ``n_present`` counts those that the structure has,
    ``first, last`` are the least and largest end, ``first_idx, last_idx`` their places (from 0) among the structure's
    residues. A domain with a range that cannot be placed has that range's ``status`` and nulls.

    Points and intervals meet in equi-joins on (structure, residue number): ranges are exploded to their numbers."""
    keys = list(keys)
    placed = expand_to_residues(ranges, residues, keys, max_shift)
    seg = F.struct("seg", F.col("first_adj").alias("a"), F.col("last_adj").alias("b"), "status")
    d = placed.groupBy(*keys, "dom").agg(F.array_sort(F.collect_list(seg)).alias("_s"))
    bad = F.filter("_s", lambda x: x["status"] != "ok")
    d = d.withColumn("status", F.when(F.size(bad) > 0, F.element_at(bad, 1)["status"]).otherwise(F.lit("ok")))
    # an end that moved past the other one gives an empty range, as counting up from the first does
    numbers = F.flatten(F.transform("_s", lambda x: F.when(x["a"] <= x["b"], F.sequence(x["a"], x["b"])).otherwise(F.slice(F.array(x["a"]), 1, 0))))
    ends = F.flatten(F.transform("_s", lambda x: F.array(x["a"], x["b"])))
    ok = F.col("status") == "ok"
    d = d.select(*keys, "dom", "status", F.when(ok, numbers).alias("residues"), F.when(ok, F.array_min(ends)).alias("first"), F.when(ok, F.array_max(ends)).alias("last"))
    have = residues.select(*keys, "resi").distinct()
    at = have.withColumn("_idx", F.row_number().over(Window.partitionBy(*keys).orderBy("resi")) - 1)
    present = d.select(*keys, "dom", F.explode("residues").alias("resi")).join(have, [*keys, "resi"]).groupBy(*keys, "dom").agg(F.count(F.lit(1)).alias("n_present"))
    d = d.join(at.select(*keys, F.col("resi").alias("first"), F.col("_idx").alias("first_idx")), [*keys, "first"], "left")
    d = d.join(at.select(*keys, F.col("resi").alias("last"), F.col("_idx").alias("last_idx")), [*keys, "last"], "left")
    d = d.join(present, [*keys, "dom"], "left")
    return d.select(*keys, "dom", "status", "residues", F.when(ok, F.coalesce("n_present", F.lit(0))).alias("n_present"), "first", "last", "first_idx", "last_idx")
