"""Per-residue domain labels: runs, cleaning, renumbering, range strings, summaries.

Input is a ``residues`` DataFrame with the structure key columns, a 0-based
``pos`` (order along the chain), ``resi`` (residue number), a label column
(``domain_id``, 0 = no domain) and per-residue ``conf`` and ``b``.

The cleaning rules are order-dependent loops in the original; here every step
is a window over ``partitionBy(keys).orderBy(pos)`` (or an unordered window on
the same keys), so the data is shuffled on the structure key once and the
windows run one after the other in the same stage. Rule numbers refer to the
semantics notes in the README.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing


def _w(keys, pos="pos"):
    return Window.partitionBy(*keys).orderBy(pos)


def _all(keys):
    return Window.partitionBy(*keys)


def runs(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos", out: str = "run") -> DataFrame:
    """Maximal runs of equal labels along a chain (gaps and islands): ``run`` = 1, 2, ..."""
    w = _w(keys, pos)
    change = F.when(F.lag(label).over(w).isNull() | (F.lag(label).over(w) != F.col(label)), 1).otherwise(0)
    return df.withColumn(out, F.sum(change).over(w.rowsBetween(UNB, 0)))


def run_lengths(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos", exact: bool = False,
                out: str = "run_len") -> DataFrame:
    """Length of the run at each position. By default with the original's off-by-one (R3): the
    first run of a chain has its true length L, every later run ``max(L - 1, 1)``."""
    d = runs(df, keys, label, pos, "_run")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_run"))
    length = n if exact else F.when(F.col("_run") == 1, n).otherwise(F.greatest(n - 1, F.lit(1)))
    return d.withColumn(out, length.cast("int")).drop("_run")


def absorb_small_domains(df: DataFrame, keys, min_size: int, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """Domains with fewer than ``min_size`` residues take the label before them (R4): position 0
    never changes, label 0 is never too small, a small domain after a 0 stretch becomes 0."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*keys, label))
    first = F.min(pos).over(_all(keys))
    kept = (F.col(label) == 0) | (total >= min_size) | (F.col(pos) == first)
    fill = F.last(F.when(kept, F.col(label)), ignorenulls=True).over(_w(keys, pos).rowsBetween(UNB, 0))
    return df.withColumn(label, fill)


def absorb_terminals(df: DataFrame, keys, threshold: int, label: str = "domain_id", pos: str = "pos",
                     run_len: str = "run_len", flag: str = "clean_error") -> DataFrame:
    """Short stretches at both ends take the neighbouring label (R5).

    N end: the first position whose run length is ``>= threshold`` or whose label is 0; it and
    everything before it take the label of the next position. C end: the same from the other
    end on the labels after the N pass (run lengths unchanged). When no such position exists or
    it is the last one, the chain is left as it is and ``flag`` is set."""
    a = _all(keys)
    hi = F.max(pos).over(a)
    lo = F.min(pos).over(a)
    q1 = (F.col(run_len) >= threshold) | (F.col(label) == 0)
    i_n = F.min(F.when(q1, F.col(pos))).over(a)
    d = df.withColumn("_iN", i_n).withColumn("_hi", hi).withColumn("_lo", lo)
    nxt = F.first(F.when(F.col(pos) == F.col("_iN") + 1, F.col(label)), ignorenulls=True).over(a)
    ok_n = F.col("_iN").isNotNull() & (F.col("_iN") < F.col("_hi"))
    d = d.withColumn("_d1", F.when(ok_n & (F.col(pos) <= F.col("_iN")), nxt).otherwise(F.col(label)))
    q2 = (F.col(run_len) >= threshold) | (F.col("_d1") == 0)
    d = d.withColumn("_jC", F.max(F.when(q2, F.col(pos))).over(a))
    prv = F.first(F.when(F.col(pos) == F.col("_jC") - 1, F.col("_d1")), ignorenulls=True).over(a)
    ok_c = F.col("_jC").isNotNull() & (F.col("_jC") > F.col("_lo"))
    d = d.withColumn("_d2", F.when(ok_c & (F.col(pos) >= F.col("_jC")), prv).otherwise(F.col("_d1")))
    bad = ~(ok_n & ok_c)
    prev_flag = F.col(flag) if flag in df.columns else F.lit(False)
    return (d.withColumn(flag, prev_flag | bad)
             .withColumn(label, F.when(bad, F.col(label)).otherwise(F.col("_d2")))
             .drop("_iN", "_hi", "_lo", "_d1", "_jC", "_d2"))


def split_internal(df: DataFrame, keys, threshold: int, label: str = "domain_id", pos: str = "pos",
                   run_len: str = "run_len", flag: str = "clean_error") -> DataFrame:
    """A short stretch between the first and the last long run is divided at its lower median:
    the part before the median takes the left neighbour's label, the rest the right one's (R6).
    Adjacent short runs form one stretch. No long run at all: unchanged, ``flag`` set."""
    a = _all(keys)
    w = _w(keys, pos)
    long_ = F.col(run_len) >= threshold
    d = df.withColumn("_fl", F.min(F.when(long_, F.col(pos))).over(a)).withColumn(
        "_ll", F.max(F.when(long_, F.col(pos))).over(a))
    si = (~long_) & (F.col(pos) > F.col("_fl")) & (F.col(pos) < F.col("_ll"))
    d = d.withColumn("_si", F.coalesce(si, F.lit(False)))
    anchor_lab = F.when(~F.col("_si"), F.col(label))
    anchor_pos = F.when(~F.col("_si"), F.col(pos))
    # nearest anchor on the right = running "last non-null" in descending order: a growing frame
    # (linear per chain) instead of a shrinking unbounded-following one (quadratic per chain)
    wd = Window.partitionBy(*keys).orderBy(F.col(pos).desc()).rowsBetween(UNB, 0)
    d = (d.withColumn("_ll_lab", F.last(anchor_lab, ignorenulls=True).over(w.rowsBetween(UNB, 0)))
          .withColumn("_ll_pos", F.last(anchor_pos, ignorenulls=True).over(w.rowsBetween(UNB, 0)))
          .withColumn("_rr_lab", F.last(anchor_lab, ignorenulls=True).over(wd))
          .withColumn("_rr_pos", F.last(anchor_pos, ignorenulls=True).over(wd)))
    s = F.col("_ll_pos") + 1
    e = F.col("_rr_pos") - 1
    mid = s + F.floor((e - s) / 2)
    new = F.when(F.col("_si"), F.when(F.col(pos) < mid, F.col("_ll_lab")).otherwise(F.col("_rr_lab"))).otherwise(F.col(label))
    bad = F.col("_fl").isNull()
    prev_flag = F.col(flag) if flag in df.columns else F.lit(False)
    return (d.withColumn(flag, prev_flag | bad)
             .withColumn(label, F.when(bad, F.col(label)).otherwise(new).cast("int"))
             .drop("_fl", "_ll", "_si", "_ll_lab", "_ll_pos", "_rr_lab", "_rr_pos"))


def clean_short_runs(df: DataFrame, keys, threshold: int, label: str = "domain_id", pos: str = "pos",
                     exact_run_length: bool = False) -> DataFrame:
    """Terminal assimilation then internal split, both with the run lengths of the input labels.
    A failure in either step leaves the chain as it came in (flag ``clean_error``)."""
    d = run_lengths(df, keys, label, pos, exact=exact_run_length).withColumn("_orig", F.col(label))
    d = absorb_terminals(d, keys, threshold, label, pos, "run_len", "_e1")
    d = split_internal(d, keys, threshold, label, pos, "run_len", "_e2")
    bad = F.max((F.col("_e1") | F.col("_e2")).cast("int")).over(_all(keys)) == 1
    return (d.withColumn(label, F.when(bad, F.col("_orig")).otherwise(F.col(label)))
             .withColumn("clean_error", bad).drop("_orig", "_e1", "_e2", "run_len"))


def clean_labels(df: DataFrame, keys, min_domain: int, min_fragment: int, label: str = "domain_id",
                 pos: str = "pos") -> DataFrame:
    """Only when a chain has more than one distinct label (0 included): absorb small domains,
    then clean short runs."""
    multi = F.min(label).over(_all(keys)) != F.max(label).over(_all(keys))
    d = df.withColumn("_multi", multi).withColumn("_orig0", F.col(label))
    d = absorb_small_domains(d, keys, min_domain, label, pos)
    d = clean_short_runs(d, keys, min_fragment, label, pos)
    return (d.withColumn(label, F.when(F.col("_multi"), F.col(label)).otherwise(F.col("_orig0")))
             .withColumn("clean_error", F.col("_multi") & F.col("clean_error"))
             .drop("_multi", "_orig0"))


def renumber_first_seen(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """Nonzero ids renumbered 1..n in order of first position; 0 stays 0."""
    first = F.min(pos).over(Window.partitionBy(*keys, label))
    d = df.withColumn("_first", first).withColumn("_nz", F.col(label) != 0)
    rank = F.dense_rank().over(Window.partitionBy(*keys, "_nz").orderBy("_first"))
    return d.withColumn(label, F.when(F.col("_nz"), rank).otherwise(F.lit(0)).cast("int")).drop("_first", "_nz")


def shuffle_ids(df: DataFrame, keys, seed: int, label: str = "domain_id") -> DataFrame:
    """Nonzero ids permuted by a seeded multiplicative hash (repeatable); 0 stays 0."""
    ids = df.where(F.col(label) != 0).select(*keys, label).distinct()
    key = (F.col(label).cast("long") * F.lit(2654435761) + F.lit(seed)) % F.lit(4294967296)
    perm = ids.withColumn("_new", F.row_number().over(Window.partitionBy(*keys).orderBy(key, F.col(label))))
    j = df.join(perm, [*keys, label], "left")
    return j.withColumn(label, F.coalesce(F.col("_new"), F.lit(0)).cast("int")).drop("_new")


def natural_key(s) -> Column:
    """Sort key for natural order: the numbers in the string, as integers."""
    c = F.col(s) if isinstance(s, str) else s
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), 1), lambda x: x.cast("long"))


def domain_segments(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """Consecutive residue numbers of a domain form one segment (``resi - row_number`` islands)."""
    d = df.where(F.col(label) != 0)
    rn = F.row_number().over(Window.partitionBy(*keys, label).orderBy(pos))
    d = d.withColumn("_isl", F.col("resi") - rn)
    seg = d.groupBy(*keys, label, "_isl").agg(F.min(pos).alias("_p0"), F.first("resi").alias("_a"),
                                               F.max("resi").alias("_b"), F.count(F.lit(1)).alias("_n"))
    # first/last residue of a segment: the residue numbers rise by one along it
    seg = seg.withColumn("_a", F.col("_b") - F.col("_n") + 1)
    txt = F.when(F.col("_n") > 1, F.concat(F.col("_a").cast("string"), F.lit("-"), F.col("_b").cast("string"))).otherwise(
        F.col("_a").cast("string"))
    return seg.select(*keys, label, F.col("_p0").alias("seg_pos"), txt.alias("segment"))


def domain_strings(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """``a-b_c-d`` per domain: segments in chain order joined by ``_``."""
    seg = domain_segments(df, keys, label, pos)
    g = seg.groupBy(*keys, label).agg(F.array_sort(F.collect_list(F.struct("seg_pos", "segment"))).alias("_s"))
    return g.select(*keys, label, F.array_join(F.transform("_s", lambda x: x["segment"]), "_").alias("dom_str"))


def range_string(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """All domains of a structure: domain strings in natural order joined by ``,``."""
    ds = domain_strings(df, keys, label, pos)
    g = ds.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(natural_key("dom_str").alias("k"), F.col("dom_str").alias("s")))).alias("_d"))
    return g.select(*keys, F.array_join(F.transform("_d", lambda x: x["s"]), ",").alias("dom_str"))


def segment_summary(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """Per structure: residues, residues in and outside domains, number of domains, mean
    confidence over all residues (zeros included), range string."""
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nres"),
        F.count_if(F.col(label) != 0).alias("nres_domain"),
        F.count_distinct(F.when(F.col(label) != 0, F.col(label))).alias("ndom"),
        F.avg("conf").alias("conf"),
    )
    agg = agg.withColumn("nres_non_domain", F.col("nres") - F.col("nres_domain"))
    rs = range_string(df, keys, label, pos)
    return agg.join(rs, list(keys), "left").withColumn("dom_str", F.coalesce("dom_str", F.lit("")))


def domain_stats(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos", letter: str = "aa") -> DataFrame:
    """Per domain: number (order of ascending id, from 1), residue count, mean confidence, mean
    pLDDT, sequence and range string."""
    d = df.where(F.col(label) != 0)
    g = d.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("nres"), F.avg("conf").alias("dom_conf"), F.avg("b").alias("dom_plddt"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(letter)))), lambda x: x[letter]), "").alias("seq"))
    g = g.withColumn("domain_no", F.dense_rank().over(Window.partitionBy(*keys).orderBy(label)))
    return g.join(domain_strings(df, keys, label, pos), [*keys, label])


def quality_filter(domains: DataFrame, conf_min: float | None = None, plddt_min: float | None = None) -> DataFrame:
    """Keep domains by confidence and/or pLDDT (``>=``); no threshold keeps all."""
    cond = F.lit(True)
    if conf_min is not None:
        cond = cond & (F.col("dom_conf") >= conf_min)
    if plddt_min is not None:
        cond = cond & (F.col("dom_plddt") >= plddt_min)
    return domains.where(cond)


def domain_sizes(df: DataFrame, keys, label: str = "domain_id", min_size: int | None = None) -> DataFrame:
    """Distinct nonzero ids and their sizes; ``small`` marks those below ``min_size``."""
    g = df.where(F.col(label) != 0).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("size"))
    if min_size is not None:
        g = g.withColumn("small", F.col("size") < min_size)
    return g


def argmax_label(scores: DataFrame, keys, cls: str = "class", score: str = "score", background: str | None = "background") -> DataFrame:
    """Per residue the class with the highest score (ties: smaller class); 0 where the background flag is set."""
    best = scores.groupBy(*keys).agg(F.max_by(F.col(cls), F.struct(F.col(score), -F.col(cls))).alias("label"),
                                     *([F.max(F.col(background).cast("int")).alias("_bg")] if background else []))
    if background:
        best = best.withColumn("label", F.when(F.col("_bg") == 1, F.lit(0)).otherwise(F.col("label"))).drop("_bg")
    return best


def halving_segmenter(df: DataFrame, keys, label: str = "domain_id", pos: str = "pos") -> DataFrame:
    """Stand-in segmenter for tests: a domain's first half is part 1, its second half part 2, and the residue between
    them is in no domain (0) where the domain has four residues at least; a domain that starts at a position divisible by
    5 stays whole (1). ``conf`` is the size of the part over 64 (0 for the residue between)."""
    domain = Window.partitionBy(*keys, label)
    n, k = F.count(F.lit(1)).over(domain), F.row_number().over(domain.orderBy(pos))
    half = F.floor(n / 2)
    part = (F.when(F.min(pos).over(domain) % 5 == 0, 1).when(k <= half, 1).when((k == half + 1) & (n >= 4), 0).otherwise(2))
    d = df.withColumn("sub", part)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, label, "sub"))
    return d.withColumn("conf", F.when(F.col("sub") == 0, F.lit(0.0)).otherwise(size / 64.0))


def iterate_resegment(df: DataFrame, keys, segmenter, average_size: int, max_rounds: int = 3,
                      label: str = "domain_id", pos: str = "pos", conf: str = "conf") -> DataFrame:
    """Domains larger than ``average_size`` are sent to ``segmenter`` again, round after round, until none is left or
    ``max_rounds`` are done; only chains longer than ``2 * average_size``.

    ``segmenter(residues, keys)`` gets the residues of the selected domains (a domain is a value of ``label``, a string)
    and returns ``keys, pos, sub`` and, if it has them, new confidences ``conf``: ``sub`` 0 (or a residue that does not come
    back) means no domain, other values are the parts. A domain that comes back as one part is left as it is and never
    sent again; all others take the new parts and confidences, and their residues without a part get label 0.

    Only what a round changed goes on: a round reads the parts that the last one made, and writes those it makes. What is
    settled is not read again. A domain's name is the list of its label and its parts so far, so names cannot collide;
    at the end they are numbered per chain."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = df.columns
    name = F.array(F.col(label).cast("int"))
    start = df.withColumn("_name", F.when(F.col(label) != 0, name)).withColumn("_long", F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 2 * average_size)
    start = written(start, "labels")
    settled = [start.where(~F.col("_long") | F.col("_name").isNull()).drop("_long")]
    active = start.where(F.col("_long") & F.col("_name").isNotNull()).drop("_long")
    for _ in range(max_rounds):
        sized = active.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_name")))
        small, large = (sized.where(c).drop("_n") for c in (F.col("_n") <= average_size, F.col("_n") > average_size))
        settled.append(small)
        sent = large.withColumn(label, F.array_join("_name", "/"))
        back = segmenter(sent.drop("_name"), keys)
        new_conf = [F.col(conf).alias("_conf")] if conf in back.columns and conf in columns else []
        back = back.select(*keys, pos, F.col("sub").alias("_sub"), *new_conf)
        parts = large.join(back, [*keys, pos], "left").withColumn("_sub", F.coalesce("_sub", F.lit(0)).cast("int"))
        domain = Window.partitionBy(*keys, "_name")
        part = F.when(F.col("_sub") != 0, F.col("_sub"))
        parts = parts.withColumn("_one", F.coalesce(F.min(part).over(domain) == F.max(part).over(domain), F.lit(False)))
        if new_conf:
            parts = parts.withColumn(conf, F.when(F.col("_one"), F.col(conf)).otherwise(F.coalesce("_conf", conf)))
        split = F.when(F.col("_sub") != 0, F.concat("_name", F.array("_sub")))
        parts = parts.withColumn("_name", F.when(F.col("_one"), F.col("_name")).otherwise(split))
        parts = written(parts.select(*columns, "_name", "_one"), "parts")
        settled.append(parts.where(F.col("_one") | F.col("_name").isNull()).drop("_one"))
        active = parts.where(~F.col("_one") & F.col("_name").isNotNull()).drop("_one")
        if active.limit(1).count() == 0:
            break
    for part in settled:
        active = active.unionByName(part)
    number = F.dense_rank().over(Window.partitionBy(*keys).orderBy("_name"))
    return active.withColumn(label, F.when(F.col("_name").isNull(), F.lit(0)).otherwise(number).cast("int")).select(*columns)
