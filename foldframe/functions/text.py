"""Parsing of text outputs (aligner reports, report headers, domain boundary strings)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: labels of the aligner's output
LENGTH_LABEL = "Aligned length="
RMSD_LABEL = "RMSD="
IDENTITY_LABEL = "n_identical/n_aligned="
TM_LABEL = "TM-score="
ALIGNMENT_LABEL = '(":" denotes residue pairs'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_after(report, label: str, nth: int = 1) -> Column:
    """The number behind the ``nth`` occurrence of a label; null where there is none or it is no number."""
    behind = F.try_element_at(F.split(_c(report), "\\Q" + label + "\\E"), F.lit(nth + 1))
    return F.regexp_substr(F.ltrim(behind), F.lit("^[0-9]*[.]?[0-9]+")).try_cast("double")


def aligner_fields(report) -> list[Column]:
    """``len_ali, rmsd, seq_id, qtm, ttm`` from an aligner report (first two TM-scores); each null where it is missing."""
    return [
        number_after(report, LENGTH_LABEL).try_cast("int").alias("len_ali"),
        number_after(report, RMSD_LABEL).alias("rmsd"),
        number_after(report, IDENTITY_LABEL).alias("seq_id"),
        number_after(report, TM_LABEL).alias("qtm"),
        number_after(report, TM_LABEL, 2).alias("ttm"),
    ]


def alignment_lines(report) -> Column:
    """The three lines below the line that explains the alignment's signs, joined by newlines (null when absent)."""
    lines = F.split(_c(report), "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains(ALIGNMENT_LABEL)), F.lit(True))
    return F.when(at > 0, F.array_join(F.slice(lines, (at + 1).cast("int"), 3), "\n"))


def report_mean(first_line) -> Column:
    """Mean pLDDT from a report header ``#<file> Results. mean plddt: <v>``."""
    return F.trim(F.try_element_at(F.split(_c(first_line), "mean plddt:"), F.lit(2))).try_cast("double")


def parse_boundary(s) -> Column:
    """One range ``a-b`` to ``struct(first, last)``: capital letters and brackets removed, either end
    may be negative (``-5-10``, ``-5--2``). Unparseable -> nulls."""
    c = F.regexp_replace(F.regexp_replace(_c(s), "[A-Z]", ""), r"[()]", "")
    pat = r"^(-?\d+)-(-?\d+)$"
    ok = c.rlike(pat)
    return F.struct(F.when(ok, F.regexp_extract(c, pat, 1).cast("int")).alias("first"),
                    F.when(ok, F.regexp_extract(c, pat, 2).cast("int")).alias("last"))


def split_domains_str(s, domain_sep: str = ",", segment_sep: str = "_", label_sep: str = ":") -> Column:
    """``a-b_c-d:label,e-f`` -> ``array<struct<dom:int, seg:int, range:string, label:string>>``."""
    doms = F.split(_c(s), domain_sep)
    return F.flatten(F.transform(doms, lambda d, i: F.transform(
        F.split(F.element_at(F.split(d, label_sep), 1), segment_sep),
        lambda r, j: F.struct((i + 1).alias("dom"), (j + 1).alias("seg"), r.alias("range"),
                              F.when(F.size(F.split(d, label_sep)) > 1, F.element_at(F.split(d, label_sep), 2)).alias("label")))))
