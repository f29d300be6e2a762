"""Atom-table operators: filters, residue mapping, alternative locations,
backbone completeness, ordered sequences and coordinates, gaps, frames.

Every operator keys on the structure columns given as ``keys`` (for example
``["structure_id", "chain"]``), so many structures run in one job and each
window or aggregate shuffles on the structure key only once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    ATOM_READER_EXTRA, BACKBONE_ATOMS, EXCLUDED_RESIDUES, FRAME_EPS, MAX_TARGET_RESIDUES, RESIDUE_CODE_GAP, RESIDUE_CODE_ORDER,
    RESIDUE_CODE_RARE, RESIDUE_LETTERS, SPECIAL_RESIDUES, UNKNOWN_LETTER,
)


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def filter_chain(atoms: DataFrame, chain: str) -> DataFrame:
    return atoms.where(F.trim(F.col("chain")) == chain)


def filter_in(atoms: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose ``column`` is in ``values`` (a list, or a one-column DataFrame for long lists)."""
    if isinstance(values, DataFrame):
        vcol = values.columns[0]
        return atoms.join(values.select(F.col(vcol).alias(column)).distinct(), column, "left_semi")
    return atoms.where(F.col(column).isin(list(values)))


def filter_residues(atoms: DataFrame, ignore_h: bool = False, col13: str | None = "name_col13") -> DataFrame:
    """Drop excluded residues and records whose atom-name column 13 is a digit; optionally hydrogens."""
    cond = ~F.col("resn").isin(EXCLUDED_RESIDUES)
    if col13 is not None and col13 in atoms.columns:
        cond = cond & ~F.coalesce(F.col(col13).rlike("^[0-9]$"), F.lit(False))
    if ignore_h:
        cond = cond & ~F.col("atom").startswith("H")
    return atoms.where(cond)


def map_special_residues(atoms: DataFrame) -> DataFrame:
    """Non-standard residues are read as their standard form (MSE -> MET, ...)."""
    return atoms.withColumn("resn", F.coalesce(_map(SPECIAL_RESIDUES)[F.col("resn")], F.col("resn")))


def keep_backbone_atoms(atoms: DataFrame) -> DataFrame:
    return atoms.where(F.col("atom").isin(BACKBONE_ATOMS))


def resolve_altloc(atoms: DataFrame, keys, order_extra=()) -> DataFrame:
    """Several copies of one atom in a residue: keep the highest occupancy; ties go to the
    later record (larger type, then larger serial)."""
    w = Window.partitionBy(*keys, "resi", "atom").orderBy(
        F.col("occ").desc(), F.col("type").desc(), F.col("serial").desc(), *[F.col(c).desc() for c in order_extra])
    return atoms.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def backbone_flags(atoms: DataFrame, keys) -> DataFrame:
    """Per residue: how many of N, CA, C, O it has and whether all four are there."""
    g = atoms.where(F.col("atom").isin(BACKBONE_ATOMS)).groupBy(*keys, "resi").agg(
        F.count_distinct("atom").alias("n_backbone"))
    return g.withColumn("complete", F.col("n_backbone") == 4)


def complete_backbone(atoms: DataFrame, keys, missing: bool = False) -> DataFrame:
    """Keep atoms of residues with N, CA, C and O (``missing=True``: the residues without)."""
    ok = backbone_flags(atoms, keys).where("complete").select(*keys, "resi")
    return atoms.join(ok, [*keys, "resi"], "left_anti" if missing else "left_semi")


def residue_letter(resn, extra=None) -> Column:
    """Three-letter name -> one letter, ``X`` for anything unknown."""
    c = F.col(resn) if isinstance(resn, str) else resn
    return F.coalesce(_map({**RESIDUE_LETTERS, **(extra if extra is not None else ATOM_READER_EXTRA)})[c],
                      F.lit(UNKNOWN_LETTER))


def residue_code(letter) -> Column:
    """Letter -> integer code: ARNDCQEGHILKMFPSTWYV -> 0..19, BJOUXZ -> 20, '-' '.' -> 21, else null."""
    c = F.col(letter) if isinstance(letter, str) else letter
    i = F.instr(F.lit(RESIDUE_CODE_ORDER), c)
    return (F.when((F.length(c) == 1) & (i > 0), i - 1)
            .when((F.length(c) == 1) & (F.instr(F.lit(RESIDUE_CODE_RARE), c) > 0), F.lit(20))
            .when((F.length(c) == 1) & (F.instr(F.lit(RESIDUE_CODE_GAP), c) > 0), F.lit(21)))


def ordered_sequence(ca: DataFrame, keys, letter_col: str = "aa", order_col: str = "resi") -> DataFrame:
    """Ordered one-letter sequence per structure (array_sort of (order, letter) structs)."""
    g = ca.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(letter_col).alias("v")))).alias("_s"))
    return g.select(*keys, F.array_join(F.transform("_s", lambda s: s["v"]), "").alias("seq"), F.size("_s").alias("n_res"))


def ordered_coords(ca: DataFrame, keys, order_col: str = "resi") -> DataFrame:
    """Ordered coordinate array per structure: ``array<struct<x,y,z>>``."""
    g = ca.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col(order_col).alias("o"), F.col("x").alias("x"), F.col("y").alias("y"), F.col("z").alias("z")))).alias("_c"))
    return g.select(*keys, F.transform("_c", lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"), s["z"].alias("z"))).alias("coords"))


def residue_gaps(residues: DataFrame, keys, pad: str = "PAD") -> DataFrame:
    """Every residue number between the first and last of a structure; missing ones get ``pad``."""
    rng = residues.groupBy(*keys).agg(F.min("resi").alias("_lo"), F.max("resi").alias("_hi"))
    full = rng.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("resi"))
    have = residues.select(*keys, "resi", "resn")
    j = full.join(have, [*keys, "resi"], "left")
    return j.select(*keys, "resi", F.coalesce("resn", F.lit(pad)).alias("resn"), F.col("resn").isNull().alias("missing"))


def residue_frames(backbone: DataFrame, keys, eps: float = FRAME_EPS) -> DataFrame:
    """Local frame per residue from N, CA, C by Gram-Schmidt: e1 along CA-N, e2 from C-CA, e3 = e1 x e2,
    origin CA. The three atoms are pivoted to columns with one aggregate."""
    p = backbone.where(F.col("atom").isin("N", "CA", "C")).groupBy(*keys, "resi").agg(
        *[F.first(F.when(F.col("atom") == a, F.col(c)), ignorenulls=True).alias(f"{a}_{c}")
          for a in ("N", "CA", "C") for c in ("x", "y", "z")])
    p = p.where(F.col("N_x").isNotNull() & F.col("CA_x").isNotNull() & F.col("C_x").isNotNull())
    v1 = [F.col(f"CA_{c}") - F.col(f"N_{c}") for c in "xyz"]
    v2 = [F.col(f"C_{c}") - F.col(f"CA_{c}") for c in "xyz"]
    n1 = F.sqrt(v1[0] * v1[0] + v1[1] * v1[1] + v1[2] * v1[2] + F.lit(eps))
    p = p.select(*keys, "resi", *[F.col(f"CA_{c}").alias(f"t_{c}") for c in "xyz"],
                 *[(v1[i] / n1).alias(f"e1_{c}") for i, c in enumerate("xyz")], *[v2[i].alias(f"v2_{c}") for i, c in enumerate("xyz")])
    dot = sum(F.col(f"e1_{c}") * F.col(f"v2_{c}") for c in "xyz")
    p = p.select("*", *[(F.col(f"v2_{c}") - F.col(f"e1_{c}") * dot).alias(f"u2_{c}") for c in "xyz"])
    n2 = F.sqrt(sum(F.col(f"u2_{c}") * F.col(f"u2_{c}") for c in "xyz") + F.lit(eps))
    p = p.select(*keys, "resi", *[F.col(f"t_{c}") for c in "xyz"], *[F.col(f"e1_{c}") for c in "xyz"],
                 *[(F.col(f"u2_{c}") / n2).alias(f"e2_{c}") for c in "xyz"])
    e1, e2 = [F.col(f"e1_{c}") for c in "xyz"], [F.col(f"e2_{c}") for c in "xyz"]
    return p.select("*", (e1[1] * e2[2] - e1[2] * e2[1]).alias("e3_x"), (e1[2] * e2[0] - e1[0] * e2[2]).alias("e3_y"),
                    (e1[0] * e2[1] - e1[1] * e2[0]).alias("e3_z"))


def structure_atoms(records: DataFrame, keys, chain: str | None = None, ignore_h: bool = False,
                    order_extra=()) -> DataFrame:
    """The segment reader end to end: record choice, residue filters, special residues,
    backbone atoms, chain, alternative locations, complete backbone."""
    from ..sources.structures import select_structure_records

    a = select_structure_records(records)
    a = filter_residues(a, ignore_h=ignore_h)
    a = map_special_residues(a)
    a = keep_backbone_atoms(a)
    if chain is not None:
        a = filter_chain(a, chain)
    a = resolve_altloc(a, keys, order_extra)
    return complete_backbone(a, keys)


def residue_sequence(text) -> Column:
    """The residue letters of a text (the 20 standard one-letter codes), in order."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(c, "[^" + "".join(sorted(RESIDUE_LETTERS.values())) + "]", "")


def truncate_residues(seq, n: int = MAX_TARGET_RESIDUES) -> Column:
    """First ``n`` residues of a sequence (the target database keeps 2000)."""
    c = F.col(seq) if isinstance(seq, str) else seq
    return F.substring(c, 1, n)


def encode_sequence(seq) -> Column:
    """Integer code of each position, as ``array<tinyint>``: letters by their place in the fixed order, rare letters 20,
    gaps 21; null for any other character.

    The letters are first translated to one run of characters, so that a code is a character's distance from ``A``."""
    c = F.col(seq) if isinstance(seq, str) else seq
    known = RESIDUE_CODE_ORDER + RESIDUE_CODE_RARE + RESIDUE_CODE_GAP
    place = [*range(len(RESIDUE_CODE_ORDER)), *[len(RESIDUE_CODE_ORDER)] * len(RESIDUE_CODE_RARE), *[len(RESIDUE_CODE_ORDER) + 1] * len(RESIDUE_CODE_GAP)]
    shifted = F.translate(F.regexp_replace(c, "[^" + known.replace("-", "\\-") + "]", "~"), known, "".join(chr(ord("A") + i) for i in place))
    letters = F.filter(F.split(shifted, ""), lambda x: x != "")
    return F.transform(letters, lambda x: F.when(x != "~", (F.ascii(x) - ord("A")).cast("tinyint")))


def one_hot(codes) -> Column:
    """Packed one-hot vectors of width 20, one ``int`` a position: bit k is set for code k; no bit for codes that are no
    standard residue."""
    c = F.col(codes) if isinstance(codes, str) else codes
    return F.transform(c, lambda x: F.when(x < len(RESIDUE_CODE_ORDER), F.call_function("shiftleft", F.lit(1), x.cast("int"))).otherwise(F.lit(0)))
