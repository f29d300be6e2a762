"""Registered queries: atom records, filters, alternative locations, backbone, sequences, frames."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import EXCLUDED_RESIDUES, RESIDUE_CODE_ORDER, RESIDUE_CODE_RARE, RESIDUE_LETTERS, SPECIAL_RESIDUES
from ..operators import atoms as A
from ..session import scratch_path
from ..sources import bundles as BN
from ..sources import structures as ST
from ..sources.store import written
from . import views as VW
from .registry import register

KEYS = ["sid", "chain"]
R4 = 4

_specials_sql = ", ".join(f"'{k}'" for k in SPECIAL_RESIDUES)
_excluded_sql = ", ".join(f"'{k}'" for k in EXCLUDED_RESIDUES)
_special_case = "CASE resn " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPECIAL_RESIDUES.items()) + " ELSE resn END"
_letters_case = "CASE resn " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RESIDUE_LETTERS.items())

# The segment reader as SQL: record choice, residue filters, special residues, backbone atoms,
# alternative locations, complete backbone.
SQL_CLEAN = VW.with_ctes(VW.SQL_ATOMS_V, f"""sel AS (
  SELECT * FROM atoms_v
  WHERE (type = 'ATOM' OR (type = 'HETATM' AND resn IN ({_specials_sql})))
    AND resn NOT IN ({_excluded_sql}) AND NOT regexp_matches(name_col13, '^[0-9]$')),
mapped AS (SELECT * REPLACE ({_special_case} AS resn) FROM sel WHERE atom IN ('C', 'N', 'CA', 'O')),
alt AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sid, chain, resi, atom
                                 ORDER BY occ DESC, type DESC, serial DESC, aux DESC) AS rn FROM mapped)
  WHERE rn = 1),
bb AS (SELECT sid, chain, resi, count(DISTINCT atom) AS n_backbone FROM alt GROUP BY sid, chain, resi),
clean AS (SELECT a.* FROM alt a JOIN bb USING (sid, chain, resi) WHERE bb.n_backbone = 4)""")


def selected(spark, sf):
    a = VW.atoms_v(spark, sf)
    a = ST.select_structure_records(a)
    a = A.filter_residues(a)
    return A.map_special_residues(a)


def altloc(spark, sf):
    return A.resolve_altloc(A.keep_backbone_atoms(selected(spark, sf)), KEYS, order_extra=("aux",))


def clean_atoms(spark, sf):
    return A.complete_backbone(altloc(spark, sf), KEYS)


@register("src_atoms", VW.with_ctes(VW.SQL_ATOMS_V) + f"""
SELECT sid, CAST(serial AS INTEGER) AS serial, type, atom, resn, chain, resi, x, y, z, occ, b
FROM atoms_v WHERE type = 'ATOM' OR (type = 'HETATM' AND resn IN ({_specials_sql}))""")
def q_src_atoms(spark, sf):
    files = structure_files(spark, sf)
    parsed = ST.select_structure_records(ST.parse_records(ST.explode_lines(files, "sid")))
    return parsed.select("sid", "serial", "type", "atom", "resn", "chain", "resi", "x", "y", "z", "occ", "b")


def structure_files(spark, sf):
    """The atom view as structure files (records in serial order), written to a bundled store and read back whole."""
    a = VW.atoms_v(spark, sf)
    path = scratch_path(spark, "structures")
    lines = written(a.select("sid", "serial", "aux", ST.render_records(a).alias("line")), "structure-lines")
    BN.write_bundles(lines, path, "sid", ["serial", "aux"])
    return BN.read_bundles(spark, path, "sid").select("sid", F.array_join("lines", "\n").alias("content"))


@register("filter_residues", VW.with_ctes(VW.SQL_ATOMS_V) + f"""
SELECT sid, serial, atom, resn FROM atoms_v
WHERE resn NOT IN ({_excluded_sql}) AND NOT regexp_matches(name_col13, '^[0-9]$') AND NOT starts_with(atom, 'H')""")
def q_filter_residues(spark, sf):
    return A.filter_residues(VW.atoms_v(spark, sf), ignore_h=True).select("sid", "serial", "atom", "resn")


@register("map_special_residue", VW.with_ctes(VW.SQL_ATOMS_V) + f"""
SELECT sid, serial, {_special_case} AS resn FROM atoms_v""")
def q_map_special_residue(spark, sf):
    return A.map_special_residues(VW.atoms_v(spark, sf)).select("sid", "serial", "resn")


@register("filter_chain", VW.with_ctes(VW.SQL_ATOMS_V) + """
SELECT sid, serial, chain FROM atoms_v WHERE trim(chain) = 'O'""")
def q_filter_chain(spark, sf):
    return A.filter_chain(VW.atoms_v(spark, sf), "O").select("sid", "serial", "chain")


@register("filter_atoms", VW.with_ctes(VW.SQL_ATOMS_V) + """
SELECT sid, serial, atom, resn, resi FROM atoms_v
WHERE atom IN ('CA', 'N') AND resn IN ('ALA', 'GLY', 'MSE') AND resi IN (SELECT DISTINCT CAST(p_size AS INTEGER) FROM part)""")
def q_filter_atoms(spark, sf):
    a = A.filter_in(VW.atoms_v(spark, sf), "atom", ["CA", "N"])
    a = A.filter_in(a, "resn", ["ALA", "GLY", "MSE"])
    sizes = VW.table(spark, sf, "part").select(F.col("p_size").cast("int").alias("resi"))
    a = A.filter_in(a, "resi", sizes)  # long lists arrive as a table: left-semi join
    return a.select("sid", "serial", "atom", "resn", "resi")


@register("win_altloc", SQL_CLEAN + """
SELECT sid, chain, resi, atom, serial, occ FROM alt""")
def q_win_altloc(spark, sf):
    return altloc(spark, sf).select("sid", "chain", "resi", "atom", "serial", "occ")


@register("agg_backbone_complete", SQL_CLEAN + """
SELECT sid, chain, resi, CAST(n_backbone AS BIGINT) AS n_backbone, n_backbone = 4 AS complete FROM bb""")
def q_agg_backbone_complete(spark, sf):
    return A.backbone_flags(altloc(spark, sf), KEYS).select(
        "sid", "chain", "resi", F.col("n_backbone").cast("long").alias("n_backbone"), "complete")


@register("sort_residues", SQL_CLEAN + """
SELECT sid, chain, CAST(row_number() OVER (PARTITION BY sid, chain ORDER BY resi, type, serial) AS BIGINT) AS ordinal,
       resi, atom FROM clean""")
def q_sort_residues(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy(*KEYS).orderBy("resi", "type", "serial")
    return clean_atoms(spark, sf).select("sid", "chain", F.row_number().over(w).cast("long").alias("ordinal"), "resi", "atom")


@register("agg_sequence", SQL_CLEAN + f"""
SELECT sid, chain, string_agg({_letters_case} ELSE 'X' END, '' ORDER BY resi) AS seq, CAST(count(*) AS BIGINT) AS n_res
FROM clean WHERE atom = 'CA' GROUP BY sid, chain""")
def q_agg_sequence(spark, sf):
    ca = clean_atoms(spark, sf).where(F.col("atom") == "CA").withColumn("aa", A.residue_letter("resn"))
    return A.ordered_sequence(ca, KEYS).select("sid", "chain", "seq", F.col("n_res").cast("long").alias("n_res"))


@register("agg_coords", SQL_CLEAN + """
SELECT sid, chain, CAST(count(*) AS BIGINT) AS n_res,
       string_agg(printf('%.3f,%.3f,%.3f', x, y, z), ';' ORDER BY resi) AS coords
FROM clean WHERE atom = 'CA' GROUP BY sid, chain""")
def q_agg_coords(spark, sf):
    ca = clean_atoms(spark, sf).where(F.col("atom") == "CA")
    c = A.ordered_coords(ca, KEYS)
    txt = F.array_join(F.transform("coords", lambda p: F.format_string("%.3f,%.3f,%.3f", p["x"], p["y"], p["z"])), ";")
    return c.select("sid", "chain", F.size("coords").cast("long").alias("n_res"), txt.alias("coords"))


@register("src_ca_trace", VW.with_ctes(VW.SQL_ATOMS_V) + f"""
SELECT sid, chain, string_agg(CASE WHEN resn = 'UNK' THEN 'X' ELSE coalesce(({_letters_case} END), 'X') END, ''
                              ORDER BY serial, aux) AS seq,
       CAST(count(*) AS BIGINT) AS n_res
FROM atoms_v WHERE type = 'ATOM' AND atom = 'CA' GROUP BY sid, chain""")
def q_src_ca_trace(spark, sf):
    lines = ST.explode_lines(structure_files(spark, sf), "sid", first_model=False)
    ca = ST.ca_trace(lines, chain=None)
    return A.ordered_sequence(ca, KEYS, order_col="line_no").select(
        "sid", "chain", "seq", F.col("n_res").cast("long").alias("n_res"))


@register("fn_residue_letter", VW.with_ctes(VW.SQL_ATOMS_V) + f"""
SELECT resn, CASE WHEN resn = 'PAD' THEN 'X' ELSE coalesce(({_letters_case} END), 'X') END AS letter,
       CAST(count(*) AS BIGINT) AS n
FROM atoms_v GROUP BY resn""")
def q_fn_residue_letter(spark, sf):
    a = VW.atoms_v(spark, sf)
    return a.groupBy("resn").agg(F.count(F.lit(1)).alias("n")).select("resn", A.residue_letter("resn").alias("letter"), "n")


_ENCODED = "[^" + RESIDUE_CODE_ORDER + RESIDUE_CODE_RARE + ".-]"


@register("fn_encode_sequence", f"""
WITH s AS (SELECT doc_id, regexp_replace(text, '{_ENCODED}', '', 'g') AS seq FROM documents),
c AS (SELECT doc_id, [CASE WHEN instr('{RESIDUE_CODE_ORDER}', x) > 0 THEN instr('{RESIDUE_CODE_ORDER}', x) - 1
                           WHEN instr('{RESIDUE_CODE_RARE}', x) > 0 THEN 20 ELSE 21 END FOR x IN string_split(seq, '') IF x <> ''] AS codes FROM s)
SELECT doc_id, CAST(len(codes) AS INTEGER) AS n, md5(array_to_string(codes, ',')) AS codes_md5,
       md5(array_to_string([CASE WHEN k < 20 THEN CAST(1 << k AS BIGINT) ELSE 0 END FOR k IN codes], ',')) AS one_hot_md5,
       CAST(coalesce(list_sum(codes), 0) AS BIGINT) AS code_sum FROM c""")
def q_fn_encode_sequence(spark, sf):
    """Codes and packed one-hot vectors of each position of each document's letters, compared by digest."""
    d = VW.table(spark, sf, "documents").select("doc_id", A.encode_sequence(F.regexp_replace("text", _ENCODED, "")).alias("codes"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return d.select("doc_id", F.size("codes").alias("n"), F.md5(text(F.col("codes"))).alias("codes_md5"), F.md5(text(A.one_hot("codes"))).alias("one_hot_md5"),
                    F.aggregate("codes", F.lit(0).cast("long"), lambda a, x: a + x).alias("code_sum"))


@register("truncate_residues", """
WITH s AS (SELECT doc_id, regexp_replace(text, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS seq FROM documents)
SELECT doc_id, CAST(length(seq) AS BIGINT) AS n_total, CAST(least(length(seq), 2000) AS BIGINT) AS n_kept,
       md5(substr(seq, 1, 2000)) AS kept_md5 FROM s""")
def q_truncate_residues(spark, sf):
    d = VW.table(spark, sf, "documents").select("doc_id", A.residue_sequence("text").alias("seq"))
    kept = A.truncate_residues("seq")
    return d.select("doc_id", F.length("seq").cast("long").alias("n_total"), F.length(kept).cast("long").alias("n_kept"),
                    F.md5(kept).alias("kept_md5"))


@register("join_residue_gaps", SQL_CLEAN + """,
res AS (SELECT sid, chain, resi, resn FROM clean WHERE atom = 'CA'),
rng AS (SELECT sid, chain, min(resi) AS lo, max(resi) AS hi FROM res GROUP BY sid, chain),
full_r AS (SELECT sid, chain, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS resi FROM rng)
SELECT f.sid, f.chain, f.resi, coalesce(r.resn, 'PAD') AS resn, r.resn IS NULL AS missing
FROM full_r f LEFT JOIN res r USING (sid, chain, resi)""")
def q_join_residue_gaps(spark, sf):
    res = clean_atoms(spark, sf).where(F.col("atom") == "CA").select(*KEYS, "resi", "resn")
    return A.residue_gaps(res, KEYS)


@register("fn_residue_frame", SQL_CLEAN + """,
p AS (
  SELECT sid, chain, resi,
         max(x) FILTER (WHERE atom = 'N') AS nx, max(y) FILTER (WHERE atom = 'N') AS ny, max(z) FILTER (WHERE atom = 'N') AS nz,
         max(x) FILTER (WHERE atom = 'CA') AS ax, max(y) FILTER (WHERE atom = 'CA') AS ay, max(z) FILTER (WHERE atom = 'CA') AS az,
         max(x) FILTER (WHERE atom = 'C') AS cx, max(y) FILTER (WHERE atom = 'C') AS cy, max(z) FILTER (WHERE atom = 'C') AS cz
  FROM clean GROUP BY sid, chain, resi),
v AS (SELECT *, ax - nx AS v1x, ay - ny AS v1y, az - nz AS v1z, cx - ax AS v2x, cy - ay AS v2y, cz - az AS v2z FROM p),
e1 AS (SELECT *, sqrt(v1x * v1x + v1y * v1y + v1z * v1z + 1e-8) AS n1 FROM v),
e1b AS (SELECT *, v1x / n1 AS e1x, v1y / n1 AS e1y, v1z / n1 AS e1z FROM e1),
u AS (SELECT *, v2x - e1x * (e1x * v2x + e1y * v2y + e1z * v2z) AS u2x,
                v2y - e1y * (e1x * v2x + e1y * v2y + e1z * v2z) AS u2y,
                v2z - e1z * (e1x * v2x + e1y * v2y + e1z * v2z) AS u2z FROM e1b),
e2 AS (SELECT *, sqrt(u2x * u2x + u2y * u2y + u2z * u2z + 1e-8) AS n2 FROM u),
f AS (SELECT *, u2x / n2 AS e2x, u2y / n2 AS e2y, u2z / n2 AS e2z FROM e2)
SELECT sid, chain, resi,
       e1x AS e1_x, e1y AS e1_y, e1z AS e1_z,
       e2x AS e2_x, e2y AS e2_y, e2z AS e2_z,
       e1y * e2z - e1z * e2y AS e3_x, e1z * e2x - e1x * e2z AS e3_y, e1x * e2y - e1y * e2x AS e3_z,
       ax AS t_x, ay AS t_y, az AS t_z
FROM f""")
def q_fn_residue_frame(spark, sf):
    fr = A.residue_frames(clean_atoms(spark, sf), KEYS)
    cols = [f"e{i}_{c}" for i in (1, 2, 3) for c in "xyz"]
    return fr.select("sid", "chain", "resi", *cols, "t_x", "t_y", "t_z")
