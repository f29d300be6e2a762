"""Structure files: record parsing, first model, reader rules, alternative locations, backbone."""
from pyspark.sql import functions as F

from foldframe.operators import atoms as A
from foldframe.sources import structures as ST


def rec(typ, serial, name, resn, chain, resi, x=1.0, y=2.0, z=3.0, occ=1.0, b=50.0, alt=" ", icode=" "):
    nm = name if (len(name) >= 4 or name[0].isdigit()) else " " + name
    return f"{typ:<6}{serial:>5} {nm:<4}{alt}{resn:>3} {chain:>1}{resi:>4}{icode}   {x:>8.3f}{y:>8.3f}{z:>8.3f}{occ:>6.2f}{b:>6.2f}"


FILE_A = "\n".join([
    "HEADER    TEST",
    rec("ATOM", 1, "N", "ALA", "A", 1), rec("ATOM", 2, "CA", "ALA", "A", 1), rec("ATOM", 3, "C", "ALA", "A", 1),
    rec("ATOM", 4, "O", "ALA", "A", 1),
    rec("HETATM", 5, "N", "MSE", "A", 2), rec("HETATM", 6, "CA", "MSE", "A", 2), rec("HETATM", 7, "C", "MSE", "A", 2),
    rec("HETATM", 8, "O", "MSE", "A", 2),
    rec("HETATM", 9, "CA", "HOH", "A", 3),
    rec("ATOM", 10, "CA", "UNK", "A", 4),
    rec("ATOM", 11, "1HB", "ALA", "A", 1),
    rec("ATOM", 12, "N", "GLY", "A", 5), rec("ATOM", 13, "CA", "GLY", "A", 5, occ=0.4, alt="A"),
    rec("ATOM", 14, "CA", "GLY", "A", 5, occ=0.6, alt="B", x=9.0), rec("ATOM", 15, "C", "GLY", "A", 5),
    rec("ATOM", 16, "O", "GLY", "A", 5),
    rec("ATOM", 17, "N", "SER", "A", 6), rec("ATOM", 18, "CA", "SER", "A", 6), rec("ATOM", 19, "C", "SER", "A", 6),
    rec("ATOM", 20, "N", "LYS", "A", -3), rec("ATOM", 21, "CA", "LYS", "A", -3), rec("ATOM", 22, "C", "LYS", "A", -3),
    rec("ATOM", 23, "O", "LYS", "A", -3),
    rec("ATOM", 24, "N", "VAL", "B", 1), rec("ATOM", 25, "CA", "VAL", "B", 1),
    rec("ATOM", 26, "CA", "TRP", "A", 52), rec("ATOM", 27, "CA", "TRP", "A", 52, icode="A"),
    "ENDMDL",
    rec("ATOM", 28, "N", "ALA", "A", 7), rec("ATOM", 29, "CA", "ALA", "A", 7),
    "END",
])


def parsed(spark, text=FILE_A):
    files = spark.createDataFrame([("s1", text)], "structure_id string, content string")
    return ST.parse_records(ST.explode_lines(files, "structure_id"))


def test_first_model_only(spark):
    serials = [r["serial"] for r in parsed(spark).collect()]
    assert max(serials) == 27 and 28 not in serials


def test_fixed_width_fields(spark):
    r = parsed(spark).where("serial = 14").first()
    assert (r["type"], r["atom"], r["alt"], r["resn"], r["chain"], r["resi"], r["x"], r["occ"], r["b"]) == \
        ("ATOM", "CA", "B", "GLY", "A", 5, 9.0, 0.6, 50.0)
    assert parsed(spark).where("serial = 20").first()["resi"] == -3


def test_reader_rules(spark):
    a = A.structure_atoms(parsed(spark), ["structure_id"], chain="A")
    got = {(r["resi"], r["atom"]): (r["resn"], r["serial"]) for r in a.collect()}
    # HETATM MSE is read as MET; HOH is not read; UNK excluded; 1HB dropped; SER lacks O; chain B dropped
    assert got[(2, "CA")][0] == "MET"
    assert not any(k[0] in (3, 4, 6) for k in got)
    # two locations of one CA: the higher occupancy is kept
    assert got[(5, "CA")][1] == 14
    assert (-3, "O") in got
    # insertion codes are ignored: 52 and 52A are one residue (and it has no backbone, so it is dropped)
    assert not any(k[0] == 52 for k in got)


def test_empty_and_missing_chain(spark):
    assert parsed(spark, "").count() == 0
    assert A.structure_atoms(parsed(spark), ["structure_id"], chain="Z").count() == 0


def test_render_parse_round_trip(spark):
    p = parsed(spark)
    back = ST.parse_records(p.select("structure_id", ST.render_records(p).alias("line")))
    cols = ["serial", "type", "atom", "resn", "chain", "resi", "x", "y", "z", "occ", "b"]
    assert sorted(map(tuple, p.select(cols).collect())) == sorted(map(tuple, back.select(cols).collect()))


def test_ca_trace_reader(spark):
    files = spark.createDataFrame([("s1", FILE_A)], "structure_id string, content string")
    lines = ST.explode_lines(files, "structure_id", first_model=False)
    ca = ST.ca_trace(lines, "A").orderBy("line_no")
    seq = "".join(r["aa"] for r in ca.collect())
    # ATOM records with ' CA ' only: ALA, GLY x2 (duplicates kept), SER, LYS, TRP x2, UNK -> X, and the 2nd model
    assert seq == "AXGGSKWWA"


def test_residue_codes(spark):
    df = spark.createDataFrame([(c,) for c in "ARVBXZ-.?"], "c string")
    got = [r[0] for r in df.select(A.residue_code("c")).collect()]
    assert got == [0, 1, 19, 20, 20, 20, 21, 21, None]


def test_gaps_are_padded(spark):
    res = spark.createDataFrame([(0, 1, "ALA"), (0, 4, "GLY")], "sid long, resi int, resn string")
    got = [(r["resi"], r["resn"], r["missing"]) for r in A.residue_gaps(res, ["sid"]).orderBy("resi").collect()]
    assert got == [(1, "ALA", False), (2, "PAD", True), (3, "PAD", True), (4, "GLY", False)]


def test_frames_are_orthonormal(spark):
    rows = [(0, 1, "N", 0.0, 0.0, 0.0), (0, 1, "CA", 1.5, 0.0, 0.0), (0, 1, "C", 2.0, 1.4, 0.0)]
    df = spark.createDataFrame(rows, "sid long, resi int, atom string, x double, y double, z double")
    r = A.residue_frames(df, ["sid"]).first()
    assert abs(r["e1_x"] - 1.0) < 1e-6 and abs(r["e2_y"] - 1.0) < 1e-6 and abs(r["e3_z"] - 1.0) < 1e-6
    assert (r["t_x"], r["t_y"], r["t_z"]) == (1.5, 0.0, 0.0)


def test_b_factor_written_as_truncated_integer(spark):
    from foldframe.operators import sinks as SK

    df = spark.createDataFrame([(1, "N", "MET", "A", 1, -20.123, 15.028, -6.906, 1.0, 69.52)],
                               "serial int, atom string, resn string, chain string, resi int, x double, y double, z double, occ double, b double")
    line = df.select(SK.atom_record(df)).first()[0]
    assert line == "ATOM      1  N   MET A   1     -20.123  15.028  -6.906  1.00    69"
