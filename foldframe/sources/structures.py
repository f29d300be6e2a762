"""Structure files: read whole files, cut to the first model, parse atom records.

All parsing is column expressions on Spark (``substring`` + ``cast``); no UDF.
A file is one row until its lines are exploded, so cutting to the first
model is a per-row array operation and needs no shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CA_READER_EXTRA, EXCLUDED_RESIDUES, RESIDUE_LETTERS, SPECIAL_RESIDUES, UNKNOWN_LETTER
from ..functions import formats as FM
from ..functions import names as N

ATOM_COLUMNS = ["type", "serial", "atom", "alt", "resn", "chain", "resi", "x", "y", "z", "occ", "b"]


def read_structures(spark: SparkSession, path_glob: str, organism: str | None = None) -> DataFrame:
    """One row per file: ``organism, path, file_name, structure_id, content``.

    ``file_name`` gets ``.pdb`` appended when missing; ``structure_id`` is the
    name without it. ``organism`` defaults to the parent folder name. Spark's file sources leave
    out files without a byte, so an empty file is no row.
    """
    df = spark.read.text(path_glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return name_structures(df, organism)


def name_structures(files: DataFrame, organism: str | None = None, path_col: str = "path") -> DataFrame:
    org = F.lit(organism) if organism else F.try_element_at(F.split(F.col(path_col), "/"), F.lit(-2))
    return files.select(
        org.alias("organism"),
        F.col(path_col).alias("path"),
        N.structure_file_name(path_col).alias("file_name"),
        N.structure_id(path_col).alias("structure_id"),
        *[c for c in files.columns if c not in (path_col, "organism")],
    )


def first_model_lines(content: Column | str) -> Column:
    """Lines of a file up to (not including) the first record starting with ``END``."""
    c = F.col(content) if isinstance(content, str) else content
    lines = F.split(c, "\n")
    idx = F.array_position(F.transform(lines, lambda l: l.startswith("END")), F.lit(True))
    return F.when(idx > 0, F.slice(lines, 1, (idx - 1).cast("int"))).otherwise(lines)


def explode_lines(files: DataFrame, key_cols, content_col: str = "content", first_model: bool = True) -> DataFrame:
    """One row per line with its 0-based ``line_no``."""
    arr = first_model_lines(content_col) if first_model else F.split(F.col(content_col), "\n")
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return files.select(*keys, F.posexplode(arr).alias("line_no", "line"))


def _field(line: Column, start: int, length: int) -> Column:
    return F.substring(line, start, length)


SERIAL = "^.{6} *([0-9]+)"


def _wider(line: Column) -> Column:
    """Places by which a serial of more than five digits moves the fields behind it."""
    return F.greatest(F.length(F.regexp_extract(line, SERIAL, 1)) - 5, F.lit(0))


def parse_records(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Parse fixed-width ATOM/HETATM records (1-based columns) into typed columns; what cannot be read is null
    (``bad_records`` lists such lines), so one bad line does not end the job."""
    ln = F.col(line_col)
    rec = ln.startswith("ATOM") | ln.startswith("HETATM")
    keep = [c for c in lines.columns if c != line_col]
    serial = F.regexp_extract(ln, SERIAL, 1)
    wider = _wider(ln)

    def text(start: int, length: int) -> Column:
        return F.trim(F.substring(ln, F.lit(start) + wider, F.lit(length)))

    fields = {"serial": serial.try_cast("int"), "atom": text(13, 4), "alt": text(17, 1), "resn": text(18, 3), "chain": text(21, 2),
              "resi": text(23, 4).try_cast("int"), "x": text(31, 8).try_cast("double"), "y": text(39, 8).try_cast("double"),
              "z": text(47, 8).try_cast("double"), "occ": text(55, 6).try_cast("double"), "b": text(61, 6).try_cast("double")}
    return lines.where(rec).select(*keep, F.trim(_field(ln, 1, 6)).alias("type"), *[c.alias(n) for n, c in fields.items()],
                                   F.substring(ln, F.lit(13) + wider, F.lit(1)).alias("name_col13"))


def bad_records(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Records whose serial, residue number or position cannot be read, for quarantine."""
    parsed = parse_records(lines.withColumn("_record", F.col(line_col)), line_col)
    needed = ["serial", "resi", "x", "y", "z"]
    bad = F.lit(False)
    for n in needed:
        bad = bad | F.col(n).isNull()
    return parsed.where(bad).select(*[c for c in lines.columns if c != line_col], F.col("_record").alias(line_col))


def select_structure_records(atoms: DataFrame) -> DataFrame:
    """The segment reader's record choice: ``ATOM``, or ``HETATM`` of a special residue."""
    return atoms.where((F.col("type") == "ATOM") | ((F.col("type") == "HETATM") & F.col("resn").isin(list(SPECIAL_RESIDUES))))


def render_records(atoms: DataFrame) -> Column:
    """Fixed-width record text of each atom (columns as the parser reads them):
    ``%-6s%5d %-4s%1s%3s %1s%4d    %8.3f%8.3f%8.3f%6.2f%6.2f``."""
    name = F.when((F.length("atom") >= 4) | F.col("atom").rlike("^[0-9]"), F.col("atom")).otherwise(
        F.concat(F.lit(" "), F.col("atom")))
    alt = FM.pad_right(F.coalesce(F.col("alt"), F.lit(" ")), 1) if "alt" in atoms.columns else F.lit(" ")
    return F.concat(
        FM.pad_right("type", 6), F.lpad(F.col("serial").cast("string"), F.greatest(F.lit(5), F.length(F.col("serial").cast("string"))), F.lit(" ")), F.lit(" "), FM.pad_right(name, 4), alt,
        FM.pad_left("resn", 3), F.lit(" "), FM.pad_left("chain", 1), FM.pad_left("resi", 4), F.lit("    "),
        FM.fixed_point("x", 8, 3), FM.fixed_point("y", 8, 3), FM.fixed_point("z", 8, 3),
        FM.fixed_point("occ", 6, 2), FM.fixed_point("b", 6, 2))


def ca_trace(lines: DataFrame, chain: str | None, line_col: str = "line") -> DataFrame:
    """Search-side CA reader: ``ATOM`` records whose atom field is exactly `` CA ``; one chain
    (``None`` = all chains); residue name -> letter with ``X`` default; duplicates kept."""
    ln = F.col(line_col)
    wider = _wider(ln)

    def field(start: int, length: int) -> Column:
        return F.substring(ln, F.lit(start) + wider, F.lit(length))

    df = lines.where(ln.startswith("ATOM") & (field(13, 4) == " CA "))
    if chain is not None:
        df = df.where(F.trim(field(21, 2)) == chain)
    letters = {**RESIDUE_LETTERS, **CA_READER_EXTRA}
    lut = F.create_map(*[F.lit(x) for kv in letters.items() for x in kv])
    keep = [c for c in lines.columns if c != line_col]
    return df.select(
        *keep,
        *([] if "chain" in keep else [F.trim(field(21, 2)).alias("chain")]),
        F.trim(field(18, 3)).alias("resn"),
        F.coalesce(lut[F.trim(field(18, 3))], F.lit(UNKNOWN_LETTER)).alias("aa"),
        F.trim(field(31, 8)).try_cast("float").alias("x"),
        F.trim(field(39, 8)).try_cast("float").alias("y"),
        F.trim(field(47, 8)).try_cast("float").alias("z"),
    )


def join_input_chains(inputs: DataFrame, lists: DataFrame, group_col: str, order_col: str, list_col: str,
                      sep: str = ",") -> DataFrame:
    """Pair the inputs of a group (in ``order_col`` order) with a comma list of chain ids by
    position. A single id is used for every input; any other length difference sets
    ``status = 'length_mismatch'`` (the original stops with an error)."""
    from pyspark.sql import Window

    w = Window.partitionBy(group_col)
    i = inputs.withColumn("_pos", F.row_number().over(w.orderBy(order_col))).withColumn("_n", F.count(F.lit(1)).over(w))
    ids = lists.select(group_col, F.split(F.col(list_col), sep).alias("_ids"))
    j = i.join(ids, group_col)
    one = F.size("_ids") == 1
    chain = F.when(one, F.try_element_at("_ids", F.lit(1))).otherwise(F.try_element_at("_ids", F.col("_pos").cast("int")))
    status = F.when(one | (F.size("_ids") == F.col("_n")), F.lit("ok")).otherwise(F.lit("length_mismatch"))
    return j.select(*[c for c in inputs.columns], chain.alias("chain"), status.alias("status"))


def unprocessed(inputs: DataFrame, outputs: DataFrame, key) -> DataFrame:
    """Inputs that have no output yet (left anti join): a restartable job skips finished work."""
    keys = [key] if isinstance(key, str) else list(key)
    return inputs.join(outputs.select(*keys).distinct(), keys, "left_anti")
