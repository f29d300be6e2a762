"""Name rules for structures, domains and chains (column expressions)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(_c(path), "/"), -1)


def base_name(path) -> Column:
    """Last path part with every ``.pdb`` removed (as ``str.replace('.pdb', '')``)."""
    return F.replace(file_name(path), F.lit(".pdb"), F.lit(""))


def structure_file_name(path) -> Column:
    """File name with ``.pdb`` appended when it does not end in it."""
    fn = file_name(path)
    return F.when(fn.endswith(".pdb"), fn).otherwise(F.concat(fn, F.lit(".pdb")))


def structure_id(path) -> Column:
    """File name without a trailing ``.pdb``."""
    return F.regexp_replace(file_name(path), r"\.pdb$", "")


def chain_of_domain(name) -> Column:
    """Domain name -> chain name: base name without ``.pdb`` suffix, two trailing digits off,
    trailing underscores off, then a trailing ``_TED`` off (suffix, not characters)."""
    s = F.regexp_replace(file_name(name), r"\.pdb$", "")
    s = F.regexp_replace(s, r"[0-9]{2}$", "")
    s = F.regexp_replace(s, r"_+$", "")
    return F.regexp_replace(s, r"_TED$", "")


def query_chain(name, suffix: str) -> Column:
    """Query domain name -> query chain: strip ``<suffix>_<digits>`` at the end."""
    return F.regexp_replace(_c(name), suffix + r"_[0-9]+$", "")


def domain_name(name, number) -> Column:
    """``<name>_<two-digit number>``."""
    return F.concat(_c(name), F.lit("_"), F.lpad(_c(number).cast("string"), 2, "0"))


def bucket_name(folder) -> Column:
    """Object-store bucket for a result folder: ``/`` -> ``-``, lower case."""
    return F.lower(F.regexp_replace(_c(folder), "/", "-"))
