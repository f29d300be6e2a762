"""Slots for a caller's own code: batch models, pair scorers, error rows.

The original starts one Python process per structure and reloads both
networks each time; here a model is loaded once per task and fed Arrow
batches (``mapInPandas``, or ``mapInArrow`` when the code works on Arrow record batches
directly, with an iterator). A pair scorer runs over candidate
pairs that are spread over tasks by a salted hash, so one hot query cannot
pile all its pairs into one task.
"""
from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ALIGNMENT_SCHEMA = "len_ali int, rmsd double, seq_id double, qtm double, ttm double"


def batch_model(df: DataFrame, model_factory: Callable, schema: str | StructType, arrow: bool = False) -> DataFrame:
    """Apply ``model = model_factory()`` to every Arrow batch of every partition.

    The factory runs once per task (one model load per partition, not per row or file). The model
    takes and returns pandas DataFrames, or with ``arrow=True`` ``pyarrow.RecordBatch`` objects
    (no pandas conversion: vector columns stay flat buffers); Arrow outputs are cast to the
    declared schema."""
    if not arrow:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = model_factory()
            for pdf in batches:
                yield model(pdf)

        return df.mapInPandas(run, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    target = to_arrow_schema(st)

    def run_arrow(batches):
        model = model_factory()
        for b in batches:
            out = model(b)
            yield out if out.schema.equals(target) else out.cast(target)

    return df.mapInArrow(run_arrow, st)


def pair_scores(pairs: DataFrame, scorer_factory: Callable, schema: str | StructType, key_cols=("qid", "dbindex"),
                partitions: int | None = None, arrow: bool = False, spread: bool = True) -> DataFrame:
    """Score candidate pairs with a caller's scorer, pairs spread over tasks by a hash of the pair.

    ``spread=False`` scores them where they are: for pairs that a join has dealt already by small groups."""
    if not spread:
        return batch_model(pairs, scorer_factory, schema, arrow=arrow)
    n = partitions or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(n, F.xxhash64(*[F.col(c) for c in key_cols]))
    return batch_model(dealt, scorer_factory, schema, arrow=arrow)


def error_rows(df: DataFrame, fn: Callable[[pd.Series], pd.Series], in_col: str, out_type: str,
               policy: str = "collect") -> DataFrame:
    """Run ``fn`` on whole batches of values, with the error of each row that fails: columns ``result``, ``status``, ``error``.

    A batch that fails is halved until the rows that make it fail stand alone: a batch without a bad row is one call, and
    each bad row costs some calls more. ``policy='fail'`` re-raises the first error (the original's behaviour);
    ``'collect'`` keeps going, so failed rows can be written to a quarantine table."""
    schema = df.schema.simpleString()[len("struct<"):-1]
    out_schema = f"{schema},result {out_type},status string,error string"

    def attempt(values: pd.Series) -> list[tuple]:
        try:
            return [(r, "ok", None) for r in fn(values)]
        except Exception as e:  # noqa: BLE001 - the slot records any failure
            if policy == "fail":
                raise
            if len(values) == 1:
                return [(None, "error", f"{type(e).__name__}: {e}".strip() or traceback.format_exc(limit=1))]
            half = len(values) // 2
            return attempt(values.iloc[:half]) + attempt(values.iloc[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = attempt(pdf[in_col]) if len(pdf) else []
            yield pdf.assign(**{c: [r[i] for r in rows] for i, c in enumerate(("result", "status", "error"))})

    return df.mapInPandas(run, out_schema)


# ------------------------------------------------------------------ test models
def composition_model(seq_col: str = "seq", out_col: str = "embedding", alphabet: str = "ACDEFGHIKLMNPQRSTVWY",
                      keep=()):
    """Factory of a stand-in embedding model: residue composition (fractions over ``alphabet``)."""

    def factory():
        lut = np.full(256, -1, dtype=np.int64)
        for i, ch in enumerate(alphabet):
            lut[ord(ch)] = i

        def model(pdf: pd.DataFrame) -> pd.DataFrame:
            vecs = []
            for s in pdf[seq_col]:
                codes = lut[np.frombuffer((s or "").encode("latin-1", "replace"), dtype=np.uint8)]
                codes = codes[codes >= 0]
                counts = np.bincount(codes, minlength=len(alphabet)).astype(np.float32)
                vecs.append(counts / max(1, len(s or "")))
            out = pdf[list(keep)].copy() if keep else pd.DataFrame(index=pdf.index)
            out[out_col] = vecs
            return out

        return model

    return factory


def cosine_scorer_arrow(q_col: str = "q_embedding", t_col: str = "t_embedding", decimals: int = 4, keep=()):
    """Factory of a stand-in pair scorer on Arrow batches: cosine of the two vectors as both TM-scores (4 decimals, as an
    aligner prints them), aligned length from the shorter length, rmsd 0, identity 1."""

    def factory():
        import pyarrow as pa

        from .search import _arrow_vectors

        def scorer(b):
            n = b.num_rows
            names = b.schema.names
            if n:
                q, t = _arrow_vectors(b.column(q_col)), _arrow_vectors(b.column(t_col))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cos = np.einsum("ij,ij->i", q, t) / (np.linalg.norm(q, axis=1) * np.linalg.norm(t, axis=1))
                cos = np.round(np.nan_to_num(cos, nan=0.0), decimals)
            else:
                cos = np.zeros(0)
            if "q_len" in names and "t_len" in names and n:
                shorter = np.minimum(b.column("q_len").to_numpy(zero_copy_only=False).astype(np.float64),
                                     b.column("t_len").to_numpy(zero_copy_only=False).astype(np.float64))
                len_ali = np.floor(shorter * cos * 2).astype(np.int32)
            else:
                len_ali = np.zeros(n, dtype=np.int32)
            arrays = [b.column(c) for c in keep] + [pa.array(len_ali, pa.int32()), pa.array(np.zeros(n)),
                                                     pa.array(np.ones(n)), pa.array(cos), pa.array(cos)]
            return pa.RecordBatch.from_arrays(arrays, names=list(keep) + ["len_ali", "rmsd", "seq_id", "qtm", "ttm"])

        return scorer

    return factory
