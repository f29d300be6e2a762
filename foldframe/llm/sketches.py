"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every hash of a five-word shingle (XXH64, A-Z lower-cased) below 1 / ``SCALE`` of the hash range. The
threshold is the same for all documents, so the sketch of a union is the union of the sketches, and the share of one
sketch found in another estimates the containment of one document in the other however unequal they are. The fingerprint
is a count of all distinct shingles, one checksum of them and the sorted kept hashes, as text (16 hex digits a hash).

``near_*`` is the estimated containment of the smaller document in the larger. Of a pair where one sketch is empty
(possible only for short texts) it is 1 if the fingerprints are equal and 0 otherwise.

The next document in the order of ids comes from a range-partitioned sort: cut ids are taken from the distribution of the
ids alone, each part also gets the first row of the part after it, and one pass over the sorted rows holds one document.

Defined results: null text = empty; a text of one to four words has one shingle, none has none; rows of one id follow
each other by text; a null id sorts first; one document is its own next; an empty table gives an empty table; other
columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import texts, written
from .simhash import shingle_hashes, words_of

#: One hash in ``SCALE`` is kept: a half, as documents of ten or twenty words would often keep none of an eighth.
SCALE, SHINGLE_WORDS = 2, 5
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double, jaccard_edited double, jaccard_next double")


class Sketch:
    """The kept hashes of a text, the number of its distinct shingles and a checksum of them."""

    def __init__(self, text: bytes, scale: int = SCALE, size: int = SHINGLE_WORDS):
        h = np.unique(shingle_hashes(words_of(text), size))
        self.count, self.sum = len(h), xxhash.xxh32_intdigest(h.tobytes())
        self.kept = h[: np.searchsorted(h, np.uint64((1 << 64) // scale - 1), side="right")]

    def text(self) -> str:
        return f"{self.count}.{self.sum:08x}." + self.kept.astype(">u8").tobytes().hex()


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both documents together."""
    return np.union1d(a, b)


def likeness(a: Sketch, b: Sketch) -> tuple[float, float]:
    """Estimated containment of the smaller in the larger, and Jaccard similarity."""
    if not len(a.kept) or not len(b.kept):
        same = float(a.count == b.count and a.sum == b.sum)
        return same, same
    both = len(np.intersect1d(a.kept, b.kept, assume_unique=True))
    return both / min(len(a.kept), len(b.kept)), both / (len(a.kept) + len(b.kept) - both)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points (rounded down) replaced by the first as many, or all, of the next text."""
    m = len(text) // 4
    return text[:len(text) - m] + following[:m] if m else text


def _with_next(scale: int, size: int):
    struct = T.StructType.fromDDL(RESULT)
    schema = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = None  # (part, id, text, sketch) of the row that waits for its next

        for batch in batches:
            for part, halo, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if halo and (held is None or held[0] != part):
                    continue  # further rows of the next part's first id, or a part without rows of its own
                sketch = Sketch(text.encode(), scale, size)
                if held is not None and held[0] == part:
                    rows.append(_row(held, text, sketch, scale, size))
                held = None if halo else (part, doc, text, sketch)
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run, struct


def _row(held: tuple, following: str, next_sketch: Sketch, scale: int, size: int) -> dict:
    _, doc, text, own = held
    new = edited(text, following).encode()
    other = Sketch(new, scale, size)
    (near_e, jac_e), (near_n, jac_n) = likeness(own, other), likeness(own, next_sketch)
    return dict(doc_id=doc, n_chars=len(text), edited_sha256=hashlib.sha256(new).hexdigest(), fingerprint=own.text(),
                edited_fingerprint=other.text(), near_edited=near_e, near_next=near_n, jaccard_edited=jac_e, jaccard_next=jac_n)


def _part(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``key``: a binary search in one constant array."""
    if not cuts:
        return F.lit(0)
    n = len(cuts)
    table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    fits = lambda at: (at <= n) & (F.element_at(table, F.least(at, F.lit(n))) <= key)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at + step), at + step).otherwise(at))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE,
                          size: int = SHINGLE_WORDS, parts: int | None = None) -> DataFrame:
    """One row for each input row: its fingerprint, its edited text's, and the likenesses to that and the next row's."""
    t = texts(docs, id_col, text_col)
    n = parts or max(2, int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # where to cut: ids only; a null id is before all
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    cuts = sorted(set(t.select(key.alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.2 / n) or []))
    cuts = sorted({int(c) for c in cuts})
    rows = t.withColumn("part", _part(key, cuts))
    # one row for each part: its first id; the part before it needs that row too
    first = written(rows.groupBy("part").agg(F.min(key).alias("first_key")), "part-firsts")
    order = Window.orderBy("part")  # as many rows as parts
    before = first.withColumn("to_part", F.coalesce(F.lag("part").over(order), F.max("part").over(order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))).select(F.col("part").alias("from_part"), "first_key", "to_part")
    halo = rows.join(F.broadcast(before), (F.col("part") == F.col("from_part")) & (key == F.col("first_key"))).select(
        F.col("to_part").alias("part"), F.lit(1).alias("halo"), "doc_id", "text")
    own = rows.select("part", F.lit(0).alias("halo"), "doc_id", "text")
    run, struct = _with_next(scale, size)
    dealt = own.unionByName(halo).repartition(n, "part").sortWithinPartitions("part", "halo", key, "text")
    return dealt.mapInArrow(run, struct)
