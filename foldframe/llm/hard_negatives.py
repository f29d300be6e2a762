"""Hard-negative mining by a secondary-sort shuffle.

Rows are packed into blocks of bounded bytes, anchors (a stated query set) too; a block of rows and a block of anchors
meet under one key and are scored by one exact integer matrix product. What a block pair sends on is combined first:
an anchor's first positives of that block, and, once its windows are known, the first negatives of each window. Every
sent pair is one binary key (anchor, descending score, id) whose byte order is the result's order. Keys are dealt by
anchor and sorted inside the partitions; a streaming reader opens an anchor's windows as their positives go by and emits
the negatives that fall into them, holding a few open windows and never an anchor's rows.

Two rounds run this way: the first finds the positives (the ends of the windows), the second the negatives. Both look at
every row; nothing is dropped that another row of its block does not stand before.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no part, nor do
rows whose vector has not the most frequent number of components. Rows that repeat an id are rows of their own; an
anchor's "other rows" are those that differ from it in id, label or vector; an anchor row that occurs more than once is
mined once, other repeated rows count as often as they occur. A window of a negative positive score is empty, of a zero
score holds zero only. An empty table, or one without anchors, gives an empty table; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ready, written
from .vectors import EXACT, matrix, of_usual_size, scaled, usable

SCALE, EVERY = 256, 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of its positive's.
LEAST, MOST = 50, 95
#: Bytes of a block (of components as 64-bit integers), and scores that are held at once.
BLOCK_BYTES, SCORES = 4 << 20, 1 << 21
#: A pair as bytes that sort by anchor, its content, falling score, positives before negatives, id.
KEY = np.dtype([("anchor", ">u8"), ("content", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)
KEYED = "anchor long, key binary"
_BLOCK = "block long, n int, ids binary, contents binary, labels binary, vectors binary"


def _unsigned(x: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones in the same order."""
    return x.astype(np.int64).view(np.uint64) ^ _SIGN


def _signed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) ^ _SIGN).view(np.int64)


def pair_keys(anchor: np.ndarray, content: np.ndarray, score: np.ndarray, kind: int, id_: np.ndarray) -> pa.Array:
    out = np.empty(len(id_), KEY)
    out["anchor"], out["content"], out["id"], out["kind"] = _unsigned(anchor), _unsigned(content), _unsigned(id_), kind
    out["score"] = ~_unsigned(score)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def read_keys(column: pa.Array) -> dict[str, list[int]]:
    """Fields of packed keys as lists."""
    k = np.frombuffer(b"".join(column.to_pylist()), KEY)
    return {"anchor": _signed(k["anchor"]).tolist(), "content": _signed(k["content"]).tolist(),
            "score": _signed(~k["score"].astype(np.uint64)).tolist(), "kind": k["kind"].tolist(), "id": _signed(k["id"]).tolist()}


def _packed(block: int, ids: np.ndarray, contents: np.ndarray, labels: np.ndarray, x: np.ndarray) -> dict[str, object]:
    """A block in the order of its ids; components in as few bytes as hold them."""
    order = np.argsort(ids, kind="stable")
    x = x[order]
    top = int(np.abs(x).max(initial=0))
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if top <= np.iinfo(k).max)
    return {"block": block, "n": len(ids), "ids": ids[order].astype("<i8").tobytes(), "contents": contents[order].astype("<i8").tobytes(),
            "labels": labels[order].astype("<i8").tobytes(), "vectors": x.astype(kind).tobytes()}


def _unpacked(row: dict, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = row["n"]
    x = np.frombuffer(row["vectors"], f"<i{len(row['vectors']) // (n * size)}").astype(np.int64).reshape(n, size)
    return tuple(np.frombuffer(row[c], "<i8") for c in ("ids", "contents", "labels")) + (x,)


def packed_rows(rows: DataFrame, size: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows ``_id, _content, _label, _vector`` in numbered blocks; a block has rows of one task only."""
    many = max(1, block_bytes // (8 * size))
    schema = to_arrow_schema(T.StructType.fromDDL(_BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        number = count(TaskContext.get().partitionId() << 32)

        def block() -> pa.RecordBatch:
            row = _packed(next(number), *map(np.concatenate, zip(*held)))
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, many - sum(len(h[0]) for h in held))
                at += part.num_rows
                held.append(tuple(part.column(i).to_numpy() for i in range(3)) + (scaled(matrix(part.column(3), size), SCALE),))
                if sum(len(h[0]) for h in held) == many:
                    yield block()
        if held:
            yield block()

    return rows.select("_id", "_content", "_label", "_vector").mapInArrow(run, _BLOCK)


def packed_anchors(anchors: DataFrame, size: int, blocks: int, positives: int) -> DataFrame:
    """Distinct anchors in ``blocks`` blocks by hash, with the ends of the windows beside their positives (``_scores``)."""
    ddl = "low binary, high binary, " + _BLOCK
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(t: pa.Table) -> pa.Table:
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        ids = col["_id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # as _packed orders them
        ends = np.tile(np.array([1, 0], "<i8"), (len(ids), positives, 1))  # a window that is not there is empty
        for line, scores in zip(ends, col["_scores"].to_pylist()):
            for k, score in enumerate(scores):
                line[k] = window(score)
        ends = ends[order]
        row = _packed(col["side"][0].as_py(), ids, col["_content"].to_numpy(), col["_label"].to_numpy(), scaled(matrix(col["_vector"], size), SCALE))
        return pa.Table.from_pylist([{"low": ends[:, :, 0].tobytes(), "high": ends[:, :, 1].tobytes(), **row}], schema=schema)

    d = anchors.select(F.pmod(F.xxhash64("_id", "_content"), F.lit(blocks)).alias("side"), "_id", "_content", "_label", "_vector", "_scores")
    return d.groupBy("side").applyInArrow(run, ddl)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: as doubles while every sum is exact, else as 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top >= 2.0 ** 62:
        raise ValueError("an inner product may not fit a 64-bit integer")
    return a @ b.T


def _scored(block: tuple[np.ndarray, ...], anchors: tuple[np.ndarray, ...], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor rows, block rows of the same or of other labels, scores in the order of falling score and rising id, their order)."""
    _, _, labels, x = block
    for label in np.unique(anchors[2]):
        cols = np.flatnonzero((labels == label) == same)
        every = np.flatnonzero(anchors[2] == label)
        if not len(cols):
            continue
        step = max(1, SCORES // len(cols))
        for i in range(0, len(every), step):
            mine = every[i:i + step]
            yield mine, cols, inner_products(anchors[3][mine], x[cols])


def first_positives(block: tuple[np.ndarray, ...], anchors: tuple[np.ndarray, ...], positives: int) -> Iterator[pa.Array]:
    """Keys of each anchor's first rows of its own label in the block, itself left out."""
    none = np.iinfo(np.int64).min
    for mine, cols, s in _scored(block, anchors, True):
        own = (anchors[0][mine, None] == block[0][cols]) & (anchors[1][mine, None] == block[1][cols])
        s[own] = none
        order = np.argsort(~s, axis=1, kind="stable")[:, :positives]  # ~s: falling, and no overflow
        top = np.take_along_axis(s, order, axis=1)
        at, k = np.nonzero(top != none)
        yield pair_keys(anchors[0][mine][at], anchors[1][mine][at], top[at, k], 0, block[0][cols][order[at, k]])


def first_negatives(block: tuple[np.ndarray, ...], anchors: tuple[np.ndarray, ...], low: np.ndarray, high: np.ndarray,
                    negatives: int) -> Iterator[pa.Array]:
    """Keys of the first rows of other labels in each window of each anchor in the block."""
    for mine, cols, s in _scored(block, anchors, False):
        order = np.argsort(~s, axis=1, kind="stable")
        s = np.take_along_axis(s, order, axis=1)
        taken = np.zeros(s.shape, bool)
        lines = np.arange(len(mine))
        for w in range(low.shape[1]):
            first = (s > high[mine, w][:, None]).sum(axis=1)  # scores fall, so these come before the window
            for k in range(negatives):
                at = np.minimum(first + k, s.shape[1] - 1)
                inside = (first + k < s.shape[1]) & (s[lines, at] >= low[mine, w]) & (s[lines, at] <= high[mine, w])
                taken[lines[inside], at[inside]] = True
        at, k = np.nonzero(taken)
        yield pair_keys(anchors[0][mine][at], anchors[1][mine][at], s[at, k], 1, block[0][cols][order[at, k]])


def block_pairs(blocks: DataFrame, anchors: DataFrame, size: int, n_blocks: int, sides: int, positives: int, negatives: int) -> DataFrame:
    """``anchor long, key binary`` of the pairs that block pairs send on: positives, or (``negatives`` > 0) negatives.

    The blocks of rows are dealt to as many slots as there are blocks; a slot meets each block of anchors once."""
    schema = to_arrow_schema(T.StructType.fromDDL(KEYED))

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [pa.array([], pa.binary())]
        for q in queries.to_pylist():
            anchors_ = _unpacked(q, size)
            low, high = (np.frombuffer(q[c], "<i8").reshape(-1, positives) for c in ("low", "high"))
            for i in range(rows.num_rows):
                block = _unpacked(rows.slice(i, 1).to_pylist()[0], size)
                out += first_negatives(block, anchors_, low, high, negatives) if negatives else first_positives(block, anchors_, positives)
        keys = pa.concat_arrays(out)
        ids = _signed(np.frombuffer(b"".join(keys.to_pylist()), KEY)["anchor"])
        return pa.Table.from_arrays([pa.array(ids), keys], schema=schema)

    def every(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    left = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(n_blocks))).withColumn("side", F.explode(every(sides)))
    right = anchors.withColumnRenamed("block", "side").withColumn("slot", F.explode(every(n_blocks)))
    return left.groupBy("side", "slot").cogroup(right.groupBy("side", "slot")).applyInArrow(run, KEYED)


def in_key_order(pairs: DataFrame) -> DataFrame:
    """Secondary sort: dealt by anchor, sorted by the packed key inside each partition."""
    return pairs.repartition("anchor").sortWithinPartitions("key")


def stream_positives(batches: Iterator[pa.RecordBatch], positives: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The first ``positives`` keys of each anchor."""
    last, seen = None, 0
    for batch in batches:
        k = read_keys(batch.column(1))
        keep = []
        for i, at in enumerate(zip(k["anchor"], k["content"])):
            if at != last:
                last, seen = at, 0
            if seen < positives:
                keep.append(i)
            seen += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[c][i] for i in keep], pa.int64()) for c in ("anchor", "content", "id", "score")], schema=schema)


def window(score: int) -> tuple[int, int]:
    """Least and largest score of a negative beside a positive of ``score``: LEAST <= 100 * negative / positive <= MOST, in integers."""
    return -(-LEAST * score // 100), MOST * score // 100


def stream_negatives(batches: Iterator[pa.RecordBatch], negatives: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Emits the first ``negatives`` keys of each open window. A positive goes by before the negatives of its window, as
    its score is larger, or equal (zero) and its kind sorts first."""
    last: tuple[int, int] | None = None
    open_: list[list[int]] = []  # positive's id, score, least, largest, how many were emitted
    for batch in batches:
        k = read_keys(batch.column(1))
        out: list[tuple[int, ...]] = []
        for anchor, content, score, kind, id_ in zip(k["anchor"], k["content"], k["score"], k["kind"], k["id"]):
            if (anchor, content) != last:
                last, open_ = (anchor, content), []
            if kind == 0:
                open_.append([id_, score, *window(score), 0])
                continue
            for w in open_:
                if w[2] <= score <= w[3] and w[4] < negatives:
                    w[4] += 1
                    out.append((anchor, w[0], w[4], id_, w[1], score))
        columns = zip(*out) if out else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def mine(rows: DataFrame, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are the rows whose id is
    divisible by ``every``; ``label`` replaces the label column."""
    ddl = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    label = F.col(f"`{label_col}`") if label is None else label
    d = ready(rows).select(F.col(f"`{id_col}`").cast("long").alias("_id"), label.cast("long").alias("_label"), F.col(f"`{vector_col}`").alias("_vector"))
    d = usable(d.where("_id is not null and _label is not null"), "_vector")
    d = written(d.withColumn("_content", F.xxhash64("_label", "_vector")), "labelled-vectors")
    d, size = of_usual_size(d, "_vector")
    spark = d.sparkSession
    anchors = d.where(F.col("_id") % every == 0).groupBy("_id", "_content", "_label", "_vector").count().drop("count")
    n_anchors = anchors.count() if size else 0
    if not n_anchors:
        return spark.createDataFrame([], ddl)
    sides = math.ceil(n_anchors / max(1, block_bytes // (8 * size)))
    blocks = written(packed_rows(d, size, block_bytes), "row-blocks")
    n_blocks = blocks.count()

    def pairs(a: DataFrame, negatives_: int) -> DataFrame:
        return block_pairs(blocks, packed_anchors(a, size, sides, positives), size, n_blocks, sides, positives, negatives_)

    found = "anchor long, content long, id long, score long"
    schema, keyed, result = (to_arrow_schema(T.StructType.fromDDL(x)) for x in (found, KEYED, ddl))
    none = F.array().cast("array<long>")
    best = in_key_order(pairs(anchors.withColumn("_scores", none), 0)).mapInArrow(lambda b: stream_positives(b, positives, schema), found)
    best = written(best, "positives")
    ends = best.groupBy("anchor", "content").agg(F.collect_list("score").alias("_scores"))  # at most ``positives``
    windowed = anchors.join(ends, (F.col("_id") == F.col("anchor")) & (F.col("_content") == F.col("content"))).drop("anchor", "content")

    def as_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchor, content, id_, score = (c.to_numpy() for c in b.columns)
            yield pa.RecordBatch.from_arrays([b.column(0), pair_keys(anchor, content, score, 0, id_)], schema=keyed)

    both = best.mapInArrow(as_keys, KEYED).unionByName(pairs(windowed, negatives))
    return in_key_order(both).mapInArrow(lambda b: stream_negatives(b, negatives, result), ddl)
