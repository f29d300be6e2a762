"""Repeated passages by merged Burrows-Wheeler transforms: remove each byte of a ``SPAN``-byte string that also starts in
a document with a smaller id.

All suffixes of a large corpus cannot be sorted, so the work is cut where equal strings must meet anyway:

1. Documents are gathered into chunks (rows of a written table). Every ``SPAN``-byte window has a key, the least hash of
   its ``GRAM``-byte pieces: equal windows have equal keys, and neighbouring windows mostly share theirs, so a chunk is
   some runs of windows with one key. Keys, 32 bits each and one for each chunk, are shuffled by value, with the bytes of
   a key's distinct contexts in the chunk if it has more than ``FEW`` runs there; those that no other document has are
   answered "alone" and their windows are done.
2. Each chunk sends the distinct contexts (run of windows and the bytes that they cover) of the other keys to the key's
   bucket, with the smallest id that has the context in the chunk.
3. In a bucket, the contexts that came from one chunk are a shard. Where a key has one context all over, its windows are
   answered at once. The others: each shard has a Burrows-Wheeler transform over symbols of ``STEP`` bytes (the symbol
   before each suffix, in suffix order). The transforms are merged by interleave refinement: the interleave, a list of
   shard numbers, is first ordered by the suffixes' first bytes; a round deals the next symbol of its shard to each entry
   and sorts the entries by symbol, keeping their order otherwise, which orders them by ``STEP`` more bytes. An entry
   that differs in symbol or in its former interval from the one before begins a new interval, so after the last round
   the intervals are the repeated strings of ``SPAN`` bytes, and no suffix was sorted against another shard's. Each
   interval's smallest id goes back to the contexts in it.
4. Chunks gather the answers, mark the windows of a larger id, and cut the bytes that they cover.

Chunks, buckets and messages are bounded by ``chunk_bytes``, not by the corpus; a key whose contexts pass ``merge_bytes``
over all chunks (or that more than ``hot_chunks`` chunks hold, if set) is dealt window by window instead, so no bucket
collects the edges of a passage that a third of all documents share, and no merge takes more than ``merge_bytes`` (whole
keys). Keys under that bound are not dealt so however many chunks hold them: a window alone takes ``SPAN`` bytes, in a
context a few. Contexts go from chunks to buckets in one shuffle and are not written besides. Results do not depend on any
of these settings.
(Windows are judged on the input; overlaps count.)

Defined results: null text = empty; texts under ``SPAN`` bytes lose nothing; a null id counts as smaller than any other;
rows of one id never cut each other; an empty table gives an empty table; other columns can be kept (``keep``), whatever
their names.
"""
from __future__ import annotations

import hashlib
import pickle
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foldframe.session import scratch_path

from .common import give_back, ready

SPAN, GRAM, STEP = 50, 24, 8
CHUNK_BYTES = 4 << 20
#: Windows of a context; longer runs are cut.
RUN_WINDOWS = 32
#: Runs of a key in a chunk that are not counted: each is taken for a longest context of its own.
FEW = 3
#: Bytes of contexts that one merge takes (whole keys; it needs about 100 times as much memory).
MERGE_BYTES = 1 << 20
NO_ID = -(1 << 63)
#: zstd level of texts in written tables and shuffles.
LEVEL = 9
MESSAGE = "bucket int, chunk long, payload binary"


def pack(*arrays) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, protocol=5), LEVEL)


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(blob))  # only what pack() wrote in this job


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _doubled(x: np.ndarray, width: int, join) -> np.ndarray:
    """``x`` combined over each run of ``width`` entries; ``join(left, right, n)`` combines with the n entries after."""
    part, size, out, done = x, 1, None, 0
    while True:
        if width & 1:
            out, done = (part, size) if out is None else (join(out[:len(out) - size] if size else out, part[done:done + len(out) - size], size), done + size)
        width >>= 1
        if not width:
            return out
        part, size = join(part[:len(part) - size], part[size:], size), 2 * size


def gram_hashes(body: np.ndarray, gram: int) -> np.ndarray:
    base = 0x9E3779B97F4A7C15

    def join(left, right, n):
        return left * np.uint64(pow(base, n, 1 << 64)) + right

    return mixed(_doubled(body.astype(np.uint64) + np.uint64(1), gram, join))


def window_keys(body: np.ndarray, span: int, gram: int, block: int = 1 << 16) -> np.ndarray:
    """Least gram hash of each window, by start; in blocks that fit a core's cache."""
    out = [np.zeros(0, np.uint64)]
    for a in range(0, len(body) - span + 1, block):
        h = gram_hashes(body[a:a + block + span - 1], gram)
        out.append(_doubled(h, span - gram + 1, lambda left, right, _: np.minimum(left, right)))
    return np.concatenate(out)


def window_runs(body: np.ndarray, ends: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key, none across documents: (first start, windows, key)."""
    least = window_keys(body, span, gram)
    valid = np.ones(len(least), bool)
    across = (ends[:, None] - np.arange(1, span)[None, :]).ravel()
    valid[across[(across >= 0) & (across < len(least))]] = False
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    tail = valid.copy()
    tail[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    start, n = np.flatnonzero(head), np.flatnonzero(tail) + 1
    n = n - start
    cuts = -(-n // RUN_WINDOWS)
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start, n = np.repeat(start, cuts) + RUN_WINDOWS * nth, np.repeat(n, cuts) - RUN_WINDOWS * nth
    return start, np.minimum(n, RUN_WINDOWS), mixed(least[start] ^ np.uint64(0x5851F42D4C957F2D))


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits: sorted keys have sorted buckets."""
    return (_scaled(keys, buckets) >> np.uint64(32)).astype(np.int64)


def present(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of the buckets that sorted ``keys`` have: work follows the keys, not the number of buckets."""
    of = buckets_of(keys, buckets)
    head = _heads(of)
    return zip(of[head].tolist(), head.tolist(), [*head[1:].tolist(), len(of)])


def _scaled(keys: np.ndarray, buckets: int) -> np.ndarray:
    """keys * buckets / 2 ** 32: the bucket, and 32 bits of the place in it."""
    return (keys >> np.uint64(32)) * np.uint64(buckets) + ((keys & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32))


def _keys_message(short: np.ndarray, at: np.ndarray, size: np.ndarray) -> bytes:
    """Sorted 32-bit keys as gaps, and the bytes ``size`` of the contexts of those in the places ``at``."""
    gaps = np.diff(short.astype(np.int64), prepend=0).astype("<u4")
    more = np.concatenate((at, size, [len(at)])).astype("<u4")
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + more.tobytes(), 3)


def _from_keys_message(blob: bytes, few: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bytes of each key's contexts: ``few`` where they were not counted)."""
    raw = zstandard.decompress(blob)
    m = int.from_bytes(raw[-4:], "little")
    end = len(raw) - 4 - 8 * m
    planes = np.frombuffer(raw[:end], np.uint8).reshape(4, -1)
    keys = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)
    size = np.full(len(keys), few, np.int64)
    at, counted = np.frombuffer(raw[end:-4], "<u4").reshape(2, m)
    size[at] = counted
    return keys, size


def _answer_message(shared: np.ndarray, hot: np.ndarray) -> bytes:
    """Two flags for each key. Messages are many and short, so none carries a pickle's header."""
    return zstandard.compress(len(shared).to_bytes(4, "little") + np.packbits(shared).tobytes() + np.packbits(hot).tobytes(), 3)


def _from_answer_message(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    return tuple(np.unpackbits(x, count=n).astype(bool) for x in np.frombuffer(raw[4:], np.uint8).reshape(2, -1))


def _contexts_message(short: np.ndarray, least: np.ndarray, texts: list[bytes]) -> bytes:
    """32-bit keys, smallest ids and texts of contexts, which have less than 256 bytes each."""
    lens = np.fromiter(map(len, texts), np.uint8, len(texts))
    return zstandard.compress(len(texts).to_bytes(4, "little") + short.astype("<u4").tobytes() + least.astype("<i8").tobytes() + lens.tobytes() + b"".join(texts), LEVEL)


def _from_contexts_message(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    at = np.cumsum([4, 4 * n, 8 * n, n]).tolist()
    return *(np.frombuffer(raw[a:b], t) for a, b, t in zip(at, at[1:], ("<u4", "<i8", "u1"))), raw[at[-1]:]


def _gaps(sorted_: np.ndarray) -> bytes:
    """A sorted array of 32-bit numbers as gaps, byte by byte, compressed."""
    gaps = np.diff(sorted_.astype(np.int64), prepend=0).astype("<u4")
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _from_gaps(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def _heads(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1]))) if len(sorted_) else np.zeros(0, np.int64)


def stable_order(key: np.ndarray, major: np.ndarray | None = None) -> np.ndarray:
    """Indices that sort by (major, key), equal ones in their order. ``key``, ``major``: ranks."""
    n = len(key)
    low = max(1, int(n).bit_length())
    mid = int(key.max()).bit_length() if n else 0
    high = int(major.max()).bit_length() if n and major is not None else 0
    if low + mid + high > 63:
        return np.lexsort((key,) if major is None else (key, major))
    both = key.astype(np.uint64) << np.uint64(low) | np.arange(n, dtype=np.uint64)
    if major is not None:
        both |= major.astype(np.uint64) << np.uint64(low + mid)
    both.sort()
    return (both & np.uint64((1 << low) - 1)).astype(np.int64)


def merged_intervals(contexts: list[bytes], shard: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the shards' transforms: (starts in the joined contexts, interval of each, offsets of the contexts).

    Two starts have the same interval exactly if the ``span`` bytes from them are equal; this holds for starts at least
    ``span`` bytes before the end of their context, others are to be ignored. ``shard`` is sorted."""
    text = np.frombuffer(b"".join(contexts) + bytes(STEP), np.uint8)
    n = len(text) - STEP
    lens = np.fromiter(map(len, contexts), np.int64, len(contexts))
    offset = np.concatenate(([0], np.cumsum(lens)))
    shard_of = np.repeat(shard, lens)
    # the symbol at each place (STEP bytes), and the place one symbol before, around the shard's own text
    symbol = np.unique(np.lib.stride_tricks.sliding_window_view(text, STEP)[:n].copy().view(">u8").ravel(), return_inverse=True)[1].astype(np.int64)
    first = np.searchsorted(shard, np.unique(shard))
    shard_start = np.repeat(offset[first], np.diff(np.append(offset[first], n)))
    shard_len = np.repeat(np.diff(np.append(offset[first], n)), np.diff(np.append(offset[first], n)))
    place = np.arange(n)
    before = shard_start + (place - shard_start - STEP) % shard_len
    rounds, rest = divmod(span, STEP)
    opening = np.zeros(n, np.int64)  # the rest of the span comes first: bytes span - rest .. span of a window
    for i in range(rest):
        opening = opening << 8 | text[i:i + n]
    # each shard's own suffix order (by span bytes), and its transform
    suffixes = stable_order(opening, shard_of)
    for _ in range(rounds):
        p = before[suffixes]
        suffixes = p[stable_order(symbol[p], shard_of[p])]
    transform = symbol[before[suffixes]]
    # the interleave
    o = stable_order(opening[suffixes])
    z = shard_of[suffixes][o]
    head = np.concatenate(([0], np.diff(opening[suffixes][o]) != 0))
    for _ in range(rounds):
        dealt = np.empty(n, np.int64)
        dealt[stable_order(z)] = transform  # the next symbol of its shard, for each entry
        interval = np.cumsum(head)
        o = stable_order(dealt)
        z, dealt, interval = z[o], dealt[o], interval[o]
        head = np.concatenate(([0], (dealt[1:] != dealt[:-1]) | (interval[1:] != interval[:-1]))).astype(np.int64)
    starts = np.empty(n, np.int64)
    starts[stable_order(z)] = suffixes
    return starts, np.cumsum(head), offset


def window_ids(contexts: list[bytes], shard: np.ndarray, ids: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Smallest id of the contexts that hold each window: a row for each context, a column for each of its windows."""
    o = np.argsort(shard, kind="stable")
    starts, interval, offset = merged_intervals([contexts[i] for i in o], shard[o], span)
    context = np.searchsorted(offset, starts, side="right") - 1
    window = starts - offset[context]
    holds = window <= np.diff(offset)[context] - span
    context, window, interval = o[context[holds]], window[holds], interval[holds]
    head = _heads(interval)
    least = np.repeat(np.minimum.reduceat(ids[context], head), np.diff(np.append(head, len(interval))))
    out = np.full((len(contexts), RUN_WINDOWS), np.iinfo(np.int64).max)
    out[context, window] = least
    return out


class _Chunk:
    """A row of the chunk table."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
        self.ends = np.array(row["ends"], np.int64)
        self.body = zstandard.decompress(row["body"]) if row["body"] else b""
        self.bytes = np.frombuffer(self.body, np.uint8)

    def keys(self, span: int, gram: int):
        """Runs, their documents' ids, and the distinct keys: (start, n, id of run, order by key, heads in it)."""
        start, n, key = window_runs(self.bytes, self.ends, span, gram)
        ids = self.ids[np.searchsorted(self.ends, start, side="right")] if len(start) else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        return start, n, key, ids, order, _heads(key[order])


def chunk_table(docs: DataFrame, id_col: str, text_col: str, keep: list[str], chunk_bytes: int) -> DataFrame:
    """Written table ``chunk long, ids, ends, body, rest``: documents gathered up to ``chunk_bytes`` a row, in buckets by
    ``chunk``, so that what comes back to the chunks is shuffled to them and they stay where they are."""
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.lit(0).alias("none"))
    d = ready(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"), rest.alias("rest"))
    struct = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
                           T.StructField("body", T.BinaryType()), T.StructField("rest", T.ArrayType(d.schema["rest"].dataType))])
    schema = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def row():
            nonlocal held, size, made
            ids, texts, extra = ([x for part in held for x in part[k].to_pylist()] for k in range(3))
            out = {"chunk": base + made, "ids": ids, "ends": np.cumsum([len(t) for t in texts]).tolist(),
                   "body": zstandard.compress(b"".join(texts), LEVEL), "rest": extra}
            held, size, made = [], 0, made + 1
            return pa.RecordBatch.from_pylist([out], schema=schema)

        for batch in batches:
            lens = np.cumsum(np.array(batch.column(1).to_pylist() and [len(t) for t in batch.column(1).to_pylist()], np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(lens[at - 1]) if at else 0
                n = max(1, int(np.searchsorted(lens, done + chunk_bytes - size, side="right")) - at)
                part = batch.slice(at, n)
                held.append([part.column(k) for k in range(3)])
                size += int(lens[at + part.num_rows - 1]) - done
                at += part.num_rows
                if size >= chunk_bytes or at < batch.num_rows:
                    yield row()
        if held:
            yield row()

    return bucketed(d.mapInArrow(run, struct), "chunks", "chunk")


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder in buckets by ``column``, as many as a shuffle has partitions.

    Only a catalog table can be read as buckets; its entry is dropped as soon as it is resolved, the files stay."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(n, column).option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    b, c, p = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(p, pa.binary())], names=["bucket", "chunk", "payload"])


def _send_keys(buckets: int, span: int, gram: int):
    """Distinct keys of each chunk, their place in the bucket in 32 bits, the last saying that two of its documents have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row)
                start, n, key, ids, order, head = c.keys(span, gram)
                if not len(head):
                    continue
                # bytes of the distinct contexts of keys with more than a few runs
                runs = np.diff(np.append(head, len(order)))
                many, size = np.flatnonzero(runs > FEW), np.zeros(len(head), np.int64)
                for k in many.tolist():
                    mine = order[head[k]:head[k] + runs[k]]
                    ends = start[mine] + n[mine] + span - 1
                    size[k] = sum(map(len, {c.body[a:b] for a, b in zip(start[mine].tolist(), ends.tolist())}))
                ids, key = ids[order], key[order][head]
                both = np.minimum.reduceat(ids, head) != np.maximum.reduceat(ids, head)
                short = _scaled(key, buckets) & np.uint64(0xFFFFFFFE) | both.astype(np.uint64)
                rows = []
                for b, i, j in present(key, buckets):
                    part, bytes_ = np.sort(short[i:j]), size[i:j]  # in this order but for the last bit
                    at = np.flatnonzero(bytes_)
                    rows.append((b, c.chunk, _keys_message(part, at, np.minimum(bytes_[at], 0xFFFFFFFF))))
                yield _messages(rows)
        give_back()

    return run


def _answer_keys(hot_chunks: int | None, merge_bytes: int = MERGE_BYTES, span: int = SPAN):
    """For each chunk's keys, as bits: is it in another document too; is it hot: with contexts that one merge cannot take,
    or in ``hot_chunks`` chunks."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts, sizes = zip(*(_from_keys_message(p, FEW * (RUN_WINDOWS + span - 1)) for p in table.column("payload").to_pylist()))
        all_ = np.concatenate(parts)
        _, at, n = np.unique(all_ >> 1, return_inverse=True, return_counts=True)
        shared = (n > 1) | (np.bincount(at, all_ & 1) > 0)
        hot = np.bincount(at, np.concatenate(sizes)) > merge_bytes
        if hot_chunks is not None:
            hot |= n >= hot_chunks
        cut = np.cumsum([0, *map(len, parts)])
        said = [_answer_message(shared[at[a:b]], hot[at[a:b]]) for a, b in zip(cut, cut[1:])]
        return pa.Table.from_batches([_messages([(key[0].as_py(), c, s) for c, s in zip(table.column("chunk").to_pylist(), said)])])

    return run


def _send_contexts(buckets: int, span: int, gram: int):
    """To buckets: contexts of the keys that are not alone. To the chunk itself (bucket -1): where they occur."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk(left.to_pylist()[0])
        start, n, key, ids, order, head = c.keys(span, gram)
        said = [_from_answer_message(p) for _, p in sorted(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist()))]
        many = np.diff(np.append(head, len(order)))

        def of_runs(k):  # answers by distinct key -> by run
            bits = np.concatenate([np.zeros(0, bool), *[s[k] for s in said]])
            out = np.zeros(len(order), bool)
            out[order] = np.repeat(bits, many)
            return out

        shared, hot = (of_runs(0), of_runs(1)) if len(head) else (np.zeros(0, bool),) * 2
        index: dict[bytes, int] = {}
        of_key, least, spots = array("Q"), array("q"), array("q")
        for i in np.flatnonzero(shared).tolist():
            s, m, k, d = int(start[i]), int(n[i]), int(key[i]), int(ids[i])
            for a, w in ([(s + j, 1) for j in range(m)] if hot[i] else [(s, m)]):
                text = c.body[a:a + w + span - 1]
                at = index.setdefault(text, len(least))
                if at == len(least):
                    of_key.append(xxhash.xxh64_intdigest(text, 7) if hot[i] else k)
                    least.append(d)
                elif d < least[at]:
                    least[at] = d
                spots.extend((a, w, at, d))
        of_key, least = np.frombuffer(of_key, np.uint64), np.frombuffer(least, np.int64)
        sort = np.argsort(of_key, kind="stable")
        texts = list(index)
        rows = []
        for b, i, j in present(of_key[sort], buckets):
            mine = sort[i:j]
            rows.append((b, c.chunk, _contexts_message(of_key[mine] & np.uint64(0xFFFFFFFF), least[mine], [texts[k] for k in mine.tolist()])))
        place = np.empty(len(sort), np.int64)
        place[sort] = np.arange(len(sort))
        a, w, at, d = np.frombuffer(spots, np.int64).reshape(-1, 4).T
        rows.append((-1, c.chunk, pack(_gaps(a), w.astype(np.uint8), place[at].astype(np.int32), d > least[at] if len(at) else np.zeros(0, bool))))
        return pa.Table.from_batches([_messages(rows)])

    return run


def _merges(key: np.ndarray, size: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Indices in groups of whole keys, each of at most ``most`` bytes (or one key): equal windows have equal keys."""
    order = np.argsort(key, kind="stable")
    head = _heads(key[order])
    ends = np.cumsum(size[order])[np.append(head[1:], len(order)) - 1] if len(head) else head
    done = 0
    while done < len(head):
        before = int(ends[done - 1]) if done else 0
        to = max(done + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield np.sort(order[head[done]:head[to] if to < len(head) else None])
        done = to


def _answer_contexts(span: int, merge_bytes: int):
    """For each chunk's contexts: which of their windows start in a document with a smaller id than the chunk's smallest.
    What a chunk sent to itself passes."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table
        sent = sorted(zip(table.column("chunk").to_pylist(), table.column("payload").to_pylist()))
        index: dict[bytes, int] = {}
        at, ids, keys, shard = array("q"), [], array("q"), array("q")
        for k, (_, payload) in enumerate(sent):
            short, least, lens, joined = _from_contexts_message(payload)
            ends = np.cumsum(lens, dtype=np.int64).tolist()
            for i, e in enumerate(ends):
                text = joined[e - int(lens[i]):e]
                j = index.setdefault(text, len(keys))
                if j == len(keys):
                    keys.append(int(short[i]))
                    shard.append(k)
                at.append(j)
            ids.append(least)
        at, keys, shard = (np.frombuffer(x, np.int64) for x in (at, keys, shard))
        sent_ids = np.concatenate(ids)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, at, sent_ids)
        texts = list(index)
        windows = np.fromiter(map(len, texts), np.int64, len(texts)) - span + 1
        _, group, n = np.unique(keys, return_inverse=True, return_counts=True)
        first = np.repeat(least[:, None], RUN_WINDOWS, axis=1)
        several = np.flatnonzero(n[group] > 1)
        for part in _merges(keys[several], windows[several] + span - 1, merge_bytes):
            part = several[part]
            first[part] = window_ids([texts[i] for i in part.tolist()], shard[part], least[part], span)

        def bits(a, b):  # of the contexts of one chunk
            smaller = (first[at[a:b]] < sent_ids[a:b, None]) & (np.arange(RUN_WINDOWS)[None, :] < windows[at[a:b]][:, None])
            return np.packbits(smaller, axis=1, bitorder="little").view("<u4").ravel()

        cut = np.cumsum([0, *map(len, ids)])
        return pa.Table.from_batches([_messages([(key[0].as_py(), c, zstandard.compress(bits(a, b).tobytes(), LEVEL)) for (c, _), a, b in zip(sent, cut, cut[1:])])])

    return run


def _cut(struct: T.StructType, n_keep: int, span: int, whole_characters: bool):
    schema = to_arrow_schema(struct)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        c = _Chunk(row)
        said = sorted(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist()))
        start, n, at, larger = unpack(said[0][1])  # bucket -1
        start = _from_gaps(start)
        bits = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(zstandard.decompress(p), "<u4") for _, p in said[1:]]]).astype("<u4")
        size = len(c.bytes)
        # runs of a document that is not the chunk's smallest are covered whole, the others window by window
        whole_a, whole_b = start[larger], (start + n + span - 1)[larger]
        own = np.unpackbits(bits[at[~larger]].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        r, w = np.nonzero(own)
        one = start[~larger][r] + w
        steps = np.bincount(np.concatenate((whole_a, one)), minlength=size + 1)
        steps -= np.bincount(np.concatenate((whole_b, one + span)), minlength=size + 1)
        gone = np.cumsum(steps, out=steps)[:size] > 0
        out = {f.name: [] for f in schema}
        begin = 0
        for i, end in enumerate(c.ends.tolist()):
            mask = gone[begin:end]
            removed = int(mask.sum())
            kept = c.bytes[begin:end][~mask].tobytes() if removed else c.body[begin:end]
            digest = hashlib.sha256(kept).hexdigest()
            if removed and whole_characters:
                kept = kept.decode("utf-8", "ignore").encode()
            values = [*[row["rest"][i][f"c{j}"] for j in range(n_keep)], row["ids"][i], end - begin, removed,
                      int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed else 0, digest, kept]
            for f, v in zip(schema, values):
                out[f.name].append(v)
            begin = end
        return pa.Table.from_pydict(out, schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), span: int = SPAN,
                   gram: int | None = None, chunk_bytes: int = CHUNK_BYTES, hot_chunks: int | None = None, buckets: int | None = None, merge_bytes: int = MERGE_BYTES,
                   with_text: bool = False, whole_characters: bool = False) -> DataFrame:
    """One row for each input row: the kept columns (``k0``, ``k1``, ...), ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``
    and, ``with_text``, ``kept`` (binary; with ``whole_characters``, UTF-8 characters cut in half go from it, while
    ``kept_sha256`` is of the bytes as they were kept)."""
    gram = gram or min(GRAM, span)
    chunks = chunk_table(docs, id_col, text_col, list(keep), chunk_bytes)
    n = buckets or max(8, 2 * chunks.count())
    light = chunks.select("chunk", "ids", "ends", "body")
    asked = light.mapInArrow(_send_keys(n, span, gram), MESSAGE)
    known = asked.groupBy("bucket").applyInArrow(_answer_keys(hot_chunks, merge_bytes, span), MESSAGE)
    sent = light.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_send_contexts(n, span, gram), MESSAGE)
    own = F.when(F.col("bucket") < 0, F.col("chunk"))  # a group for each chunk, not one for all that is sent to chunks
    back = sent.groupBy("bucket", own.alias("own")).applyInArrow(_answer_contexts(span, merge_bytes), MESSAGE)
    rest = chunks.schema["rest"].dataType.elementType
    struct = T.StructType([*[T.StructField(f"k{i}", rest[f"c{i}"].dataType) for i in range(len(keep))],
                           T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                           *[T.StructField("kept", T.BinaryType())] * with_text])
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_cut(struct, len(keep), span, whole_characters), struct)
