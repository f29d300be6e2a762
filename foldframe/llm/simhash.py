"""SimHash near-dedup by pigeonhole blocks.

A document's fingerprint has a bit set where over half of its 4-word shingles' XXH64 hashes have it. 64 bits are split
into ``b`` blocks; two fingerprints at most ``max_bits`` apart agree on at least ``b - max_bits`` of them, so they meet
under the key of one choice of ``b - max_bits`` blocks. Fingerprints (one row for each distinct one, however many
documents share it) are joined on those keys, the Hamming distance of those that meet is verified, and connected
components follow. ``b`` grows with the number of fingerprints so that a key holds few by chance; the result is the same
for every ``b``.

A key that very many near fingerprints share never makes all pairs: in a key with over ``DENSE`` fingerprints, two are
linked through a midpoint (within ``max_bits`` of each other exactly if some point is within half of that of both), and
the fingerprints around one midpoint are linked to their smallest. From each key only a spanning forest leaves the task.

Defined results: null or wordless text has fingerprint zero, linked like any other; under four words the whole sequence
is the one shingle; repeated rows are returned each; an empty table gives an empty table; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_texts, map_batches, written
from .graph import components

SEED, SHINGLE_WORDS, MAX_BITS = 42, 4, 4
DENSE = 1024
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased; words are runs of bytes other than space and \\x09-\\x0D."""
    return text.translate(LOWER_AZ).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces; fewer words: of the whole sequence; none: nothing."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    cut = map(joined.__getitem__, map(slice, starts, ends[size - 1:].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, len(starts))


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    h = shingle_hashes(words_of(text), size)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):  # the bits of a very long text in steps
        part = np.ascontiguousarray(h[i:i + (1 << 14)]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long)."""
    def run(cols):
        fp = np.array([fingerprint(t, size) for t in cols["text"]], np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "fp": fp}

    return map_batches(binary_texts(docs, id_col, text_col), run, "doc_id long, fp long")


def block_masks(blocks: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of each choice of ``blocks - max_bits`` of ``blocks`` blocks of the 64 bits."""
    at = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << at[i + 1]) - 1) ^ ((1 << at[i]) - 1) for i in range(blocks)]
    return [sum(one[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]


def blocks_for(n: int, max_bits: int = MAX_BITS) -> int:
    """The fewest blocks for which a key holds under one of ``n`` random fingerprints."""
    b = max_bits + 2
    while n >> (64 * (b - max_bits) // b) and b < max_bits + 8:
        b += 1
    return b


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 by the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def roots_in_key(fps: np.ndarray, mask: int, max_bits: int = MAX_BITS, dense: int = DENSE) -> np.ndarray:
    """For distinct fingerprints that agree under ``mask``: index of the smallest linked one, for each."""
    n = len(fps)
    a, b = [], []
    if n <= dense:
        step = max(1, (1 << 20) // n)
        for i in range(0, n, step):
            near = _bits(fps[i:i + step, None] ^ fps[None, :]) <= max_bits
            x, y = np.nonzero(near)
            x = x + i
            a.append(x[x < y])
            b.append(y[x < y])
        return _roots(n, np.concatenate(a), np.concatenate(b))
    # midpoints: within max_bits // 2 of the one and the rest of the other (an odd distance takes the larger half)
    free = [1 << i for i in range(64) if not mask >> i & 1]
    half = (max_bits + 1) // 2
    flips = np.array([sum(c) for k in range(half + 1) for c in combinations(free, k)], np.uint64)
    parts = 1 + n * len(flips) // (1 << 22)
    root = np.arange(n)
    for p in range(parts):  # midpoints in parts, so that memory does not follow the key's size
        zs, who = [], []
        for f in flips:
            z = fps ^ f
            mine = np.flatnonzero((z * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts) == p)
            zs.append(z[mine])
            who.append(mine)
        z, w = np.concatenate(zs), np.concatenate(who)
        o = np.argsort(z, kind="stable")
        z, w = z[o], w[o]
        head = np.flatnonzero(np.concatenate(([True], z[1:] != z[:-1]))) if len(z) else np.zeros(0, int)
        first = np.repeat(w[head], np.diff(np.append(head, len(z)))) if len(z) else w
        far = _bits(fps[w] ^ fps[first]) <= max_bits  # odd max_bits: two halves may add up to one more
        a, b = [w[far], np.arange(n)], [first[far], root]
        root = _roots(n, np.concatenate(a), np.concatenate(b))
    return root


def _links(masks: list[int], max_bits: int, dense: int):
    """Rows (choice, key, fp), sorted by them in a partition -> spanning forest (a, b) of the links of each key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def links(c, k, f, last):
            """Of the runs that are complete; the rest is returned."""
            change = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            starts = np.concatenate(([0], change)).astype(np.int64)
            end = len(c) if last else int(starts[-1])
            bounds = np.append(starts[starts < end], end)
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            sizes = np.diff(bounds)
            for i in np.flatnonzero(sizes > 1):
                fps = f[bounds[i]:bounds[i + 1]]
                if len(fps) == 2:
                    if int(fps[0] ^ fps[1]).bit_count() <= max_bits:
                        a.append(fps[1:])
                        b.append(fps[:1])
                    continue
                root = roots_in_key(fps, masks[int(c[bounds[i]])], max_bits, dense)
                other = root != np.arange(len(fps))
                a.append(fps[other])
                b.append(fps[root[other]])
            x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"]), (c[end:], k[end:], f[end:])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now = [now[0], now[1], now[2].view(np.uint64)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            out, held = links(*now, last=False)
            if out.num_rows:
                yield out
        if held is not None and len(held[0]):
            out, _ = links(*held, last=True)
            if out.num_rows:
                yield out

    return run


def near_components(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, dense: int = DENSE) -> DataFrame:
    """``fps(fp long)``, distinct -> ``node, root`` of the fingerprints that have a link."""
    blocks = blocks or blocks_for(fps.count(), max_bits)
    masks = block_masks(blocks, max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("k.choice", "k.key", "fp")
    met = rows.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")
    return components(met.mapInArrow(_links(masks, max_bits, dense), "a long, b long"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS, blocks: int | None = None, dense: int = DENSE) -> DataFrame:
    """One row for each input row: ``doc_id, fingerprint`` (hex)``, component_id`` (smallest id reachable)``, kept``."""
    rows = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    ids = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    comp = near_components(ids.select("fp"), max_bits, blocks, dense)
    named = written(ids.join(comp, ids["fp"] == comp["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    final = written(named.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(final, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
