"""Each operator against a brute-force version on a small table with the awkward rows: null and repeated ids, null and
empty texts, ties, copies, a very long text, extra columns with clashing names; and on an empty table."""
import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldframe.llm import elias_fano, exact_dedup, language_model, packing, sharding, simhash, sketches, suffix_dedup, token_counts, toxicity
from foldframe.llm.byte_bpe import bpe_round_trip, codec, decode, encode

BPE, WORD_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
WORDS = ["alpha", "Beta", "gamma,", "the", "of", "été", "größe.", "日本", "x1", "it's", "zeta"]


def _rows():
    r = random.Random(5)
    passages = [" ".join(r.choices(WORDS, k=30)) for _ in range(3)]
    rows = []
    for i in range(50):
        t = " ".join(r.choices(WORDS, k=r.randint(0, 30)))
        if r.random() < 0.5:
            t += " " + r.choice(passages)[r.randint(0, 20):r.randint(60, 160)] + r.choice(["", "  end", "\n"])
        rows.append((i, t))
    rows += [(60, rows[3][1]), (61, rows[3][1].upper()), (3, rows[3][1]), (62, None), (63, ""), (64, " \n "), (None, "alpha beta"), (None, None),
             (65, "ab" * 300), (66, " ".join(r.choices(WORDS, k=6000))), (67, "\x1c odd \x1f"), (68, "a"), (69, "É ALPHA")]
    return rows


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    # clashing and inner names, in another order than the operators use
    return spark.createDataFrame([(t, i, "x", 1, 2) for i, t in ROWS], "text string, doc_id long, name string, block int, idx int").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id = -5")


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def _sorted(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def _lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def _sha(t):
    return hashlib.sha256(t if isinstance(t, bytes) else t.encode()).hexdigest()


# ---- exact dedup

@pytest.mark.parametrize("block_bytes,hash_bits", [(4096, 64), (64, 64), (64, 2), (7, 3)])
def test_exact_dedup(docs, block_bytes, hash_bits):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(_lower(t), []).append(i)
    expect = []
    for i, t in ROWS:
        g = groups[_lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        expect.append((i, keep, len(g), i == keep, _sha(_lower(t))))
    got = _sorted(exact_dedup.exact_dedup(docs, block_bytes=block_bytes, hash_bits=hash_bits), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(expect, key=_key)


def test_exact_dedup_empty(empty):
    assert exact_dedup.exact_dedup(empty).collect() == []


# ---- sharding

@pytest.mark.parametrize("shards", [1, 3, 16, 100])
def test_sharding(docs, shards):
    got = sharding.shard_rows(docs, shards).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=_key) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS), key=_key)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1 and all(0 <= s < shards for s in counts)
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


@pytest.mark.parametrize("shards", [3, 16])
def test_sharding_walks_the_ring_row_by_row(spark, docs, shards):
    """Each row on its own: to its place's node, and from there clockwise to the first shard with room."""
    place = F.expr(f"pmod(xxhash64(coalesce(cast(doc_id as string), 'null')), {sharding.RING})")
    many = spark.range(3000).select((F.col("id") % 700).alias("doc_id"), F.lit("t").alias("text")).unionByName(docs.select("doc_id", "text"))
    rows = sorted(r.p for r in many.select(place.alias("p")).collect())
    nodes = sharding.ring_nodes(spark, shards)
    room = {s: len(rows) // shards + (s < len(rows) % shards) for s in range(shards)}
    want, waiting = Counter(), []
    for p in rows:
        at = next((k for k, (q, _) in enumerate(nodes) if q >= p), 0)
        shard = nodes[at][1]
        if room[shard]:
            room[shard] -= 1
            want[p, shard] += 1
        else:
            waiting.append((p, at))
    for p, at in waiting:
        shard = next(s for _, s in nodes[at:] + nodes[:at] if room[s])
        room[shard] -= 1
        want[p, shard] += 1
    got = sharding.shard_rows(many, shards).withColumn("p", place).groupBy("p", "shard").count().collect()
    assert {(r.p, r.shard): r["count"] for r in got} == dict(want) and waiting


def test_sharding_moves_little(spark):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a = {r.doc_id: (r.shard, r.moved) for r in sharding.shard_rows(many, 8).collect()}
    b = {r.doc_id: r.shard for r in sharding.shard_rows(many, 9).collect()}
    assert sum(m for _, m in a.values()) < 1200  # most rows stay at their first node
    assert sum(b[i] != s for i, (s, _) in a.items()) < 2400  # a new shard's share, and the overflow's change
    assert a == {r.doc_id: (r.shard, r.moved) for r in sharding.shard_rows(many.repartition(7), 8).collect()}


def test_sharding_empty(empty):
    assert sharding.shard_rows(empty).collect() == []


# ---- SimHash

def _fingerprint(text):
    words = [w for w in __import__("re").split(r"[ \t\n\x0b\x0c\r]+", _lower(text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(items, max_bits):
    """items: (id, fingerprint) -> smallest id reachable, by fingerprint."""
    fps = sorted({f for _, f in items})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= max_bits:
            root[find(a)] = find(b)
    least = {}
    for i, f in items:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return {f: least.get(find(f)) for f in fps}


def test_simhash(docs):
    items = [(i, _fingerprint(t)) for i, t in ROWS]
    comp = _components(items, 4)
    got = _sorted(simhash.simhash_dedup(docs), "doc_id", "fingerprint", "component_id")
    assert got == sorted(((i, f"{f:016x}", comp[f]) for i, f in items), key=_key)


@pytest.mark.parametrize("max_bits,blocks,dense", [(4, 6, 1024), (4, 7, 2), (4, 9, 1024), (3, 5, 2), (2, 4, 2)])
def test_near_components(spark, max_bits, blocks, dense):
    r = random.Random(max_bits)
    fps = set()
    for c in [r.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]:
        for _ in range(12):
            fps.add(c)
            c ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 6)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.near_components(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits, blocks, dense).collect()
    root = {f: f for f in signed} | {r_.node: r_.root for r_ in got}
    expect = _components([(f - (1 << 64) if f >> 63 else f, f) for f in fps], max_bits)
    assert {f: expect[f & (1 << 64) - 1] for f in signed} == root


def test_dense_key_links_by_midpoints():
    r = random.Random(3)
    center, mask = r.getrandbits(64), (1 << 22) - 1 << 42
    fps = np.array(sorted({center ^ sum(1 << b for b in r.sample(range(42), r.randint(0, 5))) for _ in range(300)}), np.uint64)
    a, b = simhash.roots_in_key(fps, mask, 4, dense=1000), simhash.roots_in_key(fps, mask, 4, dense=10)
    assert (a == b).all()


def test_simhash_empty(empty):
    assert simhash.simhash_dedup(empty).collect() == []


# ---- suffix dedup

def _cut(rows, span):
    first, out = {}, []
    data = [(suffix_dedup.NO_ID if i is None else i, i, (t or "").encode()) for i, t in rows]
    for k, _, t in data:
        for s in range(len(t) - span + 1):
            first[t[s:s + span]] = min(first.get(t[s:s + span], k), k)
    for k, i, t in data:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - span + 1):
            if first[t[s:s + span]] < k:
                gone[s:s + span] = True
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), runs, _sha(bytes(b for b, g in zip(t, gone) if not g))))
    return sorted(out, key=_key)


@pytest.mark.parametrize("span,gram,chunk_bytes,hot_chunks,buckets", [(50, 24, 1 << 22, 256, None), (50, 24, 700, 1, 5), (50, 24, 900, 3, 40), (20, 7, 800, 256, 3)])
def test_suffix_dedup(docs, span, gram, chunk_bytes, hot_chunks, buckets):
    got = suffix_dedup.remove_repeats(docs, span=span, gram=gram, chunk_bytes=chunk_bytes, hot_chunks=hot_chunks, buckets=buckets)
    assert _sorted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _cut(ROWS, span)


@pytest.mark.parametrize("merge_bytes", [1, 500, 20_000])
def test_suffix_dedup_merges_in_parts(docs, merge_bytes):
    got = suffix_dedup.remove_repeats(docs, span=20, gram=7, chunk_bytes=800, buckets=3, merge_bytes=merge_bytes)
    assert _sorted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _cut(ROWS, 20)


def test_merges_take_whole_keys():
    r = np.random.default_rng(2)
    key, size = r.integers(0, 9, 60), r.integers(50, 90, 60)
    for most in (1, 300, 1 << 20):
        parts = list(suffix_dedup._merges(key, size, most))
        assert sorted(np.concatenate(parts).tolist()) == list(range(60))
        assert sum(len(set(key[p].tolist())) for p in parts) == len(set(key.tolist()))
        assert all(size[p].sum() <= most or len(set(key[p].tolist())) == 1 for p in parts)
    assert list(suffix_dedup._merges(key[:0], size[:0], 10)) == []


def _line_rows():
    r, line = random.Random(8), "a line of more than fifty bytes that very many documents hold, at any place"
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=7))
    return [(i, " ".join([word(), word(), *([line] if i % 2 else []), word(), word()])) for i in range(400)]


def test_key_with_many_contexts_in_few_chunks_is_dealt(monkeypatch):
    import pyarrow as pa
    import zstandard

    rows, most, span, gram, buckets = _line_rows(), 2000, 50, 24, 3
    merged = []
    inner = suffix_dedup.window_ids
    monkeypatch.setattr(suffix_dedup, "window_ids", lambda contexts, *a: merged.append(sum(map(len, contexts))) or inner(contexts, *a))
    chunks = []
    for k in range(4):
        part = rows[100 * k:100 * k + 100]
        chunks.append({"chunk": k, "ids": [i for i, _ in part], "ends": np.cumsum([len(t) for _, t in part]).tolist(),
                       "body": zstandard.compress("".join(t for _, t in part).encode())})
    table = lambda batches: pa.Table.from_batches(list(batches))
    by = lambda t, column, v: t.filter(pa.compute.equal(t[column], pa.scalar(v, t.schema.field(column).type)))
    asked = table(suffix_dedup._send_keys(buckets, span, gram)(iter([pa.RecordBatch.from_pylist(chunks)])))
    known = pa.concat_tables([suffix_dedup._answer_keys(256, most, span)((pa.scalar(b),), by(asked, "bucket", b)) for b in range(buckets)])
    sent = pa.concat_tables([suffix_dedup._send_contexts(buckets, span, gram)(pa.Table.from_pylist([c]), by(known, "chunk", c["chunk"])) for c in chunks])
    for b in range(buckets):
        suffix_dedup._answer_contexts(span, most)((pa.scalar(b),), by(sent, "bucket", b))
    assert max(merged, default=0) <= most


@pytest.mark.parametrize("merge_bytes", [2000, 1 << 20])
def test_suffix_dedup_of_a_frequent_line(spark, merge_bytes):
    docs = spark.createDataFrame(_line_rows(), "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, chunk_bytes=9000, merge_bytes=merge_bytes)
    assert _sorted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _cut(_line_rows(), 50)


def test_suffix_dedup_writes_the_chunks_only(docs, monkeypatch):
    """Contexts go to the buckets in a shuffle: a written copy of them would be on disk twice."""
    from foldframe import session

    made: list[str] = []
    monkeypatch.setattr(session, "_SCRATCH", made)
    suffix_dedup.remove_repeats(docs, chunk_bytes=2000).collect()
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in made] == ["chunks"]


def test_suffix_dedup_of_keys_that_many_chunks_hold():
    """Such a key is dealt window by window only where its contexts pass what one merge takes."""
    import inspect

    import pyarrow as pa

    most = inspect.signature(suffix_dedup.remove_repeats).parameters["hot_chunks"].default
    one = suffix_dedup._keys_message(np.array([10, 20], np.uint32), np.zeros(0), np.zeros(0))
    for n, want in ((400, [False, False]), (9000, [True, True])):
        asked = pa.table({"bucket": pa.array([0] * n, pa.int32()), "chunk": pa.array(range(n), pa.int64()), "payload": pa.array([one] * n, pa.binary())})
        said = suffix_dedup._answer_keys(most)((pa.scalar(0),), asked).column("payload").to_pylist()
        shared, hot = suffix_dedup._from_answer_message(said[-1])
        assert shared.tolist() == [True, True] and hot.tolist() == want


def test_suffix_dedup_keeps_columns(docs):
    got = suffix_dedup.remove_repeats(docs, keep=tuple(docs.columns), with_text=True).collect()
    assert sorted(((r.k1, r.k0, r.k2, r.k3, r.k4) for r in got), key=_key) == sorted(((i, t, "x", 1, 2) for i, t in ROWS), key=_key)
    assert all(_sha(bytes(r.kept)) == r.kept_sha256 for r in got)


def test_merged_intervals_are_equal_windows():
    r = random.Random(1)
    contexts = ["".join(r.choices("ab", k=r.randint(50, 80))).encode() * 1 for _ in range(30)] + [b"ab" * 35, b"ba" * 30]
    shard = np.array(sorted(r.randint(0, 4) for _ in contexts))
    starts, interval, offset = suffix_dedup.merged_intervals(contexts, shard, 12)
    text, of = b"".join(contexts), {}
    for s, v in zip(starts.tolist(), interval.tolist()):
        c = int(np.searchsorted(offset, s, side="right")) - 1
        if s + 12 <= offset[c + 1]:
            of.setdefault(text[s:s + 12], set()).add(v)
    assert all(len(v) == 1 for v in of.values()) and len(set.union(*of.values())) == len(of)


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.remove_repeats(empty).collect() == []


# ---- packing

def test_plan_of_very_many_tiny_pieces():
    counts = np.zeros(4097, np.int64)
    counts[1:4] = 3, 9000, 700
    plan = packing.best_plan(counts)
    assert sum(times for times, _ in plan) == packing.lower_bound(counts, 4096)
    used = np.zeros(4097, np.int64)
    for times, lengths in plan:
        assert sum(lengths) <= 4096
        np.add.at(used, lengths, times)
    assert (used == counts).all()


def test_packing(docs):
    tok = Tokenizer.from_file(WORD_BPE)
    expect = []
    for i, t in ROWS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 300)):
            part = ids[a:a + 300]
            expect.append((i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack(docs, WORD_BPE, capacity=300)
    assert _sorted(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expect, key=_key)
    seqs = {}
    for r in got.collect():
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 300
    counts = np.bincount([e[3] for e in expect], minlength=301)
    assert len(seqs) == packing.lower_bound(counts, 300)


def test_bin_completion_against_exhaustive_search():
    r = random.Random(2)
    for _ in range(60):
        cap = r.randint(8, 20)
        items = [r.randint(1, cap) for _ in range(r.randint(1, 8))]

        def fewest(rest, bins):
            if not rest:
                return len(bins)
            return min([fewest(rest[1:], [*bins[:k], b - rest[0], *bins[k + 1:]]) for k, b in enumerate(bins) if b >= rest[0]]
                       + ([fewest(rest[1:], [*bins, cap - rest[0]])] if len(bins) < len(items) else [99]))

        plan = packing.best_plan(np.bincount(items, minlength=cap + 1), cap)
        assert sorted(x for n, p in plan for x in p * n) == sorted(items) and all(sum(p) <= cap for _, p in plan)
        best = fewest(sorted(items, reverse=True), [])
        assert packing.lower_bound(np.bincount(items, minlength=cap + 1), cap) <= best <= sum(n for n, _ in plan) <= best + 1


def test_search_branches_over_fillings():
    counts = np.bincount([2096, 1896, 1696, 1600, 1200, 1040, 1000, 960, 800], minlength=4097)
    assert sum(n for n, _ in packing.best_plan(counts)) == 3
    assert sum(n for n, _ in packing.best_plan(1000 * counts)) == 3000  # a filling with its multiplicity is one branch


def test_search_finds_the_fewest_sequences():
    r = random.Random(9)
    for _ in range(150):
        cap = r.randint(12, 40)
        items = [r.randint(2, cap * 2 // 3) for _ in range(r.randint(6, 11))]

        def fits(rest, bins):
            if not rest:
                return True
            return any(fits(rest[1:], [*bins[:k], b - rest[0], *bins[k + 1:]])
                       for k, b in enumerate(bins) if b >= rest[0] and b not in bins[:k])

        items.sort(reverse=True)
        plan = packing.best_plan(np.bincount(items, minlength=cap + 1), cap)
        used = sum(n for n, _ in plan)
        assert sorted((x for n, p in plan for x in p * n), reverse=True) == items and all(sum(p) <= cap for _, p in plan)
        assert not fits(items, [cap] * (used - 1))


def test_ids_of_letters_that_normalise_to_marks():
    tok = Tokenizer.from_file(WORD_BPE)
    for t in ["AYNİ,", "BELEDİYESİ.", "तरफ़,", "AYNİ BELEDİYESİ, İ. yer", "तरफ़ तरफ़. größe, été.", "ΌΣΟΣ, ΣΟΦΟΣ. Å,", "Ｅ́, ǰ. Việt,"]:
        assert packing.encode_texts([t], WORD_BPE) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]


def test_packing_empty(empty):
    assert packing.pack(empty, WORD_BPE).collect() == []


# ---- language model

@pytest.mark.parametrize("chunk_tokens,split,buckets", [(1 << 20, 1 << 20, None), (200, 20, 5), (1000, 7, 11)])
def test_lm_scores(docs, chunk_tokens, split, buckets):
    toks = [(i, [w for w in __import__("re").split(rb"[ \t\n\x0b\x0c\r]+", _lower(t).encode()) if w] + [b"\n"]) for i, t in ROWS]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in toks}
    c, pairs = Counter(), Counter()
    for i, t in toks:
        if not held[i]:
            c.update(t)
            pairs.update(zip([b"\n", *t], t))
    n, v = sum(c.values()), len(c)
    p = {w: (c[w] + 1) / (n + v + 1) for _, t in toks for w in t}
    expect = sorted(((i, held[i], len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(p[w]) for w in t),
                      sum(math.log10((pairs[h, w] + 1000 * p[w]) / (c[h] + 1000)) for h, w in zip([b"\n", *t], t))) for i, t in toks), key=_key)
    got = _sorted(language_model.lm_scores(docs, chunk_tokens=chunk_tokens, split=split, buckets=buckets), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert len(got) == len(expect)
    for g, e in zip(got, expect):
        assert g[:5] == e[:5] and abs(g[5] - e[5]) < 1e-8 and abs(g[6] - e[6]) < 2e-4 * e[2]


def test_smoothed_probabilities_sum_to_one():
    c, pairs = Counter(b"abcab"), Counter(zip(b"abca", b"bcab"))
    n, v = 5, 3
    base = {w: (c[w] + 1) / (n + v + 1) for w in c} | {"new": 1 / (n + v + 1)}
    seen = Counter({h: sum(x for (a, _), x in pairs.items() if a == h) for h in c})
    for h in c:
        total = sum(pairs[h, w] / (seen[h] + 1000) + 1000 / (seen[h] + 1000) * base[w] for w in base)
        assert abs(total - 1) < 1e-12


def test_elias_fano_and_trie(tmp_path):
    rng = np.random.default_rng(1)
    for n, top in ((1, 5), (10, 10), (1000, 10**9), (1000, 300), (5000, 2**40)):
        v = np.sort(rng.integers(0, top, n))
        e = elias_fano.EliasFano.of(v)
        assert (e.access(np.arange(n)) == v.astype(np.uint64)).all()
        q = np.concatenate((rng.integers(0, top + 10, 500), v))
        assert (e.successor(q) == np.searchsorted(v, q)).all()
    pairs = np.unique(rng.integers(0, 300, (2000, 2)), axis=0)
    trie = elias_fano.NgramTrie.of(pairs[:, 0], pairs[:, 1], np.full(len(pairs), 0.25))
    trie.save(str(tmp_path / "t"))
    trie = elias_fano.NgramTrie.open(str(tmp_path / "t"))
    asked = rng.integers(0, 320, (3000, 2))
    have = set(map(tuple, pairs.tolist()))
    codes = trie.look_up(asked[:, 0], np.arange(len(asked)), asked[:, 1])
    assert [c > 0 for c in codes] == [tuple(a) in have for a in asked.tolist()]
    assert abs(elias_fano.restored(codes).max() - 0.25) < 1e-4
    assert len(elias_fano.NgramTrie.of(*[np.zeros(0, np.int64)] * 2, np.zeros(0)).look_up(asked[:, 0], np.arange(3), asked[:3, 1])) == 3


def test_lm_empty(empty):
    assert language_model.lm_scores(empty).collect() == []


# ---- byte-level BPE

def _tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_as_tiktoken(docs):
    enc = _tiktoken()
    expect = []
    for i, t in ROWS:
        ids = enc.encode_ordinary(t or "")
        expect.append((i, len(ids), _sha(np.array(ids, "<u4").tobytes()), _sha(t or "")))
    got = bpe_round_trip(docs, BPE, public_tokenizers.PATTERN)
    assert _sorted(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expect, key=_key)


def test_bpe_encode_then_decode(docs):
    back = decode(encode(docs, BPE, public_tokenizers.PATTERN), BPE, public_tokenizers.PATTERN)
    assert sorted(((r.doc_id, bytes(r.text)) for r in back.collect()), key=_key) == sorted(((i, (t or "").encode()) for i, t in ROWS), key=_key)


def test_bpe_long_words_and_signs():
    enc, c = _tiktoken(), codec(BPE, public_tokenizers.PATTERN)
    for t in ["a" * 2000, "abcab" * 200, "日本語" * 300, "🎉🎉 we'll  go\n\n\nnow ", "\x00\x01 \x7f", "!?!?," * 50, "x" * 399 + "é", "don't,won't."]:
        assert np.frombuffer(c.encode([t])[0], "<u4").tolist() == enc.encode_ordinary(t)


def test_bpe_empty(empty):
    assert bpe_round_trip(empty, BPE, public_tokenizers.PATTERN).collect() == []


# ---- token counts

def test_token_counts(docs):
    import regex

    scores = token_counts.zipf_scores(token_counts.read_ranks(BPE))
    assert abs(sum(map(math.exp, scores.values())) - 1) < 1e-9

    def count(word):
        best = [(0.0, 0)]
        for e in range(1, len(word) + 1):
            best.append(max(((best[s][0] + scores[word[s:e]], best[s][1] - 1) for s in range(e) if word[s:e] in scores)))
        return -best[-1][1]

    expect = []
    for i, t in ROWS:
        words = regex.findall(public_tokenizers.PATTERN, t or "")
        memo = {w: count(w.encode()) for w in set(words)}
        expect.append((i, sum(memo[w] for w in words), len(words)))
    got = token_counts.token_counts(docs, BPE, public_tokenizers.PATTERN)
    assert _sorted(got, "doc_id", "n_tokens", "n_pretokens") == sorted(expect, key=_key)


def test_token_counts_do_not_depend_on_memory(monkeypatch):
    texts = [t or "" for _, t in ROWS]
    a = token_counts.count_texts(texts, BPE, public_tokenizers.PATTERN)
    monkeypatch.setattr(token_counts, "TRIE_NODES", 10)
    monkeypatch.setattr(token_counts, "MEMORY_RUNS", 5)
    assert a == token_counts.count_texts(texts, BPE, public_tokenizers.PATTERN)


def test_token_counts_empty(empty):
    assert token_counts.token_counts(empty, BPE, public_tokenizers.PATTERN).collect() == []


# ---- sketches

def _sketched(text, scale):
    """Distinct five-word shingles (fewer words: the whole), those kept, and the fingerprint; written apart from the operator."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    grams = [b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    every = sorted({xxhash.xxh64(g, seed=42).intdigest() for g in grams})
    kept = [h for h in every if h * scale < 1 << 64]
    check = xxhash.xxh32(b"".join(h.to_bytes(8, "little") for h in every)).intdigest()
    return every, set(kept), f"{len(every)}.{check:08x}." + "".join(f"{h:016x}" for h in kept)


def _like(a, b):
    if not a[1] or not b[1]:
        return float(a[0] == b[0])
    return len(a[1] & b[1]) / min(len(a[1]), len(b[1]))


@pytest.mark.parametrize("parts, scale", [(2, 2), (5, 8), (40, 1)])
def test_document_fingerprints(docs, parts, scale):
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    expect = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        m = len(t) // 4
        new = t[:len(t) - m] + following[:m]
        a, b, c = (_sketched(x, scale) for x in (t, new, following))
        expect.append((i, len(t), _sha(new.encode()), a[2], b[2], _like(a, b), _like(a, c)))
    got = sketches.document_fingerprints(docs, parts=parts, scale=scale)
    assert _sorted(got, "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == sorted(expect, key=_key)


def test_parts_by_binary_search(spark):
    for n in (0, 1, 2, 3, 7, 8, 100):
        cuts = [10 * i - 35 for i in range(n)]
        got = spark.range(-60, 1000).select("id", sketches._part(F.col("id"), cuts).alias("p")).collect()
        assert all(r.p == sum(c <= r.id for c in cuts) for r in got)


def test_sketch_estimates_containment():
    r = random.Random(1)
    words = [f"w{r.randint(0, 99999)}" for _ in range(8000)]
    whole, part, other = " ".join(words).encode(), " ".join(words[1000:1800]).encode(), " ".join(words[4000:] + words[:10][::-1] * 400).encode()
    a, b, c = map(sketches.Sketch, (whole, part, other))
    assert sketches.likeness(a, b)[0] > 0.97 and sketches.likeness(a, b)[1] < 0.15
    every = [h for h in simhash.shingle_hashes(simhash.words_of(whole), 5).tolist() if h < (1 << 64) // sketches.SCALE]
    assert a.kept.tolist() == sorted(set(every))
    assert set(sketches.merged(a.kept, c.kept).tolist()) == set(a.kept.tolist()) | set(c.kept.tolist())


def test_one_document_is_its_own_next(spark):
    r = sketches.document_fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert r.near_next == 1.0 and r.edited_sha256 == _sha("a b c a")


def test_fingerprints_empty(empty):
    assert sketches.document_fingerprints(empty).collect() == []


# ---- toxicity

@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(4)
    clean = [f"w{i}" for i in range(60)]
    bad = ["vile", "nasty", "grim"]
    rows = []
    for i in range(600):
        ws = r.choices(clean, k=30)
        toxic = int(i % 5 == 0)
        for _ in range(toxic * r.choice([1, 1, 3, 8])):
            ws.insert(r.randint(0, len(ws)), r.choice(bad) + r.choice(["", ",", "!"]))
        rows.append((i, " ".join(ws), toxic))
    return rows


def test_toxicity_on_held_out_rows(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in labelled if i % 2] + [(None, 1), (1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {i: x for i, _, x in labelled if i % 2 == 0}
    assert sum(got[i].toxic and not x for i, x in truth.items()) <= 2
    assert sum(bool(got[i].toxic) == bool(x) for i, x in truth.items()) >= 0.95 * len(truth)
    many = [got[i].severity for i, t, x in labelled if sum(t.count(w) for w in ("vile", "nasty", "grim")) >= 6]
    one = [got[i].severity for i, t, x in labelled if sum(t.count(w) for w in ("vile", "nasty", "grim")) == 1]
    assert np.mean(many) > np.mean(one) > np.mean([got[i].severity for i, _, x in labelled if not x])


def test_cumulative_thresholds_are_ordered(labelled):
    _, thresholds = toxicity.fit([(x, sorted(set(toxicity.words(t.encode())))) for _, t, x in labelled])
    assert thresholds == sorted(thresholds) and len(thresholds) == toxicity.GRADES


def test_sample_bounds_the_rows_on_the_driver(spark):
    rows = [(7, f"text {i % 40} of one id") for i in range(400)] + [(8, "of another"), (8, "text 3 of one id"), (9, "not labelled")]
    labels = spark.createDataFrame([(7, 0), (8, 1)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert toxicity._sample_rows(docs, labels, 10, "doc_id", "text").count() == 10
    got = toxicity.labelled_words(docs, labels, 100)
    texts = sorted({t.encode() for i, t in rows if i != 9}, key=lambda t: hashlib.sha256(t).digest())
    assert got == [(int(t in (b"of another", b"text 3 of one id")), sorted(set(toxicity.words(t)))) for t in texts]
    assert toxicity.labelled_words(docs, labels, 10) == got[:10]


def test_toxicity_fit_is_a_minimum_and_scores_follow_the_model(spark, labelled):
    """The objective, written out document by document, is not lower anywhere near the fit; scores are its probabilities."""
    rows = [(x, sorted(set(toxicity.words(t.encode())))) for _, t, x in labelled]
    weights, thresholds = toxicity.fit(rows)
    grades = toxicity.grade(rows)

    def objective(w, t):
        total = 0.0
        for (_, ws), g in zip(rows, grades):
            z = sum(w.get(x, 0.0) for x in ws)
            for k, cut in enumerate(t, 1):
                p = 1 / (1 + math.exp(-(z - cut)))
                total -= math.log(p if g >= k else 1 - p)
        return total / len(rows) + 2e-4 * sum(map(abs, w.values()))

    best = objective(weights, thresholds)
    r = random.Random(4)
    for word in [*sorted(weights, key=lambda x: -abs(weights[x]))[:6], *r.sample(sorted(weights), min(4, len(weights)))]:
        for step in (-0.2, 0.2):
            assert objective(weights | {word: weights[word] + step}, thresholds) > best - 1e-6
    for k in range(len(thresholds)):
        for step in (-0.1, 0.1):
            moved = [c + step * (i == k) for i, c in enumerate(thresholds)]
            if moved == sorted(moved):
                assert objective(weights, moved) > best - 2e-4
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled[:60]], "doc_id long, text string")
    for r_ in toxicity.score(docs, (weights, thresholds)).collect():
        z = sum(weights.get(x, 0.0) for x in set(toxicity.words(labelled[r_.doc_id][1].encode())))
        p = [1 / (1 + math.exp(-(z - c))) for c in thresholds]
        assert abs(r_.severity - sum(p)) < 1e-9 and abs(r_.p_toxic - p[0]) < 1e-9 and r_.toxic == (p[0] >= toxicity.CUT)


def test_toxicity_edge_rows(spark, docs, empty):
    labels = spark.createDataFrame([(3, 1), (60, 0), (3, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels)
    assert _sorted(got, "doc_id") == sorted(((i,) for i, _ in ROWS), key=_key)
    assert {r.severity for r in toxicity.toxicity(docs, labels.where("toxic = 2")).collect()} == {0.0}
    assert toxicity.toxicity(empty, labels).collect() == []
