"""Language-model scores from an Elias-Fano bigram trie.

Words are runs of bytes other than space and \\x09-\\x0D, A-Z lower-cased; a text ends with one end token, which is also
the context of the first word. The base model is add-one over training tokens. The trie holds, for each context h seen in
training, its successors w with the quantised value c(hw) / (c(h) + PRIOR); the smoothed probability is that value plus
PRIOR / (c(h) + PRIOR) * base(w) (a Dirichlet prior around the base model, so the sum over words and the unknown one is 1).

Nothing of the model fits one machine, so it is dealt by hash, and documents ask for what they need:

1. Documents are gathered into chunks: token sequences over the chunk's own words (a written table). Each chunk sends its
   distinct words with their training counts to the words' buckets, and gets back total counts and word ids.
2. Each chunk sends its distinct pairs (context, word) of known words with their training counts to the pairs' buckets. A
   bucket adds the counts up, writes its part of the trie to a file, maps it into memory and answers all pairs from it by
   context-relative successor search. A context with very many occurrences is dealt over several buckets (``SPLIT``).
3. Chunks put the answers together: base score and score of every document.

Counts cover all training documents; nothing is pruned. Word keys are 64-bit hashes only for dealing and sorting; words
are compared as such.

Defined results: null text = empty (one end token); a null id counts as the empty text in the fold's checksum; repeated
rows are counted and scored each; without training documents every count is 0; an empty table gives an empty table; other
columns are ignored.
"""
from __future__ import annotations

import os
import tempfile
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_texts, written
from .elias_fano import NgramTrie, restored
from .simhash import words_of
from .suffix_dedup import MESSAGE, _heads, _messages, mixed, pack, present, unpack

CHUNK_TOKENS = 1 << 20
#: Occurrences of a context for each bucket that its pairs are dealt to.
SPLIT = 1 << 20
PRIOR = 1000.0
FOLDS, HELD_OUT = 7, 2
END = b"\n"  # no word holds it
CHUNKS = "chunk long, docs binary, tokens binary, words binary, counts binary"
STATS = MESSAGE + ", n_train long, n_types long"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int | None, folds: int = FOLDS, fold: int = HELD_OUT) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def chunk_table(docs: DataFrame, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """Written table: of each chunk the documents (id, null id, held out, tokens), the token sequence over the chunk's
    words in the order of their hashes, these words, and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        index: defaultdict = defaultdict()
        rows, parts, size = [], [], 0

        def row():
            nonlocal index, rows, parts, size, made
            words = list(index)
            order = sorted(range(len(words)), key=[xxhash.xxh64_intdigest(w) for w in words].__getitem__)
            to = np.empty(len(words), np.uint32)
            to[order] = np.arange(len(words), dtype=np.uint32)
            tokens = to[np.concatenate(parts)]
            ids, held, n = zip(*rows)
            held, n = np.array(held, bool), np.array(n, np.int64)
            counts = np.bincount(tokens[np.repeat(~held, n)], minlength=len(words)).astype(np.uint32)
            out = [base + made, pack([i is None for i in ids], np.array([i or 0 for i in ids], np.int64), held, n), pack(tokens),
                   zstandard.compress(b" ".join([words[i] for i in order]), 3), pack(counts)]
            index, rows, parts, size, made = defaultdict(), [], [], 0, made + 1
            index.default_factory = index.__len__
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in out], names=["chunk", "docs", "tokens", "words", "counts"])

        index.default_factory = index.__len__
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                words.append(END)
                parts.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                rows.append((doc, held_out(doc), len(words)))
                size += len(words)
                if size >= chunk_tokens:
                    yield row()
        if rows:
            yield row()

    return written(binary_texts(docs, id_col, text_col).mapInArrow(run, CHUNKS), "token-chunks")


def _send_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, (counts,) = zstandard.decompress(r["words"]).split(b" "), unpack(r["counts"])
                key = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
                yield _messages([(b, r["chunk"], pack(b" ".join(words[i:j]), counts[i:j])) for b, i, j in present(key, buckets)])

    return run


def _answer_words(buckets: int):
    """Word ids (-1: not in training) and training counts; a row of chunk -1 has the bucket's totals."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        index: defaultdict = defaultdict()
        index.default_factory = index.__len__
        places, counts, chunks = [], [], table.column("chunk").to_pylist()
        for p in table.column("payload").to_pylist():
            words, n = unpack(p)
            ws = words.split(b" ")
            places.append(np.fromiter(map(index.__getitem__, ws), np.int64, len(ws)))
            counts.append(n)
        total = np.bincount(np.concatenate(places), np.concatenate(counts), len(index)).astype(np.int64)  # whole numbers: exact
        words = list(index)
        trained = sorted(np.flatnonzero(total).tolist(), key=words.__getitem__)
        ids = np.full(len(words), -1, np.int64)
        ids[trained] = np.arange(len(trained)) * buckets + bucket
        rows = [(bucket, c, pack(ids[at], total[at]), 0, 0) for c, at in zip(chunks, places)]
        rows.append((bucket, -1, b"", int(total.sum()), len(trained)))
        b, c, p, n, v = zip(*rows)
        return pa.Table.from_arrays([pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(p, pa.binary()), pa.array(n, pa.int64()), pa.array(v, pa.int64())],
                                    names=["bucket", "chunk", "payload", "n_train", "n_types"])

    return run


class _Chunk:
    """A chunk's documents and tokens with the answers to its words; pairs in the order in which they are sent."""

    def __init__(self, row: dict, words: list[tuple[int, bytes]], buckets: int, split: int):
        self.chunk = row["chunk"]
        self.no_id, self.doc_ids, self.held, self.n = unpack(row["docs"])
        (self.tokens,) = unpack(row["tokens"])
        ids, counts = zip(*[unpack(p) for _, p in sorted(words)])
        self.ids, self.counts = np.concatenate(ids), np.concatenate(counts)
        end = self.tokens[-1]  # every text ends with the end token
        previous = np.concatenate(([end], self.tokens[:-1])).astype(np.uint64)
        pairs = previous << np.uint64(32) | self.tokens.astype(np.uint64)
        distinct, self.pair = np.unique(pairs, return_inverse=True)
        h, w = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)
        known = np.flatnonzero((self.ids[h] >= 0) & (self.ids[w] >= 0))
        parts = (1 + self.counts[h[known]] // split).astype(np.uint64)
        part = mixed(self.ids[w[known]].astype(np.uint64) + np.uint64(1)) % parts
        bucket = mixed(self.ids[h[known]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint64), kind="stable")
        self.sent, self.bucket, self.h, self.w = known[order], bucket[order].astype(np.int64), h, w


def _send_pairs(buckets: int, split: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk(left.to_pylist()[0], list(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist())), buckets, split)
        trained = np.bincount(c.pair[np.repeat(~c.held, c.n)], minlength=len(c.h)).astype(np.uint32)
        starts = _heads(c.bucket)  # of the buckets that the chunk has pairs for
        rows = []
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(c.bucket)]):
            mine = c.sent[i:j]
            h = c.h[mine]
            head = _heads(h)
            rows.append((int(c.bucket[i]), c.chunk, pack(c.ids[h[head]], c.counts[h[head]], np.diff(np.append(head, len(h))).astype(np.uint32),
                                                         _narrow(c.ids[c.w[mine]]), trained[mine])))
        return pa.Table.from_batches([_messages(rows)])

    return run


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x


def _answer_pairs(prior: float):
    """The bucket's part of the trie, and every asked pair's code from it."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        sent = [unpack(p) for p in table.column("payload").to_pylist()]
        context, times = np.concatenate([s[0] for s in sent]), np.concatenate([s[1] for s in sent])
        of = np.repeat(np.arange(len(context)), np.concatenate([s[2] for s in sent]))
        word, trained = np.concatenate([s[3] for s in sent]).astype(np.int64), np.concatenate([s[4] for s in sent])
        # each pair once, in the order of (context, word): chunks ask for many of the same
        h = context[of]
        narrow = not len(h) or max(int(h.max()), int(word.max())) < 1 << 32
        o = np.argsort(h.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)) if narrow else np.lexsort((word, h))
        h, w = h[o], word[o]
        head = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])))) if len(h) else np.zeros(0, np.int64)
        n = np.add.reduceat(trained[o].astype(np.int64), head) if len(head) else np.zeros(0, np.int64)
        h, w, c = h[head], w[head], times[of[o[head]]]
        seen = n > 0
        built = NgramTrie.of(h[seen], w[seen], n[seen] / (c[seen] + prior))
        first = _heads(h)
        file, path = tempfile.mkstemp(suffix=".trie")  # this task's own scratch: read back here and removed
        os.close(file)
        try:
            built.save(path)
            found = NgramTrie.open(path).look_up(h[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h)))), w)
        finally:
            os.unlink(path)
        codes = np.empty(len(o), np.uint16)
        codes[o] = np.repeat(found, np.diff(np.append(head, len(o))))
        cut = np.cumsum([0, *[len(s[3]) for s in sent]])
        return pa.Table.from_batches([_messages([(key[0].as_py(), k, pack(codes[a:b])) for k, a, b in zip(chunks, cut, cut[1:])])])

    return run


def _score(buckets: int, split: int, prior: float, n_train: int, n_types: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        said = [(b, k, p) for b, k, p in zip(right.column("bucket").to_pylist(), right.column("kind").to_pylist(), right.column("payload").to_pylist())]
        c = _Chunk(left.to_pylist()[0], [(b, p) for b, k, p in said if k == 0], buckets, split)
        base = (c.counts + 1) / (n_train + n_types + 1)
        value = np.zeros(len(c.h))
        value[c.sent] = restored(np.concatenate([np.zeros(0, np.uint16), *[unpack(p)[0] for _, p in sorted((b, p) for b, k, p in said if k == 1)]]))
        smooth = value + prior / (c.counts[c.h] + prior) * base[c.w]
        starts = np.cumsum(c.n) - c.n
        # sums of one document only: they do not depend on the chunk
        logs, scores = np.log10(base)[c.tokens], np.log10(smooth)[c.pair]
        ends = (starts + c.n).tolist()
        spans = list(zip(starts.tolist(), ends))
        known = c.counts[c.tokens] > 0
        return pa.Table.from_pydict({
            "doc_id": pa.array([None if x else i for x, i in zip(c.no_id, c.doc_ids.tolist())], pa.int64()), "held_out": pa.array(c.held), "n_tokens": pa.array(c.n),
            "n_known": pa.array(np.add.reduceat(known.astype(np.int64), starts)), "train_tokens": pa.array(np.full(len(c.n), n_train, np.int64)),
            "base_score": pa.array([float(logs[a:b].sum()) for a, b in spans], pa.float64()), "score": pa.array([float(scores[a:b].sum()) for a, b in spans], pa.float64())})

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, chunk_tokens: int = CHUNK_TOKENS,
              split: int = SPLIT, buckets: int | None = None) -> DataFrame:
    """One row for each input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    chunks = chunk_table(docs, id_col, text_col, chunk_tokens)
    n = buckets or max(8, 2 * chunks.count())
    words = chunks.select("chunk", "words", "counts").mapInArrow(_send_words(n), MESSAGE).groupBy("bucket").applyInArrow(_answer_words(n), STATS)
    words = written(words, "word-answers")
    totals = words.where("chunk < 0").agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_types"), F.lit(0)).alias("v")).first()
    words = words.where("chunk >= 0").select("bucket", "chunk", "payload")
    tokens = chunks.select("chunk", "docs", "tokens")
    pairs = tokens.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(_send_pairs(n, split), MESSAGE)
    codes = pairs.groupBy("bucket").applyInArrow(_answer_pairs(prior), MESSAGE)
    back = words.withColumn("kind", F.lit(0)).unionByName(codes.withColumn("kind", F.lit(1)))
    return tokens.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_score(n, split, prior, totals["n"], totals["v"]), RESULT)
