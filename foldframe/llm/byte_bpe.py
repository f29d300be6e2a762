"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each partition.

A text is split by the public pattern into words (each match separately). The distinct words that a task has not met yet
become token-position rows, one for each byte; a recursive query joins neighbours with the merge table (left id, right id
-> rank) and contracts each word's leftmost pair of minimum rank, until no word has a mergeable pair. A document's ids are
its words' ids in order. Decoding turns every document's ids into (document, position, id) rows, joins the vocabulary and
aggregates the bytes in order of position.

A task remembers the ids of the words it met (``MEMORY_WORDS``, then anew); documents pass in batches; DuckDB runs in the
worker with bounded memory. No shuffle.

Defined results: null or empty text has no ids and decodes to nothing; repeated rows are encoded each; an empty table
gives an empty table; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_batches, texts
from .token_counts import read_ranks, runs_of

MEMORY_WORDS = 1_000_000
#: Words of one recursive query, and bytes of text decoded by one query.
QUERY_WORDS, QUERY_BYTES = 20_000, 4_000_000
#: A longer word (bytes) would take a round for each of its pairs: it is contracted alone, by the same rule.
LONG_WORD = 400

#: Rows stay in the order of (word, position): one thread, joins probed from the left, neighbours read by windows without
#: an order (``ORDERED`` keeps it so; ``error`` would say if a neighbour ever came out of order). A merge's new id is its
#: rank, so the least (rank, position) of a word says where to contract and what comes of it.
ORDERED = "SET preserve_insertion_order = true; SET disabled_optimizers = 'join_order,build_side_probe_side'"
NEIGHBOURS = """
    SELECT * FROM (
      WITH pairs AS MATERIALIZED (
        SELECT word, pos, y.id, CASE WHEN prev_word = word THEN prev END AS prev,
               CASE WHEN next_word < word OR next_word = word AND next <= pos THEN error('out of order') ELSE m.rank * 4294967296 + pos END AS r
        FROM (SELECT word, pos, id, lead(id) OVER () AS next_id, lead(word) OVER () AS next_word, lead(pos) OVER () AS next,
                     lag(pos) OVER () AS prev, lag(word) OVER () AS prev_word FROM {rows}) y
        LEFT JOIN merges m ON m.a = y.id AND m.b = y.next_id AND next_word = word)
      SELECT word, pos, id, prev, least FROM pairs LEFT JOIN (SELECT word, min(r) AS least FROM pairs GROUP BY word) USING (word))
"""
CONTRACTED = """(
          SELECT word, pos, CASE WHEN pos = least & 4294967295 THEN (least >> 32)::INTEGER ELSE id END AS id
          FROM step WHERE least IS NOT NULL AND prev IS DISTINCT FROM least & 4294967295)"""
ENCODE = f"""
WITH RECURSIVE step(word, pos, id, prev, least) AS (
    {NEIGHBOURS.format(rows="start")}
  UNION ALL
    {NEIGHBOURS.format(rows=CONTRACTED)}
)
SELECT word, list(id ORDER BY pos) AS ids FROM step WHERE least IS NULL GROUP BY word ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(v.hex, '' ORDER BY pos) AS hex FROM ids JOIN vocabulary v USING (id) GROUP BY doc ORDER BY doc
"""


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(a, b, rank): every split of an entry into two entries; joining a and b makes it, at its rank, which is its id."""
    a, b, rank = [], [], []
    for token, r in ranks.items():
        for i in range(1, len(token)):
            x, y = ranks.get(token[:i]), ranks.get(token[i:])
            if x is not None and y is not None:
                a.append(x)
                b.append(y)
                rank.append(r)
    return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "rank": pa.array(rank, pa.int64())})


def contract(ids: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """The same rule for one long word: the leftmost pair of minimum rank, again and again, from a heap."""
    nxt, prv, alive = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), [True] * len(ids)
    heap = [(r, i, i + 1) for i in range(len(ids) - 1) if (r := merges.get((ids[i], ids[i + 1]))) is not None]
    heapify(heap)
    while heap:
        r, i, j = heappop(heap)
        if not alive[i] or j >= len(ids) or not alive[j] or nxt[i] != j or merges.get((ids[i], ids[j])) != r:
            continue
        ids[i], alive[j], nxt[i] = r, False, nxt[j]
        if nxt[j] < len(ids):
            prv[nxt[j]] = i
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b < len(ids) and (q := merges.get((ids[a], ids[b]))) is not None:
                heappush(heap, (q, a, b))
    return [x for x, ok in zip(ids, alive) if ok]


class Codec:
    """One worker's database with the merge table and the vocabulary, and the words it met."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self.db.execute(ORDERED)
        pairs, entries = merge_table(ranks), pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        self.db.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM entries")
        self.merges = dict(zip(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()), pairs["rank"].to_pylist()))
        self.memory: dict[str, bytes] = {}  # ids of words, and of runs of words

    def _learn(self, words: list[str]) -> None:
        for w in (w for w in words if len(w) * 4 > LONG_WORD and len(w.encode()) > LONG_WORD):
            self.memory[w] = np.array(contract(self.byte_ids[np.frombuffer(w.encode(), np.uint8)].tolist(), self.merges), "<u4").tobytes()
        words = [w for w in words if w not in self.memory]
        for i in range(0, len(words), QUERY_WORDS):
            part = words[i:i + QUERY_WORDS]
            raw = [w.encode() for w in part]
            lens = np.fromiter(map(len, raw), np.int64, len(raw))
            word = np.repeat(np.arange(len(raw), dtype=np.int32), lens)
            pos = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            start = pa.table({"word": word, "pos": pos, "id": self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]})  # noqa: F841
            got = self.db.sql(ENCODE).to_arrow_table()
            ids = got.column("ids").combine_chunks()
            ends = ids.offsets.to_numpy().tolist()
            flat = ids.values.to_numpy().astype("<u4").tobytes()
            for k, w in enumerate(got.column("word").to_pylist()):
                self.memory[part[w]] = flat[4 * ends[k]:4 * ends[k + 1]]

    def _words(self, run: str) -> list[str]:
        """The pattern's matches in a run; letters, and letters with a last comma or full stop, need no matching."""
        letters = run[1:] if run[:1] == " " else run
        if letters.isalpha():
            return [run]
        if letters[-1:] in (",", ".") and letters[:-1].isalpha():
            return [run[:-1], run[-1]]
        return self.pattern.findall(run)

    def encode(self, texts_: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        memory = self.memory
        if len(memory) > MEMORY_WORDS:
            memory.clear()
        split = [runs_of(t) for t in texts_]
        # a run of text between spaces is matched once; a text with double spaces is matched whole
        new = {r: self._words(r) for r in set().union(*[rs for rs in split if rs is not None]).difference(memory)}
        whole = {i: self.pattern.findall(t) for i, (t, rs) in enumerate(zip(texts_, split)) if rs is None}
        self._learn(sorted(set().union(*new.values(), *whole.values()).difference(memory)))
        memory.update((r, b"".join(map(memory.__getitem__, ws))) for r, ws in new.items() if len(ws) != 1 or ws[0] != r)
        return [b"".join(map(memory.__getitem__, whole[i] if rs is None else rs)) for i, rs in enumerate(split)]

    def decode(self, ids_: list[bytes]) -> list[bytes]:
        out, i = [], 0
        while i < len(ids_):
            j, size = i, 0
            while j < len(ids_) and (j == i or size + len(ids_[j]) <= QUERY_BYTES):
                size += len(ids_[j])
                j += 1
            lens = np.array([len(x) // 4 for x in ids_[i:j]])
            ids = pa.table({"doc": np.repeat(np.arange(j - i, dtype=np.int32), lens),  # noqa: F841
                            "pos": np.arange(lens.sum()), "id": np.frombuffer(b"".join(ids_[i:j]), "<u4").astype(np.int32)})
            got = dict(self.db.execute(DECODE).fetchall())
            out += [bytes.fromhex(got.get(k, "")) for k in range(j - i)]
            i = j
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def run(cols):
        c = codec(path, pattern)
        out = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for i in range(0, len(cols["text"]), 512):
            ids = c.encode(cols["text"][i:i + 512])
            out["n_tokens"] += [len(x) // 4 for x in ids]
            out["ids_sha256"] += [hashlib.sha256(x).hexdigest() for x in ids]
            out["decoded_sha256"] += [hashlib.sha256(x).hexdigest() for x in c.decode(ids)]
        return out

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``."""
    def run(cols):
        ids = codec(path, pattern).encode(cols["text"])
        return {"doc_id": cols["doc_id"], "ids": [np.frombuffer(x, "<u4").astype(np.int32).tolist() for x in ids]}

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, text`` (binary)."""
    def run(cols):
        raw = [np.array(x or [], "<u4").tobytes() for x in cols["ids"]]
        return {"doc_id": cols["doc_id"], "text": codec(path, pattern).decode(raw)}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text binary")
