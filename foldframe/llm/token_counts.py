"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A pre-token (by the public pattern) is split into vocabulary entries so that the sum of their scores is the largest. The
best score of a prefix depends on the prefix alone, so distinct pre-tokens go into a trie and each node's forward score
is computed once, from its ancestors on the path; the node where a pre-token ends keeps its token count. A document's
count is the sum over its pre-tokens. The vocabulary is a public rank file (nothing is trained): an entry's score is its
Zipf log probability, -log(rank + 1) - log(H), H making the sum 1. All 256 bytes are entries, so every text has a split.
Equal scores: the split with fewer tokens counts.

Each worker keeps one trie over the documents that it meets and starts anew beyond ``TRIE_NODES`` nodes: memory is
bounded, counts do not depend on it, no shuffle is needed.

Defined results: null or empty text has 0 tokens; repeated rows are counted each; an empty table gives an empty table;
other columns are ignored.
"""
from __future__ import annotations

import base64
import math
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from .common import map_batches, texts

TRIE_NODES = 600_000
#: Runs of text whose counts a worker remembers.
MEMORY_RUNS = 400_000
DOUBLE_SPACE = regex.compile(r"\s\s")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {t: -math.log(r + 1) - total for t, r in ranks.items()}


class Trie:
    """Nodes are numbered; a child is found by (node, byte); a node has the best score and token count of its prefix."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores, self.longest = scores, max(map(len, scores))
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best: list[float] = [0.0]
        self.count: list[int] = [0]

    def tokens(self, word: bytes) -> int:
        """Token count of a pre-token; makes the nodes that are missing."""
        if len(self.best) > TRIE_NODES:
            self.clear()
        node, path, child, best, count = 0, [0], self.child, self.best, self.count
        for end, byte in enumerate(word, 1):
            nxt = child.get(node << 8 | byte)
            if nxt is None:
                top, fewest = -math.inf, 0
                for start in range(max(0, end - self.longest), end):
                    s = self.scores.get(word[start:end])
                    if s is not None:
                        at = path[start]
                        s += best[at]
                        n = count[at] + 1
                        if s > top or s == top and n < fewest:
                            top, fewest = s, n
                nxt = child[node << 8 | byte] = len(best)
                best.append(top)
                count.append(fewest)
            node = nxt
            path.append(node)
        return count[node]


@lru_cache(maxsize=2)
def _model(path: str, pattern: str):
    return Trie(zipf_scores(read_ranks(path))), regex.compile(pattern), {}


def runs_of(text: str) -> list[str] | None:
    """Parts that the pattern never matches across: a space between two other characters begins a match.

    None if two white spaces meet; then the pattern is needed on the whole text."""
    if DOUBLE_SPACE.search(text):
        return None
    first, *rest = text.split(" ")
    return [first, *[" " + r for r in rest]]


def count_texts(texts_: list[str], path: str, pattern: str) -> list[tuple[int, int]]:
    """(tokens, pre-tokens) of each text."""
    trie, pat, memory = _model(path, pattern)
    out = []

    def of(run: str) -> int:  # both numbers in one: they add up in one pass
        n = memory.get(run)
        if n is None:
            words = pat.findall(run)
            n = memory[run] = (len(words) << 40) + sum(trie.tokens(w.encode()) for w in words)
        return n

    for text in texts_:
        if len(memory) > MEMORY_RUNS:
            memory.clear()
        runs = runs_of(text)
        n = sum(map(of, pat.findall(text) if runs is None else runs))
        out.append((n & (1 << 40) - 1, n >> 40))
    return out


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: ``doc_id, n_tokens, n_pretokens``."""
    def run(cols):
        n = count_texts(cols["text"], path, pattern)
        return {"doc_id": cols["doc_id"], "n_tokens": [x for x, _ in n], "n_pretokens": [y for _, y in n]}

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, n_tokens long, n_pretokens long")
