"""Best-fit packing by bin completion, planned on the histogram of piece lengths.

Every document is tokenised and closed with an end id; only longer ones are cut, into full sequences and a rest. What is
left to pack is a multiset of lengths below the capacity, so the plan needs ``capacity`` counts and nothing else, however
many documents there are. The first incumbent is greedy: the largest length left takes the filling of the space beside it
that wastes least, as often as its lengths last. If the number of sequences is above the lower bound (all lengths over the
capacity, or the pieces that cannot share), the greedy plan is repeated with more nodes for a filling, and then bin
completion branches: a node is a histogram of what is left, a branch a filling of its largest length with its
multiplicity. Dominated fillings (a piece left over could take the place of smaller parts, or of the waste) are no
branches; a branch is cut when what it wasted, with the lower bound of the rest, cannot beat the incumbent, and when its
histogram was met before with as few sequences. The search ends at the lower bound, or when all is searched (the plan is
then the best possible), or after ``SEARCH_STEPS``, which is logged.

A piece finds its place by its rank among the pieces of its length (ranked without one task for a length that a third of
all documents share).

Defined results: null or empty text is the end id alone; repeated rows are packed each; a null id is packed like any
other; an empty table gives an empty table; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import logging
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, map_batches, ranked, texts, written

CAPACITY, END_ID = 4096, 1
#: Words whose ids a worker remembers; beyond it the memory starts anew (ids do not change by that).
MEMORY_WORDS = 1_000_000
#: Nodes of the search for one filling: first try, and the repeats if the bound is not reached.
NODES = (64, 1024, 8192)
#: Steps of the branch-and-bound search (a step of an enumeration is one, a node ``NODE_STEPS``).
SEARCH_STEPS, NODE_STEPS = 400_000, 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> dict:
    return {}


def _learn(tok, memory: dict[str, bytes], new: set[str]) -> None:
    """Ids of runs that are new. Words of letters go through the tokenizer many at a time, one pre-token each; a last
    comma or full stop after them is a pre-token of its own if normalising (NFC, lower case) leaves the last letter one
    letter, as in Latin-1; a combining mark that came of it would join the sign, so other runs are encoded whole."""
    stem = {r: r[:-1] for r in new if r[-1] in ",." and r[:-1].isalpha() and max(r) <= "\xff"}
    words = sorted((new.difference(stem) | set(stem.values()) | {",", "."}).difference(memory))
    letters, rest = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
    for i in range(0, len(letters), 500):
        part = letters[i:i + 500]
        e = tok.encode(" ".join(part), add_special_tokens=False)
        ids, word = np.array(e.ids, "<u4"), np.array(e.word_ids)
        if len(ids) and (np.diff(word) >= 0).all() and word[-1] + 1 == len(part):
            ends = np.searchsorted(word, np.arange(len(part) + 1)).tolist()
            flat = ids.tobytes()
            memory.update((w, flat[4 * ends[k]:4 * ends[k + 1]]) for k, w in enumerate(part))
        else:
            rest += part
    memory.update((w, np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in rest)
    memory.update((r, memory[s] + memory[r[-1]]) for r, s in stem.items())


def runs_of(text: str) -> list[str]:
    """Parts whose ids in turn are the text's: the pre-tokeniser never joins over white space. The tokenizer lower-cases
    anyway; doing it first, where a letter's lower case does not depend on its place (Latin-1), leaves fewer distinct
    parts. Python also splits at \\x1c-\\x1f, which are no white space for the tokenizer: a text with them is one part."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [text]
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split()
    return text.lower().split()


def encode_texts(texts_: list[str], path: str, memory_words: int = MEMORY_WORDS) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text; each distinct part is encoded once."""
    tok, memory = _tokenizer(path), _memory(path)
    out, step = [], 256
    for i in range(0, len(texts_), step):
        if len(memory) > memory_words:
            memory.clear()
        runs = [runs_of(t) for t in texts_[i:i + step]]
        _learn(tok, memory, set().union(*runs).difference(memory))
        out += [b"".join(map(memory.__getitem__, rs)) for rs in runs]
    return out


def _narrow(ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if wide.max() < 1 << 16 else ids


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           with_ids: bool = False, memory_words: int = MEMORY_WORDS, forget: bool = False) -> DataFrame:
    """Pieces of each document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (binary).

    The ids of a piece take two bytes each where all of them fit, else four. ``forget``: a worker forgets the words at the
    end of a task."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(cols):
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc, ids in zip(cols["doc_id"], encode_texts(cols["text"], path, memory_words)):
            ids += end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                for n, v in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), _narrow(part) if with_ids else None)):
                    out[n].append(v)
        return out

    def done():
        if forget:
            _memory(path).clear()
        give_back()

    return map_batches(texts(docs, id_col, text_col), run, PIECES + ", ids binary" * with_ids, done=done)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the space of all pieces; or pieces over half, which never share, and the rest.

    For each threshold k up to half the capacity: pieces over capacity - k are alone among those of at least k."""
    sizes = np.arange(len(counts))
    n = np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))
    w = np.concatenate((np.cumsum((counts * sizes)[::-1])[::-1], [0]))
    half = capacity // 2
    k = np.arange(1, half + 1)
    alone, big = n[capacity - k + 1], n[half + 1] - n[capacity - k + 1]
    space = big * capacity - (w[half + 1] - w[capacity - k + 1])
    more = np.maximum(0, -(-(w[k] - w[half + 1] - space) // capacity))
    return max(-(-int(w[0]) // capacity), int((alone + big + more).max(initial=0)))


def filling(left: np.ndarray, space: int, nodes: int) -> list[int]:
    """Lengths (from counts ``left``) that fill ``space`` with the least waste found, largest first.

    The first path down is best fit (the largest piece that fits, again and again): the incumbent. One piece, or two
    that fill the space exactly, are found from the counts at once."""
    best: list[int] = []
    taken: list[int] = []  # the path; a list of its own for what is untried at each depth, as paths of tiny pieces are long
    held: Counter[int] = Counter()
    untried: list[Iterator[int]] = []
    waste = room = top = space
    while True:
        if room < waste:
            best, waste = list(taken), room
        if not waste:
            return best
        nodes -= 1
        top = min(top, room)
        if room <= top and left[room] > held[room]:
            return [*taken, room]
        have = np.flatnonzero(left[:top + 1])
        if len(have):
            other = room - have
            pair = have[(left[other] > 0) & (other <= have) & ((other != have) | (left[have] > 1))]
            for x in pair[::-1][:8].tolist():
                y = room - x
                if left[x] - held[x] >= 1 + (x == y) and left[y] - held[y] >= 1:
                    return [*taken, x, y]
        untried.append(iter(have[::-1].tolist()))
        while True:
            x = next((x for x in untried[-1] if left[x] > held[x]), None)
            if x is not None:
                break
            untried.pop()
            if not taken or nodes <= 0:
                return best
            x = taken.pop()
            held[x] -= 1
            room += x
        taken.append(x)
        held[x] += 1
        room, top = room - x, x


def plan_patterns(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES[0]) -> list[tuple[int, list[int]]]:
    """(times, lengths largest first): fillings that use up ``counts`` (index = length, 0 unused)."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan = []
    for top in range(capacity, 0, -1):
        while left[top]:
            left[top] -= 1
            rest = filling(left, capacity - top, nodes) if top < capacity else []
            left[top] += 1
            lengths, many = np.unique([top, *rest], return_counts=True)
            times = int((left[lengths] // many).min())
            left[lengths] -= times * many
            plan.append((times, [top, *rest]))
    return plan


class _Steps:
    """Steps that are left of a search."""

    def __init__(self, left: int):
        self.left = left

    def spend(self, n: int = 1) -> bool:
        self.left -= n
        return self.left >= 0


def _bits(lengths) -> int:
    """Lengths as a set of bits."""
    flags = np.zeros(max(lengths, default=0) + 1, np.uint8)
    flags[list(lengths)] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _sums(parts: list[int]) -> int:
    """Sums of all choices of ``parts``, the empty one too, as bits."""
    sums = 1
    for x in parts:
        sums |= sums << x
    return sums


def dominated(parts: list[int], waste: int, spare: int, spare_too: list[int]) -> bool:
    """Could a piece left over take the place of some (or no) parts, smaller than it or several of its size?

    ``spare``: lengths left over that no part has, as bits; ``spare_too``: lengths left over that a part has."""
    reach, width = _sums(parts), 1  # sums, and up to ``waste`` more
    while width <= waste:
        step = min(width, waste + 1 - width)
        reach |= reach << step
        width += step
    if reach & spare:
        return True
    if not spare_too:
        return False
    more, width = _sums(parts) << 1 if waste else 0, 1
    while width < waste:
        step = min(width, waste - width)
        more |= more << step
        width += step
    return any((more | _sums([y for y in parts if y != x])) >> x & 1 for x in spare_too)


def undominated(left: np.ndarray, space: int, slack: int, steps: _Steps) -> Iterator[list[int]]:
    """Fillings of ``space`` from counts ``left`` that waste at most ``slack`` and are not dominated, largest parts first."""
    sizes = np.flatnonzero(left[:space + 1])[::-1].tolist()
    have = left[sizes].tolist()
    falling = [-x for x in sizes]
    after = np.concatenate((np.cumsum((np.array(sizes, np.int64) * np.array(have, np.int64))[::-1])[::-1], [0])).tolist()
    all_ = _bits(sizes)
    path: list[list[int]] = []  # [index of the size, how many], without zeros
    i, room = 0, space
    while steps.spend():
        i = max(i, bisect_left(falling, -room))
        if i < len(sizes) and room - after[i] <= slack:
            path.append([i, min(have[i], room // sizes[i])])
            room -= sizes[i] * path[-1][1]
            i += 1
            continue
        if i == len(sizes) and room <= slack:
            parts = [sizes[k] for k, n in path for _ in range(n)]
            spare = all_
            for k, _ in path:
                spare &= ~(1 << sizes[k])
            if not dominated(parts, room, spare, [sizes[k] for k, n in path if have[k] > n]):
                yield parts
        if not path:
            return
        i = path[-1][0] + 1
        path[-1][1] -= 1
        room += sizes[i - 1]
        if not path[-1][1]:
            path.pop()


def _branches(left: np.ndarray, capacity: int, slack: int, steps: _Steps, all_times: bool) -> Iterator[tuple[int, list[int]]]:
    """(times, lengths largest first): the fillings of the largest length, least waste first in blocks of them; each as often as
    possible, and with ``all_times`` later also half as often, and so on to once: so every number of times can be reached."""
    top = int(np.flatnonzero(left)[-1])
    rest = left.copy()
    rest[top] -= 1
    found = undominated(rest, capacity - top, slack, steps)
    fewer = []
    while block := [[top, *f] for f in islice(found, 64)]:
        block.sort(key=sum, reverse=True)
        for lengths in block:
            times = min(int(left[x]) // n for x, n in Counter(lengths).items())
            yield times, lengths
            # alone since nothing fits, or filled by one piece: no other filling is as good while it lasts
            if all_times and (len(lengths) > 2 or len(lengths) == 2 and sum(lengths) < capacity):
                fewer.append((times // 2, lengths))
    for times, lengths in fewer:
        while times:
            yield times, lengths
            times //= 2


def searched_plan(counts: np.ndarray, incumbent: list[tuple[int, list[int]]], capacity: int = CAPACITY,
                  budget: int = SEARCH_STEPS) -> tuple[list[tuple[int, list[int]]], bool]:
    """Branch and bound from the plan ``incumbent``: (plan, is it known to be the best possible). First with each filling as
    often as possible only, as a small tree has the plans of large counts, then with all numbers of times."""
    best, _ = _search(counts, incumbent, capacity, _Steps(budget // 2), False)
    return _search(counts, best, capacity, _Steps(budget // 2), True)


def _search(counts: np.ndarray, incumbent: list[tuple[int, list[int]]], capacity: int, steps: _Steps,
            all_times: bool) -> tuple[list[tuple[int, list[int]]], bool]:
    left = counts.astype(np.int64).copy()
    left[0] = 0
    bound = lower_bound(left, capacity)
    best, fewest = incumbent, sum(t for t, _ in incumbent)
    path: list[tuple[int, list[int]]] = []
    open_: list[Iterator[tuple[int, list[int]]]] = []
    met: dict[bytes, int] = {}
    used = 0
    while fewest > bound:
        if not steps.spend(NODE_STEPS):
            return best, False
        least = lower_bound(left, capacity)
        state = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
        if not least and used < fewest:
            best, fewest = list(path), used
            branches = iter(())
        elif used + least >= fewest or met.get(state, fewest) <= used:
            branches = iter(())
        else:
            met[state] = used
            slack = (fewest - 1 - used) * capacity - int(left @ np.arange(len(left)))
            branches = _branches(left, capacity, slack, steps, all_times)
        open_.append(branches)
        while open_ and (branch := next(open_[-1], None)) is None:
            open_.pop()
            if path:
                times, lengths = path.pop()
                used -= times
                np.add.at(left, lengths, times)
        if not open_:
            return best, steps.left >= 0
        times, lengths = branch
        path.append(branch)
        used += times
        np.subtract.at(left, lengths, times)
    return best, True


def best_plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """The plan with the fewest sequences: greedy over ever wider searches, then branch and bound; ends early where the
    lower bound is reached."""
    bound, best = lower_bound(counts, capacity), None
    for nodes in NODES:
        plan = plan_patterns(counts, capacity, nodes)
        if best is None or sum(t for t, _ in plan) < sum(t for t, _ in best):
            best = plan
        if sum(t for t, _ in best) <= bound:
            return best
    best, known = searched_plan(counts, best, capacity)
    if not known:
        logging.getLogger(__name__).warning("packing: the search ended after its steps at %d sequences, lower bound %d",
                                            sum(t for t, _ in best), bound)
    return best


def place_rows(plan: list[tuple[int, list[int]]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, per sequence, first sequence, offset): where the pieces of a length go by rank."""
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for times, lengths in plan:
        at = 0
        for length, many in zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))):
            first = int(used[length])
            rows.append((length, first, first + times * many, many, sequence, at))
            used[length] += times * many
            at += length * many
        sequence += times
    return rows


def _widened(packed: DataFrame) -> DataFrame:
    """``ids`` as unsigned 32-bit integers."""
    keep = [c for c in packed.columns if c not in ("ids", "length")]

    def run(cols):
        return {"length": cols["length"], "ids": [b if len(b) == 4 * n else np.frombuffer(b, "<u2").astype("<u4").tobytes() for b, n in zip(cols["ids"], cols["length"])]}

    wide = map_batches(packed, run, "length long, ids binary", keep)
    return wide.select(*[F.col(f"k{keep.index(c)}").alias(c) if c in keep else F.col(c) for c in packed.columns])


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         with_ids: bool = False, memory_words: int = MEMORY_WORDS, forget: bool = False) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``)."""
    p = written(pieces(docs, path, id_col, text_col, capacity, with_ids, memory_words, forget), "pieces")
    spark = p.sparkSession
    # at most ``capacity`` rows, whatever the number of documents
    hist = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)
    for k, n in hist.items():
        counts[k] = n
    rows = place_rows(best_plan(counts, capacity), capacity)
    table = spark.createDataFrame(rows, "at_length long, first long, end long, many long, first_sequence long, at long")
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(1 << 62))
    r = ranked(p, ["length"], ["doc_id", "piece", "ids_crc32"], spread, int(counts.sum()), "rank")
    r = r.join(F.broadcast(table), (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    nth = F.col("rank") - F.col("first")
    packed = r.select(*p.columns, (F.col("first_sequence") + F.expr("(rank - first) div many")).alias("sequence_id"),
                      (F.col("at") + nth % F.col("many") * F.col("length")).cast("long").alias("offset"))
    return _widened(packed) if with_ids else packed
