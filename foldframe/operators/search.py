"""Exact cosine search of query domains against a target database: one plan, one ranking rule.

Both sides are dealt to pivots (directions chosen from a bounded sample of the targets): every vector belongs to the
pivot nearest to it, and a pivot's radius is the angle of its farthest member. Two vectors of pivots whose centres are
``a`` apart cannot be nearer than ``a`` less both radii, so a pair of pivots whose bound lies under what is asked for (the
minimum score, or the k-th best score that the queries of a pivot already have from their own pivot) is never joined. Only
the sample (``SAMPLE_ROWS`` vectors) and a few numbers for each of the ``MAX_PIVOTS`` pivots pass through the driver.

What is left is streamed: the queries of a pivot form blocks of bounded size, consecutive blocks form a unit of at most
``UNIT_ROWS`` queries or so, each unit is sent once every target that one of its blocks has to see, and a sort
inside the partitions puts the queries of a unit before its targets. A task holds one unit of queries and one Arrow batch
of targets, scores them with numpy and keeps ``k`` rows a query, so a unit sends on ``k`` rows a query for each
``TASK_TARGETS`` targets, not for each block of them; where a unit has more than ``SPLIT_PAIRS`` pairs to score and there
are few units, its targets are spread over several groups too. A last top-k merges the groups.

Ranking rule: the kernel makes the integer ``score_key`` (score x 10,000, halves away from zero) and everything ranks,
filters and thresholds on that column, then on ``dbindex``. Results therefore do not depend on pivots, block sizes, chunk
sizes or partition counts.
"""
from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..constants import EMPTY_METADATA
from ..session import ensure_checkpoint_dir
from ..sources.store import written

SCORE_SCHEMA = "qid long, dbindex long, score double, score_key long, q_len int, t_len int"
_NAMES = ["qid", "dbindex", "score", "score_key", "q_len", "t_len"]
RANK_SCALE = 10_000             # score_key = score x RANK_SCALE, rounded
QUERY_BLOCK_ROWS = 16_384       # x 128 floats = 8 MiB
UNIT_ROWS = 2 * QUERY_BLOCK_ROWS  # queries of a unit, at most: each unit is sent the targets once
TARGET_BLOCK_ROWS = 65_536      # targets of one pivot, on average
MAX_PIVOTS = 512                # at most so many pivots, whatever the number of targets
SAMPLE_ROWS = 4 * MAX_PIVOTS    # targets from which they are chosen, at most
TASK_TARGETS = 1 << 26          # targets that one task streams past a block of queries
SLACK = 1e-6                    # for rounding in the bounds of pairs of pivots
WORK_ELEMENTS = 1 << 20         # query rows x target rows scored at once in one task: 4 MiB an array, which caches hold
HELD_ROWS = 2_048               # query rows of these, at most
PIECE_PAIRS = 1 << 16           # pairs that are scored again at once, and found pairs that a task holds before it sends them on
SENT_ROWS = 1 << 21             # targets sent to units of queries, if there could be fewer units
SPLIT_PAIRS = 1 << 28           # pairs that one task scores, while there are fewer tasks than SPLIT_TASKS a core
SPLIT_TASKS = 2                 # a group more sends every query and its k rows once more, so there are no more than keep the cores busy
MAX_SLOTS = 1 << 14             # partitions that units and groups are dealt to, at most
_DROP = -(2 ** 62)              # key of pairs that may not be returned (self pairs, below the minimum)
_ID_BITS = 48                   # dbindex < 2^48; order key = score_key << 48 - dbindex


def score_keys(score: np.ndarray) -> np.ndarray:
    """Scaled integer score, halves away from zero."""
    return np.where(score < 0, -1, 1) * np.floor(np.abs(score) * RANK_SCALE + 0.5).astype(np.int64)


def least_key(min_score: float) -> int:
    """The smallest ``score_key`` whose score (4 decimals) is at least ``min_score``."""
    return math.ceil(round(min_score * RANK_SCALE, 6))


def _unit32(v: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Vectors at unit length in single precision; one without a finite length, whose scores are all 0, becomes zero."""
    fine = np.isfinite(norm) & (norm > 0)
    return np.where(fine[:, None], np.divide(v, norm[:, None], out=np.zeros_like(v), where=fine[:, None]), 0).astype(np.float32)


def _true_at(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the true entries; few are, so eight at a time are looked at first."""
    flat = mask.reshape(-1)
    if flat.size % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64) != 0)
    at = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    return at[flat[at]]


class _Scorer:
    """Scores a fixed set of queries against a stream of targets.

    All pairs are scored in single precision, whose error has a bound; only pairs that may reach the minimum, and in
    top-k mode the ``k``-th best score that their query already has, are scored again in double precision, one by one, so
    a score does not depend on what else is scored with it. Top-k mode keeps the ``k`` best of each query; threshold mode
    hands out the pairs that reach ``min_score`` as they are found."""

    def __init__(self, qid, qvec, qlen, k, min_score, mincov, exclude_self, work=WORK_ELEMENTS):
        self.qid, self.qv, self.qlen = qid, qvec, qlen
        n = len(qid)
        with np.errstate(over="ignore", invalid="ignore"):
            self.qn = np.linalg.norm(qvec, axis=1)
        self.qu = _unit32(qvec, self.qn)
        self.error = (qvec.shape[1] + 16) * 2.0 ** -23  # of a cosine in single precision, at most
        self.k, self.mincov, self.exclude_self = k, mincov, exclude_self
        self.least = None if min_score is None else least_key(min_score)
        self.chunk = max(16, work // max(1, min(n, HELD_ROWS)) // 8 * 8)
        self.room = np.empty(min(n, HELD_ROWS) * self.chunk, bool)
        self.kth = np.full(n, _DROP, np.int64)  # order key of the k-th best
        self.limit = self._limit(np.full(n, _DROP if self.least is None else self.least, np.int64))
        self.found, self.many = [], 0           # (query's row, order key or score key, score, dbindex, t_len)
        self.full = max(PIECE_PAIRS, 3 * n * (k or 0) // 2)

    def _limit(self, key):
        """The least single-precision score that a pair with the score key ``key`` may have. A masked pair scores 0 whatever
        its cosine, so that a row that takes 0 takes all."""
        least = np.where(key <= _DROP, -np.inf, (key - 0.5) / RANK_SCALE - self.error)
        return (np.where(least > 0, least, -np.inf) if self.mincov is not None else least).astype(np.float32)

    def feed(self, tid, tvec, tlen, rows=None, only=None):
        """Score targets against all queries, or those at ``rows``; ``only(query rows, targets)`` says which pairs count. Yields
        Arrow batches of pairs (threshold mode only)."""
        with np.errstate(over="ignore", invalid="ignore"):
            tn = np.linalg.norm(tvec, axis=1)
        tu = _unit32(tvec, tn)
        qu = self.qu if rows is None else self.qu[rows]
        score, high = np.empty(len(self.room), np.float32), self.room
        for a in range(0, len(tid), self.chunk):
            part = tu[a:a + self.chunk].T
            for i in range(0, len(qu), HELD_ROWS):
                some = qu[i:i + HELD_ROWS]
                shape = (len(some), part.shape[1])
                s, mask = (x[:shape[0] * shape[1]].reshape(shape) for x in (score, high))
                limit = self.limit[i:i + HELD_ROWS] if rows is None else self.limit[rows[i:i + HELD_ROWS]]
                np.greater_equal(np.matmul(some, part, out=s), limit[:, None], out=mask)
                r, c = np.divmod(_true_at(mask), shape[1])
                r, c = r + i if rows is None else rows[r + i], c + a
                if only is not None:
                    r, c = (x[only(r, c)] for x in (r, c))
                for j in range(0, len(r), PIECE_PAIRS):
                    at = c[j:j + PIECE_PAIRS]
                    self._again(r[j:j + PIECE_PAIRS], tid[at], tvec[at], tn[at], tlen[at])
                    if self.many >= self.full:
                        if self.k is None:
                            yield from self.result().to_batches()
                        else:
                            self._cut()

    def _again(self, r, tid, tv, tn, tlen):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            s = np.einsum("ij,ij->i", self.qv[r], tv) / (self.qn[r] * tn)
        s = np.nan_to_num(s, nan=0.0)
        if self.mincov is not None:
            s = np.where(self.qlen[r] >= tlen * self.mincov, s, 0.0)
        key = score_keys(s)
        valid = (self.qid[r] != tid) if self.exclude_self else np.ones(len(r), dtype=bool)
        if self.least is not None:
            valid &= key >= self.least
        if self.k is not None:
            key = (key << _ID_BITS) - tid
            valid &= key > self.kth[r]
        self.found.append([x[valid] for x in (r, key, s, tid, tlen)])
        self.many += int(valid.sum())

    def _cut(self):
        """Leave the ``k`` best of each query and raise what a pair has to reach."""
        cols, self.found = list(zip(*self.found)), []
        for i in range(len(cols)):  # one by one: what was found is not held twice
            cols[i] = np.concatenate(cols[i])
        order = np.lexsort((-cols[1], cols[0]))
        r = cols[0][order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        cols = [x[order[place < self.k]] for x in cols]
        last = place[place < self.k] == self.k - 1
        row, key, tid = (cols[i][last] for i in (0, 1, 3))
        self.kth[row] = key
        best = np.full(len(self.kth), _DROP if self.least is None else self.least, np.int64)
        best[row] = (key + tid) >> _ID_BITS
        self.limit = self._limit(best)
        self.found, self.many = [cols], 0

    def result(self) -> pa.Table:
        """Top-k mode: the best rows of all that was fed. Threshold mode: the pairs found since the last call."""
        if self.k is not None and self.found:
            self._cut()
        cols = [np.concatenate(c) for c in zip(*self.found)] if self.found else [np.zeros(0, np.int64)] * 5
        self.found, self.many = [] if self.k is None else [cols], 0
        r, key, score, tid, tlen = cols
        if self.k is not None:
            key = (key + tid) >> _ID_BITS
        kinds = (np.int64, np.int64, np.float64, np.int64, np.int32, np.int32)
        return pa.Table.from_arrays([pa.array(x.astype(t)) for x, t in zip((self.qid[r], tid, score, key, self.qlen[r], tlen), kinds)], names=_NAMES)


def _arrow_vectors(col) -> np.ndarray:
    """A list<float> Arrow column, or one of 32-bit floats in binary, as a (rows, dim) float64 matrix without per-row Python objects."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, 0))
    if col.null_count:
        raise ValueError("target vectors may not be null")
    binary = pa.types.is_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + n + 1] // 4 if binary else col.offsets.to_numpy()
    dim = int(offs[1] - offs[0])
    if not np.all(np.diff(offs) == dim):
        raise ValueError("target vectors must all have the same length")
    values = np.frombuffer(col.buffers()[2] or b"", np.float32, int(offs[-1])) if binary else col.values.to_numpy(zero_copy_only=False)
    flat = values[offs[0]:offs[0] + n * dim]
    return flat.reshape(n, dim).astype(np.float64)


def _units(v: np.ndarray) -> np.ndarray:
    """Vectors at unit length; a zero vector stays zero."""
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, n, out=np.zeros_like(v), where=n > 0)


def choose_pivots(targets: DataFrame, n_targets: int, target_block_rows: int = TARGET_BLOCK_ROWS) -> np.ndarray:
    """Unit vectors far from each other, one for each ``target_block_rows`` targets (``MAX_PIVOTS`` at most).

    They are chosen from the ``SAMPLE_ROWS`` targets, at most, with the smallest hashes of ``dbindex``: each next pivot is
    the sampled vector farthest from those chosen. The choice affects how much is skipped, never a result."""
    many = min(MAX_PIVOTS, max(1, math.ceil(n_targets / max(1, target_block_rows))))
    if many == 1:
        return np.zeros((1, 0))
    order = F.pmod(F.xxhash64("dbindex"), F.lit(1 << 52))
    share = min(1.0, 2.0 * SAMPLE_ROWS / n_targets)  # cut by the hash first, so that the sort is over few rows
    few = targets.where(order < share * float(1 << 52)).select("embedding", order.alias("_o")).orderBy("_o").limit(SAMPLE_ROWS)
    sample = _units(np.array([r["embedding"] for r in few.select("embedding").collect()], np.float64))
    sample = sample[sample.any(axis=1)]
    if not len(sample):
        return np.zeros((1, 0))
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(many, len(sample)):
        nxt = int(np.argmin(nearest))
        chosen.append(nxt)
        nearest = np.maximum(nearest, sample @ sample[nxt])
    return sample[chosen]


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``pivot int, near double`` (the nearest pivot and the cosine to it) beside ``id, vec, len``.

    A zero vector scores 0 with everything, which no bound excludes, so it does not widen its pivot (``near`` 1)."""
    if len(pivots) == 1:
        # not a literal: a join on it stays an equi-join
        return rows.withColumn("pivot", F.pmod("id", F.lit(1)).cast("int")).withColumn("near", F.lit(-1.0))
    schema = to_arrow_schema(T.StructType([*rows.schema.fields, *T.StructType.fromDDL("pivot int, near double").fields]))

    def run(batches):
        for b in batches:
            v = _units(_arrow_vectors(b.column(b.schema.get_field_index("vec")))) if b.num_rows else np.zeros((0, pivots.shape[1]))
            cos = v @ pivots.T
            at = cos.argmax(axis=1)
            near = np.where(v.any(axis=1), cos[np.arange(len(at)), at], 1.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array(near)], schema=schema)

    out = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("pivot int, near double").fields])
    return written(rows.mapInArrow(run, out), "with-pivots")


def pivot_sizes(rows: DataFrame, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, radius) of each pivot: the angle of the farthest member."""
    n, near = np.zeros(many, np.int64), np.ones(many)
    for r in rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("near")).collect():  # a row a pivot
        n[r["pivot"]], near[r["pivot"]] = r["n"], r["near"]
    return n, np.arccos(np.clip(near, -1, 1))


def pair_bounds(pivots: np.ndarray, q_radius: np.ndarray, t_radius: np.ndarray) -> np.ndarray:
    """Largest score that a query of one pivot (row) and a target of another (column) can have.

    At least 0: a masked pair and a zero vector score 0."""
    if len(pivots) == 1:
        return np.ones((1, 1))
    apart = np.arccos(np.clip(pivots @ pivots.T, -1, 1)) - q_radius[:, None] - t_radius[None, :]
    return np.maximum(np.cos(np.clip(apart, 0, np.pi)), 0) + SLACK


class BlockSearch:
    """Queries and targets dealt to pivots, and the pairs of pivots that have been joined so far.

    ``skipped`` counts, after a search, the (query, target) pairs that were never scored; ``pairs`` counts all."""

    def __init__(self, queries: DataFrame, targets: DataFrame, query_block_rows: int = QUERY_BLOCK_ROWS,
                 target_block_rows: int = TARGET_BLOCK_ROWS, work_elements: int = WORK_ELEMENTS):
        ensure_checkpoint_dir(queries.sparkSession)
        t = targets.select(F.col("dbindex").cast("long").alias("id"), F.col("embedding").alias("vec"), F.col("length").cast("long").alias("len"))
        q = queries.select(F.col("qid").cast("long").alias("id"), F.col("q_embedding").alias("vec"), F.col("q_len").cast("long").alias("len"))
        self.work = work_elements
        self.pivots = choose_pivots(targets.select("dbindex", "embedding"), targets.select("dbindex").count(), target_block_rows)
        many = len(self.pivots)
        self.q, self.t = with_pivots(q, self.pivots), with_pivots(t, self.pivots)
        self.nq, q_radius = pivot_sizes(self.q, many)
        self.nt, t_radius = pivot_sizes(self.t, many)
        self.bound = pair_bounds(self.pivots, q_radius, t_radius)
        self.blocks = -(-self.nq // max(1, query_block_rows))  # blocks of queries of each pivot
        self.first = np.concatenate(([0], np.cumsum(self.nq)))[:-1]  # queries of the pivots before
        nq, nt, blocks = int(self.nq.sum()), int(self.nt.sum()), int(self.blocks.sum())
        self.pairs, self.skipped = nq * nt, 0
        spark = queries.sparkSession
        self.tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        # consecutive blocks go to a task as one unit, which is sent a target once
        units = min(max(1, blocks), max(-(-nq // UNIT_ROWS), min(self.tasks, SENT_ROWS // max(1, nt))))
        self.unit_rows = max(1, -(-nq // max(1, units)))
        self.units = max(1, -(-nq // self.unit_rows))
        wanted = min(-(-SPLIT_TASKS * spark.sparkContext.defaultParallelism // self.units), -(-self.pairs // (self.units * SPLIT_PAIRS)))
        self.groups = max(1, wanted, -(-nt // TASK_TARGETS))

    def _unit(self, pivot: int, block: int) -> int:
        """The unit of a block (from 0) of a pivot's queries: by how many queries lie before it, about."""
        n = max(1, int(self.blocks[pivot]))
        return (int(self.first[pivot]) * n + block * int(self.nq[pivot])) // (n * self.unit_rows)

    def _units_seen(self, wanted: np.ndarray) -> list[tuple[int, int, int]]:
        """(target pivot, first unit, last unit): the units that a pivot's targets are sent to, each unit once."""
        rows = []
        for t in np.flatnonzero(self.nt):
            last = -1
            for q in np.flatnonzero(wanted[:, t] & (self.blocks > 0)):  # units rise with the pivots
                a, b = max(last + 1, self._unit(q, 0)), self._unit(q, int(self.blocks[q]) - 1)
                if a <= b:
                    if rows and rows[-1][0] == t and rows[-1][2] == a - 1:
                        a = rows.pop()[1]
                    rows.append((int(t), a, b))
                    last = b
        return rows

    def score(self, wanted: np.ndarray, k: int | None, min_score: float | None, mincov: float | None, exclude_self: bool) -> DataFrame:
        """The rows that the wanted pairs of pivots (query pivot x target pivot) send on."""
        spark = self.q.sparkSession
        # a row for each target pivot and run of units: at most MAX_PIVOTS squared, whatever the tables' size
        seen = spark.createDataFrame(self._units_seen(wanted), "pivot int, first long, last long")
        own = spark.createDataFrame([(p, int(self.first[p]), int(self.blocks[p]), int(self.nq[p])) for p in np.flatnonzero(self.blocks).tolist()],
                                    "pivot int, first long, blocks long, many long")
        group = F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1)))
        unit = F.expr(f"(first * blocks + pmod(xxhash64(id), blocks) * many) div (blocks * {self.unit_rows})")
        q = self.q.join(F.broadcast(own), "pivot").select("id", "vec", "len", "pivot", unit.alias("unit"), F.lit(0).alias("side"), group.alias("grp"))
        t = self.t.join(F.broadcast(seen), "pivot").select("id", "vec", "len", "pivot", F.explode(F.sequence("first", "last")).alias("unit"), F.lit(1).alias("side"),
                                                           F.pmod(F.xxhash64("id"), F.lit(self.groups)).cast("int").alias("grp"))
        # a partition for each (unit, group): hashes of so few keys would put several in one
        slot = F.col("unit") * F.lit(self.groups) + F.col("grp")
        parts = min(self.units * self.groups, MAX_SLOTS)
        both = q.unionByName(t).repartitionById(parts, F.pmod(slot, F.lit(parts)).cast("int")).sortWithinPartitions("unit", "grp", "side")
        work, schema = self.work, to_arrow_schema(T.StructType.fromDDL(SCORE_SCHEMA))

        def run(batches):
            key, held, scorer, mine, of_row = None, [], None, None, None

            def ready():
                ids, vecs, lens, pivots = map(np.concatenate, zip(*held))
                return _Scorer(ids, vecs, lens, k, min_score, mincov, exclude_self, work), pivots

            for b in batches:
                col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
                marks = [col[n].to_numpy() for n in ("unit", "grp", "side")]
                cut = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1 if b.num_rows else np.zeros(0, int)
                for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
                    if lo == hi:
                        continue
                    part = [col["id"].to_numpy()[lo:hi].astype(np.int64), _arrow_vectors(col["vec"].slice(lo, hi - lo)), col["len"].to_numpy()[lo:hi].astype(np.int64)]
                    pivot = col["pivot"].to_numpy()[lo:hi]
                    if (marks[0][lo], marks[1][lo]) != key:
                        if scorer is not None:
                            yield from scorer.result().cast(schema).to_batches()
                        key, held, scorer = (marks[0][lo], marks[1][lo]), [], None
                    if marks[2][lo] == 0:
                        held.append([*part, pivot])
                    elif held:  # a unit of a few queries may have got none
                        if scorer is None:
                            scorer, qpivots = ready()
                            mine, of_row = np.unique(qpivots, return_inverse=True)
                        here, which = np.unique(pivot, return_inverse=True)
                        wants, alike = np.unique(wanted[np.ix_(mine, here)], axis=1, return_inverse=True)
                        alike = alike.reshape(-1)[which]
                        if wants.all():
                            feeds = [scorer.feed(*part)]
                        elif wants.mean() > 0.5:  # score all, then leave out what is not wanted
                            feeds = [scorer.feed(*part, only=lambda r, c: wants[of_row[r], alike[c]])]
                        else:  # targets of pivots that the same queries want are scored together
                            feeds = [scorer.feed(*[x[alike == i] for x in part], rows=np.flatnonzero(wants[of_row, i])) for i in range(wants.shape[1])]
                        for x in itertools.chain(*feeds):
                            yield from pa.Table.from_batches([x]).cast(schema).to_batches()
            if scorer is not None:
                yield from scorer.result().cast(schema).to_batches()

        return both.mapInArrow(run, SCORE_SCHEMA)

    def search(self, k: int | None = None, min_score: float | None = None, mincov: float | None = None, exclude_self: bool = False) -> DataFrame:
        """``k`` set: the best rows of each query, to be finished with ``topk``. Unset: all pairs that reach ``min_score``."""
        least = -np.inf if min_score is None else (least_key(min_score) - 0.5) / RANK_SCALE
        possible = (self.bound >= least) & (self.nq > 0)[:, None] & (self.nt > 0)[None, :]
        found = None
        if k is not None and len(self.pivots) > 1:
            # what queries get from their own pivot tells what others have to beat
            near = np.eye(len(self.pivots), dtype=bool) & possible
            found = written(topk(self.score(near, k, min_score, mincov, exclude_self), k), "own-pivot").drop("emb_rank")
            full = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score_key").alias("kth")).where(F.col("n") >= k)
            beat = np.full(len(self.pivots), -np.inf)
            for r in full.join(self.q.select(F.col("id").alias("qid"), "pivot"), "qid").groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("kth").alias("kth")).collect():
                if r["n"] == self.nq[r["pivot"]]:  # every query of the pivot has k rows
                    beat[r["pivot"]] = (r["kth"] - 0.5) / RANK_SCALE
            possible = possible & (self.bound >= beat[:, None]) & ~near
            scored = near | possible
        else:
            scored = possible
        self.skipped = self.pairs - int(self.nq @ scored @ self.nt)
        rest = self.score(possible, k, min_score, mincov, exclude_self)
        return rest if found is None else found.select(*_NAMES).unionByName(rest)


def score_blocks(queries: DataFrame, targets: DataFrame, k: int | None = None, min_score: float | None = None,
                 mincov: float | None = None, exclude_self: bool = False, **block_opts) -> DataFrame:
    """Score queries ``(qid, q_embedding, q_len)`` against targets ``(dbindex, embedding, length)``.

    ``k`` set: top-k per query, of the pairs that reach ``min_score`` if that is set; finish with ``topk``.
    ``k`` unset: all pairs whose rounded score is ``>= min_score`` (threshold join)."""
    if k is None and min_score is None:
        raise ValueError("score_blocks needs k or min_score: all pairs are never emitted")
    return BlockSearch(queries, targets, **block_opts).search(k, min_score, mincov, exclude_self)


def rank_key():
    return [F.col("score_key").desc(), F.col("dbindex").asc()]


def topk(scored: DataFrame, k: int) -> DataFrame:
    """Top-k per query with 0-based ``emb_rank``; ties by ``dbindex``. Returns all rows when fewer than k."""
    w = Window.partitionBy("qid").orderBy(*rank_key())
    # filter on row_number itself so the optimizer plans partial + final WindowGroupLimit
    ranked = scored.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return ranked.withColumn("emb_rank", (F.col("_rn") - 1).cast("long")).drop("_rn")


def vector_search(queries: DataFrame, targets: DataFrame, k: int, mincov: float | None = None,
                  exclude_self: bool = False, min_score: float | None = None, **block_opts) -> DataFrame:
    """Exact top-k cosine search; ``mincov`` applies the length mask before ranking (masked score = 0).

    ``min_score`` drops lower pairs in the kernel; they rank below all that stay, so ranks are those of
    ``filter_min_cosine`` after the search."""
    scored = score_blocks(queries, targets, k=k, min_score=min_score, mincov=mincov, exclude_self=exclude_self, **block_opts)
    return topk(scored, k)


def threshold_join(queries: DataFrame, targets: DataFrame, min_score: float, exclude_self: bool = False,
                   **block_opts) -> DataFrame:
    """All (query, target) pairs with rounded cosine ``>= min_score``."""
    return score_blocks(queries, targets, min_score=min_score, exclude_self=exclude_self, **block_opts)


def filter_min_cosine(hits: DataFrame, mincos: float) -> DataFrame:
    return hits.where(F.col("score_key") >= least_key(mincos))


def rank_kept(hits: DataFrame) -> DataFrame:
    """Batch-path rank: dense 0-based position among the hits that were kept."""
    w = Window.partitionBy("qid").orderBy(*rank_key())
    return hits.withColumn("kept_rank", (F.row_number().over(w) - 1).cast("long"))


def join_metadata(hits: DataFrame, targets: DataFrame) -> DataFrame:
    """Metadata of each hit's target; ``'{ }'`` when the target has none."""
    md = targets.select("dbindex", F.coalesce(F.col("metadata"), F.lit(EMPTY_METADATA)).alias("metadata"))
    return hits.join(md, "dbindex", "left").withColumn("metadata", F.coalesce("metadata", F.lit(EMPTY_METADATA)))


def join_payload(hits: DataFrame, payload: DataFrame) -> DataFrame:
    """Fetch name/sequence/length/coordinates for hit targets only (after top-k, so columns stay pruned); a hit whose
    target has no payload keeps nulls."""
    return hits.join(payload, "dbindex", "left")


def aligned_coverage(hits: DataFrame, mincov: float) -> DataFrame:
    """After alignment: keep hits whose aligned length covers ``mincov`` of the target."""
    return hits.where(F.col("len_ali") >= F.col("t_len") * mincov)


def split_significant(hits: DataFrame, mintm: float) -> DataFrame:
    """Flag significant hits (``max(qtm, ttm) >= mintm``); write the two sides with two filters."""
    return hits.withColumn("max_tm", F.greatest("qtm", "ttm")).withColumn("significant", F.col("max_tm") >= mintm)


def number_insignificant(flagged: DataFrame) -> DataFrame:
    """The batch path numbers insignificant hits with one counter over all queries (0-based, in
    query then rank order); significant hits get null. Numbered with range partitioning and
    per-partition offsets, not a one-task window."""
    from .indexing import dense_index

    ins = dense_index(flagged.where(~F.col("significant")), ["qid", "emb_rank"], out="_n")
    ins = ins.select("qid", "dbindex", (F.col("_n") - 1).alias("insig_no"))
    return flagged.join(ins, ["qid", "dbindex"], "left")
