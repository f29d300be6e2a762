"""Toxicity by cumulative-link ordinal regression on sparse word features.

Severity has ``GRADES`` ordered grades above 0. A labelled document that is not toxic has grade 0; toxic ones are graded
by how many of their words speak for toxicity in the labelled sample (terciles), so the binary labels become an ordered
target. The model has one weight for each word of the sample's vocabulary, shared by all thresholds: P(grade >= k) =
sigmoid(w.x - t_k) with t_1 <= t_2 <= ...; x says which words a document holds, whatever its length. An L1 penalty keeps
few words. Scoring a document needs its words that have a weight and nothing else; all documents are scored where they
lie. The result is the expected severity (sum of P(grade >= k)) and the decision P(grade >= 1) >= ``CUT``.

Fitted on at most ``SAMPLE`` labelled rows (the smallest hashes of the ids; one row for each of their texts, and at most
``SAMPLE`` of these, the smallest digests), on the driver; this bound is the only one.

Defined results: null or wordless text scores the model's intercept; null labels are not used; a document labelled more
than once takes its largest label; with no toxic or no clean label the severity is 0 for all; repeated rows are scored
each; an empty table gives an empty table; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_texts, map_batches, ready, written

#: Bound on the labelled rows that the model is fitted on.
SAMPLE = 8000
GRADES = 3
CUT = 0.3
#: A word is a feature if so many documents of the sample hold it.
LEAST_DOCS = 6
#: Punctuation, signs and digits end a word; A-Z is lower-cased; bytes over 127 are letters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def labelled_words(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, list[bytes]]]:
    """(toxic, distinct words) of the distinct texts of at most ``sample`` labelled documents, in the order of the texts'
    digests; at most ``sample`` rows, the least digests, however many rows or texts the sampled ids have."""
    return [(int(t > 0), w.split()) for t, w in _sample_rows(docs, labels, sample, id_col, text_col).toPandas().itertuples(index=False)]


def _sample_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str) -> DataFrame:
    lab = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("of_id")).agg(F.max("toxic").alias("toxic"))
    lab = written(lab.withColumn("h", F.xxhash64("of_id")).orderBy("h", "of_id").limit(sample), "label-sample")
    d = binary_texts(docs, id_col, text_col).join(F.broadcast(lab), F.col("doc_id") == F.col("of_id"))

    # copies count once, with their largest label: else the words of an often copied document speak too loud
    def run(cols):
        found: dict[bytes, int] = {}
        for toxic, t in zip(cols["toxic"], cols["text"]):
            found[t] = max(toxic, found.get(t, toxic))
        return {"copy": [hashlib.sha256(t).digest() for t in found], "toxic": list(found.values()), "words": [b" ".join(sorted(set(words(t)))) for t in found]}

    rows = map_batches(d.select("toxic", "text"), run, "copy binary, toxic int, words binary")
    one = rows.groupBy("copy").agg(F.max("toxic").alias("toxic"), F.first("words").alias("words"))
    return one.orderBy("copy").limit(sample).select("toxic", "words")


def grade(rows: list[tuple[int, list[bytes]]], grades: int = GRADES) -> np.ndarray:
    """0 for clean rows; toxic rows by how many of their words are far more frequent in toxic rows."""
    bad, good = Counter(), Counter()
    for toxic, ws in rows:
        (bad if toxic else good).update(ws)
    n_bad = max(1, sum(t for t, _ in rows))
    n_good = max(1, len(rows) - n_bad)
    speaks = {w for w, c in bad.items() if c >= LEAST_DOCS and c / n_bad > 20 * (good[w] + 0.5) / n_good}
    hits = np.array([sum(w in speaks for w in ws) if t else 0 for t, ws in rows])
    some = np.sort(hits[hits > 0])
    cuts = [some[len(some) * k // grades] for k in range(1, grades)] if len(some) else []
    toxic = np.array([t for t, _ in rows], bool)
    return np.where(toxic, 1 + sum((hits > c).astype(int) for c in cuts), 0)


def fit(rows: list[tuple[int, list[bytes]]], grades: int = GRADES, l1: float = 2e-4, steps: int = 500) -> tuple[dict[bytes, float], list[float]]:
    """Weights by word (non-zero ones) and the thresholds; proximal gradient with momentum on the mean log loss."""
    y = grade(rows, grades)
    if not len(y) or not y.any() or y.all():
        return {}, []
    docs_of = Counter(w for _, ws in rows for w in ws)
    at = {w: i for i, w in enumerate(sorted(w for w, c in docs_of.items() if c >= LEAST_DOCS))}
    cols = [[at[w] for w in ws if w in at] for _, ws in rows]
    row_of = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    col_of = np.array([c for cs in cols for c in cs], np.int64)
    n, dims = len(rows), len(at)
    reached = np.stack([y >= k for k in range(1, grades + 1)])  # the cumulative targets
    base = np.clip(reached.mean(axis=1), 1 / (2 * n), 1 - 1 / (2 * n))
    t = -np.log(base / (1 - base))
    w = np.zeros(dims)
    # a word's step follows the share of rows that hold it; a step that makes the objective worse halves all steps
    share = np.bincount(col_of, minlength=dims) / n
    rate = 1.0 / (0.25 * grades * np.maximum(share, 1 / n) * 8)

    def at_point(w_, t_):
        z = np.bincount(row_of, w_[col_of], minlength=n)
        m = np.clip(z[None, :] - t_[:, None], -500, 500)
        loss = (np.logaddexp(0, m) - reached * m).sum(axis=0).mean() + l1 * np.abs(w_).sum()
        return loss, 1 / (1 + np.exp(-m)) - reached

    v, s, since, best = w.copy(), t.copy(), 0, np.inf
    for _ in range(steps):
        _, err = at_point(v, s)
        g = np.bincount(col_of, err.sum(axis=0)[row_of], minlength=dims) / n
        new_w = v - rate * g
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * l1, 0)
        new_t = np.maximum.accumulate(s + 0.5 * err.mean(axis=1))
        loss, _ = at_point(new_w, new_t)
        if loss > best + 1e-12:
            if not since:  # a plain step, too long
                rate = rate / 2
            v, s, since = w.copy(), t.copy(), 0  # again from the last good point, without momentum
            continue
        m = since / (since + 3)
        v, s = new_w + m * (new_w - w), np.maximum.accumulate(new_t + m * (new_t - t))
        w, t, best, since = new_w, new_t, loss, since + 1
    words_ = sorted(at)
    return {words_[i]: float(w[i]) for i in np.flatnonzero(w)}, t.tolist()


def score(docs: DataFrame, model: tuple[dict[bytes, float], list[float]], id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT, keep: list[str] | None = None) -> DataFrame:
    """One row for each input row: the kept columns (``k0``, ``k1``, ...), ``doc_id, severity, p_toxic, toxic``."""
    weights, thresholds = model
    known = frozenset(weights)
    keep = keep or []

    def run(cols):
        # in the order of the words: the same sum wherever a document is scored
        z = np.array([sum(weights[w] for w in sorted(known.intersection(words(t)))) for t in cols["_text"]], float)
        p = 1 / (1 + np.exp(-np.clip(z[None, :] - np.array(thresholds)[:, None], -500, 500))) if thresholds else np.zeros((1, len(z)))
        return {"doc_id": cols["_id"], "severity": p.sum(axis=0), "p_toxic": p[0], "toxic": (p[0] >= cut).tolist()}

    d = ready(docs).select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.col(f"`{id_col}`").cast("long").alias("_id"),
                           F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    return map_batches(d, run, "doc_id long, severity double, p_toxic double, toxic boolean", [f"_k{i}" for i in range(len(keep))])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, fit(labelled_words(docs, labels, sample, id_col, text_col)), id_col, text_col)
