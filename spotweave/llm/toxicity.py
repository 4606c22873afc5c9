"""Toxicity by non-negative positive-unlabelled learning (op 1).

A linear numpy classifier over hashed word and word-prefix features, and over the prefixes that several
distinct words of a document share, is trained from confirmed toxic
documents and unlabelled text. The risk is pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) with the logistic loss,
pi the class prior; where the corrected negative part falls below zero its gradient is reversed, as the
non-negative estimator prescribes. Labels other than "toxic" never enter the risk; they only give pi.

Fitting is bounded by two documented parameters, max_positives and max_unlabelled (documents drawn by a
hash of their id, over the whole table); every text is scored whole.

Null and empty texts have no features and get the score of the bias alone; repeated rows are scored alike;
without a positive example every score is 0; an empty table gives an empty result; only the named
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.runtime import limit_batches, release_worker_memory

BITS = 20
WORD = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 100_000
SLICE = 256  # documents whose features are counted at once


def word_features(word: str) -> list[int]:
    """Hashed ids of a word and of its prefixes of 4 to 6 letters."""
    mask = (1 << BITS) - 1
    keys = ["=" + word] + [f"{k}{word[:k]}" for k in (4, 5, 6) if len(word) >= k]
    return [zlib.crc32(k.encode()) & mask for k in keys]


def again(feature: int) -> int:
    """Hashed id of the feature that several distinct words of a document have this feature."""
    return zlib.crc32(b"+%d" % feature) & ((1 << BITS) - 1)


class _Features(dict):
    def __missing__(self, word: str) -> list[int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = word_features(word)
        return found


def document_features(text: str | None, cache: dict | None = None) -> np.ndarray:
    """Sorted distinct feature ids of a text."""
    cache = _Features() if cache is None else cache
    once: set[int] = set()
    more: set[int] = set()
    for w in set(WORD.findall((text or "").lower())):
        own = cache[w]
        more.update(once.intersection(own))
        once.update(own)
    return np.array(sorted(once.union(map(again, more))), dtype=np.int32)


@dataclass
class ToxicityModel:
    """weights by hashed feature id; score(text) is the posterior of the toxic class."""

    weights: dict[int, float]
    bias: float
    prior: float

    def scorer(self):
        weights, bias = self.weights, self.bias

        class Hits(dict):
            def __missing__(self, word: str) -> tuple[int, ...]:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = found = tuple({f for f in word_features(word) if f in weights or again(f) in weights})
                return found

        hits = Hits()

        def score(text: str | None) -> float:
            once: set[int] = set()
            more: set[int] = set()
            for w in set(WORD.findall((text or "").lower())):
                if found := hits[w]:
                    more.update(once.intersection(found))
                    once.update(found)
            z = bias + sum(weights.get(f, 0.0) for f in sorted(once.union(map(again, more))))
            return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0

        return score


def _risk_gradient(z_p: np.ndarray, z_u: np.ndarray, prior: float, floor: float) -> tuple[np.ndarray, np.ndarray, float]:
    """dR/dz for positives and unlabelled under the non-negative estimator, and the risk."""
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    loss = lambda z: np.logaddexp(0, -z)
    n_p, n_u = max(1, len(z_p)), max(1, len(z_u))
    positive = prior * loss(z_p).sum() / n_p
    negative = loss(-z_u).sum() / n_u - prior * loss(-z_p).sum() / n_p
    g_pos_p = -prior * (1 - sig(z_p)) / n_p
    g_neg_p, g_neg_u = -prior * sig(z_p) / n_p, sig(z_u) / n_u
    if negative < -floor:
        return -g_neg_p, -g_neg_u, positive
    return g_pos_p + g_neg_p, g_neg_u, positive + max(0.0, negative)


def distinct_documents(docs: list[np.ndarray], bands: int = 4, rows: int = 3, least: float = 0.8) -> list[np.ndarray]:
    """docs without near copies of earlier ones, which are no evidence of their own: a shared band of minimum
    hashes makes a pair, a Jaccard of the features of at least `least` makes a copy."""
    odd = np.array([2 * i + 1 for i in range(1, bands * rows + 1)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen: dict[tuple, list[int]] = {}
    out: list[np.ndarray] = []

    def copies(d: np.ndarray, e: np.ndarray) -> bool:
        if min(len(d), len(e)) < least * max(len(d), len(e)):
            return False
        both = len(np.intersect1d(d, e, assume_unique=True))
        return both >= least * (len(d) + len(e) - both)

    for d in docs:
        if not len(d):
            continue
        h = (d.astype(np.uint64)[:, None] + np.uint64(1)) * odd[None, :]
        lowest = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0)
        own = [(b, *lowest[b * rows : (b + 1) * rows].tolist()) for b in range(bands)]
        if any(copies(d, out[k]) for k in sorted({k for band in own for k in seen.get(band, ())})):
            continue
        for band in own:
            seen.setdefault(band, []).append(len(out))
        out.append(d)
    return out


def fit_nnpu(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, max_features: int = 4096, steps: int = 300, rate: float = 0.05, decay: float = 1e-4, min_share: float = 0.02, floor: float = 0.0) -> ToxicityModel:
    """Full-batch Adam on the non-negative risk over the features that tell positives from unlabelled best."""
    if not positives:
        return ToxicityModel({}, -np.inf, prior)
    size = 1 << BITS
    rate_of = lambda docs: sum((np.bincount(np.concatenate(docs[k : k + SLICE]), minlength=size) for k in range(0, len(docs), SLICE)), np.zeros(size, np.int64))
    n_p, n_u = len(positives), max(1, len(unlabelled))
    c_p, c_u = rate_of(positives), rate_of(unlabelled)
    chance = np.maximum((c_p + c_u) / (n_p + n_u) * n_p, 1e-9)  # positives that would have a feature without a link
    evidence = 2 * (c_p * np.log(np.maximum(c_p, 1e-9) / chance) - (c_p - chance))
    evidence[c_p < max(3, min_share * n_p)] = 0  # too rare; what points to neither class for sure is left for the risk to weigh
    tested = max(2, np.count_nonzero(c_p >= 3))
    kept = np.sort(np.argsort(-evidence, kind="stable")[:max_features])
    kept = kept[evidence[kept] > 2 * np.log(tested) + 2]  # beyond the largest of as many chance values
    place = np.full(size, -1, np.int64)
    place[kept] = np.arange(len(kept))

    def packed(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        cols = [c[c >= 0] for c in (place[d] for d in docs)]  # of all features only those kept are held
        return np.repeat(np.arange(len(docs)), [len(c) for c in cols]), np.concatenate([np.zeros(0, np.int64), *cols]), len(docs)

    (rp, cp, n1), (ru, cu, n2) = packed(positives), packed(unlabelled)
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z_p, z_u = b + np.bincount(rp, w[cp], n1), b + np.bincount(ru, w[cu], n2)
        g_p, g_u, _ = _risk_gradient(z_p, z_u, prior, floor)
        g = np.bincount(cp, g_p[rp], len(w)) + np.bincount(cu, g_u[ru], len(w)) + decay * w
        gb = g_p.sum() + g_u.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return ToxicityModel({int(k): float(x) for k, x in zip(kept, w, strict=True) if abs(x) > 1e-6}, b, prior)


def fold(doc_id: Column, parts: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(-1))


def fit(docs: DataFrame, labels: DataFrame, *, max_positives: int = 2000, max_unlabelled: int = 8000, prior: float | None = None, folds: int = 5, held_fold: int = 0) -> ToxicityModel:
    """Train from the label rows outside the held-out fold and from a bounded draw of unlabelled text."""
    limit_batches(docs.sparkSession)
    train = labels.where(fold(F.col("doc_id"), folds) != held_fold).where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, n_pos = train.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_pos:
        return fit_nnpu([], [], 0.5)
    prior = min(0.95, max(0.005, n_pos / n)) if prior is None else prior
    n_docs = docs.count()
    draw = lambda *by: F.xxhash64(*by, F.lit("toxicity")).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    wanted = train.where("toxic = 1").where(draw("doc_id") < min(1.0, max_positives / n_pos)).select("doc_id", F.lit(1).alias("is_positive"))
    drawn = draw("doc_id", "text") < min(1.0, max_unlabelled / max(1, n_docs))

    @F.pandas_udf("binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _Features()
        for texts in batches:
            yield pd.Series([document_features(t, cache).tobytes() for t in texts], dtype=object)
        del cache
        release_worker_memory()

    rows = (
        docs.select("doc_id", "text", F.coalesce(drawn, F.lit(False)).alias("drawn"))
        .join(F.broadcast(wanted), "doc_id", "left")  # about max_positives ids at most, one row for each
        .where("drawn or is_positive = 1")
        .select(features("text").alias("f"), "drawn", (F.col("is_positive") == 1).alias("positive"), F.xxhash64("doc_id").alias("o"))
        .groupBy("f")  # rows that are alike in id and text are drawn together, and count once
        .agg(F.max("drawn").alias("drawn"), F.max("positive").alias("positive"), F.min("o").alias("o"))
        .collect()
    )
    rows.sort(key=lambda r: (r.o, bytes(r.f)))
    take = lambda key: [np.frombuffer(r.f, np.int32) for r in rows if r[key]]
    positives, unlabelled = distinct_documents(take("positive")), distinct_documents(take("drawn"))
    del rows
    model = fit_nnpu(positives, unlabelled, prior)
    del positives, unlabelled
    release_worker_memory()  # the driver's Python stays, too
    return model


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Posterior of the toxic class for a text column."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")
        del one
        release_worker_memory()

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = fit(docs, labels, **how)
    scored = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
