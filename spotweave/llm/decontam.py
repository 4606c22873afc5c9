"""Benchmark decontamination by training suffix arrays (op 5).

The training texts are cut into shards (runs of whole documents inside a task). For each shard a suffix array
over words is built, and every benchmark suffix is found in it by binary search on its first `window` words; suffixes
that start with a word no benchmark has are left out, as nothing can match them. A hit marks all words of the window.
Hits are then extended: the matched suffixes of shard and benchmark are ordered together by doubling their
matched length, and a suffix's neighbours of the other kind in that order give its longest verbatim match. So
the longest match of a document is one stretch of one item, with its place in both.

The benchmark is the stated query set: it is read in blocks of a bounded size, the index of each block is built once, on
the driver, and sent by itself; every block meets all rows, one at a time.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. An item of fewer words than the
window is one window; an item without words matches nothing. Null and empty texts have no words and no
hits. Repeated rows and repeated windows are reported alike for each. Empty tables give no
rows, or rows without hits. Null item ids are not reported but their words still hit. Extra columns are
not read by decontaminate() and pass through drop_contaminated(). Of several longest matches the first place in
the document counts, then the smallest item id as a string (null last), then the first place in the item.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.runtime import limit_batches, release_worker_memory, stage

_TABLE = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20 for c in range(256))
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, longest long, longest_at long, longest_item string, longest_item_at long"
NO_MATCH = (0, -1, None, -1)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


class Shard:
    """Word ids of some documents in a row, a zero after each, and their suffix array to a depth of `depth` words."""

    def __init__(self, ids: np.ndarray, depth: int, bits: int):
        self.ids, self.depth, self.bits = ids, depth, bits
        self.per = max(1, 62 // bits)  # words in one packed key
        padded = np.concatenate([ids, np.zeros(depth + self.per, ids.dtype)])
        start = np.flatnonzero(ids)
        self.levels: list[np.ndarray] = []
        rank = None
        for c in range(0, depth, self.per):
            take = min(self.per, depth - c)
            key = np.zeros(len(start), np.int64)
            for j in range(take):
                key = (key << bits) | padded[start + c + j]
            if rank is None:
                self.levels.append(key)
                rank = key
            else:
                u_rank, r = np.unique(rank, return_inverse=True)
                u_key, k = np.unique(key, return_inverse=True)
                self.levels.append((u_rank, u_key))
                rank = r.astype(np.int64) * (len(u_key) + 1) + k
        order = np.argsort(rank, kind="stable")
        self.suffixes, self.sorted = start[order], rank[order]

    def find(self, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges [lo, hi) of the suffix array that start with each row's first `length` words."""
        n = len(windows)
        lo = hi = np.zeros(n, np.int64)
        alive = np.ones(n, bool)
        rank = None
        for i, c in enumerate(range(0, self.depth, self.per)):
            take = min(self.per, self.depth - c)
            known = max(0, min(take, length - c))
            key = np.zeros(n, np.int64)
            for j in range(known):
                key = (key << self.bits) | windows[:, c + j]
            shift = self.bits * (take - known)
            low, high = key << shift, ((key + 1) << shift) - 1
            if i == 0:
                rank_lo, rank_hi = low, high
                if known == take:
                    rank = low
            else:
                u_rank, u_key = self.levels[i]
                if rank is not None:
                    r = np.searchsorted(u_rank, rank)
                    alive &= (r < len(u_rank)) & (u_rank[np.minimum(r, max(0, len(u_rank) - 1))] == rank) if len(u_rank) else False
                    k_lo, k_hi = np.searchsorted(u_key, low), np.searchsorted(u_key, high, "right") - 1
                    alive &= k_lo <= k_hi
                    base = r.astype(np.int64) * (len(u_key) + 1)
                    rank_lo, rank_hi = base + k_lo, base + k_hi
                    rank = rank_lo if known == take else None
                else:  # the prefix ended before this level: widen the range over everything below it
                    a, b = np.searchsorted(u_rank, rank_lo), np.searchsorted(u_rank, rank_hi, "right") - 1
                    alive &= a <= b
                    rank_lo, rank_hi = a.astype(np.int64) * (len(u_key) + 1), b.astype(np.int64) * (len(u_key) + 1) + len(u_key)
        lo, hi = np.searchsorted(self.sorted, rank_lo), np.searchsorted(self.sorted, rank_hi, "right")
        hi = np.where(alive, hi, lo)
        return lo, np.maximum(lo, hi)


class QueryBlock:
    """The windows of some benchmark items, without repeats, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        split = [(i, words(t)) for i, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for _, ws in split:
            for w in ws:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.bits = max(1, len(self.vocabulary).bit_length())
        found: dict[tuple[int, ...], set] = {}
        for item, ws in split:
            ids = tuple(self.vocabulary[w] for w in ws)
            if ids:
                for k in range(max(1, len(ids) - window + 1)):
                    owners = found.setdefault(ids[k : k + window], set())
                    if item is not None:
                        owners.add(item)
        self.by_length: dict[int, np.ndarray] = {}
        self.owners: dict[int, list[frozenset]] = {}
        number: dict[tuple[int, ...], int] = {}
        shared: dict[frozenset, frozenset] = {}
        for n in sorted({len(k) for k in found}):
            keys = sorted(k for k in found if len(k) == n)
            self.by_length[n] = np.array([k + (0,) * (window - n) for k in keys], np.int64)
            self.owners[n] = [shared.setdefault(f := frozenset(found[k]), f) for k in keys]
            if n == window:
                number = {k: i + 1 for i, k in enumerate(keys)}
        #: The benchmark as window numbers, a zero after each item, and for each window number in it the item and the place.
        row, self.where = [], []
        for item, ws in split:
            ids = tuple(self.vocabulary[w] for w in ws)
            for k in range(len(ids) - window + 1):
                row.append(number[ids[k : k + window]])
                self.where.append((item, k))
            row.append(0)
            self.where.append((None, -1))
        self.row = np.array(row, np.int64)

    def search(self, documents: list[list[bytes]]) -> tuple[list[np.ndarray], list[set], list[tuple]]:
        """For each document: hit flags of its words, the items whose windows occur, and the longest match."""
        get, sizes = self.vocabulary.get, [len(d) for d in documents]
        total = sum(sizes) + len(documents)
        ids = np.fromiter((x for d in documents for x in (*[get(w, 0) for w in d], 0)), np.int64, total)
        begin = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        items: list[set] = [set() for _ in documents]
        best = [NO_MATCH] * len(documents)
        change = np.zeros(total + self.window + 1, np.int64)
        number = np.zeros(total, np.int64)  # of the window that starts at a word
        if self.by_length:
            shard = Shard(ids, self.window, self.bits)
            for n, windows in self.by_length.items():
                lo, hi = shard.find(windows, n)
                for w in np.flatnonzero(hi > lo):
                    at = np.sort(shard.suffixes[lo[w] : hi[w]])
                    np.add.at(change, at, 1)
                    np.add.at(change, at + n, -1)
                    owners = self.owners[n][w]
                    docs, first = np.unique(np.searchsorted(begin, at, "right") - 1, return_index=True)
                    for d, p in zip(docs, at[first], strict=True):
                        items[d] |= owners
                        if n < self.window:
                            best[d] = better(best[d], (n, int(p - begin[d]), min(owners, default=None), 0))
                    if n == self.window:
                        number[at] = w + 1
        for d, match in self.extended(number, begin):
            best[d] = better(best[d], match)
        hit = np.cumsum(change)[:total] > 0
        return [hit[begin[i] : begin[i] + sizes[i]] for i in range(len(documents))], items, best

    def extended(self, number: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """(document, its longest match) from the numbers of the windows that start at each word."""
        at = np.flatnonzero(number)
        if not len(at):
            return
        query = np.flatnonzero(np.isin(self.row, np.unique(number[at])))
        place = np.concatenate([at, query + len(number) + 1])
        ends = np.append(np.flatnonzero(np.diff(place) != 1), len(place) - 1)
        left = ends[np.searchsorted(ends, np.arange(len(place)))] - np.arange(len(place)) + 1  # windows in a row from here on
        rank = np.concatenate([number[at], self.row[query]])
        levels, step = [rank], 1
        while step < left.max():
            later = np.where(left > step, rank[np.minimum(np.arange(len(place)) + step, len(place) - 1)], 0)
            rank = np.unique(rank * (rank.max() + 1) + later, return_inverse=True)[1] + 1
            levels.append(rank)
            step *= 2

        def in_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Windows that the suffixes a and b share from their start."""
            total, live = np.zeros(len(a), np.int64), np.ones(len(a), bool)
            for j in range(len(levels) - 1, -1, -1):
                same = live & (levels[j][a] == levels[j][b])
                gain = np.where(same, np.minimum(1 << j, left[a]), 0)
                live &= ~(same & (left[a] <= 1 << j))
                total += gain
                live &= (left[a] > gain) & (left[b] > gain)
                a, b = np.where(live, a + gain, a), np.where(live, b + gain, b)
            return total

        mine, theirs = np.arange(len(at)), np.arange(len(at), len(place))
        theirs = theirs[np.argsort(rank[theirs], kind="stable")]
        near = np.searchsorted(rank[theirs], rank[mine])
        shared = np.maximum(in_common(mine, theirs[np.minimum(near, len(theirs) - 1)]), in_common(mine, theirs[np.maximum(near - 1, 0)]))
        doc = np.searchsorted(begin, at, "right") - 1
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        best = np.array([a + int(np.argmax(shared[a:b])) for a, b in zip(first, np.append(first[1:], len(doc)), strict=True)])
        # the places that share as much are neighbours in the order of theirs: search both ends of the stretch
        as_much = lambda i: in_common(best, theirs[np.clip(i, 0, len(theirs) - 1)]) >= shared[best]
        lo, stop = np.zeros(len(best), np.int64), near[best].copy()
        while (open_ := lo < stop).any():
            mid = (lo + stop) >> 1
            good = as_much(mid)
            lo, stop = np.where(open_ & ~good, mid + 1, lo), np.where(open_ & good, mid, stop)
        hi, stop = near[best].copy(), np.full(len(best), len(theirs))
        while (open_ := hi < stop).any():
            mid = (hi + stop) >> 1
            good = as_much(mid)
            hi, stop = np.where(open_ & good, mid + 1, hi), np.where(open_ & ~good, mid, stop)
        named = [self.where[query[q - len(at)]] for q in theirs]
        order = sorted(range(len(named)), key=lambda j: (named[j][0] is None, named[j]))
        turn = np.empty(len(named), np.int64)
        turn[order] = np.arange(len(named))
        least = [turn]  # the first in turn of the 1, 2, 4 and so on from each place
        while 2 << (len(least) - 1) <= len(turn):
            half = 1 << (len(least) - 1)
            least.append(np.minimum(least[-1][: len(turn) - 2 * half + 1], least[-1][half : len(turn) - half + 1]))
        for p, a, b in zip(best.tolist(), lo.tolist(), hi.tolist(), strict=True):
            k = (b - a).bit_length() - 1
            item, where = named[order[min(least[k][a], least[k][b - (1 << k)])]]
            yield int(doc[p]), (int(shared[p]) + self.window - 1, int(at[p] - begin[doc[p]]), item, where)


def better(x: tuple, y: tuple) -> tuple:
    """The longer match, of equal ones the one that comes first."""
    return min(x, y, key=lambda m: (-m[0], m[1], m[2] is None, m[2] or "", m[3]))


def query_blocks(spark: SparkSession, benchmark: DataFrame, window: int, block_chars: int) -> list:
    """One broadcast, the compressed index, for each block of items; blocks are dealt by a hash and hold about block_chars characters."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_chars))
    if n > 1:
        rows = stage(rows, "benchmark")
    out = []
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        index = QueryBlock(sorted(((r.item, r.text) for r in part.collect()), key=repr), window)
        out.append(spark.sparkContext.broadcast(zlib.compress(pickle.dumps(index), 1)))
    return out


def contamination(spark: SparkSession, benchmark: DataFrame, text: Column, *, window: int = 10, shard_words: int = 250_000, block_chars: int = 20_000_000) -> Column:
    """struct of RESULT for a text column."""
    limit_batches(spark)
    blocks = query_blocks(spark, benchmark, window, block_chars)

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index: list = [None, None]  # number of the block that is unpacked, and the block: one at a time

        def unpacked(b: int) -> QueryBlock:
            if index[0] != b:
                index[:] = [None, None]
                index[:] = [b, pickle.loads(zlib.decompress(blocks[b].value))]
            return index[1]

        def shard(documents: list[list[bytes]]) -> list[tuple]:
            flags = [np.zeros(len(d), bool) for d in documents]
            items: list[set] = [set() for _ in documents]
            best = [NO_MATCH] * len(documents)
            for b in range(len(blocks)):
                hits, found, longest = unpacked(b).search(documents)
                for i, (h, f, m) in enumerate(zip(hits, found, longest, strict=True)):
                    flags[i] |= h
                    items[i] |= f
                    best[i] = better(best[i], m)
            return [(len(d), int(f.sum()), len(i), hashlib.sha256(",".join(sorted(i)).encode()).hexdigest(), *m) for d, f, i, m in zip(documents, flags, items, best, strict=True)]

        for texts in batches:
            out, held, size = [], [], 0
            for t in texts:
                held.append(words(t))
                size += len(held[-1])
                if size >= shard_words:
                    out += shard(held)
                    held, size = [], 0
            out += shard(held)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
        index[:] = [None, None]
        release_worker_memory()

    return scan(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the longest verbatim match with its place
    (in words) and its item and place there for every row of docs."""
    found = docs.select("doc_id", contamination(docs.sparkSession, benchmark, F.col("text"), **how).alias("c")).select("doc_id", "c.*")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_at", "longest_item", "longest_item_at")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs without a benchmark window, all their columns unchanged."""
    return docs.where(contamination(docs.sparkSession, benchmark, F.col("text"), **how)["n_hit"] == 0)
