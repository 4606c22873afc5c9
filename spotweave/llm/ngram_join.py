r"""N-gram Jaccard join by token-combination prefixes (op 8).

A document's set is its distinct five-word shingles (as 64-bit hashes); two documents link when
100 * |intersection| >= 80 * |union|. Documents with the same set are one class, and classes are joined:

1. `profile`: one pass gives each document's class id, size and bitmap, and counts shingles by lossy counting in
   chunks, so that every shingle in at least 1 / 1000 of all documents is known as hot.
2. `postings`: one global order of tokens, those with the rarest words first and hot ones last. A set of n shingles
   that must share r = ceil(0.8 n) has the extended prefix of n - r + k shingles, k = min(8, r); two linked sets share
   at least k tokens there. Every prefix token is indexed by itself at first.
3. `stars`: each list has a hub, each set is paired with the hub that it meets in most lists (one pair for a set
   at most), pairs are verified exactly, and linked sets become one component. From then on a list counts components, not
   sets, so a group of near copies is few entries of its lists.
4. `settled`: a list of at most `bound` components holds a rare token: its pairs of components are counted, and
   those that share half of k rare tokens or more are kept. A list of more components holds a frequent token. Sets
   that could share the other half of k in frequent tokens alone are indexed again by combinations of two of them, and
   pairs come from the lists of at most `bound` components. So the pairs of a list are bounded by a constant.
   Kept pairs of components are tested member by member, first by bitmaps, then exactly.
5. `families`: what meets in longer lists of combinations, or has too many frequent tokens for these, is
   gathered in families. Their sets are first tested against a few hubs, which makes most of a group of near copies of any size
   one component, then by bitmaps in pairs of blocks, where only what the bitmaps allow becomes a row. So no link between
   components is lost.

Words are hashed by their length and eight bytes at a time, and the sets of some megabytes of text are made as one array (`Sets`).
Lists of hot tokens are split by salt, classes keep copies out of the join, and nothing of the size of the
corpus reaches the driver; the hot shingles are at most 2000 times the mean set size.

Null and empty texts have no set and link with nothing; fewer than five words are one shingle; rows that
repeat a doc_id are one document with each row's own class; null ids form components only with themselves
or, through their set, take the smallest non-null id. Empty tables give no rows; only doc_id and text are read.
Class and shingle ids are 64-bit hashes: a false merge has a chance of about pairs / 2**64.
Jobs run as soon as a function of this module is called: rounds need the links of the ones before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.columns import indices
from spotweave.llm.medians import ranges
from spotweave.llm.substrings import Texts, slices
from spotweave.operators.components import connected_components
from spotweave.runtime import arrow_rows, broadcast_if_small, forget_shuffles, limit_batches, release_worker_memory, stage

N = 5
CHUNK_DOCS, CHUNK_TOKENS, LEAST_LOCAL = 4096, 1_000_000, 3
WORD_SHARE = 50_000  # words of a share of 1 / WORD_SHARE of a chunk or more are common: at most as many in a chunk
MAX_COMBINED = 16  # frequent tokens of a prefix up to which they are indexed by combinations of two
HUBS = 8  # of a family, in each turn
BLOCK, BLOCK_BYTES = 4096, 4 << 20  # sets of a block of a family, and bytes of their bitmaps
WAVE = 1 << 30  # bytes of copies of bitmaps that are made at once
SHARED = 8  # prefix tokens that two linked sets share, or all that the smaller overlap allows
LONG = 64  # bytes of a word
SLOTS = 1 << 20  # of tables by the low bits of a hash
LATE = 1 << 20  # in the order of tokens, where hot ones start; sums of five words' weights are below 320
_SLOT = np.uint64(SLOTS - 1)
_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash (uint64) of each word of the bytes, of its length and eight bytes at a time; longer words than LONG are left to xxhash."""
    size = ends - starts
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))  # from any byte on
    out = mixed(size.astype(np.uint64))
    left = np.flatnonzero(size <= LONG)
    for k in range(0, LONG, 8):
        left = left[size[left] > k]
        if not len(left):
            break
        out[left] = mixed(out[left] ^ (eight[starts[left] + k] & _BYTES[np.minimum(size[left] - k, 8)]))
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def word_weights(words: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The logarithms of the counts of common words by the low bits of their hashes, 0 elsewhere. Few other words share these bits: these
    are weighted alike everywhere, so that the order of shingles stays one."""
    weights = np.zeros(SLOTS, np.uint8)
    np.maximum.at(weights, (words & _SLOT).astype(np.int64), np.array([int(c).bit_length() for c in count], np.uint8))
    return weights


class Sets:
    """The shingle sets of some texts, worked as one array: text i has the sorted distinct hashes (uint64) tokens[at[i]:at[i + 1]], and
    the hashes words[first[i]:first[i + 1]] of its words in order. With weights of words, place is the sum of its words' for each token."""

    def __init__(self, texts: pa.Array, weights: np.ndarray | None = None):
        found = Texts(texts)
        self.first = found.first
        self.words = w = word_hashes(np.frombuffer(found.bytes.tobytes().lower(), np.uint8), found.starts, found.ends)
        begin, count = self.first[:-1], np.diff(self.first)
        rolled = w * _ODD[0]
        for i in range(1, N):
            rolled[:-i] += w[i:] * _ODD[i]
        for c in range(1, N):  # texts of fewer words are one shingle
            short = begin[count == c]
            rolled[short] = sum(w[short + i] * _ODD[i] for i in range(c)) + np.uint64(c)
        size = np.where(count < N, np.minimum(count, 1), count - N + 1)
        which, at = ranges(begin, size), np.concatenate([[0], np.cumsum(size)])
        h = mixed(rolled[which])
        if weights is not None:
            total = np.concatenate([[0], np.cumsum(weights[w & _SLOT], dtype=np.int64)])
            place = total[np.minimum(which + N, len(w))] - total[which]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if weights is None:
                h[a:b].sort()
            else:  # equal shingles have the same place
                order = h[a:b].argsort()
                h[a:b], place[a:b] = h[a:b][order], place[a:b][order]
        new = np.append(True, h[1:] != h[:-1])[: len(h)]
        new[at[:-1][size > 0]] = True
        self.tokens, self.place = h[new], None if weights is None else place[new]
        self.at = np.concatenate([[0], np.cumsum(new)])[at]

    def ids(self) -> list[int | None]:
        """The class of each text; None without words."""
        return [class_id(self.tokens[a:b]) if b > a else None for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True)]

    def bitmaps(self) -> pa.Array:
        """Four bits or more for each shingle of a text, a power of two in all; the low bits of a shingle are its place."""
        n = np.diff(self.at)
        bits = np.array([max(64, 1 << (4 * k - 1).bit_length()) if k else 0 for k in n.tolist()], np.int64)
        end = np.cumsum(bits)
        flags = np.zeros(bits.sum(), np.uint8)
        flags[np.repeat(end - bits, n) + (self.tokens & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)] = 1
        return binaries(np.packbits(flags, bitorder="little"), np.concatenate([[0], end]) // 8)


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def class_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def may_link(x: bytes, y: bytes, n: int, m: int) -> bool:
    """False only if the sets cannot link: each bit that differs needs a shingle that one set alone has."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    shared = (n + m - int(np.bitwise_count(a ^ b).sum())) // 2
    return 100 * shared >= 80 * (n + m - shared)


def required(n: int, percent: int = 80) -> int:
    return -(-n * percent // 100)


def profile(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, sig, n, bits) and, with token set, local counts of repeated shingles (n = 0) and of
    common words (n = 1)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, spoken, seen, size = [], [], set(), 0
        names = ["doc_id", "sig", "n", "bits", "token", "cnt"]

        def counted() -> pa.RecordBatch:
            parts = []
            for kind, held in ((0, sets), (1, spoken)):
                token, count = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
                keep = count >= (max(LEAST_LOCAL, size // WORD_SHARE) if kind else LEAST_LOCAL)
                parts.append((np.full(keep.sum(), kind), token[keep].view(np.int64), count[keep].astype(np.int64)))
            n, token, count = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
            none = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, n, pa.nulls(len(n), pa.binary()), token, count], names=names)

        for batch in batches:
            for rows in slices(batch):
                got = Sets(rows.column("text"))
                sigs, held = got.ids(), np.diff(got.at)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sigs, pa.int64()), pa.array(held), pc.if_else(pa.array(held > 0), got.bitmaps(), pa.scalar(None, pa.binary())), none, none], names=names)
                for i, sig in enumerate(sigs):
                    if sig is not None and sig not in seen:
                        seen.add(sig)
                        sets.append(got.tokens[got.at[i] : got.at[i + 1]].copy())  # a part would hold the whole
                        spoken.append(got.words[got.first[i] : got.first[i + 1]].copy())
                        size += len(sets[-1])
                    if len(sets) >= CHUNK_DOCS or size >= CHUNK_TOKENS:
                        yield counted()
                        sets, spoken, seen, size = [], [], set(), 0
        yield counted()
        del sets, spoken, seen
        release_worker_memory()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, sig long, n long, bits binary, token long, cnt long")


def ranked(hot: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hot shingles (sorted), their ranks by counts, and which low bits of a shingle any of them has."""
    rank = np.empty(len(hot), np.int64)
    rank[np.lexsort((hot, weight))] = np.arange(len(hot))
    low = np.zeros(SLOTS, bool)
    low[hot & _SLOT] = True
    return hot, rank, low


def ordered(tokens: np.ndarray, hot: tuple[np.ndarray, np.ndarray, np.ndarray], place: np.ndarray) -> np.ndarray:
    """The place of each token in the global order, where equal ones are ordered by hash: place, and from LATE on the ranks of the hot ones."""
    known, rank, low = hot
    maybe = np.flatnonzero(low[tokens & _SLOT])
    at = np.searchsorted(known, tokens[maybe])
    maybe, at = (x[at < len(known)] for x in (maybe, at))
    real = known[at] == tokens[maybe]
    out = place.astype(np.int64)
    out[maybe[real]] = LATE + rank[at[real]]
    return out


def prefixes(tokens: np.ndarray, begin: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The extended prefixes of the sets tokens[begin:begin + size], which are sorted, and in an order as of `ordered`: their tokens,
    which of them are hot, and the length of each prefix."""
    need = required(size)
    length = np.where(size < 4, 0, size - need + np.minimum(SHARED, need))  # a smaller set links with its equals only
    by = order << 32 | np.arange(len(tokens))
    for a, n in zip(begin.tolist(), size.tolist(), strict=True):
        by[a : a + n].sort()
    first = by[ranges(begin, length)]
    return tokens[first & 0xFFFFFFFF], first >= LATE << 32, length


def prefix(s: np.ndarray, hot: np.ndarray, weight: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """The extended prefix of one set in the global order, and how many of it, from its start, are not hot; hot (sorted)
    and weight are the hot shingles and their counts; place, an integer for each shingle, orders the others."""
    order = ordered(s, ranked(hot, weight), np.zeros(len(s), np.int64) if place is None else place)
    found, late, _ = prefixes(s, np.array([0]), np.array([len(s)]), order)
    return found, int((~late).sum())


def postings(docs: DataFrame, hot: list[tuple[int, int]], common: list[tuple[int, int]]) -> DataFrame:
    """(key, sig, n, hot) of every distinct set of a task."""

    def table(rows: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        order = sorted((t % (1 << 64), c) for t, c in rows)
        return np.array([t for t, _ in order], np.uint64), np.array([c for _, c in order], np.int64)

    held = docs.sparkSession.sparkContext.broadcast((*table(hot), *table(common)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, weight, words, count = held.value
        late, weights, seen = ranked(tokens, weight), word_weights(words, count), set()
        for batch in batches:
            for rows in slices(batch):
                got = Sets(rows.column("text"), weights)
                sigs, n, new = got.ids(), np.diff(got.at), []
                for i, k in enumerate(n.tolist()):
                    if k >= 4 and sigs[i] not in seen:
                        seen.add(sigs[i])
                        new.append(i)
                if new:
                    key, is_hot, times = prefixes(got.tokens, got.at[new], n[new], ordered(got.tokens, late, got.place))
                    sig = np.array([sigs[i] for i in new], np.int64)
                    columns = [key.view(np.int64), np.repeat(sig, times), np.repeat(n[new], times).astype(np.int32), is_hot]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "sig", "n", "hot"])
        del late, weights, seen
        release_worker_memory()

    return docs.select("text").mapInArrow(scan, "key long, sig long, n int, hot boolean")


def lists(rows: DataFrame, salts: int) -> DataFrame:
    """The posting rows of lists that hold two sets or more, with the list's hub (sig, n): the set of the smallest id,
    which is a hash. Lists of hot tokens are dealt by salt, with a hub for each part, and stay whatever a part holds."""
    w = Window.partitionBy("key", "salt")
    salted = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("sig"), F.lit(salts))).otherwise(0))
    held = salted.withColumns({"hub": F.min(F.struct("sig", "n")).over(w), "last": F.max("sig").over(w)})
    return held.where((F.col("hub.sig") != F.col("last")) | F.col("hot")).select("key", "sig", "n", "hot", "hub")


def fits(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can link at all."""
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, words): the shingle set, as bytes, of each wanted class; wanted has doc_id and sig, a row for a class."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                got = Sets(rows.column("text"))
                fits = pc.equal(pa.array(got.ids(), pa.int64()), rows.column("sig"))
                yield pa.RecordBatch.from_arrays([rows.column("sig"), binaries(got.tokens.view(np.uint8), 8 * got.at)], names=["sig", "words"]).filter(fits)
        release_worker_memory(False)

    ids = wanted.select(F.col("doc_id"), "sig")
    return docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id").mapInArrow(scan, "sig long, words binary").dropDuplicates(["sig"])


def tested(test: Callable[..., object], kind: str) -> Callable:
    """A pandas UDF that applies test row by row to its columns, and gives memory back at the end of a task."""

    @F.pandas_udf(kind)
    def each(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([test(*row) for row in zip(*columns, strict=True)], dtype=bool if kind == "boolean" else object)
        release_worker_memory(False)

    return each


def similar(x: bytes, y: bytes) -> bool:
    """Whether two sets of shingles link."""
    s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.sort(np.concatenate([s, t]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 80 * (len(s) + len(t) - shared)


def stars(live: DataFrame) -> DataFrame:
    """Pairs (a, b) to test: each set with the hub that it meets in most lists, two at least."""
    met = live.where((F.col("sig") != F.col("hub.sig")) & fits(F.col("n"), F.col("hub.n"))).groupBy("sig", "hub.sig").agg(F.count("*").alias("times")).toDF("a", "b", "times")
    best = met.where("times >= 2").groupBy("a").agg(F.max(F.struct("times", "b")).alias("best"))
    return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def labelled(live: DataFrame, nodes: DataFrame, max_broadcast: int) -> DataFrame:
    """Posting rows (key, sig, n, hot) with comp, the component of the set."""
    rows = live.select("key", "sig", "n", "hot").join(broadcast_if_small(nodes, max_broadcast), "sig", "left")
    return rows.withColumn("comp", F.coalesce("comp", "sig"))


def settled(rows: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """From posting rows (key, sig, n, comp): pairs of components (c < d) that may hold a link, and rows (key, sig, comp)
    of lists in which any two sets may."""
    overlap = lambda n: F.least(F.lit(SHARED), F.ceil(n * 4 / 5)).cast("int")

    def by_size(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs (c, d, times, lo) of lists of at most bound components, and the keys of longer ones."""
        heads = stage(rows.groupBy("key", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "join-heads")
        size = stage(heads.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "join-sizes")
        short = heads.join(size.where(F.col("size") <= bound), "key", "left_semi")
        other = short.select("key", F.col("comp").alias("d"), F.col("lo").alias("lo_d"), F.col("hi").alias("hi_d"))
        near = (F.col("comp") < F.col("d")) & (5 * F.col("hi_d") >= 4 * F.col("lo")) & (5 * F.col("hi") >= 4 * F.col("lo_d"))
        pairs = short.join(other, "key").where(near).groupBy(F.col("comp").alias("c"), "d").agg(F.count("*").alias("times"), F.min(F.least("lo", "lo_d")).alias("lo"))
        return pairs, size.where(F.col("size") > bound).select("key")

    pairs, long = by_size(rows)
    found = stage(pairs.where(F.col("times") >= F.ceil(overlap(F.col("lo")) / 2)).select("c", "d"), "join-open-pairs")
    held = rows.join(long, "key", "left_semi").groupBy("sig").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.sort_array(F.collect_set("key")).alias("keys"))
    # a link without half of its shared tokens rare shares the other half, and one more, in frequent ones
    held = stage(held.where(F.size("keys") > F.floor(overlap(F.col("n")) / 2)), "join-frequent")
    two = F.flatten(F.transform("keys", lambda x, i: F.transform(F.slice("keys", i + 2, F.size("keys")), lambda y: F.xxhash64(x, y))))
    combined = held.where(F.size("keys") <= MAX_COMBINED).select(F.explode(two).alias("key"), "sig", "n", "comp")
    pairs, long = by_size(combined)
    found = found.union(stage(pairs.select("c", "d"), "join-open-pairs")).distinct()
    single = held.select(F.explode("keys").alias("key"), "sig", "comp")
    many = held.where(F.size("keys") > MAX_COMBINED).select(F.explode("keys").alias("key")).distinct()
    rest = combined.select("key", "sig", "comp").join(long, "key", "left_semi").union(single.join(many, "key", "left_semi"))
    return found, stage(rest, "join-rest")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows) brought to `size` bytes."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, size), axis=1)


def block_pairs(x: tuple, y: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The smaller and the larger sig of the sets of two blocks (sigs, ns, comps: arrays, bitmaps: bytes), or of one block twice, that have different
    components and that the bitmaps allow to link. Sets are in the order of their sizes, so that each meets a stretch of the others."""
    own, found = x is y, []

    def parted(z: tuple) -> dict[int, tuple[np.ndarray, ...]]:
        """Sets with bitmaps of one width, by size."""
        wide, out = np.array([len(v) for v in z[3]]), {}
        for w in np.unique(wide).tolist():
            at = np.flatnonzero(wide == w)
            at = at[np.argsort(z[1][at], kind="stable")]
            out[w] = (*(v[at] for v in z[:3]), np.frombuffer(b"".join(z[3][k] for k in at), np.uint8).reshape(len(at), -1))
        return out

    xs = parted(x)
    ys = xs if own else parted(y)
    for p, (sx, nx, cx, bx) in xs.items():
        for q, (sy, ny, cy, by) in ys.items():
            if max(p, q) > 2 * min(p, q) or own and q < p:  # sizes too far apart; met already
                continue
            a, b = (folded(v, min(p, q)).view(np.uint64) for v in (bx, by))
            lo, hi = np.searchsorted(ny, -(-4 * nx // 5)), np.searchsorted(ny, 5 * nx // 4, "right")
            if own and p == q:
                lo = np.maximum(lo, np.arange(len(nx)) + 1)
            part = max(1, a.shape[1] // 4)  # of the bits, which drops most pairs
            (a, a_rest), (b, b_rest) = ([np.ascontiguousarray(v[:, c]) for c in (slice(part), slice(part, None))] for v in (a, b))
            for k in np.flatnonzero(lo < hi).tolist():
                at = np.arange(lo[k], hi[k])
                differ = np.bitwise_count(a[k] ^ b[lo[k] : hi[k]]).sum(axis=1, dtype=np.int64)
                for more in (b_rest, None):
                    total = nx[k] + ny[at]
                    shared = (total - differ) // 2
                    ok = (100 * shared >= 80 * (total - shared)) & (cy[at] != cx[k])
                    at, differ = at[ok], differ[ok]
                    if more is not None:
                        differ = differ + np.bitwise_count(a_rest[k] ^ more[at]).sum(axis=1, dtype=np.int64)
                if len(at):
                    found.append(np.stack([np.full(len(at), sx[k]), sy[at]]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs.min(axis=0), pairs.max(axis=0)


def family_sets(rest: DataFrame, maps: DataFrame) -> DataFrame:
    """(sig, comp, family, n, bits) of the sets of rest; a family is what a chain of its lists joins."""
    hub = rest.groupBy("key").agg(F.min("comp").alias("hub"))
    joined = connected_components(rest.join(hub, "key").select("comp", "hub").distinct(), "comp", "hub")
    return rest.select("sig", "comp").distinct().join(joined, F.col("comp") == F.col("node")).select("sig", "comp", F.col("component").alias("family")).join(maps, "sig")


def family_stars(sets: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each set with HUBS sets of its family, others in each turn, that differ from it in component."""
    mixed_up = lambda j: F.xxhash64("sig", F.lit(HUBS * turn + j))
    hubs = sets.groupBy("family").agg(F.array(*(F.min(F.struct(mixed_up(j).alias("o"), "sig", "comp", "n")) for j in range(HUBS))).alias("hubs"))
    met = sets.join(hubs, "family").select("sig", "comp", "n", F.explode("hubs").alias("hub")).where((F.col("comp") != F.col("hub.comp")) & fits(F.col("n"), F.col("hub.n")))
    return met.select(F.least("sig", "hub.sig").alias("a"), F.greatest("sig", "hub.sig").alias("b")).distinct()


def family_blocks(sets: DataFrame, block: int = BLOCK, most: int = WAVE) -> DataFrame:
    """Pairs (a, b) of sets that the bitmaps allow, of one family but different components. Sets of a family stand in bands by size, as only those of
    one band or of two next to each other can link, and a band in blocks of about `block` sets, or of BLOCK_BYTES of bitmaps. Every two blocks that may hold
    a link meet under a key of their own. Copies for these are made in turns of about `most` bytes, or of the bytes of all sets, so that the
    disk that they take follows the input while their number is quadratic."""
    band = F.floor(F.log("n") / float(np.log(1.26))).cast("int")  # wider than the ratio of sizes that can link, so that rounding does not matter
    banded, own = sets.withColumn("band", band), Window.partitionBy("family")
    sizes = banded.groupBy("family", "band").agg(F.count("*").alias("n_sets"), F.sum(F.length("bits")).alias("bytes"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    sizes = sizes.withColumn("blocks", F.ceil(F.greatest(F.col("n_sets") / block, F.col("bytes") / BLOCK_BYTES, F.lit(1))).cast("int"))
    beside = lambda f, k: F.when(f("band").over(own.orderBy("band")) == F.col("band") + k, f("blocks").over(own.orderBy("band"))).otherwise(0)
    sizes = sizes.withColumns({"before": beside(F.lag, -1), "after": beside(F.lead, 1), "mixed": F.min("lo").over(own) < F.max("hi").over(own)}).where("mixed")
    sizes = stage(sizes.select("family", "band", "bytes", "blocks", "before", "after"), "join-bands")  # a row for each size of a family
    every = F.col("blocks") + F.col("before") + F.col("after")
    held, copied, pairs = (v or 0 for v in sizes.agg(F.sum("bytes"), F.sum(F.col("bytes") * every), F.sum(F.when(every > 1, F.col("blocks") * (F.col("blocks") + F.col("after"))))).first())
    turns = -(-copied // max(most, held)) or 1
    n = min(10_000, max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs // turns))
    met = lambda band, step, i, j, left: F.struct(*(v.cast("int").alias(c) for v, c in ((band, "b"), (F.lit(step), "step"), (i, "i"), (j, "j"))), F.lit(left).alias("left"))
    at, b = F.col("at"), F.col("band")
    keys = F.concat(
        F.transform(indices(F.col("blocks") - at), lambda v: met(b, 0, at, at + v, True)),
        F.transform(indices(at), lambda v: met(b, 0, v, at, False)),
        F.transform(indices(F.col("after")), lambda v: met(b, 1, at, v, True)),
        F.transform(indices(F.col("before")), lambda v: met(b - 1, 1, v, at, False)),
    )
    key = ["family", "b", "step", "i", "j"]
    dealt = banded.join(broadcast_if_small(sizes, 1_000_000), ["family", "band"]).withColumn("at", F.pmod(F.xxhash64("sig", F.lit("block")), F.col("blocks")).cast("int"))
    copies = dealt.select("family", "sig", "n", "comp", "bits", F.explode(keys).alias("k")).select("family", "k.*", "sig", "n", "comp", "bits")

    def meet(rows: pa.Table) -> pa.Table:
        left = rows.column("left")
        alone = rows.column("step")[0].as_py() == 0 and rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
        x, y = (tuple(t.column(c).to_numpy() for c in ("sig", "n", "comp", "bits")) for t in (rows.filter(left), rows.filter(pc.invert(left))))
        a, b = block_pairs(x, x if alone else y)
        release_worker_memory(False)
        return pa.table({"a": a, "b": b})

    found = None
    for k in range(turns):
        part = copies if turns == 1 else copies.where(F.pmod(F.xxhash64(*key, F.lit("turn")), F.lit(turns)) == k)
        part = stage(part.repartition(n, *key).groupBy(*key).applyInArrow(meet, "a long, b long"), "join-left-over")
        found = part if found is None else found.union(part)
    return found


def similarity_classes(docs: DataFrame, *, share: int = 2000, least: int = 8, bound: int = 32, max_broadcast: int = 1_000_000, max_rounds: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(membership: doc_id, sig, n), (classes: sig, doc_id) and (nodes: sig, comp), comp the smallest sig that a class reaches."""
    spark = docs.sparkSession
    limit_batches(spark)
    seen = stage(profile(docs), "join-profile")
    members = seen.where("token is null").select("doc_id", "sig", "n")
    total = members.count()
    counts = seen.where("token is not null").groupBy("n", "token").agg(F.sum("cnt").alias("c"))
    hot = [(r.token, r.c) for r in counts.where((F.col("n") == 0) & (F.col("c") >= max(least, total // share))).collect()]
    said = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = [(r.token, r.c) for r in counts.where((F.col("n") == 1) & (F.col("c") >= max(least, said // (2 * WORD_SHARE)))).collect()]  # at most 2 * WORD_SHARE
    classes = stage(members.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "join-classes")
    salts = max(16, total // 100_000)
    live = stage(lists(postings(docs, hot, common), salts), "join-lists")
    maps = stage(seen.where("n >= 4 and sig is not null").groupBy("sig").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "join-maps")
    forget_shuffles(spark)
    sets: DataFrame | None = None

    def verified(p: DataFrame) -> DataFrame:
        """The pairs that link: bitmaps drop most others, shingle sets decide."""
        nonlocal sets
        of = lambda c: maps.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
        left = p.join(of("a"), "a").join(of("b"), "b").where(tested(may_link, "boolean")("bits_a", "bits_b", "n_a", "n_b"))
        left = stage(left.select("a", "b"), "join-likely")
        wanted = left.select(F.col("a").alias("sig")).union(left.select("b")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("sig"), "sig", "left_anti")
        wanted = stage(wanted.join(classes.select("sig", "doc_id").where("doc_id is not null"), "sig"), "join-wanted")
        if not wanted.isEmpty():
            with arrow_rows(spark, 500):
                new = stage(class_sets(docs, broadcast_if_small(wanted, max_broadcast)), "join-sets")
            sets = new if sets is None else sets.union(new)
        if sets is None:
            return left
        x = left.join(sets.select(F.col("sig").alias("a"), F.col("words").alias("s")), "a").join(sets.select(F.col("sig").alias("b"), F.col("words").alias("t")), "b")
        with arrow_rows(spark, 500):
            return stage(x.where(tested(similar, "boolean")("s", "t")).select("a", "b"), "join-links")

    def members_of(both: DataFrame, sample: int | None = None) -> DataFrame:
        """Pairs of sets that the bitmaps allow between the components c and d, or between about `sample` members of each.
        The larger one stands in blocks of about 64 bitmaps, which each member of the other meets."""
        ids = both.select(F.col("c").alias("comp")).union(both.select("d")).distinct()
        of_node = stage(maps.join(broadcast_if_small(nodes, max_broadcast), "sig", "left").withColumn("comp", F.coalesce("comp", "sig")).join(broadcast_if_small(stage(ids, "join-open-ids"), max_broadcast), "comp", "left_semi"), "join-open-maps")
        counts = of_node.groupBy("comp").agg(F.count("*").alias("size"))
        if sample:
            of_node = of_node.join(counts, "comp").where(F.pmod(F.xxhash64("sig", F.lit("sample")), F.ceil(F.col("size") / sample)) == 0).drop("size")
            counts = of_node.groupBy("comp").agg(F.count("*").alias("size"))
        sized = both.join(counts.withColumnRenamed("comp", "c").withColumnRenamed("size", "s_c"), "c").join(counts.withColumnRenamed("comp", "d").withColumnRenamed("size", "s_d"), "d")
        turned = sized.select(F.when(F.col("s_c") >= F.col("s_d"), F.col("c")).otherwise(F.col("d")).alias("big"), F.when(F.col("s_c") >= F.col("s_d"), F.col("d")).otherwise(F.col("c")).alias("small"))
        block = F.pmod(F.xxhash64("sig", F.lit("block")), F.ceil(F.col("size") / 64)).alias("block")
        blocks = of_node.join(counts, "comp").groupBy(F.col("comp").alias("big"), block).agg(F.collect_list("sig").alias("sigs"), F.collect_list("n").alias("ns"), F.collect_list("bits").alias("maps"))
        met = turned.join(of_node.select(F.col("comp").alias("small"), F.col("sig").alias("y"), F.col("n").alias("n_y"), F.col("bits").alias("bits_y")), "small")

        def near(sigs, ns, held, n, bits) -> list[int]:
            return [int(v) for v, m, x in zip(sigs, ns, held, strict=True) if 5 * min(m, n) >= 4 * max(m, n) and may_link(x, bits, int(m), int(n))]

        # exploded where it is made: a filter on its size would have it made twice, by two Python workers of a task
        found = met.join(blocks, "big").select("y", F.explode(tested(near, "array<long>")("sigs", "ns", "maps", "n_y", "bits_y")).alias("x"))
        return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def merged(links: DataFrame) -> DataFrame:
        """nodes (sig, comp) with the components that links join made one."""
        of = lambda c: nodes.select(F.col("sig").alias(c), F.col("comp").alias(f"{c}_comp"))
        e = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_comp", "a").alias("x"), F.coalesce("b_comp", "b").alias("y"))
        joined = connected_components(e, "x", "y")
        known = nodes.union(joined.select("node", F.col("node").alias("comp")))  # those met for the first time, too
        best = known.join(joined, known["comp"] == joined["node"], "left").select("sig", F.coalesce("component", "comp").alias("comp"))
        return stage(best.groupBy("sig").agg(F.min("comp").alias("comp")), "join-nodes")

    nodes = stage(connected_components(verified(stage(stars(live), "join-pairs")), "a", "b").select(F.col("node").alias("sig"), F.col("component").alias("comp")), "join-nodes")

    def renewed(df: DataFrame, name: str) -> DataFrame:
        """Component ids of a column as they are now."""
        now = nodes.select(F.col("sig").alias(name), F.col("comp").alias("now"))
        return df.join(broadcast_if_small(now, max_broadcast), name, "left").withColumn(name, F.coalesce("now", name)).drop("now")

    both, rest = settled(labelled(live, nodes, max_broadcast), bound)
    forget_shuffles(spark)
    for sample in (16, None):  # a few members of each first, as most components that link become one by that
        both = stage(renewed(renewed(both, "c"), "d").where("c <> d").select(F.least("c", "d").alias("c"), F.greatest("c", "d").alias("d")).distinct(), "join-open-pairs")
        with arrow_rows(spark, 200):
            fresh = stage(members_of(both, sample), "join-left-over")
        nodes = merged(verified(fresh))
    if not rest.isEmpty():
        held = stage(family_sets(renewed(rest, "comp"), maps), "join-family")
        for turn in range(max_rounds):
            pairs = stage(family_stars(held, turn), "join-pairs")
            links = verified(pairs)
            if links.isEmpty():
                break
            nodes = merged(links)
            held = stage(renewed(held, "comp"), "join-family")
            if links.count() * 20 <= pairs.count():  # few links among the last pairs: test all that are left
                break
        nodes = merged(verified(family_blocks(held)))
    return members, classes, nodes


def jaccard_components(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    members, classes, nodes = similarity_classes(docs, **how)
    named = classes.join(nodes, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(smallest, "comp").select("sig", "component_id")
    linked = members.where("sig is not null").join(by_class, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = members.where("sig is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_first(docs: DataFrame, *, max_broadcast: int = 1_000_000, **how) -> DataFrame:
    """The rows of docs that are the first of their component, all columns unchanged."""
    found = jaccard_components(docs, max_broadcast=max_broadcast, **how)
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "join-gone")
    small = broadcast_if_small(gone, max_broadcast)
    return docs.join(small, docs["doc_id"].cast("long") == small["gone_id"], "left_anti")
