"""Substring dedup by relative Lempel-Ziv parsing (op 13).

Words that lie in a stretch of `window` words which an earlier document holds are removed. Documents are factored against reference
blocks, and a block holds all passages that could hold the same stretch, so that each passage needs one block:

1. anchors: of every window of words, the run of `gram` words with the smallest hash. Equal windows have the same anchor, so
   a passage, the windows in a row that share an anchor, belongs to the block of its anchor. Anchors are
   counted by Spark; those of one document alone are dropped, as no window with them is repeated;
2. passages: the texts of the passages of shared anchors. Equal passages of a block are one, with its first and last document.
   Passages of anchors with over `hot_rows` rows are cut to their single windows, and each window is a block of its own,
   so that no block grows with a frequent phrase;
3. factors: a block's passages are parsed in the order of their first documents, greedily and from left to right, against an index of
   the windows of passages of earlier documents: the longest match from a place is a factor. It is `window` words or longer, or no factor.
   The windows across the end of a factor are tried from its last window - 1 words on, as a greedy factor may hide them;
4. spans: in its first document a passage loses its factors, in all later documents all of its words. Spans come back by document and
   are joined with its text.

Windows are compared by their words, never by hash alone; passages are led back to documents by 128 bits and the anchor's 64.

Texts and passages are shuffled by document and by passage; hot passages are aggregated before. A task holds one slice of a batch, or one text if
that is longer, and the index of one block. Everything is judged on the input, so the result does not depend on the order of work.

Null and empty texts have no words. Rows with a null doc_id lose nothing and are no earlier document. Rows that share a doc_id
are never earlier than each other, whatever their texts; repeated rows get the same result. Texts of fewer words than the window
stay. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.medians import ranges
from spotweave.runtime import forget_shuffles, limit_batches, release_worker_memory, stage, unstage

SLICE = 2 << 20  # bytes of text that are taken at once
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Texts:
    """Some texts in a row: their bytes, where each word starts and ends, and the number of words before each text."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_SPACE[self.bytes]
        edge = np.zeros(len(self.bytes) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.first = np.searchsorted(self.starts, offsets)
        self.inside = inside

    def hashes(self) -> np.ndarray:
        """A hash of each word: of its bytes as digits, mixed."""
        out = np.empty(len(self.starts), np.uint64)
        with np.errstate(over="ignore"):
            begin = 0
            while begin < len(out):
                end = max(begin + 1, int(np.searchsorted(self.ends, self.starts[begin] + SLICE, "right")))
                origin = self.starts[begin]
                part = self.bytes[origin : self.ends[end - 1]].astype(np.uint64) + np.uint64(1)
                inverse = np.cumprod(np.full(len(part), pow(BASE, -1, 1 << 64), np.uint64))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * np.cumprod(np.full(len(part), BASE, np.uint64)))])
                a, b = self.starts[begin:end] - origin, self.ends[begin:end] - origin
                out[begin:end] = (sums[b] - sums[a]) * inverse[a]
                begin = end
            return mixed(out)

    def joined(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The words (that are kept) with a space after each, and where each of all words starts there."""
        size = self.ends - self.starts
        took = size + 1 if kept is None else np.where(kept, size + 1, 0)
        at = np.concatenate([[0], np.cumsum(took)])
        out = np.full(at[-1], 0x20, np.uint8)
        letters = np.ones(at[-1], bool)
        letters[(at[1:] if kept is None else at[1:][kept]) - 1] = False
        source = self.bytes[self.inside]
        out[letters] = source if kept is None else source[np.repeat(kept, size)]
        return out, at

    def passages(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, text, first word and number of windows of each passage, and the hash of every run of `gram` words."""
        n = len(self.starts) - window + 1
        none = np.zeros(0, np.int64)
        if n < 1:
            return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
        word, text = self.hashes(), np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        grams = sequences(word, gram)
        least, at = grams[:n].copy(), np.arange(n)
        for j in range(1, window - gram + 1):
            less = grams[j : j + n] < least
            np.minimum(least, grams[j : j + n], out=least)
            at[less] = np.flatnonzero(less) + j
        real = np.flatnonzero(text[:n] == text[window - 1 :])
        head = np.concatenate([[True], at[real][1:] != at[real][:-1]]) if len(real) else np.zeros(0, bool)
        place = np.flatnonzero(head)
        begin = real[place]
        return least[begin], text[begin], begin, np.diff(np.concatenate([place, [len(real)]])), word


def sequences(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    n = len(word) - size + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * np.uint64(BASE) + word[j : j + n]
        return mixed(out)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about SLICE bytes of text, of one row at least."""
    size = pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64)
    end = np.cumsum(size)
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, doc_id) for every passage."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                key, text, *_ = Texts(rows.column("text")).passages(window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), rows.column("doc_id").take(pa.array(text))], names=["key", "doc_id"])
        release_worker_memory(collect=False)

    return docs.select("doc_id", "text").mapInArrow(task, f"key long, doc_id {dict(docs.dtypes)['doc_id']}")


def passages(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """key, body (words joined by a space), doc_id, version, at (first word) and windows of the passages of docs whose anchors are
    among `keys` of their row; those among `hot` in single windows."""

    def member(keys: pa.Array, text: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether each (text, key) is in the list of that text; a false hit of the hash only adds a passage."""
        owner = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
        salted = lambda t, k: mixed(k ^ mixed(t.astype(np.uint64)))
        with np.errstate(over="ignore"):
            return np.isin(salted(text, key), salted(owner, keys.flatten().to_numpy().view(np.uint64)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                rows = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in rows.columns], names=rows.schema.names)
                texts = Texts(rows.column("text"))
                key, text, at, size, word = texts.passages(window, gram)
                shared, hot = member(rows.column("keys"), text, key), member(rows.column("hot"), text, key)
                one = np.flatnonzero(hot)
                single = ranges(at[one], size[one])
                begin = np.concatenate([at[shared & ~hot], single])
                held = np.concatenate([size[shared & ~hot], np.ones(len(single), np.int64)])
                keys = np.concatenate([key[shared & ~hot], sequences(word, window)[single] if len(single) else key[:0]])
                of = np.concatenate([text[shared & ~hot], np.repeat(text[one], size[one])])
                said, place = texts.joined()
                a, b = place[begin], place[begin + held + window - 1] - 1  # without the last space
                body = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(b - a)])), pa.py_buffer(said[ranges(a, b - a)])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), body.cast(pa.binary()), rows.column("doc_id").take(pa.array(of)), rows.column("version").take(pa.array(of)), pa.array((begin - texts.first[of]).astype(np.int32)), pa.array(held.astype(np.int32))],
                    names=["key", "body", "doc_id", "version", "at", "windows"],
                )
        release_worker_memory(collect=False)

    return docs.mapInArrow(task, f"key long, body binary, doc_id {dict(docs.dtypes)['doc_id']}, version long, at int, windows int")


class Block:
    """The reference passages of one anchor and the place of every window in them."""

    def __init__(self, window: int):
        self.window = window
        self.passages: list[list[bytes]] = []
        self.index: dict[tuple[bytes, ...], tuple[int, int]] = {}

    def add(self, words: list[bytes]) -> None:
        for i in range(len(words) - self.window + 1):
            self.index.setdefault(tuple(words[i : i + self.window]), (len(self.passages), i))
        self.passages.append(words)

    def factors(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, words) of the factors, each as long as its match goes; the windows across its end are tried next."""
        out, i = [], 0
        while i + self.window <= len(words):
            found = self.index.get(tuple(words[i : i + self.window]))
            if found is None:
                i += 1
                continue
            passage, at = self.passages[found[0]], found[1]
            n = self.window
            while i + n < len(words) and at + n < len(passage) and words[i + n] == passage[at + n]:
                n += 1
            out.append((i, n))
            i += n - self.window + 1
        return out


def factored(found: DataFrame, window: int) -> DataFrame:
    """c1, c2, key, first and the factors (starts, sizes) of the distinct passages, which come with key, body, c1, c2, first and last
    document; those that stay whole everywhere are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = None
        block, waiting = Block(window), []
        for batch in batches:
            keys, firsts, lasts = batch.column("key").to_pylist(), batch.column("first").to_pylist(), batch.column("last").to_pylist()
            bodies = batch.column("body")
            rows, starts, sizes = [], [], []
            for i, k in enumerate(keys):
                if k != key:
                    key, first, block, waiting = k, firsts[i], Block(window), []
                elif firsts[i] != first:
                    for words in waiting:
                        block.add(words)
                    first, waiting = firsts[i], []
                alone = not block.passages and 0 < i < len(keys) - 1 and keys[i + 1] != k
                words = [] if alone else bodies[i].as_py().split(b" ")
                factors = block.factors(words) if block.passages else []
                waiting.append(words)
                if factors or first != lasts[i]:
                    rows.append(i)
                    starts.append([s for s, _ in factors])
                    sizes.append([n for _, n in factors])
            if rows:
                chosen = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*(chosen.column(c) for c in ("c1", "c2", "key", "first")), pa.array(starts, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], names=["c1", "c2", "key", "first", "starts", "sizes"])
        release_worker_memory(collect=False)

    return found.mapInArrow(task, f"c1 long, c2 long, key long, first {dict(found.dtypes)['first']}, starts array<int>, sizes array<int>")


def _shared(seen: DataFrame, hot_rows: int) -> DataFrame:
    counted = seen.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a <> b")
    return stage(counted.select("key", (F.col("n") > hot_rows).alias("often")), "shared-anchors")


def _keys(seen: DataFrame, shared: DataFrame) -> DataFrame:
    both = seen.join(shared, "key").groupBy("doc_id")
    return stage(both.agg(F.collect_set(F.expr("if(often, null, key)")).alias("keys"), F.collect_set(F.expr("if(often, key, null)")).alias("hot")), "document-anchors")


def _passages(given: DataFrame, keys: DataFrame, window: int, gram: int) -> DataFrame:
    found = passages(given.withColumn("version", F.xxhash64("text")).join(keys, "doc_id"), window, gram)
    return stage(found.withColumn("c1", F.xxhash64("body")).withColumn("c2", F.xxhash64(F.lit(1), "body")), "passages")


def _factors(found: DataFrame, window: int) -> DataFrame:
    distinct = found.groupBy("key", "c1", "c2", "body").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return stage(factored(distinct.repartition("key").sortWithinPartitions("key", "first"), window), "factors")


def _spans(found: DataFrame, gone: DataFrame, window: int) -> DataFrame:
    both = found.select("key", "c1", "c2", "doc_id", "version", "at", "windows").join(gone, ["key", "c1", "c2"])
    later = F.col("doc_id") > F.col("first")
    spans = both.select(
        "doc_id", "version",
        F.when(later, F.array("at")).otherwise(F.transform("starts", lambda s: s + F.col("at"))).alias("starts"),
        F.when(later, F.array(F.col("windows") + (window - 1))).otherwise(F.col("sizes")).alias("sizes"),
    ).where(F.size("starts") > 0)
    return stage(spans.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("sizes")).alias("sizes")), "spans")


def repeated_spans(docs: DataFrame, *, window: int = 13, gram: int = 5, hot_rows: int = 20_000) -> DataFrame:
    """doc_id, version (a hash of the text) and its spans (starts and sizes in words, which may overlap) that an earlier
    document holds; documents without any are left out. Every step is staged, and what it has read and shuffled goes before the next."""
    spark = docs.sparkSession
    limit_batches(spark)
    given = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    seen = stage(anchors(given, window, gram), "anchors")
    shared = _shared(seen, hot_rows)
    forget_shuffles(spark)
    keys = _keys(seen, shared)
    unstage(seen, shared)
    forget_shuffles(spark)
    found = _passages(given, keys, window, gram)
    unstage(keys)
    forget_shuffles(spark)
    gone = _factors(found, window)
    forget_shuffles(spark)
    spans = _spans(found, gone, window)
    unstage(found, gone)
    forget_shuffles(spark)
    return spans


def remove_repeats(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by a space) for every row of docs."""
    spans = repeated_spans(docs, **how).withColumnRenamed("doc_id", "of")
    rows = docs.select("doc_id", "text").withColumn("v", F.xxhash64("text")).join(spans, (F.col("doc_id") == F.col("of")) & (F.col("v") == F.col("version")), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = Texts(part.column("text"))
                turns = np.zeros(len(texts.starts) + 1, np.int64)
                starts, sizes = (part.column(c).fill_null([]) for c in ("starts", "sizes"))
                begin = np.repeat(texts.first[:-1], pa.compute.list_value_length(starts).to_numpy()) + starts.flatten().to_numpy()
                np.add.at(turns, begin, 1)
                np.add.at(turns, begin + sizes.flatten().to_numpy(), -1)
                kept = np.cumsum(turns[:-1]) == 0
                said, at = texts.joined(kept)
                bounds, view = at[texts.first], memoryview(said)
                digests = [hashlib.sha256(view[a : max(a, b - 1)]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                gone = np.concatenate([[0], np.cumsum(~kept)])[texts.first]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(texts.first)), pa.array(np.diff(gone)), pa.array(digests)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
        release_worker_memory(collect=False)

    return rows.select("doc_id", "text", "starts", "sizes").mapInArrow(task, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string")
