"""Packing by Karmarkar-Karp multiway differencing (op 2).

Documents are tokenised whole; every full window of a document is a sequence of its own, and what is left
over is cut into items of at most `item` tokens. Items are pooled until a pool holds `pool` windows'
worth of tokens less a small slack, and multiway differencing spreads a pool over its windows: each
item starts as a partial partition, and the two partial partitions with the largest imbalance are merged with
opposing orders until one is left. Where a window exceeds the capacity the window count rises and the
pool is differenced again.

Pools live inside a task, so nothing is shuffled, memory is one pool and one document, and a recomputed task
gives the same rows. Sequence ids are the partition number and a counter.

Null and empty texts are the single end-of-document id; repeated rows are packed one by one; ties follow
arrival order; an empty table gives an empty result; a clashing column name cannot matter, as only doc_id
and text are read.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from spotweave.runtime import limit_batches, release_worker_memory

CAPACITY = 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
LONG_RUN = re.compile(r"\S{4000}")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for raw bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


def load_encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids of the byte-level vocabulary file at path; none are added, but added tokens in a text are found.

    The vocabulary's ids follow its merge order, so the merges can run as ranks, several times faster than
    the file's own library; both are compared on loading, and that library takes over for texts that hold an added
    token or extremely long runs without white space, and for vocabularies where the two differ. It is `held` only from the
    first text that needs it to the next `release()`."""
    import json

    import tiktoken
    from tokenizers import Tokenizer

    held: list[Tokenizer] = []

    def slow(t: str) -> list[int]:
        if not held:
            held.append(Tokenizer.from_file(path))
        return held[0].encode(t, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {x["content"] for x in spec.get("added_tokens", [])}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
    said = [w for w in sorted(spec["model"]["vocab"]) if w not in special][::97]  # words of the whole vocabulary
    del spec
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    probes = ["It's 3.14 a\tb  c\n\n d éñß 漢字 -- x_y '' we'll I'VE end ", *(bytes(alphabet[c] for c in "".join(said[i : i + 50])).decode("utf-8", "replace") for i in range(0, len(said), 50))]
    other = re.compile("|".join([LONG_RUN.pattern, *map(re.escape, sorted(special))]))
    encode = slow if any(fast(t) != slow(t) for t in probes) else lambda t: slow(t) if other.search(t) else fast(t)
    encode.held, encode.release = held, held.clear
    encode.release()
    return encode


def worker_encoder(path: str) -> Callable[[str], list[int]]:
    """load_encoder once for each Python process."""
    cache = sys.modules.setdefault("_spotweave_worker_cache", types.ModuleType("_spotweave_worker_cache"))
    if not hasattr(cache, "encoders"):
        cache.encoders = {}
    if path not in cache.encoders:
        cache.encoders[path] = load_encoder(path)
        release_worker_memory()
    return cache.encoders[path]


def karmarkar_karp(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of sizes in k groups of nearly equal sums, by multiway differencing.

    A partial partition keeps its non-empty groups, largest first; the empty rest counts as zeros."""
    if not sizes:
        return [[] for _ in range(k)]
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) + len(b) <= k:
            merged = a + b
        else:
            overlap = len(a) + len(b) - k
            merged = a[: len(a) - overlap] + b[: len(b) - overlap]
            merged += [(x + y, m + n) for (x, m), (y, n) in zip(a[len(a) - overlap :], reversed(b[len(b) - overlap :]), strict=True)]
        merged.sort(key=lambda g: -g[0])
        if len(merged) == k and merged[-1][0] > 0:
            spread = merged[0][0] - merged[-1][0]
        else:
            spread = merged[0][0]
        order += 1
        heapq.heappush(heap, (-spread, order, merged))
    groups = [m for _, m in heap[0][2]]
    return groups + [[] for _ in range(k - len(groups))]


def fill_windows(sizes: list[int], capacity: int, windows: int | None = None) -> list[list[int]]:
    """Groups of indices, none above capacity: windows (or as few as fit), more whenever one is exceeded."""
    k = max(windows or 0, -(-sum(sizes) // capacity), 1)
    while True:
        groups = karmarkar_karp(sizes, k)
        if max(sum(sizes[i] for i in g) for g in groups) <= capacity:
            return [g for g in groups if g]
        k += 1


class Packer:
    """Takes (key, ids) of documents and gives rows (key, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, pool: int = 128, item: int = 256, slack: int = 8):
        self.sequence, self.capacity, self.item = first_sequence, capacity, item
        self.windows, self.target = pool, pool * (capacity - slack)
        self.items: list[tuple] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        raw = ids.astype("<u4").tobytes()
        while n - at >= self.capacity:
            self._place((key, at, self.capacity, zlib.crc32(raw[4 * at : 4 * (at + self.capacity)]), n), 0)
            self.sequence += 1
            at += self.capacity
        while at < n:
            length = min(self.item, n - at, self.target - self.held)
            self.items.append((key, at, length, zlib.crc32(raw[4 * at : 4 * (at + length)]), n))
            self.held += length
            at += length
            if self.held == self.target:
                self.flush(self.windows)

    def _place(self, piece: tuple, offset: int) -> None:
        self.rows.append((*piece, self.sequence, offset))

    def flush(self, windows: int | None = None) -> None:
        if not self.items:
            return
        for group in fill_windows([x[2] for x in self.items], self.capacity, windows):
            offset = 0
            for i in sorted(group):
                self._place(self.items[i], offset)
                offset += self.items[i][2]
            self.sequence += 1
        self.items, self.held = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_documents(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, capacity: int = CAPACITY, pool: int = 128, item: int = 256) -> DataFrame:
    """One row for each piece of each document; see SCHEMA."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = worker_encoder(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, pool, item)
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(packer.take(), columns=names)
            return out.astype({c: "Int64" for c in names})

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) if isinstance(text, str) and text else []
                ids.append(end_id)
                packer.add(None if pd.isna(key) else int(key), np.array(ids, dtype="<u4"))
                if len(packer.rows) >= 20_000:
                    yield frame()
            yield frame()
        packer.flush()
        yield frame()
        del packer
        encode.release()
        release_worker_memory()

    limit_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(pack, SCHEMA)
