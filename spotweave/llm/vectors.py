"""Compression of vectors to codes by product quantisation in whole numbers (op 12).

Every component x becomes floor(scale * x); a vector is cut into `parts` parts of equal length, each with a codebook of its own. A part's
nearest entry is found by screening: a float32 matrix product gives |c|^2 - 2 a.c for all entries, and a bound on its rounding
(`margin`, from the lengths of a and c and the number of components) an interval for each. Entries whose interval reaches the
lowest one are evaluated again in int64, and ties go to the lower index. So float32 never decides, and int64 touches
few entries.

Codebooks start as the parts of the `entries` smallest ids. In a round, every task sums its parts by entry, and Spark adds up these
sums, `parts * entries` rows for a task. Only codebooks reach the driver and go back to the tasks: parts * entries * length numbers,
whatever the input. Codes are staged once; errors are added up by label before they are joined back, so that a label's rows never meet.

Left out: null vectors, vectors that hold a null, a component that is no number, infinite or of 2**18 and more (so that no sum
of squares can overflow), and vectors whose length is not that of the kept vector with the smallest id or is no multiple of `parts`. A null id
counts as the largest. Rows that share an id are one place in the first codebook, with the smallest vector, and a row each in
the result. With fewer ids than `entries` codebooks are smaller. Null labels are a label. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.runtime import broadcast_if_small, stage

LARGEST = 1 << 18
UNIT = 2.0**-24  # half a unit in the last place of a float32


def margin(lengths: np.ndarray, longest: float, components: int) -> np.ndarray:
    """A bound on the rounding of the float32 values of |c|^2 - 2 a.c, for parts of the given lengths and entries up to the longest:
    the product's own (its terms, its sum and what its factors lost on conversion), twice, that of |c|^2, and that of the difference."""
    k = (components + 2) * UNIT
    return ((2 * k / (1 - k) + 4 * UNIT) * lengths * longest + 3 * UNIT * longest**2) * (1 + 1e-9)


def nearest(a: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of book for each row of a, both of whole numbers, and the squared distance to it."""
    squares = (book * book).sum(1)
    score = squares.astype(np.float32) - 2 * (a.astype(np.float32) @ book.astype(np.float32).T)
    lengths = np.sqrt((a * a).sum(1).astype(np.float64))
    bound = margin(lengths, float(np.sqrt(float(squares.max()))), a.shape[1])
    close = score.astype(np.float64) <= (score.min(1).astype(np.float64) + 2 * bound)[:, None]
    found = close.argmax(1)
    again = np.flatnonzero(close.sum(1) > 1)
    if len(again):
        row, entry = np.nonzero(close[again])
        exact = ((a[again[row]] - book[entry]) ** 2).sum(1)
        order = np.lexsort((entry, exact, row))
        first = order[np.concatenate([[True], np.diff(row[order]) > 0])]
        found[again] = entry[first]
    return found, ((a - book[found]) ** 2).sum(1)


def whole(vectors: DataFrame, ident: str, vector: str, label: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """(id, label, v: whole components) of the vectors that stay, and their length."""
    x = F.transform(vector, lambda c: c.cast("double"))
    good = F.size(x).between(1, 1 << 20) & F.forall(x, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))) & (F.size(x) % parts == 0)
    kept = vectors.where(good).select(F.col(ident).alias("id"), F.col(label).alias("label"), F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("v"))
    least = kept.agg(F.min(F.struct(F.col("id").isNull(), "id", F.size("v").alias("n"))).alias("least")).first()["least"]
    length = least["n"] if least else parts
    return kept.where(F.size("v") == length), length


def numbers(batch: pa.RecordBatch, parts: int, length: int) -> np.ndarray:
    """The vectors of a batch as whole numbers by row, part and component."""
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(len(batch), parts, length // parts)


def first_codebooks(kept: DataFrame, parts: int, entries: int, length: int) -> np.ndarray:
    ids = [r["id"] for r in kept.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries).collect()]
    named = F.col("id").isin([i for i in ids if i is not None])
    chosen = kept.where(named | F.col("id").isNull() if None in ids else named).groupBy("id").agg(F.min("v").alias("v")).collect()
    found = sorted(((r["id"] is None, r["id"], r["v"]) for r in chosen), key=lambda x: (x[0], x[1] if not x[0] else 0))
    return np.array([v for *_, v in found], np.int64).reshape(len(found), parts, length // parts).transpose(1, 0, 2)


def moved(kept: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """The codebooks after a round: every entry becomes the mean of its parts, rounded down; unused entries stay."""
    parts, entries, n = books.shape
    sums = [f"s{j}" for j in range(n)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, n), np.int64)
        for batch in batches:
            a = numbers(batch, parts, length)
            for p in range(parts):
                at = nearest(a[:, p], books[p])[0] + p * entries
                np.add.at(count, at, 1)
                np.add.at(total, at, a[:, p])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used // entries), pa.array(used % entries), pa.array(count[used]), *(pa.array(total[used, j]) for j in range(n))], names=["part", "entry", "n", *sums])

    added = kept.select("v").mapInArrow(task, "part long, entry long, n long, " + ", ".join(f"{s} long" for s in sums))
    out = books.copy()
    for r in added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in sums)).collect():
        out[r["part"], r["entry"]] = [int(r[s]) // r["n"] for s in sums]
    return out


def fit(vectors: DataFrame, *, ident: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """The vectors that stay, in whole numbers, and the codebooks, by part, entry and component."""
    kept, length = whole(vectors, ident, vector, label, parts, scale)
    books = first_codebooks(kept, parts, entries, length)
    for _ in range(rounds if books.shape[1] else 0):
        books = moved(kept, books, length)
    return kept, books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, code (two hex digits for each part) and error of each of the vectors of fit()."""
    parts, entries, n = books.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    names = np.array([f"{i:0{digits}x}" for i in range(max(entries, 1))])
    kinds = dict(kept.dtypes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = numbers(batch, parts, parts * n)
            code, error = np.full(len(batch), "", f"<U{parts * digits}"), np.zeros(len(batch), np.int64)
            for p in range(parts):
                at, off = nearest(a[:, p], books[p])
                code, error = np.char.add(code, names[at]), error + off
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    return kept.mapInArrow(task, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, *, ident: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """ident, code, error, label_error (the errors of all vectors of its label) and codebooks_sha256 for each vector that stays."""
    kept, books = fit(vectors, ident=ident, vector=vector, label=label, **how)
    codes = stage(encode(kept, books), "vector-codes")
    by_label = stage(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    both = codes.join(broadcast_if_small(by_label, 100_000), F.col("label").eqNullSafe(F.col("of")))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return both.select(F.col("id").alias(ident), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
