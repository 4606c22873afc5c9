"""Vector codes against a brute-force version in Python's whole numbers."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from spotweave.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, code string"


def brute(rows, parts, entries, rounds):
    kept = []
    for i, x, label, *_ in rows:
        if x and all(c is not None and abs(c) < 1 << 18 for c in x) and len(x) % parts == 0:
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in x], label))
    if not kept:
        return [], ""
    length = len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))[1])
    kept = [r for r in kept if len(r[1]) == length]
    n = length // parts
    cut = lambda v, p: v[p * n : (p + 1) * n]
    ids = {}
    for i, v, _ in kept:
        ids[i] = min(ids.get(i, v), v)
    first = sorted(ids, key=lambda i: (i is None, i or 0))[:entries]
    books = [[cut(ids[i], p) for i in first] for p in range(parts)]
    best = lambda a, book: min((sum((x - y) ** 2 for x, y in zip(a, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = collections.defaultdict(list)
            for _, v, _ in kept:
                held[best(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*held[e], strict=True)] if held[e] else books[p][e] for e in range(len(first))]
    out = []
    for i, v, label in kept:
        found = [best(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    total = collections.Counter()
    for *_, error, label in out:
        total[label] += error
    return [(i, code, error, total[label]) for i, code, error, label in out], hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def rows_of(seed, n, length, scale):
    r = random.Random(seed)
    out = [(r.randrange(n), [float(np.float32(r.choice([r.gauss(0, scale), r.randrange(-2, 3) / 4]))) for _ in range(length)], r.choice([None, 1, 2]), 0, "", "") for _ in range(n)]
    odd = [None, [], [1.0] * (length - 1), [None] * length, [float("nan")] * length, [float("inf")] * length, [1.0] * (2 * length), [3e5] * length]
    return out + out[:5] + [(n + i, x, 1, 0, "", "") for i, x in enumerate(odd)] + [(None, [0.5] * length, None, 0, "", "")]


@pytest.mark.parametrize(("n", "length", "parts", "entries", "scale"), [(150, 8, 4, 16, 1.0), (60, 16, 16, 64, 0.3), (5, 32, 2, 8, 60_000.0)])
def test_codes_equal_brute_force(spark, n, length, parts, entries, scale):
    rows = rows_of(n, n, length, scale)
    got = vectors.compress(spark.createDataFrame(rows, SCHEMA), parts=parts, entries=entries).collect()
    want, digest = brute(rows, parts, entries, 2)
    assert collections.Counter(tuple(r)[:4] for r in got) == collections.Counter(want)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_nearest_is_exact_where_float32_is_not():
    """Entries whose distances differ by less than float32 can tell, and ties."""
    r = np.random.default_rng(5)
    base = r.integers(-(1 << 25), 1 << 25, 4)
    book = base + r.integers(-3, 4, (64, 4))
    book[40] = book[7]
    a = base + r.integers(-3, 4, (500, 4))
    far = ((a[:, None, :] - book[None]) ** 2).sum(2)
    found, error = vectors.nearest(a, book)
    assert (found == far.argmin(1)).all() and (error == far.min(1)).all()
    by_float = ((book * book).sum(1).astype(np.float32) - 2 * (a.astype(np.float32) @ book.astype(np.float32).T)).argmin(1)
    assert (by_float != found).any()


def test_margin_bounds_the_rounding():
    r = np.random.default_rng(6)
    for size in (1, 10, 1000, 1 << 25):
        a, book = r.integers(-size, size + 1, (200, 4)), r.integers(-size, size + 1, (64, 4))
        exact = np.array([[sum(int(y) * (int(y) - 2 * int(x)) for x, y in zip(u, c, strict=True)) for c in book] for u in a], object)
        fast = (book * book).sum(1).astype(np.float32) - 2 * (a.astype(np.float32) @ book.astype(np.float32).T)
        bound = vectors.margin(np.sqrt((a * a).sum(1).astype(float)), float(np.sqrt(float((book * book).sum(1).max()))), 4)
        off = np.array([[abs(int(f) - e) for f, e in zip(fs, es, strict=True)] for fs, es in zip(fast, exact, strict=True)], float)
        assert (off <= bound[:, None]).all()


def test_empty_table(spark):
    assert vectors.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vectors.compress(spark.createDataFrame([(1, None, 1, 0, "", "")], SCHEMA)).collect() == []
