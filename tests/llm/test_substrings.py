"""Substring dedup against a brute-force version."""

import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotweave.llm import substrings

SCHEMA = "doc_id long, text string, key int, version int, starts int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    first = {}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - window + 1 if i is not None else 0):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, i), i)
    out = collections.Counter()
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        gone = {p for k in range(len(w) - window + 1 if i is not None else 0) if first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        out[i, len(w), len(gone), hashlib.sha256(" ".join(x for p, x in enumerate(w) if p not in gone).encode()).hexdigest()] += 1
    return out


def rows_of(seed, n, vocabulary):
    """Documents of stretches that are copied, cut and put next to each other, over few words, so that windows and anchors meet."""
    r = random.Random(seed)
    words = [*(f"w{i}" for i in range(vocabulary)), "é", "日本", " x"]
    pool = [[r.choice(words) for _ in range(r.randrange(5, 60))] for _ in range(12)]
    out = []
    for i in range(n):
        w = []
        for _ in range(r.randrange(0, 6)):
            p = r.choice(pool)
            a = r.randrange(len(p))
            w += r.choice([p, p[a:], p[:a], [r.choice(words) for _ in range(r.randrange(20))]])
        out.append((r.randrange(-n, n), r.choice([" ", "\n", " \t", "\r\n"]).join(w) + r.choice(["", " "]), 0, 0, 0))
    odd = [None, "", " \n", "one", "a " * 400, "a " * 13, "b " * 12, "x" * 5000, " ".join(f"u{i}" for i in range(3000)), " ".join(f"u{i}" for i in range(1000, 1500))]
    same = [(n + 50, out[0][1], 0, 0, 0), (n + 50, out[1][1], 0, 0, 0), (n + 50, out[1][1], 0, 0, 0), (None, out[0][1], 0, 0, 0)]
    return out + same + [(n + 100 + i, t, 0, 0, 0) for i, t in enumerate(odd)] + [(n + 200 + i, t, 0, 0, 0) for i, t in enumerate(odd)]


@pytest.mark.parametrize(("seed", "vocabulary", "how"), [(1, 3, {}), (2, 40, {}), (3, 5, {"hot_rows": 3}), (4, 500, {"gram": 1, "hot_rows": 10}), (5, 4, {"gram": 13})])
def test_removed_words_equal_brute_force(spark, seed, vocabulary, how):
    rows = rows_of(seed, 120, vocabulary)
    got = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), **how).collect()
    assert collections.Counter(map(tuple, got)) == brute(rows)


def test_slices_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 64)
    texts = pa.array([t for _, t, *_ in rows_of(6, 80, 6)])
    whole = substrings.Texts(texts)
    assert [bytes(whole.bytes[a:b]).decode() for a, b in zip(whole.starts, whole.ends, strict=True)] == [w for t in texts.to_pylist() for w in WORD.findall(t or "")]
    hashes = collections.defaultdict(set)
    for a, b, h in zip(whole.starts, whole.ends, whole.hashes(), strict=True):
        hashes[bytes(whole.bytes[a:b])].add(int(h))
    assert all(len(h) == 1 for h in hashes.values()) and len({h for (h,) in hashes.values()}) == len(hashes)


def test_factors_hide_no_window_across_their_end():
    block = substrings.Block(3)
    for said in ("a b c d", "c d e f", "b c d e"):
        block.add(said.encode().split())
    factors = block.factors(b"x a b c d e f y".split())
    assert factors[0] == (1, 4)
    assert {p for s, n in factors for p in range(s, s + n)} == set(range(1, 7))


def test_empty_table_and_one_document(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    got = substrings.remove_repeats(spark.createDataFrame([(1, "a b " * 40, 0, 0, 0)], SCHEMA)).collect()
    assert [tuple(r)[:3] for r in got] == [(1, 80, 0)]


def test_long_text_takes_linear_time(spark):
    text = " ".join(f"t{i % 7919}" for i in range(200_000))
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(spark.createDataFrame([(1, text, 0, 0, 0), (2, text, 0, 0, 0)], SCHEMA)).collect()}
    assert got == {1: 0, 2: 200_000}


def test_hot_passage_meets_in_no_task(spark):
    """A passage that all documents hold is one row for each task before the shuffle."""
    said = " ".join(f"licence{i}" for i in range(20))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own"), F.col("id").cast("string"), F.lit(" " + said)).alias("text"))
    got = substrings.remove_repeats(docs)
    assert got.where("n_removed = 20").count() == 2999
