"""Rolling medians against a brute-force version."""

import collections
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.llm import medians

SCHEMA = "click_id long, ts timestamp_ntz, kind string, value double, n long, us int"
START = dt.datetime(2024, 3, 31, 1, 30)


def brute(rows):
    once = {}
    for i, ts, kind, value, *_ in rows:
        if i is not None and ts is not None:
            cents = math.floor(100 * value + 0.5) if value is not None and abs(value) < 1e16 else None
            order = lambda r: (r[0], r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0)
            once[i] = min(once.get(i, (ts, kind, cents)), (ts, kind, cents), key=order)
    found = collections.Counter()
    for i, (ts, kind, cents) in once.items():
        held = sorted(c for t, k, c in once.values() if k == kind and c is not None and ts - dt.timedelta(hours=1) < t <= ts)
        n = len(held)
        if n < 2:
            found[i, kind, n, None, None, None] += 1
            continue
        median2 = held[(n - 1) // 2] + held[n // 2]
        off = sorted(abs(2 * c - median2) for c in held)
        mad4 = off[(n - 1) // 2] + off[n // 2]
        found[i, kind, n, median2, mad4, None if cents is None else 2 * abs(2 * cents - median2) > 3 * mad4] += 1
    return found


def rows_of(seed, n, hours, kinds=("a", "b", None)):
    r = random.Random(seed)
    out = []
    for i in range(n):
        ts = START + dt.timedelta(microseconds=r.choice([r.randrange(int(hours * 3.6e9)), 900_000_000 * r.randrange(1, 4 * hours + 1), 900_000_000 * r.randrange(1, 4 * hours + 1) - 1]))
        value = r.choice([None, r.uniform(-20, 300), r.uniform(-20, 300), float(r.randrange(3)), -0.005, float("nan"), float("inf"), -1e300])
        out.append((i, ts if r.random() > 0.03 else None, r.choice(kinds), value, 1, 2))
        if r.random() < 0.05:
            out.append(out[-1])
    return out


@pytest.mark.parametrize("how", [{}, {"chunk_minutes": 7}, {"chunk_minutes": 600, "block_rows": 50}])
def test_rolling_median_equals_brute_force(spark, how):
    rows = [*rows_of(1, 900, 5), (None, START, "a", 1.0, 1, 2), (5, START, "b", 2.0, 0, 0), (5, None, "b", 3.0, 0, 0)]
    got = medians.rolling_median(spark.createDataFrame(rows, SCHEMA), **how).collect()
    assert collections.Counter(map(tuple, got)) == brute(rows)


def test_one_time_and_one_amount(spark):
    rows = [(i, START, "a", 1.0, 0, 0) for i in range(300)] + [(1000 + i, START + dt.timedelta(minutes=59), "a", float(i), 0, 0) for i in range(70)]
    assert collections.Counter(map(tuple, medians.rolling_median(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_empty_table_and_other_columns(spark):
    assert medians.rolling_median(spark.createDataFrame([], SCHEMA)).collect() == []
    got = medians.rolling_median(spark.createDataFrame([(1, START, "a", 1.0), (2, START, "a", 3.0)], "user long, at timestamp_ntz, shop string, price double"), ident="user", time="at", series="shop", amount="price").orderBy("user").collect()
    assert [tuple(r) for r in got] == [(1, "a", 2, 400, 400, False), (2, "a", 2, 400, 400, False)]


def test_dense_chunk_takes_lanes_in_turns(monkeypatch):
    monkeypatch.setattr(medians, "LANE_BYTES", 1 << 14)
    r = np.random.default_rng(3)
    n, width = 3000, 1000
    time = np.sort(r.integers(0, 4000, n))
    cents = r.integers(-50, 50, n)
    new = np.arange(n) == 0
    got = medians.windows(new, time, cents, np.ones(n, bool), np.ones(n, bool), width)
    for i in range(0, n, 37):
        held = np.sort(cents[(time > time[i] - width) & (time <= time[i])])
        m = len(held)
        assert got[0][i] == m
        if m > 1:
            median2 = held[(m - 1) // 2] + held[m // 2]
            off = np.sort(abs(2 * held - median2))
            assert (got[1][i], got[2][i]) == (median2, off[(m - 1) // 2] + off[m // 2])


def test_hot_series_is_dealt_over_tasks(spark):
    """Rows of one series go to many tasks."""
    rows = spark.range(40_000).select(F.col("id").alias("click_id"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 20)).alias("ts"), F.lit("a").alias("kind"), (F.col("id") % 97).cast("double").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = medians.rolling_median(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t["count"] for t in got) == 40_000
    assert max(t["count"] for t in got) < 20_000
