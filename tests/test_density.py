"""Density clusters and single linkage against plain versions."""

import math
import random

import pytest

from spotweave.operators import density

SCHEMA = "roi_id long, fov int, zc double, yc double, xc double"


def points_of(seed, n, side):
    r = random.Random(seed)
    at = lambda: float(r.randrange(side))  # noqa: E731 - whole numbers, so that there are ties
    rows = [(i * 3 % n * 2, r.randrange(2), at(), at(), at()) for i in range(n)]
    return list({x[0]: x for x in rows}.values()) + [(100_001, 0, None, 1.0, 1.0), (100_002, 1, float("nan"), 1.0, 1.0)]


def near(points, reach):
    d = lambda p, q: math.dist(p[2:], q[2:])
    known = [p for p in points if p[2] is not None and not math.isnan(p[2])]
    return [(p[0], q[0], d(p, q)) for p in known for q in known if p[0] < q[0] and p[1] == q[1] and d(p, q) < reach]


def joined(nodes, edges):
    root = {n: n for n in nodes}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    kept = []
    for a, b, d in edges:
        p, q = sorted((top(a), top(b)))
        if p != q:
            root[q] = p
            kept.append((a, b, d))
    return {n: top(n) for n in nodes}, kept


@pytest.mark.parametrize(("side", "reach", "least"), [(9, 2.1, 4), (6, 1.5, 3), (20, 3.0, 2), (9, 2.0, 1), (9, 0.0, 1)])
def test_density_clusters(spark, side, reach, least):
    points = points_of(side, 90, side)
    edges = near(points, reach)
    by = {p[0]: [] for p in points}
    for a, b, d in edges:
        by[a].append((d, b))
        by[b].append((d, a))
    core = {i for i, n in by.items() if len(n) + 1 >= least}
    name, _ = joined(core, [e for e in edges if e[0] in core and e[1] in core])
    want = {i: (name[i], True) if i in core else (name[min((d, j) for d, j in n if j in core)[1]], False) if any(j in core for _, j in n) else (None, False) for i, n in by.items()}
    got = density.density_clusters(spark.createDataFrame(points, SCHEMA), ["fov"], reach, least).collect()
    assert {r.roi_id: (r.cluster, r.core) for r in got} == want and len(got) == len(points)


def test_single_linkage(spark):
    points = points_of(5, 80, 8)
    df = spark.createDataFrame(points, SCHEMA)
    edges = near(points, 4.0)
    _, want = joined([p[0] for p in points], sorted(edges, key=lambda e: (e[2], e[0], e[1])))
    forest = density.spanning_forest(density.near_edges(df, ["fov"], 4.0))
    assert sorted(map(tuple, forest.collect())) == sorted(want)
    for height in (1.0, 1.5, 3.9):
        name, _ = joined([p[0] for p in points], [e for e in edges if e[2] < height])
        assert {r.roi_id: r.cluster for r in density.linked_at(df, forest, height).collect()} == name


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert density.density_clusters(none, ["fov"], 1.0, 2).collect() == []
    assert density.spanning_forest(density.near_edges(none, ["fov"], 1.0)).collect() == []


def test_all_points_in_one_cell(spark):
    """Equal pairs, and shares of the cell are dealt over the tasks."""
    from pyspark.sql import functions as F

    from spotweave.operators.proximity import near_pairs

    r = random.Random(6)
    rows = [(i, i % 2, *(r.random() for _ in range(3))) for i in range(1200)] + [(5000 + i, 0, 50.0 + 7 * i, 0.0, 0.0) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    pairs = lambda most: near_pairs(df, df, ["fov"], 5.0, ["roi_id"], where=F.col("roi_id_1") < F.col("roi_id_2"), most=most)
    ids = ["roi_id_1", "roi_id_2", "distance"]
    dealt = pairs(40).select(*ids)
    assert dealt.exceptAll(pairs(10_000).select(*ids)).isEmpty() and dealt.count() == pairs(10_000).count() == 2 * 600 * 599 // 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = sorted(t["count"] for t in pairs(40).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]


@pytest.mark.parametrize("share", [3, 4096])
def test_components_of_clumps(spark, share):
    """Clumps whose gaps lie about the reach, lone points, and points of no known place or group."""
    r = random.Random(9)
    rows = [(100 * k + i, 0, 10.0 * k + r.uniform(0, 6.2), r.uniform(0, 3), r.uniform(0, 3)) for k in range(8) for i in range(40)] + [(2000 + i, i % 2, 200.0 + 3.9 * i, 0.0, 0.0) for i in range(20)]
    edges = near(rows, 4.0)
    name, _ = joined([p[0] for p in rows], edges)
    odd = [(3000, 0, None, 0.0, 0.0), (3001, None, 0.0, 0.0, 0.0), (3002, None, 0.0, 0.0, 0.0), (3003, 0, float("nan"), 0.0, 0.0), (3004, 0, float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = density.near_components(df, ["fov"], 4.0, share=share).collect()
    assert {x.node: x.component for x in got} == {**name, **{p[0]: p[0] for p in odd}} and len(got) == len(rows + odd) and len(set(name.values())) > 3
    assert {x.roi_id: x.cluster for x in density.linked_below(df, ["fov"], 4.0).collect()} == {x.node: x.component for x in got}


def test_near_pairs_are_not_listed(spark, monkeypatch):
    """What is staged grows with the points, though all pairs are near."""
    from spotweave.operators import components

    r, held = random.Random(4), []
    df = spark.createDataFrame([(i, 0, r.random(), r.random(), r.random()) for i in range(400)], SCHEMA)
    for module in (density, components):
        monkeypatch.setattr(module, "stage", lambda df, name, stage=module.stage: held.append(stage(df, name)) or held[-1])
    got = density.density_clusters(df, ["fov"], 4.0, 4).collect()
    assert {(x.cluster, x.core) for x in got} == {(0, True)} and max(h.count() for h in held) <= 400


def test_pairs_of_large_groups_are_dealt_out(spark):
    from spotweave.operators.proximity import group_pairs

    df = spark.createDataFrame(points_of(7, 120, 9) + [(200_000, None, 0.0, 0.0, 0.0)], SCHEMA)
    pairs = lambda most: group_pairs(df, ["fov"], "roi_id", [], most=most)
    dealt, plain = pairs(10), pairs(None)
    assert dealt.columns == plain.columns and dealt.rdd.getNumPartitions() >= 8
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
