"""Alignment and clusters of traces, ranks and similarity on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.functions import kernels
from spotweave.operators import clustering, naming, ranks, similarity, tracing, voxels

def traces(spark, turn=0.6, noise=0.0):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(9, 3)) * 10
    rows = []
    for i in range(5):
        c, s = np.cos(turn * i), np.sin(turn * i)
        p = base @ np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]) + i + noise * rng.normal(size=(9, 3))
        rows.append((i, *p.T.tolist(), [j != i for j in range(9)]))
    return spark.createDataFrame(rows, "trace_id long, z array<double>, y array<double>, x array<double>, good array<boolean>")


def test_alignment_of_turned_traces(spark):
    t = traces(spark)
    pairs = clustering.aligned_pairs(t).collect()
    assert len(pairs) == 10 and max(r.aligned_distance for r in pairs) < 1e-6 and max(abs(r.aligned_pcc) for r in pairs) < 1e-9
    moved, mean = clustering.general_procrustes(t)
    assert moved.agg(F.max("distance")).first()[0] < 1e-3 and len(mean) == 9 and all(v is not None for p in mean for v in p)
    assert clustering.aligned_pairs(t.limit(2), t.limit(3)).count() == 6
    assert clustering.general_procrustes(t.limit(0))[1] == []


@pytest.mark.parametrize("method", ["kmeans", "bisecting", "mixture"])
def test_clusters_tell_two_shapes(spark, method):
    rng = np.random.default_rng(2)
    rows = [(i, a, b, float((10 if i % 2 else 100) * (b - a) + rng.normal())) for i in range(20) for a in range(3) for b in range(a + 1, 3)]
    maps = spark.createDataFrame(rows, "trace_id long, locus_1 int, locus_2 int, distance double")
    got = {r.trace_id: r.cluster for r in clustering.clusters(maps, 2, method).collect()}
    assert len(got) == 20 and set(got.values()) <= {0, 1}
    if method != "mixture":  # its start is drawn, and may end in another optimum on so few rows
        assert len({got[i] for i in range(0, 20, 2)}) == 1 and {got[0], got[1]} == {0, 1}
    with pytest.raises(ValueError):
        clustering.clusters(maps, 2, "other")


def test_map_similarity_of_two_sets(spark):
    maps = spark.createDataFrame([(0, 0, 1, 1.0), (0, 0, 2, 2.0), (1, 0, 1, 1.0), (1, 0, 2, 4.0), (2, 0, 1, 5.0)], "trace_id long, locus_1 int, locus_2 int, distance double")
    rows = {(r.trace_1, r.trace_2): r for r in similarity.compare_maps(maps).collect()}
    assert set(rows) == {(0, 1), (0, 2), (1, 2)} and rows[0, 1].map_distance == 2.0 and rows[0, 1].pcc == pytest.approx(1.0) and rows[0, 1].contact_distance == 0.0
    assert similarity.compare_maps(maps.where("trace_id = 0"), maps.where("trace_id > 0")).count() == 2


def test_ranks_report_what_no_rule_names(spark):
    df = spark.createDataFrame([("A", 3, 1), (None, 4, 0)], "trace_group string, ref_timepoint int, timepoint int")
    assert [r.region_index for r in ranks.rank_in_trace_group(df, {"A": [5, 3]}).orderBy("ref_timepoint").collect()] == [0, 0]
    with pytest.raises(ValueError, match="no rule names"):
        ranks.rank_in_trace_group(df, {"A": [5, 6]})
    with pytest.raises(ValueError, match="outside its region"):
        ranks.rank_in_region(df, {3: [1], 4: [2]}, [])
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    assert ranks.numbered_rows(many, ["v"]).where("v <> row_number").count() == 0


def test_names_and_json(spark):
    df = spark.createDataFrame([("P0001__A", '{"a":1}', '{"b":"x\\"y"}', "P0001_00012_3__7"), ("none", "{}", "{}", "bad")], "key string, p string, q string, name string")
    rows = df.select(*[c.alias(k) for k, c in naming.viewing_parts(F.col("key")).items()], naming.combined_json(F.col("p"), F.col("q")).alias("j"), voxels.stack_key(F.col("name"))["roi_id"].alias("roi"), voxels.stack_key(F.col("name"))["trace_group"].alias("g")).collect()
    assert [tuple(r) for r in rows] == [("P0001", "A", '{"a":1,"b":"x\\"y"}', 12, None), (None, None, "{}", None, None)]
    with pytest.raises(Exception, match="JSON keys repeat"):
        df.select(naming.combined_json(F.col("p"), F.col("p"))).collect()


def test_drift_accuracy_without_reference(spark):
    fits = spark.createDataFrame([(1, 0.0, 0.0, 3.0, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], "k int, z double, y double, x double, z_fine double, y_fine double, x_fine double")
    rows = tracing.drift_accuracy(fits, fits.where("k = 1"), ["k"]).orderBy("k").collect()
    assert rows[0].error == 1.0 and rows[1].error is None


def test_splines_pass_through_their_points(spark):
    from spotweave.functions.kernels import spline_basis, spline_through
    from spotweave.operators.pixels import interpolated

    rng = np.random.default_rng(3)
    p = np.cumsum(rng.normal(size=(8, 3)), axis=0)
    u = np.concatenate([[0.0], np.cumsum(np.linalg.norm(np.diff(p, axis=0), axis=1))])
    fine = spline_through(p, 20001)
    at = np.linspace(0, 1, 20001)
    for point, place in zip(p, u / u[-1], strict=True):
        assert np.linalg.norm(fine[np.abs(at - place).argmin()] - point) < 1e-2
    knots = np.array([0, 0, 0, 0.4, 0.7, 1, 1, 1.0])
    assert np.allclose(spline_basis(knots, 2, np.linspace(0, 1, 50)).sum(axis=1), 1)
    line = np.array([[0.0, 0, 0], [1, 2, 3]])
    assert np.allclose(spline_through(line, 3)[1], [0.5, 1, 1.5]) and spline_through(line[:1], 2).shape == (2, 3)
    straight = np.outer(np.array([0, 1, 2.5, 4, 7]), [1.0, 2, 2])
    assert np.allclose(spline_through(straight, 11)[5], straight[-1] / 2)
    out = interpolated(traces(spark), 7).collect()
    assert all(len(r.z) == 7 for r in out)
    none = traces(spark).withColumn("good", F.transform("good", lambda g: F.lit(False)))
    assert interpolated(none, 7).where("z is null").count() == 5


def test_stack_grid_needs_one_size(spark):
    v = spark.createDataFrame([(1, 4, 0, [1.0, 2.0]), (2, 4, 1, [1.0])], "trace_id long, ref_timepoint int, slot int, voxels array<double>")
    slots = spark.createDataFrame([(4, 0), (4, 1)], "ref_timepoint int, slot int")
    with pytest.raises(ValueError, match="differ"):
        voxels.stack_grid(v, ["trace_id"], slots)
    assert sorted((r.trace_id, r.slot, r.voxels) for r in voxels.stack_grid(v.limit(1), ["trace_id"], slots).collect()) == [(1, 0, [1.0, 2.0]), (1, 1, [0.0, 0.0])]


def test_quantiles_and_ranks_with_nulls(spark):
    from spotweave.operators.summaries import quantiles
    from spotweave.operators.traces import reindex

    rows = [(None, v) for v in (4.0, 1.0, None, 3.0)] + [("a", 7.0), ("b", None)] + [("c", float(v)) for v in range(101)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.lo, r.mid) for r in quantiles(df, ["k"], "v", {"lo": 0.25, "mid": 0.5}).collect()}
    assert got == {None: (2.0, 3.0), "a": (7.0, 7.0), "c": (25.0, 50.0)}
    ranked = reindex(spark.createDataFrame([(None, 5), (None, 9), (None, 5), ("a", 2)], "k string, t int"), ["k"], "t", "i").collect()
    assert sorted((r.k or "", r.t, r.i) for r in ranked) == [("", 5, 0), ("", 5, 0), ("", 9, 1), ("a", 2, 0)]


def test_turned_pieces_come_back_to_their_curve(spark):
    """Traces that are turned as wholes, with some points missing; and pieces that are turned one by one."""
    rng = np.random.default_rng(4)
    curve = np.cumsum(rng.normal(size=(11, 3)), axis=0) * 10

    def turn():
        q, r = np.linalg.qr(rng.normal(size=(3, 3)))
        q = q * np.sign(np.diag(r))
        return q * np.sign(np.linalg.det(q))

    rows = []
    for i in range(12):
        p, good = curve @ turn().T + rng.normal(size=3), rng.random(11) > (0.15 if i else 0)
        rows.append((i, *p.T.tolist(), good.tolist()))
    rows.append((99, [0.0] * 3, [0.0] * 3, [0.0] * 3, [True] * 3))  # shorter than a piece
    df = spark.createDataFrame(rows, "trace_id long, z array<double>, y array<double>, x array<double>, good array<boolean>")
    mean = np.array(clustering.piecewise_procrustes(df, tolerance=1e-9), float)
    assert mean.shape == (11, 3) and np.abs(kernels.rigid_onto(mean, curve) - curve).max() < 1e-6
    turned = [(curve[i : i + 5] @ turn().T + rng.normal(size=3), np.ones(5, bool)) for i in range(0, 7, 2)]
    back = np.array(clustering.stitched(turned, 5, 3), float)
    assert np.abs(kernels.rigid_onto(back, curve) - curve).max() < 1e-6
    assert clustering.piecewise_procrustes(df.where("false")) == []
    with pytest.raises(ValueError, match="overlap"):
        clustering.piecewise_procrustes(df, overlap=2)


def plain_comparison(rows):
    """Pearson correlation, rmse and count of every two maps, pair by pair."""
    maps = {}
    for t, a, b, d in rows:
        maps.setdefault(t, {})[a, b] = d
    for s in maps:
        for t in maps:
            both = [(maps[s][p], maps[t][p]) for p in maps[s] if p in maps[t]]
            known = [(a, b) for a, b in both if a is not None and b is not None]
            up = np.array([p for p in known if p[0] > 0 and p[1] > 0]).T
            if s < t and both:
                yield s, t, len(both), np.sqrt(np.mean([(a - b) ** 2 for a, b in known])) if known else None, np.corrcoef(up)[0, 1] if up.size > 2 and (up.std(1) > 0).all() else None


@pytest.mark.parametrize("tile", [7, 1 << 18])
def test_maps_meet_in_blocks_of_two(spark, monkeypatch, tile):
    """Unknown, absent and zero distances, maps all equal; and no pair of maps is shuffled."""
    monkeypatch.setattr(similarity, "TILE", tile)
    rng = np.random.default_rng(5)
    rows = [(i, a, b, None if rng.random() < 0.1 else 0.0 if rng.random() < 0.1 else 5.0 if i == 3 else float(rng.random() * 200)) for i in range(60) for a in range(4) for b in range(a + 1, 4) if rng.random() < 0.8]
    maps = spark.createDataFrame(rows, "trace_id long, locus_1 int, locus_2 int, distance double")
    got = {(r.trace_1, r.trace_2): r for r in similarity.compare_maps(maps).collect()}
    want = list(plain_comparison(rows))
    assert len(got) == len(want)
    for s, t, n, rmse, pcc in want:
        r = got[s, t]
        assert r.n == n and r.rmse == (None if rmse is None else pytest.approx(rmse)) and r.pcc == (None if pcc is None else pytest.approx(pcc, abs=1e-7))
    clusters = spark.createDataFrame([(i, i % 3 if i % 10 else None) for i in range(55)], "trace_id long, cluster int")
    slow = similarity.cluster_similarity(similarity.compare_maps(maps), clusters, "rmse").first()
    assert tuple(similarity.map_clusters_compared(maps, clusters, "rmse").first()) == pytest.approx(tuple(slow))
    assert tuple(similarity.map_clusters_compared(maps.where("false"), clusters, "rmse").first()) == (None, None)
    plan = similarity.compare_maps(maps)._jdf.queryExecution().optimizedPlan().toString()
    assert "trace_1" not in plan.split("FlatMapGroupsInArrow")[1].split("\n", 1)[1]


def test_numbered_rows_in_shares(spark):
    """Parts grow in number with the rows, and numbers are their order."""
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    found = ranks.numbered_rows(many, ["v"], "place", ordered=True, share=100)
    assert found.rdd.getNumPartitions() == 50 and [tuple(r) for r in found.collect()] == [(i, i) for i in range(5000)]
    assert ranks.numbered_rows(many.where("false"), ["v"], ordered=True).collect() == []


def test_traces_in_parts(spark, sf, monkeypatch):
    from spotweave.plans import adapters

    monkeypatch.setattr(adapters, "ROWS", 500)
    plan = adapters.trace(spark, sf)
    assert plan.rdd.getNumPartitions() == -(-adapters.read(spark, sf, "lineitem").count() // 500)


def test_rigid_motions_of_a_batch():
    rng = np.random.default_rng(8)
    points, target, good = rng.normal(size=(50, 6, 3)), rng.normal(size=(50, 6, 3)), rng.random((50, 6)) < 0.8
    good[:, :3], points[0, 5], good[0, 5] = True, np.nan, False
    moved = kernels.rigid_onto_all(points, target, good)
    for i in range(50):
        assert np.allclose(moved[i][good[i]], kernels.rigid_onto(points[i], target[i], good[i])[good[i]])


def test_a_piece_that_never_fits_takes_no_part(spark):
    """It was a fault of the second round."""
    df = traces(spark).select("trace_id", *"zyx", F.transform("good", lambda g, i: i < 7).alias("good"))
    mean = clustering.piecewise_procrustes(df, length=5, overlap=3, tolerance=0.0, max_rounds=3)
    assert mean[6][0] is not None and clustering.piecewise_procrustes(df.withColumn("good", F.transform("good", lambda g, i: i < 5)), tolerance=0.0, max_rounds=3)[4][0] is not None
