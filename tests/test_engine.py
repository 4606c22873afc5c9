"""The relational operators against their SQL oracles and hand-made cases."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from spotweave.operators import beads, merging, naming, proximity, qc, traces, tracing
from spotweave.operators.components import connected_components
from spotweave.operators.geometry import crop
from spotweave.plans import catalogue, registry

TABLES = "lineitem events embeddings".split()


def norm(v):
    if isinstance(v, float):
        return f"{v:.5g}"
    return "~" if v is None else str(int(v)) if isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_its_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, sf)
    want = con.sql(catalogue.ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    place = [want.columns.index(c) for c in cols]
    assert sorted(tuple(norm(r[c]) for c in cols) for r in got.collect()) == sorted(tuple(norm(r[i]) for i in place) for r in want.fetchall())


def test_components_of_chains_rings_and_singletons(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, 200: 200}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


POINTS = [(0, -1.0, 1.0, 2.0), (1, 0.0, 5.0, 1.0), (2, 2.0, 0.0, 3.0)]


def test_pair_distances(spark):
    df = spark.createDataFrame([(7, *p) for p in POINTS], "g int, i int, zc double, yc double, xc double")
    got = {(r.i_1, r.i_2): r.distance for r in proximity.group_pairs(df, ["g"], "i", []).collect()}
    assert got == pytest.approx({(0, 1): math.sqrt(18), (0, 2): math.sqrt(11), (1, 2): math.sqrt(33)})


def rois(spark, rows):
    return spark.createDataFrame(rows, "roi_id long, fov int, timepoint int, channel int, zc double, yc double, xc double")


@pytest.mark.parametrize("threshold", [0.0, 1.0, 2.5, 7.0, 30.0])
def test_bucketed_proximity_equals_all_pairs(spark, threshold):
    df = rois(spark, [(i, 0, 0, 0, (i * 37 % 11) - 5.0, (i * 53 % 13) - 6.0, (i * 17 % 7) - 3.0) for i in range(60)])
    scale = (3.0, 1.0, 0.5)
    near = proximity.near_pairs(df, df, ["fov"], threshold, ["roi_id"], scale, F.col("roi_id_1") < F.col("roi_id_2"))
    plain = proximity.group_pairs(df, ["fov"], "roi_id", [], scale).where(F.col("distance") < threshold)
    key = lambda d: {(r.roi_id_1, r.roi_id_2) for r in d.collect()}
    assert key(near) == key(plain)


def test_square_merges_to_one(spark):
    rows = [(i, 0, 0, 0, 0.0, float(y), float(x)) for i, (y, x) in {0: (50, 50), 1: (0, 0), 2: (0, 1), 3: (1, 0), 4: (1, 1), 5: (90, 90)}.items()]
    df = rois(spark, rows)
    for a in "zyx":
        df = df.withColumn(f"{a}_min", F.col(f"{a}c") - 1).withColumn(f"{a}_max", F.col(f"{a}c") + 1)
    _, out = merging.merge_rois(proximity.assess_merge(df, 1.2, (1.0, 1.0, 1.0)), validate=True)
    merged = out.where("size(merge_partners) > 0").collect()
    assert [(r.roi_id, r.merge_partners, r.yc, r.xc) for r in merged] == [(6, [1, 2, 3, 4], 0.5, 0.5)]


def test_exclusion_discards_both(spark):
    df = rois(spark, [(0, 0, 0, 0, 0.0, 0.0, 0.0), (1, 0, 1, 0, 0.0, 0.0, 0.5), (2, 0, 1, 0, 0.0, 0.0, 9.0)])
    keep, gone = proximity.mutual_exclusion(df, "prohibition", 1.0, (1.0, 1.0, 1.0))
    assert [r.roi_id for r in keep.collect()] == [2]
    assert {r.roi_id: r.too_close for r in gone.collect()} == {0: [1], 1: [0]}


CASES = [("disjunctive", False, {0, 1, 2, 6}, {3, 4, 5}), ("conjunctive", False, {6}, {3, 4, 5}), ("lackadaisical", True, {0, 1, 2}, {3, 4, 5}), ("disjunctive", True, {0, 1}, {3, 4, 5})]


@pytest.mark.parametrize(("requirement", "discard", "kept", "skipped"), CASES)
def test_trace_assignment(spark, requirement, discard, kept, skipped):
    at = lambda x: (0.0, 0.0, float(x))
    rows = [(0, 0, 0, 0, *at(0)), (1, 0, 1, 0, *at(1)), (2, 0, 2, 0, *at(50)), (3, 1, 0, 0, *at(0)), (4, 1, 0, 0, *at(1)), (5, 1, 1, 0, *at(0.5)), (6, 2, 9, 0, *at(0))]
    kept = {k for k in kept if not (k == 2 and requirement != "lackadaisical")}
    out, skip = traces.assign_traces(rois(spark, rows), {"A": [0, 1, 2]}, 2.0, requirement, discard, (1.0, 1.0, 1.0))
    found = out.collect()
    assert {r.roi_id for r in found} == kept
    assert {r.roi_id for r in skip.collect()} == skipped
    assert not {r.trace_id for r in found} & set(range(7))
    assert traces.assign_without_rules(rois(spark, rows)).agg(F.min("trace_id"), F.max("trace_id")).first() == (7, 13)


CROPS = [((10.0, 20.0, 0, 0), (10, 20, 0, 0)), ((10.0, 20.0, 15, 0), (0, 5, 5, 0)), ((10.0, 20.0, -85, 0), (95, 100, 0, 5)), ((10.0, 20.0, -95, 0), (100, 100, 10, 0)), ((10.0, 20.0, 30, 0), (0, 0, 0, 10))]


@pytest.mark.parametrize(("given", "want"), CROPS)
def test_crop_cases(spark, given, want):
    df = spark.createDataFrame([given], "lo double, hi double, d int, r int")
    row = df.select(*[c.alias(k) for k, c in crop(F.col("lo"), F.col("hi"), F.col("d"), F.col("r"), 100).items()]).first()
    assert tuple(row) == want


def test_qc_edges_are_strict(spark):
    base = {"ref_dist": 1.0, "signal": 10.0, "background": 1.0, "sigma_xy": 2.0, "sigma_z": 2.0, "z": 5.0, "y": 5.0, "x": 5.0, "box_z": 10.0, "box_y": 10.0, "box_x": 10.0}
    changes = [{}, {"ref_dist": 800.0}, {"signal": 2.0}, {"sigma_xy": -1.0}, {"sigma_z": 400.0}, {"z": 2.0}, {"x": 8.0}]
    df = spark.createDataFrame([{**base, **c, "k": i} for i, c in enumerate(changes)])
    got = {r.k: (r.qc_pass, r.codes) for r in qc.label_qc(df, **registry.LIMITS).select("k", "qc_pass", qc.fail_codes().alias("codes")).collect()}
    assert got == {0: (1, ""), 1: (0, "R"), 2: (0, "S"), 3: (0, "xy"), 4: (0, "z O"), 5: (0, "O"), 6: (0, "O")}


def test_names(spark):
    df = spark.createDataFrame([("P0001.zarr", "1 3 2", "a_Time00007_b"), ("P0000", "1 1", "x"), ("Q1", "", "Time00001_Time00002")], "f string, s string, t string")
    rows = df.select(naming.fov_index(F.col("f")).alias("f"), naming.int_set(F.col("s")).alias("s"), naming.timepoint_in_name(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(0, [1, 2, 3], 7), (None, None, None), (None, [], None)]


def test_validated_pairing_fails_on_unequal_counts(spark):
    a = spark.createDataFrame([(0, 1, 1, 1), (0, 1, 1, 2)], "fov int, trace_id int, roi_id int, timepoint int")
    with pytest.raises(ValueError, match="differ"):
        tracing.pair_rois_fits(a, a.limit(1).withColumn("A", F.lit(1.0)), validate=True)


def test_bead_codes_and_partition(spark):
    df = spark.createDataFrame([(i, 0, 0, 1.0 if i == 0 else 9.0, 9.0, 9.0, 5.0, 100.0 if i != 1 else 1.0) for i in range(20)], "bead_id int, fov int, timepoint int, zc double, yc double, xc double, area double, max_intensity double")
    coded = df.withColumn("fail_code", beads.bead_fail_code((4, 4, 4), 10.0, 50.0))
    assert [r.fail_code for r in coded.orderBy("bead_id").limit(3).collect()] == ["z", "i", ""]
    parts = beads.partition_beads(coded.where(beads.passes()), 10, 5).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"shifting": 10, "accuracy": 5, None: 3}
