import json

import pytest

from spotweave.plans.configuration import ConfigurationError, bead_timepoint, length_nm, parse_configuration, read_configuration
from spotweave.sources import folders, tables


def good():
    return {
        "imagingRounds": [{"time": 0, "name": "pre", "isBlank": True}, {"time": 1, "probe": "a"}, {"time": 2, "probe": "b"}, {"time": 3, "probe": "a", "repeat": 1},
                          {"time": 4, "probe": "r1", "isRegional": True}, {"time": 5, "probe": "r2", "isRegional": True}],
        "locusGrouping": {"4": [1, 3], "5": [2]},
        "proximityFilterStrategy": {"semantic": "SelectiveProximityPermission", "minimumSeparation": "0.5 um", "groups": [[4], [5]]},
        "tracingExclusions": [0],
        "mergeRulesForTracing": {"groups": {"x": [4, 5]}, "distanceThreshold": 800, "requirementType": "Conjunctive", "discardRoisNotInGroupsOfInterest": False},
    }


def test_configuration(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(good(), indent=1))
    c = read_configuration(spark, str(tmp_path / "c.json"))
    assert [r.name for r in c.rounds] == ["pre", "a", "b", "a_repeat1", "r1", "r2"]
    assert c.proximity.minimum_separation == 500 and c.merge_rules.distance_threshold == 800
    assert {tuple(r) for r in c.grouping_table(spark).collect()} == {(4, 1), (4, 3), (5, 2)}
    assert {tuple(r) for r in c.merge_table(spark).collect()} == {(4, "x"), (5, "x")}
    assert c.proximity_table(spark).count() == 2 and c.rounds_table(spark).count() == 6 and c.summary()["locus"] == 3


@pytest.mark.parametrize(("key", "value", "fault"), [
    ("imagingRounds", [{"time": 1, "probe": "r", "isRegional": True}], "must be 0, 1"),
    ("locusGrouping", {"4": [1, 3]}, "neither"),
    ("locusGrouping", {"4": [1, 1, 3], "5": [2]}, "repeats"),
    ("proximityFilterStrategy", {"semantic": "UniversalProximityPermission", "groups": [[4]]}, "not allowed"),
    ("proximityFilterStrategy", {"semantic": "SelectiveProximityProhibition", "minimumSeparation": 1, "groups": [[4, 4]]}, "more than once"),
    ("tracingExclusions", [9], "no timepoints"),
    ("mergeRulesForTracing", {"groups": {"x": [4]}}, "fewer than two"),
])
def test_faults(key, value, fault):
    with pytest.raises(ConfigurationError, match=fault):
        parse_configuration({**good(), key: value})


def test_all_faults_are_reported_and_covering_can_be_waived():
    with pytest.raises(ConfigurationError) as e:
        parse_configuration({**good(), "tracingExclusions": [9], "locusGrouping": {"1": [2]}})
    assert len(e.value.faults) >= 3
    assert parse_configuration({**good(), "locusGrouping": {"4": [1], "5": [2]}, "checkLocusTimepointCovering": False})
    with pytest.raises(ValueError, match="positive"):
        length_nm(-1)


def test_tables(spark, tmp_path):
    (tmp_path / "t.csv").write_text(",fov,n,x\n0,P0001,1,0.5\n1,P0002,,\n")
    assert tables.read_strings(spark, f"{tmp_path}/t.csv").columns == ["fov", "n", "x"]
    got = tables.read_typed(spark, f"{tmp_path}/t.csv", "fov string, n int, x double")
    assert [tuple(r) for r in got.collect()] == [("P0001", 1, 0.5), ("P0002", None, None)]
    with pytest.raises(Exception, match="no int"):
        tables.read_typed(spark, f"{tmp_path}/t.csv", "x int").collect()
    with pytest.raises(ValueError, match="missing"):
        tables.read_typed(spark, f"{tmp_path}/t.csv", "y int")
    with pytest.raises(ValueError, match="replace"):
        tables.write_table(got, f"{tmp_path}/t.csv", source=f"{tmp_path}/t.csv")
    tables.write_table(got, f"{tmp_path}/o", by="fov")
    assert spark.read.option("header", True).csv(f"{tmp_path}/o").count() == 2
    (tmp_path / "empty.csv").write_text("")
    assert tables.read_typed(spark, f"{tmp_path}/empty.csv", "a int").count() == 0
    (tmp_path / "b.json").write_text(json.dumps([{"index": 3, "centroid": {"zc": 1.0, "yc": 2.0, "xc": 3.0}}]))
    assert tuple(tables.read_bead_points(spark, f"{tmp_path}/b.json").first())[:4] == (3, 1.0, 2.0, 3.0)


def test_folders(spark, tmp_path):
    for n in ("bead_rois__0_1.csv", "bead_rois__0_1.filtered.csv", "P0002_rois.csv", "other.csv"):
        (tmp_path / n).write_text("x\n")
    files = folders.listed(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in folders.bead_files(files).collect()] == [(0, 1)] == [tuple(r)[1:] for r in folders.bead_files(files, True).collect()]
    assert [r.fov for r in folders.spot_files(files).collect()] == [1]
    rows = [("p", f"P1_Time{t:05d}.nd2", f) for f, n in (("a", 2), ("b", 1)) for t in range(n)]
    moved = folders.combined(spark.createDataFrame(rows, "path string, name string, folder string"))
    assert sorted(r.new_name for r in moved.collect()) == [f"P1_Time{t:05d}.nd2" for t in range(3)]
    with pytest.raises(ValueError, match="gaps"):
        folders.combined(spark.createDataFrame([("p", "Time00001", "a")], "path string, name string, folder string"))


def test_bead_timepoint():
    rounds = parse_configuration(good()).rounds
    key = "proximityFiltrationBetweenBeadsAndSpots"
    assert bead_timepoint({key: 0}, rounds) == 0 == bead_timepoint({key: True, "subtract_background": 0}, rounds)
    for bad in ({}, {key: False}, {key: True}, {key: 4}, {key: 99}, {key: "0"}):
        with pytest.raises(ConfigurationError):
            bead_timepoint(bad, rounds)


def test_load_tables(spark, tmp_path):
    for n in ("run_rois.csv", "run_fits.tsv", "other.csv", "run_x.pkl"):
        (tmp_path / n).write_text("a\tb\n1\t2\n" if n.endswith("tsv") else "a,b\n1,2\n")
    got = folders.load_tables(spark, str(tmp_path), "run_")
    assert sorted(got) == ["fits", "rois"] and spark.sql("select b from fits").first().b == "2"
