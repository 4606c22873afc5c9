"""Programs from files to files, and the checks of parameters."""

import csv
import glob
import json

import pytest

from spotweave.plans import parameters, programs
from spotweave.plans.configuration import ConfigurationError

PIXELS = '{"z": 1, "y": 1, "x": 1}'
HEAD = "index,fieldOfView,timepoint,spotChannel,zc,yc,xc,zMin,zMax,yMin,yMax,xMin,xMax"
ROUNDS = {
    "imagingRounds": [{"time": 0, "probe": "a"}, {"time": 1, "probe": "b"}, {"time": 2, "probe": "R1", "isRegional": True}, {"time": 3, "probe": "R2", "isRegional": True}, {"time": 4, "name": "blank", "isBlank": True}],
    "proximityFilterStrategy": {"semantic": "UniversalProximityProhibition", "minimumSeparation": "2 nm"},
    "locusGrouping": {"2": [0], "3": [1]},
    "tracingExclusions": [4],
    "mergeRulesForTracing": {"groups": {"A": [2, 3]}, "distanceThreshold": "3 nm", "requirementType": "Disjunctive", "discardRoisNotInGroupsOfInterest": False},
}


def roi(i, fov, time, x):
    return f"{i},P{fov:04d}.zarr,{time},0,0,0,{x},-1,1,-1,1,{x - 1},{x + 1}"


@pytest.fixture()
def files(tmp_path):
    def put(name, lines):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    put("rounds.json", [json.dumps(ROUNDS)])
    put("rois.csv", [HEAD, roi(0, 1, 2, 0), roi(1, 1, 3, 1), roi(2, 1, 2, 9), roi(3, 1, 3, 20), roi(4, 2, 2, 0), roi(5, 2, 2, 0.5)])
    put("drift.csv", ["fieldOfView,timepoint,zDriftCoarsePixels,zDriftFinePixels,yDriftCoarsePixels,yDriftFinePixels,xDriftCoarsePixels,xDriftFinePixels"] + [f"P{f:04d}.zarr,{t},0,0,0,0,0,0" for f in (1, 2) for t in range(5)])
    return tmp_path, put


def rows(path):
    return [r for f in sorted(glob.glob(f"{path}/**/*.csv", recursive=True)) for r in csv.DictReader(open(f))]


def test_merge_programs(spark, files):
    base, _ = files
    programs.determine_roi_merge(spark, input_file=f"{base}/rois.csv", output_file=f"{base}/assessed.csv", pixels=PIXELS, distance_threshold="1")
    assert {r["index"]: r["mergePartners"] for r in rows(f"{base}/assessed.csv") if r["mergePartners"]} == {"4": "5", "5": "4"}
    programs.merge_rois(spark, input_file=f"{base}/assessed.csv", contributors_file=f"{base}/parts.csv", results_file=f"{base}/merged.csv")
    merged = rows(f"{base}/merged.csv")
    assert [r["index"] for r in merged] == ["0", "1", "2", "3", "6"] and merged[-1]["mergePartners"] == "4 5" and float(merged[-1]["xc"]) == 0.25
    assert {r["index"]: r["merge_output"] for r in rows(f"{base}/parts.csv")} == {"4": "6", "5": "6"}
    with pytest.raises(ValueError, match="replace the input"):
        programs.determine_roi_merge(spark, input_file=f"{base}/rois.csv", output_file=f"{base}/x/../rois.csv", pixels=PIXELS, distance_threshold="1")


def test_proximity_and_trace_programs(spark, files):
    base, put = files
    how = {"configuration": f"{base}/rounds.json", "spots_file": f"{base}/rois.csv", "pixels": PIXELS, "discards_file": f"{base}/gone.csv", "keepers_file": f"{base}/kept.csv"}
    programs.filter_rois_by_proximity(spark, drift_file=f"{base}/drift.csv", **how)
    assert {r["index"] for r in rows(f"{base}/kept.csv")} == {"2", "3", "4", "5"}
    assert {r["index"]: r["tooCloseRois"] for r in rows(f"{base}/gone.csv")} == {"0": "1", "1": "0"}
    short = put("short.csv", ["fieldOfView,timepoint,zDriftCoarsePixels,zDriftFinePixels,yDriftCoarsePixels,yDriftFinePixels,xDriftCoarsePixels,xDriftFinePixels", "P0001,2,0,0,0,0,0,0"])
    with pytest.raises(ValueError, match="no drift"):
        programs.filter_rois_by_proximity(spark, drift_file=short, overwrite=True, **how)
    programs.assign_trace_ids(spark, configuration=f"{base}/rounds.json", rois_file=f"{base}/rois.csv", pixels=PIXELS, output_file=f"{base}/traces.csv", skips_file=f"{base}/skips.json")
    assert json.load(open(f"{base}/skips.json")) == []
    found = rows(f"{base}/traces.csv")
    assert [(r["index"], r["traceId"], r["traceGroup"], r["tracePartners"], r["hasAllPartners"]) for r in found] == [("0", "6", "A", "1", "1"), ("1", "6", "A", "0", "1")]


def test_bead_programs(spark, files):
    base, put = files
    put("spots/P0001_rois.csv", [HEAD, roi(0, 1, 2, 0), roi(1, 1, 3, 30)])
    put("beads/bead_rois__0_4.csv", ["beadIndex,zc,yc,xc", "0,0,0,29", "1,0,0,90"])
    programs.filter_spots_by_beads(spark, spots_folder=f"{base}/spots", beads_folder=f"{base}/beads", drift_file=f"{base}/drift.csv", output_file=f"{base}/out.csv", distance_threshold="2", spotless_timepoint="4", pixels=PIXELS)
    assert [r["index"] for r in rows(f"{base}/out.csv")] == ["0"]
    for time, n in ((1, 25), (2, 9)):
        put(f"filtered/bead_rois__0_{time}.filtered.csv", ["beadIndex,zc,yc,xc", *[f"{i},0,0,{i}" for i in range(n)]])
    programs.partition_beads(spark, beads_folder=f"{base}/filtered", num_shifting="10", num_accuracy="10", output_folder=f"{base}/parts")
    assert {r["timepoint"]: (r["outcome"], r["shifting"], r["accuracy"]) for r in rows(f"{base}/parts/outcomes.csv")} == {"1": ("full", "10", "10"), "2": ("severe", "0", "0")}
    assert [f.rsplit("/", 1)[-1] for f in glob.glob(f"{base}/parts/shifting/*.json")] == ["bead_rois__0_1.json"]
    beads = json.load(open(f"{base}/parts/shifting/bead_rois__0_1.json"))
    assert len({b["index"] for b in beads}) == 10 and set(beads[0]["centroid"]) == {"zc", "yc", "xc"}


def test_folders_of_many_files(spark, files, monkeypatch):
    """The plan does not grow with the number of files."""
    base, put = files
    plans = {}
    monkeypatch.setattr(programs, "write", lambda df, *a: plans.__setitem__(n, df))
    for n in (2, 400):
        for i in range(n):
            put(f"spots{n}/P{i + 1:04d}_rois.csv", [HEAD, roi(i, i + 1, 2, 0)])
            put(f"beads{n}/bead_rois__{i}_4.csv", ["beadIndex,zc,yc,xc", f"0,0,0,{1 if i % 2 else 90}"])
        drift = put(f"drift{n}.csv", ["fieldOfView,timepoint,zDriftCoarsePixels,zDriftFinePixels,yDriftCoarsePixels,yDriftFinePixels,xDriftCoarsePixels,xDriftFinePixels"] + [f"P{f + 1:04d}.zarr,{t},0,0,0,0,0,0" for f in range(n) for t in range(5)])
        programs.filter_spots_by_beads(spark, spots_folder=f"{base}/spots{n}", beads_folder=f"{base}/beads{n}", drift_file=drift, output_file=f"{base}/o.csv", distance_threshold="2", spotless_timepoint="4", pixels=PIXELS)
    assert plans[400].count() == 200
    size = lambda df: len(df._jdf.queryExecution().analyzed().toString().splitlines())
    assert size(plans[2]) == size(plans[400])


def test_spots_by_field(spark, files):
    base, put = files
    programs.partition_regional_spots(spark, spots_files=f"{base}/rois.csv", output_folder=f"{base}/by")
    for fov, ids in (("P0001", ["0", "1", "2", "3"]), ("P0002", ["4", "5"])):
        found = list(csv.DictReader(open(f"{base}/by/{fov}/{fov}__rois.csv")))
        assert [r["index"] for r in found] == ids and [r["Unnamed: 0"] for r in found] == [str(i) for i in range(len(ids))]
    with pytest.raises(ValueError, match="files exist"):
        programs.partition_regional_spots(spark, spots_files=f"{base}/rois.csv", output_folder=f"{base}/by")
    assert not glob.glob(f"{base}/by/_writing*")


def test_skips_as_records(spark, files):
    base, put = files
    rules = {**ROUNDS, "mergeRulesForTracing": {"groups": {"A": [2, 3]}, "distanceThreshold": "3 nm", "requirementType": "Lackadaisical", "discardRoisNotInGroupsOfInterest": False}}
    rois = [roi(0, 1, 2, 0), roi(1, 1, 3, 1), roi(2, 1, 2, 2), roi(3, 1, 3, 50)]
    put("r.csv", [HEAD, *rois])
    put("one.json", [json.dumps(rules)])
    programs.assign_trace_ids(spark, configuration=f"{base}/one.json", rois_file=f"{base}/r.csv", pixels=PIXELS, output_file=f"{base}/t.csv", skips_file=f"{base}/s.json")
    assert json.load(open(f"{base}/s.json")) == [{"roiIds": [0, 1, 2], "repeats": {"2": [0, 2]}}]
    assert [(r["index"], r["traceGroup"]) for r in rows(f"{base}/t.csv")] == [("3", "A")]


def test_distance_programs(spark, files):
    base, put = files
    programs.region_pairwise_distances(spark, rois_file=f"{base}/rois.csv", output_folder=f"{base}/d", pixels=PIXELS, drift_file=f"{base}/drift.csv")
    found = [(r["fieldOfView"], r["timepoint1"], r["timepoint2"], float(r["distance"]), r["inputIndex1"], r["inputIndex2"]) for r in rows(f"{base}/d/pairwise_distances__regional.csv")]
    assert found == sorted(found, key=lambda r: r[:4]) and len(found) == 7 and found[-1][3:] == (0.5, "4", "5")
    put("turned.csv", [HEAD, roi(7, 1, 2, 0), roi(3, 1, 3, 4)])  # ids in no order
    programs.region_pairwise_distances(spark, rois_file=f"{base}/turned.csv", output_folder=f"{base}/turned", pixels=PIXELS)
    assert [(r["timepoint1"], r["timepoint2"], r["inputIndex1"], r["inputIndex2"]) for r in rows(f"{base}/turned/pairwise_distances__regional.csv")] == [("2", "3", "0", "1")]
    table = put("points.csv", ["fieldOfView,traceGroup,traceId,timepoint,ref_timepoint,z,y,x", "P0001.zarr,,7,0,2,0,0,0", "P0001.zarr,,7,1,2,3,0,4", "P0001.zarr,,8,0,2,0,0,0"])
    programs.locus_pairwise_distances(spark, traces_file=table, output_folder=f"{base}/d")
    assert [(r["traceId"], r["locus1"], r["locus2"], r["distance"]) for r in rows(f"{base}/d/pairwise_distances__locus_specific.csv")] == [("7", "0", "1", "5.0")]
    twice = put("twice.csv", ["fieldOfView,traceGroup,traceId,timepoint,ref_timepoint,z,y,x", "P0001,,7,0,2,0,0,0", "P0001,,7,0,2,3,0,4"])
    with pytest.raises(ValueError, match="repeated timepoint"):
        programs.locus_pairwise_distances(spark, traces_file=twice, output_folder=f"{base}/e")


def test_quality_program(spark, files):
    base, put = files
    head = "fieldOfView,traceGroup,traceId,timepoint,ref_timepoint,z,y,x,ref_dist,A,BG,sigma_xy,sigma_z,spot_box_z,spot_box_y,spot_box_x,z_px,y_px,x_px"
    good = "100,100,100,5,10,1,20,20,4800,3400,3400,4,4,4"
    put("t.csv", [head, f"P0001.zarr,,9,0,2,{good}", f"P0001.zarr,,9,2,2,{good}", f"P0001.zarr,,12,0,2,{good.replace('5,10,1', '5,1,1')}", f"P0001.zarr,A,13,1,3,{good.replace('4,4,4', '4,4,40')}"])
    programs.label_and_filter_locus_spots(spark, configuration=f"{base}/rounds.json", traces_file=f"{base}/t.csv", points_folder=f"{base}/points", output_prefix=f"{base}/q", roi_pixels='{"z": 16, "y": 32, "x": 32}', max_distance="800", min_snr="2", max_sigma_xy="150", max_sigma_z="400", min_trace_length="2")
    every = rows(f"{base}/q.unfiltered.csv")
    assert [(r["traceId"], r["timepoint"], r["sufficientSNR"], r["qcPass"]) for r in every] == [("9", "0", "1", "1"), ("9", "2", "1", "1"), ("12", "0", "0", "0"), ("13", "1", "1", "1")]
    assert [(r["traceId"], r["timepoint"]) for r in rows(f"{base}/q.filtered.csv")] == [("9", "0"), ("9", "2")]
    passing = list(csv.DictReader(open(f"{base}/points/P0001__/P0001__.qcpass.csv")))
    assert sorted((r["traceId"], r["traceIndex"], r["regionIndex"], r["timeIndex"]) for r in passing) == [("9", "0", "0", "0"), ("9", "0", "0", "1")]
    assert [(r["traceId"], r["traceIndex"], r["failCode"]) for r in csv.DictReader(open(f"{base}/points/P0001__/P0001__.qcfail.csv"))] == [("12", "1", "S")]
    assert sorted(f.rsplit("/", 1)[-1] for f in glob.glob(f"{base}/points/*")) == ["P0001__"]


def test_small_programs(spark, files):
    base, put = files
    put("a/x_Time00000_Point0001.nd2", [""])
    put("b/x_Time00000_Point0001.nd2", [""])
    moves = programs.combine_imaging_folders(spark, inputs=f"{base}/a,{base}/b", target_folder=f"{base}/c", script_file=f"{base}/script")
    assert [b.rsplit("/", 1)[-1] for _, b in moves] == ["x_Time00000_Point0001.nd2", "x_Time00001_Point0001.nd2"]
    assert programs.validate_configuration(spark, configuration=f"{base}/rounds.json")["rounds"] == 5
    put("g.csv", [HEAD + ",mergeOutput", *[r + g for r, g in ((roi(0, 1, 2, 0), ",7"), (roi(1, 1, 2, 50), ",7"), (roi(2, 1, 2, 80), ","), (roi(3, 1, 2, 80.5), ","))]])
    assert programs.validate_merges(spark, input_file=f"{base}/g.csv", pixels=PIXELS, distance_threshold="2") == {"split_groups": 1, "close_pairs": 1}
    assert programs.main([]) == 2 and len(programs.PROGRAMS) == 18


GOOD = {
    "zarr_conversions": {"a": "b"}, "decon_input_name": "x", "decon_output_name": "y", "require_gpu": True, "nuc_method": "cellpose", "detection_method": "dog",
    "distanceBeneathWhichSpotRoisWillMerge": "500 nm", "max_dist": "800 nm", "proximityFiltrationBetweenBeadsAndSpots": 4,
}


def test_parameters():
    assert parameters.parameter_faults(GOOD, ROUNDS) == []
    bad = {**GOOD, "require_gpu": False, "subtract_crosstalk": 1, "detection_method": "intensity", "max_dist": 800, "dc_method": "best", "proximityFiltrationBetweenBeadsAndSpots": 2}
    faults = parameters.parameter_faults(bad, ROUNDS)
    assert len(faults) == 6 and any("crosstalk" in f for f in faults)
    with pytest.raises(ConfigurationError):
        parameters.precheck({}, ROUNDS)


def test_yaml():
    text = "# run\na: 1\nb: [8, 16, 16]\nc:\n  x: 'y z'\n  d: 2.5\ne:\n- one\n- 2\nf: true\ng:\n"
    assert parameters.read_yaml(text) == {"a": 1, "b": [8, 16, 16], "c": {"x": "y z", "d": 2.5}, "e": ["one", 2], "f": True, "g": None}
    for bad in ("a: |\n  x\n", "a: 1\na: 2\n", "just text\n", "a: &x 1\n"):
        with pytest.raises(ValueError):
            parameters.read_yaml(bad)
    assert parameters.merged('{"imagingRounds": []}', "a: 1")["a"] == 1
    with pytest.raises(ConfigurationError):
        parameters.merged('{"a": 1}', "a: 1")


def test_trace_groups_and_signals():
    assert parameters.trace_groups({"A": [1, 2], "B": [4, 5]})["B"] == {4, 5}
    for bad in ({}, {"A": [1]}, {"A": [1, 1]}, {"A": [1, 2], "B": [2, 3]}, {"": [1, 2]}, {"A": "x"}):
        with pytest.raises(ConfigurationError):
            parameters.trace_groups(bad)
    assert parameters.signal_specification({"roiType": "Regional", "roiDiameterInPixels": 10, "channels": [0, 1]}).channels == {0, 1}
    with pytest.raises(ConfigurationError) as x:
        parameters.signal_specification({"roiType": "Other", "roiDiameterInPixels": 0, "channels": [1, 1]})
    assert len(x.value.faults) == 3
