"""Runs that are stopped and started again."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from spotweave.operators.detection import fine_drift
from spotweave.plans.process import STAGES, Run, Stage, by_partition, run_stages

HEAD = "index,fieldOfView,timepoint,spotChannel,zc,yc,xc,zMin,zMax,yMin,yMax,xMin,xMax"
ROUNDS = {
    "imagingRounds": [{"time": 0, "name": "blank", "isBlank": True}, {"time": 1, "probe": "b"}, {"time": 2, "probe": "R1", "isRegional": True}, {"time": 3, "probe": "R2", "isRegional": True}, {"time": 4, "probe": "c"}],
    "proximityFilterStrategy": {"semantic": "UniversalProximityProhibition", "minimumSeparation": "0.5 nm"},
    "locusGrouping": {"2": [1], "3": [4]},
    "mergeRulesForTracing": {"groups": {"A": [2, 3]}, "distanceThreshold": "3 nm", "requirementType": "Disjunctive", "discardRoisNotInGroupsOfInterest": False},
}


@pytest.fixture()
def folder(tmp_path):
    roi = lambda i, f, t, x: f"{i},P{f:04d}.zarr,{t},0,0,0,{x},-1,1,-1,1,{x - 1},{x + 1}"
    for name, lines in {
        "spots/P0001_rois.csv": [HEAD, roi(0, 1, 2, 0), roi(1, 1, 3, 2), roi(2, 1, 2, 60)],
        "spots/P0002_rois.csv": [HEAD, roi(3, 2, 2, 0), roi(4, 2, 2, 0.25), roi(5, 2, 3, 30)],
        **{f"beads/bead_rois__{f}_0{end}.csv": ["beadIndex,zc,yc,xc", *[f"{i},0,0,{60 + i}" for i in range(25)]] for f in (0, 1) for end in ("", ".filtered")},
        "drift.csv": ["fieldOfView,timepoint,zDriftCoarsePixels,zDriftFinePixels,yDriftCoarsePixels,yDriftFinePixels,xDriftCoarsePixels,xDriftFinePixels", *[f"P{f:04d}.zarr,{t},0,0,0,0,0,0" for f in (1, 2) for t in range(4)]],
        "rounds.json": [json.dumps(ROUNDS)],
    }.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    return tmp_path


def outputs(folder):
    found = {}
    for name in sorted(glob.glob(f"{folder}/**", recursive=True)):
        if name.endswith(".csv") and "/part-" in name or "/shown/" in name and name.endswith(".csv"):
            found.setdefault(name.removeprefix(str(folder)).split("/part-")[0], []).extend(csv.reader(open(name)))
    return {k: sorted(map(tuple, v)) for k, v in found.items()}


def test_a_run_goes_on_where_it_stopped(spark, folder):
    settings = {"configuration": f"{folder}/rounds.json", "pixels": '{"z": 1, "y": 1, "x": 1}', "num_shifting": "10", "num_accuracy": "10", "bead_distance": "5", "spotless_timepoint": "0", "merge_distance": "0.5"}
    run, names = Run(spark, str(folder), settings), [s.name for s in STAGES]
    assert run_stages(run, STAGES, stop="merge_rois") == names[:5]
    worked = []

    def watched(s):
        return Stage(s.name, lambda r: (worked.append(s.name), s.work(r))[1], s.uses)

    def broken(s):
        def fail(r):
            raise RuntimeError("stopped in the middle")

        return Stage(s.name, fail, s.uses) if s.name == "assign_trace_ids" else watched(s)

    with pytest.raises(RuntimeError, match="in the middle"):
        run_stages(run, [broken(s) for s in STAGES])
    assert worked == ["filter_rois_by_proximity"]
    assert run_stages(run, [watched(s) for s in STAGES]) == names[6:] and worked == names[5:]
    assert run_stages(run, [watched(s) for s in STAGES]) == [] and worked == names[5:]
    first = outputs(folder)
    traced = [r for k, v in first.items() if "rois.traced" in k and "shown" not in k for r in v]
    assert {r[0] for r in traced} == {"index", "0", "1"}
    assert run_stages(run, STAGES, start="filter_rois_by_proximity") == names[5:]
    assert outputs(folder) == first
    changed = Run(spark, str(folder), {**settings, "merge_distance": "0.1"})
    assert run_stages(changed, STAGES, stop="determine_roi_merge") == names[3:4]  # what depends on it
    with pytest.raises(ValueError, match="no such stage"):
        run_stages(run, STAGES, start="other")
    with pytest.raises(ValueError, match="is not finished"):
        run_stages(Run(spark, f"{folder}/elsewhere", settings), STAGES, start="merge_rois")


def test_partitions_are_worked_once(spark, tmp_path):
    fits = spark.range(6 * 3 * 12).select((F.col("id") % 6).cast("int").alias("fov"), (F.col("id") / 6 % 3).cast("int").alias("timepoint"), F.expr("id div 18").alias("bead_id"), *[(F.col("id") * k % 17).cast("double").alias(a) for k, a in ((3, "z"), (5, "y"), (7, "x"))])
    seen = []

    def work(rows):
        seen.append(sorted(r[0] for r in rows.select("fov").distinct().collect()))
        if seen[-1] == [2, 3] and len(seen) == 2:
            raise RuntimeError("stopped in the middle")
        return fine_drift(rows, 0)

    path = str(tmp_path / "drift")
    with pytest.raises(RuntimeError):
        by_partition(fits, "fov", path, work, at_once=2)
    whole = by_partition(fits, "fov", path, work, at_once=2)
    assert seen == [[0, 1], [2, 3], [2, 3], [4, 5]]
    columns = ["fov", "timepoint", "z_fine", "y_fine", "x_fine"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, fine_drift(fits, 0).select(columns).collect()))
    by_partition(fits, "fov", path, work, at_once=2)
    assert len(seen) == 4
