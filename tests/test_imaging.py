"""Programs over a store of images: from beads to drift, spots and signals, against what was planted."""

import csv
import glob
import json

import numpy as np
import pytest

from spotweave.functions import kernels
from spotweave.plans import imaging
from spotweave.sources import chunks

SHAPE = (3, 2, 14, 44, 44)
HEAD = "index,fieldOfView,timepoint,spotChannel,zc,yc,xc,zMin,zMax,yMin,yMax,xMin,xMax"
MOVES = {("P0001", 1): ([1, -2, 3], [0.3, -0.2, 0.1]), ("P0001", 2): ([0, 2, -1], [-0.25, 0.4, 0.2]), ("P0002", 1): ([-1, 1, 0], [0.1, 0.1, -0.3]), ("P0002", 2): ([1, 1, 1], [0.0, 0.0, 0.0])}


def rows(path):
    return [r for f in sorted(glob.glob(f"{path}/*.csv")) for r in csv.DictReader(open(f))]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("images")
    r = np.random.default_rng(8)
    grid = np.indices(SHAPE[2:]).reshape(3, -1).astype(float)
    beads, pieces = {}, []
    for field in ("P0001", "P0002"):
        beads[field] = np.array([[7, 10 + 12 * i, 10 + 12 * j] for i in range(3) for j in range(3)], float) + r.uniform(-0.4, 0.4, (9, 3))
        for t in range(3):
            coarse, fine = MOVES.get((field, t), ([0] * 3, [0] * 3))
            at = beads[field] - np.array(coarse) - np.array(fine)
            light = sum(kernels.gaussians(np.array([[0, 900.0, *p, 0.8, 0.8]]), grid)[0][0] for p in at)
            for c in range(2):
                x = (20 + light * (1 + c)).reshape(SHAPE[2:])
                pieces.append((field, [t, c, 0, 0, 0], [1, 1, *SHAPE[2:]], x.ravel().tolist()))
    path = str(base / "store")
    chunks.write_chunks(chunks.rechunked(spark.createDataFrame(pieces, chunks.PIECE), (1, 1, 8, 20, 20), SHAPE), path, (1, 1, 8, 20, 20))
    head = "fieldOfView,timepoint,zDriftCoarsePixels,zDriftFinePixels,yDriftCoarsePixels,yDriftFinePixels,xDriftCoarsePixels,xDriftFinePixels"
    line = lambda f, t: ",".join([f"{f}.zarr", str(t), *(f"{c},0" for c in MOVES.get((f, t), ([0] * 3, 0))[0])])
    (base / "coarse.csv").write_text("\n".join([head, *(line(f, t) for f in beads for t in range(3))]) + "\n")
    (base / "beads").mkdir()
    for i, field in enumerate(beads):
        for t in range(3):
            (base / f"beads/bead_rois__{i}_{t}.json").write_text(json.dumps([{"index": k, "centroid": dict(zip(("zc", "yc", "xc"), p, strict=True))} for k, p in enumerate(beads[field])]))
    (base / "rounds.json").write_text(json.dumps({"imagingRounds": [{"time": 0, "probe": "a", "isRegional": True}, {"time": 1, "probe": "b"}, {"time": 2, "probe": "c"}], "proximityFilterStrategy": {"semantic": "UniversalProximityPermission"}, "locusGrouping": {"0": [1, 2]}}))
    box = lambda p: ",".join(f"{c - 4},{c + 4}" for c in p)
    (base / "rois.csv").write_text("\n".join([HEAD + ",traceGroup,traceId", *(f"{n},{f}.zarr,0,0,{p[0]},{p[1]},{p[2]},{box(np.round(p))},,{100 + n}" for n, (f, p) in enumerate((f, p) for f in beads for p in beads[f][:4]))]) + "\n")
    return base, path, beads


def test_from_beads_to_drift_spots_and_signals(spark, store):
    base, images, beads = store
    imaging.detect_beads(spark, images=images, output_folder=f"{base}/found", threshold="80", sigma="0.6", tile="8,20,20")
    assert len(glob.glob(f"{base}/found/bead_rois__*.csv")) == 6
    first = [[float(r[f"{a}c"]) for a in "zyx"] for r in csv.DictReader(open(f"{base}/found/bead_rois__0_0.csv"))]
    assert len(first) == 9 and all(np.abs(np.array(first) - p).sum(axis=1).min() < 1.2 for p in beads["P0001"])
    how = {"images": images, "beads_folder": f"{base}/beads", "reference_timepoint": "0", "bead_pixels": "8"}
    imaging.correct_fine_drift(spark, **how, drift_file=f"{base}/coarse.csv", work_folder=f"{base}/work", output_file=f"{base}/drift.csv", at_once="1")
    drift = rows(f"{base}/drift.csv")
    assert [(r["fieldOfView"], r["timepoint"]) for r in drift] == [(f, str(t)) for f in beads for t in range(3)]
    for r in drift:
        coarse, fine = MOVES.get((r["fieldOfView"], int(r["timepoint"])), ([0] * 3, [0] * 3))
        assert [float(r[f"{a}DriftCoarsePixels"]) for a in "zyx"] == coarse
        assert np.allclose([float(r[f"{a}DriftFinePixels"]) for a in "zyx"], fine, atol=0.02)
    imaging.analyse_drift_accuracy(spark, **how, drift_file=f"{base}/drift.csv", pixels='{"z": 300, "y": 100, "x": 100}', output_file=f"{base}/accuracy.csv")
    errors = [float(r["error"]) for r in rows(f"{base}/accuracy.csv")]
    assert len(errors) == 54 and max(errors) < 10
    imaging.trace_spots(spark, images=images, configuration=f"{base}/rounds.json", rois_file=f"{base}/rois.csv", drift_file=f"{base}/drift.csv", pixels='{"z": 300, "y": 100, "x": 100}', output_file=f"{base}/traces.csv")
    traced = rows(f"{base}/traces.csv")
    assert len(traced) == 24 and {r["spot_box_z"] for r in traced} == {"2400.0"}
    by = {(r["traceId"], r["timepoint"]): np.array([float(r[a]) for a in "zyx"]) for r in traced}
    assert all(np.abs(by[str(100 + n), t] - by[str(100 + n), "0"]).max() < 10 for n in range(8) for t in "12")
    imaging.analyse_signals(spark, images=images, rois_file=f"{base}/rois.csv", drift_file=f"{base}/drift.csv", diameter="5", channels="0,1", output_file=f"{base}/signals.csv")
    signals = {(r["index"], r["signalChannel"]): float(r["mean"]) for r in rows(f"{base}/signals.csv")}
    assert len(signals) == 16 and all(np.isclose(signals[str(n), "1"] - 20, 2 * (signals[str(n), "0"] - 20)) for n in range(8))


def test_fine_drift_goes_on_by_field(spark, store, monkeypatch):
    base, images, _ = store
    worked, cut = [], imaging.bead_boxes
    monkeypatch.setattr(imaging, "bead_boxes", lambda p, some, size: (worked.append(sorted(r[0] for r in some.select("fov").distinct().collect())), cut(p, some, size))[1])
    how = {"images": images, "beads_folder": f"{base}/beads", "reference_timepoint": "0", "bead_pixels": "8", "drift_file": f"{base}/coarse.csv", "work_folder": f"{base}/again", "at_once": "1"}
    for name in ("one", "two"):
        imaging.correct_fine_drift(spark, **how, output_file=f"{base}/{name}.csv")
    assert worked == [[0], [1]] and rows(f"{base}/one.csv") == rows(f"{base}/two.csv")
