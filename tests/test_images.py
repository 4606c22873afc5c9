"""Detection on images, and arrays in files."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.functions import detection
from spotweave.operators import detection as tables
from spotweave.sources import arrays


def flood(mask):
    out, n = np.zeros(mask.shape, int), 0
    for p in np.argwhere(mask):
        if out[tuple(p)]:
            continue
        n += 1
        todo = [tuple(p)]
        while todo:
            q = todo.pop()
            if all(0 <= c < s for c, s in zip(q, mask.shape, strict=True)) and mask[q] and not out[q]:
                out[q] = n
                todo += [tuple(np.add(q, d)) for d in (*np.eye(mask.ndim, dtype=int), *-np.eye(mask.ndim, dtype=int))]
    return out


def test_labels_equal_flood_fill():
    rng = np.random.default_rng(0)
    for shape in ((9, 9), (5, 6, 7), (1, 30), (4, 4, 4)):
        for share in (0.0, 0.3, 0.6, 1.0):
            mask = rng.random(shape) < share
            assert (detection.labelled(mask) == flood(mask)).all()


def test_regions_and_threshold():
    image = np.zeros((6, 10, 10))
    image[1:3, 2:4, 2:4] = 5.0
    image[4, 7, 7] = 9.0
    found = detection.regions(detection.labelled(image > 0), image)
    assert [(r["zc"], r["yc"], r["area"], r["max_intensity"]) for r in found] == [(1.5, 2.5, 8.0, 5.0), (4.0, 7.0, 1.0, 9.0)]
    assert 0 < detection.otsu(np.concatenate([np.random.default_rng(1).normal(0, 1, 500), np.random.default_rng(2).normal(20, 1, 500)])) < 20
    blurred = detection.smoothed(image, 1.0)
    assert abs(blurred.sum() - image.sum()) < 1e-6 and blurred.max() < 9.0
    assert len(detection.detect(image, "dog", 4.0)) == 2
    with pytest.raises(ValueError):
        detection.detect(image, "other", 1.0)


def test_crosstalk_is_taken_off():
    bleed = np.zeros((8, 8))
    bleed[3, 4] = 1000.0
    source = np.full((8, 8), 10.0) + 0.1 * bleed
    out = detection.without_crosstalk(source, bleed)
    assert out[3, 4] == pytest.approx(0.0) and out[0, 0] == 10.0
    assert (detection.without_crosstalk(source, bleed * 0) == source).all()


def images(spark):
    image = np.full((4, 8, 8), 1.0)
    image[1, 2, 3], image[2, 6, 6] = 50.0, 70.0
    return spark.createDataFrame([(0, 1, image.ravel().tolist(), [4, 8, 8]), (0, 2, np.ones(256).tolist(), [4, 8, 8])], "fov int, timepoint int, voxels array<double>, shape array<int>")


def test_detection_over_tables(spark):
    spots = tables.detect_spots(images(spark), ["fov", "timepoint"], "intensity", 20.0).orderBy("label").collect()
    assert [(r.timepoint, r.zc, r.yc, r.xc, r.max_intensity) for r in spots] == [(1, 1.0, 2.0, 3.0, 50.0), (1, 2.0, 6.0, 6.0, 70.0)]
    assert tables.bead_regions(images(spark), ["fov", "timepoint"], 3.0).count() == 2
    assert tables.nuclei(images(spark).where("timepoint = 1"), ["fov"], sigma=0.5).count() >= 1
    both = images(spark).withColumn("bleed", F.col("voxels"))
    assert "bleed" not in tables.without_crosstalk(both, 5.0).columns


def test_crops_of_tables(spark):
    rows = [(0, 1, 7, 0.0, 2.0, 0.0, 0.0, 1.0, 4.0, 0.0, 0.0, 2.0, 5.0, 0.0, 0.0), (0, 1, 8, 0.0, 2.0, 0.0, 0.0, 0.0, 4.0, 1.0, 0.0, 2.0, 5.0, 0.0, 0.0)]
    columns = ", ".join(f"{a}_{k} double" for a in "zyx" for k in ("lo", "hi", "pad_lo", "pad_hi"))
    boxes = spark.createDataFrame(rows, f"fov int, timepoint int, roi_id int, {columns}")
    got = {r.roi_id: r for r in tables.cropped(boxes, images(spark), ["fov", "timepoint"]).collect()}
    assert got[7].shape == [2, 3, 3] and max(got[7].voxels) == 50.0 and got[7].reason is None
    assert got[8].reason == "padded in y or x" and max(got[8].voxels) == 0.0


def test_fine_drift(spark):
    rows = [(0, 0, b, float(b), 0.0, 0.0) for b in range(10)] + [(0, 1, b, float(b) - 2.0 - (50 if b == 3 else 0), 1.0, 0.0) for b in range(10)] + [(0, 2, 99, 1.0, 1.0, 1.0)]
    fits = spark.createDataFrame(rows, "fov int, timepoint int, bead_id int, z double, y double, x double")
    got = {r.timepoint: (r.z_fine, r.y_fine, r.x_fine) for r in tables.fine_drift(fits, 0).collect()}
    assert got == {0: (0.0, 0.0, 0.0), 1: (2.0, -1.0, 0.0), 2: (0.0, 0.0, 0.0)}


def test_archives(spark, tmp_path):
    (tmp_path / "a.npz").write_bytes(arrays.zipped({"x/one.npy": np.arange(6).reshape(2, 3), "two": np.ones(2)}))
    found = arrays.read_npz(spark, str(tmp_path))
    assert {(r.name, tuple(r.shape), sum(r.voxels)) for r in found.collect()} == {("one", (2, 3), 15.0), ("two", (2,), 2.0)}
    assert [arrays.chosen(found, w).count() for w in ("one", 1, slice(0, 5), ["two", 0], "none", slice(None, None, -1))] == [1, 1, 2, 2, 0, 2]
    with pytest.raises(ValueError):
        arrays.zipped({"a/x.npy": np.ones(1), "b/x.npy": np.ones(1)})
    assert np.load(io.BytesIO((tmp_path / "a.npz").read_bytes()))["one"].sum() == 15


@pytest.mark.parametrize("compressor", ["zlib", None])
def test_chunked_arrays(spark, tmp_path, compressor):
    x = np.arange(5 * 7, dtype="uint16").reshape(5, 7)
    for name, content in arrays.zarr_files(x, (2, 4), compressor):
        (tmp_path / name).write_bytes(content)
    back = np.zeros((5, 7))
    for r in arrays.read_zarr(spark, str(tmp_path)).collect():
        back[tuple(slice(a, a + n) for a, n in zip(r.start, r.shape, strict=True))] = np.reshape(r.voxels, r.shape)
    assert (back == x).all()


def test_folders_of_images(spark, tmp_path):
    for name in ("Time00001_Point0002.nd2", "Time00002_Point0002.nd2"):
        (tmp_path / name).write_bytes(b"x")
    assert {(r.position, r.time) for r in arrays.image_folder(spark, str(tmp_path)).collect()} == {(2, 1), (2, 2)}
    (tmp_path / "bad.nd2").write_bytes(b"x")
    with pytest.raises(ValueError, match="bad.nd2"):
        arrays.image_folder(spark, str(tmp_path))
    (tmp_path / "P0001_a.csv").write_bytes(b"x")
    assert [(r.fov, len(r.paths)) for r in arrays.by_field(spark, str(tmp_path)).collect()] == [("P0001", 1)]
