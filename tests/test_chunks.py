"""The data source of chunked arrays: layout, filters, commits, boxes."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotweave.functions import kernels
from spotweave.sources import chunks

SHAPE, CHUNK = (3, 2, 5, 6, 7), (1, 1, 2, 4, 4)


def pieces_of(spark, arrays, step=(2, 1, 3, 5, 7)):
    rows = []
    for field, x in arrays.items():
        for at in np.ndindex(*(-(-n // c) for n, c in zip(x.shape, step, strict=True))):
            start = [k * c for k, c in zip(at, step, strict=True)]
            piece = x[tuple(slice(a, a + c) for a, c in zip(start, step, strict=True))]
            rows.append((field, start, list(piece.shape), piece.ravel().tolist()))
    return spark.createDataFrame(rows, chunks.PIECE)


@pytest.fixture(scope="module")
def arrays():
    r = np.random.default_rng(2)
    return {f"P{i:04d}": r.integers(0, 999, SHAPE).astype(float) for i in (1, 2, 3)}


@pytest.fixture
def store(spark, arrays, tmp_path):
    path = str(tmp_path / "images")
    chunks.write_chunks(chunks.rechunked(pieces_of(spark, arrays), CHUNK, SHAPE), path, CHUNK, dtype="<u2")
    return path


def whole(rows, field):
    out = np.full(SHAPE, -1.0)
    for r in rows:
        if r.field == field:
            out[tuple(slice(a, a + n) for a, n in zip(r.start, r.shape, strict=True))] = np.reshape(r.voxels, r.shape)
    return out


def test_what_is_written_is_read(spark, arrays, store, tmp_path):
    rows = chunks.read_chunks(spark, store).collect()
    for field, x in arrays.items():
        assert (whole(rows, field) == x).all()
    assert len(rows) == 3 * 3 * 2 * 3 * 2 * 2
    described = json.loads((tmp_path / "images/P0002.zarr/.zarray").read_text())
    assert described["shape"] == list(SHAPE) and described["chunks"] == list(CHUNK) and described["dtype"] == "<u2"
    assert sorted(p.name for p in (tmp_path / "images").iterdir()) == [f"{f}.zarr" for f in sorted(arrays)]  # no folder of the writing is left


def test_only_the_chunks_asked_for_are_opened(spark, arrays, store, tmp_path):
    """All other files are spoilt, so that opening one fails."""
    for p in (tmp_path / "images").rglob("*"):
        if p.is_file() and p.name != ".zarray" and not (p.parent.name == "P0002.zarr" and p.name.startswith(("1.0.", "2.0."))):
            p.write_bytes(b"spoilt")
    df = chunks.read_chunks(spark, store).where("field = 'P0002' and t_chunk >= 1 and c_chunk = 0")
    got = whole(df.collect(), "P0002")
    assert (got[1:, 0] == arrays["P0002"][1:, 0]).all() and (got[0] == -1).all()
    one = chunks.read_chunks(spark, store).where("field in ('P0002') and t_chunk = 2 and c_chunk = 0 and z_chunk < 1 and y_chunk = 1 and x_chunk <= 0").collect()
    assert [(r.start, r.shape) for r in one] == [([2, 0, 0, 4, 0], [1, 1, 2, 2, 4])]
    assert chunks.read_chunks(spark, store).where("field = 'P0009'").collect() == []
    with pytest.raises(Exception, match="incorrect header check|Error -3"):
        chunks.read_chunks(spark, store).where("field = 'P0001'").collect()


def test_tasks_hold_a_share_of_the_chunks(spark, store):
    assert chunks.read_chunks(spark, store).rdd.getNumPartitions() == 3
    assert chunks.read_chunks(spark, store, bytesPerTask=1).rdd.getNumPartitions() == 216


def test_appending_and_replacing(spark, arrays, store):
    more = pieces_of(spark, {"P0004": arrays["P0001"]})
    chunks.write_chunks(chunks.rechunked(more, CHUNK, SHAPE), store, CHUNK, dtype="<u2")
    assert set(chunks.layouts(store)) == {*arrays, "P0004"}
    with pytest.raises(Exception, match="another layout"):
        chunks.write_chunks(spark.createDataFrame([("P0001", [0] * 5, [1] * 5, [1.0])], chunks.PIECE), store, (1, 1, 1, 1, 1))
    chunks.write_chunks(spark.createDataFrame([("P0001", [0] * 5, [1] * 5, [7.5])], chunks.PIECE), store, (1, 1, 1, 1, 1), overwrite=True)
    assert [(r.field, r.voxels) for r in chunks.read_chunks(spark, store).collect()] == [("P0001", [7.5])]


def test_faults_leave_nothing(spark, tmp_path):
    path = tmp_path / "none"
    row = ("P0001", [0, 0, 0, 0, 0], [1, 1, 2, 2, 2], [0.0] * 8)
    with pytest.raises(Exception, match="no whole chunk"):
        chunks.write_chunks(spark.createDataFrame([row, ("P0001", [0, 0, 1, 0, 0], [1, 1, 2, 2, 2], [0.0] * 8)], chunks.PIECE), str(path), (1, 1, 2, 2, 2))
    for n in (1, 2):
        with pytest.raises(Exception, match="two pieces"):
            chunks.write_chunks(spark.createDataFrame([row, row], chunks.PIECE).repartition(n), str(path), (1, 1, 2, 2, 2))
    assert chunks.read_chunks(spark, str(path)).collect() == [] and not [p for p in path.rglob("*") if p.is_file()]


def test_arrays_of_fewer_axes_and_gaps(spark, tmp_path):
    folder = tmp_path / "a" / "P0001.zarr" / "0"
    folder.mkdir(parents=True)
    (folder / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": [3, 4], "chunks": [2, 2], "dtype": "<i2", "order": "F", "fill_value": 9, "filters": None, "compressor": {"id": "zlib"}}))
    (folder / "1.0").write_bytes(zlib.compress(np.arange(4, dtype="<i2").reshape(2, 2).tobytes(order="F")))
    (tmp_path / "a" / "P0002.zarr").mkdir()  # no description: not there yet
    rows = chunks.read_chunks(spark, str(tmp_path / "a")).collect()
    assert [(r.field, r.y_chunk, r.x_chunk, r.start, r.shape, r.voxels) for r in rows] == [("P0001", 1, 0, [0, 0, 0, 2, 0], [1, 1, 1, 1, 2], [0.0, 1.0])]
    box = spark.createDataFrame([(1, "P0001", [0, 0, 0, 1, 0], [1, 1, 1, 3, 3])], "id int, field string, lo array<int>, hi array<int>")
    assert chunks.cut_boxes(box, str(tmp_path / "a"), ["id"]).first().voxels == [9.0, 9.0, 9.0, 0.0, 1.0, 9.0]


def test_boxes_equal_slices_and_no_image_is_shuffled(spark, arrays, store):
    r = random.Random(4)
    boxes = []
    for i in range(80):
        lo = [r.randrange(n) for n in SHAPE]
        boxes.append((i, f"P{r.randrange(1, 4):04d}", lo, [r.randrange(a + 1, n + 1) for a, n in zip(lo, SHAPE, strict=True)]))
    df = spark.createDataFrame(boxes, "id int, field string, lo array<int>, hi array<int>")
    cut = chunks.cut_boxes(df, store, ["id"])
    got = {x.id: x.voxels for x in cut.collect()}
    assert got == {i: arrays[f][tuple(slice(a, b) for a, b in zip(lo, hi, strict=True))].ravel().tolist() for i, f, lo, hi in boxes}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" not in plan and "chunked_arrays" not in plan
    with pytest.raises(Exception, match="beyond the array"):
        chunks.cut_boxes(spark.createDataFrame([(1, "P0001", [0] * 5, [1, 1, 1, 1, 9])], df.schema), store, ["id"]).collect()


def test_crops_equal_those_of_images_in_rows(spark, arrays, store):
    r = random.Random(5)
    rows = []
    for i in range(60):
        lo = [r.uniform(0, n - 1) for n in SHAPE[2:]]
        hi = [min(a + r.uniform(0, 4), n + r.choice([0, 0, 0, 2])) for a, n in zip(lo, SHAPE[2:], strict=True)]
        rows.append((i, f"P{r.randrange(1, 4):04d}", r.randrange(3), r.randrange(2), *(float(v) for a in range(3) for v in (lo[a], hi[a], r.choice([0, 0, 1.5]) if a == 0 or r.random() < 0.1 else 0, 0))))
    names = [f"{a}_{k}" for a in "zyx" for k in ("lo", "hi", "pad_lo", "pad_hi")]
    df = spark.createDataFrame(rows, "id int, field string, timepoint int, channel int, " + ", ".join(f"{n} double" for n in names))
    got = {x.id: x for x in chunks.cropped_chunks(df, store, ["id"], background=1).collect()}
    reasons = set()
    for i, field, t, c, *bounds in rows:
        b = dict(zip(names, bounds, strict=True))
        side = lambda k, b=b: np.array([b[f"{a}_{k}"] for a in "zyx"])
        want, reason = kernels.crop(arrays[field][t, c], side("lo"), side("hi"), np.concatenate([side("pad_lo"), side("pad_hi")]), t == 1)
        assert (got[i].reason, got[i].shape, got[i].voxels) == (reason, list(want.shape), want.ravel().tolist())
        reasons.add(reason)
    assert reasons == {None, "out of bounds", "empty", "padded in y or x"}


def test_rechunking_empty_table(spark):
    assert chunks.rechunked(spark.createDataFrame([], chunks.PIECE), CHUNK, SHAPE).collect() == []
    assert chunks.cells(spark.createDataFrame([([0], [5])], "lo array<int>, hi array<int>"), (2,)).select(F.col("chunk")[0]).count() == 3


def test_batches_of_a_write_are_bounded(spark, tmp_path, monkeypatch):
    """By rows, and by the bytes of their chunks."""
    held = []
    monkeypatch.setattr(chunks, "arrow_rows", lambda s, n, f=chunks.arrow_rows: held.append(n) or f(s, n))
    piece = spark.createDataFrame([("P0001", [0, 0, 0, 0, 0], [1, 1, 1, 2, 2], [1.0, 2.0, 3.0, 4.0])], chunks.PIECE)
    chunks.write_chunks(piece, str(tmp_path / "a"), (1, 1, 1, 2, 2))
    chunks.write_chunks(piece, str(tmp_path / "b"), (1, 1, 8, 1024, 1024))
    assert held == [1000, 1] and chunks.read_chunks(spark, str(tmp_path / "a")).count() == 1


@pytest.mark.parametrize("bound", [0, 512])
def test_pieces_are_cut_by_kind(monkeypatch, bound):
    """A batch of pieces is cut as arrays of those that are cut alike, as each is alone, also from the middle of a batch and from none."""
    monkeypatch.setattr(chunks, "CUT_VOXELS", bound)
    r = np.random.default_rng(4)
    rows = []
    for i in range(60):
        start, shape = [i, *r.integers(0, 5, 2).tolist()], r.integers(1, 4, 3).tolist()
        lo = [s + int(r.integers(0, n)) for s, n in zip(start, shape, strict=True)]
        hi = [int(r.integers(a + 1, s + n + 1)) for a, s, n in zip(lo, start, shape, strict=True)]
        rows.append((start, shape, r.random(np.prod(shape)).tolist(), lo, hi))
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.list_(pa.int32())] * 2 + [pa.list_(pa.float64())] + [pa.list_(pa.int32())] * 2, strict=True)]
    got = chunks.cut_pieces(*[c.slice(5) for c in columns], 3).to_pylist()
    want = [np.array(v).reshape(n)[tuple(slice(a - s, b - s) for s, a, b in zip(o, lo, hi, strict=True))].ravel().tolist() for o, n, v, lo, hi in rows[5:]]
    assert got == want
    assert len(chunks.cut_pieces(*[c.slice(60) for c in columns], 3)) == 0
    with pytest.raises(ValueError):
        chunks.cut_pieces(columns[0], columns[1], pa.array([[1.0]] * 59 + [None], pa.list_(pa.float64())), columns[3], columns[4], 3)
