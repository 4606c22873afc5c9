"""Detection in tiles against the same image worked whole."""

import numpy as np
import pyarrow as pa
import pytest

from spotweave.functions import detection
from spotweave.operators import components, tiles
from spotweave.sources import chunks

SHAPE = (2, 1, 6, 17, 19)


def images(seed):
    r = np.random.default_rng(seed)
    return {f"P{i:04d}": np.floor(detection.smoothed(r.random(SHAPE[2:]), 0.7) * 4000).reshape(1, 1, *SHAPE[2:]).repeat(2, 0) * np.array([1, 2]).reshape(2, 1, 1, 1, 1) + r.integers(0, 3, SHAPE) for i in (1, 2)}


def pieces_of(spark, arrays, step):
    rows = []
    for field, x in arrays.items():
        for at in np.ndindex(*(-(-n // c) for n, c in zip(x.shape, step, strict=True))):
            start = [k * c for k, c in zip(at, step, strict=True)]
            piece = x[tuple(slice(a, a + c) for a, c in zip(start, step, strict=True))]
            rows.append((field, start, list(piece.shape), piece.ravel().tolist()))
    return spark.createDataFrame(rows, chunks.PIECE)


def whole(image, seen, threshold):
    x = seen(image)
    if seen.method == "dog":
        x = (x - x.mean()) / x.std()
    return detection.regions(detection.labelled(x > (detection.otsu(x) if threshold is None else threshold)), image)


@pytest.mark.parametrize(("method", "threshold", "tile"), [("intensity", 2050.0, (2, 5, 4)), ("dog", 1.0, (4, 6, 7)), ("blur", None, (3, 9, 8)), ("intensity", 0.0, (2, 4, 4)), ("intensity", 1e9, (6, 17, 19))])
def test_tiles_equal_whole_images(spark, method, threshold, tile):
    arrays, seen = images(3), tiles.Seen(method)
    got = tiles.regions(pieces_of(spark, arrays, (1, 1, 3, 8, 19)), SHAPE, tile, threshold, seen).collect()
    n = 0
    for field, x in arrays.items():
        for t in range(2):
            mine = sorted((r for r in got if r.field == field and r.t == t), key=lambda r: r.label)
            want = whole(x[t, 0], seen, threshold)
            assert [(r.label, r.area, r.max_intensity) for r in mine] == [(w["label"], w["area"], w["max_intensity"]) for w in want]
            for r, w in zip(mine, want, strict=True):
                assert np.allclose([r.zc, r.yc, r.xc, r.intensityMean], [w["zc"], w["yc"], w["xc"], w["intensityMean"]])
            n += len(want)
    assert len(got) == n and (n > 4 or threshold == 1e9 or threshold == 0.0)


def test_one_part_through_all_tiles(spark):
    """A line that winds through every tile is one part."""
    x = np.zeros((1, 1, 1, 9, 9))
    x[0, 0, 0, ::2] = 1
    x[0, 0, 0, 1::4, -1] = x[0, 0, 0, 3::4, 0] = 1
    got = tiles.regions(pieces_of(spark, {"P0001": x}, (1, 1, 1, 9, 9)), x.shape, (1, 2, 2), 0.5, tiles.Seen("intensity")).collect()
    assert [(r.label, r.area) for r in got] == [(1, int(x.sum()))]


def test_tiles_of_one_shape_are_one_array():
    """A batch of tiles is worked by the shapes in it, not tile by tile; every tile comes once, without its halo."""
    r = np.random.default_rng(5)
    shapes = [[2, 3, 4], [2, 4, 4], [3, 3, 3]]
    rows = [(f"P{i % 7:04d}", i, 0, [i, 2, 0], shapes[i % 3], [i, 2, 1], r.random(np.prod(shapes[i % 3])).tolist()) for i in range(300)]
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.float64())]
    names = [*tiles.IMAGE, "start", "shape", "core", "voxels"]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names).slice(3)
    found = list(tiles.cores(batch, (2, 2, 2), tiles.Seen("dog")))
    assert len(found) == 3
    got = {int(i) + 3: (place, image, x) for some, places, images, seen in found for i, place, image, x in zip(some, places, images, seen, strict=True)}
    assert sorted(got) == list(range(3, 300))
    for i, (place, image, x) in got.items():
        whole = np.array(rows[i][6]).reshape(rows[i][4])
        assert place.tolist() == rows[i][5] and (image == whole[:2, :2, 1:3]).all() and (x == tiles.Seen("dog")(whole)[:2, :2, 1:3]).all()
    masks = r.random((50, 3, 4, 5)) > 0.6
    labels, n = detection.labelled(masks, 1), 0
    for mask, of in zip(masks, labels, strict=True):
        alone = detection.labelled(mask)
        assert (of == np.where(alone, alone + n, 0)).all()
        n += alone.max()


def test_components_within_groups(spark):
    """Small groups, worked in buckets, and those above the bound give the components that each group's edges have alone; nulls among keys are a group."""
    r = np.random.default_rng(8)
    edges = [(f"P{g:04d}" if g else None, g % 3, int(a), int(b)) for g in range(40) for a, b in r.integers(0, 30, (90 if g % 13 == 0 else 12, 2)) * 10**11]
    table = spark.createDataFrame(edges, "field string, t int, src long, dst long")
    want = {}
    for field, t in {e[:2] for e in edges}:
        mine = [e[2:] for e in edges if e[:2] == (field, t)]
        least = {n: n for e in mine for n in e}
        for _ in least:
            for a, b in mine:
                least[a] = least[b] = min(least[a], least[b])
        want |= {(field, t, n): m for n, m in least.items()}
    for bucket in (50, 1 << 16):
        got = components.components_within(table, ["field", "t"], bucket).collect()
        assert len(got) == len(want) and {(x.field, x.t, x.node): x.component for x in got} == want
    assert components.components_within(table.where("t = 9"), ["field", "t"]).collect() == []
