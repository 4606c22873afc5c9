"""Depth, splitting of touching parts, and fits of many volumes, against plain versions."""

import time

import numpy as np
import pytest

from spotweave.functions import detection, kernels
from spotweave.operators import detection as tables


def flooded(mask, prominence):
    """Pixel by pixel, from the deepest on."""
    depth = detection.squared_depth(mask)
    where = sorted((tuple(map(int, p)) for p in np.argwhere(mask)), key=lambda p: (-depth[p], p))
    root, done, peak = {}, {}, {}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for n, p in enumerate(where):
        near = sorted((done[q], q) for axis in range(mask.ndim) for d in (-1, 1) if (q := (*p[:axis], p[axis] + d, *p[axis + 1 :])) in done)
        done[p] = n
        if not near:
            root[p], peak[p] = p, n
            continue
        root[p] = top(near[0][1])
        for _, q in near[1:]:
            a, b = sorted((top(p), top(q)), key=lambda r: done[r])
            if a != b and np.sqrt(depth[b]) - np.sqrt(depth[p]) < prominence:
                root[b] = a
    out, names = np.zeros(mask.shape, int), {}
    for p in sorted(where):
        out[p] = names.setdefault(top(p), len(names) + 1)
    return out


def balls(*centres, radius=5, shape=(13, 14, 26)):
    z, y, x = np.indices(shape)
    return np.any([(z - c[0]) ** 2 + (y - c[1]) ** 2 + (x - c[2]) ** 2 <= radius**2 for c in centres], axis=0)


def test_depth_is_exact():
    r = np.random.default_rng(1)
    for shape in ((5, 7), (4, 5, 6), (9,)):
        mask = r.random(shape) < 0.8
        outside = np.argwhere(~mask)
        want = [min((((o - p) ** 2).sum() for o in outside), default=1 << 40) for p in np.argwhere(mask)]
        assert detection.squared_depth(mask)[mask].tolist() == want
    assert (detection.squared_depth(np.ones((3, 3), bool)) >= 1 << 40).all()


@pytest.mark.parametrize("prominence", [0.0, 0.4, 1.0, 5.0])
def test_basins_equal_flooding(prominence):
    r = np.random.default_rng(2)
    for share, shape in ((0.5, (6, 7)), (0.8, (5, 6, 7)), (0.95, (12, 13)), (0.97, (7, 8, 9)), (1.0, (4, 4)), (0.0, (3, 3))):
        mask = r.random(shape) < share
        assert (detection.basins(mask, prominence) == flooded(mask, prominence)).all()


def test_touching_balls_are_two():
    two = balls((6, 6, 7), (6, 7, 15))
    assert detection.labelled(two).max() == 1 and detection.basins(two).max() == 2
    sizes = np.bincount(detection.basins(two).ravel())[1:]
    assert abs(int(sizes[0]) - int(sizes[1])) < 0.1 * sizes.sum()
    assert detection.basins(balls((6, 6, 7))).max() == 1
    assert (detection.basins(two) == flooded(two, 1.0)).all()


def test_nuclei_with_holes_specks_and_touching(spark):
    image = balls((6, 6, 7), (6, 7, 15)).astype(float) * 100
    image[6, 6, 7] = 0  # a hole
    image[0, 0, 25] = 100  # a speck
    df = spark.createDataFrame([(1, image.ravel().tolist(), list(image.shape)), (2, [0.0] * 8, [2, 2, 2])], "id int, voxels array<double>, shape array<int>")
    how = {"sigma": 0.1, "threshold": 50.0, "least_area": 5}
    whole, split = (tables.nuclei(df, ["id"], split=s, **how).collect() for s in (False, True))
    assert [(r.id, r.area) for r in whole] == [(1, float(balls((6, 6, 7), (6, 7, 15)).sum()))]
    assert [r.label for r in split] == [1, 2] and sum(r.area for r in split) == whole[0].area


def one_fit(y3, sigma=1.0, method="LS", rounds=200):
    """The same steps for one volume, by itself."""
    grid, y = np.indices(y3.shape).reshape(3, -1).astype(float), y3.ravel()
    p = np.array([y.min(), y.max(), *np.unravel_index(int(y.argmax()), y3.shape), sigma, sigma], float)
    p[0] = max(p[0], 1e-6) if method == "MLE" else p[0]
    value = lambda p: (kernels.gaussians(p[None], grid)[0][0], kernels.gaussians(p[None], grid)[1][0].T)

    def cost(f):
        if method == "LS":
            return ((f - y) ** 2).sum()
        return np.inf if (f <= 0).any() else 2 * (f - y).sum() - 2 * (y[y > 0] * np.log(f[y > 0] / y[y > 0])).sum()

    f, jac = value(p)
    best, damp = cost(f), 1e-3
    for _ in range(rounds):
        slope, curve = (jac.T @ (f - y), jac.T @ jac) if method == "LS" else (jac.T @ (1 - y / f), (jac * (y / f**2)[:, None]).T @ jac)
        q = p + np.linalg.lstsq(curve + damp * np.diag(np.diag(curve) + 1e-12), -slope, rcond=None)[0]
        with np.errstate(all="ignore"):
            g, next_jac = value(q)
            tried = cost(g) if np.isfinite(g).all() and np.isfinite(next_jac).all() else np.inf
        if tried < best:
            gain, p, f, jac, best, damp = best - tried, q, g, next_jac, tried, max(damp / 10, 1e-12)
            if gain <= 1e-12 * (best + 1e-12):
                break
        else:
            damp *= 10
            if damp > 1e12:
                break
    return p


@pytest.mark.parametrize("method", ["LS", "MLE"])
def test_fits_of_many_equal_those_of_one(method):
    r = np.random.default_rng(7)
    grid = np.indices((6, 7, 8)).reshape(3, -1).astype(float)
    truth = np.column_stack([r.uniform(5, 20, 400), r.uniform(60, 200, 400), r.uniform(2, 4, 400), r.uniform(2, 5, 400), r.uniform(2, 6, 400), r.uniform(0.6, 1.2, 400), r.uniform(0.6, 1.2, 400)])
    data = r.poisson(kernels.gaussians(truth, grid)[0]).reshape(-1, 6, 7, 8).astype(float)
    data[13] = 0
    began = time.time()
    many = kernels.fit_gaussians(data, method=method)
    took = time.time() - began
    began = time.time()
    one = np.array([one_fit(d, method=method) if d.any() else kernels.NO_FIT for d in data])
    assert np.allclose(many, one, rtol=1e-4, atol=1e-4) and (many[13] == -1).all()
    assert time.time() - began > 2 * took
    near = np.delete(np.arange(400), 13)
    assert np.median(np.abs(many[near, 2:5] - truth[near, 2:5])) < 0.1
