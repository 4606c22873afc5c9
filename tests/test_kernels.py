import numpy as np
import pytest

from spotweave.functions import kernels
from spotweave.operators import pixels

TRUE = (10.0, 90.0, 7.3, 15.6, 16.2, 1.4, 2.1)


def spot():
    grid = np.indices((16, 32, 32)).reshape(3, -1).astype(float)
    return kernels.gaussians(np.array([TRUE]), grid)[0].reshape(16, 32, 32)


@pytest.mark.parametrize("method", ["LS", "MLE"])
def test_fit_recovers_the_spot(method):
    assert np.allclose(np.abs(kernels.fit_gaussian(spot(), method=method)), TRUE, rtol=1e-3)
    noisy = np.random.default_rng(1).poisson(spot()).astype(float)
    assert np.allclose(np.abs(kernels.fit_gaussian(noisy, method=method))[2:5], TRUE[2:5], atol=0.1)


def test_jacobian_equals_differences():
    grid = np.indices((4, 5, 6)).reshape(3, -1).astype(float)
    p = np.array([1.0, 5, 2, 2.5, 3, 1.2, 1.7])
    for i, h in enumerate(np.eye(7) * 1e-6):
        values = kernels.gaussians(np.array([p + h, p - h]), grid)[0]
        assert np.allclose((values[0] - values[1]) / 2e-6, kernels.gaussians(p[None], grid)[1][0, i], atol=1e-5)


def test_no_fit():
    assert kernels.fit_gaussian(np.zeros((3, 3, 3))) == kernels.NO_FIT == kernels.fit_gaussian(np.ones((3, 3)))


def test_phase_shift():
    a = np.random.default_rng(2).random((8, 32, 32))
    assert kernels.phase_shift(a, np.roll(a, (1, -5, 7), (0, 1, 2))) == (-1, 5, -7)


def test_crop():
    image = np.arange(4 * 6 * 6).reshape(4, 6, 6)
    low, high, none = np.array([0, 1, 1.5]), np.array([2, 3.9, 4]), np.zeros(6)
    got, why = kernels.crop(image, low, high, none)
    assert why is None and (got == image[0:2, 1:3, 1:4]).all()
    assert kernels.crop(image, low, np.array([5, 3, 4]), none)[1] == "out of bounds"
    assert kernels.crop(image, low, np.array([0.5, 3, 4]), none)[1] == "empty"
    pads = np.array([1, 0, 0.4, 0, 1, 0])
    assert kernels.crop(image, low, high, pads)[1] == "padded in y or x" and kernels.crop(image, low, high, pads, True)[1] is None


def test_alignment_and_plane():
    rng = np.random.default_rng(3)
    a = rng.random((9, 3))
    turn = np.linalg.qr(rng.random((3, 3)))[0]
    turn *= np.sign(np.linalg.det(turn))
    assert kernels.aligned_rmse(a, a @ turn.T + 4) < 1e-9
    flat = np.column_stack([np.full(9, 2.0), a[:, 1:]])
    assert np.allclose(np.abs(kernels.plane_normal(flat)), [1, 0, 0])


def test_operators(spark):
    rows = [(1, spot().ravel().tolist(), [16, 32, 32], "x"), (2, None, [16, 32, 32], "y"), (3, [1.0], [2, 2, 2], None)]
    df = spark.createDataFrame(rows, "id int, voxels array<double>, shape array<int>, BG string")
    got = {r.id: r for r in pixels.fit_spots(df).collect()}
    assert abs(got[1].z_px - 7.3) < 1e-2 and got[2].A == got[3].A == -1 and pixels.fit_spots(df.limit(0)).count() == 0
    a = np.random.default_rng(4).random((4, 8, 8))
    images = [("P0001", t, np.roll(a, t, 1).ravel().tolist(), [4, 8, 8]) for t in range(3)]
    drift = pixels.coarse_drift(spark.createDataFrame(images, "fieldOfView string, timepoint int, voxels array<double>, shape array<int>"), 0)
    assert {(r.timepoint, r.yDriftCoarsePixels) for r in drift.collect()} == {(0, 0.0), (1, -1.0), (2, -2.0)}
    points = [(1, t, float(t), float(t * t), 1.0, 1) for t in range(5)] + [(2, t, float(t) + 3, float(t * t), 2.0, int(t > 0)) for t in range(5)] + [(3, 0, 0.0, 0.0, 0.0, 0)]
    traces = pixels.traces_as_rows(spark.createDataFrame(points, "traceId int, timepoint int, z double, y double, x double, qcPass int"), ["traceId"])
    rmse = {r.traceId: r.rmse for r in pixels.aligned_to(traces, ([0, 1, 2, 3, 4], [0, 1, 4, 9, 16], [1] * 5)).collect()}
    assert rmse[1] < 1e-9 and rmse[2] < 1e-9 and rmse[3] is None
    assert {r.traceId: r.normal and round(abs(r.normal[2]), 6) for r in pixels.plane_normals(traces).collect()} == {1: 1.0, 2: 1.0, 3: None}
