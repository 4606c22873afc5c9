"""Numeric kernels on numpy arrays of one image, spot or trace (K3, K6, K8, K10, K16, K17, K20). `operators/pixels` applies them to tables."""

from __future__ import annotations

import numpy as np

FIT_COLUMNS = ("BG", "A", "z_px", "y_px", "x_px", "sigma_z", "sigma_xy")
NO_FIT = (-1.0,) * len(FIT_COLUMNS)
BLOCK = 1 << 16  # voxels that are fitted as one array


def gaussians(p: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (spots, n) and Jacobians (spots, 7, n) of the spot model at grid (3, n) for parameters (spots, 7). The model divides squared
    distances by (2 sigma) ** 2, which the thresholds of quality control rest on."""
    level, height, widths = p[:, 0, None], p[:, 1, None, None], p[:, [5, 6, 6], None]
    u = (grid[None] - p[:, 2:5, None]) / (2 * widths)
    bell = np.exp(-(u**2).sum(axis=1))
    lifted = height * bell[:, None]
    by_centre, by_width = lifted * u / widths, lifted * 2 * u**2 / widths
    jac = np.stack([np.ones_like(bell), bell, *by_centre.transpose(1, 0, 2), by_width[:, 0], by_width[:, 1] + by_width[:, 2]], axis=1)
    return level + height[:, 0] * bell, jac


def fit_gaussians(data: np.ndarray, sigma: float = 1.0, center: str | tuple | None = "max", method: str = "LS", rounds: int = 200) -> np.ndarray:
    """FIT_COLUMNS of the spots in volumes (spots, z, y, x) by damped Gauss-Newton steps, for squared errors (LS) or the Poisson
    deviance (MLE), all volumes in one array; those that have converged leave it. center starts the search: "max", three coordinates, or the
    middle for None. A volume of zeros only has no fit: -1 throughout."""
    if method not in ("LS", "MLE"):
        raise ValueError(f"no such method: {method}")
    size = max(1, BLOCK // max(1, int(np.prod(data.shape[1:]))))
    if len(data) > size:  # what is worked at once stays in the cache
        return np.concatenate([fit_gaussians(data[i : i + size], sigma, center, method, rounds) for i in range(0, len(data), size)])
    shape, all_y = data.shape[1:], data.reshape(len(data), -1).astype(float)
    out = np.full((len(data), len(FIT_COLUMNS)), -1.0)
    active = np.flatnonzero(all_y.any(axis=1)) if all_y.size else np.zeros(0, int)
    if not len(active):
        return out
    y, grid = all_y[active], np.indices(shape).reshape(3, -1).astype(float)
    if center is None:
        start = np.tile([s // 2 for s in shape], (len(y), 1))
    elif isinstance(center, str):
        start = np.stack(np.unravel_index(y.argmax(axis=1), shape), axis=1)
    else:
        start = np.tile(center, (len(y), 1))
    p = np.column_stack([y.min(axis=1), y.max(axis=1), start, np.full((len(y), 2), sigma)]).astype(float)

    def cost(f: np.ndarray, y: np.ndarray) -> np.ndarray:
        if method == "LS":
            return ((f - y) ** 2).sum(axis=1)
        terms = np.where(y > 0, y * np.log(np.where(f > 0, f, 1) / np.where(y > 0, y, 1)), 0)
        return np.where((f <= 0).any(axis=1), np.inf, 2 * (f - y).sum(axis=1) - 2 * terms.sum(axis=1))

    if method == "MLE":
        p[:, 0] = np.maximum(p[:, 0], 1e-6)
    f, jac = gaussians(p, grid)
    best, damp = cost(f, y), np.full(len(y), 1e-3)
    place = np.arange(p.shape[1])
    for _ in range(rounds):
        weighted = jac if method == "LS" else jac * (y / f**2)[:, None]
        slope = (jac @ (f - y if method == "LS" else 1 - y / f)[:, :, None])[:, :, 0]
        curve = weighted @ jac.transpose(0, 2, 1)
        diagonal = curve[:, place, place]
        curve[:, place, place] += damp[:, None] * (diagonal + 1e-12)
        q = p - (np.linalg.pinv(curve, rcond=1e-15 * len(place), hermitian=True) @ slope[:, :, None])[:, :, 0]
        with np.errstate(all="ignore"):
            g, next_jac = gaussians(q, grid)
            fine = np.isfinite(g).all(axis=1) & np.isfinite(next_jac).all(axis=(1, 2))
            tried = np.where(fine, cost(np.where(fine[:, None], g, 1.0), y), np.inf)
        better = tried < best
        gain = np.where(better, best - tried, np.inf)
        p[better], f[better], jac[better], best[better] = q[better], g[better], next_jac[better], tried[better]
        damp = np.where(better, np.maximum(damp / 10, 1e-12), damp * 10)
        done = (gain <= 1e-12 * (best + 1e-12)) | (damp > 1e12)
        if done.any():
            out[active[done]] = p[done]
            active, y, p, f, jac, best, damp = (x[~done] for x in (active, y, p, f, jac, best, damp))
        if not len(active):
            break
    out[active] = p
    return out


def fit_gaussian(voxels: np.ndarray, sigma: float = 1.0, center: str | tuple | None = "max", method: str = "LS", rounds: int = 200) -> tuple[float, ...]:
    """FIT_COLUMNS of the spot in one array; of zeros only, or of other than three dimensions, it has no fit: -1 throughout."""
    data = np.asarray(voxels, float)
    if method not in ("LS", "MLE"):
        raise ValueError(f"no such method: {method}")
    return NO_FIT if data.ndim != 3 or not data.size else tuple(fit_gaussians(data[None], sigma, center, method, rounds)[0].tolist())


def phase_shift(reference: np.ndarray, moving: np.ndarray, downsample: int = 1) -> tuple[int, ...]:
    """The whole-pixel shift that registers moving with reference, by phase correlation."""
    every = (slice(None, None, downsample),) * reference.ndim
    a, b = np.asarray(reference, float)[every], np.asarray(moving, float)[every]
    if a.shape != b.shape:
        raise ValueError(f"images differ in shape: {a.shape} and {b.shape}")
    cross = np.fft.fftn(a) * np.conj(np.fft.fftn(b))
    size = np.abs(cross)
    peak = np.unravel_index(int(np.abs(np.fft.ifftn(cross / np.where(size > 1e-12 * size.max(initial=0.0), size, np.inf))).argmax()), a.shape)
    return tuple((int(k) - n if k > n // 2 else int(k)) * downsample for k, n in zip(peak, a.shape, strict=True))


def crop(image: np.ndarray, low: np.ndarray, high: np.ndarray, pads: np.ndarray, background: bool = False) -> tuple[np.ndarray, str | None]:
    """The box of an image with its pads (3 lower, 3 upper), and the reason where there is none: zeros then stand for it.
    Bounds are floored, lower pads rounded up and upper pads down."""
    start, stop = np.floor(low).astype(int), np.floor(high).astype(int)
    before, after = np.ceil(pads[:3]).astype(int), np.floor(pads[3:]).astype(int)
    reason = None
    if (stop > np.array(image.shape)).any():
        reason = "out of bounds"
    elif (start == stop).any():
        reason = "empty"
    elif not background and (np.concatenate([before[1:], after[1:]]) != 0).any():
        reason = "padded in y or x"
    box = np.zeros(np.maximum(stop - start, 0), image.dtype) if reason else image[tuple(slice(a, b) for a, b in zip(start, stop, strict=True))]
    return np.pad(box, list(zip(np.maximum(before, 0), np.maximum(after, 0), strict=True)), mode="edge" if box.size and not reason else "constant"), reason


def rigid_onto(points: np.ndarray, target: np.ndarray, good: np.ndarray | None = None) -> np.ndarray:
    """All points moved by the rotation and translation that fit the good ones to target best in squared distance."""
    keep = np.ones(len(points), bool) if good is None else good
    if not keep.any():
        return points
    a, b = points[keep], target[keep]
    u, _, vt = np.linalg.svd((a - a.mean(axis=0)).T @ (b - b.mean(axis=0)))
    flip = np.diag([1.0, 1.0, -1.0 if np.linalg.det(vt.T @ u.T) < 0 else 1.0])
    turn = vt.T @ flip @ u.T
    return (points - a.mean(axis=0)) @ turn.T + b.mean(axis=0)


def rigid_onto_all(points: np.ndarray, target: np.ndarray, good: np.ndarray) -> np.ndarray:
    """rigid_onto for many sets of points at once (set, point, axis), each with good points of its own, three or more."""
    weight = good[..., None] / good.sum(1)[:, None, None]
    a, b = np.where(good[..., None], points, 0.0), np.where(good[..., None], target, 0.0)
    mean_a, mean_b = (a * weight).sum(1, keepdims=True), (b * weight).sum(1, keepdims=True)
    u, _, vt = np.linalg.svd(np.swapaxes(np.where(good[..., None], a - mean_a, 0.0), 1, 2) @ np.where(good[..., None], b - mean_b, 0.0))
    v, ut = np.swapaxes(vt, 1, 2), np.swapaxes(u, 1, 2)
    v = v * np.stack([np.ones(len(points)), np.ones(len(points)), np.where(np.linalg.det(v @ ut) < 0, -1.0, 1.0)], 1)[:, None, :]
    return (points - mean_a) @ np.swapaxes(v @ ut, 1, 2) + mean_b


def aligned_rmse(points: np.ndarray, target: np.ndarray, good: np.ndarray | None = None) -> float:
    """Root mean squared distance of the good points after alignment; NaN without any."""
    keep = np.ones(len(points), bool) if good is None else good
    if not keep.any():
        return float("nan")
    return float(np.sqrt(((rigid_onto(points, target, keep)[keep] - target[keep]) ** 2).sum(axis=1).mean()))


def plane_normal(points: np.ndarray) -> np.ndarray:
    """Unit normal of the plane through the points: the null direction of their homogeneous coordinates."""
    normal = np.linalg.svd(np.column_stack([points, np.ones(len(points))]), full_matrices=True)[2][3, :3]
    return normal / np.linalg.norm(normal)


def spline_basis(knots: np.ndarray, degree: int, at: np.ndarray) -> np.ndarray:
    """Values (len(at), functions) of the B-splines of a knot vector."""
    last = np.flatnonzero(knots[:-1] < knots[1:])[-1]
    inside = np.clip(np.searchsorted(knots, at, "right") - 1, degree, last)
    values = np.zeros((len(at), len(knots) - 1))
    values[np.arange(len(at)), inside] = 1.0
    for k in range(1, degree + 1):
        n = len(knots) - 1 - k
        rise, fall = knots[k : k + n] - knots[:n], knots[k + 1 : k + 1 + n] - knots[1 : 1 + n]
        left = np.where(rise > 0, (at[:, None] - knots[:n]) / np.where(rise > 0, rise, 1), 0)
        right = np.where(fall > 0, (knots[k + 1 : k + 1 + n] - at[:, None]) / np.where(fall > 0, fall, 1), 0)
        values = left * values[:, :n] + right * values[:, 1 : n + 1]
    return values


def spline_through(points: np.ndarray, n: int = 100) -> np.ndarray:
    """n points, evenly spaced in the parameter, of the quadratic spline through all points (K19). The parameter is the length of
    the path as a share; knots lie half way between neighbours. Repeated neighbours count once; fewer than three points are joined
    by a line."""
    p = points[np.concatenate([[True], (np.diff(points, axis=0) != 0).any(axis=1)])]
    u = np.concatenate([[0.0], np.cumsum(np.linalg.norm(np.diff(p, axis=0), axis=1))])
    at = np.linspace(0, 1, n)
    if len(p) < 3:
        return p[0] + at[:, None] * (p[-1] - p[0])
    u /= u[-1]
    knots = np.concatenate([[0.0] * 3, (u[1:-2] + u[2:-1]) / 2, [1.0] * 3])
    return spline_basis(knots, 2, at) @ np.linalg.solve(spline_basis(knots, 2, u), p)


def smallest_reached(parent: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The smallest number that each of the numbers from 0 on reaches by edges (two rows of numbers). At first each is its own parent; those
    that have their count as parent are left out, and no edge may name them."""
    size = len(parent)
    while edges.shape[1]:
        roots = parent[edges]
        least = roots.min(axis=0)
        np.minimum.at(parent, roots[0], least)
        np.minimum.at(parent, roots[1], least)
        while True:
            inside = parent < size
            jumped = parent.copy()
            jumped[inside] = parent[parent[inside]]
            if (jumped == parent).all():
                break
            parent = jumped
        edges = edges[:, parent[edges[0]] != parent[edges[1]]]
    return parent
