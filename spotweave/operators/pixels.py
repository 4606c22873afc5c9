"""Kernels over tables (K3, K6, K7, K16, K20). An image is an array column in (z, y, x) order with its shape beside it; each row
is worked by itself, in Arrow batches, so nothing is shuffled but for the pairs of aligned traces."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions import kernels
from spotweave.runtime import limit_batches

FIT = ", ".join(f"{c} double" for c in kernels.FIT_COLUMNS)


def fit_spots(df: DataFrame, voxels: str = "voxels", shape: str = "shape", *, sigma: float = 1.0, center: str | None = "max", method: str = "LS", rows: int = 200) -> DataFrame:
    """df without its voxels and with the fitted columns; null, misshapen or all-zero voxels give -1 throughout (K6, K7). The volumes
    of an Arrow batch that are alike in shape are fitted as one array."""
    limit_batches(df.sparkSession, rows)

    @F.pandas_udf(FIT)
    def fitted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for vs, ss in batches:
            out, alike = np.full((len(vs), len(kernels.FIT_COLUMNS)), -1.0), defaultdict(list)
            for i, (v, s) in enumerate(zip(vs, ss, strict=True)):
                if v is not None and s is not None and len(s) == 3 and len(v) == int(np.prod(s)):
                    alike[tuple(int(n) for n in s)].append(i)
            for size, at in alike.items():
                out[at] = kernels.fit_gaussians(np.stack([np.asarray(vs.iloc[i], float) for i in at]).reshape(len(at), *size), sigma, center, method)
            yield pd.DataFrame(out, columns=list(kernels.FIT_COLUMNS))

    kept = [c for c in df.columns if c not in (voxels, shape, *kernels.FIT_COLUMNS)]
    return df.select(*kept, fitted(voxels, shape).alias("fit")).select(*kept, "fit.*")


def coarse_drift(images: DataFrame, reference_time: int, *, downsample: int = 1, rows: int = 4) -> DataFrame:
    """(fieldOfView, timepoint, {z,y,x}DriftCoarsePixels) of images (fieldOfView, timepoint, voxels, shape) against the reference
    timepoint of the same field of view (K3). A field without a reference image has no rows."""
    limit_batches(images.sparkSession, rows)
    reference = images.where(F.col("timepoint") == reference_time).select("fieldOfView", F.col("voxels").alias("ref"))

    @F.pandas_udf("zDriftCoarsePixels double, yDriftCoarsePixels double, xDriftCoarsePixels double")
    def shifts(ref: pd.Series, moving: pd.Series, shape: pd.Series) -> pd.DataFrame:
        got = [kernels.phase_shift(np.reshape(a, tuple(s)), np.reshape(b, tuple(s)), downsample) for a, b, s in zip(ref, moving, shape, strict=True)]
        return pd.DataFrame(got, columns=["zDriftCoarsePixels", "yDriftCoarsePixels", "xDriftCoarsePixels"], dtype=float)

    joined = images.join(reference, "fieldOfView")
    return joined.select("fieldOfView", "timepoint", shifts("ref", "voxels", "shape").alias("d")).select("fieldOfView", "timepoint", "d.*")


def traces_as_rows(points: DataFrame, keys: list[str], time: str = "timepoint") -> DataFrame:
    """One row for each trace: its points in the order of time, as arrays z, y, x and good (from qcPass)."""
    one = F.struct(time, "z", "y", "x", (F.col("qcPass") == 1).alias("good"))
    row = points.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("p"))
    return row.select(*keys, *[F.col("p")[c].alias(c) for c in (time, "z", "y", "x", "good")])


def aligned_to(traces: DataFrame, template: tuple[list[float], list[float], list[float]]) -> DataFrame:
    """Distance of every trace (arrays z, y, x, good) to one template of the same length after the best rigid motion (K16);
    null where lengths differ or no point is good."""
    target = np.array(template, float).T

    @F.pandas_udf("double")
    def rmse(z: pd.Series, y: pd.Series, x: pd.Series, good: pd.Series) -> pd.Series:
        out = []
        for a, b, c, g in zip(z, y, x, good, strict=True):
            p, keep = np.column_stack([a, b, c]).astype(float), np.asarray(g, bool)
            out.append(kernels.aligned_rmse(p, target, keep) if p.shape == target.shape and keep.any() else None)
        return pd.Series(out, dtype=float)

    return traces.withColumn("rmse", rmse("z", "y", "x", "good"))


def plane_normals(traces: DataFrame) -> DataFrame:
    """The unit normal of each trace's points (arrays z, y, x), up to its sign; null for fewer than three points."""

    @F.pandas_udf("array<double>")
    def normal(z: pd.Series, y: pd.Series, x: pd.Series) -> pd.Series:
        return pd.Series([kernels.plane_normal(np.column_stack([a, b, c]).astype(float)).tolist() if len(a) >= 3 else None for a, b, c in zip(z, y, x, strict=True)], dtype=object)

    return traces.withColumn("normal", normal("z", "y", "x"))


def interpolated(traces: DataFrame, n: int = 100) -> DataFrame:
    """Traces (arrays z, y, x, good) with the arrays z, y and x of n points on the spline through their good points (K19); null
    arrays without any."""

    @F.pandas_udf("z array<double>, y array<double>, x array<double>")
    def fine(z: pd.Series, y: pd.Series, x: pd.Series, good: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c, g in zip(z, y, x, good, strict=True):
            p = np.column_stack([a, b, c]).astype(float)[np.asarray(g, bool)]
            out.append(kernels.spline_through(p, n).T.tolist() if len(p) else [None] * 3)
        return pd.DataFrame(out, columns=["z", "y", "x"])

    others = [c for c in traces.columns if c not in ("z", "y", "x")]
    return traces.select(*others, fine("z", "y", "x", "good").alias("f")).select(*others, "f.*")
