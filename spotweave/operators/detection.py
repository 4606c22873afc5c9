"""Detection over tables of images, and drift from beads (K1, K2, K4, K8 to K11). An image is a row (keys, voxels, shape); each is worked by
itself in small Arrow batches, so nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.functions import detection, kernels
from spotweave.operators.geometry import AXES
from spotweave.runtime import limit_batches

REGION = "label long, zc double, yc double, xc double, area double, intensityMean double, max_intensity double"


def _image(voxels, shape) -> np.ndarray:
    return np.asarray(voxels, float).reshape(tuple(int(n) for n in shape))


def _regions_of(images: DataFrame, keys: list[str], found: Callable[[np.ndarray], list[dict]], rows: int) -> DataFrame:
    limit_batches(images.sparkSession, rows)
    names = [c.split()[0] for c in REGION.split(", ")]

    @F.pandas_udf(f"array<struct<{', '.join(c.replace(' ', ': ') for c in REGION.split(', '))}>>")
    def work(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for voxels, shapes in batches:
            out = [[{n: (int(r[n]) if n == "label" else float(r.get(n, 0.0))) for n in names} for r in found(_image(v, s))] if v is not None else [] for v, s in zip(voxels, shapes, strict=True)]
            yield pd.Series(out, dtype=object)

    return images.select(*keys, F.explode(work("voxels", "shape")).alias("r")).select(*keys, "r.*")


def detect_spots(images: DataFrame, keys: list[str], method: str = "dog", threshold: float = 10.0, *, rows: int = 4) -> DataFrame:
    """keys and one row for each spot of an image, by intensity or difference of blurs (K1)."""
    return _regions_of(images, keys, lambda image: detection.detect(image, method, threshold), rows)


def bead_regions(images: DataFrame, keys: list[str], threshold: float, *, sigma: float = 1.0, rows: int = 4) -> DataFrame:
    """keys and one row for each bead of a blurred image, with the properties that fail codes are made from (K9)."""
    return _regions_of(images, keys, lambda image: detection.regions(detection.labelled(detection.smoothed(image, sigma) > threshold), image), rows)


def nuclei(images: DataFrame, keys: list[str], *, sigma: float = 2.0, threshold: float | None = None, least_area: int = 1, split: bool = False, prominence: float = 1.0, rows: int = 4) -> DataFrame:
    """keys and one row for each nucleus (K11, without learned models): the parts above a threshold, which the blurred image gives itself
    where none is given, with what they enclose, of least_area pixels or more. With split, touching nuclei are parted by their depth."""

    def found(image: np.ndarray) -> list[dict]:
        blurred = detection.smoothed(image, sigma)
        mask = detection.without_holes(blurred > (detection.otsu(blurred) if threshold is None else threshold))
        whole = detection.labelled(mask)
        mask &= np.bincount(whole.ravel())[whole] >= least_area
        return detection.regions(detection.basins(mask, prominence) if split else detection.labelled(mask), image)

    return _regions_of(images, keys, found, rows)


def without_crosstalk(images: DataFrame, threshold: float = 500.0, *, rows: int = 4) -> DataFrame:
    """Images (voxels, bleed, shape) with the other channel's light taken off (K2)."""
    limit_batches(images.sparkSession, rows)

    @F.pandas_udf("array<double>")
    def clean(source: pd.Series, bleed: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([detection.without_crosstalk(_image(a, s), _image(b, s), threshold).ravel().tolist() for a, b, s in zip(source, bleed, shape, strict=True)], dtype=object)

    return images.withColumn("voxels", clean("voxels", "bleed", "shape")).drop("bleed")


def cropped(boxes: DataFrame, images: DataFrame, keys: list[str], *, background: int | None = None, rows: int = 4) -> DataFrame:
    """The voxels of every box (bounds {a}_lo, {a}_hi and pads {a}_pad_lo, {a}_pad_hi) of its image, with their shape and the
    reason where there are none (K8, K10). The image travels once for each box of it: group boxes by image where they are many."""
    limit_batches(boxes.sparkSession, rows)

    @F.pandas_udf("voxels array<double>, shape array<int>, reason string")
    def cut(v: pd.Series, s: pd.Series, box: pd.DataFrame, time: pd.Series) -> pd.DataFrame:
        out = []
        for voxels, shape, b, t in zip(v, s, box.to_dict("records"), time, strict=True):
            side = lambda k, b=b: np.array([b[f"{a}_{k}"] for a in AXES], float)
            piece, reason = kernels.crop(_image(voxels, shape), side("lo"), side("hi"), np.concatenate([side("pad_lo"), side("pad_hi")]), t == background)
            out.append((piece.ravel().tolist(), list(piece.shape), reason))
        return pd.DataFrame(out, columns=["voxels", "shape", "reason"])

    bounds = F.struct(*[f"{a}_{k}" for a in AXES for k in ("lo", "hi", "pad_lo", "pad_hi")])
    joined = boxes.join(images.select(*keys, "voxels", "shape"), keys)
    return joined.select(*boxes.columns, cut("voxels", "shape", bounds, "timepoint").alias("c")).select(*boxes.columns, "c.*")


def fine_drift(fits: DataFrame, reference_time: int, share: float = 0.2) -> DataFrame:
    """(fov, timepoint, {a}_fine): the trimmed mean, over the beads fitted at both timepoints, of reference less moving centre (K4).
    A timepoint without common beads has 0 on each axis."""
    ref = fits.where(F.col("timepoint") == reference_time).select("fov", "bead_id", *[F.col(a).alias(f"{a}_ref") for a in AXES])
    moved = fits.join(ref, ["fov", "bead_id"]).select("fov", "timepoint", *[(F.col(f"{a}_ref") - F.col(a)).alias(a) for a in AXES])
    n = F.count("*").over(Window.partitionBy("fov", "timepoint"))
    k = F.floor(F.col("n") * F.lit(share))
    ranked = moved.withColumn("n", n).withColumns({f"{a}_rank": F.row_number().over(Window.partitionBy("fov", "timepoint").orderBy(a)) for a in AXES})
    kept = lambda a: F.when((F.col(f"{a}_rank") > k) & (F.col(f"{a}_rank") <= F.col("n") - k), F.col(a))
    found = ranked.groupBy("fov", "timepoint").agg(*[F.avg(kept(a)).alias(f"{a}_fine") for a in AXES])
    return fits.select("fov", "timepoint").distinct().join(found, ["fov", "timepoint"], "left").fillna(0.0, subset=[f"{a}_fine" for a in AXES])
