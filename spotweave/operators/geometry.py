"""Distances, boxes and crops as Column functions (SC1, SC2, SC9, P3, A13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


def distance(a: tuple[Column, ...], b: tuple[Column, ...], scale: tuple[float, ...] = (1.0, 1.0, 1.0)) -> Column:
    """Euclidean distance of two points, each axis times its scale; null where a coordinate is null."""
    total = F.lit(0.0)
    for p, q, s in zip(a, b, scale, strict=True):
        d = (p - q) * F.lit(float(s))
        total = total + d * d
    return F.sqrt(total)


def centre(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{a}c") for a in AXES)


def box_around(size: tuple[int, int, int]) -> dict[str, Column]:
    """Bounds of a box of the given size (halved by integer division) around the centre."""
    out = {}
    for a, s in zip(AXES, size, strict=True):
        out[f"{a}_min"], out[f"{a}_max"] = F.col(f"{a}c") - float(s // 2), F.col(f"{a}c") + float(s // 2)
    return out


def crop(lo: Column, hi: Column, drift: Column, ref_drift: Column, limit: int) -> dict[str, Column]:
    """One axis of a crop after drift (SC9): lo, hi, pad_lo, pad_hi.

    With d = int(drift) - int(ref_drift) the bounds move by -d. Both out: an error (fails the query); out
    below or above: clipped and padded; wholly beyond a side: empty there, padded by the rounded length, halves to even."""
    d = drift.cast("int") - ref_drift.cast("int")
    a, b, n = lo - d, hi - d, F.lit(float(limit))
    length = F.bround(b - a, 0)
    both = F.raise_error(F.lit("both sides of a crop lie outside the image"))
    zero = F.lit(0.0)
    case = F.when(a >= n, F.struct(n.alias("lo"), n.alias("hi"), length.alias("pad_lo"), zero.alias("pad_hi")))
    case = case.when(b <= 0, F.struct(zero.alias("lo"), zero.alias("hi"), zero.alias("pad_lo"), length.alias("pad_hi")))
    case = case.when((a < 0) & (b > n), F.struct(both.cast("double").alias("lo"), zero.alias("hi"), zero.alias("pad_lo"), zero.alias("pad_hi")))
    case = case.when(a < 0, F.struct(zero.alias("lo"), b.alias("hi"), (-a).alias("pad_lo"), zero.alias("pad_hi")))
    case = case.when(b > n, F.struct(a.alias("lo"), n.alias("hi"), zero.alias("pad_lo"), (b - n).alias("pad_hi")))
    case = case.otherwise(F.struct(a.alias("lo"), b.alias("hi"), zero.alias("pad_lo"), zero.alias("pad_hi")))
    return {k: case[k] for k in ("lo", "hi", "pad_lo", "pad_hi")}
