"""Quality control of fitted spots (FL4 to FL8, P13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.geometry import AXES

FLAGS = ("within_region", "sufficient_snr", "dense_xy", "dense_z", "in_bounds_z", "in_bounds_y", "in_bounds_x")


def qc_flags(max_dist: float, min_snr: float, max_sigma_xy: float, max_sigma_z: float) -> dict[str, Column]:
    """The seven flags. All comparisons are strict; a centre must lie further than its sigma (at least 0) from both ends of the box."""
    c = F.col

    def inside(axis: str) -> Column:
        sigma = F.greatest(c("sigma_z" if axis == "z" else "sigma_xy"), F.lit(0.0))
        return (sigma < c(axis)) & (c(axis) < c(f"box_{axis}") - sigma)

    return {
        "within_region": c("ref_dist") < max_dist,
        "sufficient_snr": c("signal") > min_snr * c("background"),
        "dense_xy": (c("sigma_xy") > 0) & (c("sigma_xy") < max_sigma_xy),
        "dense_z": (c("sigma_z") > 0) & (c("sigma_z") < max_sigma_z),
        **{f"in_bounds_{a}": inside(a) for a in AXES},
    }


def label_qc(df: DataFrame, **limits: float) -> DataFrame:
    """df with the flags and qc_pass as 0 or 1; a null makes a flag 0."""
    flags = {k: F.coalesce(v, F.lit(False)).cast("int") for k, v in qc_flags(**limits).items()}
    return df.withColumns(flags).withColumn("qc_pass", reduce(lambda a, b: a * b, [F.col(f) for f in FLAGS]))


def fail_codes() -> Column:
    """Reasons R, S, xy, z, O in this order, joined by spaces; empty for a pass (FL5)."""
    bad = lambda *fs: reduce(lambda a, b: a | b, [F.col(f) == 0 for f in fs])
    codes = [("R", bad("within_region")), ("S", bad("sufficient_snr")), ("xy", bad("dense_xy")), ("z", bad("dense_z")), ("O", bad("in_bounds_z", "in_bounds_y", "in_bounds_x"))]
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in codes])), " ")


def qc_filtered(labelled: DataFrame, keys: list[str], excluded: list[int], min_length: int) -> DataFrame:
    """Passing rows outside the excluded timepoints whose group keeps min_length rows or more (FL7, FL8)."""
    kept = labelled.where(F.col("qc_pass") == 1)
    if excluded:
        kept = kept.where(~F.col("timepoint").isin(excluded))
    return kept.withColumn("n_", F.count("*").over(Window.partitionBy(*keys))).where(F.col("n_") >= min_length).drop("n_")


def display_class(size: tuple[int, int, int]) -> Column:
    """pass, fail or invisible: the centre (pixels) must lie inside the box to be shown (FL6)."""
    seen = reduce(lambda a, b: a & b, [(F.col(f"{a}_px") > 0) & (F.col(f"{a}_px") < n) for a, n in zip(AXES, size, strict=True)])
    return F.when(~F.coalesce(seen, F.lit(False)), "invisible").when(F.col("qc_pass") == 1, "pass").otherwise("fail")
