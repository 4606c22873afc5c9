"""From regions to traced spots (J9 to J13, P6 to P8, FL13, K8, K21)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.checks import require_none, require_unique
from spotweave.operators.geometry import AXES, crop, distance

PAIR_KEYS = ["fov", "trace_id", "roi_id", "timepoint"]


def expand_bounds(rois: DataFrame, drift: DataFrame, loci: DataFrame | None, background: int | None, shape: tuple[int, int, int]) -> DataFrame:
    """One row for each roi and eligible timepoint of its fov, with the crop of each axis (J9, J10, SC9).

    Eligible: locus timepoints of the region, the region's own, the background; regions without loci are left
    out; without a grouping (loci None) all timepoints. loci: (ref_timepoint, timepoint)."""
    regions = rois.withColumnRenamed("timepoint", "ref_timepoint")
    moves = [f"{a}_{k}" for a in AXES for k in ("coarse", "fine")]
    ref = drift.select("fov", F.col("timepoint").alias("ref_timepoint"), *[F.col(f"{a}_coarse").alias(f"{a}_ref") for a in AXES])
    rows = regions.join(drift.select("fov", "timepoint", *moves), "fov").join(ref, ["fov", "ref_timepoint"])
    if loci is not None:
        known = loci.select("ref_timepoint").distinct()
        rows = rows.join(known, "ref_timepoint", "left_semi").join(loci.withColumn("is_locus", F.lit(True)), ["ref_timepoint", "timepoint"], "left")
        own = (F.col("timepoint") == F.col("ref_timepoint")) | F.coalesce("is_locus", F.lit(False))
        rows = rows.where(own | (F.col("timepoint") == F.lit(background)) if background is not None else own).drop("is_locus")
    out = {}
    for a, n in zip(AXES, shape, strict=True):
        for k, c in crop(F.col(f"{a}_min"), F.col(f"{a}_max"), F.col(f"{a}_coarse"), F.col(f"{a}_ref"), n).items():
            out[f"{a}_{k}"] = c
    return rows.withColumns(out)


def skip_reason(shape: tuple[int, int, int], background: int | None = None) -> Column:
    """Why a crop gives no voxels: out of bounds, empty or padded in y or x; null if it does (K8)."""
    any_of = lambda f: reduce(lambda p, q: p | q, [f(a, n) for a, n in zip(AXES, shape, strict=True)])
    padded = reduce(lambda p, q: p | q, [F.col(f"{a}_{s}") != 0 for a in ("y", "x") for s in ("pad_lo", "pad_hi")])
    allowed = F.col("timepoint") == F.lit(background) if background is not None else F.lit(False)
    return F.when(any_of(lambda a, n: F.floor(f"{a}_hi") > n), "out_of_bounds").when(any_of(lambda a, _: F.floor(f"{a}_lo") == F.floor(f"{a}_hi")), "empty").when(padded & ~allowed, "padding")


def pair_rois_fits(rois: DataFrame, fits: DataFrame, *, background: int | None = None, validate: bool = True) -> DataFrame:
    """Inner 1:1 join of extraction rows and fits (J11); validated: unique keys and equal counts."""
    if background is not None:
        rois = rois.where(F.col("timepoint") != background)
    joined = rois.join(fits, PAIR_KEYS)
    if validate:
        require_unique(rois, PAIR_KEYS, "roi row")
        require_unique(fits, PAIR_KEYS, "fit")
        counts = (rois.count(), fits.count(), joined.count())
        if len(set(counts)) > 1:
            raise ValueError(f"rois, fits and pairs differ in number: {counts}")
    return joined


def to_nanometres(df: DataFrame, scale: tuple[float, float, float]) -> DataFrame:
    """Drift-corrected centres (z_px + fine drift) and nanometre columns z, y, x."""
    out = {f"{a}_px_dc": F.col(f"{a}_px") + F.col(f"{a}_fine") for a in AXES}
    return df.withColumns(out).withColumns({a: F.col(f"{a}_px_dc") * float(s) for a, s in zip(AXES, scale, strict=True)})


def sizes_in_nanometres(df: DataFrame, scale: tuple[float, float, float], box: tuple[int, int, int]) -> DataFrame:
    """sigma_z and sigma_xy from pixels, and the box of the fit as box_z, box_y, box_x."""
    z, _, x = scale
    sizes = {f"box_{a}": F.lit(float(n) * float(s)) for a, n, s in zip(AXES, box, scale, strict=True)}
    return df.withColumns({"sigma_z": F.col("sigma_z_px") * float(z), "sigma_xy": F.col("sigma_xy_px") * float(x), **sizes})


def drift_accuracy(fits: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Refitted beads against their reference points: the centre with fine drift added, the absolute difference on each axis
    and the distance (K15). Beads without a reference point have none."""
    ref = reference.select(*keys, *[F.col(a).alias(f"{a}_ref") for a in AXES])
    moved = fits.withColumns({a: F.col(a) + F.col(f"{a}_fine") for a in AXES}).join(ref, keys, "left")
    out = moved.withColumns({f"{a}_error": F.abs(F.col(a) - F.col(f"{a}_ref")) for a in AXES})
    return out.withColumn("error", distance(tuple(F.col(a) for a in AXES), tuple(F.col(f"{a}_ref") for a in AXES)))


def with_reference_distance(df: DataFrame, keys: list[str], is_reference: Column, *, validate: bool = True) -> DataFrame:
    """df with *_ref and ref_dist to the reference row of its keys (J12); a missing one is an error, or null if not validated."""
    ref = df.where(is_reference).select(*keys, *[F.col(a).alias(f"{a}_ref") for a in AXES])
    out = df.join(ref, keys, "left").withColumn("ref_dist", distance(tuple(F.col(a) for a in AXES), tuple(F.col(f"{a}_ref") for a in AXES)))
    return require_none(out, F.col("z_ref").isNull(), "no reference row") if validate else out


def nuclear_label(spots: DataFrame, mask: DataFrame) -> DataFrame:
    """spots with the label of the mask pixel under their truncated centre, 0 outside (J14); mask: fov, z, y, x, label."""
    at = [F.col(f"{a}c").cast("long").alias(f"{a}_at") for a in AXES]
    pixels = mask.select("fov", *[F.col(a).cast("long").alias(f"{a}_at") for a in AXES], "label")
    return spots.select("*", *at).join(pixels, ["fov", "z_at", "y_at", "x_at"], "left").withColumn("label", F.coalesce("label", F.lit(0))).drop("z_at", "y_at", "x_at")


def fill_times(df: DataFrame, keys: list[str], times: DataFrame, values: list[str]) -> DataFrame:
    """Every (keys, timepoint) of the grid, zeros where df has no row."""
    listed = [r.timepoint for r in times.select("timepoint").distinct().orderBy("timepoint").collect()]  # the rounds of an experiment
    grid = df.select(*keys).distinct().select("*", F.explode(F.array(*[F.lit(t) for t in listed])).alias("timepoint"))
    return grid.join(df, [*keys, "timepoint"], "left").fillna(0, subset=values)
