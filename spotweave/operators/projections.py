"""Columns derived from the row alone, and filters on them (P1, P2, P8, P9, P11, P13 to P15, FL1, FL3, FL10 to FL12, S6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.checks import require_found, require_none
from spotweave.operators.geometry import AXES


def with_context(df: DataFrame, fov: str | Column, timepoint: int | Column, channel: int | Column) -> DataFrame:
    """df with fov, timepoint and channel as its first columns (P1); columns of these names are replaced."""
    own = [c for c in df.columns if c not in ("fov", "timepoint", "channel")]
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select(lit(fov).alias("fov"), lit(timepoint).alias("timepoint"), lit(channel).alias("channel"), *own)


def scaled(df: DataFrame, columns: list[str], factor: float) -> DataFrame:
    """df with columns brought back from a downsampled image."""
    return df.withColumns({c: F.col(c) * factor for c in columns})


def with_timepoint_name(df: DataFrame, rounds: DataFrame, *, validate: bool = True) -> DataFrame:
    """df with timepoint_name from the rounds (timepoint, timepoint_name); an unknown timepoint is an error, or null unless validated."""
    if validate:
        require_found(df, rounds, ["timepoint"], "imaging round")
    return df.join(rounds.select("timepoint", "timepoint_name"), "timepoint", "left")


def with_probe_name(df: DataFrame, names: list[str], index: str = "timepoint", *, validate: bool = True) -> DataFrame:
    """df with probe_name, the entry of a list that starts at 1 for index 0; an index beyond the list is an error."""
    if validate:
        require_none(df, ~F.col(index).between(0, len(names) - 1), "no probe name")
    listed = F.array(*[F.lit(n) for n in names])
    return df.withColumn("probe_name", F.when(F.col(index).between(0, len(names) - 1), F.get(listed, F.col(index).cast("int"))))


def signed_difference(a: Column, b: Column) -> Column:
    """Pixel by pixel a - b as signed integers, for unsigned images."""
    return F.zip_with(a, b, lambda x, y: x.cast("int") - y.cast("int"))


def signal_to_noise(signal: Column, background: Column) -> Column:
    return F.when(background != 0, signal / background)


def snr_flag(signal: Column, background: Column, least: float) -> Column:
    """1 where the ratio reaches least, else 0."""
    return F.when(signal_to_noise(signal, background) >= least, 1).otherwise(0)


def box_relative_centre() -> dict[str, Column]:
    """Centres of fits in image pixels: the place in the box plus the box's origin."""
    return {f"{a}c": F.col(f"{a}_px") + F.col(f"{a}_min") for a in AXES}


def in_nuclear_frame(df: DataFrame) -> DataFrame:
    """Points moved by minus the nuclear drift, and those of regional spots by their own drift besides.
    Columns: roi_type, {a}c, {a}_nuclear, {a}_coarse, {a}_fine."""
    own = lambda a: F.when(F.col("roi_type") == "regional", F.col(f"{a}_coarse") + F.col(f"{a}_fine")).otherwise(0.0)
    return df.withColumns({f"{a}c": F.col(f"{a}c") - F.col(f"{a}_nuclear") + own(a) for a in AXES})


def in_nuclei(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with a nucleus (FL1)."""
    return df.where(F.col(label) != 0)


def outside_nuclei(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows without a nucleus, and without the label (FL3)."""
    return df.where(F.col(label) == 0).drop(label)


def passing_in_channel(df: DataFrame, channel: int, flag: str = "qc_pass") -> DataFrame:
    """FL10."""
    return df.where((F.col(flag) == 1) & (F.col("channel") == channel))


def without_pairs(df: DataFrame, problems: DataFrame, keys: tuple[str, ...] = ("fov", "timepoint")) -> DataFrame:
    """Rows whose keys are not among the problems (FL11); null keys match nothing and stay."""
    return df.join(problems.select(*keys).distinct(), list(keys), "left_anti")


def eligible(df: DataFrame, pool: DataFrame, *, validate: bool = True) -> DataFrame:
    """Rows whose timepoint is in the pool and whose z is not negative; one outside the pool is an error when validated (FL12)."""
    if validate:
        require_found(df, pool, ["timepoint"], "eligible timepoint")
    return df.join(pool.select("timepoint").distinct(), "timepoint", "left_semi").where("zc >= 0")


def first_fields(df: DataFrame, last_fov: int) -> DataFrame:
    """Rows of the fields of view up to a limit, for a run that is to stop there."""
    return df.where(F.col("fov") <= last_fov)
