"""Voxel stacks and pixels as rows (J19, SC4, SC5, A18, A19, K12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.checks import require_unique

#: Parts of the name of a stack: field of view, roi, regional time, trace group (may be empty), trace.
NAME = r"^(P\d{4})_(\d{5,})_(\d+)_(.*)_(\d+)$"
KEY = ["fov", "roi_id", "ref_timepoint", "trace_group", "trace_id"]


def stack_name(fov: Column, roi_id: Column, ref_timepoint: Column, trace_group: Column, trace_id: Column) -> Column:
    """The name of a voxel stack, the roi padded to five digits (SC5, J19)."""
    padded = F.when(F.length(roi_id.cast("string")) < 5, F.lpad(roi_id.cast("string"), 5, "0")).otherwise(roi_id.cast("string"))
    return F.concat_ws("_", fov, padded, ref_timepoint.cast("string"), F.coalesce(trace_group, F.lit("")), trace_id.cast("string"))


def stack_key(name: Column) -> dict[str, Column]:
    """The parts of a stack's name; null throughout where it is none."""
    ok = name.rlike(NAME)
    part = lambda i: F.when(ok, F.regexp_extract(name, NAME, i))
    return {"fov": part(1), "roi_id": part(2).cast("long"), "ref_timepoint": part(3).cast("int"), "trace_group": F.when(part(4) != "", part(4)), "trace_id": part(5).cast("long")}


def match_stacks(rows: DataFrame, names: DataFrame, *, validate: bool = True) -> DataFrame:
    """rows (KEY) with the name of their stack from names (name); a missing one is null, a name that stands twice an error."""
    if validate:
        require_unique(names, ["name"], "stack name")
    return rows.withColumn("name", stack_name(*[F.col(c) for c in KEY])).join(names.select("name", F.lit(True).alias("found")), "name", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def place_and_time(name: Column) -> dict[str, Column]:
    """Numbers after Point and Time in the name of an image file; null unless each stands there once (SC4)."""
    one = lambda kind: F.regexp_extract_all(name, F.lit(rf"{kind}(\d+)"), F.lit(1))
    return {c: F.when(F.size(one(kind)) == 1, F.element_at(one(kind), 1).try_cast("int")) for c, kind in (("position", "Point"), ("time", "Time"))}


def pixel_statistics(df: DataFrame, keys: list[str], pixels: str = "pixels") -> DataFrame:
    """Count, least, largest, sum, mean and median of an array of pixels in each row (A18); an empty one has null statistics."""
    x = F.col(pixels)
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    ordered = F.array_sort(x)
    middle = (F.get(ordered, F.floor((F.size(x) - 1) / 2).cast("int")) + F.get(ordered, F.floor(F.size(x) / 2).cast("int"))) / 2
    n = F.size(x)
    return df.select(*keys, n.alias("n"), F.array_min(x).alias("least"), F.array_max(x).alias("largest"), F.when(n > 0, total).alias("total"), F.when(n > 0, total / n).alias("mean"), F.when(n > 0, middle).alias("median"))


def stack_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Timepoints of each stack."""
    return df.groupBy(*keys).agg(F.count("*").alias("times"))


def largest_stack(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.max("times").alias("times"))


def labelled_centroids(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Mean pixel of each label but 0 of a mask in long form (keys, z, y, x, label)."""
    return mask.where("label <> 0").groupBy(*keys, "label").agg(*[F.avg(a).alias(f"{a}c") for a in ("z", "y", "x")], F.count("*").alias("area"))


def stack_grid(volumes: DataFrame, keys: list[str], slots: DataFrame, *, validate: bool = True) -> DataFrame:
    """Every key with every (ref_timepoint, slot) of slots, with its voxels, or zeros of their number where it has none (K22). Volumes
    of different numbers of voxels, and two for one place, are errors when validated."""
    if validate:
        require_unique(volumes, [*keys, "ref_timepoint", "slot"], "volume of a stack")
    sizes = [r.n for r in volumes.select(F.size("voxels").alias("n")).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError("volumes differ in their number of voxels")
    places = [(r.ref_timepoint, r.slot) for r in slots.select("ref_timepoint", "slot").distinct().orderBy("ref_timepoint", "slot").collect()]  # of an experiment's rounds
    place = F.explode(F.array(*[F.struct(F.lit(t).alias("ref_timepoint"), F.lit(s).alias("slot")) for t, s in places])).alias("p")
    grid = volumes.select(*keys).distinct().select(*keys, place).select(*keys, "p.*")
    zeros = F.array_repeat(F.lit(0.0), sizes[0] if sizes else 0)
    return grid.join(volumes, [*keys, "ref_timepoint", "slot"], "left").withColumn("voxels", F.coalesce("voxels", zeros))
