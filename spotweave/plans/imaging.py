"""Programs that read images from a store of chunked arrays (section 2.13): beads, fine drift, drift accuracy, spot extraction and fits, signals.

Boxes travel to the chunks that they meet (`sources.chunks`), so images are read where they lie and are never shuffled. Tables are those of
`programs`, with the same names of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators import detection, naming, pixels, tiles, tracing, voxels
from spotweave.operators.geometry import AXES
from spotweave.plans.configuration import read_configuration
from spotweave.plans.process import by_partition
from spotweave.plans.programs import DRIFT, ROI, program, read, scale_of, write
from spotweave.sources import chunks, folders, tables
from spotweave.sources.tables import read_bead_points


def around(size: tuple[int, int, int], centre: dict[str, Column]) -> dict[str, Column]:
    """Bounds of whole pixels around a point: half the size below and above it, and no pads."""
    out = {}
    for a, n in zip(AXES, size, strict=True):
        out[f"{a}_lo"], out[f"{a}_hi"] = F.round(centre[a]) - (n // 2), F.round(centre[a]) + (n - n // 2)
        out[f"{a}_pad_lo"] = out[f"{a}_pad_hi"] = F.lit(0.0)
    return out


def inside(boxes: DataFrame) -> DataFrame:
    """Boxes without those that begin below the image; what ends above it gives a reason when it is cut."""
    return boxes.where(" and ".join(f"{a}_lo >= 0" for a in AXES))


def fitted_points(boxes: DataFrame, images: str, keys: list[str], *, center: str | None = None) -> DataFrame:
    """keys, the parameters of the spot fitted in each box and the centre in pixels of the image, for those that have a fit."""
    cut = chunks.cropped_chunks(boxes, images, keys)
    fits = pixels.fit_spots(cut.where("reason is null").select(*keys, "voxels", "shape"), center=center).where("A <> -1 or BG <> -1")
    low = boxes.select(*keys, *[F.floor(f"{a}_lo").alias(f"{a}_from") for a in AXES])
    return fits.join(low, keys).withColumns({a: F.col(f"{a}_px") + F.col(f"{a}_from") for a in AXES})


@program
def detect_beads(spark: SparkSession, *, images: str, output_folder: str, threshold: str, sigma: str = "1.0", tile: str = "16,512,512", channel: str = "0", overwrite: bool = False) -> None:
    """bead_rois__FOV_TIME.csv for every image of a channel: the parts of the blurred image above a threshold, found in tiles."""
    known = chunks.layouts(images)
    for shape in sorted({x.shape for x in known.values()}):
        alike = [f for f, x in known.items() if x.shape == shape]
        here = F.col("field").isin(alike) & (F.col("c_chunk") == int(channel) // known[alike[0]].chunks[1])
        found = tiles.regions(chunks.read_chunks(spark, images).where(here).select("field", "start", "shape", "voxels"), shape, tuple(int(n) for n in tile.split(",")), float(threshold), tiles.Seen("blur", sigma=float(sigma)))
        rows = found.where(F.col("c") == int(channel)).select((F.col("label") - 1).alias("beadIndex"), "zc", "yc", "xc", "max_intensity", "area", F.format_string("bead_rois__%d_%d.csv", naming.fov_index(F.col("field")), F.col("t")).alias("file"))
        tables.write_named(rows, output_folder, "file", ["beadIndex"], overwrite=overwrite)


def bead_boxes(points: DataFrame, drift: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """A box for each bead (fov, bead_id, zc, yc, xc of the reference) at each timepoint of its field of view, moved against the coarse drift."""
    moved = points.join(drift.select("fov", "fov_name", "timepoint", *[f"{a}_coarse" for a in AXES]), "fov")
    at = {a: F.col(f"{a}c") - F.col(f"{a}_coarse") for a in AXES}
    return inside(moved.withColumns(around(size, at)).select("fov", F.col("fov_name").alias("field"), "timepoint", F.lit(0).alias("channel"), "bead_id", *[f"{a}_coarse" for a in AXES], *[f"{a}_{k}" for a in AXES for k in ("lo", "hi", "pad_lo", "pad_hi")]))


def bead_points(spark: SparkSession, folder: str, time: int) -> DataFrame:
    """fov, bead_id and centres of the JSON arrays of one timepoint."""
    rows = read_bead_points(spark, f"{folder.rstrip('/')}/bead_rois__*_{time}.json")
    fov = F.regexp_extract(F.element_at(F.split("file", "/"), -1), folders.BEADS, 1).cast("int")
    return rows.select(fov.alias("fov"), F.col("index").cast("long").alias("bead_id"), "zc", "yc", "xc")


@program
def correct_fine_drift(spark: SparkSession, *, images: str, beads_folder: str, drift_file: str, reference_timepoint: str, bead_pixels: str, work_folder: str, output_file: str, at_once: str = "64", overwrite: bool = False) -> None:
    """The drift table with fine drift (K4): beads of the reference timepoint are cut at every timepoint, moved by coarse drift, fitted, and the
    trimmed mean of their shifts taken. Fields of view that the work folder holds already are not worked again."""
    time, size = int(reference_timepoint), (int(bead_pixels),) * 3
    drift, points = read(spark, drift_file, DRIFT), bead_points(spark, beads_folder, time)

    def work(some: DataFrame) -> DataFrame:
        boxes = bead_boxes(points.join(some.select("fov").distinct(), "fov", "left_semi"), some, size)
        fits = fitted_points(boxes, images, ["fov", "timepoint", "bead_id"])
        found = fits.join(some.select("fov", "timepoint", *[F.col(f"{a}_coarse").alias(f"{a}_c") for a in AXES]), ["fov", "timepoint"])
        fine = detection.fine_drift(found.select("fov", "timepoint", "bead_id", *[(F.col(a) + F.col(f"{a}_c")).alias(a) for a in AXES]), time)
        return some.drop(*[f"{a}_fine" for a in AXES]).join(fine, ["fov", "timepoint"], "left").fillna(0.0, subset=[f"{a}_fine" for a in AXES])

    whole = by_partition(drift, "fov", work_folder, work, at_once=int(at_once))
    columns = ["fov_name", "timepoint", *[f"{a}_{k}" for a in AXES for k in ("coarse", "fine")]]
    write(whole.select(*columns).orderBy("fov_name", "timepoint"), output_file, [drift_file], overwrite)


@program
def analyse_drift_accuracy(spark: SparkSession, *, images: str, beads_folder: str, drift_file: str, reference_timepoint: str, bead_pixels: str, pixels: str, output_file: str, overwrite: bool = False) -> None:
    """Beads kept for accuracy at every timepoint, refitted and moved by the whole drift, against the reference, in nanometres."""
    time, scale = int(reference_timepoint), scale_of(pixels)
    drift = read(spark, drift_file, DRIFT)
    fits = fitted_points(bead_boxes(bead_points(spark, beads_folder, time), drift, (int(bead_pixels),) * 3), images, ["fov", "timepoint", "bead_id"])
    moved = fits.join(drift, ["fov", "timepoint"]).select("fov", "fov_name", "timepoint", "bead_id", *[((F.col(a) + F.col(f"{a}_coarse")) * s).alias(a) for a, s in zip(AXES, scale, strict=True)], *[(F.col(f"{a}_fine") * s).alias(f"{a}_fine") for a, s in zip(AXES, scale, strict=True)])
    out = tracing.drift_accuracy(moved, moved.where(F.col("timepoint") == time), ["fov", "bead_id"])
    write(out.select("fov_name", "timepoint", F.col("bead_id").alias("beadIndex"), *[f"{a}_error" for a in AXES], "error").orderBy("fov_name", "timepoint", "beadIndex"), output_file, [drift_file], overwrite)


@program
def trace_spots(spark: SparkSession, *, images: str, configuration: str, rois_file: str, drift_file: str, pixels: str, output_file: str, background: str | None = None, channel: str = "0", overwrite: bool = False) -> None:
    """Every traced roi cut out at the timepoints of its region, fitted, and its points relative to the box, in pixels and nanometres (J9 to J11, K6, K8,
    P6, P7), as quality control reads them. Boxes that give no voxels have no point."""
    known, scale = read_configuration(spark, configuration), scale_of(pixels)
    rois = read(spark, rois_file, f"{ROI}, traceGroup string, traceId long")
    drift = read(spark, drift_file, DRIFT)
    loci = known.grouping_table(spark) if known.locus_grouping else None
    shapes = {x.shape[2:] for x in chunks.layouts(images).values()}
    if len(shapes) != 1:
        raise ValueError(f"images of one size are wanted, found {sorted(shapes)}")
    back = int(background) if background is not None else None
    boxes = tracing.expand_bounds(rois, drift.drop("fov_name"), loci, back, shapes.pop()).withColumn("field", F.col("fov_name")).withColumn("channel", F.lit(int(channel)))
    keys = ["fov", "roi_id", "timepoint"]
    cut = chunks.cropped_chunks(boxes, images, keys, background=back)
    fits = pixels_fitted(cut.where("reason is null"), keys)
    size = {a: F.floor(f"{a}_hi") - F.floor(f"{a}_lo") + F.ceil(f"{a}_pad_lo") + F.floor(f"{a}_pad_hi") for a in AXES}
    points = boxes.join(fits, keys).withColumns({f"spot_box_{a}": size[a] * s for a, s in zip(AXES, scale, strict=True)})
    out = tracing.to_nanometres(points, scale).withColumns({"sigma_z": F.col("sigma_z") * scale[0], "sigma_xy": F.col("sigma_xy") * scale[2]})
    columns = ["fov_name", "trace_group", "trace_id", "roi_id", "timepoint", "ref_timepoint", "BG", "A", *[f"{a}_px" for a in AXES], "sigma_z", "sigma_xy", *[f"{a}_px_dc" for a in AXES], *[f"spot_box_{a}" for a in AXES], *AXES]
    renamed = out.select(*columns).withColumnRenamed("roi_id", "roiId")
    write(renamed.orderBy("fov_name", "trace_id", "ref_timepoint", "timepoint"), output_file, [rois_file, drift_file], overwrite)


def pixels_fitted(cut: DataFrame, keys: list[str]) -> DataFrame:
    return pixels.fit_spots(cut.select(*keys, "voxels", "shape"))


@program
def analyse_signals(spark: SparkSession, *, images: str, rois_file: str, drift_file: str, diameter: str, channels: str, output_file: str, overwrite: bool = False) -> None:
    """Statistics of the pixels around every roi in each of the channels (comma-separated), where it lies after the drift of its timepoint."""
    drift = read(spark, drift_file, DRIFT).drop("fov_name")
    rois = read(spark, rois_file, ROI).join(drift, ["fov", "timepoint"])
    listed = F.explode(F.array(*[F.lit(int(c)) for c in channels.split(",")]))
    at = {a: F.col(f"{a}c") - F.col(f"{a}_coarse") - F.col(f"{a}_fine") for a in AXES}
    boxes = inside(rois.withColumns(around((int(diameter),) * 3, at)).withColumn("field", F.col("fov_name")).withColumn("channel", listed))
    keys = ["fov", "roi_id", "timepoint", "channel"]
    found = voxels.pixel_statistics(chunks.cropped_chunks(boxes, images, keys).where("reason is null"), keys, "voxels")
    out = found.withColumn("fov_name", naming.fov_name(F.col("fov"))).select(F.col("fov_name"), F.col("roi_id"), "timepoint", F.col("channel").alias("signalChannel"), "n", "least", "largest", "total", "mean", "median")
    write(out.orderBy("roi_id", "signalChannel"), output_file, [rois_file, drift_file], overwrite)


