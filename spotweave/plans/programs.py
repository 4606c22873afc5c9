"""Programs from files to files: each reads headed tables, applies the operators and writes headed tables.

Column names are those of the files that such programs exchange (fixed values, as FILE_COLUMNS and the schemas below give
them); inside, the engine's names are used. An output that exists is an error unless overwrite is set, and an output is never
its own input. All faults that the operators check end a program before anything is written.

A command line runs them: `python -m spotweave.plans.programs NAME key=value ...`."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators import beads, drift as drifts, merging, naming, proximity, qc, ranks, traces
from spotweave.operators.geometry import AXES
from spotweave.plans.configuration import RoundsConfiguration, read_configuration
from spotweave.runtime import session
from spotweave.sources import folders, tables

# Names in files and in the engine, and types.
FILE_COLUMNS = {
    "index": "roi_id", "fieldOfView": "fov_name", "spotChannel": "channel", "traceId": "trace_id", "traceGroup": "trace_group", "tracePartners": "trace_partners",
    "mergePartners": "merge_partners", "tooCloseRois": "too_close", "hasAllPartners": "has_all_partners", "intensityMean": "intensity",
    **{f"{a}Min": f"{a}_min" for a in AXES}, **{f"{a}Max": f"{a}_max" for a in AXES},
    **{f"{a}Drift{k}Pixels": f"{a}_{k.lower()}" for a in AXES for k in ("Coarse", "Fine")},
}
ROI = "index long, fieldOfView string, timepoint int, spotChannel int, zc double, yc double, xc double, zMin double, zMax double, yMin double, yMax double, xMin double, xMax double"
DRIFT = "fieldOfView string, timepoint int, " + ", ".join(f"{a}Drift{k}Pixels double" for a in AXES for k in ("Coarse", "Fine"))
TRACE = "fieldOfView string, traceGroup string, traceId long, timepoint int, ref_timepoint int, z double, y double, x double"
SEMANTIC = {"UniversalProximityPermission": "permission", "UniversalProximityProhibition": "prohibition", "SelectiveProximityPermission": "selective_permission", "SelectiveProximityProhibition": "selective_prohibition"}
PROGRAMS: dict[str, Callable] = {}


def program(f: Callable) -> Callable:
    PROGRAMS[f.__name__] = f
    return f


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed table with the engine's names; the field of view also as an index."""
    df = tables.read_typed(spark, path, schema).withColumnsRenamed(FILE_COLUMNS)
    if "fov_name" in df.columns:
        df = df.withColumn("fov_name", F.regexp_replace("fov_name", r"\.zarr$", "")).withColumn("fov", naming.fov_index(F.col("fov_name")))
    return df


def write(df: DataFrame, path: str, sources: list[str], overwrite: bool) -> None:
    for s in sources:
        if tables.same_place(df.sparkSession, s, path):
            raise ValueError(f"the output would replace the input: {path}")
    back = {v: k for k, v in FILE_COLUMNS.items()}
    sets = [c for c, t in df.dtypes if t.startswith("array")]
    out = df.withColumns({c: naming.int_set_cell(F.col(c)) for c in sets}).withColumnsRenamed(back)
    tables.write_table(out.drop("fov"), path, overwrite=overwrite)


def scale_of(pixels: str | dict) -> tuple[float, float, float]:
    """Nanometres by pixel on z, y and x, from JSON such as {"z": 300, "y": 107.3, "x": 107.3}."""
    given = json.loads(pixels) if isinstance(pixels, str) else pixels
    scale = tuple(float(given[a]) for a in AXES)
    if min(scale) <= 0:
        raise ValueError(f"sizes of pixels must be positive: {given}")
    return scale


def _roi_columns(*more: str) -> list[str]:
    return ["roi_id", "fov_name", "timepoint", "channel", *[f"{a}c" for a in AXES], *[f"{a}_{s}" for a in AXES for s in ("min", "max")], *more]


@program
def determine_roi_merge(spark: SparkSession, *, input_file: str, output_file: str, pixels: str, distance_threshold: str, overwrite: bool = False) -> None:
    """Rois with the partners that they would merge with."""
    found = proximity.assess_merge(read(spark, input_file, ROI), float(distance_threshold), scale_of(pixels))
    write(found.select(*_roi_columns("merge_partners")), output_file, [input_file], overwrite)


@program
def merge_rois(spark: SparkSession, *, input_file: str, contributors_file: str, results_file: str, overwrite: bool = False) -> None:
    """Assessed rois into merged ones, and the table of what went into which."""
    assessed = read(spark, input_file, f"{ROI}, mergePartners string").withColumn("merge_partners", F.transform(naming.int_set(F.col("merge_partners")), lambda x: x.cast("long")))
    contributors, results = merging.merge_rois(assessed)
    write(contributors.select(*_roi_columns("merge_output")), contributors_file, [input_file, results_file], overwrite)
    results = results.withColumn("fov_name", naming.fov_name(F.col("fov")))
    write(results.select(*_roi_columns("merge_partners")).orderBy("roi_id"), results_file, [input_file, contributors_file], overwrite)


@program
def filter_rois_by_proximity(spark: SparkSession, *, configuration: str, spots_file: str, drift_file: str, discards_file: str, keepers_file: str, pixels: str, overwrite: bool = False) -> None:
    """Rois apart from others of other timepoints, by the strategy of the configuration; coordinates as they were before drift."""
    strategy = read_configuration(spark, configuration)
    rois, drift = read(spark, spots_file, ROI), read(spark, drift_file, DRIFT)
    moved = drifts.shift_centre(drifts.with_drift(rois, drift.drop("fov_name")))
    keep, gone = proximity.mutual_exclusion(moved, SEMANTIC[strategy.proximity.semantic], strategy.proximity.minimum_separation or 0.0, scale_of(pixels), strategy.proximity_table(spark))
    raw = lambda df: df.withColumns({f"{a}c": F.col(f"{a}c_raw") for a in AXES})
    write(raw(keep).select(*_roi_columns()), keepers_file, [spots_file, drift_file, discards_file], overwrite)
    write(raw(gone).select(*_roi_columns("too_close")), discards_file, [spots_file, drift_file, keepers_file], overwrite)


def bead_rows(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """bead_id, the coordinates, and the field of view and timepoint that the names of the files give."""
    rows = tables.read_typed(spark, f"{folder.rstrip('/')}/{glob}", "beadIndex long, zc double, yc double, xc double").withColumn("name", F.element_at(F.split(F.input_file_name(), "/"), -1))
    part = lambda i: F.regexp_extract("name", folders.BEADS, i).cast("int")
    return rows.select(F.col("beadIndex").alias("bead_id"), part(1).alias("fov"), part(2).alias("timepoint"), *[f"{a}c" for a in AXES])


@program
def filter_spots_by_beads(spark: SparkSession, *, spots_folder: str, beads_folder: str, drift_file: str, output_file: str, distance_threshold: str, spotless_timepoint: str, pixels: str, overwrite: bool = False) -> None:
    """Spots of all fields of view that are not near a bead of one blank timepoint."""
    time = int(spotless_timepoint)
    bead_files = folders.bead_files(folders.listed(spark, beads_folder, "*.csv")).where(F.col("timepoint") == time)
    if folders.spot_files(folders.listed(spark, spots_folder, "*.csv")).isEmpty() or bead_files.isEmpty():
        raise ValueError("no files of spots or of beads")
    drift = read(spark, drift_file, DRIFT).drop("fov_name")
    spots = read(spark, f"{spots_folder.rstrip('/')}/P*_rois.csv", ROI)
    points = bead_rows(spark, beads_folder, f"bead_rois__*_{time}.csv").where(F.col("timepoint") == time)
    shifted = lambda df: drifts.shift_centre(drifts.with_drift(df, drift))
    keep, _ = proximity.spot_bead_filter(shifted(spots), shifted(points), float(distance_threshold), scale_of(pixels))
    write(keep.withColumns({f"{a}c": F.col(f"{a}c_raw") for a in AXES}).select(*_roi_columns()), output_file, [drift_file], overwrite)


@program
def assign_trace_ids(spark: SparkSession, *, configuration: str, rois_file: str, pixels: str, output_file: str, skips_file: str, overwrite: bool = False) -> None:
    """Rois with their trace, group and partners, and a JSON array of what was skipped."""
    rules = read_configuration(spark, configuration).merge_rules
    rois = read(spark, rois_file, ROI)
    if rules is None:
        rows = traces.assign_without_rules(rois).select("roi_id", "trace_id").withColumns({"trace_group": F.lit(""), "trace_partners": F.lit(""), "has_all_partners": F.lit("")})
        skips = rois.where("false").select(F.col("roi_id").alias("order_"), "timepoint")
    else:
        found, skipped = traces.assign_traces(rois, {k: list(v) for k, v in rules.groups.items()}, rules.distance_threshold, rules.requirement.lower(), rules.discard_others, scale_of(pixels))
        rows = found.withColumns({"trace_partners": naming.int_set_cell(F.col("trace_partners")), "has_all_partners": F.coalesce(F.col("has_all_partners").cast("int").cast("string"), F.lit(""))})
        skips = traces.skip_records(skipped, rois).select(F.struct("component", "roiId").alias("order_"), "roiId", "groupTimes", "groupIds", "roiIds", "repeats")
    write(rois.join(rows, "roi_id").select(*_roi_columns("trace_group", "trace_id", "trace_partners", "has_all_partners")).orderBy("roi_id"), output_file, [rois_file, skips_file], overwrite)
    tables.write_json_array(skips, skips_file, "order_", overwrite=overwrite)


QC = TRACE + ", roiId long, " + ", ".join(f"{c} double" for c in ("ref_dist", "A", "BG", "sigma_xy", "sigma_z", "spot_box_z", "spot_box_y", "spot_box_x", "z_px", "y_px", "x_px"))
FLAG_NAMES = dict(zip(qc.FLAGS, ("withinRegion", "sufficientSNR", "denseXY", "denseZ", "inBoundsZ", "inBoundsY", "inBoundsX"), strict=True))


@program
def label_and_filter_locus_spots(spark: SparkSession, *, configuration: str, traces_file: str, points_folder: str, output_prefix: str, roi_pixels: str, max_distance: str, min_snr: str, max_sigma_xy: str, max_sigma_z: str, min_trace_length: str = "0", overwrite: bool = False) -> None:
    """PREFIX.unfiltered.csv with all flags, PREFIX.filtered.csv with the passing rows less exclusions and short traces, and in
    the points folder the passing and failing points of each field of view and trace group, with reindexed times and traces."""
    known: RoundsConfiguration = read_configuration(spark, configuration)
    schema = QC.replace(", roiId long", "")
    raw = tables.read_typed(spark, traces_file, schema).withColumn("fieldOfView", F.regexp_replace("fieldOfView", r"\.zarr$", ""))
    named = raw.withColumns({"trace_id": F.col("traceId"), "trace_group": F.col("traceGroup"), "signal": F.col("A"), "background": F.col("BG"), **{f"box_{a}": F.col(f"spot_box_{a}") for a in AXES}})
    marked = qc.label_qc(named, max_dist=float(max_distance), min_snr=float(min_snr), max_sigma_xy=float(max_sigma_xy), max_sigma_z=float(max_sigma_z))
    columns = raw.columns
    flags = [F.col(k).alias(v) for k, v in FLAG_NAMES.items()]
    order = ["fieldOfView", "traceId", "ref_timepoint", "timepoint"]
    tables.write_table(marked.select(*columns, *flags, F.col("qc_pass").alias("qcPass")).orderBy(*order), f"{output_prefix}.unfiltered.csv", source=traces_file, overwrite=overwrite)
    keys = ["fieldOfView", "ref_timepoint", "traceId"]
    kept = qc.qc_filtered(marked, keys, sorted(known.tracing_exclusions), int(min_trace_length))
    tables.write_table(kept.select(*columns, F.col("qc_pass").alias("qcPass")).orderBy(*order), f"{output_prefix}.filtered.csv", source=traces_file, overwrite=overwrite)
    size = tuple(json.loads(roi_pixels)[a] for a in AXES)
    shown = marked.withColumns({"display": qc.display_class(size), "failCode": qc.fail_codes()}).where("display <> 'invisible'")
    groups = {k: list(v) for k, v in known.merge_rules.groups.items()} if known.merge_rules else {}
    ranked = traces.reindex(shown.withColumn("group_", F.coalesce("trace_group", F.lit(""))), ["fieldOfView", "group_"], "trace_id", "traceIndex")
    ranked = ranks.rank_in_trace_group(ranked, groups, "regionIndex") if groups else ranked.withColumn("regionIndex", F.lit(0).cast("long"))
    ranked = ranks.rank_in_region(ranked, {k: list(v) for k, v in known.locus_grouping.items()} or None, [r.time for r in known.rounds], "timeIndex")
    points = ["traceIndex", "regionIndex", "timeIndex", *[F.col(f"{a}_px").alias(a) for a in AXES]]
    head = [F.col("ref_timepoint").alias("regionTime"), "traceId", F.col("timepoint").alias("locusTime")]
    view = naming.viewing_key(F.col("fieldOfView"), F.col("group_"))
    for kind, extra in (("pass", []), ("fail", ["failCode"])):
        part = ranked.where(F.col("display") == kind).select(view.alias("view"), *head, *points, *extra)
        named = F.concat(F.col("view"), F.lit("/"), F.col("view"), F.lit(f".qc{kind}.csv"))
        tables.write_named(part.withColumn("file", named).drop("view"), points_folder, "file", ["traceId", "regionTime", "locusTime"], overwrite=overwrite)


@program
def locus_pairwise_distances(spark: SparkSession, *, traces_file: str, output_folder: str, pixels: str | None = None, overwrite: bool = False) -> None:
    """Distances of all pairs of loci within a trace, in order."""
    points = read(spark, traces_file, TRACE).withColumnsRenamed({a: f"{a}c" for a in AXES}).withColumn("trace_group", F.coalesce("trace_group", F.lit("")))
    pairs = proximity.group_pairs(points, ["trace_id"], "timepoint", ["fov_name", "trace_group", "ref_timepoint"], scale_of(pixels) if pixels else (1.0, 1.0, 1.0), unique=True, one_of=("fov_name", "trace_group"))
    out = pairs.select(F.col("fov_name_1").alias("fov_name"), F.col("trace_group_1").alias("trace_group"), F.col("trace_id_1").alias("trace_id"), F.col("ref_timepoint_1").alias("region1"), F.col("ref_timepoint_2").alias("region2"), F.col("timepoint_1").alias("locus1"), F.col("timepoint_2").alias("locus2"), "distance")
    write(out.orderBy("fov_name", "trace_group", "locus1", "locus2", "trace_id", "region1", "region2"), f"{output_folder}/pairwise_distances__locus_specific.csv", [traces_file], overwrite)


@program
def region_pairwise_distances(spark: SparkSession, *, rois_file: str, output_folder: str, pixels: str, drift_file: str | None = None, overwrite: bool = False) -> None:
    """Distances of all pairs of rois of a field of view and channel, in order, with the places of both in the input file; drift-corrected
    where a drift file is given."""
    place = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("row"))
    rois = read(spark, rois_file, ROI).withColumn("place", place)
    if drift_file:
        rois = drifts.shift_centre(drifts.with_drift(rois, read(spark, drift_file, DRIFT).drop("fov_name")))
    numbered = ranks.numbered_rows(rois, ["place"], "inputIndex")
    pairs = proximity.group_pairs(numbered, ["fov_name", "channel"], "inputIndex", ["timepoint"], scale_of(pixels))
    out = pairs.select(F.col("fov_name_1").alias("fov_name"), F.col("channel_1").alias("channel"), F.col("timepoint_1").alias("timepoint1"), F.col("timepoint_2").alias("timepoint2"), "distance", F.col("inputIndex_1").alias("inputIndex1"), F.col("inputIndex_2").alias("inputIndex2"))
    write(out.orderBy("fov_name", "channel", "timepoint1", "timepoint2", "distance"), f"{output_folder}/pairwise_distances__regional.csv", [rois_file], overwrite)


@program
def partition_beads(spark: SparkSession, *, beads_folder: str, num_shifting: str, num_accuracy: str, output_folder: str, overwrite: bool = False) -> None:
    """Beads for shifting and for accuracy in JSON arrays, and a table of the outcome for each field of view and timepoint; one
    with fewer than ten usable beads is severe and has no beads."""
    if int(num_shifting) < 10 or int(num_accuracy) < 1:
        raise ValueError("at least ten beads for shifting and one for accuracy are needed")
    if folders.bead_files(folders.listed(spark, beads_folder, "*.filtered.csv"), filtered=True).isEmpty():
        raise ValueError(f"no filtered bead files in {beads_folder}")
    usable = bead_rows(spark, beads_folder, "bead_rois__*.filtered.csv")
    counts = usable.groupBy("fov", "timepoint").agg(F.count("*").alias("n"))
    sizes = beads.partition_sizes(counts, int(num_shifting), int(num_accuracy), 10)
    tables.write_table(sizes, f"{output_folder}/outcomes.csv", overwrite=overwrite)
    parts = beads.partition_beads(usable, int(num_shifting), int(num_accuracy), 0).where("part is not null").join(sizes.where("outcome <> 'severe'").select("fov", "timepoint"), ["fov", "timepoint"])
    item = F.struct(F.col("bead_id").alias("index"), F.struct(*[f"{a}c" for a in AXES]).alias("centroid")).alias("bead")
    for part in ("shifting", "accuracy"):
        arrays = parts.where(F.col("part") == part).groupBy("fov", "timepoint").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("value"))  # at most as many as asked for
        tables.write_named(arrays.select("value", F.format_string("bead_rois__%d_%d.json", "fov", "timepoint").alias("file")), f"{output_folder}/{part}", "file", overwrite=overwrite, kind="text")


@program
def partition_regional_spots(spark: SparkSession, *, spots_files: str, output_folder: str, overwrite: bool = False) -> None:
    """Each of the files (comma-separated) by field of view: P0001/P0001__NAME, with an index in front."""
    for file in spots_files.split(","):
        place = F.struct(F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("row"))
        rows = tables.read_strings(spark, file).withColumn("place", place)
        numbered = ranks.rank_within(rows.withColumn("fieldOfView", F.regexp_replace("fieldOfView", r"\.zarr$", "")), ["fieldOfView"], ["place"], "number")
        named = F.concat("fieldOfView", F.lit("/"), "fieldOfView", F.lit("__" + file.rstrip("/").rsplit("/", 1)[-1]))
        others = [c for c in rows.columns if c != "place"]
        tables.write_named(numbered.select(F.col("number").alias("Unnamed: 0"), *others, named.alias("file_")), output_folder, "file_", ["`Unnamed: 0`"], overwrite=overwrite)


@program
def validate_merges(spark: SparkSession, *, input_file: str, pixels: str, distance_threshold: str, group_column: str = "mergeOutput", overwrite: bool = False) -> dict[str, int]:
    """Numbers of stored groups that are not one component, and of pairs of ungrouped rois that are too close."""
    rois = read(spark, input_file, f"{ROI}, {group_column} long")
    threshold, scale = float(distance_threshold), scale_of(pixels)
    grouped = rois.where(F.col(group_column).isNotNull()).select("roi_id", F.col(group_column).alias("group_id"))
    split = merging.split_groups(rois, grouped, merging.partner_edges(proximity.assess_merge(rois, threshold, scale)))
    close = proximity.ungrouped_violations(rois.where(F.col(group_column).isNull()), threshold, scale)
    return {"split_groups": split.count(), "close_pairs": close.count()}


@program
def validate_configuration(spark: SparkSession, *, configuration: str) -> dict:
    """The summary of a configuration; all its faults in one error."""
    return read_configuration(spark, configuration).summary()


@program
def combine_imaging_folders(spark: SparkSession, *, inputs: str, target_folder: str, script_file: str | None = None, execute: bool = False) -> list[tuple[str, str]]:
    """Moves that bring the files of several folders (comma-separated, in order) into one sequence of times: returned, written as a
    script, or made. Two files for one name are an error before anything moves."""
    parts = [folders.listed(spark, p).select("path", "name").withColumn("folder", F.lit(i)) for i, p in enumerate(inputs.split(","))]
    moves = folders.combined(reduce(DataFrame.unionByName, parts))
    plan = sorted((r.path, f"{target_folder.rstrip('/')}/{r.new_name}") for r in moves.select("path", "new_name").collect())  # files of one experiment
    if len({b for _, b in plan}) < len(plan):
        raise ValueError("several files would take one name")
    if script_file:
        local = lambda p: p.removeprefix("file:")
        lines = "\n".join(["#!/bin/sh", "set -e", *[f"mv '{local(a)}' '{local(b)}'" for a, b in plan]])
        spark.createDataFrame([(lines,)], "value string").coalesce(1).write.mode("error").text(script_file)
    if execute:
        path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        for a, b in plan:
            system = path(b).getFileSystem(conf)
            if system.exists(path(b)) or not system.rename(path(a), path(b)):
                raise ValueError(f"could not move {a} to {b}")
    return plan


def main(arguments: list[str]) -> int:
    from spotweave.plans import imaging  # noqa: F401 - programs that read images

    if not arguments or arguments[0] not in PROGRAMS:
        print("programs:", *sorted(PROGRAMS), sep="\n  ")
        return 2
    given = dict(a.split("=", 1) for a in arguments[1:])
    flags = {k: given.pop(k).lower() == "true" for k in ("overwrite", "execute") if k in given}
    found = PROGRAMS[arguments[0]](session(arguments[0]), **given, **flags)
    if found is not None:
        print(json.dumps(found))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
