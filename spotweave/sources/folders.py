"""Files found by their names (IO10, IO11, IO22 to IO24). Only names are listed; contents are read by the table sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators.checks import require_none, require_unique
from spotweave.operators.naming import fov_index, time_offsets, timepoint_in_name
from spotweave.sources.tables import SEPARATORS, read_strings

BEADS = r"^bead_rois__(\d+)_(\d+)(\.filtered)?\.(?:csv|json)$"
SPOTS = r"^(P\d{4})_rois\.csv$"


def listed(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, length) of the files of a folder."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    return reader.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def matching(files: DataFrame, pattern: str, *names: str) -> DataFrame:
    """The files whose name fits, with the pattern's groups as columns (IO22)."""
    return files.where(F.col("name").rlike(pattern)).select("*", *[F.regexp_extract("name", pattern, i + 1).alias(n) for i, n in enumerate(names)])


def bead_files(files: DataFrame, filtered: bool = False) -> DataFrame:
    """(path, fov, timepoint) of bead files; a repeated pair is an error (IO10)."""
    found = matching(files, BEADS, "fov", "timepoint", "suffix").where((F.col("suffix") != "") == F.lit(filtered))
    typed = found.select("path", F.col("fov").cast("int").alias("fov"), F.col("timepoint").cast("int").alias("timepoint"))
    return require_unique(typed, ["fov", "timepoint"], "bead files")


def spot_files(files: DataFrame) -> DataFrame:
    """(path, fov) of the spot files of fields of view (IO11)."""
    return matching(files, SPOTS, "name_of_fov").select("path", fov_index(F.col("name_of_fov")).alias("fov")).where("fov is not null")


def renamed(name: Column, time: Column) -> Column:
    return F.regexp_replace(name, r"Time\d{5}", F.format_string("Time%05d", time))


def combined(files: DataFrame) -> DataFrame:
    """(path, name, folder, timepoint, new_timepoint, new_name) for files (path, name, folder: its place) of several
    imaging folders in one sequence: times are shifted by those of the folders before (IO23, IO24). Each folder must
    hold the times 0, 1, 2 and so on."""
    timed = require_none(files.withColumn("timepoint", timepoint_in_name(F.col("name"))), F.col("timepoint").isNull(), "names without one time")
    counts = timed.groupBy("folder").agg(F.countDistinct("timepoint").alias("n"), F.max("timepoint").alias("last"))
    require_none(counts, F.col("n") != F.col("last") + 1, "folders whose times have gaps")
    shifted = timed.join(F.broadcast(time_offsets(counts.select("folder", "n"), "folder")), "folder")
    new = (F.col("timepoint") + F.col("offset")).cast("int")
    return shifted.select("path", "name", "folder", "timepoint", new.alias("new_timepoint"), renamed(F.col("name"), new).alias("new_name"))


def load_tables(spark: SparkSession, folder: str, prefix: str) -> dict[str, DataFrame]:
    """A view for each delimited file named prefix + table name + ending (IO8); two files for one name are an error. Their number is
    that of an analysis's tables, so the names come to the driver."""
    found: dict[str, DataFrame] = {}
    for r in listed(spark, folder).select("path", "name").orderBy("name").collect():
        name, _, ending = r.name.rpartition(".")
        if not name.startswith(prefix) or len(name) == len(prefix) or ending not in SEPARATORS:
            continue
        table = name[len(prefix):]
        if table in found:
            raise ValueError(f"several files for table {table}")
        found[table] = read_strings(spark, r.path)
        found[table].createOrReplaceTempView(f"`{table}`")
    return found
