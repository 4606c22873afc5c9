"""The processing of an experiment as stages that go on where they stopped (section 2.13).

A run has a folder with a manifest: a small file for each stage that is finished, with the settings it ran under. A run that is started again
passes over these; a stage whose settings have changed, and all after it, run anew. Within a stage, `by_partition` works a number of
partitions (fields of view) at a time; the finished ones are a table, and what is left is found by an anti-join, so that a stage that was stopped
in the middle repeats at most the partitions that were under way.

`python -m spotweave.plans.process CONFIGURATION SETTINGS FOLDER [start=STAGE] [stop=STAGE]` runs the stages of `STAGES`."""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.plans import programs
from spotweave.runtime import session, setting


@dataclass(frozen=True)
class Stage:
    """A step of a run: its work gets the run, and `uses` names the settings that it depends on."""

    name: str
    work: Callable[[Run], None]
    uses: tuple[str, ...] = ()


@dataclass
class Run:
    spark: SparkSession
    folder: str
    settings: dict

    def path(self, *names: str) -> str:
        return "/".join([self.folder.rstrip("/"), *names])

    def _file(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def note(self, stage: Stage) -> str | None:
        """What the manifest holds of a stage."""
        system, p = self._file(self.path("_finished", f"{stage.name}.json"))
        if not system.exists(p):
            return None
        stream = system.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def finish(self, stage: Stage, mark: str) -> None:
        system, p = self._file(self.path("_finished", f"{stage.name}.json"))
        stream = system.create(p, True)
        stream.write(bytearray(mark, "utf-8"))
        stream.close()

    def remove(self, path: str) -> None:
        system, p = self._file(path)
        system.delete(p, True)


def run_stages(run: Run, stages: list[Stage], *, start: str | None = None, stop: str | None = None) -> list[str]:
    """Work the stages in order, from `start` on (else all that are not finished) up to and with `stop`; the names of those that were worked.
    A stage before start must be finished."""
    names = [s.name for s in stages]
    if len(set(names)) < len(names) or not {start, stop} <= {None, *names}:
        raise ValueError(f"no such stage, or two of one name: {start}, {stop}, {names}")
    first = names.index(start) if start else 0
    last = names.index(stop) if stop else len(stages) - 1
    worked, above = [], ""
    for i, s in enumerate(stages[: last + 1]):
        above = hashlib.sha256(json.dumps([above, s.name, {k: run.settings.get(k) for k in s.uses}], sort_keys=True).encode()).hexdigest()
        mark = json.dumps({"stage": s.name, "state": above})
        known = run.note(s)
        if i < first:
            if known is None:
                raise ValueError(f"{s.name} is not finished, and {start} needs it")
            continue
        if known == mark and not (start and i >= first):
            continue
        s.work(run)
        run.finish(s, mark)
        worked.append(s.name)
    return worked


def by_partition(rows: DataFrame, key: str, path: str, work: Callable[[DataFrame], DataFrame], *, at_once: int = 64, most: int | None = None) -> DataFrame:
    """work(rows of some values of key) for all values, `at_once` in a job, in the table `path`/rows, partitioned by key; values that
    `path`/finished holds are not worked again. `most` ends after so many jobs. Values of key are those of fields of view or the
    like, whose names come to the driver; each value's rows are replaced as a whole, so a job that was cut off can be repeated."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[key]
    done, data = f"{path.rstrip('/')}/finished", f"{path.rstrip('/')}/rows"
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(done)
    known = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)
    left = rows.select(key).distinct().where(F.col(key).isNotNull())
    if known:
        left = left.join(spark.read.schema(f"`{key}` {kind}").parquet(done), key, "left_anti")
    todo = [r[0] for r in left.orderBy(key).collect()]
    for n, i in enumerate(range(0, len(todo), at_once)):
        if most is not None and n >= most:
            break
        some = todo[i : i + at_once]
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            work(rows.where(F.col(key).isin(some))).write.mode("overwrite").partitionBy(key).parquet(data)
        spark.createDataFrame([(v,) for v in some], f"`{key}` {kind}").coalesce(1).write.mode("append").parquet(done)
    return spark.read.parquet(data)


def _stage(name: str, uses: tuple[str, ...], **given) -> Stage:
    """A program as a stage; given maps its arguments to files of the run (with a dot or a slash in the name) or to settings."""

    def work(run: Run) -> None:
        arguments = {k: run.path(v[1:]) if v.startswith("/") else run.settings[v] for k, v in given.items() if v.startswith("/") or v in run.settings}
        programs.PROGRAMS[name](run.spark, **arguments, overwrite=True)

    return Stage(name, work, uses)


def _checked(run: Run) -> None:
    programs.validate_configuration(run.spark, configuration=run.settings["configuration"])


#: From spots, drift and beads to distances, in order. Names with a slash in front are files of the run's folder, others settings.
STAGES = [
    Stage("validate_configuration", _checked, ("configuration",)),
    _stage("partition_beads", ("num_shifting", "num_accuracy"), beads_folder="/beads", num_shifting="num_shifting", num_accuracy="num_accuracy", output_folder="/bead_parts"),
    _stage("filter_spots_by_beads", ("bead_distance", "spotless_timepoint", "pixels"), spots_folder="/spots", beads_folder="/beads", drift_file="/drift.csv", output_file="/rois.unbeaded.csv", distance_threshold="bead_distance", spotless_timepoint="spotless_timepoint", pixels="pixels"),
    _stage("determine_roi_merge", ("merge_distance", "pixels"), input_file="/rois.unbeaded.csv", output_file="/rois.assessed.csv", pixels="pixels", distance_threshold="merge_distance"),
    _stage("merge_rois", (), input_file="/rois.assessed.csv", contributors_file="/rois.contributors.csv", results_file="/rois.merged.csv"),
    _stage("filter_rois_by_proximity", ("configuration", "pixels"), configuration="configuration", spots_file="/rois.merged.csv", drift_file="/drift.csv", discards_file="/rois.too_close.csv", keepers_file="/rois.kept.csv", pixels="pixels"),
    _stage("assign_trace_ids", ("configuration", "pixels"), configuration="configuration", rois_file="/rois.kept.csv", pixels="pixels", output_file="/rois.traced.csv", skips_file="/rois.skipped.json"),
    _stage("partition_regional_spots", (), spots_files="/rois.traced.csv", output_folder="/shown"),
    _stage("region_pairwise_distances", ("pixels",), rois_file="/rois.kept.csv", output_folder="/distances", pixels="pixels", drift_file="/drift.csv"),
]


def main(arguments: list[str]) -> int:
    if len(arguments) < 3:
        print("usage: CONFIGURATION SETTINGS FOLDER [start=STAGE] [stop=STAGE]; stages:", *[s.name for s in STAGES], sep="\n  ")
        return 2
    spark = session("process")
    settings = json.loads("\n".join(r[0] for r in spark.read.text(arguments[1]).collect()))
    print(json.dumps(run_stages(Run(spark, arguments[2], {**settings, "configuration": arguments[0]}), STAGES, **dict(a.split("=", 1) for a in arguments[3:]))))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
