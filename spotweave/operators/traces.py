"""Trace-id assignment (section 2.11: T1 to T10; J20, A10, A11, W5, W6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators.checks import require_none, require_unique
from spotweave.operators.merging import numbered, with_components
from spotweave.operators.proximity import Scale, rule_edges
from spotweave.operators.ranks import join_same, rank_within
from spotweave.runtime import stage

REQUIREMENTS = ("conjunctive", "disjunctive", "lackadaisical")


def assign_without_rules(rois: DataFrame) -> DataFrame:
    """Every roi its own trace, numbered above the largest roi id in the order of the ids."""
    return numbered(rois, "roi_id", rois, "roi_id").withColumnRenamed("number", "trace_id")


def rule_table(spark, groups: dict[str, list[int]], threshold: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of timepoints with threshold and rule, members: timepoint, trace_group, group_size)."""
    pairs = [(a, b, float(threshold), name) for name, times in groups.items() for a in times for b in times if a < b]
    members = [(t, name, len(times)) for name, times in groups.items() for t in times]
    return (
        spark.createDataFrame(pairs, "timepoint_1 int, timepoint_2 int, threshold double, rule string"),
        spark.createDataFrame(members, "timepoint int, trace_group string, group_size int"),
    )


def assign_traces(rois: DataFrame, groups: dict[str, list[int]], threshold: float, requirement: str, discard_ungrouped: bool, scale: Scale, *, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(assigned: roi_id, trace_id, trace_group, trace_partners, has_all_partners; skipped: roi_id, reason).

    Singletons outside all groups are kept unless discard_ungrouped; those in a group are kept only if
    lackadaisical. A component with a repeated timepoint is skipped as a collision; a conjunctive one
    that lacks a timepoint of its group is dropped without a row; one whose timepoints lie in several groups is skipped
    for its ambiguity; all others are emitted. A component whose timepoints lie in no one group bridges rules, which
    is an error when validated. Ids go on from the largest roi id, in the order of the components' smallest
    ids, and only emitted components take one. Jobs run when this is called."""
    if requirement not in REQUIREMENTS:
        raise ValueError(f"requirement must be one of {REQUIREMENTS}")
    if validate:
        require_unique(rois, ["roi_id"], "roi id")
    pairs, _ = rule_table(rois.sparkSession, groups, threshold)
    edges = stage(rule_edges(rois, pairs, threshold, scale), "trace-edges")
    comps = stage(with_components(rois, edges.select("src", "dst").distinct()), "trace-components")
    observed = comps.groupBy("component").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("timepoint")).alias("times"), F.array_sort(F.collect_list("roi_id")).alias("ids"))
    summary = with_groups(observed, groups)
    alone, grouped, several = F.col("n") == 1, F.size("names") > 0, F.size("names") > 1
    if validate:
        require_none(summary, ~alone & ~grouped, "a component bridges rules")
    complete = F.array_contains("sizes", F.size("times"))
    named = F.when(several, "ambiguity").otherwise("emit")
    outcome = (
        F.when(alone & grouped, F.when(F.lit(requirement == "lackadaisical"), named).otherwise("drop"))
        .when(alone, F.lit("drop" if discard_ungrouped else "emit"))
        .when(F.size("times") < F.col("n"), "collision")
        .when(F.lit(requirement == "conjunctive") & ~complete, "drop")
        .otherwise(named)
    )
    decided = stage(summary.withColumn("outcome", outcome).withColumn("has_all", complete), "trace-decisions")
    emitted = numbered(decided.where("outcome = 'emit'"), "component", rois, "roi_id")
    rows = emitted.select(F.explode("ids").alias("roi_id"), F.col("number").alias("trace_id"), F.try_element_at("names", F.lit(1)).alias("trace_group"), "ids", "n", "has_all")
    if validate and not emitted.join(rois.select(F.col("roi_id").alias("number")), "number", "left_semi").isEmpty():
        raise ValueError("a trace id is the id of a roi already")  # T10
    partners = F.array_except("ids", F.array("roi_id"))
    assigned = rows.select("roi_id", "trace_id", "trace_group", partners.alias("trace_partners"), F.when(F.col("trace_group").isNotNull(), F.coalesce("has_all", F.lit(False)) & (F.col("n") > 1)).alias("has_all_partners"))
    skipped = decided.where("outcome in ('collision', 'ambiguity')").select(F.explode("ids").alias("roi_id"), F.col("outcome").alias("reason"), "component", "times", "names")
    return assigned, skipped


def skip_records(skipped: DataFrame, rois: DataFrame) -> DataFrame:
    """What was skipped as the records of its file, in the order of the rois: for an ambiguity the roi, its times and the groups that hold
    them; for a collision its rois, and those of each repeated time. Fields of the other kind are null."""
    timed = skipped.where("reason = 'collision'").join(rois.select("roi_id", "timepoint"), "roi_id")
    each = timed.groupBy("component", "timepoint").agg(F.array_sort(F.collect_list("roi_id")).alias("ids"))
    repeats = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.size("ids") > 1, F.struct(F.col("timepoint").cast("string"), F.col("ids"))))))
    none = F.lit(None)
    collisions = each.groupBy("component").agg(F.array_sort(F.flatten(F.collect_list("ids"))).alias("roiIds"), repeats.alias("repeats"))
    return skipped.where("reason = 'ambiguity'").select("component", F.col("roi_id").alias("roiId"), F.col("times").alias("groupTimes"), F.col("names").alias("groupIds"), none.cast("array<bigint>").alias("roiIds"), none.cast("map<string,array<bigint>>").alias("repeats")).unionByName(
        collisions.select("component", none.cast("bigint").alias("roiId"), none.cast("array<int>").alias("groupTimes"), none.cast("array<string>").alias("groupIds"), "roiIds", "repeats")
    )


def with_groups(observed: DataFrame, groups: dict[str, list[int]]) -> DataFrame:
    """observed with names (sorted) and sizes of all groups that hold all of its `times`; more than one is an ambiguity."""
    table = F.array(*[F.struct(F.lit(k).alias("name"), F.array(*[F.lit(t) for t in sorted(set(v))]).alias("members")) for k, v in sorted(groups.items())])
    held = F.filter(table, lambda g: F.size(F.array_except("times", g["members"])) == 0)
    return observed.withColumn("held_", held).withColumn("names", F.transform("held_", lambda g: g["name"])).withColumn("sizes", F.transform("held_", lambda g: F.size(g["members"]))).drop("held_")


def reindex(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """name: the 0-based rank of column among its distinct values within keys."""
    places = rank_within(df.select(*keys, column).distinct(), keys, [column], name)
    return join_same(df, places, [*keys, column])
