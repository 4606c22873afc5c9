"""Merging of regions of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.checks import require_none, require_unique
from spotweave.operators.components import connected_components
from spotweave.operators.geometry import AXES


def partner_edges(assessed: DataFrame) -> DataFrame:
    return assessed.select(F.col("roi_id").alias("src"), F.explode("merge_partners").alias("dst"))


def with_components(rois: DataFrame, edges: DataFrame) -> DataFrame:
    """rois with component (smallest member) and component_size; a roi without an edge is its own."""
    found = connected_components(edges).withColumnRenamed("node", "roi_id")
    sizes = found.groupBy("component").agg(F.count("*").alias("component_size"))
    joined = rois.join(found.join(sizes, "component"), "roi_id", "left")
    return joined.withColumn("component", F.coalesce("component", "roi_id")).withColumn("component_size", F.coalesce("component_size", F.lit(1)))


def numbered(groups: DataFrame, order: str, above: DataFrame, top: str) -> DataFrame:
    """groups with `number`: one above the largest `top` for the first in order, and so on.

    Ranks are counted within range partitions and offset by the counts before, so no single task sorts all."""
    parts = groups.repartitionByRange(F.col(order)).withColumn("part_", F.spark_partition_id())
    from spotweave.runtime import stage

    held = stage(parts.withColumn("rank_", F.row_number().over(Window.partitionBy("part_").orderBy(order))), "numbered")
    counts = held.groupBy("part_").agg(F.count("*").alias("n_"))
    before = counts.select("part_", (F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")).alias("before_"))  # a row for each partition
    largest = above.agg(F.coalesce(F.max(top), F.lit(-1)).alias("top_"))
    return held.join(F.broadcast(before), "part_").join(F.broadcast(largest)).withColumn("number", (F.col("top_") + F.col("before_") + F.col("rank_")).cast("long")).drop("part_", "rank_", "before_", "top_")


def merge_rois(assessed: DataFrame, *, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(contributors with merge_output, results: singletons and merged rois).

    A merged roi has the mean centre, the largest extent on each axis around it, and the sorted ids of its members.
    Jobs run when this is called. When validated, repeated ids and groups of several contexts are errors."""
    if validate:
        require_unique(assessed, ["roi_id"], "roi id")
    comps = with_components(assessed, partner_edges(assessed))
    several = comps.where("component_size > 1")
    extents = [F.max(F.col(f"{a}_max") - F.col(f"{a}_min")).alias(f"{a}_size") for a in AXES]
    one = several.groupBy("component").agg(
        *[F.first(c).alias(c) for c in ("fov", "timepoint", "channel")],
        F.count_distinct(F.struct("fov", "timepoint", "channel")).alias("contexts"),
        *[F.avg(f"{a}c").alias(f"{a}c") for a in AXES], *extents,
        F.array_sort(F.collect_set("roi_id")).alias("merge_partners"),
    )
    if validate:
        require_none(one, F.col("contexts") > 1, "a merged group spans several imaging contexts")
    one = numbered(one, "component", assessed, "roi_id")
    boxes = {f"{a}_{s}": F.col(f"{a}c") + (F.col(f"{a}_size") / 2) * k for a in AXES for s, k in (("min", -1), ("max", 1))}
    merged = one.withColumns(boxes).withColumn("roi_id", F.col("number"))
    columns = ["roi_id", "fov", "timepoint", "channel", *[f"{a}c" for a in AXES], *[f"{a}_{s}" for a in AXES for s in ("min", "max")], "merge_partners"]
    contributors = several.join(one.select("component", F.col("number").alias("merge_output")), "component").drop("component", "component_size")
    singles = comps.where("component_size = 1").select(*columns)
    return contributors, singles.unionByName(merged.select(*columns))


def recover_contributors(results: DataFrame, rois: DataFrame, *, validate: bool = True) -> DataFrame:
    """(roi_id, merge_output) of all members of merged rois, joined back to the originals (J16); one that went into two
    merged rois is an error when validated."""
    parts = results.where(F.size("merge_partners") > 1).select(F.col("roi_id").alias("merge_output"), F.explode("merge_partners").alias("roi_id"))
    if validate:
        require_unique(parts, ["roi_id"], "contribution")
    return rois.join(parts, "roi_id")


def partner_records(assessed: DataFrame, rois: DataFrame, columns: list[str], *, validate: bool = True) -> DataFrame:
    """One row for each roi and partner with the partner's columns as partner_*; an unknown partner is an error when validated."""
    edges = partner_edges(assessed)
    found = edges.join(rois.select(F.col("roi_id").alias("dst"), *[F.col(c).alias(f"partner_{c}") for c in columns], F.lit(True).alias("known_")), "dst", "left")
    if validate:
        require_none(found, F.col("known_").isNull(), "unknown merge partner")
    return found.select(F.col("src").alias("roi_id"), F.col("dst").alias("partner_id"), *[f"partner_{c}" for c in columns])


def split_groups(rois: DataFrame, groups: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored groups (roi_id, group_id) whose members are not one component of the edges among them."""
    own = edges.join(groups.select(F.col("roi_id").alias("src"), F.col("group_id").alias("g1")), "src").join(groups.select(F.col("roi_id").alias("dst"), F.col("group_id").alias("g2")), "dst").where("g1 = g2")
    parts = with_components(groups, own.select("src", "dst"))
    return parts.groupBy("group_id").agg(F.count_distinct("component").alias("parts")).where("parts > 1")
