"""Pairs and proximity.

A proximity join is an equi-join: space is cut into cells as wide as the threshold, one side is copied into the
neighbouring cells, and the distance is checked within a cell. All thresholds are strict, so a threshold of zero
has no pairs. Where all pairs are the result (J3, J4), a plain self-join on the group is used."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.checks import require_found, require_unique
from spotweave.operators.geometry import AXES, distance
from spotweave.runtime import stage

POINT = [f"{a}c" for a in AXES]
Scale = tuple[float, float, float]


def side(df: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in keep])


def _points(suffix: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{c}{suffix}") for c in POINT)


def group_pairs(df: DataFrame, group: list[str], order: str, keep: list[str], scale: Scale = (1.0, 1.0, 1.0), *, unique: bool = False, one_of: tuple[str, ...] = (), most: int | None = None) -> DataFrame:
    """All unordered pairs inside a group, the smaller `order` first, with their distance (J3, J4). With unique, an order that
    repeats in a group is an error; so are groups with more than one value of a column in one_of. With most, the rows of larger groups are
    cut into shares of about so many, and every two shares are a key of their own; groups are counted first, by a job of its own."""
    if unique:
        require_unique(df, [*group, order], f"{order} in a group")
    for c in one_of:
        require_unique(df.select(*group, c).distinct(), group, f"group with several values of {c}")
    cols = list(dict.fromkeys([*group, order, *keep, *POINT]))
    a, b = side(df, "_1", cols), side(df, "_2", cols)
    on = reduce(lambda p, q: p & q, [F.col(f"{g}_1") == F.col(f"{g}_2") for g in group])
    if most is not None:
        heavy = stage(df.groupBy(*group).agg(F.ceil(F.count("*") / most).cast("int").alias("shares")).where("shares > 1"), "heavy-groups")
        keys = heavy.agg(F.sum(F.col("shares").cast("long") * F.col("shares"))).first()[0]
        if keys:
            n = min(10_000, max(keys, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
            shares = F.coalesce("shares", F.lit(1))

            def dealt(s: DataFrame, i: int) -> DataFrame:
                own, every = F.pmod(F.xxhash64(f"{order}_{i}"), shares).cast("int"), F.explode(F.sequence(F.lit(0), shares - 1))
                met = s.join(heavy.withColumnsRenamed({g: f"{g}_{i}" for g in group}), [f"{g}_{i}" for g in group], "left")
                met = met.withColumn(f"share_{i}_1", own if i == 1 else every).withColumn(f"share_{i}_2", own if i == 2 else every).drop("shares")
                return met.repartition(n, *[f"{g}_{i}" for g in group], f"share_{i}_1", f"share_{i}_2")

            a, b = dealt(a, 1), dealt(b, 2)
            on = on & (F.col("share_1_1") == F.col("share_2_1")) & (F.col("share_1_2") == F.col("share_2_2"))
            found = a.join(b, on & (F.col(f"{order}_1") < F.col(f"{order}_2"))).drop(*[f"share_{i}_{j}" for i in (1, 2) for j in (1, 2)])
            return found.withColumn("distance", distance(_points("_1"), _points("_2"), scale))
    return a.join(b, on & (F.col(f"{order}_1") < F.col(f"{order}_2"))).withColumn("distance", distance(_points("_1"), _points("_2"), scale))


def near_pairs(left: DataFrame, right: DataFrame, group: list[str], threshold: float, keep: list[str], scale: Scale = (1.0, 1.0, 1.0), where: Column | None = None, *, most: int = 4096) -> DataFrame:
    """Pairs (suffixes _1 of left, _2 of right) of the same group that are closer than threshold.

    A cell with over `most` points of left is dealt out: its points are cut into shares of about `most` rows, as are those that meet it from
    right, and every two shares are a key of their own, so that no task compares more than most * most pairs of a cell. Cells
    are counted first, by a job of its own. Null or NaN coordinates are near to nothing."""
    cols = list(dict.fromkeys([*group, *keep, *POINT]))
    width = float(threshold) if threshold > 0 else 1.0
    cell = lambda c, s: F.floor(F.col(c) * float(s) / width)
    known = reduce(lambda p, q: p & q, [F.col(c).isNotNull() & ~F.isnan(c) for c in POINT])
    a = side(left.where(known).where(F.lit(threshold > 0)), "_1", cols)
    b = side(right.where(known), "_2", cols)
    for c, s in zip(POINT, scale, strict=True):
        a = a.withColumn(f"cell_{c}", cell(f"{c}_1", s))
        b = b.withColumn(f"cell_{c}", F.explode(F.array(*[cell(f"{c}_2", s) + F.lit(k) for k in (-1, 0, 1)])))
    cells = [f"cell_{c}" for c in POINT]
    heavy = _shares(a, b, group, cells, most) if threshold > 0 else None
    if heavy is not None:
        own, other = [F.coalesce(F.col(f"shares_{i}"), F.lit(1)) for i in (1, 2)]
        deal = lambda df, i, n: F.pmod(F.xxhash64(*[c for c in df.columns if c.endswith(f"_{i}")]), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        at = lambda df, i: df.join(heavy.withColumnsRenamed({g: f"{g}_{i}" for g in group}), [*[f"{g}_{i}" for g in group], *cells], "left")
        a = at(a, 1).withColumn("share_a", deal(a, 1, own)).withColumn("share_b", every(other)).drop("shares_1", "shares_2")
        b = at(b, 2).withColumn("share_b", deal(b, 2, other)).withColumn("share_a", every(own)).drop("shares_1", "shares_2")
        cells = [*cells, "share_a", "share_b"]
    on = reduce(lambda p, q: p & q, [F.col(f"{g}_1") == F.col(f"{g}_2") for g in group])
    b = b.withColumnsRenamed({c: f"near_{c}" for c in cells})
    on = reduce(lambda p, q: p & q, [F.col(c) == F.col(f"near_{c}") for c in cells], on)
    found = a.join(b, on).withColumn("distance", distance(_points("_1"), _points("_2"), scale)).where(F.col("distance") < threshold)
    found = found.drop(*cells, *[f"near_{c}" for c in cells])
    return found if where is None else found.where(where)


def _shares(a: DataFrame, b: DataFrame, group: list[str], cells: list[str], most: int) -> DataFrame | None:
    """group, cells and the numbers of shares of the cells where over `most` points of a lie; None without such cells."""
    plain = lambda df, i: df.select(*[F.col(f"{g}_{i}").alias(g) for g in group], *cells).groupBy(*group, *cells).agg(F.count("*").alias("n"))
    heavy = stage(plain(a, 1).where(F.col("n") > most).select(*group, *cells, F.ceil(F.col("n") / most).cast("int").alias("shares_1")), "heavy-cells")
    if heavy.isEmpty():
        return None
    names = [*group, *cells]
    met = b.join(heavy.select(*[F.col(g).alias(f"{g}_2") for g in group], *cells), [*[f"{g}_2" for g in group], *cells], "left_semi")
    return stage(heavy.join(plain(met, 2), names, "left").select(*names, "shares_1", F.ceil(F.coalesce("n", F.lit(1)) / most).cast("int").alias("shares_2")), "heavy-cells")


def neighbour_sets(pairs: DataFrame, key: str, name: str) -> DataFrame:
    """For each member of a pair its partners, sorted (symmetric)."""
    both = pairs.select(F.col(f"{key}_1").alias(key), F.col(f"{key}_2").alias("o")).union(pairs.select(f"{key}_2", f"{key}_1"))
    return both.groupBy(key).agg(F.array_sort(F.collect_set("o")).alias(name))


def assess_merge(rois: DataFrame, threshold: float, scale: Scale) -> DataFrame:
    """rois with merge_partners: those closer than threshold at the same fov, timepoint and channel."""
    pairs = near_pairs(rois, rois, ["fov", "timepoint", "channel"], threshold, ["roi_id"], scale, F.col("roi_id_1") < F.col("roi_id_2"))
    sets = neighbour_sets(pairs, "roi_id", "merge_partners")
    return rois.join(sets, "roi_id", "left").withColumn("merge_partners", F.coalesce("merge_partners", F.array().cast("array<bigint>")))


def mutual_exclusion(rois: DataFrame, strategy: str, threshold: float, scale: Scale, groups: DataFrame | None = None, *, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(keepers, discards with too_close) among rois of the same fov and channel at different timepoints.

    permission: nothing is tested. prohibition: all pairs. selective_permission: pairs of different groups;
    selective_prohibition: pairs of the same group; groups is (timepoint, group_id). Both members of a close pair go. A
    timepoint without a group is an error under the selective strategies; if not validated, it is a group of its own."""
    if strategy == "permission":
        return rois, rois.where("false").withColumn("too_close", F.array().cast("array<bigint>"))
    keep, extra = ["roi_id", "timepoint"], F.col("timepoint_1") != F.col("timepoint_2")
    tested = rois
    if strategy != "prohibition":
        if strategy not in ("selective_permission", "selective_prohibition"):
            raise ValueError(f"unknown strategy {strategy}")
        if validate:
            require_found(rois, groups, ["timepoint"], "proximity group")
        tested, keep = rois.join(groups, "timepoint", "left"), [*keep, "group_id"]
        same = F.coalesce(F.col("group_id_1") == F.col("group_id_2"), F.lit(False))
        extra = extra & (same if strategy == "selective_prohibition" else ~same)
    pairs = near_pairs(tested, tested, ["fov", "channel"], threshold, keep, scale, extra & (F.col("roi_id_1") < F.col("roi_id_2")))
    close = neighbour_sets(pairs, "roi_id", "too_close")
    return rois.join(close, "roi_id", "left_anti"), rois.join(close, "roi_id")


def spot_bead_filter(spots: DataFrame, beads: DataFrame, threshold: float, scale: Scale = (1.0, 1.0, 1.0), *, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(keepers, discards with the ids of the beads closer than threshold), by field of view (J7). Both come with their drift
    applied, the beads with that of their own timepoint. A field of view without beads is an error when validated."""
    if validate:
        require_found(spots, beads, ["fov"], "beads")
    b = beads.withColumnRenamed("bead_id", "id")
    near = near_pairs(spots.withColumnRenamed("roi_id", "id"), b, ["fov"], threshold, ["id"], scale)
    hit = near.groupBy(F.col("id_1").alias("roi_id")).agg(F.array_sort(F.collect_set("id_2")).alias("beads"))
    return spots.join(hit, "roi_id", "left_anti"), spots.join(hit, "roi_id")


def rule_edges(rois: DataFrame, rules: DataFrame, longest: float, scale: Scale) -> DataFrame:
    """Edges of rois of one fov and channel whose two timepoints a rule names and whose distance is below the rule's
    threshold (J8, T2); rules: (timepoint_1, timepoint_2, threshold, rule), longest the largest threshold."""
    pairs = near_pairs(rois, rois, ["fov", "channel"], longest, ["roi_id", "timepoint"], scale, F.col("roi_id_1") < F.col("roi_id_2"))
    both = rules.union(rules.select("timepoint_2", "timepoint_1", "threshold", "rule")).distinct()
    return pairs.join(both, ["timepoint_1", "timepoint_2"]).where("distance < threshold").select(F.col("roi_id_1").alias("src"), F.col("roi_id_2").alias("dst"), "rule").distinct()


def ungrouped_violations(rois: DataFrame, threshold: float, scale: Scale) -> DataFrame:
    """Pairs of ungrouped rois of one fov and timepoint that are too close."""
    return near_pairs(rois, rois, ["fov", "timepoint"], threshold, ["roi_id"], scale, F.col("roi_id_1") < F.col("roi_id_2"))
