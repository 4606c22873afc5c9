"""Beads: fail codes, counts, thresholds and partitions (FL2, FL9, FL14, A4, A6, A7, J13, W9, C11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bead_fail_code(half: tuple[int, int, int], max_area: float, min_intensity: float, max_intensity: float | None = None) -> Column:
    """Letters z, y, x (too near the low border), s, i and, with a maximum, I; empty for a pass."""
    parts = [F.when(F.col(f"{a}c") <= h, a).otherwise("") for a, h in zip("zyx", half, strict=True)]
    parts += [F.when(F.col("area") > max_area, "s").otherwise(""), F.when(F.col("max_intensity") < min_intensity, "i").otherwise("")]
    if max_intensity is not None:
        parts.append(F.when(F.col("max_intensity") > max_intensity, "I").otherwise(""))
    return F.concat(*parts)


def passes() -> Column:
    return F.col("fail_code").isNull() | (F.col("fail_code") == "") | F.lower("fail_code").isin("nan")


def letter_histogram(df: DataFrame) -> DataFrame:
    """Rows for each letter of the codes."""
    letters = df.select(F.explode(F.split("fail_code", "")).alias("letter")).where("letter <> ''")
    return letters.groupBy("letter").agg(F.count("*").alias("n"))


def nth_largest(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """The n-th largest value of each group; groups with fewer have none."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return df.withColumn("rn_", F.row_number().over(w)).where(F.col("rn_") == n).select(*keys, F.col(value).alias("nth"))


def lowest_threshold(thresholds: DataFrame) -> DataFrame:
    """The least of the files' n-th largest values, null where there is none."""
    return thresholds.agg(F.min("nth").alias("nth"))


def sample_beads(df: DataFrame, n: int, seed: int = 1, order: str = "bead_id") -> DataFrame:
    """n rows of each (fov, timepoint), or all, in a seeded order of the ids."""
    return partition_beads(df, n, 0, seed, order).where("part = 'shifting'").drop("part")


def joined_counts(every: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of two tables side by side, 0 where the second has no row."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    return count(every, "n_all").join(count(kept, "n_kept"), keys, "left").withColumn("n_kept", F.coalesce("n_kept", F.lit(0).cast("long")))


def counts_by_status(df: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """All rows and passing rows of each group, 0 for none."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_all"), F.count_if(ok).alias("n_pass"))


def partition_beads(df: DataFrame, n_shifting: int, n_accuracy: int, seed: int | None = 0, order: str = "bead_id") -> DataFrame:
    """df with part: shifting, accuracy or null, by a seeded hash order within (fov, timepoint), or by order if seed is None."""
    by = F.col(order) if seed is None else F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(order).cast("string")))
    rank = F.row_number().over(Window.partitionBy("fov", "timepoint").orderBy(by, order))
    return df.withColumn("rn_", rank).withColumn("part", F.when(F.col("rn_") <= n_shifting, "shifting").when(F.col("rn_") <= n_shifting + n_accuracy, "accuracy")).drop("rn_")


def partition_sizes(counts: DataFrame, n_shifting: int, n_accuracy: int, least: int = 10) -> DataFrame:
    """Sizes and outcome of a partition from n usable beads (C11): severe, rescued, few_accuracy or full."""
    n = F.col("n")
    shifting = F.when(n < least, 0).otherwise(F.least(n, F.lit(n_shifting)))
    accuracy = F.when(n < least, 0).otherwise(F.greatest(F.least(n - n_shifting, F.lit(n_accuracy)), F.lit(0)))
    outcome = F.when(n < least, "severe").when(n < n_shifting, "rescued").when(n < n_shifting + n_accuracy, "few_accuracy").otherwise("full")
    return counts.select("*", shifting.cast("long").alias("shifting"), accuracy.cast("long").alias("accuracy"), outcome.alias("outcome"))
