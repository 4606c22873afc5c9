"""Counts and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.ranks import join_same
from spotweave.runtime import stage


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], *, most: int = 100_000) -> DataFrame:
    """keys and, for each name, the exact quantile of value by linear interpolation; null values do not count.

    Selection instead of a sort: rows are counted by key and range of values, the ranges that hold a wanted place follow from the
    counts, and only their rows are read again. A range of over `most` rows that are not all equal is first cut into 1024 of equal
    width, as often as it takes. The first ranges go by the logarithm of the value, 64 to a power of e, so that a key has
    some thousands at most, whatever the input. Counts are added up before the shuffle, and no key's values meet."""
    v = F.col(value).cast("double")
    size = F.floor(F.signum("v_") * F.log1p(F.abs("v_")) * 64)
    step = F.when(F.isnan("v_"), F.lit(1 << 40)).otherwise(F.greatest(F.lit(-1 << 39), F.least(F.lit(1 << 39), size)))
    rows = df.select(*keys, F.when(v == 0, F.lit(0.0)).otherwise(v).alias("v_")).where("v_ is not null")
    rows = stage(rows.select("*", F.lit("").alias("of_"), step.cast("long").alias("step_"), F.lit(0).cast("long").alias("start_"), F.lit(None).cast("long").alias("total_")), "quantile-values")
    at = {q: (F.col("total_") - 1) * float(s) for q, s in shares.items()}
    places = F.array(*[end(at[q]).cast("long") for q in shares for end in (F.floor, F.ceil)])
    range_ = Window.partitionBy(*keys, "of_", "step_").orderBy("v_")
    ends = []
    while True:
        group = Window.partitionBy(*keys, "of_")
        counts = rows.groupBy(*keys, "of_", "step_", "start_", "total_").agg(F.count("*").alias("n_"), F.min("v_").alias("lo_"), F.max("v_").alias("hi_"))
        lower = F.coalesce(F.sum("n_").over(group.orderBy("step_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select(*keys, "of_", "step_", "n_", "lo_", "hi_", F.coalesce("total_", F.sum("n_").over(group)).alias("total_"), (F.col("start_") + lower).alias("start_"))
        found = stage(counts.where(F.exists(places, lambda p: (p >= F.col("start_")) & (p < F.col("start_") + F.col("n_")))), "quantile-ranges")
        ends.append(found.where("lo_ = hi_").select(*keys, "total_", "start_", "n_", F.col("lo_").alias("v_")))
        rows = join_same(rows.drop("start_", "total_"), found.where("lo_ <> hi_"), [*keys, "of_", "step_"])
        few = rows.where(F.col("n_") <= most).select(*keys, "total_", (F.col("start_") + F.row_number().over(range_) - 1).alias("start_"), F.lit(1).cast("long").alias("n_"), "v_")
        ends.append(few)
        if found.where((F.col("n_") > most) & (F.col("lo_") != F.col("hi_"))).isEmpty():
            break
        fine = F.floor((F.col("v_") - F.col("lo_")) / (F.col("hi_") - F.col("lo_")) * 1024)
        rows = rows.where(F.col("n_") > most).select(*keys, "v_", F.concat_ws("/", "of_", F.col("step_").cast("string")).alias("of_"), fine.alias("step_"), "start_", "total_")
    near = lambda q, end: F.max(F.when((end(at[q]) >= F.col("start_")) & (end(at[q]) < F.col("start_") + F.col("n_")), F.col("v_"))).alias(f"{q}_{end.__name__}")
    picked = reduce(DataFrame.union, ends).groupBy(*keys, "total_").agg(*[near(q, e) for q in shares for e in (F.floor, F.ceil)])
    between = lambda q: F.col(f"{q}_floor") + (at[q] - F.floor(at[q])) * (F.col(f"{q}_ceil") - F.col(f"{q}_floor"))
    return picked.select(*keys, *[between(q).alias(q) for q in shares])


def summarise(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Quartiles, mean and the 95 % interval of the mean of each column by key, in long form (A5)."""
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])).alias("v")).select(key, "v.*")
    half = 1.96 * F.stddev_samp("value") / F.sqrt(F.count("value"))
    moments = long.groupBy(key, "variable").agg(F.avg("value").alias("mean"), (F.avg("value") - half).alias("low"), (F.avg("value") + half).alias("high"))
    middle = quantiles(long, [key, "variable"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return join_same(moments, middle, [key, "variable"], "left").select(key, "variable", "q25", "q50", "q75", "mean", "low", "high")
