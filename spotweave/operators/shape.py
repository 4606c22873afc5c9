"""Shape of traces: gyration, contour, distance and contact maps, loops (A15, A16, A20, W11, SC12, SC14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.geometry import AXES, distance
from spotweave.operators.summaries import quantiles


def radius_of_gyration(df: DataFrame, keys: list[str]) -> DataFrame:
    """sqrt of the summed population variances of the coordinates."""
    return df.groupBy(*keys).agg(F.sqrt(sum((F.var_pop(a) for a in AXES[1:]), F.var_pop("z"))).alias("gyration"), F.count("*").alias("n"))


def contour_length(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Sum of the distances of consecutive points; 0 for a single point."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = distance(tuple(F.col(a) for a in AXES), tuple(F.lag(a).over(w) for a in AXES))
    return df.withColumn("step", step).groupBy(*keys).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("contour"))


MAP = ["locus_1", "locus_2"]


def mean_map(pairs: DataFrame) -> DataFrame:
    """The mean distance of each pair of loci."""
    return pairs.groupBy(*MAP).agg(F.avg("distance").alias("mean_distance"))


def median_map(pairs: DataFrame) -> DataFrame:
    """The median distance of each pair of loci."""
    return quantiles(pairs, MAP, "distance", {"median_distance": 0.5})


def contact_map(pairs: DataFrame, cutoff: float) -> DataFrame:
    """The share of positive distances below cutoff for each pair of loci; no positive one gives 1."""
    close, positive = F.count_if(F.col("distance") < cutoff), F.count_if(F.col("distance") > 0)
    return pairs.groupBy(*MAP).agg(F.when(positive == 0, F.lit(1.0)).otherwise(close / positive).alias("contact"))


def elongation(df: DataFrame, keys: list[str]) -> DataFrame:
    """One less the second over the first principal variance, from the 3 x 3 covariance in closed form; null without extent."""
    v = {a: F.var_pop(a) for a in AXES}
    c = {a + b: F.covar_pop(a, b) for a, b in (("z", "y"), ("z", "x"), ("y", "x"))}
    m = df.groupBy(*keys).agg(*[x.alias("v" + a) for a, x in v.items()], *[x.alias("c" + a) for a, x in c.items()])
    q = (F.col("vz") + F.col("vy") + F.col("vx")) / 3
    off = F.col("czy") ** 2 + F.col("czx") ** 2 + F.col("cyx") ** 2
    m = m.withColumn("q", q).withColumn("p", F.sqrt(((F.col("vz") - q) ** 2 + (F.col("vy") - q) ** 2 + (F.col("vx") - q) ** 2 + 2 * off) / 6))
    a, b, d = F.col("vz") - F.col("q"), F.col("vy") - F.col("q"), F.col("vx") - F.col("q")
    det = a * (b * d - F.col("cyx") ** 2) - F.col("czy") * (F.col("czy") * d - F.col("cyx") * F.col("czx")) + F.col("czx") * (F.col("czy") * F.col("cyx") - b * F.col("czx"))
    phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det / (2 * F.col("p") ** 3)))) / 3
    first, third = F.col("q") + 2 * F.col("p") * F.cos(phi), F.col("q") + 2 * F.col("p") * F.cos(phi + 2 * 3.141592653589793 / 3)
    second = F.greatest(3 * F.col("q") - first - third, F.lit(0.0))
    return m.select(*keys, F.when(F.col("q") <= 0, None).when(F.col("p") == 0, F.lit(0.0)).otherwise(1 - second / first).alias("elongation"))


def loop_fractions(df: DataFrame, cell: str, label: str) -> DataFrame:
    """Share of cells without any loop, and with each class (A20, SC14)."""
    cells = df.groupBy(cell).agg(F.bool_and(F.col(label) == 0).alias("none"), *[F.bool_or(F.col(label) == k).alias(f"class_{k}") for k in range(1, 6)])
    return cells.agg(F.avg(F.col("none").cast("double")).alias("none"), *[F.avg(F.col(f"class_{k}").cast("double")).alias(f"class_{k}") for k in range(1, 6)])
