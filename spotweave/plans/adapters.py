"""The driver's tables in the roles of the engine's inputs, in Spark and as SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators.geometry import AXES, box_around
from spotweave.runtime import read

SCALE = (3.0, 1.0, 1.0)  # nanometres by unit, z y x, over a hundred
BOX = (8, 16, 16)
ROWS = 250_000  # of lineitem in a task

ROI_SQL = """roi AS (SELECT CAST(vec_id AS BIGINT) AS roi_id, CAST(label AS INT) AS fov, CAST(vec_id % 8 AS INT) AS timepoint, 0 AS channel,
  CAST(embedding[1] AS DOUBLE) * 1e2 AS zc, CAST(embedding[2] AS DOUBLE) * 1e2 AS yc, CAST(embedding[3] AS DOUBLE) * 1e2 AS xc FROM embeddings),
drift AS (SELECT DISTINCT fov, timepoint, CAST(2 * ((fov + timepoint) % 5) - 4 AS DOUBLE) AS coarse, CAST(fov * 8 + timepoint AS DOUBLE) / 1e2 - 4e-1 AS fine FROM roi),
shifted AS (SELECT roi_id, fov, timepoint, channel, zc + coarse + fine AS zc, yc + coarse + fine AS yc, xc + coarse + fine AS xc FROM roi JOIN drift USING (fov, timepoint))"""

TRACE_SQL = """trace AS (SELECT CAST(l_orderkey AS BIGINT) AS trace_id, CAST(l_linenumber AS INT) AS locus,
  min(l_quantity) AS zc, min(l_extendedprice) / 1e3 AS yc, min(l_discount) * 1e2 AS xc FROM lineitem GROUP BY 1, 2)"""

FIT_SQL = """fit AS (SELECT CAST(l_orderkey AS BIGINT) AS trace_id, CAST(l_linenumber AS INT) AS timepoint, CAST(l_suppkey % 10 AS INT) AS fov, l_extendedprice AS signal, l_quantity * 5e2 AS background,
  l_discount * 2e3 AS sigma_xy, l_tax * 5e3 AS sigma_z, l_quantity * 25 AS ref_dist, l_quantity * 96 AS z, l_quantity * 68 AS y, l_extendedprice / 30 AS x FROM lineitem)"""

BEAD_FILE_SQL = """bead_file AS (SELECT CAST(event_id AS BIGINT) AS bead_id, CAST(user_id % 7 AS INT) AS fov, CAST(day(ts) AS INT) AS timepoint, value AS max_intensity,
  CASE event_id % 5 WHEN 0 THEN 'zs' WHEN 1 THEN 'i' WHEN 2 THEN 'yxi' ELSE '' END AS fail_code FROM events)"""


def roi(spark: SparkSession, sf: str, boxes: bool = False) -> DataFrame:
    e = read(spark, sf, "embeddings")
    at = [(F.element_at("embedding", i + 1).cast("double") * 100.0).alias(f"{a}c") for i, a in enumerate(AXES)]
    out = e.select(F.col("vec_id").cast("long").alias("roi_id"), F.col("label").cast("int").alias("fov"), (F.col("vec_id") % 8).cast("int").alias("timepoint"), F.lit(0).alias("channel"), *at)
    return out.withColumns(box_around(BOX)) if boxes else out


def drift(rois: DataFrame) -> DataFrame:
    coarse = (2 * ((F.col("fov") + F.col("timepoint")) % 5) - 4).cast("double")
    fine = (F.col("fov") * 8 + F.col("timepoint")).cast("double") / 100.0 - 0.4
    keys = rois.select("fov", "timepoint").distinct()
    return keys.select("fov", "timepoint", *[coarse.alias(f"{a}_coarse") for a in AXES], *[fine.alias(f"{a}_fine") for a in AXES])


def trace(spark: SparkSession, sf: str) -> DataFrame:
    """Dealt out by trace into parts that grow in number, not in size; joins of a trace's rows need no other shuffle."""
    li = read(spark, sf, "lineitem")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // ROWS))
    rows = li.select(F.col("l_orderkey").cast("long").alias("trace_id"), F.col("l_linenumber").cast("int").alias("locus"), "l_quantity", "l_extendedprice", "l_discount")
    return rows.repartition(n, "trace_id").groupBy("trace_id", "locus").agg(F.min("l_quantity").alias("zc"), (F.min("l_extendedprice") / 1000.0).alias("yc"), (F.min("l_discount") * 100.0).alias("xc"))


def fit(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return li.select(
        F.col("l_orderkey").cast("long").alias("trace_id"), F.col("l_linenumber").cast("int").alias("timepoint"), (F.col("l_suppkey") % 10).cast("int").alias("fov"), p.alias("signal"), (q * 500.0).alias("background"),
        (F.col("l_discount") * 2000.0).alias("sigma_xy"), (F.col("l_tax") * 5000.0).alias("sigma_z"), (q * 25.0).alias("ref_dist"), (q * 96.0).alias("z"), (q * 68.0).alias("y"), (p / 30.0).alias("x"),
        F.lit(4800.0).alias("box_z"), F.lit(3434.0).alias("box_y"), F.lit(3434.0).alias("box_x"),
    )


def bead_file(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    code = F.when(F.col("event_id") % 5 == 0, "zs").when(F.col("event_id") % 5 == 1, "i").when(F.col("event_id") % 5 == 2, "yxi").otherwise("")
    return e.select(F.col("event_id").cast("long").alias("bead_id"), (F.col("user_id") % 7).cast("int").alias("fov"), F.dayofmonth("ts").cast("int").alias("timepoint"), F.col("value").alias("max_intensity"), code.alias("fail_code"))
