"""Queries on images in chunked arrays and in tiles, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import detection, tiles
from spotweave.operators.naming import fov_name
from spotweave.plans import adapters as ad
from spotweave.plans.analysis import _BRIGHT, volumes
from spotweave.plans.registry import query, r6
from spotweave.runtime import scratch
from spotweave.sources import chunks

CHUNK = (1, 1, 2, 4, 4)


def stacks(spark, sf, bright: bool = False) -> tuple[DataFrame, tuple[int, ...]]:
    """Every vector as an image of 4 x 4 x 4 voxels, the label its field of view and the id its timepoint, in pieces, and the shape of a field."""
    e = ad.read(spark, sf, "embeddings")
    last = e.agg(F.max("vec_id")).first()[0]
    named = e.select(F.col("vec_id").alias("id"), "label", F.transform("embedding", lambda v: v.cast("double")).alias("voxels"))
    rows = volumes(spark, sf).select(F.col("vec_id").alias("id"), "voxels").join(named.drop("voxels"), "id") if bright else named
    at = F.array(F.col("id").cast("int"), *[F.lit(0)] * 4)
    return rows.select(fov_name(F.col("label")).alias("field"), at.alias("start"), F.array(*[F.lit(n) for n in (1, 1, 4, 4, 4)]).alias("shape"), "voxels"), ((last if last is not None else -1) + 1, 1, 4, 4, 4)


def stored(spark, sf, bright: bool = False) -> str:
    path = scratch(spark, "images")
    pieces, shape = stacks(spark, sf, bright)
    chunks.write_chunks(chunks.rechunked(pieces, CHUNK, shape), path, CHUNK)
    return path


_FIELD = "printf('P%04d', label + 1)"
_HALVES = f"SELECT {_FIELD} AS field, CAST(vec_id AS INT) AS t, CAST(h AS INT) AS z, CAST(list_min(embedding[32 * h + 1:32 * h + 32]) AS DOUBLE) AS least, CAST(list_max(embedding[32 * h + 1:32 * h + 32]) AS DOUBLE) AS largest, CAST(embedding[32 * h + 1] AS DOUBLE) AS first FROM embeddings, (SELECT unnest(range(2)) AS h)"


def _halves(df: DataFrame) -> DataFrame:
    return df.select("field", F.col("t_chunk").alias("t"), F.col("z_chunk").alias("z"), F.array_min("voxels").alias("least"), F.array_max("voxels").alias("largest"), F.get("voxels", F.lit(0)).alias("first"))


@query(_HALVES)
def chunks_round_trip(spark, sf):
    """IO16, IO17: every image in two chunks, written and read back."""
    return _halves(chunks.read_chunks(spark, stored(spark, sf)))


@query(_HALVES + " WHERE label = 3 AND h = 1")
def chunks_of_field(spark, sf):
    """IO16: the upper halves of the images of one field of view; other files are not opened."""
    return _halves(chunks.read_chunks(spark, stored(spark, sf)).where("field = 'P0004' and z_chunk = 1"))


@query(f"SELECT CAST(vec_id AS BIGINT) AS vec_id, '2 3 3' AS shape, round(sum(v), 6) AS total, round(max(v), 6) AS largest, CASE WHEN vec_id % 3 = 0 THEN 'padded in y or x' END AS reason FROM (SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE {_BRIGHT} END AS v FROM embeddings, (SELECT unnest(range(64)) AS i) WHERE i // 16 BETWEEN 1 AND 2 AND i // 4 % 4 BETWEEN 1 AND 3 AND i % 4 BETWEEN 1 AND 3) GROUP BY vec_id")
def voxel_crops_chunked(spark, sf):
    """K8, K10 from chunks: a box that meets two chunks of every image; those of every third are padded in y, and give zeros with the reason."""
    path = stored(spark, sf, bright=True)
    bounds = {f"{a}_{k}": F.lit(float(n)) for a, lo, hi in (("z", 1, 3), ("y", 1, 4), ("x", 1, 4)) for k, n in (("lo", lo), ("hi", hi), ("pad_lo", 0), ("pad_hi", 0))}
    e = ad.read(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), fov_name(F.col("label")).alias("field"), F.col("vec_id").cast("int").alias("timepoint"), F.lit(0).alias("channel"))
    boxes = e.withColumns(bounds).withColumn("y_pad_lo", F.when(F.col("vec_id") % 3 == 0, 1.0).otherwise(0.0))
    cut = chunks.cropped_chunks(boxes, path, ["vec_id"])
    inner = F.when(F.col("reason").isNull(), F.col("voxels")).otherwise(F.array(F.lit(0.0)))
    return cut.select("vec_id", F.when(F.col("reason").isNull(), F.array_join(F.col("shape").cast("array<string>"), " ")).otherwise("2 3 3").alias("shape"), r6(F.aggregate(inner, F.lit(0.0), lambda a, x: a + x), "total"), r6(F.array_max(inner), "largest"), "reason")


@query(f"""WITH RECURSIVE v AS (SELECT CAST(vec_id AS INT) AS t, label, i, i // 16 AS z, i // 4 % 4 AS y, i % 4 AS x, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(64)) AS i) WHERE embedding[i + 1] > 0),
near AS (SELECT a.t AS t, a.i AS a, b.i AS b FROM v a JOIN v b ON a.t = b.t AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1),
reach(t, node, other) AS (SELECT t, i, i FROM v UNION SELECT r.t, r.node, n.b FROM reach r JOIN near n ON n.t = r.t AND n.a = r.other),
part AS (SELECT t, node, min(other) AS first FROM reach GROUP BY t, node)
SELECT {_FIELD} AS field, v.t AS t, CAST(row_number() OVER (PARTITION BY v.t ORDER BY first) AS BIGINT) AS label, count(*) AS area, round(avg(z), 6) AS zc, round(avg(y), 6) AS yc, round(avg(x), 6) AS xc, max(v) AS max_intensity FROM v JOIN part ON v.t = part.t AND v.i = part.node GROUP BY v.t, v.label, first""")
def tiled_regions(spark, sf):
    """K1, K9, K12 in tiles of 2 x 2 x 3 voxels: the parts of every image above 0."""
    pieces, shape = stacks(spark, sf)
    found = tiles.regions(pieces, shape, (2, 2, 3), 0.0, tiles.Seen("intensity"))
    return found.select("field", "t", "label", "area", *[r6(f"{a}c") for a in "zyx"], "max_intensity")


@query()
def split_nuclei(spark, sf):
    """K11; no SQL: flooding. The parts of every image above 0, touching ones split."""
    e = ad.read(spark, sf, "embeddings")
    images = e.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double")).alias("voxels"), F.array(*[F.lit(4)] * 3).alias("shape"))
    found = detection.nuclei(images, ["vec_id"], sigma=0.3, threshold=0.0, split=True, prominence=0.4, rows=200)
    return found.select("vec_id", "label", "area", "zc", "yc", "xc")
