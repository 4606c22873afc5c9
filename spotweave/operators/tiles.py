"""Detection in images that are larger than a task: tiles with halos, parts labelled tile by tile and joined at the seams.

Images are pieces (field, start, shape, voxels by t, c, z, y, x), as `sources.chunks` reads them; an image is one field, t and c. A tile
gets a halo as wide as the blur. In each tile the parts of its mask are labelled, and it gives away a row for each part, with sums
from which the properties follow, and a row for each voxel of a part on a face where tiles meet. Faces are joined on the
place of the voxel; the parts that touch are the edges of a graph, whose components are the parts of the whole image. So
nothing but borders and parts is shuffled after the tiles are cut. A part is named by its first voxel, and labels follow the order of these,
as in an image that is labelled whole."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions import detection
from spotweave.operators.components import components_within
from spotweave.operators.ranks import join_same, rank_within
from spotweave.runtime import stage
from spotweave.sources.chunks import rechunked

IMAGE = ["field", "t", "c"]
STACK = 1 << 18  # voxels that are worked as one array
Shape = tuple[int, int, int, int, int]
_PART = [("kind", pa.string()), ("field", pa.string()), *[(n, pa.int32()) for n in ("t", "c", "axis")], *[(n, pa.int64()) for n in ("place", "first", "area")], *[(n, pa.float64()) for n in ("sum_z", "sum_y", "sum_x", "total", "largest")]]
_DDL = ", ".join(f"{n} {'string' if k == pa.string() else 'int' if k == pa.int32() else 'long' if k == pa.int64() else 'double'}" for n, k in _PART)


def blur_reach(*sigmas: float) -> int:
    """How far a blur reaches, as `detection.smoothed` cuts it off."""
    return max([0, *(max(1, int(4 * s + 0.5)) for s in sigmas if s)])


def tiles_of(pieces: DataFrame, tile: tuple[int, int, int], shape: Shape, reach: int) -> DataFrame:
    """Tiles (field, t, c, start, shape, voxels and core by z, y, x) of images, with a halo of `reach`."""
    out = rechunked(pieces, (1, 1, *tile), shape, (0, 0, *([reach] * 3)))
    rest = lambda c: F.slice(c, 3, 3)
    return out.select("field", F.col("core")[0].alias("t"), F.col("core")[1].alias("c"), rest("start").alias("start"), rest("shape").alias("shape"), rest("core").alias("core"), "voxels")


class Seen:
    """What a method makes of an image before the threshold; sigmas of its blurs, and how it is brought to a common scale."""

    def __init__(self, method: str, low: float = 0.8, high: float = 1.3, sigma: float = 1.0):
        if method not in ("intensity", "dog", "blur"):
            raise ValueError(f"no such method: {method}")
        self.method, self.sigmas = method, {"intensity": (), "dog": (low, high), "blur": (sigma,)}[method]

    def __call__(self, image: np.ndarray) -> np.ndarray:
        """The same for each of several images, if image has a first axis more."""
        blurred = [detection.smoothed(image, s, image.ndim - 3) for s in self.sigmas]
        return image if not blurred else blurred[0] if len(blurred) == 1 else blurred[0] - blurred[1]


def cores(batch: pa.RecordBatch, tile: tuple[int, int, int], seen: Seen) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, places, voxels and what the method sees of the tiles of a batch, without their halos: tiles of one shape as one array, of about
    STACK voxels at most, or of one tile if that has more."""
    start, shape, core = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3) for c in ("start", "shape", "core"))
    voxels = batch.column("voxels")
    lengths = voxels.value_lengths().to_numpy(zero_copy_only=False)
    if not np.array_equal(lengths, shape.prod(axis=1, dtype=np.int64)):
        raise ValueError("a tile whose voxels are not as many as its shape has")
    values, ends = voxels.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    kinds, of = np.unique(np.concatenate([shape, core - start], axis=1), axis=0, return_inverse=True)
    for k, kind in enumerate(kinds):
        whole, before = tuple(kind[:3].tolist()), kind[3:].tolist()
        inside = tuple(slice(b, min(b + n, e)) for b, n, e in zip(before, tile, whole, strict=True))
        rows = np.flatnonzero(of.ravel() == k)
        for some in np.array_split(rows, -(-len(rows) * math.prod(whole) // STACK)):
            if len(some):
                image = np.stack([values[ends[i] - lengths[i] : ends[i]] for i in some]).reshape(-1, *whole)
                yield some, core[some], image[:, *inside], seen(image)[:, *inside]


def moments(tiles: DataFrame, tile: tuple[int, int, int], seen: Seen) -> DataFrame:
    """field, t, c, n, mean, deviation, least and most of what the method sees in each image."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _, x in cores(batch, tile, seen):
                flat = x.reshape(len(rows), -1)
                mean = flat.mean(axis=1)
                found = [np.full(len(rows), flat.shape[1]), mean, ((flat - mean[:, None]) ** 2).sum(axis=1), flat.min(axis=1), flat.max(axis=1)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows)) for c in IMAGE), *map(pa.array, found)], names=[*IMAGE, "n", "mean", "off", "least", "most"])

    each = tiles.mapInArrow(task, "field string, t int, c int, n long, mean double, off double, least double, most double")
    total = each.groupBy(*IMAGE).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"), F.sum("off").alias("off"), F.sum(F.col("n") * F.col("mean") ** 2).alias("squares"), F.min("least").alias("least"), F.max("most").alias("most"))
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("off") + F.col("squares")) / F.col("n") - F.col("mean") ** 2))
    return total.select(*IMAGE, "n", "mean", spread.alias("deviation"), "least", "most")


def otsu_thresholds(tiles: DataFrame, tile: tuple[int, int, int], seen: Seen, bins: int = 256) -> DataFrame:
    """field, t, c and the threshold that parts each image's values into two classes of the largest variance between them: extents, then
    counts by tile, added up."""
    extents = stage(moments(tiles, tile, seen).select(*IMAGE, "least", "most"), "image-extents")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, most = batch.column("least").to_numpy(), batch.column("most").to_numpy()
            for i, x in ((i, x) for rows, _, _, stack in cores(batch, tile, seen) for i, x in zip(rows, stack, strict=True)):
                counts = np.histogram(x, bins, (least[i], most[i]))[0]
                used = np.flatnonzero(counts)
                row = pa.array(np.full(len(used), i))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in (*IMAGE, "least", "most")), pa.array(used), pa.array(counts[used])], names=[*IMAGE, "least", "most", "bin", "n"])

    counted = tiles.join(F.broadcast(extents), IMAGE).mapInArrow(task, "field string, t int, c int, least double, most double, bin long, n long")  # a row for each image
    found = counted.groupBy(*IMAGE, "least", "most", "bin").agg(F.sum("n").alias("n")).groupBy(*IMAGE, "least", "most").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))

    @F.pandas_udf("double")
    def threshold(least: pd.Series, most: pd.Series, counts: pd.Series) -> pd.Series:
        edges = (np.histogram_bin_edges(np.array([a, b]), bins) for a, b in zip(least, most, strict=True))
        return pd.Series([detection.otsu_of(np.array([dict(c).get(b, 0) for b in range(bins)]), e) for c, e in zip(counts, edges, strict=True)])

    return found.select(*IMAGE, threshold("least", "most", "counts").alias("threshold"))


def given(kind: str, batch: pa.RecordBatch, rows: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """Rows of one kind from tiles in the rows of a batch."""
    image = {c: batch.column(c).take(pa.array(rows)) for c in IMAGE}
    return pa.RecordBatch.from_arrays([image[c] if c in IMAGE else pa.array([kind] * len(rows), k) if c == "kind" else pa.array(more[c], k) if c in more else pa.nulls(len(rows), k) for c, k in _PART], schema=pa.schema(_PART))


def tile_parts(tiles: DataFrame, tile: tuple[int, int, int], shape: Shape, seen: Seen) -> DataFrame:
    """Parts and face voxels of tiles that come with the threshold, mean and deviation of their image. A voxel is named by its number in the image, in the
    order of z, y, x; a part by its first one."""
    by = np.array([shape[3] * shape[4], shape[4], 1], np.int64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limit, mean, deviation = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("threshold", "mean", "deviation"))
            for rows, places, image, x in cores(batch, tile, seen):
                scaled = [v[rows].reshape(-1, 1, 1, 1) for v in (mean, np.where(deviation == 0, 1.0, deviation), limit)]
                labels = detection.labelled((x - scaled[0]) / scaled[1] > scaled[2], 1)
                n = int(labels.max(initial=0))
                if not n:
                    continue
                held = np.argwhere(labels)  # tile of the stack, z, y, x
                of, values, inside = labels[labels > 0] - 1, image[labels > 0], held[:, 1:] + places[held[:, 0]]
                begin = np.full(n, len(of))
                np.minimum.at(begin, of, np.arange(len(of)))
                largest = np.full(n, -np.inf)
                np.maximum.at(largest, of, values)
                owner, first = held[begin, 0], inside[begin] @ by
                sums = {f"sum_{a}": np.bincount(of, inside[:, k].astype(float), n) for k, a in enumerate("zyx")}
                yield given("part", batch, rows[owner], first=first, area=np.bincount(of, minlength=n), **sums, total=np.bincount(of, values, n), largest=largest)
                for axis in range(3):
                    size = labels.shape[axis + 1]
                    for kind, at, there in (("low", 0, places[:, axis] > 0), ("high", size - 1, places[:, axis] + size < shape[axis + 2])):
                        face = np.take(labels, at, axis + 1)
                        face = np.where(there[:, None, None], face, 0)
                        spots, part = np.argwhere(face), face[face > 0] - 1
                        voxel = np.insert(spots[:, 1:], axis, at, axis=1) + places[spots[:, 0]]
                        voxel[:, axis] += kind == "high"
                        if len(part):
                            yield given(kind, batch, rows[spots[:, 0]], first=first[part], axis=np.full(len(part), axis), place=voxel @ by)

    return tiles.mapInArrow(task, _DDL)


def regions(pieces: DataFrame, shape: Shape, tile: tuple[int, int, int], threshold: float | None, seen: Seen) -> DataFrame:
    """field, t, c, label, zc, yc, xc, area, intensityMean, max_intensity and the first voxel of every part of the images of pieces
    (each of the given shape) whose value exceeds the threshold: that of the method, for dog in deviations from the
    image's mean, and found by the image's own histogram where none is given."""
    tiles = tiles_of(pieces, tile, shape, blur_reach(*seen.sigmas))
    if seen.method == "dog":
        tiles = stage(tiles, "tiles")
        known = stage(moments(tiles, tile, seen).select(*IMAGE, F.lit(threshold).alias("threshold"), "mean", "deviation"), "image-moments")
        tiles = tiles.join(F.broadcast(known), IMAGE)  # a row for each image
    elif threshold is None:
        tiles = stage(tiles, "tiles")
        known = stage(otsu_thresholds(tiles, tile, seen), "image-thresholds")
        tiles = tiles.join(F.broadcast(known), IMAGE).withColumn("mean", F.lit(0.0)).withColumn("deviation", F.lit(1.0))
    else:
        tiles = tiles.withColumns({"threshold": F.lit(float(threshold)), "mean": F.lit(0.0), "deviation": F.lit(1.0)})
    found = stage(tile_parts(tiles, tile, shape, seen), "tile-parts")
    seam = [*IMAGE, "axis", "place"]
    low, high = (found.where(F.col("kind") == k).select(*seam, F.col("first").alias(end)) for k, end in (("low", "src"), ("high", "dst")))
    joined = components_within(join_same(low, high, seam), IMAGE).withColumnRenamed("node", "first")
    parts = join_same(found.where("kind = 'part'"), joined, [*IMAGE, "first"], "left").withColumn("whole", F.coalesce("component", "first"))
    area = F.sum("area")
    whole = parts.groupBy(*IMAGE, "whole").agg(*[(F.sum(f"sum_{a}") / area).alias(f"{a}c") for a in "zyx"], area.alias("area"), (F.sum("total") / area).alias("intensityMean"), F.max("largest").alias("max_intensity"))
    ranked = rank_within(whole, IMAGE, ["whole"], "rank_")
    firsts = [F.expr(f"whole div {n} % {m}").cast("int").alias(f"first_{a}") for a, n, m in zip("zyx", (shape[3] * shape[4], shape[4], 1), shape[2:], strict=True)]
    return ranked.select(*IMAGE, (F.col("rank_") + 1).alias("label"), "zc", "yc", "xc", "area", "intensityMean", "max_intensity", *firsts)
