"""Alignment and clusters of traces (K16, K17, K18). Traces are rows with arrays z, y, x and good, as `pixels.traces_as_rows` makes them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions import kernels
from spotweave.operators.geometry import AXES
from spotweave.runtime import stage, unstage

POINTS = (*AXES, "good")


def _array(z, y, x) -> np.ndarray:
    return np.column_stack([z, y, x]).astype(float)


def aligned_pairs(traces: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """For every two traces (or each of traces with each of right) the root of the summed squared differences and one less the
    correlation of their points after the best rigid motion, over points that are good in both (K17); 1000 and 1 for fewer than three."""
    side = lambda df, i: df.select(F.col("trace_id").alias(f"trace_{i}"), F.struct(*POINTS).alias(f"p{i}"))
    a, b = side(traces, 1), side(traces if right is None else right, 2)
    both = a.join(b, F.col("trace_1") < F.col("trace_2")) if right is None else a.crossJoin(b)  # every two are the result

    @F.pandas_udf("aligned_distance double, aligned_pcc double")
    def compare(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        for u, v in zip(p.itertuples(index=False), q.itertuples(index=False), strict=True):
            keep = np.asarray(u.good, bool) & np.asarray(v.good, bool)
            if keep.sum() < 3:
                out.append((1000.0, 1.0))
                continue
            x, y = _array(u.z, u.y, u.x)[keep], _array(v.z, v.y, v.x)[keep]
            x, y = x - x.mean(axis=0), y - y.mean(axis=0)
            moved = kernels.rigid_onto(y, x)
            spread = np.sqrt((x**2).sum() * (moved**2).sum())
            out.append((float(np.sqrt(((x - moved) ** 2).sum())), float(1 - (x * moved).sum() / spread) if spread else 1.0))
        return pd.DataFrame(out, columns=["aligned_distance", "aligned_pcc"])

    return both.select("trace_1", "trace_2", compare("p1", "p2").alias("c")).select("trace_1", "trace_2", "c.*")


def general_procrustes(traces: DataFrame, *, tolerance: float = 0.01, least_good: int = 6, max_rounds: int = 50) -> tuple[DataFrame, list[list[float | None]]]:
    """Traces aligned to their mean, and the mean: align to a template, average the good points, and repeat until the summed
    distance changes by less than tolerance (K16). The first template is the trace of the smallest id that has more than
    least_good good points, or the most. A round is one pass; only the mean comes to the driver."""
    good = F.size(F.filter("good", lambda g: g))
    first = traces.orderBy((good > least_good).desc(), F.when(good > least_good, 0).otherwise(-good), "trace_id").select(*POINTS).first()
    if first is None:
        return traces, []
    template = _array(first.z, first.y, first.x)
    keep = np.asarray(first.good, bool)
    template = template - template[keep].mean(axis=0) if keep.any() else template
    before = None
    for _ in range(max_rounds):
        moved = aligned(traces, template, keep)
        rows = moved.select(F.posexplode(F.arrays_zip(*POINTS)).alias("i", "p"), "distance").where("p.good").groupBy("i").agg(*[F.avg(F.col("p")[a]).alias(a) for a in AXES]).collect()
        total = moved.agg(F.sum("distance")).first()[0] or 0.0
        template, keep = np.zeros_like(template), np.zeros(len(template), bool)
        for r in rows:
            template[r.i], keep[r.i] = (r.z, r.y, r.x), True
        if before is not None and abs(before - total) <= tolerance:
            break
        before = total
    return aligned(traces, template, keep), [[*map(float, p)] if k else [None] * 3 for p, k in zip(template, keep, strict=True)]


def _moved(z, y, x, good, template: np.ndarray, keep: np.ndarray) -> tuple:
    """A trace moved onto a template by their common good points, and its distance to it; unchanged with fewer than three."""
    p, both = _array(z, y, x), np.asarray(good, bool) & keep
    q = kernels.rigid_onto(p, template, both) if both.sum() >= 3 else p
    return (*q.T.tolist(), float(np.sqrt(((q[both] - template[both]) ** 2).mean())) if both.any() else 1e6)


def aligned(traces: DataFrame, template: np.ndarray, keep: np.ndarray) -> DataFrame:
    """Traces moved onto a template by their common good points, with their distance to it; unchanged with fewer than three."""

    @F.pandas_udf("z array<double>, y array<double>, x array<double>, distance double")
    def move(z: pd.Series, y: pd.Series, x: pd.Series, good: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_moved(*p, template, keep) for p in zip(z, y, x, good, strict=True)], columns=["z", "y", "x", "distance"])

    others = [c for c in traces.columns if c not in (*AXES, "distance")]
    return traces.select(*others, move(*POINTS).alias("m")).select(*others, "m.*")


def pieces_of(traces: DataFrame, length: int, overlap: int) -> DataFrame:
    """trace_id, piece, and the arrays z, y, x and good of stretches of `length` points, each sharing `overlap` points with the next; what is
    left at the end of a trace is in none."""
    n, step = F.size("z"), length - overlap
    starts = F.when(n >= length, F.sequence(F.lit(0), F.expr(f"(size(z) - {length}) div {step}").cast("int"))).otherwise(F.array().cast("array<int>"))
    return traces.select("trace_id", *POINTS, F.explode(starts).alias("piece")).select("trace_id", "piece", *[F.slice(c, F.col("piece") * step + 1, length).alias(c) for c in POINTS])


def piecewise_procrustes(traces: DataFrame, *, length: int = 5, overlap: int = 3, tolerance: float = 0.01, max_rounds: int = 50) -> list[list[float | None]]:
    """The mean of traces whose parts move against each other (K16): pieces are aligned to their means, all pieces in one pass for a round, and
    the means are put together, each moved by the motion that brings its first `overlap` points onto the last ones before it, where
    both are averaged. A piece that has fewer than three points with its mean takes no part in it. Only means come to the driver, as many points as a trace has. Points that no trace has are null, as is all from
    a place on where fewer than three points overlap."""
    if not 3 <= overlap < length:
        raise ValueError("pieces must overlap by three points or more, and be longer")
    pieces = stage(pieces_of(traces, length, overlap), "pieces")
    good = F.size(F.filter("good", lambda g: g))
    enough = good > length - 1
    first = pieces.groupBy("piece").agg(F.min_by(F.struct(*POINTS), F.struct((~enough).alias("few"), F.when(enough, 0).otherwise(-good).alias("n"), "trace_id")).alias("p")).collect()
    templates = {r.piece: (_array(r.p.z, r.p.y, r.p.x), np.asarray(r.p.good, bool)) for r in first}
    before: dict[int, float] = {}
    for _ in range(max_rounds):
        sums = pieces.select("piece", *POINTS).mapInArrow(_onto(templates, length), "piece int, i int, n long, z double, y double, x double, total double")
        rows = sums.groupBy("piece", "i").agg(F.sum("n").alias("n"), *[(F.sum(a) / F.nullif(F.sum("n"), F.lit(0))).alias(a) for a in AXES], F.sum("total").alias("total")).collect()
        totals = {r.piece: r.total for r in rows if r.i == 0}
        means = {k: (np.zeros((length, 3)), np.zeros(length, bool)) for k in totals}
        for r in rows:
            if r.n:
                means[r.piece][0][r.i], means[r.piece][1][r.i] = (r.z, r.y, r.x), True
        settled = {k for k in totals if k in before and abs(before[k] - totals[k]) <= tolerance}
        templates = {k: m if k not in settled else templates[k] for k, m in means.items()}
        if len(settled) == len(totals):
            break
        before = totals
    unstage(pieces)
    return stitched([templates[k] for k in sorted(templates)], length, overlap)


def _onto(templates: dict[int, tuple[np.ndarray, np.ndarray]], length: int):
    """A task that moves pieces onto the templates of their kind, all of a batch at once, and gives for each kind and point the number of good points,
    their sums, and the summed distances of the pieces that had three points to go by."""
    kinds = np.array(sorted(templates))
    at, there = (np.stack([templates[k][i] for k in kinds]) if len(kinds) else np.zeros((0, length)) for i in (0, 1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total, seen = np.zeros((len(kinds), length), np.int64), np.zeros((len(kinds), length, 3)), np.zeros(len(kinds)), np.zeros(len(kinds), bool)
        for batch in batches:
            piece = batch.column("piece").to_numpy()
            points = np.stack([batch.column(a).flatten().to_numpy(zero_copy_only=False).reshape(-1, length) for a in AXES], 2)
            good = batch.column("good").flatten().fill_null(False).to_numpy(zero_copy_only=False).reshape(-1, length)
            of = np.minimum(np.searchsorted(kinds, piece), max(0, len(kinds) - 1))
            if not len(kinds) or not len(piece):
                continue
            both = good & there[of]
            used = (kinds[of] == piece) & (both.sum(1) >= 3)
            of, both, good, points = of[used], both[used], good[used], points[used]
            if not len(of):
                continue
            moved, to = kernels.rigid_onto_all(points, at[of], both), at[of]
            off = np.where(both[..., None], moved - to, 0.0)
            total += np.bincount(of, np.sqrt((off * off).sum((1, 2)) / (3 * both.sum(1))), len(kinds))
            seen[of] = True
            np.add.at(n, of, good)
            for k in range(length):
                for a in range(3):
                    sums[:, k, a] += np.bincount(of, np.where(good[:, k], moved[:, k, a], 0.0), len(kinds))
        k, i = (x.ravel() for x in np.meshgrid(np.flatnonzero(seen), np.arange(length), indexing="ij"))
        yield pa.RecordBatch.from_arrays([pa.array(kinds[k], pa.int32()), pa.array(i, pa.int32()), pa.array(n[k, i]), *(pa.array(sums[k, i, a]) for a in range(3)), pa.array(total[k])], names=["piece", "i", "n", *AXES, "total"])

    return task


def stitched(pieces: list[tuple[np.ndarray, np.ndarray]], length: int, overlap: int) -> list[list[float | None]]:
    """Points of pieces in a row, each moved onto the one before by what they share."""
    if not pieces:
        return []
    step, size = length - overlap, length + (len(pieces) - 1) * (length - overlap)
    at, there = np.zeros((size, 3)), np.zeros(size, bool)
    at[:length], there[:length] = pieces[0]
    for i, (points, good) in enumerate(pieces[1:], 1):
        a = i * step
        both = np.zeros(length, bool)
        both[:overlap] = good[:overlap] & there[a : a + overlap]
        if both.sum() < 3:
            break
        target = np.zeros((length, 3))
        target[:overlap] = at[a : a + overlap]
        moved = kernels.rigid_onto(points, target, both)
        for j in range(length):
            if good[j]:
                at[a + j] = (at[a + j] + moved[j]) / 2 if there[a + j] else moved[j]
                there[a + j] = True
    return [[*map(float, p)] if k else [None] * 3 for p, k in zip(at, there, strict=True)]


def map_vectors(maps: DataFrame) -> DataFrame:
    """trace_id and features: the distances of a trace's map in the order of its loci, for traces that have all pairs."""
    width = maps.select("locus_1", "locus_2").distinct().count()
    rows = maps.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("locus_1", "locus_2", "distance"))).alias("d"))
    return rows.where(F.size("d") == width).select("trace_id", F.col("d.distance").alias("features"))


def clusters(maps: DataFrame, k: int, method: str = "kmeans", seed: int = 1) -> DataFrame:
    """trace_id and cluster by the distance maps (K18): kmeans, bisecting (a hierarchy from above) or mixture (normal distributions)."""
    from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
    from pyspark.ml.functions import array_to_vector

    kinds = {"kmeans": KMeans, "bisecting": BisectingKMeans, "mixture": GaussianMixture}
    if method not in kinds:
        raise ValueError(f"method must be one of {sorted(kinds)}")
    vectors = map_vectors(maps).select("trace_id", array_to_vector("features").alias("features"))
    model = kinds[method]().setK(k).setSeed(seed).fit(vectors)
    return model.transform(vectors).select("trace_id", F.col("prediction").alias("cluster"))
