"""Arrays in files: NPZ archives, chunked arrays of the Zarr layout (version 2), folders of images (IO15 to IO17, IO19, IO20, IO22, IO26).

Contents are read by Spark's binary source, so any store that Spark reads will do, and decoded in the tasks."""

from __future__ import annotations

import io
import json
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators.checks import require_unique
from spotweave.operators.voxels import place_and_time
from spotweave.sources.folders import listed

ARRAY = "name string, shape array<int>, dtype string, voxels array<double>"


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """(path, position, name, shape, dtype, voxels) of every array of NPZ archives, in the order of the archive (IO19)."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                with np.load(io.BytesIO(content)) as found:
                    for i, name in enumerate(found.files):
                        x = found[name]
                        yield pd.DataFrame([(where, i, name, list(x.shape), str(x.dtype), x.astype(float).ravel().tolist())], columns=["path", "position", "name", "shape", "dtype", "voxels"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")
    return raw.mapInPandas(unpack, f"path string, position int, {ARRAY}")


def chosen(arrays: DataFrame, which: str | int | slice | list) -> DataFrame:
    """Arrays by name, by position, by a slice of positions, or by a list of either (IO19). An unknown one gives no row."""
    if isinstance(which, slice):
        at = F.col("position")
        n = arrays.agg(F.max("position")).first()[0]
        return arrays.where(at.isin(list(range(*which.indices((n if n is not None else -1) + 1)))))
    wanted = which if isinstance(which, list) else [which]
    names, places = [w for w in wanted if isinstance(w, str)], [w for w in wanted if isinstance(w, int)]
    return arrays.where(F.col("name").isin(names) | F.col("position").isin(places))


def zipped(arrays: dict[str, np.ndarray]) -> bytes:
    """An NPZ archive of arrays whose names lose a file ending; two for one name are an error (IO20)."""
    out, seen = io.BytesIO(), set()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, x in arrays.items():
            stem = name.rsplit("/", 1)[-1].removesuffix(".npy")
            if stem in seen:
                raise ValueError(f"two arrays are named {stem}")
            seen.add(stem)
            held = io.BytesIO()
            np.save(held, x)
            archive.writestr(f"{stem}.npy", held.getvalue())
    return out.getvalue()


def _decoder(kind: str | None):
    if kind is None:
        return bytes
    if kind in ("zlib", "gzip"):
        return lambda b: zlib.decompress(b, 47)
    if kind == "zstd":
        import zstandard

        return lambda b: zstandard.ZstdDecompressor().decompressobj().decompress(b)
    raise ValueError(f"chunks compressed by {kind} cannot be read")


def zarr_layout(spark: SparkSession, path: str) -> dict:
    """Shape, chunks, type, order, fill value and compressor of an array."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/.zarray")  # Spark's own readers pass over names that start with a dot
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        found = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if found.get("zarr_format") != 2 or found.get("filters"):
        raise ValueError(f"no plain version 2 array: {path}")
    return found


def read_zarr(spark: SparkSession, path: str) -> DataFrame:
    """(start, shape, voxels) of every stored chunk of an array, cut to the array's bounds (IO16); a chunk that is not stored is all
    fill value and has no row."""
    layout = zarr_layout(spark, path)
    size, step, kind, order = layout["shape"], layout["chunks"], np.dtype(layout["dtype"]), layout.get("order", "C")
    mark, compressor = layout.get("dimension_separator", "."), (layout.get("compressor") or {}).get("id")
    depth = len(size) if mark == "/" else 1

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = _decoder(compressor)
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                key = "/".join(where.rstrip("/").split("/")[-depth:])
                at = [int(k) * n for k, n in zip(key.split(mark), step, strict=True)]
                x = np.frombuffer(decode(content), kind).reshape(step, order=order)
                x = x[tuple(slice(0, max(0, min(n, s - a))) for n, s, a in zip(step, size, at, strict=True))]
                yield pd.DataFrame([(at, list(x.shape), x.astype(float).ravel().tolist())], columns=["start", "shape", "voxels"])

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    name = F.element_at(F.split("path", "/"), -1)
    return raw.where(~name.startswith(".") & name.rlike(r"^[0-9.]+$")).mapInPandas(unpack, "start array<int>, shape array<int>, voxels array<double>")


def zarr_files(x: np.ndarray, chunks: tuple[int, ...], compressor: str | None = "zlib") -> Iterator[tuple[str, bytes]]:
    """(name, content) of the files of an array in the same layout (IO17); the caller stores them where it wants."""
    kind = x.dtype.newbyteorder("<") if x.dtype.itemsize > 1 else x.dtype
    yield ".zarray", json.dumps({"zarr_format": 2, "shape": list(x.shape), "chunks": list(chunks), "dtype": kind.str, "order": "C", "fill_value": 0, "filters": None, "compressor": {"id": "zlib", "level": 1} if compressor else None}).encode()
    for key in np.ndindex(*(-(-n // c) for n, c in zip(x.shape, chunks, strict=True))):
        piece = x[tuple(slice(k * c, (k + 1) * c) for k, c in zip(key, chunks, strict=True))]
        full = np.pad(piece, [(0, c - n) for c, n in zip(chunks, piece.shape, strict=True)]).astype(kind).tobytes()
        yield ".".join(map(str, key)), zlib.compress(full, 1) if compressor else full


def image_folder(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, position, time) of the image files of a folder (IO15's keys). All bad names are reported together, and two files
    for one place and time are an error; pixels are left to a decoder for the files' format."""
    files = listed(spark, folder, glob)
    keyed = files.select("path", "name", *[c.alias(k) for k, c in place_and_time(F.col("name")).items()])
    bad = [r.name for r in keyed.where("position is null or time is null").select("name").orderBy("name").limit(20).collect()]
    if bad:
        raise ValueError(f"names without one position and one time: {bad}")
    return require_unique(keyed.drop("name"), ["position", "time"], "images of one place and time")


def by_field(spark: SparkSession, folder: str, pattern: str = r"(P\d{4})") -> DataFrame:
    """(fov, paths): the files of each field of view that their name gives (IO22, IO26); files without one are left out."""
    files = listed(spark, folder, recursive=True).withColumn("fov", F.regexp_extract("name", pattern, 1)).where("fov <> ''")
    return files.groupBy("fov").agg(F.array_sort(F.collect_list("path")).alias("paths"))
