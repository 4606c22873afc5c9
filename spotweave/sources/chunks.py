"""Images in chunked arrays as a data source of Spark (IO16, IO17, K8, K10).

A store is a folder with an array of the Zarr layout, version 2, for each field of view: `P0001.zarr/.zarray` (or under `0/`) and a file for
each chunk, named by its place in the grid. Axes are t, c, z, y and x; arrays of fewer axes have the last ones.

    register(spark)
    spark.read.format("chunked_arrays").load(path).where("field = 'P0002' and t_chunk = 7")
    images.write.format("chunked_arrays").mode("append").option("chunks", "1,1,16,512,512").save(path)

Reading gives a row for each stored chunk, cut to the array's bounds. Filters on field and on the places in the grid choose the files
before any is opened, and a task reads about `bytesPerTask` of them. A chunk that is not stored is all fill value and has no row.

Writing takes rows (field, start, shape, voxels) that are whole chunks. A task writes to a folder of its own; the commit moves the files
of the tasks that count to their names, and the description of an array comes last, so that an array is not seen before
it is whole. Attempts that were lost leave nothing behind. `rechunked` turns pieces of any size into whole chunks.

Paths are those that Arrow's file systems open (file, s3, gs, hdfs), from every executor."""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage

from spotweave.runtime import arrow_rows

FORMAT = "chunked_arrays"
GRID = ("t", "c", "z", "y", "x")
CHUNKS = [f"{a}_chunk" for a in GRID]
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20  # of the chunks of a batch that is written
CUT_VOXELS = 512  # of a piece that is cut together with others
PIECE = "field string, start array<int>, shape array<int>, voxels array<double>"
SCHEMA = f"field string, {', '.join(f'{c} int' for c in CHUNKS)}, start array<int>, shape array<int>, voxels array<double>"
ARROW = pa.schema([("field", pa.string()), *[(c, pa.int32()) for c in CHUNKS], ("start", pa.list_(pa.int32())), ("shape", pa.list_(pa.int32())), ("voxels", pa.list_(pa.float64()))])


def place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.rstrip("/"))
    return fs.LocalFileSystem(), path.rstrip("/")


def contents(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.readall()


@dataclass(frozen=True)
class Layout:
    """How an array lies in its files; shape and chunks have all five axes."""

    folder: str
    shape: tuple[int, ...]
    chunks: tuple[int, ...]
    kind: str
    order: str
    mark: str
    compressor: str | None
    fill: float
    axes: int

    @staticmethod
    def parsed(folder: str, content: bytes) -> Layout:
        found = json.loads(content)
        if found.get("zarr_format") != 2 or found.get("filters"):
            raise ValueError(f"no plain version 2 array: {folder}")
        n = len(found["shape"])
        if n > len(GRID):
            raise ValueError(f"more than {len(GRID)} axes: {folder}")
        wide = lambda x: (1,) * (len(GRID) - n) + tuple(x)
        compressor = (found.get("compressor") or {}).get("id")
        return Layout(folder, wide(found["shape"]), wide(found["chunks"]), found["dtype"], found.get("order", "C"), found.get("dimension_separator", "."), compressor, float(found.get("fill_value") or 0), n)

    def described(self) -> bytes:
        n = len(GRID) - self.axes
        return json.dumps({"zarr_format": 2, "shape": self.shape[n:], "chunks": self.chunks[n:], "dtype": self.kind, "order": self.order, "fill_value": self.fill, "filters": None, "dimension_separator": self.mark, "compressor": {"id": self.compressor, "level": 1} if self.compressor else None}).encode()

    def name(self, at: Iterable[int]) -> str:
        return self.mark.join(str(k) for k in list(at)[len(GRID) - self.axes :])

    def grid(self) -> list[int]:
        return [-(-s // c) for s, c in zip(self.shape, self.chunks, strict=True)]

    def decoded(self, content: bytes) -> np.ndarray:
        if self.compressor in ("zlib", "gzip"):
            content = zlib.decompress(content, 47)
        elif self.compressor == "zstd":
            import zstandard

            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        elif self.compressor:
            raise ValueError(f"chunks compressed by {self.compressor} cannot be read")
        return np.frombuffer(content, np.dtype(self.kind)).reshape(self.chunks, order=self.order)

    def encoded(self, x: np.ndarray) -> bytes:
        full = np.pad(x, [(0, c - n) for c, n in zip(self.chunks, x.shape, strict=True)], constant_values=self.fill)
        raw = full.astype(np.dtype(self.kind)).tobytes(order=self.order)
        return zlib.compress(raw, 1) if self.compressor else raw

    def chunk(self, system: fs.FileSystem, at: tuple[int, ...]) -> np.ndarray | None:
        """The voxels of a chunk within the array's bounds; None where it is not stored."""
        path = f"{self.folder}/{self.name(at)}"
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return None
        inside = tuple(slice(0, min(c, s - k * c)) for k, c, s in zip(at, self.chunks, self.shape, strict=True))
        return self.decoded(contents(system, path))[inside]


def layouts(path: str, wanted=lambda field: True) -> dict[str, Layout]:
    """The arrays of a store by field of view; folders without a description are no arrays, or not yet."""
    system, base = place(path)
    found = {}
    for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        name = info.base_name
        field = name.removesuffix(".zarr")
        if info.type != fs.FileType.Directory or not name.endswith(".zarr") or not wanted(field):
            continue
        for folder in (info.path, f"{info.path}/0"):
            if system.get_file_info(f"{folder}/.zarray").type == fs.FileType.File:
                found[field] = Layout.parsed(folder, contents(system, f"{folder}/.zarray"))
                break
    return found


@dataclass
class Some(InputPartition):
    field: str
    layout: Layout
    places: list[tuple[int, ...]]


class ChunkReader(DataSourceReader):
    TESTS = {EqualTo: lambda v, w: v == w, In: lambda v, w: v in w, GreaterThan: lambda v, w: v > w, GreaterThanOrEqual: lambda v, w: v >= w, LessThan: lambda v, w: v < w, LessThanOrEqual: lambda v, w: v <= w}

    def __init__(self, options: dict[str, str]):
        self.path, self.bytes_per_task = options["path"], int(options.get("bytespertask", 32 << 20))
        self.asked: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in ("field", *CHUNKS) and type(f) in self.TESTS:
                self.asked.append((column, type(f), f.value))
            elif not (column in ("field", *CHUNKS) and isinstance(f, IsNotNull)):
                yield f

    def keeps(self, column: str, value) -> bool:
        return all(self.TESTS[kind](value, given) for c, kind, given in self.asked if c == column)

    def partitions(self):
        system, _ = place(self.path)
        out = []
        for field, layout in sorted(layouts(self.path, lambda f: self.keeps("field", f)).items()):
            axes = [[k for k in range(n) if self.keeps(c, k)] for n, c in zip(layout.grid(), CHUNKS, strict=True)]
            if math.prod(map(len, axes)) * 16 <= math.prod(layout.grid()):  # few: ask for them by name
                names = {layout.name(at): at for at in product(*axes)}
                stored = [i.path for i in system.get_file_info([f"{layout.folder}/{n}" for n in names]) if i.type == fs.FileType.File]
            else:
                names = {layout.name(at): at for at in product(*axes)}
                stored = [i.path for i in system.get_file_info(fs.FileSelector(layout.folder, recursive=layout.mark == "/")) if i.type == fs.FileType.File]
            found = sorted(names[n] for p in stored if (n := p[len(layout.folder) + 1 :]) in names)
            size = max(1, self.bytes_per_task // max(1, math.prod(layout.chunks) * np.dtype(layout.kind).itemsize))
            out += [Some(field, layout, found[i : i + size]) for i in range(0, len(found), size)]
        return out or [Some("", None, [])]

    def read(self, part: Some) -> Iterator[pa.RecordBatch]:
        system, _ = place(self.path)
        for at in part.places:
            x = part.layout.chunk(system, at)
            if x is not None:
                start = [k * c for k, c in zip(at, part.layout.chunks, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([part.field]), *[pa.array([k], pa.int32()) for k in at], pa.array([start], ARROW.field("start").type), pa.array([list(x.shape)], ARROW.field("shape").type), pa.ListArray.from_arrays([0, x.size], pa.array(x.astype(float).ravel()))], schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    ends: dict[str, list[int]]


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        chunks = tuple(int(c) for c in options["chunks"].split(","))
        if len(chunks) > len(GRID) or min(chunks) < 1:
            raise ValueError(f"no chunks: {options['chunks']}")
        self.chunks, self.axes = (1,) * (len(GRID) - len(chunks)) + chunks, len(chunks)
        self.kind, self.compressor = np.dtype(options.get("dtype", "<f8")).str, None if options.get("compressor", "zlib") == "none" else "zlib"
        self.job = f"_writing-{uuid.uuid4().hex}"

    def layout(self, folder: str, shape: Iterable[int]) -> Layout:
        return Layout(folder, tuple(shape), self.chunks, self.kind, "C", ".", self.compressor, 0.0, self.axes)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = place(self.path)
        folder = f"{base}/{self.job}/{uuid.uuid4().hex}"
        ends: dict[str, list[int]] = {}
        seen = set()
        for batch in iterator:
            starts, shapes, voxels = (batch.column(c) for c in ("start", "shape", "voxels"))
            for i, field in enumerate(batch.column("field").to_pylist()):
                start, shape = starts[i].as_py(), shapes[i].as_py()
                lead = [0] * (len(GRID) - len(start))
                start, shape = [*lead, *start], [*(1 for _ in lead), *shape]
                if any(a % c or n > c or n < 1 for a, n, c in zip(start, shape, self.chunks, strict=True)):
                    raise ValueError(f"no whole chunk: {field} at {start}, {shape}")
                at = tuple(a // c for a, c in zip(start, self.chunks, strict=True))
                if (field, at) in seen:
                    raise ValueError(f"two pieces for chunk {at} of {field}")
                seen.add((field, at))
                where = self.layout(f"{folder}/{field}.zarr", shape)
                system.create_dir(where.folder, recursive=True)
                with system.open_output_stream(f"{where.folder}/{where.name(at)}") as out:
                    out.write(where.encoded(voxels[i].values.to_numpy(zero_copy_only=False).reshape(shape)))
                ends[field] = [max(e, a + n) for e, a, n in zip(ends.get(field, start), start, shape, strict=True)]
        return Written(folder, ends)

    def commit(self, messages: list[Written | None]) -> None:
        system, base = place(self.path)
        done = [m for m in messages if m is not None and m.ends]
        before = layouts(self.path)
        if self.overwrite:
            for old in before.values():
                system.delete_dir(old.folder)
            before = {}
        files = [f for m in done for f in system.get_file_info(fs.FileSelector(m.folder, recursive=True)) if f.type == fs.FileType.File]
        moves = [(f.path, f"{base}/{f.path.split('/')[-2]}/{f.base_name}") for f in files]
        taken = {t for _, t in moves}
        if len(taken) < len(moves):
            self.abort(messages)
            raise ValueError("two pieces for one chunk")
        ends = {}
        for m in done:
            for field, end in m.ends.items():
                ends[field] = [max(a, b) for a, b in zip(ends.get(field, end), end, strict=True)]
        for field, end in ends.items():
            system.create_dir(f"{base}/{field}.zarr", recursive=True)
            if field in before:
                old = before[field]
                if (old.chunks, old.kind, old.compressor) != (self.chunks, self.kind, self.compressor):
                    raise ValueError(f"another layout than that of {field}")
                ends[field] = [max(a, b) for a, b in zip(old.shape, end, strict=True)]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda x: system.move(*x), moves))
        for field, end in ends.items():
            with system.open_output_stream(f"{base}/{field}.zarr/.zarray") as out:
                out.write(self.layout("", end).described())
        self.abort(messages)

    def abort(self, messages) -> None:
        system, base = place(self.path)
        if system.get_file_info(f"{base}/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/{self.job}")


class ChunkedArrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def given(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(self.given())

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.given(), overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkedArrays)


def read_chunks(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)


def write_chunks(pieces: DataFrame, path: str, chunks: tuple[int, ...], *, overwrite: bool = False, dtype: str = "<f8", compressor: str = "zlib") -> None:
    """Store pieces (field, start, shape, voxels) that are whole chunks. Batches are bounded by bytes of chunks, too, as what makes and writes the pieces holds a batch
    of them as objects of Python."""
    rows = max(1, min(BATCH_ROWS, BATCH_BYTES // (8 * math.prod(chunks))))
    register(pieces.sparkSession)
    out = pieces.select(*[c.split()[0] for c in PIECE.split(", ")]).write.format(FORMAT).mode("overwrite" if overwrite else "append")
    out = out.option("chunks", ",".join(map(str, chunks))).option("dtype", dtype).option("compressor", compressor)
    with arrow_rows(pieces.sparkSession, rows):
        out.save(path)


def cells(boxes: DataFrame, chunks: tuple[int, ...], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Boxes (lo and hi: arrays by axis, of at least one voxel) with a row for each chunk of the grid that they meet: `chunk`."""
    out = boxes
    for i, c in enumerate(chunks):
        first, last = F.expr(f"{lo}[{i}] div {c}").cast("int"), F.expr(f"({hi}[{i}] - 1) div {c}").cast("int")
        out = out.withColumn(f"at_{i}", F.explode(F.sequence(first, last)))
    return out.withColumn("chunk", F.array(*[F.col(f"at_{i}") for i in range(len(chunks))])).drop(*[f"at_{i}" for i in range(len(chunks))])


def joined_pieces(lo, hi, parts) -> np.ndarray:
    """The voxels of a box from its parts (start and shape in the array's own coordinates)."""
    origin = np.asarray(lo)
    out = np.zeros(np.asarray(hi) - origin)
    for p in parts:
        a = np.asarray(p["start"]) - origin
        n = np.asarray(p["shape"])
        out[tuple(slice(s, s + k) for s, k in zip(a, n, strict=True))] = np.asarray(p["voxels"]).reshape(n)
    return out


def cut_pieces(start: pa.Array, shape: pa.Array, voxels: pa.Array, lo: pa.Array, hi: pa.Array, axes: int) -> pa.Array:
    """The voxels from lo to hi of each piece of so many axes. Pieces that are cut alike are cut as one array, large ones each by itself."""
    start, shape, lo, hi = (c.flatten().to_numpy(zero_copy_only=False).reshape(-1, axes) for c in (start, shape, lo, hi))
    lengths = voxels.value_lengths().to_numpy(zero_copy_only=False)
    if not np.array_equal(lengths, shape.prod(axis=1, dtype=np.int64)):
        raise ValueError("a piece whose voxels are not as many as its shape has")
    values, begin = voxels.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths
    bounds = np.append(0, np.cumsum((hi - lo).prod(axis=1, dtype=np.int64)))
    out = np.empty(bounds[-1])
    kinds, of = np.unique(np.concatenate([shape, lo - start, hi - start], axis=1), axis=0, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    ends = np.searchsorted(of.ravel()[order], np.arange(len(kinds) + 1))
    for k, kind in enumerate(kinds):
        rows, (whole, first, last) = order[ends[k] : ends[k + 1]], np.split(kind, 3)
        inside = tuple(slice(a, b) for a, b in zip(first, last, strict=True))
        if math.prod(whole.tolist()) > CUT_VOXELS:
            for i in rows:
                out[bounds[i] : bounds[i + 1]] = values[begin[i] : begin[i] + lengths[i]].reshape(whole)[inside].ravel()
        else:
            at = np.arange(math.prod(whole.tolist())).reshape(whole)[inside].ravel()
            out[bounds[rows][:, None] + np.arange(len(at))] = values[begin[rows][:, None] + at]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(out))


def assembled(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, lo, hi and voxels of boxes from their parts (start, shape, voxels); what no part holds is 0. A part that is the whole box is taken as it is."""

    @F.pandas_udf("array<double>")
    def whole(lo: pd.Series, hi: pd.Series, ps: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else joined_pieces(a, b, p).ravel() for a, b, p in zip(lo, hi, ps, strict=True)], dtype=object)

    row = parts.groupBy(*keys, "lo", "hi").agg(F.collect_list(F.struct("start", "shape", "voxels")).alias("parts_"))
    only = F.get("parts_", F.lit(0))
    alone = (F.size("parts_") == 1) & (only["start"] == F.col("lo")) & (only["shape"] == F.zip_with("hi", "lo", lambda b, a: b - a))
    row = row.select(*keys, "lo", "hi", F.when(alone, only["voxels"]).alias("alone_"), F.when(~alone, F.col("parts_")).alias("parts_"))
    return row.select(*keys, "lo", "hi", F.coalesce("alone_", whole("lo", "hi", "parts_")).alias("voxels"))


def rechunked(pieces: DataFrame, chunks: tuple[int, ...], shape: tuple[int, ...], halo: tuple[int, ...] | None = None) -> DataFrame:
    """Pieces of any size (field, start, shape, voxels) of arrays of the given shape as whole chunks: each is cut where chunks
    meet, and the cuts of a chunk are put together. Pieces must not overlap; what none holds is 0. With a halo, chunks reach so many
    voxels into their neighbours, as far as the array goes, and `core` is where they start without it: only borders travel twice."""

    @F.arrow_udf("array<double>")
    def cut(start: pa.Array, size: pa.Array, voxels: pa.Array, lo: pa.Array, hi: pa.Array) -> pa.Array:
        return cut_pieces(start, size, voxels, lo, hi, len(chunks))

    axes, more = range(len(chunks)), halo or (0,) * len(chunks)
    each = lambda f: F.array(*[f(i) for i in axes]).cast("array<int>")
    reach = pieces.withColumn("from_", each(lambda i: F.greatest(F.col("start")[i] - more[i], F.lit(0)))).withColumn("to_", each(lambda i: F.least(F.col("start")[i] + F.col("shape")[i] + more[i], F.lit(shape[i]))))
    met = cells(reach, chunks, "from_", "to_")
    met = met.withColumn("lo", each(lambda i: F.greatest(F.col("chunk")[i] * chunks[i] - more[i], F.lit(0)))).withColumn("hi", each(lambda i: F.least((F.col("chunk")[i] + 1) * chunks[i] + more[i], F.lit(shape[i]))))
    met = met.withColumn("lo_", each(lambda i: F.greatest(F.col("start")[i], F.col("lo")[i]))).withColumn("hi_", each(lambda i: F.least(F.col("start")[i] + F.col("shape")[i], F.col("hi")[i])))
    parts = met.select("field", each(lambda i: F.col("chunk")[i] * chunks[i]).alias("core"), "lo", "hi", F.col("lo_").alias("start"), F.zip_with("hi_", "lo_", lambda b, a: b - a).alias("shape"), cut("start", "shape", "voxels", "lo_", "hi_").alias("voxels"))
    whole = assembled(parts, ["field", "core"])
    return whole.select("field", F.col("lo").alias("start"), F.zip_with("hi", "lo", lambda b, a: b - a).alias("shape"), "voxels", *(["core"] if halo else []))


def cut_boxes(boxes: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """keys, field, lo, hi and voxels for boxes (keys, field, lo, hi: arrays by t, c, z, y, x, inside the array and not empty) of a
    store. Boxes travel to the chunks that they meet, and only what they cut out of these travels on: no image is shuffled. A chunk
    with very many boxes is dealt over several tasks, and each opens it once."""
    known = layouts(path)
    grids = {x.chunks for x in known.values()}
    if len(grids) != 1:
        raise ValueError(f"arrays of one chunk size are wanted, found {sorted(grids)}")
    chunks = grids.pop()
    routed = cells(boxes.select(*keys, "field", "lo", "hi"), chunks).hint("rebalance", "field", "chunk").sortWithinPartitions("field", "chunk")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in routed.drop("chunk").schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = place(path)
        key = image = None
        for batch in batches:
            starts, shapes, voxels = [], [], []
            for field, at, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("field", "chunk", "lo", "hi")), strict=True):
                if (field, at) != key:
                    key, image = (field, at), known[field].chunk(system, tuple(at))
                origin = [k * c for k, c in zip(at, chunks, strict=True)]
                a, b = [max(p, o) for p, o in zip(lo, origin, strict=True)], [min(q, o + c) for q, o, c in zip(hi, origin, chunks, strict=True)]
                size = [q - p for p, q in zip(a, b, strict=True)]
                piece = np.full(size, known[field].fill) if image is None else image[tuple(slice(p - o, q - o) for p, q, o in zip(a, b, origin, strict=True))]
                if list(piece.shape) != size:
                    raise ValueError(f"a box beyond the array of {field}: {lo}, {hi}")
                starts.append(a)
                shapes.append(size)
                voxels.append(piece.astype(float).ravel())
            kept = [batch.column(c) for c in batch.schema.names if c != "chunk"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(starts, pa.list_(pa.int32())), pa.array(shapes, pa.list_(pa.int32())), pa.array(voxels, pa.list_(pa.float64()))], names=[*[c for c in batch.schema.names if c != "chunk"], "start", "shape", "voxels"])

    parts = routed.mapInArrow(task, f"{kinds}, start array<int>, shape array<int>, voxels array<double>")
    return assembled(parts, [*keys, "field"])


def cropped_chunks(boxes: DataFrame, path: str, keys: list[str], *, background: int | None = None) -> DataFrame:
    """keys, voxels, shape and the reason where there are none, for boxes (keys, field, timepoint, channel, bounds {a}_lo, {a}_hi and
    pads {a}_pad_lo, {a}_pad_hi) of the images of a store (K8, K10), as `detection.cropped` has them for images in rows."""
    spark, axes = boxes.sparkSession, ("z", "y", "x")
    sizes = F.broadcast(spark.createDataFrame([(f, list(x.shape[2:])) for f, x in layouts(path).items()], "field string, size array<int>"))  # a row for each field of view
    lo, hi = ({a: F.floor(f"{a}_{k}").cast("int") for a in axes} for k in ("lo", "hi"))
    before, after = {a: F.ceil(f"{a}_pad_lo").cast("int") for a in axes}, {a: F.floor(f"{a}_pad_hi").cast("int") for a in axes}
    some = lambda test, which=axes: reduce(lambda p, q: p | q, [test(i, a) for i, a in enumerate(axes) if a in which])
    padded = some(lambda i, a: (before[a] != 0) | (after[a] != 0), ("y", "x"))
    reason = F.when(some(lambda i, a: hi[a] > F.col("size")[i]), "out of bounds").when(some(lambda i, a: lo[a] == hi[a]), "empty").when(padded & ~F.col("timepoint").eqNullSafe(F.lit(background)), "padded in y or x")
    three = lambda d: F.array(*[d[a] for a in axes])
    placed = boxes.join(sizes, "field").select(*keys, *[c for c in ("field",) if c not in keys], F.col("timepoint").alias("t_"), F.col("channel").alias("c_"), three(lo).alias("from_"), three(hi).alias("to_"), three(before).alias("before_"), three(after).alias("after_"), reason.alias("reason"))
    five = lambda t, c, rest: F.concat(F.array(t.cast("int"), c.cast("int")), F.col(rest))
    t, c = F.col("t_"), F.col("c_")
    cut = cut_boxes(placed.where("reason is null").select(*keys, *[c for c in ("field",) if c not in keys], five(t, c, "from_").alias("lo"), five(t + 1, c + 1, "to_").alias("hi")), path, keys)

    @F.pandas_udf("voxels array<double>, shape array<int>")
    def whole(voxels: pd.Series, lo: pd.Series, hi: pd.Series, before: pd.Series, after: pd.Series) -> pd.DataFrame:
        out = []
        for v, a, b, p, q in zip(voxels, lo, hi, before, after, strict=True):
            size = np.maximum(np.asarray(b) - np.asarray(a), 0)
            box = np.zeros(size) if v is None else np.asarray(v).reshape(size)
            x = np.pad(box, list(zip(np.maximum(p, 0), np.maximum(q, 0), strict=True)), mode="edge" if v is not None and box.size else "constant")
            out.append((x.ravel(), list(x.shape)))
        return pd.DataFrame(out, columns=["voxels", "shape"])

    both = placed.join(cut.select(*keys, "voxels"), keys, "left")
    return both.select(*keys, "reason", whole("voxels", "from_", "to_", "before_", "after_").alias("w")).select(*keys, "w.*", "reason")
