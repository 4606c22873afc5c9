"""Tables in delimited files and JSON (IO1 to IO7, IO9, IO12, IO13)."""

from __future__ import annotations

import posixpath
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spotweave.operators.ranks import numbered_rows

SEPARATORS = {"csv": ",", "tsv": "\t"}


def separator(path: str) -> str:
    """The delimiter that the ending of a path stands for; .gz and a trailing slash do not matter (IO4)."""
    ending = re.sub(r"(\.gz)?/?$", "", path).rsplit(".", 1)[-1].lower()
    if ending not in SEPARATORS:
        raise ValueError(f"no delimiter is known for {path}")
    return SEPARATORS[ending]


def read_strings(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """All columns as strings, "" where a cell is empty; a leading unnamed index column is dropped (IO3, P12)."""
    df = spark.read.option("header", True).option("sep", sep or separator(path)).option("nullValue", "\0").option("emptyValue", "").csv(path)
    df = df.drop(*[c for c in df.columns[:1] if c in ("", "_c0", "Unnamed: 0")])
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_typed(spark: SparkSession, path: str, schema: str | StructType, sep: str | None = None, strict: bool = True) -> DataFrame:
    """Columns of schema from a headed file, found by name; other columns stay out. A cell that is empty is null. With strict, a cell
    that does not fit its type fails the query when its row is read, and a missing column fails at once (IO1, IO7)."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    raw = read_strings(spark, path, sep)
    if missing := [f.name for f in wanted if f.name not in raw.columns]:
        if not raw.columns:  # a file with no header at all is an empty table
            return spark.createDataFrame([], wanted)
        raise ValueError(f"columns missing in {path}: {missing}")

    def typed(name: str, kind: str):
        cell = F.col(f"`{name}`")
        if kind == "string":
            return F.when(cell != "", cell)
        value = F.trim(cell).try_cast(kind)
        bad = F.raise_error(F.concat(F.lit(f"column {name} is no {kind}: "), cell)).cast(kind)
        return F.when(F.trim(cell) == "", None).otherwise(F.when(value.isNull(), bad).otherwise(value) if strict else value)

    return raw.select(*[typed(f.name, f.dataType.simpleString()).alias(f.name) for f in wanted])


def same_place(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two paths are one, with or without the scheme of the default file system, dots and trailing slashes."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    full = []
    for p in (a, b):
        system = path(p).getFileSystem(conf)
        whole = system.makeQualified(path(p)).toUri()
        full.append((str(whole.getScheme()), str(whole.getAuthority()), posixpath.normpath(str(whole.getPath()))))
    return full[0] == full[1]


def write_table(df: DataFrame, path: str, *, source: str | None = None, overwrite: bool = False, by: str | None = None) -> None:
    """Headed delimited files, refused where they would replace their own source (IO2, IO5, IO6), a folder for each value of `by` (IO9)."""
    if source is not None and same_place(df.sparkSession, source, path):
        raise ValueError(f"the output would replace the input: {path}")
    out = df.write.mode("overwrite" if overwrite else "error").option("header", True).option("sep", separator(path) if "." in path.rsplit("/", 1)[-1] else ",")
    (out.partitionBy(by) if by else out).csv(path)


def write_named(df: DataFrame, folder: str, name: str, order: list[str | Column] = (), *, overwrite: bool = False, kind: str = "csv") -> None:
    """Files under the names that other programs read: the rows of each value of the column `name` go, without it, to that file of the folder (IO9),
    headed and delimited, or for kind text the lines of the one column there is. Written in a folder beside, then moved, so that no file is
    there before all are. A file's rows go through one task, sorted but not gathered; only names reach the driver."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    held = f"{folder.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    dealt = df.withColumnRenamed(name, "name_").repartition("name_").sortWithinPartitions("name_", *order)
    if kind == "text":
        dealt.select("name_", "value").write.partitionBy("name_").text(held)
    else:
        dealt.write.partitionBy("name_").option("header", True).csv(held)
    system = path(held).getFileSystem(conf)
    moves = []
    for place in system.listStatus(path(held)):
        if not place.isDirectory() or not place.getPath().getName().startswith("name_="):
            continue
        target = f"{folder.rstrip('/')}/{unquote(place.getPath().getName().removeprefix('name_='))}"
        parts = [f.getPath() for f in system.listStatus(place.getPath()) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"several files for {target}")
        moves.append((parts[0], path(target)))
    if not overwrite and (there := [str(t) for _, t in moves if system.exists(t)]):
        system.delete(path(held), True)
        raise ValueError(f"files exist: {there[:5]}")

    def move(pair) -> None:
        system.mkdirs(pair[1].getParent())
        system.delete(pair[1], False)
        if not system.rename(*pair):
            raise ValueError(f"could not write {pair[1]}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, moves))
    system.delete(path(held), True)


def write_json_array(df: DataFrame, path: str, order: str, *, overwrite: bool = False) -> None:
    """One file with a JSON array of the rows, without the column that gives their order (IO12). Rows are numbered over range partitions; the lines of the file
    go through one task, as a stream."""
    rows = numbered_rows(df, [order], "number_")
    last = rows.agg(F.max("number_")).first()[0]
    columns = F.struct(*[c for c in df.columns if c != order])
    lines = rows.select("number_", F.concat(F.when(F.col("number_") == 0, "[").otherwise(","), F.to_json(columns), F.when(F.col("number_") == last, "]").otherwise("")).alias("value"))
    if last is None:
        lines = df.sparkSession.createDataFrame([(0, "[]")], "number_ long, value string")
    folder, _, name = path.rpartition("/")
    write_named(lines.withColumn("file_", F.lit(name)), folder, "file_", ["number_"], overwrite=overwrite, kind="text")


def write_json_arrays(df: DataFrame, keys: list[str], item: str, path: str, overwrite: bool = False) -> None:
    """One file line with a JSON array of `item` for each value of keys (IO12); a key's rows must fit a task, as those of an
    imaging context do."""
    arrays = df.groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
    arrays.select("value").write.mode("overwrite" if overwrite else "error").text(path)


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """item for each entry of JSON arrays, one array to a line; a line that is none is an error (IO13)."""
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("items"), "value")
    items = F.when(F.col("items").isNull(), F.raise_error(F.concat(F.lit("no JSON array: "), "value"))).otherwise(F.col("items"))
    return parsed.select(F.explode(items).alias("item"))


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object for a row (IO12)."""
    df.write.mode("overwrite" if overwrite else "error").json(path)


def read_bead_points(spark: SparkSession, path: str) -> DataFrame:
    """index and centroid coordinates from JSON arrays of bead regions (IO13)."""
    schema = "index int, centroid struct<zc: double, yc: double, xc: double>"
    return spark.read.schema(schema).json(path, multiLine=True).select("index", "centroid.zc", "centroid.yc", "centroid.xc", F.input_file_name().alias("file"))
