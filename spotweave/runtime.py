"""Session, staging and size-check helpers shared by every operator."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: list[tuple[SparkSession, str]] = []


def session(app: str = "spotweave", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, benches and examples; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Where it is unset, a temporary one in local mode, as in
    tests; on a cluster that is an error, as no folder of one machine is shared."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.conf.get("spotweave.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spotweave-')}"
        spark.conf.set("spotweave.shared.dir", found)
    return found


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, nothing is computed twice,
    and a lost executor costs no more than reading again. What was shuffled to write it is deleted as soon as it is written; it
    is removed itself when the application ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete tables of stage() that nothing reads any more, before the application ends."""
    for df in tables:
        place = (df.sparkSession, df.staged_path)
        if place in _STAGED:
            _STAGED.remove(place)
            delete(*place)


def scratch(spark: SparkSession, name: str, ending: str = "") -> str:
    """A path of its own in the shared folder for what is to be removed when the application ends."""
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}{ending}"
    _STAGED.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def staged() -> int:
    """How many tables stage() has written that are still there."""
    return len(_STAGED)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete what stage() has written, but for the first `keep` tables; results that are still to be read must not depend on it."""
    while len(_STAGED) > keep:
        _, path = _STAGED.pop()
        delete(spark, path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have the driver collect what nothing refers to any more, so that Spark's cleaner deletes the shuffle files of tables that
    are staged by now, and not only at its next periodic collection."""
    spark.sparkContext._jvm.System.gc()


@atexit.register
def _release_at_exit() -> None:
    active = SparkSession.getActiveSession()
    if active is not None and active.sparkContext._jsc is not None:
        try:
            release(active)
        except Exception:  # noqa: BLE001 - the gateway may be gone already; the folder belongs to the application
            _STAGED.clear()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session's setting for what is executed inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def arrow_rows(spark: SparkSession, n: int) -> AbstractContextManager[None]:
    """Batches of n rows for what is executed inside: for rows that are large, as a batch is bounded by rows alone."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def limit_batches(spark: SparkSession, n: int = 2000) -> None:
    """Arrow batches of at most n rows from now on in this session: rows here are whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= n:
        spark.conf.set(key, str(n))


def release_worker_memory(collect: bool = True) -> None:
    """At the end of a Python task: give freed memory back, as the worker stays for later tasks. Without collect only what
    is free already, which takes no time to speak of."""
    import ctypes
    import gc

    import pyarrow

    if collect:
        gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when a count shows at most max_rows rows; otherwise leave the join to shuffle.
    df should be staged, as it is counted first, and hold a few numbers in a row, so that rows bound its bytes."""
    return F.broadcast(df) if df.count() <= max_rows else df
