"""Row numbers, ranks by the rules of an experiment, and running sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.checks import require_none
from spotweave.runtime import stage, unstage

#: Orders of the outputs, as their readers expect them.
LOCUS_PAIR_ORDER = ("fov", "trace_group", "locus_1", "locus_2", "trace_id", "region_1", "region_2")
REGION_PAIR_ORDER = ("fov", "channel", "timepoint_1", "timepoint_2", "distance")
TRACE_ORDER = ("fov", "roi_id", "ref_timepoint", "trace_id", "timepoint")
POINT_ORDER = ("zc", "yc", "xc")

SHARE = 1 << 20  # rows that a task sorts


def numbered_rows(df: DataFrame, order: list[str], name: str = "row_number", *, ordered: bool = False, share: int = SHARE) -> DataFrame:
    """df with the 0-based number of each row in a total order (W1). Rows are staged and counted first, so that range partitions of about `share` rows are
    sorted, each by a task, and offset by the rows before. The result comes in no order of its own; if `ordered`, in that of the numbers, dealt out by them."""
    rows = stage(df, "unnumbered")
    n = max(1, -(-rows.count() // share))
    parts = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id())
    held = stage(parts, "row-numbers").withColumn("part_", F.shiftright("at_", 33)).withColumn("rank_", F.col("at_").bitwiseAND((1 << 33) - 1)).drop("at_")
    unstage(rows)
    counts = held.groupBy("part_").agg(F.count("*").alias("n_"))
    before = counts.select("part_", (F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")).alias("before_"))  # a row for each partition
    out = held.join(F.broadcast(before), "part_").withColumn(name, F.col("before_") + F.col("rank_")).drop("part_", "rank_", "before_")
    return out.repartitionById(n, F.floor(F.col(name) / share).cast("int")).sortWithinPartitions(name) if ordered else out


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left with the other columns of right by keys, nulls being equal."""
    other = right.withColumnsRenamed({k: f"{k}_same_" for k in keys})
    on = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"{k}_same_")) for k in keys])
    return left.join(other, on, how).drop(*[f"{k}_same_" for k in keys])


def rank_within(df: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """df with the 0-based place of each row among those of its keys. Rows are numbered in one range-partitioned order, so a key
    with most of the rows is spread over tasks like any other."""
    numbered = numbered_rows(df, [*keys, *order], "n_")  # from a staged table, so reading it twice is cheap
    first = numbered.groupBy(*keys).agg(F.min("n_").alias("first_"))
    return join_same(numbered, first, keys).select(*df.columns, (F.col("n_") - F.col("first_")).alias(name))


def in_order(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """df sorted by those of the order's columns that it has."""
    return df.orderBy(*[c for c in order if c in df.columns])


def _rank_table(df: DataFrame, groups: dict, key: str, key_type: str, value: str) -> DataFrame:
    rows = [(g, t, i) for g, times in groups.items() for i, t in enumerate(sorted(set(times)))]
    return df.sparkSession.createDataFrame(rows, f"{key} {key_type}, {value} int, rank_ long")


def rank_in_trace_group(df: DataFrame, groups: dict[str, list[int]], name: str = "region_index", *, validate: bool = True) -> DataFrame:
    """The 0-based rank of ref_timepoint among the sorted members of the row's trace_group; 0 without a group.
    A group or a time that the rules do not know is an error when validated, else null."""
    out = df.join(F.broadcast(_rank_table(df, groups, "trace_group", "string", "ref_timepoint")), ["trace_group", "ref_timepoint"], "left")
    out = out.withColumn(name, F.when(F.col("trace_group").isNull(), F.lit(0).cast("long")).otherwise(F.col("rank_"))).drop("rank_")
    return require_none(out, F.col(name).isNull(), "a trace group or regional time that no rule names") if validate else out


def rank_in_region(df: DataFrame, grouping: dict[int, list[int]] | None, all_times: list[int], name: str = "time_index", *, validate: bool = True) -> DataFrame:
    """The 0-based rank of timepoint among its region's time and locus times, sorted; without a grouping, among all times."""
    if grouping:
        table = _rank_table(df, {r: [r, *times] for r, times in grouping.items()}, "ref_timepoint", "int", "timepoint")
        out = df.join(F.broadcast(table), ["ref_timepoint", "timepoint"], "left")
    else:
        out = df.join(F.broadcast(_rank_table(df, {0: all_times}, "all_", "int", "timepoint").drop("all_")), "timepoint", "left")
    out = out.withColumnRenamed("rank_", name)
    return require_none(out, F.col(name).isNull(), "a timepoint outside its region") if validate else out


def true_times(stacks: DataFrame, grouping: dict[int, list[int]], volumes: str = "volumes") -> DataFrame:
    """One row for each volume of a stack, with the timepoint that its position stands for (W8); a position beyond the
    region's times is an error."""
    times = F.create_map(*[x for r, ts in grouping.items() for x in (F.lit(r), F.array(*[F.lit(t) for t in sorted({r, *ts})]))])
    rows = stacks.select("*", F.posexplode(volumes).alias("position", "volume")).drop(volumes)
    found = F.try_element_at(F.try_element_at(times, F.col("ref_timepoint")), F.col("position") + 1)
    return rows.withColumn("timepoint", F.coalesce(found, F.raise_error(F.concat(F.lit("no timepoint for position "), F.col("position").cast("string")))))


def walk(df: DataFrame, keys: list[str], order: str, steps: list[str]) -> DataFrame:
    """Positions of a walk: the running sums of its steps."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"{s}_position": F.sum(s).over(w) for s in steps})
