"""Names and keys as Column functions (P10, SC3, SC6 to SC8, IO24, W12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fov_name(index: Column) -> Column:
    """P0001 for index 0, up to P9999; null outside."""
    return F.when(index.between(0, 9998), F.format_string("P%04d", (index + 1).cast("int")))


def fov_index(name: Column) -> Column:
    """0-based index of a name with or without the .zarr suffix; null for anything else, P0000 included."""
    digits = F.regexp_extract(F.regexp_replace(name, r"\.zarr$", ""), r"^P(\d{4})$", 1)
    return F.when((digits != "") & (digits != "0000"), F.expr("1") * digits.try_cast("int") - 1)


def timepoint_in_name(name: Column) -> Column:
    """The one Time00000 of a file name; null if there is none or several."""
    found = F.regexp_extract_all(name, F.lit(r"Time(\d{5})"), F.lit(1))
    return F.when(F.size(found) == 1, F.element_at(found, 1).try_cast("int"))


def viewing_key(fov: Column, group: Column) -> Column:
    return F.concat_ws("__", fov, group)


def viewing_parts(key: Column) -> dict[str, Column]:
    """Field of view and group of a viewing key; null throughout if it has not two parts (SC6)."""
    parts = F.split(key, "__", -1)
    ok = F.size(parts) == 2
    return {"fov": F.when(ok, F.get(parts, 0)), "trace_group": F.when(ok, F.get(parts, 1))}


def combined_json(*objects: Column) -> Column:
    """One JSON object of several (flat, of numbers or text); a key that stands in two of them is an error (SC8)."""
    maps = [F.from_json(o, "map<string,string>") for o in objects]
    keys = F.flatten(F.array(*[F.map_keys(m) for m in maps]))
    text = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), json_value(e["value"]))), ",")
    body = F.array_join(F.filter(F.array(*[text(m) for m in maps]), lambda t: t != ""), ",")
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.raise_error(F.concat(F.lit("JSON keys repeat: "), F.array_join(keys, " ")))).otherwise(F.concat(F.lit("{"), body, F.lit("}")))


def json_value(value: Column) -> Column:
    """A number as it is, anything else as a quoted string."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(value.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"), value).otherwise(quoted)


def int_set(cell: Column) -> Column:
    """Sorted ints of a space-joined cell; empty for ""; null where a part is no int or repeats."""
    parts = F.transform(F.filter(F.split(F.coalesce(cell, F.lit("")), " "), lambda x: x != ""), lambda x: x.try_cast("int"))
    bad = F.exists(parts, lambda x: x.isNull()) | (F.size(F.array_distinct(parts)) < F.size(parts))
    return F.when(~bad, F.array_sort(parts))


def int_set_cell(ids: Column) -> Column:
    return F.array_join(F.array_sort(ids), " ")


def safe_number(cell: Column, kind: str = "double", positive: bool = False) -> Column:
    """The number in a cell, null if it is none (or not positive where that is asked)."""
    value = F.trim(cell).try_cast(kind)
    return F.when(value > 0, value) if positive else value


def time_offsets(counts: DataFrame, order: str) -> DataFrame:
    """Timepoints before each folder: the running sum of n without the own (W12). A row for each folder."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum("n").over(w), F.lit(0)))
