"""Column helpers of the native operators: bind a value once inside higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def indices(n: Column) -> Column:
    """0 .. n - 1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running_sums(numbers: Column, block: int = 512) -> Column:
    """The sums of an array of whole numbers up to and with each. An array that grows is copied for every number, so sums are made in
    blocks, and added to the sums of the blocks before: copies stay within `block` and the number of blocks."""
    none = F.array().cast("array<int>")
    grown = lambda x: F.aggregate(x, none, lambda a, v: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + v)))
    blocks = lambda x: F.transform(indices(F.ceil(F.size(x) / block).cast("int")), lambda b: grown(F.slice(x, b * block + 1, block)))

    def joined(parts: Column) -> Column:
        before = grown(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(before, lambda s: F.flatten(F.transform(parts, lambda p, i: F.transform(p, lambda v: v + F.when(i > 0, F.get(s, i - 1)).otherwise(0)))))

    return let(numbers, lambda x: let(blocks(x), joined))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
