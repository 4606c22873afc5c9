"""Connected components of an undirected graph given as edge rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions.kernels import smallest_reached
from spotweave.operators.ranks import join_same
from spotweave.runtime import stage

BUCKET = 1 << 16  # edges of small groups that are worked as one array


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component): component is the smallest node that node reaches.

    Alternating star contraction: a large star moves the larger neighbours of every node to its smallest
    neighbour, a small star does so with the smaller ones; edges turn into stars around the smallest node
    after about the logarithm of the node count in rounds. Minima are partially aggregated and joined back,
    so no neighbourhood is gathered into one row, and each round is staged in the shared folder.
    Self-loops make singletons; repeated edges change nothing; edges with a null end are ignored;
    no edges give no rows. Not converging within max_rounds is an error, never a partial answer.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    e = stage(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    e, before = e.where("a <> b"), None
    for _ in range(max_rounds):
        both = e.union(e.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = stage(small.select("x.a", "x.b").where("a <> b").distinct(), "cc-edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        before = now
    raise RuntimeError(f"components did not converge within {max_rounds} rounds")


def bucket_components(edges: pa.Table, keys: list[str]) -> pa.Table:
    """keys, node and component of whole groups of edges (keys, src, dst)."""
    group = np.zeros(edges.num_rows, np.int64)
    for k in keys:
        codes = edges[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        group = np.unique(group * (codes.max(initial=0) + 1) + codes, return_inverse=True)[1].ravel()
    ids, of = np.concatenate([edges["src"].to_numpy(), edges["dst"].to_numpy()]), np.tile(group, 2)
    order = np.lexsort((ids, of))
    new = np.append(True, (np.diff(of[order]) != 0) | (np.diff(ids[order]) != 0))
    number = np.empty(len(ids), np.int64)
    number[order] = np.cumsum(new) - 1
    at = order[new]  # a row that has the node, in the order of groups and nodes
    least = smallest_reached(np.arange(len(at)), number.reshape(2, -1))
    rows = pa.array(at % edges.num_rows)
    return pa.table([*(edges[k].take(rows) for k in keys), pa.array(ids[at]), pa.array(ids[at][least])], names=[*keys, "node", "component"])


def components_within(edges: DataFrame, keys: list[str], bucket: int = BUCKET) -> DataFrame:
    """Rows (keys, node, component) as of `connected_components` for edges (keys, src, dst: long, without nulls) that stay within a group of keys,
    nulls being equal. Groups of up to `bucket` edges are dealt into buckets of about as many, each worked as one array, so they take no rounds; larger
    groups, of which a counted few can be, take the rounds."""
    e = stage(edges.select(*keys, "src", "dst").distinct(), "cc-within")
    sizes = e.groupBy(*keys).agg(F.count("*").alias("n_"))
    few, more = sizes.agg(F.sum(F.when(F.col("n_") <= bucket, F.col("n_"))), F.count_if(F.col("n_") > bucket)).first()
    large = F.broadcast(sizes.where(F.col("n_") > bucket).select(*keys))  # a row for more than `bucket` edges
    small = join_same(e, large, keys, "left_anti") if more else e
    dealt = small.withColumn("bucket_", F.pmod(F.xxhash64(*keys), F.lit(-(-(few or 1) // bucket))))
    kinds = ", ".join(f"`{k}` {e.schema[k].dataType.simpleString()}" for k in keys)
    found = dealt.groupBy("bucket_").applyInArrow(lambda t: bucket_components(t, keys), f"{kinds}, node long, component long")
    if not more:
        return found
    end = lambda c: F.struct(*keys, F.col(c).alias("at_")).alias(c)
    joined = connected_components(join_same(e, large, keys, "left_semi").select(end("src"), end("dst")))
    return found.union(joined.select(*[f"node.{k}" for k in keys], F.col("node.at_").alias("node"), F.col("component.at_").alias("component")))
