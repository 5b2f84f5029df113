"""Connected components of a graph of links, as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir import storage
from logweir.llm.frames import stored
from logweir.scratch import scratch_dir

#: Edges that a task contracts at once.
CONTRACT_EDGES = 1_000_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of edges (a, b) as edges to the least node of each."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        least = np.minimum(label[x], label[y])
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while not np.array_equal(new, further := new[new]):
            new = further
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``a``, ``b`` of a task's batches, contracted CONTRACT_EDGES at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= CONTRACT_EDGES:
            yield (star := _star(held))
            held = [star] if 2 * star.num_rows <= CONTRACT_EDGES else []
    if held:
        yield _star(held)


def _star(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    star = contract(*(table[name].to_numpy() for name in ("a", "b")))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in star], names=["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of the component) from edges ``a``, ``b`` (longs).

    Roots themselves and nodes without edges are not listed. Each task first contracts the
    edges that it has to the stars of their components. Then alternating stars: each node's
    larger neighbours are tied to its least one, then its smaller ones, until nothing
    changes, which takes about log(longest path) rounds of what contraction has left. Minima
    are combined before each shuffle; a hub's edges are joined by its key, which adaptive
    execution splits, and no node has many smaller neighbours. Each round ends in a table
    in the shared scratch folder, which is removed when the next one is there.
    """
    spark = edges.sparkSession
    one = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    path = scratch_dir(spark)
    current = stored(_contract(one.where("a <> b")).distinct(), path)
    state = None
    while (now := _state(current)) != state:
        state, before = now, path
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = F.min("b").over(Window.partitionBy("a"))
        # (a, b) becomes (b, least of a), and (a, least) stays.
        small = large.withColumn("m", lowest).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
        )
        path = scratch_dir(spark)
        current = stored(_contract(small).distinct(), path)
        storage.remove(spark, before)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _contract(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").mapInArrow(contracted, "a bigint, b bigint")


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 24))).first())
