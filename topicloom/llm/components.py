"""Connected components of an edge table by alternating large-star and small-star rounds, until the edges fit in a task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.shared import lean, materialize, salted_join

MAX_ROUNDS = 60
#: So many edges at most are settled in one task, of some 250 bytes each; a round of seven shuffles costs more than that.
TASK_EDGES = 200_000


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all nodes of the edges (u, v): trees whose roots are the smallest nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root[x]
        return top

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, c = find(u), find(v)
            root[max(a, c)] = min(a, c)
    nodes = list(root)
    for i in range(0, len(nodes), 10_000):
        own = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([find(x) for x in own], pa.int64())], ["node", "component"])


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    tied = salted_join(both.where("v > u"), materialize(least, "neighbours"), ["u"], "n", 2 * total, "v")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Edges point from larger to smaller; u and its smaller neighbours are tied to the smallest."""
    edges = materialize(edges, "edges")
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "neighbours")
    moved = salted_join(edges, least, ["u"], "n", total, "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge, component being the smallest node reachable.

    `edges` has long columns u and v, in any direction; loops and repeats do no harm. Only counts and a checksum reach
    the driver. Groups are never gathered: a hub is a partial minimum and a salted join.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    total, seen = now.count(), None
    for _ in range(MAX_ROUNDS):
        if total <= TASK_EDGES:
            return now.coalesce(1).mapInArrow(lean(_settle), "node long, component long")
        now = materialize(_small_star(_large_star(now, total), total), "edges")
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(row) == seen:
            break
        seen, total = tuple(row), row[0]
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
