"""Data-quality gates: each gives one row of booleans, and all must be true before a refresh is published.

As in the engine they stand for, an aggregate over nothing is null and fails the gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import format_name


def _none(df: DataFrame, name: str = "ok") -> DataFrame:
    return df.agg((F.count(F.lit(1)) == 0).alias(name))


def ids_in_top_fields(scores: DataFrame, top: DataFrame) -> DataFrame:
    return _none(scores.where("fields is not null").join(top.select("merged_id"), "merged_id", "left_anti"))


def children_in_meta(children: DataFrame, meta: DataFrame) -> DataFrame:
    """Two equi-joins and a test for null, where a disjunction of anti-joins would need a nested loop."""
    p, c = meta.select(F.col("name").alias("p")).distinct(), meta.select(F.col("name").alias("c")).distinct()
    joined = children.join(p, children.parent_name == p.p, "left").join(c, children.child_name == c.c, "left")
    return _none(joined.where("p is null or c is null"))


def score_names_in_meta(scores: DataFrame, meta: DataFrame) -> DataFrame:
    return names_in_meta(scores.select(F.inline("fields")).select("name"), meta)


def names_in_meta(names: DataFrame, meta: DataFrame) -> DataFrame:
    """Names are made distinct first: few are, and a join by name would deal a large taxonomy's scores."""
    return _none(names.distinct().join(meta.select("name"), "name", "left_anti"))


def all_ids_scored(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    return _none(corpus.join(scores.select("merged_id"), "merged_id", "left_anti"))


def _full(left: DataFrame, right: DataFrame) -> DataFrame:
    both = left.withColumn("l", F.lit(True)).join(right.withColumn("r", F.lit(True)), "k", "full")
    return both.agg(F.bool_and(F.col("l").isNotNull()).alias("in_first"), F.bool_and(F.col("r").isNotNull()).alias("in_second"))


def names_agree(children: DataFrame, hierarchy: DataFrame, side: str) -> DataFrame:
    """side "child" or "parent": the names of both tables are the same set."""
    other = {"child": "child_display_name", "parent": "display_name"}[side]
    return _full(children.select(F.col(f"{side}_name").alias("k")).distinct(), hierarchy.select(F.col(other).alias("k")).distinct())


def ids_agree(observed: DataFrame, imputed: DataFrame, top: DataFrame) -> DataFrame:
    ids = observed.select(F.col("merged_id").alias("k")).union(imputed.select("merged_id")).distinct()
    return _full(ids, top.select(F.col("merged_id").alias("k")).distinct())


def marks_agree(marks: DataFrame) -> DataFrame:
    """The same from (merged_id, top), a row for each identifier with whether it has a top: then no other has one."""
    return marks.agg(F.bool_and(F.lit(True)).alias("in_first"), F.bool_and("top").alias("in_second"))


def ids_distinct(scores: DataFrame) -> DataFrame:
    return scores.agg((F.count_distinct("merged_id") == F.count("merged_id")).alias("ok"))


def not_empty(df: DataFrame) -> DataFrame:
    return df.agg((F.count(F.lit(1)) > 0).alias("ok"))


def same_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    counts = a.agg(F.count(F.lit(1)).alias("n")).union(b.agg(F.count(F.lit(1)).alias("n")))
    return counts.agg((F.count_distinct("n") == 1).alias("ok"))


def score_range(scores: DataFrame) -> DataFrame:
    return range_of(scores.select(F.inline("fields")))


def range_of(scores: DataFrame) -> DataFrame:
    return scores.agg((F.min("score") >= 0).alias("min_score"), (F.max("score") <= 1).alias("max_score"))


def taxonomy(meta: DataFrame, children: DataFrame) -> DataFrame:
    """One row with every invariant of names and edges."""
    folded = F.regexp_replace(F.lower("name"), r"\s", "")
    one = meta.agg(
        (F.count_distinct("name") == F.count("name")).alias("names_unique"),
        (F.count_distinct(folded) == F.count("name")).alias("names_unique_folded"),
        F.bool_and(F.coalesce(F.col("name") == F.trim("name"), F.lit(False))).alias("names_trimmed"),
        F.bool_and(F.coalesce(F.col("name") != "", F.lit(False))).alias("names_filled"),
        F.bool_and(F.coalesce(format_name(F.col("name")) == F.col("name"), F.lit(False))).alias("names_cased"),
    )
    filled = [F.coalesce(F.col(c) != "", F.lit(False)) for c in ("parent_name", "child_name")]
    named = children.agg(F.bool_and(filled[0] & filled[1]).alias("ends_named"))
    edges = children.groupBy("parent_name", "child_name").count().agg(F.bool_and(F.col("count") == 1).alias("edges_unique"))
    ends = children.select(F.col("parent_name").alias("name")).union(children.select("child_name")).distinct()
    known = ends.join(meta, "name", "left_anti").agg((F.count(F.lit(1)) == 0).alias("ends_known"))
    used = meta.join(ends, "name", "left_anti").agg((F.count(F.lit(1)) == 0).alias("nodes_used"))
    level = meta.select(F.col("name").alias("parent_name"), "level")
    mixed = children.join(level, "parent_name").groupBy("child_name").agg(F.count_distinct("level").alias("n"))
    even = mixed.agg(F.bool_and(F.col("n") == 1).alias("parents_level"))
    out = one
    for part in (edges, named, known, used, even):
        (name,) = part.columns
        out = out.withColumn(name, part.scalar())
    return out


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, passed) of all of them; null counts as failed."""
    out = None
    for name, df in checks.items():
        ok: Column = F.lit(True)
        for c in df.columns:
            ok = ok & F.coalesce(F.col(c), F.lit(False))
        row = df.select(F.lit(name).alias("check"), ok.alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out
