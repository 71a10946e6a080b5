"""Maintenance of the taxonomy: tables in, tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import format_name


def clean_revisions(sheet: DataFrame) -> DataFrame:
    """(parent_name, child_name, level) of a revision sheet with its names formatted."""
    return sheet.select(format_name(F.col("parent_name")).alias("parent_name"), format_name(F.col("child_name")).alias("child_name"), "level")


def checked_revisions(sheet: DataFrame) -> DataFrame:
    """The sheet with its names formatted; fails unless it has one parent, one level, and children that are distinct and
    named."""
    rows = clean_revisions(sheet)
    one = rows.agg(
        F.count_distinct("parent_name").alias("parents"),
        F.count_distinct("level").alias("levels"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("child_name").alias("children"),
        F.count_if((F.coalesce("parent_name", F.lit("")) == "") | (F.coalesce("child_name", F.lit("")) == "")).alias("unnamed"),
    ).first()
    faults = [what for what, bad in (("parent", one.parents != 1), ("level", one.levels != 1), ("repeated child", one.children != one.n), ("missing name", one.unnamed)) if bad]
    if faults:
        raise ValueError("revision sheet: " + ", ".join(faults))
    return rows


def append_children(meta: DataFrame, children: DataFrame, revisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds the revisions' edges, and their children to the topics where they are new."""
    fresh = revisions.select(F.col("child_name").alias("name"), "level").distinct().join(meta, "name", "left_anti")
    return meta.select("name", "level").unionByName(fresh), children.select("parent_name", "child_name").unionByName(revisions.select("parent_name", "child_name"))


def replace_children(meta: DataFrame, children: DataFrame, revisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drops the topics and edges below the revisions' parents, then appends."""
    parents = revisions.select("parent_name").distinct()
    old = children.join(parents, "parent_name", "left_semi").select(F.col("child_name").alias("name")).distinct()
    return append_children(meta.join(old, "name", "left_anti"), children.join(parents, "parent_name", "left_anti"), revisions)


def fix_parent_levels(meta: DataFrame, children: DataFrame) -> DataFrame:
    """Where a child has parents at several levels, its edges from level 0 go."""
    level = meta.select(F.col("name").alias("parent_name"), "level")
    placed = children.join(level, "parent_name", "left")
    mixed = placed.groupBy("child_name").agg(F.count_distinct("level").alias("n")).where("n > 1").select("child_name", F.lit(True).alias("mixed"))
    marked = placed.join(mixed, "child_name", "left")
    return marked.where(~(F.coalesce("mixed", F.lit(False)) & (F.coalesce("level", F.lit(-1)) == 0))).select("parent_name", "child_name")


def remove_topic(meta: DataFrame, children: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    return meta.where(F.col("name") != name), children.where((F.col("parent_name") != name) & (F.col("child_name") != name))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, for assertions."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
