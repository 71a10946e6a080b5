"""Sets of whole numbers as bits, 64 in a word, so that a membership is looked up where a row is and no row is dealt for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that are broadcast, of some 60 bytes each; they hold 64 million numbers that lie side by side.
MAX_BROADCAST_WORDS = 1_000_000


def _word(key: Column) -> Column:
    return F.shiftright(key, 6)


def _place(key: Column) -> Column:
    return key.bitwiseAND(F.lit(63)).cast("int")


def words(df: DataFrame, key: str, keep: Callable, name: str | None = None, **flags: Column) -> DataFrame | None:
    """(word, known, flags): the bits of all values of `key`, and of those for which a row has a flag; None where there are
    more words than are broadcast. Null is in no set."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), _place(F.col(key)))
    sets = {"known": F.lit(True), **flags}
    rows = df.where(F.col(key).isNotNull()).select(_word(F.col(key)).alias("word"), *[F.when(c, one).otherwise(F.lit(0).cast("long")).alias(s) for s, c in sets.items()])
    table = keep(name or f"words-of-{key}", lambda: rows.groupBy("word").agg(*[F.bit_or(s).alias(s) for s in sets]))
    return table if table.count() <= MAX_BROADCAST_WORDS else None


def flagged(df: DataFrame, key: str, table: DataFrame, **flags: str) -> DataFrame:
    """`df` with a boolean column for each set of `table` that is asked for: column="set"; false for null."""
    mine = table.select(F.col("word").alias("_word"), *[F.col(s).alias(f"_{column}") for column, s in flags.items()])
    out = df.join(F.broadcast(mine), _word(F.col(key)) == F.col("_word"), "left")
    tests = [F.coalesce(F.getbit(F.col(f"_{column}"), _place(F.col(key))) == 1, F.lit(False)).alias(column) for column in flags]
    return out.select(*df.columns, *tests)
