"""Dense and sparse vectors as higher-order expressions, accumulated in doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def length(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def normed(v: Column) -> Column:
    """Unit length; a zero vector, also one with NaN for zeros, stays zero."""
    clean = F.transform(v, lambda x: F.when(F.isnan(x.cast("double")), 0.0).otherwise(x.cast("double")))
    n = length(clean)
    return F.when(n == 0, F.transform(clean, lambda x: F.lit(0.0))).otherwise(F.transform(clean, lambda x: x / n))


def cosine(a: Column, b: Column) -> Column:
    return dot(normed(a), normed(b))


def sparse_normed(pairs: Column) -> Column:
    """array<struct<i, v>> of unit length; an empty or zero vector stays as it is."""
    n = F.sqrt(F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["v"] * p["v"]))
    return F.transform(pairs, lambda p: F.struct(p["i"].alias("i"), F.when(n == 0, p["v"]).otherwise(p["v"] / n).alias("v")))


#: Vectors that are broadcast to the rows that name them, of some 8 bytes an element.
MAX_BROADCAST_VECTORS = 50_000


def vector_sum(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None, unit: bool = True, size: int | None = None) -> DataFrame:
    """The element-wise (weighted) sum of each group's vectors, of unit length if asked for: `keys` and `vector`.

    A group is one row with a sum for each of `size` elements, as many as the longest vector has; without `size` they are
    counted first. Null and empty vectors add nothing; a group of them alone has null.
    """
    w = F.lit(1.0) if weight is None else weight
    rows = df.select(*keys, w.alias("_w"), F.col(vector).alias("_v"))
    if size is None:
        size = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    sums = [F.sum(F.col("_w") * F.get("_v", F.lit(i))).alias(f"_{i}") for i in range(max(size, 0))]
    whole = rows.groupBy(*keys).agg(F.max(F.when(F.size("_v") > 0, F.size("_v"))).alias("_n"), *sums)
    out = F.when(F.col("_n").isNotNull(), F.slice(F.array(*[F.col(f"_{i}").cast("double") for i in range(max(size, 0))]).cast("array<double>"), 1, F.col("_n")))
    named = whole.select(*keys, out.alias(vector))
    return named.withColumn(vector, normed(F.col(vector))) if unit else named


def named_sum(rows: DataFrame, vectors: DataFrame, key: str, name: str, weight: Column) -> DataFrame:
    """(key, vector): the weighted unit sum of the vectors that a key's rows name; null where none is known.

    `rows` has key, name and what `weight` needs, `vectors` is (name, vector). While these can be broadcast, only the narrow
    rows are dealt, by key, and summed where they are.
    """
    n, size = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    narrow = rows.select(key, name, weight.alias("_w"))
    joined = narrow.repartition(key).join(F.broadcast(vectors), name, "left") if n <= MAX_BROADCAST_VECTORS else narrow.join(vectors, name, "left")
    return vector_sum(joined, [key], "vector", F.col("_w"), size=size or 0)
