"""Evaluation: shares, samples, venues, agreement, confusion, coverage, identifier joins, entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.ids import domain, identifier
from topicloom.functions.vectors import named_sum, normed


def shares(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """(key, n, pct): each value's share of all rows, in percent; the window runs over the few groups only."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()) * 100, digits))


def share_change(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Shares of both, for keys in both, and their difference."""
    a, b = shares(before, key), shares(after, key)
    both = a.select(key, F.col("pct").alias("pct_pre")).join(b.select(key, F.col("pct").alias("pct_post")), key)
    return both.withColumn("diff", F.round(F.col("pct_post") - F.col("pct_pre"), 1))


def average_rank_first(df: DataFrame, group: list[str], score: str) -> DataFrame:
    """Rows whose rank within the group, averaged over ties and best score first, is 1: no tie for the first place."""
    by = Window.partitionBy(*group)
    ranked = df.withColumn("rank", F.rank().over(by.orderBy(F.desc(score))) + (F.count(F.lit(1)).over(Window.partitionBy(*group, score)) - 1) / 2)
    return ranked.where("rank = 1").drop("rank")


def harmonic(a: Column, b: Column) -> Column:
    return F.lit(2.0) / (F.lit(1.0) / a + F.lit(1.0) / b)


def group_shares(df: DataFrame, group: str, value: str, min_total: int = 100) -> DataFrame:
    """(group, value, n, total, prop) of groups with at least `min_total` rows."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    total = counts.withColumn("total", F.sum("n").over(Window.partitionBy(group)))
    return total.where(F.col("total") >= min_total).withColumn("prop", F.round(F.col("n") / F.col("total"), 4))


def heads(df: DataFrame, group: str, order: list, n: int = 5) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def kth_best(scores: DataFrame, k: int) -> DataFrame:
    """(merged_id, name, score): the k-th best topic of each document over all levels."""
    by = Window.partitionBy("merged_id").orderBy(F.desc("score"), "name")
    return scores.withColumn("_r", F.row_number().over(by)).where(F.col("_r") == k).select("merged_id", "name", "score")


def best_per_level(scores: DataFrame) -> DataFrame:
    """(merged_id, level, name, score): the greatest (score, name) of each level, as one aggregate."""
    top = F.max(F.struct("score", "name")).alias("t")
    return scores.groupBy("merged_id", "level").agg(top).select("merged_id", "level", "t.name", "t.score")


def portable_hash(i: Column) -> Column:
    """A multiplicative hash of an integer that any SQL engine can repeat."""
    return (i.cast("decimal(38,0)") * F.lit(2654435761).cast("decimal(38,0)") % F.lit(4294967296).cast("decimal(38,0)")).cast("long")


def stratified_sample(df: DataFrame, group: str, key: str, n: int = 1000, seed: int | None = None) -> DataFrame:
    """At most n rows of each group, the first by hash of an integer key; a seed draws another sample."""
    h = portable_hash(F.col(key)) if seed is None else F.xxhash64(F.lit(seed), key)
    return heads(df.withColumn("_h", h), group, ["_h", key], n).drop("_h")


def hash_sample(df: DataFrame, key: Column, modulus: int, below: int = 1) -> DataFrame:
    return df.where(F.pmod(F.abs(key), F.lit(modulus)) < below)


def sampling_frame(corpus: DataFrame, before: DataFrame, years: DataFrame, first: int = 2010, last: int = 2021) -> DataFrame:
    """(merged_id, year, number, id_hash): documents of both corpora by year, numbered within the year and hashed.

    Numbers follow the digest of merged_id, so unlike an unordered numbering they can be repeated. A year is numbered
    slice by slice of the digest, each slice after the rows of the earlier ones, so no task sees all of a year.
    """
    ids = corpus.select("merged_id").unionAll(before.select("merged_id"))
    rows = years.join(ids, "merged_id").where(F.col("year").between(first, last)).select("merged_id", "year")
    rows = rows.withColumn("_h", F.md5(F.col("merged_id").cast("binary"))).withColumn("_s", F.substring("_h", 1, 3))
    earlier = Window.partitionBy("year").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("year", "_s").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("year", "_s").orderBy("_h", "merged_id"))
    numbered = rows.join(slices, ["year", "_s"]).withColumn("number", F.col("_before") + own)
    return numbered.select("merged_id", "year", "number", F.xxhash64(F.col("number").cast("string")).alias("id_hash"))


def labelled_sample(sample: DataFrame, scores: DataFrame, meta: DataFrame, texts: DataFrame, top_level: int = 1) -> DataFrame:
    """(merged_id, title, abstract, fields): observed scores of the sampled documents for topics down to `top_level`, with
    names and texts where they are known; a document without text stays, and documents aren't merged by their texts.

    `scores` is (merged_id, name, score, is_imputed), `texts` (merged_id, title, abstract).
    """
    upper = meta.where(F.col("level") <= top_level).select("name", "level")
    own = scores.where(~F.col("is_imputed")).join(sample.select("merged_id"), "merged_id", "left_semi").join(upper, "name")
    rows = own.groupBy("merged_id").agg(F.array_sort(F.collect_list(F.struct("level", "name", "score"))).alias("fields"))
    return rows.join(texts, "merged_id", "left").select("merged_id", "title", "abstract", "fields")


def confusion(df: DataFrame, key: str, actual: str, predicted: str) -> DataFrame:
    """(key, tp, fp, fn, tn, recall) from boolean columns."""
    a, p = F.col(actual), F.col(predicted)
    out = df.groupBy(key).agg(
        F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"), F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn")
    )
    return out.withColumn("recall", F.when(F.col("tp") + F.col("fn") > 0, F.round(F.col("tp") / (F.col("tp") + F.col("fn")), 4)))


def zero_filled(a: DataFrame, b: DataFrame) -> DataFrame:
    """(merged_id, name, score_a, score_b) for documents in both; a topic that one side lacks is 0 there."""
    both = a.select("merged_id").intersect(b.select("merged_id"))
    x = a.join(both, "merged_id", "left_semi").select("merged_id", "name", F.col("score").alias("score_a"))
    y = b.join(both, "merged_id", "left_semi").select("merged_id", "name", F.col("score").alias("score_b"))
    full = x.join(y, ["merged_id", "name"], "full")
    return full.select("merged_id", "name", F.coalesce("score_a", F.lit(0.0)).alias("score_a"), F.coalesce("score_b", F.lit(0.0)).alias("score_b"))


def agreement_alpha(a: DataFrame, b: DataFrame) -> DataFrame:
    """(merged_id, alpha): Krippendorff's alpha of two coders with nominal distance over a document's topics.

    With two values for every item: 1 - (n - 1) * observed disagreements / pairs of unequal values, n = 2 * items.
    Null where the values are all alike.
    """
    return alpha_of_pairs(zero_filled(a, b))


def alpha_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same from (merged_id, score_a, score_b), a row a topic; null is 0, and a document that one side has nothing of
    has no row. Rows are dealt by document at most once: values are counted, then the counts are added up.
    """
    a, b = (F.coalesce(c, F.lit(0.0)) for c in ("score_a", "score_b"))
    zero, one = F.lit(0), F.lit(1)
    values = pairs.where("score_a is not null or score_b is not null").select(
        "merged_id", F.col("score_a").isNotNull().alias("has_a"), F.col("score_b").isNotNull().alias("has_b"),
        F.explode(F.array(F.struct(a.alias("v"), one.alias("item"), (a != b).cast("int").alias("differ")), F.struct(b.alias("v"), zero.alias("item"), zero.alias("differ")))).alias("x"),
    )
    counts = values.groupBy("merged_id", "x.v").agg(
        F.count(F.lit(1)).alias("c"), F.sum("x.item").alias("items"), F.sum("x.differ").alias("differ"), F.bool_or("has_a").alias("has_a"), F.bool_or("has_b").alias("has_b")
    )
    per = counts.groupBy("merged_id").agg(
        F.sum("items").alias("items"), F.sum("differ").alias("differ"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.bool_or("has_a").alias("has_a"), F.bool_or("has_b").alias("has_b")
    )
    n = F.col("items") * 2
    expected = (n * n - F.col("squares")) / (n - 1)
    return per.where("has_a and has_b").select("merged_id", F.when(expected > 0, F.round(1 - 2 * F.col("differ") / expected, 2)).alias("alpha"))


def references(urls: DataFrame, id_col: str = "field", url_col: str = "url") -> DataFrame:
    """(id_col, url, domain, id_type, id_value), each once."""
    i = identifier(F.col(url_col))
    return urls.select(id_col, F.col(url_col).alias("url"), domain(F.col(url_col)).alias("domain"), i["id_type"].alias("id_type"), i["id_value"].alias("id_value")).distinct()


def identifier_join(refs: DataFrame, id_type: str, works: DataFrame, work_key: Column, sources: DataFrame, papers: DataFrame) -> DataFrame:
    """(id, merged_id, text): references of a kind to works by key, on to merged ids and their texts."""
    own = refs.where((F.col("id_type") == id_type) & F.col("id_value").isNotNull()).select("id", "id_value")
    keyed = works.select(F.col("orig_id"), work_key.alias("id_value"))
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    found = own.join(keyed, "id_value").join(sources, "orig_id").join(papers, "merged_id")
    return found.select("id", "merged_id", text.alias("text")).distinct()


def match_flags(refs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(matched, n): references with and without a partner."""
    joined = refs.join(known.select(F.col(key).alias("_k")).distinct(), refs.id_value == F.col("_k"), "left")
    return joined.groupBy(F.col("_k").isNotNull().alias("matched")).agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row: distinct keys, and distinct keys with a text."""
    return df.agg(F.count_distinct(key).alias("n_keys"), F.count_distinct(F.when(F.char_length(text) > 0, F.col(key))).alias("n_covered"))


def mention_counts(mentions: DataFrame, id_col: str, array_col: str) -> DataFrame:
    return mentions.select(id_col, F.explode(array_col).alias("mention")).groupBy(id_col, "mention").agg(F.count(F.lit(1)).alias("n"))


def entity_vectors(counts: DataFrame, vectors: DataFrame, id_col: str, exclude_self: bool = False) -> DataFrame:
    """(id_col, vector): the unit sum of the mentioned entities' vectors, weighted by count; zeros without mentions.

    `vectors` is (mention, vector). `exclude_self` leaves out mentions equal to the identifier.
    """
    n = F.col("n").cast("double")
    if exclude_self:
        # The row stays for its identifier and names nothing.
        counts = counts.withColumn("mention", F.when(F.lower(F.col(id_col).cast("string")) != F.lower("mention"), F.col("mention")))
    zero = vectors.select(F.transform("vector", lambda x: F.lit(0.0)).alias("z")).limit(1)
    return named_sum(counts, vectors, id_col, "mention", n).select(id_col, F.coalesce("vector", zero.scalar()).alias("vector"))


def sentence_vectors(words: DataFrame, vectors: DataFrame, id_col: str) -> DataFrame:
    """(id_col, vector): the mean of the unit vectors of a text's words, brought to unit length; words without a
    vector are left out. `words` is (id_col, term, tf)."""
    unit = vectors.select("term", normed(F.col("vector")).alias("vector"))
    return named_sum(words, unit, id_col, "term", F.col("tf").cast("double")).where("vector is not null")
