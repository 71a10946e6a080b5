"""The production chain: corpus, score merge, citation imputation, union, hierarchy, top topics, refresh.

Each step takes and gives DataFrames. Score arrays are never null at a step's edge: a null array counts as empty.
Ties are broken by name or identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions.text import clean_corpus_text, join_title_abstract

#: Topics left out after review.
DENIED = ("Process Management", "Access Control")
#: A taxonomy of at most this many topics is broadcast.
BROADCAST_TOPICS = 100_000
FIELDS = "array<struct<name:string,score:double>>"
EMPTY = f"cast(array() as {FIELDS})"


#: Sums of rounded scores often fall on half a unit; this settles them upwards whatever the order of addition.
HALF = 1e-9


def round4(x: Column | str) -> Column:
    return F.round((F.col(x) if isinstance(x, str) else x) + HALF, 4)


def in_language(text: str, ok: str, code: str, lang: str) -> Column:
    """Three-valued: null when the language code is unknown and nothing else says no."""
    return F.col(text).isNotNull() & F.col(ok).eqNullSafe(True) & (F.lower(code) == lang)


def language_meta(meta: DataFrame, sources: DataFrame, lang: str) -> DataFrame:
    """Metadata rows of merged ids with a title or an abstract in `lang`, with has_title and has_abstract."""
    joined = meta.join(sources, meta.id == sources.orig_id)
    marked = joined.withColumn("has_title", in_language("title", "title_ok", "title_code", lang)).withColumn(
        "has_abstract", in_language("abstract", "abstract_ok", "abstract_code", lang)
    )
    return marked.where(F.coalesce("has_title", F.lit(False)) | F.coalesce("has_abstract", F.lit(False)))


def corpus(meta: DataFrame, sources: DataFrame, lang: str = "en") -> DataFrame:
    """(merged_id, text): the longest title and abstract in the language, cleaned; empty texts left out.

    One aggregation picks both by max of (length, id), where two windows would sort every group twice.
    """
    rows = language_meta(meta, sources, lang)

    def longest(col: str, flag: str) -> Column:
        key = F.struct(F.char_length(F.trim(col)).alias("n"), F.col("id").alias("id"), F.col(col).alias("text"))
        return F.max(F.when(F.col(flag), key)).getField("text")

    best = rows.groupBy("merged_id").agg(longest("title", "has_title").alias("title"), longest("abstract", "has_abstract").alias("abstract"))
    text = clean_corpus_text(join_title_abstract(F.col("title"), F.col("abstract")), lang)
    # As the one element of an array a text is cleaned once; a test of a plain column is moved below it and cleans it again.
    return best.select("merged_id", F.explode(F.array(text)).alias("text")).where(F.char_length("text") > 0)


def changed_only(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows whose (merged_id, text) isn't in the earlier corpus."""
    return now.join(before, ["merged_id", "text"], "left_anti")


def incremental_corpus(meta: DataFrame, sources: DataFrame, before: DataFrame | None, lang: str = "en", rerun: bool = False, limit: int = 0) -> DataFrame:
    """The corpus to score in this run; `rerun` takes all of it, a limit takes the first by merged_id."""
    out = corpus(meta, sources, lang)
    if before is not None and not rerun:
        out = changed_only(out, before)
    return out.orderBy("merged_id").limit(limit) if limit else out


def nest(long: DataFrame, *keys: str) -> DataFrame:
    """(keys, fields) from (keys, name, score), sorted by name."""
    return long.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("name", "score"))).alias("fields"))


def unnest(nested: DataFrame, *keys: str) -> DataFrame:
    return nested.select(*keys, F.inline("fields"))


def no_null_fields(df: DataFrame) -> DataFrame:
    return df.withColumn("fields", F.coalesce("fields", F.expr(EMPTY)))


def merged_long(new: DataFrame, prod: DataFrame, meta: DataFrame, sources: DataFrame, lang: str = "en") -> DataFrame:
    """(merged_id, name, score): new scores, and old ones of documents still in the language that weren't scored anew."""
    in_lang = language_meta(meta, sources, lang).select("merged_id").distinct()
    old = prod.join(new.select("merged_id").distinct(), "merged_id", "left_anti").join(in_lang, "merged_id", "left_semi")
    return new.select("merged_id", "name", "score").unionByName(old.select("merged_id", "name", "score"))


def allowed_topics(scores: DataFrame, denied=DENIED) -> DataFrame:
    return scores.where(~F.col("name").isin(*denied))


def en_long(new: DataFrame, prod: DataFrame, meta: DataFrame, sources: DataFrame, lang: str = "en", denied=DENIED) -> tuple[DataFrame, DataFrame]:
    """(merged_id) and (merged_id, name, score) of the merged scores. Denied topics have no score, but a document whose
    every topic is denied stays among the identifiers."""
    both = merged_long(new, prod, meta, sources, lang)
    return both.select("merged_id").distinct(), allowed_topics(both, denied)


def en_scores(new: DataFrame, prod: DataFrame, meta: DataFrame, sources: DataFrame, lang: str = "en", denied=DENIED, observed_only: bool = False) -> DataFrame:
    """The same over nested tables: `new` and `prod` are (merged_id, fields), `prod` with is_imputed where `observed_only`
    is wanted. A document whose every topic is denied keeps an empty array, and so does an old one without topics; a new
    one scored with no topic at all drops out.
    """
    in_lang = language_meta(meta, sources, lang).select("merged_id").distinct()
    if observed_only:
        prod = prod.where(~F.col("is_imputed"))
    old = no_null_fields(prod.select("merged_id", "fields")).join(new, "merged_id", "left_anti").join(in_lang, "merged_id", "left_semi")
    fresh = new.where(F.size("fields") > 0).groupBy("merged_id").agg(F.array_sort(F.flatten(F.collect_list("fields"))).alias("fields"))
    both = fresh.unionByName(old.select("merged_id", F.col("fields").cast(FIELDS).alias("fields")))
    return both.withColumn("fields", F.filter("fields", lambda f: ~f["name"].isin(*denied)))


def neighbor_pairs(edges: DataFrame, scored_ids: DataFrame) -> DataFrame:
    """(merged_id, neighbor_id): scored citation neighbours of documents without scores, either direction, each once."""
    back = edges.select(F.col("ref_id").alias("merged_id"), F.col("merged_id").alias("ref_id"))
    near = edges.select("merged_id", "ref_id").unionByName(back).withColumnRenamed("ref_id", "neighbor_id")
    known = scored_ids.select("merged_id")
    # Ends are ruled out before pairs are made distinct, so only those that count are shuffled for it.
    return near.join(known, "merged_id", "left_anti").join(known.withColumnRenamed("merged_id", "neighbor_id"), "neighbor_id", "left_semi").select("merged_id", "neighbor_id").distinct()


def neighbor_scores(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """(merged_id, neighbor_id, fields) of those pairs."""
    known = no_null_fields(scored).select(F.col("merged_id").alias("neighbor_id"), "fields")
    return neighbor_pairs(edges, scored).join(known, "neighbor_id").select("merged_id", "neighbor_id", "fields")


def imputed_from(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """(merged_id, neighbors_count, name, avg_neighbors_score, neighbors_with_field_count, score) from neighbour pairs and
    (merged_id, name, score), in which a document has a name once.

    Neighbours without a topic count as zero for it, and those without any score still count. A pair occurs once, so
    plain counts suffice where distinct ones would shuffle twice.
    """
    n = pairs.groupBy("merged_id").agg(F.count("neighbor_id").alias("neighbors_count"))
    near = scores.select(F.col("merged_id").alias("neighbor_id"), "name", "score")
    seen = pairs.join(near, "neighbor_id").groupBy("merged_id", "name").agg(F.avg("score").alias("mean"), F.count("score").alias("neighbors_with_field_count"))
    return seen.join(n, "merged_id").select(
        "merged_id",
        "neighbors_count",
        "name",
        round4("mean").alias("avg_neighbors_score"),
        "neighbors_with_field_count",
        round4(F.col("mean") * (F.col("neighbors_with_field_count") / F.col("neighbors_count"))).alias("score"),
    )


def imputed_long(neighbors: DataFrame) -> DataFrame:
    """The same from (merged_id, neighbor_id, fields)."""
    n = neighbors.groupBy("merged_id").agg(F.count("neighbor_id").alias("neighbors_count"))
    seen = (
        unnest(neighbors, "merged_id", "neighbor_id")
        .groupBy("merged_id", "name")
        .agg(F.avg("score").alias("mean"), F.count_distinct("neighbor_id").alias("neighbors_with_field_count"))
    )
    return seen.join(n, "merged_id").select(
        "merged_id",
        "neighbors_count",
        "name",
        round4("mean").alias("avg_neighbors_score"),
        "neighbors_with_field_count",
        round4(F.col("mean") * (F.col("neighbors_with_field_count") / F.col("neighbors_count"))).alias("score"),
    )


def imputed_scores(neighbors: DataFrame) -> DataFrame:
    members = F.struct("name", "avg_neighbors_score", "neighbors_with_field_count", "score")
    return imputed_long(neighbors).groupBy("merged_id", "neighbors_count").agg(F.array_sort(F.collect_list(members)).alias("fields"))


def field_long(observed: DataFrame, imputed: DataFrame, sources: DataFrame) -> DataFrame:
    """(merged_id, name, score, is_imputed) of both kinds, for documents that still have a source."""
    parts = [df.select("merged_id", "name", "score", F.lit(flag).alias("is_imputed")) for df, flag in ((observed, False), (imputed, True))]
    return parts[0].unionByName(parts[1]).join(sources.select("merged_id"), "merged_id", "left_semi")


def field_scores(observed: DataFrame, imputed: DataFrame, sources: DataFrame) -> DataFrame:
    """(merged_id, fields, is_imputed) of both kinds, for documents that still have a source."""
    pick = F.transform("fields", lambda f: F.struct(f["name"].alias("name"), f["score"].alias("score")))
    both = no_null_fields(observed).select("merged_id", "fields", F.lit(False).alias("is_imputed")).unionByName(
        imputed.where(F.size("fields") > 0).select("merged_id", pick.cast(FIELDS).alias("fields"), F.lit(True).alias("is_imputed"))
    )
    return both.join(sources.select("merged_id"), "merged_id", "left_semi")


def field_hierarchy(children: DataFrame, meta: DataFrame) -> DataFrame:
    parent = meta.select(F.col("name").alias("parent_name"), F.col("level").alias("parent_level"))
    child = meta.select(F.col("name").alias("child_name"), F.col("level").alias("child_level"))
    both = children.join(parent, "parent_name").join(child, "child_name")
    return both.select(
        F.col("parent_name").alias("normalized_name"),
        F.col("parent_name").alias("display_name"),
        "parent_level",
        F.col("child_name").alias("child_normalized_name"),
        F.col("child_name").alias("child_display_name"),
        "child_level",
    )


def ranked_long(scores: DataFrame, meta: DataFrame, top: int = 3) -> DataFrame:
    """(merged_id, level, name, score, field_rank) of each document's best positive topics by level, from long scores."""
    long = scores.where("score > 0").join(F.broadcast(meta.select("name", "level")) if meta.count() <= BROADCAST_TOPICS else meta.select("name", "level"), "name")
    best = Window.partitionBy("merged_id", "level").orderBy(F.desc("score"), "name")
    ranked = long.withColumn("field_rank", F.row_number().over(best)).where(F.col("field_rank") <= top)
    return ranked.select("merged_id", "level", "name", "score", "field_rank")


def ranked_fields(scores: DataFrame, meta: DataFrame, top: int = 3) -> DataFrame:
    return ranked_long(unnest(scores, "merged_id"), meta, top)


def top_long(scores: DataFrame, meta: DataFrame) -> DataFrame:
    """One row a document: fields by level and score, top_l0..3, top_3_l0..3 (empty where a level has none)."""
    members = F.array_sort(F.collect_list(F.struct("level", "field_rank", "name", "score")))
    return top_from(ranked_long(scores, meta).groupBy("merged_id").agg(members.alias("m")))


def top_from(rows: DataFrame) -> DataFrame:
    """The same from (merged_id, m), ranked members in order of level and rank."""
    at = lambda k: F.transform(F.filter("m", lambda x: x["level"] == k), lambda x: x["name"])
    return rows.select(
        "merged_id",
        F.transform("m", lambda x: F.struct(x["name"].alias("name"), x["level"].alias("level"), x["score"].alias("score"))).alias("fields"),
        *[F.get(at(k), 0).alias(f"top_l{k}") for k in range(4)],
        *[at(k).alias(f"top_3_l{k}") for k in range(4)],
    )


def top_fields(scores: DataFrame, meta: DataFrame) -> DataFrame:
    return top_long(unnest(scores, "merged_id"), meta)


def refreshed_corpus(now: DataFrame, before: DataFrame, prod: DataFrame) -> DataFrame:
    """The corpus of record: this run's, and earlier rows that weren't in it and still have scores in production."""
    kept = before.join(now.select("merged_id"), "merged_id", "left_anti").join(prod.select("merged_id"), "merged_id", "left_semi")
    return now.unionByName(kept)


def run(spark: SparkSession, meta, sources, edges, new, prod, fields, children, lang: str = "en") -> dict[str, DataFrame]:
    """All tables of a refresh. Tables that are read twice or more are cached; the caller unpersists them."""
    scored = en_scores(new, prod, meta, sources, lang).cache()
    near = neighbor_scores(edges, scored).cache()
    imputed = imputed_scores(near)
    final = field_scores(scored, imputed, sources).cache()
    return {
        "en_scores": scored,
        "neighbor_scores": near,
        "imputed_scores": imputed,
        "field_scores": final,
        "field_hierarchy": field_hierarchy(children, fields),
        "top_fields": top_fields(final, fields),
    }
