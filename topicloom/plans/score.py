"""From texts to scores: three embeddings of documents and topics, and scores of lower topics only where upper ones open them.

A text's embeddings are the mean of its words' vectors, its tf-idf weights, and the sum of the vectors of the entities it
mentions. A topic's are the same of its own text. The score of a document for a topic is the mean of the three
similarities that lie within [0, 1].
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions import match, similar
from topicloom.functions.text import format_name
from topicloom.functions.vectors import MAX_BROADCAST_VECTORS, dot
from topicloom.operators.scoring import MAX_BROADCAST_FIELDS, MAX_BROADCAST_WEIGHTS, combine, constraints, rank_per_level, squared_lengths, term_counts, text_counts, tfidf
from topicloom.plans.analysis import entity_vectors, mention_counts, sentence_vectors

#: A table that is read more than once: (name, build) to a DataFrame.
Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]
#: Similarities are settled at this digit before they are combined, so that ranks don't hang on the order of addition.
DIGITS = 6


def settle(x: Column) -> Column:
    return F.round(x + 10.0 ** -(DIGITS + 3), DIGITS)


@dataclass
class Embedded:
    """(id, vector), (id, term, weight) and (id, vector); texts without known words or mentions are missing."""

    dense: DataFrame
    sparse: DataFrame
    entity: DataFrame


@dataclass
class Models:
    """Word vectors (term, vector), entity vectors (mention, vector) with their mentions, and document frequencies (term,
    df) over n texts."""

    words: DataFrame
    entities: DataFrame
    mentions: list[str]
    frequency: DataFrame
    n: Column


def embed(texts: DataFrame, models: Models, name: str, keep: Keep) -> Embedded:
    """`texts` is (id, text), cleaned."""
    counts = keep(f"{name}-counts", lambda: term_counts(texts, "id", "text"))
    found = texts.select("id", match.find_terms(F.col("text"), models.mentions).alias("found"))
    return Embedded(
        keep(f"{name}-dense", lambda: sentence_vectors(counts, models.words, "id").withColumnRenamed("embedding", "vector")),
        keep(f"{name}-sparse", lambda: tfidf(counts, "id", models.n, models.frequency)),
        keep(f"{name}-entity", lambda: entity_vectors(mention_counts(found, "id", "found"), models.entities, "id")),
    )


def field_texts(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """(index, name, level, text): the topics that have text, in the row order of their matrices.

    `pages` is (display_name, text). Names are formatted first; pages without text, pages of topics that `meta` doesn't
    know and second pages of a name are left out, the first in order of text being the one that counts.
    """
    named = pages.select(format_name(F.col("display_name")).alias("name"), "text").where(F.length(F.trim("text")) > 0)
    one = named.groupBy("name").agg(F.min("text").alias("text")).join(meta.select("name", "level"), "name")
    place = F.row_number().over(Window.orderBy("level", "name"))  # a taxonomy's topics fit in one task
    return one.select((place - 1).cast("long").alias("index"), "name", "level", "text")


def missing_topics(fields: DataFrame, meta: DataFrame) -> DataFrame:
    """Topics without text; before a release there must be none."""
    return meta.join(fields.select("name"), "name", "left_anti").select("name", "level")


def require_distinct(df: DataFrame, key: str) -> DataFrame:
    """`df`, unless a value of `key` occurs twice: then the call fails."""
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(key).limit(5).collect()
    if again:
        raise ValueError(f"{key} occurs more than once: {', '.join(str(r[0]) for r in again)}")
    return df


def titles_to_topics(pages: DataFrame, titles: list[str]) -> DataFrame:
    """(mention, name): every title in lower case to its topic; of several topics the first by name counts."""
    long = pages.select(format_name(F.col("display_name")).alias("name"), F.explode(F.array(*titles)).alias("title"))
    return long.where("title is not null").groupBy(F.lower("title").alias("mention")).agg(F.min("name").alias("name"))


def first_title(titles: list[str]) -> Column:
    return F.coalesce(*titles)


def topic_entity_vectors(pages: DataFrame, titles: list[str], vectors: DataFrame, exclude_self: bool = False) -> DataFrame:
    """(name, title, vector): a topic's entity vector is the unit sum of the vectors of the topics whose titles its text
    mentions, as often as it does. `pages` is (display_name, text, titles...), `vectors` is (name, vector).

    The first title that isn't null keys the matcher; mentions of any title count. With `exclude_self` mentions of the
    topic's own titles don't. A topic without title or without text, or that mentions none, has zeros.
    """
    own = pages.withColumn("name", format_name(F.col("display_name"))).withColumn("title", first_title(titles))
    lookup = titles_to_topics(pages, titles)
    mentions = [r.mention for r in lookup.select("mention").collect()]  # one for each title of the taxonomy
    readable = own.where("title is not null and text is not null")
    found = readable.select("name", F.explode(match.find_terms(F.lower("text"), mentions)).alias("mention"))
    if exclude_self:
        mine = own.select("name", F.explode(F.array(*titles)).alias("t")).where("t is not null").select("name", F.lower("t").alias("mention")).distinct()
        found = found.join(mine, ["name", "mention"], "left_anti")
    counts = found.join(lookup.withColumnRenamed("name", "target"), "mention").groupBy("name", "target").agg(F.count(F.lit(1)).alias("n"))
    known = vectors.select(F.col("name").alias("mention"), "vector")
    summed = entity_vectors(counts.withColumnRenamed("target", "mention"), known, "name")
    zero = vectors.select(F.transform("vector", lambda x: F.lit(0.0)).alias("z")).limit(1)
    return own.select("name", "title").join(summed, "name", "left").select("name", "title", F.coalesce("vector", zero.scalar()).alias("vector"))


def similarities(pairs: DataFrame, docs: Embedded, fields: Embedded) -> DataFrame:
    """(id, name, dense, sparse, entity) of the given pairs (id, name) and no others; what a text lacks is similar to nothing.

    The topics' side is broadcast while it is small, so pairs with a text's vectors or terms are multiplied out in place and
    only their similarities are shuffled.
    """

    def vectors(part: str) -> DataFrame:
        left = getattr(docs, part).select("id", F.col("vector").alias("v"))
        right = getattr(fields, part).select(F.col("id").alias("name"), F.col("vector").alias("w"))
        return pairs.join(left, "id").join(small(right, MAX_BROADCAST_VECTORS), "name").select("id", "name", dot(F.col("v"), F.col("w")).alias(part))

    a = docs.sparse.select("id", "term", F.col("weight").alias("v"))
    b = fields.sparse.select(F.col("id").alias("name"), "term", F.col("weight").alias("w"))
    shared = pairs.join(a, "id").join(small(b, MAX_BROADCAST_WEIGHTS), ["name", "term"]).groupBy("id", "name").agg(F.sum(F.col("v") * F.col("w")).alias("sparse"))
    out = pairs
    for part, table in (("dense", vectors("dense")), ("sparse", shared), ("entity", vectors("entity"))):
        out = out.join(table, ["id", "name"], "left").withColumn(part, settle(F.coalesce(part, F.lit(0.0))))
    return out


def small(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def averaged(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", settle(combine("unit", *[F.col(c) for c in ("dense", "sparse", "entity")])))


def pairs_with(ids: DataFrame, topics: DataFrame) -> DataFrame:
    """Every id with every topic; topics are a taxonomy's, held as one array."""
    names = topics.agg(F.array_sort(F.collect_list("name")).alias("names"))
    return ids.select("id", F.explode(names.scalar()).alias("name"))


def _matrix(rows: list, key: str) -> tuple[dict[str, int], list[list[float]]] | None:
    """The row of each key and the vectors; None unless all have one length and every element, and no key occurs twice."""
    place, vectors = {r[key]: i for i, r in enumerate(rows)}, [r.vector for r in rows]
    if len(place) < len(rows) or any(v is None or len(v) != len(vectors[0]) or None in v for v in vectors):
        return None
    return place, vectors


def _few(df: DataFrame, most: int) -> list | None:
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None


def held(meta: DataFrame, fields: Embedded, models: Models) -> tuple[similar.Texts, similar.Topics] | None:
    """What every task holds to embed texts and to compare them with the topics (name, level); None where that is more than is
    broadcast, or vectors are of several lengths."""
    names = _few(meta, MAX_BROADCAST_FIELDS)
    tables = [_few(df.select(key, "vector"), MAX_BROADCAST_VECTORS) for df, key in ((models.words, "term"), (models.entities, "mention"), (fields.dense, "id"), (fields.entity, "id"))]
    weights = None if names is None or None in tables else _few(fields.sparse, MAX_BROADCAST_WEIGHTS)
    if weights is None:
        return None
    words, entities, dense, entity = matrices = [_matrix(t, k) for t, k in zip(tables, ("term", "mention", "id", "id"), strict=True)]
    if None in matrices:
        return None
    sizes = [len(v[0]) if v else 0 for _, v in (words, entities)]
    if any(v and len(v[0]) != n for (_, v), n in zip((dense, entity), sizes, strict=True)):
        return None
    names = sorted(names, key=lambda r: (r.level, r.name.encode()))
    number = {r.name: i for i, r in enumerate(names)}

    def by_topic(place: dict, vectors: list, n: int) -> np.ndarray:
        out = np.zeros((len(names), n))
        for name, i in place.items():
            if name in number:
                out[number[name]] = vectors[i]
        return out

    own = fields.sparse.select("term").distinct()
    idf = {r.term: r.idf for r in models.frequency.join(F.broadcast(own), "term").select("term", F.log2(models.n / F.col("df")).alias("idf")).collect()}
    terms = {t: i for i, t in enumerate(sorted(idf))}
    entries = sorted((terms[r.term], number[r.id], r.weight) for r in weights if r.id in number and r.term in terms)
    starts = np.searchsorted(np.array([e[0] for e in entries], dtype=np.int64), np.arange(len(terms) + 1))
    texts = similar.Texts(
        {t.encode(): i for t, i in words[0].items()}, similar.unit(np.array(words[1], dtype=float).reshape(len(words[1]), sizes[0])),
        models.mentions, entities[0], np.array(entities[1], dtype=float).reshape(len(entities[1]), sizes[1]),
        {t.encode(): i for t, i in terms.items()}, np.array([idf[t] for t in terms], dtype=float),
    )
    topics = similar.Topics(
        [r.name for r in names], np.array([r.level for r in names], dtype=np.int64), by_topic(*dense, sizes[0]), by_topic(*entity, sizes[1]),
        starts, np.array([e[1] for e in entries], dtype=np.int64), np.array([e[2] for e in entries], dtype=float), DIGITS,
    )
    return texts, topics


def embedded(texts: DataFrame, models: Models, by: similar.Texts, keep: Keep, counts: DataFrame | None = None) -> DataFrame:
    """(id, dense, entity, terms, weights), a row a text: its vectors and its tf-idf weights of the topics' terms. `texts` are
    cleaned and identifiers distinct; `counts` (id, term, tf) are theirs where they are known."""
    kind = texts.schema["id"].dataType.simpleString()

    def build() -> DataFrame:
        own = text_counts(texts, ["id"], "text") if counts is None else counts
        lengths = squared_lengths(own, models.frequency, models.n, "id")
        return texts.select("id", "text").join(lengths, "id", "left").mapInArrow(by.embed, f"id {kind}, {similar.EMBEDDED}")

    return keep("docs-embedded", build)


def all_similarities(texts: DataFrame, fields: DataFrame, topics: DataFrame, models: Models, keep: Keep, counts: DataFrame | None = None) -> DataFrame:
    """(id, name, dense, sparse, entity) of every text with every topic of `topics` (name, level)."""
    f = embed(fields.select(F.col("name").alias("id"), "text"), models, "topics", keep)
    in_place = held(topics.select("name", "level"), f, models)
    if in_place is None:
        return similarities(pairs_with(texts.select("id"), topics), embed(texts, models, "docs", keep), f)
    docs = embedded(texts, models, in_place[0], keep, counts)
    return docs.mapInArrow(similar.similar(in_place[1]), f"id {texts.schema['id'].dataType.simpleString()}, {similar.SIMILAR}")


def score_corpus(
    texts: DataFrame, fields: DataFrame, children: DataFrame, models: Models, keep: Keep, top: int = 3, emit: int = 10, constrained: bool = True, counts: DataFrame | None = None
) -> DataFrame:
    """(id, level, name, score, rank) of `texts` (id, text) against `fields` (name, level, text).

    Levels 0 and 1 are scored for every document. Of levels 2 and 3 only topics below one of the document's best `top`
    pairs of level 0 and level 1 are, before any similarity is computed; zeros can be among the best. Names of topics must
    be distinct. With `constrained` off every topic is scored.

    A text is embedded once and compared where its row is, with a taxonomy that every task holds; a larger one is joined.
    """
    require_distinct(fields, "name")
    f = embed(fields.select(F.col("name").alias("id"), "text"), models, "fields", keep)
    in_place = held(fields.select("name", "level"), f, models)
    if in_place is None:
        return _scored_by_joins(texts, fields, children, models, f, keep, top, emit, constrained)
    by, topics = in_place
    docs, kind = embedded(texts, models, by, keep, counts), f"id {texts.schema['id'].dataType.simpleString()}, {similar.RANKED}"
    if not constrained:
        return docs.mapInArrow(similar.best_topics(topics, emit), kind)
    opened: dict[tuple[str, str], list[str]] = {}
    for r in constraints(children, fields.select("name", "level")).collect():
        opened.setdefault((r.l0, r.l1), []).append(r.descendant)
    upper = docs.mapInArrow(similar.best_topics(topics.only(topics.levels <= 1), emit), kind)
    return upper.unionByName(keep("allowed-pairs", lambda: docs.mapInArrow(similar.best_opened(topics, opened, top, emit), kind)))


def _scored_by_joins(texts: DataFrame, fields: DataFrame, children: DataFrame, models: Models, f: Embedded, keep: Keep, top: int, emit: int, constrained: bool) -> DataFrame:
    d = embed(texts, models, "docs", keep)
    ids, meta = texts.select("id"), fields.select("name", "level")
    upper = averaged(similarities(pairs_with(ids, meta.where("level <= 1") if constrained else meta), d, f)).join(meta, "name")
    upper = keep("upper-scores", lambda: upper.select("id", "level", "name", "score"))
    if not constrained:
        return rank_per_level(upper, "id", emit)
    best = Window.partitionBy("id", "level").orderBy(F.desc("score"), "name")
    tops = upper.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top)
    l0 = tops.where("level = 0").select("id", F.col("name").alias("l0"))
    l1 = tops.where("level = 1").select("id", F.col("name").alias("l1"))
    below = meta.where("level >= 2").select("name")
    allowed = l0.join(l1, "id").join(constraints(children, meta), ["l0", "l1"]).select("id", F.col("descendant").alias("name")).distinct().join(below, "name", "left_semi")
    lower = averaged(similarities(keep("allowed-pairs", lambda: allowed), d, f)).join(meta, "name")
    return rank_per_level(upper.unionByName(lower.select(*upper.columns)), "id", emit)


def score_text(spark: SparkSession, text: str, fields: DataFrame, children: DataFrame, models: Models, keep: Keep) -> dict[str, float]:
    """Scores of one text by topic name."""
    one = spark.createDataFrame([("text", text)], "id string, text string")
    n = fields.count()
    return {r.name: r.score for r in score_corpus(one, fields, children, models, keep, emit=n, constrained=False).collect()}


def score_output(scores: DataFrame, parts: tuple[str, ...] = (), average: bool = True, precision: int = 4, nested: bool = False) -> DataFrame:
    """One row a document from (id, name, dense, sparse, entity, score): (merged_id, fields) as an array of (name, score)
    if `nested`, else maps by name, one for each similarity in `parts` and, unless left out, the average as `fields`."""
    rounded = lambda c: F.round(F.col(c) + 1e-9, precision)
    if nested:
        out = F.array_sort(F.collect_list(F.struct("name", F.col("score"))))
        return scores.groupBy(F.col("id").alias("merged_id")).agg(out.alias("fields"))
    columns = {**{p: p for p in parts}, **({"fields": "score"} if average else {})}
    if not columns:
        raise ValueError("neither a similarity nor the average is asked for")
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", rounded(c))))).alias(k) for k, c in columns.items()]
    return scores.groupBy(F.col("id").alias("merged_id")).agg(*maps)
