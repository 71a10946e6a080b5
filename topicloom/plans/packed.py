"""The score chain with one row a document: (merged_id, topics array<int>, scores array<float>), entries side by side.

A topic is its place in the order of (level, name), so places compare as names do and a level is a range of places. Scores
have four digits, which a float holds and `exact` gives back. Long rows with names arise only where a result is published;
what is shuffled is a document's row, an edge or the row of a neighbour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions import bits, folds
from topicloom.operators.scoring import constraints
from topicloom.plans.pipeline import HALF, language_meta, round4

SCALE = 10_000.0


def exact(score: Column) -> Column:
    return F.rint(score.cast("double") * SCALE) / SCALE


def topic_table(meta: DataFrame) -> DataFrame:
    """(topic, name, level, copies): topics numbered from 0; `copies` counts the rows of a name in its level."""
    one = meta.groupBy("level", "name").agg(F.count(F.lit(1)).alias("copies"))
    place = F.row_number().over(Window.orderBy("level", "name"))  # a taxonomy's topics fit in one task
    return one.select((place - 1).cast("int").alias("topic"), "name", "level", "copies")


class Topics:
    """A kept topic table: names by place as one array, some 35 bytes a topic, and the range of places of each level."""

    def __init__(self, table: DataFrame):
        self.table = table
        self._names = table.agg(F.transform(F.array_sort(F.collect_list(F.struct("topic", "name"))), lambda t: t["name"]).alias("names"))
        rows = table.groupBy("level").agg(F.min("topic").alias("low"), F.max("topic").alias("high"), F.max("copies").alias("copies")).orderBy("level").collect()
        self.ranges = {r["level"]: (r["low"], r["high"]) for r in rows}
        self.distinct = all(r["copies"] == 1 for r in rows) and table.count() == table.select("name").distinct().count()

    def name(self, topic: Column) -> Column:
        return F.get(self._names.scalar(), topic)

    def level(self, topic: Column) -> Column:
        out = F.lit(None).cast("int")
        for level, (low, high) in self.ranges.items():
            out = F.when(topic.between(low, high), level).otherwise(out)
        return out

    def places(self, names) -> list[int]:
        return [r.topic for r in self.table.where(F.col("name").isin(*names)).select("topic").collect()]


def pack(lines: DataFrame, levels: list[str], denied: list[int] | None = None) -> DataFrame:
    """(merged_id, topics, scores) from lines (merged_id, a topic of each level, w) dealt by merged_id, each topic once a
    document: its share of the document's total. Topics in `denied` have no entry; their documents stay.

    Lines are sorted and folded in place: neither an entry nor a document's lines are gathered by an aggregate.
    """
    kind = lines.schema["merged_id"].dataType.simpleString()
    narrow = lines.select("merged_id", *levels, F.col("w").cast("double")).sortWithinPartitions("merged_id")
    return narrow.mapInArrow(folds.shares(len(levels), denied or []), f"merged_id {kind}, topics array<int>, scores array<float>")


def entries(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, topic, score), one row an entry."""
    e = docs.select(*keys, F.inline(F.arrays_zip(F.col("topics").alias("topic"), F.col("scores").alias("score"))).alias("topic", "score"))
    return e.withColumn("score", exact(F.col("score")))


def merged_ids(new_ids: DataFrame, prod_ids: DataFrame, meta: DataFrame, sources: DataFrame, lang: str = "en") -> DataFrame:
    """(merged_id) of the merged scores, where new and old scores of a document are rows of one table: it is scored anew, or
    it has old scores and is still in the language."""
    in_lang = language_meta(meta, sources, lang).select("merged_id")
    return new_ids.select("merged_id").union(prod_ids.select("merged_id").join(in_lang, "merged_id", "left_semi")).distinct()


def open_edges(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """(merged_id, neighbor_id): edges of documents without scores in either direction, as often as they occur."""
    near = edges.select(F.explode(F.array(F.struct("merged_id", "ref_id"), F.struct(F.col("ref_id").alias("merged_id"), F.col("merged_id").alias("ref_id")))).alias("e"))
    near = near.select(F.col("e.merged_id").alias("merged_id"), F.col("e.ref_id").alias("neighbor_id"))
    return near.join(scored.select("merged_id"), "merged_id", "left_anti")


def near_pairs(edges: DataFrame, words: DataFrame, *flags: str) -> DataFrame:
    """(merged_id, neighbor_id, flags): the edges with one scored end, from the other to it, as often as they occur. Ends are
    looked up in `words`, the bits of scored documents with their flags, so no edge is dealt."""
    sets = {"known": "known", **{f: f for f in flags}}
    out = bits.flagged(edges, "merged_id", words, **{f"_a_{k}": s for k, s in sets.items()})
    out = bits.flagged(out, "ref_id", words, **{f"_b_{k}": s for k, s in sets.items()}).where(F.col("_a_known") != F.col("_b_known"))
    first = F.col("_a_known")
    return out.select(
        F.when(first, F.col("ref_id")).otherwise(F.col("merged_id")).alias("merged_id"),
        F.when(first, F.col("merged_id")).otherwise(F.col("ref_id")).alias("neighbor_id"),
        *[F.when(first, F.col(f"_a_{f}")).otherwise(F.col(f"_b_{f}")).alias(f) for f in flags],
    )


def neighbors(edges: DataFrame, scored: DataFrame, *columns: str | Column, words: DataFrame | None = None, of: DataFrame | None = None) -> DataFrame:
    """(merged_id, neighbor_id, columns of the neighbour's row): scored neighbours of documents without scores, each once; with
    `of` (merged_id) only of these documents.

    Edges are dealt by neighbour once, for both the distinct pairs and the join.
    """
    known = scored.select(F.col("merged_id").alias("neighbor_id"), *columns)
    pairs = open_edges(edges, scored) if words is None else near_pairs(edges, words)
    pairs = pairs if of is None else pairs.join(of, "merged_id", "left_semi")
    return pairs.repartition("neighbor_id").distinct().join(known, "neighbor_id").select("merged_id", *known.columns)


def known_neighbors(edges: DataFrame, scored: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """The rows of `open_edges` whose neighbour is in `scored`, as often as they occur: for what asks who and not what."""
    if words is not None:
        return near_pairs(edges, words)
    return open_edges(edges, scored).join(scored.select(F.col("merged_id").alias("neighbor_id")), "neighbor_id", "left_semi")


def imputed_pairs(edges: DataFrame, scored: DataFrame, of: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """(merged_id, neighbor_id) of neighbours with topics, as often as they occur, for documents in `of` (merged_id); a
    document with one has imputed entries. `words` need the flag filled."""
    if words is not None:
        open_ = near_pairs(edges, words, "filled").where("filled").drop("filled")
        return open_ if of is None else open_.join(of, "merged_id", "left_semi")
    filled = scored.where(F.size("topics") > 0).select(F.col("merged_id").alias("neighbor_id"))
    open_ = open_edges(edges, scored)
    return (open_ if of is None else open_.join(of, "merged_id", "left_semi")).join(filled, "neighbor_id", "left_semi")


#: A document with a neighbour whose score for a topic is at least this, ...
STRONG = 0.1
#: ... with so many neighbours at most, and none of whose scores is null or below zero, has a score above half of 0.0001 for
#: that topic, hence a positive one when it is rounded.
STRONG_NEIGHBORS = 1000


def scored_words(scored: DataFrame, keep: Callable) -> DataFrame | None:
    """The bits of scored documents, with flags: has it topics, has it a strong score, has it one that is null or below zero."""
    e = F.arrays_zip("topics", "scores")
    flags = {
        "filled": F.size("topics") > 0,
        "strong": F.exists(e, lambda x: x["topics"].isNotNull() & F.coalesce(x["scores"] >= STRONG, F.lit(False))),
        "odd": F.exists("scores", lambda s: s.isNull() | (s < 0)),
    }
    return bits.words(scored, "merged_id", keep, "scored-words", **{k: F.coalesce(c, F.lit(k == "odd")) for k, c in flags.items()})


def marked(docs: DataFrame) -> DataFrame:
    """(merged_id, filled, top): has it topics, and a positive score; every place stands for a topic of the taxonomy, so it
    has a top then."""
    top = F.exists(F.arrays_zip("topics", "scores"), lambda e: e["topics"].isNotNull() & (e["scores"] > 0))
    return docs.select("merged_id", (F.size("topics") > 0).alias("filled"), F.coalesce(top, F.lit(False)).alias("top"))


def imputed_marks(edges: DataFrame, scored: DataFrame, words: DataFrame | None, keep: Callable) -> DataFrame:
    """`marked` of imputed documents. Their neighbours' bits settle all but a few, and the scores of these few are imputed."""
    if words is None:
        return keep("imputed-marks", lambda: marked(imputed_docs(neighbors(edges, scored, "topics", "scores"))))

    def build() -> DataFrame:
        pairs = near_pairs(edges, words, "filled", "strong", "odd")
        return pairs.groupBy("merged_id").agg(F.count(F.lit(1)).alias("n"), *[F.bool_or(f).alias(f) for f in ("filled", "strong", "odd")])

    rows = keep("neighbor-marks", build)
    # An edge without an identifier stands for no document that is published.
    settled = F.col("merged_id").isNull() | ~F.col("filled") | (F.col("strong") & ~F.col("odd") & (F.col("n") <= STRONG_NEIGHBORS))
    out, few = rows.where(settled).select("merged_id", "filled", F.col("filled").alias("top")), rows.where(~settled).select("merged_id")
    if few.isEmpty():
        return out
    near = neighbors(edges, scored, "topics", "scores", words=words, of=few)
    return out.unionByName(keep("imputed-marks", lambda: marked(imputed_docs(near))))


def _dealt(near: DataFrame) -> DataFrame:
    """A neighbour's row is dealt by document once."""
    return near.select("merged_id", "topics", "scores").repartition("merged_id").sortWithinPartitions("merged_id")


def imputed(near: DataFrame) -> DataFrame:
    """(merged_id, neighbors_count, e array<struct<topic, mean, n>>) from (merged_id, topics, scores) of the neighbours,
    of which those without a topic count too."""
    kind = near.schema["merged_id"].dataType.simpleString()
    return _dealt(near).mapInArrow(folds.neighbour_means(), f"merged_id {kind}, neighbors_count bigint, e array<struct<topic:int,mean:double,n:bigint>>")


def imputed_docs(near: DataFrame) -> DataFrame:
    """(merged_id, topics, scores) of the same documents, with the scores of `imputed_long`."""
    kind = near.schema["merged_id"].dataType.simpleString()
    return _dealt(near).mapInArrow(folds.neighbour_scores(HALF), f"merged_id {kind}, topics array<int>, scores array<float>")


def imputed_score(mean: Column, n: Column) -> Column:
    return round4(mean * (n / F.col("neighbors_count")))


def imputed_long(rows: DataFrame, topics: Topics) -> DataFrame:
    """The columns of pipeline.imputed_from."""
    long = rows.select("merged_id", "neighbors_count", F.inline("e"))
    return long.select(
        "merged_id", "neighbors_count", topics.name(F.col("topic")).alias("name"), round4("mean").alias("avg_neighbors_score"),
        F.col("n").alias("neighbors_with_field_count"), imputed_score(F.col("mean"), F.col("n")).alias("score"),
    )


def field_docs(observed: DataFrame, rows: DataFrame, sources: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(merged_id, topics, scores, is_imputed) of both kinds, `rows` as of `imputed_docs`, for documents that still have a
    source; with `words`, the bits of these, no row is dealt. An imputed document has entries; an observed one may have none."""
    of = rows.where(F.size("topics") > 0).withColumn("is_imputed", F.lit(True))
    return sourced(observed.select("merged_id", "topics", "scores", F.lit(False).alias("is_imputed")), sources, words).unionByName(sourced(of, sources, words))


def sourced(docs: DataFrame, sources: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """The rows of documents that have a source."""
    if words is None:
        return docs.join(sources.select("merged_id"), "merged_id", "left_semi")
    return bits.flagged(docs, "merged_id", words, _sourced="known").where("_sourced").drop("_sourced")


def best(topics: Topics, level: int, top: int, positive: bool = True) -> Column:
    """array<struct<neg, topic>> of a document's best entries of a level, by score and then by name."""
    low, high = topics.ranges[level]
    both = F.transform(F.arrays_zip(F.col("topics").alias("topic"), F.col("scores").alias("score")), lambda e: F.struct((-exact(e["score"])).alias("neg"), e["topic"].alias("topic")))
    return F.slice(F.array_sort(F.filter(both, lambda e: e["topic"].between(low, high) & ((e["neg"] < 0) if positive else F.lit(True)))), 1, top)


def ranked(docs: DataFrame, topics: Topics, top: int = 3) -> DataFrame:
    """(merged_id, m array<struct<level, field_rank, name, score>>) of the best positive topics by level, in order of level and
    rank; documents without one are left out. Names must be distinct."""
    firsts = docs.select("merged_id", *[best(topics, k, top).alias(f"_b{k}") for k in topics.ranges])
    at = [(k, i) for k in topics.ranges for i in range(top)]
    # Names are columns of their own first: a subquery isn't allowed in the arguments of a lambda's function.
    named = firsts.select("*", *[topics.name(F.get(f"_b{k}", F.lit(i))["topic"]).alias(f"_n{k}_{i}") for k, i in at])
    members = []
    for k, i in at:
        e = F.get(f"_b{k}", F.lit(i))
        row = F.struct(F.lit(k).alias("level"), F.lit(i + 1).alias("field_rank"), F.col(f"_n{k}_{i}").alias("name"), (-e["neg"]).alias("score"))
        members.append(F.when(e.isNotNull(), row))
    return named.select("merged_id", F.filter(F.array(*members), lambda x: x.isNotNull()).alias("m")).where(F.size("m") > 0)


def ranked_long(docs: DataFrame, topics: Topics, top: int = 3) -> DataFrame:
    return ranked(docs, topics, top).select("merged_id", F.inline("m")).select("merged_id", "level", "name", "score", "field_rank")


def constrained_scores(docs: DataFrame, topics: Topics, children: DataFrame, meta: DataFrame, keep: Callable, top: int = 3, emit: int = 10) -> DataFrame:
    """scoring.constrained_scores inside a document's row: an entry of levels 2 and 3 looks up the pairs that open its topic,
    so no document is multiplied by what lies below its pairs. Pairs by place are one array, some 40 bytes a topic."""
    place = topics.table.select("name", "topic")
    opened = constraints(children, meta)
    for c in ("l0", "l1", "descendant"):
        opened = opened.join(place.select(F.col("name").alias(c), F.col("topic").alias(f"_{c}")), c)
    pairs = opened.where(F.col("_l1").between(*topics.ranges[1])).groupBy(F.col("_descendant").alias("topic")).agg(F.collect_list(F.struct("_l0", "_l1")).alias("pairs"))
    table = keep("opening-pairs", lambda: topics.table.select("topic").join(pairs, "topic", "left"))
    array = table.agg(F.transform(F.array_sort(F.collect_list(F.struct("topic", "pairs"))), lambda t: t["pairs"]).alias("pairs"))
    # A document's row is dealt, so that its entries are sorted without a shuffle.
    firsts = docs.repartition("merged_id").select("*", *[F.transform(best(topics, k, top, False), lambda e: e["topic"]).alias(f"_top{k}") for k in (0, 1)])
    long = entries(firsts, "merged_id", "_top0", "_top1").withColumn("level", topics.level(F.col("topic")))
    opened_by = long.withColumn("_pairs", F.when(F.col("level") >= 2, F.get(array.scalar(), F.col("topic"))))
    is_open = F.exists("_pairs", lambda p: F.array_contains("_top0", p["_l0"]) & F.array_contains("_top1", p["_l1"]))
    own = opened_by.where((F.col("level") <= 1) | is_open).select("merged_id", "level", "topic", "score")
    # Places compare as names do.
    by = Window.partitionBy("merged_id", "level").orderBy(F.desc("score"), "topic")
    rank = own.withColumn("rank", F.row_number().over(by)).where((F.col("rank") <= emit) & (F.col("score") != 0))
    return rank.select("merged_id", "level", topics.name(F.col("topic")).alias("name"), "score", "rank")
