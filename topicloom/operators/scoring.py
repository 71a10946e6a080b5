"""Similarity, score combination and ranking."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import tokens
from topicloom.functions.vectors import dot, normed

#: Fields whose vectors are broadcast to the documents; more are joined through blocks of documents.
MAX_BROADCAST_FIELDS = 20_000
#: Entries of the topics' inverted lists that are broadcast, of some 50 bytes each.
MAX_BROADCAST_WEIGHTS = 1_000_000


def term_counts(docs: DataFrame, id_col: str, text_col: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """(id_col, term, tf); with a vocabulary (term) only its terms."""
    long = docs.select(id_col, F.explode(tokens(F.col(text_col))).alias("term")).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    return long if vocabulary is None else long.join(vocabulary.select("term"), "term", "left_semi")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, terms, tfs = [], [], []
        for i, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
            own = Counter(text.encode().split()) if text else {}  # of bytes: white space as `tokens` has it
            rows.extend([i] * len(own))
            terms.extend(own)
            tfs.extend(own.values())
        kept = b.select(list(range(b.num_columns - 1))).take(pa.array(rows, pa.int32()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64())], [*kept.schema.names, "term", "tf"])


def text_counts(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, term, tf) of each row's own cleaned text, counted where the row is; rows alike in `keys` aren't added up."""
    kept = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, text_col).mapInArrow(_counted, f"{kept}, term string, tf bigint")


def tfidf(counts: DataFrame, id_col: str, n_docs: Column | None = None, document_frequency: DataFrame | None = None) -> DataFrame:
    """(id_col, term, weight): tf * log2(N / df), of unit length by document; terms in every document weigh nothing.

    `counts` is read three times; hand in a materialised table where that matters.
    """
    df = document_frequency or counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = n_docs if n_docs is not None else counts.agg(F.count_distinct(id_col).alias("n")).scalar()
    raw = counts.join(df, "term").select(id_col, "term", (F.col("tf") * F.log2(n / F.col("df"))).alias("w")).where("w <> 0")
    total = raw.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    return raw.join(total, id_col).select(id_col, "term", (F.col("w") / F.col("len")).alias("weight"))


def sparse_cosine(docs: DataFrame, fields: DataFrame, doc_id: str, field_id: str) -> DataFrame:
    """(doc_id, field_id, similarity) of pairs that share a term, by joining the inverted lists of both sides.

    A taxonomy's lists are broadcast while they have at most MAX_BROADCAST_WEIGHTS entries, so documents stay where they
    are and a term that most texts have is no hot key; sums are partly made before the one shuffle.
    """
    a = docs.select(doc_id, "term", F.col("weight").alias("wa"))
    b = fields.select(field_id, "term", F.col("weight").alias("wb"))
    if b.count() <= MAX_BROADCAST_WEIGHTS:
        b = F.broadcast(b)
    return a.join(b, "term").groupBy(doc_id, field_id).agg(F.sum(F.col("wa") * F.col("wb")).alias("similarity"))


def frequent_terms(table: DataFrame, most: int) -> Column | None:
    """The condition on `df` of the most frequent terms of (term, df, f), of which no more than `most` entries of f, and one a
    term, are held; null where all are."""
    size = F.coalesce(F.size("f"), F.lit(0)) + 1
    octave = F.floor(F.log2("df"))
    sizes = table.groupBy(octave.alias("o")).agg(F.sum(size).alias("n")).orderBy(F.desc("o")).collect()
    if sum(r.n for r in sizes) <= most:
        return None
    total, low = 0, 64
    for r in sizes:
        total += r.n
        if total > most:
            break
        low = r.o
    return octave >= low


def with_terms(rows: DataFrame, table: DataFrame) -> DataFrame:
    """`rows` with the columns of their term's row in (term, df, f, ...), which is broadcast while it has at most
    MAX_BROADCAST_WEIGHTS entries; else the most frequent terms are, and the rows of the others are dealt by term."""
    some = frequent_terms(table, MAX_BROADCAST_WEIGHTS)
    if some is None:
        return rows.join(F.broadcast(table), "term")
    often = table.where(some)
    others = rows.join(F.broadcast(often.select("term")), "term", "left_anti").join(table.where(~some), "term")
    return rows.join(F.broadcast(often), "term").unionByName(others)


def squared_lengths(counts: DataFrame, frequency: DataFrame, n_docs: Column, doc_id: str) -> DataFrame:
    """(doc_id, squared): the squared length of a document's row in tfidf(counts) before it is brought to unit length; documents
    without weights are missing."""
    idf = frequency.select("term", "df", F.log2(n_docs / F.col("df")).alias("idf"), F.array().cast("array<int>").alias("f")).where("idf <> 0")
    w = F.col("tf") * F.col("idf")
    return with_terms(counts.select(doc_id, "term", "tf"), idf).groupBy(doc_id).agg(F.sum(w * w).alias("squared"))


def tfidf_cosine(counts: DataFrame, frequency: DataFrame, n_docs: Column, fields: DataFrame, doc_id: str, field_id: str, keep: Callable) -> DataFrame:
    """sparse_cosine of tfidf(counts) and `fields` in one pass over `counts` (doc_id, term, tf).

    A term's row has its weight and its inverted list, and lengths are divided by at the end, so documents stay where they are.
    Rows are broadcast while they have at most MAX_BROADCAST_WEIGHTS entries; of a larger vocabulary the most frequent terms'
    are, and the occurrences of the others, of which a text has few, are dealt by term.
    """
    lists = fields.groupBy("term").agg(F.collect_list(F.struct(F.col(field_id).alias("field"), F.col("weight").alias("x"))).alias("f"))
    table = keep("term-lists", lambda: frequency.join(lists, "term", "left").select("term", "df", F.log2(n_docs / F.col("df")).alias("idf"), "f").where("idf <> 0"))
    wide = with_terms(counts.select(doc_id, "term", "tf"), table).select(doc_id, "tf", "idf", "f")
    w = F.col("tf") * F.col("idf")
    own = F.struct(F.lit(None).cast(fields.schema[field_id].dataType).alias("field"), w.alias("x"))  # adds up to the squared length
    pairs = wide.select(doc_id, w.alias("w"), F.inline(F.concat(F.array(own), F.coalesce("f", F.slice(F.array(own), 1, 0)))))
    sums = pairs.groupBy(doc_id, "field").agg(F.sum(F.col("w") * F.col("x")).alias("x"))
    length = F.sqrt(F.max(F.when(F.col("field").isNull(), F.col("x"))).over(Window.partitionBy(doc_id)))
    out = sums.withColumn("length", length).where("field is not null")
    return out.select(doc_id, F.col("field").alias(field_id), (F.col("x") / F.col("length")).alias("similarity"))


def dense_cosine(docs: DataFrame, fields: DataFrame, doc_vec: str = "embedding", field_vec: str = "field_vector") -> DataFrame:
    """Every document against every field, with `similarity`. The fields are the stated query set: a taxonomy's
    vectors, packed into one array that each document is mapped over while they are few enough, else joined block
    by block."""
    n = fields.count()
    unit_docs = docs.withColumn("_d", normed(F.col(doc_vec)))
    cols = [c for c in fields.columns if c != field_vec]
    unit = fields.select(F.struct(*cols, normed(F.col(field_vec)).alias("_v")).alias("f"))
    if n <= MAX_BROADCAST_FIELDS:
        packed = unit.agg(F.collect_list("f").alias("all"))
        wide = unit_docs.withColumn("_all", packed.scalar())
        scored = F.transform("_all", lambda f: F.struct(*[f[c].alias(c) for c in cols], dot(f["_v"], F.col("_d")).alias("similarity")))
        return wide.select(*docs.columns, F.inline(scored))
    blocks = unit.withColumn("_b", F.pmod(F.xxhash64("f"), F.lit(-(-n // MAX_BROADCAST_FIELDS))))
    packed = blocks.groupBy("_b").agg(F.collect_list("f").alias("_all"))
    spread = unit_docs.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(-(-n // MAX_BROADCAST_FIELDS) - 1).cast("long"))))
    scored = F.transform("_all", lambda f: F.struct(*[f[c].alias(c) for c in cols], dot(f["_v"], F.col("_d")).alias("similarity")))
    return spread.join(packed, "_b").select(*docs.columns, F.inline(scored))


def combine(mode: str, *similarities: Column) -> Column:
    """One score from several similarities.

    "mean": of those that aren't null. "positive": of those above 0, null if there are none. "unit": of those within
    [0, 1], zeros counting, 0 if there are none; this is the mode of production.
    """
    tests = {
        "mean": lambda s: s.isNotNull(),
        "positive": lambda s: F.coalesce(s > 0, F.lit(False)),
        "unit": lambda s: F.coalesce((s >= 0) & (s <= 1), F.lit(False)),
    }
    ok = [tests[mode](s) for s in similarities]
    total = sum((F.when(t, s).otherwise(0.0) for t, s in zip(ok, similarities, strict=True)), F.lit(0.0))
    n = sum((t.cast("int") for t in ok), F.lit(0))
    return F.when(n > 0, total / n).otherwise(F.lit(0.0) if mode == "unit" else F.lit(None).cast("double"))


def rank_per_level(scores: DataFrame, id_col: str = "merged_id", top: int = 10) -> DataFrame:
    """(id_col, level, name, score, rank): the best of each level, NaN and null as 0, zeros left out before rounding."""
    clean = scores.withColumn("score", F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0)))
    best = Window.partitionBy(id_col, "level").orderBy(F.desc("score"), "name")
    out = clean.withColumn("rank", F.row_number().over(best)).where((F.col("rank") <= top) & (F.col("score") != 0))
    return out.select(id_col, "level", "name", F.round("score", 4).alias("score"), "rank")


def two_hop(children: DataFrame) -> DataFrame:
    """(l0, l1, descendant): parent, child and grandchild along the edges."""
    top = children.select(F.col("parent_name").alias("l0"), F.col("child_name").alias("l1"))
    below = children.select(F.col("parent_name").alias("l1"), F.col("child_name").alias("descendant"))
    return top.join(below, "l1").select("l0", "l1", "descendant")


def constraints(children: DataFrame, meta: DataFrame) -> DataFrame:
    """The two-hop rows that start at level 0; a pair (l0, l1) opens the topics listed for it."""
    roots = meta.where(F.col("level") == 0).select(F.col("name").alias("l0"))
    return two_hop(children).join(roots, "l0", "left_semi").distinct()


def constrained_scores(scores: DataFrame, meta: DataFrame, children: DataFrame, top: int = 3, emit: int = 10) -> DataFrame:
    """(merged_id, level, name, score, rank): levels 0 and 1 as they rank; levels 2 and 3 only for topics below one of
    the document's best `top` pairs of level 0 and level 1.

    A score of levels 2 and 3 looks up the pairs that open its topic, so a document meets its own topics only and not all that
    lie below its pairs.
    """
    upper = scores.where("level <= 1")
    best = Window.partitionBy("merged_id", "level").orderBy(F.desc("score"), "name")
    tops = upper.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top)
    l0 = tops.where("level = 0").select("merged_id", F.col("name").alias("l0"))
    l1 = tops.where("level = 1").select("merged_id", F.col("name").alias("l1"))
    below, opened = scores.where("level >= 2"), constraints(children, meta).withColumnRenamed("descendant", "name")
    asked = below.select("merged_id", "name").join(opened, "name")
    allowed = asked.join(l0.join(l1, "merged_id"), ["merged_id", "l0", "l1"], "left_semi").select("merged_id", "name").distinct()
    lower = below.join(allowed, ["merged_id", "name"], "left_semi")
    return rank_per_level(upper.unionByName(lower.select(*upper.columns)), "merged_id", emit)
