"""Benchmark decontamination by a broadcast hash set of test n-grams, in DataFrame operations only.

Benchmark texts become a set of normalised n-grams. Every window of every document is looked up in
a bit array made from that set, by the words at its ends; windows that pass are written out as text and joined with the
set itself, so a hit is verified word for word. The set is broadcast while it has at most `max_broadcast_grams` members;
beyond that the same join is shuffled. The bit array is a scalar of 2**bits_log2 bits, a filter without misses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import key_filter, key_hash, materialize, own_names, with_filter_flag, without_keys

#: What parts words: all of ASCII but digits and letters. All that is not ASCII belongs to words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
MAX_BROADCAST_GRAMS = 200_000
#: A document is contaminated when its hit words are one in this many, or more.
ONE_IN = 20


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


def gram_set(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct (gram, ends, gram_words, item): windows of n words, or the whole item if it has fewer, and the hash of
    the window's first and last word."""
    item = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w"))
    item = item.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(n)))
    at = item.select("item", "w", "len", F.explode(F.expr("sequence(1, size(w) - len + 1)")).alias("i"))
    part = F.slice("w", F.col("i"), F.col("len"))
    ends = F.expr("xxhash64(w[i - 1], w[i + len - 2])")
    return at.select(F.array_join(part, " ").alias("gram"), ends.alias("ends"), F.col("len").alias("gram_words"), "item").distinct()


def _bit_array(grams: DataFrame, bits_log2: int) -> DataFrame:
    """One row: an array of 2**(bits_log2 - 6) longs with the bit of every window's ends set."""
    size = 1 << (bits_log2 - 6)
    own = grams.select(
        F.expr(f"cast(shiftright(ends, 6) & {size - 1}L as int)").alias("at"), F.expr("shiftleft(1L, cast(ends & 63 as int))").alias("bit")
    )
    empty = grams.sparkSession.range(size).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bit"))
    words = own.unionByName(empty).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    return words.agg(F.expr("transform(array_sort(collect_list(struct(at, bits))), x -> x.bits)").alias("bits"))


def window_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: list[str],
    text_col: str = "text",
    n: int = WINDOW,
    max_broadcast_grams: int = MAX_BROADCAST_GRAMS,
) -> DataFrame:
    """A row for every occurrence of a benchmark window, and at least one for every document row.

    Columns: `carry`, __row (names the document row), n_words, pos, len (1-based words), item, hit; hit is null for
    windows that only the bit array let through, and for documents without any. The names in `carry` are the caller's
    and must not be among the others. For each length of window, a position is tried by the hash of the two words at
    its ends; only where that bit is set is the window written out and held against the set, word for word.
    """
    grams = materialize(gram_set(benchmark, n=n), "grams")
    lengths = {r[0]: r[1] for r in grams.groupBy("gram_words").count().collect()}  # at most n rows
    total = sum(lengths.values())
    bits_log2 = min(26, max(16, (total * 16).bit_length()))
    size = 1 << (bits_log2 - 6)
    words = docs.select(*carry, F.monotonically_increasing_id().alias("__row"), words_of(F.col(f"`{text_col}`")).alias("__w"))
    none = "cast(array() as array<struct<pos:int,len:int,gram:string>>)"
    ends = "xxhash64(__w[i - 1], __w[i + {k} - 2])"
    parts = [
        f"""transform(
              filter(if(size(__w) >= {k}, sequence(1, size(__w) - {k - 1}), cast(array() as array<int>)),
                     i -> exists(array({ends}), h -> (shiftright(__bits[cast(shiftright(h, 6) & {size - 1}L as int)], cast(h & 63 as int)) & 1) = 1)),
              i -> struct(i as pos, {k} as len, array_join(slice(__w, i, {k}), ' ') as gram))""".replace("{k}", str(k))
        for k in sorted(lengths)
    ]
    if parts:
        bits = materialize(_bit_array(grams, bits_log2), "gram-bits")
        words = words.withColumn("__bits", bits.scalar())
    windows = words.select(
        *carry,
        "__row",
        F.size("__w").cast("long").alias("n_words"),
        F.explode_outer(F.expr(f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0] if parts else none)).alias("__x"),
    ).select(*carry, "__row", "n_words", "__x.pos", "__x.len", "__x.gram")
    known = grams.select(F.col("gram").alias("__gram"), "item", F.lit(True).alias("hit"))
    if total <= max_broadcast_grams:
        known = F.broadcast(known)
    return windows.join(known, F.col("gram") == F.col("__gram"), "left").drop("__gram", "gram")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = WINDOW,
    one_in: int = ONE_IN,
    max_broadcast_grams: int = MAX_BROADCAST_GRAMS,
) -> DataFrame:
    """Per row of `docs`: id_col, __row, n_words, n_hit, n_items, items (sorted), spans (sorted), full_window, contaminated.

    A word inside any occurrence of a benchmark window is hit; full_window says that one of them has n words, and
    contaminated that n_hit > 0 and one_in * n_hit >= n_words. Null and empty texts have no words and aren't
    contaminated; items without words hit nothing; repeated rows give repeated results; null item names are left out
    of the items. Other columns of `docs` don't matter. An empty table gives an empty result, an empty benchmark no hits.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("text"))
    hits = window_hits(docs, benchmark, ["__id"], "text", n, max_broadcast_grams)
    per = hits.groupBy("__row", "__id", "n_words").agg(
        F.collect_set(F.when(F.col("hit"), F.struct("pos", "len"))).alias("at"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    covered = "array_distinct(flatten(transform(at, x -> sequence(x.pos, x.pos + x.len - 1))))"
    n_hit = F.size(F.expr(covered)).cast("long")
    return per.select(
        F.col("__id").alias(id_col),
        "__row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.expr("array_sort(at)").alias("spans"),
        F.exists("at", lambda x: x["len"] == n).alias("full_window"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", mode: str = "documents", rule: str = "window", **options
) -> DataFrame:
    """`docs` without documents that hold benchmark text (mode "documents"), or with every hit word cut out (mode "spans").

    By rule "window" a document goes for one verified window of n words, or for hit words that are one in one_in; by rule
    "share" only for the latter. In mode "spans" a cut word goes with the characters between it and the word before.
    Rows are told apart by identifier and text, so rows that repeat both share one fate. Columns stay as they were,
    whatever their names.
    """
    assert mode in ("documents", "spans") and rule in ("window", "share")
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    slim = docs.select(F.struct(ident.alias("id"), F.xxhash64(text).alias("h")).alias("__key"), text.alias("text"))
    marked = contamination(slim, benchmark, "__key", "text", **options).where("n_hit > 0")
    marked = materialize(marked.select(F.col("__key.id").alias("id"), F.col("__key.h").alias("h"), "spans", "full_window", "contaminated"), "contaminated")
    on = {"id": ident, "h": F.xxhash64(text)}
    if mode == "documents":
        gone = marked.where("contaminated or full_window" if rule == "window" else "contaminated")
        return without_keys(docs, gone.select("id", "h").distinct(), on)
    spans, flag, cid, ch = own_names(docs, "x_spans", "x_maybe", "x_id", "x_hash")
    cut = materialize(marked.groupBy("id", "h").agg(F.first("spans").alias(spans)).select(F.col("id").alias(cid), F.col("h").alias(ch), spans), "cut-spans")
    flagged = with_filter_flag(docs, key_hash(*on.values()), key_filter(cut, key_hash(cid, ch)), flag)
    joined = flagged.where(F.col(flag)).join(cut, ident.eqNullSafe(F.col(cid)) & on["h"].eqNullSafe(F.col(ch)), "left")
    # A piece is a word with the gap before it; what follows the last word is a piece of its own and stays.
    pieces = F.split(text, r"(?<=[^\x00-\x2F\x3A-\x60\x7B-\x7F])(?=[\x00-\x2F\x3A-\x60\x7B-\x7F])")
    kept = F.filter(pieces, lambda x, i: ~F.exists(F.col(spans), lambda s: (i + 1 >= s["pos"]) & (i + 1 < s["pos"] + s["len"])))
    new = F.when(F.col(spans).isNotNull(), F.array_join(kept, "")).otherwise(text)
    done = joined.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    return flagged.where(~F.col(flag)).drop(flag).unionByName(done)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bg),
win AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, win.k, item_id FROM win JOIN bg USING (gram)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
