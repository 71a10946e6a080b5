"""Token counts through a digest cache.

The cache is a table (content_digest, tokenizer_digest, n_tokens). Each text is reduced to the digest of its
normalised content; digests the cache lacks are encoded once each, whatever the number of copies, and appended.
Only the texts of distinct misses move between executors.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import delete, exists, key_filter, key_hash, lean, lookup, materialize, maybe_in, prepare, scratch_path

TOKENIZER = "byte_bpe_50k"
LIMIT = 1024
#: The session setting that names a cache which outlives the query.
CACHE_SETTING = "spark.topicloom.token.cache"
CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def vocabulary_path(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


@lru_cache(maxsize=4)
def encoding(ranks_path: str, model_path: str):
    """A byte-level BPE from a file of ranks, with the special tokens that the .json file of the model adds.

    It has the vocabulary, merges and splitting of the .json file, and a test holds its counts against the
    tokenizers library; it takes a quarter of the time.
    """
    import tiktoken

    pattern = importlib.import_module("public_tokenizers").PATTERN
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(model_path, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def tokenizer_digest(*paths: str) -> str:
    h = hashlib.sha256()
    for path in paths:
        with open(path, "rb") as f:
            h.update(hashlib.sha256(f.read()).digest())
    return h.hexdigest()


def normalised(text: Column) -> Column:
    """What the digest is made of. Counts depend on every byte, so nothing but null is changed."""
    return F.coalesce(text.cast("string"), F.lit(""))


@lru_cache(maxsize=2)
def library_model(model_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(model_path)


def n_tokens(enc, text: str, model_path: str) -> int:
    """A special token's string inside a text is that token, as the tokenizers library has it by default.

    Runs of white space by the hundred thousand are too deep for the splitter of ranks; the library itself counts
    texts that hold one.
    """
    try:
        return len(enc.encode(text, allowed_special="all", disallowed_special=()))
    except ValueError:
        return len(library_model(model_path).encode(text, add_special_tokens=False).ids)


def _counter(*paths: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(*paths)
        for b in batches:
            counts = [n_tokens(enc, t.as_py(), paths[1]) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    return count


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(content_digest, n_tokens), one row for each digest, however many writers have appended it."""
    if not exists(spark, path):
        return spark.createDataFrame([], "content_digest binary, n_tokens long")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer_digest") == version)
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def compact_cache(spark: SparkSession, path: str) -> None:
    """Rewrites a cache, of all versions, with one row for each key. No other writer may be at work."""
    whole = spark.read.schema(CACHE_SCHEMA).parquet(path).groupBy("content_digest", "tokenizer_digest").agg(F.max("n_tokens").alias("n_tokens"))
    whole.write.parquet(f"{path}.compacted")
    delete(spark, path)
    jvm = spark._jvm.org.apache.hadoop.fs
    new = jvm.Path(f"{path}.compacted")
    new.getFileSystem(spark._jsc.hadoopConfiguration()).rename(new, jvm.Path(path))


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    paths: tuple[str, str] | None = None,
    cache_path: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Counts by the tokenizer whose files `paths` names (ranks, model); they must be readable on executors.

    Per row of `docs`: id_col, n_bytes, n_tokens, over_limit, content_digest (hex). Other columns are left out.

    `cache_path` names a cache that outlives the call; without it the call has one of its own in the shared folder.
    Null text is empty: 0 bytes, 0 tokens. Repeated rows each get their count, and so do rows without identifier. Texts
    of any length are counted whole. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    paths = paths or (vocabulary_path(f"{TOKENIZER}.tiktoken"), vocabulary_path(f"{TOKENIZER}.json"))
    cache_path = cache_path or scratch_path(spark, "token-cache")
    version = tokenizer_digest(*paths)
    ident, text = F.col(f"`{id_col}`"), normalised(F.col(f"`{text_col}`"))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    keyed = materialize(
        docs.select(ident.alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("content_digest")), "keyed"
    )
    # One row stands for each digest; copies fold before the shuffle.
    distinct = materialize(keyed.groupBy("content_digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "digests")
    wanted = materialize(distinct.join(read_cache(spark, cache_path, version), "content_digest", "left_anti").select("id", "content_digest"), "misses")
    bodies = docs.select(ident.alias("id"), text.alias("text"))
    maybe = maybe_in(bodies, key_hash("id"), key_filter(wanted, key_hash("id")))
    wanted = wanted.select(F.col("id").alias("__id"), F.col("content_digest").alias("__digest"))
    misses = maybe.join(
        wanted,
        F.col("id").eqNullSafe(F.col("__id")) & (F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == F.col("__digest")),
    ).select(F.col("__digest").alias("content_digest"), "text")
    counted = misses.mapInArrow(lean(_counter(*paths)), "content_digest binary, n_tokens long")
    # Rows that repeat identifier and text are encoded alike; one of them goes to the cache.
    fresh = counted.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh.select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(cache_path)
    known = materialize(distinct.select("content_digest", "n").join(read_cache(spark, cache_path, version), "content_digest"), "counts")
    return lookup(keyed, known, ["content_digest"], "n", keyed.count(), "id").select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.lower(F.hex("content_digest")).alias("content_digest"),
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts are those of the cache that the setting CACHE_SETTING names, if it is set."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, cache_path=spark.conf.get(CACHE_SETTING, None)).select("doc_id", "n_bytes", "n_tokens", "over_limit")
