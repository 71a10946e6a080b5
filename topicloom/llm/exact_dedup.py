"""Exact dedup by a log-structured merge index of digests, in DataFrame operations only.

Rows are dealt to memtables of a bounded number of rows. Each is reduced to its distinct digests and flushed as a run:
one file sorted by digest, with a Parquet Bloom filter sized for its rows and min/max statistics per row group.
Compaction merges `fanout` runs at a time, keeping the smallest and largest identifier and the count of each digest,
until one run is left; a run of many rows is cut into slices by the digest's first bytes, one sorted file each, so
that no task ever holds more than a slice. A level goes once the next one stands.

Digests that the last run has more than once are hits, and their identifiers and counts are the result. A bit filter
over the hits lets all other rows pass without a shuffle. Hits receive byte verification: the whole texts of each
digest are grouped, folded before the shuffle, and where one digest stands for several texts, the texts decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import (
    KeyFilter,
    delete,
    intermediate,
    key_filter,
    key_hash,
    lookup,
    materialize,
    own_names,
    prepare,
    scratch_path,
    settled,
    with_filter_flag,
)

#: Rows of a memtable, and of a slice of a merged run, about.
MEMTABLE_ROWS = 1 << 17
FANOUT = 16


def sha256_digest(text: Column) -> Column:
    """32 bytes; lets tests put in a weaker digest to force collisions."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


class DigestIndex:
    """Runs on shared storage: columns digest, min_id, max_id, n; level=k/run=r/slice=s holds one sorted file."""

    SCHEMA = "digest binary, min_id long, max_id long, n long, run int, slice int"

    def __init__(self, spark: SparkSession, path: str | None = None, memtable_rows: int = MEMTABLE_ROWS, fanout: int = FANOUT):
        prepare(spark)
        self.spark, self.memtable_rows, self.fanout = spark, memtable_rows, fanout
        self.path = path or scratch_path(spark, "digest-index")
        self.level, self.runs = -1, 0

    def level_path(self, level: int) -> str:
        return f"{self.path}/level={level}"

    def _write(self, dealt: DataFrame, rows: int, runs: int) -> None:
        """`dealt` has all rows of a (run, slice) in one partition; `rows` of them in all, at most."""
        (
            dealt.sortWithinPartitions("run", "slice", "digest")
            .write.partitionBy("run", "slice")
            .option("parquet.bloom.filter.enabled#digest", "true")
            .option("parquet.bloom.filter.expected.ndv#digest", str(max(1, min(rows, self.memtable_rows))))
            .parquet(self.level_path(self.level + 1))
        )
        self.level, self.runs = self.level + 1, runs

    def flush(self, keyed: DataFrame, rows: int) -> None:
        """`keyed` has digest and id, `rows` rows. Every memtable becomes one sorted run of level 0."""
        runs = max(1, -(-rows // self.memtable_rows))
        # Dealt by identifier and digest, so that neither copies of one text nor rows of one identifier share a memtable.
        dealt = keyed.withColumn("run", F.pmod(F.xxhash64("id", "digest"), F.lit(runs)).cast("int")).repartition(runs, "run")
        distinct = dealt.groupBy("run", "digest").agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count(F.lit(1)).alias("n"))
        self._write(distinct.withColumn("slice", F.lit(0)), -(-rows // runs), runs)

    def merge_level(self) -> None:
        """Merges `fanout` runs at a time into one of the next level."""
        below, total = self.level, self.read().count()
        runs = -(-self.runs // self.fanout)
        slices = max(1, -(-total // (runs * self.memtable_rows)))
        start = F.coalesce(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(0))
        dealt = (
            self.read()
            .withColumn("run", (F.col("run") / self.fanout).cast("int"))
            .withColumn("slice", F.shiftright(start * slices, 32).cast("int"))
            .repartition(runs * slices, "run", "slice")
        )
        merged = dealt.groupBy("run", "slice", "digest").agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), F.sum("n").alias("n"))
        self._write(merged, -(-total // (runs * slices)), runs)
        delete(self.spark, self.level_path(below))

    def compact(self) -> None:
        while self.runs > 1:
            self.merge_level()

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.level_path(self.level))

    def probe(self, digests: list[bytes]) -> DataFrame:
        """The rows of a few digests: statistics and Bloom filters rule out most files before a row is read."""
        return self.read().where(F.col("digest").isin([F.lit(bytes(d)) for d in digests]))

    def hits(self) -> DataFrame:
        """(digest, min_id, max_id, n) of the digests that stand for several rows."""
        return self.read().where("n > 1").select("digest", "min_id", "max_id", "n")


def _index(docs: DataFrame, ident: Column, body: Column, digest, memtable_rows: int, fanout: int) -> tuple[DataFrame, KeyFilter, int]:
    """The hits as a table, a filter over them, and the number of rows."""
    spark = docs.sparkSession
    total = docs.count()

    def build() -> DataFrame:
        index = DigestIndex(spark, memtable_rows=memtable_rows, fanout=fanout)
        index.flush(docs.select(digest(body).alias("digest"), ident.alias("id")), total)
        index.compact()
        return index.hits()

    hits = settled(build, spark, "digest-hits")
    return hits, key_filter(hits, key_hash("digest")), total


def _decided(docs: DataFrame, id_col: str, text_col: str, keep: str, digest, memtable_rows: int, fanout: int) -> tuple[DataFrame, list[str]]:
    """`docs` with four columns, whose names come second: the identifier that stays, the group's size, whether the row
    stays, and the digest."""
    assert keep in ("min", "max")
    key, keeper, size, kept, hit = names = own_names(docs, "x_digest", "x_keeper", "x_size", "x_kept", "x_hit")
    ident, body = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    extreme = F.max if keep == "max" else F.min
    hits, filt, total = _index(docs, ident, body, digest, memtable_rows, fanout)
    flagged = with_filter_flag(docs.withColumn(key, digest(body)), key_hash(key), filt, hit)
    maybe = flagged.where(F.col(hit)).drop(hit)

    # Byte verification. Copies fold before the shuffle; a digest with one text keeps what the index says.
    texts = maybe.select(F.col(f"`{key}`").alias("digest"), ident.alias("id"), body.alias("body")).groupBy("digest", "body")
    one = texts.agg(extreme("id").alias("keeper"), F.count(F.lit(1)).alias("n")).groupBy("digest")
    several = materialize(one.agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "collided")
    single = hits.select(F.col("digest").alias(key), F.col(f"{keep}_id").alias(keeper), F.col("n").alias(size))
    single = materialize(single.join(several.withColumnRenamed("digest", key), key, "left_anti"), "verified-hits")
    columns = [F.col(f"`{c}`") for c in (*docs.columns, key, keeper, size)]
    done = lookup(maybe, single, [key], size, total, id_col, "left").select(*columns)
    if not several.isEmpty():
        collided = several.withColumnRenamed("digest", key)
        text = own_names(docs, "x_text")[0]
        odd = maybe.join(collided, key, "left_semi").withColumn(text, body)
        groups = odd.groupBy(key, text).agg(extreme(ident).alias(keeper), F.count(F.lit(1)).alias(size))
        done = done.join(collided, key, "left_anti").select(*columns).unionByName(odd.join(groups, [key, text]).select(*columns))
    alone = flagged.where(~F.col(hit)).drop(hit).withColumn(keeper, F.lit(None).cast("long")).withColumn(size, F.lit(None).cast("long"))
    both = alone.select(*columns).unionByName(done)
    both = both.withColumn(keeper, F.when(F.col(size).isNull(), ident).otherwise(F.col(keeper)))
    both = both.withColumn(size, F.coalesce(size, F.lit(1).cast("long"))).withColumn(kept, ident.eqNullSafe(F.col(keeper)))
    return both, names[:4]


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    digest=sha256_digest,
    memtable_rows: int = MEMTABLE_ROWS,
    fanout: int = FANOUT,
) -> DataFrame:
    """All rows of `docs` with `keep_id`, `group_size`, `kept` and `text_sha256` added.

    `keep` is "min" or "max": which identifier of a group of equal texts stays. Null text counts as empty, a text of any
    length is compared whole. A null identifier loses against any other; a group of null identifiers keeps all its
    rows. Rows that repeat the kept identifier and text are alike in every way and all count as kept. Added columns
    replace columns of the same name in `docs`, in any case; no other column changes. An empty table gives an empty result.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    marked, (key, keeper, size, kept) = _decided(docs, id_col, text_col, keep, digest, memtable_rows, fanout)
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added or c in (id_col, text_col)]
    sha = F.col(key) if digest is sha256_digest else sha256_digest(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    values = (F.col(keeper), F.col(size), F.col(kept), F.lower(F.hex(sha)))
    return marked.select(*own, *[v.alias(name) for v, name in zip(values, added, strict=True)])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row of each group of equal texts, with the columns of `docs` as they were, whatever their names."""
    marked, (_, _, _, kept) = _decided(docs, id_col, text_col, keep, sha256_digest, MEMTABLE_ROWS, FANOUT)
    return marked.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def build() -> DataFrame:
        return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")

    return settled(build, spark, "exact-groups")


OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
"""
