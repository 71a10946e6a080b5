"""Helpers that the operators of this package share: durable tables, key filters, row exclusion."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce, wraps
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.session import make_importable

#: A key filter spends 16 bits a counted key, between these powers of two. The greater, 2**26 bits, is a table of 2**20
#: rows of 12 bytes; beyond four million keys it fills up and lets more rows through, never fewer.
FILTER_BITS_LOG2 = (16, 26)
#: Rows of a table that may be broadcast: at most this many, of fixed width.
BROADCAST_ROWS = 200_000
#: A key is hot when it holds more than one in this many of all rows, so at most this many keys are.
HOT_ONE_IN = 1000


#: Rows and bytes of a batch that goes to Python, where the session doesn't set them. Spark's own 10,000 rows are some
#: 100 MB of memory beside the heap in every task that sends whole texts.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

#: The folder of local runs without the setting.
_LOCAL: list[str] = []


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: Python workers that find this package, batches of bounded size."""
    make_importable(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(name := f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(name, most)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees; `spark.checkpoint.dir` if set, else a folder for local runs."""
    prepare(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not _LOCAL:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _LOCAL.append(tempfile.mkdtemp(prefix="topicloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/topicloom/{name}-{uuid.uuid4().hex}"


#: Tables written inside the innermost `intermediate` scope.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Tables that `materialize` writes in this scope go at its end: nothing lazy may leave the scope."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            delete(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path that goes at the end of the innermost `intermediate` scope, if there is one."""
    path = fresh_path(spark, name)
    if (open_scope := _SCOPE.get()) is not None:
        open_scope.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(build: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """`build()` written as a table; what it wrote on the way goes as soon as the table stands."""
    path = scratch_path(spark, name)
    with intermediate(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame | list[str], *wanted: str) -> list[str]:
    """Names for added columns that no column of `df`, or no name of a list, has, whatever the case."""
    taken = {c.lower() for c in (df if isinstance(df, list) else df.columns)}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: ArrowMap) -> ArrowMap:
    """`run`, after which a worker's freed memory goes back to the system.

    Workers are used again by later stages, which else add their needs to what earlier ones have left.
    """

    @wraps(run)
    def then_trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return then_trim


def key_hash(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


@dataclass
class KeyFilter:
    """A blocked Bloom filter as a table (word, bits): two bits of one 64-bit word for each key."""

    table: DataFrame
    bits_log2: int

    def word(self, h: Column) -> Column:
        return F.shiftright(h, 12).bitwiseAND(F.lit((1 << (self.bits_log2 - 6)) - 1).cast("long")).cast("int")


def _two_bits(h: str) -> str:
    return f"(shiftleft(1L, cast({h} & 63 as int)) | shiftleft(1L, cast(shiftright({h}, 6) & 63 as int)))"


def key_filter(keys: DataFrame, hashed: Column) -> KeyFilter:
    """The filter of `hashed` over `keys`, a table that is read twice: once to count it, once to fill the filter.

    False positives only, about one in fifty; an empty `keys` gives an empty filter.
    """
    low, high = FILTER_BITS_LOG2
    filt = KeyFilter(keys, min(high, max(low, (16 * keys.count()).bit_length())))
    h = keys.select(hashed.alias("h"))
    words = h.select(filt.word(F.col("h")).alias("word"), F.expr(_two_bits("h")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    filt.table = materialize(words, "key-filter")
    return filt


def with_filter_flag(df: DataFrame, hashed: Column, filt: KeyFilter, flag: str) -> DataFrame:
    """Adds boolean `flag`: false where the key is certainly absent from the filter. No shuffle of `df`."""
    h, at, word, bits = own_names(df, "f_h", "f_at", "f_word", "f_bits")
    probed = df.withColumn(h, hashed).withColumn(at, filt.word(F.col(h)))
    joined = probed.join(F.broadcast(filt.table.toDF(word, bits)), F.col(at) == F.col(word), "left")
    hit = F.expr(f"coalesce({bits} & {_two_bits(h)} = {_two_bits(h)}, false)")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], hit.alias(flag))


def maybe_in(df: DataFrame, hashed: Column, filt: KeyFilter) -> DataFrame:
    """The rows whose key may be in the filter."""
    flag = own_names(df, "f_maybe")[0]
    return with_filter_flag(df, hashed, filt, flag).where(F.col(flag)).drop(flag)


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, by: str, how: str = "inner") -> DataFrame:
    """`rows` joined with `table`, which has one row for each combination of `keys` and in `weight` the number of rows
    that it will meet, of `total` in all. `by` is a column that differs between the rows of a key.

    Rows of a hot key are dealt over as many salts as it takes for each to hold at most one in HOT_ONE_IN of all rows,
    and the hot row of the table is repeated for each salt. Only hot keys and their salts are broadcast, HOT_ONE_IN rows
    at most. `table` is read twice, so it should be materialised.
    """
    assert how in ("inner", "left")
    least = max(1, total // HOT_ONE_IN)
    salt, salts = own_names([*rows.columns, *table.columns], "x_salt", "x_salts")
    many = F.ceil(F.col(weight) / least).cast("int")
    hot = table.where(F.col(weight) > least).select(*keys, many.alias(salts))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(salt, F.coalesce(F.pmod(F.xxhash64(by), F.col(salts)), F.lit(0)).cast("int")).drop(salts)
    repeated = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.greatest(many - 1, F.lit(0)))))
    return dealt.join(repeated, [*keys, salt], how).drop(salt)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, by: str, how: str = "inner") -> DataFrame:
    """As `salted_join`, for a table of narrow rows: while it has at most BROADCAST_ROWS, it is broadcast whole."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, how)
    return salted_join(rows, table, keys, weight, total, by, how)


def without_keys(df: DataFrame, keys: DataFrame, on: dict[str, Column]) -> DataFrame:
    """Rows of `df` whose key tuple is not in `keys` (columns named as in `on`, nulls match nulls).

    Rows that the filter rules out pass through untouched, so only rows that may match are shuffled.
    """
    names = list(on)
    mine = own_names(df, *[f"k_{n}" for n in names])
    flag = own_names(df, "f_maybe")[0]
    keys = materialize(keys.select(*[F.col(n).alias(k) for n, k in zip(names, mine, strict=True)]), "keys")
    flagged = with_filter_flag(df, key_hash(*on.values()), key_filter(keys, key_hash(*mine)), flag)
    sure = flagged.where(~F.col(flag)).drop(flag)
    cond = reduce(and_, [on[n].eqNullSafe(F.col(k)) for n, k in zip(names, mine, strict=True)])
    checked = flagged.where(F.col(flag)).drop(flag).join(keys, cond, "left_anti")
    return sure.unionByName(checked)
