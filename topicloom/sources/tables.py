"""Reading and writing: JSON lines extracts, tables, schemas, snapshots."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from topicloom.session import shared_folder

CORPUS = T.StructType([T.StructField("merged_id", T.StringType(), False), T.StructField("text", T.StringType(), False)])
SCORES = T.StructType(
    [
        T.StructField("merged_id", T.StringType()),
        T.StructField("fields", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())]))),
    ]
)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/topicloom/{uuid.uuid4().hex}"


def read_extract(spark: SparkSession, folder: str, prefix: str, schema: T.StructType = CORPUS) -> DataFrame:
    """The shards `prefix*.jsonl.gz` of a folder; fails if there are none."""
    glob = f"{folder}/{prefix}*.jsonl.gz"
    try:
        return spark.read.schema(schema).json(glob)
    except AnalysisException as e:
        raise FileNotFoundError(glob) from e


def write_extract(df: DataFrame, path: str) -> None:
    """Sharded gzip JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def download(spark: SparkSession, df: DataFrame, folder: str, prefix: str, clobber: bool = False) -> int:
    """A table or a query's result as `prefix` and a number, sharded gzip JSON lines in `folder`; the number of shards.

    An empty prefix would match every file there and is refused, and so are shards that are there already, unless
    `clobber` clears them first.
    """
    if not prefix:
        raise ValueError("a prefix is needed")
    jvm = spark._jvm.org.apache.hadoop.fs
    home = jvm.Path(folder)
    fs = home.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(home)
    own = [f.getPath() for f in fs.globStatus(jvm.Path(f"{folder}/{prefix}*.jsonl.gz"))]
    if own and not clobber:
        raise FileExistsError(f"{folder}/{prefix}*.jsonl.gz")
    staged = f"{folder}/.{prefix}{uuid.uuid4().hex}"
    write_extract(df, staged)
    for path in own:
        fs.delete(path, False)
    parts = sorted(f.getPath().toString() for f in fs.globStatus(jvm.Path(f"{staged}/part-*")))
    for i, part in enumerate(parts):
        fs.rename(jvm.Path(part), jvm.Path(f"{folder}/{prefix}{i:012d}.jsonl.gz"))
    fs.delete(jvm.Path(staged), True)
    return len(parts)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep=sep, header=header)


def write_embeddings(df: DataFrame, path: str, vectors: list[str], digits: int | None = None) -> None:
    """JSON lines with the arrays in `vectors` beside the other columns, rounded only where `digits` is given."""
    if digits is not None:
        for c in vectors:
            df = df.withColumn(c, F.transform(c, lambda x: F.round(x.cast("double"), digits)))
    df.write.mode("overwrite").json(path)


def read_embeddings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def sampled_scan(df: DataFrame, percent: float | None = None, rows: int | None = None, seed: int | None = None) -> DataFrame:
    """About `percent` of a table, or its first `rows` in no order."""
    if (percent is None) == (rows is None):
        raise ValueError("either percent or rows")
    return df.limit(rows) if rows is not None else df.sample(withReplacement=False, fraction=percent / 100, seed=seed)


def write_scores(df: DataFrame, path: str, clobber: bool = True) -> None:
    df.write.mode("overwrite" if clobber else "errorifexists").json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORES).json(path)


def scores_as_map(scores: DataFrame) -> DataFrame:
    """(merged_id, fields map name -> score); of a name given twice the last counts."""
    pairs = F.aggregate(
        "fields",
        F.create_map().cast("map<string,double>"),
        lambda m, f: F.map_concat(F.map_filter(m, lambda k, v: k != f["name"]), F.create_map(f["name"], f["score"])),
    )
    return scores.select("merged_id", pairs.alias("fields"))


def load_json(spark: SparkSession, source: str, table: str, truncate: bool = True) -> DataFrame:
    """JSON lines with an inferred schema into a Parquet table."""
    spark.read.json(source).write.mode("overwrite" if truncate else "errorifexists").parquet(table)
    return spark.read.parquet(table)


def write_query(spark: SparkSession, sql: str, table: str, clobber: bool = False, **parameters) -> DataFrame:
    """The result of a query with named parameters as a table; without `clobber` an existing one is left alone and
    the call fails."""
    spark.sql(sql, args=parameters).write.mode("overwrite" if clobber else "errorifexists").parquet(table)
    return spark.read.parquet(table)


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType = CORPUS) -> DataFrame:
    """The table at `path`, empty if there was none."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_clustered(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> None:
    """Range-partitioned and sorted by `keys`, so row-group statistics prune reads by them."""
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def publish(spark: SparkSession, staging: str, production: str, backup: str, tables: list[str], day: str, comments: dict[str, dict] | None = None) -> None:
    """Copies staged tables to production with their comments, and to a backup named by day (yyyymmdd)."""
    for name in tables:
        df = described(spark.read.parquet(f"{staging}/{name}"), (comments or {}).get(name, {}))
        df.write.mode("overwrite").parquet(f"{production}/{name}")
        df.write.mode("overwrite").parquet(f"{backup}/{name}_{day}")


def clean_backups(spark: SparkSession, backup: str, tables: list[str], keep: int = 3) -> list[str]:
    """Deletes all but the `keep` latest dated backups of each table; the names of those that went."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(backup).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for name in tables:
        dated = sorted(f.getPath().getName() for f in fs.globStatus(jvm.Path(f"{backup}/{name}_{'[0-9]' * 8}")))
        for old in dated[: max(0, len(dated) - keep)]:
            fs.delete(jvm.Path(f"{backup}/{old}"), True)
            gone.append(old)
    return gone


def described(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    for column, comment in comments.items():
        if column in df.columns:
            df = df.withMetadata(column, {**df.schema[column].metadata, "comment": comment})
    return df


def schema_to_dict(df: DataFrame) -> dict:
    return json.loads(df.schema.json())


def dict_to_schema(schema: dict) -> T.StructType:
    return T.StructType.fromJson(schema)


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """`table` with the rows of `changes` in place of those with the same keys."""
    return table.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def not_fetched(wanted: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to be fetched."""
    return wanted.join(pages.select(*keys), keys, "left_anti")
