"""A corpus in five stages: toxic documents go, copies go, near copies go, benchmark leaks go, the rest is encoded.

Every stage is written as Parquet to the shared folder and read again as the next one's input; that goes once the next
output stands, and so does all that a stage wrote for itself. The result has the piece ids of every document that is left.

Stages take null texts and identifiers, empty and very long texts, repeated rows, empty tables and more columns than
documents has, whatever their names: null and empty texts are equal texts, of which the largest identifier stays, and
pass all other stages; a row without identifier is no copy that stays beside one that has one, is near to nothing and
is encoded with null for its identifier. Rows alike in identifier and text share one fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicloom.llm.decontaminate import decontaminate
from topicloom.llm.exact_dedup import exact_dedup
from topicloom.llm.minhash import near_dedup
from topicloom.llm.sentencepiece_sampling import sampled_segmentations
from topicloom.llm.shared import delete, intermediate, scratch_path
from topicloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go. The model learns from labelled rows of these documents."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest doc_id stays."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a whole window of 13 benchmark words go, and those of whose words one in twenty stand in shorter items."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document that is left, with their piece ids."""
    return sampled_segmentations(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", benchmark),
    ("sentencepiece", encode),
]

#: Learned scores, components and sampled segmentations have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with intermediate(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
