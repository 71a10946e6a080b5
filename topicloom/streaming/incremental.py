"""A file stream of documents: texts that are new or changed are cleaned and appended, others are skipped.

The reference engine has no streams; this is the incremental refresh run continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicloom.functions.text import clean_corpus_text
from topicloom.plans.pipeline import changed_only
from topicloom.sources.tables import CORPUS, create_if_missing


def stream_corpus(spark: SparkSession, source: str, corpus: str, checkpoint: str, lang: str = "en") -> StreamingQuery:
    """Reads JSON lines (merged_id, text) as they arrive and appends cleaned new rows to the table `corpus`.

    A batch that is retried finds its rows there already, so nothing is written twice.
    """
    create_if_missing(spark, corpus)

    def append(batch: DataFrame, _: int) -> None:
        clean = batch.select("merged_id", clean_corpus_text(F.col("text"), lang).alias("text")).where(F.char_length("text") > 0)
        before = batch.sparkSession.read.schema(CORPUS).parquet(corpus)
        changed_only(clean.distinct(), before).write.mode("append").parquet(corpus)

    stream = spark.readStream.schema(CORPUS).json(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
