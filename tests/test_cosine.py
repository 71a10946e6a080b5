"""Cosine of texts and topics in one pass over the texts' terms."""

import random

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F
from test_scale import shuffled
from topicloom.operators import scoring


def rows(df, key, field):
    return {(r[key], r[field]): r.similarity for r in df.collect()}


@pytest.mark.parametrize("most", [10**6, 60, 1])
def test_one_pass_equals_the_join_of_both_lists(spark, monkeypatch, most):
    """Whole lists broadcast, those of frequent terms alone, and none."""
    rng = random.Random(9)
    words = [f"t{int(rng.paretovariate(0.7)) % 90}" for _ in range(900)] + ["all"] * 40
    counts = [(d, f"s{d % 4}", t, n) for d in range(40) for t, n in {w: rng.randrange(1, 5) for w in [*rng.sample(words, 12), "all"]}.items()]
    docs = spark.createDataFrame(counts, "doc long, source string, term string, tf long").cache()
    fields = scoring.tfidf(docs.groupBy("source", "term").agg(F.sum("tf").alias("tf")), "source").cache()
    want = rows(scoring.sparse_cosine(scoring.tfidf(docs.select("doc", "term", "tf"), "doc"), fields, "doc", "source"), "doc", "source")
    monkeypatch.setattr(scoring, "MAX_BROADCAST_WEIGHTS", most)
    frequency = docs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    out = scoring.tfidf_cosine(docs, frequency, F.lit(40), fields, "doc", "source", lambda _, build: build().cache())
    got = rows(out, "doc", "source")
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert out.count() == len(got)


def test_texts_are_counted_in_place(spark):
    docs = spark.createDataFrame([(1, "b a  b\n"), (2, ""), (3, None), (4, "a")], "id long, text string")
    assert sorted(map(tuple, scoring.text_counts(docs, ["id"], "text").collect())) == [(1, "a", 1), (1, "b", 2), (4, "a", 1)]


def test_sparse_cosine_deals_pairs_and_not_terms(spark, sf):
    """Every term of a text was dealt by its document."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    terms = scoring.text_counts(docs, ["doc_id"], "text").count()
    assert shuffled(entry.queries()["sparse_cosine"](spark, sf)) < 60 * docs.count() < terms
