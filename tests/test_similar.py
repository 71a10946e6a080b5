"""Texts are embedded and compared where they are, with the results of the joins."""

import random

import pytest
from pyspark.sql import functions as F

from test_scale import shuffled
from topicloom.functions import similar
from topicloom.operators import scoring
from topicloom.plans import pipeline, score
from topicloom.sources.roles import Roles


def built(_, build):
    return build()


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    vectors = spark.createDataFrame([(w, [rng.uniform(-0.3, 1) if w != "w3" else 0.0 for _ in range(5)]) for w in words[:12]] + [("w12", [float("nan"), 1.0, 0.0, 0.0, 0.0])], "term string, vector array<double>")
    frequency = spark.createDataFrame([(w, 60 if w == "w0" else rng.randrange(1, 50)) for w in words[:38]], "term string, df long")
    models = score.Models(vectors, vectors.where("term <> 'w5'").withColumnRenamed("term", "mention"), words[:14], frequency, F.lit(60))
    names = [(f"A{i}", 0) for i in range(4)] + [(f"B{i}", 1) for i in range(5)] + [(f"C{i}é", 2 + i % 2) for i in range(12)]
    fields = spark.createDataFrame([(n, k, text(9) if n != "A1" else "w39 w39") for n, k in names], "name string, level int, text string").cache()
    edges = [(f"A{i % 4}", f"B{i}") for i in range(5)] + [(f"B{i % 5}", f"C{i}é") for i in range(12)]
    children = spark.createDataFrame(edges, "parent_name string, child_name string")
    texts = [(f"d{i}", text(rng.randrange(1, 40))) for i in range(50)] + [("none", ""), ("null", None), ("gaps", "w1\fw2\u2003w1\tx\x1cw2 w4"), ("unknown", "w39 zz"), ("common", "w0 w0")]
    return spark.createDataFrame(texts, "id string, text string").cache(), fields, children, models


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("constrained", [True, False])
def test_scores_in_place_are_those_of_the_joins(inputs, monkeypatch, constrained):
    texts, fields, children, models = inputs
    run = lambda: score.score_corpus(texts, fields, children, models, built, top=2, emit=3, constrained=constrained).select("id", "level", "name", "score", "rank")
    assert score.held(fields.select("name", "level"), score.embed(fields.select(F.col("name").alias("id"), "text"), models, "f", built), models)
    got = rows(run())
    monkeypatch.setattr(similar, "BLOCK", 40)  # a block a text
    assert rows(run()) == got
    monkeypatch.setattr(score, "MAX_BROADCAST_WEIGHTS", 3)
    assert rows(run()) == got and {r[1] for r in got} == {0, 1, 2, 3}


def test_similarities_in_place_are_those_of_the_joins(inputs, monkeypatch):
    texts, fields, _, models = inputs
    run = lambda: score.all_similarities(texts, fields, fields.where("level <= 1"), models, built).select("id", "name", "dense", "sparse", "entity")
    got = rows(run())
    assert len(got) == texts.count() * 9
    monkeypatch.setattr(score, "MAX_BROADCAST_VECTORS", 1)
    assert rows(run()) == got


def test_lengths_of_a_large_vocabulary_are_the_same(inputs, monkeypatch):
    texts, _, _, models = inputs
    counts = scoring.term_counts(texts, "id", "text").cache()
    run = lambda: {r.id: round(r.squared, 9) for r in scoring.squared_lengths(counts, models.frequency, models.n, "id").collect()}
    want = run()
    monkeypatch.setattr(scoring, "MAX_BROADCAST_WEIGHTS", 10)
    assert run() == want and len(want) > 45


def test_a_text_is_dealt_and_not_its_pairs_or_terms(spark, inputs):
    """Every pair of a text and a topic was dealt, with each term of the text for the sparse part."""
    _, fields, children, models = inputs
    rng = random.Random(12)
    texts = spark.createDataFrame([(f"d{i}", " ".join(rng.sample([f"w{k}" for k in range(40)], 30))) for i in range(400)], "id string, text string")
    out = score.score_corpus(texts, fields, children, models, lambda _, build: build().cache())
    assert shuffled(out) < 4000


def test_a_text_of_the_corpus_is_cleaned_once(spark, sf):
    plan = pipeline.corpus(Roles(spark, sf).doc_meta(), Roles(spark, sf).doc_sources())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2  # two patterns; the test for empty texts cleaned every text again
