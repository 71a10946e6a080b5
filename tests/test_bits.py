"""Sets of numbers as bits, and what the checks of the score chain deal by them."""

import random

import __spark_entry__ as entry
from pyspark.sql import functions as F
from test_folds import plan_of
from test_scale import shuffled
from topicloom.functions import bits
from topicloom.plans import packed
from topicloom.sources.roles import Roles


def now(_, build):
    return build().cache()


def test_bits_are_sets(spark):
    rng = random.Random(2)
    some = [rng.randrange(-300, 300) for _ in range(150)] + [2**62, -(2**62)]
    rows = spark.createDataFrame([(k, k % 3 == 0) for k in some] + [(None, True)], "k long, third boolean")
    words = bits.words(rows, "k", now, third=F.col("third"))
    asked = spark.createDataFrame([(k,) for k in [*range(-320, 320), 2**62, -(2**62), None]], "q long")
    got = bits.flagged(asked, "q", words, own="known", third="third").collect()
    assert len(got) == 643
    assert {r.q for r in got if r.own} == set(some)
    assert {r.q for r in got if r.third} == {k for k in some if k % 3 == 0}


def edges_and_scores(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(900)] + [(399, k) for k in range(0, 390, 3)] + [(k, 398) for k in range(1, 9)] + [(397, 6)]
    kinds = [([0, 1], [0.5, 0.5]), ([2], [0.0]), ([], []), ([1], [0.00004]), ([None], [0.9]), ([0, 3], [0.4, -0.4]), ([3], [None])]
    scored = [(k, *kinds[rng.randrange(7) if k % 2 else 3]) for k in range(395) if k % 5]
    return spark.createDataFrame(edges, "merged_id long, ref_id long").cache(), spark.createDataFrame(scored, "merged_id long, topics array<int>, scores array<float>").cache()


def test_pairs_by_bits_are_those_by_joins(spark):
    edges, scored = edges_and_scores(spark)
    words = packed.scored_words(scored, now)
    rows = lambda df: sorted(map(tuple, df.select("merged_id", "neighbor_id").collect()))
    assert rows(packed.known_neighbors(edges, scored, words)) == rows(packed.known_neighbors(edges, scored))
    assert rows(packed.imputed_pairs(edges, scored, words=words)) == rows(packed.imputed_pairs(edges, scored))
    assert rows(packed.neighbors(edges, scored, "topics", words=words)) == rows(packed.neighbors(edges, scored, "topics"))


def test_marks_by_bits_are_those_of_imputed_scores(spark):
    edges, scored = edges_and_scores(spark)
    marks = lambda df: {r.merged_id: (r.filled, r.top) for r in df.collect()}
    got = packed.imputed_marks(edges, scored, packed.scored_words(scored, now), now)
    want = packed.marked(packed.imputed_docs(packed.neighbors(edges, scored, "topics", "scores")))
    assert got.count() == want.count() and marks(got) == marks(want)
    assert set(marks(want).values()) == {(False, False), (True, False), (True, True)}


def test_checks_deal_no_edges(spark, sf):
    """Edges were dealt twice, in both directions."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    for name in ("ids_agree", "ids_in_top_fields", "score_names_in_meta", "imputed_not_empty", "neighbors_not_empty"):
        assert shuffled(entry.queries()[f"check_{name}"](spark, sf)) < lines / 10, name


def test_lines_are_dealt_by_document_alone(spark, sf):
    """A part's topic was joined by dealing every line by its part once the parts were more than Spark broadcasts unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(Roles(spark, sf, numbered=True).packed_scores())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_partkey" not in plan and "hashpartitioning(merged_id" in plan
