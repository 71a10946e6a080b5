"""What is shuffled grows with the input and not with what the input opens or touches."""

import random

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from topicloom.functions import vectors
from topicloom.operators import scoring
from topicloom.plans import analysis, packed, pipeline


def shuffled(df) -> int:
    """Rows written to shuffles by one run of `df`."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    total, todo, seen = 0, [df._jdf.queryExecution().executedPlan()], set()
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            todo.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return total


def taxonomy(spark, suppliers):
    names = [("R", 0), ("N", 1)] + [(f"S{i:05d}", 2) for i in range(suppliers)]
    meta = spark.createDataFrame(names, "name string, level int")
    children = spark.createDataFrame([("R", "N")] + [("N", n) for n, level in names if level == 2], "parent_name string, child_name string")
    return meta, children


def test_constrained_scores_meet_a_documents_own_topics_only(spark):
    meta, children = taxonomy(spark, 2000)
    long = [(f"d{d}", level, name, score) for d in range(20) for name, level, score in (("R", 0, 1.0), ("N", 1, 0.5), (f"S{d:05d}", 2, 0.25))]
    scores = spark.createDataFrame(long, "merged_id string, level int, name string, score double")
    out = scoring.constrained_scores(scores, meta, children)
    assert out.count() == 60
    assert shuffled(out) < 20_000  # 40,000 were the pairs of documents and topics below alone


def test_packed_constraints_equal_long_ones(spark, sf, tmp_path):
    rng = random.Random(3)
    meta = spark.createDataFrame([(f"A{i}", 0) for i in range(4)] + [(f"B{i}", 1) for i in range(6)] + [(f"C{i}", 2 + i % 2) for i in range(30)], "name string, level int")
    children = spark.createDataFrame(
        [(f"A{i % 4}", f"B{i}") for i in range(6)] + [(f"A{(i + 1) % 4}", f"B{i}") for i in range(3)] + [(f"B{rng.randrange(6)}", f"C{i}") for i in range(28)] + [("B0", "C3")],
        "parent_name string, child_name string",
    ).distinct()
    levels = {r.name: r.level for r in meta.collect()}
    long = [(f"d{d}", levels[n], n, rng.randrange(0, 12) / 10) for d in range(60) for n in rng.sample(sorted(levels), 25)]
    scores = spark.createDataFrame(long, "merged_id string, level int, name string, score double")
    table = packed.topic_table(meta).cache()
    docs = scores.join(table.drop("level", "copies"), "name").groupBy("merged_id").agg(F.collect_list(F.struct("topic", "score")).alias("e"))
    docs = docs.select("merged_id", F.col("e.topic").alias("topics"), F.col("e.score").cast("array<float>").alias("scores"))
    topics = packed.Topics(table)
    rows = lambda df: sorted(map(tuple, df.select("merged_id", "level", "name", "score", "rank").collect()))
    assert rows(packed.constrained_scores(docs, topics, children, meta, lambda _, build: build())) == rows(scoring.constrained_scores(scores, meta, children))
    ranked = packed.ranked_long(docs, topics).select("merged_id", "level", "name", "score", F.col("field_rank").alias("rank"))
    expected = pipeline.ranked_long(scores.drop("level"), meta).withColumnRenamed("field_rank", "rank")
    assert rows(ranked) == rows(expected)


def test_neighbours_send_one_row_and_keep_their_counts(spark):
    edges = spark.createDataFrame([("u", "a"), ("a", "u"), ("u", "a"), ("u", "b"), ("u", "c"), ("c", "v"), ("a", "b"), ("u", "v")], "merged_id string, ref_id string")
    scored = spark.createDataFrame([("a", [0, 2], [0.5, 1.0]), ("b", [2], [0.1]), ("c", [], [])], "merged_id string, topics array<int>, scores array<float>")
    near = packed.neighbors(edges, scored, "topics", "scores")
    assert sorted((r.merged_id, r.neighbor_id) for r in near.collect()) == [("u", "a"), ("u", "b"), ("u", "c"), ("v", "c")]
    got = {r.merged_id: (r.neighbors_count, sorted((e.topic, round(e.mean, 9), e.n) for e in r.e)) for r in packed.imputed(near).collect()}
    assert got == {"u": (3, [(0, 0.5, 1), (2, 0.55, 2)]), "v": (1, [])}


def test_the_chain_shuffles_documents_and_edges(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    for name in ("imputed_scores", "field_scores", "top_fields_exploded", "neighbor_scores", "agreement_alpha"):
        assert shuffled(entry.queries()[name](spark, sf)) < 6 * lines, name


def test_float_scores_come_back_exact(spark):
    values = [i / 10000 for i in range(0, 20001, 7)] + [123.4567]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.e for r in df.select(packed.exact(F.col("v").cast("float")).alias("e")).collect()] == values


def test_named_vectors_shuffle_the_rows_that_name_them(spark):
    rng = random.Random(4)
    known = {f"t{i}": [rng.uniform(-1, 1) for _ in range(48)] for i in range(30)}
    table = spark.createDataFrame(list(known.items()), "term string, vector array<double>")
    words = [(f"d{d}", t, rng.randrange(1, 5)) for d in range(50) for t in rng.sample([*known, "unknown"], 20)] + [("none", "unknown", 1)]
    out = analysis.sentence_vectors(spark.createDataFrame(words, "id string, term string, tf long"), table, "id")
    got = {r.id: r.vector for r in out.collect()}
    assert set(got) == {f"d{d}" for d in range(50)}
    unit = {t: np.array(v) / np.linalg.norm(v) for t, v in known.items()}
    for d, v in got.items():
        want = sum(tf * unit[t] for i, t, tf in words if i == d and t in unit)
        assert np.allclose(v, want / np.linalg.norm(want))
    assert shuffled(out) <= len(words) + len(known)  # not a row for each of 48 elements
    entities = analysis.entity_vectors(
        spark.createDataFrame([("t1", "t1", 2), ("t1", "t2", 1), ("t2", "t2", 1), ("x", "unknown", 1)], "id string, mention string, n long"),
        table.withColumnRenamed("term", "mention"), "id", exclude_self=True,
    )
    got = {r.id: r.vector for r in entities.collect()}
    assert np.allclose(got["t1"], unit["t2"]) and not any(got["t2"]) and not any(got["x"]) and len(got) == 3


def test_vectors_of_unequal_length_are_summed_to_the_longest(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [1.0, 0.0, 5.0]), ("b", [3.0]), ("c", None)], "k string, v array<double>")
    assert {r.k: r.v for r in vectors.vector_sum(rows, ["k"], "v", unit=False).collect()} == {"a": [2.0, 2.0, 5.0], "b": [3.0], "c": None}
