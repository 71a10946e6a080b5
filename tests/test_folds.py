"""Folds of a document's rows against plain Python, in batches that cut documents, and what the chain's plans gather."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from topicloom.functions import folds
from topicloom.plans import packed
from topicloom.sources.roles import Roles


def batches(table: pa.Table, size: int):
    return iter(table.combine_chunks().to_batches(max_chunksize=size))


def half_up(x, digits=4):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_rounding_is_by_decimal_digits(spark):
    rng = random.Random(5)
    values = [rng.uniform(0, 1) for _ in range(3000)] + [i / 20000 for i in range(2000)] + [rng.randrange(1, 300) / 7 for _ in range(500)] + [-0.00005, 123456.00005]
    got = folds.half_up(np.array(values)).tolist()
    assert got == [half_up(v) for v in values]
    assert got == [r.r for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 4).alias("r")).collect()]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_shares_of_lines_in_any_batches(size):
    rng = random.Random(size)
    ids = sorted(rng.randrange(40) for _ in range(200))
    lines = [(None if i == 0 else f"d{i:02d}", rng.randrange(3), rng.choice([3, 4, None]), rng.choice([None, 9]), rng.choice([1.25, 10.5, None])) for i in ids]
    table = pa.table({"id": pa.array([x[0] for x in lines]), **{f"t{k}": pa.array([x[1 + k] for x in lines], pa.int32()) for k in range(3)}, "w": pa.array([x[4] for x in lines], pa.float64())})
    got = {}
    for b in folds.shares(3, [4])(batches(table, size)):
        for d, topics, scores in zip(*(c.to_pylist() for c in b.columns), strict=True):
            assert d not in got
            got[d] = sorted(((-1 if t is None else t), s) for t, s in zip(topics, scores, strict=True)) if None not in scores else None
    assert set(got) == {x[0] for x in lines}
    for d in got:
        own = [x for x in lines if x[0] == d]
        weights = [x[4] for x in own if x[4] is not None]
        sums = {}
        for x in own:
            for k in range(3):
                if x[1 + k] != 4:
                    sums.setdefault((k if x[1 + k] is None else None, x[1 + k]), []).append(x[4])
        if any(all(v is None for v in s) for s in sums.values()) or not weights:
            assert got[d] is None
            continue
        want = [(-1 if t is None else t, float(np.float32(half_up(sum(v for v in s if v is not None) / sum(weights))))) for (_, t), s in sums.items()]
        assert got[d] == sorted(want), d


@pytest.mark.parametrize("size", [1, 3, 500])
def test_means_of_neighbours_in_any_batches(size):
    rng = random.Random(size)
    rows = []
    for d in sorted(rng.randrange(30) for _ in range(150)):
        topics = rng.sample(range(6), rng.randrange(0, 5))
        rows.append((f"d{d:02d}", topics, [rng.randrange(0, 10001) / 10000 for _ in topics]))
    rows += [("e", [1], [1.0])] * 400  # one document over many batches
    rows += [("f", [], [])]
    table = pa.table({"id": [r[0] for r in rows], "topics": pa.array([r[1] for r in rows], pa.list_(pa.int32())), "scores": pa.array([r[2] for r in rows], pa.list_(pa.float32()))})
    want = {}
    for d, topics, scores in rows:
        n, sums = want.setdefault(d, [0, {}])
        want[d][0] += 1
        for t, s in zip(topics, scores, strict=True):
            sums.setdefault(t, []).append(round(s * 10000))
    got = {r["merged_id"]: r for b in folds.neighbour_means()(batches(table, size)) for r in b.to_pylist()}
    assert {d: (r["neighbors_count"], [(e["topic"], e["n"]) for e in r["e"]]) for d, r in got.items()} == {d: (n, [(t, len(s)) for t, s in sorted(sums.items())]) for d, (n, sums) in want.items()}
    assert all(math.isclose(e["mean"], sum(want[d][1][e["topic"]]) / e["n"] / 10000) for d, r in got.items() for e in r["e"])
    scores = {r["merged_id"]: r for b in folds.neighbour_scores(1e-9)(batches(table, size)) for r in b.to_pylist()}
    for d, (n, sums) in want.items():
        expected = [float(np.float32(half_up(sum(s) / len(s) / 10000 * (len(s) / n) + 1e-9))) for _, s in sorted(sums.items())]
        assert (scores[d]["topics"], scores[d]["scores"]) == (sorted(sums), expected)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_aggregate_gathers_entries(spark, sf):
    """They were exploded and collected again, in memory that grew with a partition's entries and was spilled."""
    r = Roles(spark, sf)
    scored = r.packed_scores()
    for df in (scored, r.packed_scores([1]), packed.imputed(packed.neighbors(r.edge_rows(), scored, "topics", "scores"))):
        assert "collect_list" not in plan_of(df)


def test_checks_of_identifiers_move_no_scores(spark, sf):
    """Neighbours' rows were dealt twice and folded for a question about identifiers alone."""
    for name in ("check_distinct_ids", "check_imputed_not_empty", "check_neighbors_not_empty", "check_score_names_in_meta"):
        assert "InArrow" not in plan_of(entry.queries()[name](spark, sf)), name


def test_imputed_pairs_are_those_with_entries(spark):
    edges = spark.createDataFrame([("u", "a"), ("a", "u"), ("v", "c"), ("w", "x"), ("w", "b"), ("a", "b")], "merged_id string, ref_id string")
    scored = spark.createDataFrame([("a", [0], [0.5]), ("b", [2], [0.0]), ("c", [], [])], "merged_id string, topics array<int>, scores array<float>")
    of = spark.createDataFrame([("w",), ("v",)], "merged_id string")
    pairs = lambda df: {(r.merged_id, r.neighbor_id) for r in df.collect()}
    assert pairs(packed.imputed_pairs(edges, scored)) == {("u", "a"), ("w", "b")}
    assert pairs(packed.imputed_pairs(edges, scored, of)) == {("w", "b")}
    assert pairs(packed.known_neighbors(edges, scored)) == {("u", "a"), ("v", "c"), ("w", "b")}
    docs = packed.imputed_docs(packed.neighbors(edges, scored, "topics", "scores"))
    assert {r.merged_id: r.topics for r in docs.collect()} == {"u": [0], "v": [], "w": [2]}
