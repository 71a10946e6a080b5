"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

from test_llm import WORD, brute_components, brute_hits

import corpus_pipeline
from topicloom.llm import decontaminate, sentencepiece_sampling, toxicity
from topicloom.llm.shared import materialize


def words(text):
    return re.findall(WORD, (text or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER)))


def test_stages_and_run(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(rows, spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")).prepare()
    left = {r.doc_id: r.text for r in rows.collect()}
    left = {i: t for i, t in left.items() if model.score(t or "") < 0.7}
    groups = defaultdict(list)
    for i, t in left.items():
        groups[t or ""].append(i)
    left = {max(g): left[max(g)] for g in groups.values()}
    near = brute_components(list(left.items()))
    left = {i: t for i, t in left.items() if near[i][2]}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = {i: brute_hits(t, items) for i, t in left.items()}
    windows = {tuple(w[k : k + 13]) for _, t in items for w in [words(t)] for k in range(len(w) - 12)}
    whole = {i for i, t in left.items() for w in [words(t)] if any(tuple(w[k : k + 13]) in windows for k in range(len(w) - 12))}
    left = {i: t for i, t in left.items() if i not in whole and not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])}
    assert whole
    v = sentencepiece_sampling.vocabulary(sentencepiece_sampling.model_path())
    ids = sorted(left)
    want = sum(1 for _ in sentencepiece_sampling.sample_chunk(v, [(left[i] or "").encode() for i in ids], sentencepiece_sampling.row_keys(ids), 2))
    before = tables(spark)
    result = corpus_pipeline.run(spark, sf)
    assert len(tables(spark) - before) == 1  # nothing but the result is left
    out = result.collect()
    assert {r.doc_id for r in out} == set(left) and len(out) == want
    for r in out:
        assert v.sp.decode(r.piece_ids) == (left[r.doc_id] or "") and len(r.piece_ids) == r.n_pieces


def tables(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob("topicloom/*"))


def test_stages_take_odd_tables(spark, sf):
    odd = (1, "a", 2, 3, 4, 5)
    docs = spark.createDataFrame(
        [(None, None, None, None, None, *odd), (1, "", "en", "s", 0, *odd), (2, "word " * 30_000, "en", "s", 9, *odd), (2, "word " * 30_000, "en", "s", 9, *odd)],
        "doc_id long, text string, lang string, source string, n_chars long, kept int, __id string, x_size int, f_h long, KEEP_ID int, sample int",
    )
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, sf), "t")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns
    assert now.count() == 0


def test_last_stage_can_be_decoded(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    out = sentencepiece_sampling.decoded_segmentations(corpus_pipeline.encode(spark, docs, sf)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id for r in out} == set(texts) and all(r.decoded == texts[r.doc_id] for r in out)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "sentencepiece"]


def test_one_window_in_a_long_document_is_enough(spark, sf, tmp_path):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()
    own = words(item.text)[:13]
    long = " ".join(f"u{i}" for i in range(3000))
    docs = spark.createDataFrame([(1, f"{long} {' '.join(own)} {long}"), (2, f"{long} {' '.join(own[:12])} {long}")], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.benchmark(spark, docs, sf).collect()] == [2]
