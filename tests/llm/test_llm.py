"""The ten operators: edge cases, brute force and round trips."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from parity import assert_same, database
from pyspark.sql import functions as F

from topicloom.llm import chat_format, decontaminate, exact_dedup, html_extract, minhash, sentencepiece_sampling, token_counts, toxicity, url_filters, warc
from topicloom.llm.components import components
from topicloom.llm.queries import oracle_sql, queries
from topicloom.llm.shared import without_keys

DOCS = "doc_id long, text string, kept string, __x int"
#: The words of the benchmark contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "a", 1),
    (2, "alpha beta gamma delta epsilon zeta", "b", 2),
    (2, "alpha beta gamma delta epsilon zeta", "b", 2),
    (3, None, "c", 3),
    (4, "", None, 4),
    (5, "   \n\t", "d", None),
    (6, LONG, "e", 6),
    (None, "no identifier here", "f", 7),
    (7, "ALPHA beta", "g", 8),
    (8, "alpha BETA", "h", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_parity(spark, sf, name):
    assert_same(spark, database(sf), queries()[name], oracle_sql()[name], sf)


# 1


def test_token_counts(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(token_counts.vocabulary_path("byte_bpe_50k.json"))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect())
    count = lambda t: len(model.encode(t or "", add_special_tokens=False).ids)
    assert got == Counter((i, len((t or "").encode()), count(t), count(t) > 1024) for i, t, *_ in ROWS)
    assert token_counts.token_counts(none).count() == 0
    cache = str(tmp_path / "cache")
    first = token_counts.token_counts(docs, cache_path=cache).count()
    rows = spark.read.parquet(cache).count()
    assert token_counts.token_counts(docs, cache_path=cache).count() == first == len(ROWS)
    assert spark.read.parquet(cache).count() == rows == len({t or "" for _, t, *_ in ROWS})
    enc = token_counts.encoding(token_counts.vocabulary_path("byte_bpe_50k.tiktoken"), token_counts.vocabulary_path("byte_bpe_50k.json"))
    odd = ["<|endoftext|> a", "it's 123 \n\n  x\t　y   z", "İI ñé 日本語 🏽‍♂️ \x00 ﻿", "don'T I'LL", "a\u0085 c", " " * 50 + "x", " \x1c\x1d a", "²³ ½ Ⅷ ①"]
    model_path = token_counts.vocabulary_path("byte_bpe_50k.json")
    assert [token_counts.n_tokens(enc, t, model_path) for t in odd] == [count(t) for t in odd]


@pytest.mark.parametrize("text", [" " * 2_000_000, "\t" * 2_000_000, "\n" * 2_000_000, "a" + " " * 2_000_000 + "b", "word " * 10 + " \t" * 500_000 + "x", "1" * 500_000, "日本" * 100_000], ids=range(7))
def test_token_counts_of_any_text(text):
    from tokenizers import Tokenizer

    paths = [token_counts.vocabulary_path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json")]
    want = len(Tokenizer.from_file(paths[1]).encode(text, add_special_tokens=False).ids)
    assert token_counts.n_tokens(token_counts.encoding(*paths), text, paths[1]) == want


def test_token_cache(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    want = Counter(map(tuple, token_counts.token_counts(docs, cache_path=cache).collect()))
    # A second writer appends the same rows; the result doesn't double.
    spark.read.parquet(cache).write.mode("append").parquet(cache)
    assert Counter(map(tuple, token_counts.token_counts(docs, cache_path=cache).collect())) == want
    token_counts.compact_cache(spark, cache)
    assert spark.read.parquet(cache).count() == len({t or "" for _, t, *_ in ROWS})
    # The query serves stored counts: marked ones come back.
    marked = str(tmp_path / "marked")
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(7_000_000).cast("long")).write.parquet(marked)
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set(token_counts.CACHE_SETTING, marked)
    try:
        assert {r.n_tokens for r in token_counts.op1_token_counts(spark, str(tmp_path)).collect()} == {7_000_000}
    finally:
        spark.conf.unset(token_counts.CACHE_SETTING)


def test_token_counts_of_documents(spark, sf):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(token_counts.vocabulary_path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries()["op1_token_counts"](spark, sf).collect():
        assert r.n_tokens == len(model.encode(texts[r.doc_id], add_special_tokens=False).ids)


# 2


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(docs, none, keep, weak):
    digest = (lambda t: F.unhex(F.substring(F.sha2(t.cast("binary"), 256), 1, 2)).substr(1, 0)) if weak else exact_dedup.sha256_digest
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    pick = lambda ids: (max if keep == "max" else min)([i for i in ids if i is not None], default=None)
    want = Counter((i, pick(groups[t or ""]), len(groups[t or ""]), i == pick(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS)
    out = exact_dedup.exact_groups(docs, keep=keep, digest=digest, memtable_rows=2, fanout=2)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()) == want
    assert "__x" in out.columns
    assert exact_dedup.exact_groups(none).count() == 0


def test_exact_dedup_keeps_columns(docs):
    out = exact_dedup.exact_dedup(docs)
    assert out.columns == docs.columns
    assert {r.kept for r in out.collect()} == {"b", None, "d", "e", "f", "g", "h"}


def test_hot_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr("topicloom.llm.shared.BROADCAST_ROWS", 0)
    monkeypatch.setattr("topicloom.llm.shared.HOT_ONE_IN", 50)
    rows = [(i, "the same text" if i % 3 else f"text {i % 40}") for i in range(900)] + [(None, "the same text"), (None, "x")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(-1 if i is None else i)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect())
    keeper = {t: None if max(g) < 0 else max(g) for t, g in groups.items()}
    assert got == Counter((i, keeper[t], len(groups[t]), i == keeper[t]) for i, t in rows)
    counted = Counter((r.doc_id, r.n_bytes) for r in token_counts.token_counts(docs).collect())
    assert counted == Counter((i, len(t)) for i, t in rows)


def test_digest_index_files(spark, tmp_path):
    import pyarrow.parquet as pq

    keyed = spark.range(1000).select((F.col("id") % 700).alias("id"), exact_dedup.sha256_digest((F.col("id") % 300).cast("string")).alias("digest"))
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), memtable_rows=60, fanout=4)
    index.flush(keyed.repartition(211), 1000)
    assert index.runs == 17
    while True:
        files = sorted((tmp_path / "index").glob("level=*/run=*/slice=*/*.parquet"))
        assert len({f.parent for f in files}) == len(files)  # one file a run and slice
        for f in files:
            digests = pq.ParquetFile(f).read().column("digest").to_pylist()
            assert digests == sorted(set(digests)) and f.stat().st_size < 3000 + 250 * len(digests)
        if index.runs == 1:
            break
        index.merge_level()
    got = {bytes(r.digest): (r.min_id, r.max_id, r.n) for r in index.read().collect()}
    want = defaultdict(list)
    for i in range(1000):
        want[hashlib.sha256(str(i % 300).encode()).digest()].append(i % 700)
    assert got == {d: (min(v), max(v), len(v)) for d, v in want.items()}
    assert not list((tmp_path / "index").glob("level=0"))
    some = [hashlib.sha256(b"7").digest(), hashlib.sha256(b"299").digest(), b"unknown"]
    assert {bytes(r.digest): r.n for r in index.probe(some).collect()} == {d: len(want[d]) for d in some[:2]}
    assert "In(digest" in index.probe(some)._jdf.queryExecution().executedPlan().toString()


# 3


def test_url_filters(spark):
    c = [(1, "http://user@A.Example.com:80/p/q/?x#y", "2024-01-05"), (2, "https://b.example.com", "2024-01-05"), (3, None, "2024-01-05"), (4, "nonsense", "2024-01-05"), (5, "http://a.example.com/p", None), (5, "http://a.example.com/p", None), (6, "http://a.example.com/px", "2024-01-09")]
    captures = spark.createDataFrame(c, "page_id long, url string, fetch_date string")
    feed = [("host", "example.com", "2024-01-01 10:00:00", True), ("host", "example.com", "2024-01-03 09:00:00", True), ("host", "example.com", "2024-01-05 23:00:00", False), ("url", "a.example.com/p", "2024-01-05 01:00:00", True), ("host", "", "2024-01-01 00:00:00", True), ("host", "b.example.com", None, True), ("host", "b.example.com", "2024-01-02 00:00:00", None)]
    changes = spark.createDataFrame(feed, "kind string, key string, at string, listed boolean").withColumn("at", F.to_timestamp("at"))
    got = {(r.page_id, r.n_entries, r.first_entry, r.blocked) for r in url_filters.filter_urls(captures, changes).collect()}
    assert got == {(1, 1, "url:a.example.com/p", True), (2, 0, None, False), (3, 0, None, False), (4, 0, None, False), (5, 0, None, False), (6, 0, None, False)}
    assert url_filters.filter_urls(captures, changes).count() == len(c)
    assert url_filters.filter_urls(captures.limit(0), changes).count() == 0
    assert url_filters.filter_urls(captures, changes.limit(0)).where("blocked").count() == 0
    spans = {tuple(map(str, r)) for r in url_filters.intervals(changes).collect()}
    assert ("host", "example.com", "2024-01-01", "2024-01-05") in spans


def test_url_filters_at_instants(spark):
    feed = [("host", "e.com", "2024-01-05 23:00:00", True), ("host", "f.com", "2024-01-05 08:00:00", True), ("host", "f.com", "2024-01-05 09:00:00", False), ("url", "f.com/a", "2024-01-05 08:30:00", True), ("url", "f.com/a", "2024-01-05 08:30:00", False)]
    changes = spark.createDataFrame(feed, "kind string, key string, at string, listed boolean").withColumn("at", F.to_timestamp("at"))
    c = [("http://e.com", "02:00:00", 0), ("http://e.com", "22:59:59", 0), ("http://e.com", "23:00:00", 1), ("http://f.com", "07:59:59", 0), ("http://f.com", "08:00:00", 1), ("http://f.com", "08:59:59", 1), ("http://f.com", "09:00:00", 0), ("http://f.com/a", "08:45:00", 2), ("http://f.com/a", None, 0)]
    rows = [(i, u, t and f"2024-01-05 {t}") for i, (u, t, _) in enumerate(c)]
    for kind in ("timestamp", "timestamp_ntz"):
        captures = spark.createDataFrame(rows, "page_id long, url string, fetch_date string").withColumn("fetch_date", F.col("fetch_date").cast(kind))
        got = {r.page_id: (r.n_entries, r.blocked) for r in url_filters.filter_urls(captures, changes).collect()}
        assert got == {i: (n, n > 0) for i, (_, _, n) in enumerate(c)}


def test_url_filters_against_brute_force(spark):
    rng = np.random.default_rng(3)
    hosts = ["a.com", "x.a.com", "b.org", "y.x.a.com"]
    at = lambda n: np.datetime64("2024-01-01") + np.timedelta64(int(n), "s")
    feed = [("host", hosts[rng.integers(4)], str(at(rng.integers(200_000) // 60 * 60)), bool(rng.integers(2))) for _ in range(900)]
    feed += [("url", hosts[rng.integers(4)] + "/p", str(at(rng.integers(200_000))), bool(rng.integers(2))) for _ in range(300)]
    c = [(i, f"http://{hosts[rng.integers(4)]}/{'pq'[rng.integers(2)]}", str(at(rng.integers(-9, 200_000) // 60 * 60))) for i in range(2000)]
    captures = spark.createDataFrame(c, "page_id long, url string, at string").select("page_id", "url", F.col("at").cast("timestamp").alias("fetch_date"))
    changes = spark.createDataFrame(feed, "kind string, key string, at string, listed boolean").withColumn("at", F.col("at").cast("timestamp"))
    # Rows that have no fixed place: numbers drawn twice would differ.
    shuffled = captures.unionByName(captures).repartition(5).dropDuplicates(["page_id"])
    state = defaultdict(dict)
    for kind, key, t, listed in feed:
        state[kind, key][t] = state[kind, key].get(t, False) or listed

    def active(kind, key, t):
        own, run, last = state.get((kind, key), {}), None, False
        for when in sorted(own):
            if when <= t:
                run, last = (when if own[when] and not last else run), own[when]
        return run if last else None

    want = {}
    for i, url, t in c:
        host, path = url[7:].split("/")
        parts = host.split(".")
        asked = [("host", ".".join(parts[k:])) for k in range(len(parts))] + [("url", host), ("url", f"{host}/{path}")]
        found = [(f"{kind}:{key}", since) for kind, key in asked if (since := active(kind, key, t))]
        want[i] = (len(found), min((f for f, _ in found), default=None), min((s for _, s in found), default=None))
    got = {r.page_id: (r.n_entries, r.first_entry, r.since and r.since.isoformat()) for r in url_filters.filter_urls(shuffled, changes).collect()}
    assert got == want
    spans = url_filters.intervals(changes, exact=True).collect()
    for r in spans:
        t = r.valid_from.isoformat()
        assert active(r.kind, r.key, t) == t and (r.valid_until.year == 9999 or active(r.kind, r.key, r.valid_until.isoformat()) is None)


def test_url_filters_beside_other_columns_and_long_urls(spark, monkeypatch):
    long = "http://e.com/" + "/".join(["s"] * 3000)
    rows = [(1, long, "2024-01-05", 9, "k"), (1, long, "2024-01-05", 9, "k"), (2, "http://e.com/" + "x" * 500_000, "2024-01-05", 9, "k")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetch_date string, row int, key string")
    changes = spark.createDataFrame([("url", "e.com/s/s/s", "2024-01-01", True)], "kind string, key string, at string, listed boolean").withColumn("at", F.to_timestamp("at"))
    for bound in (200_000, 0):  # with the answers broadcast, and with the hot ones apart
        monkeypatch.setattr("topicloom.llm.shared.BROADCAST_ROWS", bound)
        got = Counter((r.page_id, r.url, r.blocked) for r in url_filters.filter_urls(captures, changes).collect())
        assert got == {(1, long, True): 2, (2, rows[2][1], False): 1}


# 4


def wanted(page):
    return [t for t, state in html_extract.blocks(page) if state == 0]


def test_html_blocks():
    page = '<body><nav>menu</nav><div class="ad">ad</div><article><h1>T&amp;t</h1><p>one <b>wo</b>rd<br>two<p>three<script>x</script><div id="comments">c</div></article><footer>f'
    assert html_extract.blocks(page) == [("T&t", 0), ("one word two", 0), ("three", 0)]
    assert html_extract.blocks("") == []
    assert html_extract.blocks("<p>a<form>no</form>b<aside>no</aside>") == [("a", 1), ("b", 1)]
    assert html_extract.blocks("x < y <b>3</b><p title=it's>hey</p><![CDATA[a<b]]>") == [("x < y 3", 1), ("hey", 1), ("a<b", 1)]


def test_html_names_neither_drop_ancestors_nor_headings():
    assert wanted('<div class="layout has-sidebar"><article><p>x</article></div>') == ["x"]
    assert wanted('<div class="sidebar"><article>buried, but all there is</article></div>') == ["buried, but all there is"]
    assert wanted('<article><h2 class="section-header">Methods</h2>a</article>') == ["Methods", "a"]
    assert html_extract.blocks('<article><p class="related work">r</p><p>z</article>') == [("r", 1), ("z", 0)]
    assert wanted('<article><p>a</p><div class="social-share">no</div><div class="cookie-banner">no</div><p>b</article>') == ["a", "b"]
    assert wanted("<main><p>real</p><section><h2>Comments (3)</h2><p>first!</section><p>more</main>") == ["real", "more"]
    assert wanted("<main><p>real</p><h2>Comments</h2><p>first!</main>") == ["real"]
    assert wanted("<article><p>on</p><h2>Comments on the method</h2><p>stay</article>") == ["on", "Comments on the method", "stay"]
    assert wanted("<article><p>the real article</article><article><a href=/x>teaser of another</a></article>") == ["the real article"]
    assert wanted("<main>a<article>b</article></main><article>elsewhere</article>") == ["a", "b"]


@pytest.mark.parametrize(
    "bad",
    ["<a b " * 200_000, "<i>" * 330_000, "<svg>" * 200_000, "<![CDATA[" * 110_000, "<p " + '="' * 400_000, "<div>" * 200_000, "<b><p>" * 150_000, "<div>" + "<b>" * 60_000 + "<h1></h1>" * 60_000, "<" * 1_000_000, "<p><span>" * 60_000 + "<h2>q</h2>" * 60_000, "<a href='" * 110_000, "&" * 1_000_000],
    ids=range(12),
)
def test_html_time_grows_with_length(bad):
    import time

    began = time.process_time()
    html_extract.blocks(bad)
    assert time.process_time() - began < 2


def test_html_in_doubt_against_brute_force(spark):
    """Pages of two hosts without article: a block goes if runs of six tokens on three distinct pages cover it whole."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    common = [" ".join(rng.choice(words, n)) for n in (14, 9, 5, 30, 4, 3)]
    rows, texts = [], {}
    for i in range(60):
        host = "one.example" if i < 45 else "two.example"
        own = [" ".join(rng.choice(words, rng.integers(3, 25))) for _ in range(3)]
        blocks = [common[rng.integers(6)], own[0], common[0], own[1] + " " + common[1], *common[4:6], own[2]]
        texts[i] = (host, blocks)
        rows.append((i, f"http://{host}/{i}", "".join(f"<div>{b}</div>" for b in blocks)))
    rows += [(100 + i, *rows[7][1:]) for i in range(5)]  # copies of one page
    texts |= {100 + i: texts[7] for i in range(5)}
    run = 6
    stand = defaultdict(set)
    for host, blocks in texts.values():
        t = " ".join(blocks).split(" ")
        for k in range(len(t) - run + 1):
            stand[host, tuple(t[k : k + run])].add(tuple(blocks))
    want = {}
    for i, (host, blocks) in texts.items():
        t = " ".join(blocks).split(" ")
        covered = [any(len(stand[host, tuple(t[k : k + run])]) >= 3 for k in range(max(0, j - run + 1), min(j, len(t) - run) + 1)) for j in range(len(t))]
        at, kept = 0, []
        for b in blocks:
            n = len(b.split(" "))
            if not all(covered[at : at + n]):
                kept.append(b)
            at += n
        want[i] = " ".join(kept)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("parts", F.lit("x")).repartition(4)
    assert any(common[0] not in w for w in want.values()) and all(texts[i][1][1] in w for i, w in want.items())
    for shard_tokens in (200_000, 150):
        got = {r.page_id: r.text for r in html_extract.extract_text(pages, run=run, shard_tokens=shard_tokens).collect()}
        assert got == want


def test_html_keeps_sentences_and_copies(spark):
    rows = [(i, f"http://h.example/{i}", f"<div>He woke up in the middle of the night and left number {i}.</div>") for i in range(5)]
    rows += [(9, "http://h.example/9", "<p>A page without an article element that is stored more than once, word for word, as it is.</p>")] * 4
    got = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = Counter(r.text for r in html_extract.extract_text(got).collect())
    assert texts == Counter(re.sub("<[^>]*>", "", h) for _, _, h in rows)


def test_html_extract(spark, sf):
    bar = "All rights reserved by this fine site of ours since nineteen ninety"
    rows = [(i, f"http://h.example/{i}", f"<div>{bar}</div><div>only{i} these{i} words{i} stand{i} alone{i} here{i} now{i}</div>") for i in range(4)]
    rows += [(10, "http://h.example/x", f"<article>{bar} kept</article><div>{bar}</div>"), (11, None, None), (12, "http://o.example", f"<div>{bar}</div>"), (13, "http://h.example/e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(pages).collect()}
    assert got[10][0] == f"{bar} kept" and got[12][0] == bar and got[11] == ("", 0) and got[13] == ("", 0)
    for i in range(4):
        assert got[i] == (t := f"only{i} these{i} words{i} stand{i} alone{i} here{i} now{i}", len(t))
    assert html_extract.extract_text(pages.limit(0)).count() == 0
    import html

    for r in queries()["op4_html_extraction"](spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", body)).split())


def test_suffix_array():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 200)
    order, rank = html_extract.suffix_array(codes, 6)
    keys = [tuple(codes[i : i + 6].tolist()) for i in range(200)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, 200, 7) for j in range(200))


# 5


def brute_hits(text, items, n=13):
    low = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
    words = lambda t: re.findall(WORD, (t or "").translate(low))
    w, hit, found = words(text), set(), set()
    for name, body in items:
        b = words(body)
        k = min(n, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_contamination(spark, docs, none, bound):
    items = [(1, "Alpha, BETA gamma"), (2, "alpha beta"), (3, None), (4, "..."), (10, LONG[:3000]), (11, "never seen words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in decontaminate.contamination(docs, benchmark, max_broadcast_grams=bound).collect())
    want = Counter()
    for i, t, *_ in ROWS:
        n, h, f = brute_hits(t, items)
        want[(i, n, h, tuple(f), h > 0 and 20 * h >= n)] += 1
    assert got == want
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_decontaminate(spark, docs):
    benchmark = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    out = decontaminate.decontaminate(docs, benchmark)
    assert out.columns == docs.columns and {r.kept for r in out.collect()} == {"c", None, "d", "e", "f", "g", "h"}
    cut = {r.kept: r.text for r in decontaminate.decontaminate(docs, benchmark, mode="spans").collect()}
    assert cut["a"] == "alpha delta epsilon zeta" and cut["g"] == "ALPHA beta" and cut["c"] is None and cut["e"] == LONG


def test_decontaminate_by_one_window(spark):
    item = " ".join(f"q{i}" for i in range(20))
    long = " ".join(f"d{i}" for i in range(2000))
    rows = [(1, f"{long} Q3, {' '.join(f'q{i}' for i in range(4, 16))} {long}"), (2, f"{long} {' '.join(f'q{i}' for i in range(4, 16))}"), (3, item), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = lambda **o: {r.doc_id for r in decontaminate.decontaminate(docs, benchmark, **o).collect()}
    assert left() == {2, 4} and left(rule="share") == {1, 2, 4}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark, mode="spans").collect()}
    assert cut == {1: f"{long} {long}", 2: rows[1][1], 3: "", 4: None}


CLASHING = "__f_h long, __id string, __body string, __hit int, __variant string, __spans string, KEEP_ID long, x_keeper int, f_maybe int, k_id int, x_digest string, Text2 string"


def test_clashing_columns_stay(spark):
    rows = [(i % 40, f"text number {i % 30} with a few more words to make it long enough for windows {i % 30}", *[7, "a", "b", 1, "c", "d", 9, 5, 6, 8, "e", "f"]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + CLASHING)
    benchmark = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    kept = {tuple(r) for r in docs.collect()}
    for out in (exact_dedup.exact_dedup(docs), decontaminate.decontaminate(docs, benchmark), minhash.near_dedup(docs)):
        assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= kept and 0 < out.count() < 80
    spans = decontaminate.decontaminate(docs, benchmark, mode="spans")
    assert spans.columns == docs.columns and {tuple(r)[2:] for r in spans.collect()} == {rows[0][2:]}
    groups = exact_dedup.exact_groups(docs)
    assert [c for c in groups.columns if c.lower() == "keep_id"] == ["keep_id"] and "__f_h" in groups.columns
    assert groups.where("__f_h = 7 and __id = 'a' and x_keeper = 5").count() == 80


# 6


def test_chat_format(spark):
    rows = [
        (1, 1, "assistant", "fine </s> \\ [INST]"),
        (1, 0, "user", "hi <s>[/INST] <<SYS>>é"),
        (1, 2, "tool", None),
        (2, None, None, "x"),
        (2, 0, "system", "<\\s>"),
        (None, 0, "user", "lost"),
        (3, 0, "assistant", LONG),
        (3, 0, "assistant", LONG),
        (4, 0, "[ROLE] odd [/ROLE] ", "y [/TURN]"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert chat_format.parse(out[c].formatted) == turns and out[c].n_turns == len(turns)
        loss = [chat_format.unescape(out[c].formatted[s.start : s.start + s.length]) for s in out[c].loss_spans]
        assert loss == [t for role, t in turns if role == "assistant"]
    assert chat_format.format_chats(df.limit(0)).count() == 0


# 7


def brute_components(rows):
    low = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
    sets, parent = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            index[g].append(i)
    common = Counter((a, b) for own in index.values() for a in own for b in own if a < b)
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c) and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("hot", [False, True])
def test_near_duplicates_brute_force(spark, sf, hot, monkeypatch):
    if hot:  # nothing is broadcast, every other key is hot
        monkeypatch.setattr("topicloom.llm.shared.BROADCAST_ROWS", 0)
        monkeypatch.setattr("topicloom.llm.shared.HOT_ONE_IN", 200)
        monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in rng.integers(0, 5000, 130)]
    for k in range(150):  # one group whose similarities lie on both sides of the threshold
        own = list(base)
        for p in rng.integers(0, 130, int(rng.integers(0, 9))):
            own[p] = f"e{k}-{p}"
        rows.append((10_000 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_edges(docs, none):
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    want = Counter({(1, 1, True): 1, (2, 1, False): 2, (3, 3, True): 1, (4, 4, True): 1, (5, 5, True): 1, (6, 6, True): 1, (None, None, True): 1, (7, 7, True): 1, (8, 7, False): 1})
    assert got == want
    assert minhash.near_duplicates(none).count() == 0
    out = minhash.near_dedup(docs)
    assert out.columns == docs.columns and {r.kept for r in out.collect()} == {"a", "c", None, "d", "e", "f", "g"}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7)] + [(200, k) for k in range(201, 240)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 105: 100, 103: 100, **{k: 200 for k in range(200, 240)}}


def test_bayes_bounds():
    for n in (16, 64, 128):
        m = minhash.least_matches(n)
        assert 0 < m < n * 0.75


# 8


def test_sampled_segmentations(spark, docs, none):
    path = sentencepiece_sampling.model_path()
    out = sentencepiece_sampling.sampled_segmentations(docs, k=3).collect()
    again = sentencepiece_sampling.sampled_segmentations(docs.repartition(1), k=3).collect()
    assert Counter((r.doc_id, r.sample, r.ids_sha256) for r in out) == Counter((r.doc_id, r.sample, r.ids_sha256) for r in again)
    texts = {i: t or "" for i, t, *_ in ROWS}
    by = defaultdict(list)
    for r in out:
        assert sentencepiece_sampling.decode(path, r.piece_ids) == texts[r.doc_id] and r.n_pieces == len(r.piece_ids)
        by[r.doc_id].append(r)
    for i, rows in by.items():
        if i != 2:
            assert len({r.ids_sha256 for r in rows}) == len(rows) == (3 if texts[i] else 1)
        assert all(a.perturbed > b.perturbed for a, b in zip(sorted(rows, key=lambda r: r.sample), sorted(rows, key=lambda r: r.sample)[1:], strict=False)) or i == 2
    assert sentencepiece_sampling.sampled_segmentations(none).count() == 0
    for t in ("日本 \x00é🏽", " two  spaces ", "line\nend", "x" * 300):
        (row,) = [x for x in sentencepiece_sampling.sample_chunk(sentencepiece_sampling.vocabulary(path), [t.encode()], sentencepiece_sampling.row_keys([1]), 1)]
        assert sentencepiece_sampling.decode(path, row[2].tolist()) == t


def test_op8_returns_ids_and_round_trips(spark, docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    path = sentencepiece_sampling.model_path()
    out = sentencepiece_sampling.op8_sentencepiece(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {i for i, *_ in ROWS} and all(r.round_trip for r in out)
    texts = {i: t or "" for i, t, *_ in ROWS}
    for r in out:
        assert sentencepiece_sampling.decode(path, r.piece_ids) == texts[r.doc_id]
        assert hashlib.sha256(np.array(r.piece_ids, dtype="<i4").tobytes()).hexdigest() == r.ids_sha256


def test_decoded_segmentations(spark):
    path = sentencepiece_sampling.model_path()
    texts = ["日本 \x00é🏽", " two  spaces ", "line\nend", "x" * 300, "", "a\tb", "   ", "é" * 200]
    lists = [sentencepiece_sampling.encode(path, t) for t in texts] + [[], None]
    rows = spark.createDataFrame(list(enumerate(lists)), "i int, piece_ids array<int>")
    got = {r.i: r.decoded for r in sentencepiece_sampling.decoded_segmentations(rows).collect()}
    assert got == {i: None if x is None else sentencepiece_sampling.decode(path, x) for i, x in enumerate(lists)}


def every_segmentation(sp, text):
    """{piece ids: probability} by trying every vocabulary piece at every place of the whole text."""
    size = sp.get_piece_size()
    byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
    whole = {sp.id_to_piece(i): i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    goal, found = "▁" + text.replace(" ", "▁"), {}

    def extend(at, ids, weight):
        if at == len(goal):
            found[tuple(ids)] = weight
        for end in range(at + 1, len(goal) + 1):
            if (i := whole.get(goal[at:end])) is not None:
                extend(end, [*ids, i], weight / (2 - min(0.0, sp.get_score(i))))
        if at < len(goal) and goal[at] not in whole:
            own = [byte[x] for x in goal[at].encode()]
            extend(at + 1, ids + own, weight / (2 + size) ** len(own))

    extend(0, [], 1.0)
    total = sum(found.values())
    return {ids: w / total for ids, w in found.items()}


@pytest.mark.parametrize("text", ["the cat", "a    b", "  if x:", "日本語", "re\nx", "🏽é", "http://ab", ". . ."])
def test_sampling_against_enumeration(text):
    S = sentencepiece_sampling
    v, n = S.vocabulary(S.model_path()), 4000
    chance = every_segmentation(v.sp, text)
    rows = list(S.sample_chunk(v, [text.encode()] * n, S.row_keys(list(range(n))), 2))
    for r in rows[:50]:
        assert abs(r[3] - np.log(chance[tuple(r[2].tolist())])) < 1e-9
    first = Counter(tuple(r[2].tolist()) for r in rows if r[1] == 0)
    assert set(first) <= set(chance)
    for ids, p in sorted(chance.items(), key=lambda x: -x[1])[:5]:
        assert abs(first[ids] / n - p) <= 5 * np.sqrt(p * (1 - p) / n) + 1e-12
    # The second is drawn from what the first leaves: P(second = s) is the sum over other firsts f of P(f) P(s) / (1 - P(f)).
    second = Counter(tuple(r[2].tolist()) for r in rows if r[1] == 1)
    for ids, p in sorted(chance.items(), key=lambda x: -x[1])[:5]:
        want = sum(q * p / (1 - q) for f, q in chance.items() if f != ids and q < 1)
        assert abs(second[ids] / n - want) <= 5 * np.sqrt(want * (1 - want) / n) + 1e-9
    assert abs(sum(np.exp(r[3] - r[5]) for r in rows) / n - 1) < 0.05 or len(chance) == 1


def test_library_segmentation_is_reachable():
    S = sentencepiece_sampling
    v = S.vocabulary(S.model_path())
    for t in ["    return x\n        y  =  3\t\n", "日本語のテキスト。漢字かな交じり" * 5, "https://ex.com/" + "Qz7xKp" * 60, "x" * 300, " " * 40 + "x", "🏽‍♂️ ﬁ ﷽ \x00", "def f(a):\n    return a[0]  #  ok"]:
        assert S.segmentation_log_prob(v, t, S.encode(S.model_path(), t)) > -np.inf
    assert S.segmentation_log_prob(v, "ab", S.encode(S.model_path(), "ac")) == -np.inf


def test_long_texts_without_borders():
    S = sentencepiece_sampling
    v = S.vocabulary(S.model_path())
    for t in ["a" * 100_000, " " * 50_000, "word" * 20_000, "ab " * 30_000]:
        rows = list(S.sample_chunk(v, [t.encode()], S.row_keys([5]), 2))
        assert len({r[2].tobytes() for r in rows}) == 2 and all(v.sp.decode(r[2].tolist()) == t for r in rows)
        assert abs(S.segmentation_log_prob(v, t, rows[1][2].tolist()) - rows[1][3]) < 1e-6 * len(t)


# 9


def test_warc(spark, tmp_path):
    trap = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\nContent-Length: 1\r\n\r\ny\r\n\r\n"
    rows = [(1, "http://a/ b\n", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://d", ""), (5, "http://e", trap), (6, "http://f", trap), (7, "http://g", LONG), (7, "http://g", LONG), (None, "http://h", "é日")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, archive_bytes=2000)
    got = warc.read_archives(spark, path, payload=True).collect()
    assert sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to or 0) for r in got) == [
        (-1, "response", 0), (1, "revisit", 2), (2, "response", 0), (3, "revisit", 4), (4, "response", 0), (5, "revisit", 6), (6, "response", 0), (7, "response", 0), (7, "response", 0),
    ]
    body = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        assert r.payload_bytes == len(body[r.page_id])
        if r.record_type == "response":
            assert bytes(r.payload) == body[r.page_id]
    whole = str(tmp_path / "whole")
    warc.write_archives(pages, whole, min_bytes=5)
    assert {r.page_id for r in warc.read_archives(spark, whole).where("record_type = 'revisit'").collect()} == {5}
    empty = str(tmp_path / "empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_archives_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, f"http://h/{i}/WARC/1.1", f"{i} " * (40_000 if i % 7 == 0 else 20), 1, "x") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive int, value string").coalesce(2)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, archive_bytes=100_000)
    sizes = [f.stat().st_size for f in (tmp_path / "warc").glob("*/part-*")]
    assert max(sizes) < 100_000 + 170_000 and len(sizes) > 20 and sum(s >= 100_000 for s in sizes) >= len(sizes) - 2
    got = warc.read_archives(spark, path, payload=True).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {i: h for i, _, h, *_ in rows} and len(got) == 200


def test_warc_keeps_records_before_a_break(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "abc" * i) for i in range(9)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "warc"))
    (part,) = (tmp_path / "warc").glob("*/part-*")
    whole = part.read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "part-0").write_bytes(whole[:-10])
    (tmp_path / "cut" / "part-1").write_bytes(b" " + whole)
    assert sorted(r.page_id for r in warc.read_archives(spark, str(tmp_path / "cut")).collect()) == list(range(8))


def test_reachable():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 200):
        at = np.sort(rng.choice(1000, n, replace=False))
        if n > 1:
            at[0] = 0
        successor = np.where(rng.random(n) < 0.95, np.append(at[1:], 2000)[:n], at + 1)
        want, here = set(), 0
        while here in at:
            want.add(here)
            here = int(successor[list(at).index(here)])
        assert set(at[warc.reachable(at, successor)].tolist()) == want


def test_many_magics_are_read_in_one_pass():
    import time

    began = time.process_time()
    for piece in (b"WARC/1.1\r\n", b"WARC/1.1\r\nA: b\r\n", b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 9\r\n\r\n"):
        list(warc.records(piece * (2_000_000 // len(piece))))
    assert time.process_time() - began < 4


# 10


def test_fuzzy_matcher():
    terms = ["loser", "pathetic", "disgusting", "scum", "lover"]
    m = toxicity.FuzzyMatcher(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = np.random.default_rng(2)
    words = [*terms, "losr", "loserr", "lozer", "pathetik", "disgutsing", "xdisgustin", "scumm", ""]
    for t in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(int(rng.integers(1, 4))):
                p = int(rng.integers(0, len(w) + 1))
                w[p : p + int(rng.integers(0, 2))] = [chr(97 + int(rng.integers(0, 26)))] * int(rng.integers(0, 2))
            words.append("".join(w))
    for w in words:
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= m.edits(t)]
        got = m.match(w)
        assert (got is None) == (not near)
        if near:
            assert (got[1], got[0]) == min(near)


@pytest.fixture(scope="module")
def abuse(spark):
    import zlib

    rng = np.random.default_rng(3)
    vocabulary = [f"plain{i}" for i in range(300)]
    bad = ["vrakk", "zlorfen", "stupifant"]
    rows, labels, toxic = [], [], {}
    for i in range(600):
        w = [vocabulary[k] for k in rng.integers(0, 300, 60)]
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            for _ in range(4):
                w[int(rng.integers(0, 60))] = bad[int(rng.integers(0, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, toxic[i]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), toxic, lambda i: zlib.crc32(str(i).encode()) % 3 == 1


def test_toxicity(spark, abuse, none):
    docs, labels, toxic, held = abuse
    model = toxicity.train(docs, labels).prepare()
    assert {"vrakk", "zlorfen", "stupifant"} <= set(model.words)
    assert model.score("you vrakk and zlorfen vrakk") > 0.7 > model.score("plain1 plain2")
    assert model.score("zlorfem stupifent zlorfan") > model.score("plain1 plain2 plain3")
    quoted = 'they said "you vrakk" and wrote it down'
    assert model.score(quoted) <= model.score("you vrakk they go and they keep it down")
    out = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    own = [r for r in out if r.held_out]
    assert sum(r.predicted == toxic[r.doc_id] for r in own) / len(own) > 0.95
    assert {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()} == {r.doc_id for r in out if not r.predicted}
    # Labels of held-out rows teach nothing.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped).weights == pytest.approx(model.weights)
    assert toxicity.toxicity(none.select("doc_id", "text"), labels).count() == 0


def test_toxicity_against_brute_force(spark, abuse):
    """The lexicon by counting, tokens by their distance to every term: the scores of the whole table are the same."""
    docs, labels, toxic, held = abuse
    T = toxicity
    slips = {1: "you vrak zlorfan", 2: "stupif4nt vr*kk plain3", 4: "zlorfen said", 5: "stupifantly plain1 vrakkish", 7: "", 8: None}
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + i, t) for i, t in slips.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    learn = [(t, toxic[i]) for i, t in rows if i in toxic and not held(i)]
    beside, stand, clean = defaultdict(set), defaultdict(set), Counter()
    for n, (t, bad) in enumerate(learn):
        own = T.TOKEN.findall(t.lower())
        seen = set()
        for before, x in zip(["", *own], own, strict=False):
            for key in [("word", x)] + [("stem", x[:k]) for k in T.STEMS if k <= len(x) <= k + T.ENDING]:
                seen.add(key)
                if bad:
                    beside[key].add(before)
                    stand[key].add(n)
        clean.update(() if bad else seen)
    pos, neg = sum(b for _, b in learn), sum(1 - b for _, b in learn)
    lexicon, share = {}, pos / (pos + neg)
    least = np.log(sum(len(k[1]) >= 3 and len(d) >= T.MIN_DOCS for k, d in stand.items()) / T.BY_CHANCE)

    def sure(k, n):
        return k >= (k + n) * share and k * np.log(k / ((k + n) * share)) + (n * np.log(n / ((k + n) * (1 - share))) if n else 0) >= least

    for key, docs_of in stand.items():
        if not sure(min(len(docs_of), len(beside[key])), clean[key]):
            continue
        odds = np.log((len(docs_of) + 0.5) / (pos + 1)) - np.log((clean[key] + T.CLEAN_PRIOR) / (neg + 1))
        if len(key[1]) >= 3 and len(beside[key]) >= T.MIN_NEIGHBOURS and len(docs_of) >= T.MIN_DOCS and odds >= T.MIN_LOG_ODDS and clean[key] <= T.MAX_CLEAN * len(docs_of):
            lexicon[key] = odds
    model = T.train(table, labels).prepare()
    assert model.words == pytest.approx({t: o for (k, t), o in lexicon.items() if k == "word"})
    assert model.stems == pytest.approx({t: o for (k, t), o in lexicon.items() if k == "stem"})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    def found(token, accidents):
        exact = [model.words[token]] if token in model.words else []
        exact += [o for s, o in model.stems.items() if token.startswith(s) and len(token) <= len(s) + T.ENDING]
        if exact:
            return 0, max(exact)
        if len(token) < 4 or token in accidents:
            return None
        near = min(((d, t) for t in model.words if len(t) >= 5 and (d := distance(token, t)) <= (1 if len(t) < 10 else 2)), default=None)
        return (1, model.words[near[1]]) if near else None

    accidents = {x for t, bad in learn if not bad for x in set(T.TOKEN.findall(t.lower())) if (m := found(x, ())) and m[0] == 1}
    assert model.accidents == accidents
    model.look = lambda token: found(token, accidents)
    want = {i: model.score(t or "") for i, t in rows}
    got = {r.doc_id: (r.score, r.predicted) for r in T.toxicity(table, labels).collect()}
    assert got == {i: (pytest.approx(s, abs=1e-9), int(s >= 0.7)) for i, s in want.items()}
    assert got[10_001][0] > got[10_007][0] and got[10_002][0] > got[10_007][0]


def test_toxicity_of_long_repeated_and_other_rows(spark, abuse):
    docs, labels, *_ = abuse
    long = "plain1 plain2 " * 200_000
    rows = [(1, long, 1, "a"), (2, long + "you vrakk zlorfen", 1, "b"), (3, "vrakk zlorfen vrakk", 1, "c"), (3, "vrakk zlorfen vrakk", 1, "c"), (None, "vrakk zlorfen vrakk", 1, "d"), (4, None, 1, "e"), (5, "", 1, "f")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    learned = docs.select("doc_id", "text", F.lit(0).alias("toxic"), F.lit("x").alias("score"))
    out = toxicity.toxicity(learned.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100_000)), labels)
    got = Counter((r.doc_id, r.predicted) for r in out.where("doc_id is null or doc_id > 100000").collect())
    assert got == {(100_001, 0): 1, (100_002, 0): 1, (100_003, 1): 2, (None, 1): 1, (100_004, 0): 1, (100_005, 0): 1}
    left = toxicity.drop_toxic(learned.unionByName(odd), labels)
    assert left.columns == odd.columns and {r.score for r in left.collect()} == {"x", "a", "b", "e", "f"}


def test_toxicity_masked_letters():
    model = toxicity.Model(words={"scum": 4.0, "pathetic": 5.0}, weights=[0.0] * 8).prepare()
    assert model.look("sc*m") == model.look("s0um") == (1, 4.0) and model.look("path3tic") == (1, 5.0)
    assert model.look("slum") is None and model.look("*cum") is None


def test_toxicity_spares_words_that_begin_like_terms(spark):
    rng = np.random.default_rng(5)
    bad = ["pathetic", "worthless", "trash", "disgusting", "moron"]
    rows, labels = [], []
    for i in range(600):
        w = [f"{'bcdfg'[k % 5]}{'aeiou'[k // 5 % 5]}{'lmnrs'[k // 25 % 5]}{'aeiou'[k // 125 % 5]}" for k in rng.integers(0, 625, 60)]
        for _ in range(6 if i % 4 == 0 else 0):
            w[int(rng.integers(0, 60))] = bad[int(rng.integers(0, 5))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).prepare()
    assert model.look("pathetic") and not any(map(model.look, ("path", "pathway", "worth", "wort")))
    for t in (
        "The path through the old forest is longer than the road, but on a clear day the view from the hill makes up for it.",
        "A new pathway for cyclists opens on Monday and links the station with the river and the market square.",
        "The house is worth more than it was ten years ago, although the roof and the windows need some repair.",
        "Das letzte Wort hat der Rat der Stadt, der am Montag über den Plan für die neue Brücke berät.",
        "Sie gab ihm ihr Wort, und er fand seine Antwort in einem Wörterbuch aus dem vorigen Jahrhundert.",
    ):
        assert model.score(t) < toxicity.FLAG_AT, t
    for t in ("you pathetic worthless moron", "what disgusting trash, you moron"):
        assert model.score(t) >= toxicity.FLAG_AT, t


def test_toxicity_edges(spark, docs):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, no_labels).collect()
    assert len(rows) == len(ROWS) and len({r.score for r in rows}) == 1
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, odd).count() == len(ROWS)
    kept = toxicity.drop_toxic(docs, no_labels)
    assert kept.columns == docs.columns


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries()["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.9


def test_without_keys(spark, docs):
    keys = spark.createDataFrame([(2,), (None,)], "id long")
    out = without_keys(docs, keys, {"id": F.col("doc_id")})
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5, 6, 7, 8] and out.columns == docs.columns


def test_few_edges_are_settled_without_rounds(spark, monkeypatch):
    import random

    from topicloom.llm import components as module

    rng = random.Random(8)
    edges = [(rng.randrange(-50, 150), rng.randrange(-50, 150)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1400)] + [(5000, k) for k in range(4000, 4300)]
    found = lambda: sorted(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).select("node", "component").collect()))
    with monkeypatch.context() as m:
        m.setattr(module, "TASK_EDGES", 0)
        rounds = found()

    def star(*_):
        raise AssertionError("a round of seven shuffles")

    monkeypatch.setattr(module, "_large_star", star)
    assert found() == rounds
    assert dict(rounds)[1399] == 1000 and dict(rounds)[5000] == 4000
