"""Toxicity: a lexicon learned from labels, matched by Levenshtein automata over its trie, scored in context.

A bounded sample of the labelled training rows teaches the lexicon: words, and word beginnings (stems), that
stand in toxic documents beside many different neighbours and hardly ever in clean ones. Distinct neighbours, not
occurrences, are counted, so that the words of a document copied many times don't become terms. A token matches a
term exactly, by a stem of six letters or more and an ending of at most six, or through the automaton within one edit
(five letters or more) or two (ten or more); a term of four letters may have one of them, not the first, masked by a
digit or a mark. The trie has every word of the lexicon.
Windows around the matches tell quotation (quotation marks, verbs of saying) from abuse; a logistic model over
these counts, fitted on the same sample, gives the score. Labels, language, source and identifier aren't inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import intermediate, key_filter, key_hash, lean, materialize, maybe_in, prepare

#: Labelled rows to learn from, at most; beyond that a share of them by hash of the identifier. Everything else about the
#: lexicon follows from what these rows say: it has every term that passes the thresholds below.
TRAIN_ROWS = 20_000
#: Shorter beginnings, such as "path" or "worth", are words of their own in texts that the clean training rows lack.
STEMS = (6, 7, 8)
#: A token has at most this many letters after its stem.
ENDING = 6
#: A term stands beside this many different neighbours and in this many toxic documents.
MIN_NEIGHBOURS, MIN_DOCS = 3, 2
#: Clean documents count this many more than seen, so that rare terms weigh little.
MIN_LOG_ODDS, CLEAN_PRIOR = 2.5, 1.5
#: A term's clean documents are at most this share of its toxic ones.
MAX_CLEAN = 0.05
#: Terms that may be expected to pass by chance among all candidates.
BY_CHANCE = 0.5
WINDOW = 12
FLAG_AT = 0.7
#: Letters and digits, and marks between them that stand for letters, as in "st*pid".
TOKEN = re.compile(r"[^\W_]+(?:[*@$!#_]{1,3}[^\W_]+)*")
#: Marks that open and close a quotation, and verbs of saying near it, in four languages.
OPEN, CLOSE = "\"“«„‹", "\"”»“›"
SAYING = frozenset(
    "said says say quote quoted quotes wrote writes called calls term word dit écrit cite appelé mot dijo dice escribió cita palabra sagte sagt schrieb zitat nannte wort".split()
)


_UNLIKE = re.compile(r"[\d*@$!#_]")


class FuzzyMatcher:
    """The Levenshtein automaton of every term, intersected with the trie of all of them, made lazily into a DFA.

    A state is a set of (trie node, edits so far); transitions are computed when first taken and kept.
    """

    MAX_KEPT = 100_000

    def __init__(self, terms: list[str]):
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.most: list[int] = [0]
        for t in terms:
            node, d = 0, self.edits(t)
            self.most[0] = max(self.most[0], d)
            for ch in t:
                nxt = self.child[node].get(ch)
                if nxt is None:
                    nxt = self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.ends.append(None)
                    self.most.append(0)
                node = nxt
                self.most[node] = max(self.most[node], d)
            self.ends[node] = t
        self._reset()

    @staticmethod
    def edits(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 10 else 2

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: dict[tuple[int, str], int] = {}
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        least: dict[int, int] = {}
        stack = list(items)
        while stack:  # skipping a letter of a term is an edit too
            node, e = stack.pop()
            if e > self.most[node] or least.get(node, 99) <= e:
                continue
            least[node] = e
            stack.extend((c, e + 1) for c in self.child[node].values())
        key = frozenset(least.items())
        at = self.states.get(key)
        if at is None:
            at = self.states[key] = len(self.sets)
            self.sets.append(key)
            ends = [(e, self.ends[n]) for n, e in key if self.ends[n] and e <= self.edits(self.ends[n])]
            best = min(ends, default=None)
            self.found.append((best[1], best[0]) if best else None)
        return at

    def _move(self, state: int, ch: str) -> int:
        after = set()
        for node, e in self.sets[state]:
            after.add((node, e + 1))
            for c, nxt in self.child[node].items():
                after.add((nxt, e if c == ch else e + 1))
        return self._state(after)

    def match(self, token: str) -> tuple[str, int] | None:
        """The nearest term within its edits, and how many; ties go to the first in order of letters."""
        if len(self.moves) > self.MAX_KEPT:
            self._reset()
        state = self.start
        for ch in token:
            key = (state, ch)
            nxt = self.moves.get(key)
            if nxt is None:
                nxt = self.moves[key] = self._move(state, ch)
            state = nxt
            if not self.sets[state]:
                return None
        return self.found[state]


@dataclass
class Model:
    """Learned from the sample, which bounds it."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    accidents: frozenset[str] = frozenset()  # tokens near a term that clean training texts use
    weights: list[float] = field(default_factory=list)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def prepare(self) -> Model:
        self._seen: dict[str, tuple[int, float] | None] = {}
        self._matcher = FuzzyMatcher(sorted(self.words))
        self._masked = {f"{t[:i]}.{t[i + 1 :]}": t for t in sorted(self.words) if len(t) == 4 for i in (1, 2, 3)}
        return self

    def release(self) -> None:
        """What was kept to look up tokens goes; an idle worker holds none of it."""
        for k in [k for k in self.__dict__ if k.startswith("_")]:
            del self.__dict__[k]

    def look(self, token: str) -> tuple[int, float] | None:
        """(0 exact or stem, 1 misspelled; log-odds) of a token."""
        try:
            return self._seen[token]
        except KeyError:
            pass
        out = None
        w = self.words.get(token)
        for k in STEMS:
            s = self.stems.get(token[:k]) if k <= len(token) <= k + ENDING else None
            if s is not None and (w is None or s > w):
                w = s
        if w is not None:
            out = (0, w)
        elif len(token) >= 4 and token not in self.accidents:
            if (m := self._matcher.match(token)) and m[1]:
                out = (1, self.words[m[0]])
            elif len(token) == 4 and (t := self._masked.get(_UNLIKE.sub(".", token))):
                out = (1, self.words[t])
        if len(self._seen) > 100_000:
            self._seen.clear()
        self._seen[token] = out
        return out

    def features(self, text: str) -> list[float]:
        low = text.lower()
        look = self.look
        tokens = TOKEN.findall(low)
        hits = [(i, m) for i, m in enumerate(map(look, tokens)) if m]
        if not hits:
            return [0.0] * 7
        abuse = quoted = misspelled = odds = 0.0
        spans = None
        for i, (kind, w) in hits:
            if spans is None:
                spans = [m.start() for m in TOKEN.finditer(low)]
            if self._quoted(low, tokens, spans, i):
                quoted += 1
            elif kind:
                misspelled += 1
            else:
                abuse += 1
                odds += w
        at = [i for i, _ in hits]
        crowd = lo = 0
        for hi in range(len(at)):
            while at[hi] - at[lo] > 4 * WINDOW:
                lo += 1
            crowd = max(crowd, hi - lo + 1)
        n = len(tokens)
        share = 100.0 * (abuse + misspelled) / n
        return [min(odds, 40.0) / 5, np.log1p(odds), np.log1p(misspelled), np.log1p(quoted), np.log1p(share), np.log1p(abuse), np.log1p(crowd - 1)]

    @staticmethod
    def _quoted(low: str, tokens: list[str], spans: list[int], i: int) -> bool:
        """Whether the window around token i opens a quotation before it and closes one after, near a verb of saying."""
        a, b = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
        start = spans[i]
        before, after = low[spans[a] : start], low[start + len(tokens[i]) : spans[b - 1] + len(tokens[b - 1]) + 2]
        opened = any(before.count(o) > before.count(c) or (o == c and before.count(o) % 2) for o, c in zip(OPEN, CLOSE, strict=True))
        closed = any(c in after for c in CLOSE)
        return opened and closed and (not SAYING.isdisjoint(tokens[a:b]) or after[:1] in CLOSE)

    def score(self, text: str) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text), strict=True))
        return float(1 / (1 + np.exp(-z)))


def held_out(id_col):
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their distinct (token, the token before)."""
    for b in batches:
        toks, prev = [], []
        for t in b.column(0).to_pylist():
            own = TOKEN.findall(t.lower())
            for x, before in set(zip(own, ["", *own], strict=False)):
                toks.append(x)
                prev.append(before)
        yield pa.RecordBatch.from_arrays([pa.array(toks, pa.string()), pa.array(prev, pa.string())], ["token", "prev"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to the words and stems in them, each with its number of texts."""
    seen: Counter = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            own = set(TOKEN.findall(t.lower()))
            seen.update(("word", x) for x in own)
            seen.update({("stem", x[:k]) for x in own for k in STEMS if k <= len(x) <= k + ENDING})
    kinds, terms, n = [k for k, _ in seen], [t for _, t in seen], list(seen.values())
    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(terms, pa.string()), pa.array(n, pa.int64())], ["kind", "term", "n"])


def _with(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, while the model is ready to look up tokens."""
    model.prepare()
    try:
        yield from batches
    finally:
        model.release()


def _near_tokens(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _with(model, batches):
            own = {x for t in b.column(0).to_pylist() for x in TOKEN.findall(t.lower())}
            near = [x for x in own if (m := model.look(x)) and m[0] == 1]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["token"])

    return run


def _features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _with(model, batches):
            x = [model.features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps; every count can only raise the score, so negative weights become 0."""
    z = np.hstack([np.ones((len(x), 1)), x])
    active = np.ones(z.shape[1], dtype=bool)
    for _ in range(z.shape[1]):
        w = np.zeros(z.shape[1])
        a, penalty = z[:, active], np.diag([1e-6, *[ridge] * (active.sum() - 1)])
        v = np.zeros(active.sum())
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
            g = a.T @ (p - y) + penalty @ v
            h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty
            step = np.linalg.solve(h, g)
            v -= np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        w[active] = v
        below = (w < 0) & active
        below[0] = False
        if not below.any():
            return w.tolist()
        active &= ~below
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = TRAIN_ROWS) -> Model:
    """Learns from labelled rows that aren't held out, at most about `max_rows` of them.

    A document with several labels is toxic if one of them says so; null labels are ignored. Without toxic or
    without clean rows there is no lexicon, and every text scores the smoothed share of toxic rows.
    """
    prepare(docs.sparkSession)
    ident = F.col("doc_id")
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(ident)).groupBy(ident.cast("long").alias("__lid")).agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, max_rows / max(1, total))
    picked = materialize(known.where(F.pmod(F.xxhash64(F.col("__lid"), F.lit(31)), F.lit(1 << 20)) < int(share * (1 << 20))), "labelled")
    filt = key_filter(picked, key_hash("__lid"))
    body = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    sample = materialize(maybe_in(body, key_hash("id"), filt).join(picked, F.col("id") == F.col("__lid")).select("id", "text", "toxic"), "sample")
    counts = dict(sample.groupBy("toxic").count().collect())
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    model = Model(weights=[float(np.log((pos + 0.5) / (neg + 0.5))), *[0.0] * 7])
    if not pos or not neg:
        return model

    # Frequent everywhere or only here: documents of both kinds are counted, for words and stems.
    common, bad = sample.where("toxic = 0").select("text"), sample.where("toxic = 1").select("text")
    docs_of = lambda texts, n: texts.mapInArrow(lean(_count_terms), "kind string, term string, n long").groupBy("kind", "term").agg(F.sum("n").alias(n))
    found = materialize(docs_of(bad, "docs").where((F.length("term") >= 3) & (F.col("docs") >= MIN_DOCS)), "terms")
    odds = F.log((F.col("docs") + 0.5) / (pos + 1)) - F.log((F.col("n") + CLEAN_PRIOR) / (neg + 1))
    known = found.join(docs_of(common, "n"), ["kind", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("odds", odds)
    least = float(np.log(max(1, found.count()) / BY_CHANCE))
    share = pos / (pos + neg)

    def sure(k: str) -> Column:
        """Chernoff's bound on the chance that a term which says nothing stands in k toxic documents and n clean ones."""
        m = F.col(k) + F.col("n")
        part = lambda x, p: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (m * p))).otherwise(0.0)
        return (F.col(k) >= m * share) & (part(k, share) + part("n", 1 - share) >= least)

    chosen = (F.col("odds") >= MIN_LOG_ODDS) & (F.col("n") <= MAX_CLEAN * F.col("docs")) & sure("docs")
    known = materialize(known.where(chosen), "candidates")
    # Copies of a document share their neighbours, so no more documents count than there are neighbours.
    tokens = bad.mapInArrow(lean(_tokens), "token string, prev string")
    stems = F.explode(F.expr(f"transform(filter(array({', '.join(map(str, STEMS))}), k -> length(token) between k and k + {ENDING}), k -> substring(token, 1, k))"))
    long_form = tokens.select(F.lit("word").alias("kind"), F.col("token").alias("term"), "prev").unionByName(tokens.select(F.lit("stem").alias("kind"), stems.alias("term"), "prev"))
    beside = long_form.join(known.select("kind", "term"), ["kind", "term"], "left_semi").groupBy("kind", "term").agg(F.count_distinct("prev").alias("neighbours"))
    known = known.join(beside, ["kind", "term"]).withColumn("k", F.least("docs", "neighbours"))
    lexicon = known.where((F.col("neighbours") >= MIN_NEIGHBOURS) & sure("k")).select("kind", "term", "odds").collect()
    model.words = {r.term: r.odds for r in sorted(lexicon) if r.kind == "word"}
    model.stems = {r.term: r.odds for r in sorted(lexicon) if r.kind == "stem"}
    near = common.mapInArrow(lean(_near_tokens(model)), "token string").distinct().collect()
    model.accidents = frozenset(r.token for r in near)
    data = sample.select(F.col("toxic").cast("double").alias("toxic"), "text").mapInArrow(lean(_features(model)), "toxic double, x array<double>").collect()
    data.sort(key=lambda r: (r.toxic, r.x))
    model.weights = _fit(np.array([r.x for r in data]), np.array([r.toxic for r in data]))
    return model


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _with(model, batches):
            s = [model.score(t or "") for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of `docs`: id_col, held_out, score in 0 to 1, predicted (1 from 0.7).

    Null and empty texts score as texts without matches, texts of any length are read whole. Repeated rows score alike; a
    row without identifier isn't held out; a score of exactly 0.7 counts as 1. Of several terms as near to a token the
    first by letters is meant. Other columns of `docs` are left out. An empty table gives an empty result.
    """
    with intermediate(docs.sparkSession):
        model = train(docs, labels, id_col, text_col, max_rows)
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = slim.mapInArrow(lean(_scorer(model)), "id long, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= FLAG_AT).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of `docs` whose score stays below 0.7, in one narrow pass over the table."""
    with intermediate(docs.sparkSession):
        model = train(docs, labels, id_col, text_col, max_rows)
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _with(model, batches):
            yield b.filter(pa.array([model.score(t or "") < FLAG_AT for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(lean(run), schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
