"""A text's embeddings, and its similarities to topics, worked out where the text is: what a task holds goes with the
taxonomy and the dictionaries, and no pair of a text and a topic is dealt.

Vectors have one length. Topics are numbered in the order of level and name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from topicloom.functions.folds import half_up
from topicloom.functions.match import automaton, leftmost_longest

#: Products of a text's and a topic's weights that are held at once, or those of one text.
BLOCK = 1_000_000
EMBEDDED = "dense array<double>, entity array<double>, terms array<int>, weights array<double>"
SIMILAR = "name string, dense double, sparse double, entity double"
RANKED = "level int, name string, score double, rank int"


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of unit length; NaN is zero, and a row of zeros stays."""
    m = np.where(np.isnan(m), 0.0, m)
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n != 0)


@dataclass
class Texts:
    """What a text is embedded by: vectors of words and of entities by their row, and the topics' terms with their weight."""

    words: dict[bytes, int]
    word_vectors: np.ndarray
    mentions: list[str]
    entities: dict[str, int]
    entity_vectors: np.ndarray
    terms: dict[bytes, int]
    idf: np.ndarray

    def _sum(self, found: list[dict[int, int]], table: np.ndarray) -> pa.Array:
        out = np.zeros((len(found), table.shape[1]))
        for i, own in enumerate(found):
            if own:
                out[i] = np.fromiter(own.values(), float, len(own)) @ table[list(own)]
        out = unit(out)
        offsets = np.arange(len(found) + 1, dtype=np.int32) * table.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out.ravel(), pa.float64()))

    def embed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From (id, text, squared), the sum of a text's squared weights, to (id, EMBEDDED); only weights of topics' terms are
        kept. What a text lacks is zero."""
        search = automaton(self.mentions)
        for b in (s for whole in batches for s in _slices(whole, 1000)):
            words, entities, sizes, terms, weights = [], [], [0], [], []
            for text, squared in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                text = text or ""
                counts = Counter(text.encode().split())  # white space is that of ASCII, as for Spark
                words.append({self.words[t]: n for t, n in counts.items() if t in self.words})
                named = Counter(leftmost_longest(search, text)) if search and text else {}
                entities.append({self.entities[m]: n for m, n in named.items() if m in self.entities})
                own = [(self.terms[t], n) for t, n in counts.items() if t in self.terms] if squared else []
                at, tf = np.array([t for t, _ in own], dtype=np.int32), np.array([n for _, n in own], dtype=float)
                sizes.append(sizes[-1] + len(own))
                terms.append(at)
                weights.append(tf * self.idf[at] / np.sqrt(squared) if own else tf)
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), kind)) for x, kind in ((terms, pa.int32()), (weights, pa.float64()))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), self._sum(words, self.word_vectors), self._sum(entities, self.entity_vectors), *lists], [b.schema.names[0], "dense", "entity", "terms", "weights"]
            )


def _slices(b: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    return (b.slice(k, n) for k in range(0, b.num_rows, n))


def settled(x: np.ndarray, digits: int) -> np.ndarray:
    return half_up(x.ravel() + 10.0 ** -(digits + 3), digits).reshape(x.shape)


@dataclass
class Topics:
    """Topics by number: their vectors and, for each term, which topics have it (from starts[term] on) with what weight."""

    names: list[str]
    levels: np.ndarray
    dense: np.ndarray
    entity: np.ndarray
    starts: np.ndarray
    lists: np.ndarray
    weights: np.ndarray
    digits: int

    def only(self, keep: np.ndarray) -> Topics:
        """Those of the topics for which `keep` is true."""
        place, mine = np.cumsum(keep) - 1, keep[self.lists]
        before = np.concatenate([[0], np.cumsum(mine)])
        names = [n for n, k in zip(self.names, keep, strict=True) if k]
        return Topics(names, self.levels[keep], self.dense[keep], self.entity[keep], before[self.starts], place[self.lists[mine]], self.weights[mine], self.digits)

    def blocks(self, b: pa.RecordBatch) -> Iterator[tuple[pa.Array, tuple]]:
        """(ids, (dense, entity, row of each weight, term, weight)) of as many texts as BLOCK allows."""
        if not b.num_rows:
            return
        sizes = np.diff(b.column(3).offsets.to_numpy())
        terms, weights = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (3, 4))
        dense, entity = (b.column(k).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for k in (1, 2))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cost = np.concatenate([[0], np.cumsum(np.diff(self.starts)[terms])])[ends] + np.arange(b.num_rows + 1) * (len(self.names) + 1)
        at = 0
        while at < b.num_rows:
            to = max(int(np.searchsorted(cost, cost[at] + BLOCK, side="right")) - 1, at + 1)
            own = slice(ends[at], ends[to])
            yield b.column(0).slice(at, to - at), (dense[at:to], entity[at:to], np.repeat(np.arange(to - at), sizes[at:to]), terms[own], weights[own])
            at = to

    def _sparse(self, n: int, row, term, weight, wanted: np.ndarray | None = None) -> np.ndarray:
        size = self.starts[term + 1] - self.starts[term]
        shift = np.repeat(self.starts[term] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else np.zeros(0, int)
        entry = shift + np.arange(len(shift))
        key = np.repeat(row, size) * len(self.names) + self.lists[entry]
        product = np.repeat(weight, size) * self.weights[entry]
        if wanted is not None:
            mine = wanted.ravel()[key]
            key, product = key[mine], product[mine]
        return np.bincount(key, product, n * len(self.names)).reshape(n, len(self.names))

    def similarities(self, texts: tuple) -> list[np.ndarray]:
        """Dense, sparse and entity similarity of every text, by row, to every topic."""
        dense, entity, *sparse = texts
        return [settled(x, self.digits) for x in (dense @ self.dense.T, self._sparse(len(dense), *sparse), entity @ self.entity.T)]

    def similarities_of(self, texts: tuple, row: np.ndarray, topic: np.ndarray) -> list[np.ndarray]:
        """The same of the given pairs alone."""
        dense, entity, *sparse = texts
        wanted = np.zeros((len(dense), len(self.names)), dtype=bool)
        wanted[row, topic] = True
        sums = [np.einsum("ij,ij->i", dense[row], self.dense[topic]), self._sparse(len(dense), *sparse, wanted)[row, topic], np.einsum("ij,ij->i", entity[row], self.entity[topic])]
        return [settled(x, self.digits) for x in sums]

    def score(self, parts: list[np.ndarray]) -> np.ndarray:
        """The mean of those within [0, 1], as scoring.combine has it."""
        ok = [(x >= 0) & (x <= 1) for x in parts]
        n = sum(o.astype(int) for o in ok)
        total = sum(np.where(o, x, 0.0) for o, x in zip(ok, parts, strict=True))
        return settled(np.divide(total, n, out=np.zeros_like(total), where=n > 0), self.digits)

    def best(self, scores: np.ndarray, level: int, top: int) -> np.ndarray:
        """By row the topics of the level with the highest scores, by name where they are equal."""
        own = np.flatnonzero(self.levels == level)
        return own[np.argsort(-scores[:, own], axis=1, kind="stable")[:, :top]]

    def rows(self, key: str, ids: pa.Array, row, topic, score, rank) -> pa.RecordBatch:
        columns = [ids.take(pa.array(row)), pa.array(self.levels[topic], pa.int32()), pa.array([self.names[t] for t in topic.tolist()], pa.string()), pa.array(half_up(score, 4)), pa.array(rank, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, [key, "level", "name", "score", "rank"])

    def ranked(self, ids: pa.Array, key: str, row: np.ndarray, topic: np.ndarray, score: np.ndarray, emit: int) -> pa.RecordBatch:
        """The best `emit` of each text and level among the given pairs, without zeros."""
        order = np.lexsort((topic, -score, self.levels[topic], row))
        row, topic, score = row[order], topic[order], score[order]
        group = row * (int(self.levels.max(initial=0)) + 1) + self.levels[topic]
        first = np.searchsorted(group, group)  # groups are in order
        rank = np.arange(len(row)) - first + 1
        stays = (rank <= emit) & (score != 0)
        return self.rows(key, ids, row[stays], topic[stays], score[stays], rank[stays])


def _each(topics: Topics, run: Callable) -> Callable:
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in topics.blocks(b):
                yield run(b.schema.names[0], ids, texts)

    return mapped


def similar(topics: Topics) -> Callable:
    """From (id, EMBEDDED) to (id, SIMILAR), every text with every topic."""

    def run(key, ids, texts):
        parts = topics.similarities(texts)
        n, k = parts[0].shape
        names = pa.array(topics.names, pa.string()).take(pa.array(np.tile(np.arange(k), n)))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(n), k))), names, *[pa.array(p.ravel()) for p in parts]], [key, "name", "dense", "sparse", "entity"])

    return _each(topics, run)


def best_topics(topics: Topics, emit: int) -> Callable:
    """From (id, EMBEDDED) to (id, RANKED)."""

    def run(key, ids, texts):
        score = topics.score(topics.similarities(texts))
        n, k = score.shape
        return topics.ranked(ids, key, np.repeat(np.arange(n), k), np.tile(np.arange(k), n), score.ravel(), emit)

    return _each(topics, run)


def best_opened(topics: Topics, opened: dict[tuple[str, str], list[str]], top: int, emit: int) -> Callable:
    """From (id, EMBEDDED) to (id, RANKED) of the topics of levels 2 and 3 that one of a text's best `top` pairs of levels 0
    and 1 opens; no other of these is compared."""
    upper, lower = topics.only(topics.levels <= 1), topics.only(topics.levels >= 2)
    place = {n: i for i, n in enumerate(lower.names)}
    below = {pair: [place[n] for n in names if n in place] for pair, names in opened.items()}

    def run(key, ids, texts):
        score = upper.score(upper.similarities(texts))
        tops = [upper.best(score, level, top).tolist() for level in (0, 1)]
        row, topic = [], []
        for i, (zeros, ones) in enumerate(zip(*tops, strict=True)):
            own = {t for a in zeros for b in ones for t in below.get((upper.names[a], upper.names[b]), ())}
            row.extend([i] * len(own))
            topic.extend(own)
        row, topic = np.array(row, dtype=np.int64), np.array(topic, dtype=np.int64)
        return lower.ranked(ids, key, row, topic, lower.score(lower.similarities_of(texts, row, topic)), emit)

    return _each(topics, run)
