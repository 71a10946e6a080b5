"""SentencePiece encoding and decoding with segmentations sampled without replacement.

The lattice of a text has an arc for every vocabulary piece at every place, and byte pieces where a character is no
piece itself. A piece weighs -log(2 + rank), rank being its place in the merge order, so the product over pieces is a
distribution over all segmentations of the text; backward sums give the chance of every arc. Between two characters
that no piece has side by side every segmentation has a border, so the lattice is cut there without loss: it is the
chain of its units, and equal units of a chunk share one.

Sampling is A* over the tree of partial segmentations with Gumbel noise: a node's perturbed value is the largest of
the leaves below it. The root draws it, the arc picked by chance keeps it, every other arc draws its own below it
and waits on the frontier. The best of the frontier is the next sample, so the first k leaves are k distinct
segmentations drawn without replacement, and the value left on top of the frontier gives each one's chance of
inclusion, 1 - exp(-exp(log_prob - kappa)). All noise is hashed from the row's key, the place and the sample.
"""

from __future__ import annotations

import hashlib
import importlib
from collections.abc import Iterator
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topicloom.llm.shared import lean, prepare
from topicloom.llm.shingles import U64, _powers, mix

SAMPLES = 2
SEED = 17
#: Units of more bytes are summed node by node, and walked by a chain of picks made for all their nodes at once.
LONG_UNIT = 64
#: Arcs that a bank of lattices has when it is emptied, of 28 bytes each.
BANK_ARCS = 1_200_000
#: Texts are taken in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 17
MARK = "▁".encode()
#: Frontier noise has 32 bits, so no arc's value exceeds the log-probability of the path before it by this much.
REACH = 23.0
NEAR = -26.0
MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    return importlib.import_module("public_tokenizers").path(name)


class Vocabulary:
    """The pieces as a byte trie in an open-addressing table, with weights."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_id = np.zeros(256, dtype=np.int32)
        edges: dict[tuple[int, int], int] = {}
        piece_of = [-1]
        spoken: list[str] = []
        weight = np.zeros(sp.get_piece_size())
        for i in range(sp.get_piece_size()):
            weight[i] = -np.log(2.0 + max(0.0, -sp.get_score(i)))
            if sp.is_byte(i):
                self.byte_id[int(sp.id_to_piece(i)[3:5], 16)] = i
                weight[i] = -np.log(2.0 + sp.get_piece_size())
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                spoken.append(sp.id_to_piece(i))
                node = 0
                for b in spoken[-1].encode():
                    nxt = edges.get((node, b))
                    if nxt is None:
                        nxt = edges[node, b] = len(piece_of)
                        piece_of.append(-1)
                    node = nxt
                piece_of[node] = i
        self.weight = weight
        self._spelling()
        self._neighbours(spoken)
        self.piece_of = np.array(piece_of, dtype=np.int32)
        bits = (4 * len(edges)).bit_length()
        self.shift = U64(64 - bits)
        self.mask = (1 << bits) - 1
        keys = np.fromiter((n << 8 | b for n, b in edges), dtype=np.int64, count=len(edges))
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.next = np.zeros(1 << bits, dtype=np.int32)
        for key, slot, to in zip(keys.tolist(), self._slot(keys).tolist(), edges.values(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.next[slot] = key, to

    def _spelling(self) -> None:
        """What each piece decodes to, end to end: the word mark is a space, a byte piece its byte, a control nothing."""
        sp = self.sp
        spelt = []
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                spelt.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
            elif sp.is_unknown(i):
                spelt.append(" ⁇ ".encode())
            else:
                spelt.append(b"" if sp.is_control(i) else sp.id_to_piece(i).encode().replace(MARK, b" "))
        self.spelt = pa.array(spelt, pa.large_binary())

    def _neighbours(self, pieces: list[str]) -> None:
        """Which characters some piece has side by side: a table over the characters of all pieces, 0 being any other."""
        codes = np.unique(np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32))
        self.char_class = np.zeros(0x110000, dtype=np.int32)
        self.char_class[codes] = np.arange(1, len(codes) + 1)
        self.classes = len(codes) + 1
        self.side_by_side = np.zeros(self.classes**2, dtype=bool)
        for piece in pieces:
            own = self.char_class[np.frombuffer(piece.encode("utf-32-le"), dtype=np.uint32)]
            self.side_by_side[own[:-1] * self.classes + own[1:]] = True

    def borders(self, data: np.ndarray) -> np.ndarray:
        """Positions in UTF-8 `data`, the start left out, that no piece reaches across."""
        own = self.char_class[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)]
        free = ~self.side_by_side[own[:-1] * self.classes + own[1:]]
        return np.flatnonzero((data & 0xC0) != 0x80)[1:][free]

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The text of each list of ids, list i being ids[bounds[i] : bounds[i + 1]]; the first piece's leading space goes."""
        _, offsets, raw = self.spelt.take(pa.array(ids)).buffers()
        starts = np.frombuffer(offsets, dtype=np.int64)[: len(ids) + 1]
        data = np.frombuffer(raw, dtype=np.uint8)[: starts[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
        ends = starts[bounds]
        begin = ends[:-1]
        lead = begin[begin < ends[1:]]
        lead = lead[data[lead] == 32]
        keep = np.ones(len(data), dtype=bool)
        keep[lead] = False
        ends = np.append(0, np.cumsum(keep))[ends]
        raw = np.ascontiguousarray(data[keep])
        out = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # lists of ids that aren't those of a text
            whole = raw.tobytes()
            out = pa.array([whole[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:], strict=False)], pa.large_string())
        return out.cast(pa.string())

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next trie node, -1 where there is none."""
        key = node.astype(np.int64) << 8 | byte
        slot = self._slot(key)
        got = self.keys[slot]
        out = np.where(got == key, self.next[slot], -1)
        todo = np.flatnonzero((got != key) & (got >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            got = self.keys[slot[todo]]
            same = got == key[todo]
            out[todo[same]] = self.next[slot[todo[same]]]
            todo = todo[~same & (got >= 0)]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    v = Vocabulary(path)
    v.bank = Bank(v)
    return v


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] of them, then those of the next."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(count) - count
    return np.arange(total) + np.repeat(start - before, count)


class Lattices:
    """The lattices of distinct units laid end to end; a node is a byte position, arcs are in CSR order."""

    def __init__(self, v: Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.start, self.end = start, end
        size = len(data)
        unit_end = np.repeat(end, end - start).astype(np.int32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        node = np.zeros(len(at), dtype=np.int32)
        count = np.zeros(size, dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray, int, np.ndarray]] = []
        depth = 0
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        wide = np.zeros(size, dtype=np.int64)
        wide[lead] = np.diff(np.append(lead, size))
        named = np.zeros(size, dtype=bool)
        while len(at):
            live = at + depth < unit_end[at]
            at, node = at[live], node[live]
            node = v.step(node, data[at + depth])
            live = node >= 0
            at, node = at[live], node[live]
            depth += 1
            piece = v.piece_of[node]
            whole = piece >= 0
            found.append((at[whole], count[at[whole]].copy(), depth, piece[whole]))
            count[at[whole]] += 1
            named[at[whole & (wide[at] == depth)]] = True
        # Bytes stand for a character that is no piece itself, even where a longer piece begins.
        bare = np.flatnonzero(~named)
        found.append((bare, count[bare].copy(), 1, v.byte_id[data[bare]]))
        count[bare] += 1
        self.first = np.zeros(size + 1, dtype=np.int64)
        np.cumsum(count, out=self.first[1:])
        n = int(self.first[-1])
        self.piece = np.empty(n, dtype=np.int32)
        self.length = np.empty(n, dtype=np.int32)
        for p, rank, length, piece in found:
            to = self.first[p + 1] - 1 - rank  # the longest first: it is the likeliest, and picks try arcs in order
            self.piece[to], self.length[to] = piece, length
        self.node = np.repeat(np.arange(size, dtype=np.int32), count)
        self._backward(v, unit_end, count)

    def _backward(self, v: Vocabulary, unit_end: np.ndarray, count: np.ndarray) -> None:
        """Sums from the units' ends; LONG_UNIT bytes can't leave the range of a double, so they need no logarithms."""
        size = len(count)
        weight = v.weight[self.piece]
        beta = np.ones(size + 1)
        p = np.exp(weight)
        left = unit_end - np.arange(size, dtype=np.int32)
        # What follows an arc to its unit's end is 1; beta there is that of the next unit until it is set.
        to = np.where(self.length == np.repeat(left, count), size, self.node + self.length)
        short = np.flatnonzero(np.repeat(self.end - self.start <= LONG_UNIT, self.end - self.start))
        order = short[np.argsort(left[short].astype(np.int8), kind="stable")]
        bounds = np.searchsorted(left[order], np.arange(1, LONG_UNIT + 2))
        first = self.first
        for k in range(len(bounds) - 1):
            nodes = order[bounds[k] : bounds[k + 1]]
            if not len(nodes):
                continue
            c = count[nodes]
            seg = np.cumsum(c) - c
            arcs = np.arange(seg[-1] + c[-1]) + np.repeat(first[nodes] - seg, c)
            value = p[arcs] * beta[to[arcs]]
            total = np.add.reduceat(value, seg)
            beta[nodes] = total
            p[arcs] = value / np.repeat(total, c)
        self.chance, self.p = np.log(p), p  # of an arc given its node
        for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True):
            if b - a > LONG_UNIT:
                self._backward_long(a, b, weight)
                lo, hi = first[a], first[b]
                p[lo:hi] = np.exp(self.chance[lo:hi])

    def _backward_long(self, a: int, b: int, weight: np.ndarray) -> None:
        """The same for one unit, from its end."""
        lo, hi = int(self.first[a]), int(self.first[b])
        first, length, own = (self.first[a : b + 1] - lo).tolist(), self.length[lo:hi].tolist(), weight[lo:hi].tolist()
        beta, chance = [0.0] * (b - a + 1), [0.0] * (hi - lo)
        for i in range(b - a - 1, -1, -1):
            arcs = range(first[i], first[i + 1])
            value = [own[k] + beta[i + length[k]] for k in arcs]
            top = max(value)
            beta[i] = total = top + log(sum([exp(x - top) for x in value]))
            for k, x in zip(arcs, value, strict=True):
                chance[k] = x - total
        self.chance[lo:hi] = chance

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        arc, last = self.first[node], self.first[node + 1] - 1
        u = u - self.p[arc]
        todo = np.flatnonzero((u > 0) & (arc < last))
        while len(todo):
            arc[todo] += 1
            rest = u[todo] - self.p[arc[todo]]
            u[todo] = rest
            todo = todo[(rest > 0) & (arc[todo] < last[todo])]
        return arc


class Bank(Lattices):
    """The lattices of units met so far, so that a word of many chunks is built once; emptied when it has BANK_ARCS."""

    PARTS = ("piece", "length", "node", "chance", "p")

    def __init__(self, v: Vocabulary):
        self.v = v
        self.release()

    def release(self) -> None:
        """Empties the bank and gives its room back."""
        kinds = {"piece": np.int32, "length": np.int32, "node": np.int32, "chance": float, "p": float, "first": np.int64}
        self._room = {k: np.zeros(1, dtype=d) for k, d in kinds.items()}
        self._empty()

    def _empty(self) -> None:
        """The room stays for what comes next; first[0] is 0 for good."""
        self.start = self.end = np.zeros(0, dtype=np.int64)
        self.hashes, self.order = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
        self._used = {**dict.fromkeys(self.PARTS, 0), "first": 1}
        self._show()

    def _show(self) -> None:
        for k, n in self._used.items():
            setattr(self, k, self._room[k][:n])

    def _append(self, k: str, values: np.ndarray) -> None:
        n = self._used[k]
        if n + len(values) > len(self._room[k]):
            room = np.empty(max(n + len(values), min(2 * n, BANK_ARCS)), dtype=self._room[k].dtype)
            room[:n] = self._room[k][:n]
            self._room[k] = room
        self._room[k][n : n + len(values)] = values
        self._used[k] = n + len(values)

    def units(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The place in the bank of every unit data[start[i] : start[i + 1]]."""
        if len(self.p) > BANK_ARCS:
            self._empty()
        h, example, which = np.unique(_unit_hashes(data, start), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, h)
        known = np.append(self.hashes, U64(0))[at] == h
        known[at == len(self.hashes)] = False
        if not known.all():
            own, places = example[~known], len(self.start)
            sizes = start[own + 1] - start[own]
            turn = (np.cumsum(sizes) - sizes) // CHUNK_BYTES  # built some at a time, so that a long text needs no more room
            for t in np.unique(turn):
                size, begin = sizes[turn == t], start[own[turn == t]]
                end = np.cumsum(size)
                lat = Lattices(self.v, data[_ranges(begin, size)], end - size, end)
                nodes, arcs = len(self.first) - 1, len(self.p)
                for k in self.PARTS:
                    self._append(k, getattr(lat, k) + nodes if k == "node" else getattr(lat, k))
                self._append("first", lat.first[1:] + arcs)
                self._show()
                self.start, self.end = np.append(self.start, lat.start + nodes), np.append(self.end, lat.end + nodes)
            self.order = np.insert(self.order, at[~known], places + np.arange(len(own)))
            self.hashes = np.insert(self.hashes, at[~known], h[~known])
            at = at + np.cumsum(~known) - ~known
        return self.order[at][which]


def _uniform(key: np.ndarray, *place, bits: int = 52) -> np.ndarray:
    """In (0, 1), from the row's key and a place."""
    x = key
    for i, p in enumerate(place):
        x = mix(x + np.asarray(p).astype(U64) * U64(0x9E3779B97F4A7C15 + 2 * i))
    return ((x >> U64(64 - bits)).astype(np.float64) + 0.5) / 2.0**bits


def _walk(lat: Lattices, at: np.ndarray, end: np.ndarray, key: np.ndarray, place: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """From node `at` of each unit to its end: arcs in order of units, and how many each unit has."""
    n = len(at)
    at = at.copy()
    count = np.zeros(n, dtype=np.int64)
    who = np.flatnonzero(at < end)
    steps = []
    while len(who) and len(steps) < LONG_UNIT:
        u = _uniform(key[who], place[who], at[who] - end[who] + (sample << 40))
        arc = lat.pick(at[who], u)
        steps.append((who, arc))
        count[who] += 1
        at[who] += lat.length[arc]
        who = who[at[who] < end[who]]
    rest = {}
    for w in who.tolist():
        nodes = np.arange(at[w], end[w])
        arc = lat.pick(nodes, _uniform(key[w : w + 1], place[w : w + 1], nodes - end[w] + (sample << 40)))
        onward, chain, i = lat.length[arc].tolist(), [], 0
        while i < len(onward):
            chain.append(i)
            i += onward[i]
        rest[w] = arc[chain]
        count[w] += len(chain)
    offset = np.cumsum(count) - count
    out = np.empty(int(count.sum()), dtype=np.int64)
    for k, (w, arc) in enumerate(steps):
        out[offset[w] + k] = arc
    for w, arc in rest.items():
        out[offset[w] + len(steps) : offset[w] + count[w]] = arc
    return out, count


def _units(v: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The normalised texts end to end, the units' starts (and the end), and each text's first unit (and the last)."""
    normal = [MARK + t.replace(b" ", MARK) if t else b"" for t in texts]
    data = np.frombuffer(b"".join(normal), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in normal])
    begins = ends - np.array([len(t) for t in normal])
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[v.borders(data)] = True
    cut[begins] = True
    cut[len(data)] = True
    start = np.flatnonzero(cut)
    return data, start, np.searchsorted(start, np.append(begins, len(data)))


_POWERS: list[np.ndarray] = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]
_BASE = 0x5851F42D4C957F2D
_CODE = mix(np.arange(1, 257, dtype=U64))


def _unit_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    n = len(data)
    up, down = _POWERS
    if n >= len(up):
        up, down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)
        if n <= 8 * CHUNK_BYTES:
            _POWERS[:] = up, down
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(_CODE[data] * up[:n], out=total[1:])
    return mix((total[start[1:]] - total[start[:-1]]) * down[start[:-1]] + np.diff(start).astype(U64))


def sample_chunk(v: Vocabulary, texts: list[bytes], keys: np.ndarray, k: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(text, sample, piece ids, log_prob, perturbed, log_inclusion), up to k for each text; an empty text has one."""
    n = len(texts)
    data, start, first_unit = _units(v, texts)
    if not len(data):
        for i in range(n):
            yield i, 0, np.zeros(0, dtype=np.int32), 0.0, float(-np.log(-np.log(_uniform(keys[i : i + 1], 0)[0]))), 0.0
        return
    lat = v.bank
    which = lat.units(data, start)
    unit_text = np.repeat(np.arange(n), np.diff(first_unit))
    place = np.arange(len(which)) - first_unit[:-1][unit_text]
    begin, end = lat.start[which], lat.end[which]

    arcs, count = _walk(lat, begin, end, keys[unit_text], place, 0)
    top = -np.log(-np.log(_uniform(keys, 0)))  # the root's perturbed value
    paths = []  # of each sample: arcs, first arc of each text, the root value, whether the text has that sample
    frontier: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # value, path * size + position, arc; by text

    def add(arcs: np.ndarray, bounds: np.ndarray, value: np.ndarray, has: np.ndarray, skip: np.ndarray, want: int) -> None:
        """A finished path; its siblings' best `want` join the frontier. skip: arcs at whose place siblings are known."""
        r = len(paths)
        text = np.repeat(np.arange(n), np.diff(bounds))
        run = np.cumsum(lat.chance[arcs])
        before = run - lat.chance[arcs]
        before -= np.where(np.diff(bounds) > 0, before[np.minimum(bounds[:-1], max(len(arcs) - 1, 0))], 0.0)[text] if len(arcs) else 0
        inner = np.arange(len(arcs)) - bounds[:-1][text]
        logp = np.bincount(text, lat.chance[arcs], n)
        paths.append((arcs, bounds, value, has, logp))
        slots = [(np.full(n, -np.inf), np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)) for _ in range(want)]
        open_texts, least = np.ones(n, dtype=bool), np.full(n, NEAR)
        while True:
            where = np.flatnonzero((inner >= skip[text]) & open_texts[text] & (before >= least[text]))
            nodes = lat.node[arcs[where]]
            c = lat.first[nodes + 1] - lat.first[nodes]
            other = _ranges(lat.first[nodes], c)
            at = np.repeat(where, c)
            keep = other != arcs[at]
            other, at = other[keep], at[keep]
            own = text[at]
            phi = before[at] + lat.chance[other]
            u = _uniform(keys[own], inner[at], other - lat.first[lat.node[other]] + (r << 8) + (1 << 20), bits=32)
            with np.errstate(over="ignore"):
                x = phi - np.log(np.exp(np.minimum(phi - value[own], 700)) - np.log(u))
            runs = np.flatnonzero(np.diff(own, prepend=-1))  # siblings come text by text
            for best, p, a in slots:
                best[open_texts], p[open_texts], a[open_texts] = -np.inf, -1, -1
                if not len(own):
                    continue
                best[own[runs]] = np.maximum.reduceat(x, runs)
                is_best = np.flatnonzero(x == best[own])
                a[own[is_best]], p[own[is_best]] = other[is_best], at[is_best]
                x[is_best] = -np.inf
            # Exact: nothing that follows a path's point of log-probability b can exceed b + REACH.
            last = slots[-1][0]
            open_texts &= last < least + REACH
            open_texts &= least > -np.inf
            if not open_texts.any():
                break
            least = np.where(open_texts, np.where(np.isfinite(last), last - REACH - 1, -np.inf), least)
        for best, p, a in slots:
            frontier.append((np.where(has, best, -np.inf), np.full(n, r), p, a))

    bounds = np.concatenate([[0], np.cumsum(np.bincount(unit_text, count, n).astype(np.int64))])
    everyone = np.ones(n, dtype=bool)
    add(arcs, bounds, top, everyone, np.zeros(n, dtype=np.int64), k)
    unit_of: list[np.ndarray] = [np.repeat(np.arange(len(which)), count)]

    for r in range(1, k + 1):
        values = np.stack([f[0] for f in frontier])
        slot = values.argmax(axis=0)
        best = values[slot, np.arange(n)]
        if r == k:
            kappa = best
            break
        has = np.isfinite(best)
        src = np.stack([f[1] for f in frontier])[slot, np.arange(n)]
        pos = np.stack([f[2] for f in frontier])[slot, np.arange(n)]
        arc = np.stack([f[3] for f in frontier])[slot, np.arange(n)]
        for s, f in enumerate(frontier):
            f[0][slot == s] = -np.inf
        t = np.flatnonzero(has)
        unit = np.empty(n, dtype=np.int64)
        for q in range(r):
            sel = t[src[t] == q]
            unit[sel] = unit_of[q][pos[sel]]
        rest = first_unit[1:][t] - unit[t]
        units = _ranges(unit[t], rest)
        at = begin[units].copy()
        heads = np.cumsum(rest) - rest
        node = lat.node[arc[t]]
        at[heads] = node + lat.length[arc[t]]
        walked, wcount = _walk(lat, at, end[units], keys[unit_text[units]], place[units], r)
        wbounds = np.concatenate([[0], np.cumsum(wcount)])
        tail_start, tail_end = wbounds[heads], wbounds[heads + rest]
        lead = np.empty(len(t), dtype=np.int64)
        lead_from = np.empty(len(t), dtype=np.int64)
        for q in range(r):
            sel = src[t] == q
            lead_from[sel] = paths[q][1][:-1][t[sel]]
            lead[sel] = pos[t[sel]] - lead_from[sel]
        tail = tail_end - tail_start
        new_len = np.zeros(n, dtype=np.int64)
        new_len[t] = lead + 1 + tail
        bounds = np.concatenate([[0], np.cumsum(new_len)])
        arcs = np.empty(int(bounds[-1]), dtype=np.int64)
        owner = np.empty(int(bounds[-1]), dtype=np.int64)
        for q in range(r):
            sel = src[t] == q
            to, frm = _ranges(bounds[:-1][t[sel]], lead[sel]), _ranges(lead_from[sel], lead[sel])
            arcs[to], owner[to] = paths[q][0][frm], unit_of[q][frm]
        joint = bounds[:-1][t] + lead
        arcs[joint], owner[joint] = arc[t], unit[t]
        to = _ranges(joint + 1, tail)
        arcs[to], owner[to] = walked, np.repeat(units, wcount)
        unit_of.append(owner)
        skip = np.zeros(n, dtype=np.int64)
        skip[t] = lead + 1  # siblings before the branch stay where the first path put them
        add(arcs, bounds, np.where(has, best, 0.0), has, skip, k - r)

    for r, (arcs, bounds, value, has, logp) in enumerate(paths):
        ids = lat.piece[arcs]
        with np.errstate(over="ignore", divide="ignore"):
            x = np.exp(np.minimum(logp - kappa, 700.0))
            inclusion = np.where(np.isfinite(kappa), np.where(x < 1e-8, logp - kappa, np.log(-np.expm1(-x))), 0.0)
        for i in np.flatnonzero(has):
            yield int(i), r, ids[bounds[i] : bounds[i + 1]], float(logp[i]), float(value[i]), float(inclusion[i])


def segmentation_log_prob(v: Vocabulary, text: str, ids: list[int]) -> float:
    """The log-probability of a segmentation of `text`; minus infinity if its lattice has no such path."""
    data, start, _ = _units(v, [text.encode()])
    if not len(data) or not len(ids):
        return 0.0 if not len(data) and not len(ids) else -np.inf
    lat = Lattices(v, data, start[:-1], start[1:])
    at, total = 0, 0.0
    for i in ids:
        arcs = range(lat.first[at], lat.first[at + 1]) if at < len(data) else ()
        arc = next((a for a in arcs if lat.piece[a] == i), None)
        if arc is None:
            return -np.inf
        total += lat.chance[arc]
        at += int(lat.length[arc])
    return float(total) if at == len(data) else -np.inf


def row_keys(ids: list[int | None], seed: int = SEED) -> np.ndarray:
    own = np.array([-1 if i is None else i for i in ids], dtype=np.int64).astype(U64) + U64(1)
    return mix(own + mix(np.array([seed], dtype=U64))[0])


def decode(path: str, ids: list[int]) -> str:
    return vocabulary(path).sp.decode(ids)


def encode(path: str, text: str) -> list[int]:
    """The library's own segmentation."""
    return vocabulary(path).sp.encode(text)


def _round_trip(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray, texts: pa.Array) -> pa.Array:
    """Whether each list of ids decodes to its text; the library has a space where a text holds the word mark itself."""
    texts = pa.compute.replace_substring(texts.fill_null(""), MARK.decode(), " ")
    return pa.compute.equal(v.texts(ids, bounds), texts)


def _sampler(path: str, k: int, seed: int, round_trip: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        try:
            yield from sampled(v, batches)
        finally:  # an idle worker holds no lattices
            v.bank.release()

    def sampled(v: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            i = 0
            while i < len(ids):
                chunk, size = [], 0
                while i + len(chunk) < len(ids) and (not chunk or size < CHUNK_BYTES):
                    t = texts[i + len(chunk)].as_py()
                    chunk.append((t or "").encode())
                    size += len(chunk[-1])
                rows = list(sample_chunk(v, chunk, row_keys(ids[i : i + len(chunk)], seed), k))
                bounds = np.append(0, np.cumsum([len(r[2]) for r in rows])).astype(np.int32)
                pieces = np.concatenate([r[2] for r in rows])
                columns = [
                    pa.array([ids[i + r[0]] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([len(r[2]) for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.float64()),
                    pa.array([r[4] for r in rows], pa.float64()),
                    pa.array([r[5] for r in rows], pa.float64()),
                    pa.array([hashlib.sha256(r[2].astype("<i4").tobytes()).hexdigest() for r in rows], pa.string()),
                    pa.ListArray.from_arrays(bounds, pieces),
                ]
                names = ["id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_sha256", "piece_ids"]
                if round_trip:
                    columns.append(_round_trip(v, pieces, bounds, texts.take(pa.array([i + r[0] for r in rows], pa.int64()))))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names)
                i += len(chunk)

    return run


def sampled_segmentations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, seed: int = SEED, path: str | None = None, round_trip: bool = False
) -> DataFrame:
    """Up to k rows per row of `docs`: id_col, sample (0 first), n_pieces, log_prob, perturbed, log_inclusion,
    ids_sha256 (of the ids as little-endian int32), piece_ids and, with `round_trip`, whether the ids, decoded again, are
    the whole text.

    Samples of a text are distinct; a text with fewer than k segmentations has fewer rows, with inclusion 1. Null and
    empty texts have the one empty segmentation. Rows with the same identifier and text get the same samples, and
    a row without identifier is seeded as its own case. A text that holds the word mark itself decodes with a space
    in its place, as the library has it. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    slim = docs.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{text_col}` as string) as text")
    schema = "id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_sha256 string, piece_ids array<int>"
    out = slim.mapInArrow(lean(_sampler(path or model_path(), k, seed, round_trip)), schema + (", round_trip boolean" if round_trip else ""))
    return out.withColumnRenamed("id", id_col)


def _decoder(path: str, ids_col: str, out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids_col))
            size = pa.compute.coalesce(pa.compute.list_value_length(lists), pa.scalar(0, pa.int32())).to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(size))
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < len(lists):
                # As many lists as hold about CHUNK_BYTES ids, so that a batch of long ones isn't spelt at once.
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, side="right")) - 1)
                text = v.texts(ids[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
                text = pa.compute.if_else(pa.compute.is_valid(lists.slice(at, to - at)), text, pa.scalar(None, pa.string()))
                part = b.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*b.schema.names, out_col])
                at = to

    return run


def decoded_segmentations(encoded: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """`encoded` and, as out_col, the text that the ids in ids_col stand for; null where they are null.

    Bytes that aren't UTF-8, which no encoded text gives, become the replacement character.
    """
    prepare(encoded.sparkSession)
    schema = StructType([*encoded.schema.fields, StructField(out_col, StringType())])
    return encoded.mapInArrow(lean(_decoder(path or model_path(), ids_col, out_col)), schema)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples of every document with their ids, decoded again; round_trip: the decoded text is the document's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sampled_segmentations(docs, round_trip=True)
