"""Vectorised word shingles over Arrow string batches: 64-bit hashes of words and of word runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=U64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = int(_RNG.integers(0, 2**64, dtype=U64)) | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLACE = _RNG.integers(0, 2**64, 64, dtype=U64) | U64(1)

#: Texts are hashed in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=U64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * U64(step)])
        step = step * step % 2**64
    return out[:n]


class _Hasher:
    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=U64)

    def words(self, data: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of concatenated texts, in order, and each word's start."""
        n = len(data)
        up, down = self.up, self.down
        if n + 1 > len(up):
            size = 1 << (n + 1).bit_length()
            up, down = _powers(_BASE, size), _powers(_BASE_INV, size)
            if n <= 2 * CHUNK_BYTES:  # those for a very long text aren't kept
                self.up, self.down = up, down
        solid = ~_SPACE[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edge = starts_of_texts[starts_of_texts < n]
        first[edge] = solid[edge]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        before = edge[edge > 0] - 1
        last[before] = solid[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.empty(n + 1, dtype=U64)
        total[0] = 0
        np.cumsum(_BYTE[data] * up[:n], out=total[1:])
        return mix((total[e] - total[s]) * down[s] + (e - s).astype(U64)), s


_HASHER = _Hasher()


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes; nulls are empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return o - o[0], d[o[0] : o[-1]]


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingles as 64-bit hashes.

    Words are runs without ASCII white space, with A-Z in lower case. A text of fewer than k words has one
    shingle, all of it; a text without words has none.
    """
    if not len(texts):
        return
    offsets, data = _buffers(texts)
    for a, b in _chunks(offsets):
        own = offsets[a : b + 1] - offsets[a]
        words, starts = _HASHER.words(data[offsets[a] : offsets[b]], own[:-1])
        first = np.searchsorted(starts, own)  # the first word of each text, and one past the last
        runs = np.zeros(max(0, len(words) - k + 1), dtype=U64)
        for j in range(k if len(runs) else 0):
            runs += words[j : len(words) - k + 1 + j] * _PLACE[j]
        runs = mix(runs)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= k:
                yield np.unique(runs[lo : hi - k + 1])
            elif hi > lo:
                yield mix(np.array([int((words[lo:hi] * _PLACE[: hi - lo]).sum(dtype=U64)) ^ (hi - lo)], dtype=U64))
            else:
                yield np.zeros(0, dtype=U64)
