"""Word hashes of whole texts with numpy, for the operators that run inside Arrow batches.

A word is a run of bytes other than space, tab, LF, VT, FF, CR, with A-Z lower-cased. Its hash is a
polynomial over its bytes modulo 2^64, taken from running sums, then mixed: the same for equal words on
every machine, and without a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20  # bytes hashed at once; bounds the memory of the running sums
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else (32 if b == 32 or 9 <= b <= 13 else b) for b in range(256)
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    def __init__(self) -> None:
        self._up = _powers(_BASE, 1)
        self._down = _powers(pow(_BASE, -1, 1 << 64), 1)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            self._up = _powers(_BASE, n)
            self._down = _powers(pow(_BASE, -1, 1 << 64), n)

    def _piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of folded bytes, and the places where they start."""
        raw = np.frombuffer(data, dtype=np.uint8)
        n = len(raw)
        self._grow(n + 1)
        word = np.concatenate(([False], raw != 32, [False]))
        edges = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[raw] * self._up[:n], out=sums[1:], dtype=np.uint64)
        return mix((sums[ends] - sums[starts]) * self._down[starts]), starts

    def batch(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order."""
        waiting: list[bytes] = []
        size = 0
        for text in texts:
            if len(text) > PIECE:
                yield from self._together(waiting)
                waiting, size = [], 0
                yield self._long(text.translate(_FOLD))
                continue
            if size + len(text) > PIECE:
                yield from self._together(waiting)
                waiting, size = [], 0
            waiting.append(text)
            size += len(text) + 1
        yield from self._together(waiting)

    def _together(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        hashes, starts = self._piece(b" ".join(texts).translate(_FOLD))
        bounds = np.cumsum([len(t) + 1 for t in texts])
        yield from np.split(hashes, np.searchsorted(starts, bounds[:-1]))

    def _long(self, data: bytes) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            end = len(data) if at + PIECE >= len(data) else data.find(b" ", at + PIECE)
            end = len(data) if end < 0 else end
            parts.append(self._piece(data[at:end])[0])
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def utf8(column) -> list[bytes]:
    """The texts of an Arrow string column as bytes; NULL as empty."""
    import pyarrow as pa

    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]
