"""Word hashes of whole Arrow batches in numpy, for the operators that work on word windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1; kept up to a block's length."""
    out = _POWERS.get(int(base))
    if out is None or len(out) < n:
        out = np.full(max(n, 1 << 18), base, _U)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if len(out) <= 1 << 22:
            _POWERS[int(base)] = out
    return out[:n]


def _inverse(odd: int) -> np.uint64:
    return _U(pow(odd, -1, 1 << 64))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_FOLDED = _BYTE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the batch, and where each row begins and the last one ends; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about limit bytes of text, which bounds the arrays made of them."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        for rows in row_slices(sizes.astype(np.int64), limit):
            yield batch.slice(rows.start, rows.stop - rows.start)


class Words:
    """The words of a batch: 64-bit hashes, and where the words of each row begin.

    hashes: one per word; first: row i has the words first[i]:first[i + 1].
    begin, end: where a word's bytes stand in data.
    """

    def __init__(self, texts: pa.Array, fold: bool):
        self.data, offsets = text_buffer(texts)
        data = self.data
        inside = np.zeros(len(data) + 1, bool)
        np.logical_not(_IS_SPACE[data], out=inside[:-1])
        starts = inside[:-1].copy()
        starts[1:] &= ~inside[:-2]
        stops = inside[:-1] & ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        starts[edges] = inside[edges]  # a word does not go on into the next row
        stops[edges - 1] = inside[edges - 1]
        self.begin = np.flatnonzero(starts)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.begin, offsets)
        self.hashes = self._hash(data, _FOLDED if fold else _BYTE)

    def _hash(self, data: np.ndarray, table: np.ndarray, block: int = 1 << 18) -> np.ndarray:
        """Polynomials of the words' bytes; in blocks of whole words, so that memory stays small."""
        out = np.empty(len(self.begin), _U)
        back = _inverse(int(_STEP))
        k = 0
        while k < len(self.begin):
            stop = max(k + 1, int(np.searchsorted(self.end, self.begin[k] + block)))
            base, top = self.begin[k], self.end[stop - 1]
            n = int(top - base)
            total = np.zeros(n + 1, _U)
            np.cumsum(table[data[base:top]] * _powers(_STEP, n), out=total[1:])
            begin, end = self.begin[k:stop] - base, self.end[k:stop] - base
            out[k:stop] = (total[end] - total[begin]) * _powers(back, n)[begin]
            k = stop
        lengths = (self.end - self.begin).astype(_U)
        return mix(out + lengths * _BASE)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of hashes[i:i + width] for every i where that many are left, across rows."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    if width <= 8:
        out = hashes[:n].copy()
        for j in range(1, width):
            out *= _STEP
            out += hashes[j : j + n]
        return mix(out)
    total = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * _powers(_STEP, len(hashes)), out=total[1:])
    return mix((total[width:] - total[:-width]) * _powers(_inverse(int(_STEP)), n))


def row_slices(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive rows whose sizes add up to limit at most; a larger row comes alone."""
    upto = np.cumsum(sizes)
    k, done = 0, 0
    while k < len(sizes):
        stop = max(k + 1, int(np.searchsorted(upto, done + limit, side="right")))
        yield slice(k, stop)
        done, k = upto[stop - 1], stop


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
