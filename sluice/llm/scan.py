"""Vectorised scanning of document bytes: words, rolling hashes, anchors.

A column of texts arrives as one Arrow string array; everything here works on its byte buffer
directly, so no Python object is made for a word, a window or a byte.  ``blocks`` walks a column in
runs of whole documents, ``words`` finds the words, ``Roller`` hashes any span of a token sequence in
constant time, and ``anchors`` names for every window of L tokens the one k-token gram inside it with
the least hash.  The anchor depends on the window's content alone, so equal windows have equal
anchors at equal offsets, and an anchor's count is an upper bound on the count of each window that it
stands for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import worker_cache

#: ASCII white space, the separators of a word: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class Roller:
    """Span hashes of a sequence of 64-bit values: sum of value[i] * base**i, shifted back to zero."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, seed: int = 1):
        n = len(values)
        self.powers, self.inverse = self._tables(seed, n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[:n], out=self.sums[1:])

    @classmethod
    def _tables(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(seed)
        if have is None or len(have[0]) <= n:
            size = max(1 << 16, 1 << int(n + 1).bit_length())
            base = int(stream(seed, 1)[0]) | 1
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                t = np.full(size, b, dtype=np.uint64)
                t[0] = 1
                both.append(np.cumprod(t, dtype=np.uint64))
            have = (both[0], both[1])
            if size <= 1 << 22:
                cls._powers[seed] = have
        return have

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:n])


worker_cache(Roller._powers.clear)


def blocks(texts: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``most`` bytes.

    A null text is an empty one.  A text longer than ``most`` makes a block of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if texts.null_count:  # the bytes under a null count for nothing
        length = np.where(np.asarray(texts.is_null()), 0, np.diff(off))
        if int(length.sum()) != int(off[-1] - off[0]):
            raw = np.concatenate([raw[a : a + k] for a, k in zip(off[:-1], length)] or [raw[:0]])
            off = np.concatenate([[0], np.cumsum(length)])
    first = 0
    while first < n:
        end = int(np.searchsorted(off, off[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, raw[off[first] : off[end]], off[first : end + 1] - off[first]
        first = end


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets of the documents in the list of words)."""
    n = len(data)
    if not n:
        e = np.zeros(0, dtype=np.int64)
        return e, e, np.zeros(len(off), dtype=np.int64)
    gap = np.ones(n + 1, dtype=bool)
    np.take(SPACE, data, out=gap[:n])
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    inside = ~gap[:n]
    opens = inside.copy()
    opens[1:] &= gap[: n - 1] | edge[1:n]
    closes = inside & (gap[1:] | edge[1:])
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, off)


def pieces(texts: pa.Array, window: int, worded: bool, most: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, tokens before, bytes, offsets): ``blocks``, but a long text comes in pieces.

    Tokens are words or bytes.  Neighbouring pieces overlap by ``window`` - 1 tokens, so that each window of a
    text starts in exactly one of its pieces, and memory doesn't follow a text's length.
    """
    for row, end, data, off in blocks(texts, most):
        n = len(data)
        if end - row > 1 or n <= 2 * most:
            yield row, 0, data, off
        elif not worded:
            for at in range(0, n - window + 1, most):
                own = data[at : at + most + window - 1]
                yield row, at, own, np.array([0, len(own)])
        else:
            at, before, stop = 0, 0, 0
            while stop < n:
                stop, m = at, 0
                while m < window and stop < n:  # at least one window, or the rest
                    stop = word_end(data, min(stop + most, n))
                    start, _, doc = words(data[at:stop], np.array([0, stop - at]))
                    m = len(start)
                yield row, before, data[at:stop], np.array([0, stop - at])
                if m >= window:
                    at += int(start[m - window + 1]) if window > 1 else stop - at
                    before += m - window + 1


def word_end(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on that is not within a word."""
    while at < len(data):
        gap = np.flatnonzero(SPACE[data[at : at + 4096]])
        if len(gap):
            return at + int(gap[0])
        at += 4096
    return len(data)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of these words, each followed by a space; where each begins)."""
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat((start - to[:-1]), size)
    index += np.arange(to[-1])
    np.minimum(index, max(len(data) - 1, 0), out=index)
    out = data[index] if len(data) else np.zeros(0, np.uint8)
    out[to[1:] - 1] = 32
    return out, to


_BYTES = {seed: stream(seed * 977, 256) | np.uint64(1) for seed in (1, 2)}


def byte_roller(data: np.ndarray, seed: int = 1) -> Roller:
    return Roller(_BYTES[seed][data], seed)


def anchors(grams: np.ndarray, window: int, k: int, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all windows of ``window`` tokens that lie within one document.

    ``grams[i]`` is the hash of the k tokens from i on; ``off`` has the documents' offsets in tokens.
    Returns (document, first window start, number of window starts, position of the gram): one row
    for each run of neighbouring windows that share an anchor.
    """
    none = np.zeros(0, dtype=np.int64)
    length = np.diff(off)
    total = int(np.maximum(length - window + 1, 0).sum())
    if not total:
        return none, none, none, none
    w = window - k + 1
    m = len(grams)
    pad = -m % w
    x = np.full(m + pad, np.iinfo(np.uint64).max, dtype=np.uint64)
    x[:m] = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    x = x.reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    doc = np.flatnonzero(length >= window)
    count = length[doc] - window + 1
    starts = np.repeat(off[:-1][doc] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(total)
    at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(total, dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    runs = np.diff(np.append(head, total))
    first = starts[head]
    return np.searchsorted(off, first, "right") - 1, first, runs, at[head]


def binary_rows(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """An Arrow binary array of the spans [start, end) of ``data``."""
    size = (end - start).astype(np.int64)
    to = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat(start - to[:-1], size) + np.arange(to[-1])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[index]))])
