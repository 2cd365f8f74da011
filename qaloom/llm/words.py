"""Hashes of the words of many texts at once, in numpy: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased."""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
MARK = BLANK | ((np.arange(256) < 128) & ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)]))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


try:
    _trim = ctypes.CDLL(None).malloc_trim
except AttributeError:  # only glibc has it
    _trim = None


def tidy() -> None:
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidied(work):
    """work, a function for mapInArrow or applyInArrow, that gives its memory back to the system when it is done:
    Python workers live on between tasks, and would keep it."""

    if inspect.isgeneratorfunction(work):

        @functools.wraps(work)
        def run(batches):
            yield from work(batches)
            tidy()
    elif len(inspect.signature(work).parameters) == 2:

        @functools.wraps(work)
        def run(left, right):
            out = work(left, right)
            tidy()
            return out
    else:

        @functools.wraps(work)
        def run(table):
            out = work(table)
            tidy()
            return out

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(n + (1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def pieces(texts: pa.Array, size: int = 1 << 19, most: int = 60_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to size bytes and most rows, or one row."""
    off = np.concatenate([[0], np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)).astype(np.int64))]) if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(off, off[at] + size, "right")) - 1
        to = min(max(to, at + 1), at + most, len(texts))
        yield at, to
        at = to


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts end to end, and where each begins; null is empty."""
    flat = pc.fill_null(texts, "").cast(pa.large_string())
    off = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def word_hashes(texts: pa.Array, separators: np.ndarray = BLANK, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """A 64-bit hash for each word, and bounds: text i has words bounds[i] to bounds[i + 1]; then, for each number in
    heads, the hashes of so many first bytes of the words. Words are runs of bytes that aren't separators. A hash is the difference of two prefix sums of a polynomial, moved to power 0 and mixed.
    Memory: some 60 bytes a byte."""
    data, off = raw(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), *(np.zeros(0, np.uint64) for _ in heads)
    blank = separators[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    cut = edge.copy()
    cut[1:] |= blank
    begin = np.flatnonzero(~blank & cut[:n])
    cut = edge[1:].copy()
    cut[:-1] |= blank[1:]
    end = np.flatnonzero(~blank & cut) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[LOWERED[data]] * up, out=sums[1:])
    hashed = lambda to: mix((sums[to] - sums[begin]) * down[begin])
    return hashed(end), np.searchsorted(begin, off), *(hashed(np.minimum(end, begin + k)) for k in heads)


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of k words of each text, as sorted 64-bit hashes, and their bounds. A text of fewer
    words, but not none, has its whole sequence as one."""
    texts = np.diff(bounds)
    total = len(words)
    rolled = np.zeros(max(0, total - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j : j + len(rolled)] * np.uint64(pow(INVERSE, j + 1, 1 << 64))
    owner = np.repeat(np.arange(len(texts)), texts)
    whole = np.flatnonzero(np.arange(len(rolled)) + k <= bounds[1:][owner[: len(rolled)]])
    short = np.flatnonzero((texts > 0) & (texts < k))
    brief = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        there = texts[short] > j
        brief[there] += words[bounds[short[there]] + j] * np.uint64(pow(INVERSE, j + 1, 1 << 64))
    brief += texts[short].astype(np.uint64) * np.uint64(BASE)
    values = mix(np.concatenate([rolled[whole], brief]))
    owners = np.concatenate([owner[whole], short]).astype(np.uint16)
    order = np.argsort(values)
    order = order[np.argsort(owners[order], kind="stable")]
    values, owners = values[order], owners[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[first], owners[first]
    return values, np.searchsorted(owners, np.arange(len(texts) + 1))
