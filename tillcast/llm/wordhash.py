"""Words and word hashes of many texts at once, over the UTF-8 bytes of an Arrow column.

Used inside tasks: an Arrow batch is cut into slices of bounded size and
every step is a numpy pass over the slice's bytes or words, so no Python
loop runs per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = []

# ASCII case folding and the word bytes: digits, a-z (after folding), and every byte of a non-ASCII character.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive runs of texts, each of about ``max_bytes``
    (a longer text stands alone). Nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def each_text(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """The texts one by one; only some hundred of them are Python strings at a time."""
    for a in range(0, len(column), rows):
        yield from column.slice(a, rows).to_pylist()


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        out = []
        for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        if n > 8 * SLICE_BYTES:  # of one very long text: not kept
            return out[0], out[1]
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = ALNUM
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that stay inside one text.

    Returns the case-folded bytes, the start and end of each word, and
    ``first``: the index of each text's first word (one more entry than texts).
    """
    low = FOLD[data]
    inside = word_bytes[low]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def range_hasher(low: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that hashes ranges (starts, ends) of bytes or of word hashes: a
    polynomial over the values, taken from prefix sums, then mixed."""
    power, inverse = _powers(len(low))
    total = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:len(low)], dtype=np.uint64, out=total[1:])
    return lambda starts, ends: mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word."""
    return range_hasher(low)(starts, ends)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (fewer words: an empty array)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    size = len(words) - n + 1
    out = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + words[j:j + size]
    return mix(out)


def owner(first: np.ndarray) -> np.ndarray:
    """The text index of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
