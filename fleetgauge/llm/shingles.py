"""Words and five-word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a shingle.
WORDS = 5
_RNG = np.random.default_rng(20240131)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_WORD = ~np.isin(np.arange(256), [32, *range(9, 14)])
_STEP = _RNG.integers(1, 1 << 62, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(of: np.uint64, name: str, n: int) -> np.ndarray:
    """of ** 0 .. of ** n modulo 2 ** 64; kept for the next call: a slice's bytes and some, or a longer text's."""
    if name not in _powers or len(_powers[name]) <= n:
        steps = np.full(max(n, 5 << 17) + 1, of, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one more entry: the end). Null: empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, hash) of each word in order. Words: runs without space, tab to CR; A-Z lower-cased.

    A word's hash is a difference of two prefix sums, moved to a common origin, so all words of all
    segments cost a few passes over the bytes.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    inner = at[(at > 0) & (at < n)]  # a segment's border also parts words
    begins[inner] = inside[inner]
    ends[inner - 1] = inside[inner - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.multiply(_BYTE[data], _power(_BASE, "up", n)[:n]), out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _power(_BACK, "down", n)[begin])
    return np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(begin, at))), hashes


def grouped(segment: np.ndarray, value: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """An order that groups by segment, inside by rank (of at most 16 bits) and value.

    One sort of a packed key; where that can't tell two values apart, an exact one.
    """
    high = int(segment.max(initial=0)).bit_length() if len(segment) else 0
    low = 0 if rank is None else 16
    if high + low > 40:
        return np.lexsort((value, segment) if rank is None else (value, rank, segment))
    packed = value >> np.uint64(high + low)
    if rank is not None:
        packed |= rank.astype(np.uint64) << np.uint64(64 - high - low)
    if high:
        packed |= segment.astype(np.uint64) << np.uint64(64 - high)
    order = np.argsort(packed)
    same = np.flatnonzero(packed[order[1:]] == packed[order[:-1]])
    if (value[order[same]] != value[order[same + 1]]).any():
        return np.lexsort((value, segment) if rank is None else (value, rank, segment))
    return order


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, hash) of all shingles, repeats included, in no order.

    A segment of fewer than five words has its whole sequence as its one shingle; without words, none.
    """
    segment, words = word_hashes(data, at)
    n = len(words)
    count = np.bincount(segment, minlength=len(at) - 1)
    if n >= WORDS:
        whole = segment[: n - WORDS + 1] == segment[WORDS - 1 :]
        value = np.zeros(n - WORDS + 1, np.uint64)
        for k in range(WORDS):
            value += words[k : n - WORDS + 1 + k] * _STEP[k]
        seg, val = segment[: n - WORDS + 1][whole], mix(value[whole])
    else:
        seg, val = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.cumsum(count) - count
    for size in range(1, WORDS):
        own = np.flatnonzero(count == size)
        value = np.full(len(own), size, np.uint64) * _STEP[WORDS]
        for k in range(size):
            value += words[first[own] + k] * _STEP[k]
        seg, val = np.concatenate([seg, own]), np.concatenate([val, mix(value)])
    return seg, val


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, hash) of the distinct shingles, grouped by segment."""
    seg, val = shingles(data, at)
    order = grouped(seg, val)
    seg, val = seg[order], val[order]
    new = np.ones(len(seg), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (val[1:] != val[:-1])
    return seg[new], val[new]


def starts_of(sorted_ids: np.ndarray, n: int) -> np.ndarray:
    """Where each id of 0..n-1 begins in the sorted ids, and the end."""
    return np.concatenate([[0], np.cumsum(np.bincount(sorted_ids, minlength=n))])


def folded(values: np.ndarray, op: np.ufunc, at: np.ndarray) -> np.ndarray:
    """op over each segment of values; 0 for an empty one."""
    out = np.zeros(len(at) - 1, values.dtype)
    full = at[1:] > at[:-1]
    if full.any():
        out[full] = op.reduceat(values, at[:-1][full])
    return out


def fingerprints(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each segment's set."""
    return (
        mix(folded(mix(values, 11), np.add, at)).view(np.int64),
        mix(folded(mix(values, 23), np.bitwise_xor, at), 5).view(np.int64),
    )


def sketches(values: np.ndarray, segment: np.ndarray, n: int, words: int) -> np.ndarray:
    """Parity sketches: each shingle flips one of 64 * words bits of its segment's row (n x words)."""
    spot = mix(values, 37) % np.uint64(64 * words)
    out = np.zeros(n * words, np.uint64)
    np.bitwise_xor.at(out, segment * words + (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
    return out.view(np.int64).reshape(n, words)
