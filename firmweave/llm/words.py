"""Words and fingerprints over many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x2545F4914F6CDD1B)
_BLOCK = 1 << 17

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= _K1
    x ^= x >> np.uint64(29)
    x *= _K2
    x ^= x >> np.uint64(32)
    return x


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of two neighbours as one; order matters."""
    x = a >> np.uint64(32)
    x ^= a
    x *= _K1
    x += b
    x ^= x >> np.uint64(29)
    x *= _K2
    return x


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per text the number of words before it.

    A word is a longest run of bytes of one text that are no separators.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


_powers = np.ones((2, 1), np.uint64)
# _STEP is odd, so it has an inverse among 64-bit numbers.
_STEPS = np.array([[int(_STEP)], [pow(int(_STEP), -1, 1 << 64)]], np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of the step, and of its inverse."""
    global _powers
    while _powers.shape[1] < n:
        _powers = np.concatenate([_powers, _powers * (_powers[:, -1:] * _STEPS)], axis=1)
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of words, block by block: differences of running sums, brought back to the word's start."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _BLOCK)))
        first, size = int(starts[lo]), int(ends[hi - 1] - starts[lo])
        forth, back = _power(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[first : first + size]] * forth[:size], out=sums[1:])
        heads = starts[lo:hi] - first
        out[lo:hi] = (sums[ends[lo:hi] - first] - sums[heads]) * back[heads]
        lo = hi
    return mix(out)


def ranking(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable ``argsort`` of numbers below ``2 ** bits``, and the numbers in that order.

    The upper bits that leave room for the place are sorted along with it, which is several times as fast as sorting places; what
    they leave out of order is put right.
    """
    room = len(values).bit_length()
    packed = (values >> np.uint64(max(0, bits + room - 64))) << np.uint64(room)
    packed |= np.arange(len(values), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << room) - 1)
    order = packed.view(np.int64)
    ranked = values[order]
    if (ranked[1:] < ranked[:-1]).any():
        order = order[np.argsort(ranked, kind="stable")]
        ranked = values[order]
    return order, ranked


def distinct(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers below ``2 ** bits``, ascending, and the place of each one's number among them."""
    order, ranked = ranking(values, bits)
    first = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return ranked[first], inverse


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def counts_between(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set marks from each offset to the next one."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
