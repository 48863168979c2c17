"""The matching-blocks ratio 2M/T of many pairs of texts at once, in numpy.

M counts the characters in matching blocks: the longest common run (of equally long ones the first in the first text, then in the second), and
so on to its left and right. All stretches of one depth form a work list that is compared together: a row of the comparison is one
character of the first texts against all characters of the second ones. In second texts of 200 characters or more,
characters that make up over a hundredth of the text begin no run and only prolong one, as in the usual definition of the measure.
"""

from __future__ import annotations

import numpy as np

# Characters compared at once, layout only.
AT_ONCE = 1 << 21
# From this length of the second text on, frequent characters begin no run (fixed values of the measure).
LONG, SHARE = 200, 100
_PAD_A, _PAD_B = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of all texts one after the other, and where each begins."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _common(a: np.ndarray, b: np.ndarray, starts_run: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin in ``a``, begin in ``b`` and length of the first longest common run of each row."""
    n, width = b.shape
    run = np.zeros((n, width + 1), np.int32)
    best, at_a, at_b = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(a.shape[1]):
        same = b == a[:, i : i + 1]
        if starts_run is not None:
            same &= starts_run
        run[:, 1:] = (run[:, :-1] + 1) * same
        top = run.max(axis=1)
        better = np.flatnonzero(top > best)
        if len(better):
            best[better] = top[better]
            at_a[better] = i + 1 - top[better]
            at_b[better] = run[better].argmax(axis=1) - top[better]
    return at_a, at_b, best.astype(np.int64)


def _prolong(a, b, size_a, size_b, at_a, at_b, size):
    """Runs made longer on both ends by characters that may begin none."""
    rows = np.arange(len(a))
    while True:
        more = (at_a > 0) & (at_b > 0)
        more &= a[rows, np.maximum(at_a - 1, 0)] == b[rows, np.maximum(at_b - 1, 0)]
        if not more.any():
            break
        at_a, at_b, size = at_a - more, at_b - more, size + more
    while True:
        end_a, end_b = at_a + size, at_b + size
        more = (end_a < size_a) & (end_b < size_b)
        more &= a[rows, np.minimum(end_a, a.shape[1] - 1)] == b[rows, np.minimum(end_b, b.shape[1] - 1)]
        if not more.any():
            return at_a, at_b, size
        size = size + more


def _padded(data: np.ndarray, begin: np.ndarray, size: np.ndarray, pad) -> np.ndarray:
    width = int(size.max())
    place = begin[:, None] + np.arange(width)
    out = data[np.minimum(place, len(data) - 1)]
    out[np.arange(width) >= size[:, None]] = pad
    return out


def _frequent(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of long texts that begin no run."""
    out = np.zeros(len(data), bool)
    for i in np.flatnonzero(np.diff(offsets) >= LONG):
        text = data[offsets[i] : offsets[i + 1]]
        _, inverse, counts = np.unique(text, return_inverse=True, return_counts=True)
        out[offsets[i] : offsets[i + 1]] = counts[inverse] > len(text) // SHARE + 1
    return out


def matched_characters(left: list[str], right: list[str]) -> np.ndarray:
    """M of each pair."""
    a, at_a = _codes(left)
    b, at_b = _codes(right)
    frequent = _frequent(b, at_b)
    total = np.zeros(len(left), np.int64)
    pair = np.arange(len(left))
    begin_a, end_a, begin_b, end_b = at_a[:-1], at_a[1:], at_b[:-1], at_b[1:]
    while len(pair):
        some = (end_a > begin_a) & (end_b > begin_b)
        pair, begin_a, end_a, begin_b, end_b = (x[some] for x in (pair, begin_a, end_a, begin_b, end_b))
        if not len(pair):
            break
        size_a, size_b = end_a - begin_a, end_b - begin_b
        # Stretches of like sizes together, so that little is padded.
        order = np.lexsort((size_b, size_a))
        found_a, found_b, found = (np.zeros(len(pair), np.int64) for _ in range(3))
        at = 0
        while at < len(order):
            upto = at + max(1, min(len(order) - at, AT_ONCE // int(size_b[order[at:]].max())))
            # A part ends where its first texts become much longer.
            longest = size_a[order[at]] * 3 // 2 + 4
            upto = at + max(1, int(np.searchsorted(size_a[order[at:upto]], longest, side="right")))
            part = order[at:upto]
            x, y = _padded(a, begin_a[part], size_a[part], _PAD_A), _padded(b, begin_b[part], size_b[part], _PAD_B)
            barred = _padded(frequent, begin_b[part], size_b[part], False)
            result = _common(x, y, ~barred if barred.any() else None)
            if barred.any():
                result = _prolong(x, y, size_a[part], size_b[part], *result)
            found_a[part], found_b[part], found[part] = result
            at = upto
        np.add.at(total, pair, found)
        hit = found > 0
        pair, begin_a, end_a, begin_b, end_b, found_a, found_b, found = (x[hit] for x in (pair, begin_a, end_a, begin_b, end_b, found_a, found_b, found))
        stop_a, stop_b = begin_a + found_a, begin_b + found_b
        pair = np.concatenate([pair, pair])
        begin_a, end_a = np.concatenate([begin_a, stop_a + found]), np.concatenate([stop_a, end_a])
        begin_b, end_b = np.concatenate([begin_b, stop_b + found]), np.concatenate([stop_b, end_b])
    return total


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """2M/T of each pair; 1 for two empty texts. Not symmetric: ``left`` is the first text."""
    length = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64)
    if not length.any():
        return np.ones(len(length))
    return np.where(length > 0, 2.0 * matched_characters(left, right) / np.maximum(length, 1), 1.0)
