"""Flat arrays over many texts: code points, words and word hashes.

A batch of texts becomes one array of code points with offsets, so that whole
batches are handled by numpy without a loop over characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = (9, 10, 11, 12, 13, 32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xBF58476D1CE4E5B9)


def chunks(texts: list, limit: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` characters together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str], gap: int = 1, fill: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """All code points, ``gap`` fillers after each text; and the offset of each text, with the end."""
    joined = (chr(fill) * gap).join(texts) + chr(fill) * gap
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + gap
    return points, np.concatenate(([0], np.cumsum(lengths)))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _MUL
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of characters other than white space."""
    low = points <= 32
    space = low & ((points == 32) | ((points >= 9) & (points <= 13)))
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    return edge[0::2], edge[1::2]


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word. Characters are mixed with their place in the
    word before they are summed, so the order of characters counts."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    place = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    chars = points[place + np.repeat(starts, lengths)].astype(np.uint64)
    h = mix(chars + (place.astype(np.uint64) + np.uint64(1)) * _MIX)
    return mix(np.add.reduceat(h, first) + lengths.astype(np.uint64) * _MIX)


def shingle_hashes(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the n-word shingles of each text, ascending within a
    text, and offsets. A text of fewer words is one shingle, one without words
    has none."""
    points, at = code_points(texts)
    starts, ends = word_spans(points)
    words = word_hashes(points, starts, ends)
    owner = np.searchsorted(at, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    base = np.cumsum(count) - count
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(texts)), made)
    first = np.repeat(base, made) + np.arange(int(made.sum())) - np.repeat(np.cumsum(made) - made, made)
    stop = np.repeat(base + count, made)
    h = np.zeros(len(first), np.uint64)
    for k in range(n):
        inside = first + k < stop
        word = words[np.minimum(first + k, max(len(words) - 1, 0))] if len(words) else h
        salt = np.uint64((k + 1) * int(_MIX) & (1 << 64) - 1)
        h = np.where(inside, mix(h * np.uint64(31) + word + salt), h)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))
