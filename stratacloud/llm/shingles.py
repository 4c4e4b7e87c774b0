"""Word shingles of many texts at once, as numpy arrays of hashes.

A-Z are lower-cased; words are maximal runs of other than ASCII white space. A text's set is its distinct runs of `width`
words; with fewer words, the whole sequence as one; without words, empty.
"""

from __future__ import annotations

import numpy as np

from .common import U64, SpanHasher, mix

_words = SpanHasher(101, fold_case=True)
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' sets, text by text and ascending in each, and the bounds (len(texts) + 1) between the texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    first = np.concatenate([[0], np.cumsum(lengths + 1)])  # where the line break in front of each text is
    word = ~_space[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    hashes = _words.spans(_words.prefix(data), start, end)
    bound = np.searchsorted(start, first)
    counts = np.diff(bound)
    n = len(hashes)
    # Horner over the next words; windows that would leave their text are cut off below
    rolled = np.zeros(n, U64)
    factor = U64(0x9E3779B97F4A7C15)
    for k in range(width):
        shifted = np.zeros(n, U64)
        shifted[: max(n - k, 0)] = hashes[k:]
        rolled = rolled * factor + shifted
    rolled = mix(rolled)
    owner = np.repeat(np.arange(len(texts)), counts)
    keep = np.arange(n) + width <= bound[1:][owner]
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        whole = U64(0)
        with np.errstate(over="ignore"):
            for h in hashes[bound[k] : bound[k + 1]]:
                whole = whole * factor + h
            rolled[bound[k]] = mix(np.array([whole + U64(int(counts[k]))]))[0]
        keep[bound[k]] = True
    owner, found = owner[keep], rolled[keep]
    limits = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        found[a:b].sort()
    if len(found):
        new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
        limits = np.concatenate([[0], np.cumsum(new)])[limits]
        found = found[new]
    return found, limits


def set_sums(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 63-bit sums per set that equal sets share, as (len(bounds) - 1, 2) int64."""
    out = np.zeros((len(bounds) - 1, 2), np.int64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            out[full, k] = np.add.reduceat(mix(sets ^ U64(salt)), bounds[full]).view(np.int64)
    return out


def intersections(a: list[bytes], b: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of a[k]'s set, b[k]'s set and what they share."""
    x, at_x = shingle_sets(a, width)
    y, at_y = shingle_sets(b, width)
    both = np.zeros(len(a), np.int64)
    for k in range(len(a)):
        merged = np.concatenate([x[at_x[k] : at_x[k + 1]], y[at_y[k] : at_y[k + 1]]])
        merged.sort()
        both[k] = np.count_nonzero(merged[1:] == merged[:-1])
    return np.diff(at_x), np.diff(at_y), both
