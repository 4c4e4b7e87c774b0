"""Content-chosen anchors of fixed-length windows, for all texts of a block at once.

A window of `span` bytes is anchored at the k-gram of least hash in it (the leftmost of equals). Equal windows have equal
anchors at equal places, so repeats of a window are found among repeats of its anchor. Neighbouring windows mostly share
an anchor; a run of windows with one anchor is a single row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .common import U64, SpanHasher, mix

GRAM = 36
_grams, _regions = SpanHasher(303), SpanHasher(404)
_PLACE = U64(24)
#: Bytes of a text that are looked at together; a longer one is cut with overlaps, each window in one cut.
LONGEST = 1 << 23


class Runs(NamedTuple):
    text: np.ndarray  # which text
    start: np.ndarray  # first window's first byte
    count: np.ndarray  # windows
    anchor: np.ndarray  # the anchor's first byte
    gram: np.ndarray  # hash of the anchor's k-gram
    region: np.ndarray  # hash of all bytes that the windows cover, with the place of the anchor in them


def _runs(data: np.ndarray, bounds: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    width = span - GRAM + 1
    n = len(data) - span + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    prefix = _grams.prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _grams.spans(prefix, at, at + GRAM)
    least = (grams >> _PLACE << _PLACE) | at.astype(U64)
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.arange(n) + span <= bounds[1:][owner]
    windows = np.flatnonzero(inside)
    if not len(windows):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    anchor = (least[windows] & U64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    start, anchor = windows[first], anchor[first]
    count = np.diff(np.concatenate([first, [len(windows)]]))
    regions = _regions.spans(_regions.prefix(data), start, start + count + span - 1)
    region = mix(regions ^ ((anchor - start).astype(U64) << U64(40)) ^ (count.astype(U64) << U64(52)))
    return owner[start], start, count, anchor, grams[anchor], region


def anchored_runs(texts: list[bytes], span: int) -> Runs:
    if len(texts) == 1 and len(texts[0]) > LONGEST:
        parts = []
        for a in range(0, len(texts[0]) - span + 1, LONGEST):
            cut = np.frombuffer(texts[0], np.uint8)[a : a + LONGEST + span - 1]
            owner, start, count, anchor, gram, region = _runs(cut, np.array([0, len(cut)]), span)
            parts.append((owner, start + a, count, anchor + a, gram, region))
        out = [np.concatenate(c) for c in zip(*parts, strict=True)]
    else:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        out = list(_runs(np.frombuffer(b"".join(texts), np.uint8), bounds, span))
        out[1] = out[1] - bounds[:-1][out[0]]
        out[3] = out[3] - bounds[:-1][out[0]]
    return Runs(*out)


def longer_gram(span: int) -> int:
    """Bytes of the grams that sides() deals by: the anchor's and half of what a window has beyond it."""
    return GRAM + (span - GRAM) // 2


def sides(texts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts that are one run each (the bytes that its windows cover): which text, first window, windows, a key, and where in
    the windows' bytes its gram is; once or twice a text. A window reaches half its free bytes or more beyond its anchor's k-gram
    on the left, or else on the right; windows of one side that are equal have equal longer grams on that side, whose hash is
    the key, at equal places."""
    runs = anchored_runs(texts, span)
    if len(runs.text) != len(texts):
        raise ValueError("each text must be one run")
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    half = (span - GRAM) // 2
    prefix, at, n = _regions.prefix(data), bounds + runs.anchor, runs.count
    split = np.clip(runs.anchor - half + 1, 0, n)  # windows before it are the left side's
    left, right = np.flatnonzero(split > 0), np.flatnonzero(split < n)
    keys = [mix(_regions.spans(prefix, at[left] - half, at[left] + GRAM) ^ U64(1)), mix(_regions.spans(prefix, at[right], at[right] + GRAM + half) ^ U64(2))]
    first = np.concatenate([np.zeros(len(left), np.int64), split[right]])
    place = np.concatenate([runs.anchor[left] - half, runs.anchor[right]]) - first
    return np.concatenate([left, right]), first, np.concatenate([split[left], (n - split)[right]]), np.concatenate(keys).view(np.int64), place
