"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column through sequential files.

Round 0 inserts every string's empty suffix, in the strings' order. Round j inserts, for every string of j or more symbols at
once, its suffix of length j: the row of the suffix of length j - 1 holds the symbol in front of it, and the new suffix's
row follows from how many such symbols stand before that row (LF mapping). The new row's common prefix with the row above is
one more than the least common prefix between its old row and the row above that which holds the same symbol; the row below
changes likewise.

Rows are records of a file, in order: symbol in front, common prefix with the row above, length and string of the suffix. A round
reads the file twice in blocks from front to back, first to place the new rows, with a few numbers for each symbol carried from
block to block, then to write the file of the next round. Files are the task's own and without a name; up to FILE_BYTES they
stay in memory, beyond it they are on the worker's spill folder. In memory are the strings, a few numbers for each string and one
block; there is no limit to the number of strings but that.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

_STEP = 16
#: Rows of a block, and bytes of a file that stay in memory.
BLOCK, FILE_BYTES = 1 << 20, 32 << 20
#: Bits of a record's fields from the low end: string, length, common prefix, symbol.
STRING, LENGTH, COMMON = 32, 11, 11
LONGEST = (1 << LENGTH) - 1
U = np.uint64
_LENGTH_AT, _COMMON_AT, _SYMBOL_AT = U(STRING), U(STRING + LENGTH), U(STRING + LENGTH + COMMON)
_COMMON_MASK = U(LONGEST) << _COMMON_AT


class Strings:
    """Strings of symbols (numbers from 0) in one array, their bounds, and the symbols that occur, numbered from 1."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray):
        self.bounds, self.lengths = bounds, np.diff(bounds)
        if len(self.lengths) and self.lengths.max() > LONGEST:
            raise ValueError(f"strings of more than {LONGEST} symbols")
        self.present = np.flatnonzero(np.bincount(symbols)) if len(symbols) else np.zeros(0, np.int64)
        code = np.zeros(int(self.present.max(initial=0)) + 1, np.uint16)
        code[self.present] = np.arange(1, len(self.present) + 1)
        self.symbols = code[symbols] if len(symbols) else np.zeros(0, np.uint16)

    @classmethod
    def of(cls, strings: list[bytes]) -> Strings:
        return cls(np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings], dtype=np.int64)]))

    def in_front(self, which: np.ndarray, length: int) -> np.ndarray:
        """The symbol in front of the suffix of this length, 0 if it is the whole string."""
        out = np.zeros(len(which), np.uint16)
        more = self.lengths[which] > length
        out[more] = self.symbols[self.bounds[which[more] + 1] - 1 - length]
        return out


def _records(symbol: np.ndarray, common: np.ndarray, length: int, string: np.ndarray) -> np.ndarray:
    return (symbol.astype(U) << _SYMBOL_AT) | (common.astype(U) << _COMMON_AT) | (U(length) << _LENGTH_AT) | string.astype(U)


def _commons(records: np.ndarray) -> np.ndarray:
    return (records >> _COMMON_AT & U(LONGEST)).astype(np.int16)


def _symbols(records: np.ndarray) -> np.ndarray:
    return (records >> _SYMBOL_AT).astype(np.uint16)


class _File:
    """Records written once from front to back, then read in blocks."""

    def __init__(self):
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self.file = tempfile.SpooledTemporaryFile(FILE_BYTES, dir=folder if os.path.isdir(folder) else None)  # noqa: SIM115
        self.n = 0

    def write(self, records: np.ndarray) -> None:
        self.file.write(memoryview(np.ascontiguousarray(records)).cast("B"))
        self.n += len(records)

    def blocks(self) -> Iterator[np.ndarray]:
        self.file.seek(0)
        while raw := self.file.read(8 * BLOCK):
            yield np.frombuffer(raw, U)

    def close(self) -> None:
        self.file.close()


class _Least:
    """Least values of many ranges (after, upto] of an array: partial blocks directly, whole blocks by doubled minima."""

    def __init__(self, values: np.ndarray):
        top = np.iinfo(values.dtype).max
        pad = -len(values) % _STEP
        self.blocks = np.concatenate([values, np.full(pad, top, values.dtype)]).reshape(-1, _STEP)
        least = self.blocks.ravel()
        while len(least) > len(self.blocks):
            least = np.minimum(least[::2], least[1::2])
        self.top, self.levels = top, [least]
        while len(self.levels[-1]) > 1:
            width = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            if len(last) <= width:
                break
            self.levels.append(np.minimum(last[:-width], last[width:]))

    def _part(self, block: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        at = np.arange(_STEP)
        cut = self.blocks[block]
        cut[(at < first[:, None]) | (at > last[:, None])] = self.top
        return cut.min(axis=1)

    def __call__(self, after: np.ndarray, upto: np.ndarray) -> np.ndarray:
        first = after + 1
        a, b = first // _STEP, upto // _STEP
        out = self._part(a, first % _STEP, np.where(a == b, upto % _STEP, _STEP - 1))
        more = np.flatnonzero(a != b)
        if len(more):
            out[more] = np.minimum(out[more], self._part(b[more], np.zeros(len(more), np.int64), upto[more] % _STEP))
        far = np.flatnonzero(b - a > 1)
        if len(far):
            n = (b - a)[far] - 1
            level = np.frexp(n)[1] - 1
            for k in np.unique(level):
                here = far[level == k]
                low, high = a[here] + 1, b[here] - (1 << int(k))
                out[here] = np.minimum(out[here], np.minimum(self.levels[k][low], self.levels[k][high]))
        return out


def _place(file: _File, rows: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One pass over the file. For the ascending rows: their strings, their new rows and common prefixes there; and the new rows
    right below them, where there are, with what these share with the row above now. base: where the new rows of each symbol start."""
    strings, new, common, lower, lower_common = ([] for _ in range(5))
    seen = np.zeros(len(base), np.int64)
    top = np.int16(np.iinfo(np.int16).max)
    carried = np.full(len(base), top)  # least common prefix since the symbol's last row
    waiting = np.full(len(base), -1)  # the new row below the symbol's last row, if that is one of rows
    at = offset = 0
    for records in file.blocks():
        n = len(records)
        upto = int(np.searchsorted(rows, offset + n))
        symbol = _symbols(records)
        symbol = symbol if len(base) > 256 else symbol.astype(np.uint8)
        least = _Least(_commons(records))
        order = np.argsort(symbol, kind="stable")
        counts = np.bincount(symbol, minlength=len(base))
        starts = np.cumsum(counts) - counts
        flag = np.zeros(n + 1, bool)
        flag[rows[at:upto] - offset] = True
        asked = np.flatnonzero(flag[order])  # places in order: by symbol, then by row
        here = order[asked]
        own = symbol[here].astype(np.int64)
        rank = asked - starts[own]
        target = base[own] + seen[own] + rank
        inside, followed = rank > 0, rank + 1 < counts[own]
        # least prefixes between neighbours of a symbol, once for each pair that is asked for
        pairs = np.unique(np.concatenate([asked[inside], asked[followed] + 1]))
        between = least(order[pairs - 1], order[pairs]) + 1
        found = np.zeros(len(asked), np.int64)
        found[inside] = between[np.searchsorted(pairs, asked[inside])]
        across = np.flatnonzero(~inside & (seen[own] > 0))
        if len(across):
            found[across] = np.minimum(carried[own[across]], least(np.full(len(across), -1), here[across])) + 1
        strings.append((records[here] & U((1 << STRING) - 1)).astype(np.int64))
        new.append(target)
        common.append(found)
        # what waited for its symbol's next row, which is the first one here
        there = counts > 0
        met = np.flatnonzero(there & (waiting >= 0))
        lower += [waiting[met], target[followed] + 1]
        lower_common += [np.minimum(carried[met], least(np.full(len(met), -1), order[starts[met]])) + 1, between[np.searchsorted(pairs, asked[followed] + 1)]]
        last = order[(starts + counts - 1)[there]]
        carried = np.minimum(carried, least.levels[-1].min())
        carried[there] = np.where(last < n - 1, least(np.minimum(last, n - 2), np.full(len(last), n - 1)) if n > 1 else top, top)
        waiting[there] = -1
        waiting[own[~followed]] = target[~followed] + 1
        seen += counts
        at, offset = upto, offset + n
    return tuple(np.concatenate(x) for x in (strings, new, common, lower, lower_common))


def _merge(file: _File, places: np.ndarray, records: np.ndarray, lower: np.ndarray, lower_common: np.ndarray) -> _File:
    """The next round's file: records at the ascending places, common prefixes replaced at lower (ascending)."""
    out = _File()
    ahead = places - np.arange(len(places))  # old rows in front of each
    at = offset = 0
    for old in file.blocks():
        ends = offset + len(old) == file.n
        upto = len(places) if ends else int(np.searchsorted(ahead, offset + len(old)))
        start, n = offset + at, len(old) + upto - at
        merged, keep = np.empty(n, U), np.ones(n, bool)
        into = places[at:upto] - start
        keep[into] = False
        merged[keep] = old
        merged[into] = records[at:upto]
        a, b = np.searchsorted(lower, [start, start + n])
        where = lower[a:b] - start
        merged[where] = (merged[where] & ~_COMMON_MASK) | (lower_common[a:b].astype(U) << _COMMON_AT)
        out.write(merged)
        at, offset = upto, offset + len(old)
    file.close()
    return out


def transform(strings: Strings) -> _File:
    """The file of the last round. Equal suffixes are ordered by their strings' places in the list."""
    m = len(strings.lengths)
    counts = np.zeros(len(strings.present) + 1, np.int64)
    every = rows = np.arange(m)
    file, symbol = _File(), strings.in_front(every, 0)
    for k in range(0, m, BLOCK):
        some = every[k : k + BLOCK]
        file.write(_records(symbol[some], np.zeros(len(some), np.int64), 0, some))
    for j in range(1, int(strings.lengths.max(initial=0)) + 1):
        counts += np.bincount(symbol, minlength=len(counts))
        # rows whose suffix has a symbol in front; new rows of a symbol come after the empty suffixes and those of smaller symbols
        rows = rows[symbol > 0]
        string, rows, common, lower, lower_common = _place(file, rows, m + np.cumsum(counts) - counts - counts[0])
        # both are runs of ascending rows, one for each symbol and block
        by_row, by_lower = np.argsort(rows, kind="stable"), np.argsort(lower, kind="stable")
        string, rows = string[by_row], rows[by_row]
        symbol = strings.in_front(string, j)
        file = _merge(file, rows, _records(symbol, common[by_row], j, string), lower[by_lower], lower_common[by_lower])
    return file


def collection_suffixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of all strings in order: which string, where the suffix starts, the symbol in front of it (-1: none), and the
    symbols it shares with the suffix above."""
    held = Strings.of(strings)
    file = transform(held)
    records = np.concatenate([np.zeros(0, U), *file.blocks()])
    file.close()
    string, symbol = (records & U((1 << STRING) - 1)).astype(np.int64), _symbols(records).astype(np.int64)
    length = (records >> _LENGTH_AT & U(LONGEST)).astype(np.int64)
    return string, held.lengths[string] - length, np.where(symbol > 0, np.concatenate([[0], held.present])[symbol], -1), _commons(records)


def repeated_windows(strings: Strings, windows: np.ndarray, span: int) -> np.ndarray:
    """For each string a number of windows at its start (window w covers symbols w to w + span): which of all these windows, in
    string order, equals one of a string further up the list or earlier in the same string."""
    offset = np.concatenate([[0], np.cumsum(windows, dtype=np.int64)])
    out = np.zeros(int(offset[-1]), bool)
    if not len(out):
        return out
    file, held = transform(strings), np.zeros(0, U)

    def judge(records: np.ndarray) -> None:
        """Whole runs: rows of one window content are a run in which each shares the span with the row above."""
        string = (records & U((1 << STRING) - 1)).astype(np.int64)
        start = strings.lengths[string] - (records >> _LENGTH_AT & U(LONGEST)).astype(np.int64)
        run = np.cumsum(_commons(records) < span)
        wanted = start < windows[string]
        string, start, run = string[wanted], start[wanted], run[wanted]
        if len(run):
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            order = string * (1 << LENGTH) + start
            earliest = np.repeat(np.minimum.reduceat(order, first), np.diff(np.concatenate([first, [len(order)]])))
            out[offset[string] + start] = order > earliest

    for block in file.blocks():
        held = np.concatenate([held, block])
        heads = np.flatnonzero(_commons(held) < span)
        if len(heads) and heads[-1]:
            judge(held[: heads[-1]])
            held = held[heads[-1] :]
    judge(held)
    file.close()
    return out
