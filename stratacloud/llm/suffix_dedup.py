"""Exact removal of repeated byte strings: every byte that a SPAN-byte string covers which also starts earlier.

Documents are ordered by id, then by position; matches never cross documents; strings are judged on the input.

1. Candidates. Each SPAN-byte window is anchored at one k-gram (see anchors); runs of windows with one anchor are rows. Rows are
   dealt by the anchor's hash. Rows with the same covered bytes form a class; all but the class's first are repeats as a whole.
   A class's first matters further only if its anchor occurs in another class, too: some of its windows may be repeats.
   No pair of rows is ever made; a batch sends each class once.
2. Suffix order. For those first rows, the covered bytes (SPAN to about 2 SPAN) are cut into the windows that reach far to the
   left of the anchor and those that reach far to the right, and dealt by the longer gram on that side, which also takes apart
   an anchor that very many documents have. A string alone with its gram is done. In the others the gram, which equal windows
   have at equal places, is written as DIGITS symbols that occur nowhere else, one number for each distinct gram (its bytes, not
   its hash). The collection's Burrows-Wheeler transform and common prefixes are built column by column, one symbol of each
   string a round, through sequential files (see collection_bwt). Neighbouring suffixes whose common prefix reaches a window's
   symbols are equal windows; all but the earliest are repeats.
3. Removal. Each document's repeated runs are merged and cut out of its bytes.

The column-wise construction takes as many passes over the transform as the longest string has symbols; on whole texts that
is up to 100,000 passes over all data. Step 1 leaves it strings of bounded length, and exactly those in which it decides. In
step 1 rows are equal if two independent 64-bit hashes are, of the anchor's gram and of all covered bytes with the anchor's place:
over 10^10 rows two different ones meet with a chance below 10^-18.

Null or empty text, or one shorter than SPAN bytes: nothing is removed. Rows that repeat doc_id and text are one document and
get the same result; rows that share a doc_id but not the text are ordered by a hash of the text. A null doc_id sorts first.
An empty table gives an empty result. Other columns are not read. Texts are taken whole; kept_text replaces a character that
a removal cut through by U+FFFD.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import anchored_runs, longer_gram, sides
from .collection_bwt import Strings, repeated_windows
from .common import column_bytes, durable, released, small_batches, task_count, text_blocks

SPAN = 100
#: Strings whose transform is built together, but for a group that has more; and the symbols that number a gram, each of 7 bits.
COLLECTION, DIGITS = 8192, 4
_NULL = -(1 << 63)
_KEY = ["doc", "tie"]
_RUN = np.dtype([("start", "<i4"), ("count", "<i2"), ("kind", "<i2"), ("gram", "<i8")])


def _keyed(docs: DataFrame, *extra: Column) -> DataFrame:
    """doc and tie identify a document and order documents; both are never null."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"), *extra)


def candidate_runs(keyed: DataFrame, span: int) -> DataFrame:
    """gram, region, doc, tie, at, kind: at is the start and, in its low 16 bits, the count; kind 1 says that the batch has an earlier row
    of the class (a repeat)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(2))
            doc, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in text_blocks(texts):
                r = anchored_runs(texts[a:b], span)
                d, t = doc[a:b][r.text], tie[a:b][r.text]
                order = np.lexsort((r.start, t, d, r.region, r.gram))
                gram, region = r.gram[order].view(np.int64), r.region[order].view(np.int64)
                again = np.zeros(len(order), np.int16)
                again[1:] = (gram[1:] == gram[:-1]) & (region[1:] == region[:-1])
                d, t, start = d[order], t[order], r.start[order].astype(np.int32)
                # a row repeated as it is (a document given twice) is no repeat of itself
                first = np.maximum.accumulate(np.where(again == 0, np.arange(len(order)), 0))
                again[(d == d[first]) & (t == t[first]) & (start == start[first])] = 0
                yield pa.record_batch({"gram": gram, "region": region, "doc": d, "tie": t, "at": start.astype(np.int64) << 16 | r.count[order], "kind": again})

    return keyed.select("doc", "tie", "text").mapInArrow(released(find), "gram bigint, region bigint, doc bigint, tie bigint, at bigint, kind short")


def _unpacked(rows: DataFrame) -> DataFrame:
    """doc, tie, start, count, kind, gram of candidate rows."""
    return rows.select(*_KEY, F.shiftright("at", 16).cast("int").alias("start"), F.col("at").bitwiseAND(F.lit(65535)).cast("short").alias("count"), "kind", "gram")


def _classes(rows: DataFrame) -> DataFrame:
    """Rows sorted by gram, region, doc, tie, at to doc, tie, start, count, kind, gram: kind 1 for repeats, 2 for the first
    of a class whose anchor has several classes."""
    names = ["doc", "tie", "start", "count", "kind", "gram"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: np.ndarray | None = None  # the last row
        held: np.ndarray | None = None  # the only class's first row of the last anchor so far
        first: np.ndarray | None = None  # the last class's first row
        for batch in batches:
            c = [batch.column(k).to_numpy() for k in range(5)]
            c = np.stack([*c[:4], c[4] >> 16, c[4] & 65535], axis=1)  # gram region doc tie start count
            if not len(c):
                continue
            before = np.concatenate([[last], c[:-1]]) if last is not None else np.concatenate([[c[0] - 1], c[:-1]])
            new_gram = c[:, 0] != before[:, 0]
            new_class = new_gram | (c[:, 1] != before[:, 1])
            at = np.flatnonzero(new_class)
            # first row of each row's class; -1 stands for the one carried over
            of = np.maximum.accumulate(np.where(new_class, np.arange(len(c)), -1))
            firsts = np.where((of >= 0)[:, None], c[np.maximum(of, 0)], first if first is not None else c[0])
            repeat = ~new_class & (c[:, 2:5] != firsts[:, 2:5]).any(axis=1)
            # classes in a row with one anchor
            heads, joined = c[at], ~new_gram[at]
            also = np.concatenate([joined[1:], [False]]) | joined
            out = [np.concatenate([c[repeat][:, 2:6], np.full((repeat.sum(), 1), 1), c[repeat][:, :1]], axis=1)]
            if len(at):
                if joined[0] and held is not None:
                    out.append(np.concatenate([held[2:6], [2], held[:1]])[None, :])
                out.append(np.concatenate([heads[also][:, 2:6], np.full((also.sum(), 1), 2), heads[also][:, :1]], axis=1))
                held = None if also[-1] else heads[-1]
                first = heads[-1]
            last = c[-1]
            found = np.concatenate(out)
            yield pa.record_batch([pa.array(found[:, k].astype(t)) for k, t in enumerate((np.int64, np.int64, np.int32, np.int16, np.int16, np.int64))], names=names)

    return rows.select("gram", "region", "doc", "tie", "at").mapInArrow(released(scan), "doc bigint, tie bigint, start int, count short, kind short, gram bigint")


def _packed(rows: DataFrame) -> DataFrame:
    """One row per document: its runs, as one array of structs."""
    return rows.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "count", "kind", "gram")).alias("runs"))


def _read(column, k: int) -> np.ndarray:
    """The k-th row's runs of an Arrow column of lists of structs, ordered by start."""
    runs = column[k].values
    if runs is None or not len(runs):
        return np.zeros(0, _RUN)
    out = np.zeros(len(runs), _RUN)
    for j, name in enumerate(("start", "count", "kind", "gram")):
        out[name] = runs.field(j).to_numpy(zero_copy_only=False)
    return out[np.argsort(out["start"], kind="stable")]


def _strings(docs: DataFrame, span: int) -> DataFrame:
    """Documents with runs: the bytes covered by each side's windows of the runs of kind 2, keyed by the longer gram."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts: list[bytes] = []
            doc, tie = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, text in enumerate(column_bytes(batch.column(2))):
                runs = _read(batch.column(4), k)
                for start, count in runs[runs["kind"] == 2][["start", "count"]].tolist():
                    rows.append((doc[k], tie[k], start))
                    texts.append(text[start : start + count + span - 1])
            out: list[tuple] = []
            for a, b in text_blocks(texts):
                for k, first, n, key, place in zip(*(x.tolist() for x in sides(texts[a:b], span)), strict=True):
                    d, t, start = rows[a + k]
                    out.append((key, d, t, start + first, n, place, texts[a + k][first : first + n + span - 1]))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 7, types, strict=True)], names=["key", *_KEY, "start", "count", "place", "bytes"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.binary()]
    # extra isn't read; with it the rows are those of the last join, which then reuses their shuffle
    return docs.select("doc", "tie", "text", "extra", "runs").mapInArrow(released(cut), "key bigint, doc bigint, tie bigint, start int, count short, place short, bytes binary")


def with_grams_numbered(data: np.ndarray, bounds: np.ndarray, place: np.ndarray, gram: int) -> Strings:
    """Strings of bytes with the gram bytes at each one's place replaced by the digits of the gram's number."""
    starts = bounds[:-1] + place
    inside = starts[:, None] + np.arange(gram)
    number = pa.FixedSizeBinaryArray.from_buffers(pa.binary(gram), len(starts), [None, pa.py_buffer(np.ascontiguousarray(data[inside]))]).dictionary_encode().indices.to_numpy()
    symbols, keep = data.astype(np.uint16), np.ones(len(data), bool)
    keep[inside[:, DIGITS:]] = False
    for k in range(DIGITS):
        symbols[starts + k] = 256 + (number >> 7 * k & 127)
    return Strings(symbols[keep], bounds - (gram - DIGITS) * np.arange(len(bounds)))


def repeated_runs(strings: pa.Table, span: int) -> pa.RecordBatch:
    """Strings with whole groups of a key, sorted by key, doc, tie, start: runs of repeated windows."""
    key = strings.column("key").to_numpy()
    edge = np.concatenate([[True], key[1:] != key[:-1]])
    alone = edge & np.append(edge[1:], True)
    strings = strings.filter(pa.array(~alone)).combine_chunks()
    names, types = [*_KEY, "start", "count", "kind", "gram"], [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64()]
    if not strings.num_rows:
        return pa.record_batch([pa.array([], t) for t in types], names=names)
    column = {c: strings.column(c).to_numpy().astype(np.int64) for c in (*_KEY, "start", "count", "place")}
    raw = strings.column("bytes").cast(pa.large_binary()).combine_chunks()
    raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
    bounds = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, 8 * raw.offset)
    data = np.frombuffer(raw.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    gram, counts = longer_gram(span), column["count"]
    repeated = repeated_windows(with_grams_numbered(data, bounds - bounds[0], column["place"], gram), counts, span - gram + DIGITS)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    edge = np.zeros(len(repeated) + 1, bool)
    edge[bounds] = True
    here, before = np.append(repeated, False), np.append(False, repeated)
    begins, ends = np.flatnonzero(here & (~before | edge)), np.flatnonzero(before & (~here | edge))
    owner = np.searchsorted(bounds, begins, side="right") - 1
    found = [column["doc"][owner], column["tie"][owner], column["start"][owner] + begins - bounds[owner], ends - begins, np.ones(len(owner)), np.zeros(len(owner))]
    return pa.record_batch([pa.array(c).cast(t) if c.dtype.kind == "i" else pa.array(c.astype(np.int64)).cast(t) for c, t in zip(found, types, strict=True)], names=names)


def _repeats(strings: DataFrame, span: int) -> DataFrame:
    """Strings dealt by key and sorted by key, doc, tie, start: runs of repeated windows. A string alone with its key has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = closed = 0  # rows held, and how many of them are whole groups
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            changes = np.flatnonzero(key[1:] != key[:-1]) + 1
            if len(changes) or last not in (None, key[0]):
                closed = n + (int(changes[-1]) if len(changes) else 0)
            held.append(batch)
            n, last = n + batch.num_rows, key[-1]
            if closed >= COLLECTION:
                table = pa.Table.from_batches(held)
                yield repeated_runs(table.slice(0, closed), span)
                # copied, or the rest would keep the whole batch
                held, n, closed = table.slice(closed).take(pa.array(range(n - closed), pa.int64())).to_batches(), n - closed, 0
        if held:
            yield repeated_runs(pa.Table.from_batches(held), span)

    return strings.mapInArrow(released(run), "doc bigint, tie bigint, start int, count short, kind short, gram bigint")


def _removed(docs: DataFrame, span: int) -> DataFrame:
    """doc, extra, text, runs, more: the documents with their repeated runs cut out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, text in enumerate(column_bytes(batch.column(2))):
                runs = np.concatenate([_read(batch.column(3), k), _read(batch.column(4), k)])
                runs = np.sort(runs[runs["kind"] == 1], order="start")
                if not len(runs):
                    out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text.decode()))
                    continue
                start = runs["start"].astype(np.int64)
                reach = np.maximum.accumulate(start + runs["count"] + span - 1)
                first = np.concatenate([[True], start[1:] > reach[:-1]])
                begin, end = start[first], reach[np.concatenate([first[1:], [True]])]
                kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True))
                out.append((len(text), int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 5, types, strict=True))], names=["doc", "extra", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    docs = docs.select("doc", "extra", "text", "runs", "more")
    schema = docs.select("doc", "extra").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept_text", "string")
    return docs.mapInArrow(released(cut), schema)


def remove_repeats(docs: DataFrame, span: int = SPAN, keep: list[str] | None = None) -> DataFrame:
    """docs(doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, and the columns to keep as they are."""
    small_batches(docs.sparkSession)
    parts = task_count(docs.sparkSession, docs)
    keyed = _keyed(docs)
    rows = candidate_runs(keyed, span)
    # repeats within a batch are known and go straight to their documents
    once = rows.filter("kind = 0").drop("kind").repartition(parts, "gram").sortWithinPartitions("gram", "region", *_KEY, "at")
    # the candidates are the most that is ever shuffled here; they are gone before the texts are
    runs = durable(_packed(_unpacked(rows.filter("kind = 1")).unionByName(_classes(once))), clear=True)
    keep = keep or []
    extra = F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.lit(None).cast("int").alias("none"))
    whole = _keyed(docs, extra.alias("extra"))
    strings = _strings(whole.join(runs.filter(F.exists("runs", lambda r: r["kind"] == 2)), _KEY), span)
    strings = strings.repartition(parts, "key").sortWithinPartitions("key", *_KEY, "start")
    more = _packed(_repeats(strings, span)).withColumnRenamed("runs", "more")
    out = _removed(whole.join(runs, _KEY, "left").join(more, _KEY, "left"), span)
    out = out.select(F.when(F.col("doc") != _NULL, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "extra")
    return out.select(*out.columns[:-1], *(F.col(f"extra.c{k}").alias(c) for k, c in enumerate(keep)))
