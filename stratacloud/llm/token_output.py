"""Token-id output: one zstandard-compressed record per document under a shared dictionary, with an offset index.

A shard is one binary image:
  magic "STTK", version u8, id width u8 (2 or 4 bytes), 2 zero bytes, number of documents u32, end id u32,
  sha256 of the dictionary (32 bytes), then the index (per document: doc_id i64, ids before it in the shard u64,
  byte offset of its record u64, 1 in u8 if doc_id is null; one last entry closes the ranges), then the records.
A record is a zstandard frame of the document's ids, little-endian. A single document is read by one index look-up
and one decompression.

The dictionary is trained on the serialised id arrays, whole, of about SAMPLE_DOCS documents and kept once; its size is an
eighth of the sample's, DICTIONARY_BYTES at most. A sample that the trainer refuses (a handful of documents) is itself the
dictionary, as raw content, so that every shard is written under one.

Shards are rows (part, seq, base, image) of a table, so that any store that Spark writes can hold them;
base is the number of ids in all shards before. Documents are in ascending doc_id order over shards and in them.

Null or empty text: only the end id. Rows with equal doc_id: each is written, ordered by number of ids and then by record.
Null doc_id sorts first; the index marks it. An empty table gives no shard. Texts are taken whole; a long one is tokenised
in cuts of about LONGEST code points. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, ensure_checkpoint_dir, range_bounds, range_of, small_batches, task_count, unit_hash

MAGIC, VERSION = b"STTK", 2
HEAD = struct.Struct("<4sBBHII32s")
INDEX = np.dtype([("doc_id", "<i8"), ("start", "<u8"), ("offset", "<u8"), ("null", "u1")])
#: A shard is closed at so many documents or bytes of records.
SHARD_DOCS, SHARD_BYTES = 4096, 8 << 20
#: The dictionary's training sample: about so many documents; and the dictionary's greatest size.
SAMPLE_DOCS, DICTIONARY_BYTES = 2000, 64 << 10
#: Shards up to which the table of their bases is broadcast: a few MB.
BROADCAST_SHARDS = 100_000
#: Chunks whose ids one Python worker keeps, and their bytes; and chunks that go through the library at once.
CACHE_CHUNKS, CACHE_BYTES, TOGETHER = 600_000, 16 << 20, 8192
#: Code points of a text that are tokenised together.
LONGEST = 1 << 20
#: A space between two characters that are no white space: a text may be cut before it.
CUT = re.compile(r"(?<=\S) (?=\S)")


class ByteTokenizer:
    """Ids as the tokenizers library gives them, from the distinct chunks of many texts.

    A chunk is what lies between two cuts (CUT); the library's pre-tokenizer never matches over one, so the ids of a text are
    those of its chunks one after the other. The chunks of a batch are numbered by an Arrow dictionary, and only those not
    seen lately go through the library, many in one call: each chunk's first token, and no other, starts with the space.
    A text whose spaces are not all cuts is cut one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = not any(t.lstrip or t.rstrip or " " in t.content for t in special)
        self.led = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.led[k] = token.startswith("\u0120")  # how byte-level vocabularies write a space
        self.chunks, self.bounds, self.ids = pa.array([], pa.string()), np.zeros(1, np.int64), np.zeros(0, self.dtype)
        self.uses = np.zeros(0, np.int32)  # batches that each chunk was in

    def _make_room(self) -> None:
        """Drop the chunks of fewest batches until half the cache is free."""
        least = 2
        while len(self.chunks) > CACHE_CHUNKS // 2 or self.chunks.nbytes + self.ids.nbytes > CACHE_BYTES // 2:
            keep = np.flatnonzero(self.uses >= least)
            counts = np.diff(self.bounds)[keep]
            ends = np.cumsum(counts)
            self.ids = self.ids[np.repeat(self.bounds[keep] - (ends - counts), counts) + np.arange(int(counts.sum()))]
            self.chunks, self.bounds, self.uses = self.chunks.take(pa.array(keep)), np.concatenate([[0], ends]), self.uses[keep]
            least *= 2
        self.uses //= 2

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: pa.Array) -> None:
        """Append clean chunks (each stands after a space) and their ids to the cache."""
        found, counts = [self.ids], []
        for k in range(0, len(chunks), TOGETHER):
            some = chunks.slice(k, TOGETHER).to_pylist()
            ids = np.array(self._library([" " + " ".join(some)])[0], self.dtype)
            starts = np.flatnonzero(self.led[ids])
            if len(starts) != len(some) or starts[0]:
                each = self._library([" " + x for x in some])
                ids, starts = np.array([i for x in each for i in x], self.dtype), np.cumsum([0, *map(len, each[:-1])])
            found.append(ids)
            counts.append(np.diff(np.append(starts, len(ids))))
        self.chunks = pa.concat_arrays([self.chunks, chunks])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(counts))]) if counts else self.bounds
        self.ids = np.concatenate(found)

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Where in the cache each of these chunks is."""
        if len(self.chunks) > CACHE_CHUNKS or self.chunks.nbytes + self.ids.nbytes > CACHE_BYTES:
            self._make_room()
        found = pc.index_in(distinct, value_set=self.chunks)
        new = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            # sorted, words that only differ by what follows them meet in the library's own cache
            some, order = np.flatnonzero(new), pc.sort_indices(distinct.filter(pa.array(new))).to_numpy()
            some = some[order]
            at[some] = len(self.chunks) + np.arange(len(some))
            self._learn(distinct.take(pa.array(some)))
            self.uses = np.concatenate([self.uses, np.zeros(len(some), np.int32)])
        self.uses[at] += 1
        return at

    def _by_cuts(self, text: str) -> np.ndarray:
        first, *rest = CUT.split(text) if self.cuts else [text]
        return np.array([i for x in self._library([first, *(" " + x for x in rest)]) for i in x], self.dtype)

    def _clean(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts, the bounds between them, and which texts have spaces that are no cuts (their ids are wrong)."""
        parts = pc.split_pattern(texts, " ")
        bounds, values = parts.offsets.to_numpy().astype(np.int64), parts.values
        if bounds[0]:
            values, bounds = values.slice(bounds[0]), bounds - bounds[0]
        keyed = values.dictionary_encode()
        distinct, which = keyed.dictionary, keyed.indices.to_numpy()
        bad = pc.or_(pc.equal(pc.utf8_length(distinct), 0), pc.not_equal(pc.utf8_trim_whitespace(distinct), distinct)).to_numpy(zero_copy_only=False)
        odd = np.zeros(len(texts), bool)
        if bad.any():
            # a text without any space is one chunk, whatever it is
            odd = (np.add.reduceat(bad[which].astype(np.int64), bounds[:-1]) > 0) & (np.diff(bounds) > 1)
        first = self._library(values.take(pa.array(bounds[:-1])).to_pylist())
        inner = np.ones(len(values), bool)
        inner[bounds[:-1]] = False
        used = np.zeros(len(distinct), bool)
        used[which[inner]] = True
        used &= ~bad
        place = np.zeros(len(distinct), np.int64)
        place[used] = self._places(distinct.filter(pa.array(used)))
        start, count = self.bounds[:-1], np.diff(self.bounds)
        inner &= used[which]
        lengths = np.zeros(len(values), np.int64)
        lengths[inner] = count[place[which[inner]]]
        lengths[bounds[:-1]] = [len(x) for x in first]
        ends = np.cumsum(lengths)
        out = np.empty(int(ends[-1]), self.dtype)
        n = lengths[inner]
        into = np.repeat(ends[inner] - n, n)
        step = np.arange(len(into)) - np.repeat(np.cumsum(n) - n, n)
        out[into + step] = self.ids[np.repeat(start[place[which[inner]]], n) + step]
        for k, x in zip((ends - lengths)[bounds[:-1]].tolist(), first, strict=True):
            out[k : k + len(x)] = x
        return out, np.concatenate([[0], ends])[bounds], odd

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, in an Arrow array of strings without nulls."""
        lengths = pc.utf8_length(texts).to_numpy()
        alone = lengths > LONGEST if self.cuts else np.ones(len(texts), bool)
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        some = np.flatnonzero(~alone & (lengths > 0))
        if len(some):
            ids, bounds, odd = self._clean(texts.take(pa.array(some)))
            for j, k in enumerate(some.tolist()):
                out[k] = self._by_cuts(texts[k].as_py()) if odd[j] else ids[bounds[j] : bounds[j + 1]]
        for k in np.flatnonzero(alone).tolist():
            out[k] = self._long(texts[k].as_py())
        return out

    def _long(self, text: str) -> np.ndarray:
        found, at = [], 0
        while self.cuts and (m := CUT.search(text, at + LONGEST)):
            found.append(self._by_cuts(text[at : m.start()]))
            at = m.start()
        # what comes after a cut starts with its space, which _by_cuts leaves in the first chunk
        return np.concatenate([*found, self._by_cuts(text[at:])])

    def serialise(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text and the end id, as little-endian integers; null as empty."""
        end = np.array([end_id], self.dtype).tobytes()
        return [x.tobytes() + end for x in self.encode(texts.cast(pa.string()).fill_null(""))]


_tokenizers: dict[str, ByteTokenizer] = {}


def byte_tokenizer(path: str) -> ByteTokenizer:
    """One for each Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = ByteTokenizer(path)
    return _tokenizers[path]


def train_dictionary(samples: list[bytes], least: bytes) -> bytes:
    """A zstandard dictionary from samples; where the trainer refuses them, they are its raw content themselves (least, where
    they are empty)."""
    import zstandard

    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(max(256, min(DICTIONARY_BYTES, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:] or least
        return raw * -(-8 // len(raw))  # a dictionary of fewer than 8 bytes is none


def sampled_ids(docs: DataFrame, n: int, path: str, end_id: int, seed: int = 11) -> list[bytes]:
    """The serialised ids of about SAMPLE_DOCS of the n documents, chosen by a hash of doc_id (all, where there are fewer)."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"ids": pa.array(byte_tokenizer(path).serialise(batch.column(0), end_id), pa.binary())})

    sample = docs.filter(unit_hash(F.col("doc_id"), seed) < SAMPLE_DOCS / max(1, n)).select("text")
    return sorted(bytes(r.ids) for r in sample.mapInArrow(ids, "ids binary").collect())


def pack_shard(records: list[tuple[int | None, int, bytes]], digest: bytes, width: int, end_id: int) -> bytes:
    """records: doc_id, number of ids, compressed ids."""
    index = np.zeros(len(records) + 1, INDEX)
    index["doc_id"][:-1] = [r[0] or 0 for r in records]
    index["null"][:-1] = [r[0] is None for r in records]
    index["start"][1:] = np.cumsum([r[1] for r in records])
    index["offset"][1:] = np.cumsum([len(r[2]) for r in records])
    return b"".join([HEAD.pack(MAGIC, VERSION, width, 0, len(records), end_id, digest), index.tobytes(), *(r[2] for r in records)])


class Shard:
    """Reads a shard image; single documents by position."""

    def __init__(self, image: bytes, dictionary: bytes):
        import zstandard

        magic, version, width, _, self.n, self.end_id, digest = HEAD.unpack_from(image)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        self.index = np.frombuffer(image, INDEX, self.n + 1, HEAD.size)
        self.records, self.dtype = memoryview(image)[HEAD.size + self.index.nbytes :], np.dtype(f"<u{width}")
        self.zstd = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, k: int) -> np.ndarray:
        a, b = int(self.index["offset"][k]), int(self.index["offset"][k + 1])
        return np.frombuffer(self.zstd.decompress(self.records[a:b]), self.dtype)


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, where: str | None = None) -> tuple[DataFrame, bytes]:
    """Tokenize docs(doc_id, text) and write the shard table to where (a new folder below the checkpoint folder by default).
    Returns the table as read back, with base, and the dictionary."""
    import zstandard

    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    where = where or f"{spark.sparkContext.getCheckpointDir()}/token-shards-{uuid.uuid4().hex}"
    docs = docs.select("doc_id", "text")
    n, bounds = range_bounds(docs, "doc_id", SHARD_DOCS)
    tokenizer = byte_tokenizer(tokenizer_path)
    dictionary = train_dictionary(sampled_ids(docs, n, tokenizer_path, end_id), np.array([end_id], tokenizer.dtype).tobytes())
    digest = hashlib.sha256(dictionary).digest()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = byte_tokenizer(tokenizer_path)
        z = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            ids = t.serialise(batch.column(1), end_id)
            yield pa.record_batch({
                "doc_id": batch.column(0), "n": pa.array([len(x) // t.dtype.itemsize for x in ids], pa.int64()),
                "record": pa.array(map(z.compress, ids), pa.binary()),
            })

    width = 4 if tokenizer.wide else 2

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, seq, size = [], None, 0, 0

        def shard():
            return pa.record_batch({"part": pa.array([at], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_ids": pa.array([sum(r[1] for r in held)], pa.int64()), "image": pa.array([pack_shard(held, digest, width, end_id)], pa.binary())})

        for batch in batches:
            for part, doc_id, n, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (part != at or len(held) >= SHARD_DOCS or size >= SHARD_BYTES):
                    yield shard()
                    held, seq, size = [], seq + 1 if part == at else 0, 0
                at = part
                held.append((doc_id, n, record))
                size += len(record)
        if held:
            yield shard()

    # ranges of doc_id with about equal numbers of documents, many to a task; a null doc_id sorts before all
    part = range_of(F.col("doc_id"), bounds)
    records = docs.mapInArrow(compress, "doc_id bigint, n bigint, record binary")
    records = records.select(part.cast("int").alias("part"), "doc_id", "n", "record").repartition(task_count(spark, docs), "part")
    shards = records.sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "n", "record").mapInArrow(assemble, "part int, seq int, n_ids bigint, image binary")
    shards.write.mode("overwrite").parquet(where)
    table = spark.read.parquet(where)
    # one row per part: small
    by_part = table.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    by_part = by_part.withColumn("part_base", F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sizes = table.select("part", "seq", "n_ids").withColumn("in_part", F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bases = durable(sizes.join(by_part, "part").select("part", "seq", (F.col("part_base") + F.col("in_part")).alias("base")))
    if bases.count() <= BROADCAST_SHARDS:
        bases = F.broadcast(bases)
    return table.join(bases, ["part", "seq"]), dictionary


def read_documents(shards: DataFrame, dictionary: bytes) -> DataFrame:
    """Per document, from the shard images: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its ids
    as little-endian unsigned 32-bit integers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(image, dictionary)
                starts = shard.index["start"].astype(np.int64) + base
                crc = [zlib.crc32(shard.ids(k).astype("<u4").tobytes()) for k in range(shard.n)]
                index = shard.index[:-1]
                yield pa.record_batch({
                    "doc_id": pa.array(index["doc_id"].copy(), mask=index["null"] == 1), "start": pa.array(starts[:-1]),
                    "n_tokens": pa.array(np.diff(starts)), "ids_crc32": pa.array(crc, pa.int64()),
                })

    return shards.select("base", "image").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
