"""SentencePiece encoding and decoding with offsets into the original bytes.

Normalisation walks the text by longest prefix through the model's compiled character map (a double-array trie and a
block of replacement strings), and records for every byte of the normalised text where in the original it comes from.
White space is escaped as U+2581 and a leading one is added if the model says so. Pieces cover the normalised text
without gaps, so each piece's original span follows from its two ends through that record.

Where no piece of the model holds U+2581 after another character, merges never cross the start of a run of U+2581; the
text is then cut there and the cuts' pieces are cached, which leaves the ids as they are. Other models, and models with
user-defined pieces, are encoded whole.

Null or empty text: no pieces but the end id; it decodes to the empty text. Repeated rows: each has its row. Texts are
taken whole at any length. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column_bytes, released, small_batches

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
#: Cached cuts in one Python worker, and the longest cut that is kept.
CACHE_CUTS, CACHE_LENGTH = 150_000, 48
OUTPUTS = ("ids", "begins", "ends", "decoded")
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6


class CharMap:
    """Longest-prefix replacement through a compiled map: u32 size of the trie, its u32 units, NUL-ended strings.

    A unit holds a label (low 8 bits), whether a value follows (bit 8), a scale (bit 9) and an offset (from bit 10);
    children stand at offset xor label.
    """

    def __init__(self, blob: bytes):
        self.units, self.strings = [], b""
        if blob:
            n = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", n // 4, 4).tolist()
            self.strings = blob[4 + n :]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit >> 6) & 8)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes of text that are replaced at this place, and by what."""
        if not self.units:
            return None
        found, node = None, self._child(self.units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(self.units) or (self.units[node] & 0x800000FF) != text[k]:
                break
            unit = self.units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.strings[start : self.strings.index(b"\0", start)]
        return found


class Normaliser:
    def __init__(self, spec, suffix: bool):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, suffix
        self.plain = not self.map.units and not self.squeeze and self.escape and not suffix

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its byte boundaries, the original's."""
        if self.plain:
            return self._plain(text)
        out, source, at = [], [], 0
        space = SPACE_BYTES if self.escape else b" "

        spaced = True  # a space of the text came last; U+2581 of the text itself is none

        def put(piece: bytes, start: int) -> None:
            out.append(piece)
            source.extend([start] * len(piece))

        while at < len(text):
            n, piece = self.map.longest(text, at) or (0, b"")
            if not n:
                lead = text[at]
                n = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                piece = text[at : at + n]
            # a replacement may hold spaces of its own
            for k, part in enumerate(piece.split(b" ")):
                if k and not (self.squeeze and spaced):
                    put(space, at)
                    spaced = True
                if part:
                    put(part, at)
                    spaced = False
            at += n
        while self.squeeze and out and out[-1] == space:
            del source[len(source) - len(out.pop()) :]
        ends = [*source, len(text)]
        if out and self.prefix:
            if self.suffix:
                out.append(space)
                ends = [*source, *[len(text)] * (len(space) + 1)]
            else:
                out.insert(0, space)
                ends = [ends[0]] * len(space) + ends
        return b"".join(out), np.array(ends, np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        lead = SPACE_BYTES if self.prefix else b""
        widths = np.where(np.frombuffer(text, np.uint8) == 32, len(SPACE_BYTES), 1)
        ends = np.concatenate([np.zeros(len(lead), np.int64), np.repeat(np.arange(len(text)), widths), [len(text)]])
        return lead + text.replace(b" ", SPACE_BYTES), ends


class PieceCoder:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.normalise = Normaliser(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        # bytes of normalised text that a piece covers; 0 where the text must say
        self.width = [1 if p.type == BYTE else 0 if p.type in (UNKNOWN, CONTROL) else len(p.piece.encode()) for p in model.pieces]
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        self.cuts = self.normalise.plain and self.normalise.prefix and not any(p.type == USER_DEFINED or p.type == NORMAL and inner.search(p.piece) for p in model.pieces) and any(p.type == BYTE for p in model.pieces) and max(self.width) < 256 and self.library.piece_to_id(SPACE) != self.library.unk_id()
        self.end_id = self.library.eos_id()
        self.cache: dict[str, tuple] = {}
        self.runs = re.compile(" *[^ ]+| +").findall

    def _known(self, cut: str) -> tuple[str, list[int], bytes]:
        ids = self.library.encode(cut) or [self.library.piece_to_id(SPACE)]
        out = " ".join(map(str, ids)), ids, bytes([self.width[i] for i in ids])
        if len(cut) <= CACHE_LENGTH:
            if len(self.cache) >= CACHE_CUTS:
                self.cache.clear()
            self.cache[cut] = out
        return out

    def encode(self, text: str) -> tuple[str, list[int], np.ndarray]:
        """Decimal ids joined by a space, the ids, and the bytes of normalised text under each; no end id."""
        if not text:
            return "", [], np.zeros(0, np.int64)
        if not self.cuts:
            pieces = self.library.encode(text, out_type="immutable_proto").pieces
            ids = [p.id for p in pieces]
            return " ".join(map(str, ids)), ids, np.array([self.width[p.id] or len(p.piece.encode()) for p in pieces], np.int64)
        # the model adds one space in front of what it is given, so each cut goes in without its first space
        text = text.replace(SPACE, " ")  # the same once normalised
        single = "  " not in text and text[0] != " " and text[-1] != " "
        cuts = text.split(" ") if single else [c[1:] for c in self.runs(" " + text)]
        get, known = self.cache.get, self._known
        found = [get(c) or known(c) for c in cuts]
        decimal, ids, widths = zip(*found, strict=True)
        widths = b"".join(widths)
        return " ".join(decimal), list(chain.from_iterable(ids)), np.frombuffer(widths, np.uint8).astype(np.int64)

    def spans(self, text: bytes, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one original byte of each piece."""
        normal, source = self.normalise(text)
        ends = np.cumsum(widths)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return source[ends - widths], source[ends]


_coders: dict[str, PieceCoder] = {}


def piece_coder(path: str) -> PieceCoder:
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def encode_pieces(docs: DataFrame, path: str, keep: tuple[str, ...] = OUTPUTS) -> DataFrame:
    """docs(doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32 (over first and last bytes of the
    pieces, as little-endian int32 pairs), and those of OUTPUTS to keep: ids (end id last), begins, ends, decoded."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                rows = []
                for raw in column_bytes(part.column(1)):
                    decimal, ids, widths = coder.encode(raw.decode())
                    begins, ends = coder.spans(raw, widths)
                    ids.append(coder.end_id)
                    decoded = coder.library.decode(ids)
                    spans = np.stack([begins, ends], axis=1).astype("<i4")
                    row = [len(ids), hashlib.sha256(f"{decimal} {coder.end_id}".lstrip().encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), zlib.crc32(spans.tobytes())]
                    outputs = {"ids": ids, "begins": begins, "ends": ends, "decoded": decoded}
                    rows.append([*row, *(outputs[c] if c == "decoded" else np.asarray(outputs[c], np.int32) for c in keep)])
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.record_batch([part.column(0), *columns], names=["doc_id", *(f.name for f in fields)])

    small_batches(docs.sparkSession)
    ints = pa.list_(pa.int32())
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string()), pa.field("spans_crc32", pa.int64())]
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"
    fields += [pa.field(c, pa.string() if c == "decoded" else ints) for c in keep]
    schema += "".join(f", {c} {'string' if c == 'decoded' else 'array<int>'}" for c in keep)
    return docs.select("doc_id", "text").mapInArrow(released(code), schema)
