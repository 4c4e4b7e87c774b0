"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training takes about DOCS_PER_LANG whole labelled documents of each language, chosen by a hash of doc_id (all, where there
are fewer), counts n-grams on the executors, and gathers at most languages x BUCKETS counts. The log-probability matrix has
that fixed size and is broadcast. Scoring turns a block of texts into one row of n-gram buckets per document (a sparse
matrix in CSR form whose values are all one) and multiplies it by the matrix: one gather and one segmented sum for each
language. A prediction sees the text only.

Null text or one without a letter: und, score 0. A null doc_id is never held out and never learned from. Without any
label every text is und. Repeated rows: each is predicted; ties between languages go to the first in order. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, durable, released, small_batches, text_blocks, unit_hash

UNDETERMINED = "und"
BUCKETS_LOG2, ORDERS, SMOOTHING = 15, (1, 2, 3), 0.5
#: About so many documents of each language are learned from.
DOCS_PER_LANG = 4000
#: Bound of the broadcast matrix, and languages whose counts are gathered at once.
MATRIX_BYTES, TOGETHER = 1 << 30, 64
_word = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    m = _word.search(text)
    return bool(m) and (m[0].isalpha() or any(map(str.isalpha, text)))


def gram_buckets(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the bucket of the n-gram at each code point, lower-cased texts one after the other, each with one space
    around; and where each text starts. An n-gram that would leave its text has bucket 2 ** BUCKETS_LOG2."""
    low = [f" {t.decode().lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in low])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    out, hashed = [], np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        at = points[n - 1 :]
        hashed = (hashed[: len(at)] * np.uint32(0x01000193) + at + np.uint32(n)) * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        if n in ORDERS:
            bucket = np.full(len(points), 1 << BUCKETS_LOG2, np.int32)
            bucket[: len(at)] = (hashed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKETS_LOG2)
            for back in range(1, n):
                bucket[ends - back] = 1 << BUCKETS_LOG2
            out.append(bucket)
    return out, ends - [len(t) for t in low]


def is_held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Languages in order and their float32 matrix (languages, buckets + 2): log-probabilities, a zero column, priors."""
    small_batches(docs.sparkSession)
    learn = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    width = (1 << BUCKETS_LOG2) + 2
    most = MATRIX_BYTES // (4 * width)
    sizes = learn.groupBy("lang").count().limit(most + 1).collect()
    langs = sorted(r["lang"] for r in sizes)
    if len(langs) > most:
        raise ValueError(f"lang has more than {most} values, whose matrix would exceed {MATRIX_BYTES} bytes")
    if not langs:
        return [], np.zeros((0, width), np.float32)
    rate = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, docs_per_lang / r["count"]))))
    sample = learn.filter(unit_hash(F.col("doc_id"), seed) < rate[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: k for k, x in enumerate(langs)}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), column_bytes(batch.column(1))
            for lang in set(names):
                own = [t for t, n in zip(texts, names, strict=True) if n == lang]
                for a, b in text_blocks(own):
                    for bucket in gram_buckets(own[a:b])[0]:
                        k = place[lang]
                        sums[k] = sums.get(k, 0) + np.bincount(bucket, minlength=width - 1)
        for k, found in sums.items():
            at = np.flatnonzero(found[:-1])
            yield pa.record_batch({"k": pa.array(np.full(len(at), k, np.int32)), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(found[at].astype(np.int64))})

    counts = durable(sample.mapInArrow(released(count), "k int, bucket int, n bigint").groupBy("k", "bucket").agg(F.sum("n").alias("n")))
    docs_of = {r["lang"]: r["count"] for r in sizes}
    out = np.zeros((len(langs), width), np.float32)
    for first in range(0, len(langs), TOGETHER):
        some = langs[first : first + TOGETHER]
        found = counts.filter((F.col("k") >= first) & (F.col("k") < first + TOGETHER)).toPandas()
        table = np.full((len(some), 1 << BUCKETS_LOG2), SMOOTHING)
        np.add.at(table, (found["k"].to_numpy(np.int64) - first, found["bucket"].to_numpy(np.int64)), found["n"].to_numpy(np.float64))
        out[first : first + len(some), :-2] = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
        out[first : first + len(some), -1] = np.log([docs_of[x] for x in some]) - np.log(sum(docs_of.values()))
    return langs, out


def score_texts(texts: list[bytes], matrix: np.ndarray) -> np.ndarray:
    """Log joint probabilities (texts, languages)."""
    buckets, starts = gram_buckets(texts)
    out = np.tile(matrix[:, -1].astype(np.float64), (len(texts), 1))
    for k, row in enumerate(matrix):
        for bucket in buckets:
            out[:, k] += np.add.reduceat(row.take(bucket), starts, dtype=np.float64)
    return out


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray, keep: list[str]) -> DataFrame:
    """keep columns of docs, then lang_pred and score (the posterior of the predicted language)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))
    schema = docs.select(*keep).schema
    columns = [c for c in keep if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in batches:
            texts = column_bytes(batch.column(batch.num_columns - 1))
            pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            lettered = [k for k, t in enumerate(texts) if names and has_letter(t.decode())]
            for a, b in text_blocks([texts[k] for k in lettered]):
                at = np.array(lettered[a:b])
                joint = score_texts([texts[k] for k in at], table)
                top = joint.argmax(axis=1)
                score[at] = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
                for k, x in zip(at, top, strict=True):
                    pred[k] = names[x]
            kept = [batch.column(k) for k in range(len(columns))]
            if "text" in keep:
                kept.insert(keep.index("text"), batch.column(batch.num_columns - 1))
            yield pa.record_batch([*kept, pa.array(pred, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    schema = schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*columns, F.col("text")).mapInArrow(released(run), schema)


def identify(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """docs(doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    docs = docs.select("doc_id", "text", "lang")
    langs, matrix = train(docs, docs_per_lang)
    return predict(docs, langs, matrix, ["doc_id"]).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
