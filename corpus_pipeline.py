"""Documents to token ids in five stages, each an operator of stratacloud.llm over all that the stage before kept.

Every stage is a function of (spark, docs, sf_dir); run() writes each stage's rows as Parquet in the shared checkpoint
folder and reads them again as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacloud.llm import langid, mixing, near_dedup, pieces, suffix_dedup
from stratacloud.llm.common import ensure_checkpoint_dir

#: A document stays if its language is known with this posterior.
LEAST_SCORE = 0.5
#: Ids of dropped documents up to which their list is broadcast.
BROADCAST_IDS = 1_000_000


#: Columns that the operators read; every other one travels in one struct, so that no name can clash with an operator's.
OWN, REST = ("doc_id", "text", "lang", "source"), "corpus_rest"


def _packed(docs: DataFrame) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in OWN]
    return docs.select(*OWN, F.struct(*rest, F.lit(0).alias(REST)).alias(REST))


def _unpacked(packed: DataFrame, columns: list[str], new: dict[str, Column]) -> DataFrame:
    """The columns as they were, but for the new ones among them."""
    return packed.select(*((new[c] if c in new else F.col(c) if c in OWN else F.col(REST)[c]).alias(c) for c in columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts, texts without a letter, and those whose language stays uncertain; the others are left as they are.

    Without any label every document's language is undetermined, and all go. A null doc_id is judged like any other. Repeated
    rows are judged alike. An empty table stays empty. Extra columns are kept, whatever their names."""
    packed = _packed(docs)
    langs, matrix = langid.train(packed)
    found = langid.predict(packed, langs, matrix, packed.columns)
    return _unpacked(found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)), docs.columns, {})


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near duplicates (five-word shingles, similarity 0.8).

    Documents without a word, and null doc_ids, are in no group and stay. Rows that repeat a doc_id are one document, which stays
    or goes with all of them. An empty table stays empty. Extra columns are kept, whatever their names."""
    drop = near_dedup.durable(near_dedup.near_duplicates(docs, width=5, percent=80).filter("NOT kept").select(F.col("doc_id").alias("dropped_id")).distinct())
    drop = F.broadcast(drop) if drop.count() <= BROADCAST_IDS else drop
    packed = _packed(docs)
    return _unpacked(packed.join(drop, F.col("doc_id") == F.col("dropped_id"), "left_anti"), docs.columns, {})


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out byte strings of 100 or more that an earlier document or place has; n_chars, if there, follows.

    Every document stays, also one that is cut to nothing. A null text becomes empty. A null doc_id is the first document. Rows
    that repeat doc_id and text are one document and are cut alike. An empty table stays empty. Extra columns are kept, whatever
    their names."""
    packed = _packed(docs)
    cut = suffix_dedup.remove_repeats(packed, span=100, keep=[c for c in packed.columns if c not in ("doc_id", "text")])
    return _unpacked(cut, docs.columns, {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")})


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: sources weigh 1, 2, 3 repeating, at most three times each; documents occur as often as they are taken.

    A null source is a source of its own, last in order. Documents without a word are not taken. Repeated rows are taken alike,
    each as often. An empty table stays empty. Extra columns are kept, whatever their names."""
    packed = _packed(docs)
    mixed = mixing.repeat_rows(mixing.mix_sources(packed, weight=F.col("ord") % 3 + 1, max_epochs=3.0), packed.columns)
    return _unpacked(mixed, docs.columns, {})


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, with digests of ids, spans and decoded text; no other column is returned.

    A null or empty text has the end id alone. A null doc_id stays null. Repeated rows have a row each. An empty table gives an
    empty result."""
    import public_tokenizers

    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("ids",))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]
#: SQL can't express the iterations and models; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    where = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
    return docs
