"""I-Match fingerprints with randomised lexicons, in DataFrame expressions only.

A term is a lower-cased run of letters and digits, numbered by a 64-bit hash. The lexicon holds the terms whose inverse document
frequency, over all rows, lies in a band. A document keeps its terms within the lexicon (all its terms, if none is), sorts the
distinct ones and hashes the whole list and what is left of it in each of the fixed sub-lexicons. Sub-lexicon (f, d) holds a
random share 2^-d of the lexicon: the terms that have d chosen values in d bits of their number from bit BITS * f on; DEPTHS
of each of FAMILIES families, nested within a family. Small shares are those that long documents still agree in after an edit.
Equal texts have equal fingerprints. Likeness of two fingerprints is 1 if the whole lists agree; else the share of sub-lexicons
whose hashes agree, among those in which either document has a term (0 where there is none).

The band's rarest terms occur in 1 of 2000 documents, so that the lexicon has at most 2000 times as many terms as a document has
distinct ones on average, however large the corpus. A lexicon of up to LEXICON_TERMS goes along with the tasks as hash tables, the
value of a scalar subquery; a larger one is joined by a shuffle of (row, term).

Null text: as empty. Text without terms: the whole list's hash is that of the text, all others are missing. Repeated
rows: each has its row; rows with one doc_id follow each other by text. A null doc_id sorts first. An empty table gives an
empty result. Other columns are not read. Texts are hashed whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, range_bounds, range_of, task_count

#: Terms in at least 1 of 2000 and at most 1 of 5 documents.
IDF_BAND = (math.log(5), math.log(2000))
#: Families of sub-lexicons, bits between the first bits of two, and their shares as powers of 1/2.
FAMILIES, BITS, DEPTHS = 8, 8, (2, 4, 6, 8, 10)
#: Terms of a lexicon that goes along with the tasks (less than 100 MB); its hash tables, and the bits between their slots' first.
LEXICON_TERMS, LEVELS, SHIFT = 1_000_000, 4, 13
#: The chosen values of all bits.
SEED = 0x5DEECE66D1B54A32
#: Documents to a range of doc_id.
RANGE_DOCS = 1024
_FIRST = -(1 << 63)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def terms(text: Column) -> Column:
    """Distinct term numbers."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    # only the first and the last can be empty
    return F.array_remove(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """The band's terms; document frequencies are over all rows."""
    n = docs.count()
    low, high = n * math.exp(-band[1]), n * math.exp(-band[0])
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return durable(df.filter((F.col("df") >= low) & (F.col("df") <= high)).select("term"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def fingerprint(own: Column, kept: Column, text: Column) -> Column:
    """The hashes of a document with the terms own, of which those of kept are in the lexicon: of the whole list, then of what each
    sub-lexicon leaves of it (null if nothing)."""

    def family(left: Column, f: int, depths: tuple[int, ...], found: list[Column]) -> Column:
        if not depths:
            return F.array(*found)
        mask = _signed(sum(1 << (BITS * f + k) % 64 for k in range(depths[0])))
        fits = F.filter(left, lambda t: t.bitwiseAND(F.lit(mask)) == F.lit(_signed(mask & SEED)))
        return _let(fits, lambda x: family(x, f, depths[1:], [*found, F.when(F.size(x) > 0, F.shiftrightunsigned(F.xxhash64(x), 32))]))

    def hashes(listed: Column) -> Column:
        whole = F.array(F.when(F.size(listed) > 0, F.xxhash64(listed)).otherwise(F.xxhash64(text)))
        return F.concat(whole, *(family(listed, f, DEPTHS, []) for f in range(FAMILIES)))

    return _let(F.array_sort(F.when(F.size(kept) > 0, kept).otherwise(own)), hashes)


def hash_tables(members: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Tables of powers of two slots, at least twice as many as terms: the slot of a term in table k is in its bits from SHIFT * k
    on. A slot that several terms share holds the least; the others go to the next table. What LEVELS tables do not hold."""
    tables = []
    rest = np.sort(members)
    for k in range(LEVELS):
        size = 1 << max(1, 2 * len(rest) - 1).bit_length()
        slots = (rest.view(np.uint64) >> np.uint64(SHIFT * k) & np.uint64(size - 1)).astype(np.int64)
        taken, first = np.unique(slots, return_index=True)
        table = np.full(size, None, object)
        table[taken] = rest[first]
        tables.append(table)
        rest = np.delete(rest, first)
    return tables, rest


class Lexicon:
    """A lexicon in the form that its size allows."""

    def __init__(self, found: DataFrame):
        self.found, self.n = found, found.count()
        if self.n <= LEXICON_TERMS:
            tables, rest = hash_tables(found.toArrow()["term"].to_numpy())
            self.masks = [len(t) - 1 for t in tables]
            values = {f"t{k}": t for k, t in enumerate(tables)} | {"rest": rest}
            row = pa.table({name: pa.ListArray.from_arrays([0, len(v)], pa.array(v, pa.int64())) for name, v in values.items()})
            # a subquery's value, which plans and their descriptions don't hold
            self.tables = found.sparkSession.createDataFrame(row).select(F.struct(*values)).scalar()

    def holds(self, tables: Column, term: Column) -> Column:
        out = F.array_contains(tables["rest"], term)
        for k, mask in reversed(list(enumerate(self.masks))):
            there = tables[f"t{k}"][F.shiftrightunsigned(term, SHIFT * k).bitwiseAND(F.lit(mask)).cast("int")]
            out = F.when(there.isNull(), F.lit(False)).when(there == term, F.lit(True)).otherwise(out)
        return out

    def fingerprinted(self, docs: DataFrame, text: str, name: str) -> DataFrame:
        """docs with the fingerprint of the column text as a column of that name."""
        own = terms(F.col(text))
        if self.n <= LEXICON_TERMS:
            kept = lambda tables: lambda own: fingerprint(own, F.filter(own, lambda t: self.holds(tables, t)), F.col(text))
            # used once, so that the optimiser puts the subquery in its place and rows never hold it
            return docs.withColumn("tables", self.tables).withColumn(name, _let(F.col("tables"), lambda t: _let(own, kept(t)))).drop("tables")
        rows = durable(docs.withColumn("row", F.monotonically_increasing_id()))
        kept = rows.select("row", F.explode(own).alias("term")).join(self.found, "term").groupBy("row").agg(F.collect_list("term").alias("kept"))
        rows = rows.join(kept, "row", "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<bigint>")))
        return rows.withColumn(name, fingerprint(own, F.col("kept"), F.col(text))).drop("row", "kept")


def shown(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ".", "-")


def likeness(a: Column, b: Column) -> Column:
    """1 if the whole lists' hashes agree, else the share of agreeing sub-lexicons among those that either document has terms in."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda x: x)) - 1
    return F.when(a[0] == b[0], 1.0).when(either > 0, same / either.cast("double")).otherwise(0.0)


def with_next(docs: DataFrame, payload: list[str]) -> DataFrame:
    """docs with column next, a struct of the payload of the row that follows by doc_id (the first, after the last).

    Rows are dealt to ranges of doc_id, several to a task; the first rows of each range are also sent to the range before it,
    so that every range finds its rows' followers by itself and rows move once.
    """
    docs = docs.withColumn("at", F.coalesce(F.col("doc_id"), F.lit(_FIRST)))
    _, bounds = range_bounds(docs.select("at"), "at", RANGE_DOCS)
    docs = docs.withColumn("range", range_of(F.col("at"), bounds))
    firsts = sorted(tuple(r) for r in docs.groupBy("range").agg(F.min("at")).collect())
    first, before = np.full(len(bounds) + 1, _FIRST), np.zeros(len(bounds) + 1, np.int32)
    for k, (here, least) in enumerate(firsts):
        first[here], before[here] = least, firsts[k - 1][0]
    is_first = F.col("at") == F.element_at(F.lit(first), F.col("range") + 1)
    docs = docs.withColumn("guest", F.explode(F.when(is_first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    docs = docs.withColumn("range", F.when(F.col("guest"), F.element_at(F.lit(before), F.col("range") + 1)).otherwise(F.col("range"))).repartition(task_count(docs.sparkSession, docs), "range")
    order = Window.partitionBy("range").orderBy("guest", "at", "text")
    return docs.withColumn("next", F.lead(F.struct(*payload)).over(order)).filter(~F.col("guest")).drop("at", "range", "guest")


def fingerprint_edits(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """docs(doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, where
    the edited text has its last floor(n_chars / 2) code points replaced by as many of the next document's first."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = Lexicon(lexicon(docs, band))
    both = with_next(known.fingerprinted(docs, "text", "own"), ["text", "own"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "own", F.concat(F.left(F.col("text"), n - half), F.left(F.col("next.text"), half)).alias("edited"), F.col("next.own").alias("next_own"))
    both = known.fingerprinted(both, "edited", "edited_own")
    return both.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), shown(F.col("own")).alias("fingerprint"),
        shown(F.col("edited_own")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited_own")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
