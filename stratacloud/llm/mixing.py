"""Mixing sources to target weights by capped water-filling.

Each source has a size (words over its documents) and a weight. Targets share the total size by weight; a target
stops at max_epochs times its source's size and the excess goes to the other sources by weight until none is above.
A source whose target is r times its size gives floor(r) whole repetitions of each document, and the fraction left
by one more repetition of the documents that come first in a seeded order, up to the document at which the sum is
nearest the target. Only (document, source, size, order) rows are grouped: texts never move.

Hot sources: sums are taken by (source, slice of the seeded order) with partial aggregation, and only the one slice
that holds a source's boundary is looked at document by document.

Null or empty text: size 0, nothing is taken. Null source: a source of its own, last in order. Repeated rows count as
often as they occur; rows equal in document id tie and are taken or left together, rows without an id are told apart by their
text. An empty table
gives an empty result. Columns of the input named like the results' are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

#: Places in the seeded order, and the slices of it by which a source's sizes are first summed.
PLACES_LOG2, SLICES_LOG2 = 40, 12
#: A plan of so many sources is broadcast; a longer one is joined by a shuffle.
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def place_of(seed: int) -> Column:
    """A row's place in the seeded order: by doc_id, or by text where that is null (which leaves the hash of others as it is)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << PLACES_LOG2))


def word_count(text: Column) -> Column:
    """Number of maximal runs of other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weight: Column, max_epochs: float) -> DataFrame:
    """Targets of sources(source, source_size): with the caps reached in order of cap over weight, the level of the others
    follows from running sums, so no iteration is needed. weight may use the column ord (0-based source order)."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("ord"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = sources.withColumn("ord", (F.row_number().over(ordered) - 1).cast("long"))
    s = s.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    s = s.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / weights)
    s = s.withColumn("open", F.col("cap") / F.col("weight") >= F.col("level"))
    s = s.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("ord"), "level"))).over(whole)["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.col("level")).alias("target"))


def mix_plan(sized: DataFrame, weight: Column, max_epochs: float) -> DataFrame:
    """For sized(source, size, place): source, source_size, target, whole (repetitions of each document) and upto, the
    last place that is taken once more (-1: none)."""
    to_slice = F.shiftright("place", PLACES_LOG2 - SLICES_LOG2)
    slices = sized.groupBy("source", to_slice.alias("slice")).agg(F.sum("size").alias("slice_size"))
    slices = slices.withColumn("source_size", F.sum("slice_size").over(Window.partitionBy("source")))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = durable(slices.withColumn("before", F.coalesce(F.sum("slice_size").over(running), F.lit(0))))
    plan = water_fill(slices.select("source", "source_size").distinct(), weight, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = durable(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rests = plan.select(F.col("source").alias("p_source"), "rest")
    at = slices.join(rests, same("source", "p_source"))
    at = at.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("slice_size")))
    at = at.select(F.col("p_source").alias("b_source"), F.col("slice").alias("b_slice"), "before", "rest")
    near = sized.filter("size > 0").join(at, same("source", "b_source") & (to_slice == F.col("b_slice")))
    near = near.groupBy("b_source", "before", "rest", "place").agg(F.sum("size").alias("size"))
    near = near.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(Window.partitionBy("b_source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last = near.filter(F.col("start") + F.col("size") / 2 <= F.col("rest")).groupBy("b_source").agg(F.max("place").alias("last")).withColumnRenamed("b_source", "l_source")
    ends = at.join(last, same("b_source", "l_source"), "left")
    ends = ends.select("b_source", F.coalesce("last", F.shiftleft("b_slice", PLACES_LOG2 - SLICES_LOG2) - 1).alias("upto"))
    return plan.join(ends, same("source", "b_source"), "left").select("source", "source_size", "target", "whole", F.coalesce("upto", F.lit(-1)).alias("upto"))


def mix_sources(docs: DataFrame, weight: Column, max_epochs: float = 3.0, seed: int = 7) -> DataFrame:
    """docs with added columns mix_size, mix_source_size, mix_target, mix_copies (times the document is taken)."""
    sized = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), word_count(F.col("text")).alias("size"),
        place_of(seed).alias("place"),
    )
    plan = durable(mix_plan(durable(sized.drop("doc_id")), weight, max_epochs).withColumnsRenamed({c: f"mix_{c}" for c in ("source", "source_size", "target", "whole", "upto")}))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    place = place_of(seed)
    out = docs.drop(*(c for c in docs.columns if c.startswith("mix_"))).withColumn("mix_size", word_count(F.col("text")))
    out = out.join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
    copies = F.when(F.col("mix_size") == 0, 0).otherwise(F.col("mix_whole") + (place <= F.col("mix_upto")).cast("long"))
    return out.withColumn("mix_copies", copies).drop("mix_source", "mix_whole", "mix_upto")


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixture itself: each row as many times as it is taken."""
    return mixed.filter("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*columns)
