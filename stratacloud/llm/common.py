"""Helpers that the operators of this folder share: durable intermediate results, text blocks, vectorised string hashes."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that one vectorised step takes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Bytes and rows of an Arrow batch between an executor and its Python workers.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000
#: Keys that can be hot: those of more rows than one in so many, and than so many.
HOT, LEAST_HOT = 2000, 256
#: Bytes of input files to a task of an explicit exchange, and ranges of doc_id at most.
TASK_BYTES, MOST_RANGES = 128 << 20, 1 << 12


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the checkpoint folder the cluster names; set a local one only where none is set and the session is local, as in
    tests; on a cluster other machines would not see it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="stratacloud-checkpoint-"))


def small_batches(spark: SparkSession) -> None:
    """Let no Arrow batch hold more than BATCH_BYTES (or one row): executors and their Python workers hold several at once. This
    stays set in the session, since plans are run after the operator returns."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, BATCH_BYTES)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def released(f):
    """f for mapInArrow, after which the Python worker, which waits for other tasks, gives the memory it no longer uses back."""

    def run(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow as pa

        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run in here go as soon as it has run. A plan takes the setting when it is made, so that plans
    made elsewhere keep their files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def durable(df: DataFrame, clear: bool = False) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there: later steps don't recompute it, lost executors don't lose it.
    With clear, the shuffle files that this took go as soon as it is written, not when the driver next collects its garbage."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not clear:
        return df.checkpoint(eager=True)
    with cleared(spark):
        return df.select("*").checkpoint(eager=True)


def salted_join(many: DataFrame, one: DataFrame, on: list[str], sizes: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """many joined with one, whose keys are never null; sizes(on, n) says how many rows of many a key has. A key with more than a
    HOT share of those rows is taken apart: its rows of one are copied, and its rows of many are dealt to the copies by a hash of
    the columns by. At most HOT keys can be that hot, so that their list is broadcast."""
    with cleared(many.sparkSession):
        total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    limit = max(LEAST_HOT, (total or 0) // HOT)
    if (most or 0) <= limit:
        return many.join(one, on, how)
    hot = F.broadcast(durable(sizes.filter(F.col("n") > limit).select(*on, F.ceil(F.col("n") / limit).cast("int").alias("salts")), clear=True))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    one = one.join(hot, on, "left").withColumn("salt", copies).drop("salts")
    many = many.join(hot, on, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    return many.join(one, [*on, "salt"], how).drop("salt")


def task_count(spark: SparkSession, df: DataFrame | None = None) -> int:
    """Tasks for an explicit exchange: spark.sql.shuffle.partitions or the cores, and where the files behind df are known to be
    larger, one for each TASK_BYTES of them."""
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if df is not None else 0
    # a plan that doesn't know its size says a huge one
    return max(least, -(-size // TASK_BYTES)) if size < 1 << 60 else least


def range_bounds(docs: DataFrame, column: str, rows: int) -> tuple[int, np.ndarray]:
    """The number of rows, and ascending distinct values that cut a bigint column into ranges of about so many rows, at most
    MOST_RANGES of them; one pass over the column."""
    shares = ", ".join(f"{k / MOST_RANGES}D" for k in range(1, MOST_RANGES))
    n, found = docs.agg(F.count("*"), F.expr(f"percentile_approx({column}, array({shares}), {4 * MOST_RANGES})")).first()
    parts = min(MOST_RANGES, -(-n // rows))
    return n, np.array(sorted({found[k * MOST_RANGES // parts - 1] for k in range(1, parts)} if found else []), np.int64)


def range_of(column, bounds: np.ndarray):
    """Number of bounds at or below the value, by bisection; 0 for null."""
    if not len(bounds):
        return F.lit(0)
    table, steps = F.lit(bounds), [1 << k for k in reversed(range(len(bounds).bit_length()))]
    step = lambda at, n: F.when(F.try_element_at(table, at + n) <= column, at + n).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def unit_hash(column, seed: int):
    """A column in [0, 1) that depends on the value and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1 << 53)).cast("double") / float(1 << 53)


def text_blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts with about limit bytes each; every text is whole in one range."""
    a = size = 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > limit:
            yield a, b
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


def column_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads entropy over all 64 bits."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class SpanHasher:
    """64-bit polynomial hashes of any spans of a byte array, all at once, from one pass of prefix sums."""

    def __init__(self, seed: int, fold_case: bool = False):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        if fold_case:
            self.values[65:91] = self.values[97:123]
        self.base = (int(rng.integers(1 << 62)) * 8 + 5) % (1 << 64)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, U64)
        self.inverses = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        while len(self.powers) < n:
            k = len(self.powers)
            self.powers = np.concatenate([self.powers, self.powers * U64(pow(self.base, k, 1 << 64))])
            self.inverses = np.concatenate([self.inverses, self.inverses * U64(pow(self.inverse, k, 1 << 64))])

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverses[start])
