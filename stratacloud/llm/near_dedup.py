"""MinHash near-duplicate detection that loses no link: universal hash minima, bands, signature check, exact check, components.

1. Each text's distinct word shingles are hashed; N_HASHES multiply-shift functions give its minima (16 bits each kept).
   Texts with equal sets are one node (the least doc_id) from here on.
2. Bands of ROWS minima deal nodes to buckets. A pair at the similarity asked for misses all bands with probability
   (1 - 0.8 ** ROWS) ** (N_HASHES / ROWS), below 1e-7.
3. Stars: each node is paired with its buckets' least node; pairs whose signatures agree enough (LEAST_AGREEMENT is more
   than five standard deviations below 0.8) are checked on full sets. Components are found over these links. This is
   linear in the group's size, however large the group.
4. Rest: buckets that still hold several components are looked at once more, pair by pair inside a task, skipping pairs of
   one component and pairs that share an earlier band; a bucket of more than BLOCK nodes or BLOCK_BYTES of texts is cut into
   blocks and each pair of blocks is a group of its own. Only links that join two components leave the task. Their components
   are the result.
Keys that very many rows share (copies of one text, a bucket, a hub of links) are salted, see common.salted_join. Each step ends in
a checkpoint, after which its shuffle files go at once: dozens of steps would else pile up until the driver collects its garbage.

Null or empty text, or one without words: an empty set, linked with nothing. Fewer words than a shingle: the whole sequence
is one shingle. A null doc_id takes no part: component null, kept. Rows that repeat a doc_id are one node with the links of
each. An empty table gives an empty result. Other columns are not read. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, cleared, column_bytes, durable, released, salted_join, small_batches, task_count, text_blocks
from .components import connected_components
from .shingles import intersections, set_sums, shingle_sets

N_HASHES, ROWS = 128, 4
BANDS = N_HASHES // ROWS
LEAST_AGREEMENT = 0.6
#: Nodes of a block and about the bytes of their texts, and ids up to which a list of them is broadcast.
BLOCK, BLOCK_BYTES, BROADCAST_IDS = 4096, 16 << 20, 1_000_000
#: Bytes of shingle sets that one task keeps for a block.
KEPT_BYTES = 64 << 20
_rng = np.random.default_rng(2024)
_factors = _rng.integers(0, 1 << 63, N_HASHES, dtype=np.uint64) * U64(2) + U64(1)
_terms = _rng.integers(0, 1 << 63, N_HASHES, dtype=np.uint64)


def minima(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(len(bounds) - 1, N_HASHES) uint16; all zero for an empty set."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, N_HASHES), np.uint16)
    if len(full):
        for k in range(N_HASHES):
            hashed = ((sets * _factors[k] + _terms[k]) >> U64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(hashed, bounds[full])
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_bytes, n_shingles, s1, s2 (sums that equal sets share), signature."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(1))
            for a, b in text_blocks(texts):
                sets, bounds = shingle_sets(texts[a:b], width)
                sums = set_sums(sets, bounds)
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(a, b - a), "n_bytes": pa.array([len(t) for t in texts[a:b]], pa.int64()), "n_shingles": pa.array(np.diff(bounds)), "s1": pa.array(sums[:, 0]), "s2": pa.array(sums[:, 1]),
                    "signature": pa.array([x.tobytes() for x in minima(sets, bounds)], pa.binary()),
                })

    return docs.select("doc_id", "text").mapInArrow(released(sketch), "doc_id bigint, n_bytes bigint, n_shingles bigint, s1 bigint, s2 bigint, signature binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """node, band, key: the band's minima as they are."""
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.substring("signature", 2 * ROWS * b + 1, 2 * ROWS).alias("key")) for b in range(BANDS))))
    return nodes.select("node", each.alias("b")).select("node", "b.band", "b.key")


def _with(ids: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Rows of table whose key is among ids(on): by broadcast while the list is small."""
    ids = durable(ids.select(on).distinct(), clear=True)
    with cleared(ids.sparkSession):
        n = ids.count()
    return table.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, on)


def _agree(pairs: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in LEAST_AGREEMENT of the hashes."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, N_HASHES) for c in (batch.column(2), batch.column(3)))
            yield batch.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= LEAST_AGREEMENT))

    return pairs.select("u", "v", "su", "sv").mapInArrow(released(check), "u bigint, v bigint")


def _linked(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs(u, v, tu, tv) whose sets meet the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = column_bytes(batch.column(2)), column_bytes(batch.column(3))
            for i, j in text_blocks([x + y for x, y in zip(a, b, strict=True)]):
                x, y, both = intersections(a[i:j], b[i:j], width)
                ok = (100 * both >= percent * (x + y - both)) & (both > 0)
                yield batch.slice(i, j - i).select([0, 1]).filter(pa.array(ok))

    return pairs.select("u", "v", "tu", "tv").mapInArrow(released(check), "u bigint, v bigint")


def _pairwise(members: DataFrame, width: int, percent: int) -> DataFrame:
    """members(band, key, i, j, block, node, component, signature, text), dealt and sorted by (band, key, i, j): links between
    components, a spanning set for each group."""

    def links(group: list[tuple]) -> list[tuple[int, int]]:
        band, i, j = group[0][0], group[0][2], group[0][3]
        if len({r[6] for r in group}) < 2:
            return []
        signatures = np.frombuffer(b"".join(r[7] for r in group), np.uint16).reshape(-1, N_HASHES)
        bands = signatures.view(np.uint64)
        component, block = np.array([r[6] for r in group]), np.array([r[4] for r in group])
        sets: dict[int, np.ndarray] = {}
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        def shingles(k: int) -> np.ndarray:
            if k not in sets:
                if len(sets) % 64 == 63 and sum(x.nbytes for x in sets.values()) > KEPT_BYTES:
                    sets.clear()
                sets[k] = shingle_sets([group[k][8] or b""], width)[0]
            return sets[k]

        found = []
        for k in range(len(group) - 1):
            if block[k] == j != i:
                continue
            rest = np.arange(k + 1, len(group)) if i == j else np.flatnonzero(block == j)
            rest = rest[component[rest] != component[k]]
            rest = rest[(signatures[rest] == signatures[k]).mean(axis=1) >= LEAST_AGREEMENT]
            rest = rest[(bands[rest] == bands[k]).argmax(axis=1) == band]
            for m in rest:
                a, b = top(int(component[k])), top(int(component[m]))
                if a == b:
                    continue
                x, y = shingles(k), shingles(int(m))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    root[max(a, b)] = min(a, b)
                    found.append((int(component[k]), int(component[m])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns[:8]), column_bytes(batch.column(8)), strict=True):
                if group and row[:4] != group[0][:4]:
                    out += links(group)
                    group = []
                group.append(row)
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["u", "v"])
        out = links(group) if group else []
        yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["u", "v"])

    return members.select("band", "key", "i", "j", "block", "node", "component", "signature", "text").mapInArrow(released(run), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs(doc_id, text): doc_id, n_shingles, component_id, kept. Texts are linked whose sets' intersection is at least
    percent / 100 of their union."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    found = durable(sketches(docs, width), clear=True)
    key = ["s1", "s2", "n_shingles"]
    sets = found.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("node"), F.max("n_bytes").alias("n_bytes"), F.first("signature").alias("signature"), F.count("*").alias("n"))
    sets = durable(sets, clear=True)
    nodes = sets.select("node", "signature", "n_bytes")
    texts = docs.withColumnRenamed("doc_id", "node")

    # stars
    buckets = durable(_bands(nodes).groupBy("band", "key").agg(F.min("node").alias("v"), F.count("*").alias("n")).filter("n > 1"), clear=True)
    pairs = durable(salted_join(_bands(nodes), buckets.drop("n"), ["band", "key"], buckets, ["node"]).filter("node <> v").select(F.col("node").alias("u"), "v").distinct(), clear=True)
    hubs = lambda links: links.groupBy("v").agg(F.count("*").alias("n"))
    u, v = nodes.select(F.col("node").alias("u"), F.col("signature").alias("su")), nodes.select(F.col("node").alias("v"), F.col("signature").alias("sv"))
    pairs = durable(_agree(salted_join(pairs.join(u, "u"), v, ["v"], hubs(pairs), ["u"])).distinct(), clear=True)
    involved = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))
    some = _with(involved, texts, "node")
    tu, tv = some.select(F.col("node").alias("u"), F.col("text").alias("tu")), some.select(F.col("node").alias("v"), F.col("text").alias("tv"))
    first = connected_components(_linked(salted_join(pairs.join(tu, "u"), tv, ["v"], hubs(pairs), ["u"]), width, percent))

    # buckets with several components, equal ones once
    labelled = durable(nodes.join(first, "node", "left").select("node", "signature", "n_bytes", F.coalesce("component", "node").alias("component")), clear=True)
    member = _bands(labelled)
    mixed = member.join(labelled.select("node", "component", "n_bytes"), "node").groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum("n_bytes").alias("size"), F.min("component").alias("least"), F.max("component").alias("most"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.ceil(F.col("size") / BLOCK_BYTES), F.col("n"))).cast("int")
    mixed = mixed.filter("least <> most").withColumn("blocks", blocks).groupBy("n", "s", "x").agg(F.min(F.struct("band", "key", "blocks")).alias("b")).select("b.band", "b.key", "b.blocks", "n")
    mixed = durable(mixed, clear=True)
    rest = durable(salted_join(member, mixed.drop("n"), ["band", "key"], mixed, ["node"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")), clear=True)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rest.select("band", "key", "node", "block", other).select("band", "key", "node", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    dealt = dealt.join(labelled.drop("n_bytes"), "node").join(_with(rest, texts, "node"), "node")
    group = ["band", "key", "i", "j"]
    dealt = dealt.repartition(task_count(spark, docs), *group).sortWithinPartitions(*group)
    second = connected_components(_pairwise(dealt, width, percent)).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    # a node that rows with other texts share has several labels, which are one component
    final = labelled.select("node", "component").join(second, "component", "left").select("node", F.coalesce("joined", "component").alias("component")).groupBy("node").agg(F.min("component").alias("component"))

    answers = sets.select(*key, "node").join(final, "node")
    out = salted_join(found.select("doc_id", *key), answers, key, sets.select(*key, "n"), ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
