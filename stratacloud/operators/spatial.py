"""Spatial joins as grid-keyed equi-joins: a range or nearest-neighbour condition never becomes a nested loop.

Clouds are DataFrames with pid, x, y, z. A cell key is a struct of integers; the probing side is spread to the neighbour
cells, the other side stays as it is, and the exact distance decides. A dense cell is a skewed key of a sort-merge join,
which adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from .durable import cut

#: Rows up to which polygon and wall tables are broadcast.
BROADCAST_ROWS = 100_000
#: Points of a block of a nearest-neighbour search, points that place the cuts between blocks, queries to a task of a block, and
#: pairs compared at once.
BLOCK_POINTS, CUT_POINTS, BLOCK_QUERIES, PAIRS = 1024, 200_000, 8192, 1_000_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast only if it is known to be small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def cell(size: float, *axes: str, prefix: str = "") -> list[Column]:
    return [F.floor(F.col(a) / F.lit(float(size))).cast("long").alias(f"{prefix}c_{a}") for a in axes]


def spread(df: DataFrame, size: float, axes: tuple[str, ...] = ("x", "y", "z"), reach: int = 1) -> DataFrame:
    """Each row once for every neighbour cell, as columns c_<axis>."""
    for a in axes:
        here = F.floor(F.col(a) / F.lit(float(size))).cast("long")
        df = df.withColumn(f"c_{a}", F.explode(F.sequence(here - reach, here + reach)))
    return df


def distance2(axes: tuple[str, ...]) -> Column:
    return sum(((F.col(f"q_{a}") - F.col(a)) * (F.col(f"q_{a}") - F.col(a)) for a in axes), F.lit(0.0))


def radius_pairs(queries: DataFrame, points: DataFrame, radius: float, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """qid, pid, d2 for all pairs within the radius, a point's pair with itself included."""
    q = spread(queries, radius, axes).select(F.col("pid").alias("qid"), *(F.col(a).alias(f"q_{a}") for a in axes), *(f"c_{a}" for a in axes))
    p = points.select("pid", *axes, *cell(radius, *axes))
    return q.join(p, [f"c_{a}" for a in axes]).withColumn("d2", distance2(axes)).filter(F.col("d2") <= radius * radius).select("qid", "pid", "d2")


def nearest(queries: DataFrame, points: DataFrame, k: int, size: float, axes: tuple[str, ...] = ("x", "y", "z"), same: bool = False) -> DataFrame:
    """qid, pid, d2, rank of each query's k nearest points, ties by pid; same drops the pair of a point with itself.

    Exact, in two rounds whatever the density: a query is compared with the points of its own block, which bounds its k-th
    distance, then with those of every other block whose points' bounds lie within it. Pairs are ranked inside tasks, so that at
    most k rows a query and block are shuffled. Of points at one place only the k + 1 of least pid can be among anyone's k
    nearest. Rows without a finite place take no part. size is a hint that blocks, which follow the density, do not need.
    """
    here = Window.partitionBy(*axes).orderBy("pid")
    points = points.filter(finite(axes)).select("pid", *axes).withColumn("nth", F.row_number().over(here)).filter(F.col("nth") <= k + 1)
    points = cut(points.drop("nth"), clear=True)
    blocks = Blocks(points, axes)
    points = points.withColumn("block", blocks.of(axes))
    bounds = points.groupBy("block").agg(*(f(a) for f in (F.min, F.max) for a in axes)).toPandas().to_numpy(float).reshape(-1, 1 + 2 * len(axes))
    asked = queries.filter(finite(axes)).select(F.col("pid").alias("qid"), *axes).withColumns({"block": blocks.of(axes), "most": F.lit(float("inf"))})
    first = cut(_ranked(asked, points, k, axes, same, bounds), clear=True)
    again = first.select("qid", *axes, F.explode("others").alias("block"), "most")
    found = first.unionByName(_ranked(again, points, k, axes, same)).select("qid", F.explode(F.arrays_zip("pids", "d2s")).alias("p"))
    found = found.select("qid", F.col("p.pids").alias("pid"), F.col("p.d2s").alias("d2"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("d2", "pid"))).filter(F.col("rank") <= k)


def finite(axes: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, (F.abs(F.col(a)) < float("inf") for a in axes))


class Blocks:
    """Space cut into boxes of about BLOCK_POINTS points, at medians of the widest axis. The cuts are placed by at most about
    CUT_POINTS of the points, which decide nothing but how even the boxes are: every point is in one."""

    def __init__(self, points: DataFrame, axes: tuple[str, ...]):
        n = points.count()
        some = points.filter(F.pmod(F.xxhash64("pid"), F.lit(1 + n // CUT_POINTS)) == 0).select(*axes).toPandas().to_numpy(float)
        depth = max(0, min(n // BLOCK_POINTS, len(some) // 8)).bit_length()
        self.axis, self.at = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        groups = [some]
        for level in range(depth):
            halves = []
            for k, group in enumerate(groups):
                if len(group):
                    axis = int(np.argmax(np.ptp(group, axis=0)))
                    self.axis[(1 << level) + k], self.at[(1 << level) + k] = axis, np.median(group[:, axis])
                left = group[:, self.axis[(1 << level) + k]] < self.at[(1 << level) + k]
                halves += [group[left], group[~left]]
            groups = halves
        self.depth = depth

    def of(self, axes: tuple[str, ...]) -> Column:
        """The number of a place's box."""
        axis, at, depth = self.axis, self.at, self.depth

        @F.pandas_udf("long")
        def block(*place: pd.Series) -> pd.Series:
            p = np.stack([c.to_numpy(float) for c in place])
            node, rows = np.ones(p.shape[1], np.int64), np.arange(p.shape[1])
            for _ in range(depth):
                node = 2 * node + (p[axis[node], rows] >= at[node])
            return pd.Series(node - (1 << depth))

        return block(*axes)


def _ranked(asked: DataFrame, points: DataFrame, k: int, axes: tuple[str, ...], same: bool, bounds: np.ndarray | None = None) -> DataFrame:
    """asked(qid, axes, block, most) with pids and d2s, the k nearest of the block's points with d2 up to most. With the blocks' bounds
    (block, least and greatest by axis), most is the k-th d2 (infinite, if there are fewer) and others are the other blocks that
    reach so far. A block that many ask is sent to several tasks."""
    counts = asked.groupBy("block").count().toPandas()
    parts = np.zeros(int(counts["block"].max()) + 1 if len(counts) else 0, np.int64)
    parts[counts["block"].to_numpy(np.int64)] = 1 + counts["count"].to_numpy(np.int64) // BLOCK_QUERIES

    @F.pandas_udf("long")
    def n_parts(block: pd.Series) -> pd.Series:
        b = block.to_numpy(np.int64)
        return pd.Series(np.where(b < len(parts), np.append(parts, 0)[np.minimum(b, len(parts))], 0))

    def rank(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("pid")
        pids, at, ids, place = p["pid"].to_numpy(), p[list(axes)].to_numpy(float), q["qid"].to_numpy(), q[list(axes)].to_numpy(float)
        most, step, n = q["most"].to_numpy(float).copy(), max(1, PAIRS // max(1, len(pids))), min(k, len(pids))
        found_pids, found_d2s, others = [], [], [np.zeros(0, np.int64)] * len(q)
        for start in range(0, len(q), step):
            rows = slice(start, start + step)
            d2 = np.zeros((len(ids[rows]), len(pids)))
            for a in range(len(axes)):
                d2 += np.square(place[rows, a][:, None] - at[:, a])
            if same:
                d2[ids[rows][:, None] == pids] = np.nan
            # the k-th, ties with it included: np.partition puts what is left out last
            kth = np.partition(d2, n - 1, axis=1)[:, n - 1] if n else np.full(len(d2), np.nan)
            kth = np.where(np.isnan(kth), np.inf, kth)
            row, col = np.nonzero(d2 <= np.minimum(kth, most[rows])[:, None])
            near = d2[row, col]
            order = np.lexsort((col, near, row))
            row, col, near = row[order], col[order], near[order]
            first = np.searchsorted(row, np.arange(len(d2) + 1))
            keep = np.arange(len(row)) - first[row] < k
            ends = np.cumsum(np.bincount(row[keep], minlength=len(d2)))[:-1]
            found_pids += np.split(pids[col[keep]], ends)
            found_d2s += np.split(near[keep], ends)
            if bounds is not None:
                have = np.bincount(row[keep], minlength=len(d2))
                most[rows] = np.where(have == k, kth, np.inf)
        if bounds is not None:
            m, block = len(axes), q["block"].iloc[0] if len(q) else -1
            low, high = bounds[:, 1 : 1 + m], bounds[:, 1 + m :]
            # a relative margin, so that rounding leaves no block out
            gap = lambda lo, hi: np.square(np.maximum(np.maximum(low - hi, lo - high), 0)).sum(axis=-1) * (1 - 1e-9)
            near = (gap(place.min(axis=0), place.max(axis=0)) <= most.max()) & (bounds[:, 0] != block) if len(q) else np.zeros(len(bounds), bool)
            bounds_near = bounds[near]
            low, high = bounds_near[:, 1 : 1 + m], bounds_near[:, 1 + m :]
            others = [bounds_near[gap(x, x) <= d, 0].astype(np.int64) for x, d in zip(place, most, strict=True)]
        return pd.DataFrame({"qid": ids, **{a: place[:, j] for j, a in enumerate(axes)}, "most": most, "pids": found_pids, "d2s": found_d2s, "others": others})

    asked = asked.withColumn("parts", n_parts("block")).withColumn("part", F.pmod(F.xxhash64("qid", F.lit(1)), F.col("parts"))).drop("parts")
    sent = points.withColumn("parts", n_parts("block")).filter("parts > 0").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    tasks = max(1, min(int(parts.sum()), int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    kind = {f.name: f.dataType.simpleString() for f in (asked.schema["qid"], points.schema["pid"])}
    schema = f"qid {kind['qid']}, {', '.join(f'{a} double' for a in axes)}, most double, pids array<{kind['pid']}>, d2s array<double>, others array<bigint>"
    asked, sent = (d.repartition(tasks, "block", "part").groupBy("block", "part") for d in (asked, sent))
    return asked.cogroup(sent).applyInPandas(rank, schema)


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, boundary: bool = True) -> DataFrame:
    """Rows of points with polygon_id, for polygons(polygon_id, ring). Polygons are spread over the cells of their bounds."""
    bound = lambda f, c: F.floor(f(F.transform("ring", lambda p: p[c])) / F.lit(float(size))).cast("long")
    p = polygons.select("polygon_id", "ring", *(F.explode(F.sequence(bound(F.array_min, "x"), bound(F.array_max, "x"))).alias("c_x"),))
    p = p.withColumn("c_y", F.explode(F.sequence(bound(F.array_min, "y"), bound(F.array_max, "y"))))
    joined = points.withColumns({"c_x": F.floor(F.col("x") / size).cast("long"), "c_y": F.floor(F.col("y") / size).cast("long")}).join(small(p), ["c_x", "c_y"])
    return joined.filter(G.in_polygon(F.col("x"), F.col("y"), F.col("ring"), boundary)).drop("c_x", "c_y", "ring")


def reclassify(points: DataFrame, polygons: DataFrame, size: float, code: int = 6) -> DataFrame:
    """classification becomes code for points covered by any polygon; column inside says so."""
    hit = points_in_polygons(points, polygons, size).select("pid").distinct().withColumn("inside", F.lit(True))
    out = points.join(hit, "pid", "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    return out.withColumn("classification", F.when(F.col("inside"), F.lit(code)).otherwise(F.col("classification")))
