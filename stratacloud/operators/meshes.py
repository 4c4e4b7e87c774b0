"""Meshes and surfaces: sampling, spacing, normals, region growing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spatial import nearest, radius_pairs


def triangle_area(a: str = "a", b: str = "b", c: str = "c"):
    u = {k: F.col(f"{b}.{k}") - F.col(f"{a}.{k}") for k in "xyz"}
    v = {k: F.col(f"{c}.{k}") - F.col(f"{a}.{k}") for k in "xyz"}
    cross = [u["y"] * v["z"] - u["z"] * v["y"], u["z"] * v["x"] - u["x"] * v["z"], u["x"] * v["y"] - u["y"] * v["x"]]
    return F.sqrt(sum((x * x for x in cross), F.lit(0.0))) / 2


def sample_counts(triangles: DataFrame, n: int) -> DataFrame:
    """triangles(fid, a, b, c): area and how many of n samples each gets, by rounding down running shares, so that they sum to n.
    Running sums are taken in slices of fid, then over the slices, so that no task sees all triangles."""
    t = triangles.withColumn("area", triangle_area()).withColumn("slice", F.floor(F.col("fid") / 4096))
    sums = t.groupBy("slice").agg(F.sum("area").alias("slice_area"))
    sums = sums.withColumns({"base": F.coalesce(F.sum("slice_area").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "total": F.sum("slice_area").over(Window.partitionBy())})
    w = Window.partitionBy("slice").orderBy("fid").rowsBetween(Window.unboundedPreceding, 0)
    t = t.join(sums.drop("slice_area"), "slice").withColumn("upto", F.col("base") + F.sum("area").over(w))
    share = lambda x: F.floor(x / F.col("total") * n + 1e-9)
    return t.withColumn("samples", (share(F.col("upto")) - share(F.col("upto") - F.col("area"))).cast("long")).drop("slice", "base", "total", "upto")


def sample_surface(triangles: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """fid, k, x, y, z: points spread over triangles by area; places follow from a hash of (seed, fid, k)."""
    s = sample_counts(triangles, n).filter("samples > 0").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("samples"))))
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "fid", "k"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    r = F.sqrt(unit(1))
    weights = {"a": 1 - r, "b": r * (1 - unit(2)), "c": r * unit(2)}
    return s.select("fid", "k", *(sum((w * F.col(f"{v}.{x}") for v, w in weights.items()), F.lit(0.0)).alias(x) for x in "xyz"))


def spacing(points: DataFrame, cell: float) -> DataFrame:
    """Median distance to the nearest other point, at least 1e-6."""
    near = nearest(points, points, 1, cell, same=True)
    return near.agg(F.greatest(F.median(F.sqrt("d2")), F.lit(1e-6)).alias("spacing"))


def auto_voxel(n: int, volume: float, spacing_: float, target: int = 100_000) -> float:
    return 2 * spacing_ if n <= target else max((volume / target) ** (1 / 3), 5 * spacing_)


def pivot_radii(spacing_: float) -> list[float]:
    return [spacing_ * m for m in (1.0, 1.5, 2.5, 4.0, 8.0)]


def normals(points: DataFrame, radius: float) -> DataFrame:
    """pid, nx, ny, nz: direction of least variance of each point's neighbourhood, upward or towards +x, +y; null below three
    neighbours. Covariances are sums over the radius join; the 3 x 3 problems are solved in batches."""
    pairs = radius_pairs(points, points, radius).join(points.select("pid", "x", "y", "z"), "pid")
    sums = pairs.groupBy(F.col("qid").alias("pid")).agg(F.count("*").alias("n"), *(F.covar_pop(a, b).alias(a + b) for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")))

    def solve(batches):
        for pdf in batches:
            m = pdf[["xx", "xy", "xz", "xy", "yy", "yz", "xz", "yz", "zz"]].to_numpy().reshape(-1, 3, 3)
            v = np.linalg.eigh(m)[1][:, :, 0] if len(m) else np.zeros((0, 3))
            lead = np.where(np.abs(v[:, 2]) > 1e-9, v[:, 2], np.where(np.abs(v[:, 1]) > 1e-9, v[:, 1], v[:, 0]))
            v = v * np.where(lead < 0, -1, 1)[:, None]
            v[(pdf["n"] < 3).to_numpy()] = np.nan
            yield pd.DataFrame({"pid": pdf["pid"], "nx": v[:, 0], "ny": v[:, 1], "nz": v[:, 2]})

    out = sums.mapInPandas(solve, "pid long, nx double, ny double, nz double")
    return out.select("pid", *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("nx", "ny", "nz")))


def grow_regions(faces: DataFrame, adjacency: DataFrame, angle: float = 5.0) -> DataFrame:
    """faces(mesh_id, fid, nx, ny, nz), adjacency(mesh_id, face_1, face_2): fid, region. A region takes the adjacent faces whose
    normal is within the angle of its seed's, in order of fid; it depends on the seed, so a mesh is one bounded group."""
    least = math.cos(math.radians(angle))

    def grow(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a = a.sort_values("fid")
        n = {r.fid: np.array([r.nx, r.ny, r.nz]) for r in a.itertuples()}
        near: dict = {f: [] for f in n}
        for r in b.itertuples():
            near[r.face_1].append(r.face_2)
            near[r.face_2].append(r.face_1)
        region: dict = {}
        for seed in n:
            if seed in region:
                continue
            region[seed], todo = seed, [seed]
            while todo:
                for f in near[todo.pop()]:
                    if f not in region and abs(n[f] @ n[seed]) >= least:
                        region[f] = seed
                        todo.append(f)
        return pd.DataFrame({"mesh_id": a["mesh_id"].iloc[0] if len(a) else None, "fid": list(region), "region": list(region.values())})

    return faces.groupBy("mesh_id").cogroup(adjacency.groupBy("mesh_id")).applyInPandas(grow, "mesh_id string, fid long, region long")


def mutual_nearest(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Pairs (pid_a, pid_b) that are each other's nearest."""
    ab = nearest(a, b, 1, cell).select(F.col("qid").alias("pid_a"), F.col("pid").alias("pid_b"))
    ba = nearest(b, a, 1, cell).select(F.col("qid").alias("pid_b"), F.col("pid").alias("pid_a"))
    return ab.join(ba, ["pid_a", "pid_b"])


def vote(scores: DataFrame, key: str, label: str, value: str) -> DataFrame:
    """Mean value per key and label, then the label of the greatest mean, the smallest of equals."""
    m = scores.groupBy(key, label).agg(F.avg(value).alias("mean"))
    return m.groupBy(key).agg(F.min_by(label, F.struct(-F.col("mean"), F.col(label))).alias(label), F.max("mean").alias("mean"))
