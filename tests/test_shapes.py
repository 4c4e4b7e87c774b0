"""Hulls, alpha shapes, registration, facade parts and panoramas against known shapes and plain versions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratacloud.operators import align, facades, hulls, panorama


def table(spark, p, **more):
    return spark.createDataFrame(pd.DataFrame({"pid": range(len(p)), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2], **more}))


def test_hulls():
    rng = np.random.default_rng(2)
    for p in (rng.normal(size=(300, 3)), np.array([(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)], float), np.repeat(rng.normal(size=(6, 3)), 3, axis=0)):
        f = hulls.hull_faces(p)
        n = hulls._normals(p, f)
        assert (((p[:, None] - p[f[:, 0]][None]) * n[None]).sum(axis=2) < 1e-9).all()
        volume = (np.cross(p[f[:, 1]], p[f[:, 2]]) * p[f[:, 0]]).sum() / 6
        assert volume > 0 and len(hulls.boundary(f)) == 0
    cube = np.array([(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    f = hulls.hull_faces(cube)
    assert abs((np.cross(cube[f[:, 1]], cube[f[:, 2]]) * cube[f[:, 0]]).sum() / 6 - 1) < 1e-12
    assert not len(hulls.hull_faces(np.column_stack([rng.normal(size=(20, 2)), np.zeros(20)]))) and not len(hulls.hull_faces(np.zeros((5, 3))))


def test_delaunay():
    rng = np.random.default_rng(3)
    q = rng.uniform(size=(120, 2))
    t = hulls.delaunay(q)
    a, b, c = (q[t[:, k]] for k in range(3))
    for i, j, k in zip(a, b, c):
        m = 2 * np.array([j - i, k - i])
        centre = np.linalg.solve(m, [j @ j - i @ i, k @ k - i @ i])
        assert (np.linalg.norm(q - centre, axis=1) >= np.linalg.norm(i - centre) - 1e-7).all()
    assert len(hulls.delaunay(np.array([(i, j) for i in range(6) for j in range(6)], float))) == 50
    assert len(hulls.delaunay(np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float))) == 2 and len(hulls.delaunay(np.array([(k, k) for k in range(5)], float))) == 0


def test_cluster_meshes(spark):
    rng = np.random.default_rng(4)
    cube = rng.uniform(size=(200, 3))
    flat = np.column_stack([rng.uniform(size=(150, 2)) * 3, np.zeros(150)])
    p = np.concatenate([cube, flat])
    df = table(spark, p, k=[0] * 200 + [1] * 150)
    h = hulls.cluster_hulls(df, "k").toPandas()
    assert set(h.k) == {0} and len(h) == len(hulls.hull_faces(cube))
    front = hulls.exterior_hulls(df, "k", 1.0, 0.0)
    assert 0 < front.count() < len(h)
    m = hulls.plane_meshes(df.filter("k = 1"), "k", 10.0).toPandas()
    assert len(m) == len(hulls.delaunay(flat[:, :2]))
    ring = np.array([(math.cos(a) * r, math.sin(a) * r, 0.0) for r in (1.0, 1.1, 1.2) for a in np.linspace(0, 2 * math.pi, 80, endpoint=False)])
    out = hulls.alpha_outlines(table(spark, ring, k=[7] * len(ring)), "k", 5.0).toPandas()
    assert abs(out.area.iloc[0] - math.pi * (1.2**2 - 1)) < 0.05 and len(out) == 160
    with pytest.raises(Exception, match="thin them"):
        hulls.cluster_hulls(df, "k", most=10).collect()


def surface(n=400):
    rng = np.random.default_rng(6)
    p = rng.uniform(-2, 2, size=(n, 3))
    n = np.zeros_like(p)
    for k in range(len(p)):
        a = k % 3
        p[k, a], n[k, a] = 0.0, 1.0
    return p, n


def test_registration(spark):
    p, n = surface()
    a = math.radians(4)
    r = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]])
    moved = (p - [0.1, -0.05, 0.08]) @ r  # r and the shift take it back
    target = table(spark, p, nx=n[:, 0], ny=n[:, 1], nz=n[:, 2])
    rotation, translation = align.icp_to_planes(table(spark, moved), target, thresholds=(0.6, 0.3), rounds=6, cell=0.3)
    assert np.abs(moved @ rotation.T + translation - p).max() < 0.02
    # a pass that would turn too far is not kept
    rotation, translation = align.icp_to_planes(table(spark, moved), target, thresholds=(0.6,), rounds=2, cell=0.3, most_angle=0.1)
    assert np.allclose(rotation, np.eye(3)) and not translation.any()
    big = table(spark, p[:, [1, 2, 0]] * [1.0, 2.0, 3.0])
    order, scale, spread = align.best_axis_mapping(big, table(spark, (p[:, [1, 2, 0]] * [1.0, 2.0, 3.0])[:, [2, 0, 1]] * 5))
    assert order == (2, 0, 1) and abs(scale - 5) < 1e-9 and spread < 1e-9


def test_facade_parts(spark):
    y, z = np.meshgrid(np.arange(0, 6, 0.1), np.arange(0, 4, 0.1))
    wall = np.column_stack([np.zeros(y.size), y.ravel(), z.ravel()])
    y, z = np.meshgrid(np.arange(1, 1.6, 0.1), np.arange(0, 2, 0.1))
    door = np.column_stack([np.full(y.size, -0.5), y.ravel(), z.ravel()])
    y, z = np.meshgrid(np.arange(3, 4, 0.1), np.arange(2.5, 3.2, 0.1))
    window = np.column_stack([np.full(y.size, -0.5), y.ravel(), z.ravel()])
    stray = np.array([[5.0, 5.0, 5.0]])
    df = table(spark, np.concatenate([wall, door, window, stray]))
    parts = {r.pid: r.part for r in facades.classify_facade(df, radius=0.25).collect()}
    n = len(wall)
    assert {parts[k] for k in range(n)} == {"wall"} and parts[n + len(door) + len(window)] == "other"
    found = {parts[k] for k in range(n, n + len(door))}, {parts[k] for k in range(n + len(door), n + len(door) + len(window))}
    assert found[0] <= {"door", "wall"} and found[1] <= {"window", "wall"}


def test_small_operators(spark):
    cells = [("w", i, j, 1) for i in range(3) for j in range(2)] + [("w", 5, 5, 1), ("w", 0, 5, -1), ("w", 1, 5, -1), ("w", 2, 5, -1), ("w", 3, 5, -1), ("v", 0, 0, 1)]
    p = facades.detail_patches(spark.createDataFrame(cells, "wall string, i long, j long, sign int")).collect()
    assert sorted((r.wall, r.sign, r.n, r.i0, r.i1, r.j0, r.j1) for r in p) == [("w", -1, 4, 0, 3, 5, 5), ("w", 1, 6, 0, 2, 0, 1)]
    q = np.random.default_rng(8).normal(size=(50, 3))
    labelled = table(spark, q, value=np.arange(50.0))
    out = {r.pid: r.value for r in facades.spread_values(table(spark, q[:10] + 0.1), labelled).collect()}
    for k in range(10):
        d = np.linalg.norm(q - q[k] - 0.1, axis=1)
        near = np.argsort(d)[:3]
        assert abs(out[k] - ((1 / (d[near] + 1e-8)) @ near) / (1 / (d[near] + 1e-8)).sum()) < 1e-6
    thin = facades.thinned_samples(table(spark, q), 1.0)
    assert thin.count() == len({tuple(np.floor(x)) for x in q})
    model = facades.apply_model(table(spark, q), lambda v: (v[:, 0] > 0).astype(int), ["x", "y", "z"], chunk=7)
    assert all(r.label == int(r.x > 0) for r in model.collect())
    n = spark.createDataFrame([(k, 1.0, 0.0, 0.0) for k in range(50)], "pid long, nx double, ny double, nz double")
    assert all((r.x - q[:, 0].mean()) * r.nx >= 0 for r in facades.facing(n, table(spark, q)).join(table(spark, q), "pid").collect())
    angle, _ = facades.rotation_refined(table(spark, q[:12]), table(spark, q[:12] @ np.array([[math.cos(0.5), math.sin(0.5), 0], [-math.sin(0.5), math.cos(0.5), 0], [0, 0, 1]])), 1.0, around=1.0, step=0.25)
    assert abs(angle - math.degrees(0.5)) < 0.2


def test_panorama_both_ways(spark):
    """A cube's pixel looks at a panorama pixel that is taken from the same face, near the same place."""
    u, v = panorama.panorama_pixel(400, 200)
    there = panorama.face_pixels(spark, 20).withColumns({"u": u, "v": v})
    back = panorama.panorama_source(spark, 400, 200, 20).select("u", "v", F.col("face").alias("f2"), F.col("row").alias("r2"), F.col("col").alias("c2"))
    j = there.join(back, ["u", "v"])
    assert j.count() == 6 * 400 and j.filter("face = f2 AND abs(row - r2) <= 1 AND abs(col - c2) <= 1").count() > 0.97 * 2400
    pixels = back.select("u", "v", (F.col("u") % 256).alias("red"), (F.col("v") % 256).alias("green"), F.lit(1).alias("blue"))
    assert panorama.resampled(panorama.face_pixels(spark, 20), pixels, 400, 200).count() == 2400
