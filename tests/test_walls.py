"""Merged walls, match variants, samples and neighbours against plain versions and cases with known results."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratacloud.functions import color, geometry
from stratacloud.operators import clustering, facades, meshes, models, selection, spatial
from stratacloud.sources import assembly, documents

POINT = "array<struct<x:double,y:double,z:double>>"
WALL = f"model_id string, obj_id string, idx int, nx double, ny double, ring {POINT}, holes array<{POINT}>"


def rectangle(x0, x1, z0, z1, y=0.0):
    """Faces -y: counter-clockwise seen from there."""
    return [tuple(map(float, p)) for p in ((x0, y, z0), (x1, y, z0), (x1, y, z1), (x0, y, z1))]


def merged(spark, rings, **options):
    rows = [("m", "o", k, 0.0, -1.0, r[0], r[1:]) for k, r in enumerate(rings)]
    return [r.asDict() for r in models.merge_walls(spark.createDataFrame(rows, WALL), **options).orderBy("group_idx", "piece").collect()]


def test_merge_walls(spark):
    # a T-junction: the edge of the long wall is met by two short ones
    out = merged(spark, [[rectangle(0, 4, 0, 2)], [rectangle(0, 2, 2, 5)], [rectangle(2, 4, 2, 5)]])
    assert [(r["members"], r["made"], round(r["area"], 9)) for r in out] == [([0, 1, 2], "outline", 20.0)] and len(out[0]["ring"]) == 7
    # four walls around an opening leave a hole, which stays only if it is large enough
    frame = [[rectangle(0, 4, 0, 1)], [rectangle(0, 1, 1, 2)], [rectangle(3, 4, 1, 2)], [rectangle(0, 4, 2, 3)]]
    out = merged(spark, frame)
    assert len(out) == 1 and round(out[0]["area"], 9) == 10 and len(out[0]["holes"]) == 1
    assert merged(spark, frame, least_hole=3.0)[0]["holes"] == []
    # a hole of a member is kept
    out = merged(spark, [[rectangle(0, 4, 0, 4), rectangle(1, 2, 1, 2)[::-1]], [rectangle(4, 6, 0, 4)]])
    assert round(out[0]["area"], 9) == 23 and len(out[0]["holes"]) == 1
    # vertices 0.002 apart over any rounding edge meet; planes 0.6 apart, other directions and mere planes do not
    assert len(merged(spark, [[rectangle(0, 4, 0, 2)], [rectangle(4.0049, 6, 0, 2)]])) == 1
    assert len(merged(spark, [[rectangle(0, 4, 0, 2)], [rectangle(4, 6, 0, 2, y=0.6)]])) == 2
    assert len(merged(spark, [[rectangle(0, 4, 0, 2)], [rectangle(5, 6, 0, 2)]])) == 2
    tilted = [(4.0, 0.0, 0.0), (6.0, 0.7, 0.0), (6.0, 0.7, 2.0), (4.0, 0.0, 2.0)]
    assert len(merged(spark, [[rectangle(0, 4, 0, 2)], [tilted]])) == 2
    # overlapping walls leave no proper outline: their hull
    out = merged(spark, [[rectangle(0, 4, 0, 2)], [[(4.0, 0.0, 0.0), (4.0, 0.0, 2.0), (1.0, 0.0, 3.0), (1.0, 0.0, -1.0)]]])
    assert len(out) == 1 and out[0]["area"] > 8
    assert models.merge_walls(spark.createDataFrame([], WALL)).count() == 0


def test_long_chain_and_far_neighbours(spark):
    n = 3000
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)], "a long, b long")
    assert clustering.components(edges).agg(F.min("label"), F.max("label"), F.count("*")).first()[:] == (0, 0, n + 1)
    q = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1e5, 0.0, 0.0)], "pid long, x double, y double, z double")
    assert sorted((r.qid, r.pid) for r in spatial.nearest(q, q, 1, 0.01, same=True).collect()) == [(1, 2), (2, 1)]


def test_color_names(spark):
    cases = [((255, 0, 0), "Bright Red"), ((255, 160, 160), "Light Red"), ((40, 0, 0), "Dark Red"), ((0, 128, 0), "Green"), ((10, 10, 10), "Black"), ((100, 100, 100), "Dark Gray"), ((180, 180, 180), "Light Gray"), ((250, 250, 250), "White"), ((255, 0, 120), "Bright Pink"), ((255, 0, 20), "Bright Red")]
    df = spark.createDataFrame([(*(c / 255 for c in rgb), name) for rgb, name in cases], "r double, g double, b double, name string")
    assert df.filter(color.color_name(color.hsv(F.col("r"), F.col("g"), F.col("b"))) != F.col("name")).count() == 0


def test_prefixes(spark):
    c = spark.createDataFrame([("Abc_1.las",), ("xy_2.las",), ("none_3.las",)], "name string")
    p = spark.createDataFrame([("ABC_old",), ("abcd",), ("12xy",), ("XYz",), ("x",), ("",)], "polygon_id string")
    assert sorted(tuple(r) for r in facades.match_prefixes(c, p).collect()) == [("Abc_1.las", "ABC_old", True), ("xy_2.las", "12xy", False), ("xy_2.las", "XYz", False)]
    assert facades.match_prefixes(c.limit(0), p).count() == 0


def test_meshes_of_several_files(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"m{k}.obj").write_text("".join(f"v {x + 10 * k} {y} 0\n" for x, y in ((0, 0), (1, 0), (1, 1), (0, 1))) + f"vn 0 0 1\ng part{k}\nf 1//1 2//1 3//1\nf 1 3 4\n")
    v, f = documents.read_obj(spark, str(tmp_path))
    assert v.groupBy("model_id").agg(F.max("vid")).select(F.max("max(vid)"), F.count("*")).first()[:] == (3, 2)
    rows = {(r.grp, r.fid): (r.vids, r.nids) for r in f.collect()}
    assert rows["part1", 0] == ([0, 1, 2], [0, 0, 0]) and rows["part0", 1] == ([0, 2, 3], [None] * 3)
    whole, faces = selection.concatenated(v, f)
    assert sorted(r.vid for r in whole.collect()) == list(range(8)) and sorted(max(r.vids) for r in faces.collect()) == [2, 3, 6, 7]
    rings = assembly.group_models(v, f)
    assert {(r.obj_id, r.poly_idx) for r in rings.collect()} == {("part0", 0), ("part0", 1), ("part1", 0), ("part1", 1)}
    parents = f.select("model_id").distinct().select(F.col("model_id").alias("mesh_id"), F.lit("m").alias("model_id"), F.lit("b").alias("parent"))
    base = spark.createDataFrame([("m", "b", "Building", 2.2, "WallSurface", 0, 0, rectangle(0, 1, 0, 1))], f"model_id string, obj_id string, type string, lod double, sem_type string, poly_idx int, ring_idx int, ring {POINT}")
    both = assembly.with_meshes(base, v.withColumnRenamed("model_id", "mesh_id"), f.withColumnRenamed("model_id", "mesh_id"), parents)
    assert both.filter("type = 'BuildingInstallation' AND parent = 'b'").count() == 4
    lines = [r.value for r in documents.obj_lines(rings.filter("obj_id = 'part0'").select(F.col("poly_idx").alias("fid"), F.col("obj_id").alias("grp"), "ring", geometry.unit_normal(F.col("ring")).alias("normal")), normals=True).collect()]
    assert lines[5] == "f 1//1 2//1 3//1" and lines[4] == "vn 0.000000 0.000000 1.000000" and lines[-1] == "f 4//2 5//2 6//2"


def test_openings_greedily(spark):
    rng = random.Random(3)
    rows = [(w, k, t, t + rng.uniform(0.2, 2), z, z + rng.uniform(0.2, 2)) for w in range(3) for k in range(25) for t, z in [(rng.uniform(0, 6), rng.uniform(0, 6))]]
    got = {(r.wall, r.opening_id) for r in models.keep_largest_openings(spark.createDataFrame(rows, "wall int, opening_id int, t0 double, t1 double, z0 double, z1 double"), ["wall"], 0.1).collect()}
    want = set()
    for w in range(3):
        kept = []
        for r in sorted((r for r in rows if r[0] == w), key=lambda r: (-(r[3] - r[2]) * (r[5] - r[4]), r[1])):
            area = lambda q: (q[3] - q[2]) * (q[5] - q[4])
            both = [max(0, min(r[3], q[3]) - max(r[2], q[2])) * max(0, min(r[5], q[5]) - max(r[4], q[4])) for q in kept]
            if all(b / (area(r) + area(q) - b) <= 0.1 for b, q in zip(both, kept)):
                kept.append(r)
                want.add((w, r[1]))
    assert got == want and len(want) < len(rows)


def cloud(spark, n=200, seed=1):
    p = np.random.default_rng(seed).normal(size=(n, 3))
    return p, spark.createDataFrame(pd.DataFrame({"pid": range(n), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2]}))


def test_normals(spark):
    p, df = cloud(spark, 120)
    p[:, 2] *= 0.02
    df = df.withColumn("z", F.col("z") * 0.02)
    for r in meshes.normals(df, 1.0).collect():
        near = p[np.linalg.norm(p - p[r.pid], axis=1) <= 1.0]
        values, vectors = np.linalg.eigh(np.cov(near.T)) if len(near) > 2 else (None, None)
        if len(near) > 3:
            assert abs(abs(vectors[:, 0] @ [r.nx, r.ny, r.nz]) - 1) < 1e-6


def test_rotation_and_planes(spark):
    p, df = cloud(spark, 60)
    a = math.radians(60)
    turned = df.select("pid", (F.col("x") * math.cos(a) - F.col("y") * math.sin(a)).alias("x"), (F.col("x") * math.sin(a) + F.col("y") * math.cos(a)).alias("y"), "z")
    angle, distance = facades.rotation_search(df, turned, 0.5, [float(d) for d in range(0, 360, 30)])
    means = {}
    for d in range(0, 360, 30):
        c, s = math.cos(math.radians(d)), math.sin(math.radians(d))
        q = np.stack([p[:, 0] * c - p[:, 1] * s, p[:, 0] * s + p[:, 1] * c, p[:, 2]], axis=1)
        t = np.array([[r.x, r.y, r.z] for r in turned.orderBy("pid").collect()]) if d == 0 else t
        means[d] = np.linalg.norm(q[:, None] - t[None], axis=2).min(axis=1).mean()
    assert angle == 60 == min(means, key=means.get) and abs(distance - means[60]) < 1e-9
    rng = np.random.default_rng(5)
    flat = [(k, *rng.uniform(0, 5, 2), 0.0) for k in range(150)] + [(150 + k, 0.0, *rng.uniform(0, 5, 2)) for k in range(120)] + [(270 + k, *rng.uniform(1, 5, 3)) for k in range(20)]
    planes = clustering.ransac_planes(spark.createDataFrame([tuple(map(float, r[1:])) + (r[0],) for r in flat], "x double, y double, z double, pid long"), 0.01, least=100)
    found = {r.pid: r.plane for r in planes.collect()}
    assert {found[k] for k in range(150)} == {0} and {found[k] for k in range(150, 270)} <= {0, 1} and sum(found[k] == 1 for k in range(150, 270)) > 110


def test_cloth_on_a_slope(spark):
    rows = [(i * 100 + j, float(i), float(j), 0.2 * i + (5.0 if (i, j) in ((10, 10), (4, 7)) else 0.0)) for i in range(20) for j in range(20)]
    out = facades.cloth_ground(spark.createDataFrame(rows, "pid long, x double, y double, z double"), 1.0, 0.6)
    assert {r.pid for r in out.filter("NOT ground").collect()} == {1010, 407}


def test_samples_and_triangles(spark):
    rings = spark.createDataFrame([(1, rectangle(0, 2, 0, 2)), (2, [(0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (0.0, 0.0, 4.0)])], f"id int, ring {POINT}")
    s = selection.sampled(rings, "id", 0.1, 10).toPandas()
    assert s.groupby("id").size().tolist() == [400, 800] and s.y.abs().max() < 1e-12
    a = s[s.id == 1]
    assert abs(a.x.mean() - 1) < 0.1 and abs(a.z.mean() - 1) < 0.1 and (s[s.id == 2].x + s[s.id == 2].z).max() <= 4 + 1e-9
    t = selection.subdivided(selection.triangles(rings, "id"), 1.5)
    longest = max(max(math.dist(r.a, r.b), math.dist(r.b, r.c), math.dist(r.c, r.a)) for r in t.collect())
    assert longest <= 1.5 and selection.subdivided(selection.triangles(rings.limit(0), "id"), 1.0).count() == 0


def test_fragments(spark):
    d = spark.createDataFrame([("m", "<bldg:Building>a</bldg:Building><bldg:Building>b</bldg:Building>"), ("n", "no building")], "model_id string, value string")
    f = spark.createDataFrame([("m", "<x>$1\\</x>"), ("n", "y")], "model_id string, fragment string")
    assert {r.value for r in assembly.with_fragments(d, f).collect()} == {"<bldg:Building>a</bldg:Building><bldg:Building>b<x>$1\\</x></bldg:Building>", "no building"}
    w = '<bldg:boundedBy><bldg:WallSurface gml:id="{}">x</bldg:WallSurface></bldg:boundedBy>'
    g = spark.createDataFrame([("m", w.format("a.b") + w.format("axb"))], "model_id string, value string")
    assert assembly.without_surfaces(g, spark.createDataFrame([("m", "a.b")], "model_id string, surface_id string")).first().value == w.format("axb")


@pytest.mark.parametrize("master", ["spark://host:7077"])
def test_no_local_folder_on_a_cluster(monkeypatch, spark, master):
    from stratacloud.operators import durable

    class Context:
        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    Context.master = master

    class Session:
        sparkContext, conf = Context(), {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError):
        durable.cut(Frame())
