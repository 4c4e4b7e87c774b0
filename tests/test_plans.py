from pyspark.sql import functions as F

from stratacloud.operators import models
from stratacloud.plans import facade

RING = "ring array<struct<x:double,y:double,z:double>>"


def test_openings_of_a_wall(spark):
    wall = models.wall_rows(spark.createDataFrame([("m", "b", 0, 0, 0, [(0.0, 0.0, 0.0), (10.0, 0.0, 0.0), (10.0, 0.0, 3.0), (0.0, 0.0, 3.0)])], f"model_id string, obj_id string, geom_idx int, shell_idx int, poly_idx int, {RING}"))
    grid = [(a, 4 + 0.2 * (a % 11), -0.05, 1 + 0.2 * (a // 11)) for a in range(66)]
    points = spark.createDataFrame([(i, float(x), float(y), float(z)) for i, x, y, z in grid], "pid long, x double, y double, z double")
    o = facade.openings(points, wall, "Window", facade.Config()).collect()
    assert len(o) == 1 and [round(v, 6) for v in (o[0].t0, o[0].t1, o[0].z0, o[0].z1)] == [4, 6, 1, 2]
    assert [round(p.x, 6) for p in o[0].hole] == [4.005, 5.995, 5.995, 4.005] and all(round(p.y, 6) == -0.01 for p in o[0].face)


def test_downsample_and_classify(spark):
    rows = [(i, 0.5 * (i % 20), 0.5 * (i // 20), 0.0, 2) for i in range(400)] + [(1000 + i, 0.5 * (i % 20), 3.0, 2.5 + 0.1 * (i // 20), 6) for i in range(200)]
    p = spark.createDataFrame([(i, float(x), float(y), float(z), c) for i, x, y, z, c in rows], "pid long, x double, y double, z double, classification int")
    down = facade.downsample(p, facade.Config(voxel=2.0))
    assert down.agg(F.sum("n")).first()[0] == 600 and {r.classification for r in down.collect()} <= {2, 6}
    got = {r.classification: r["count"] for r in facade.classify(p, facade.Config(neighbours=5)).groupBy("classification").count().collect()}
    assert got.get(6, 0) >= 100 and got[2] >= 300 and sum(got.values()) == 600
