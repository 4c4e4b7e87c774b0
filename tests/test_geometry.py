"""Hand-computed cases of a box of 10 x 6 x 3, and properties of the engine's operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacloud.functions import color as C
from stratacloud.functions import geometry as G
from stratacloud.functions import text as X
from stratacloud.operators import align, clouds, clustering, facades, models, spatial
from stratacloud.sources import documents, las

RING = "ring array<struct<x:double,y:double,z:double>>"
BOX = [(0, 0, 0), (10, 0, 0), (10, 6, 0), (0, 6, 0), (0, 0, 3), (10, 0, 3), (10, 6, 3), (0, 6, 3)]
FACES = {"GroundSurface": (0, 3, 2, 1), "RoofSurface": (4, 5, 6, 7), "south": (0, 1, 5, 4), "east": (1, 2, 6, 5), "north": (2, 3, 7, 6), "west": (3, 0, 4, 7)}


def ring(name):
    return [tuple(map(float, BOX[i])) for i in FACES[name]]


@pytest.fixture(scope="module")
def box(spark):
    return spark.createDataFrame([(n, ring(n)) for n in FACES], f"name string, {RING}")


def test_newell_and_vertical(box):
    rows = {r.name: r for r in box.select("name", G.newell(F.col("ring")).alias("v"), G.unit_normal(F.col("ring")).alias("n"), G.is_vertical(F.col("ring")).alias("vertical"), G.area_xy(F.col("ring")).alias("a")).collect()}
    assert tuple(rows["GroundSurface"].v) == (0, 0, -120) and tuple(rows["south"].v) == (0, -60, 0) and tuple(rows["east"].v) == (36, 0, 0)
    assert tuple(rows["north"].n) == (0, 1, 0) and rows["RoofSurface"].a == 60
    assert {n for n, r in rows.items() if r.vertical} == {"south", "east", "north", "west"}


def test_walls_of_document(spark):
    faces = [[list(v)] for v in FACES.values()]
    doc = {"type": "CityJSON", "version": "1.1", "transform": {"scale": [0.001] * 3, "translate": [0, 0, 0]}, "vertices": [[1000 * c for c in p] for p in BOX], "CityObjects": {"b": {"type": "Building", "geometry": [{"type": "Solid", "lod": "2.2", "boundaries": [faces], "semantics": {"surfaces": [{"type": "GroundSurface"}, {"type": "RoofSurface"}, {"type": "WallSurface"}], "values": [[0, 1, 2, 2, 2, 2]]}}, {"type": "Solid", "lod": "1", "boundaries": [faces[:2]]}]}, "w": {"type": "Window"}}}
    import json

    rings = models.polygons(documents.parse_cityjson(spark.createDataFrame([("m", json.dumps(doc))], "model_id string, value string")))
    assert {r.sem_type: r.n for r in models.semantic_histogram(models.highest_lod(rings)).collect()} == {"WallSurface": 4, "GroundSurface": 1, "RoofSurface": 1}
    assert sorted(round(r.wall_d, 9) for r in models.walls(rings).collect()) == [0, 0, 6, 10]


def test_polygon_tests(spark, box):
    south = "ring"
    p = spark.createDataFrame([(10.0, 3.0), (5.0, 3.0), (10.05, 3.0), (11.0, 3.0)], "x double, y double").crossJoin(box.filter("name = 'RoofSurface'"))
    rows = p.select(G.in_polygon(F.col("x"), F.col("y"), F.col(south), True).alias("covers"), G.in_polygon(F.col("x"), F.col("y"), F.col(south), False).alias("contains"), G.in_buffered(F.col("x"), F.col("y"), F.col(south), 0.1).alias("near")).collect()
    assert [tuple(r) for r in rows] == [(True, False, True), (True, True, True), (False, False, True), (False, False, False)]


def test_merge_and_openings(spark):
    half = lambda a, b: [(a, 0.0, 0.0), (b, 0.0, 0.0), (b, 0.0, 3.0), (a, 0.0, 3.0)]
    walls = spark.createDataFrame([("m", "b", 0, 0.0, -1.0, 0.0, half(0.0, 5.0)), ("m", "b", 1, 0.0, -1.0, 0.0, half(5.0, 10.0)), ("m", "b", 2, 1.0, 0.0, 10.0, ring("east"))], f"model_id string, obj_id string, idx int, nx double, ny double, wall_d double, {RING}")
    merged = models.merge_walls(walls).collect()
    # the corners that the two walls share stay on the outline, so that walls next to it meet it without cracks
    assert [(r.members, round(r.area, 9)) for r in merged] == [([0, 1], 30), ([2], 18)] and len(merged[0].ring) == 6
    o = spark.createDataFrame([("w", 1, 0.0, 2.0, 0.0, 2.0), ("w", 2, 1.0, 3.0, 0.0, 2.0), ("w", 3, 2.0, 3.0, 0.0, 2.0)], "wall string, opening_id int, t0 double, t1 double, z0 double, z1 double")
    for threshold in (0.3, 0.0):
        assert sorted(r.opening_id for r in models.keep_largest_openings(o, ["wall"], threshold).collect()) == [1, 3]


def test_encode_half_even(spark):
    v = spark.createDataFrame([(0.0005,), (0.0015,), (0.0025,)], "v double").select(G.encode(F.col("v"), 0.001, 0.0)).collect()
    assert [r[0] for r in v] == [0, 2, 2]


def test_hsv_and_palette(spark):
    c = spark.createDataFrame([(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0), (0.5, 0.5, 0.5), (1.0, 0.0, 0.5)], "r double, g double, b double").select(C.hsv(F.col("r"), F.col("g"), F.col("b")).alias("c")).select("c.*").collect()
    assert [tuple(round(x, 6) for x in r) for r in c] == [(0, 1, 1), (120, 1, 1), (240, 1, 1), (0, 0, 0.5), (330, 1, 1)]
    assert C.palette(5)[0] == (242, 36, 36)


def test_text(spark):
    r = spark.createDataFrame([("coid=b1|geom=0|shell=0|face=5", "0 0 0 1 0 0 1 1 0 0 0 0", "ab_c.las")], "kv string, pos string, name string")
    r = r.select(X.key_values(F.col("kv")).alias("m"), F.size(X.pos_list(F.col("pos"))).alias("n"), X.file_prefix(F.col("name")).alias("p"), X.strip_suffix(F.col("name"), [".laz", ".las"]).alias("s")).first()
    assert len(r.m) == 4 and r.m["face"] == "5" and (r.n, r.p, r.s) == (3, "AB", "ab_c")


def test_dbscan(spark):
    x = [0.0, 0.1, 0.2, 0.3, 5.0, 5.1, 5.2, 9.0]
    p = spark.createDataFrame([(i, v, 0.0, 0.0) for i, v in enumerate(x)], "pid long, x double, y double, z double")
    labels = {r.pid: r.label for r in clustering.dbscan(p, 0.15, 3).collect()}
    assert labels[7] == -1 and len({labels[i] for i in range(4)}) == 1 and len({labels[i] for i in (4, 5, 6)}) == 1 and labels[0] != labels[4]


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(0, 0.01, (60, 3)), rng.normal(5, 2, (60, 3))])
    p = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(pts)], "pid long, x double, y double, z double")
    got = {(r.qid, r["rank"]): r.pid for r in spatial.nearest(p, p, 4, 0.05, same=True).collect()}
    for i, v in enumerate(pts):
        d = ((pts - v) ** 2).sum(axis=1)
        assert [got[i, k + 1] for k in range(4)] == [j for j in np.lexsort((np.arange(len(d)), d)) if j != i][:4]


def test_rays(spark):
    r = spark.createDataFrame([(0.5, 0.5, 0.5, 4.5, 2.5, 0.5)], "ox double, oy double, oz double, x double, y double, z double")
    got = {(v.i, v.j, v.k): v.state for v in clouds.ray_voxels(r, 1.0).collect()}
    assert got[4, 2, 0] == 2 and got[2, 1, 0] == 1 and len(got) == 4


def test_similarity(spark):
    src = np.array([[0.0, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1]])
    dst = np.array([[5.0, 6, 7], [5, 8, 7], [3, 6, 7], [5, 6, 9]])
    pairs = spark.createDataFrame([(*map(float, a), *map(float, b)) for a, b in zip(src, dst)], "sx double, sy double, sz double, dx double, dy double, dz double")
    scale, rotation, t = align.fit_similarity(pairs)
    assert math.isclose(scale, 2) and np.allclose(rotation, [[0, -1, 0], [1, 0, 0], [0, 0, 1]]) and np.allclose(t, (5, 6, 7))
    assert len(set(align.axis_permutations())) == 24


def test_las_roundtrip(spark, tmp_path):
    import pandas as pd

    n = 2500
    pdf = pd.DataFrame({"x": np.arange(n) * 0.001 + 292000, "y": np.arange(n) * 0.5, "z": -np.arange(n) * 0.25, "classification": np.arange(n) % 7, "red": np.arange(n) % 65536, "green": 1, "blue": 2})
    path = str(tmp_path / "a.las")
    with open(path, "wb") as f:
        f.write(las.encode(pdf))
    spark.dataSource.register(las.LasSource)
    got = spark.read.format("las").option("range", "1000").load(path).toPandas().sort_values("pid")
    assert np.allclose(got[["x", "y", "z"]], pdf[["x", "y", "z"]], atol=0.0005001) and (got.red.to_numpy() == pdf.red.to_numpy()).all() and got.gps_time.isna().all()
    files = spark.read.format("binaryFile").load(path)
    assert las.read_las_table(files).count() == n and las.las_metadata(files).first().n_points == n
    assert las.list_files(spark, str(tmp_path)).count() == 1


def test_obj_and_gml(spark, tmp_path):
    faces = spark.createDataFrame([(0, "g1", ring("south")), (1, "g1", ring("east"))], f"fid int, grp string, {RING}")
    text = "\n".join(r.value for r in documents.obj_lines(faces).collect())
    (tmp_path / "a.obj").write_text(text)
    v, f = documents.read_obj(spark, str(tmp_path / "a.obj"))
    assert v.count() == 8 and [r.vids for r in f.orderBy("fid").collect()] == [[0, 1, 2, 3], [4, 5, 6, 7]]
    gml = faces.select(documents.gml_surface(F.lit("WallSurface"), F.col("fid").cast("string"), F.array("ring")).alias("s")).collect()
    (tmp_path / "a.gml").write_text("<m>" + "".join(r.s for r in gml) + "</m>")
    back = documents.read_gml_surfaces(spark, str(tmp_path / "a.gml"))
    assert back.count() == 2 and back.filter("surface_type = 'WallSurface'").count() == 2
    assert [tuple(p) for p in back.orderBy("surface_id").first().ring] == ring("south")
    (tmp_path / "f.json").write_text('{"features":[{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"geometry":null}]}')
    assert documents.read_footprints(spark, str(tmp_path / "f.json")).count() == 1


def test_stream(spark, tmp_path):
    from stratacloud.streaming import ingest

    p = spark.createDataFrame([(i, i * 0.1, 0.0, 0.0) for i in range(20)], "pid long, x double, y double, z double")
    p.write.parquet(str(tmp_path / "in"))
    counts = ingest.voxel_counts(ingest.point_stream(spark, str(tmp_path / "in"), "pid long, x double, y double, z double"), 1.0)
    q = counts.writeStream.format("memory").queryName("voxels").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.i: r.n for r in spark.table("voxels").collect()} == {0: 10, 1: 10}


def test_crossings_of_whole_rings(spark, tmp_path):
    from stratacloud import queries

    rng = np.random.default_rng(3)
    pts = np.concatenate([rng.normal(0, 0.2, (40, 2)), np.cumsum(rng.normal(0, 0.05, (60, 2)), axis=0)])
    spark.createDataFrame([(i, [*map(float, v), 0.0], int(i >= 40)) for i, v in enumerate(pts)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in queries.QUERIES["segment_crossings_whole"](spark, str(tmp_path)).collect()]
    want, pts = set(), pts.astype(np.float32).astype(float)
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) > 0
    for face, ring_ in enumerate((pts[:40], pts[40:])):
        n = len(ring_)
        e = [(ring_[i], ring_[(i + 1) % n]) for i in range(n)]
        want |= {(face, i, j) for i in range(n) for j in range(i + 2, n) if (i, j) != (0, n - 1) and side(*e[i], e[j][0]) != side(*e[i], e[j][1]) and side(*e[j], e[i][0]) != side(*e[j], e[i][1])}
    assert len(got) == len(set(got)) and set(got) == want and any(i >= 12 for f, i, j in want)


def test_rotation_and_planes_of_all_rows(spark, tmp_path):
    from stratacloud import queries

    rng = np.random.default_rng(4)
    near, far = rng.normal(0, 0.02, (110, 3)), rng.normal(0, 1, (40, 3)) + (5, 0, 0)
    pts = np.concatenate([near, far]).astype(np.float32).astype(float)
    spark.createDataFrame([(i, list(map(float, v)), 0) for i, v in enumerate(pts)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    seen = []
    plain = facades.rotation_search
    facades.rotation_search = lambda s, t, *a: seen.append((s.count(), t.count())) or plain(s, t, *a)
    try:
        r = queries.QUERIES["rotation_search"](spark, str(tmp_path)).first()
    finally:
        facades.rotation_search = plain
    assert seen == [(150, 150)] and r.angle == 90 and r.distance < 1e-9
    spark.createDataFrame([(k,) for k in range(25)], "n_nationkey int").write.parquet(str(tmp_path / "nation.parquet"))
    planes = {r.plane: r.n for r in queries.QUERIES["ransac_planes"](spark, str(tmp_path)).collect()}
    assert planes == dict.fromkeys(range(7), 100 * 21)  # the levels that the points of all walls share


def test_rotation_distance_is_exact(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, (30, 3)), np.concatenate([rng.normal(0, 0.01, (80, 3)), rng.normal(0, 2, (10, 3))])
    frame = lambda v: spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(v)], "pid long, x double, y double, z double")
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)).min(axis=1).mean()
    for target, least in ((b, want), (b * (1, 1, 0), None)):
        angle, distance = facades.rotation_search(frame(a), frame(target), 0.7, [0.0])
        assert angle == 0 and (least is None or math.isclose(distance, least))


def test_cloth_reaches_high_ground(spark):
    p = [(k, 0.25 + 0.5 * (k // 2), 0.25, 0.3 * (k // 2) + 4.0 * (k % 2)) for k in range(160)]
    cloth = facades.cloth_ground(spark.createDataFrame(p, "pid long, x double, y double, z double"))
    got = {r.pid: r.ground for r in cloth.collect()}
    assert len(got) == 160 and all(got[k] == (k % 2 == 0) for k in got)
    assert facades.cloth_ground(cloth.select("pid", "x", "y", "z").limit(0)).count() == 0
