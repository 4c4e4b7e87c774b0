import json

import pytest
from pyspark.sql import functions as F

from stratacloud.operators import facades
from stratacloud.sources import documents, sinks

SCHEMA = "model_id string, obj_id string, type string, geom_idx int, lod double, shell_idx int, poly_idx int, ring_idx int, sem_type string, ring array<struct<x:double,y:double,z:double>>"
SQUARE = [(0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.0, 4.0, 0.0), (0.0, 4.0, 0.0)]
HOLE = [(1.0, 1.0, 0.0), (1.0, 2.0, 0.0), (2.0, 2.0, 0.0), (2.0, 1.0, 0.0)]


@pytest.fixture(scope="module")
def rings(spark):
    return spark.createDataFrame([("m", "b 1", "Building", 0, 2.2, 0, 0, 0, "GroundSurface", SQUARE), ("m", "b 1", "Building", 0, 2.2, 0, 0, 1, "GroundSurface", HOLE), ("m", "b2", "Building", 0, 1.0, 0, 0, 0, "RoofSurface", [(x + 10, y, 3.0) for x, y, _ in SQUARE])], SCHEMA)


def test_documents(spark, rings, tmp_path):
    text = sinks.gml_documents(rings).first().value
    assert text.count("<gml:interior>") == 1 and 'gml:id="b_1"' in text
    (tmp_path / "m.gml").write_text(text)
    back = documents.read_gml_surfaces(spark, str(tmp_path / "m.gml"))
    assert back.count() == 3 and [tuple(p) for p in back.filter("surface_type = 'RoofSurface'").first().ring][0] == (10, 0, 3)
    sinks.write_cityjson(rings, str(tmp_path / "cj"))
    doc = json.loads(spark.read.text(str(tmp_path / "cj")).first().value)
    assert len(doc["CityObjects"]["b 1"]["geometry"][0]["boundaries"][0]) == 2 and len(doc["vertices"]) == 12
    f = [json.loads(r.value) for r in sinks.geojson_features(rings.filter("ring_idx = 0"), "obj_id").collect()]
    assert {x["properties"]["id"] for x in f} == {"b 1", "b2"} and all(x["geometry"]["coordinates"][0][0] == x["geometry"]["coordinates"][0][-1] for x in f)


def test_model_edits(rings):
    assert sinks.merge_models(rings, rings).select("obj_id").distinct().count() == 4
    assert sinks.filter_lods(rings, [1.0]).count() == 1
    assert sinks.change_height(rings, 2.0).agg(F.max(F.array_max("ring.z"))).first()[0] == 5
    assert {r.obj_id for r in sinks.subset_models(rings, -1, -1, 5, 5).collect()} == {"b 1"}


def test_tables(spark, rings, tmp_path):
    p = spark.createDataFrame([(i, 0.0, 0.0, 0.0, i % 3) for i in range(30)], "pid long, x double, y double, z double, classification int")
    sinks.write_points_by_class(p, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).filter("classification = 1").count() == 10
    sinks.write_conflicts(spark.createDataFrame([("w", 0.123456)], "wall string, probability double"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().probability == "0.1235"


def test_facade_cases(spark, rings):
    f = {r.obj_id: r.ring for r in facades.footprints(rings).collect()}
    assert len(f["b 1"]) == 4 and len(f["b2"]) == 4
    r = facades.align_vector_to_z((0.0, 1.0, 0.0)) @ [0, 1, 0]
    assert abs(r[2] - 1) < 1e-12
    s = spark.createDataFrame([([0.5, 0.25, 0.25], [{"red": 100, "green": 0, "blue": 255}] * 3), ([1.0, 0.0, 0.0], None)], "weights array<double>, colors array<struct<red:int,green:int,blue:int>>")
    assert [(x.red, x.green, x.blue) for x in facades.barycentric_colors(s).collect()] == [(100, 0, 255), (255, 255, 255)]
    e = spark.createDataFrame([(104, "d", {"coid": "b 1", "geom": "0", "shell": "0", "face": "0"})], "code int, description string, id map<string,string>")
    assert facades.reported_faces(e, rings).count() == 2
    v = rings.groupBy("obj_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring_idx", "ring"))), lambda x: x["ring"]).alias("rings"))
    assert all(r[0] for r in v.select(facades.valid_surface(F.col("rings"))).collect())
    n = spark.createDataFrame([(i, float(i % 5), float(i // 5), 0.0, 0.0, 0.0, 1.0) for i in range(25)], "pid long, x double, y double, z double, nx double, ny double, nz double")
    c = facades.curvature(n.select("pid", "x", "y", "z"), n.select("pid", "nx", "ny", "nz"), 4, 1.0, 0.1)
    assert c.filter("flat").count() == 25
    box = spark.createDataFrame([("b", 0, SQUARE), ("b", 1, [(x + 50, y, z) for x, y, z in SQUARE])], "box_id string, face int, ring array<struct<x:double,y:double,z:double>>")
    near = spark.createDataFrame([("b", 1.0, 1.0, 0.2)], "box_id string, x double, y double, z double")
    assert [r.face for r in facades.supported_faces(box, near).collect()] == [0]


def shapefile(records):
    import struct

    body = b""
    for n, parts in enumerate(records):
        points = [p for ring in parts for p in ring]
        starts = [sum(len(r) for r in parts[:k]) for k in range(len(parts))]
        shape = struct.pack("<I4dII", 5, 0, 0, 1, 1, len(parts), len(points)) + struct.pack(f"<{len(parts)}I", *starts) + b"".join(struct.pack("<2d", *p) for p in points) if parts else struct.pack("<I", 0)
        body += struct.pack(">II", n + 1, len(shape) // 2) + shape
    return struct.pack(">I20xI", 9994, (100 + len(body)) // 2) + b"\0" * 72 + body


def test_shapes_and_images(spark, tmp_path):
    square = lambda x, y, s: [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)]  # noqa: E731 - clockwise
    content = shapefile([[square(0, 0, 4), square(1, 1, 1)[::-1], square(9, 9, 2)], [], [[*square(5, 5, 1)[:1], *square(5, 5, 1)]]])
    (tmp_path / "area.shp").write_bytes(content)
    files = spark.read.format("binaryFile").load(str(tmp_path / "area.shp"))
    rows = {r.polygon_id: (len(r.ring), len(r.holes)) for r in documents.read_shapes(files).collect()}
    assert rows == {"area_0_0": (4, 1), "area_0_1": (4, 0), "area_2_0": (4, 0)}
    for name in ("b.png", "a.jpg", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in documents.list_images(spark, str(tmp_path)).collect()] == ["a.jpg", "b.png"]


def test_las_subsets(spark, tmp_path):
    import struct

    import numpy as np
    import pandas as pd

    from stratacloud.sources import las

    n = 50
    image = las.encode(pd.DataFrame({"x": np.arange(n) * 1.5, "y": np.arange(n) * 2.0, "z": np.zeros(n), "classification": 2, "red": 5, "green": 6, "blue": 7}))
    # three bytes of an extra dimension behind each record, and a record that names the coordinate system
    head, length = bytearray(image[:227]), struct.unpack_from("<H", image, 105)[0]
    raw = np.frombuffer(image[227:], np.uint8).reshape(n, length)
    raw = np.concatenate([raw, np.arange(3 * n, dtype=np.uint8).reshape(n, 3)], axis=1)
    keys = struct.pack("<8H", 1, 1, 0, 1, 3072, 0, 1, 32651)
    vlr = struct.pack("<H16sHH32s", 0, b"LASF_Projection", 34735, len(keys), b"") + keys
    struct.pack_into("<IIBH", head, 96, 227 + len(vlr), 1, 2, length + 3)
    (tmp_path / "a.las").write_bytes(bytes(head) + vlr + raw.tobytes())
    files = spark.read.format("binaryFile").load(str(tmp_path / "a.las"))
    path = files.first().path
    assert las.las_metadata(files).first().crs == "EPSG:32651"
    segments = spark.createDataFrame([(path, "even" if k % 2 == 0 else "odd", k) for k in range(n)], "path string, segment string, pid long")
    out = {r.segment: bytes(r.content) for r in las.las_subsets(files, segments).collect()}
    h = las.parse_header(out["odd"])
    assert (h["n_points"], h["record_length"], h["maxs"][0], h["mins"][1]) == (25, length + 3, 49 * 1.5, 2.0) and las.crs_of(out["odd"]) == "EPSG:32651"
    kept = np.frombuffer(out["odd"], np.uint8, 25 * (length + 3), h["data_offset"]).reshape(25, -1)
    assert (kept == raw[1::2]).all()
