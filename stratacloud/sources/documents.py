"""City-model, mesh, footprint and report documents as tables, through Spark's own readers."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import format_pos_list, key_values, pos_list

#: CityJSON: nested parts that vary in depth stay strings.
CITYJSON = (
    "type string, version string, transform struct<scale:array<double>,translate:array<double>>, vertices array<array<bigint>>, "
    "CityObjects map<string,struct<type:string,parents:array<string>,children:array<string>,"
    "geometry:array<struct<type:string,lod:string,boundaries:string,semantics:struct<surfaces:array<struct<type:string>>,values:string>>>>>"
)
REPORT = "features array<struct<id:string,type:string,errors:array<struct<code:int,description:string,info:string,id:string>>>>"


def read_cityjson(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: model_id, scale, translate, vertices, objects (geometry with boundaries, values, surfaces)."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("model_id"), "value")
    return parse_cityjson(text)


def parse_cityjson(text: DataFrame) -> DataFrame:
    """text(model_id, value); a missing transform is scale 1, translate 0."""
    d = text.select("model_id", F.from_json("value", CITYJSON).alias("d")).select("model_id", "d.*").filter("CityObjects IS NOT NULL")
    scale = F.coalesce("transform.scale", F.array(*[F.lit(1.0)] * 3))
    translate = F.coalesce("transform.translate", F.array(*[F.lit(0.0)] * 3))
    geometry = lambda o: F.transform(F.coalesce(o["geometry"], F.array().cast("array<struct<type:string,lod:string,boundaries:string,semantics:struct<surfaces:array<struct<type:string>>,values:string>>>")), lambda g: F.struct(g["type"].alias("type"), g["lod"].alias("lod"), g["boundaries"].alias("boundaries"), g["semantics"]["values"].alias("values"), F.coalesce(g["semantics"]["surfaces"]["type"], F.array().cast("array<string>")).alias("surfaces")))
    objects = F.transform_values("CityObjects", lambda k, o: F.struct(o["type"].alias("type"), o["parents"].alias("parents"), o["children"].alias("children"), geometry(o).alias("geometry")))
    return d.select("model_id", scale.alias("scale"), translate.alias("translate"), "vertices", objects.alias("objects"))


def cityjson_document(rings: DataFrame, scale: float = 0.001) -> DataFrame:
    """One compact document per model from rings(model_id, obj_id, type, lod, sem_type, poly_idx, ring_idx, ring, and parent, if
    there): surfaces of polygons, vertices numbered by first use after quantisation, children linked with their parents. A model is
    a bounded group."""
    if "parent" not in rings.columns:
        rings = rings.withColumn("parent", F.lit(None).cast("string"))
    q = lambda p: F.struct(*(F.bround(p[c] / scale, 0).cast("long").alias(c) for c in "xyz"))
    rows = rings.withColumn("q", F.transform("ring", q)).groupBy("model_id").agg(F.collect_list(F.struct("obj_id", "type", "lod", "sem_type", "poly_idx", "ring_idx", "q", "parent")).alias("rows"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for model_rows in batch.column(1).to_pylist():
                vertices: dict[tuple, int] = {}
                objects: dict = {}
                for r in sorted(model_rows, key=lambda r: (r["obj_id"], r["poly_idx"], r["ring_idx"])):
                    o = objects.setdefault(r["obj_id"], {"type": r["type"], "geometry": [{"type": "MultiSurface", "lod": f"{r['lod']:g}", "boundaries": [], "semantics": {"surfaces": [], "values": []}}]})
                    g = o["geometry"][0]
                    ids = [vertices.setdefault((p["x"], p["y"], p["z"]), len(vertices)) for p in r["q"]]
                    if r["ring_idx"] == 0:
                        g["boundaries"].append([])
                        names = [s["type"] for s in g["semantics"]["surfaces"]]
                        if r["sem_type"] and r["sem_type"] not in names:
                            g["semantics"]["surfaces"].append({"type": r["sem_type"]})
                            names.append(r["sem_type"])
                        g["semantics"]["values"].append(names.index(r["sem_type"]) if r["sem_type"] else None)
                    g["boundaries"][-1].append(ids)
                for r in sorted(model_rows, key=lambda r: r["obj_id"]):
                    if (parent := r["parent"]) is not None and "parents" not in objects[r["obj_id"]]:
                        objects[r["obj_id"]]["parents"] = [parent]
                        if parent in objects:
                            objects[parent].setdefault("children", []).append(r["obj_id"])
                out.append(json.dumps({"type": "CityJSON", "version": "1.1", "transform": {"scale": [scale] * 3, "translate": [0.0] * 3}, "CityObjects": objects, "vertices": [list(v) for v in vertices]}, separators=(",", ":")))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["model_id", "value"])

    return rows.mapInArrow(build, "model_id string, value string")


def read_gml_surfaces(spark: SparkSession, path: str, tags: tuple[str, ...] = ("bldg:WallSurface", "bldg:RoofSurface", "bldg:GroundSurface")) -> DataFrame:
    """model_id, surface_type, surface_id, ring_idx, ring of every posList in the surfaces."""
    return parse_gml_surfaces(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("model_id"), "value"), tags)


def parse_gml_surfaces(text: DataFrame, tags: tuple[str, ...] = ("bldg:WallSurface", "bldg:RoofSurface", "bldg:GroundSurface")) -> DataFrame:
    """text(model_id, value): surfaces by block extraction, in one pass for all tags."""
    kinds = "|".join(tags)
    blocks = text.select("model_id", F.explode(F.regexp_extract_all("value", F.lit(rf"(?s)<({kinds})[ >].*?</\1>"), F.lit(0))).alias("block"))
    kind = F.element_at(F.split(F.regexp_extract("block", f"^<({kinds})", 1), ":"), -1)
    found = blocks.select("model_id", kind.alias("surface_type"), F.regexp_extract("block", 'gml:id="([^"]*)"', 1).alias("surface_id"), F.posexplode(F.regexp_extract_all("block", F.lit("(?s)<gml:posList[^>]*>(.*?)</gml:posList>"), F.lit(1))).alias("ring_idx", "pos"))
    return found.select("model_id", "surface_type", "surface_id", "ring_idx", pos_list(F.col("pos")).alias("ring")).filter("ring IS NOT NULL")


def gml_surface(kind: Column, surface_id: Column, rings: Column) -> Column:
    """A boundary surface as text: the first ring is exterior, the others are interior."""
    linear = lambda r: F.concat(F.lit("<gml:LinearRing><gml:posList>"), format_pos_list(r), F.lit("</gml:posList></gml:LinearRing>"))
    inner = F.array_join(F.transform(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: F.concat(F.lit("<gml:interior>"), linear(r), F.lit("</gml:interior>"))), "")
    return F.concat(F.lit("<bldg:"), kind, F.lit(' gml:id="'), surface_id, F.lit('"><gml:Polygon><gml:exterior>'), linear(rings[0]), F.lit("</gml:exterior>"), inner, F.lit("</gml:Polygon></bldg:"), kind, F.lit(">"))


def read_footprints(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON polygons and multipolygons: source, polygon_id (unique over files), ring (exterior, without its closing vertex); null and empty ones dropped."""
    source = F.regexp_extract(F.input_file_name(), "([^/]+?)(?:[.][^./]*)?$", 1)
    return parse_footprints(spark.read.text(path, wholetext=True).select(source.alias("source"), "value"))


def parse_footprints(text: DataFrame) -> DataFrame:
    """text(source, value): footprints of feature collections."""
    schema = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
    g = text.select("source", F.posexplode(F.from_json("value", schema)["features"]).alias("n", "f")).select("source", "n", "f.geometry.*")
    many = F.when(F.col("type") == "MultiPolygon", F.from_json("coordinates", "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json("coordinates", "array<array<array<double>>>")))
    p = g.filter("coordinates IS NOT NULL").select("source", "n", F.posexplode(many).alias("m", "polygon")).filter("size(polygon) > 0")
    ring = F.transform(F.slice(F.col("polygon")[0], 1, F.greatest(F.size(F.col("polygon")[0]) - 1, F.lit(0))), lambda c: F.struct(c[0].alias("x"), c[1].alias("y"), F.lit(0.0).alias("z")))
    return p.select("source", F.concat_ws("_", "source", "n", "m").alias("polygon_id"), ring.alias("ring")).filter("size(ring) >= 3")


def read_obj(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """mesh_vertex(model_id, vid from 0, x, y, z) and mesh_face(model_id, fid, grp, vids from 0, nids: of normals, null where a corner
    has none), numbered within each file; a g line names the faces after it."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("model_id"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    t = lines.withColumn("w", F.split(F.trim("text"), r"\s+")).withColumn("token", F.col("w")[0])
    by_line = Window.partitionBy("model_id").orderBy("line")
    v = t.filter("token = 'v'").select("model_id", (F.row_number().over(by_line) - 1).alias("vid"), *(F.col("w")[k + 1].cast("double").alias(c) for k, c in enumerate("xyz")))
    groups = t.filter("token IN ('f', 'g')").withColumn("grp", F.last(F.when(F.col("token") == "g", F.array_join(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), " ")), ignorenulls=True).over(by_line))
    vids = F.transform(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda s: F.split_part(s, F.lit("/"), F.lit(1)).cast("int") - 1)
    nids = F.transform(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda s: F.split_part(s, F.lit("/"), F.lit(3)).try_cast("int") - 1)
    f = groups.filter("token = 'f'").select("model_id", (F.row_number().over(by_line) - 1).alias("fid"), "grp", vids.alias("vids"), nids.alias("nids"))
    return v, f


def obj_lines(faces: DataFrame, normals: bool = False) -> DataFrame:
    """faces(fid, grp, ring; normal, if asked for) to text lines in order (value): vertices from 1, six decimals, a group line per
    face, and a normal per face, which its corners name."""
    w = Window.orderBy("fid").rowsBetween(Window.unboundedPreceding, -1)
    f = faces.withColumn("before", F.coalesce(F.sum(F.size("ring")).over(w), F.lit(0)))
    vertex = F.transform("ring", lambda p: F.format_string("v %.6f %.6f %.6f", p["x"], p["y"], p["z"]))
    number = F.row_number().over(Window.orderBy("fid")).cast("string")
    named = F.concat(F.lit("//"), F.col("number")) if normals else F.lit("")
    face = F.concat(F.lit("f "), F.array_join(F.transform("ring", lambda p, i: F.concat((F.col("before") + i + 1).cast("string"), named)), " "))
    normal = F.array(F.format_string("vn %.6f %.6f %.6f", *(F.col("normal")[c] for c in "xyz"))) if normals else F.array().cast("array<string>")
    f = f.withColumn("number", number)
    return f.select("fid", F.posexplode(F.concat(F.array(F.concat(F.lit("g "), F.coalesce("grp", F.lit("default")))), vertex, normal, F.array(face))).alias("k", "value")).orderBy("fid", "k").select("value")


def read_glb_vertices(files: DataFrame) -> DataFrame:
    """files(path, content): positions of every primitive: path, mesh, primitive, vid, x, y, z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _glb(path, content)

    return files.select("path", "content").mapInArrow(run, "path string, mesh int, primitive int, vid int, x double, y double, z double")


def _glb(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    magic, _, _ = struct.unpack_from("<4sII", content)
    if magic != b"glTF":
        raise ValueError(f"{path} is no binary glTF")
    at, doc, blob = 12, {}, b""
    while at < len(content):
        size, kind = struct.unpack_from("<I4s", content, at)
        chunk = content[at + 8 : at + 8 + size]
        doc, blob = (json.loads(chunk), blob) if kind == b"JSON" else (doc, chunk)
        at += 8 + size
    for m, mesh in enumerate(doc.get("meshes", [])):
        for k, primitive in enumerate(mesh["primitives"]):
            a = doc["accessors"][primitive["attributes"]["POSITION"]]
            view = doc["bufferViews"][a["bufferView"]]
            start, stride = view.get("byteOffset", 0) + a.get("byteOffset", 0), view.get("byteStride", 12)
            raw = np.frombuffer(blob, np.uint8, stride * (a["count"] - 1) + 12 if a["count"] else 0, start)
            xyz = np.stack([raw[i * stride : i * stride + 12].view("<f4") for i in range(a["count"])]).astype(float) if a["count"] else np.zeros((0, 3))
            n = len(xyz)
            yield pa.record_batch([pa.array([path] * n, pa.string()), pa.array([m] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)), *(pa.array(xyz[:, c]) for c in range(3))], names=["path", "mesh", "primitive", "vid", "x", "y", "z"])


def report_errors(text: DataFrame, code: int | None = None) -> DataFrame:
    """Validation reports (value: JSON): feature_id, code, description, id map, optionally of one code."""
    e = text.select(F.explode(F.from_json("value", REPORT)["features"]).alias("f")).select(F.col("f.id").alias("feature_id"), F.explode("f.errors").alias("e"))
    out = e.select("feature_id", "e.code", "e.description", key_values(F.col("e.id")).alias("id"))
    return out if code is None else out.filter(F.col("code") == code)


def read_shapes(files: DataFrame) -> DataFrame:
    """files(path, content) of .shp files with polygons (also with z or m): source, polygon_id, ring (exterior, without its closing
    vertex or repeated ones, clockwise in the file), holes. Null and empty shapes are dropped; a hole belongs to the exterior that
    holds its first vertex, the last one before it if none does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, rows = path.rsplit("/", 1)[-1].rsplit(".", 1)[0], []
                for n, rings in _shapes(path, content):
                    rows += [(source, f"{source}_{n}_{m}", _corners(ring), [_corners(h) for h in holes]) for m, (ring, holes) in enumerate(rings)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, types, strict=True)], names=["source", "polygon_id", "ring", "holes"])

    ring = pa.list_(pa.struct([(c, pa.float64()) for c in "xyz"]))
    types = [pa.string(), pa.string(), ring, pa.list_(ring)]
    point = "array<struct<x:double,y:double,z:double>>"
    return files.select("path", "content").mapInArrow(run, f"source string, polygon_id string, ring {point}, holes array<{point}>")


def _corners(ring: np.ndarray) -> list[dict]:
    return [{"x": float(x), "y": float(y), "z": 0.0} for x, y in ring]


def _shapes(path: str, content: bytes) -> Iterator[tuple[int, list]]:
    """Number of each polygon record and its (exterior, holes)."""
    from ..operators.outlines import inside, signed_area

    if struct.unpack_from(">I", content)[0] != 9994:
        raise ValueError(f"{path} is no shapefile")
    at = 100
    while at + 8 <= len(content):
        number, words = struct.unpack_from(">II", content, at)
        kind = struct.unpack_from("<I", content, at + 8)[0] if words >= 2 else 0
        body, at = at + 8, at + 8 + 2 * words
        if kind not in (5, 15, 25):
            continue
        parts, points = struct.unpack_from("<II", content, body + 36)
        starts = [*np.frombuffer(content, "<u4", parts, body + 44).tolist(), points]
        xy = np.frombuffer(content, "<f8", 2 * points, body + 44 + 4 * parts).reshape(-1, 2)
        found: list = []
        for a, b in zip(starts, starts[1:]):
            ring = xy[a:b]
            ring = ring[np.any(ring != np.roll(ring, 1, axis=0), axis=1)] if len(ring) else ring
            if len(ring) < 3 or signed_area(ring) == 0:
                continue
            if signed_area(ring) < 0 or not found:
                found.append((ring, []))
            else:
                next((f for f in found if inside(ring[0], f[0])), found[-1])[1].append(ring)
        if found:
            yield number - 1, found


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, length of the .jpg, .jpeg and .png files of a folder, ordered by name; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,JPG,JPEG,PNG}").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length").orderBy("name")
