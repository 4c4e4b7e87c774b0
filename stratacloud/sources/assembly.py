"""Detailed models from ring tables and features: holes and openings, installations, meshes, and their documents.

A ring table has model_id, obj_id, type, lod, sem_type, poly_idx, ring_idx, ring; here also parent (the object a feature belongs
to) and wall_poly (the polygon of the parent that an opening is cut into), null for objects of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import format_pos_list, xml_id

RINGS = ["model_id", "obj_id", "type", "lod", "sem_type", "poly_idx", "ring_idx", "ring", "parent", "wall_poly"]
_TAIL = "</bldg:Building>"


def _plain(rings: DataFrame) -> DataFrame:
    for c, kind in (("parent", "string"), ("wall_poly", "int")):
        if c not in rings.columns:
            rings = rings.withColumn(c, F.lit(None).cast(kind))
    return rings.select(*RINGS)


def punched(rings: DataFrame, openings: DataFrame) -> DataFrame:
    """rings with the openings(model_id, obj_id, poly_idx, feature_id, feature_type, hole, face) cut in: each hole, turned against its
    wall, is one more ring of its polygon, and each opening a child object of lod 3 with its face."""
    rings = _plain(rings)
    key = ["model_id", "obj_id", "poly_idx"]
    wall = rings.groupBy(*key).agg(F.max("ring_idx").alias("last"), *(F.min_by(c, "ring_idx").alias(c) for c in ("type", "lod", "sem_type", "parent", "wall_poly")))
    number = F.row_number().over(Window.partitionBy(*key).orderBy("feature_id"))
    openings = openings.select(*key, "feature_id", "feature_type", "hole", "face")
    holes = openings.join(wall, key).withColumns({"ring_idx": F.col("last") + number, "ring": F.reverse("hole")}).select(*RINGS)
    child = {"obj_id": F.col("feature_id"), "type": F.col("feature_type"), "lod": F.lit(3.0), "sem_type": F.col("feature_type"), "poly_idx": F.lit(0), "ring_idx": F.lit(0), "ring": F.col("face"), "parent": F.col("obj_id"), "wall_poly": F.col("poly_idx").cast("int")}
    return rings.unionByName(holes).unionByName(openings.select("model_id", *(v.alias(k) for k, v in child.items())))


def with_installations(rings: DataFrame, faces: DataFrame, lod: float = 3.0) -> DataFrame:
    """rings with child objects of type BuildingInstallation from faces(model_id, parent, feature_id, poly_idx, sem_type, ring)."""
    child = {"obj_id": F.col("feature_id"), "type": F.lit("BuildingInstallation"), "lod": F.lit(lod), "ring_idx": F.lit(0), "wall_poly": F.lit(None).cast("int")}
    return _plain(rings).unionByName(faces.withColumns(child).select(*RINGS))


def with_meshes(rings: DataFrame, vertices: DataFrame, faces: DataFrame, parents: DataFrame, lod: float = 2.2) -> DataFrame:
    """rings with one installation without semantics per mesh: vertices(mesh_id, vid, x, y, z), faces(mesh_id, fid, vids),
    parents(mesh_id, model_id, parent)."""
    f = face_rings(vertices, faces, "mesh_id").join(parents, "mesh_id")
    return with_installations(rings, f.select("model_id", "parent", F.concat(F.lit("mesh_"), F.col("mesh_id").cast("string")).alias("feature_id"), F.col("fid").alias("poly_idx"), F.lit("").alias("sem_type"), "ring"), lod)


def face_rings(vertices: DataFrame, faces: DataFrame, key: str) -> DataFrame:
    """faces with their corners as a ring: key, fid, ring (and grp, if there)."""
    more = [c for c in ("grp",) if c in faces.columns]
    corners = faces.select(key, "fid", *more, F.posexplode("vids").alias("k", "vid")).join(vertices, [key, "vid"])
    ring = F.transform(F.array_sort(F.collect_list(F.struct("k", "x", "y", "z"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z")))
    return corners.groupBy(key, "fid", *more).agg(ring.alias("ring"))


def group_models(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Ring table of the groups of OBJ files (read_obj): an object of each group, a polygon of each face."""
    f = face_rings(vertices, faces, "model_id")
    name = F.coalesce("grp", F.lit("default"))
    poly = F.row_number().over(Window.partitionBy("model_id", name).orderBy("fid")) - 1
    return f.select("model_id", name.alias("obj_id"), F.lit("Building").alias("type"), F.lit(2.2).alias("lod"), F.lit("").alias("sem_type"), poly.alias("poly_idx"), F.lit(0).alias("ring_idx"), "ring")


def _element(tag: str, body: Column, identifier: Column | None = None) -> Column:
    start = F.lit(f"<{tag}>") if identifier is None else F.concat(F.lit(f'<{tag} gml:id="'), identifier, F.lit('">'))
    return F.concat(start, body, F.lit(f"</{tag}>"))


def gml_ring(ring: Column) -> Column:
    return _element("gml:LinearRing", _element("gml:posList", format_pos_list(ring)))


def gml_polygon(rings: Column) -> Column:
    """The first ring is exterior, the others are interior."""
    inner = F.transform(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: _element("gml:interior", gml_ring(r)))
    return _element("gml:Polygon", F.concat(_element("gml:exterior", gml_ring(rings[0])), F.array_join(inner, "")))


def gml_multi_surface(polygons: Column) -> Column:
    return _element("gml:MultiSurface", F.array_join(F.transform(polygons, lambda p: _element("gml:surfaceMember", p)), ""))


def detailed_gml(rings: DataFrame) -> DataFrame:
    """Ring table with features to (model_id, value): a building per root object, its boundary surfaces with their openings, and its
    installations, in lod 3."""
    rings = _plain(rings)
    key = ["model_id", "obj_id", "type", "sem_type", "poly_idx", "parent", "wall_poly"]
    p = rings.groupBy(*key).agg(gml_polygon(F.transform(F.array_sort(F.collect_list(F.struct("ring_idx", "ring"))), lambda r: r["ring"])).alias("polygon"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("poly_idx", c))), lambda x: x[c])
    child = p.filter("parent IS NOT NULL").groupBy("model_id", "obj_id", "type", "parent", "wall_poly").agg(gml_multi_surface(ordered("polygon")).alias("surface"))
    name = xml_id(F.col("obj_id"))
    opening = child.filter("wall_poly IS NOT NULL").withColumn("text", F.when(F.col("type") == "Door", _element("bldg:opening", _element("bldg:Door", _element("bldg:lod3MultiSurface", F.col("surface")), name))).otherwise(_element("bldg:opening", _element("bldg:Window", _element("bldg:lod3MultiSurface", F.col("surface")), name))))
    opening = opening.groupBy("model_id", F.col("parent").alias("obj_id"), F.col("wall_poly").alias("poly_idx")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("obj_id").alias("o"), "text"))), lambda x: x["text"]), "").alias("openings"))
    installed = child.filter("wall_poly IS NULL").withColumn("text", _element("bldg:outerBuildingInstallation", _element("bldg:BuildingInstallation", _element("bldg:lod3Geometry", F.col("surface")), name)))
    installed = installed.groupBy("model_id", F.col("parent").alias("obj_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("obj_id").alias("o"), "text"))), lambda x: x["text"]), "").alias("installations"))
    surface = p.filter("parent IS NULL").join(opening, ["model_id", "obj_id", "poly_idx"], "left")
    kind = F.when(F.col("sem_type") == "", "WallSurface").otherwise(F.col("sem_type"))
    body = F.concat(_element("bldg:lod3MultiSurface", gml_multi_surface(F.array("polygon"))), F.coalesce("openings", F.lit("")))
    text = F.concat(F.lit("<bldg:boundedBy><bldg:"), kind, F.lit(' gml:id="'), xml_id(F.concat_ws("_", "obj_id", "poly_idx")), F.lit('">'), body, F.lit("</bldg:"), kind, F.lit("></bldg:boundedBy>"))
    b = surface.withColumn("text", text).groupBy("model_id", "obj_id").agg(F.array_join(ordered("text"), "").alias("surfaces")).join(installed, ["model_id", "obj_id"], "left")
    b = b.withColumn("text", _element("core:cityObjectMember", _element("bldg:Building", F.concat("surfaces", F.coalesce("installations", F.lit(""))), name)))
    head = '<core:CityModel xmlns:core="http://www.opengis.net/citygml/2.0" xmlns:bldg="http://www.opengis.net/citygml/building/2.0" xmlns:gml="http://www.opengis.net/gml">'
    return b.groupBy("model_id").agg(F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("obj_id", "text"))), lambda t: t["text"]), ""), F.lit("</core:CityModel>")).alias("value"))


def with_fragments(documents: DataFrame, fragments: DataFrame) -> DataFrame:
    """documents(model_id, value) with the fragments(model_id, fragment), in order, put in at the end of the last building."""
    f = fragments.groupBy("model_id").agg(F.array_join(F.sort_array(F.collect_list("fragment")), "").alias("more"))
    after = F.substring_index("value", _TAIL, -1)
    at = F.length("value") - F.length(after) - len(_TAIL)
    put = F.concat(F.left(F.col("value"), at), F.col("more"), F.lit(_TAIL), after)
    return documents.join(f, "model_id", "left").withColumn("value", F.when(F.col("more").isNotNull() & F.contains("value", F.lit(_TAIL)), put).otherwise(F.col("value"))).drop("more")


def without_surfaces(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    """documents(model_id, value) without the boundary surfaces of dropped(model_id, surface_id)."""
    d = dropped.groupBy("model_id").agg(F.collect_set("surface_id").alias("ids"))
    pattern = lambda i: F.concat(F.lit(r'(?s)<bldg:boundedBy>\s*<bldg:\w+ gml:id="\Q'), i, F.lit(r'\E">(?:(?!</bldg:boundedBy>).)*</bldg:boundedBy>'))
    cut = F.aggregate(F.coalesce("ids", F.array().cast("array<string>")), F.col("value"), lambda v, i: F.regexp_replace(v, pattern(i), F.lit("")))
    return documents.join(d, "model_id", "left").withColumn("value", cut).drop("ids")
