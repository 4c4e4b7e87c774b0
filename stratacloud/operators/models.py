"""City models as tables: normalisation of nested documents, openings, boxes, merged walls."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from . import outlines

FEATURE_TYPES = ("Window", "Door", "BuildingInstallation", "OtherConstruction")


def polygons(documents: DataFrame) -> DataFrame:
    """documents(model_id, scale, translate, vertices, objects) to one row per ring: model_id, obj_id, type, geom_idx, lod,
    shell_idx, poly_idx, ring_idx, sem_type, ring. Solids have shells of polygons, surfaces polygons; both are parsed by type."""
    o = documents.select("model_id", "scale", "translate", "vertices", F.explode("objects").alias("obj_id", "object"))
    g = o.select("*", F.col("object.type").alias("type"), F.posexplode("object.geometry").alias("geom_idx", "g")).drop("object")
    four, three = "array<array<array<array<int>>>>", "array<array<array<int>>>"
    solid = F.col("g.type") == "Solid"
    shells = F.when(solid, F.from_json("g.boundaries", four)).otherwise(F.array(F.from_json("g.boundaries", three)))
    values = F.when(solid, F.from_json("g.values", "array<array<int>>")).otherwise(F.array(F.from_json("g.values", "array<int>")))
    g = g.withColumn("lod", F.coalesce(F.col("g.lod").try_cast("double"), F.lit(0.0))).withColumn("shells", shells).withColumn("sem", values)
    g = g.select("*", F.posexplode("shells").alias("shell_idx", "shell")).select("*", F.posexplode("shell").alias("poly_idx", "poly"))
    at = F.try_element_at(F.try_element_at("sem", F.col("shell_idx") + 1), F.col("poly_idx") + 1)
    g = g.withColumn("sem_type", F.coalesce(F.try_element_at("g.surfaces", at + 1), F.lit("")))
    g = g.select("*", F.posexplode("poly").alias("ring_idx", "vids"))
    world = lambda v: F.struct(*(G.decode(v[k], F.col("scale")[k], F.col("translate")[k]).alias(c) for k, c in enumerate("xyz")))
    ring = F.transform("vids", lambda i: world(F.element_at("vertices", i + 1)))
    return g.select("model_id", "obj_id", "type", "geom_idx", "lod", "shell_idx", "poly_idx", "ring_idx", "sem_type", ring.alias("ring"))


def highest_lod(rings: DataFrame) -> DataFrame:
    """Each object's geometry of highest lod, the first of equals."""
    best = rings.groupBy("model_id", "obj_id").agg(F.min_by("geom_idx", F.struct(-F.col("lod"), F.col("geom_idx"))).alias("geom_idx"))
    return rings.join(best, ["model_id", "obj_id", "geom_idx"], "left_semi")


def walls(rings: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Near-vertical exterior rings of building objects as wall rows."""
    r = highest_lod(rings.filter(~F.col("type").isin(*FEATURE_TYPES))).filter((F.col("ring_idx") == 0) & G.is_vertical(F.col("ring"), tolerance))
    return wall_rows(r)


def wall_rows(r: DataFrame) -> DataFrame:
    n, c = G.newell(F.col("ring")), G.centroid(F.col("ring"))
    flat = F.hypot(n["x"], n["y"])
    r = r.withColumns({"nx": n["x"] / flat, "ny": n["y"] / flat, "ox": c["x"], "oy": c["y"]})
    ends = {f"{a}_{k}": f(F.col(f"ring.{a}")) for a in "xyz" for k, f in (("min", F.array_min), ("max", F.array_max))}
    r = r.withColumn("wall_d", F.col("ox") * F.col("nx") + F.col("oy") * F.col("ny")).withColumns(ends)
    order = Window.partitionBy("model_id").orderBy("obj_id", "geom_idx", "shell_idx", "poly_idx")
    return r.withColumn("idx", F.row_number().over(order) - 1)


def semantic_histogram(rings: DataFrame) -> DataFrame:
    return rings.filter("ring_idx = 0").groupBy("sem_type").agg(F.count("*").alias("n"))


def keep_largest_openings(openings: DataFrame, key: list[str], threshold: float = 0.0) -> DataFrame:
    """openings(key, opening_id, t0, t1, z0, z1): largest first, dropped where its overlap ratio with a kept one exceeds the
    threshold. Order-dependent; the openings of one wall are a bounded group."""

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(area=(pdf.t1 - pdf.t0) * (pdf.z1 - pdf.z0)).sort_values(["area", "opening_id"], ascending=[False, True])
        kept: list = []
        for row in pdf.itertuples():
            over = False
            for k in kept:
                w, h = max(0.0, min(row.t1, k.t1) - max(row.t0, k.t0)), max(0.0, min(row.z1, k.z1) - max(row.z0, k.z0))
                union = row.area + k.area - w * h
                over |= union > 0 and w * h / union > threshold
            if not over:
                kept.append(row)
        return pdf[pdf.opening_id.isin([k.opening_id for k in kept])].drop(columns="area")

    return openings.groupBy(*key).applyInPandas(keep, openings.schema)


def hole_ring(inset: float = 0.005) -> Column:
    """The opening's hole in its wall's plane, inset unless that leaves nothing: columns nx, ny, wall_d, t0, t1, z0, z1."""
    room = (F.col("t1") - F.col("t0") > 2 * inset) & (F.col("z1") - F.col("z0") > 2 * inset)
    i = F.when(room, inset).otherwise(0.0)
    return plane_rectangle(F.col("wall_d"), F.col("t0") + i, F.col("t1") - i, F.col("z0") + i, F.col("z1") - i)


def plane_rectangle(depth: Column, t0: Column, t1: Column, z0: Column, z1: Column) -> Column:
    """Counter-clockwise seen from outside, on the plane at a depth along (nx, ny)."""
    tangent = G.tangent(F.col("nx"), F.col("ny"))
    at = lambda t, z: F.struct((depth * F.col("nx") + t * tangent["x"]).alias("x"), (depth * F.col("ny") + t * tangent["y"]).alias("y"), z.alias("z"))
    return F.array(at(t0, z0), at(t1, z0), at(t1, z1), at(t0, z1))


def opening_features(openings: DataFrame, push: float = 0.01, inset: float = 0.005) -> DataFrame:
    """openings with hole (ring to cut), face (the opening's surface, pushed out) and a feature id that depends on the key alone."""
    face = plane_rectangle(F.col("wall_d") + push, F.col("t0"), F.col("t1"), F.col("z0"), F.col("z1"))
    name = F.concat(F.col("feature_type"), F.lit("_"), F.substring(F.sha1(F.concat_ws("|", "model_id", "idx", "opening_id")), 1, 8))
    return openings.withColumns({"hole": hole_ring(inset), "face": face, "feature_id": name, "lod": F.lit("3")})


def hole_class(z_bottom: Column, z_top: Column, ground: Column, threshold: float = 0.3) -> Column:
    return F.when((z_bottom <= ground + threshold) & (z_top - z_bottom < 4.0), "Door").otherwise("Window")


def boxes(points: DataFrame, outward: bool, guard: float = 0.05) -> DataFrame:
    """Points with cluster_id and their wall's nx, ny, wall_d: the recess (outward false) or extrusion box in the wall's frame:
    t0, t1, z0, z1, d_wall, d_far; none where it does not reach beyond the wall plane (by the guard, for a recess)."""
    length = F.hypot("nx", "ny")
    t = (F.col("y") * F.col("nx") - F.col("x") * F.col("ny")) / length
    d = (F.col("x") * F.col("nx") + F.col("y") * F.col("ny")) / length
    b = points.groupBy("cluster_id", "idx").agg(
        F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.first("wall_d").alias("wall_d"), F.min(t).alias("t0"), F.max(t).alias("t1"), F.min("z").alias("z0"), F.max("z").alias("z1"),
        (F.max(d) if outward else F.min(d)).alias("d_far"),
    )
    b = b.withColumn("d_wall", F.col("wall_d"))
    return b.filter(F.col("d_far") > F.col("d_wall")) if outward else b.filter(F.col("d_wall") - F.col("d_far") >= guard)


def box_faces(outward: bool) -> Column:
    """Rings of the box without its open side: five for a recess (open at the wall), six for an extrusion."""
    near, far = F.col("d_wall"), F.col("d_far")
    a = plane_rectangle(near, F.col("t0"), F.col("t1"), F.col("z0"), F.col("z1"))
    b = plane_rectangle(far, F.col("t0"), F.col("t1"), F.col("z0"), F.col("z1"))
    side = lambda i, j: F.array(a[i], a[j], b[j], b[i])
    faces = [b, side(0, 1), side(1, 2), side(2, 3), side(3, 0)]
    return F.array(*faces, F.reverse(a)) if outward else F.array(*faces)


def merge_walls(wall: DataFrame, angle: float = 5.0, distance: float = 2.0, adjacency: float = 0.01, least_hole: float = 0.05) -> DataFrame:
    """wall(model_id, obj_id, idx, nx, ny, ring, holes if there): walls of an object that face as a seed (in idx order) does, have
    all vertices within min(distance, 0.5) of its plane and share a vertex (nearer than the adjacency) with a member of its group
    become one. A row for each piece of the outline that is left when shared edges cancel: group_idx, piece, members, ring, holes
    of least_hole square metres or more, area, and how it was made (alone, outline, exterior: its holes are not valid, hull).
    All vertices on an outline stay, so that walls next to it meet it without cracks. An object's walls are a bounded group."""
    point = "array<struct<x:double,y:double,z:double>>"
    schema = f"model_id string, obj_id string, group_idx int, piece int, members array<int>, nx double, ny double, area double, made string, ring {point}, holes array<{point}>"
    cosine, reach = math.cos(math.radians(angle)), min(distance, 0.5)
    if "holes" not in wall.columns:
        wall = wall.withColumn("holes", F.array().cast(f"array<{point}>"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [outlines.Wall(int(r.idx), r.nx, r.ny, [outlines.points(x) for x in (r.ring, *r.holes)]) for r in pdf.sort_values("idx").itertuples()]
        out = []
        for number, group in enumerate(outlines.groups(rows, cosine, reach, adjacency, 10 * distance)):
            seed = group[0]
            for piece, (rings, made) in enumerate(outlines.pieces(group, adjacency, least_hole)):
                area = outlines.area(rings[0], seed) + sum(outlines.area(h, seed) for h in rings[1:])
                as_points = [[dict(zip("xyz", map(float, p), strict=True)) for p in ring] for ring in rings]
                out.append((pdf["model_id"].iloc[0], pdf["obj_id"].iloc[0], number, piece, sorted(w.idx for w in group), seed.nx, seed.ny, area, made, as_points[0], as_points[1:]))
        return pd.DataFrame(out, columns=["model_id", "obj_id", "group_idx", "piece", "members", "nx", "ny", "area", "made", "ring", "holes"])

    return wall.select("model_id", "obj_id", "idx", "nx", "ny", "ring", "holes").groupBy("model_id", "obj_id").applyInPandas(merge, schema)


def shared_edges(rings: DataFrame, decimals: int = 3) -> DataFrame:
    """rings(face_id, ring): undirected edges that exactly two faces have: their key and the faces."""
    q = lambda p: F.struct(*(F.bround(p[c], decimals).alias(c) for c in "xyz"))
    e = rings.select("face_id", F.explode(G.edges(F.col("ring"))).alias("e")).select("face_id", q(F.col("e.a")).alias("a"), q(F.col("e.b")).alias("b"))
    e = e.select("face_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return e.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("face_id").alias("face_1"), F.max("face_id").alias("face_2")).filter("n = 2").drop("n")


def self_crossings(rings: DataFrame) -> DataFrame:
    """rings(face_id, ring): pairs of non-adjacent edges that cross: face_id, i, j. Edges meet in the grid cells of their bounds, and
    a pair counts in the first cell that both lie in. A ring's cells are as wide as its edges in the root mean square, so that all
    its edges lie in at most a few times as many cells as there are edges."""
    sizes = []
    for a in "xy":
        square = F.aggregate("es", F.lit(0.0), lambda s, e: s + F.pow(e["b"][a] - e["a"][a], 2))
        sizes.append(F.when(square > 0, F.sqrt(square / F.size("es"))).otherwise(1.0).alias(f"size_{a}"))
    e = rings.select("face_id", G.edges(F.col("ring")).alias("es")).select("face_id", F.size("es").alias("n"), *sizes, "es")
    e = e.select("face_id", "n", "size_x", "size_y", F.posexplode("es").alias("i", "e"))  # on its own, or each edge carries its ring
    e = e.select("face_id", "n", "size_x", "size_y", "i", *(F.col(f"e.{k}.{a}").alias(f"{k}{a}") for k in "ab" for a in "xy"))
    bound = lambda f, a, d: F.floor((f(F.col(f"a{a}"), F.col(f"b{a}")) + F.lit(d)) / F.col(f"size_{a}")).cast("long")
    e = e.withColumns({f"{k}_{a}": bound(f, a, d) for a in "xy" for k, f, d in (("low", F.least, -1e-6), ("high", F.greatest, 1e-6))})
    for a in "xy":
        e = e.withColumn(f"c_{a}", F.explode(F.sequence(f"low_{a}", f"high_{a}")))
    e = e.select("face_id", "c_x", "c_y", "low_x", "low_y", "n", "i", "ax", "ay", "bx", "by")
    other = e.select("face_id", "c_x", "c_y", F.col("low_x").alias("from_x"), F.col("low_y").alias("from_y"), F.col("i").alias("j"), *(F.col(c).alias(f"f{c}") for c in ("ax", "ay", "bx", "by")))
    j = e.join(other, ["face_id", "c_x", "c_y"]).filter("j > i + 1 AND NOT (i = 0 AND j = n - 1) AND c_x = greatest(low_x, from_x) AND c_y = greatest(low_y, from_y)")
    ends = [{"x": F.col(f"{k}x"), "y": F.col(f"{k}y")} for k in ("a", "b", "fa", "fb")]
    return j.filter(G.segments_cross(*ends)).select("face_id", "i", "j")
