"""Rankings and samples of rows, and small summaries of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G


def by_size(points: DataFrame, key: str) -> DataFrame:
    """Groups of a key, the largest first, ties by key: key, n, place."""
    n = points.groupBy(key).agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), key)))


def segments_by_size(points: DataFrame, key: str) -> DataFrame:
    """Segments with an id in the order in which they are first seen (by pid), and their place by size, ties by that id."""
    s = points.groupBy(key).agg(F.count("*").alias("n"), F.min("pid").alias("first_pid"))
    s = s.withColumn("segment_id", F.row_number().over(Window.orderBy("first_pid", key)) - 1)
    return s.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "segment_id")))


def capped_in_order(points: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """A seeded sample of at most so many points without repetition; place keeps their order by pid."""
    kept = points.orderBy(F.xxhash64(F.lit(seed), "pid"), "pid").limit(most)
    return kept.withColumn("place", F.row_number().over(Window.orderBy("pid")) - 1)


def stride_sample(points: DataFrame, key: str, stride: int, seed: int = 0) -> DataFrame:
    """Of each batch (key) one point in a stride, two at least, by a seeded order."""
    order = Window.partitionBy(key).orderBy(F.xxhash64(F.lit(seed), "pid"), "pid")
    p = points.withColumns({"_n": F.count("*").over(Window.partitionBy(key)), "_k": F.row_number().over(order)})
    return p.filter(F.col("_k") <= F.greatest(F.floor(F.col("_n") / stride), F.lit(2))).drop("_n", "_k")


def near_model(points: DataFrame, rings: DataFrame, pad: float = 100.0) -> DataFrame:
    """Points in the padded bounds of all rings in XY; one row of bounds goes to all."""
    ends = {f"{a}{k}": f(g(F.col(f"ring.{a}"))) for a in "xy" for k, f, g in ((0, F.min, F.array_min), (1, F.max, F.array_max))}
    bounds = rings.agg(*(c.alias(f"_{n}") for n, c in ends.items()))
    inside = F.col("x").between(F.col("_x0") - pad, F.col("_x1") + pad) & F.col("y").between(F.col("_y0") - pad, F.col("_y1") + pad)
    return points.join(F.broadcast(bounds)).filter(inside).drop("_x0", "_x1", "_y0", "_y1")


def ground_level(rings: DataFrame) -> DataFrame:
    """model_id, ground: the lowest vertex of its ground surfaces, 0 where it has none."""
    low = F.min(F.when(F.col("sem_type") == "GroundSurface", F.array_min(F.col("ring.z"))))
    return rings.groupBy("model_id").agg(F.coalesce(low, F.lit(0.0)).alias("ground"))


def polygons_by_type(faces: DataFrame) -> DataFrame:
    """faces(sem_idx, types: names of the object's surfaces): polygons of each type; an index beyond them counts as INVALID(i)."""
    name = F.when(F.col("sem_idx").isNull(), "").when((F.col("sem_idx") >= 0) & (F.col("sem_idx") < F.size("types")), F.try_element_at("types", F.col("sem_idx") + 1))
    return faces.groupBy(name.otherwise(F.concat(F.lit("INVALID("), F.col("sem_idx").cast("string"), F.lit(")"))).alias("sem_type")).agg(F.count("*").alias("n"))


def statistics(rings: DataFrame) -> DataFrame:
    """model_id, objects, polygons, surfaces by type as a map, vertices, and the highest lod."""
    first = rings.filter("ring_idx = 0").groupBy("model_id", "sem_type").agg(F.count("*").alias("n"))
    types = first.groupBy("model_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sem_type", "n")))).alias("types"))
    whole = rings.groupBy("model_id").agg(F.countDistinct("obj_id").alias("objects"), F.count_if(F.col("ring_idx") == 0).alias("polygons"), F.sum(F.size("ring")).alias("vertices"), F.max("lod").alias("lod"))
    return whole.join(types, "model_id", "left")


def file_hashes(files: DataFrame) -> DataFrame:
    """files(path, content): path, sha1."""
    return files.select("path", F.sha1("content").alias("sha1"))


def labels_of(code: Column, names: dict[int, str], other: str = "Other") -> Column:
    """The name of a class among those wanted, or the other."""
    out = None
    for k, name in names.items():
        out = F.when(code == k, name) if out is None else out.when(code == k, name)
    return F.lit(other) if out is None else out.otherwise(other)


def detail_cells(cells: DataFrame, baseline: DataFrame, depth: float = 0.12) -> DataFrame:
    """cells(wall, i, j, depth) that stand out of their wall's baseline(wall, base) by more than a depth: with sign 1 (out) or -1."""
    d = F.col("depth") - F.col("base")
    return cells.join(F.broadcast(baseline), "wall").filter(F.abs(d) > depth).withColumn("sign", F.signum(d).cast("int"))


def depth_baseline(cells: DataFrame) -> DataFrame:
    """wall, base: the median of its cells' median depths."""
    return cells.groupBy("wall").agg(F.median("depth").alias("base"))


def oriented_boxes(points: DataFrame, key: str) -> DataFrame:
    """Per key the box along the axes of the XY covariance: angle, width, height, depth and its four lower corners as a ring. The
    axes are closed-form, so groups are never gathered."""
    m = points.groupBy(key).agg((0.5 * F.atan2(2 * F.covar_pop("x", "y"), F.var_pop("x") - F.var_pop("y"))).alias("angle"))
    p = points.join(m, key).withColumns({"u": F.col("x") * F.cos("angle") + F.col("y") * F.sin("angle"), "v": F.col("y") * F.cos("angle") - F.col("x") * F.sin("angle")})
    b = p.groupBy(key).agg(F.first("angle").alias("angle"), *(f(c).alias(f"{c}{k}") for c in "uvz" for k, f in ((0, F.min), (1, F.max))))
    at = lambda u, v: F.struct((F.col(u) * F.cos("angle") - F.col(v) * F.sin("angle")).alias("x"), (F.col(u) * F.sin("angle") + F.col(v) * F.cos("angle")).alias("y"), F.col("z0").alias("z"))
    ring = F.array(at("u0", "v0"), at("u1", "v0"), at("u1", "v1"), at("u0", "v1"))
    return b.select(key, "angle", (F.col("u1") - F.col("u0")).alias("width"), (F.col("z1") - F.col("z0")).alias("height"), (F.col("v1") - F.col("v0")).alias("depth"), ring.alias("ring"))


def triangles(rings: DataFrame, key: str) -> DataFrame:
    """Fans of rings: key, k, a, b, c."""
    n = F.sequence(F.lit(2), F.greatest(F.size("ring"), F.lit(3)) - 1)
    t = rings.filter(F.size("ring") >= 3).select(key, F.col("ring"), F.explode(n).alias("k"))
    return t.select(key, (F.col("k") - 2).alias("k"), F.col("ring")[0].alias("a"), F.element_at("ring", F.col("k")).alias("b"), F.element_at("ring", F.col("k") + 1).alias("c"))


def subdivided(tri: DataFrame, most: float) -> DataFrame:
    """Triangles(a, b, c) with edges longer than `most` cut at their middles into four, level by level; each level is a flat map
    and the levels follow from the longest edge."""
    side = lambda p, q: F.sqrt(sum(((p[c] - q[c]) * (p[c] - q[c]) for c in "xyz"), F.lit(0.0)))
    longest = lambda a, b, c: F.greatest(side(a, b), side(b, c), side(c, a))
    top = tri.agg(F.max(longest(F.col("a"), F.col("b"), F.col("c")))).first()[0] or 0.0
    mid = lambda p, q: F.struct(*(((p[c] + q[c]) / 2).alias(c) for c in "xyz"))
    while top > most:
        a, b, c = (F.col(x) for x in "abc")
        ab, bc, ca = mid(a, b), mid(b, c), mid(c, a)
        as_struct = lambda p, q, r: F.struct(p.alias("a"), q.alias("b"), r.alias("c"))
        four = F.array(as_struct(a, ab, ca), as_struct(ab, b, bc), as_struct(ca, bc, c), as_struct(ab, bc, ca))
        parts = F.when(longest(a, b, c) > most, four).otherwise(F.array(as_struct(a, b, c)))
        tri = tri.withColumn("t", F.explode(parts)).withColumns({x: F.col(f"t.{x}") for x in "abc"}).drop("t")
        top /= 2
    return tri


def sampled(rings: DataFrame, key: str, spacing: float = 0.05, least: int = 100, seed: int = 0) -> DataFrame:
    """Points on rings: one for each square of the spacing, at least so many a ring, spread over its triangles by area; where a point
    falls depends on the ring's key, its number and the seed alone. key, n, x, y, z."""
    t = triangles(rings, key)
    cross = lambda a, b, c: G.norm(G.corner_normal(F.array(a, b, c))) / 2
    t = t.withColumn("area", cross(F.col("a"), F.col("b"), F.col("c")))
    whole = t.groupBy(key).agg(F.sum("area").alias("whole"), F.array_sort(F.collect_list(F.struct("k", "area", "a", "b", "c"))).alias("parts"))
    n = F.greatest(F.floor(F.col("whole") / (spacing * spacing) + 1e-9), F.lit(least)).cast("long")
    p = whole.filter("whole > 0").withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    unit = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col(key), F.col("n")), F.lit(1 << 53)).cast("double") / float(1 << 53)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("at"))
    at = F.aggregate("parts", start, lambda s, x: F.struct((s["sum"] + x["area"]).alias("sum"), F.when(s["sum"] + x["area"] < F.col("pick"), s["at"] + 1).otherwise(s["at"]).alias("at")), lambda s: s["at"])
    p = p.withColumn("pick", unit(1) * F.col("whole")).withColumn("at", F.least(at, F.size("parts") - 1))
    p = p.select(key, "n", F.element_at("parts", F.col("at") + 1).alias("t"), F.sqrt(unit(2)).alias("r"), unit(3).alias("s"))
    return p.select(key, "n", *((F.col(f"t.a.{c}") * (1 - F.col("r")) + F.col(f"t.b.{c}") * F.col("r") * (1 - F.col("s")) + F.col(f"t.c.{c}") * F.col("r") * F.col("s")).alias(c) for c in "xyz"))


def concatenated(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Meshes(model_id, vid ...) and (model_id, fid, vids) as one: vertices and faces numbered on, models in order of their id."""
    count = vertices.groupBy("model_id").agg(F.count("*").alias("nv")).join(faces.groupBy("model_id").agg(F.count("*").alias("nf")), "model_id", "left").na.fill(0, ["nf"])
    before = Window.orderBy("model_id").rowsBetween(Window.unboundedPreceding, -1)  # one row a mesh
    at = F.broadcast(count.select("model_id", F.coalesce(F.sum("nv").over(before), F.lit(0)).alias("v0"), F.coalesce(F.sum("nf").over(before), F.lit(0)).alias("f0")))
    v = vertices.join(at, "model_id").withColumn("vid", F.col("vid") + F.col("v0")).drop("v0", "f0")
    f = faces.join(at, "model_id").withColumns({"fid": F.col("fid") + F.col("f0"), "vids": F.transform("vids", lambda k: (k + F.col("v0")).cast("int"))}).drop("v0", "f0")
    return v, f


def shared_edges_within(rings: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """rings(face_id, ring): pairs of edges of two faces whose ends meet within a tolerance, in either direction: face_1, i, face_2, j.
    Edges meet by the cell of their middle, probed in the neighbour cells."""
    e = rings.select("face_id", F.posexplode(G.edges(F.col("ring"))).alias("i", "e")).select("face_id", "i", "e.a", "e.b")
    cell = lambda c: F.floor((F.col(f"a.{c}") + F.col(f"b.{c}")) / 2 / (2 * tolerance)).cast("long")
    other = e.select(F.col("face_id").alias("face_2"), F.col("i").alias("j"), F.col("a").alias("p"), F.col("b").alias("q"), *(cell(c).alias(f"c_{c}") for c in "xyz"))
    for c in "xyz":
        e = e.withColumn(f"c_{c}", F.explode(F.sequence(cell(c) - 1, cell(c) + 1)))
    meet = lambda u, v: F.sqrt(sum(((F.col(f"{u}.{c}") - F.col(f"{v}.{c}")) * (F.col(f"{u}.{c}") - F.col(f"{v}.{c}")) for c in "xyz"), F.lit(0.0))) <= tolerance
    j = e.join(other, [f"c_{c}" for c in "xyz"]).filter(F.col("face_id") < F.col("face_2"))
    return j.filter((meet("a", "p") & meet("b", "q")) | (meet("a", "q") & meet("b", "p"))).select(F.col("face_id").alias("face_1"), "i", "face_2", "j")


def tile_requests(locations: DataFrame, faces: tuple[str, ...] = ("front", "right", "back", "left", "up", "down")) -> DataFrame:
    """locations(lat, lng): the list of tiles that would be asked for: lat, lng, face, heading, pitch, name."""
    table = F.explode(F.array(*(F.struct(F.lit(f).alias("face"), F.lit(h).alias("heading"), F.lit(p).alias("pitch")) for f, h, p in zip(faces, (0, 90, 180, 270, 0, 0), (0, 0, 0, 0, 90, -90), strict=False))))
    t = locations.withColumn("t", table).select("lat", "lng", "t.*")
    return t.withColumn("name", F.concat(F.format_string("%.6f_%.6f_", "lat", "lng"), "face", F.lit(".jpg")))
