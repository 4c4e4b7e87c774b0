"""Geometry on Column expressions: rings are arrays of struct<x,y,z> without a closing vertex."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double,z:double>"


def point(x, y, z) -> Column:
    return F.struct(*(c.cast("double").alias(n) if isinstance(c, Column) else F.lit(float(c)).alias(n) for n, c in zip("xyz", (x, y, z), strict=True)))


def rotated(ring: Column) -> Column:
    """The ring from its second vertex on, then the first: zipped with the ring it gives the edges."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def edges(ring: Column) -> Column:
    """array<struct<a,b>> of cyclic edges."""
    return F.zip_with(ring, rotated(ring), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(items: Column, term) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda s, e: s + term(e))


def newell(ring: Column) -> Column:
    """Unnormalised Newell vector as a point."""
    e = edges(ring)
    part = lambda i, j: _sum(e, lambda p: (p["a"][i] - p["b"][i]) * (p["a"][j] + p["b"][j]))
    return F.struct(part("y", "z").alias("x"), part("z", "x").alias("y"), part("x", "y").alias("z"))


def norm(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def unit_normal(ring: Column, least: float = 1e-6) -> Column:
    """Unit normal; (0, 0, 1) for fewer than three vertices or a degenerate ring."""
    v = newell(ring)
    length = norm(v)
    good = (F.size(ring) >= 3) & (length >= least)
    return F.when(good, F.struct(*((v[c] / length).alias(c) for c in "xyz"))).otherwise(point(0, 0, 1))


def corner_normal(ring: Column) -> Column:
    """Unnormalised normal of the first three vertices."""
    u, v = (F.struct(*((ring[k][c] - ring[0][c]).alias(c) for c in "xyz")) for k in (1, 2))
    return F.struct((u["y"] * v["z"] - u["z"] * v["y"]).alias("x"), (u["z"] * v["x"] - u["x"] * v["z"]).alias("y"), (u["x"] * v["y"] - u["y"] * v["x"]).alias("z"))


def plane_distance(p, plane) -> Column:
    """Signed distance of a point from a x + b y + c z + d = 0; the normal is made a unit, d is taken as it is."""
    length = F.sqrt(plane["a"] * plane["a"] + plane["b"] * plane["b"] + plane["c"] * plane["c"])
    return (plane["a"] * p["x"] + plane["b"] * p["y"] + plane["c"] * p["z"]) / length + plane["d"]


def nearest_on_segment(p, a, b) -> Column:
    """The point of the segment from a to b that is nearest to p."""
    along = {c: b[c] - a[c] for c in "xyz"}
    square = sum((along[c] * along[c] for c in "xyz"), F.lit(0.0))
    t = F.when(square > 0, sum(((p[c] - a[c]) * along[c] for c in "xyz"), F.lit(0.0)) / square).otherwise(0.0)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.struct(*((a[c] + along[c] * t).alias(c) for c in "xyz"))


def centroid(ring: Column) -> Column:
    n = F.size(ring).cast("double")
    return F.struct(*((_sum(ring, lambda p, c=c: p[c]) / n).alias(c) for c in "xyz"))


def area_xy(ring: Column) -> Column:
    """Signed shoelace area."""
    return _sum(edges(ring), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2


def planar_deviation(ring: Column) -> Column:
    """Largest distance of a vertex from the plane through the centroid."""
    n, c = unit_normal(ring), centroid(ring)
    return F.array_max(F.transform(ring, lambda p: F.abs(sum((p[k] - c[k]) * n[k] for k in "xyz"))))


def is_vertical(ring: Column, tolerance: float = 0.3) -> Column:
    v = newell(ring)
    length = norm(v)
    flat = F.sqrt(v["x"] * v["x"] + v["y"] * v["y"])
    return (F.size(ring) >= 3) & (length >= 1e-9) & (F.abs(v["z"]) / length <= tolerance) & (flat / length >= 1e-6)


def encode(value: Column, scale: Column | float, translate: Column | float) -> Column:
    """World to quantised integer, halves to even."""
    return F.bround((value - translate) / scale, 0).cast("long")


def decode(value: Column, scale: Column | float, translate: Column | float) -> Column:
    return value * scale + translate


def tangent(nx: Column, ny: Column) -> Column:
    """Unit tangent of a wall, z cross n; (1, 0) for a degenerate normal."""
    length = F.sqrt(nx * nx + ny * ny)
    return F.when(length < 1e-9, F.struct(F.lit(1.0).alias("x"), F.lit(0.0).alias("y"))).otherwise(F.struct((-ny / length).alias("x"), (nx / length).alias("y")))


def fan(n: Column) -> Column:
    """Triangles (0, i, i + 1) of a ring of n vertices."""
    return F.when(n >= 3, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(3)) - 2), lambda i: F.array(F.lit(0), i, i + 1))).otherwise(F.array().cast("array<array<int>>"))


def rect_iou(a: Column, b: Column) -> Column:
    """Intersection over union of struct<t0,t1,z0,z1> rectangles; 0 for an empty union."""
    w = F.greatest(F.least(a["t1"], b["t1"]) - F.greatest(a["t0"], b["t0"]), F.lit(0.0))
    h = F.greatest(F.least(a["z1"], b["z1"]) - F.greatest(a["z0"], b["z0"]), F.lit(0.0))
    size = lambda r: (r["t1"] - r["t0"]) * (r["z1"] - r["z0"])
    union = size(a) + size(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def in_polygon(x: Column, y: Column, ring: Column, boundary: bool) -> Column:
    """Crossing-number test in XY; boundary says whether points on the outline count."""
    e = edges(ring)
    on = F.exists(e, lambda s: (F.abs(_cross(s["a"], s["b"], x, y)) < 1e-12) & x.between(F.least(s["a"]["x"], s["b"]["x"]), F.greatest(s["a"]["x"], s["b"]["x"])) & y.between(F.least(s["a"]["y"], s["b"]["y"]), F.greatest(s["a"]["y"], s["b"]["y"])))
    crosses = lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y)) & (x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) / (s["b"]["y"] - s["a"]["y"]) + s["a"]["x"])
    inside = F.size(F.filter(e, crosses)) % 2 == 1
    return (inside | on) if boundary else (inside & ~on)


def distance_to_outline(x: Column, y: Column, ring: Column) -> Column:
    """Least XY distance to the ring's edges."""

    def one(s: Column) -> Column:
        dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["a"]["x"]) * dx + (y - s["a"]["y"]) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-300))))
        return F.hypot(x - s["a"]["x"] - t * dx, y - s["a"]["y"] - t * dy)

    return F.array_min(F.transform(edges(ring), one))


def in_buffered(x: Column, y: Column, ring: Column, buffer: float) -> Column:
    """Inside the outline grown by a round buffer, its boundary excluded."""
    return in_polygon(x, y, ring, False) | (distance_to_outline(x, y, ring) < buffer)


def _cross(a: Column, b: Column, x: Column, y: Column) -> Column:
    return (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])


def orientation(a: Column, b: Column, c: Column, eps: float = 1e-12) -> Column:
    v = _cross(a, b, c["x"], c["y"])
    return F.when(F.abs(v) <= eps, 0).when(v > 0, 1).otherwise(-1)


def on_segment(a: Column, b: Column, p: Column) -> Column:
    """p, known to be collinear with a-b, lies between them."""
    return p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def segments_cross(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Proper crossings and collinear contacts."""
    o = [orientation(a, b, c), orientation(a, b, d), orientation(c, d, a), orientation(c, d, b)]
    touch = ((o[0] == 0) & on_segment(a, b, c)) | ((o[1] == 0) & on_segment(a, b, d)) | ((o[2] == 0) & on_segment(c, d, a)) | ((o[3] == 0) & on_segment(c, d, b))
    return ((o[0] != o[1]) & (o[2] != o[3])) | touch


def clip_z_min(ring: Column, z_min: Column) -> Column:
    """The part of the ring at or above z_min; fewer than three vertices left: empty."""

    def part(e: Column) -> Column:
        a, b = e["a"], e["b"]
        t = (z_min - a["z"]) / (b["z"] - a["z"])
        cut = F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y"), z_min.cast("double").alias("z"))
        up, over = a["z"] >= z_min, b["z"] >= z_min
        none = F.array().cast(f"array<{POINT}>")
        return F.concat(F.when(up, F.array(a)).otherwise(none), F.when(up != over, F.array(cut)).otherwise(none))

    out = F.flatten(F.transform(edges(ring), part))
    return F.when(F.size(out) >= 3, out).otherwise(F.array().cast(f"array<{POINT}>"))


def wound_like(ring: Column, reference: Column) -> Column:
    """The ring, reversed where its normal opposes the reference."""
    return F.when(dot(newell(ring), reference) < 0, F.reverse(ring)).otherwise(ring)


def drop_repeats(ring: Column, eps: float = 1e-8) -> Column:
    """Without vertices that equal the last kept one, or a closing vertex that equals the first."""
    far = lambda a, b: (F.abs(a["x"] - b["x"]) > eps) | (F.abs(a["y"] - b["y"]) > eps) | (F.abs(a["z"] - b["z"]) > eps)
    kept = F.aggregate(ring, F.array().cast(f"array<{POINT}>"), lambda out, p: F.when((F.size(out) == 0) | far(F.try_element_at(out, F.lit(-1)), p), F.concat(out, F.array(p))).otherwise(out))
    return F.transform(F.array(kept), lambda k: F.when((F.size(k) > 1) & ~far(F.try_element_at(k, F.lit(1)), F.try_element_at(k, F.lit(-1))), F.slice(k, 1, F.greatest(F.size(k) - 1, F.lit(0)))).otherwise(k))[0]


def ring_is_valid(ring: Column, deviation: float = 0.05) -> Column:
    """Three distinct vertices (8 decimals), a normal, and planar up to a deviation."""
    distinct = F.size(F.array_distinct(F.transform(ring, lambda p: F.struct(*(F.bround(p[c], 8) for c in "xyz")))))
    return (distinct >= 3) & (norm(newell(ring)) >= 1e-12) & (planar_deviation(ring) <= deviation)


def is_curved(ring: Column, tolerance: float = 0.05) -> Column:
    n = F.size(F.array_distinct(ring))
    return (n > 4) | ((n == 4) & (planar_deviation(ring) > tolerance))


def vertical_edge(a: Column, b: Column, least: float = 0.10) -> Column:
    dz = F.abs(a["z"] - b["z"])
    return (dz >= least) & (F.hypot(a["x"] - b["x"], a["y"] - b["y"]) < dz)


def circumradius(a: Column, b: Column, c: Column) -> Column:
    """Of an XY triangle; infinite where the squared area is at most 1e-14."""
    side = lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"])
    area = F.abs(_cross(a, b, c["x"], c["y"])) / 2
    return F.when(area * area <= 1e-14, float("inf")).otherwise(side(a, b) * side(b, c) * side(c, a) / (4 * area))
