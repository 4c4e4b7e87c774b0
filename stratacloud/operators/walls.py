"""Matching points and clusters to walls: wall(idx, nx, ny, ox, oy, wall_d, z_min, z_max, x_min, x_max, y_min, y_max)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .durable import cut
from .spatial import small


def signed_distance() -> Column:
    return (F.col("x") - F.col("ox")) * F.col("nx") + (F.col("y") - F.col("oy")) * F.col("ny")


def _cells(walls: DataFrame, size: float, pad: float) -> DataFrame:
    for a in "xy":
        low, high = F.floor((F.col(f"{a}_min") - pad) / size).cast("long"), F.floor((F.col(f"{a}_max") + pad) / size).cast("long")
        walls = walls.withColumn(f"c_{a}", F.explode(F.sequence(low, high)))
    return walls


def assign_nearest(points: DataFrame, walls: DataFrame, tolerance: float = 2.0, least_points: int = 5, size: float = 10.0) -> DataFrame:
    """Points to the wall of least absolute distance among those whose box, padded by the tolerance, holds them (distance at most
    the tolerance, ties by idx); walls with fewer than least_points are left out. pid, idx, d."""
    here = points.withColumns({f"c_{a}": F.floor(F.col(a) / size).cast("long") for a in "xy"})
    j = here.join(small(_cells(walls, size, tolerance)), ["c_x", "c_y"]).withColumn("d", signed_distance())
    box = F.col("x").between(F.col("x_min") - tolerance, F.col("x_max") + tolerance) & F.col("y").between(F.col("y_min") - tolerance, F.col("y_max") + tolerance) & F.col("z").between(F.col("z_min") - tolerance, F.col("z_max") + tolerance)
    best = j.filter(box & (F.abs("d") <= tolerance)).groupBy("pid").agg(F.min_by(F.struct("idx", "d"), F.struct(F.abs("d"), F.col("idx"))).alias("b"))
    best = best.select("pid", "b.idx", "b.d")
    enough = best.groupBy("idx").count().filter(F.col("count") >= least_points).select("idx")
    return best.join(enough, "idx", "left_semi")


def match_clusters(
    clusters: DataFrame, walls: DataFrame, tolerance: float = 2.0, z_expand: float = 0.5, many: bool = False, inward: float | None = None, pad: float | None = None,
    z_always: bool = False, last: str = "plane", size: float = 10.0,
) -> DataFrame:
    """clusters(cluster_id, x, y, z_lo, z_hi: centre and heights) to their walls: cluster_id, idx, stage, d.

    Stage 1: at most the tolerance in front of the wall's plane and inward behind it (the tolerance, if not given), over the wall's
    box padded by pad (the tolerance, if not given), heights overlapping. Stage 2: the same without heights. Stage 3, by last:
    "plane" the wall of nearest plane, "centroid" that of nearest centre among those with the depth of stage 1, and no stage 2,
    None no wall. With z_always heights must overlap in every stage. The best of the first stage that has one; with many, every
    match of stage 1. Stages 1 and 2 meet in grid cells; stage 3 compares the clusters left over with all walls (of their model_id,
    where both have it), in slices of clusters."""
    inward, pad = tolerance if inward is None else inward, tolerance if pad is None else pad
    keys = ["model_id"] if "model_id" in clusters.columns and "model_id" in walls.columns else []
    deep = (F.col("d") < tolerance) & (F.col("d") > -inward)
    high = (F.col("z_hi") >= F.col("z_min") - z_expand) & (F.col("z_lo") <= F.col("z_max") + z_expand)
    # over the wall is the centre itself, or what the plane's depth leaves of it where that may be large
    over = lambda a, n: F.col(a) - (F.col("d") * F.col(n) if last == "centroid" else 0)
    above = over("x", "nx").between(F.col("x_min") - pad, F.col("x_max") + pad) & over("y", "ny").between(F.col("y_min") - pad, F.col("y_max") + pad)
    reach = pad + (max(tolerance, inward) if last == "centroid" else 0.0)
    here = clusters.withColumns({f"c_{a}": F.floor(F.col(a) / size).cast("long") for a in "xy"})
    j = here.join(small(_cells(walls, size, reach)), [*keys, "c_x", "c_y"]).withColumn("d", signed_distance()).filter(deep & above)
    j = j.withColumn("stage", F.when(high, 1).otherwise(2))
    if z_always or last == "centroid":
        j = j.filter("stage = 1")
    order = Window.partitionBy(*keys, "cluster_id").orderBy("stage", F.abs("d"), "idx")
    first = j.withColumn("rank", F.row_number().over(order))
    kept = first.filter((F.col("rank") == 1) | (F.col("stage") == 1)) if many else first.filter("rank = 1")
    out = kept.select(*keys, "cluster_id", "idx", "stage", "d")
    if last is None:
        return out
    out = cut(out)
    slices = clusters.sparkSession.sparkContext.defaultParallelism
    slot = F.pmod(F.xxhash64("cluster_id"), F.lit(slices)).cast("int")
    rest = clusters.join(out.select(*keys, "cluster_id").distinct(), [*keys, "cluster_id"], "left_anti").withColumn("slot", slot)
    every = walls.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    j = rest.join(small(every), [*keys, "slot"]).withColumn("d", signed_distance())
    if z_always:
        j = j.filter(high)
    if last == "centroid":
        j = j.filter(deep)
    far = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")) if last == "centroid" else F.abs("d")
    best = j.groupBy(*keys, "cluster_id").agg(F.min_by(F.struct("idx", "d"), F.struct(far, F.col("idx"))).alias("b"))
    return out.unionByName(best.select(*keys, "cluster_id", "b.idx", F.lit(3).alias("stage"), "b.d"))


def interior_points(points: DataFrame, outward: float = 0.1, inward: float = 10.0) -> DataFrame:
    """Points with their wall's nx, ny, ox, oy that lie no more than outward in front of it and inward behind it."""
    return points.withColumn("d", signed_distance()).filter(F.col("d").between(-inward, outward))


def passing_clusters(points: DataFrame, least: int = 10, share: float = 0.10, extent: float = 0.01) -> DataFrame:
    """points(cluster_id, x, y, z, interior): clusters with enough interior points, as a number and as a share, and none of whose
    interior extents vanishes: cluster_id, n, n_interior."""
    size = lambda c: F.max(F.when(F.col("interior"), F.col(c))) - F.min(F.when(F.col("interior"), F.col(c)))
    c = points.groupBy("cluster_id").agg(F.count("*").alias("n"), F.count_if("interior").alias("n_interior"), *(size(c).alias(f"_{c}") for c in "xyz"))
    ok = (F.col("n_interior") >= least) & (F.col("n_interior") >= share * F.col("n")) & (F.greatest("_x", "_y") >= extent) & (F.col("_z") >= extent)
    return c.filter(ok).drop("_x", "_y", "_z")


def split_by_wall(points: DataFrame, walls: DataFrame) -> DataFrame:
    """Each point's wall of nearest plane, without any bound: pid, idx, d. Walls are a model's."""
    p = points.withColumnsRenamed({"pid": "cluster_id"}).select("cluster_id", "x", "y", F.col("z").alias("z_lo"), F.col("z").alias("z_hi"))
    return match_clusters(p, walls, tolerance=0.0, last="plane").select(F.col("cluster_id").alias("pid"), "idx", "d")


def overlapping(boxes: DataFrame, walls: DataFrame, cosine: float = 0.80, depth: float = 0.30, slack: float = 0.05) -> DataFrame:
    """boxes(box_id, nx, ny, wall_d, tx, ty, t_min, t_max, z_lo, z_hi) with the walls that face alike, lie as deep and overlap:
    box_id, idx. Keyed by rounded depth, so that no pair outside the depth tolerance is made."""
    b = boxes.select("box_id", *(F.col(c).alias(f"b_{c}") for c in ("nx", "ny", "wall_d", "tx", "ty", "t_min", "t_max", "z_lo", "z_hi")))
    b = b.withColumn("key", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.col("b_wall_d") / depth).cast("long") + k)))
    j = walls.withColumn("key", F.floor(F.col("wall_d") / depth).cast("long")).join(b, "key")
    t = [F.col(f"{x}") * F.col("b_tx") + F.col(f"{y}") * F.col("b_ty") for x, y in (("x_min", "y_min"), ("x_max", "y_max"))]
    low, high = F.least(*t), F.greatest(*t)
    ok = (F.col("nx") * F.col("b_nx") + F.col("ny") * F.col("b_ny") >= cosine) & (F.abs(F.col("wall_d") - F.col("b_wall_d")) <= depth)
    ok &= (F.col("z_max") >= F.col("b_z_lo") - slack) & (F.col("z_min") <= F.col("b_z_hi") + slack) & (high >= F.col("b_t_min") - slack) & (low <= F.col("b_t_max") + slack)
    return j.filter(ok).select("box_id", "idx")


def nearest_by_heading(walls: DataFrame, mx: Column, my: Column, bin_degrees: float = 10.0, margin: float = 2.0) -> DataFrame:
    """Walls whose distance from (mx, my) is within a margin of the least in their heading bin."""
    heading = F.bround(F.degrees(F.atan2("ny", "nx")) / bin_degrees, 0) * bin_degrees
    d = F.abs((mx - F.col("ox")) * F.col("nx") + (my - F.col("oy")) * F.col("ny"))
    w = walls.withColumn("heading", heading + 0.0).withColumn("distance", d)
    return w.withColumn("least", F.min("distance").over(Window.partitionBy("heading"))).filter(F.col("distance") <= F.col("least") + margin).drop("least")


def project_openings(matched: DataFrame) -> DataFrame:
    """Points with a cluster and its wall's columns: cluster_id, idx, the cluster's rectangle (t, z) cut to the wall's; none for an
    empty one."""
    length = F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny"))
    tx, ty = -F.col("ny") / length, F.col("nx") / length
    t = F.col("x") * tx + F.col("y") * ty
    ends = [F.col(f"x_{k}") * tx + F.col(f"y_{k}") * ty for k in ("min", "max")]
    out = matched.groupBy("cluster_id", "idx").agg(
        F.greatest(F.min(t), F.min(F.least(*ends))).alias("t0"), F.least(F.max(t), F.max(F.greatest(*ends))).alias("t1"),
        F.greatest(F.min("z"), F.min("z_min")).alias("z0"), F.least(F.max("z"), F.max("z_max")).alias("z1"),
    )
    return out.filter("t1 > t0 AND z1 > z0")
