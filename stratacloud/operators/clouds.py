"""Operators on point clouds: point(pid, x, y, z, ...). All are expressions and partial aggregates; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def voxels(size: float, origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> list[Column]:
    return [F.floor((F.col(a) - F.lit(o)) / F.lit(float(size))).cast("long").alias(k) for a, o, k in zip("xyz", origin, "ijk", strict=True)]


def voxel_downsample(points: DataFrame, size: float, origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Centroid and number of points of each voxel."""
    return points.groupBy(*voxels(size, origin)).agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"))


def grid_subsample(points: DataFrame, size: float, label: str = "classification") -> DataFrame:
    """Mean position and the label of the point of largest pid per voxel."""
    return points.groupBy(*voxels(size)).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"), F.max_by(label, "pid").alias(label))


def majority_class(points: DataFrame, size: float, label: str = "classification") -> DataFrame:
    """The most frequent class of each voxel, the smallest of equals."""
    counts = points.groupBy(*voxels(size), label).agg(F.count("*").alias("n"))
    return counts.groupBy("i", "j", "k").agg(F.sum("n").alias("n"), F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias(label))


def grid_min_z(points: DataFrame, size: float = 2.0) -> DataFrame:
    return points.groupBy(F.floor(F.col("x") / size).cast("long").alias("i"), F.floor(F.col("y") / size).cast("long").alias("j")).agg(F.min("z").alias("ground"))


def height_bands(height: Column) -> Column:
    """2 ground below 0.3, 3 low vegetation below 2, else 5."""
    return F.when(height < 0.3, 2).when(height < 2.0, 3).otherwise(5)


def above_ground(points: DataFrame, size: float = 2.0) -> DataFrame:
    """points with height over their cell's lowest point, and its band."""
    ground = grid_min_z(points, size)
    p = points.withColumns({"i": F.floor(F.col("x") / size).cast("long"), "j": F.floor(F.col("y") / size).cast("long")})
    return p.join(ground, ["i", "j"]).withColumn("height", F.col("z") - F.col("ground")).withColumn("band", height_bands(F.col("height"))).drop("i", "j")


def extent(points: DataFrame) -> DataFrame:
    """Bounds, area in XY and points per area (0 for none)."""
    b = points.agg(F.count("*").alias("n"), *(f(a).alias(f"{a}_{n}") for a in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))))
    area = (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min"))
    return b.withColumn("area", area).withColumn("density", F.when(area > 0, F.col("n") / area).otherwise(0.0))


def outliers(neighbours: DataFrame, ratio: float = 2.0) -> DataFrame:
    """neighbours(qid, d2) of k nearest: pid, mean_distance, outlier (over the mean of means plus ratio standard deviations)."""
    means = neighbours.groupBy(F.col("qid").alias("pid")).agg(F.avg(F.sqrt("d2")).alias("mean_distance"))
    limit = means.agg((F.avg("mean_distance") + ratio * F.stddev_samp("mean_distance")).alias("limit"))
    return means.join(F.broadcast(limit)).withColumn("outlier", F.col("mean_distance") > F.col("limit")).drop("limit")


def depth_buffer(points: DataFrame, u: Column, v: Column, depth: Column, payload: list[str]) -> DataFrame:
    """Per pixel the point of least depth, ties by pid."""
    p = points.withColumns({"u": u.cast("long"), "v": v.cast("long"), "depth": depth})
    return p.groupBy("u", "v").agg(F.min_by(F.struct("pid", "depth", *payload), F.struct("depth", "pid")).alias("p")).select("u", "v", "p.*")


def merge_clouds(clouds: DataFrame, color: tuple[str, ...] = ("red", "green", "blue")) -> DataFrame:
    """Union of all clouds of a group; colours become null for all if any cloud of the group lacks them."""
    has = F.bool_and(F.col(color[0]).isNotNull()).over(Window.partitionBy("group_id"))
    return clouds.withColumn("has_color", has).withColumns({c: F.when(F.col("has_color"), F.col(c)) for c in color}).drop("has_color")


def segment_key(planes: list[tuple[float, float, float]]) -> Column:
    """Signs of a point against vertical planes (nx, ny, d) as a string of + and -."""
    return F.concat(*(F.when(F.col("x") * nx + F.col("y") * ny - d >= 0, "+").otherwise("-") for nx, ny, d in planes))


def slabs(points: DataFrame, t: Column, n: int, key: list[str]) -> DataFrame:
    """Equal-width slabs along t within each key, the last one closed."""
    w = Window.partitionBy(*key)
    p = points.withColumn("t", t)
    low, high = F.min("t").over(w), F.max("t").over(w)
    at = F.when(high > low, F.least(F.floor((F.col("t") - low) / ((high - low) / n)), F.lit(n - 1))).otherwise(0)
    return p.withColumn("slab", at.cast("int"))


def seeded_sample(points: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n points that a hash of pid and seed chooses; the same whatever the partitioning."""
    return points.orderBy(F.xxhash64(F.lit(seed), "pid"), "pid").limit(n)


def every_fraction(points: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return points.filter(F.pmod(F.xxhash64(F.lit(seed), "pid"), F.lit(1 << 30)) < int(fraction * (1 << 30)))


def gps_origins(points: DataFrame, width: float = 0.5) -> DataFrame:
    """Sensor origin of each time bin: mean x, y and least z minus 1.5."""
    return points.groupBy(F.floor(F.col("gps_time") / width).cast("long").alias("bin")).agg(F.avg("x").alias("ox"), F.avg("y").alias("oy"), (F.min("z") - 1.5).alias("oz"), F.count("*").alias("n"))


def ray_voxels(rays: DataFrame, size: float, most_steps: int = 200) -> DataFrame:
    """rays(ox, oy, oz, x, y, z): voxels walked through (state 1) and hit (state 2); the larger state wins. i, j, k, state."""
    g = lambda c: F.floor(F.col(c) / size)
    r = rays.select(*(g(o).alias(f"a_{c}") for o, c in (("ox", "x"), ("oy", "y"), ("oz", "z"))), *(g(c).alias(f"b_{c}") for c in "xyz"))
    r = r.withColumn("steps", F.greatest(*(F.abs(F.col(f"b_{c}") - F.col(f"a_{c}")) for c in "xyz")))
    walk = F.when(F.col("steps") > 1, F.sequence(F.lit(1), (F.least(F.col("steps"), F.lit(most_steps)) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    along = lambda c: F.floor(F.col(f"a_{c}") + (F.col(f"b_{c}") - F.col(f"a_{c}")) * F.col("s") / F.col("steps") + 0.5).cast("long")
    empty = r.withColumn("s", F.explode(walk)).select(*(along(c).alias(k) for c, k in zip("xyz", "ijk", strict=True)), F.lit(1).alias("state"))
    hit = r.select(*(F.col(f"b_{c}").cast("long").alias(k) for c, k in zip("xyz", "ijk", strict=True)), F.lit(2).alias("state"))
    return empty.unionByName(hit).groupBy("i", "j", "k").agg(F.max("state").alias("state"))


def conflict_probability(states: DataFrame, key: str) -> DataFrame:
    """Share of walked-through voxels among the known ones of each wall; over 0.5 is a conflict."""
    empty, hit = F.count_if(F.col("state") == 1), F.count_if(F.col("state") == 2)
    return states.groupBy(key).agg(F.when(empty + hit > 0, empty / (empty + hit)).otherwise(0.0).alias("probability")).withColumn("conflict", F.col("probability") > 0.5)
