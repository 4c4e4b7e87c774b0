"""Whole runs over tables: cloud classification, and openings of a model's walls. Every step is a table of the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clouds, clustering, models, spatial, walls


@dataclass(frozen=True)
class Config:
    """Parameters of a run, with the defaults of the interactive tools that it replaces."""

    voxel: float = 0.05
    normal_threshold: float = 5.0
    distance_threshold: float = 2.0
    ground_tolerance: float = 0.5
    ground_cell: float = 2.0
    neighbours: int = 20
    outlier_ratio: float = 2.0
    window_eps: float = 0.5
    door_eps: float = 0.3
    least_points: int = 10
    polygon_cell: float = 10.0


def downsample(points: DataFrame, config: Config) -> DataFrame:
    """Voxel centroids that carry the class of their nearest source point."""
    v = clouds.voxel_downsample(points, config.voxel).withColumn("pid", F.struct("i", "j", "k"))
    near = spatial.nearest(v, points, 1, 2 * config.voxel).select(F.col("qid").alias("pid"), F.col("pid").alias("source"))
    return v.join(near, "pid").join(points.select(F.col("pid").alias("source"), "classification"), "source").select("pid", "x", "y", "z", "n", "classification")


def classify(points: DataFrame, config: Config) -> DataFrame:
    """Noise 7 by distance to neighbours; ground 2, low vegetation 3 by height; above that buildings 6 on planes, else 5."""
    near = spatial.nearest(points, points, config.neighbours, config.ground_cell / 4, same=True)
    flags = clouds.outliers(near, config.outlier_ratio).select("pid", "outlier")
    clean = points.join(flags, "pid", "left").withColumn("outlier", F.coalesce("outlier", F.lit(False)))
    banded = clouds.above_ground(clean.filter("NOT outlier"), config.ground_cell)
    planes = clustering.ransac_planes(banded.filter("band = 5").select("pid", "x", "y", "z")).select("pid", "plane")
    code = F.when(F.col("band") < 5, F.col("band")).when(F.col("plane") >= 0, 6).otherwise(5)
    done = banded.join(planes, "pid", "left").withColumn("classification", code.cast("short"))
    keep = ["pid", "x", "y", "z", "classification"]
    return done.select(*keep).unionByName(clean.filter("outlier").withColumn("classification", F.lit(7).cast("short")).select(*keep))


def openings(points: DataFrame, wall: DataFrame, feature_type: str, config: Config, iou: float = 0.0) -> DataFrame:
    """Feature points to openings: density clusters, their best walls, rectangles on those, the largest of overlapping ones."""
    eps = config.window_eps if feature_type == "Window" else config.door_eps
    labels = clustering.dbscan(points, eps, config.least_points).filter("label >= 0").withColumnRenamed("label", "cluster_id")
    c = points.join(labels, "pid")
    shape = c.groupBy("cluster_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("z").alias("z_lo"), F.max("z").alias("z_hi"))
    plain = wall.drop("ring")
    best = walls.match_clusters(shape, plain).select("cluster_id", "idx")
    found = walls.project_openings(c.join(best, "cluster_id").join(spatial.small(plain), "idx")).withColumnRenamed("cluster_id", "opening_id")
    kept = models.keep_largest_openings(found, ["idx"], iou)
    return models.opening_features(kept.join(spatial.small(wall.select("model_id", "idx", "nx", "ny", "wall_d")), "idx").withColumn("feature_type", F.lit(feature_type)))
