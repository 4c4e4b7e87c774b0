"""Equirectangular panoramas and cube faces as pixel tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Direction of a face's pixel (a to the right, b down, both -1..1): fixed values.
FACES = {
    "front": ("1", "a", "-b"), "back": ("-1", "-a", "-b"), "right": ("-a", "1", "-b"), "left": ("a", "-1", "-b"), "up": ("b", "a", "1"), "down": ("-b", "a", "-1"),
}


def face_pixels(spark: SparkSession, size: int) -> DataFrame:
    """face, row, col and the direction x, y, z through each pixel's centre."""
    p = spark.range(size * size).select((F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"))
    p = p.withColumns({"a": (F.col("col") + 0.5) * (2.0 / size) - 1, "b": (F.col("row") + 0.5) * (2.0 / size) - 1})
    faces = F.explode(F.array(*(F.struct(F.lit(n).alias("face"), *(F.expr(f"cast({e} as double)").alias(c) for e, c in zip(d, "xyz", strict=True))) for n, d in FACES.items())))
    return p.withColumn("f", faces).select("f.face", "row", "col", "f.x", "f.y", "f.z")


def rotate(pixels: DataFrame, yaw: float = 0.0, pitch: float = 0.0, roll: float = 0.0) -> DataFrame:
    """Directions turned by roll about x, pitch about y, yaw about z, in degrees."""
    for angle, (u, v) in ((roll, ("y", "z")), (pitch, ("z", "x")), (yaw, ("x", "y"))):
        c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
        a, b = F.col(u), F.col(v)
        pixels = pixels.withColumns({u: a * c - b * s, v: a * s + b * c})
    return pixels


def panorama_pixel(width: int, height: int) -> tuple[Column, Column]:
    """Column and row of the panorama that a direction x, y, z looks at."""
    lon = F.atan2("y", "x")
    lat = F.atan2(F.col("z"), F.hypot("x", "y"))
    u = F.pmod(F.floor((lon / (2 * math.pi) + 0.5) * width), F.lit(width))
    v = F.least(F.greatest(F.floor((0.5 - lat / math.pi) * height), F.lit(0)), F.lit(height - 1))
    return u.cast("int"), v.cast("int")


def grid_coordinates(spark: SparkSession, south: float, west: float, north: float, east: float, spacing: float) -> DataFrame:
    """lat, lng every so many metres; a degree is 111139 m, narrowed by the mean latitude's cosine for longitude."""
    per = 111139.0
    dlat, dlng = spacing / per, spacing / (per * math.cos(math.radians((south + north) / 2)))
    rows, cols = int((north - south) / dlat + 1e-9) + 1, int((east - west) / dlng + 1e-9) + 1
    return spark.range(rows * cols).select((F.lit(south) + F.floor(F.col("id") / cols) * dlat).alias("lat"), (F.lit(west) + F.col("id") % cols * dlng).alias("lng"))


def resampled(faces: DataFrame, pixels: DataFrame, width: int, height: int) -> DataFrame:
    """faces (face_pixels, turned or not) with the colours of the panorama pixels(u, v, red, green, blue) that they look at."""
    u, v = panorama_pixel(width, height)
    return faces.withColumns({"u": u, "v": v}).join(pixels, ["u", "v"]).select("face", "row", "col", "red", "green", "blue")


def panorama_source(spark: SparkSession, width: int, height: int, size: int) -> DataFrame:
    """The inverse: each pixel u, v of a panorama with the face, row and col of a cube of that size which it is taken from."""
    p = spark.range(width * height).select((F.col("id") % width).cast("int").alias("u"), (F.col("id") / width).cast("int").alias("v"))
    lon, lat = ((F.col("u") + 0.5) / width - 0.5) * (2 * math.pi), (0.5 - (F.col("v") + 0.5) / height) * math.pi
    x, y, z = F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)
    p = p.withColumns({"x": x, "y": y, "z": z})
    # of the face that the direction leaves through, a and b follow from its own formulas
    ax, ay, az = (F.abs(c) for c in "xyz")
    face = F.when((ax >= ay) & (ax >= az), F.when(F.col("x") > 0, "front").otherwise("back")).when(ay >= az, F.when(F.col("y") > 0, "right").otherwise("left")).otherwise(F.when(F.col("z") > 0, "up").otherwise("down"))
    p = p.withColumn("face", face).withColumn("m", F.greatest(ax, ay, az))
    a = F.when(F.col("face") == "front", F.col("y")).when(F.col("face") == "back", -F.col("y")).when(F.col("face") == "right", -F.col("x")).when(F.col("face") == "left", F.col("x")).otherwise(F.col("y"))
    b = F.when(F.col("face") == "up", F.col("x")).when(F.col("face") == "down", -F.col("x")).otherwise(-F.col("z"))
    at = lambda c: F.least(F.greatest(F.floor((c / F.col("m") + 1) / 2 * size), F.lit(0)), F.lit(size - 1)).cast("int")
    return p.select("u", "v", "face", at(b).alias("row"), at(a).alias("col"))
