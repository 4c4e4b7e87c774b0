"""Colour expressions; r, g, b in 0..1 unless said otherwise."""

from __future__ import annotations

import colorsys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Upper bounds of hue names, in degrees: fixed values.
HUES = [(15, "Red"), (40, "Orange"), (70, "Yellow"), (160, "Green"), (200, "Cyan"), (260, "Blue"), (290, "Purple"), (335, "Pink")]


def hsv(r: Column, g: Column, b: Column) -> Column:
    """struct<h (0..360), s, v>; grey has hue 0; on ties red comes before green before blue."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    d = top - low
    h = F.when(d <= 1e-10, 0.0).when(top == r, F.pmod((g - b) / d, F.lit(6.0))).when(top == g, (b - r) / d + 2).otherwise((r - g) / d + 4) * 60
    return F.struct(h.alias("h"), F.when(top > 1e-10, d / top).otherwise(0.0).alias("s"), top.alias("v"))


def to_8bit(v: Column) -> Column:
    """16-bit channel to 8 bits."""
    return F.least(F.floor(v / 256), F.lit(255)).cast("int")


def normalised(points: DataFrame, channels: tuple[str, ...] = ("red", "green", "blue")) -> DataFrame:
    """Channels to 0..1: of 16 bits if any value of any channel exceeds 255, else of 8. One row of bounds goes to all."""
    top = points.agg(F.max(F.greatest(*channels)).alias("_top"))
    scale = F.when(F.col("_top") > 255, 65535.0).otherwise(255.0)
    return points.join(F.broadcast(top)).withColumns({c: F.col(c) / scale for c in channels}).drop("_top")


def class_color(code: Column, colors: dict[int, tuple[float, float, float]]) -> Column:
    """struct<red, green, blue> (0..1) of a class; dark grey for one that has no colour."""
    one = lambda rgb: F.struct(*(F.lit(float(v)).alias(c) for v, c in zip(rgb, ("red", "green", "blue"), strict=True)))
    out = None
    for k, rgb in colors.items():
        out = F.when(code == k, one(rgb)) if out is None else out.when(code == k, one(rgb))
    return one((0.2, 0.2, 0.2)) if out is None else out.otherwise(one((0.2, 0.2, 0.2)))


def color_clusters(points: DataFrame) -> DataFrame:
    """Distinct 16-bit colours: red, green, blue, n, their 8-bit values, and a readable name; colours of one name are numbered by
    size, ties by colour."""
    t = points.groupBy("red", "green", "blue").agg(F.count("*").alias("n"))
    t = t.withColumns({f"{c}8": to_8bit(F.col(c)) for c in ("red", "green", "blue")})
    t = t.withColumn("base", color_name(hsv(*(F.col(f"{c}8") / 255 for c in ("red", "green", "blue")))))
    same = Window.partitionBy("base")
    number = F.row_number().over(same.orderBy(F.desc("n"), "red", "green", "blue"))
    return t.withColumn("name", F.concat("base", F.when(F.count("*").over(same) > 1, F.concat(F.lit(" #"), number.cast("string"))).otherwise(""))).drop("base")


def labelled(points: DataFrame, labels: DataFrame, other: int = 0, most: int = 100_000) -> DataFrame:
    """points with the class that labels(red, green, blue, class) give their colour; other where they give none."""
    labels = F.broadcast(labels) if labels.limit(most + 1).count() <= most else labels
    return points.join(labels.dropDuplicates(["red", "green", "blue"]), ["red", "green", "blue"], "left").withColumn("classification", F.coalesce("class", F.lit(other))).drop("class")


def palette(n: int, s: float = 0.85, v: float = 0.95) -> list[tuple[int, int, int]]:
    """n colours of equally spaced hues, channels truncated to 0..255."""
    return [tuple(int(c * 255) for c in colorsys.hsv_to_rgb(k / n, s, v)) for k in range(n)]


def hue_name(h: Column) -> Column:
    out = None
    for bound, name in HUES:
        out = F.when(h < bound, name) if out is None else out.when(h < bound, name)
    return out.otherwise("Red")


def color_name(c: Column) -> Column:
    """A readable name of a struct<h,s,v>: greys by value, hues with a word for brightness (bright colours of little saturation are
    light)."""
    h, s, v = c["h"], c["s"], c["v"]
    grey = F.when(v < 0.25, "Black").when(v < 0.55, "Dark Gray").when(v < 0.80, "Light Gray").otherwise("White")
    word = F.when(v < 0.35, "Dark ").when((v > 0.8) & (s < 0.5), "Light ").when(v > 0.8, "Bright ").otherwise("")
    return F.when(s < 0.12, grey).otherwise(F.concat(word, hue_name(h)))
