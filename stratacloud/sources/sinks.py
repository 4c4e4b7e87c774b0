"""Writers: partitioned point tables, model documents as text, reports. Each is a DataFrame write, so a lost task is redone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import cityjson_document, gml_surface


def write_points_by_class(points: DataFrame, folder: str, name: str = "classification") -> None:
    """One folder a class; rows are dealt by ranges of class and point, so that a class has files in proportion to its points."""
    points.repartitionByRange(F.col(name), F.xxhash64("pid")).write.mode("overwrite").partitionBy(name).parquet(folder)


def write_conflicts(conflicts: DataFrame, folder: str) -> None:
    """Wall conflict probabilities as CSV with four decimals."""
    conflicts.withColumn("probability", F.format_string("%.4f", "probability")).write.mode("overwrite").option("header", True).csv(folder)


def write_summary(counts: DataFrame, folder: str) -> None:
    counts.write.mode("overwrite").json(folder)


def write_report(rows: DataFrame, folder: str) -> None:
    """A text report: a line for each row, name=value parts of all its columns."""
    line = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in rows.columns))
    rows.select(line.alias("value")).write.mode("overwrite").text(folder)


def write_cityjson(rings: DataFrame, folder: str, scale: float = 0.001) -> None:
    """One compact document per model, one line each."""
    cityjson_document(rings, scale).select("value").write.mode("overwrite").text(folder)


def gml_documents(rings: DataFrame) -> DataFrame:
    """rings(model_id, obj_id, sem_type, poly_idx, ring_idx, ring) to (model_id, value): a building per object, a surface per
    polygon with its holes."""
    key = ["model_id", "obj_id", "sem_type", "poly_idx"]
    p = rings.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("ring_idx", "ring"))), lambda r: r["ring"]).alias("rings"))
    name = F.translate(F.concat_ws("_", "obj_id", F.col("poly_idx").cast("string")), " :/", "___")
    s = p.withColumn("text", F.concat(F.lit("<bldg:boundedBy>"), gml_surface(F.col("sem_type"), name, F.col("rings")), F.lit("</bldg:boundedBy>")))
    b = s.groupBy("model_id", "obj_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("poly_idx", "text"))), lambda t: t["text"]), "").alias("body"))
    b = b.withColumn("text", F.concat(F.lit('<core:cityObjectMember><bldg:Building gml:id="'), F.translate("obj_id", " :/", "___"), F.lit('">'), F.col("body"), F.lit("</bldg:Building></core:cityObjectMember>")))
    head = '<core:CityModel xmlns:core="http://www.opengis.net/citygml/2.0" xmlns:bldg="http://www.opengis.net/citygml/building/2.0" xmlns:gml="http://www.opengis.net/gml">'
    return b.groupBy("model_id").agg(F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("obj_id", "text"))), lambda t: t["text"]), ""), F.lit("</core:CityModel>")).alias("value"))


def geojson_features(rings: DataFrame, key: str) -> DataFrame:
    """rings(key, ring) to (value): one feature a line, closed outlines."""
    outline = F.transform(F.concat("ring", F.slice("ring", 1, 1)), lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(outline).alias("coordinates"))
    return rings.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col(key).cast("string").alias("id")).alias("properties"), geometry.alias("geometry"))).alias("value"))


def merge_models(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ring tables of two sets of models, objects of b renamed where a model of a has the id."""
    taken = a.select("model_id", "obj_id").distinct().withColumn("taken", F.lit(True))
    renamed = b.join(taken, ["model_id", "obj_id"], "left").withColumn("obj_id", F.when(F.col("taken"), F.concat("obj_id", F.lit("_2"))).otherwise(F.col("obj_id"))).drop("taken")
    return a.unionByName(renamed)


def filter_lods(rings: DataFrame, lods: list[float]) -> DataFrame:
    return rings.filter(F.col("lod").isin(lods))


def change_height(rings: DataFrame, by: float) -> DataFrame:
    return rings.withColumn("ring", F.transform("ring", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["z"] + by).alias("z"))))


def subset_models(rings: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Objects of which all vertices lie in the box."""
    inside = F.forall("ring", lambda p: p["x"].between(x0, x1) & p["y"].between(y0, y1))
    keep = rings.groupBy("model_id", "obj_id").agg(F.bool_and(inside).alias("all")).filter("all").drop("all")
    return rings.join(keep, ["model_id", "obj_id"], "left_semi")
