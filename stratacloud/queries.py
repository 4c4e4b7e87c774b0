"""Named queries of the engine over the driver's tables, and the SQL that each agrees with.

Clouds, colours and walls are views of the tables: `cloud` is embeddings (first three components), `big` is lineitem, `rgb` is
part, `wall` gives every nation a box of four walls, `pts` is cloud in the walls' range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import color as C
from .functions import geometry as G
from .functions import text as X
from .operators import align, clouds, clustering, facades, meshes, models, panorama, selection, spatial, walls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

VIEWS = {
    "cloud": "SELECT vec_id AS pid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, label AS classification FROM embeddings",
    "pts": "SELECT pid, x * 100 AS x, y * 100 AS y, z * 10 AS z, classification FROM cloud",
    "big": "SELECT l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z, l_returnflag AS cls FROM lineitem",
    "rgb": "SELECT p_partkey AS pid, CAST(p_partkey * 37 % 256 AS INT) AS red, CAST(p_partkey * 91 % 256 AS INT) AS green, CAST(p_partkey * 13 % 256 AS INT) AS blue, p_size FROM part",
    "wall": """SELECT n_nationkey * 4 + side AS idx, nx, ny, 20.0 * (n_nationkey % 5) + 5.0 * nx AS ox, 20.0 * (n_nationkey // 5) + 5.0 * ny AS oy, 0.0 AS z_min, 3.0 + n_nationkey % 3 AS z_max
      FROM nation, (VALUES (0, 1.0, 0.0), (1, 0.0, 1.0), (2, -1.0, 0.0), (3, 0.0, -1.0)) s(side, nx, ny)""",
    "w": "SELECT *, ox * nx + oy * ny AS wall_d, ox - 5 * abs(ny) AS x_min, ox + 5 * abs(ny) AS x_max, oy - 5 * abs(nx) AS y_min, oy + 5 * abs(nx) AS y_max FROM wall",
    "corner": """SELECT idx, k, ox - ny * t AS x, oy + nx * t AS y, CASE WHEN top THEN z_max ELSE z_min END AS z
      FROM wall, (VALUES (0, -5.0, false), (1, 5.0, false), (2, 5.0, true), (3, -5.0, true)) c(k, t, top)""",
}
_NEEDS = {"pts": ["cloud"], "w": ["wall"], "corner": ["wall"]}


def _with(*views: str) -> str:
    names = list(dict.fromkeys(x for v in views for x in (*_NEEDS.get(v, []), v)))
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in names)


def query(*views: str, sql: str | None = None):
    """Register a query; its SQL may use the named views."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"{_with(*views)} {sql}" if views else sql
        return f

    return put


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cloud(spark: SparkSession, sf: str) -> DataFrame:
    e = lambda k: F.element_at("embedding", k).cast("double")
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("pid"), e(1).alias("x"), e(2).alias("y"), e(3).alias("z"), F.col("label").alias("classification"))


def pts(spark: SparkSession, sf: str) -> DataFrame:
    return cloud(spark, sf).withColumns({"x": F.col("x") * 100, "y": F.col("y") * 100, "z": F.col("z") * 10})


def big(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"), F.col("l_returnflag").alias("cls"))


def rgb(spark: SparkSession, sf: str) -> DataFrame:
    c = lambda k: (F.col("p_partkey") * k % 256).cast("int")
    return _table(spark, sf, "part").select(F.col("p_partkey").alias("pid"), c(37).alias("red"), c(91).alias("green"), c(13).alias("blue"), "p_size")


def wall(spark: SparkSession, sf: str) -> DataFrame:
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.lit(nx).alias("nx"), F.lit(ny).alias("ny")) for s, nx, ny in ((0, 1.0, 0.0), (1, 0.0, 1.0), (2, -1.0, 0.0), (3, 0.0, -1.0)))))
    n = _table(spark, sf, "nation").select("n_nationkey", sides.alias("s")).select("n_nationkey", "s.*")
    k = F.col("n_nationkey")
    w = n.select((k * 4 + F.col("side")).alias("idx"), "nx", "ny", (k % 5 * 20.0 + F.col("nx") * 5).alias("ox"), (F.floor(k / 5) * 20.0 + F.col("ny") * 5).alias("oy"), F.lit(0.0).alias("z_min"), (k % 3 + 3.0).alias("z_max"), k.alias("n_nationkey"))
    w = w.withColumns({"wall_d": F.col("ox") * F.col("nx") + F.col("oy") * F.col("ny"), **{f"{a}_{n}": F.col(f"o{a}") + s * 5 * F.abs(f"n{b}") for a, b in ("xy", "yx") for n, s in (("min", -1), ("max", 1))}})
    at = lambda t, z: F.struct((F.col("ox") - F.col("ny") * t).alias("x"), (F.col("oy") + F.col("nx") * t).alias("y"), F.col(z).alias("z"))
    return w.withColumn("ring", F.array(at(-5.0, "z_min"), at(5.0, "z_min"), at(5.0, "z_max"), at(-5.0, "z_max")))


def r6(c, name: str) -> Column:
    return (F.round(F.col(c) if isinstance(c, str) else c, 6) + 0.0).alias(name)


# --- clouds


@query("cloud", sql="SELECT CAST(floor(x / 0.2) AS BIGINT) AS i, CAST(floor(y / 0.2) AS BIGINT) AS j, CAST(floor(z / 0.2) AS BIGINT) AS k, count(*) AS n, round(avg(x), 6) + 0.0 AS cx, round(avg(y), 6) + 0.0 AS cy, round(avg(z), 6) + 0.0 AS cz FROM cloud GROUP BY 1, 2, 3")
def voxel_centroid(spark, sf):
    return clouds.voxel_downsample(cloud(spark, sf), 0.2).select("i", "j", "k", "n", r6("x", "cx"), r6("y", "cy"), r6("z", "cz"))


@query("cloud", sql="SELECT CAST(floor(x / 0.1) AS BIGINT) AS i, CAST(floor(y / 0.1) AS BIGINT) AS j, CAST(floor(z / 0.1) AS BIGINT) AS k, round(avg(x), 6) + 0.0 AS cx, round(avg(y), 6) + 0.0 AS cy, round(avg(z), 6) + 0.0 AS cz, arg_max(classification, pid) AS classification FROM cloud GROUP BY 1, 2, 3")
def grid_subsample(spark, sf):
    return clouds.grid_subsample(cloud(spark, sf), 0.1).select("i", "j", "k", r6("x", "cx"), r6("y", "cy"), r6("z", "cz"), "classification")


@query("cloud", sql=", c AS (SELECT CAST(floor(x / 0.2) AS BIGINT) AS i, CAST(floor(y / 0.2) AS BIGINT) AS j, CAST(floor(z / 0.2) AS BIGINT) AS k, classification, count(*) AS m FROM cloud GROUP BY ALL) SELECT i, j, k, CAST(sum(m) OVER (PARTITION BY i, j, k) AS BIGINT) AS n, classification FROM c QUALIFY row_number() OVER (PARTITION BY i, j, k ORDER BY m DESC, classification) = 1")
def voxel_majority_class(spark, sf):
    return clouds.majority_class(cloud(spark, sf), 0.2).select("i", "j", "k", "n", "classification")


@query("big", sql="SELECT CAST(floor(x / 2) AS BIGINT) AS i, CAST(floor(y / 2) AS BIGINT) AS j, min(z) AS ground FROM big GROUP BY 1, 2")
def grid_min_z(spark, sf):
    return clouds.grid_min_z(big(spark, sf), 2.0)


@query("big", sql=", g AS (SELECT *, z - min(z) OVER (PARTITION BY floor(x / 2), floor(y / 2)) AS h FROM big) SELECT CASE WHEN h < 0.3 THEN 2 WHEN h < 2 THEN 3 ELSE 5 END AS band, count(*) AS n, round(avg(h), 6) AS mean_height FROM g GROUP BY 1")
def height_above_ground_bands(spark, sf):
    return clouds.above_ground(big(spark, sf), 2.0).groupBy("band").agg(F.count("*").alias("n"), r6(F.avg("height"), "mean_height"))


@query("big", sql="SELECT cls, count(*) AS n FROM big GROUP BY 1")
def class_histogram(spark, sf):
    return big(spark, sf).groupBy("cls").agg(F.count("*").alias("n"))


@query("big", sql="SELECT count(*) AS n, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, min(z) AS z_min, max(z) AS z_max, round((max(x) - min(x)) * (max(y) - min(y)), 6) AS area, round(count(*) / ((max(x) - min(x)) * (max(y) - min(y))), 6) AS density FROM big")
def cloud_extent_density(spark, sf):
    return clouds.extent(big(spark, sf)).withColumns({"area": F.round("area", 6), "density": F.round("density", 6)})


@query("big", sql="SELECT cls, count(*) AS n, round(avg(z), 6) AS mean_z FROM big WHERE z BETWEEN 2 AND 7 GROUP BY 1")
def z_clip(spark, sf):
    return big(spark, sf).filter(F.col("z").between(2, 7)).groupBy("cls").agg(F.count("*").alias("n"), r6(F.avg("z"), "mean_z"))


@query("big", sql="SELECT median(x) AS mx, round(median(y), 6) AS my FROM big")
def cloud_median(spark, sf):
    return big(spark, sf).agg(F.median("x").alias("mx"), r6(F.median("y"), "my"))


@query("big", sql="SELECT CAST(floor(x / 5) AS BIGINT) AS i, CAST(floor(y / 5) AS BIGINT) AS j, round(median(z), 6) AS depth, count(*) AS n FROM big GROUP BY 1, 2")
def median_depth_grid(spark, sf):
    return big(spark, sf).groupBy(F.floor(F.col("x") / 5).alias("i"), F.floor(F.col("y") / 5).alias("j")).agg(r6(F.median("z"), "depth"), F.count("*").alias("n"))


@query("cloud", sql="SELECT CAST(floor(x / 0.05) AS BIGINT) AS u, CAST(floor(y / 0.05) AS BIGINT) AS v, arg_min(pid, {'a': z, 'b': pid}) AS pid, min(z) AS depth FROM cloud GROUP BY 1, 2")
def depth_buffer_min(spark, sf):
    return clouds.depth_buffer(cloud(spark, sf), F.floor(F.col("x") / 0.05), F.floor(F.col("y") / 0.05), F.col("z"), [])


@query("cloud", sql="SELECT concat(CASE WHEN x - 0.02 >= 0 THEN '+' ELSE '-' END, CASE WHEN y + 0.01 >= 0 THEN '+' ELSE '-' END, CASE WHEN x * 0.6 + y * 0.8 - 0.0 >= 0 THEN '+' ELSE '-' END) AS segment, count(*) AS n, min(pid) AS first_pid FROM cloud GROUP BY 1")
def halfspace_segments(spark, sf):
    key = clouds.segment_key([(1.0, 0.0, 0.02), (0.0, 1.0, -0.01), (0.6, 0.8, 0.0)])
    return cloud(spark, sf).groupBy(key.alias("segment")).agg(F.count("*").alias("n"), F.min("pid").alias("first_pid"))


@query("cloud", sql=", t AS (SELECT *, min(x) OVER (PARTITION BY classification) AS lo, max(x) OVER (PARTITION BY classification) AS hi FROM cloud) SELECT classification, CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / ((hi - lo) / 5)), 4) ELSE 0 END AS INT) AS slab, count(*) AS n, round(min(z), 6) + 0.0 AS z_min, round(max(z), 6) + 0.0 AS z_max FROM t GROUP BY 1, 2")
def curve_slabs(spark, sf):
    s = clouds.slabs(cloud(spark, sf), F.col("x"), 5, ["classification"])
    return s.groupBy("classification", "slab").agg(F.count("*").alias("n"), r6(F.min("z"), "z_min"), r6(F.max("z"), "z_max"))


@query("big", sql="SELECT CAST(floor(x) AS BIGINT) AS i, CAST(floor(y / 10) AS BIGINT) AS j, count(*) AS n FROM big GROUP BY 1, 2 ORDER BY n DESC, i, j LIMIT 20")
def topk_clusters(spark, sf):
    return big(spark, sf).groupBy(F.floor("x").alias("i"), F.floor(F.col("y") / 10).alias("j")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "i", "j").limit(20)


@query(sql="SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS bin, round(avg(user_id), 6) AS ox, round(avg(event_id), 6) AS oy, round(min(value) - 1.5, 6) AS oz, count(*) AS n FROM events GROUP BY 1")
def gps_bin_origins(spark, sf):
    e = _table(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("us"), F.col("user_id").alias("x"), F.col("event_id").alias("y"), F.col("value").alias("z"))
    o = clouds.gps_origins(e.withColumn("gps_time", F.col("us") / 1e6), 3600.0)
    return o.select("bin", r6("ox", "ox"), r6("oy", "oy"), r6("oz", "oz"), "n")


@query(sql="""WITH a AS (SELECT 'customer' AS src, c_nationkey % 5 AS group_id, CAST(c_custkey AS DOUBLE) AS x, c_nationkey AS red FROM customer UNION ALL SELECT 'supplier', s_nationkey, CAST(s_suppkey AS DOUBLE), CASE WHEN s_nationkey <> 3 THEN s_suppkey END FROM supplier WHERE s_nationkey < 4),
  h AS (SELECT group_id, bool_and(red IS NOT NULL) AS has FROM a GROUP BY 1) SELECT group_id, src, count(*) AS n, CAST(sum(x) AS BIGINT) AS sx, count(CASE WHEN has THEN red END) AS colored FROM a JOIN h USING (group_id) GROUP BY 1, 2""")
def merge_clouds_union(spark, sf):
    a = _table(spark, sf, "customer").select(F.lit("customer").alias("src"), (F.col("c_nationkey") % 5).alias("group_id"), F.col("c_custkey").cast("double").alias("x"), F.col("c_nationkey").alias("red"))
    b = _table(spark, sf, "supplier").filter("s_nationkey < 4").select(F.lit("supplier").alias("src"), F.col("s_nationkey").alias("group_id"), F.col("s_suppkey").cast("double").alias("x"), F.when(F.col("s_nationkey") != 3, F.col("s_suppkey")).alias("red"))
    return clouds.merge_clouds(a.unionByName(b), ("red",)).groupBy("group_id", "src").agg(F.count("*").alias("n"), F.sum("x").cast("bigint").alias("sx"), F.count("red").alias("colored"))


@query("cloud", sql="SELECT count(*) AS n, round(sum(x), 6) + 0.0 AS sx FROM cloud WHERE pid NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join_replaced(spark, sf):
    gone = _table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("pid"))
    return cloud(spark, sf).join(gone, "pid", "left_anti").agg(F.count("*").alias("n"), r6(F.sum("x"), "sx"))


# --- colours


@query("rgb", sql=""", t AS (SELECT pid, red / 255.0 AS r, green / 255.0 AS g, blue / 255.0 AS b FROM rgb), m AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM t)
  SELECT pid, round(60 * CASE WHEN d <= 1e-10 THEN 0 WHEN v = r THEN (g - b) / d - 6 * floor((g - b) / d / 6) WHEN v = g THEN (b - r) / d + 2 ELSE (r - g) / d + 4 END, 6) + 0.0 AS h, round(CASE WHEN v > 1e-10 THEN d / v ELSE 0 END, 6) AS s, round(v, 6) AS v FROM m""")
def rgb_to_hsv(spark, sf):
    return rgb(spark, sf).withColumn("c", C.hsv(F.col("red") / 255, F.col("green") / 255, F.col("blue") / 255)).select("pid", r6("c.h", "h"), r6("c.s", "s"), r6("c.v", "v"))


@query("rgb", sql=""", t AS (SELECT p_size % 5 AS cluster, red / 255.0 AS r, green / 255.0 AS g, blue / 255.0 AS b FROM rgb), m AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM t)
  SELECT cluster, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct, round(avg(CASE WHEN v > 1e-10 THEN d / v ELSE 0 END), 6) AS s, round(avg(v), 6) AS v FROM m GROUP BY 1""")
def hsv_cluster_stats(spark, sf):
    c = rgb(spark, sf).withColumn("c", C.hsv(F.col("red") / 255, F.col("green") / 255, F.col("blue") / 255)).groupBy((F.col("p_size") % 5).alias("cluster"))
    c = c.agg(F.count("*").alias("n"), r6(F.avg("c.s"), "s"), r6(F.avg("c.v"), "v"))
    return c.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


_NAMED = """, t AS (SELECT (red // 64) * 16384 AS r16, (green // 64) * 16384 AS g16, (blue // 64) * 16384 AS b16, count(*) AS n FROM rgb GROUP BY ALL),
  e AS (SELECT *, (r16 // 256) / 255.0 AS r, (g16 // 256) / 255.0 AS g, (b16 // 256) / 255.0 AS b FROM t),
  f AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM e),
  h AS (SELECT *, CASE WHEN v > 0 THEN d / v ELSE 0 END AS s, CASE WHEN d <= 1e-10 THEN 0.0 WHEN v = r THEN 60 * (((g - b) / d + 6) % 6) WHEN v = g THEN 60 * ((b - r) / d + 2) ELSE 60 * ((r - g) / d + 4) END AS h FROM f),
  k AS (SELECT *, CASE WHEN s < 0.12 THEN CASE WHEN v < 0.25 THEN 'Black' WHEN v < 0.55 THEN 'Dark Gray' WHEN v < 0.8 THEN 'Light Gray' ELSE 'White' END
    ELSE concat(CASE WHEN v < 0.35 THEN 'Dark ' WHEN v > 0.8 AND s < 0.5 THEN 'Light ' WHEN v > 0.8 THEN 'Bright ' ELSE '' END,
      CASE WHEN h < 15 THEN 'Red' WHEN h < 40 THEN 'Orange' WHEN h < 70 THEN 'Yellow' WHEN h < 160 THEN 'Green' WHEN h < 200 THEN 'Cyan' WHEN h < 260 THEN 'Blue' WHEN h < 290 THEN 'Purple' WHEN h < 335 THEN 'Pink' ELSE 'Red' END) END AS base FROM h)"""


@query("rgb", sql=_NAMED + " SELECT r16 AS red, g16 AS green, b16 AS blue, n, concat(base, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN ' #' || row_number() OVER (PARTITION BY base ORDER BY n DESC, r16, g16, b16) ELSE '' END) AS name FROM k")
def distinct_colors_named(spark, sf):
    q = {c: (F.floor(F.col(c) / 64) * 16384).cast("int") for c in ("red", "green", "blue")}
    return C.color_clusters(rgb(spark, sf).withColumns(q)).select("red", "green", "blue", "n", "name")


@query(sql="SELECT * FROM (VALUES (0, 242, 36, 36), (1, 201, 242, 36), (2, 36, 242, 118), (3, 36, 118, 242), (4, 201, 36, 242)) t(k, red, green, blue)")
def palette(spark, sf):
    return spark.createDataFrame([(k, *c) for k, c in enumerate(C.palette(5))], "k int, red int, green int, blue int")


# --- spatial joins

_AREAS = [("a", [(5.0, 5.0), (20.0, 5.0), (20.0, 30.0), (5.0, 30.0)]), ("b", [(15.0, 20.0), (40.0, 20.0), (40.0, 60.0), (15.0, 60.0)])]


def _areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, [(x, y, 0.0) for x, y in p]) for n, p in _AREAS], "polygon_id string, ring array<struct<x:double,y:double,z:double>>")


@query("big", sql="SELECT polygon_id, count(*) AS n, round(avg(z), 6) AS mean_z FROM big JOIN (VALUES ('a', 5.0, 20.0, 5.0, 30.0), ('b', 15.0, 40.0, 20.0, 60.0)) p(polygon_id, x0, x1, y0, y1) ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1")
def pip_reclassify(spark, sf):
    return spatial.points_in_polygons(big(spark, sf), _areas(spark), 10.0).groupBy("polygon_id").agg(F.count("*").alias("n"), r6(F.avg("z"), "mean_z"))


@query("big", sql="SELECT cls, round(avg(CASE WHEN x > 5 AND x < 20 AND y > 5 AND y < 30 THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM big GROUP BY 1")
def footprint_interior_fraction(spark, sf):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(0.0).alias("z")) for x, y in _AREAS[0][1]))
    return big(spark, sf).groupBy("cls").agg(r6(F.avg(G.in_polygon(F.col("x"), F.col("y"), ring, False).cast("double")), "fraction"))


_PAIRS = ", d AS (SELECT a.pid AS qid, b.pid AS pid, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2, b.classification FROM cloud a, cloud b)"


@query("cloud", sql=_PAIRS + " SELECT qid, pid, classification, round(sqrt(d2), 6) AS distance FROM d WHERE qid % 5 = 0 AND pid % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, pid) = 1")
def knn1_label_transfer(spark, sf):
    c = cloud(spark, sf)
    near = spatial.nearest(c.filter("pid % 5 = 0"), c.filter("pid % 5 <> 0"), 1, 0.1)
    return near.join(c.select("pid", "classification"), "pid").select("qid", "pid", "classification", r6(F.sqrt("d2"), "distance"))


@query("cloud", sql=_PAIRS + ", k AS (SELECT * FROM d WHERE qid <> pid QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, pid) <= 20) SELECT qid, count(*) AS n, round(avg(sqrt(d2)), 6) AS mean_distance, CAST(sum(pid) AS BIGINT) AS pids FROM k GROUP BY 1")
def knn_k20_curvature_input(spark, sf):
    c = cloud(spark, sf)
    return spatial.nearest(c, c, 20, 0.15, same=True).groupBy("qid").agg(F.count("*").alias("n"), r6(F.avg(F.sqrt("d2")), "mean_distance"), F.sum("pid").alias("pids"))


@query("cloud", sql=_PAIRS + " SELECT qid AS pid, count(*) AS n FROM d WHERE d2 <= 0.1 * 0.1 GROUP BY 1")
def radius_count(spark, sf):
    c = cloud(spark, sf)
    return spatial.radius_pairs(c, c, 0.1).groupBy(F.col("qid").alias("pid")).agg(F.count("*").alias("n"))


@query("cloud", sql=_PAIRS + ", k AS (SELECT * FROM d WHERE qid <> pid QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, pid) <= 20), m AS (SELECT qid AS pid, avg(sqrt(d2)) AS mean_distance FROM k GROUP BY 1) SELECT pid, round(mean_distance, 6) AS mean_distance, mean_distance > (SELECT avg(mean_distance) + 2 * stddev_samp(mean_distance) FROM m) AS outlier FROM m")
def sor_outliers(spark, sf):
    c = cloud(spark, sf)
    return clouds.outliers(spatial.nearest(c, c, 20, 0.15, same=True)).withColumn("mean_distance", F.round("mean_distance", 6))


@query("cloud", sql=_PAIRS + " SELECT qid AS pid, count(*) AS n_neighbours, count(*) >= 5 AS core FROM d WHERE d2 <= 0.08 * 0.08 GROUP BY 1")
def dbscan_core_points(spark, sf):
    c = cloud(spark, sf)
    return clustering.core_points(spatial.radius_pairs(c, c, 0.08), 5)


@query("cloud", sql=_PAIRS.replace(", d AS", ", e AS").replace("b.classification FROM", "0 AS c FROM") + """, n AS MATERIALIZED (SELECT qid, pid FROM e WHERE d2 <= 0.08 * 0.08), core AS MATERIALIZED (SELECT qid AS pid FROM n GROUP BY 1 HAVING count(*) >= 5),
  cc AS MATERIALIZED (SELECT n.qid, n.pid FROM n JOIN core a ON n.qid = a.pid JOIN core b ON n.pid = b.pid), reach AS (SELECT a, least FROM (WITH RECURSIVE r(a, b) AS (SELECT qid, pid FROM cc UNION SELECT r.a, cc.pid FROM r JOIN cc ON r.b = cc.qid) SELECT a, min(b) AS least FROM r GROUP BY 1)),
  near AS (SELECT n.qid AS pid, min(reach.least) AS label FROM n JOIN reach ON n.pid = reach.a GROUP BY 1)
  SELECT cloud.pid, coalesce(reach.least, near.label, -1) AS label FROM cloud LEFT JOIN reach ON cloud.pid = reach.a LEFT JOIN near ON cloud.pid = near.pid""")
def dbscan_labels(spark, sf):
    return clustering.dbscan(cloud(spark, sf), 0.08, 5)


@query("cloud", sql=", m AS (SELECT classification, covar_pop(x, y) AS c, var_pop(x) AS vx, var_pop(y) AS vy FROM cloud GROUP BY 1) SELECT classification, round(0.5 * atan2(2 * c, vx - vy), 6) + 0.0 AS angle FROM m")
def pca_angle_2d(spark, sf):
    m = cloud(spark, sf).groupBy("classification").agg(F.covar_pop("x", "y").alias("c"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    return m.select("classification", r6(0.5 * F.atan2(2 * F.col("c"), F.col("vx") - F.col("vy")), "angle"))


# --- walls

_BOX = "x BETWEEN x_min - 2 AND x_max + 2 AND y BETWEEN y_min - 2 AND y_max + 2"


@query("pts", "w", sql=f", j AS (SELECT pid, idx, (x - ox) * nx + (y - oy) * ny AS d FROM pts, w WHERE {_BOX} AND z BETWEEN z_min - 2 AND z_max + 2 AND abs((x - ox) * nx + (y - oy) * ny) <= 2), b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY pid ORDER BY abs(d), idx) = 1) SELECT pid, idx, round(d, 6) + 0.0 AS d FROM b WHERE idx IN (SELECT idx FROM b GROUP BY 1 HAVING count(*) >= 2)")
def nearest_wall_assign(spark, sf):
    return walls.assign_nearest(pts(spark, sf), wall(spark, sf).drop("ring", "n_nationkey"), least_points=2).select("pid", "idx", r6("d", "d"))


@query("pts", "w", sql=f""", c AS (SELECT pid AS cluster_id, x, y, z - 0.5 AS z_lo, z + 0.5 AS z_hi FROM pts), j AS (SELECT cluster_id, idx, (x - ox) * nx + (y - oy) * ny AS d, CASE WHEN abs((x - ox) * nx + (y - oy) * ny) < 2 AND {_BOX} THEN CASE WHEN z_hi >= z_min - 0.5 AND z_lo <= z_max + 0.5 THEN 1 ELSE 2 END ELSE 3 END AS stage FROM c, w)
  SELECT cluster_id, idx, stage, round(d, 6) + 0.0 AS d FROM j QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY stage, abs(d), idx) = 1""")
def wall_stage_match(spark, sf):
    c = pts(spark, sf).select(F.col("pid").alias("cluster_id"), "x", "y", (F.col("z") - 0.5).alias("z_lo"), (F.col("z") + 0.5).alias("z_hi"))
    return walls.match_clusters(c, wall(spark, sf).drop("ring", "n_nationkey")).select("cluster_id", "idx", "stage", r6("d", "d"))


@query("w", sql=", m AS (SELECT 10.0 AS mx, 30.0 AS my), h AS (SELECT idx, round_even(degrees(atan2(ny, nx)) / 10, 0) * 10 + 0.0 AS heading, abs((mx - ox) * nx + (my - oy) * ny) AS distance FROM w, m) SELECT idx, heading, round(distance, 6) AS distance FROM h QUALIFY distance <= min(distance) OVER (PARTITION BY heading) + 2")
def wall_heading_filter(spark, sf):
    return walls.nearest_by_heading(wall(spark, sf), F.lit(10.0), F.lit(30.0)).select("idx", "heading", r6("distance", "distance"))


@query("w", sql=", b AS (SELECT idx AS box_id, nx AS bnx, ny AS bny, wall_d AS bd, -ny AS tx, nx AS ty, z_min AS zl, 2.0 AS zh, -ny * ox + nx * oy - 2 AS t0, -ny * ox + nx * oy + 2 AS t1 FROM w) SELECT box_id, idx FROM b, w WHERE nx * bnx + ny * bny >= 0.8 AND abs(wall_d - bd) <= 0.3 AND z_max >= zl - 0.05 AND z_min <= zh + 0.05 AND greatest(x_min * tx + y_min * ty, x_max * tx + y_max * ty) >= t0 - 0.05 AND least(x_min * tx + y_min * ty, x_max * tx + y_max * ty) <= t1 + 0.05")
def wall_overlap(spark, sf):
    w = wall(spark, sf).drop("ring", "n_nationkey")
    t = -F.col("ny") * F.col("ox") + F.col("nx") * F.col("oy")
    b = w.select(F.col("idx").alias("box_id"), "nx", "ny", "wall_d", (-F.col("ny")).alias("tx"), F.col("nx").alias("ty"), (t - 2).alias("t_min"), (t + 2).alias("t_max"), F.col("z_min").alias("z_lo"), F.lit(2.0).alias("z_hi"))
    return walls.overlapping(b, w)


@query("pts", "w", sql=", j AS (SELECT pid, classification AS cluster_id, x, y, z, w.* FROM pts JOIN w ON idx = classification * 3), t AS (SELECT cluster_id, idx, x * -ny + y * nx AS t, z, least(x_min * -ny + y_min * nx, x_max * -ny + y_max * nx) AS lo, greatest(x_min * -ny + y_min * nx, x_max * -ny + y_max * nx) AS hi, z_min, z_max FROM j), a AS (SELECT cluster_id, idx, greatest(min(t), min(lo)) AS t0, least(max(t), max(hi)) AS t1, greatest(min(z), min(z_min)) AS z0, least(max(z), max(z_max)) AS z1 FROM t GROUP BY 1, 2) SELECT cluster_id, idx, round(t0, 6) + 0.0 AS t0, round(t1, 6) + 0.0 AS t1, round(z0, 6) + 0.0 AS z0, round(z1, 6) + 0.0 AS z1 FROM a WHERE t1 > t0 AND z1 > z0")
def opening_projection(spark, sf):
    p = pts(spark, sf).select(F.col("classification").alias("cluster_id"), "x", "y", "z", (F.col("classification") * 3).alias("idx"))
    m = p.join(spatial.small(wall(spark, sf).drop("ring", "n_nationkey")), "idx")
    return walls.project_openings(m).select("cluster_id", "idx", r6("t0", "t0"), r6("t1", "t1"), r6("z0", "z0"), r6("z1", "z1"))


@query("cloud", sql=", r AS (SELECT pid, classification AS wall, x AS t0, x + 0.1 AS t1, z AS z0, z + 0.1 AS z1 FROM cloud), j AS (SELECT a.pid AS a, b.pid AS b, greatest(least(a.t1, b.t1) - greatest(a.t0, b.t0), 0) * greatest(least(a.z1, b.z1) - greatest(a.z0, b.z0), 0) AS i, (a.t1 - a.t0) * (a.z1 - a.z0) + (b.t1 - b.t0) * (b.z1 - b.z0) AS s FROM r a JOIN r b ON a.wall = b.wall AND a.pid < b.pid) SELECT a, b, round(i / (s - i), 6) AS iou FROM j WHERE i / (s - i) > 0.3")
def rect_iou_pairs(spark, sf):
    size = 0.1  # rectangles that overlap share a cell of their own size; a pair counts in the cell of the overlap's lower corner
    r = cloud(spark, sf).select("pid", F.col("classification").alias("wall"), F.struct(F.col("x").alias("t0"), (F.col("x") + size).alias("t1"), F.col("z").alias("z0"), (F.col("z") + size).alias("z1")).alias("r"))
    for c, k in (("t", "i"), ("z", "j")):
        r = r.withColumn(k, F.explode(F.sequence(F.floor(F.col(f"r.{c}0") / size).cast("long"), F.floor(F.col(f"r.{c}1") / size).cast("long"))))
    j = r.select(F.col("pid").alias("a"), "wall", "i", "j", F.col("r").alias("ra")).join(r.select(F.col("pid").alias("b"), "wall", "i", "j", F.col("r").alias("rb")), ["wall", "i", "j"]).filter("a < b")
    lower = [F.floor(F.greatest(F.col(f"ra.{c}0"), F.col(f"rb.{c}0")) / size).cast("long") == F.col(k) for c, k in (("t", "i"), ("z", "j"))]
    return j.filter(lower[0] & lower[1]).withColumn("iou", G.rect_iou(F.col("ra"), F.col("rb"))).filter("iou > 0.3").select("a", "b", r6("iou", "iou"))


_EDGES = ", e AS (SELECT p.idx, p.k, p.x AS ax, p.y AS ay, p.z AS az, q.x AS ex, q.y AS ey, q.z AS ez FROM corner p JOIN corner q ON p.idx = q.idx AND q.k = (p.k + 1) % 4)"
_NEWELL = _EDGES + ", nw AS (SELECT idx, sum((ay - ey) * (az + ez)) AS vx, sum((az - ez) * (ax + ex)) AS vy, sum((ax - ex) * (ay + ey)) AS vz FROM e GROUP BY 1)"


@query("corner", sql=_NEWELL + " SELECT idx, round(vx / sqrt(vx * vx + vy * vy + vz * vz), 6) + 0.0 AS nx, round(vy / sqrt(vx * vx + vy * vy + vz * vz), 6) + 0.0 AS ny, round(vz / sqrt(vx * vx + vy * vy + vz * vz), 6) + 0.0 AS nz, round(sqrt(vx * vx + vy * vy + vz * vz) / 2, 6) AS area FROM nw")
def newell_normal(spark, sf):
    w = wall(spark, sf).select("idx", G.unit_normal(F.col("ring")).alias("n"), (G.norm(G.newell(F.col("ring"))) / 2).alias("area"))
    return w.select("idx", r6("n.x", "nx"), r6("n.y", "ny"), r6("n.z", "nz"), r6("area", "area"))


@query("corner", sql=_EDGES + " SELECT idx, round(sum(az * ey - ez * ay) / 2, 6) + 0.0 AS area FROM e GROUP BY 1")
def ring_area(spark, sf):
    """Signed area in the plane of z and y."""
    return wall(spark, sf).select("idx", r6(G.area_xy(F.transform("ring", lambda p: F.struct(p["z"].alias("x"), p["y"].alias("y"), p["x"].alias("z")))), "area"))


@query("corner", sql=_NEWELL + " SELECT count(*) AS n_vertical FROM nw WHERE abs(vz) / sqrt(vx * vx + vy * vy + vz * vz) <= 0.3")
def vertical_walls(spark, sf):
    return wall(spark, sf).filter(G.is_vertical(F.col("ring"))).agg(F.count("*").alias("n_vertical"))


@query("cloud", sql="SELECT pid, CAST(round_even((x + 1) / 0.001, 0) AS BIGINT) AS ix, abs(round_even((x + 1) / 0.001, 0) * 0.001 - 1 - x) <= 0.0005001 AS ok FROM cloud")
def encode_decode_vertices(spark, sf):
    c = cloud(spark, sf).withColumn("ix", G.encode(F.col("x"), 0.001, -1.0))
    return c.select("pid", "ix", (F.abs(G.decode(F.col("ix"), 0.001, -1.0) - F.col("x")) <= 0.0005001).alias("ok"))


@query(sql="SELECT n_nationkey AS k, i AS a, i + 1 AS b FROM nation, unnest(generate_series(1, CAST(n_nationkey % 7 AS BIGINT))) t(i)")
def fan_triangles(spark, sf):
    n = _table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.explode(G.fan((F.col("n_nationkey") % 7 + 2).cast("int"))).alias("t"))
    return n.select("k", F.col("t")[1].cast("bigint").alias("a"), F.col("t")[2].cast("bigint").alias("b"))


@query("corner", sql=_EDGES + ", q AS (SELECT DISTINCT idx, CASE WHEN (ax, ay, az) < (ex, ey, ez) THEN (ax, ay, az, ex, ey, ez) ELSE (ex, ey, ez, ax, ay, az) END AS key FROM e) SELECT min(idx) AS face_1, max(idx) AS face_2 FROM q GROUP BY key HAVING count(*) = 2")
def shared_edges(spark, sf):
    return models.shared_edges(wall(spark, sf).select(F.col("idx").alias("face_id"), "ring")).select("face_1", "face_2")


@query("cloud", sql=", r AS (SELECT classification AS face_id, row_number() OVER (PARTITION BY classification ORDER BY pid) AS rn, x, y FROM cloud), f AS (SELECT face_id, rn - 1 AS k, x, y FROM r WHERE rn <= 12), m AS (SELECT face_id, count(*) AS n FROM f GROUP BY 1), e AS (SELECT p.face_id, p.k, n, p.x AS ax, p.y AS ay, q.x AS bx, q.y AS by FROM f p JOIN m USING (face_id) JOIN f q ON p.face_id = q.face_id AND q.k = (p.k + 1) % n) SELECT a.face_id, a.k AS i, b.k AS j FROM e a JOIN e b ON a.face_id = b.face_id AND b.k > a.k + 1 AND NOT (a.k = 0 AND b.k = a.n - 1) WHERE sign((a.bx - a.ax) * (b.ay - a.ay) - (a.by - a.ay) * (b.ax - a.ax)) <> sign((a.bx - a.ax) * (b.by - a.ay) - (a.by - a.ay) * (b.bx - a.ax)) AND sign((b.bx - b.ax) * (a.ay - b.ay) - (b.by - b.ay) * (a.ax - b.ax)) <> sign((b.bx - b.ax) * (a.by - b.ay) - (b.by - b.ay) * (a.bx - b.ax))")
def segment_crossings(spark, sf):
    c = cloud(spark, sf).withColumn("k", F.row_number().over(Window.partitionBy("classification").orderBy("pid")) - 1).filter("k < 12")
    ring = F.transform(F.array_sort(F.collect_list(F.struct("k", "x", "y", F.lit(0.0).alias("z")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z")))
    return models.self_crossings(c.groupBy(F.col("classification").alias("face_id")).agg(ring.alias("ring"))).select("face_id", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))


@query()
def segment_crossings_whole(spark, sf):
    """As segment_crossings, whose SQL takes the first 12 points of each class, but of the rings of all points."""
    p = F.transform(F.array_sort(F.collect_list(F.struct("pid", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(0.0).alias("z")))
    rings = cloud(spark, sf).groupBy(F.col("classification").alias("face_id")).agg(p.alias("ring"))
    return models.self_crossings(rings).select("face_id", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))


@query("corner", sql=", roof AS (SELECT DISTINCT round_even(x * 10, 0) AS x, round_even(y * 10, 0) AS y FROM corner WHERE idx % 3 = 0) SELECT DISTINCT idx FROM corner JOIN roof ON round_even(corner.x * 10, 0) = roof.x AND round_even(corner.y * 10, 0) = roof.y")
def roof_wall_semijoin(spark, sf):
    v = wall(spark, sf).select("idx", F.explode("ring").alias("p")).select("idx", F.bround(F.col("p.x") * 10, 0).alias("x"), F.bround(F.col("p.y") * 10, 0).alias("y"))
    return v.join(v.filter("idx % 3 = 0").select("x", "y").distinct(), ["x", "y"], "left_semi").select("idx").distinct()


_RAYS = """, ray AS (SELECT CAST(floor(0.0 / 2) AS DOUBLE) AS ax, floor(0.0 / 2) AS ay, floor(1.0 / 2) AS az, floor(x / 2) AS ex, floor(y / 2) AS ey, floor(z / 2) AS ez FROM pts), st AS (SELECT *, greatest(abs(ex - ax), abs(ey - ay), abs(ez - az)) AS steps FROM ray),
  walk AS (SELECT CAST(floor(ax + (ex - ax) * s / steps + 0.5) AS BIGINT) AS i, CAST(floor(ay + (ey - ay) * s / steps + 0.5) AS BIGINT) AS j, CAST(floor(az + (ez - az) * s / steps + 0.5) AS BIGINT) AS k, 1 AS state FROM st, unnest(generate_series(1, CAST(least(steps, 200) - 1 AS BIGINT))) t(s) WHERE steps > 1 UNION ALL SELECT CAST(ex AS BIGINT), CAST(ey AS BIGINT), CAST(ez AS BIGINT), 2 FROM st),
  vox AS (SELECT i, j, k, max(state) AS state FROM walk GROUP BY 1, 2, 3)"""


def _rays(spark, sf) -> DataFrame:
    return clouds.ray_voxels(pts(spark, sf).withColumns({"ox": F.lit(0.0), "oy": F.lit(0.0), "oz": F.lit(1.0)}), 2.0)


@query("pts", sql=_RAYS + " SELECT i, j, k, state FROM vox")
def ray_voxels(spark, sf):
    return _rays(spark, sf)


@query("pts", sql=_RAYS + ", c AS (SELECT i // 3 AS wall, count(*) FILTER (state = 1) AS e, count(*) FILTER (state = 2) AS o FROM (SELECT abs(i) AS i, state FROM vox) GROUP BY 1) SELECT wall, round(CASE WHEN e + o > 0 THEN e / (e + o) ELSE 0 END, 6) AS probability, CASE WHEN e + o > 0 THEN e / (e + o) ELSE 0 END > 0.5 AS conflict FROM c")
def wall_conflict_probability(spark, sf):
    v = _rays(spark, sf).withColumn("wall", F.floor(F.abs("i") / 3))
    return clouds.conflict_probability(v, "wall").withColumn("probability", F.round("probability", 6))


# --- alignment


@query("cloud", sql=", p AS (SELECT x AS sx, y AS sy, z AS sz, 1 - 2 * y AS dx, 2 + 2 * x AS dy, 3 + 2 * z AS dz FROM cloud) SELECT count(*) AS n, round(avg(sx), 6) + 0.0 AS msx, round(avg(dx), 6) + 0.0 AS mdx, round(var_pop(sx) + var_pop(sy) + var_pop(sz), 6) AS var, round(covar_pop(dx, sy), 6) + 0.0 AS cxy, round(covar_pop(dz, sz), 6) + 0.0 AS czz FROM p")
def umeyama_sums(spark, sf):
    p = cloud(spark, sf).select(*(F.col(a).alias(f"s{a}") for a in "xyz"), (1 - 2 * F.col("y")).alias("dx"), (2 + 2 * F.col("x")).alias("dy"), (3 + 2 * F.col("z")).alias("dz"))
    return align.pair_sums(p).select("n", *(r6(c, c) for c in ("msx", "mdx", "var", "cxy", "czz")))


@query("cloud", sql="SELECT pid, round(2 * -y + 5, 6) + 0.0 AS x, round(2 * x + 6, 6) + 0.0 AS y, round(2 * z + 7, 6) + 0.0 AS z FROM cloud")
def similarity_apply(spark, sf):
    import numpy as np

    out = align.apply_similarity(cloud(spark, sf), 2.0, np.array([[0.0, -1, 0], [1, 0, 0], [0, 0, 1]]), np.array([5.0, 6, 7]))
    return out.select("pid", r6("x", "x"), r6("y", "y"), r6("z", "z"))


# --- text and models


@query(sql="SELECT event_type, count(*) AS n, CAST(max(event_id % 97) AS BIGINT) AS most FROM events GROUP BY 1")
def kv_error_ids(spark, sf):
    kv = X.key_values(F.concat(F.lit("coid="), F.col("event_type"), F.lit("|face="), (F.col("event_id") % 97).cast("string")))
    return _table(spark, sf, "events").withColumn("m", kv).groupBy(F.col("m.coid").alias("event_type")).agg(F.count("*").alias("n"), F.max(X.tolerant_int(F.col("m.face"))).cast("bigint").alias("most"))


@query(sql="SELECT upper(split_part(p_type, ' ', 1)) AS prefix, count(*) AS n FROM part GROUP BY 1")
def prefix_match(spark, sf):
    return _table(spark, sf, "part").groupBy(X.file_prefix(F.translate("p_type", " ", "_")).alias("prefix")).agg(F.count("*").alias("n"))


@query(sql="SELECT r_name AS sem_type, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def semantic_histogram(spark, sf):
    n = _table(spark, sf, "nation").join(spatial.small(_table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return models.semantic_histogram(n.select(F.col("r_name").alias("sem_type"), F.lit(0).alias("ring_idx")))


# --- without SQL


@query()
def nms_openings(spark, sf):
    o = cloud(spark, sf).select(F.col("classification").alias("wall"), F.col("pid").alias("opening_id"), F.col("x").alias("t0"), (F.col("x") + 0.1).alias("t1"), F.col("z").alias("z0"), (F.col("z") + 0.05 + F.abs("y") / 10).alias("z1"))
    return models.keep_largest_openings(o, ["wall"], 0.0)


@query("w", sql="SELECT CAST(idx // 4 AS VARCHAR) AS obj_id, CAST(idx % 4 AS INT) AS group_idx, 0 AS piece, 2 AS n_members, 'outline' AS made, 6 AS n_vertices, 10.0 * z_max AS area FROM w")
def merge_walls(spark, sf):
    w = wall(spark, sf).withColumns({"model_id": F.lit("m"), "obj_id": F.col("n_nationkey").cast("string")})
    half = lambda a, b: F.struct(*(((F.col("ring")[a][c] + F.col("ring")[b][c]) / 2).alias(c) for c in "xyz"))
    low, top, r = half(0, 1), half(2, 3), F.col("ring")
    both = F.explode(F.array(F.array(r[0], low, top, r[3]), F.array(low, r[1], r[2], top)))
    parts = w.withColumn("ring", both).withColumn("idx", F.row_number().over(Window.partitionBy("obj_id").orderBy("idx", F.col("ring")[0]["x"], F.col("ring")[0]["y"])).cast("int"))
    return models.merge_walls(parts).select("obj_id", "group_idx", "piece", F.size("members").alias("n_members"), "made", F.size("ring").alias("n_vertices"), F.round("area", 6).alias("area"))


@query()
def kmeans_hsv(spark, sf):
    c = rgb(spark, sf).withColumns({c: F.col(c) / 255 for c in ("red", "green", "blue")})
    return clustering.hsv_clusters(c, 5).groupBy("cluster").agg(F.count("*").alias("n"))


@query()
def ransac_planes(spark, sf):
    w = wall(spark, sf).select("idx", F.explode(F.sequence(F.lit(-10), F.lit(10))).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("h"), "ox", "oy", "nx", "ny")
    p = w.select((F.col("idx") * 1000 + F.col("t") * 10 + F.col("h")).cast("bigint").alias("pid"), (F.col("ox") - F.col("ny") * F.col("t") / 2).alias("x"), (F.col("oy") + F.col("nx") * F.col("t") / 2).alias("y"), (F.col("h") / 2).alias("z"))
    return clustering.ransac_planes(p, 0.05).groupBy("plane").agg(F.count("*").alias("n"))


@query("pts", "w", sql=", j AS (SELECT classification AS cluster_id, idx, nx, ny, wall_d, y * nx - x * ny AS t, z, x * nx + y * ny AS d FROM pts JOIN w ON idx = classification * 3), g AS (SELECT cluster_id, idx, min(wall_d) AS d_wall, min(t) AS t0, max(t) AS t1, min(z) AS z0, max(z) AS z1, min(d) AS d_far FROM j GROUP BY 1, 2) SELECT cluster_id, idx, round(t0, 6) + 0.0 AS t0, round(t1, 6) + 0.0 AS t1, round(z0, 6) + 0.0 AS z0, round(z1, 6) + 0.0 AS z1, round(d_far, 6) + 0.0 AS d_far, round(d_wall, 6) + 0.0 AS d_wall, 5 AS faces FROM g WHERE d_wall - d_far >= 0.05")
def recess_boxes(spark, sf):
    p = pts(spark, sf).select(F.col("classification").alias("cluster_id"), "x", "y", "z", (F.col("classification") * 3).alias("idx")).join(spatial.small(wall(spark, sf).select("idx", "nx", "ny", "wall_d")), "idx")
    return models.boxes(p, outward=False).select("cluster_id", "idx", *(r6(c, c) for c in ("t0", "t1", "z0", "z1", "d_far", "d_wall")), F.size(models.box_faces(False)).alias("faces"))


@query("pts", "w", sql=", j AS (SELECT classification AS cluster_id, idx, nx, ny, wall_d, y * nx - x * ny AS t, z, x * nx + y * ny AS d FROM pts JOIN w ON idx = classification * 3), g AS (SELECT cluster_id, idx, min(wall_d) AS d_wall, min(t) AS t0, max(t) AS t1, min(z) AS z0, max(z) AS z1, max(d) AS d_far FROM j GROUP BY 1, 2) SELECT cluster_id, idx, round(t0, 6) + 0.0 AS t0, round(t1, 6) + 0.0 AS t1, round(z0, 6) + 0.0 AS z0, round(z1, 6) + 0.0 AS z1, round(d_far, 6) + 0.0 AS d_far, round(d_wall, 6) + 0.0 AS d_wall, 6 AS faces FROM g WHERE d_far > d_wall")
def extrusion_boxes(spark, sf):
    p = pts(spark, sf).select(F.col("classification").alias("cluster_id"), "x", "y", "z", (F.col("classification") * 3).alias("idx")).join(spatial.small(wall(spark, sf).select("idx", "nx", "ny", "wall_d")), "idx")
    return models.boxes(p, outward=True).select("cluster_id", "idx", *(r6(c, c) for c in ("t0", "t1", "z0", "z1", "d_far", "d_wall")), F.size(models.box_faces(True)).alias("faces"))


@query("w", sql="SELECT concat('m', idx // 4 % 5) AS model_id, count(*) AS n_walls, round(sum(10 * (z_max - z_min)), 6) AS area FROM w GROUP BY 1")
def cityjson_roundtrip(spark, sf):
    from .sources import documents

    rings = wall(spark, sf).select(F.concat(F.lit("m"), (F.col("n_nationkey") % 5).cast("string")).alias("model_id"), F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("obj_id"), F.lit("Building").alias("type"), F.lit(2.2).alias("lod"), F.lit("WallSurface").alias("sem_type"), F.col("idx").alias("poly_idx"), F.lit(0).alias("ring_idx"), "ring")
    back = models.walls(models.polygons(documents.parse_cityjson(documents.cityjson_document(rings))))
    return back.groupBy("model_id").agg(F.count("*").alias("n_walls"), F.round(F.sum(G.norm(G.newell(F.col("ring"))) / 2), 6).alias("area"))


# --- meshes, panoramas, votes


def _triangles(spark, sf) -> DataFrame:
    t = wall(spark, sf).select("idx", "ring", F.posexplode(G.fan(F.size("ring"))).alias("k", "t"))
    return t.select((F.col("idx") * 2 + F.col("k")).alias("fid"), *(F.element_at("ring", F.col("t")[i] + 1).alias(c) for i, c in enumerate("abc")))


@query("wall", sql=", t AS (SELECT idx * 2 + k AS fid, 5.0 * (z_max - z_min) AS area FROM wall, (VALUES (0), (1)) v(k)), s AS (SELECT *, sum(area) OVER (ORDER BY fid) AS upto, sum(area) OVER () AS total FROM t) SELECT fid, round(area, 6) AS area, CAST(floor(upto / total * 10000 + 1e-9) - floor((upto - area) / total * 10000 + 1e-9) AS BIGINT) AS samples FROM s")
def mesh_sample_counts(spark, sf):
    return meshes.sample_counts(_triangles(spark, sf), 10_000).select("fid", r6("area", "area"), "samples")


@query("wall", sql="SELECT CAST(count(*) * 100 AS BIGINT) AS n, true AS on_walls FROM wall")
def mesh_surface_samples(spark, sf):
    s = meshes.sample_surface(_triangles(spark, sf), 10_000)
    w = wall(spark, sf).select("idx", "nx", "ny", "wall_d", "z_max")
    j = s.join(w, F.floor(F.col("fid") / 2) == F.col("idx"))
    off = F.abs(F.col("x") * F.col("nx") + F.col("y") * F.col("ny") - F.col("wall_d"))
    return j.agg(F.count("*").alias("n"), F.bool_and((off < 1e-9) & F.col("z").between(-1e-9, F.col("z_max") + 1e-9)).alias("on_walls"))


@query("cloud", sql=_PAIRS + ", m AS (SELECT qid, min(d2) AS d2 FROM d WHERE qid <> pid GROUP BY 1) SELECT round(greatest(median(sqrt(d2)), 1e-6), 6) AS spacing FROM m")
def point_spacing(spark, sf):
    return meshes.spacing(cloud(spark, sf), 0.1).select(r6("spacing", "spacing"))


@query("cloud", sql=_PAIRS + ", ab AS (SELECT qid, pid FROM d WHERE qid % 2 = 0 AND pid % 2 = 1 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, pid) = 1), ba AS (SELECT qid, pid FROM d WHERE qid % 2 = 1 AND pid % 2 = 0 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, pid) = 1) SELECT ab.qid AS pid_a, ab.pid AS pid_b FROM ab JOIN ba ON ab.qid = ba.pid AND ab.pid = ba.qid")
def mutual_nearest(spark, sf):
    c = cloud(spark, sf)
    return meshes.mutual_nearest(c.filter("pid % 2 = 0"), c.filter("pid % 2 = 1"), 0.1)


@query(sql="WITH s AS (SELECT vec_id % 50 AS pid, label AS cls, avg(CAST(embedding[4] AS DOUBLE)) AS mean FROM embeddings GROUP BY 1, 2) SELECT pid, cls, round(mean, 6) + 0.0 AS mean FROM s QUALIFY row_number() OVER (PARTITION BY pid ORDER BY mean DESC, cls) = 1")
def class_votes(spark, sf):
    s = _table(spark, sf, "embeddings").select((F.col("vec_id") % 50).alias("pid"), F.col("label").alias("cls"), F.element_at("embedding", 4).cast("double").alias("p"))
    return meshes.vote(s, "pid", "cls", "p").select("pid", "cls", r6("mean", "mean"))


@query("cloud", sql=", t AS (SELECT pid, x AS ax, y AS ay, lead(x) OVER w AS qx, lead(y) OVER w AS qy, lead(x, 2) OVER w AS cx, lead(y, 2) OVER w AS cy FROM cloud WINDOW w AS (PARTITION BY classification ORDER BY pid)), s AS (SELECT pid, abs((qx - ax) * (cy - ay) - (qy - ay) * (cx - ax)) / 2 AS area, sqrt((ax - qx) ** 2 + (ay - qy) ** 2) * sqrt((qx - cx) ** 2 + (qy - cy) ** 2) * sqrt((cx - ax) ** 2 + (cy - ay) ** 2) AS m FROM t WHERE cx IS NOT NULL) SELECT count(*) AS n, count(*) FILTER (area * area > 1e-14 AND m / (4 * area) <= 0.1) AS kept FROM s")
def alpha_filter(spark, sf):
    w = Window.partitionBy("classification").orderBy("pid")
    p = F.struct("x", "y")
    t = cloud(spark, sf).select(p.alias("a"), F.lead(p, 1).over(w).alias("b"), F.lead(p, 2).over(w).alias("c")).filter("c IS NOT NULL")
    return t.agg(F.count("*").alias("n"), F.count_if(G.circumradius(F.col("a"), F.col("b"), F.col("c")) <= 0.1).alias("kept"))


@query("wall", sql="SELECT idx, round(10 * (z_max - 1), 6) AS area FROM wall")
def clipped_walls(spark, sf):
    w = wall(spark, sf).select("idx", G.clip_z_min(F.col("ring"), F.lit(1.0)).alias("r"))
    return w.select("idx", r6(G.norm(G.newell(F.col("r"))) / 2, "area"))


@query(sql="""WITH p AS (SELECT i // 16 AS row, i % 16 AS col, (i % 16 + 0.5) * (2.0 / 16) - 1 AS a, (i // 16 + 0.5) * (2.0 / 16) - 1 AS b FROM generate_series(0, 255) t(i)),
  d AS (SELECT 'front' AS face, row, col, 1.0 AS x, a AS y, -b AS z FROM p UNION ALL SELECT 'up', row, col, b, a, 1.0 FROM p UNION ALL SELECT 'back', row, col, -1.0, -a, -b FROM p UNION ALL SELECT 'right', row, col, -a, 1.0, -b FROM p UNION ALL SELECT 'left', row, col, a, -1.0, -b FROM p UNION ALL SELECT 'down', row, col, -b, a, -1.0 FROM p)
  SELECT face, CAST(row AS INT) AS row, CAST(col AS INT) AS col, CAST(floor((atan2(y, x) / (2 * pi()) + 0.5) * 1000) % 1000 AS INT) AS u, CAST(least(greatest(floor((0.5 - atan2(z, sqrt(x * x + y * y)) / pi()) * 500), 0), 499) AS INT) AS v FROM d""")
def panorama_mapping(spark, sf):
    u, v = panorama.panorama_pixel(1000, 500)
    return panorama.face_pixels(spark, 16).select("face", "row", "col", u.alias("u"), v.alias("v"))


@query(sql="SELECT round(14.5 + i * (50 / 111139.0), 6) AS lat, round(121.0 + j * (50 / (111139.0 * cos(radians(14.51)))), 6) AS lng FROM generate_series(0, CAST(floor(0.02 / (50 / 111139.0)) AS BIGINT)) t(i), generate_series(0, CAST(floor(0.01 / (50 / (111139.0 * cos(radians(14.51))))) AS BIGINT)) s(j)")
def sampling_grid(spark, sf):
    return panorama.grid_coordinates(spark, 14.5, 121.0, 14.52, 121.01, 50.0).select(r6("lat", "lat"), r6("lng", "lng"))


@query()
def point_normals(spark, sf):
    return meshes.normals(cloud(spark, sf), 0.15)


@query()
def grown_regions(spark, sf):
    w = wall(spark, sf)
    faces = w.select(F.lit("m").alias("mesh_id"), F.col("idx").cast("long").alias("fid"), "nx", "ny", F.lit(0.0).alias("nz"))
    adjacent = models.shared_edges(w.select(F.col("idx").cast("long").alias("face_id"), "ring")).select(F.lit("m").alias("mesh_id"), "face_1", "face_2")
    return meshes.grow_regions(faces, adjacent, 5.0).groupBy("region").agg(F.count("*").alias("n"))


# --- facades


def _rings(spark, sf) -> DataFrame:
    """Walls as rings of building models: model by fifth of the nations, object by nation."""
    w = wall(spark, sf)
    return w.select((F.col("n_nationkey") % 5).cast("string").alias("model_id"), F.col("n_nationkey").cast("string").alias("obj_id"), F.lit("Building").alias("type"), F.lit(0).alias("geom_idx"), F.lit(2.2).alias("lod"), F.lit(0).alias("shell_idx"), (F.col("idx") % 4).cast("int").alias("poly_idx"), F.lit(0).alias("ring_idx"), F.lit("WallSurface").alias("sem_type"), "ring", "idx")


@query("wall", sql="SELECT n_nationkey AS obj, count(*) AS n FROM nation, (VALUES (0), (1), (2), (3)) s(side) WHERE side <> 3 OR n_nationkey % 2 = 0 GROUP BY 1")
def ground_attached(spark, sf):
    lift = F.when((F.col("poly_idx") == 3) & (F.col("obj_id").cast("int") % 2 == 1), 1.0).otherwise(0.0)
    r = _rings(spark, sf).withColumn("lift", lift)
    r = r.withColumn("ring", F.transform("ring", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["z"] + F.col("lift")).alias("z"))))
    return facades.ground_attached(r.drop("lift")).groupBy(F.col("obj_id").cast("int").alias("obj")).agg(F.count("*").alias("n"))


@query(sql="SELECT n_nationkey AS obj, 100.0 AS area, 4 AS n FROM nation")
def footprint_hulls(spark, sf):
    f = facades.footprints(_rings(spark, sf))
    return f.select(F.col("obj_id").cast("int").alias("obj"), F.round(F.abs(G.area_xy(F.col("ring"))), 6).alias("area"), F.size("ring").alias("n"))


@query(sql="WITH s AS (SELECT n_nationkey AS i, n_regionkey AS o, n_nationkey % 3 <> 1 AS kept, n_nationkey - 5 AS parent FROM nation), k AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY i) - 1 AS new_idx FROM s WHERE kept) SELECT k.o AS obj, k.i AS sem_idx, CAST(k.new_idx AS BIGINT) AS new_idx, CAST(coalesce(p.new_idx, -1) AS BIGINT) AS new_parent FROM k LEFT JOIN k p ON p.o = k.o AND p.i = k.parent")
def rekey_surfaces(spark, sf):
    s = _table(spark, sf, "nation").select(F.lit("m").alias("model_id"), F.col("n_regionkey").alias("obj_id"), F.col("n_nationkey").alias("sem_idx"), (F.col("n_nationkey") % 3 != 1).alias("kept"), (F.col("n_nationkey") - 5).alias("parent"))
    return facades.rekey_surfaces(s).select(F.col("obj_id").alias("obj"), "sem_idx", F.col("new_idx").cast("bigint").alias("new_idx"), F.coalesce("new_parent", F.lit(-1)).cast("bigint").alias("new_parent"))


@query(sql="""WITH n AS (SELECT n_nationkey AS k, replace(n_name, '_', '') AS n FROM nation), c AS (SELECT n || '_roof' AS name, lower(n) AS p FROM n), g AS (SELECT DISTINCT CASE s_suppkey % 3 WHEN 0 THEN concat(n, '_', s_suppkey % 7) WHEN 1 THEN concat('Old', n) ELSE concat(lower(n), 'x') END AS polygon_id FROM supplier JOIN n ON s_nationkey = k),
  j AS (SELECT name, polygon_id, starts_with(lower(polygon_id), p || '_') AS strict FROM c JOIN g ON contains(lower(polygon_id), p)) SELECT name, polygon_id, strict FROM j QUALIFY strict OR NOT max(strict) OVER (PARTITION BY name)""")
def prefix_join(spark, sf):
    n = _table(spark, sf, "nation").select("n_nationkey", F.replace("n_name", F.lit("_"), F.lit("")).alias("n"))
    g = _table(spark, sf, "supplier").join(spatial.small(n), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, F.concat("n", F.lit("_"), (k % 7).cast("string"))).when(k % 3 == 1, F.concat(F.lit("Old"), "n")).otherwise(F.concat(F.lower("n"), F.lit("x")))
    return facades.match_prefixes(n.select(F.concat("n", F.lit("_roof")).alias("name")), g.select(name.alias("polygon_id")).distinct())


@query("cloud", sql="SELECT pid, round(x, 6) + 0.0 AS u, round(z, 6) + 0.0 AS v, round(-y, 6) + 0.0 AS d FROM cloud")
def surface_frame(spark, sf):
    f = facades.surface_frame(cloud(spark, sf), G.point(0, 0, 0), G.point(0, -1, 0))
    return f.select("pid", r6("u", "u"), r6("v", "v"), r6("d", "d"))


@query("big", sql=", q AS (SELECT quantile_cont(y, 0.9) AS m FROM big) SELECT count(*) AS n, round(min(y), 6) AS least FROM big, q WHERE y >= m")
def density_trim(spark, sf):
    return facades.trim_density(big(spark, sf), "y", 0.9).agg(F.count("*").alias("n"), r6(F.min("y"), "least"))


@query("pts", "w", sql=", j AS (SELECT classification AS cluster_id, w.idx, x * -ny + y * nx AS t, z, least(x_min * -ny + y_min * nx, x_max * -ny + y_max * nx) AS lo, greatest(x_min * -ny + y_min * nx, x_max * -ny + y_max * nx) AS hi, z_min, z_max FROM pts JOIN w ON w.idx = classification * 7), a AS (SELECT cluster_id, idx, min(t) AS a0, max(t) AS a1, min(lo) AS w0, max(hi) AS w1, min(z) AS c0, max(z) AS c1, min(z_min) AS h0, max(z_max) AS h1 FROM j GROUP BY 1, 2) SELECT cluster_id, idx, round(CASE WHEN least(a1, w1) > greatest(a0, w0) THEN greatest(a0, w0) ELSE (w0 + w1) / 2 - least(a1 - a0, w1 - w0) / 2 END, 6) + 0.0 AS t0, round(CASE WHEN least(c1, h1) > greatest(c0, h0) THEN greatest(c0, h0) ELSE c0 END, 6) + 0.0 AS z0 FROM a")
def lenient_projection(spark, sf):
    p = pts(spark, sf).select(F.col("classification").alias("cluster_id"), "x", "y", "z", (F.col("classification") * 7).alias("idx"))
    m = p.join(spatial.small(wall(spark, sf).drop("ring", "n_nationkey")), "idx")
    return facades.project_lenient(m).select("cluster_id", "idx", r6("t0", "t0"), r6("z0", "z0"))


@query("cloud", sql=", b AS (SELECT pid AS box_id, x AS t0, x + 0.2 AS t1, z AS z0, z + 0.2 AS z1 FROM cloud), p AS (SELECT pid AS box_id, label AS idx, x + 0.05 AS p0, x + 0.15 AS p1, z - 0.1 AS h0, z + 0.05 AS h1 FROM (SELECT *, classification AS label FROM cloud)) SELECT b.box_id, idx, round(greatest(t0, p0 + 0.01), 6) + 0.0 AS t0, round(least(z1, h1 - 0.01), 6) + 0.0 AS z1 FROM b JOIN p USING (box_id) WHERE least(t1, p1 - 0.01) > greatest(t0, p0 + 0.01) AND least(z1, h1 - 0.01) > greatest(z0, h0 + 0.01)")
def panel_holes(spark, sf):
    c = cloud(spark, sf)
    b = c.select(F.col("pid").alias("box_id"), F.col("x").alias("t0"), (F.col("x") + 0.2).alias("t1"), F.col("z").alias("z0"), (F.col("z") + 0.2).alias("z1"))
    p = c.select(F.col("pid").alias("box_id"), F.col("classification").alias("idx"), (F.col("x") + 0.05).alias("p0"), (F.col("x") + 0.15).alias("p1"), (F.col("z") - 0.1).alias("h0"), (F.col("z") + 0.05).alias("h1"))
    return facades.panel_holes(b, p).select("box_id", "idx", r6("t0", "t0"), r6("z1", "z1"))


@query("w", sql=", b AS (SELECT idx AS box_id, nx, ny, wall_d + 3 AS m, wall_d AS d FROM w) SELECT box_id, round(coalesce((SELECT max(w.wall_d) FROM w WHERE b.nx * w.nx + b.ny * w.ny >= 0.8 AND w.wall_d <= b.m), d), 6) + 0.0 AS d_wall FROM b")
def snapped_extrusions(spark, sf):
    w = wall(spark, sf)
    b = w.select(F.col("idx").alias("box_id"), "nx", "ny", (F.col("wall_d") + 3).alias("d_median"), (F.col("wall_d") + 4).alias("d_far"), "wall_d").withColumnRenamed("wall_d", "d_wall")
    return facades.snap_near_face(b, w).select("box_id", r6("d_wall", "d_wall")).distinct()


@query("cloud", sql=_PAIRS.replace("b.classification", "b.x AS bx") + ", s AS (SELECT qid AS pid, count(*) AS n, stddev_pop(bx) / 3 AS spread FROM d WHERE d2 <= 0.12 * 0.12 GROUP BY 1) SELECT pid, n, round(spread, 6) AS spread, n >= 4 AND spread > 0.01 AS rough FROM s")
def neighbour_normal_spread(spark, sf):
    c = cloud(spark, sf)
    n = c.select("pid", F.col("x").alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    return facades.normal_spread(c, n, 0.12, 0.01).withColumn("spread", F.round("spread", 6))


@query("cloud", sql=", a AS (SELECT classification, 0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS g FROM cloud GROUP BY 1), p AS (SELECT classification, z, x * cos(g) + y * sin(g) AS u, y * cos(g) - x * sin(g) AS v FROM cloud JOIN a USING (classification)), s AS (SELECT classification, max(z) - min(z) AS height, greatest(max(u) - min(u), max(v) - min(v)) AS length FROM p GROUP BY 1) SELECT classification, round(height, 6) AS height, round(length, 6) AS length, round(height / length, 6) AS ratio FROM s")
def cluster_elongation(spark, sf):
    return facades.elongation(cloud(spark, sf), "classification").select("classification", r6("height", "height"), r6("length", "length"), r6("ratio", "ratio"))


@query("cloud", sql=", s AS (SELECT max(x) - min(x) AS a, max(y) - min(y) AS b, max(z) - min(z) AS c FROM cloud), t AS (SELECT unnest([a * 2 / a, b * 3 / b, c * 2.5 / c]) AS r FROM s) SELECT round(median(r), 6) AS scale, round(stddev_pop(r) / avg(r), 6) AS spread FROM t")
def robust_scale(spark, sf):
    c = cloud(spark, sf)
    return facades.robust_scale(c, c.withColumns({"x": F.col("x") * 2, "y": F.col("y") * 3, "z": F.col("z") * 2.5})).select(r6("scale", "scale"), r6("spread", "spread"))


@query("wall", sql="SELECT idx, CAST(greatest(floor(10 * z_max / 0.25 + 1e-9), 100) AS BIGINT) AS samples, CAST(pow(4, greatest(ceil(log2(sqrt(100 + z_max * z_max) / 2.0) - 1e-12), 0)) AS BIGINT) AS triangles FROM wall")
def polygon_samples(spark, sf):
    s = facades.polygon_sample_counts(wall(spark, sf).select("idx", "ring", "z_max"), 0.5)
    return s.select("idx", "samples", facades.subdivisions(F.sqrt(100 + F.col("z_max") * F.col("z_max")), 2.0).alias("triangles"))


@query("pts", "w", sql=_RAYS + ", c AS (SELECT (i + 0.5) * 2 AS x, (j + 0.5) * 2 AS y, (k + 0.5) * 2 AS z, state FROM vox) SELECT idx, count(*) FILTER (state = 1) AS empty, count(*) FILTER (state = 2) AS hit FROM c, w WHERE abs((x - ox) * nx + (y - oy) * ny) < 1.01 AND abs((x - ox) * -ny + (y - oy) * nx) <= sqrt((x_max - x_min) ** 2 + (y_max - y_min) ** 2) / 2 AND z BETWEEN z_min AND z_max GROUP BY 1")
def wall_voxels(spark, sf):
    v = facades.voxels_on_walls(_rays(spark, sf), wall(spark, sf).drop("ring", "n_nationkey"), 2.0, 1.01)
    return v.groupBy("idx").agg(F.count_if(F.col("state") == 1).alias("empty"), F.count_if(F.col("state") == 2).alias("hit"))


@query()
def cloth_ground(spark, sf):
    return facades.cloth_ground(pts(spark, sf), 5.0, 1.0).groupBy("ground").agg(F.count("*").alias("n"))


@query()
def rotation_search(spark, sf):
    c = cloud(spark, sf)
    turned = c.select("pid", (-F.col("y")).alias("x"), F.col("x").alias("y"), "z")
    return spark.createDataFrame([facades.rotation_search(c, turned, 0.2, [float(d) for d in range(0, 360, 30)])], "angle double, distance double")


# --- matching variants, selections, labels

_MATCH = ", c AS (SELECT pid AS cluster_id, x, y, z - 0.5 AS z_lo, z + 0.5 AS z_hi FROM pts), j AS (SELECT c.*, w.*, (x - ox) * nx + (y - oy) * ny AS d FROM c, w)"


def _clusters(spark, sf) -> DataFrame:
    return pts(spark, sf).select(F.col("pid").alias("cluster_id"), "x", "y", (F.col("z") - 0.5).alias("z_lo"), (F.col("z") + 0.5).alias("z_hi"))


def _plain_walls(spark, sf) -> DataFrame:
    return wall(spark, sf).drop("ring", "n_nationkey")


@query("pts", "w", sql=_MATCH + f" SELECT cluster_id, idx, round(d, 6) + 0.0 AS d FROM j WHERE abs(d) < 2 AND {_BOX} AND z_hi >= z_min - 0.5 AND z_lo <= z_max + 0.5")
def wall_match_every(spark, sf):
    return walls.match_clusters(_clusters(spark, sf), _plain_walls(spark, sf), many=True, last=None).filter("stage = 1").select("cluster_id", "idx", r6("d", "d"))


@query("pts", "w", sql=_MATCH + """, one AS (SELECT cluster_id, idx, 1 AS stage, d, abs(d) AS far FROM j WHERE d < 2 AND d > -10 AND z_hi >= z_min - 1 AND z_lo <= z_max + 1 AND x - d * nx BETWEEN x_min - 2 AND x_max + 2 AND y - d * ny BETWEEN y_min - 2 AND y_max + 2),
  two AS (SELECT cluster_id, idx, 3 AS stage, d, sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy)) AS far FROM j WHERE d < 2 AND d > -10)
  SELECT cluster_id, idx, stage, round(d, 6) + 0.0 AS d FROM (SELECT * FROM one UNION ALL SELECT * FROM two) QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY stage, far, idx) = 1""")
def wall_match_deep(spark, sf):
    return walls.match_clusters(_clusters(spark, sf), _plain_walls(spark, sf), tolerance=2.0, inward=10.0, z_expand=1.0, pad=2.0, last="centroid").select("cluster_id", "idx", "stage", r6("d", "d"))


@query("pts", "w", sql=_MATCH + """, t AS (SELECT cluster_id, idx, d, CASE WHEN abs(d) < 5 AND x BETWEEN x_min - 5 AND x_max + 5 AND y BETWEEN y_min - 5 AND y_max + 5 THEN 1 ELSE 3 END AS stage FROM j WHERE z_hi >= z_min - 2 AND z_lo <= z_max + 2) SELECT cluster_id, idx, stage, round(d, 6) + 0.0 AS d FROM t QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY stage, abs(d), idx) = 1""")
def wall_match_heights(spark, sf):
    return walls.match_clusters(_clusters(spark, sf), _plain_walls(spark, sf), tolerance=5.0, z_expand=2.0, z_always=True).select("cluster_id", "idx", "stage", r6("d", "d"))


@query("pts", "w", sql=", j AS (SELECT pid, idx, (x - ox) * nx + (y - oy) * ny AS d FROM pts, w) SELECT pid, idx, round(d, 6) + 0.0 AS d FROM j QUALIFY row_number() OVER (PARTITION BY pid ORDER BY abs(d), idx) = 1")
def split_by_wall(spark, sf):
    return walls.split_by_wall(pts(spark, sf), _plain_walls(spark, sf)).select("pid", "idx", r6("d", "d"))


@query("pts", "w", sql=""", j AS (SELECT pts.*, classification AS cluster_id, (x - ox) * nx + (y - oy) * ny BETWEEN -10 AND 0.1 AS inside FROM pts JOIN w ON idx = classification * 3)
  SELECT cluster_id, count(*) AS n, count(*) FILTER (inside) AS n_interior FROM j GROUP BY 1 HAVING count(*) FILTER (inside) >= 10 AND count(*) FILTER (inside) >= 0.1 * count(*) AND max(z) FILTER (inside) - min(z) FILTER (inside) >= 0.01
  AND greatest(max(x) FILTER (inside) - min(x) FILTER (inside), max(y) FILTER (inside) - min(y) FILTER (inside)) >= 0.01""")
def cluster_gates(spark, sf):
    p = pts(spark, sf).withColumn("idx", F.col("classification") * 3).join(spatial.small(_plain_walls(spark, sf).select("idx", "nx", "ny", "ox", "oy")), "idx").withColumnRenamed("classification", "cluster_id")
    inside = walls.interior_points(p).select("pid", F.lit(True).alias("interior"))
    return walls.passing_clusters(p.join(inside, "pid", "left").na.fill(False, ["interior"]))


@query("big", sql="SELECT cls, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, cls) AS place FROM big GROUP BY 1")
def clusters_by_size(spark, sf):
    return selection.by_size(big(spark, sf), "cls").withColumn("place", F.col("place").cast("bigint"))


@query("cloud", sql=", s AS (SELECT classification, count(*) AS n, min(pid) AS first_pid FROM cloud GROUP BY 1), i AS (SELECT *, row_number() OVER (ORDER BY first_pid, classification) - 1 AS segment_id FROM s) SELECT *, row_number() OVER (ORDER BY n DESC, segment_id) AS place FROM i")
def segments_by_size(spark, sf):
    return selection.segments_by_size(cloud(spark, sf), "classification").withColumns({c: F.col(c).cast("bigint") for c in ("segment_id", "place")})


@query("cloud", sql="SELECT classification, greatest(count(*) // 7, 2) AS n, true AS apart FROM cloud GROUP BY 1")
def stride_subsample(spark, sf):
    s = selection.stride_sample(cloud(spark, sf), "classification", 7)
    return s.groupBy("classification").agg(F.count("*").alias("n"), (F.countDistinct("pid") == F.count("*")).alias("apart"))


@query("cloud", sql="SELECT 100 AS n, 100 AS distinct_pids, 0 AS out_of_order")
def capped_points(spark, sf):
    c = selection.capped_in_order(cloud(spark, sf), 100).withColumn("before", F.lag("pid").over(Window.orderBy("place")))
    return c.agg(F.count("*").alias("n"), F.countDistinct("pid").alias("distinct_pids"), F.count_if(F.col("before") > F.col("pid")).alias("out_of_order"))


@query("pts", "w", sql=", b AS (SELECT min(x_min) AS x0, max(x_max) AS x1, min(y_min) AS y0, max(y_max) AS y1 FROM w) SELECT pid FROM pts, b WHERE x BETWEEN x0 - 3 AND x1 + 3 AND y BETWEEN y0 - 3 AND y1 + 3")
def near_model_points(spark, sf):
    return selection.near_model(pts(spark, sf), wall(spark, sf).select("ring"), 3.0).select("pid")


@query(sql="SELECT CAST(n_regionkey AS VARCHAR) AS model_id, coalesce(min(CASE WHEN n_nationkey % 4 = 1 THEN n_nationkey - 10.0 END), 0) AS ground FROM nation GROUP BY 1")
def ground_levels(spark, sf):
    n = _table(spark, sf, "nation")
    at = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), (F.col("n_nationkey") - 10.0).alias("z"))
    kind = F.when(F.col("n_nationkey") % 4 == 1, "GroundSurface").otherwise("RoofSurface")
    return selection.ground_level(n.select(F.col("n_regionkey").cast("string").alias("model_id"), kind.alias("sem_type"), F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0)).alias("ring")))


@query(sql="WITH f AS (SELECT CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE n_nationkey % 6 - 1 END AS i FROM nation) SELECT CASE WHEN i IS NULL THEN '' WHEN i = 0 THEN 'WallSurface' WHEN i = 1 THEN 'RoofSurface' ELSE concat('INVALID(', i, ')') END AS sem_type, count(*) AS n FROM f GROUP BY 1")
def polygons_by_type(spark, sf):
    i = F.when(F.col("n_nationkey") % 6 != 5, (F.col("n_nationkey") % 6 - 1).cast("int"))
    return selection.polygons_by_type(_table(spark, sf, "nation").select(i.alias("sem_idx"), F.array(F.lit("WallSurface"), F.lit("RoofSurface")).alias("types")))


@query("w", sql="SELECT concat('m', idx // 4 % 5) AS model_id, count(DISTINCT idx // 4) AS objects, count(*) AS polygons, count(*) * 4 AS vertices, 2.2 AS lod, count(*) FILTER (idx % 2 = 0) AS walls FROM w GROUP BY 1")
def model_statistics(spark, sf):
    s = selection.statistics(_model_rings(spark, sf).withColumn("sem_type", F.when(F.col("poly_idx") % 2 == 0, "WallSurface").otherwise("RoofSurface")))
    return s.select("model_id", "objects", "polygons", "vertices", "lod", F.col("types")["WallSurface"].alias("walls"))


def _model_rings(spark, sf) -> DataFrame:
    w = wall(spark, sf)
    return w.select(
        F.concat(F.lit("m"), (F.col("n_nationkey") % 5).cast("string")).alias("model_id"), F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("obj_id"), F.lit("Building").alias("type"),
        F.lit(2.2).alias("lod"), F.lit("WallSurface").alias("sem_type"), F.col("idx").cast("int").alias("poly_idx"), F.lit(0).alias("ring_idx"), "ring",
    )


def _model_openings(spark, sf) -> DataFrame:
    """A window in every wall, a door in those of every fifth nation."""
    w = wall(spark, sf).withColumns({"model_id": F.concat(F.lit("m"), (F.col("n_nationkey") % 5).cast("string")), "obj_id": F.concat(F.lit("b"), F.col("n_nationkey").cast("string")), "poly_idx": F.col("idx").cast("int")})
    middle = F.col("oy") * F.col("nx") - F.col("ox") * F.col("ny")
    kinds = F.explode(F.filter(F.array(F.struct(F.lit("Window").alias("feature_type"), F.lit(1).alias("opening_id"), F.lit(1.0).alias("t"), F.lit(1.0).alias("low")), F.when(F.col("n_nationkey") % 5 == 0, F.struct(F.lit("Door").alias("feature_type"), F.lit(2).alias("opening_id"), F.lit(-2.0).alias("t"), F.lit(0.1).alias("low")))), lambda k: k.isNotNull()))
    o = w.withColumn("k", kinds).select("model_id", "obj_id", "poly_idx", "idx", "nx", "ny", "wall_d", "k.feature_type", "k.opening_id", (middle + F.col("k.t")).alias("t0"), (middle + F.col("k.t") + 1).alias("t1"), F.col("k.low").alias("z0"), (F.col("k.low") + 1.5).alias("z1"))
    return models.opening_features(o)


@query("w", sql="""SELECT concat('m', idx // 4 % 5) AS model_id, 'Building' AS type, count(DISTINCT idx // 4) AS n, CAST(sum(CASE WHEN idx // 4 % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS holes, CAST(sum(CASE WHEN idx // 4 % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) + count(*) FILTER (idx % 4 = 0) AS linked, 2.2 AS lod FROM w GROUP BY 1
  UNION ALL SELECT concat('m', idx // 4 % 5), 'Window', count(*), 0, count(*), 3.0 FROM w GROUP BY 1 UNION ALL SELECT 'm0', 'Door', count(*), 0, count(*), 3.0 FROM w WHERE idx // 4 % 5 = 0 UNION ALL SELECT concat('m', idx // 4 % 5), 'BuildingInstallation', count(*), 0, count(*), 3.0 FROM w WHERE idx % 4 = 0 GROUP BY 1""")
def detailed_models(spark, sf):
    """Openings punched, installations added, written as documents and read again: objects, holes and links by type."""
    from .sources import assembly, documents

    faces = wall(spark, sf).filter("idx % 4 = 0").select(F.concat(F.lit("m"), (F.col("n_nationkey") % 5).cast("string")).alias("model_id"), F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("parent"), F.concat(F.lit("i"), F.col("idx").cast("string")).alias("feature_id"), F.lit(0).alias("poly_idx"), F.lit("WallSurface").alias("sem_type"), "ring")
    rings = assembly.with_installations(assembly.punched(_model_rings(spark, sf), _model_openings(spark, sf)), faces)
    back = documents.parse_cityjson(documents.cityjson_document(rings))
    objects = back.select("model_id", F.explode("objects").alias("obj_id", "o")).select("model_id", "obj_id", F.col("o.type").alias("type"), F.coalesce(F.size("o.parents"), F.lit(0)).alias("p"), F.coalesce(F.size("o.children"), F.lit(0)).alias("c"))
    table = models.polygons(back).groupBy("model_id", "obj_id").agg(F.count_if(F.col("ring_idx") > 0).alias("holes"), F.max("lod").alias("lod"))
    link = F.when(F.col("p") > 0, F.col("p")).otherwise(F.when(F.col("c") > 0, F.col("c")).otherwise(0))
    return objects.join(table, ["model_id", "obj_id"]).groupBy("model_id", "type").agg(F.count("*").alias("n"), F.sum("holes").cast("bigint").alias("holes"), F.sum(link).cast("bigint").alias("linked"), F.max("lod").alias("lod"))


@query("w", sql="SELECT concat('m', idx // 4 % 5) AS model_id, count(*) AS walls, count(*) AS windows, count(*) FILTER (idx // 4 % 5 = 0) AS doors, count(*) + count(*) FILTER (idx // 4 % 5 = 0) AS interiors FROM w GROUP BY 1")
def detailed_gml_documents(spark, sf):
    from .sources import assembly

    g = assembly.detailed_gml(assembly.punched(_model_rings(spark, sf), _model_openings(spark, sf)))
    n = lambda t: F.regexp_count("value", F.lit(t)).cast("bigint")
    return g.select("model_id", n("<bldg:WallSurface ").alias("walls"), n("<bldg:opening><bldg:Window ").alias("windows"), n("<bldg:opening><bldg:Door ").alias("doors"), n("<gml:interior>").alias("interiors"))


@query("w", sql="SELECT concat('m', idx // 4 % 5) AS model_id, 3 * count(DISTINCT idx // 4) AS surfaces, 1 AS fragments FROM w GROUP BY 1")
def edited_gml_documents(spark, sf):
    """The first wall of every building taken out of the documents, a fragment put into each."""
    from .sources import assembly, sinks

    g = sinks.gml_documents(_model_rings(spark, sf))
    first = wall(spark, sf).filter("idx % 4 = 0").select(F.concat(F.lit("m"), (F.col("n_nationkey") % 5).cast("string")).alias("model_id"), F.concat(F.lit("b"), F.col("n_nationkey").cast("string"), F.lit("_"), F.col("idx").cast("string")).alias("surface_id"))
    out = assembly.with_fragments(assembly.without_surfaces(g, first), g.select("model_id", F.lit("<bldg:outerBuildingInstallation/>").alias("fragment")))
    n = lambda t: F.regexp_count("value", F.lit(t)).cast("bigint")
    return out.select("model_id", n("<bldg:WallSurface ").alias("surfaces"), n("<bldg:outerBuildingInstallation/></bldg:Building></core:cityObjectMember></core:CityModel>").alias("fragments"))


@query("cloud", sql=", m AS (SELECT classification, 0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS a FROM cloud GROUP BY 1), p AS (SELECT classification, x * cos(a) + y * sin(a) AS u, y * cos(a) - x * sin(a) AS v, z FROM cloud JOIN m USING (classification)) SELECT classification, round(max(u) - min(u), 6) + 0.0 AS width, round(max(z) - min(z), 6) + 0.0 AS height, round(max(v) - min(v), 6) + 0.0 AS depth, round((max(u) - min(u)) * (max(v) - min(v)), 5) + 0.0 AS area FROM p GROUP BY 1")
def oriented_boxes(spark, sf):
    b = selection.oriented_boxes(cloud(spark, sf), "classification")
    return b.select("classification", r6("width", "width"), r6("height", "height"), r6("depth", "depth"), (F.round(F.abs(G.area_xy(F.col("ring"))), 5) + 0.0).alias("area"))


@query("w", sql="SELECT idx, CAST(2 * power(4, ceil(log2(sqrt(100 + z_max * z_max) / 2.0))) AS BIGINT) AS n, round(10 * z_max, 6) AS area FROM w")
def subdivided_walls(spark, sf):
    t = selection.subdivided(selection.triangles(wall(spark, sf), "idx"), 2.0)
    area = G.norm(G.corner_normal(F.array("a", "b", "c"))) / 2
    return t.groupBy("idx").agg(F.count("*").alias("n"), F.round(F.sum(area), 6).alias("area"))


@query("w", sql="SELECT idx, greatest(100, CAST(floor(10 * z_max / 0.25) AS BIGINT)) AS n, 0.0 AS off_plane, 0 AS outside FROM w")
def wall_samples(spark, sf):
    s = selection.sampled(wall(spark, sf).select("idx", "ring"), "idx", 0.5).join(spatial.small(_plain_walls(spark, sf)), "idx")
    out = ~(F.col("x").between(F.col("x_min") - 1e-9, F.col("x_max") + 1e-9) & F.col("y").between(F.col("y_min") - 1e-9, F.col("y_max") + 1e-9) & F.col("z").between(F.col("z_min"), F.col("z_max")))
    return s.groupBy("idx").agg(F.count("*").alias("n"), (F.round(F.max(F.abs(walls.signed_distance())), 6) + 0.0).alias("off_plane"), F.count_if(out).alias("outside"))


@query("corner", sql=", e AS (SELECT a.idx, CAST(a.k AS INT) AS i, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz FROM corner a JOIN corner b ON a.idx = b.idx AND b.k = (a.k + 1) % 4) SELECT p.idx AS face_1, p.i, q.idx AS face_2, q.i AS j FROM e p JOIN e q ON p.idx < q.idx AND ((sqrt((p.ax - q.ax) ** 2 + (p.ay - q.ay) ** 2 + (p.az - q.az) ** 2) <= 0.05 AND sqrt((p.bx - q.bx) ** 2 + (p.by_ - q.by_) ** 2 + (p.bz - q.bz) ** 2) <= 0.05) OR (sqrt((p.ax - q.bx) ** 2 + (p.ay - q.by_) ** 2 + (p.az - q.bz) ** 2) <= 0.05 AND sqrt((p.bx - q.ax) ** 2 + (p.by_ - q.ay) ** 2 + (p.bz - q.az) ** 2) <= 0.05))")
def edges_within_tolerance(spark, sf):
    return selection.shared_edges_within(wall(spark, sf).select(F.col("idx").alias("face_id"), "ring"))


@query("pts", "w", sql=", n AS (SELECT pid, idx, least(greatest(((x - x_min) * (x_max - x_min) + (y - y_min) * (y_max - y_min)) / ((x_max - x_min) ** 2 + (y_max - y_min) ** 2), 0), 1) AS t, x_min, x_max, y_min, y_max, z_min FROM pts JOIN w ON idx = classification) SELECT pid, round(x_min + t * (x_max - x_min), 6) + 0.0 AS x, round(y_min + t * (y_max - y_min), 6) + 0.0 AS y, round(z_min, 6) + 0.0 AS z FROM n")
def nearest_on_edges(spark, sf):
    w = _plain_walls(spark, sf).select("idx", G.point(F.col("x_min"), F.col("y_min"), F.col("z_min")).alias("a"), G.point(F.col("x_max"), F.col("y_max"), F.col("z_min")).alias("b"))
    p = pts(spark, sf).join(spatial.small(w), F.col("idx") == F.col("classification"))
    n = G.nearest_on_segment({c: F.col(c) for c in "xyz"}, F.col("a"), F.col("b"))
    return p.select("pid", n.alias("n")).select("pid", *(r6(f"n.{c}", c) for c in "xyz"))


@query("rgb", sql=", t AS (SELECT pid, red * 257 AS r, blue * 257 AS b, p_size FROM rgb) SELECT CASE WHEN p_size % 4 = 0 THEN 'Wall' WHEN p_size % 4 = 1 THEN 'Roof' ELSE 'Other' END AS label, count(*) AS n, round(avg(r / 65535.0), 6) AS red, round(avg(CASE p_size % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.2 END), 6) AS shown, count(*) FILTER (r = 0 AND b = 0) AS black FROM t GROUP BY 1")
def labelled_classes(spark, sf):
    t = rgb(spark, sf).withColumns({c: F.col(c) * 257 for c in ("red", "green", "blue")})
    code = F.col("p_size") % 4
    t = C.normalised(t).withColumns({"label": selection.labels_of(code, {0: "Wall", 1: "Roof"}), "shown": C.class_color(code, {0: (1.0, 0, 0), 1: (0.5, 0, 0)})["red"]})
    return t.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("red"), 6).alias("red"), F.round(F.avg("shown"), 6).alias("shown"), F.count_if((F.col("red") == 0) & (F.col("blue") == 0)).alias("black"))


@query("rgb", sql=", q AS (SELECT pid, red // 64 AS red, green // 64 AS green, blue // 64 AS blue FROM rgb), l AS (SELECT red, green, blue, min(pid) % 5 + 1 AS class FROM q WHERE red > 0 GROUP BY ALL) SELECT coalesce(class, 0) AS classification, count(*) AS n FROM q LEFT JOIN l USING (red, green, blue) GROUP BY 1")
def assigned_labels(spark, sf):
    q = rgb(spark, sf).select("pid", *(F.floor(F.col(c) / 64).alias(c) for c in ("red", "green", "blue")))
    labels = q.filter("red > 0").groupBy("red", "green", "blue").agg((F.min("pid") % 5 + 1).alias("class"))
    return C.labelled(q, labels).groupBy("classification").agg(F.count("*").alias("n"))


@query("big", sql=", g AS (SELECT cls AS wall, floor(x / 5) AS i, floor(y / 5) AS j, median(z) AS depth FROM big GROUP BY ALL), b AS (SELECT wall, median(depth) AS base FROM g GROUP BY 1) SELECT wall, CAST(sign(depth - base) AS INT) AS sign, count(*) AS n, round(base, 6) AS base FROM g JOIN b USING (wall) WHERE abs(depth - base) > 0.12 GROUP BY ALL")
def depth_details(spark, sf):
    g = big(spark, sf).groupBy(F.col("cls").alias("wall"), F.floor(F.col("x") / 5).alias("i"), F.floor(F.col("y") / 5).alias("j")).agg(F.median("z").alias("depth"))
    return selection.detail_cells(g, selection.depth_baseline(g)).groupBy("wall", "sign", F.round("base", 6).alias("base")).agg(F.count("*").alias("n"))


@query(sql="SELECT n_nationkey AS k, t.face, t.heading, t.pitch, concat(format('{:.6f}', 14.5 + n_nationkey / 100.0), '_', format('{:.6f}', 121.0), '_', t.face, '.jpg') AS name FROM nation, (VALUES ('front', 0, 0), ('right', 90, 0), ('back', 180, 0), ('left', 270, 0), ('up', 0, 90), ('down', 0, -90)) t(face, heading, pitch)")
def tile_requests(spark, sf):
    n = _table(spark, sf, "nation").select((F.lit(14.5) + F.col("n_nationkey") / 100.0).alias("lat"), F.lit(121.0).alias("lng"))
    return selection.tile_requests(n).select(F.round((F.col("lat") - 14.5) * 100).cast("bigint").alias("k"), "face", "heading", "pitch", "name")


@query(sql="SELECT n_nationkey AS k, concat('labelled_', n_name, '.las') AS labelled, concat('color_segmented_', n_name, '.las') AS segmented, concat(n_name, '_LOD3.json') AS lod3 FROM nation")
def output_names(spark, sf):
    name = F.concat("n_name", F.lit(".las"))
    return _table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), *(X.output_name(name, k).alias(k) for k in ("labelled", "segmented", "lod3")))


# --- files written and read again


@query("w", sql="SELECT concat('m', idx // 4 % 5) AS model_id, 'WallSurface' AS surface_type, count(*) AS n, round(sum(10 * z_max), 6) AS area FROM w GROUP BY 1")
def gml_roundtrip(spark, sf):
    from .sources import documents, sinks

    back = documents.parse_gml_surfaces(sinks.gml_documents(_model_rings(spark, sf)))
    return back.groupBy("model_id", "surface_type").agg(F.count("*").alias("n"), F.round(F.sum(G.norm(G.newell(F.col("ring"))) / 2), 6).alias("area"))


@query(sql="SELECT 'all' AS source, n_nationkey AS k, round((1 + n_nationkey) * 2.0, 6) AS area FROM nation")
def geojson_roundtrip(spark, sf):
    from .sources import documents, sinks

    at = lambda x, y: F.struct(F.lit(float(x)).cast("double").alias("x") if not isinstance(x, Column) else x.cast("double").alias("x"), F.lit(float(y)).alias("y"), F.lit(0.0).alias("z"))
    k = F.col("n_nationkey")
    features = sinks.geojson_features(_table(spark, sf, "nation").select("n_nationkey", F.array(at(0, 0), at(k + 1, 0), at(k + 1, 2), at(0, 2)).alias("ring")), "n_nationkey")
    text = features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.sort_array(F.collect_list("value")), ","), F.lit("]}")).alias("value")).select(F.lit("all").alias("source"), "value")
    back = documents.parse_footprints(text)
    return back.select("source", (F.array_max("ring.x") - 1).cast("bigint").alias("k"), F.round(F.abs(G.area_xy(F.col("ring"))), 6).alias("area"))


@query(sql="SELECT l_returnflag AS cloud_id, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS x, CAST(sum(l_linenumber) AS BIGINT) AS y, round(max(l_discount) * 100, 3) AS z, CAST(sum(l_suppkey % 32) AS BIGINT) AS classes FROM lineitem GROUP BY 1")
def las_roundtrip(spark, sf):
    """One image a return flag, whose records are read again."""
    from .sources import las

    t = _table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("cloud_id"), F.col("l_quantity").cast("double").alias("x"), F.col("l_linenumber").cast("double").alias("y"), (F.col("l_discount") * 100).cast("double").alias("z"), (F.col("l_suppkey") % 32).cast("int").alias("classification"))
    back = las.read_las_table(las.las_images(t).withColumnRenamed("cloud_id", "path"))
    total = lambda c: F.round(F.sum(c)).cast("bigint")
    return back.groupBy("cloud_id").agg(F.count("*").alias("n"), total("x").alias("x"), total("y").alias("y"), F.round(F.max("z"), 3).alias("z"), F.sum("classification").cast("bigint").alias("classes"))


@query(sql="SELECT concat('f', n_regionkey) AS feature_id, 100 + n_nationkey % 3 AS code, concat('b', n_nationkey) AS obj_id, n_nationkey % 4 AS face FROM nation WHERE n_nationkey % 3 = 1")
def report_scan(spark, sf):
    from .sources import documents

    e = F.struct((F.col("n_nationkey") % 3 + 100).alias("code"), F.lit("d").alias("description"), F.lit("").alias("info"), F.concat(F.lit("coid=b"), F.col("n_nationkey").cast("string"), F.lit("|geom=0|shell=0|face="), (F.col("n_nationkey") % 4).cast("string")).alias("id"))
    f = _table(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list(e).alias("errors")).select(F.struct(F.concat(F.lit("f"), F.col("n_regionkey").cast("string")).alias("id"), F.lit("Building").alias("type"), "errors").alias("f"))
    text = f.agg(F.to_json(F.struct(F.collect_list("f").alias("features"))).alias("value"))
    return documents.report_errors(text, 101).select("feature_id", F.col("code").cast("bigint").alias("code"), F.col("id")["coid"].alias("obj_id"), F.col("id")["face"].cast("bigint").alias("face"))


@query("cloud", sql=", d AS (SELECT a.pid AS qid, b.classification AS value, sqrt((a.x + 0.05 - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS r, row_number() OVER (PARTITION BY a.pid ORDER BY (a.x + 0.05 - b.x) * (a.x + 0.05 - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), b.pid) AS k FROM cloud a, cloud b) SELECT qid AS pid, round(sum(value / (r + 1e-8)) / sum(1 / (r + 1e-8)), 5) + 0.0 AS value FROM d WHERE k <= 3 GROUP BY 1")
def spread_values(spark, sf):
    c = cloud(spark, sf)
    s = facades.spread_values(c.withColumn("x", F.col("x") + 0.05), c.withColumn("value", F.col("classification").cast("double")), 3, 0.1)
    return s.select("pid", (F.round("value", 5) + 0.0).alias("value"))


@query("pts", sql="SELECT min(pid) AS pid FROM pts GROUP BY floor(x / 10), floor(y / 10), floor(z / 10)")
def thinned_samples(spark, sf):
    return facades.thinned_samples(pts(spark, sf), 10.0).select("pid")


@query(sql="""WITH p AS (SELECT i % 64 AS u, i // 64 AS v, ((i % 64 + 0.5) / 64 - 0.5) * 2 * pi() AS lon, (0.5 - (i // 64 + 0.5) / 32) * pi() AS lat FROM generate_series(0, 2047) t(i)),
  d AS (SELECT *, cos(lat) * cos(lon) AS x, cos(lat) * sin(lon) AS y, sin(lat) AS z FROM p),
  f AS (SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN CASE WHEN x > 0 THEN 'front' ELSE 'back' END WHEN abs(y) >= abs(z) THEN CASE WHEN y > 0 THEN 'right' ELSE 'left' END WHEN z > 0 THEN 'up' ELSE 'down' END AS face, greatest(abs(x), abs(y), abs(z)) AS m FROM d)
  SELECT face, count(*) AS n, CAST(min(u) AS INT) AS u0, CAST(max(v) AS INT) AS v1 FROM f GROUP BY 1""")
def panorama_inverse(spark, sf):
    return panorama.panorama_source(spark, 64, 32, 16).groupBy("face").agg(F.count("*").alias("n"), F.min("u").alias("u0"), F.max("v").alias("v1"))
