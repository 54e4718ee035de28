"""Queries on polygons, grids and rasters: each nation is an L with a slanted hole, customers and orders are points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators import areas
from terravane.plans.catalog import query, t

OUTLINE, HOLE = ((0, 0), (12, 0), (12, 20), (6, 20), (6, 40), (0, 40)), ((2, 2), (4, 2), (4, 6), (3, 9))
WEDGE = ((0, 0), (9, 3), (2, 11))


def _ring(x: Column, y: Column, corners: tuple[tuple[int, int], ...]) -> Column:
    return F.array(*[F.struct((x + F.lit(float(a))).alias("lon"), (y + F.lit(float(b))).alias("lat")) for a, b in corners])


def _lands(spark: SparkSession, d: str, shift: float = 0.0) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = k * 14.0 - 180 + shift, (k % 5) * 3.0 - 40 + shift
    return t(spark, d, "nation").select(k.alias("code"), F.array(_ring(x, y, OUTLINE), _ring(x, y, HOLE)).alias("rings"))


def _edge_sql(name: str, key: str, x: str, y: str, table: str, *rings: tuple[tuple[int, int], ...]) -> str:
    rows = ", ".join(f"({n}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for n, r in enumerate(rings) for a, b in zip(r, (*r[1:], r[0]), strict=True))
    return f"{name} AS (SELECT {key} AS code, n AS ring, {x} + u1 AS x1, {y} + v1 AS y1, {x} + u2 AS x2, {y} + v2 AS y2 FROM {table}, (VALUES {rows}) v(n, u1, v1, u2, v2))"


def _land_sql(shift: float = 0.0) -> str:
    return _edge_sql("e", "n_nationkey", f"n_nationkey * 14.0::DOUBLE - 180 + {shift}", f"(n_nationkey % 5) * 3.0::DOUBLE - 40 + {shift}", "nation", OUTLINE, HOLE)


# even-odd y2 the edges to the right of (x, y); a point on an edge is outside
INSIDE = """count(*) FILTER (WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1
  AND NOT bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2))"""


@query(f"""WITH {_land_sql()}, p AS (SELECT c_custkey AS point_id, (c_custkey * 101 % 360 - 180)::DOUBLE AS x, (c_custkey * 37 % 90 - 45)::DOUBLE AS y FROM customer),
h AS (SELECT point_id, code FROM p, e GROUP BY point_id, code, x, y HAVING {INSIDE}), n AS (SELECT point_id, count(*) AS hits, min(code) AS code FROM h GROUP BY 1)
SELECT p.point_id, CASE WHEN hits = 1 THEN code END AS code, coalesce(hits, 0) AS hits FROM p LEFT JOIN n USING (point_id)""")
def points_on_edges(spark: SparkSession, d: str) -> DataFrame:
    """Points at whole degrees against outlines at whole degrees: many lie on edges and corners, which are outside."""
    k = F.col("c_custkey")
    points = t(spark, d, "customer").select(k.alias("point_id"), (k * 37 % 90 - 45).cast("double").alias("lat"), (k * 101 % 360 - 180).cast("double").alias("lon"))
    return areas.point_in_polygon(points, _lands(spark, d))


@query(f"""WITH {_land_sql(0.5)}, c AS (SELECT i, j, -90 + (i + 0.5::DOUBLE) * 2.5 AS y, -180 + (j + 0.5::DOUBLE) * 2.5 AS x FROM range(0, 72) a(i), range(0, 144) b(j))
SELECT code, '2:' || i || ':' || j AS cell FROM c, e GROUP BY code, i, j, x, y HAVING {INSIDE}""")
def polygon_cell_fill(spark: SparkSession, d: str) -> DataFrame:
    """The grid cells whose centre lies in each outline and not in its hole."""
    return areas.fill(_lands(spark, d, 0.5), 2)


@query(f"""WITH {_land_sql(0.25)}, o AS (SELECT floor((o_orderkey * 7919 % 36000 / 100.0::DOUBLE) / 0.5)::BIGINT AS j, floor((o_orderkey * 104729 % 12000 / 100.0::DOUBLE + 30) / 0.5)::BIGINT AS i, o_custkey AS v FROM orders),
c AS (SELECT i, j, sum(v) AS v, -90 + (i + 0.5::DOUBLE) * 0.5 AS y, -180 + (j + 0.5::DOUBLE) * 0.5 AS x FROM o GROUP BY i, j),
h AS (SELECT code, i, j, any_value(v) AS v FROM c, e GROUP BY code, i, j, x, y HAVING {INSIDE}), s AS (SELECT code, sum(v)::DOUBLE AS total FROM h GROUP BY 1),
g AS (SELECT i, j, -90 + (i + 0.5::DOUBLE) * 0.5 AS y, -180 + (j + 0.5::DOUBLE) * 0.5 AS x FROM range(96, 212) a(i), range(0, 720) b(j)),
n AS (SELECT code, count(*) AS pixels FROM (SELECT code FROM g, e WHERE TRUE GROUP BY code, i, j, x, y HAVING {INSIDE}) GROUP BY 1)
SELECT code, coalesce(total, 0) AS total, pixels FROM n LEFT JOIN s USING (code)""")
def raster_zonal_sums(spark: SparkSession, d: str) -> DataFrame:
    """Orders binned into a raster of half degrees, summed inside each nation's outline y2 runs of raster lines."""
    k = F.col("o_orderkey")
    lat, lon = k * 104729 % 12000 / 100.0 - 60, k * 7919 % 36000 / 100.0 - 180
    pixels = t(spark, d, "orders").select(F.floor((lat + 90) / 0.5).alias("line"), F.floor((lon + 180) / 0.5).alias("column"), F.col("o_custkey").alias("value"))
    pixels = pixels.groupBy("line", "column").agg(F.sum("value").alias("value"))
    return areas.zonal_sums(areas.raster_lines(pixels, 64), _lands(spark, d, 0.25), 0.5, 64)


@query("""WITH c AS (SELECT c_custkey AS code, 160.0::DOUBLE + c_custkey % 40 AS w, 5.0::DOUBLE + c_custkey % 11 AS wide, -60.0::DOUBLE + c_custkey % 100 AS s FROM customer)
SELECT code, CASE WHEN w < 180 AND w + wide > 180 THEN 2 ELSE 1 END AS parts, CASE WHEN w < 180 AND w + wide > 180 THEN (180 - w) * 2 WHEN w >= 180 THEN 0 ELSE wide * 2 END AS east, CASE WHEN w < 180 AND w + wide > 180 THEN (w + wide - 180) * 2 WHEN w >= 180 THEN wide * 2 ELSE 0 END AS west FROM c""")
def antimeridian_parts(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of two degrees' height around the antimeridian, cut there: number of parts and the area on either side."""
    k = F.col("c_custkey")
    home = lambda x: F.when(x > 180, x - 360).otherwise(x)
    w, s = 160.0 + k % 40, -60.0 + k % 100
    w, e = F.when(w >= 180, w - 360).otherwise(w), home(w + 5.0 + k % 11)
    ring = F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((w, s), (e, s), (e, s + 2), (w, s + 2))])
    parts = t(spark, d, "customer").select(k.alias("code"), areas.split_at_antimeridian(ring).alias("rings"))
    flat = parts.select("code", F.size("rings").alias("parts"), F.explode("rings").alias("r")).withColumn("q", F.concat(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1)))
    doubled = F.aggregate(F.zip_with("r", "q", lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"]), F.lit(0.0), lambda s, x: s + x)
    east = F.array_max(F.transform("r", lambda p: p["lon"])) > 0
    area = F.abs(doubled) / 2
    return flat.groupBy("code", "parts").agg(F.sum(F.when(east, area).otherwise(0.0)).alias("east"), F.sum(F.when(~east, area).otherwise(0.0)).alias("west"))


@query(f"""WITH {_land_sql()}, {_edge_sql("f", "c_custkey", "(c_custkey * 53 % 350 - 180)::DOUBLE", "(c_custkey * 29 % 70 - 45)::DOUBLE", "customer", WEDGE).replace("FROM customer", "FROM (SELECT * FROM customer WHERE c_acctbal > 5000)")},
m AS (SELECT e.code AS land, f.code AS wedge, e.x1 AS px, e.y1 AS py, e.x2 AS qx, e.y2 AS qy, f.x1 AS rx, f.y1 AS ry, f.x2 AS sx, f.y2 AS sy FROM e JOIN f ON least(e.x1, e.x2) <= greatest(f.x1, f.x2) AND least(f.x1, f.x2) <= greatest(e.x1, e.x2) AND least(e.y1, e.y2) <= greatest(f.y1, f.y2) AND least(f.y1, f.y2) <= greatest(e.y1, e.y2)),
s AS (SELECT land, wedge, sign((qx-px)*(ry-py)-(qy-py)*(rx-px)) AS d1, sign((qx-px)*(sy-py)-(qy-py)*(sx-px)) AS d2, sign((sx-rx)*(py-ry)-(sy-ry)*(px-rx)) AS d3, sign((sx-rx)*(qy-ry)-(sy-ry)*(qx-rx)) AS d4 FROM m),
x AS (SELECT land, wedge FROM s WHERE d1 * d2 <= 0 AND d3 * d4 <= 0),
a AS (SELECT e.code AS land, p.code AS wedge FROM (SELECT code, x1 AS x, y1 AS y FROM f) p, e GROUP BY e.code, p.code, x, y HAVING {INSIDE}),
b AS (SELECT p.code AS land, f.code AS wedge FROM (SELECT code, x1 AS x, y1 AS y FROM e) p, f GROUP BY p.code, f.code, x, y HAVING {INSIDE})
SELECT land, wedge FROM x UNION SELECT land, wedge FROM a UNION SELECT land, wedge FROM b""")
def polygon_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Wedges at customers against the nations' outlines with holes; corners and edges that only touch count."""
    k = F.col("c_custkey")
    ring = _ring((k * 53 % 350 - 180).cast("double"), (k * 29 % 70 - 45).cast("double"), WEDGE)
    wedges = t(spark, d, "customer").where("c_acctbal > 5000").select(k.alias("wedge"), ring.alias("ring"))
    return areas.polygons_intersect(_lands(spark, d).withColumnRenamed("code", "land"), wedges, "land", "wedge")
