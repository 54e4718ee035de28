"""Polygons on grids: points located by an edge index, polygons filled with cells, rasters summed inside polygons.

A polygon is ``rings``, an array of rings of struct<lon, lat> (or ``ring``, one of them). All its rings count together by the
even-odd rule, so holes and parts need no marks, and a closing corner may stand or not. Points on an edge are outside. Rings do not
cross the antimeridian; ``split_at_antimeridian`` makes two of one that does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEST, SOUTH = -180.0, -90.0
COARSEST, LEVELS = 16.0, 24  # degrees of a cell of level 0; each level halves it
SHIFT = 0.3819660112501051  # the index's lines lie off the round numbers on which corners stand


def with_rings(polygons: DataFrame) -> DataFrame:
    return polygons if "rings" in polygons.columns else polygons.withColumn("rings", F.array("ring"))


def edges(polygons: DataFrame, code: str = "code", *carry: str) -> DataFrame:
    """A row per edge: code, ring (its number), ax, ay, bx, by. Null and empty rings have none, nor do two equal corners in a row."""
    ring = with_rings(polygons).select(code, *carry, F.posexplode("rings").alias("ring", "r")).where(F.size("r") > 0)
    after = F.concat(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1))
    pair = ring.select(code, *carry, "ring", F.explode(F.arrays_zip(F.col("r").alias("a"), after.alias("b"))).alias("e"))
    flat = pair.select(code, *carry, "ring", *[F.col(f"e.{p}.{c}").cast("double").alias(p + x) for p in "ab" for c, x in (("lon", "x"), ("lat", "y"))])
    return flat.where("ax <> bx OR ay <> by")


def _at(y: Column, ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by") -> Column:
    """Where an edge that is not level meets the line of height y."""
    return F.col(ax) + (F.col(bx) - F.col(ax)) * ((y - F.col(ay)) / F.nullif(F.col(by) - F.col(ay), F.lit(0.0)))


# cells by their centres


def line_spans(polygons: DataFrame, size: float, code: str = "code") -> DataFrame:
    """(code, line, low, high): of each line of grid cells the runs of columns whose centre lies inside the polygon.

    Edges meet the lines of centres one by one, so the work is the polygon's lines and not its cells. A centre on a sloping edge is no column between two
    crossings; one on a level edge has the polygon on one side only, so runs hold just above and just below the line.
    """
    e = edges(polygons, code)
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    line = F.sequence(F.floor((low - SOUTH) / size) - 1, F.floor((high - SOUTH) / size) + 1)
    y = SOUTH + (F.col("line") + 0.5) * size
    met = e.withColumn("line", F.explode(line)).withColumn("y", y).withColumn("x", _at(F.col("y")))
    above, below = (F.col("ay") > F.col("y")) != (F.col("by") > F.col("y")), (F.col("ay") >= F.col("y")) != (F.col("by") >= F.col("y"))
    per = met.where(above | below).groupBy(code, "line").agg(*[F.sort_array(F.collect_list(F.when(on, F.col("x")))).alias(name) for name, on in (("up", above), ("down", below))])

    def runs(xs: str) -> Column:
        centre = lambda c: WEST + (c + 0.5) * size

        def run(k: Column) -> Column:
            a, b = F.get(xs, 2 * k), F.get(xs, 2 * k + 1)
            near_a, near_b = F.floor((a - WEST) / size - 0.5), F.floor((b - WEST) / size - 0.5) + 1
            return F.struct(
                F.when(centre(near_a) > a, near_a).when(centre(near_a + 1) > a, near_a + 1).otherwise(near_a + 2).alias("low"),
                F.when(centre(near_b) < b, near_b).when(centre(near_b - 1) < b, near_b - 1).otherwise(near_b - 2).alias("high"),
            )

        made = F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1), run)
        return F.when(F.size(xs) > 1, F.filter(made, lambda s: s["low"] <= s["high"])).otherwise(F.array().cast("array<struct<low: bigint, high: bigint>>"))

    both = F.flatten(F.transform(runs("up"), lambda u: F.filter(
        F.transform(runs("down"), lambda d: F.struct(F.greatest(u["low"], d["low"]).alias("low"), F.least(u["high"], d["high"]).alias("high"))), lambda s: s["low"] <= s["high"]
    )))
    return per.select(code, "line", F.explode(F.when(F.col("up") == F.col("down"), runs("up")).otherwise(both)).alias("s")).select(code, "line", "s.low", "s.high")


def fill(polygons: DataFrame, resolution: int, code: str = "code") -> DataFrame:
    """(code, cell): every cell of ``scalar.grid_cell`` whose centre lies inside the polygon, once."""
    spans = line_spans(polygons, 10.0 / 2**resolution, code)
    return spans.select(code, "line", F.explode(F.sequence("low", "high")).alias("column")).select(code, F.concat_ws(":", F.lit(resolution), "line", "column").alias("cell"))


def split_at_antimeridian(ring: Column) -> Column:
    """A ring -> an array of rings: one that spans over 180 degrees is taken to cross the antimeridian and is cut there into its eastern and western part."""
    lons = F.transform(ring, lambda p: p["lon"].cast("double"))
    corner = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    shifted = F.transform(ring, lambda p: corner(F.when(p["lon"] < 0, p["lon"] + 360.0).otherwise(p["lon"]).cast("double"), p["lat"].cast("double")))
    after = F.concat(F.slice(shifted, 2, F.size(shifted)), F.slice(shifted, 1, 1))

    def part(side: int, back: float) -> Column:
        """Keeps the corners on one side and a corner wherever an edge meets the line; ``back`` moves them to where they belong."""

        def kept(e: Column) -> Column:
            a, b = e["a"], e["b"]
            here, there = (180.0 - a["lon"]) * side >= 0, (180.0 - b["lon"]) * side >= 0
            cut = corner(F.lit(180.0 + back), a["lat"] + (b["lat"] - a["lat"]) * ((180.0 - a["lon"]) / F.nullif(b["lon"] - a["lon"], F.lit(0.0))))
            return F.array_compact(F.array(F.when(here, corner(a["lon"] + back, a["lat"])), F.when(here != there, cut)))

        return F.flatten(F.transform(F.arrays_zip(shifted.alias("a"), after.alias("b")), kept))

    halves = F.filter(F.array(part(1, 0.0), part(-1, -360.0)), lambda r: F.size(r) > 2)
    plain = F.array(F.transform(ring, lambda p: corner(p["lon"].cast("double"), p["lat"].cast("double"))))
    return F.when(F.array_max(lons) - F.array_min(lons) > 180, halves).otherwise(plain)


# sums over rasters


def raster_lines(pixels: DataFrame, tile: int = 512) -> DataFrame:
    """pixels (line, column, value) -> raster tiles as rows: (line, tile, sums), the running sums of ``tile`` pixels of a line.

    sums has one number more than the tile has pixels, so the sum from column a to b is a difference of two. Absent pixels, nulls and NaN count as no data;
    several values of one pixel add up.
    """
    dense = pixels.groupBy("line", F.floor(F.col("column") / tile).alias("tile")).agg(F.collect_list(F.struct(F.pmod("column", F.lit(tile)).cast("int").alias("at"), F.col("value").cast("double").alias("value"))).alias("p"))
    rows = dense.select(F.col("line").cast("long").alias("line"), "tile", F.col("p.at").alias("at"), F.col("p.value").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = batch.column("at"), batch.column("value")
            row = np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy()))
            grid = np.zeros((batch.num_rows, tile + 1))
            np.add.at(grid, (row, at.flatten().to_numpy() + 1), np.nan_to_num(value.flatten().to_numpy(zero_copy_only=False)))
            sums = np.cumsum(grid, axis=1)
            cuts = np.arange(batch.num_rows + 1, dtype=np.int32) * (tile + 1)
            yield pa.RecordBatch.from_arrays([batch.column("line"), batch.column("tile"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(sums.ravel()))], ["line", "tile", "sums"])

    return rows.mapInArrow(run, "line long, tile long, sums array<double>")


def zonal_sums(lines: DataFrame, polygons: DataFrame, size: float, tile: int = 512, code: str = "code") -> DataFrame:
    """Raster lines and polygons -> (code, total, pixels): the sum and the number of grid pixels whose centre lies inside each polygon; 0 without one.

    A polygon costs two numbers for each raster line and tile that it covers, whatever the number of pixels between them.
    """
    spans = line_spans(polygons, size, code).withColumn("tile", F.explode(F.sequence(F.floor(F.col("low") / tile), F.floor(F.col("high") / tile))))
    low, high = F.greatest("low", F.col("tile") * tile) - F.col("tile") * tile, F.least("high", F.col("tile") * tile + tile - 1) - F.col("tile") * tile
    placed = spans.select(code, "line", "tile", low.cast("int").alias("a"), (high + 1).cast("int").alias("b"))
    part = placed.join(lines, ["line", "tile"], "left").select(code, F.coalesce(F.get("sums", "b") - F.get("sums", "a"), F.lit(0.0)).alias("part"), (F.col("b") - F.col("a")).alias("n"))
    per = part.groupBy(code).agg(F.sum("part").alias("total"), F.sum("n").alias("pixels"))
    return polygons.select(code).distinct().join(per, code, "left").select(code, F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("pixels", F.lit(0)).cast("long").alias("pixels"))


# points by an index of edges


def _size(level: Column) -> Column:
    return F.lit(COARSEST) / F.pow(F.lit(2.0), level)


def leveled(polygons: DataFrame, code: str) -> DataFrame:
    """Adds ``level``: the grid on which a polygon has about as many cells as edges."""
    rings = with_rings(polygons)
    corners = F.flatten("rings")
    xs, ys = F.transform(corners, lambda p: p["lon"].cast("double")), F.transform(corners, lambda p: p["lat"].cast("double"))
    wide, tall = F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
    cell = F.greatest(F.sqrt(wide * tall / F.size(corners)), F.greatest(wide, tall) / F.size(corners), F.lit(1e-9))
    level = F.least(F.greatest(F.ceil(F.log2(F.lit(COARSEST) / cell)), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    return rings.where(F.size(corners) > 0).select(code, "rings", level.alias("level"))


def _gridded(e: DataFrame) -> DataFrame:
    """Adds an edge's corners in cells of its level."""
    u = lambda x: (F.col(x) - WEST) / _size(F.col("level")) + SHIFT
    v = lambda y: (F.col(y) - SOUTH) / _size(F.col("level")) + SHIFT
    return e.withColumns({"au": u("ax"), "av": v("ay"), "bu": u("bx"), "bv": v("by")})


def _touched(e: DataFrame) -> DataFrame:
    """An edge -> a row for each cell (i, j) of its level that it passes."""
    low, high = F.least("av", "bv"), F.greatest("av", "bv")
    row = e.withColumn("j", F.explode(F.sequence(F.floor(low), F.floor(high))))
    enters, leaves = _at(F.greatest(low, F.col("j")), "au", "av", "bu", "bv"), _at(F.least(high, F.col("j") + 1.0), "au", "av", "bu", "bv")
    a, b = F.coalesce(enters, F.col("au")), F.coalesce(leaves, F.col("bu"))
    return row.withColumn("i", F.explode(F.sequence(F.floor(F.least(a, b) - 1e-9), F.floor(F.greatest(a, b) + 1e-9))))


def edge_index(polygons: DataFrame, code: str = "code") -> DataFrame:
    """(code, level, i, j, odd, edges): the cells of a polygon's own grid that it touches or covers.

    edges are those that pass the cell; odd tells whether the cell's lower left corner is inside. A cell without edges whose corner is
    outside has no row, so a point meets a polygon only where it may be inside, and tests the edges of that cell alone.
    """
    e = _gridded(edges(leveled(polygons, code), code, "level"))
    edge = F.struct("ax", "ay", "bx", "by", "au", "av", "bu", "bv")
    passed = _touched(e).select(code, "level", "i", "j", F.lit(0).alias("odd"), edge.alias("edge"))
    lines = e.withColumn("j", F.explode(F.sequence(F.floor(F.least("av", "bv")), F.floor(F.greatest("av", "bv"))))).where((F.col("av") > F.col("j")) != (F.col("bv") > F.col("j")))
    xs = lines.groupBy(code, "level", "j").agg(F.sort_array(F.collect_list(_at(F.col("j").cast("double"), "au", "av", "bu", "bv"))).alias("xs"))
    run = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda k: F.struct(F.ceil(F.get("xs", 2 * k)).alias("low"), (F.ceil(F.get("xs", 2 * k + 1)) - 1).alias("high")))
    runs = xs.where(F.size("xs") > 1).select(code, "level", "j", F.explode(F.filter(run, lambda s: s["low"] <= s["high"])).alias("s"))
    covered = runs.select(code, "level", F.explode(F.sequence("s.low", "s.high")).alias("i"), "j", F.lit(1).alias("odd"), F.lit(None).cast(passed.schema["edge"].dataType).alias("edge"))
    return passed.unionByName(covered).groupBy(code, "level", "i", "j").agg(F.max("odd").alias("odd"), F.collect_list("edge").alias("edges"))


def locate(points: DataFrame, polygons: DataFrame, point_id: str = "point_id", code: str = "code") -> DataFrame:
    """points (id, lat, lon) -> (id, code), a row for every polygon that a point lies strictly inside.

    From the cell's corner, whose side is known, a path goes along the cell's lower border and then up to the point; each edge of the cell that it meets changes
    the side. Points meet polygons by equal cells; of the levels there are ``LEVELS`` at most. Points without coordinates are nowhere.
    """
    index = edge_index(polygons, code)
    levels = leveled(polygons, code).agg(F.collect_set("level").alias("_levels"))
    placed = points.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)").select(point_id, F.col("lat").cast("double").alias("_lat"), F.col("lon").cast("double").alias("_lon"))
    placed = placed.crossJoin(levels).withColumn("level", F.explode("_levels")).drop("_levels")  # one row of at most LEVELS numbers
    u, v = (F.col("_lon") - WEST) / _size(F.col("level")) + SHIFT, (F.col("_lat") - SOUTH) / _size(F.col("level")) + SHIFT
    placed = placed.withColumn("_u", u).withColumn("_v", v).withColumn("i", F.floor("_u")).withColumn("j", F.floor("_v"))
    x, y, pu, pv, i, j = (F.col(c) for c in ("_lon", "_lat", "_u", "_v", "i", "j"))

    def on(e: Column) -> Column:
        cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
        return (cross == 0) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    def met(e: Column) -> Column:
        across = e["au"] + (e["bu"] - e["au"]) * ((j - e["av"]) / F.nullif(e["bv"] - e["av"], F.lit(0.0)))
        border = ((e["av"] > j) != (e["bv"] > j)) & (across > i) & (across <= pu)
        height = e["av"] + (e["bv"] - e["av"]) * ((pu - e["au"]) / F.nullif(e["bu"] - e["au"], F.lit(0.0)))
        up = ((e["au"] > pu) != (e["bu"] > pu)) & (height > j) & (height < pv)
        return F.coalesce(border, F.lit(False)).cast("int") + F.coalesce(up, F.lit(False)).cast("int")

    flips = F.aggregate(F.transform("edges", met), F.col("odd"), lambda s, n: s + n)
    return placed.join(index, ["level", "i", "j"]).where(~F.exists("edges", on) & (flips % 2 == 1)).select(point_id, code)


def point_in_polygon(points: DataFrame, polygons: DataFrame, point_id: str = "point_id") -> DataFrame:
    """points (id, lat, lon) and polygons (code, and ring or rings) -> (id, code, hits): code is null where none or several contain the point."""
    per = locate(points, polygons, point_id).groupBy(point_id).agg(F.count_distinct("code").alias("hits"), F.min("code").alias("code"))
    return points.select(point_id).join(per, point_id, "left").select(
        point_id, F.when(F.col("hits") == 1, F.col("code")).alias("code"), F.coalesce("hits", F.lit(0)).cast("long").alias("hits")
    )


def polygons_intersect(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(left_id, ring or rings) and (right_id, ring or rings) -> the pairs of polygons that share a point: edges that cross or touch, or one within the other.

    Edges meet by cell, on the coarser of two polygons' grids, where the coarser one has few edges to a cell. If no edge meets another, each ring of the one
    lies wholly inside or outside of the other, so one corner of a ring tells it. A polygon in the hole of another shares nothing with it.
    """
    a, b = leveled(left, left_id), leveled(right, right_id)
    levels = a.select("level").unionByName(b.select("level")).agg(F.collect_set("level").alias("_levels"))

    def filed(df: DataFrame, name: str, side: str) -> DataFrame:
        own = edges(df.withColumnRenamed("level", "own"), name, "own").crossJoin(levels)
        here = own.withColumn("level", F.explode(F.filter("_levels", lambda x: x <= F.col("own")))).drop("_levels")
        return _touched(_gridded(here)).select(name, "level", "i", "j", F.struct("own", "ax", "ay", "bx", "by").alias(side))

    met = filed(a, left_id, "_a").join(filed(b, right_id, "_b"), ["level", "i", "j"]).where((F.col("_a.own") == F.col("level")) | (F.col("_b.own") == F.col("level")))
    u, v = F.col("_a"), F.col("_b")
    corner = lambda e, p: (e[f"{p}x"], e[f"{p}y"])
    side = lambda p, q, r: F.signum((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
    within = lambda p, q, r: r[0].between(F.least(p[0], q[0]), F.greatest(p[0], q[0])) & r[1].between(F.least(p[1], q[1]), F.greatest(p[1], q[1]))
    p, q, r, s = corner(u, "a"), corner(u, "b"), corner(v, "a"), corner(v, "b")
    d1, d2, d3, d4 = side(p, q, r), side(p, q, s), side(r, s, p), side(r, s, q)
    touch = ((d1 == 0) & within(p, q, r)) | ((d2 == 0) & within(p, q, s)) | ((d3 == 0) & within(r, s, p)) | ((d4 == 0) & within(r, s, q))
    crossed = met.where(((d1 * d2 < 0) & (d3 * d4 < 0)) | touch).select(left_id, right_id)

    def inner(inside: DataFrame, inside_id: str, around: DataFrame, around_id: str) -> DataFrame:
        first = inside.select(inside_id, F.explode("rings").alias("r")).where(F.size("r") > 0).select(inside_id, F.get("r", F.lit(0)).alias("p")).select(inside_id, "p.lat", "p.lon")
        return locate(first, around, inside_id, around_id).select(left_id, right_id)

    return crossed.unionByName(inner(b, right_id, a, left_id)).unionByName(inner(a, left_id, b, right_id)).distinct()
