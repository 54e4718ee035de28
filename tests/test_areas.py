"""Polygons, fills and raster sums against plain code."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.operators import areas

POLYGONS = "code string, rings array<array<struct<lon: double, lat: double>>>"


def on_edge(p, q, x, y):
    cross = (q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0])
    return cross == 0 and min(p[0], q[0]) <= x <= max(p[0], q[0]) and min(p[1], q[1]) <= y <= max(p[1], q[1])


def inside(rings, x, y):
    odd = False
    for ring in rings or []:
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            if p != q and on_edge(p, q, x, y):
                return False
            if (p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0]:
                odd = not odd
    return odd


def star(rng, x, y, n, size):
    turn = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(x + rng.uniform(0.2, 1) * size * math.cos(t), y + rng.uniform(0.2, 1) * size * math.sin(t)) for t in turn]


SHAPES = {
    "L": [[(0.0, 0.0), (12.0, 0.0), (12.0, 6.0), (6.0, 6.0), (6.0, 14.0), (0.0, 14.0)]],
    "hole": [[(20.0, 0.0), (30.0, 0.0), (30.0, 10.0), (20.0, 10.0), (20.0, 0.0)], [(23.0, 3.0), (27.0, 3.0), (27.0, 7.0), (23.0, 7.0)]],
    "diamond": [[(40.0, 5.0), (45.0, 0.0), (50.0, 5.0), (45.0, 10.0)]],
    "notch": [[(60.0, 0.0), (70.0, 0.0), (70.0, 10.0), (65.0, 5.0), (60.0, 10.0)]],
    "parts": [[(80.0, 0.0), (84.0, 0.0), (84.0, 4.0), (80.0, 4.0)], [(86.0, 0.0), (90.0, 0.0), (90.0, 4.0)]],
    "over": [[(2.0, 2.0), (25.0, 2.0), (25.0, 5.0), (2.0, 5.0)]],
    "line": [[(5.0, 5.0), (9.0, 5.0)]],
    "none": [],
}


def test_points_against_plain_code(spark):
    """Points at whole degrees on corners and edges, shapes of very different sizes and numbers of corners, and points without coordinates."""
    rng = random.Random(4)
    shapes = SHAPES | {f"star{i}": [star(rng, rng.uniform(-100, 100), rng.uniform(-50, 50), n, s)] for i, (n, s) in enumerate([(3, 1e-3), (40, 0.5), (400, 30), (9, 80)])}
    points = [(x, y) for x in range(-2, 92) for y in range(-1, 16)]
    points += [(rng.uniform(-120, 120), rng.uniform(-90, 90)) for _ in range(1500)] + [p for r in shapes.values() for ring in r for p in ring[:50]]
    points += [(x + rng.uniform(-1e-3, 1e-3), y + rng.uniform(-1e-3, 1e-3)) for r in shapes.values() for ring in r for x, y in ring[:9]]
    rows = [(i, float(y), float(x)) for i, (x, y) in enumerate(points)]
    frame = spark.createDataFrame([*rows, (-1, None, 3.0), (-2, float("nan"), 3.0)], "point_id int, lat double, lon double")
    got = {(r.point_id, r.code) for r in areas.locate(frame, spark.createDataFrame([*shapes.items(), ("null", None)], POLYGONS)).collect()}
    assert got == {(i, c) for i, y, x in rows for c, rings in shapes.items() if inside(rings, x, y)}
    per = {r.point_id: (r.code, r.hits) for r in areas.point_in_polygon(frame, spark.createDataFrame(list(shapes.items()), POLYGONS)).collect()}
    assert len(per) == len(rows) + 2 and per[-1] == (None, 0) and any(h > 1 and c is None for c, h in per.values())
    assert areas.point_in_polygon(frame.limit(0), spark.createDataFrame([], POLYGONS)).count() == 0


def test_an_outline_of_many_corners_costs_a_few_edges(spark):
    n = 50_000
    ring = [(30 * math.cos(2 * math.pi * i / n) * (1 + 0.02 * math.sin(i)), 30 * math.sin(2 * math.pi * i / n) * (1 + 0.02 * math.sin(i))) for i in range(n)]
    index = areas.edge_index(spark.createDataFrame([("big", [ring])], POLYGONS))
    stats = index.agg(F.avg(F.size("edges")).alias("mean"), F.max(F.size("edges")).alias("most"), F.count("*").alias("cells")).first()
    assert stats["most"] < 200 and stats["mean"] < 20 and stats["cells"] < 4 * n


@pytest.mark.parametrize("resolution", [1, 3])
def test_fill_is_the_test_of_every_centre(spark, resolution):
    rng = random.Random(resolution)
    size = 10 / 2**resolution
    # corners and level edges on the lines of centres as well
    shapes = SHAPES | {"star": [star(rng, 10, 20, 60, 40)], "centres": [[(-7.5, -7.5), (7.5, -7.5), (7.5, 2.5), (2.5, 2.5), (2.5, 7.5), (-7.5, 7.5)]], "tip": [[(-40.0, -8.0), (-30.0, -8.0), (-30.0, 2.0), (-35.0, -2.5), (-40.0, 2.0)]]}
    got = [(r.code, r.cell) for r in areas.fill(spark.createDataFrame(list(shapes.items()), POLYGONS), resolution).collect()]
    want = {(c, f"{resolution}:{i}:{j}") for c, rings in shapes.items() for i in range(round(180 / size)) for j in range(round(360 / size)) if inside(rings, -180 + (j + 0.5) * size, -90 + (i + 0.5) * size)}
    assert set(got) == want and len(got) == len(want)


def test_zonal_sums_against_plain_counts(spark):
    rng = random.Random(9)
    pixels = [(rng.randrange(170, 220), rng.randrange(340, 560), rng.choice([1.0, 2.5, None, float("nan")])) for _ in range(6000)]
    frame = spark.createDataFrame(pixels, "line int, column int, value double")
    shapes = SHAPES | {"star": [star(rng, 30, 5, 200, 25)]}
    got = {r.code: (r.total, r.pixels) for r in areas.zonal_sums(areas.raster_lines(frame, 16), spark.createDataFrame(list(shapes.items()), POLYGONS), 0.5, 16).collect()}
    for code, rings in shapes.items():
        cells = {(i, j) for i in range(100, 280) for j in range(300, 620) if inside(rings, -180 + (j + 0.5) * 0.5, -90 + (i + 0.5) * 0.5)}
        total = sum(v for i, j, v in pixels if (i, j) in cells and v is not None and not math.isnan(v))
        assert got[code][1] == len(cells) and abs(got[code][0] - total) < 1e-6
    assert len(got) == len(shapes)


def test_rings_over_the_antimeridian(spark):
    rings = [[(170.0, 0.0), (-170.0, 0.0), (-170.0, 4.0), (170.0, 4.0)], [(10.0, 0.0), (20.0, 0.0), (20.0, 5.0)], [(175.0, 0.0), (-175.0, 5.0), (175.0, 10.0), (175.0, 0.0)]]
    got = spark.createDataFrame([(r,) for r in rings], "ring array<struct<lon: double, lat: double>>").select(areas.split_at_antimeridian(F.col("ring")).alias("p")).collect()
    parts = [[[tuple(p) for p in r] for r in row.p] for row in got]
    area = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True))) / 2
    assert [len(p) for p in parts] == [2, 1, 2] and parts[1] == [rings[1]]
    assert {max(x for x, _ in r) for r in parts[0]} == {180.0, -170.0} and [area(r) for r in parts[0]] == [40.0, 40.0]
    assert sum(area(r) for r in parts[2]) == 50.0


def test_polygons_intersect_against_plain_code(spark):
    rng = random.Random(2)
    shapes = SHAPES | {"in hole": [[(24.0, 4.0), (26.0, 4.0), (26.0, 6.0), (24.0, 6.0)]], "in L": [[(1.0, 1.0), (1.5, 1.0), (1.0, 1.5)]], "corner": [[(50.0, 5.0), (52.0, 4.0), (52.0, 6.0)]], "edge": [[(12.0, 1.0), (14.0, 1.0), (14.0, 3.0), (12.0, 3.0)]]}
    shapes |= {f"s{i}": [star(rng, rng.uniform(0, 90), rng.uniform(0, 14), rng.choice([4, 30]), rng.choice([0.4, 6]))] for i in range(25)}

    def segments(rings):
        return [(p, q) for r in rings for p, q in zip(r, r[1:] + r[:1], strict=True) if p != q]

    def meet(a, b):
        side = lambda p, q, r: np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
        for p, q in segments(a):
            for r, s in segments(b):
                if side(p, q, r) * side(p, q, s) < 0 and side(r, s, p) * side(r, s, q) < 0:
                    return True
                if any((on_edge(p, q, *r), on_edge(p, q, *s), on_edge(r, s, *p), on_edge(r, s, *q))):
                    return True
        return any(inside(a, *r[0]) for r in b if r) or any(inside(b, *r[0]) for r in a if r)

    frame = spark.createDataFrame(list(shapes.items()), POLYGONS)
    got = {(r.u, r.w) for r in areas.polygons_intersect(frame.withColumnRenamed("code", "u"), frame.withColumnRenamed("code", "w"), "u", "w").collect()}
    assert got == {(u, w) for u, a in shapes.items() for w, b in shapes.items() if meet(a, b)}
    assert ("hole", "in hole") not in got and {("L", "in L"), ("diamond", "corner"), ("L", "edge")} <= got
