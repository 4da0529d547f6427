import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanweave.functions import geometry as G
from urbanweave.operators import spatial
from urbanweave.sources.files import with_shapes


def crossings(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def star(cx, cy, radius, points, rnd):
    """A closed ring around a centre, not convex."""
    ring = []
    for k in range(points):
        r = radius * (0.4 + 0.6 * rnd.random())
        ring.append((cx + r * math.cos(2 * math.pi * k / points), cy + r * math.sin(2 * math.pi * k / points)))
    return ring + ring[:1]


def zone_frame(spark, zones):
    data = [(name, [[[list(map(float, p)) for p in ring] for ring in part] for part in parts]) for name, parts in zones.items()]
    return spark.createDataFrame(data, "zone string, parts array<array<array<array<double>>>>")


@pytest.fixture(scope="module")
def zones():
    rnd = random.Random(5)
    made = {f"z{i}": [[star(rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.uniform(5, 40), 12, rnd)]] for i in range(8)}
    made["hole"] = [[[(-10, -10), (10, -10), (10, 10), (-10, 10), (-10, -10)], [(-4, -4), (4, -4), (4, 4), (-4, 4), (-4, -4)]]]
    made["two"] = [[[(20, 20), (25, 20), (25, 25), (20, 20)]], [[(-30, -30), (-20, -30), (-20, -22), (-30, -30)]]]
    return made


@pytest.mark.parametrize("size", [3.0, 17.0, 500.0])
def test_points_in_zones_follow_brute_force(spark, zones, size):
    rnd = random.Random(6)
    # A third of all points lie in one spot.
    points = [(i, rnd.uniform(-60, 60), rnd.uniform(-60, 60)) for i in range(400)] + [(i, 7.013, 7.017) for i in range(400, 600)] + [(600, None, 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {(r.id, r.zone) for r in spatial.spatial_join_within(df, zone_frame(spark, zones), "x", "y", "parts", ["zone"], size).collect()}
    want = set()
    for i, x, y in points:
        hits = [n for n, parts in zones.items() if x is not None and crossings([ring for part in parts for ring in part], x, y)]
        want |= {(i, n) for n in hits} or {(i, None)}
    assert got == want


def test_intersecting_areas(spark):
    square = lambda x, y, w: [[[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]]
    city = {"city": square(0, 0, 100), "far": [[[(300, 0), (310, 0), (310, 10), (300, 0)]]]}
    shapes = {"inside": square(40, 40, 3), "border": square(98, 50, 10), "around": square(-50, -50, 400), "outside": square(120, 120, 5),
              "touching": square(100, 20, 7), "corner of far": square(305, -20, 21)}
    features = zone_frame(spark, shapes).withColumnRenamed("zone", "id")
    for size in (5.0, 40.0, 1000.0):
        got = {r.id for r in spatial.spatial_filter(features, zone_frame(spark, city), "id", "parts", "parts", size).collect()}
        assert got == {"inside", "border", "around", "touching", "corner of far"}


def test_measures_with_holes_and_parts(spark, zones):
    measured = {r.zone: r for r in spatial.polygon_measures(zone_frame(spark, zones), "parts").collect()}
    assert math.isclose(measured["hole"].area, 400 - 64) and math.isclose(measured["hole"].perimeter, 80 + 32)
    assert math.isclose(measured["two"].area, 12.5 + 40)
    centres = {(r.zone, r.part): (r.x, r.y) for r in spatial.polygon_centroid(zone_frame(spark, zones), "parts").collect()}
    assert centres["hole", 0] == pytest.approx((0, 0), abs=1e-9)
    assert centres["two", 1] == pytest.approx((-70 / 3, -82 / 3))
    far = {"f": [[[(431000.0, 4581000.0), (431002.0, 4581000.0), (431002.0, 4581001.0), (431000.0, 4581001.0), (431000.0, 4581000.0)]]]}
    row = spatial.polygon_centroid(spatial.polygon_measures(zone_frame(spark, far), "parts"), "parts").first()
    assert row.area == pytest.approx(2.0, abs=1e-9) and (row.x, row.y) == pytest.approx((431001.0, 4581000.5), abs=1e-6)


def test_geojson_text_to_shapes(spark):
    df = spark.createDataFrame([("Polygon", "[[[0,0],[1,0],[1,1],[0,1],[0,0]]]"), ("MultiPolygon", "[[[[0,0],[2,0],[2,2],[0,2],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]"),
                                ("Point", "[1.5,2]")], "type string, coordinates string").select(F.struct("type", "coordinates").alias("geometry"))
    got = with_shapes(df).select("point", F.expr(G.area("parts")).alias("area")).collect()
    assert [r.area for r in got] == [1.0, 4.5, None] and got[2].point == [1.5, 2.0]


@pytest.mark.parametrize("metric", ["sphere", "plane"])
def test_nearest_station(spark, metric):
    rnd = random.Random(9)
    stations = [(f"s{i:03d}", rnd.uniform(-89, 89), rnd.uniform(-179.9, 179.9)) for i in range(60)] + [("tie b", 10.0, 179.9), ("tie a", 10.0, 179.9)]
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)] + [(900, 10.0, -179.95), (901, 89.99, 0.0)]

    def distance(p, s):
        if metric == "plane":
            return math.hypot(p[1] - s[1], p[2] - s[2])
        a, b = math.radians(p[1]), math.radians(s[1])
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(s[2] - p[2]) / 2) ** 2
        return 2 * spatial.EARTH_KM * math.asin(min(1, math.sqrt(h)))

    want = {p[0]: min((round(distance(p, s), 4), s[0]) for s in stations) for p in points}
    p, s = spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(stations, "name string, lat double, lon double")
    for leaf in (32, 2):
        got = spatial.nearest_station(p, s, "id", ["lat", "lon"], "name", ["lat", "lon"], metric, leaf)
        assert {r.id: (round(r.distance, 4), r.name) for r in got.collect()} == want


def test_one_far_station_changes_nothing(spark):
    draw = np.random.default_rng(3)
    city, asked = draw.normal(0, 0.01, (3000, 2)), draw.normal(0, 0.01, (500, 2))
    stations = [(k, 41 + a, 2 + b) for k, (a, b) in enumerate(city.tolist())]
    p = spark.createDataFrame([(k, 41 + a, 2 + b) for k, (a, b) in enumerate(asked.tolist())], "id int, lat double, lon double")
    results = []
    for more in ([], [(9999, -1e3, 1e5)]):
        s = spark.createDataFrame(stations + more, "name int, lat double, lon double")
        leaves = spatial.station_leaves(s.select(F.col("name").alias("__name"), F.col("lat").alias("__s0"), F.col("lon").alias("__s1"), F.lit(0.0).alias("__s2")))
        assert leaves.agg(F.max(F.size("stations"))).first()[0] <= spatial.LEAF
        near = spatial._Bounds.of(leaves).near(np.column_stack([41 + asked[:, 0], 2 + asked[:, 1], np.zeros(500)]))
        results.append(len(near[0]))
        got = {r.id: r.name for r in spatial.nearest_station(p, s, "id", ["lat", "lon"], "name", ["lat", "lon"], "plane").collect()}
        assert got == dict(enumerate(((asked[:, None] - city) ** 2).sum(axis=2).argmin(axis=1).tolist()))
    assert results[1] < 1.5 * results[0] < 500 * 15


YOUNG = """
from urbanweave.session import build_session
spark = build_session("young", "local[1]", spark_sql_shuffle_partitions="1", spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
from __spark_entry__ import queries
print("rows", queries()["harmonise_addresses"](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_first_query_of_a_session_joins_points_and_zones():
    """Columns of a young session have low numbers, which the lambdas of the join condition must not hold."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-B", "-c", YOUNG], cwd=root, capture_output=True, text=True, timeout=600)
    assert "rows " in done.stdout, done.stderr[-2000:]
    for text in (G.inside("z", "px", "py"), G.odd_crossings("z", "px", "py", "pr", "pl")):
        body = text.split("->", 1)[1]
        assert not any(column in body for column in ("px", "py", "pr", "pl"))


def test_many_stations_and_points_of_one_file(spark, monkeypatch, tmp_path):
    """Beyond the most leaves a leaf has parts, each point looks at a few bounds, and points of one small file are dealt to many tasks."""
    draw = np.random.default_rng(8)
    city = np.concatenate([draw.normal(0, 1, (2500, 2)), draw.integers(-40, 40, (1500, 2)) / 4.0])
    asked = np.concatenate([draw.normal(0, 1, (300, 2)), draw.integers(-40, 40, (300, 2)) / 8.0, [[1e7, -1e7], [0.0, 1e300]]])
    spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(asked.tolist())], "id int, x double, y double").coalesce(1).write.parquet(f"{tmp_path}/points")
    p, s = spark.read.parquet(f"{tmp_path}/points"), spark.createDataFrame([(f"s{k:04d}", a, b) for k, (a, b) in enumerate(city.tolist())], "name string, x double, y double")
    monkeypatch.setattr(spatial, "LEAVES", 16)
    leaves = spatial.station_leaves(s.select(F.col("name").alias("__name"), F.col("x").alias("__s0"), F.col("y").alias("__s1"), F.lit(0.0).alias("__s2")), 8)
    assert leaves.agg(F.max(F.size("stations"))).first()[0] <= 8
    bounds = spatial._Bounds.of(leaves)
    assert len(bounds.leaf) <= 16 + 4  # each range of the sort begins a leaf
    dealt = spatial._near_leaves(p.select(F.col("id").alias("__point"), F.col("x").alias("__p0"), F.col("y").alias("__p1"), F.lit(0.0).alias("__p2")), bounds)
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1
    d2 = (asked[:, None, 0] - city[:, 0]) ** 2 + (asked[:, None, 1] - city[:, 1]) ** 2
    got = {r.id: (r.name, r.distance) for r in spatial.nearest_station(p, s, "id", ["x", "y"], "name", ["x", "y"], "plane", 8).collect()}
    assert got == {k: (f"s{i:04d}", math.sqrt(d2[k, i])) for k, i in enumerate(d2.argmin(axis=1).tolist())}
    at = np.column_stack([asked, np.zeros(len(asked))])
    whole = bounds.near(at)
    monkeypatch.setattr(spatial, "PAIRS", 40)
    assert all(np.array_equal(a, b) for a, b in zip(whole, bounds.near(at)))


def test_zone_of_many_edges_over_many_cells(spark):
    rnd, n = random.Random(4), 5000
    ring = [[1000 + (900 + 60 * math.sin(37 * a) + rnd.uniform(-3, 3)) * math.cos(a), 1000 + (900 + 60 * math.sin(37 * a)) * math.sin(a)]
            for a in (2 * math.pi * k / n for k in range(n))]
    hole = [[1000 + 300 * math.cos(a), 1000 + 300 * math.sin(a)] for a in (2 * math.pi * k / 200 for k in range(200))]
    parts = [[ring + ring[:1], hole + hole[:1]]]
    points = [(k, rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for k in range(1500)]
    zones = spark.createDataFrame([("z", parts)], "zone string, parts array<array<array<array<double>>>>")
    placed = spark.createDataFrame(points, "id int, x double, y double")

    def inside(x, y):
        odd = False
        for loop in parts[0]:
            for (x1, y1), (x2, y2) in zip(loop, loop[1:]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd

    got = spatial.spatial_join_within(placed, zones, "x", "y", "parts", ["zone"], 20.0, "inner")
    assert {r.id for r in got.collect()} == {k for k, x, y in points if inside(x, y)}
    cells = spatial.ray_cells(zones, ["zone"], "parts", 20.0)
    assert cells.agg(F.sum(F.size("__lines"))).first()[0] < 4 * (n + 200)
