import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lettora.functions import geojson
from lettora.functions.geometry import inside_any, member_edges
from lettora.operators.spatial import EDGES_IN_CELL, as_points, containing_polygons, cover, postcode_polygons
from lettora.params import GridSpec, SkewLimits
from lettora.sources.files import POSTCODES_SCHEMA

MEMBERS = "array<array<array<array<double>>>>"
DIAMOND = [[0.5, 0.0], [1.0, 0.5], [0.5, 1.0], [0.0, 0.5], [0.5, 0.0]]
SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [1.0, 3.0], [3.0, 3.0], [3.0, 1.0], [1.0, 1.0]]


def contains(spark, members, points):
    df = spark.createDataFrame([(i, members, x, y) for i, (x, y) in enumerate(points)], f"i int, m {MEMBERS}, x double, y double")
    out = df.selectExpr("i", f"{inside_any('x', 'y', member_edges('m'))} as inside").orderBy("i")
    return [row.inside for row in out.collect()]


def test_boundary_is_outside(spark):
    points = [(0.5, 0.5), (0.5, 0.0), (0.25, 0.25), (0.0, 0.5), (0.75, 0.75), (1.0, 0.5), (0.5, 1.0), (0.9, 0.9)]
    assert contains(spark, [[DIAMOND]], points) == [True] + [False] * 7


def test_horizontal_and_vertical_edges(spark):
    points = [(2.0, 0.0), (0.0, 2.0), (4.0, 2.0), (2.0, 4.0), (0.0, 0.0), (4.0, 4.0), (2.0, 2.0), (-1.0, 0.0), (5.0, 4.0)]
    assert contains(spark, [[SQUARE]], points) == [False] * 6 + [True, False, False]


def test_hole_and_its_edge(spark):
    assert contains(spark, [[SQUARE, HOLE]], [(0.5, 0.5), (2.0, 2.0), (1.0, 2.0), (3.5, 1.0)]) == [True, False, False, True]


def test_open_ring_is_closed(spark):
    assert contains(spark, [[SQUARE[:-1]]], [(2.0, 2.0), (0.0, 2.0), (5.0, 2.0)]) == [True, False, False]


def test_any_member_is_enough(spark):
    far = [[x + 10, y] for x, y in SQUARE]
    overlapping = [[x + 1, y] for x, y in SQUARE]
    assert contains(spark, [[SQUARE], [far]], [(2.0, 2.0), (12.0, 2.0), (7.0, 2.0)]) == [True, True, False]
    assert contains(spark, [[SQUARE], [overlapping]], [(2.0, 2.0), (0.5, 2.0), (4.5, 2.0)]) == [True, True, True]


def exact_inside(x, y, members):
    """Independent check with rational numbers: winding of a closed polygon by rays upwards."""
    x, y = Fraction(x), Fraction(y)

    def member(rings):
        odd = False
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
                ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
                turn = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
                if turn == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                    return False
                if (ax <= x) != (bx <= x):
                    odd ^= ay + (x - ax) * (by - ay) / (bx - ax) > y
        return odd

    return any(map(member, members))


def random_polygon(rng):
    """A star with corners on a quarter grid; sometimes with a hole, sometimes two of them."""
    import math

    def star(cx, cy, low, high):
        corners = []
        for k in range(rng.randint(3, 9)):
            angle, radius = 2 * math.pi * k / 9, rng.uniform(low, high)
            corners.append([round((cx + radius * math.cos(angle)) * 4) / 4, round((cy + radius * math.sin(angle)) * 4) / 4])
        return corners + corners[:1]

    cx, cy = rng.randint(-6, 6), rng.randint(-6, 6)
    kind = rng.random()
    if kind < 0.3:
        return [[star(cx, cy, 3, 5), star(cx, cy, 0.5, 1.5)]]
    if kind < 0.6:
        return [[star(cx, cy, 1, 2)], [star(cx + 5, cy + 1, 1, 3)]]
    return [[star(cx, cy, 1, 4)]]


@pytest.mark.parametrize(
    "grid",
    [
        *({"cell": cell, "broadcast_bytes": size} for cell in (None, 0.25, 0.7, 3.0, 50.0) for size in (0, 1 << 30)),
        # Cut in four until two edges are left, or a corner is as small as can be; with the first cells cut by edges too.
        *({"edges_per_cell": 2, "most_splits": 6, "edges_in_row": edges} for edges in (0, 12, 1000)),
        {"edges_per_cell": 1, "most_splits": 3, "cells_across": 1},
    ],
)
def test_grid_join_equals_brute_force(spark, grid):
    rng = random.Random(7)
    polygons = [(f"p{i}", random_polygon(rng)) for i in range(25)]
    points = [(i, rng.randint(-48, 48) / 4, rng.randint(-48, 48) / 4) for i in range(400)]
    expected = sorted((i, code) for i, x, y in points for code, members in polygons if exact_inside(x, y, members))
    joined = containing_polygons(
        spark.createDataFrame(points, "i int, x double, y double"),
        spark.createDataFrame(polygons, f"postcode string, members {MEMBERS}"),
        GridSpec(**grid),
        SkewLimits(rows_per_task=3),
    )
    assert sorted((row.i, row.postcode) for row in joined.collect()) == expected


def test_copies_of_a_polygon_each_match(spark):
    polygons = spark.createDataFrame([("a", [[SQUARE]]), ("a", [[SQUARE]])], f"postcode string, members {MEMBERS}")
    points = spark.createDataFrame([(1, 2.0, 2.0)], "i int, x double, y double")
    assert containing_polygons(points, polygons, GridSpec(1.0)).count() == 2


def test_inner_cells_need_no_edges(spark):
    polygons = spark.createDataFrame([("a", [[SQUARE]])], f"postcode string, members {MEMBERS}")
    cells = {(r.cell_x, r.cell_y): r for r in cover(polygons, GridSpec(cells_across=5)).collect()}
    assert {r.level for r in cells.values()} == {0}
    assert cells[(2, 2)].whole and cells[(2, 2)].rims == []
    assert not cells[(0, 0)].whole and cells[(0, 0)].rims


def stored_edges(spark, members, grid):
    polygons = spark.createDataFrame([("a", members)], f"postcode string, members {MEMBERS}")
    return cover(polygons, grid).selectExpr("sum(aggregate(rims, 0, (n, r) -> n + size(r.edges)))").first()[0]


@pytest.mark.parametrize("across", [16, 160])
def test_edges_are_stored_about_once(spark, across):
    """Jagged edges along one row of cells: not edges times cells, however fine the cells are."""
    teeth = [[x / 1000, 0.001 * (x % 2)] for x in range(2001)]
    ring = teeth + [[2.0, 0.5], [0.0, 0.5], teeth[0]]
    assert stored_edges(spark, [[ring]], GridSpec(cells_across=across)) <= 3 * len(ring) + 8 * across


def coast(n):
    """A ring of about ``n`` edges that runs to and fro, by steps as long as its edges."""
    import math

    rng, radius, ring = random.Random(n), 1.0, []
    for k in range(n):
        radius += 12 / n * rng.uniform(-1, 1) + 0.01 * (1 - radius)
        ring.append([radius * math.cos(2 * math.pi * k / n), radius * math.sin(2 * math.pi * k / n)])
    return [ring]


def test_edges_in_a_cell_do_not_grow_with_the_polygon(spark):
    most, stored = {}, {}
    for n in (5_000, 20_000, 80_000):
        polygons = spark.createDataFrame([("a", [coast(n)])], f"postcode string, members {MEMBERS}")
        cells = cover(polygons).selectExpr(f"{EDGES_IN_CELL} as n", "whole")
        most[n], stored[n] = cells.selectExpr("max(n)", "sum(n)").first()
    assert max(most.values()) <= GridSpec().edges_per_cell
    assert max(stored[n] / n for n in stored) < 4


def test_divided_cells_equal_brute_force(spark):
    rng = random.Random(2)
    ring = coast(3000)[0]
    points = [(i, rng.uniform(-1.3, 1.3), rng.uniform(-1.3, 1.3)) for i in range(150)] + [(900 + i, *ring[i]) for i in range(20)]
    polygons = spark.createDataFrame([("a", [[ring]])], f"postcode string, members {MEMBERS}")
    found = containing_polygons(spark.createDataFrame(points, "i int, x double, y double"), polygons)
    assert sorted(r.i for r in found.collect()) == [i for i, x, y in points if exact_inside(x, y, [[ring]])]


def test_many_edges_in_one_point_end(spark):
    """More edges than a cell may have meet in a corner: cutting stops."""
    spokes = [p for k in range(100) for p in ([0.5, 0.5], [k / 100, 1.0], [(k + 0.5) / 100, 1.0])] + [[0.5, 0.5]]
    polygons = spark.createDataFrame([("a", [[spokes]])], f"postcode string, members {MEMBERS}")
    points = [(i, (i + 0.25) / 200, 0.99) for i in range(200)]
    found = containing_polygons(spark.createDataFrame(points, "i int, x double, y double"), polygons, GridSpec(most_splits=4))
    assert sorted(r.i for r in found.collect()) == [i for i, x, y in points if exact_inside(x, y, [[spokes]])]


def test_large_and_small_polygons_have_bounded_covers(spark):
    square = lambda x, y, size: [[[x + a * size, y + b * size] for a, b in SQUARE]]
    small = [(f"s{i}", [square(i % 40, i // 40, 0.01)]) for i in range(1000)]
    polygons = spark.createDataFrame([*small, ("country", [square(-500.0, -500.0, 250.0)])], f"postcode string, members {MEMBERS}")
    cells = cover(polygons).groupBy("postcode").count()
    assert cells.agg(F.max("count")).first()[0] <= 19 * 19
    points = spark.createDataFrame([(1, 3.02, 0.02), (2, -100.0, 7.0), (3, 600.0, 0.0)], "i int, x double, y double")
    found = sorted((r.i, r.postcode) for r in containing_polygons(points, polygons).collect())
    assert found == [(1, "country"), (1, "s3"), (2, "country")]


def test_small_units(spark):
    """Degrees: cells far below one, negative coordinates."""
    ring = [[[-0.0004 + x / 10000, -0.0002 + y / 10000] for x, y in SQUARE]]
    polygons = spark.createDataFrame([("a", [ring])], f"postcode string, members {MEMBERS}")
    points = spark.createDataFrame([(1, -0.0001, 0.0001), (2, 0.00011, 0.0001)], "i int, x double, y double")
    for grid in (GridSpec(), GridSpec(7.5e-05)):
        assert [row.i for row in containing_polygons(points, polygons, grid).collect()] == [1]


def test_no_polygons_at_all(spark):
    polygons = spark.createDataFrame([], f"postcode string, members {MEMBERS}")
    points = spark.createDataFrame([(1, 2.0, 2.0)], "i int, x double, y double")
    assert containing_polygons(points, polygons).count() == 0


def test_points_must_be_finite_numbers(spark):
    df = spark.createDataFrame([("1", "2"), ("NaN", "2"), ("1", "Infinity"), ("x", "1"), (None, "1")], "longitude string, latitude string")
    assert [(r.x, r.y) for r in as_points(df).collect()] == [(1.0, 2.0)]


def mixed_collection():
    def feature(code, kind, coordinates):
        return {"type": "Feature", "properties": {"pc4_code": code}, "geometry": {"type": kind, "coordinates": coordinates}}

    return {
        "type": "FeatureCollection",
        "features": [
            feature("1011", "Polygon", [SQUARE, HOLE]),
            feature(1012, "MultiPolygon", [[DIAMOND], [[[x + 10, y] for x, y in SQUARE]]]),
            feature("1013", "Point", [1.0, 2.0]),
        ],
    }


@pytest.mark.parametrize("indent", [None, 2])
def test_mixed_geojson_file(spark, tmp_path, indent):
    file = tmp_path / "areas.geojson"
    file.write_text(json.dumps(mixed_collection(), indent=indent))
    df = spark.read.schema(POSTCODES_SCHEMA).option("multiLine", True).json(str(file))
    areas = {row.postcode: row.members for row in postcode_polygons(df).collect()}
    assert areas == {"1011": [[SQUARE, HOLE]], "1012": [[DIAMOND], [[[x + 10, y] for x, y in SQUARE]]]}


def test_inferred_geojson_schema(spark, tmp_path):
    """Doubles when a file has one kind of geometry, quoted texts when it mixes kinds."""
    collection = mixed_collection()
    collection["features"] = collection["features"][:2]
    mixed = tmp_path / "mixed.geojson"
    mixed.write_text(json.dumps(collection))
    collection["features"] = collection["features"][:1]
    single = tmp_path / "single.geojson"
    single.write_text(json.dumps(collection))
    for file, expected in ((mixed, 2), (single, 1)):
        df = spark.read.option("multiLine", True).json(str(file))
        areas = {row.postcode: row.members for row in postcode_polygons(df).collect()}
        assert len(areas) == expected and areas["1011"] == [[SQUARE, HOLE]]


def test_repair_of_json_text(values):
    quoted = '{"coordinates":["[[0.5, -1]]","[2]"],"type":"x"}'
    assert values(geojson.unquote_arrays, [quoted]) == ['{"coordinates":[[[0.5, -1]],[2]],"type":"x"}']
    assert values(geojson.unquote_numbers, ['["0.5","-1","a"]']) == ['[0.5,-1,"a"]']


def test_join_plan(spark, plan_text):
    """Equi-joins on cells, no pairing of everything with everything, no Python."""
    polygons = spark.createDataFrame([("a", [[SQUARE]])], f"postcode string, members {MEMBERS}")
    points = spark.range(100).select((F.col("id") / 10).alias("x"), (F.col("id") / 20).alias("y"))
    for size, kind in ((1 << 30, "BroadcastHashJoin"), (0, "Join [level")):
        plan = plan_text(containing_polygons(points, polygons, GridSpec(1.0, size)))
        assert kind in plan
        assert not any(word in plan for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"))


def test_cutting_computes_boundaries_once(spark):
    """No filter of the cutting takes a copy of the boundary or of a cell's edges along."""
    from lettora.operators.spatial import _cut_in_row, _sized

    text = "[[[0, 0], [4, 0], [4, 4], [0, 0]]]"
    polygons = spark.createDataFrame([("1", text)], "postcode string, text string").select(
        "postcode", geojson.polygon_members(F.lit("Polygon"), F.col("text")).alias("members")
    )
    plan = _cut_in_row(_sized(polygons, GridSpec()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 1
    assert plan.count("aggregate(") == 1
