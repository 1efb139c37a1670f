"""Point-in-polygon join as an equi-join on grid cells.

Every polygon is cut along a grid of its own level: squares with a power of two as side, a few of them along its extent,
however large it is. A cell keeps the edges that meet it and one bit: whether its upper right corner is inside. Whether a
point is inside follows from that bit and the edges crossed on the way from the point right to the border of the cell and
up to the corner, all of which meet the cell. A cell without edges is inside or outside as a whole; outside ones are not
stored. A cell with many edges is cut into four of the next level, and these again, so however long a border is, a point
is tested against a bounded number of its edges (unless more than that meet in one place). The corner bits of the four
follow from that of the cell and its edges, so cutting is work inside a row.

A point has one cell per level in use, and the cells of a polygon do not overlap. Each (point, polygon) pair therefore
arises once. Sides being powers of two, cell numbers and cell borders are exact, and no rounding can part a point from an
edge it needs.

Polygons of few edges, which is nearly all, are cut inside their row: no shuffle, no edge table. Only where there are
larger ones, these go edge by edge through a shuffle, so that no task holds more than a cell of them.

Building a join runs jobs: the cover is written, to be measured, round by round, and hot cells are counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lettora.functions.geojson import coordinates_text, polygon_members
from lettora.functions.geometry import (
    crossings_left,
    inside_cell,
    left_end,
    meets_box,
    member_edges,
    odd_from_all,
    odd_in_cell,
    right_end,
)
from lettora.functions.text import to_double
from lettora.operators.columns import quoted
from lettora.operators.skew import skew_join
from lettora.params import GridSpec, SkewLimits
from lettora.sources.shared import written

# Upper estimates of what a broadcast cover takes up, per row and per edge (four doubles plus array and struct headers).
ROW_BYTES, EDGE_BYTES = 128, 64


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def postcode_polygons(collections: DataFrame) -> DataFrame:
    """Feature collections -> (postcode, members). Geometries other than (Multi)Polygon are left out.

    Unreadable coordinates give NULL members, which contain no point.
    """
    features = collections.select(F.explode("features").alias("feature")).select(
        F.col("feature.properties.pc4_code").cast("string").alias("postcode"),
        F.col("feature.geometry").alias("geometry"),
    )
    parsed = features.select(
        "postcode", F.col("geometry.type").alias("kind"), coordinates_text(features, "geometry").alias("coordinates")
    ).where(F.col("kind").isin("Polygon", "MultiPolygon"))
    # One file is one task up to here. The rows are few but costly to cut, so the number of tasks is fixed: by their
    # bytes alone they would be merged into one.
    return parsed.repartition(_tasks(collections)).select(
        "postcode", polygon_members(F.col("kind"), F.col("coordinates")).alias("members")
    )


def as_points(df: DataFrame, longitude: str = "longitude", latitude: str = "latitude") -> DataFrame:
    """Add the numbers (x, y) of two coordinate columns; rows without a finite pair are left out."""
    finite = [F.abs(F.col(axis)) < F.lit(float("inf")) for axis in ("x", "y")]
    points = df.withColumns({"x": to_double(F.col(longitude)), "y": to_double(F.col(latitude))})
    return points.where(finite[0] & finite[1])


def _once(df: DataFrame, *columns: str, **computed: str) -> DataFrame:
    """``columns`` of ``df`` and expressions that are computed once per row, whatever is filtered by them.

    A filter on a plain column is moved below it and takes a copy of its expression along; one on a generator's is not.
    """
    fields = ", ".join(f"'{name}', {expression}" for name, expression in computed.items())
    return df.selectExpr(*columns, f"inline(array(named_struct({fields})))")


def _sized(polygons: DataFrame, grid: GridSpec) -> DataFrame:
    """(postcode, boundary, low_x, low_y, high_x, high_y, level, n_edges): finite edges per member, the box around them,
    and the level of the first cells."""
    numbers = "array(e.xlo, e.ylo, e.xhi, e.yhi)"
    finite = f"forall({numbers}, v -> v is not null and abs(v) < double('infinity'))"
    boundary = _once(polygons, "postcode", boundary=f"transform({member_edges('members')}, edges -> filter(edges, e -> {finite}))")
    every = boundary.selectExpr("postcode", "boundary", "flatten(boundary) as every")
    ends = {
        "low_x": f"array_min(transform(every, e -> {left_end('e')}))",
        "low_y": "array_min(every.ylo)",
        "high_x": f"array_max(transform(every, e -> {right_end('e')}))",
        "high_y": "array_max(every.yhi)",
    }
    boxes = _once(every, "postcode", "boundary", **ends, n_edges="size(every)")
    across = f"if(n_edges > {int(grid.edges_in_row)}, {int(grid.cells_across_large)}, {int(grid.cells_across)})"
    level = f"cast(ceil(log2(greatest(extent / ({across}), {float(grid.cell or 0)!r}D))) as int)"
    sized = boxes.selectExpr("*", "greatest(high_x - low_x, high_y - low_y) as extent").where("extent > 0")
    return sized.selectExpr("postcode", "boundary", *ends, f"{level} as level", "n_edges")


def _as_cell(keys: list[str], rims: DataFrame) -> DataFrame:
    """Rows with ``all_rims`` as cells. A cell that no member touches is outside and goes."""
    whole = "exists(rims, r -> r.odd and size(r.edges) = 0)"
    kept = _once(rims, *keys, rims="filter(all_rims, r -> r.odd or size(r.edges) > 0)").where("size(rims) > 0")
    return kept.selectExpr(*keys, f"{whole} as whole", f"if({whole}, slice(rims, 1, 0), rims) as rims")


def _box(size: str) -> list[str]:
    return [f"cell_x * {size}", f"cell_y * {size}", f"(cell_x + 1) * {size}", f"(cell_y + 1) * {size}"]


_KEYS = ["level", "cell_x", "cell_y", "postcode"]
_SIDES = ["box_left", "box_bottom", "box_right", "box_top"]


def _boxed(cells: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the borders of each cell of side ``side``, as columns: edge after edge is held against them."""
    return cells.selectExpr(*_KEYS, *columns, "side", *(f"{at} as {name}" for at, name in zip(_box("side"), _SIDES)))


def _cut_in_row(sized: DataFrame) -> DataFrame:
    """The first cells of polygons, each cut in its row."""
    ends = sized.withColumn("side", F.expr("pow(2D, level)"))
    # A cell is closed: what lies on its upper or right border meets it as well.
    rows = ends.selectExpr("*", "explode(sequence(ceil(low_y / side) - 1, floor(high_y / side))) as cell_y")
    cells = rows.selectExpr("*", "explode(sequence(ceil(low_x / side) - 1, floor(high_x / side))) as cell_x")
    odd = odd_from_all("box_right", "box_top", "edges")
    rim = f"named_struct('odd', {odd}, 'edges', filter(edges, e -> {meets_box(*_SIDES, 'side')}))"
    return _as_cell(_KEYS, _boxed(cells, "boundary").selectExpr(*_KEYS, f"transform(boundary, edges -> {rim}) as all_rims"))


def _cut_by_edges(sized: DataFrame) -> DataFrame:
    """The first cells of large polygons, cut edge by edge in many tasks."""
    numbered = sized.selectExpr("monotonically_increasing_id() as pid", "postcode", "boundary", "level")
    members = numbered.selectExpr("pid", "postcode", "level", "posexplode(boundary) as (member, edges)")
    # Written, as the numbers must not change between the uses below.
    stored = written(members.selectExpr("pid", "postcode", "level", "member", "explode(edges) as e"), "edges")
    edges = stored.withColumn("side", F.expr("pow(2D, level)"))
    x_from, x_to = f"floor({left_end('e')} / side)", f"floor({right_end('e')} / side)"
    rows = edges.selectExpr("*", "explode(sequence(ceil(e.ylo / side) - 1, floor(e.yhi / side))) as cell_y")
    met = rows.selectExpr("*", f"explode(sequence(ceil({left_end('e')} / side) - 1, {x_to})) as cell_x")
    met = met.where(meets_box(*_box("side"), "side"))
    # Upper borders that an edge crosses, and how many corners on them lie to its left.
    lines = edges.selectExpr("*", "explode(sequence(ceil(e.ylo / side) - 1, ceil(e.yhi / side) - 2)) as cell_y").where(
        "ceil(e.yhi / side) - 1 > ceil(e.ylo / side) - 1"
    )
    until = crossings_left(x_from, x_to, "(cell_y + 1) * side")
    crossed = lines.selectExpr("pid", "postcode", "level", "member", "cell_y", f"{until} as until")
    odd = crossed.groupBy("pid", "postcode", "level", "member", "cell_y", "until").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    odd = odd.groupBy("pid", "postcode", "level", "member", "cell_y").agg(F.sort_array(F.collect_list("until")).alias("untils"))
    # Between the 1st and 2nd, the 3rd and 4th ... of these numbers, corners are inside.
    pairs = "filter(transform(untils, (u, i) -> struct(u as u, get(untils, i + 1) as v, i as i)), p -> p.i % 2 = 0)"
    odd = odd.selectExpr("pid", "postcode", "level", "member", "cell_y", f"explode({pairs}) as p")
    odd = odd.selectExpr("pid", "postcode", "level", "member", "explode(sequence(p.u, p.v - 1)) as cell_x", "cell_y")
    keys = ["pid", "postcode", "level", "cell_x", "cell_y"]
    kind = "struct<xlo:double,ylo:double,xhi:double,yhi:double>"
    both = met.select(*keys, "member", "e", F.lit(False).alias("odd")).union(
        odd.select(*keys, "member", F.lit(None).cast(kind).alias("e"), F.lit(True).alias("odd"))
    )
    # Dealt by cell, both aggregations work in place.
    dealt = both.repartition("pid", "cell_x", "cell_y")
    rims = dealt.groupBy(*keys, "member").agg(F.max("odd").alias("odd"), F.collect_list("e").alias("edges"))
    return _as_cell(_KEYS, rims.groupBy(*keys).agg(F.collect_list(F.struct("odd", "edges")).alias("all_rims")))


def _cut_in_four(cells: DataFrame) -> DataFrame:
    """Cells of the next level; their corner bits follow from that of the cell they are part of."""
    quarters = "explode(array(struct(0L as i, 0L as j), struct(0L as i, 1L as j), struct(1L as i, 0L as j), struct(1L as i, 1L as j)))"
    parts = cells.selectExpr("postcode", "level", "cell_x as old_x", "cell_y as old_y", "rims as old_rims", f"{quarters} as q")
    parts = parts.selectExpr(
        "postcode",
        "level - 1 as level",
        "2 * old_x + q.i as cell_x",
        "2 * old_y + q.j as cell_y",
        "old_rims",
        "(old_x + 1) * pow(2D, level) as right",
        "(old_y + 1) * pow(2D, level) as top",
        "pow(2D, level - 1) as side",
    )
    odd = odd_in_cell("box_right", "box_top", "right", "top", "r.edges", "r.odd")
    rim = f"named_struct('odd', {odd}, 'edges', filter(r.edges, e -> {meets_box(*_SIDES, 'side')}))"
    boxed = _boxed(parts, "old_rims", "right", "top")
    return _as_cell(_KEYS, boxed.selectExpr(*_KEYS, f"transform(old_rims, r -> {rim}) as all_rims"))


CORNER = "_right", "_top"
EDGES_IN_CELL = "aggregate(rims, 0, (n, rim) -> n + size(rim.edges))"


def measured_cover(polygons: DataFrame, grid: GridSpec = GridSpec()) -> tuple[DataFrame, int]:
    """A cover and its estimated size in memory. It is written to the shared folder, so it is computed once.

    (postcode, members) -> at most one row per polygon and cell: (level, cell_x, cell_y, postcode, whole, rims). ``whole``
    says that the cell lies inside without a test. Otherwise ``rims`` holds, per polygon member whose edges meet the cell,
    those edges and whether the upper right corner is inside (``odd``).
    """
    sizes = Observation()
    sized = _sized(polygons, grid)
    seen = sized.observe(sizes, F.count_if(F.col("n_edges") > grid.edges_in_row).alias("large"))
    small = seen.where(F.col("n_edges") <= grid.edges_in_row)
    parts, cost = _divided(_cut_in_row(small), grid)
    if sizes.get["large"]:
        large, more = _divided(_cut_by_edges(sized.where(F.col("n_edges") > grid.edges_in_row)), grid)
        parts, cost = parts + large, cost + more
    return reduce(DataFrame.union, parts), cost


def _divided(cells: DataFrame, grid: GridSpec) -> tuple[list[DataFrame], int]:
    """Written tables of cells of few edges, and their estimated size."""
    # A cell that would become smaller than it may be stays as it is.
    crowded = F.expr(f"{EDGES_IN_CELL} > {int(grid.edges_per_cell)} and pow(2D, level - 1) >= {float(grid.cell or 0)!r}D")
    parts, cost = [], 0
    for split in range(grid.most_splits + 1):
        size = Observation()
        edges = F.expr(EDGES_IN_CELL)
        last = split == grid.most_splits
        stays = F.lit(True) if last else ~crowded
        counts = [F.count_if(stays).alias("rows"), F.sum(F.when(stays, edges)).alias("edges"), F.count_if(~stays).alias("crowded")]
        # Cut in many tasks, stored in few files.
        stored = written(cells.observe(size, *counts).hint("rebalance"), "cover")
        cost += size.get["rows"] * ROW_BYTES + (size.get["edges"] or 0) * EDGE_BYTES
        if not size.get["crowded"]:
            parts.append(stored)
            break
        parts.append(stored.where(~crowded))
        # Few rows, costly to cut: dealt by their number, not by their bytes.
        cells = _cut_in_four(stored.where(crowded).repartition(_tasks(stored)))
    return parts, cost


def cover(polygons: DataFrame, grid: GridSpec = GridSpec()) -> DataFrame:
    return measured_cover(polygons, grid)[0]


def containing_polygons(
    points: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
) -> DataFrame:
    """Every pair of a point (any columns plus x, y) and a polygon strictly containing it: point columns and postcode.

    The cover is broadcast when its measured size allows. Otherwise both sides are shuffled by cell, and cells that hold
    very many points, or polygons, are split.
    """
    cells, cells_bytes = measured_cover(polygons, grid)
    # The levels are exponents of two, so they are few: of doubles there are about two thousand.
    levels = sorted(row.level for row in cells.select("level").distinct().collect())
    placed = points.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    placed = placed.selectExpr("*", "floor(x / pow(2D, level)) as cell_x", "floor(y / pow(2D, level)) as cell_y")
    # The corner belongs to the point's side of the join, so that it is not computed again for every edge.
    right, top = (f"(cell_{axis} + 1) * pow(2D, level) as {name}" for axis, name in zip("xy", CORNER))
    placed = placed.selectExpr("*", right, top)
    keys = ["level", "cell_x", "cell_y"]
    if cells_bytes <= grid.broadcast_bytes:
        candidates = placed.join(F.broadcast(cells), keys)
    else:
        candidates = skew_join(placed, cells, keys, "inner", limits, split_right=True)
    inside = f"exists(rims, r -> {inside_cell('x', 'y', *CORNER, 'r.edges', 'r.odd')})"
    return candidates.where(f"whole or {inside}").select(*map(quoted, points.columns), "postcode")
