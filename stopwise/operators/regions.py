"""Stops inside regions, region centroid and nearest weather station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import SHAPE_LEVEL
from stopwise.functions.geo import ring_edges, sphere_distance
from stopwise.sources.shapes import with_bounds

#: Cells are 2^-level degrees wide, so that all their borders are exact numbers.
COARSEST_LEVEL, FINEST_LEVEL = -5, 20
SALTS = 8


def select_regions(polygons: DataFrame, region_ids: Sequence[str], level: str = SHAPE_LEVEL) -> DataFrame:
    """Polygons ``(uuid, level, rings)`` of the named regions."""
    return polygons.filter((F.col("level") == level) & F.trim("uuid").isin(*region_ids))


def _cross(e: str, lon: str, lat: str) -> str:
    return f"(({e}.b.lon - {e}.a.lon) * ({lat} - {e}.a.lat) - ({e}.b.lat - {e}.a.lat) * ({lon} - {e}.a.lon))"


def _lies_east(e: str, lon: str, lat: str) -> str:
    """The edge crosses the ray from the point to the east; half-open latitudes count a corner on the ray once."""
    return f"""CASE
        WHEN ({e}.a.lat <= {lat}) = ({e}.b.lat <= {lat}) OR greatest({e}.a.lon, {e}.b.lon) <= {lon} THEN false
        WHEN least({e}.a.lon, {e}.b.lon) > {lon} THEN true
        ELSE {_cross(e, lon, lat)} * sign({e}.b.lat - {e}.a.lat) > 0 END"""


def _lies_north(e: str, lon: str, lat: str) -> str:
    """As ``_lies_east`` for the ray to the north. Of an edge through the point, the part just east of it counts."""
    cross, eastward = _cross(e, lon, lat), f"sign({e}.b.lon - {e}.a.lon)"
    return f"""CASE
        WHEN ({e}.a.lon <= {lon}) = ({e}.b.lon <= {lon}) OR greatest({e}.a.lat, {e}.b.lat) <= {lat} THEN false
        WHEN least({e}.a.lat, {e}.b.lat) > {lat} THEN true
        WHEN {cross} = 0 THEN ({e}.b.lat - {e}.a.lat) * {eastward} > 0
        ELSE {cross} * {eastward} < 0 END"""


def _on_edge(e: str, lon: str, lat: str) -> str:
    return f"""({lon} BETWEEN least({e}.a.lon, {e}.b.lon) AND greatest({e}.a.lon, {e}.b.lon)
        AND {lat} BETWEEN least({e}.a.lat, {e}.b.lat) AND greatest({e}.a.lat, {e}.b.lat) AND {_cross(e, lon, lat)} = 0)"""


def _cell_contains(lon: str, lat: str) -> Column:
    """True for a point of a cell strictly inside the cell's polygon, from the edges that come into the cell alone.

    ``corner`` is 1 if the cell's corner at ``(west, south)`` is inside. From there one goes up the western side and then east
    to the point; each edge met on the way changes sides. Further edges in the list do no harm: they are on the same side of
    both ends of each way.
    """
    up = f"size(filter(edges, e -> ({_lies_north('e', 'west', 'south')}) != ({_lies_north('e', 'west', lat)})))"
    along = f"size(filter(edges, e -> ({_lies_east('e', 'west', lat)}) != ({_lies_east('e', lon, lat)})))"
    return F.expr(f"NOT exists(edges, e -> {_on_edge('e', lon, lat)}) AND (corner + {up} + {along}) % 2 = 1")


def _levelled(polygons: DataFrame) -> DataFrame:
    """Rings, edges and level of each polygon: about as many cells along an axis as the root of its edges."""
    edges = F.flatten(F.transform("rings", ring_edges)).alias("edges")
    bounded = with_bounds(polygons.select("rings", edges)).filter("size(edges) > 0")
    extent = "nullif(greatest(max_lon - min_lon, max_lat - min_lat), 0D)"
    fitting = f"coalesce(floor(log2(sqrt(size(edges)) / {extent})), {FINEST_LEVEL})"
    level = f"cast(greatest({COARSEST_LEVEL}, least({FINEST_LEVEL}, {fitting})) AS int)"
    return bounded.selectExpr("rings", "edges", f"{level} AS level")


def region_cells(polygons: DataFrame) -> DataFrame:
    """Cells ``(level, cell_x, cell_y, corner, edges)`` that cover the polygons, each polygon on the level of its own size.

    Cells of a level are 2^-level degrees wide. A cell on the border of a polygon has the edges that come into it, and
    ``corner`` tells if its south-western corner is inside. A cell with no edges lies inside as a whole; cells outside have no
    row, and a polygon given twice counts once. A polygon of n edges has about (sqrt(n) + 2)^2 cells at most.

    Edges are dealt over the rows of cells they cross. Where an edge crosses the southern border of a row, all corners west of
    it change sides, so that a running count from east to west tells the corners' sides and those of the cells between.
    """
    shapes = _levelled(polygons).withColumn("shape", F.sha2(F.to_json("rings"), 256)).drop("rings").dropDuplicates(["shape"])
    rows = shapes.selectExpr("shape", "level", "pow(2D, level) AS scale", "explode(edges) AS e").selectExpr(
        "*", "explode(sequence(floor(least(e.a.lat, e.b.lat) * scale), floor(greatest(e.a.lat, e.b.lat) * scale))) AS cell_y"
    )

    def lon_at(lat: str) -> str:
        return f"(e.a.lon + ({lat} - e.a.lat) / nullif(e.b.lat - e.a.lat, 0D) * (e.b.lon - e.a.lon))"

    def east_of(cell: str) -> str:
        return _lies_east("e", f"(({cell}) / scale)", "(cell_y / scale)")

    rows = rows.selectExpr(
        "shape", "level", "scale", "e", "cell_y", f"floor({lon_at('cell_y / scale')} * scale) AS near_x",
        f"{lon_at('greatest(least(e.a.lat, e.b.lat), cell_y / scale)')} AS one_lon",
        f"{lon_at('least(greatest(e.a.lat, e.b.lat), (cell_y + 1) / scale)')} AS other_lon",
    )
    # Horizontal edges have no such longitudes; least and greatest pass over nulls. A millionth of a cell more on both sides
    # outweighs rounding. The crossing is in the easternmost cell whose south-western
    # corner the edge lies east of, if it crosses the row's southern border at all.
    reached = rows.selectExpr(
        "shape", "level", "e", "cell_y",
        "floor(greatest(least(one_lon, other_lon) - 1e-6D / scale, least(e.a.lon, e.b.lon)) * scale) AS low_x",
        "floor(least(greatest(one_lon, other_lon) + 1e-6D / scale, greatest(e.a.lon, e.b.lon)) * scale) AS high_x",
        f"""CASE WHEN {east_of('near_x + 1')} THEN near_x + 1 WHEN {east_of('near_x')} THEN near_x
            WHEN {east_of('near_x - 1')} THEN near_x - 1 END AS crossing_x""",
    )
    touched = reached.selectExpr(
        "shape", "level", "cell_y", "e", "crossing_x", "explode(sequence(least(low_x, crossing_x), greatest(high_x, crossing_x))) AS cell_x"
    )
    cells = touched.groupBy("shape", "level", "cell_y", "cell_x").agg(
        F.count_if(F.col("crossing_x") == F.col("cell_x")).alias("crossings"), F.collect_list("e").alias("edges")
    )
    westward = Window.partitionBy("shape", "level", "cell_y").orderBy(F.desc("cell_x"))
    changed = F.sum("crossings").over(westward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sided = cells.withColumns({"corner": changed % 2, "west_x": F.lead("cell_x").over(westward)})
    between = "if(corner = 1 AND cell_x - west_x > 1, sequence(west_x + 1, cell_x - 1), array())"
    whole = f"transform({between}, x -> struct(x AS cell_x, slice(edges, 1, 0) AS edges))"
    found = sided.selectExpr("level", "cell_y", "corner", f"inline(concat(array(struct(cell_x, edges)), {whole}))")
    return found.select("level", "cell_x", "cell_y", "corner", "edges")


def stops_within(stops: DataFrame, polygons: DataFrame) -> DataFrame:
    """Rows of ``stops`` strictly inside any of the polygons; stops without a place are in none.

    Each place counts once, however many rows of ``stops`` have it, and meets the cells that hold it, on each level that
    some polygon has. Places of a cell are dealt over several salts, and the cells repeated, so that a crowded cell
    is shared between tasks. A semi join keeps a stop once however many polygons hold it.
    """
    levels = _levelled(polygons).agg(F.collect_set("level")).scalar()
    places = stops.select("stop_lon", "stop_lat").distinct().withColumn("level", F.explode(levels))
    gridded = places.selectExpr(
        "*", "floor(stop_lon * pow(2D, level)) AS cell_x", "floor(stop_lat * pow(2D, level)) AS cell_y",
        f"pmod(xxhash64(stop_lon, stop_lat), {SALTS}) AS salt",
    )
    cells = region_cells(polygons).selectExpr(
        "*", "cell_x / pow(2D, level) AS west", "cell_y / pow(2D, level) AS south", f"explode(sequence(0L, {SALTS - 1}L)) AS salt"
    )
    inside = gridded.join(cells, ["level", "cell_x", "cell_y", "salt"]).filter(_cell_contains("stop_lon", "stop_lat"))
    return stops.join(inside.select("stop_lon", "stop_lat"), ["stop_lon", "stop_lat"], "left_semi").select(*stops.columns)


def _directed_edges(polygons: DataFrame) -> DataFrame:
    """Edges ``(shape, ax, ay, bx, by)`` with the inside of their polygon on the left; a polygon given twice counts once."""
    shapes = polygons.select("rings", F.sha2(F.to_json("rings"), 256).alias("shape")).dropDuplicates(["shape"])
    rings = shapes.select("shape", F.posexplode("rings").alias("number", "ring"))
    doubled = F.aggregate(ring_edges(F.col("ring")), F.lit(0.0), lambda acc, e: acc + e.a.lon * e.b.lat - e.b.lon * e.a.lat)
    turned = (doubled > 0) != (F.col("number") == 0)
    edges = rings.select("shape", turned.alias("turned"), F.explode(ring_edges(F.col("ring"))).alias("e"))
    return edges.selectExpr("shape", "inline(array(if(turned, struct(e.b AS a, e.a AS b), e)))").selectExpr(
        "shape", "a.lon AS ax", "a.lat AS ay", "b.lon AS bx", "b.lat AS by"
    )


def _cell_pieces(edges: DataFrame) -> DataFrame:
    """What each edge is in each cell of its polygon's box: ``(cell_x, cell_y, low_y, high_y, low_x, high_x, turn)``.

    Cells are as large as the average polygon; coordinates are relative to the cell. What lies west or east of a cell is moved
    to its border, so that going east through a cell ``turn`` adds up to the number of polygons around each point.
    Equal pieces are added up, so that borders shared by neighbours vanish.
    """
    boxes = edges.groupBy("shape").agg(
        F.min("ax").alias("west"), F.max("ax").alias("east"), F.min("ay").alias("south"), F.max("ay").alias("north")
    )
    # One row, joined: callers use the centroid in scalar subqueries, and Spark fails when it merges two of those with one more inside.
    size = boxes.agg(F.avg(F.expr("east - west")).alias("w"), F.avg(F.expr("north - south")).alias("h"))
    sized = edges.join(boxes, "shape").crossJoin(F.broadcast(size)).filter("ay != by AND w > 0 AND h > 0")
    upward = sized.selectExpr(
        "west", "east", "w", "h", "if(by > ay, -1, 1) AS turn", "least(ay, by) AS y0", "greatest(ay, by) AS y1",
        "if(by > ay, ax, bx) AS x0", "if(by > ay, bx, ax) AS x1",
    )
    # An edge that lies east of a cell has an effect on it only by closing what is open, so it comes to all cells of the box.
    rows = upward.selectExpr("*", "explode(sequence(floor(y0 / h), floor(y1 / h))) AS cell_y").selectExpr(
        "*", "explode(sequence(floor(west / w), floor(east / w))) AS cell_x",
        "greatest(y0, cell_y * h) AS from_y", "least(y1, (cell_y + 1) * h) AS to_y",
    ).filter("from_y < to_y")

    def crossing(x: str) -> str:
        return f"if(x0 = x1, from_y, greatest(from_y, least(to_y, y0 + ({x} - x0) / (x1 - x0) * (y1 - y0))))"

    cuts = f"array_sort(array(from_y, to_y, {crossing('cell_x * w')}, {crossing('(cell_x + 1) * w')}))"
    parts = rows.withColumn("cuts", F.expr(cuts)).selectExpr("*", "explode(sequence(0, 2)) AS part").selectExpr(
        "cell_x", "cell_y", "w", "h", "turn", "x0", "x1", "y0", "y1", "cuts[part] AS p", "cuts[part + 1] AS q"
    ).filter("p < q")

    def inside(y: str) -> str:
        return f"least(w, greatest(0D, x0 + ({y} - y0) / (y1 - y0) * (x1 - x0) - cell_x * w))"

    pieces = parts.selectExpr(
        "cell_x", "cell_y", "w", "h", "p - cell_y * h AS low_y", "q - cell_y * h AS high_y",
        f"{inside('p')} AS low_x", f"{inside('q')} AS high_x", "turn",
    )
    keys = [c for c in pieces.columns if c != "turn"]
    return pieces.groupBy(*keys).agg(F.sum("turn").alias("turn")).filter("turn != 0")


def union_moments(polygons: DataFrame) -> DataFrame:
    """One row ``(area, mx, my)`` of the union of all polygons, however they overlap; the centroid is ``(mx, my) / area``.

    Each cell is cut into slabs at every corner and crossing in it, so that within a slab edges do not change their order. Going
    east through a slab, the running number of polygons around tells which edges bound the union. Only edges of one cell
    meet. Without polygons, or with none that has an area, all three are null.
    """
    pieces = _cell_pieces(_directed_edges(polygons))
    cell = ["cell_x", "cell_y"]
    slope = "(({0}high_x - {0}low_x) / ({0}high_y - {0}low_y))"
    one, two = pieces.alias("one"), pieces.alias("two")
    gap = f"(two.low_x - one.low_x + (one.low_y - two.low_y) * {slope.format('two.')})"
    meeting = f"one.low_y + {gap} / nullif({slope.format('one.')} - {slope.format('two.')}, 0D)"
    # Two pieces that cross lie in each other's box.
    boxed = [f"one.{c} = two.{c}" for c in cell] + ["one.low_y < two.high_y AND two.low_y < one.high_y"]
    boxed += [f"least({f}.low_x, {f}.high_x) <= greatest({g}.low_x, {g}.high_x)" for f, g in (("one", "two"), ("two", "one"))]
    crossings = one.join(two, F.expr(" AND ".join(boxed))).select(
        *[F.col(f"one.{c}") for c in cell], F.expr(meeting).alias("y"), F.expr("greatest(one.low_y, two.low_y) AS least_y"), F.expr("least(one.high_y, two.high_y) AS most_y")
    ).filter("y > least_y AND y < most_y").select(*cell, "y")
    corners = pieces.select(*cell, F.explode(F.array("low_y", "high_y")).alias("y"))
    upward = Window.partitionBy(*cell).orderBy("y")
    slabs = corners.union(crossings).distinct().withColumn("top", F.lead("y").over(upward)).filter("top IS NOT NULL")
    within = pieces.join(slabs, cell).filter("low_y <= y AND high_y >= top").selectExpr(
        *cell, "w", "h", "y", "top - y AS height", "turn",
        f"low_x + (y - low_y) * {slope.format('')} AS a",
        f"low_x + (top - low_y) * {slope.format('')} AS b",
    )
    eastward = Window.partitionBy(*cell, "y").orderBy(F.expr("a + b"), "turn", "a").rowsBetween(Window.unboundedPreceding, 0)
    bounds = within.withColumn("around", F.sum("turn").over(eastward)).withColumn(
        "side", F.expr("cast(around - turn > 0 AS int) - cast(around > 0 AS int)")
    ).filter("side != 0")
    moments = bounds.selectExpr(
        "side * height * (a + b) / 2 AS area", "side * height * (a * a + a * b + b * b) / 6 AS mx",
        "side * height * ((a + b) / 2 * y + height * (a / 6 + b / 3)) AS my", "cell_x * w AS west", "cell_y * h AS south",
    )
    return moments.selectExpr("sum(area) AS area", "sum(mx + west * area) AS mx", "sum(my + south * area) AS my")


def region_centroid(polygons: DataFrame) -> DataFrame:
    """Area-weighted centroid of the union of the polygons, one row ``(lon, lat)``; parts that overlap count once."""
    parts = union_moments(polygons)
    return parts.select((F.col("mx") / F.col("area")).alias("lon"), (F.col("my") / F.col("area")).alias("lat"))


def closest_site(stations: DataFrame, centroid: DataFrame) -> DataFrame:
    """One row ``(site, distance)``: the active station nearest to a one-row centroid."""
    point = centroid.selectExpr("lon AS _lon", "lat AS _lat")
    distance = sphere_distance(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat"))
    nearest = F.min(F.struct(distance.alias("distance"), "site"))
    placed = stations.filter("active").join(F.broadcast(point), F.lit(True), "left")
    return placed.agg(nearest.alias("n")).select("n.site", "n.distance")
