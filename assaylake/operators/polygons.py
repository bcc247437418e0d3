"""Polygons that share area, by filter and refine, in expressions and equi-joins only.

The area two polygons share is a sum over pairs of their edges. The region below an edge, down to a common base line, counts
positive or negative by the edge's direction; a polygon is the sum of its regions, holes included, so the shared area is the
sum over edge pairs of the area below both edges, with the product of their signs. That needs no case for touching corners,
shared borders or one shape inside the other: neighbours that only share a border come out as zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions import geo
from assaylake.operators.joins import cells_of
from assaylake.session import stored

STRIP_EDGES = 32  # edges of a polygon in one strip of a pair, about
TOLERANCE = 1e-9  # of the smaller polygon's area: less counts as rounding
TRIES = (2, 6, 24)  # partners that a polygon still open is held against, before all that are left


def _turn(xs: Column, ys: Column) -> Column:
    """Twice the signed area of a ring; positive if it runs against the clock."""
    steps = F.sequence(F.lit(2), F.size(xs))
    total = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.element_at(xs, i - 1) * F.element_at(ys, i)
                        - F.element_at(xs, i) * F.element_at(ys, i - 1))
    return F.when(F.size(xs) > 1, total).otherwise(F.lit(0.0))


def edges(shapes: DataFrame, key: str, shape: str = "geom") -> DataFrame:
    """(key, ring, n, ax, ay, bx, by, sign): the edges of polygons, from left to right; upright edges are left out.

    ``sign`` is 1 where the polygon lies below the edge. A polygon's first ring is its shell and the others are holes, however they
    run; the rings of a multipolygon count by their direction, that of the first being a shell's.
    """
    g = F.col(shape)
    ring = F.struct("xs", "ys", _turn(F.col("xs"), F.col("ys")).alias("turn"))
    rings = shapes.where(g["kind"].isin("Polygon", "MultiPolygon")).select(
        key, (g["kind"] == "Polygon").alias("_one"), _turn(g["xs"][0], g["ys"][0]).alias("_first"),
        F.posexplode(F.arrays_zip(g["xs"].alias("xs"), g["ys"].alias("ys"))).alias("ring", "_r"))
    rings = rings.select(key, "_one", "_first", "ring", "_r.xs", "_r.ys").withColumn("_turn", ring["turn"])
    shell = F.when(F.col("_one"), F.col("ring") == 0).otherwise(F.signum("_turn") == F.signum("_first"))
    # a shell that runs against the clock has its inside below the edges that run to the left
    against = (F.col("_turn") > 0) == shell
    at = F.posexplode(F.transform(F.slice("xs", 2, F.greatest(F.size("xs") - 1, F.lit(0))), lambda x, i: F.struct(
        F.element_at("xs", i + 1).alias("px"), F.element_at("ys", i + 1).alias("py"), x.alias("qx"), F.element_at("ys", i + 2).alias("qy"))))
    rows = rings.select(key, "ring", against.alias("_against"), at.alias("n", "_e")).select(key, "ring", "n", "_against", "_e.*")
    left = F.col("px") > F.col("qx")
    ends = {"ax": ("qx", "px"), "ay": ("qy", "py"), "bx": ("px", "qx"), "by": ("py", "qy")}
    return rows.where("px <> qx").select(key, "ring", "n", *[F.when(left, F.col(a)).otherwise(F.col(b)).alias(n) for n, (a, b) in ends.items()],
                                         F.when(left == F.col("_against"), 1.0).otherwise(-1.0).alias("sign"))


def _height(edge: str, x: Column) -> Column:
    a, b = F.col(f"{edge}.a"), F.col(f"{edge}.b")
    share = (x - a["x"]) / (b["x"] - a["x"])
    return a["y"] * (1 - share) + b["y"] * share


def shared_areas(pairs: DataFrame, sides: DataFrame, sizes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``shared``, the area the two have in common.

    A pair's common x range is cut into strips by the number of edges, so a strip holds about ``STRIP_EDGES`` of each, and the edges of
    both sides meet by (pair, strip). Edges outside the common range do not travel. ``sizes`` has key, extent and number of edges.
    """
    own = {side: sizes.select(*[F.col(c).alias(f"{side}_{c}") for c in sizes.columns]) for side in "ab"}
    boxed = pairs.join(own["a"].hint("merge"), F.col("a") == F.col("a_key")).join(own["b"].hint("merge"), F.col("b") == F.col("b_key"))
    low, high = F.greatest("a_xmin", "b_xmin"), F.least("a_xmax", "b_xmax")
    strips = F.greatest(F.ceil(F.greatest("a_edges", "b_edges") / STRIP_EDGES), F.lit(1)).cast("double")
    boxed = boxed.select("a", "b", low.alias("low"), high.alias("high"), ((high - low) / strips).alias("width"), strips.alias("strips"),
                         F.least("a_ymin", "b_ymin").alias("base"))

    def cut(side: str) -> DataFrame:
        near = boxed.join(sides.hint("merge"), (F.col(side) == F.col("key")) & (F.col("ax") < F.col("high")) & (F.col("bx") > F.col("low")))

        def strip(x: Column) -> Column:
            return F.least(F.greatest(F.floor((x - F.col("low")) / F.col("width")).cast("long"), F.lit(0).cast("long")), F.col("strips").cast("long") - 1)

        out = near.select("a", "b", "low", "width", "base", "sign", F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("a_"),
                          F.struct(F.col("bx").alias("x"), F.col("by").alias("y")).alias("b_"),
                          F.explode(F.sequence(strip(F.col("ax")), strip(F.col("bx")))).alias("strip"))
        return out.select("a", "b", "strip", F.struct(F.col("a_").alias("a"), F.col("b_").alias("b"), "sign").alias(side + "_edge"),
                          *(["low", "width", "base"] if side == "a" else []))

    met = cut("a").join(cut("b").hint("merge"), ["a", "b", "strip"])
    left, right = F.col("low") + F.col("strip") * F.col("width"), F.col("low") + (F.col("strip") + 1) * F.col("width")
    met = met.withColumns({"l": F.greatest(left, F.col("a_edge.a.x"), F.col("b_edge.a.x")), "r": F.least(right, F.col("a_edge.b.x"), F.col("b_edge.b.x"))}).where("l < r")
    met = met.withColumns({f"{s}{end}": _height(f"{s}_edge", F.col(end)) - F.col("base") for s in "ab" for end in "lr"})
    slope = (F.col("ar") - F.col("al")) - (F.col("br") - F.col("bl"))
    cross = (F.col("bl") - F.col("al")) / slope
    top = F.col("al") + cross * (F.col("ar") - F.col("al"))
    lows = [F.least(f"a{end}", f"b{end}") for end in "lr"]
    crossing = (F.col("al") - F.col("bl")) * (F.col("ar") - F.col("br")) < 0
    below = F.when(crossing, cross * (lows[0] + top) / 2 + (1 - cross) * (top + lows[1]) / 2).otherwise((lows[0] + lows[1]) / 2)
    return met.groupBy("a", "b").agg(F.sum(below * (F.col("r") - F.col("l")) * F.col("a_edge.sign") * F.col("b_edge.sign")).alias("shared"))


def overlapping_polygons(df: DataFrame, key: str, shape: str = "geom") -> DataFrame:
    """The keys of polygons that share area with another one, each once.

    1. Equal shapes are counted and go on as one.
    2. Filter: extents that share area meet in grids whose cell size doubles per level, each shape in the level of its own size.
    3. Refine: in turns, the shapes still open against a few that meet their extents, drawn from a few of each cell. Where shapes
       crowd that settles nearly all of them with a bounded number of pairs each. Those left are held against all that meet them.

    Null keys and null or empty shapes take no part, nor do shapes that are no polygons. Rings should be valid (``shape_problem``).

    All joins are sorted ones: what is stored here takes far more room in memory than in files, so a file's size must not make Spark
    broadcast it through the driver.
    """
    g = F.col(shape)
    usable = df.where(F.col(key).isNotNull() & g["kind"].isin("Polygon", "MultiPolygon") & ~geo.is_missing(g))
    rows = stored(usable.select(F.col(key).alias("_key"), F.xxhash64(g["xs"], g["ys"]).alias("_look"), g.alias("geom")), "polygons")
    own = rows.groupBy("_look", F.struct("geom.xs", "geom.ys").alias("_same")).agg(
        F.min("_key").alias("key"), F.count("*").alias("copies"), F.min("geom.kind").alias("kind"))
    own = own.select("key", "copies", F.struct("kind", F.col("_same.xs").alias("xs"), F.col("_same.ys").alias("ys")).alias("geom"))
    own = stored(own, "distinct-polygons")
    extent = geo.bounds(F.struct("geom.kind", F.lit(0).alias("srid"), "geom.xs", "geom.ys"))
    count = F.aggregate("geom.xs", F.lit(0), lambda n, x: n + F.size(x))
    sizes = own.select("key", "copies", count.alias("edges"), geo.area(F.col("geom")).alias("_area"), extent.alias("_e")).select("key", "copies", "edges", "_area", "_e.*")
    sizes = stored(sizes.where("xmin < xmax and ymin < ymax"), "extents")
    sides = stored(edges(own, "key"), "edges")
    sides = sides.where("ax < bx")
    placed, seekers = cells_of(sizes.select("key", "xmin", "ymin", "xmax", "ymax"))

    areas = sizes.select("key", F.col("_area").alias("size"))

    def hits(pairs: DataFrame) -> DataFrame:
        found = shared_areas(pairs, sides, sizes.drop("copies", "_area"))
        for side in "ab":
            found = found.join(areas.select(F.col("key").alias(side), F.col("size").alias(f"_{side}")).hint("merge"), side)
        found = found.where(F.col("shared") > F.least("_a", "_b") * TOLERANCE)
        return found.select(F.explode(F.array("a", "b")).alias("key")).distinct()

    cell = ("at", "cx", "cy")
    size = F.pow(F.lit(2.0), F.col("o.at"))
    # two extents share several cells; only the one with the lower left corner of what they share counts
    meets = [F.col(f"o.{c}") == F.col(f"p.{c}") for c in cell] + [F.col("o.key") != F.col("p.key")] + [
        F.col(f"{a}.{d}min") < F.col(f"{b}.{d}max") for d in "xy" for a, b in ("op", "po")] + [
        F.col(f"o.c{d}") == F.floor(F.greatest(f"o.{d}min", f"p.{d}min") / size).cast("bigint") for d in "xy"]
    # shapes of one level find each other as seekers
    finer = seekers.where("own < at")

    def listed(still: DataFrame, turn: int | None = None) -> DataFrame:
        """Pairs (a, b) with a shape still open and extents that meet: all of them, or those of a turn."""
        found = []
        for own, others in ((seekers, placed), (placed, finer)):
            if turn is not None:
                few = Window.partitionBy(*cell).orderBy(F.xxhash64("key", F.lit(turn)), "key")
                others = others.withColumn("_nth", F.row_number().over(few)).where(F.col("_nth") <= 2 * TRIES[turn])
            mine = own.join(still.hint("merge"), "key", "left_semi")
            found.append(mine.alias("o").join(others.alias("p").hint("merge"), reduce(lambda a, b: a & b, meets)).select(
                F.col("o.key").alias("a"), F.col("p.key").alias("b")))
        pairs = found[0].unionByName(found[1])
        if turn is not None:
            few = Window.partitionBy("a").orderBy(F.xxhash64("a", "b", F.lit(turn)), "b")
            pairs = pairs.withColumn("_nth", F.row_number().over(few)).where(F.col("_nth") <= TRIES[turn])
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    hit = stored(sizes.where("copies > 1").where("_area > 0").select("key"), "overlapping-copies")
    for turn in (*range(len(TRIES)), None):
        still = stored(sizes.select("key").join(hit.hint("merge"), "key", "left_anti"), "still-open")
        if still.isEmpty():
            break
        hit = stored(hit.unionByName(hits(stored(listed(still, turn), "open-pairs"))).distinct(), "overlapping")
    # back to all copies of a shape
    shapes = own.join(hit.hint("merge"), "key", "left_semi").select(F.xxhash64("geom.xs", "geom.ys").alias("_look"), F.struct("geom.xs", "geom.ys").alias("_same"))
    again = rows.withColumn("_same", F.struct("geom.xs", "geom.ys"))
    return again.join(shapes.hint("merge"), ["_look", "_same"], "left_semi").select(F.col("_key").alias(key)).distinct()


PROBLEMS = ("too_few_points", "ring_not_closed", "no_area", "self_crossing", "rings_cross", "hole_outside")
FEW_SEGMENTS = 64  # segments of a polygon that are compared within its row
BETWEEN = 1 << 30  # stands for a ring in problems between rings, which come last


def _side(a: Column, b: Column, p: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))


def _in_strips(segments: DataFrame) -> DataFrame:
    """Segments (a left of b) with the cells of their polygon's grid that they run through; the grid is as fine as there are segments."""
    def cell(value: Column, low: str, size: str) -> Column:
        return F.least(F.greatest(F.floor((value - F.col(low)) / F.col(size)), F.lit(0)), F.col("grid") - 1)

    columns = segments.withColumn("cx", F.explode(F.sequence(cell(F.col("a.x"), "xmin", "dx"), cell(F.col("b.x"), "xmin", "dx"))))
    left, right = F.col("xmin") + F.col("cx") * F.col("dx"), F.col("xmin") + (F.col("cx") + 1) * F.col("dx")
    width = F.col("b.x") - F.col("a.x")

    def height(x: Column) -> Column:
        return F.when(width > 0, F.col("a.y") + (F.col("b.y") - F.col("a.y")) * (F.least(F.greatest(x, F.col("a.x")), F.col("b.x")) - F.col("a.x")) / width)

    ends = [F.coalesce(height(left), F.col("a.y")), F.coalesce(height(right), F.col("b.y"))]
    # a cell more on both sides, so that rounding hides no meeting
    low, high = cell(F.least(*ends), "ymin", "dy") - 1, cell(F.greatest(*ends), "ymin", "dy") + 1
    return columns.withColumn("cy", F.explode(F.sequence(low, high)))


def _crossings(pairs: DataFrame) -> DataFrame:
    """(id, ring, at) of pairs of segments, ``s`` before ``t``, that meet where they must not."""
    s_a, s_b, t_a, t_b = (F.col(c) for c in ("s_a", "s_b", "t_a", "t_b"))
    d1, d2, d3, d4 = _side(s_a, s_b, t_a), _side(s_a, s_b, t_b), _side(t_a, t_b, s_a), _side(t_a, t_b, s_b)

    def overlap(axis: str, strict: bool = False) -> Column:
        low = F.greatest(F.least(s_a[axis], s_b[axis]), F.least(t_a[axis], t_b[axis]))
        high = F.least(F.greatest(s_a[axis], s_b[axis]), F.greatest(t_a[axis], t_b[axis]))
        return low < high if strict else low <= high

    same = F.col("s_ring") == F.col("t_ring")
    gap = F.col("t_n") - F.col("s_n")
    # extents are compared first: most pairs are settled by them
    close = overlap("x") & overlap("y")
    meets = same & (gap != 1) & (gap != F.col("s_count") - 1) & (d1 * d2 <= 0) & (d3 * d4 <= 0)
    along = (d1 == 0) & (d2 == 0) & (overlap("x", True) | overlap("y", True))
    between = ~same & (((d1 * d2 < 0) & (d3 * d4 < 0)) | along)
    return pairs.where(close & (meets | between)).select(
        "id", F.when(same, F.col("s_ring")).otherwise(F.lit(BETWEEN)).alias("ring"), F.when(same, 3.0).otherwise(4.0).alias("at")).distinct()


def _on(a: Column, b: Column, p: Column) -> Column:
    """The point lies on the segment."""
    return (_side(a, b, p) == 0) & (p["x"] >= a["x"]) & (p["x"] <= b["x"]) & (p["y"] >= F.least(a["y"], b["y"])) & (p["y"] <= F.greatest(a["y"], b["y"]))


def _above(a: Column, b: Column, p: Column) -> Column:
    """A ray upwards from the point meets the segment."""
    return (a["x"] <= p["x"]) & (p["x"] < b["x"]) & (_side(a, b, p) < 0)


def _outside(found: DataFrame) -> DataFrame:
    return found.select("id", F.lit(BETWEEN).alias("ring"), F.lit(5.0).alias("at")).distinct()


def _within_rows(shapes: DataFrame) -> DataFrame:
    """(id, ring, at) of shapes with few segments: their segments are compared where they stand, without a shuffle."""
    shapes = shapes.select("id", F.when(F.col("one"), F.filter("segments", lambda s: s["ring"] == 0)).alias("shell"), "segments")
    first = shapes.select("id", "segments", F.posexplode("segments").alias("i", "s"))
    pairs = first.select("id", "s", F.explode(F.slice("segments", F.col("i") + 2, F.size("segments"))).alias("t"))
    crossing = _crossings(pairs.select("id", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "st" for c in ("ring", "n", "count", "a", "b")]))

    def alone(corner: Column) -> Column:
        p = corner["from"]
        on = F.exists("shell", lambda s: _on(s["a"], s["b"], p))
        return (corner["ring"] > 0) & ~on & (F.size(F.filter("shell", lambda s: _above(s["a"], s["b"], p))) % 2 == 0)

    return crossing.unionByName(_outside(shapes.where(F.col("shell").isNotNull() & F.exists("segments", alone))))


def _by_cells(shapes: DataFrame) -> DataFrame:
    """(id, ring, at) of shapes of any size: crossings by a join of segments by (polygon, cell), holes outside their shell by even-odd
    counts by (polygon, column of cells).

    What is stored here takes little room in files and much in memory, so the joins are sorted ones: a file's size must not make
    Spark broadcast it.
    """
    grid = F.greatest(F.ceil(F.sqrt(F.col("steps") / 2)), F.lit(1)).cast("long").alias("grid")
    rows = shapes.select("id", "one", "e.*", grid, F.explode("segments").alias("s"))

    def size(low: str, high: str) -> Column:
        return F.when(F.col(high) > F.col(low), (F.col(high) - F.col(low)) / F.col("grid")).otherwise(F.lit(1.0))

    segments = stored(rows.select("id", "one", "s.*", "grid", "xmin", "ymin", size("xmin", "xmax").alias("dx"), size("ymin", "ymax").alias("dy")), "segments")
    placed = stored(_in_strips(segments).select("id", "ring", "n", "count", "cx", "cy", "a", "b"), "segment-cells")
    one = placed.select(*[F.col(c).alias(c if c in ("id", "cx", "cy") else f"s_{c}") for c in placed.columns])
    two = placed.select(*[F.col(c).alias(c if c in ("id", "cx", "cy") else f"t_{c}") for c in placed.columns])
    pairs = one.hint("merge").join(two, ["id", "cx", "cy"]).where("s_ring < t_ring or (s_ring = t_ring and s_n < t_n)")

    # a ray upwards from every corner of a hole meets the shell an odd number of times, or the corner lies on the shell
    shell = segments.where("one and ring = 0").select("id", "a", "b", F.explode(F.sequence(*[
        F.floor((F.col(f"{e}.x") - F.col("xmin")) / F.col("dx")) for e in ("a", "b")])).alias("cx"))
    corners = segments.where("one and ring > 0").select("id", "ring", "n", F.col("from").alias("p"), F.floor((F.col("from.x") - F.col("xmin")) / F.col("dx")).alias("cx"))
    a, b, p = F.col("a"), F.col("b"), F.col("p")
    rays = corners.join(shell.hint("merge"), ["id", "cx"], "left").groupBy("id", "ring", "n").agg(
        F.coalesce(F.bool_or(_on(a, b, p)), F.lit(False)).alias("on"), F.count_if(_above(a, b, p)).alias("met"))
    return _crossings(pairs).unionByName(_outside(rays.where("not on and met % 2 = 0")))


def polygon_problems(df: DataFrame, key: str, shape: str = "geom") -> DataFrame:
    """(key, problem): the first of ``PROBLEMS`` of every polygon that has one, ring by ring; then what is wrong between its rings.

    Shapes with up to ``FEW_SEGMENTS`` segments are settled within their row. The segments of larger ones are spread over tasks by the
    cells they run through, so a shape may have any size. Rings may touch in points; they may not cross or share a border.
    Keys should be unique. Null keys and shapes, and shapes that are no polygons, have no problem.
    """
    g = F.col(shape)
    usable = df.where(F.col(key).isNotNull() & g["kind"].isin("Polygon", "MultiPolygon") & ~geo.is_missing(g))
    kind = "array<struct<s:struct<x:double,y:double>,t:struct<x:double,y:double>>>"

    def points(r: Column) -> Column:
        return F.struct(F.zip_with(r["xs"], r["ys"], lambda x, y: F.struct(x.alias("x"), y.alias("y"))).alias("p"), _turn(r["xs"], r["ys"]).alias("turn"))

    def stepped(r: Column) -> Column:
        steps = F.zip_with(F.slice(r["p"], 1, F.size(r["p"]) - 1), F.slice(r["p"], 2, F.size(r["p"])), lambda s, t: F.struct(s.alias("s"), t.alias("t")))
        steps = F.when(F.size(r["p"]) > 1, F.filter(steps, lambda x: x["s"] != x["t"])).otherwise(F.array().cast(kind))
        return F.struct(F.size(r["p"]).alias("points"), F.get(r["p"], F.lit(0)).alias("first"), F.get(r["p"], F.size(r["p"]) - 1).alias("last"),
                        r["turn"].alias("turn"), steps.alias("steps"))

    def own(r: Column) -> Column:
        # a ring's own problem; the size of steps is the number of segments with a length
        return F.when(r["points"] < 4, 0.0).when(r["first"] != r["last"], 1.0).when(F.size(r["steps"]) < 3, 2.0)

    def cut(r: Column) -> Column:
        def segment(step: Column, n: Column) -> Column:
            s, t = step["s"], step["t"]
            forward = (s["x"] < t["x"]) | ((s["x"] == t["x"]) & (s["y"] < t["y"]))
            return F.struct(r["ring"].alias("ring"), n.alias("n"), F.size(r["steps"]).alias("count"), F.when(forward, s).otherwise(t).alias("a"),
                            F.when(forward, t).otherwise(s).alias("b"), s.alias("from"))
        return F.transform(r["steps"], segment)

    rings = F.transform(F.transform(F.arrays_zip(g["xs"].alias("xs"), g["ys"].alias("ys")), points), stepped)
    shapes = usable.select(F.col(key).alias("id"), (g["kind"] == "Polygon").alias("one"), geo.bounds(g).alias("e"), rings.alias("rings"))
    rings = F.transform("rings", lambda r, i: F.struct(i.alias("ring"), r["turn"].alias("turn"), own(r).alias("at"), r["steps"].alias("steps")))
    shapes = shapes.select("id", "one", "e", rings.alias("rings"))
    flawed = F.transform("rings", lambda r: F.struct(r["ring"].alias("ring"), F.coalesce(r["at"], F.when(F.abs(r["turn"]) <= 1e-18, 3.5)).alias("at")))
    shapes = stored(shapes.select(
        "id", "one", "e", F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r["steps"])).alias("steps"),
        F.filter(flawed, lambda r: r["at"].isNotNull()).alias("flawed"),
        F.flatten(F.transform(F.filter("rings", lambda r: r["at"].isNull()), cut)).alias("segments")), "shapes")
    few = F.size("segments") <= FEW_SEGMENTS
    every = shapes.select("id", F.explode("flawed").alias("f")).select("id", "f.ring", "f.at").unionByName(
        _within_rows(shapes.where(few))).unionByName(_by_cells(shapes.where(~few)))
    first = every.groupBy("id").agg(F.min(F.struct("ring", "at")).alias("f"))
    names = F.array(*[F.lit(n) for n in PROBLEMS])
    return first.select(F.col("id").alias(key), F.when(F.col("f.at") == 3.5, "no_area").otherwise(F.get(names, F.col("f.at").cast("int"))).alias("problem"))
