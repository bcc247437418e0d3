"""Map layers over coordinates derived from customers and suppliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import geo
from assaylake.operators import layers
from assaylake.operators.joins import overlapping_extents
from assaylake.operators.polygons import overlapping_polygons, polygon_problems
from assaylake.queries.registry import joined, query, sql_digest, sql_text, table
from assaylake.session import scratch_dir, spread
from assaylake.sinks import staging, versions

BOX = (116.9, 4.5, 126.7, 21.2)


def _lon(key: Column) -> Column:
    return (key * 37 % 1300) / 100.0 + 115.0


def _lat(key: Column) -> Column:
    return (key * 53 % 2000) / 100.0 + 3.0


LAYER = {
    "layer": "sites", "geometry_type": "Point", "allow_multi": False, "source_crs": "EPSG:4326", "target_crs": "EPSG:4326",
    "bbox": list(BOX), "unique_key": "site_id",
    "attributes": [{"name": "site_id", "required": True}, {"name": "site_name", "required": True},
                   {"name": "kind", "required": True, "permissible_values": ["BUILDING", "FURNITURE", "MACHINERY"]}],
    "thresholds": {"max_null_geom_pct": 5, "max_repaired_pct": 2},
}


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as point features; some without coordinates, name or key, some keys twice."""
    key = F.col("c_custkey")
    shape = F.when(key % 31 != 0, geo.point(_lon(key), _lat(key)))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 43 != 0, F.concat(F.lit("S"), key - key % 41 % 2)).otherwise(F.lit(" ")).alias("site_id"),
        F.when(key % 29 != 0, F.col("c_name")).otherwise("").alias("site_name"), F.col("c_mktsegment").alias("kind"), shape.alias("geom"))


_SITES = f"""
sites as (
  select case when c_custkey % 43 <> 0 then 'S' || (c_custkey - c_custkey % 41 % 2) else ' ' end as site_id,
         case when c_custkey % 29 <> 0 then c_name else '' end as site_name, c_mktsegment as kind, c_custkey % 31 = 0 as missing,
         (c_custkey * 37 % 1300) / 100.0::double + 115.0::double as lon, (c_custkey * 53 % 2000) / 100.0::double + 3.0::double as lat
  from customer),
judged as (
  select *, not missing and (lon < {BOX[0]}::double or lon > {BOX[2]}::double or lat < {BOX[1]}::double or lat > {BOX[3]}::double) as outside,
         trim(site_id) = '' as no_key, trim(site_id) <> '' and count(*) over (partition by site_id) > 1 as twice,
         trim(site_name) = '' as no_name, kind not in ('BUILDING', 'FURNITURE', 'MACHINERY') as bad_kind
  from sites)"""


@query("geo_layer_report", "with " + _SITES + """
select 'sites' as layer, count(*) as row_count, count(*) filter (where missing or outside or no_key or twice or no_name or bad_kind) as flagged_rows,
       round((1.0::double - count(*) filter (where missing or outside or no_key or twice or no_name or bad_kind)::double / count(*)) * 100, 1) as dqi_rows,
       cast(max(outside::int) + 2 * max(no_key::int) + max(twice::int) + max(no_name::int) + max(bad_kind::int) as bigint) as hard_failures, cast(0 as bigint) as soft_warnings
from judged""")
def geo_layer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a layer; missing shapes stay within their limit but lower the index."""
    summary, _ = layers.validate_layer(sites(spark, sf_dir), LAYER)
    return summary.select(F.col("dataset").alias("layer"), "row_count", "flagged_rows", "dqi_rows", "hard_failures", "soft_warnings")


def _rule_sql(rule: str, column: str, flag: str, severity: str = "hard", limit: str = "0") -> str:
    return f"""select '{rule}' as rule, '{column}' as "column", '{severity}' as severity, count(*) filter (where {flag}) as failed_count,
       cast(count(*) filter (where {flag}) * 100.0 / count(*) <= {limit} as bigint) as success,
       coalesce((select string_agg(site_id, ',' order by site_id) from (select site_id from judged where {flag} order by site_id limit 5)), '') as sample_ids from judged"""


@query("geo_rule_results", "with " + _SITES + " union all ".join([
    _rule_sql("not_empty", "*", "false"), _rule_sql("geometry_type", "geom", "false"), _rule_sql("null_or_empty_geometry", "geom", "missing", limit="5"),
    _rule_sql("invalid_geometries", "geom", "false", "soft"), _rule_sql("repair_threshold", "geom", "false"),
    _rule_sql("bbox", "geom", "outside"), _rule_sql("unique_key_present", "site_id", "no_key"), _rule_sql("unique_key_unique", "site_id", "twice"),
    _rule_sql("required_columns", "*", "false"), _rule_sql("required_values", "site_id", "no_key"), _rule_sql("required_values", "site_name", "no_name"),
    _rule_sql("required_values", "kind", "false"), _rule_sql("permissible_values", "kind", "bad_kind"), _rule_sql("unexpected_columns", "*", "false", "soft")]))
def geo_rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of a layer with counts and sample ids."""
    _, results = layers.validate_layer(sites(spark, sf_dir), LAYER)
    return results.select("rule", "column", "severity", "failed_count", F.col("success").cast("bigint").alias("success"), joined("sample_ids").alias("sample_ids"))


@query("empty_layer_report", """
with layers as (select c_mktsegment as kind, count(*) filter (where c_custkey % 31 <> 0 and c_mktsegment not in ('BUILDING', 'MACHINERY')) as n from customer group by 1)
select kind, n as row_count, cast(n > 0 as bigint) as passed, case when n = 0 then 'not_empty' end as failed_rule from layers""")
def empty_layer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layer for each segment; those that lose all their rows fail, and the rule that says so is named."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), key).alias("site_id"), F.col("c_name").alias("site_name"), F.lit("BUILDING").alias("kind"), F.col("c_mktsegment").alias("segment"),
        geo.point(F.lit(121.0), F.lit(14.0)).alias("geom"), (key % 31 != 0).alias("kept"))
    out = []
    for segment in [r["segment"] for r in rows.select("segment").distinct().collect()]:  # five of them, each a layer of its own
        own = rows.where((F.col("segment") == segment) & F.col("kept") & ~F.col("segment").isin("BUILDING", "MACHINERY")).drop("segment", "kept")
        report, results = layers.validate_layer(own, LAYER)
        named = results.filter((F.col("severity") == "hard") & ~F.col("success")).agg(F.max("rule")).scalar()
        out.append(report.select(F.lit(segment).alias("kind"), "row_count", F.col("hard_rule_pass").cast("bigint").alias("passed"), named.alias("failed_rule")))
    return reduce(DataFrame.unionByName, out)


@query("wkb_layer", """
select c_custkey, case when c_custkey % 4 < 3 then 'Point' end as kind, case when c_custkey % 4 < 3 then 2.0::double end as x,
       case when c_custkey % 4 < 3 then 0.5::double end as y from customer""")
def wkb_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as bytes built by expression: plain, ISO with height, ISO with height and measure, and bytes that are no shape."""
    kind = F.col("c_custkey") % 4
    head = F.when(kind == 0, "0101000000").when(kind == 1, "01E9030000").otherwise("01B90B0000")
    more = F.repeat(F.lit("0000000000000000"), F.when(kind == 0, 0).when(kind == 1, 1).otherwise(2))
    # 2.0 and 0.5, least byte first
    data = F.unhex(F.when(kind == 3, "01FF").otherwise(F.concat(head, F.lit("0000000000000040"), F.lit("000000000000E03F"), more)))
    g = geo.from_wkb(data)
    return table(spark, sf_dir, "customer").select("c_custkey", geo.wkb_kind(data).alias("kind"), g["xs"][0][0].alias("x"), g["ys"][0][0].alias("y"))


@query("geo_bbox_rules", f"""
with p as (select c_custkey, (c_custkey * 37 % 1300) / 100.0::double + 115.0::double as lon, (c_custkey * 53 % 2000) / 100.0::double + 3.0::double as lat from customer)
select c_custkey, lon, lat, cast(lon < {BOX[0]}::double or lon > {BOX[2]}::double or lat < {BOX[1]}::double or lat > {BOX[3]}::double as bigint) as outside,
       cast(lat < {BOX[0]}::double or lat > {BOX[2]}::double or lon < {BOX[1]}::double or lon > {BOX[3]}::double as bigint) as outside_if_swapped from p""")
def geo_bbox_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", geo.point(_lon(key), _lat(key)).alias("g"), geo.point(_lat(key), _lon(key)).alias("swapped"))
    extent = geo.bounds(F.col("g"))
    return rows.select("c_custkey", extent["xmin"].alias("lon"), extent["ymax"].alias("lat"),
                       geo.outside(extent, BOX).cast("bigint").alias("outside"),
                       geo.outside(geo.bounds(F.col("swapped")), BOX).cast("bigint").alias("outside_if_swapped"))


@query("geo_reproject", """
with p as (select c_custkey, (c_custkey * 37 % 1300) / 100.0::double + 115.0::double as lon, (c_custkey * 53 % 2000) / 100.0::double + 3.0::double as lat from customer)
select c_custkey, round(radians(lon) * 6378137.0, 3) as x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 3) as y, round(lon, 6) as back_lon, round(lat, 6) as back_lat,
       round(lon, 1) as coarse_lon from p""")
def geo_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To web mercator and back, and a longitude made coarse."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", _lon(key).alias("lon"), _lat(key).alias("lat"))
    x, y = geo.reprojected(F.col("lon"), F.col("lat"), 4326, 3857)
    rows = rows.withColumns({"x": x, "y": y})
    back_lon, back_lat = geo.reprojected(F.col("x"), F.col("y"), 3857, 4326)
    return rows.select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(back_lon, 6).alias("back_lon"),
                       F.round(back_lat, 6).alias("back_lat"), geo.coarsened(F.col("lon"), 1).alias("coarse_lon"))


def _rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    x, y = (key * 7919 % 9973) / 8.0, (key * 104729 % 9967) / 8.0
    return table(spark, sf_dir, "customer").select("c_custkey", x.alias("xmin"), y.alias("ymin"), (x + (key % 40 + 1) / 4.0).alias("xmax"),
                                                   (y + (key % 23 + 1) / 2.0).alias("ymax"))


_RECTANGLES = """
r as (select c_custkey, (c_custkey * 7919 % 9973) / 8.0::double as xmin, (c_custkey * 104729 % 9967) / 8.0::double as ymin,
      (c_custkey * 7919 % 9973) / 8.0::double + (c_custkey % 40 + 1) / 4.0::double as xmax, (c_custkey * 104729 % 9967) / 8.0::double + (c_custkey % 23 + 1) / 2.0::double as ymax from customer)"""


@query("overlapping_extents", "with " + _RECTANGLES + """
select c_custkey, xmin, ymax from r a where exists (
  select 1 from r b where a.c_custkey <> b.c_custkey and a.xmin < b.xmax and b.xmin < a.xmax and a.ymin < b.ymax and b.ymin < a.ymax)""")
def overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles that share area with another one."""
    return overlapping_extents(_rectangles(spark, sf_dir)).select("c_custkey", "xmin", "ymax")


_POLYGONS = """
s as (select c_custkey as k, c_custkey % 3 as kind, (c_custkey * 7919 % 4999) / 8.0::double as x, (c_custkey * 104729 % 4993) / 8.0::double as y, (c_custkey % 29 + 2) / 1.0::double as s from customer),
p as (select *, x + y + s as c, x + s / 4 as hx, y + s / 4 as hy, s / 2 as hs from s),
pairs as (select a.k, case
    when a.kind = 0 and b.kind = 0 then greatest(a.x, b.x) + greatest(a.y, b.y) < least(a.c, b.c)
    when a.kind = 1 and b.kind = 1 then least(a.x + a.s, b.x + b.s) + least(a.y + a.s, b.y + b.s) > greatest(a.c, b.c)
    when a.kind = 0 and b.kind = 1 then a.x < b.x + b.s and a.y < b.y + b.s and b.c < a.c and greatest(b.c, a.x + a.y) < least(a.c, b.x + b.y + 2 * b.s)
    when a.kind = 1 and b.kind = 0 then b.x < a.x + a.s and b.y < a.y + a.s and a.c < b.c and greatest(a.c, b.x + b.y) < least(b.c, a.x + a.y + 2 * a.s)
    when a.kind = 2 and b.kind = 0 then greatest(a.x, b.x) < a.x + a.s and greatest(a.y, b.y) < a.y + a.s and greatest(a.x, b.x) + greatest(a.y, b.y) < b.c and not b_in_a
    when a.kind = 0 and b.kind = 2 then greatest(a.x, b.x) < b.x + b.s and greatest(a.y, b.y) < b.y + b.s and greatest(a.x, b.x) + greatest(a.y, b.y) < a.c and not a_in_b
    when a.kind = 2 and b.kind = 1 then least(a.x + a.s, b.x + b.s) > a.x and least(a.y + a.s, b.y + b.s) > a.y and least(a.x + a.s, b.x + b.s) + least(a.y + a.s, b.y + b.s) > b.c and not b_in_a
    when a.kind = 1 and b.kind = 2 then least(a.x + a.s, b.x + b.s) > b.x and least(a.y + a.s, b.y + b.s) > b.y and least(a.x + a.s, b.x + b.s) + least(a.y + a.s, b.y + b.s) > a.c and not a_in_b
    else not a_in_b and not b_in_a end as shared
  from (select a, b, a.x >= b.hx and a.x + a.s <= b.hx + b.hs and a.y >= b.hy and a.y + a.s <= b.hy + b.hs as a_in_b,
               b.x >= a.hx and b.x + b.s <= a.hx + a.hs and b.y >= a.hy and b.y + b.s <= a.hy + a.hs as b_in_a
        from p a join p b on a.k <> b.k and a.x < b.x + b.s and b.x < a.x + a.s and a.y < b.y + b.s and b.y < a.y + a.s))"""


def _polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower and upper halves of squares, and frames: shapes whose rectangles meet more often than they do."""
    key = F.col("c_custkey")
    x, y, s = (key * 7919 % 4999) / 8.0, (key * 104729 % 4993) / 8.0, (key % 29 + 2) / F.lit(1.0)

    def ring(*points: tuple[float, float]) -> tuple[Column, Column]:
        return F.array(*[x + s * px for px, _ in points]), F.array(*[y + s * py for _, py in points])

    lower, upper = ring((0, 0), (1, 0), (0, 1), (0, 0)), ring((1, 0), (0, 1), (1, 1), (1, 0))
    frame, hole = ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)), ring((.25, .25), (.75, .25), (.75, .75), (.25, .75), (.25, .25))
    parts = [F.when(key % 3 == 0, F.array(lower[i])).when(key % 3 == 1, F.array(upper[i])).otherwise(F.array(frame[i], hole[i])) for i in (0, 1)]
    shape = F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), parts[0].alias("xs"), parts[1].alias("ys"))
    return table(spark, sf_dir, "customer").select("c_custkey", shape.alias("geom"))


@query("overlapping_polygons", "with " + _POLYGONS + " select distinct k as c_custkey from pairs where shared")
def overlapping_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles and frames that share area with another one; many share only their rectangles, borders or a hole."""
    return overlapping_polygons(_polygons(spark, sf_dir), "c_custkey")


def _made_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares, bow-ties, squares with a vertex twice, slivers, and squares whose hole crosses the shell or lies beside it."""
    case = F.col("c_custkey") % 6
    x0 = (F.col("c_custkey") % 64).cast("double")

    def ring(*points: tuple[float, float]) -> tuple[Column, Column]:
        return F.array(*[x0 + px for px, _ in points]), F.array(*[F.lit(float(py)) for _, py in points])

    square = ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    shapes = [[square], [((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))], [((0, 0), (2, 0), (2, 0), (2, 2), (0, 2), (0, 0))],
              [((0, 0), (2, 0), (2, 0.001), (0, 0.001), (0, 0))], [square, ((1, 0.5), (1, 1.5), (3, 1.5), (3, 0.5), (1, 0.5))],
              [square, ((5, 0), (5, 1), (6, 1), (6, 0), (5, 0))]]
    parts = [[F.array(*[ring(*r)[axis] for r in rings]) for axis in (0, 1)] for rings in shapes]
    xs, ys = parts[5]
    for i in range(4, -1, -1):
        xs, ys = F.when(case == i, parts[i][0]).otherwise(xs), F.when(case == i, parts[i][1]).otherwise(ys)
    shape = F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), xs.alias("xs"), ys.alias("ys"))
    return spread(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", shape.alias("geom"))


@query("geo_polygon_rules", """
select c_custkey, case c_custkey % 6 when 1 then 'self_crossing' when 4 then 'rings_cross' when 5 then 'hole_outside' end as problem,
       cast(c_custkey % 6 = 2 as bigint) as repeated, cast(c_custkey % 6 = 3 as bigint) as sliver,
       case c_custkey % 6 when 0 then 4.0::double when 1 then 0.0::double when 2 then 4.0::double when 3 then 0.002::double when 4 then 2.0::double else 3.0::double end as area
from customer""")
def geo_polygon_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems, repeated vertices, slivers and areas of made shapes."""
    rows, g = _made_shapes(spark, sf_dir), F.col("geom")
    return rows.join(polygon_problems(rows, "c_custkey"), "c_custkey", "left").select(
        "c_custkey", "problem", geo.repeated_vertices(g).cast("bigint").alias("repeated"),
        geo.is_sliver(g).cast("bigint").alias("sliver"), F.round(geo.area(g), 6).alias("area"))


@query("polygon_layer_results", """
with bad as (select count(*) as rows_, count(*) filter (where c_custkey % 6 in (1, 4, 5)) as n from customer)
select rule, severity, case when rule = 'geometry_type' then 0 else n end as failed_count,
       cast(case rule when 'geometry_type' then true when 'repair_threshold' then n * 100.0 / rows_ <= 51 else n = 0 end as bigint) as success
from bad, (select unnest(['geometry_type', 'invalid_geometries', 'repair_threshold']) as rule, unnest(['hard', 'soft', 'hard']) as severity)""")
def polygon_layer_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of polygons: invalid ones are flagged and stay within the share that may be repaired."""
    config = {**LAYER, "layer": "shapes", "geometry_type": "Polygon", "unique_key": "c_custkey", "attributes": [], "thresholds": {"max_repaired_pct": 51}}
    _, results = layers.validate_layer(_made_shapes(spark, sf_dir), config)
    return results.where(F.col("rule").isin("geometry_type", "invalid_geometries", "repair_threshold")).select(
        "rule", "severity", "failed_count", F.col("success").cast("bigint").alias("success"))


@query("geo_from_wkt", """
select c_custkey, round((c_custkey * 37 % 1300) / 100.0::double + 115.0::double, 6) as lon, round((c_custkey * 53 % 2000) / 100.0::double + 3.0::double, 6) as lat from customer where c_custkey % 5 <> 0
union all select c_custkey, null, null from customer where c_custkey % 5 = 0""")
def geo_from_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written as text and read back; anything else is no shape."""
    key = F.col("c_custkey")
    plain = F.concat_ws(" ", _lon(key), _lat(key))
    text = F.when(key % 5 == 0, "LINESTRING (0 0, 1 1)").when(key % 5 == 1, F.concat(F.lit("POINT ("), plain, F.lit(")"))).when(
        key % 5 == 2, F.concat(F.lit("point Z( +"), plain, F.lit(" 1e2)"))).otherwise(
        F.concat(F.lit("POINT ("), _lon(key) * 10, F.lit("e-1 "), _lat(key), F.lit(")")))
    g = geo.point_from_wkt(text)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(g["xs"][0][0], 6).alias("lon"), F.round(g["ys"][0][0], 6).alias("lat"))


@query("serving_view", """
select 'S' || c_custkey as site_id, c_mktsegment as kind from customer""")
def serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns a layer exposes."""
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("S"), F.col("c_custkey")).alias("site_id"), F.col("c_mktsegment").alias("kind"), "c_name", "c_acctbal")
    return versions.serving_view(rows, ["site_id", "kind"], ["c_name"])


@query("geo_archive_box", """
with p as (select c_custkey, (c_custkey * 37 % 1300) / 100.0::double + 115.0::double as lon, (c_custkey * 53 % 2000) / 100.0::double + 3.0::double as lat from customer)
select c_custkey from p where lon between 118 and 121 and lat between 10 and 14""")
def geo_archive_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archived batch read back by box; the extents skip row groups."""
    from assaylake.sources.tables import archived_layer

    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", geo.point(_lon(key), _lat(key)).alias("geom"))
    path = versions.archive_layer(rows, scratch_dir(spark, "archive"), "sites", "007")
    return versions.inside_box(archived_layer(spark, path, "sites", "007"), (118.0, 10.0, 121.0, 14.0)).select("c_custkey")


_SITE_TEXT = sql_text("site_id", "site_name", "kind", "case when not missing then 'Point' end", "case when not missing then '[[' || lon || ']]' end", "case when not missing then '[[' || lat || ']]' end")


@query("layer_manifest", "with " + _SITES + f"""
select 'sites' as layer, 'run-1' as run_id, count(*) as feature_count, 'Point' as geometry_types, 'site_id,site_name,kind' as columns,
       {sql_digest(_SITE_TEXT)} as sha256, cast(sum(strlen({_SITE_TEXT})) as bigint) as content_bytes from sites""")
def layer_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, kinds, columns, digest and bytes of a layer; the digest is the same however the rows are dealt out."""
    out = staging.layer_manifest(sites(spark, sf_dir).repartition(5, "site_name"), "sites", "run-1")
    return out.select("layer", "run_id", "feature_count", joined("geometry_types").alias("geometry_types"), joined("columns").alias("columns"), "sha256", "content_bytes")


@query("layer_aliases", """
select 'C' || c_custkey as facility_id, c_name as name, c_mktsegment as facility_type, (c_custkey * 37 % 1300) / 100.0::double + 115.0::double as lon from customer""")
def layer_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer whose columns come under other names, in any case."""
    from assaylake.sources.tables import read_layer

    key = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), key).alias("FACITY_ID"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("Facility_T"), _lon(key).alias("x"), _lat(key).alias("y"))
    out = read_layer(raw, {**LAYER, "field_aliases": {"facity_Id": "facility_id", "facility_t": "facility_type"}}, lon_lat=("x", "y"))
    return out.select("facility_id", "name", "facility_type", F.col("geom.xs")[0][0].alias("lon"))
