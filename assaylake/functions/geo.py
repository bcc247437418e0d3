"""Shapes: points, lines and polygons without a geometry library.

A shape is ``struct<kind, srid, xs array<array<double>>, ys array<array<double>>>``: one inner array per
part or ring. Points given as longitude and latitude stay pure expressions; only WKB bytes and the
self-crossing test need a small vectorised helper.
"""

from __future__ import annotations

import math
import struct
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the two helpers below travel with the query, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")

_PARTS = T.ArrayType(T.ArrayType(T.DoubleType()))
SHAPE_TYPE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("xs", _PARTS),
    T.StructField("ys", _PARTS),
])


def point(lon: Column, lat: Column, srid: int = 4326) -> Column:
    """A point shape; null where a coordinate is missing."""
    shape = F.struct(
        F.lit("Point").alias("kind"), F.lit(srid).alias("srid"),
        F.array(F.array(lon)).alias("xs"), F.array(F.array(lat)).alias("ys"),
    )
    return F.when(lon.isNotNull() & lat.isNotNull(), shape)


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column, srid: int = 4326) -> Column:
    """An axis-aligned rectangle as a polygon shape."""
    return F.struct(
        F.lit("Polygon").alias("kind"), F.lit(srid).alias("srid"),
        F.array(F.array(xmin, xmax, xmax, xmin, xmin)).alias("xs"),
        F.array(F.array(ymin, ymin, ymax, ymax, ymin)).alias("ys"),
    )


def point_from_wkt(wkt: Column, srid: int = 4326) -> Column:
    """``POINT (x y)`` text as a point shape; heights and measures (``POINT Z``, ``M``, ``ZM``) are left out."""
    number = r"([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)"
    more = r"(?:\s+[^\s()]+){0,2}"
    pattern = rf"(?i)^\s*POINT\s*(?:ZM|Z|M)?\s*\(\s*{number}\s+{number}{more}\s*\)\s*$"
    return point(F.regexp_extract(wkt, pattern, 1).try_cast("double"),
                 F.regexp_extract(wkt, pattern, 2).try_cast("double"), srid)


def wkb_kind(wkb: Column) -> Column:
    """Geometry kind from the WKB header alone."""
    order = F.hex(F.substring(wkb, 1, 1))
    # the two low bytes hold the kind, with the thousands of ISO heights and measures
    little = F.concat(F.hex(F.substring(wkb, 3, 1)), F.hex(F.substring(wkb, 2, 1)))
    big = F.hex(F.substring(wkb, 4, 2))
    code = F.conv(F.when(order == "01", little).otherwise(big), 16, 10).cast("int") % 1000
    return F.get(F.array(*[F.lit(k) for k in KINDS]), code - 1)  # null for codes without a kind


def _read_wkb(data: bytes, at: int = 0) -> tuple[str, int | None, list, list, int]:
    end = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(end + "I", data, at + 1)
    at += 5
    srid = None
    if code & 0x20000000:
        (srid,) = struct.unpack_from(end + "I", data, at)
        at += 4
    # flags of EWKB, or thousands of ISO WKB: 1 for heights, 2 for measures, 3 for both
    iso, number = divmod(code & 0xFFFF, 1000)
    dims = 2 + bool(code & 0x80000000 or iso in (1, 3)) + bool(code & 0x40000000 or iso in (2, 3))
    if iso > 3 or not 1 <= number <= len(KINDS):
        raise ValueError(f"unknown geometry code {code}")
    kind = KINDS[number - 1]
    xs: list = []
    ys: list = []

    def run(count: int, at: int) -> int:
        block = np.frombuffer(data, dtype=end + "f8", count=count * dims, offset=at).reshape(count, dims)
        if count and not np.isnan(block[:, :2]).any():
            xs.append(block[:, 0].tolist())
            ys.append(block[:, 1].tolist())
        return at + count * dims * 8

    if kind == "Point":
        at = run(1, at)
    else:
        (count,) = struct.unpack_from(end + "I", data, at)
        at += 4
        if kind == "LineString":
            at = run(count, at)
        elif kind == "Polygon":
            for _ in range(count):
                (size,) = struct.unpack_from(end + "I", data, at)
                at = run(size, at + 4)
        else:
            for _ in range(count):
                _, _, x, y, at = _read_wkb(data, at)
                xs.extend(x)
                ys.extend(y)
    return kind, srid, xs, ys, at


def from_wkb(wkb: Column, srid: int = 4326) -> Column:
    """WKB or EWKB bytes as a shape; unreadable bytes give null."""

    @F.pandas_udf(SHAPE_TYPE)
    def parse(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for data in batch:
            try:
                kind, own, xs, ys, _ = _read_wkb(bytes(data))
                rows.append((kind, own or srid, xs, ys))
            except (TypeError, struct.error, IndexError, ValueError):
                rows.append((None, None, None, None))
        return pd.DataFrame(rows, columns=["kind", "srid", "xs", "ys"])

    parsed = parse(wkb)
    return F.when(parsed["kind"].isNotNull(), parsed)


def point_wkb(lon: float, lat: float) -> bytes:
    """WKB of a point, for writers and tests."""
    return struct.pack("<BIdd", 1, 1, lon, lat)


def polygon_wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    """WKB of a polygon, for writers and tests."""
    body = b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)
    return struct.pack("<BII", 1, 3, len(rings)) + body


def is_missing(shape: Column) -> Column:
    """True where the shape is null or has no coordinates."""
    return shape.isNull() | (F.coalesce(F.size(F.flatten(shape["xs"])), F.lit(0)) <= 0)


def bounds(shape: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>``; null for an empty shape."""
    xs, ys = F.flatten(shape["xs"]), F.flatten(shape["ys"])
    return F.when(~is_missing(shape), F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")))


def outside(extent: Column, limits: tuple[float, float, float, float]) -> Column:
    """True where an extent leaves the limits ``(xmin, ymin, xmax, ymax)``. Null extents are not outside."""
    xmin, ymin, xmax, ymax = limits
    return F.coalesce((extent["xmin"] < xmin) | (extent["xmax"] > xmax)
                      | (extent["ymin"] < ymin) | (extent["ymax"] > ymax), F.lit(False))


def _ring_problem(x: np.ndarray, y: np.ndarray) -> str | None:
    if len(x) < 4:
        return "too_few_points"
    if x[0] != x[-1] or y[0] != y[-1]:
        return "ring_not_closed"
    ax, ay, bx, by = x[:-1], y[:-1], x[1:], y[1:]
    moved = (ax != bx) | (ay != by)
    ax, ay, bx, by = ax[moved], ay[moved], bx[moved], by[moved]
    n = len(ax)
    if n < 3:
        return "no_area"
    low, high = np.minimum(ax, bx), np.maximum(ax, bx)
    order = np.argsort(low, kind="stable")
    reach = np.searchsorted(low[order], high[order], side="right")

    def side(i, px, py):
        return np.sign((bx[i] - ax[i]) * (py - ay[i]) - (by[i] - ay[i]) * (px - ax[i]))

    # sweep along x: only segments whose x ranges meet can cross
    for rank in range(n):
        i = order[rank]
        near = order[rank + 1:reach[rank]]
        near = near[(np.abs(near - i) != 1) & (np.abs(near - i) != n - 1)]
        if not len(near):
            continue
        d1, d2 = side(i, ax[near], ay[near]), side(i, bx[near], by[near])
        d3 = np.sign((bx[near] - ax[near]) * (ay[i] - ay[near]) - (by[near] - ay[near]) * (ax[i] - ax[near]))
        d4 = np.sign((bx[near] - ax[near]) * (by[i] - ay[near]) - (by[near] - ay[near]) * (bx[i] - ax[near]))
        y_meets = (np.minimum(ay[near], by[near]) <= max(ay[i], by[i])) \
            & (np.maximum(ay[near], by[near]) >= min(ay[i], by[i]))
        if (y_meets & (d1 * d2 <= 0) & (d3 * d4 <= 0)).any():
            return "self_crossing"
    if math.isclose(float(np.sum(ax * by - bx * ay)), 0.0, abs_tol=1e-18):
        return "no_area"
    return None


def shape_problem(shape: Column) -> Column:
    """Why a polygon is not valid, or null. Other kinds are valid once they have coordinates."""

    @F.pandas_udf("string")
    def check(kind: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for k, px, py in zip(kind, xs, ys):
            problem = None
            if k in ("Polygon", "MultiPolygon") and px is not None:
                for x, y in zip(px, py):
                    problem = _ring_problem(np.asarray(x, dtype=float), np.asarray(y, dtype=float))
                    if problem:
                        break
            out.append(problem)
        return pd.Series(out, dtype=object)

    return check(shape["kind"], shape["xs"], shape["ys"])


def repeated_vertices(shape: Column) -> Column:
    """True where a part repeats a vertex, beyond a ring closing on its start."""
    def part(xs: Column, ys: Column) -> Column:
        pairs = F.arrays_zip(xs.alias("x"), ys.alias("y"))
        closed = F.when((F.element_at(xs, 1) == F.element_at(xs, -1))
                        & (F.element_at(ys, 1) == F.element_at(ys, -1)) & (F.size(xs) > 1), 1).otherwise(0)
        return F.size(F.array_distinct(pairs)) < F.size(pairs) - closed

    flags = F.zip_with(shape["xs"], shape["ys"], part)
    return F.coalesce(F.exists(flags, lambda f: f), F.lit(False))


def _walk(shape: Column, term) -> Column:
    """Sum a term over the segments of every part."""
    def part(xs: Column, ys: Column) -> Column:
        steps = F.sequence(F.lit(2), F.size(xs))
        total = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + term(xs, ys, i))
        return F.when(F.size(xs) > 1, total).otherwise(F.lit(0.0))

    return F.aggregate(F.zip_with(shape["xs"], shape["ys"], part), F.lit(0.0), lambda a, v: a + v)


def perimeter(shape: Column) -> Column:
    return _walk(shape, lambda x, y, i: F.sqrt(
        F.pow(F.element_at(x, i) - F.element_at(x, i - 1), 2)
        + F.pow(F.element_at(y, i) - F.element_at(y, i - 1), 2)))


def area(shape: Column) -> Column:
    """Shoelace area; holes count with their own orientation."""
    return F.abs(_walk(shape, lambda x, y, i:
                       F.element_at(x, i - 1) * F.element_at(y, i)
                       - F.element_at(x, i) * F.element_at(y, i - 1))) / 2


def is_sliver(shape: Column, ratio: float = 0.01) -> Column:
    """True for a polygon whose area is tiny against its squared perimeter. No area at all is a
    problem of its own."""
    around, inside = perimeter(shape), area(shape)
    return F.coalesce(shape["kind"].isin("Polygon", "MultiPolygon") & (inside > 0)
                      & (inside / (around * around) < ratio), F.lit(False))


EARTH_RADIUS = 6378137.0


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 to EPSG:3857."""
    return (F.radians(lon) * EARTH_RADIUS,
            F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH_RADIUS)


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 to EPSG:4326."""
    return (F.degrees(x / EARTH_RADIUS),
            F.degrees(F.atan(F.exp(y / EARTH_RADIUS)) * 2 - F.lit(math.pi / 2)))


def reprojected(lon: Column, lat: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates in the target system. Only the two closed-form systems are known."""
    if source == target:
        return lon, lat
    if (source, target) == (4326, 3857):
        return to_mercator(lon, lat)
    if (source, target) == (3857, 4326):
        return from_mercator(lon, lat)
    raise ValueError(f"no closed form for EPSG:{source} to EPSG:{target}")


def coarsened(c: Column, digits: int = 2) -> Column:
    """A coordinate rounded so that it names an area, not a household."""
    return F.round(c, digits)
