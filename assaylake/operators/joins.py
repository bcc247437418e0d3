"""Joins of the engine: shared-key table joins, lookups and overlapping extents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.operators.canonical import ColumnMismatch


def join_tables(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Left joins of every further table onto the first, on one shared key."""
    out = frames[0]
    for frame in frames[1:]:
        clash = sorted((set(out.columns) & set(frame.columns)) - {key})
        if clash:
            raise ColumnMismatch(f"columns in more than one table: {clash}")
        out = out.join(frame, key, "left")
    return out


def with_lookup(df: DataFrame, dim: DataFrame, left: str, right: str, value: str, into: str) -> DataFrame:
    """A name looked up by code; unknown codes give null.

    No broadcast is forced: Spark broadcasts the lookup when its size is known to be small.
    """
    names = dim.select(F.col(right).alias("_code"), F.col(value).alias(into))
    return df.join(names, F.col(left) == F.col("_code"), "left").drop("_code")


def round_trip_mismatches(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys whose values differ between two sides or exist on one side only; ``left`` and ``right`` are the largest.

    Rows and nulls are counted too, and values are summed up by hash: a null against no row, or two values against
    one, are differences. Both sides are stacked and grouped, which needs one shuffle and no outer join.
    """
    sides = [side.select(*keys, F.col(value).alias("_v"), F.lit(i).alias("_side"))
             for i, side in enumerate((left, right))]
    def only(side: int, c: Column) -> Column:
        return F.when(F.col("_side") == side, c)

    digest = F.xxhash64("_v").cast("decimal(38,0)")
    grouped = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        *[F.max(only(i, F.col("_v"))).alias(n) for i, n in enumerate(("left", "right"))],
        *[F.struct(F.count(only(i, F.lit(1))), F.count(only(i, F.col("_v"))), F.sum(only(i, digest))).alias(f"_{i}") for i in (0, 1)])
    same = F.col("left").eqNullSafe(F.col("right")) & F.col("_0").eqNullSafe(F.col("_1"))
    return grouped.filter(~same).drop("_0", "_1")


def _cell_range(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size).cast("bigint"), F.floor(high / size).cast("bigint"))


def _cells(boxes: DataFrame, size: Column) -> DataFrame:
    xs = boxes.select("*", F.explode(_cell_range(F.col("xmin"), F.col("xmax"), size)).alias("cx"))
    return xs.select("*", F.explode(_cell_range(F.col("ymin"), F.col("ymax"), size)).alias("cy"))


def cells_of(shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placed, seekers) of distinct rectangles, with a level ``at`` and a cell ``cx``, ``cy``.

    Cell sizes double per level. A rectangle is placed in the finest level whose cell is as large as itself, so in four cells at
    most, and looks for partners in its own level and in coarser ones.
    """
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    shapes = shapes.withColumn("own", F.ceil(F.log2(F.greatest(side, F.lit(2.0 ** -20)))).cast("int"))
    # the levels in use are a few dozen whole numbers at most, whatever the number of rows
    in_use = shapes.groupBy("own").agg(F.count("*").alias("n")).agg(F.collect_list("own").alias("l")).scalar()
    placed = _cells(shapes.withColumn("at", F.col("own")), F.pow(F.lit(2.0), F.col("at")))
    seekers = shapes.withColumn("levels", in_use).withColumn(
        "at", F.explode(F.array_intersect(F.sequence("own", F.array_max("levels")), "levels"))).drop("levels")
    return placed, _cells(seekers, F.pow(F.lit(2.0), F.col("at")))


def _meets(a: str, b: str) -> Column:
    """Same grid cell and a shared area."""
    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    return (
        (c(a, "at") == c(b, "at")) & (c(a, "cx") == c(b, "cx")) & (c(a, "cy") == c(b, "cy"))
        & (c(a, "xmin") < c(b, "xmax")) & (c(b, "xmin") < c(a, "xmax"))
        & (c(a, "ymin") < c(b, "ymax")) & (c(b, "ymin") < c(a, "ymax"))
        & ~((c(a, "xmin") == c(b, "xmin")) & (c(a, "xmax") == c(b, "xmax"))
            & (c(a, "ymin") == c(b, "ymin")) & (c(a, "ymax") == c(b, "ymax")))
    )


EXTENT = ("xmin", "ymin", "xmax", "ymax")
_SALTS = 8


def overlapping_extents(df: DataFrame, extent: Sequence[str] = EXTENT) -> DataFrame:
    """Rows whose rectangle shares area with another row's, each once. Columns stay as they are.

    Rectangles meet in the grids of ``cells_of``. Equal rectangles are settled by counting, so a heap of copies
    is never compared. The rest are semi joins: they stop at the first partner and list no pairs.
    """
    boxes = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(extent, EXTENT)])
    shapes = boxes.dropna().groupBy(*EXTENT).agg(F.count("*").alias("copies"))
    placed, seekers = cells_of(shapes)

    finer = seekers.alias("a").join(placed.alias("b"), _meets("a", "b"), "left_semi")
    # the coarser partner of a pair; a crowded cell's finer rectangles are spread over salts
    salted = finer.withColumn("salt", F.pmod(F.xxhash64(*EXTENT), F.lit(_SALTS)).cast("int"))
    copies = placed.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])))
    coarser = copies.alias("a").join(
        salted.alias("b"), _meets("a", "b") & (F.col("a.salt") == F.col("b.salt")), "left_semi")
    heaps = shapes.filter((F.col("copies") > 1) & (F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax")))
    hit = finer.select(*EXTENT).union(coarser.select(*EXTENT)).union(heaps.select(*EXTENT)).distinct()
    hit = hit.select(*[F.col(c).alias(f"_{c}") for c in EXTENT])
    same = reduce(lambda a, b: a & b, [F.col(c).cast("double") == F.col(f"_{n}") for c, n in zip(extent, EXTENT)])
    return df.join(hit, same, "left_semi")
