"""Latest row per key and repeated keys, without gathering a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest ``order``, nulls lowest, then the highest tie-breaker.

    Spark turns the rank filter into a top-1 per key before the shuffle, so each map task sends one
    row per key however often the key occurs. Without tie-breakers a hash of the row decides.
    """
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [F.col(c).desc_nulls_last() for c in ties] or [F.xxhash64(*[F.col(c) for c in df.columns]).desc()]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def first_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of every group; limited per map task before the shuffle, as above."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, keys with a null or blank part left out. Counted before the shuffle."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("copies"))


_HOT_SHARE = 1000  # a key with more than one row in a thousand is hot, so there are under a thousand
_SALTS = 64


def _splits_skew(df: DataFrame) -> bool:
    """Whether Spark itself splits a hot partition of a join at run time."""
    conf = df.sparkSession.conf
    return all(conf.get(f"spark.sql.adaptive.{name}", "false") == "true" for name in ("enabled", "skewJoin.enabled"))


def with_copies(df: DataFrame, keys: Sequence[str], into: str = "_copies") -> DataFrame:
    """Every row with the number of rows that share its key; 0 for rows without a key.

    The counted side has one row per repeated key, so a hot key is heavy on the row side only.
    Adaptive execution splits it there; where that is switched off, keys that hold more than a
    thousandth of the rows are salted. Rows without a key match nothing and are always spread.
    """
    counts = key_counts(df, keys)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = counts.filter(F.col("copies") > 1)
    if _splits_skew(df):
        repeated, settled = repeated.withColumn("_ks", F.lit(0)), keyed
    else:
        total = counts.agg(F.sum("copies")).scalar()
        hot = counts.filter(F.col("copies") * _HOT_SHARE > total).agg(F.collect_set(F.xxhash64(*keys)).alias("hot")).scalar()
        is_hot = F.array_contains(hot, F.xxhash64(*keys))
        every = F.array(*[F.lit(i) for i in range(_SALTS)])
        repeated = repeated.withColumn("_h", is_hot)
        repeated = repeated.withColumn("_ks", F.explode(F.when(F.col("_h"), every).otherwise(F.array(F.lit(0)))))
        settled = keyed & ~is_hot
    repeated = repeated.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_ks", F.col("copies").alias(into))

    # the partition number keeps equal rows apart; both parts are the same when a task is run again
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id()), F.lit(_SALTS)).cast("int")
    salted = df.withColumn("_salt", F.when(settled, F.lit(0)).otherwise(spread))
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_salt") == F.col("_ks")]
    joined = salted.join(repeated, reduce(lambda a, b: a & b, on), "left")
    return joined.select(*df.columns, F.coalesce(into, F.when(keyed, F.lit(1)).otherwise(F.lit(0))).alias(into))


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All copies of rows whose key occurs more than once."""
    return with_copies(df, keys).filter(F.col("_copies") > 1)
