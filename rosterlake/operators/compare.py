"""Differences between two datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, kind, field, in_a, in_b): keys on one side only, and fields that differ (nulls are equal).

    One full outer join; rows with a null key are left out. Keys that repeat
    are compared with every row of the other side.
    """
    left = a.where(F.col(key).isNotNull()).select(F.col(key), F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("__a"))
    right = b.where(F.col(key).isNotNull()).select(F.col(key), F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("__b"))
    both = left.join(right, key, "full")
    one = lambda k, f, x, y: F.struct(F.lit(k).alias("kind"), F.lit(f).cast("string").alias("field"), x.cast("string").alias("in_a"), y.cast("string").alias("in_b"))
    none = F.lit(None)
    each = F.array(*[F.when(~F.col(f"__a.{f}").eqNullSafe(F.col(f"__b.{f}")), one("differs", f, F.col(f"__a.{f}"), F.col(f"__b.{f}"))) for f in fields])
    rows = F.when(F.col("__b").isNull(), F.array(one("only_a", None, none, none))).when(F.col("__a").isNull(), F.array(one("only_b", None, none, none))).otherwise(F.array_compact(each))
    return both.select(key, F.inline(rows))


def missing_keys(a: DataFrame, b: DataFrame, key: str, list_a: str, list_b: str) -> DataFrame:
    """(key, missing): what the list of ``a`` has and that of ``b`` hasn't, where there is any."""
    joined = a.select(key, F.col(list_a).alias("__a")).join(b.select(key, F.col(list_b).alias("__b")), key)
    return joined.select(key, F.array_sort(F.array_except("__a", "__b")).alias("missing")).where(F.size("missing") > 0)


def is_clean(*differences: DataFrame) -> bool:
    """Whether all of them are empty; each is asked for one row only."""
    return all(not d.take(1) for d in differences)


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): 'a', 'b' or 'both', in one aggregation."""
    tagged = a.select(key, F.lit(1).alias("s")).unionByName(b.select(key, F.lit(2).alias("s"))).where(F.col(key).isNotNull())
    side = F.bit_or("s")
    return tagged.groupBy(key).agg(F.when(side == 1, "a").when(side == 2, "b").otherwise("both").alias("side"))
