"""Choosing the main one among several, the same whatever the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def primary_by_count(rows: DataFrame, owner: str, choice: str) -> DataFrame:
    """(owner, primary, times, choices): the choice that occurs most, ties to the smallest; null choices don't count.

    Two aggregations that are both combined map-side; no owner's rows are gathered.
    """
    counts = rows.where(F.col(choice).isNotNull()).groupBy(owner, choice).agg(F.count("*").alias("__n"))
    return counts.groupBy(owner).agg(F.min_by(choice, F.struct(-F.col("__n"), F.col(choice))).alias("primary"), F.max("__n").alias("times"), F.count("*").alias("choices"))


def first_holding(rows: DataFrame, owner: str, row_id: str, holds: Column) -> DataFrame:
    """(owner, row_id): the smallest row that ``holds``, else the smallest row."""
    return rows.groupBy(owner).agg(F.min_by(row_id, F.struct((~F.coalesce(holds, F.lit(False))).alias("x"), F.col(row_id))).alias(row_id))


def primary_first(rows: DataFrame, owner: str, is_primary: Column, order: str) -> DataFrame:
    """``rows`` with ``rank``: the primary one first, then by ``order``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(owner).orderBy((~F.coalesce(is_primary, F.lit(False))).cast("int"), order)))


def any_true(c: Column) -> Column:
    """True if any is true, else false if any is false, else NULL."""
    return F.bool_or(c)


def site_count(ids: Column) -> Column:
    """Number of distinct ids of an array, at least 1."""
    return F.greatest(F.lit(1), F.size(F.array_distinct(F.array_compact(F.coalesce(ids, F.array().cast("array<string>"))))))


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the one that is last in ``order``."""
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order)).alias("__r"))
    return best.select(*keys, "__r.*")


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the one that is first in ``order``."""
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order)).alias("__r"))
    return best.select(*keys, "__r.*")


def failure_runs(rows: DataFrame, owner: str, order: list[str], failed: Column, least: int) -> DataFrame:
    """(owner, run, failures): islands of at least ``least`` failures in a row."""
    w = Window.partitionBy(owner).orderBy(*order)
    marked = rows.withColumn("__f", failed).withColumn("run", F.sum((~F.col("__f")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.where("__f").groupBy(owner, "run").agg(F.count("*").alias("failures")).where(F.col("failures") >= least)


def overlap_with_previous(pages: DataFrame, owner: str, order: str, links: str) -> DataFrame:
    """``pages`` with ``repeats``: whether a page shares a link with the one before."""
    return pages.withColumn("repeats", F.coalesce(F.arrays_overlap(links, F.lag(links).over(Window.partitionBy(owner).orderBy(order))), F.lit(False)))


def date_windows(spark, start: str, end: str, days: int) -> DataFrame:
    """(lower, upper): windows of ``days`` with shared inner and open outer edges; at least two. ValueError unless days > 0."""
    if days <= 0:
        raise ValueError("days must be positive")
    edges = spark.sql("SELECT explode(sequence(to_timestamp(:a), to_timestamp(:b), make_dt_interval(:n))) AS edge", {"a": start, "b": end, "n": days})
    # A few edges: the range of dates, not the data.
    w = Window.orderBy("edge")
    inner = edges.select("edge", F.lead("edge").over(w).alias("upper"))
    first = edges.agg(F.min("edge").alias("upper")).select(F.lit(None).cast("timestamp").alias("lower"), "upper")
    return first.unionByName(inner.select(F.col("edge").alias("lower"), "upper"))
