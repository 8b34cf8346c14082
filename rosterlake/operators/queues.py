"""Searches, work queues, counts and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search(rows: DataFrame, query: str, contains: list[str], equals: str, order: list[Column | str], limit: int = 25, active: Column | None = None) -> DataFrame:
    """Rows in which a column contains the text (regardless of case; % and _ stay wildcards) or ``equals`` is it."""
    hit = F.col(equals) == query
    for c in contains:
        hit = hit | F.col(c).ilike(f"%{query}%")
    found = rows.where(hit if active is None else hit & active)
    return found.orderBy(*order).limit(limit)


def lookup(rows: DataFrame, **keys: str | None) -> DataFrame:
    """Rows with the first key that is given; ValueError without any."""
    for k, v in keys.items():
        if v:
            return rows.where(F.col(k) == v)
    raise ValueError("give one of " + ", ".join(keys))


def pending(ledger: DataFrame, limit: int = 0, most_attempts: int = 4) -> DataFrame:
    """Work to do: pending or failed fewer than ``most_attempts`` times, the least tried first. Limit 0 is none."""
    out = ledger.where(F.col("status").isin("pending", "error") & (F.col("attempts") < most_attempts)).orderBy("attempts", "id")
    return out.limit(limit) if limit else out


def stale(ledger: DataFrame, as_of: str, days: int, limit: int = 0) -> DataFrame:
    """Done work last fetched more than ``days`` ago or never, oldest first; days <= 0 means all, by id. Limit 0 is none."""
    done = ledger.where("status = 'done'")
    if days <= 0:
        out = done.orderBy("id")
    else:
        out = done.where(F.col("last_fetched").isNull() | (F.col("last_fetched") < F.expr(f"timestamp '{as_of}' - interval {int(days)} days"))).orderBy(F.col("last_fetched").asc_nulls_first(), "id")
    return out.limit(limit) if limit else out


def without_website(orgs: DataFrame, as_of: str, recheck_days: int | None, limit: int | None = None) -> DataFrame:
    """Organizations without a website that weren't checked within the window; here limit 0 is zero rows."""
    out = orgs.where("website is null")
    if recheck_days is not None and recheck_days > 0:
        out = out.where(F.col("website_checked_at").isNull() | (F.col("website_checked_at") < F.expr(f"timestamp '{as_of}' - interval {int(recheck_days)} days")))
    out = out.orderBy("organization_id")
    return out if limit is None else out.limit(limit)


def duplicate_groups(rows: DataFrame, keys: dict[str, Column], row_id: str, shown: list[str], listed: str) -> DataFrame:
    """Groups of more than one row by ``keys``: n, ``shown`` of the smallest id, and ``listed`` values joined by ' | '.

    Rows without a listed value count, too; a group of such rows has NULL.
    """
    grouped = rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.count("*").alias("n"), *[F.min_by(c, row_id).alias(c) for c in shown], F.expr(f"listagg({listed}, ' | ') within group (order by {listed})").alias(f"{listed}_list")
    )
    return grouped.where("n > 1").drop(*keys)


def counts_by(rows: DataFrame, key: Column, name: str) -> DataFrame:
    return rows.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def with_percent(counts: DataFrame, n: str = "n") -> DataFrame:
    """Adds the percentage of the total (a total of 0 counts as 1); as many rows as groups."""
    return counts.withColumn("percent", F.round(100.0 * F.col(n) / F.greatest(F.lit(1), F.sum(n).over(Window.partitionBy())), 4))


def top_reasons(rows: DataFrame, reason: Column, limit: int = 20) -> DataFrame:
    """The most frequent reasons, ties in the order of the alphabet."""
    return rows.where(reason.isNotNull()).groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(limit)


def one_pass_counts(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows for which each condition holds."""
    return rows.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()])


def page(rows: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """The page of that number (from 0) in order."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def mark(ledger: DataFrame, done: DataFrame, as_of: str) -> DataFrame:
    """Work after a batch (id, status, error): one attempt more, errors cut to 500 characters, fetched now."""
    d = done.select("id", F.col("status").alias("__s"), F.substring("error", 1, 500).alias("__e"), F.lit(True).alias("__in"))
    j = ledger.join(d, "id", "left")
    hit = F.coalesce("__in", F.lit(False))
    new = {"status": F.when(hit, F.col("__s")).otherwise(F.col("status")), "attempts": F.col("attempts") + hit.cast("int"), "error": F.when(hit, F.col("__e")).otherwise(F.col("error")), "last_fetched": F.when(hit, F.lit(as_of).cast("timestamp")).otherwise(F.col("last_fetched"))}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in ledger.columns])


def requeue(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    """Work made pending again without attempts."""
    j = ledger.join(ids.select("id", F.lit(True).alias("__in")), "id", "left")
    new = {"status": F.when(F.col("__in"), "pending").otherwise(F.col("status")), "attempts": F.when(F.col("__in"), 0).otherwise(F.col("attempts"))}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in ledger.columns])


#: Counters that a finished run may carry.
RUN_COUNTERS = ("new", "changed", "unchanged", "excluded", "errors", "deactivated")


def start_run(runs: DataFrame, run_id: int, kind: str, as_of: str) -> DataFrame:
    """Runs with one more, begun at ``as_of``; counters begin at 0. An id that is there already isn't added again."""
    spark = runs.sparkSession
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), F.lit(as_of).cast("timestamp").alias("started_at"), *[F.lit(0).alias(c) for c in RUN_COUNTERS if c in runs.columns])
    fresh = row.join(runs.select("run_id"), "run_id", "left_anti")
    return runs.unionByName(fresh.select([F.col(c).cast(runs.schema[c].dataType) for c in fresh.columns if c in runs.columns]), allowMissingColumns=True)


def set_source(runs: DataFrame, run_id: int, source: str) -> DataFrame:
    """Runs with the source that one of them found its work by."""
    return runs.withColumn("source", F.when(F.col("run_id") == run_id, F.lit(source)).otherwise(F.col("source")))


def finish_run(runs: DataFrame, run_id: int, as_of: str, counters: dict[str, int], notes: str | None = None) -> DataFrame:
    """Runs with one finished; only known counters are taken (ValueError otherwise), notes are cut to 200 characters."""
    unknown = sorted(set(counters) - set(RUN_COUNTERS))
    if unknown:
        raise ValueError(f"unknown counters: {', '.join(unknown)}")
    new = {c: F.lit(v) for c, v in counters.items()} | {"finished_at": F.lit(as_of).cast("timestamp"), "notes": F.substring(F.lit(notes).cast("string"), 1, 200)}
    return runs.select(*[F.when(F.col("run_id") == run_id, new[c].cast(runs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in runs.columns])
