"""What changed between consecutive full snapshots.

Method: both sides of each pair are united, tagged by side, grouped by key,
and classified from per-side row hashes in a single aggregation shuffle. The
hashes are made before the shuffle, so rows travel as a few numbers each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(cols: list[str]) -> Column:
    """A hash of the values as they are. Two nulls are equal; a null differs from any text.

    Null flags are hashed along with the values, because the hash function
    itself passes over nulls.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    flags = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    return F.xxhash64(*values, flags)


def snapshot_changes(rows: DataFrame, run: str, key: str, present: Column, at: str, content_hash: str, compared: list[str]) -> DataFrame:
    """(run, key, change) for every run but the first, against the run before.

    Of several present rows of a key in a run the latest ``at`` counts (ties:
    the greater hash). A change is judged by ``content_hash``, case and outer
    spaces aside, or by ``compared`` where either hash is null. Rows with a
    null run or key are left out. The list of runs is as long as the number of
    deliveries and is the only thing read on the driver.
    """
    runs = sorted(r[0] for r in rows.select(run).where(F.col(run).isNotNull()).distinct().collect())
    if len(runs) < 2:
        return rows.sparkSession.createDataFrame([], rows.select(F.col(run), F.col(key), F.lit("").alias("change")).schema)
    after = F.create_map(*[F.lit(x) for pair in zip(runs, runs[1:]) for x in pair])
    hashed = rows.where(present & F.col(run).isNotNull() & F.col(key).isNotNull()).select(
        F.col(run), F.col(key), F.col(at).alias("__at"), F.xxhash64(F.lower(F.trim(F.col(content_hash)))).alias("__h"), F.col(content_hash).isNull().alias("__none"), row_hash(compared).alias("__f")
    )
    state = F.struct("__at", "__none", "__h", "__f")
    sides = F.filter(
        F.array(F.struct(F.col(run).alias("pair"), F.lit(True).alias("now")), F.struct(F.try_element_at(after, F.col(run)).alias("pair"), F.lit(False).alias("now"))),
        lambda s: s["pair"].isNotNull() & (s["pair"] != F.lit(runs[0])),
    )
    tagged = hashed.select(F.col(key), state.alias("__s"), F.explode(sides).alias("__side"))
    grouped = tagged.groupBy(F.col("__side.pair").alias(run), F.col(key)).agg(
        F.max(F.when(F.col("__side.now"), F.col("__s"))).alias("n"), F.max(F.when(~F.col("__side.now"), F.col("__s"))).alias("b")
    )
    differs = F.when(F.col("n.__none") | F.col("b.__none"), F.col("n.__f") != F.col("b.__f")).otherwise(F.col("n.__h") != F.col("b.__h"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("n").isNull(), "removed").when(differs, "changed")
    return grouped.select(run, key, change.alias("change")).where("change is not null")
