"""Exact lookups that never guess: ambiguous keys are left out, tiers are tried in order.

Dimension sides are broadcast only if their size is checked: ``small`` looks at
the number of rows and leaves the choice to the optimizer beyond its bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast.
BROADCAST_ROWS = 50_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unambiguous(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value): the single distinct value of each key; keys with several are left out.

    Null or empty keys and null values take no part. Partial aggregation of
    least and greatest value needs no set of values, so a hot key costs no
    more than others.
    """
    kept = rows.where(reduce(Column.__and__, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys], F.col(value).isNotNull()))
    return kept.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi")).where("__lo = __hi").select(*keys, F.col("__lo").alias(value))


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``; null and empty keys are left out."""
    cols = [c for c in rows.columns if c != key]
    best = rows.where((F.col(key).isNotNull()) & (F.col(key) != "")).groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("__r"))
    return best.select(key, *[F.col(f"__r.{c}").alias(c) for c in cols])


def exact_link(probe: DataFrame, columns: list[str], build: DataFrame, key: str, value: str) -> DataFrame:
    """``probe`` with ``value``: that of the first of ``columns`` whose text is a key of ``build``, else NULL.

    One equi-join per column, never an OR-join.
    """
    index, out, found = small(build.select(F.col(key).alias("__key"), F.col(value).alias("__value"))), probe, []
    for i, c in enumerate(columns):
        name = f"__m{i}"
        out = out.join(index.withColumnsRenamed({"__key": f"__k{i}", "__value": name}), F.col(c) == F.col(f"__k{i}"), "left")
        found.append(F.col(name))
    return out.select(*probe.columns, F.coalesce(*found).alias(value))


def tiered_lookup(probe: DataFrame, tiers: list[tuple[list[str], DataFrame]], value: str) -> DataFrame:
    """``probe`` with ``value`` and ``tier``: the first tier (keys, index) with a hit, from 1; NULL without any."""
    out, hits = probe, []
    for i, (keys, index) in enumerate(tiers):
        side = small(index.select(*[F.col(k).alias(f"__t{i}_{k}") for k in keys], F.col(value).alias(f"__v{i}")))
        out = out.join(side, [F.col(k) == F.col(f"__t{i}_{k}") for k in keys], "left")
        hits.append(F.col(f"__v{i}"))
    tier = reduce(lambda w, i: w.when(hits[i].isNotNull(), i + 1), range(1, len(hits)), F.when(hits[0].isNotNull(), 1))
    return out.select(*probe.columns, F.coalesce(*hits).alias(value), tier.alias("tier"))


def ordered_first_hit(probe: DataFrame, row_id: str, keys: Column, index: DataFrame, key: str, value: str) -> DataFrame:
    """(row_id, value, pos): of an array of keys the first that the index has. Rows without a hit are left out."""
    listed = probe.select(F.col(row_id), F.posexplode(keys).alias("pos", "__key")).where("__key is not null and __key <> ''")
    hit = listed.join(small(index.select(F.col(key).alias("__key"), F.col(value).alias("__value"))), "__key")
    return hit.groupBy(row_id).agg(F.min_by("__value", "pos").alias(value), F.min("pos").alias("pos"))


def unlinked(rows: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the linked ones; a null among these changes nothing."""
    return rows.join(linked.select(key), key, "left_anti")


def split_known(incoming: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(new, known already) of the incoming rows; those with a null key are new."""
    keys = known.select(key).where(F.col(key).isNotNull())
    return incoming.join(keys, key, "left_anti"), incoming.join(keys, key, "left_semi")


def two_step_match(incoming: DataFrame, known: DataFrame, first: str, second: str, row_id: str) -> DataFrame:
    """``incoming`` with ``matched`` (by ``first``, else by ``second``) and ``conflict`` (both match different rows)."""
    one = known.where(F.col(first).isNotNull()).select(F.col(first).alias("__f"), F.col(row_id).alias("__a"))
    two = known.where(F.col(second).isNotNull()).select(F.col(second).alias("__s"), F.col(row_id).alias("__b"))
    joined = incoming.join(one, F.col(first) == F.col("__f"), "left").join(two, F.col(second) == F.col("__s"), "left")
    return joined.select(*incoming.columns, F.coalesce("__a", "__b").alias("matched"), F.coalesce(F.col("__a") != F.col("__b"), F.lit(False)).alias("conflict"))


def dereference(links: DataFrame, on: str, target: DataFrame, key: str, prefix: str) -> DataFrame:
    """``links`` with the target's columns (prefixed) and ``<prefix>missing``: a reference that leads nowhere."""
    side = target.select(F.col(key).alias("__key"), *[F.col(c).alias(f"{prefix}{c}") for c in target.columns if c != key], F.lit(True).alias("__there"))
    joined = links.join(side, F.col(on) == F.col("__key"), "left")
    return joined.withColumn(f"{prefix}missing", F.col(on).isNotNull() & F.col("__there").isNull()).drop("__key", "__there")


def alias_items(rows: DataFrame, item: str, name: str, state: str, seq: str, norm: Column) -> DataFrame:
    """(item, key, raw, state): every name of an item in its first spelling, with the item's state if it has exactly one."""
    keyed = rows.withColumn("key", norm).where("key is not null and key <> ''")
    states = rows.groupBy(item).agg(F.min(state).alias("__lo"), F.max(state).alias("__hi")).select(item, F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).alias("state"))
    return keyed.groupBy(item, "key").agg(F.min_by(name, seq).alias("raw")).join(states, item)


def other_names(matched: DataFrame, names: DataFrame, item: str, own_key: str) -> DataFrame:
    """``matched`` rows (with an item) joined with all names of the item but their own."""
    return matched.join(names, item).where(F.col("key") != F.col(own_key))
