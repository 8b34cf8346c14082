"""State as pure functions: new state and change feed from old state and a batch.

Nothing is written here, so a dry run is a plan whose result isn't saved, and
running a batch twice changes nothing the second time. Times and run ids are
parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields whose changes are recorded one by one.
TRACKED = (
    "full_name", "credentials", "provider_type", "specialty", "primary_site_of_care", "practice_name", "address", "city", "state", "zip", "phone", "location_count",
    "hospital_affiliation", "accepting_new_patients",
)


@dataclass(frozen=True)
class Merged:
    """The new state, the outcome per key, and the field changes."""

    state: DataFrame
    outcome: DataFrame
    changes: DataFrame


def same_or_empty(a: Column, b: Column) -> Column:
    """Equal as text, '' and NULL being the same."""
    return F.nullif(a.cast("string"), F.lit("")).eqNullSafe(F.nullif(b.cast("string"), F.lit("")))


def field_changes(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old_value, new_value) of fields that differ in rows of both sides; '' and NULL are the same."""
    joined = old.alias("o").join(new.alias("n"), key)
    each = [F.when(~same_or_empty(F.col(f"o.{f}"), F.col(f"n.{f}")), F.struct(F.lit(f).alias("field"), F.col(f"o.{f}").cast("string").alias("old_value"), F.col(f"n.{f}").cast("string").alias("new_value"))) for f in fields]
    return joined.select(key, F.inline(F.array_compact(F.array(*each))))


def upsert(old: DataFrame, batch: DataFrame, key: str, compared: list[str], run_id: int, as_of: str, protected: tuple[str, ...] = ()) -> Merged:
    """Upsert of ``batch`` (one row per key) into ``old`` with soft activity.

    ``old`` has the batch's columns and is_active, first_seen, last_seen,
    last_seen_run_id. NEW rows get all times; UNCHANGED ones (all ``compared``
    equal and active) only last_seen and last_seen_run_id; CHANGED ones all
    columns, of which ``protected`` are never replaced by NULL. An inactive
    row that comes back is CHANGED even without a difference. One outer join
    on the key. Rows with a null key are inserted as NEW.
    """
    now, data = F.lit(as_of).cast("timestamp"), [c for c in batch.columns if c != key]
    keep = [c for c in old.columns if c not in (key, *data)]
    o = old.select(F.col(key).alias("__k"), *[F.col(c).alias(f"o_{c}") for c in (*data, *keep)], F.lit(True).alias("__old"))
    n = batch.select(F.col(key), *[F.col(c).alias(f"n_{c}") for c in data], F.lit(True).alias("__new"))
    j = n.join(o, F.col(key) == F.col("__k"), "full").withColumn(key, F.coalesce(key, "__k"))
    equal = F.lit(True)
    for c in compared:
        equal = equal & same_or_empty(F.col(f"o_{c}"), F.col(f"n_{c}"))
    outcome = F.when(F.col("__new").isNull(), "UNTOUCHED").when(F.col("__old").isNull(), "NEW").when(equal & F.col("o_is_active"), "UNCHANGED").otherwise("CHANGED")
    j = j.withColumn("outcome", outcome)
    takes, seen = F.col("outcome").isin("NEW", "CHANGED"), F.col("outcome") != "UNTOUCHED"
    values = [F.when(takes, F.coalesce(F.col(f"n_{c}"), F.col(f"o_{c}")) if c in protected else F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in data]
    special = {
        "is_active": F.when(seen, F.lit(True)).otherwise(F.col("o_is_active")), "first_seen": F.coalesce("o_first_seen", now),
        "last_seen": F.when(seen, now).otherwise(F.col("o_last_seen")), "last_seen_run_id": F.when(seen, F.lit(run_id)).otherwise(F.col("o_last_seen_run_id")),
    }
    state = j.select(key, *values, *[special.get(c, F.col(f"o_{c}")).alias(c) for c in keep])
    changed = j.where("outcome = 'CHANGED'")
    tracked = [c for c in compared if c in data]
    each = [F.when(~same_or_empty(F.col(f"o_{f}"), F.col(f"n_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").cast("string").alias("old_value"), F.col(f"n_{f}").cast("string").alias("new_value"))) for f in tracked]
    changes = changed.select(key, F.inline(F.array_compact(F.array(*each))), F.lit(run_id).alias("run_id"))
    return Merged(state, j.select(key, "outcome"), changes)


def null_safe_upsert(old: DataFrame, batch: DataFrame, keys: list[str], compared: list[str], shown: list[str] | None = None) -> DataFrame:
    """``shown`` columns (default ``keys``) and ``outcome`` of each row of a batch.

    Values are compared so that nulls are equal and '' differs from NULL; a row with a null key is always NEW.
    """
    o = old.select(*[F.col(k).alias(f"o_{k}") for k in keys], *[F.col(c).alias(f"o_{c}") for c in compared], F.lit(True).alias("__old"))
    equal = F.lit(True)
    for c in compared:
        equal = equal & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    joined = batch.join(o, [F.col(k) == F.col(f"o_{k}") for k in keys], "left")
    return joined.select(*(shown or keys), F.when(F.col("__old").isNull(), "NEW").when(equal, "UNCHANGED").otherwise("CHANGED").alias("outcome"))


def insert_missing(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose keys aren't there, one per key; rows with a null key are left out."""
    there = batch.dropna(subset=keys).dropDuplicates(keys)
    return there.join(old.select(*keys), keys, "left_anti")


def touch_or_insert(old: DataFrame, batch: DataFrame, key: str, as_of: str) -> DataFrame:
    """State in which known keys only get last_seen, unknown ones are inserted: the first writing wins."""
    now = F.lit(as_of).cast("timestamp")
    seen = batch.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__seen", F.lit(True))
    touched = old.join(seen, key, "left").withColumn("last_seen", F.when(F.col("__seen"), now).otherwise(F.col("last_seen"))).drop("__seen")
    fresh = insert_missing(old, batch, [key]).withColumn("first_seen", now).withColumn("last_seen", now)
    return touched.unionByName(fresh.select(*touched.columns))


def overwrite_links(old: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Links in which the batch's row replaces the old one of the same keys; of several the last in ``order`` counts."""
    cols = [c for c in old.columns if c not in keys]
    last = batch.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("__r")).select(*keys, "__r.*")
    return old.join(last.select(*keys), keys, "left_anti").unionByName(last.select(*old.columns))


def enrich_links(old: DataFrame, batch: DataFrame, owner: str, target: str, order: str) -> DataFrame:
    """Links after a batch that only adds: known pairs become active again, new pairs may claim to be primary only
    if the owner has no primary yet, and of several claims in a batch the first in ``order`` wins.

    ``old`` has (owner, target, is_primary, is_active), ``batch`` (owner, target, is_primary, order).
    """
    pairs = batch.groupBy(owner, target).agg(F.bool_or("is_primary").alias("is_primary"), F.min(order).alias("__o"))
    fresh = pairs.join(old.select(owner, target), [owner, target], "left_anti")
    taken = old.where("is_primary").select(owner).distinct().withColumn("__taken", F.lit(True))
    claims = fresh.join(taken, owner, "left")
    first = F.row_number().over(Window.partitionBy(owner, "is_primary").orderBy("__o", target)) == 1
    granted = claims.withColumn("__first", first).select(owner, target, (F.col("is_primary") & F.col("__taken").isNull() & F.col("__first")).alias("is_primary"), F.lit(True).alias("is_active"))
    again = batch.select(owner, target).distinct().withColumn("__again", F.lit(True))
    kept = old.join(again, [owner, target], "left").select(owner, target, "is_primary", (F.col("is_active") | F.coalesce("__again", F.lit(False))).alias("is_active"))
    return kept.unionByName(granted)


def deactivate_missing(state: DataFrame, key: str, discovered: DataFrame, complete: bool, limited: bool = False) -> DataFrame:
    """Active rows whose key this run didn't discover become inactive; nothing is deleted.

    Only after a complete, unlimited discovery; otherwise the state comes back
    as it is. What counts is the set of keys discovered in this run, so work
    that was done before and not repeated doesn't deactivate anything.
    """
    if not complete or limited:
        return state
    seen = discovered.select(key).distinct().withColumn("__seen", F.lit(True))
    return state.join(seen, key, "left").withColumn("is_active", F.col("is_active") & F.coalesce("__seen", F.lit(False))).drop("__seen")


def update_columns(state: DataFrame, patch: DataFrame, key: str, columns: list[str], only_empty: bool = False) -> DataFrame:
    """State with ``columns`` from the patch where it has the key; with ``only_empty`` only where there was no value."""
    p = patch.select(F.col(key), *[F.col(c).alias(f"__p_{c}") for c in columns], F.lit(True).alias("__in"))
    joined = state.join(p, key, "left")
    new = {c: (F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__p_{c}")) if only_empty else F.when(F.col("__in"), F.col(f"__p_{c}")).otherwise(F.col(c))) for c in columns}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in state.columns])


def keep_first_date(old: DataFrame, batch: DataFrame, key: str, as_of: str) -> DataFrame:
    """Upsert by key that keeps date_found of a known row and renews last_seen."""
    now, data = F.lit(as_of).cast("timestamp"), [c for c in batch.columns if c != key]
    o = old.select(F.col(key), *[F.col(c).alias(f"o_{c}") for c in old.columns if c != key])
    n = batch.select(F.col(key), *[F.col(c).alias(f"n_{c}") for c in data], F.lit(True).alias("__new"))
    j = o.join(n, key, "full")
    took = F.col("__new").isNotNull()
    return j.select(key, *[F.when(took, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in data], F.coalesce("o_date_found", now).alias("date_found"), F.when(took, now).otherwise(F.col("o_last_seen")).alias("last_seen"))


def membership_history(events: DataFrame, owner: str, value: str, at: str) -> DataFrame:
    """(owner, value, valid_from, valid_to): the same value again changes nothing, another closes the period and opens one."""
    w = Window.partitionBy(owner).orderBy(at, value)
    starts = events.where(F.col(owner).isNotNull() & F.col(at).isNotNull()).withColumn("__before", F.lag(F.struct(value)).over(w)).where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.struct(value)))
    return starts.select(owner, value, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))


def switch_members(current: DataFrame, changes: DataFrame, owner: str, value: str, as_of: str) -> DataFrame:
    """Periods after ``changes`` (owner, value) at ``as_of``: unchanged owners stay, others are closed and opened."""
    now = F.lit(as_of).cast("timestamp")
    c = changes.select(F.col(owner), F.col(value).alias("__v"))
    joined = current.join(c, owner, "left")
    moves = F.col("valid_to").isNull() & F.col("__v").isNotNull() & ~F.col("__v").eqNullSafe(F.col(value))
    closed = joined.withColumn("valid_to", F.when(moves, now).otherwise(F.col("valid_to"))).select(*current.columns)
    still = current.where("valid_to is null").select(owner, F.col(value).alias("__cur"))
    opened = c.join(still, owner, "left").where(~F.col("__v").eqNullSafe(F.col("__cur"))).select(owner, F.col("__v").alias(value), now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return closed.unionByName(opened.select(*closed.columns))


def add_columns(state: DataFrame, wanted: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """State with the missing columns added (name -> type); existing ones are left, nulls of ``defaults`` filled."""
    out = state.select("*", *[F.lit(None).cast(t).alias(c) for c, t in wanted.items() if c not in state.columns])
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key no parent has: must be none. Null keys aren't orphans."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def latest_values(log: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """(key, value) of a key/value log, the last writing of each key."""
    return log.groupBy(key).agg(F.max_by(value, F.struct(at, value)).alias(value))


def appended(trail: DataFrame, rows: DataFrame, as_of: str) -> DataFrame:
    """An append-only trail with more rows, stamped ``as_of``; nothing that is there is changed or compared."""
    return trail.unionByName(rows.withColumn("added_at", F.lit(as_of).cast("timestamp")))


def pending(merged: Merged) -> DataFrame:
    """(outcome, n): what a merge would write if it weren't a dry run."""
    return merged.outcome.where("outcome in ('NEW', 'CHANGED')").groupBy("outcome").agg(F.count("*").alias("n"))
