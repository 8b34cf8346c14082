"""The best representative of each duplicate group, field by field.

Method: currency reasoning. Precedence between values is learned from rows
with timestamps: of two values that follow each other in many groups, the one
that comes later more often is the more current. In a group these precedences
form a partial order of its values, and where rows have no timestamp, the
topologically latest values (none of the group's other values is known to
follow them) win. Where timestamps are there, they decide.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that only say that nothing is known.
NOTHING_KNOWN = (
    "", "-", "--", "?", "n/a", "na", "n.a.", "none", "none listed", "not listed", "not available", "not provided", "not known", "not specified",
    "unknown", "unknown site", "unspecified", "tbd", "tba", "to be determined", "see website", "pending", "null", "nil", "missing", "no data",
)


def told(col: Column) -> Column:
    """The value, or null if it is null or a text that only says that nothing is known."""
    return F.when(~F.trim(F.regexp_replace(F.lower(col), r"(?U)\s+", " ")).isin(*NOTHING_KNOWN), col)


def dialled(col: Column) -> Column:
    """The phone text, or null without ten digits or with zeros only; an extension doesn't count."""
    digits = F.regexp_replace(F.regexp_replace(F.lower(col), r"(?:x|ext\.?|extension)\s*\d+\s*$", ""), r"[^0-9]", "")
    ten = F.regexp_replace(digits, r"^1(?=[0-9]{10}$)", "")
    return F.when((F.length(ten) >= 10) & ~ten.rlike("^0+$"), col)


def valid_npi(col: Column) -> Column:
    """The ten digits of a provider number however written, or null if it isn't one."""
    digits = F.regexp_replace(F.regexp_replace(F.trim(col), r"\.0*$", ""), r"[^0-9]", "")
    return F.when(digits.rlike("^[12][0-9]{9}$") & F.call_function("luhn_check", F.concat(F.lit("80840"), digits)), digits)


@dataclass
class Rule:
    """How a field's best row is found: its usable value, and what ranks before the time (greatest first)."""

    name: str
    value: Column
    first: list[Column] = field(default_factory=list)


def transitions(values: DataFrame) -> DataFrame:
    """(field, before, after, n): how often ``after`` followed ``before`` in a group, less the reverse; n > 0.

    ``values`` has (entity, field, v, at). Following rows are found inside
    months, and across months from each month's first and last value, so that
    even a group with a third of all rows is never in one task as a whole.
    """
    timed = values.where("at is not null").withColumn("month", F.date_trunc("month", "at"))
    slot = ["entity", "field", "month"]
    inside = timed.select("field", F.lag("v").over(Window.partitionBy(*slot).orderBy("at", "v")).alias("before"), F.col("v").alias("after"))
    ends = timed.groupBy(*slot).agg(F.min_by("v", F.struct("at", "v")).alias("head"), F.max_by("v", F.struct("at", "v")).alias("tail"))
    across = ends.select("field", F.lag("tail").over(Window.partitionBy("entity", "field").orderBy("month")).alias("before"), F.col("head").alias("after"))
    steps = inside.unionByName(across).where("before is not null and before <> after")
    low, high = F.least("before", "after"), F.greatest("before", "after")
    net = steps.groupBy("field", low.alias("lo"), high.alias("hi")).agg(F.sum(F.when(F.col("after") == high, 1).otherwise(-1)).alias("n")).where("n <> 0")
    up = F.col("n") > 0
    return net.select("field", F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("before"), F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("after"), F.abs("n").alias("n"))


def overtaken(values: DataFrame, learned: DataFrame) -> DataFrame:
    """(entity, field, v) of values that another value of the group is known to follow.

    The partial order of a group is what learned precedences say of its own
    values. Only learned pairs are looked up; no group is paired with itself.
    """
    own = values.select("entity", "field", "v").distinct()
    edges = own.join(learned.select("field", F.col("before").alias("v"), "after"), ["field", "v"])
    return edges.join(own.select("entity", "field", F.col("v").alias("after")), ["entity", "field", "after"], "left_semi").select("entity", "field", "v").distinct()


def best_rows(rows: DataFrame, entity: Column, row_id: str, at: str, rules: list[Rule], least: int = 2, learn: bool = True) -> DataFrame:
    """(entity, field, row_id, value): for each entity on ``least`` or more rows, and each field, the row that gives the value.

    Order: what the rule ranks first, then the latest ``at``; then, among rows
    without ``at``, values that nothing in the group is known to follow; then
    the smallest id (without ``learn`` the id alone). Rows without a usable value give none; fields for which
    no row has one have no result. Rows without an entity are left out.
    One aggregation with map-side combination; no group is gathered.
    """
    slots = F.array(*[F.struct(F.lit(r.name).alias("field"), r.value.cast("string").alias("v"), F.array(*[c.cast("long") for c in r.first]).cast("array<bigint>").alias("first")) for r in rules])
    read = rows.select(entity.alias("entity"), F.col(row_id).alias("row"), F.col(at).alias("at"), slots.alias("s")).where("entity is not null")
    counts = read.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("entity")
    long = read.select("entity", "row", "at", F.inline("s")).where("v is not null")
    untimed = long.where("at is null")
    # The learned order is asked only in groups that have rows without a time.
    asked = long.join(untimed.select("entity", "field").distinct(), ["entity", "field"], "left_semi")
    late = overtaken(asked, transitions(long) if learn else transitions(long).limit(0)).withColumn("old", F.lit(1))
    ranked = untimed.join(late, ["entity", "field", "v"], "left").unionByName(long.where("at is not null").withColumn("old", F.lit(0)))
    order = F.struct(F.transform("first", lambda x: -x), F.coalesce(-F.unix_micros(F.col("at").cast("timestamp")), F.lit(2**62)), F.coalesce("old", F.lit(0)), "row")
    best = ranked.groupBy("entity", "field").agg(F.min(F.struct(order.alias("o"), F.col("row").alias("row"), F.col("v").alias("v"))).alias("b"))
    return best.join(counts, "entity", "left_semi").select("entity", "field", F.col("b.row").alias("row"), F.col("b.v").alias("value"))


def merged(best: DataFrame, names: list[str]) -> DataFrame:
    """One surviving record per entity, with a column per field."""
    return best.groupBy("entity").agg(*[F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names])
