"""Queries p5 and p8 to p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import contamination, mixture, residue, survivors
from rosterlake.session import cut, table, written


def survivor_rules() -> list[survivors.Rule]:
    said = F.lower(F.trim(F.col("site_confidence")))
    conf = F.when(said == "high", 3).when(said == "medium", 2).when(said == "low", 1).otherwise(0)
    return [
        survivors.Rule("primary_site_of_care", survivors.told(F.col("primary_site_of_care")), [conf]),
        survivors.Rule("specialty", survivors.told(F.col("specialty"))),
        survivors.Rule("phone", survivors.dialled(F.col("phone"))),
    ]


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.best_rows(table(spark, sf_dir, "providers"), survivors.valid_npi(F.col("npi")), "provider_id", "updated_date", survivor_rules())


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per number on two or more rows, and field, the row that gives the value."""
    return _best(spark, sf_dir).select(F.col("entity").alias("npi"), "field", F.col("row").alias("provider_id"))


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each number."""
    return survivors.merged(_best(spark, sf_dir), ["primary_site_of_care", "specialty", "phone"]).withColumnRenamed("entity", "npi")


def p5_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the learned order does where times are missing: every second number's are taken away before the choice.

    Per field, of the numbers without times whose values differ: how many, how many get the value that their times
    would give by the order learned from the other numbers, and how many if the smallest id decides.
    """
    rows, entity = table(spark, sf_dir, "providers"), survivors.valid_npi(F.col("npi"))
    less = rows.withColumn("updated_date", F.when(F.pmod(F.xxhash64(entity), F.lit(2)) == 0, F.col("updated_date")))
    best = lambda df, learn=True: survivors.best_rows(df, entity, "provider_id", "updated_date", [survivors.Rule(r.name, r.value) for r in survivor_rules()], learn=learn).select("entity", "field", F.lower(F.trim("value")).alias("v"))
    spoken = rows.select(entity.alias("entity"), F.inline(F.array(*[F.struct(F.lit(r.name).alias("field"), F.lower(F.trim(r.value)).alias("v")) for r in survivor_rules()])))
    torn = spoken.where("v is not null and pmod(xxhash64(entity), 2) = 1").groupBy("entity", "field").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo <> hi").select("entity", "field")
    sides = torn.join(best(rows), ["entity", "field"]).join(best(less).withColumnRenamed("v", "learned"), ["entity", "field"]).join(best(less, False).withColumnRenamed("v", "plain"), ["entity", "field"])
    return sides.groupBy("field").agg(F.count("*").alias("groups"), F.count_if(F.col("v") == F.col("learned")).alias("by_learned_order"), F.count_if(F.col("v") == F.col("plain")).alias("by_id"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the test items they leak."""
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents leak each item."""
    return p8_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = written(mixture.token_counts(table(spark, sf_dir, "documents")))
    available = counts.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("available"))
    shares = cut(mixture.plan(available, table(spark, sf_dir, "mix_targets")))
    return mixture.mix(counts, shares), shares


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture in training order."""
    return mixture.in_order(_mixture(spark, sf_dir)[0])


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixture.report(*_mixture(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with leftovers where content should be."""
    return residue.affected(table(spark, sf_dir, "documents"))


_P5 = r"""
WITH d AS (SELECT *, regexp_replace(regexp_replace(trim(npi), '\.0*$', ''), '[^0-9]', '', 'g') AS n FROM providers),
v AS (SELECT *, list_sum(list_transform(range(1, 16), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr('80840' || n, 16 - i, 1) AS INT)
        ELSE CASE WHEN CAST(substr('80840' || n, 16 - i, 1) AS INT) * 2 > 9 THEN CAST(substr('80840' || n, 16 - i, 1) AS INT) * 2 - 9 ELSE CAST(substr('80840' || n, 16 - i, 1) AS INT) * 2 END END)) AS luhn
      FROM d WHERE regexp_matches(n, '^[12][0-9]{9}$')),
ok AS (SELECT * FROM v WHERE luhn % 10 = 0 AND n IN (SELECT n FROM v WHERE luhn % 10 = 0 GROUP BY n HAVING count(*) > 1)),
f AS (
  SELECT n, 'primary_site_of_care' AS field, provider_id, updated_date, primary_site_of_care AS v,
         CASE lower(trim(site_confidence)) WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS c FROM ok
  UNION ALL SELECT n, 'specialty', provider_id, updated_date, specialty, 0 FROM ok
  UNION ALL SELECT n, 'phone', provider_id, updated_date, phone, 0 FROM ok),
u AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(v), '(x|ext\.?|extension)\s*[0-9]+\s*$', ''), '[^0-9]', '', 'g'), '^1([0-9]{10})$', '\1') AS ten FROM f),
w AS (SELECT * FROM u WHERE v IS NOT NULL AND CASE WHEN field = 'phone' THEN length(ten) >= 10 AND NOT regexp_matches(ten, '^0+$')
      ELSE trim(regexp_replace(lower(v), '\s+', ' ', 'g')) NOT IN (""" + ", ".join(f"'{x}'" for x in survivors.NOTHING_KNOWN) + r""") END),
b AS (SELECT *, row_number() OVER (PARTITION BY n, field ORDER BY c DESC, updated_date DESC NULLS LAST, provider_id) AS k FROM w)
"""

QUERIES = {
    "p5_found": p5_found, "p5_records": p5_records, "p5_learned": p5_learned, "p8_found": p8_found, "p8_items": p8_items,
    "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found,
}
ORACLE = {
    "p5_found": _P5 + "SELECT n AS npi, field, provider_id FROM b WHERE k = 1",
    "p5_records": _P5 + "SELECT n AS npi, max(v) FILTER (field = 'primary_site_of_care') AS primary_site_of_care, max(v) FILTER (field = 'specialty') AS specialty, max(v) FILTER (field = 'phone') AS phone FROM b WHERE k = 1 GROUP BY n",
}
