"""Queries p2, p3 and p7: which rows mean the same person, organization, hospital or place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import addresses, hospitals, linking
from rosterlake.session import cut, kept, table, written


def _person_classes(spark: SparkSession, providers: DataFrame) -> DataFrame:
    return kept(spark, lambda: linking.person_classes(kept(spark, lambda: linking.people(providers))))


def _org_links(spark: SparkSession, orgs: DataFrame, providers: DataFrame) -> DataFrame:
    return kept(spark, lambda: linking.org_links(kept(spark, lambda: linking.mentions(orgs, providers))))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of one person, organizations that are one, and practices that mean an organization."""
    providers, orgs = table(spark, sf_dir, "providers"), table(spark, sf_dir, "organizations")
    persons = linking.pairs_of(_person_classes(spark, providers)).withColumn("kind", F.lit("person"))
    links = _org_links(spark, orgs, providers)
    classes = kept(spark, lambda: linking.org_classes(links))
    same = linking.pairs_of(classes.select((F.col("id") / 2).cast("bigint").alias("id"), "root")).withColumn("kind", F.lit("organization"))
    practice = linking.practice_pairs(links, classes).withColumn("kind", F.lit("practice"))
    return persons.unionByName(same).unionByName(practice).select("kind", "id_a", "id_b").distinct()


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listing and organization: its class, the class's number of rows, and so how many others it is linked to."""
    providers, orgs = table(spark, sf_dir, "providers"), table(spark, sf_dir, "organizations")
    persons = _person_classes(spark, providers).select(F.lit("person").alias("kind"), "id", "root")
    same = kept(spark, lambda: linking.org_classes(_org_links(spark, orgs, providers))).select(F.lit("organization").alias("kind"), (F.col("id") / 2).cast("bigint").alias("id"), (F.col("root") / 2).cast("bigint").alias("root"))
    known = providers.select(F.lit("person").alias("kind"), F.col("provider_id").alias("id")).unionByName(orgs.select(F.lit("organization").alias("kind"), F.col("organization_id").alias("id"))).where("id is not null").distinct()
    member = known.join(written(persons.unionByName(same)), ["kind", "id"], "left").withColumn("root", F.coalesce("root", "id"))
    # Counted before they are joined, so that a class of a third of all rows isn't gathered.
    sizes = member.groupBy("kind", "root").agg(F.count("*").alias("size"))
    return member.join(sizes, ["kind", "root"]).select("kind", "id", F.col("root").alias("class_id"), "size", (F.col("size") - 1).alias("links"))


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of organizations and listed hospitals with the rule that found them and its confidence."""
    left = hospitals.records(hospitals.from_organizations(table(spark, sf_dir, "organizations")))
    right = hospitals.records(hospitals.from_hifld(table(spark, sf_dir, "hifld_hospitals")))
    return hospitals.matches(left, right).select(F.col("l").alias("organization_id"), F.col("r").alias("hifld_id"), "rule", F.round("confidence", 4).alias("confidence"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of rows that mean the same hospital."""
    return p3_matches(spark, sf_dir).select("organization_id", "hifld_id").distinct()


def _located(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    loc = table(spark, sf_dir, "locations").select(F.col("location_id").alias("id"), "address", "city", "state", "zip")
    pro = table(spark, sf_dir, "providers").select(F.col("provider_id").alias("id"), "address", "city", "state", "zip")
    rows = written(addresses.read_addresses(loc.withColumn("kind", F.lit("location")).unionByName(pro.withColumn("kind", F.lit("provider"))), ["kind", "id"]))
    both = cut(addresses.with_place(rows, addresses.places(rows)))
    return both.where("kind = 'location'"), both.where("kind = 'provider'")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations of one place, and providers at it."""
    loc, pro = _located(spark, sf_dir)
    pairs = addresses.same_place(loc, loc, "id", "id").where("id_a < id_b").withColumn("kind", F.lit("location"))
    out = pairs.unionByName(addresses.same_place(loc, pro, "id", "id").withColumn("kind", F.lit("provider")))
    return out.select("kind", "id_a", "id_b").distinct()


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p3_matches": p3_matches, "p7_found": p7_found}
ORACLE: dict[str, str] = {}
