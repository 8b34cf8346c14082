"""The enrichment cascade: prioritized sources of websites with a full trail of candidates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.text import candidate_domains, page_mentions, with_scheme
from rosterlake.operators.lookup import ordered_first_hit, small, unambiguous


@dataclass(frozen=True)
class Source:
    """A website index (key, state, website) and how far it is trusted: 'high' ones aren't probed."""

    name: str
    rows: DataFrame
    checked: bool = True


def indexes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unambiguous websites by (key, state) and by key alone; rows without a state only count for the latter."""
    return unambiguous(rows.where("state is not null"), ["key", "state"], "website"), unambiguous(rows, ["key"], "website")


def hits(orgs: DataFrame, keys: Column, source: Source) -> DataFrame:
    """(organization_id, website): for each key in order, by state first and by name alone second; the first hit wins."""
    by_state, by_name = indexes(source.rows)
    listed = orgs.select("organization_id", "state", keys.alias("ks"))
    tagged = by_state.select(F.concat_ws("\u0001", F.lit("s"), "key", "state").alias("k"), "website").unionByName(by_name.select(F.concat_ws("\u0001", F.lit("n"), "key").alias("k"), "website"))
    both = F.flatten(F.transform("ks", lambda k: F.array(F.when(F.col("state").isNotNull(), F.concat_ws("\u0001", F.lit("s"), k, F.col("state"))), F.concat_ws("\u0001", F.lit("n"), k))))
    return ordered_first_hit(listed.withColumn("both", both), "organization_id", F.col("both"), tagged, "k", "website").select("organization_id", "website")


def candidate_keys(orgs: DataFrame, aliases: DataFrame) -> DataFrame:
    """``orgs`` with ``keys``: the own folded name, then trusted aliases by id, without repeats."""
    listed = aliases.where("confidence = 'high'").groupBy("organization_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("alias_id", "normalized_alias"))), lambda x: x["normalized_alias"]).alias("others"))
    joined = orgs.join(listed, "organization_id", "left")
    return joined.withColumn("keys", F.filter(F.array_distinct(F.concat(F.array("normalized_name"), F.coalesce("others", F.array().cast("array<string>")))), lambda k: k.isNotNull() & (k != ""))).drop("others")


def enrich(orgs: DataFrame, keys: Column, sources: list[Source], probes: DataFrame) -> DataFrame:
    """(organization_id, rank, source, website, reachable, confidence, chosen): every candidate up to the one chosen.

    Sources are asked in order. One that needn't be checked is chosen at once
    with high confidence; another if its site answers, with medium confidence
    if the page mentions the organization, else low. Last, domains guessed
    from the name are tried; guesses that don't answer leave no trace.
    """
    landed = small(probes.where("status = 200").groupBy(with_scheme(F.col("url")).alias("u")).agg(F.max("html").alias("page")))
    found = None
    for i, s in enumerate(sources):
        part = hits(orgs, keys, s).select("organization_id", F.lit(i).alias("rank"), F.lit(s.name).alias("source"), with_scheme(F.col("website")).alias("website"), F.lit(s.checked).alias("checked"))
        found = part if found is None else found.unionByName(part)
    guesses = orgs.select("organization_id", F.posexplode(candidate_domains(F.col("name"))).alias("pos", "d")).select("organization_id", (F.lit(len(sources)) + F.col("pos")).alias("rank"), F.lit("guess").alias("source"), with_scheme(F.col("d")).alias("website"), F.lit(True).alias("checked"))
    every = found.unionByName(guesses) if found is not None else guesses
    probed = every.join(landed, F.col("website") == F.col("u"), "left").join(orgs.select("organization_id", "name"), "organization_id")
    up = F.when(F.col("checked"), F.col("page").isNotNull())
    trust = F.when(~F.col("checked"), "high").when(page_mentions(F.col("page"), F.col("name")), "medium").otherwise("low")
    rated = probed.select("organization_id", "rank", "source", "website", up.alias("reachable"), F.when(~F.col("checked") | up, trust).alias("confidence"))
    best = rated.where("confidence is not null").groupBy("organization_id").agg(F.min("rank").alias("best"))
    trail = rated.join(best, "organization_id", "left").where("(best is null or rank <= best) and (source <> 'guess' or confidence is not null)")
    return trail.withColumn("chosen", F.coalesce(F.col("rank") == F.col("best"), F.lit(False))).drop("best")
