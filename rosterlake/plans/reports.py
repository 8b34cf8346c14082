"""Reports as tables: providers, excluded records, summary, organizations, and a profile in words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.text import list_text
from rosterlake.operators.queues import counts_by, duplicate_groups, one_pass_counts, top_reasons, with_percent
from rosterlake.operators.rules import needs_review, yes_no

#: What the grades of site confidence mean.
MEANING = {
    "high": "Single location, NPPES-confirmed identity. Safe to join.",
    "medium": "2-3 locations, or identity unconfirmed. Review before joining.",
    "low": "4+ locations. 'Primary site' is not meaningful for this provider.",
}


def providers(rows: DataFrame) -> dict[str, DataFrame]:
    """Active providers with flags in words and review marks, and departed ones, the last seen first."""
    active = rows.where("is_active = 1").select(
        "full_name", "first_name", "last_name", "credentials", "provider_type", "specialty", "primary_site_of_care", "practice_name", "address", "city", "state", "zip", "phone", "npi", "location_count", "site_confidence",
        yes_no(F.col("nppes_name_match")).alias("name_match"), yes_no(F.col("accepting_new_patients")).alias("accepting_new_patients"), list_text(F.col("languages")).alias("languages"), needs_review(F.col("site_confidence")).alias("needs_review"),
    )
    nulls_first = [F.col(c).asc_nulls_first() for c in ("last_name", "first_name", "full_name")]
    departed = rows.where("is_active = 0").select("full_name", "npi", "practice_name", "city", "state", "last_seen").orderBy(F.desc("last_seen"), "npi")
    return {"Providers": active.orderBy(*nulls_first), "Departed": departed}


def excluded(rows: DataFrame) -> dict[str, DataFrame]:
    return {"Excluded": rows.orderBy("classification", "full_name"), "By classification": counts_by(rows, F.col("classification"), "classification").orderBy(F.desc("n"))}


def summary(rows: DataFrame, changes: DataFrame, runs: DataFrame, ledger: DataFrame) -> dict[str, DataFrame]:
    conf = F.lower(F.trim("site_confidence"))
    meaning = F.create_map(*[F.lit(x) for kv in MEANING.items() for x in kv])
    previous = runs.where("finished_at is not null").orderBy(F.desc("run_id")).offset(1).limit(1).select(F.col("run_id").alias("since"))
    return {
        "Totals": one_pass_counts(rows, total=F.lit(True), active=F.col("is_active") == 1, inactive=F.col("is_active") == 0, without_npi=F.col("npi").isNull()),
        "Types": counts_by(rows, F.col("provider_type"), "provider_type").orderBy(F.desc("n")),
        "Site confidence": counts_by(rows, conf, "site_confidence").withColumn("meaning", F.coalesce(F.try_element_at(meaning, F.col("site_confidence")), F.lit(""))).orderBy(F.desc("n")),
        "Duplicates": duplicate_groups(rows, {"k1": F.lower("full_name"), "k2": F.lower(F.coalesce("city", F.lit(""))), "k3": F.coalesce("state", F.lit(""))}, "provider_id", ["full_name", "city", "state"], "npi"),
        "Changes": changes.join(F.broadcast(previous), F.col("run_id") >= F.col("since")).join(rows.select("provider_id", "full_name"), "provider_id", "left").orderBy(F.desc("run_id")).limit(5000),
        "Errors": ledger.where("status = 'error'").orderBy(F.desc("attempts"), "id").limit(2000),
        "Runs": runs.orderBy(F.desc("run_id")).limit(20),
    }


def organizations(orgs: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    counted = orgs.join(links.groupBy("organization_id").agg(F.count("provider_id").alias("providers")), "organization_id", "left").fillna(0, ["providers"])
    flagged = counted.withColumn("needs_website", F.coalesce("website", F.lit("")) == "").orderBy(F.col("state").asc_nulls_first(), "name")
    return {"Organizations": flagged, "Website coverage": counts_by(orgs, F.coalesce("website_confidence", F.lit("none")), "website_confidence").orderBy(F.desc("n"))}


def investigation(labels: DataFrame, reasons: DataFrame) -> str:
    """A short report in Markdown from a profile's aggregates (label) and (reason); a few rows reach the driver."""
    kinds = with_percent(counts_by(labels, F.col("label"), "label")).orderBy(F.desc("n"), "label").limit(100).collect()
    lines = ["# Investigation", "", "| kind | n | % |", "|---|---:|---:|", *[f"| {r.label} | {r.n} | {r.percent:.1f} |" for r in kinds], "", "## Reasons", ""]
    return "\n".join([*lines, *[f"* {r.reason} ({r.n})" for r in top_reasons(reasons, F.col("reason")).collect()]])
