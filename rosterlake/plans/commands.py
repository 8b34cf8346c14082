"""One function per command; tables in, tables out. What a command saves is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.operators import merge, queues
from rosterlake.operators.lookup import exact_link, last_by_key, unlinked
from rosterlake.operators.rules import NumberPolicy
from rosterlake.plans import cascade, ingest, reports
from rosterlake.sources import bundles, files

COMPARED = [c for c in merge.TRACKED]


def discover(known_urls: DataFrame, landed_sitemaps: DataFrame, start: DataFrame | list[str], pattern: str, most_files: int | None = 200) -> DataFrame:
    """New addresses for the queue."""
    found = bundles.crawl_sitemaps(landed_sitemaps, start, most_files).where(F.col("url").rlike(pattern))
    return merge.insert_missing(known_urls, found, ["url"])


def scrape(state: DataFrame, urls: DataFrame, cards: DataFrame, pages: DataFrame, registry: DataFrame, site: str, run_id: int, as_of: str, policy: NumberPolicy = NumberPolicy()) -> tuple[merge.Merged, DataFrame]:
    """The merged state of a crawl, and what was excluded."""
    good, bad = ingest.crawl(urls, cards, pages, registry, ingest.adapter(site), policy)
    fields = [c for c in COMPARED if c in good.columns]
    return merge.upsert(state, good, "npi", fields, run_id, as_of, protected=("profile_url",)), bad


def refresh(state: DataFrame, urls: DataFrame, cards: DataFrame, pages: DataFrame, registry: DataFrame, site: str, run_id: int, as_of: str, complete: bool, policy: NumberPolicy = NumberPolicy()) -> tuple[merge.Merged, DataFrame]:
    """``scrape``, and then providers that this run didn't discover become inactive, if it was complete."""
    merged, bad = scrape(state, urls, cards, pages, registry, site, run_id, as_of, policy)
    return merge.Merged(merge.deactivate_missing(merged.state, "profile_url", urls.withColumnRenamed("url", "profile_url"), complete), merged.outcome, merged.changes), bad


def trial(urls: DataFrame, n: int) -> DataFrame:
    """The first ``n`` addresses, for a look before a run."""
    return urls.orderBy("url").limit(n)


def sampled(judged: DataFrame, n: int, shown: int = 40) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` judged addresses, and of these the first ``shown`` that aren't providers, with their reasons."""
    first = judged.orderBy("url").limit(n)
    return first, first.where("reason is not null").orderBy("url").limit(shown)


def last_finished(runs: DataFrame) -> DataFrame:
    """The run that was finished last, or no row."""
    return runs.where("finished_at is not null").orderBy(F.desc("finished_at"), F.desc("run_id")).limit(1)


def investigate(labels: DataFrame, reasons: DataFrame) -> str:
    return reports.investigation(labels, reasons)


def status(ledger: DataFrame) -> DataFrame:
    return queues.one_pass_counts(ledger, pending=F.col("status") == "pending", done=F.col("status") == "done", error=F.col("status") == "error")


def changes(feed: DataFrame, limit: int = 40) -> DataFrame:
    return feed.orderBy(F.desc("run_id"), "npi", "field").limit(limit)


def query(providers: DataFrame, text: str) -> DataFrame:
    return queues.search(providers, text, ["full_name", "last_name"], "npi", [F.desc("is_active"), "full_name", "provider_id"])


def export(providers: DataFrame, folder: str) -> None:
    files.write_sheets(reports.providers(providers), folder)


def ingest_organizations(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Outcomes of a hospital file against the organizations that are there."""
    return merge.null_safe_upsert(old, files.hospitals_from_csv(rows), ["source", "source_id"], ["name", "normalized_name", "address", "city", "state", "zip", "phone"])


def ingest_providers(spool: DataFrame, known: DataFrame, policy: NumberPolicy = NumberPolicy(require_profile_url=False)) -> tuple[DataFrame, DataFrame, DataFrame]:
    return ingest.ingest(ingest.normalized(ingest.resource_views(spool)), known, policy)


def enrich_organizations(orgs: DataFrame, sources: list[cascade.Source], probes: DataFrame, aliases: DataFrame) -> DataFrame:
    keyed = cascade.candidate_keys(orgs, aliases)
    return cascade.enrich(keyed, F.col("keys"), sources, probes)


def link_organizations(providers: DataFrame, orgs: DataFrame, links: DataFrame, key) -> DataFrame:
    """(provider_id, organization_id) of active, unlinked providers whose affiliation, else practice, is exactly an organization's name."""
    pool = unlinked(providers.where("is_active = 1 and (hospital_affiliation is not null or practice_name is not null)"), links, "provider_id")
    keyed = pool.select("provider_id", key(F.col("hospital_affiliation")).alias("a"), key(F.col("practice_name")).alias("p"))
    index = last_by_key(orgs.select("normalized_name", "organization_id"), "normalized_name", "organization_id")
    return exact_link(keyed, ["a", "p"], index, "normalized_name", "organization_id").where("organization_id is not null").select("provider_id", "organization_id")


def export_organizations(orgs: DataFrame, links: DataFrame, folder: str) -> None:
    files.write_sheets(reports.organizations(orgs, links), folder)


def refresh_osm_cache(elements: DataFrame, path: str) -> None:
    bundles.osm_elements(elements).write.mode("overwrite").json(path)


def test_run(judged: DataFrame, n: int = 50) -> tuple[DataFrame, DataFrame]:
    return sampled(judged, n)


#: The commands by name.
COMMANDS = {
    "test": test_run, "investigate": investigate, "discover": discover, "scrape": scrape, "refresh": refresh, "trial": trial, "export": export, "status": status, "changes": changes, "query": query,
    "ingest-organizations": ingest_organizations, "ingest-providers": ingest_providers, "enrich-organizations": enrich_organizations, "link-organizations": link_organizations,
    "export-organizations": export_organizations, "refresh-osm-cache": refresh_osm_cache,
}
