"""Pipelines from landed files to records: resources of an interface, pages of a site, rows of a file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import documents, fhir
from rosterlake.functions import text as tx
from rosterlake.operators import rules
from rosterlake.operators.lookup import dereference
from rosterlake.operators.nested import latest_records
from rosterlake.operators.primary import first_holding, primary_by_count
from rosterlake.session import cut, written

# Resources


@dataclass(frozen=True)
class Views:
    """Typed views of the newest readable state of each resource."""

    practitioners: DataFrame
    roles: DataFrame
    locations: DataFrame
    organizations: DataFrame


def resource_views(spool: DataFrame, npi_part: str = "npi") -> Views:
    """Views of a spool (resource_type, resource_id, body, spooled_at, spool_seq). A resource repeated counts once."""
    # Four views and several joins read it: the newest states are found and parsed once, and kept as they were parsed.
    newest = written(latest_records(spool).select("resource_type", "resource_id", F.to_variant_object("record").alias("v")))
    of = lambda t: newest.where(F.col("resource_type") == t)
    v = F.col("v")
    refs = lambda path: F.filter(F.transform(fhir.items(v, path), lambda x: fhir.reference(fhir.text(x, "$.reference"))), lambda r: r.isNotNull())
    practitioners = of("Practitioner").select(
        F.col("resource_id").alias("practitioner_id"), fhir.identifier(v, npi_part).alias("npi"), fhir.person_name(v).alias("full_name"), fhir.person_suffix(v).alias("credentials"), tx.list_text(fhir.languages(v)).alias("languages")
    )
    roles = of("PractitionerRole").select(
        F.col("resource_id").alias("role_id"), fhir.reference(fhir.text(v, "$.practitioner.reference"))["id"].alias("practitioner_id"), fhir.reference(fhir.text(v, "$.organization.reference"))["id"].alias("organization_id"),
        F.transform(F.filter(refs("$.location"), lambda r: r["type"] == "Location"), lambda r: r["id"]).alias("location_ids"), fhir.preferred_coding(fhir.items(v, "$.specialty"), "tax")["display"].alias("specialty"),
        fhir.accepting_new_patients(v).alias("accepting"),
    )
    locations = of("Location").select(
        F.col("resource_id").alias("location_id"),
        F.when(~tx.is_generated_name(fhir.text(v, "$.name"), fhir.texts(v, "$.address.line"), fhir.text(v, "$.address.city"), fhir.text(v, "$.address.state"), fhir.text(v, "$.address.postalCode")), fhir.text(v, "$.name")).alias("name"),
        fhir.address_line(v).alias("address"), fhir.text(v, "$.address.city").alias("city"), fhir.text(v, "$.address.state").alias("state"), fhir.text(v, "$.address.postalCode").alias("zip"), tx.clean_phone(fhir.contact(v, "phone")).alias("phone"),
    )
    organizations = of("Organization").select(F.col("resource_id").alias("organization_id"), fhir.text(v, "$.name").alias("name"), F.coalesce(fhir.identifier(v, "npi"), F.col("resource_id")).alias("source_id"))
    return Views(practitioners, roles, locations, organizations)


def role_locations(views: Views) -> DataFrame:
    """(practitioner_id, role_id, location_id) of roles whose practitioner is there, one row per referenced location."""
    kept = views.roles.join(views.practitioners.select("practitioner_id"), "practitioner_id", "left_semi")
    return kept.select("practitioner_id", "role_id", F.explode("location_ids").alias("location_id"))


def misses(views: Views) -> DataFrame:
    """(kind, hits, misses) of the references of roles."""
    p = dereference(views.roles.select("practitioner_id"), "practitioner_id", views.practitioners.select(F.col("practitioner_id").alias("k")), "k", "p_").select(F.lit("practitioner").alias("kind"), F.col("practitioner_id").alias("r"), F.col("p_missing").alias("m"))
    o = dereference(views.roles.select("organization_id"), "organization_id", views.organizations.select(F.col("organization_id").alias("k")), "k", "o_").select(F.lit("organization").alias("kind"), F.col("organization_id").alias("r"), F.col("o_missing").alias("m"))
    ls = views.roles.select(F.explode("location_ids").alias("location_id"))
    lo = dereference(ls, "location_id", views.locations.select(F.col("location_id").alias("k")), "k", "l_").select(F.lit("location").alias("kind"), F.col("location_id").alias("r"), F.col("l_missing").alias("m"))
    return p.unionByName(o).unionByName(lo).where("r is not null").groupBy("kind").agg(F.count_if(~F.col("m")).alias("hits"), F.count_if("m").alias("misses"))


def normalized(views: Views) -> DataFrame:
    """One record per practitioner with roles: the main location (most roles, ties to the smallest id), its address,
    the main role (smallest that holds it), the organization, number of locations, whether new patients are taken.

    The main location is chosen among referenced ones, whether they are there
    or not; an absent one leaves the address NULL.
    """
    pairs = role_locations(views)
    main = primary_by_count(pairs, "practitioner_id", "location_id")
    kept = views.roles.join(views.practitioners.select("practitioner_id"), "practitioner_id", "left_semi").join(main.select("practitioner_id", "primary", "choices"), "practitioner_id", "left")
    role = first_holding(kept, "practitioner_id", "role_id", F.array_contains("location_ids", F.col("primary")))
    accepts = kept.groupBy("practitioner_id").agg(F.bool_or("accepting").alias("accepting"), F.greatest(F.lit(1), F.coalesce(F.max("choices"), F.lit(0))).alias("location_count"), F.max("primary").alias("primary_location"))
    details = views.roles.select("role_id", "organization_id", "specialty")
    out = views.practitioners.join(accepts, "practitioner_id").join(role, "practitioner_id").join(details, "role_id", "left")
    out = out.join(views.locations.withColumnRenamed("name", "site").withColumnRenamed("location_id", "primary_location"), "primary_location", "left").join(views.organizations.withColumnRenamed("name", "organization"), "organization_id", "left")
    return out.withColumn("practice_name", tx.first_filled(F.col("site"), F.col("organization")))


def nested_records(views: Views) -> DataFrame:
    """The same with the lists of locations (main one first) and organizations as nested columns."""
    base = normalized(views)
    pairs = role_locations(views).select("practitioner_id", "location_id").distinct().join(views.locations, "location_id")
    ranked = pairs.join(base.select("practitioner_id", "primary_location"), "practitioner_id").select("practitioner_id", F.struct((F.col("location_id") != F.col("primary_location")).alias("later"), "location_id", "name", "address", "city", "state", "zip", "phone").alias("l"))
    # A list is as long as one person's places.
    lists = ranked.groupBy("practitioner_id").agg(F.array_sort(F.collect_list("l")).alias("locations"))
    orgs = views.roles.join(views.organizations, "organization_id").groupBy("practitioner_id").agg(F.array_sort(F.collect_set(F.struct("organization_id", "name", "source_id"))).alias("organizations"))
    return base.join(lists, "practitioner_id", "left").join(orgs, "practitioner_id", "left")


def ingest(records: DataFrame, known: DataFrame, policy: rules.NumberPolicy) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new providers, link-only records, excluded with reasons). Of several records of a number the smallest practitioner is new."""
    cols = {c: F.col(c) for c in ("full_name", "npi", "address", "city", "state", "phone", "specialty", "practice_name")} | {"enumeration": F.lit(None).cast("string"), "profile_url": F.lit(None).cast("string")}
    judged = records.withColumn("reasons", rules.problems(cols, policy))
    valid, bad = judged.where("size(reasons) = 0"), judged.where("size(reasons) > 0")
    first = valid.groupBy("npi").agg(F.min("practitioner_id").alias("practitioner_id"))
    fresh = valid.join(first, ["npi", "practitioner_id"], "left_semi").join(known.select("npi"), "npi", "left_anti")
    links = valid.join(fresh.select("practitioner_id"), "practitioner_id", "left_anti")
    return fresh, links, bad.select("practitioner_id", F.array_join("reasons", "; ").alias("reason"))


def completeness(stats: DataFrame) -> DataFrame:
    """(fatal, reason) of a landing's statuses (status, n): a run with failures or silent gaps isn't complete."""
    by = stats.groupBy().agg(F.sum(F.when(F.col("status") == "failed", F.col("n")).otherwise(0)).alias("failed"), F.sum(F.when(F.col("status") == "silent_empty", F.col("n")).otherwise(0)).alias("silent"))
    reason = tx.notes(F.when(F.col("failed") > 0, F.concat("failed", F.lit(" failed batches"))), F.when(F.col("silent") > 0, F.concat("silent", F.lit(" silently empty answers"))))
    return by.select((F.coalesce("failed", F.lit(0)) + F.coalesce("silent", F.lit(0)) > 0).alias("fatal"), reason.alias("reason"))


# Pages of a site


@dataclass(frozen=True)
class SiteAdapter:
    """What is particular to a site, as patterns and columns: the extension point for new sites."""

    name: str
    profile_url: str
    npi_group: int = 1
    brand: str = ""
    org_shapes: tuple[tuple[str, str], ...] = ()

    def parse(self, page: Column) -> Column:
        """struct of what a page tells of a person, from its JSON-LD, else from its headings."""
        node = documents.jsonld_node(page)
        return F.struct(
            tx.first_filled(documents.jsonld_text(node, "name"), documents.page_title(page)).alias("name"), tx.first_filled(documents.jsonld_text(node, "medicalSpecialty", "specialty"), documents.title_segment(page, self.brand or self.name)).alias("specialty"),
            documents.jsonld_text(node, "hospitalAffiliation", "affiliation").alias("affiliation"), documents.jsonld_flag(node, "isAcceptingNewPatients").alias("accepting"), documents.location_ids(page).alias("location_ids"),
        )


ADAPTERS: dict[str, SiteAdapter] = {}


def register(adapter: SiteAdapter) -> SiteAdapter:
    ADAPTERS[adapter.name] = adapter
    return adapter


def adapter(name: str) -> SiteAdapter:
    """The adapter of that name; ValueError names those that are known."""
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name!r}; known: {', '.join(sorted(ADAPTERS)) or 'none'}")
    return ADAPTERS[name]


register(SiteAdapter("example", r"^https?://[^/]+/profile/[a-z0-9-]+-(\d{10})/?$", brand="Example Health"))


def crawl(urls: DataFrame, cards: DataFrame, pages: DataFrame, registry: DataFrame, site: SiteAdapter, policy: rules.NumberPolicy) -> tuple[DataFrame, DataFrame]:
    """(providers, excluded) from landed (url), (npi, card), (url, html) and a registry.

    ``registry`` has npi, enumeration, first_name, last_name, credential,
    organization_name, taxonomy_code, taxonomy_desc; it is asked only for
    numbers with a right check digit unless the policy is off. One record per
    address; of several addresses of one number the smallest is kept. Each
    excluded address has the first reason that applies.
    """
    base = urls.distinct().withColumn("npi", tx.filled(F.regexp_extract("url", site.profile_url, site.npi_group)))
    askable = tx.npi_valid(F.col("npi")) if policy.checksum != "off" else F.col("npi").isNotNull()
    reg = registry.select(F.col("npi").alias("r_npi"), *[F.col(c).alias(f"r_{c}") for c in ("enumeration", "first_name", "last_name", "credential", "organization_name", "taxonomy_code", "taxonomy_desc")])
    joined = base.join(cards, "npi", "left").join(pages, "url", "left").join(reg, (F.col("npi") == F.col("r_npi")) & askable, "left")
    read = joined.withColumn("c", documents.parse_vcard(F.col("card"))).withColumn("p", site.parse(F.col("html")))
    shown = tx.first_filled(F.col("p.name"), F.col("c.organization"), F.col("c.name"))
    read = read.withColumn("shown", shown).withColumn("full_name", tx.name_part(F.col("shown"))).withColumn("credentials", tx.merged_credentials(tx.credential_part(F.col("shown")), F.col("c.title")))
    kind = rules.classify(F.col("full_name"), F.col("credentials"), F.col("r_enumeration"), F.col("r_organization_name"), F.col("r_credential"), F.col("r_taxonomy_desc"), list(site.org_shapes))
    read = read.withColumn("kind", kind).withColumn("name_match", F.when(F.col("r_npi").isNotNull(), tx.names_match(F.col("full_name"), F.col("r_first_name"), F.col("r_last_name"))))
    read = read.withColumn("location_count", F.greatest(F.lit(1), F.size("p.location_ids"))).withColumn("enumeration", F.coalesce("r_enumeration", F.lit("not_found")))
    named = read.withColumn("address", F.col("c.address")).withColumn("city", F.col("c.city")).withColumn("state", F.col("c.state")).withColumn("zip", F.col("c.zip")).withColumn("phone", F.col("c.phone")).withColumn("specialty", tx.first_filled(F.col("p.specialty"), F.col("r_taxonomy_desc"))).withColumn("practice_name", F.col("c.organization")).withColumn("profile_url", F.col("url"))
    cols = {c: F.col(c) for c in ("full_name", "npi", "enumeration", "address", "city", "state", "profile_url", "phone", "specialty", "practice_name")}
    wrong = rules.problems(cols, policy)
    reason = rules.first_reason(
        (F.col("npi").isNull(), "no number in address"), (F.col("html").isNull() & F.col("card").isNull(), "page and card missing"), (documents.is_error_page(F.col("html"), F.col("p.name")), "error page"),
        (F.col("shown").isNull() & F.col("r_npi").isNull(), "no name and no registry record"), (~F.col("kind.type").isin("Physician", "APP"), "not an individual"), (F.size(wrong) > 0, "invalid"),
    )
    # Parsed once and kept, as good and excluded records are both read from it, and so that the filter on the reason isn't pushed into the parsing.
    judged = cut(named.withColumn("why", reason).withColumn("reason", F.when(F.col("why") == "invalid", F.array_join(wrong, "; ")).otherwise(F.col("why"))).drop("html", "card", "why"))
    trust = rules.site_confidence(F.col("location_count"), F.col("r_npi").isNotNull(), F.col("name_match"), F.col("kind.confidence"))
    remarks = rules.warnings(F.col("npi"), F.col("enumeration"), F.col("name_match"), policy)
    good = judged.where("reason is null").select(
        "npi", "profile_url", "full_name", tx.first_name(F.col("full_name")).alias("first_name"), tx.last_name(F.col("full_name")).alias("last_name"), "credentials", F.col("kind.type").alias("provider_type"), "specialty", F.col("practice_name").alias("primary_site_of_care"), "practice_name",
        "address", "city", "state", "zip", "phone", "location_count", trust.alias("site_confidence"), F.col("enumeration").alias("nppes_enumeration"), F.col("name_match").alias("nppes_name_match"), F.col("r_taxonomy_code").alias("taxonomy_code"), F.col("r_taxonomy_desc").alias("taxonomy_desc"), tx.filled(F.array_join(remarks, "; ")).alias("source_notes"),
    )
    one = good.groupBy("npi").agg(F.min_by(F.struct(*[c for c in good.columns if c != "npi"]), "profile_url").alias("r")).select("npi", "r.*")
    return one, judged.where("reason is not null").select("url", "full_name", F.col("kind.type").alias("classification"), "reason")
