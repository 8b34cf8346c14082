"""Queries of filters, joins, aggregations, windows, sorts and set operations, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterlake.functions import text as tx
from rosterlake.operators import compare, lookup, primary, queues, rules
from rosterlake.plans.catalog import Catalog
from rosterlake.plans.directory import P1_SQL
from rosterlake.plans.ingest import misses, normalized, resource_views, role_locations
from rosterlake.session import table
from rosterlake.sources import bundles

C = Catalog()
c = F.col


def stamp(x: str):
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss")


_LAST, _BEFORE, _FIRST = "(SELECT max(run_id)::INT FROM provider_snapshots)", "(SELECT max(run_id)::INT FROM provider_snapshots WHERE run_id < (SELECT max(run_id) FROM provider_snapshots))", "(SELECT min(run_id)::INT FROM provider_snapshots)"


def runs(spark, d) -> list[int]:
    """The run ids of the deliveries in order; as many as there were deliveries."""
    return sorted(r[0] for r in table(spark, d, "provider_snapshots").select("run_id").where("run_id is not null").distinct().collect())


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
#: Events read as a ledger of work: the kind of event is the status.
_LEDGER = "(SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'pending' WHEN 'error' THEN 'error' ELSE 'done' END AS status, CAST(floor(value) AS BIGINT) % 6 AS attempts, CASE WHEN event_type <> 'view' THEN ts END AS last_fetched FROM events) l"


def ledger(spark, d):
    kind = F.when(c("event_type") == "click", "pending").when(c("event_type") == "error", "error").otherwise("done")
    return table(spark, d, "events").select(c("event_id").alias("id"), kind.alias("status"), (F.floor("value") % 6).alias("attempts"), F.when(c("event_type") != "view", c("ts").cast("timestamp")).alias("last_fetched"))


@C.query("SELECT provider_id, full_name, npi FROM providers WHERE (full_name ILIKE '%lomb%' OR last_name ILIKE '%lomb%' OR npi = 'lomb') AND is_active = 1 ORDER BY is_active DESC, full_name, provider_id LIMIT 25")
def fil01_search(spark, d):
    hits = queues.search(table(spark, d, "providers"), "lomb", ["full_name", "last_name"], "npi", [F.desc("is_active"), "full_name", "provider_id"], active=c("is_active") == 1)
    return hits.select("provider_id", "full_name", "npi")


@C.query("SELECT provider_id, full_name FROM providers WHERE npi = (SELECT max(npi) FROM providers)")
def fil02_lookup(spark, d):
    rows = table(spark, d, "providers")
    return queues.lookup(rows, npi=rows.agg(F.max("npi")).first()[0], profile_url=None).select("provider_id", "full_name")


@C.query(f"SELECT id, status, attempts FROM {_LEDGER} WHERE status IN ('pending', 'error') AND attempts < 4")
def fil03_pending(spark, d):
    return queues.pending(ledger(spark, d)).select("id", "status", "attempts")


@C.query(f"SELECT id, coalesce({_TS.format('last_fetched')}, '') AS last_fetched FROM {_LEDGER} WHERE status = 'done' AND (last_fetched IS NULL OR last_fetched < TIMESTAMP '2024-02-01' - INTERVAL 10 DAY)")
def fil04_stale(spark, d):
    return queues.stale(ledger(spark, d), "2024-02-01 00:00:00", 10).select("id", F.coalesce(stamp("last_fetched"), F.lit("")).alias("last_fetched"))


@C.query("SELECT provider_id FROM providers p WHERE EXISTS (SELECT 1 FROM provider_snapshots s WHERE s.provider_id = p.provider_id AND s.is_active = 1)")
def fil05_is_done(spark, d):
    return table(spark, d, "providers").select("provider_id").join(table(spark, d, "provider_snapshots").where("is_active = 1").select("provider_id"), "provider_id", "left_semi")


@C.query("SELECT organization_id FROM organizations WHERE website IS NULL AND (updated_date IS NULL OR updated_date < TIMESTAMP '2024-10-01' - INTERVAL 90 DAY)")
def fil06_without_website(spark, d):
    orgs = table(spark, d, "organizations").withColumn("website_checked_at", c("updated_date").cast("timestamp"))
    return queues.without_website(orgs, "2024-10-01 00:00:00", 90).select("organization_id")


@C.query("SELECT system_id, name FROM health_systems WHERE primary_domain IS NULL")
def fil07_open_rows(spark, d):
    return table(spark, d, "health_systems").where("primary_domain is null").select("system_id", "name")


@C.query("SELECT provider_id, full_name, CASE nppes_name_match WHEN true THEN 'Yes' WHEN false THEN 'No' END AS name_match, coalesce(lower(trim(site_confidence)) IN ('low', 'medium'), false) AS needs_review FROM providers WHERE is_active = 1")
def fil09_active_export(spark, d):
    rows = table(spark, d, "providers").where("is_active = 1")
    return rows.select("provider_id", "full_name", rules.yes_no(c("nppes_name_match")).alias("name_match"), rules.needs_review(c("site_confidence")).alias("needs_review"))


@C.query(f"SELECT provider_id, {_TS.format('last_seen')} AS last_seen FROM providers WHERE is_active = 0")
def fil10_departed(spark, d):
    return table(spark, d, "providers").where("is_active = 0").orderBy(F.desc("last_seen")).select("provider_id", stamp("last_seen").alias("last_seen"))


@C.query(f"SELECT id, attempts FROM {_LEDGER} WHERE status = 'error' ORDER BY attempts DESC, id LIMIT 2000")
def fil11_errors(spark, d):
    return ledger(spark, d).where("status = 'error'").orderBy(F.desc("attempts"), "id").limit(2000).select("id", "attempts")


@C.query("SELECT profile_url, regexp_extract(profile_url, '-([0-9]{6,})$', 1) AS number FROM providers WHERE regexp_matches(profile_url, '-([0-9]{6,})$')")
def fil16_admitted_urls(spark, d):
    urls = table(spark, d, "providers").select(c("profile_url").alias("url"))
    return bundles.admitted(urls, "-([0-9]{6,})$", 1, "number").select(c("url").alias("profile_url"), "number")


@C.query("SELECT count(*) FILTER (resource_type IS NULL OR resource_id IS NULL) AS skipped, count(*) FILTER (resource_type IS NOT NULL AND resource_id IS NOT NULL) AS kept FROM spool_resources")
def fil17_malformed(spark, d):
    bad = c("resource_type").isNull() | c("resource_id").isNull()
    return queues.one_pass_counts(table(spark, d, "spool_resources"), skipped=bad, kept=~bad)


@C.query("SELECT h.name, count(*) AS documents FROM documents d JOIN health_systems h USING (system_id) WHERE h.primary_domain IS NOT NULL GROUP BY h.name")
def joi01_system_rollup(spark, d):
    systems = table(spark, d, "health_systems").where("primary_domain is not null").select("system_id", "name")
    # Counted before the join: as many rows as systems are moved.
    counts = table(spark, d, "documents").where("system_id is not null").groupBy("system_id").agg(F.count("*").alias("documents"))
    return counts.join(systems, "system_id").groupBy("name").agg(F.sum("documents").alias("documents"))


@C.query("SELECT s.run_id, s.provider_id, p.full_name FROM provider_snapshots s LEFT JOIN (SELECT * FROM providers WHERE is_active = 1) p USING (provider_id)")
def joi02_changes_with_names(spark, d):
    rows = table(spark, d, "provider_snapshots").select("run_id", "provider_id")
    return rows.join(table(spark, d, "providers").where("is_active = 1").select("provider_id", "full_name"), "provider_id", "left")


_LINKS = """(SELECT p.provider_id, coalesce(a.organization_id, b.organization_id) AS organization_id FROM
 (SELECT provider_id, nullif(trim(regexp_replace(lower(hospital_affiliation), '\\s+', ' ', 'g')), '') AS a, nullif(trim(regexp_replace(lower(practice_name), '\\s+', ' ', 'g')), '') AS p FROM providers) p
 LEFT JOIN (SELECT normalized_name, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1) a ON p.a = a.normalized_name
 LEFT JOIN (SELECT normalized_name, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1) b ON p.p = b.normalized_name) k"""


def links(spark, d):
    keyed = table(spark, d, "providers").select("provider_id", tx.org_key(c("hospital_affiliation")).alias("a"), tx.org_key(c("practice_name")).alias("p"))
    index = lookup.last_by_key(table(spark, d, "organizations").select("normalized_name", "organization_id"), "normalized_name", "organization_id")
    return lookup.exact_link(keyed, ["a", "p"], index, "normalized_name", "organization_id").select("provider_id", "organization_id")


@C.query(f"SELECT provider_id, organization_id FROM {_LINKS}")
def joi04_exact_link(spark, d):
    return links(spark, d)


@C.query(f"SELECT o.organization_id, o.name, count(k.provider_id) AS providers FROM organizations o LEFT JOIN {_LINKS} USING (organization_id) GROUP BY ALL")
def joi03_link_count(spark, d):
    counts = links(spark, d).where("organization_id is not null").groupBy("organization_id").agg(F.count("provider_id").alias("providers"))
    return table(spark, d, "organizations").select("organization_id", "name").join(counts, "organization_id", "left").fillna(0, ["providers"])


@C.query("SELECT normalized_name, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1")
def joi05_last_by_key(spark, d):
    return lookup.last_by_key(table(spark, d, "organizations").select("normalized_name", "organization_id"), "normalized_name", "organization_id")


@C.query(f"SELECT provider_id FROM providers p WHERE NOT EXISTS (SELECT 1 FROM {_LINKS} WHERE k.provider_id = p.provider_id AND k.organization_id IS NOT NULL)")
def joi06_unlinked(spark, d):
    return lookup.unlinked(table(spark, d, "providers").select("provider_id"), links(spark, d).where("organization_id is not null"), "provider_id")


_SITES = "SELECT normalized_name AS key, upper(trim(state)) AS state, website FROM organizations WHERE website IS NOT NULL AND normalized_name <> ''"
_HKEY = "trim(regexp_replace(lower(name), '\\s+', ' ', 'g'))"


@C.query(f"""WITH s AS ({_SITES}), a AS (SELECT key, state, min(website) AS website FROM s WHERE state <> '' GROUP BY ALL HAVING count(DISTINCT website) = 1), b AS (SELECT key, min(website) AS website FROM s GROUP BY ALL HAVING count(DISTINCT website) = 1)
SELECT h.hifld_id, coalesce(a.website, b.website) AS website, CASE WHEN a.website IS NOT NULL THEN 1 WHEN b.website IS NOT NULL THEN 2 END AS tier
FROM (SELECT hifld_id, {_HKEY} AS key, upper(trim(state)) AS state FROM hifld_hospitals) h LEFT JOIN a ON h.key = a.key AND h.state = a.state LEFT JOIN b ON h.key = b.key""")
def joi07_tiered(spark, d):
    sites = bundles.website_rows(table(spark, d, "organizations"), [c("name")], c("state"), c("website"), "va").select("key", "state", "website")
    by_state, by_name = lookup.unambiguous(sites.where("state <> ''"), ["key", "state"], "website"), lookup.unambiguous(sites, ["key"], "website")
    probe = table(spark, d, "hifld_hospitals").select("hifld_id", tx.org_key(c("name")).alias("key"), F.upper(F.trim("state")).alias("state"))
    return lookup.tiered_lookup(probe, [(["key", "state"], by_state), (["key"], by_name)], "website").select("hifld_id", "website", "tier")


@C.query(f"""WITH i AS (SELECT normalized_name AS key, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1),
k AS (SELECT hifld_id, unnest([{_HKEY}, trim(regexp_replace(lower(alt_name), '\\s+', ' ', 'g'))]) AS key, unnest([0, 1]) AS pos FROM hifld_hospitals)
SELECT hifld_id, arg_min(organization_id, pos) AS organization_id, min(pos) AS pos FROM k JOIN i USING (key) GROUP BY hifld_id""")
def joi08_ordered_keys(spark, d):
    probe = table(spark, d, "hifld_hospitals").select("hifld_id", F.array(tx.org_key(c("name")), tx.org_key(c("alt_name"))).alias("keys"))
    return lookup.ordered_first_hit(probe, "hifld_id", c("keys"), joi05_last_by_key(spark, d), "normalized_name", "organization_id")


# Resources of the spool: what P1_SQL reads of them is shared.
_ROLES = P1_SQL.split("objs AS (")[0].rstrip().rstrip(",") + """,
now AS (SELECT n.resource_type, n.resource_id, r.j FROM newest n JOIN readable r USING (spool_seq)),
roles AS (SELECT resource_id AS role_id, nullif(str_split(regexp_replace(j->>'$.practitioner.reference', '/_history/[^/]*$', ''), '/')[-1], '') AS practitioner_id,
  CASE WHEN len(str_split(j->>'$.organization.reference', '/')) > 1 THEN str_split(regexp_replace(j->>'$.organization.reference', '/_history/[^/]*$', ''), '/')[-1] END AS organization_id,
  CASE json_type(j->'$.location') WHEN 'ARRAY' THEN (j->'$.location')::JSON[] WHEN 'OBJECT' THEN [j->'$.location'] ELSE [] END AS locs FROM now WHERE resource_type = 'PractitionerRole'),
refs AS (SELECT practitioner_id, role_id, regexp_replace(l->>'$.reference', '/_history/[^/]*$', '') AS ref FROM (SELECT *, unnest(locs) AS l FROM roles)),
pairs AS (SELECT practitioner_id, role_id, str_split(ref, '/')[-1] AS location_id FROM refs WHERE len(str_split(ref, '/')) > 1 AND str_split(ref, '/')[-2] = 'Location' AND str_split(ref, '/')[-1] <> ''),
known AS (SELECT resource_id AS practitioner_id FROM now WHERE resource_type = 'Practitioner'),
mine AS (SELECT * FROM pairs WHERE practitioner_id IN (SELECT practitioner_id FROM known))
"""


@C.query(_ROLES + """SELECT 'practitioner' AS kind, count(*) FILTER (practitioner_id IN (SELECT practitioner_id FROM known)) AS hits, count(*) FILTER (practitioner_id NOT IN (SELECT practitioner_id FROM known)) AS misses FROM roles WHERE practitioner_id IS NOT NULL
UNION ALL SELECT 'location', count(*) FILTER (location_id IN (SELECT resource_id FROM now WHERE resource_type = 'Location')), count(*) FILTER (location_id NOT IN (SELECT resource_id FROM now WHERE resource_type = 'Location')) FROM pairs
UNION ALL SELECT 'organization', count(*) FILTER (organization_id IN (SELECT resource_id FROM now WHERE resource_type = 'Organization')), count(*) FILTER (organization_id NOT IN (SELECT resource_id FROM now WHERE resource_type = 'Organization')) FROM roles WHERE organization_id IS NOT NULL""")
def joi09_dereference(spark, d):
    return misses(resource_views(table(spark, d, "spool_resources")))


def snapshot(spark, d, run):
    rows = table(spark, d, "provider_snapshots").where(c("run_id") == run)
    return rows.groupBy("provider_id").agg(F.max_by(F.struct("specialty", "phone", "full_name", "practice_name"), F.struct("updated_date", "specialty", "phone", "full_name", "practice_name")).alias("r")).select("provider_id", "r.*")


_TOP = "(SELECT provider_id, specialty, phone, full_name, practice_name FROM (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY updated_date DESC, specialty DESC NULLS LAST, phone DESC NULLS LAST, full_name DESC NULLS LAST, practice_name DESC NULLS LAST) AS k FROM provider_snapshots WHERE run_id = {0}) WHERE k = 1)"


@C.query(f"""WITH a AS {_TOP.format(_BEFORE)}, b AS {_TOP.format(_LAST)}, j AS (SELECT coalesce(a.provider_id, b.provider_id) AS provider_id, a.provider_id IS NULL AS na, b.provider_id IS NULL AS nb, a.specialty AS s1, b.specialty AS s2, a.phone AS p1, b.phone AS p2 FROM a FULL JOIN b USING (provider_id))
SELECT provider_id, 'only_a' AS kind, NULL AS field, NULL AS in_a, NULL AS in_b FROM j WHERE nb UNION ALL SELECT provider_id, 'only_b', NULL, NULL, NULL FROM j WHERE na
UNION ALL SELECT provider_id, 'differs', 'specialty', s1, s2 FROM j WHERE NOT na AND NOT nb AND s1 IS DISTINCT FROM s2 UNION ALL SELECT provider_id, 'differs', 'phone', p1, p2 FROM j WHERE NOT na AND NOT nb AND p1 IS DISTINCT FROM p2""")
def joi10_diff(spark, d):
    return compare.diff(snapshot(spark, d, runs(spark, d)[-2]), snapshot(spark, d, runs(spark, d)[-1]), "provider_id", ["specialty", "phone"])


@C.query(f"""WITH n AS (SELECT website AS item, {_HKEY} AS key, arg_min(name, organization_id) AS raw FROM organizations WHERE website IS NOT NULL AND {_HKEY} <> '' GROUP BY ALL)
SELECT o.organization_id, n.key, n.raw FROM (SELECT organization_id, website AS item, {_HKEY} AS own FROM organizations WHERE website IS NOT NULL) o JOIN n USING (item) WHERE n.key <> o.own""")
def joi11_other_names(spark, d):
    orgs = table(spark, d, "organizations").where("website is not null").select("organization_id", c("website").alias("item"), "name", "state")
    names = lookup.alias_items(orgs, "item", "name", "state", "organization_id", tx.org_key(c("name")))
    own = orgs.select("organization_id", "item", tx.org_key(c("name")).alias("own"))
    return lookup.other_names(own, names.select("item", "key", "raw"), "item", "own").select("organization_id", "key", "raw")


@C.query("SELECT provider_id, CASE WHEN npi IS NOT NULL AND npi IN (SELECT npi FROM provider_snapshots WHERE run_id = " + _FIRST + " AND npi IS NOT NULL) THEN 'known' ELSE 'new' END AS side FROM providers")
def joi12_enrich_split(spark, d):
    fresh, known = lookup.split_known(table(spark, d, "providers").select("provider_id", "npi"), table(spark, d, "provider_snapshots").where(c("run_id") == runs(spark, d)[0]), "npi")
    return fresh.select("provider_id", F.lit("new").alias("side")).unionByName(known.select("provider_id", F.lit("known").alias("side")))


@C.query("""WITH p AS (SELECT phone, min(organization_id) AS i FROM organizations WHERE phone IS NOT NULL GROUP BY 1), w AS (SELECT normalized_name AS n, min(organization_id) AS i FROM organizations WHERE normalized_name IS NOT NULL GROUP BY 1)
SELECT hifld_id, coalesce(p.i, w.i) AS matched, coalesce(p.i <> w.i, false) AS conflict FROM (SELECT hifld_id, telephone AS phone, trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS n FROM hifld_hospitals) h LEFT JOIN p USING (phone) LEFT JOIN w USING (n)""")
def joi13_two_step(spark, d):
    orgs = table(spark, d, "organizations")
    by = lambda k: orgs.where(c(k).isNotNull()).groupBy(k).agg(F.min("organization_id").alias("organization_id"))
    known = by("phone").select("phone", F.lit(None).cast("string").alias("key"), "organization_id").unionByName(by("normalized_name").select(F.lit(None).cast("string").alias("phone"), c("normalized_name").alias("key"), "organization_id"))
    incoming = table(spark, d, "hifld_hospitals").select("hifld_id", c("telephone").alias("phone"), tx.org_key(c("name")).alias("key"))
    return lookup.two_step_match(incoming, known, "phone", "key", "organization_id").select("hifld_id", "matched", "conflict")


@C.query("SELECT run_id FROM (SELECT DISTINCT run_id FROM provider_snapshots) ORDER BY run_id DESC LIMIT 1 OFFSET 1")
def joi15_previous_run(spark, d):
    return table(spark, d, "provider_snapshots").select("run_id").distinct().orderBy(F.desc("run_id")).offset(1).limit(1)


@C.query("""SELECT min_by(full_name, provider_id) AS full_name, min_by(city, provider_id) AS city, count(*) AS n, string_agg(npi, ' | ' ORDER BY npi) AS npi_list FROM providers
GROUP BY lower(full_name), lower(coalesce(city, '')), coalesce(state, '') HAVING count(*) > 1""".replace("min_by(city, provider_id)", "arg_min_null(city, provider_id)").replace("min_by(full_name, provider_id)", "arg_min_null(full_name, provider_id)"))
def agg01_duplicates(spark, d):
    keys = {"k1": F.lower("full_name"), "k2": F.lower(F.coalesce("city", F.lit(""))), "k3": F.coalesce("state", F.lit(""))}
    return queues.duplicate_groups(table(spark, d, "providers"), keys, "provider_id", ["full_name", "city"], "npi")


@C.query("SELECT provider_type, count(*) AS n FROM providers GROUP BY 1")
def agg03_by_type(spark, d):
    return queues.counts_by(table(spark, d, "providers"), c("provider_type"), "provider_type").orderBy(F.desc("n"))


@C.query("SELECT organization_type, count(*) AS n FROM organizations GROUP BY 1")
def agg02_by_classification(spark, d):
    return queues.counts_by(table(spark, d, "organizations"), c("organization_type"), "organization_type").orderBy(F.desc("n"))


@C.query("SELECT lower(trim(site_confidence)) AS site_confidence, count(*) AS n FROM providers GROUP BY 1")
def agg04_by_confidence(spark, d):
    return queues.counts_by(table(spark, d, "providers"), F.lower(F.trim("site_confidence")), "site_confidence")


@C.query("SELECT coalesce(website_confidence, 'none') AS website_confidence, count(*) AS n FROM organizations GROUP BY 1")
def agg05_coverage(spark, d):
    return queues.counts_by(table(spark, d, "organizations"), F.coalesce("website_confidence", F.lit("none")), "website_confidence")


@C.query("SELECT count(*) AS total, count(*) FILTER (is_active = 1) AS active, count(*) FILTER (is_active = 0) AS inactive, count(*) FILTER (npi IS NULL) AS without_npi, count(*) FILTER (address IS NULL) AS without_address FROM providers")
def agg07_counts(spark, d):
    return queues.one_pass_counts(table(spark, d, "providers"), total=F.lit(True), active=c("is_active") == 1, inactive=c("is_active") == 0, without_npi=c("npi").isNull(), without_address=c("address").isNull())


@C.query("SELECT resource_type, count(*) AS n FROM spool_resources GROUP BY 1")
def agg08_by_resource(spark, d):
    return queues.counts_by(table(spark, d, "spool_resources"), c("resource_type"), "resource_type")


@C.query("SELECT DISTINCT practitioner_ref FROM spool_resources WHERE practitioner_ref IS NOT NULL")
def agg09_practitioner_refs(spark, d):
    return table(spark, d, "spool_resources").where("practitioner_ref is not null").select("practitioner_ref").distinct().orderBy("practitioner_ref")


@C.query(f"SELECT count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'error') AS error, count(*) FILTER (status = 'pending') AS pending FROM {_LEDGER}")
def agg10_progress(spark, d):
    return queues.one_pass_counts(ledger(spark, d), done=c("status") == "done", error=c("status") == "error", pending=c("status") == "pending")


@C.query(f"WITH s AS ({_SITES}) SELECT key, min(website) AS website FROM s GROUP BY key HAVING count(DISTINCT website) = 1")
def agg11_unambiguous_name(spark, d):
    return lookup.unambiguous(bundles.website_rows(table(spark, d, "organizations"), [c("name")], c("state"), c("website"), "va"), ["key"], "website")


@C.query(f"WITH s AS ({_SITES}) SELECT key, state, min(website) AS website FROM s WHERE state <> '' GROUP BY key, state HAVING count(DISTINCT website) = 1")
def agg11_unambiguous_name_state(spark, d):
    return lookup.unambiguous(bundles.website_rows(table(spark, d, "organizations"), [c("name")], c("state"), c("website"), "va"), ["key", "state"], "website")


@C.query(f"""WITH s AS (SELECT website AS item, min(state) AS lo, max(state) AS hi FROM organizations WHERE website IS NOT NULL GROUP BY 1)
SELECT website AS item, {_HKEY} AS key, arg_min(name, organization_id) AS raw, any_value(CASE WHEN s.lo = s.hi THEN s.lo END) AS state FROM organizations o JOIN s ON o.website = s.item WHERE {_HKEY} <> '' GROUP BY website, {_HKEY}""")
def agg12_alias_items(spark, d):
    orgs = table(spark, d, "organizations").where("website is not null").select("organization_id", c("website").alias("item"), "name", "state")
    return lookup.alias_items(orgs, "item", "name", "state", "organization_id", tx.org_key(c("name")))


@C.query(_ROLES + """, n AS (SELECT practitioner_id, location_id, count(*) AS n FROM mine GROUP BY ALL)
SELECT practitioner_id, first(location_id ORDER BY n DESC, location_id) AS "primary", max(n) AS times, count(*) AS choices FROM n GROUP BY practitioner_id""")
def agg13_primary_location(spark, d):
    return primary.primary_by_count(role_locations(resource_views(table(spark, d, "spool_resources"))), "practitioner_id", "location_id")


@C.query("SELECT l_orderkey AS owner, first(l_suppkey ORDER BY n DESC, l_suppkey) AS \"primary\", max(n) AS times, count(*) AS choices FROM (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1")
def agg13_primary_supplier(spark, d):
    return primary.primary_by_count(table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "owner"), "owner", "l_suppkey")


@C.query("SELECT l_orderkey AS owner, coalesce(min(CASE WHEN l_quantity > 40 THEN l_partkey END), min(l_partkey)) AS l_partkey FROM lineitem GROUP BY 1")
def agg14_first_holding(spark, d):
    return primary.first_holding(table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "owner"), "owner", "l_partkey", c("l_quantity") > 40)


@C.query("SELECT specialty, bool_or(accepting_new_patients) AS accepting FROM providers GROUP BY 1")
def agg15_tristate(spark, d):
    return table(spark, d, "providers").groupBy("specialty").agg(primary.any_true(c("accepting_new_patients")).alias("accepting"))


@C.query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def agg17_newest(spark, d):
    return primary.newest(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@C.query("SELECT count(*) AS seen, count(DISTINCT (resource_type, resource_id)) AS distinct_n, count(*) - count(DISTINCT (resource_type, resource_id)) AS duplicates FROM spool_resources WHERE resource_type IS NOT NULL AND resource_id IS NOT NULL")
def agg22_distinct_resources(spark, d):
    per = table(spark, d, "spool_resources").where("resource_type is not null and resource_id is not null").groupBy("resource_type", "resource_id").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("seen"), F.count("*").alias("distinct_n"), (F.sum("n") - F.count("*")).alias("duplicates"))


@C.query("WITH t AS (SELECT coalesce(specialty, 'none') AS reason FROM providers WHERE is_active = 0) SELECT reason, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, reason LIMIT 20")
def agg19_top_reasons(spark, d):
    return queues.top_reasons(table(spark, d, "providers").where("is_active = 0"), F.coalesce("specialty", F.lit("none")))


@C.query("SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM events GROUP BY 1")
def agg20_percent(spark, d):
    return queues.with_percent(queues.counts_by(table(spark, d, "events"), c("event_type"), "event_type"))


@C.query("SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def agg21_mean(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 4).alias("mean"))


@C.query("SELECT record_id, greatest(1, len(list_distinct(list_filter(list_transform(coalesce(locations, []), lambda l: l.address_key), lambda k: k IS NOT NULL))))::INT AS sites FROM normalized_providers")
def agg23_site_count(spark, d):
    return table(spark, d, "normalized_providers").select("record_id", primary.site_count(c("locations.address_key")).alias("sites"))


@C.query("SELECT provider_id, run_id FROM (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY run_id) AS k FROM (SELECT DISTINCT provider_id, run_id FROM provider_snapshots)) WHERE k = 1")
def win01_first_seen(spark, d):
    return table(spark, d, "provider_snapshots").groupBy("provider_id").agg(F.min("run_id").alias("run_id"))


@C.query("SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_suppkey = m THEN 0 ELSE 1 END, l_suppkey) AS rank FROM (SELECT DISTINCT l_orderkey, l_suppkey, max(l_suppkey) OVER (PARTITION BY l_orderkey) AS m FROM lineitem)")
def win02_primary_first(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return primary.primary_first(rows.withColumn("m", F.max("l_suppkey").over(Window.partitionBy("l_orderkey"))), "l_orderkey", c("l_suppkey") == c("m"), "l_suppkey").drop("m")


@C.query(f"""WITH e AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) AS k FROM events), s AS (SELECT * FROM e WHERE k = 1 OR b IS DISTINCT FROM event_type)
SELECT user_id, event_type, {_TS.format('ts')} AS valid_from, coalesce({_TS.format("lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type)")}, 'open') AS valid_to FROM s""")
def win04_scd2(spark, d):
    from rosterlake.operators.merge import membership_history

    h = membership_history(table(spark, d, "events").select("user_id", "event_type", "ts"), "user_id", "event_type", "ts")
    return h.select("user_id", "event_type", stamp("valid_from").alias("valid_from"), F.coalesce(stamp("valid_to"), F.lit("open")).alias("valid_to"))


@C.query("""WITH r AS (SELECT user_id, event_type, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events)
SELECT user_id, run::BIGINT AS run, count(*) AS failures FROM r WHERE event_type = 'error' GROUP BY ALL HAVING count(*) >= 2""")
def win06_breaker(spark, d):
    return primary.failure_runs(table(spark, d, "events"), "user_id", ["ts", "event_id"], c("event_type") == "error", 2)


@C.query("""WITH n AS (SELECT system_id, doc_id, regexp_extract_all(text, '[0-9]{4,}') AS ns FROM documents WHERE system_id IS NOT NULL)
SELECT doc_id, coalesce(list_has_any(ns, lag(ns) OVER (PARTITION BY system_id ORDER BY doc_id)), false) AS repeats FROM n""")
def win07_overlap(spark, d):
    rows = table(spark, d, "documents").where("system_id is not null").select("system_id", "doc_id", F.regexp_extract_all("text", F.lit("[0-9]{4,}"), F.lit(0)).alias("ns"))
    return primary.overlap_with_previous(rows, "system_id", "doc_id", "ns").select("doc_id", "repeats")


@C.query("SELECT run_id, count(*) AS n FROM provider_snapshots GROUP BY 1 ORDER BY run_id DESC LIMIT 5")
def srt01_recent_runs(spark, d):
    return queues.counts_by(table(spark, d, "provider_snapshots"), c("run_id"), "run_id").orderBy(F.desc("run_id")).limit(5)


@C.query("SELECT organization_id, state, name FROM organizations ORDER BY state NULLS FIRST, name, organization_id LIMIT 100 OFFSET 100")
def srt10_page(spark, d):
    return queues.page(table(spark, d, "organizations"), ["state", "name", "organization_id"], 1, 100).select("organization_id", "state", "name")


@C.query(f"""SELECT provider_id, CASE WHEN bool_or(s = 1) AND bool_or(s = 2) THEN 'both' WHEN bool_or(s = 1) THEN 'a' ELSE 'b' END AS side FROM
(SELECT provider_id, 1 AS s FROM provider_snapshots WHERE run_id = {_BEFORE} UNION ALL SELECT provider_id, 2 FROM provider_snapshots WHERE run_id = {_LAST}) GROUP BY 1""")
def set01_key_sets(spark, d):
    rows = table(spark, d, "provider_snapshots")
    ids = runs(spark, d)
    return compare.key_sets(rows.where(c("run_id") == ids[-2]), rows.where(c("run_id") == ids[-1]), "provider_id")


@C.query("""WITH a AS (SELECT system_id, list(DISTINCT source) AS l FROM documents WHERE lang = 'en' AND system_id IS NOT NULL AND source IS NOT NULL GROUP BY 1), b AS (SELECT system_id, list(DISTINCT source) AS l FROM documents WHERE lang = 'es' AND system_id IS NOT NULL AND source IS NOT NULL GROUP BY 1)
SELECT system_id, array_to_string(list_sort(list_filter(a.l, lambda x: NOT list_contains(b.l, x))), ',') AS missing FROM a JOIN b USING (system_id) WHERE len(list_filter(a.l, lambda x: NOT list_contains(b.l, x))) > 0""")
def set02_missing_keys(spark, d):
    docs = table(spark, d, "documents").where("system_id is not null and source is not null")
    # A set is as long as the list of sources.
    side = lambda lang: docs.where(c("lang") == lang).groupBy("system_id").agg(F.collect_set("source").alias("l"))
    return compare.missing_keys(side("en"), side("es"), "system_id", "l", "l").select("system_id", F.array_join("missing", ",").alias("missing"))


@C.query("""SELECT provider_id, coalesce(list_has_any(list_distinct(regexp_split_to_array(upper(coalesce(credentials, '')), '[,\\s/]+')), ['MD', 'DO']), false) AS physician FROM providers""")
def set03_credentials(spark, d):
    return table(spark, d, "providers").select("provider_id", F.arrays_overlap(tx.credential_tokens(c("credentials")), F.array(F.lit("MD"), F.lit("DO"))).alias("physician"))


@C.query(f"SELECT DISTINCT hifld_id, key FROM (SELECT hifld_id, {_HKEY} AS key FROM hifld_hospitals UNION ALL SELECT hifld_id, trim(regexp_replace(lower(alt_name), '\\s+', ' ', 'g')) FROM hifld_hospitals WHERE lower(trim(alt_name)) NOT IN ('not available','no website','n/a','na','none','-','')) WHERE key <> ''")
def set04_name_keys(spark, d):
    keys = F.array_distinct(F.array_compact(F.array(tx.org_key(c("name")), tx.org_key(tx.without_placeholder(c("alt_name"), "hifld")))))
    return table(spark, d, "hifld_hospitals").select("hifld_id", F.explode(keys).alias("key")).where("key <> ''")


@C.query("SELECT 'snapshot' AS origin, count(*) AS n FROM provider_snapshots UNION ALL SELECT 'current', count(*) FROM providers")
def set05_union(spark, d):
    a = table(spark, d, "provider_snapshots").select(F.lit("snapshot").alias("origin"), "provider_id")
    return a.unionByName(table(spark, d, "providers").select(F.lit("current").alias("origin"), "provider_id")).groupBy("origin").agg(F.count("*").alias("n"))


_FLAG = _ROLES + """, n AS (SELECT practitioner_id, location_id, count(*) AS n FROM mine GROUP BY ALL),
p AS (SELECT practitioner_id, first(location_id ORDER BY n DESC, location_id) AS main, count(*) AS sites FROM n GROUP BY 1),
o AS (SELECT DISTINCT practitioner_id FROM roles WHERE practitioner_id IN (SELECT practitioner_id FROM known))
SELECT o.practitioner_id, p.main AS primary_location, coalesce(p.sites, 1) AS location_count, CASE WHEN coalesce(p.sites, 1) > 3 THEN 'low' WHEN coalesce(p.sites, 1) > 1 THEN 'medium' ELSE 'high' END AS site_confidence FROM o LEFT JOIN p USING (practitioner_id)"""


@C.query(_FLAG)
def flagship_primary_site(spark, d):
    """Where each practitioner primarily practises, at how many places, and how far that can be trusted."""
    records = normalized(resource_views(table(spark, d, "spool_resources")))
    trust = rules.site_confidence(c("location_count"), F.lit(True), F.lit(None).cast("boolean"), F.lit("high"))
    return records.select("practitioner_id", "primary_location", "location_count", trust.alias("site_confidence"))


QUERIES, ORACLE = C.queries, C.sql
