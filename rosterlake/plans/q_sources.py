"""Queries of sources, sinks, resource fields, ledgers and extension points.

Landed answers of interfaces are made of the tables' rows here, read by the
operators, and compared with SQL over the rows themselves.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import functions as F

from rosterlake.functions import fhir
from rosterlake.functions import text as tx
from rosterlake.operators import compare, merge, queues, rules
from rosterlake.plans import cascade, commands, ingest, reports
from rosterlake.plans.catalog import Catalog
from rosterlake.plans.q_relational import _HKEY, _ROLES, _TS, ledger, runs, stamp
from rosterlake.plans.q_state import _MERGE, NOW, _upsert
from rosterlake.session import scratch, table
from rosterlake.sources import adapters, bundles, files, seeds
from rosterlake.streaming import ledger as lg

C = Catalog()
c = F.col


def _folder(spark, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid4().hex}"


def _values(rows: list[tuple], names: str) -> str:
    quoted = ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, (int, bool)) else "'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {quoted}) AS t({names})"


# Files

_CMS = lambda x: f"CASE WHEN lower(trim({x})) NOT IN ('', 'not available') THEN trim({x}) END"
_CSV_SQL = f"SELECT {_CMS('CAST(organization_id AS VARCHAR)')} AS source_id, {', '.join(f'{_CMS(x)} AS {x}' for x in ('name', 'address', 'city', 'state', 'zip', 'phone'))} FROM organizations WHERE {_CMS('name')} IS NOT NULL"


def _hospital_file(spark, d) -> str:
    path, rows = _folder(spark, "hospitals"), table(spark, d, "organizations")
    rows.select(*[c("organization_id" if n == "source_id" else n).cast("string").alias(h) for h, n in files.HOSPITAL_COLUMNS.items()]).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@C.query(_CSV_SQL)
def src01_csv(spark, d):
    read = files.hospitals_from_csv(files.read_csv(spark, _hospital_file(spark, d)))
    return read.select("source_id", "name", "address", "city", "state", "zip", "phone")


@C.query(_CSV_SQL.replace("SELECT ", "SELECT 'CMS' AS source, ", 1))
def udf02_organization_adapter(spark, d):
    a = adapters.ORGANIZATIONS.get("hospital-file")
    return a.normalize(a.read(spark, _hospital_file(spark, d))).select("source", "source_id", "name", "address", "city", "state", "zip", "phone")


@C.query("SELECT 'https://' || primary_domain || '/hospitals.csv' AS url FROM health_systems WHERE primary_domain IS NOT NULL ORDER BY system_id LIMIT 1")
def src02_current_download(spark, d):
    """The metadata list is as long as the table of health systems, which is fixed."""
    listed = table(spark, d, "health_systems").orderBy("system_id").select("primary_domain").collect()
    meta = {"distribution": [{"downloadURL": f"https://{r[0]}/hospitals.csv"} if r[0] else {"accessURL": "x"} for r in listed]}
    return spark.createDataFrame([(files.current_download(json.dumps(meta)),)], "url string")


@C.query("SELECT name, website FROM organizations WHERE website IS NOT NULL UNION ALL SELECT NULL, NULL WHERE false")
def src21_cache_or_empty(spark, d):
    path = _folder(spark, "cache")
    good = table(spark, d, "organizations").where("website is not null").select(F.to_json(F.struct("name", "website")).alias("value"))
    good.unionByName(spark.createDataFrame([('{"name": "broken',)], "value string")).write.text(path)
    schema = "name string, website string"
    return files.read_json_or_empty(spark, path, schema).unionByName(files.read_json_or_empty(spark, f"{path}-none", schema))


@C.query("SELECT doc_id, CASE WHEN lang = 'en' THEN true WHEN lang = 'es' THEN false END AS ok FROM documents WHERE text IS NOT NULL")
def src23_verified(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select(c("doc_id").alias("path"), F.md5("text").alias("md5"), "lang")
    wanted = docs.where("lang in ('en', 'es')").select("path", F.when(c("lang") == "en", F.upper("md5")).otherwise("0").alias("md5"))
    return files.verified(docs.drop("lang"), wanted).select(c("path").alias("doc_id"), "ok")


@C.query("""WITH t AS (SELECT sha256(url) AS key, doc_id, fetched_at, (SELECT max(fetched_at) FROM documents) AS now FROM documents WHERE url IS NOT NULL)
SELECT key, arg_max(doc_id, (fetched_at, doc_id)) AS doc_id FROM t WHERE fetched_at >= date_trunc('second', now) - INTERVAL 2400 HOUR GROUP BY key""")
def src28_cached(spark, d):
    docs = table(spark, d, "documents").where("url is not null").groupBy("url", "fetched_at").agg(F.max("doc_id").alias("doc_id"))
    now = table(spark, d, "documents").agg(F.date_format(F.max("fetched_at"), "yyyy-MM-dd HH:mm:ss")).first()[0] or "2024-01-01 00:00:00"
    return files.cached(docs, now, 2400).select("key", "doc_id")


@C.query(_values([(i + 1, n) for i, n in enumerate(("NPPES", "CMS", "Site Directory", "Manual Review"))], "id, name") + " UNION ALL " + _values([(1, "ascension.org"), (2, "mercy.net"), (3, "bswhealth.com"), (4, "balladhealth.org"), (5, "brownhealth.org"), (6, "tghnorth.org")], "id, name"))
def src31_seeds(spark, d):
    return seeds.sources(spark).select(c("source_id").cast("int").alias("id"), "name").unionByName(seeds.health_systems(spark).select(c("system_id").cast("int").alias("id"), c("primary_domain").alias("name")))


_SETTINGS = "data:\n  dir: in  # where\n  checks: [a, 'b: c']\nnpi:\n  checksum: \"strict\"\n  require: yes\nattempts: 5\n"


@C.query(_values([("attempts", "5"), ("data.checks.0", "a"), ("data.checks.1", "b: c"), ("data.dir", "in"), ("npi.checksum", "strict"), ("npi.require", "yes")], "key, value"))
def src32_settings(spark, d):
    return spark.createDataFrame(sorted(seeds.flattened(seeds.read_sections(_SETTINGS)).items()), "key string, value string")


# Bundles and other landed answers

_GOOD = "regexp_matches(body, '^\\{.*\\}$', 's') AND json_valid(body)"
_BODIES = f"WITH b AS (SELECT spool_seq, spool_seq // 100 AS page, CASE WHEN {_GOOD} THEN body::JSON END AS j FROM spool_resources WHERE body IS NOT NULL), r AS (SELECT page, spool_seq, j->>'resourceType' AS resource_type, j->>'id' AS resource_id FROM b WHERE j IS NOT NULL) "


def _bundles(spark, d):
    """Pages of a hundred arrivals each, as bundles."""
    good = table(spark, d, "spool_resources").where(c("body").rlike(r"(?s)^\{.*\}$") & F.try_parse_json("body").isNotNull()).withColumn("page", F.floor(c("spool_seq") / 100))
    entries = F.array_join(F.collect_list(F.concat(F.lit('{"resource":'), "body", F.lit("}"))), ",")
    head = F.concat(F.lit('{"resourceType":"Bundle","link":[{"relation":"self","url":"s"},{"relation":"next","url":"p'), (c("page") + 1).cast("string"), F.lit('"}],"entry":['))
    return good.groupBy("page").agg(entries.alias("e")).select("page", F.concat(head, "e", F.lit("]}")).alias("body"))


@C.query(_BODIES + "SELECT page, resource_id FROM r WHERE resource_type = 'Location' AND resource_id IS NOT NULL")
def src03_locations(spark, d):
    return bundles.bundle_resources(_bundles(spark, d)).where("resource_type = 'Location'").select("page", "resource_id")


@C.query(_BODIES + "SELECT DISTINCT page, 'ok' AS status, 'p' || (page + 1) AS next_url FROM r")
def jsn02_next_link(spark, d):
    return bundles.bundle_status(_bundles(spark, d))


@C.query(_BODIES + "SELECT page, resource_type, resource_id, 'match' AS mode FROM r WHERE resource_type = 'PractitionerRole' AND resource_id IS NOT NULL UNION ALL SELECT min(page), resource_type, resource_id, 'include' FROM r WHERE resource_type <> 'PractitionerRole' AND resource_id IS NOT NULL GROUP BY resource_type, resource_id")
def src05_includes(spark, d):
    return bundles.split_includes(_bundles(spark, d), "PractitionerRole")


_LANDED_SQL = """WITH q AS (SELECT provider_id AS n, 'u' || npi AS url FROM providers WHERE npi IS NOT NULL), l AS (SELECT 'u' || npi AS url, min(provider_id) AS i, bool_or(is_active = 1) AS good, bool_and(is_active = 1) AND min(provider_id) % 3 = 0 AS bare FROM providers WHERE npi IS NOT NULL AND state IS NOT NULL GROUP BY npi)
SELECT n, CASE WHEN l.url IS NULL THEN 'missing' WHEN NOT good THEN 'failed' WHEN i % 3 = 0 THEN 'silent_empty' ELSE 'ok' END AS status FROM q LEFT JOIN l USING (url)"""


@C.query(_LANDED_SQL)
def src04_one_request_each(spark, d):
    """Also SRC07 (answers in the order of requests, failures as values) and SRC30 (offline answers by address)."""
    rows = table(spark, d, "providers").where("npi is not null")
    requests = rows.select(c("provider_id").alias("n"), F.concat(F.lit("u"), "npi").alias("url"))
    total = F.concat(F.lit('{"total": '), F.when(F.min("provider_id") % 3 == 0, "0").otherwise("2"), F.lit("}"))
    landed = rows.where("state is not null").groupBy(F.concat(F.lit("u"), "npi").alias("url")).agg(F.when(F.bool_or(c("is_active") == 1), 200).otherwise(500).alias("status"), total.alias("body"))
    return bundles.landed_answers(requests, landed).select("n", "status")


@C.query("SELECT spool_seq FROM spool_resources WHERE spooled_at >= (SELECT date_trunc('day', min(spooled_at)) + INTERVAL 1 DAY FROM spool_resources) AND spooled_at <= (SELECT date_trunc('day', max(spooled_at)) FROM spool_resources)")
def src06_window(spark, d):
    rows = table(spark, d, "spool_resources")
    lo, hi = rows.agg(F.date_format(F.date_trunc("day", F.min("spooled_at")) + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"), F.date_format(F.date_trunc("day", F.max("spooled_at")), "yyyy-MM-dd HH:mm:ss")).first()
    return bundles.in_window(rows.withColumn("at", c("spooled_at").cast("timestamp")), "at", lo, hi).select("spool_seq")


@C.query("""WITH a AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'silent_empty' ELSE 'ok' END AS status, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
e AS (SELECT user_id, min(k) FILTER (status = 'ok') AS first, count(*) AS n, arg_max(status, k) AS last FROM a WHERE k <= 4 GROUP BY 1)
SELECT user_id, CASE WHEN first IS NOT NULL THEN 'ok' ELSE last END AS status, coalesce(first, n)::INT AS tries, CASE coalesce(first, n) WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 ELSE 6.0 END::DOUBLE AS waited FROM e""")
def src08_retries(spark, d):
    kind = F.when(c("event_type") == "error", "failed").when(c("event_type") == "view", "silent_empty").otherwise("ok")
    return bundles.settled(table(spark, d, "events").select("user_id", "event_id", kind.alias("status")), "user_id", "event_id", 4, 1.0, 3.0)


@C.query("SELECT p.provider_id, r.enumeration FROM providers p LEFT JOIN (SELECT npi, max(nppes_enumeration) AS enumeration FROM providers WHERE is_active = 1 AND npi IS NOT NULL GROUP BY 1) r USING (npi)")
def src09_registry_lookup(spark, d):
    rows = table(spark, d, "providers")
    registry = rows.where("is_active = 1 and npi is not null").groupBy("npi").agg(F.max("nppes_enumeration").alias("enumeration"))
    return rows.select("provider_id", "npi").join(registry, "npi", "left").select("provider_id", "enumeration")


def _sitemaps(spark, d):
    urls = table(spark, d, "providers").where("profile_url is not null").select("profile_url", F.concat(F.lit("m"), c("provider_id") % 50).alias("url"))
    loc = lambda x: F.array_join(F.transform(F.collect_set(x), lambda u: F.concat(F.lit("<loc>"), u, F.lit("</loc>"))), "")
    maps = urls.groupBy("url").agg(F.concat(F.lit("<urlset>"), loc("profile_url"), F.lit("</urlset>")).alias("body"))
    root = urls.agg(F.concat(F.lit("<sitemapindex><loc>root</loc>"), loc("url"), F.lit("</sitemapindex>")).alias("body")).select(F.lit("root").alias("url"), "body")
    return maps.unionByName(root), spark.createDataFrame([("root",)], "url string")


@C.query("SELECT DISTINCT profile_url AS url FROM providers WHERE profile_url IS NOT NULL")
def src10_sitemaps(spark, d):
    return bundles.crawl_sitemaps(*_sitemaps(spark, d))


@C.query("SELECT 'sitemap' AS way, count(DISTINCT profile_url) AS n FROM providers WHERE profile_url IS NOT NULL")
def src14_discover(spark, d):
    """Also UDF05 and UDF06: ways to discover, given their landed tables."""
    maps, starts = _sitemaps(spark, d)
    way, urls = adapters.discover({"sitemaps": maps, "starts": starts})
    return urls.agg(F.count("*").alias("n")).select(F.lit(way).alias("way"), "n")


@C.query("SELECT provider_id // 50 AS page, CAST(provider_id AS VARCHAR) AS id, profile_url AS path FROM providers WHERE profile_url IS NOT NULL")
def src11_collection(spark, d):
    rows = table(spark, d, "providers").where("profile_url is not null")
    item = F.to_json(F.struct(F.lit("node--provider").alias("type"), c("provider_id").cast("string").alias("id"), F.struct(F.struct(c("profile_url").alias("alias")).alias("path")).alias("attributes")))
    pages = rows.groupBy(F.floor(c("provider_id") / 50).alias("page")).agg(F.concat(F.lit('{"links":{"next":{"href":"n"}},"data":[{"type":"node--other"},'), F.array_join(F.collect_list(item), ","), F.lit("]}")).alias("body"))
    return bundles.jsonapi_rows(pages, "node--provider").select("page", "id", "path")


def _listing(spark, d):
    """Twenty links a page; pages 10 to 12 of each listing are empty, and 12 repeats."""
    rows = table(spark, d, "providers").where("profile_url is not null").select((c("provider_id") % 40).alias("listing"), F.floor(c("provider_id") / 40).alias("page"), F.concat(F.lit("/p/"), "provider_id").alias("u"))
    html = F.array_join(F.transform(F.array_sort(F.collect_list("u")), lambda u: F.concat(F.lit('<a href="'), u, F.lit('">'))), "")
    full = rows.withColumn("page", F.floor(c("page") / 20)).groupBy("listing", "page").agg(html.alias("html"))
    return full.withColumn("page", F.when(c("page") >= 3, c("page") + 2).otherwise(c("page"))).unionByName(full.select("listing").distinct().select("listing", F.explode(F.array(F.lit(3).cast("long"), F.lit(4).cast("long"))).alias("page"), F.lit("").alias("html")))


_LISTED = "SELECT DISTINCT {0} FROM providers WHERE profile_url IS NOT NULL AND provider_id // 800 < 3"


@C.query(_LISTED.format("'https://h.example/p/' || provider_id AS url"))
def src13_listing(spark, d):
    return bundles.listing_links(_listing(spark, d), r"/p/\d+", "https://h.example/")


@C.query(_LISTED.format("'/p/' || provider_id AS link"))
def src12_answers(spark, d):
    answers = _listing(spark, d).select("listing", c("page"), F.to_json(F.array(F.struct(F.lit("insert").alias("command"), c("html").alias("data")))).alias("body"))
    links = bundles.ajax_links(answers.withColumn("page", F.struct("listing", "page")), r"/p/\d+").select("page.listing", "page.page", "links")
    return bundles.until_idle(links, "listing", "page", "links").select(F.explode("links").alias("link")).distinct()


_HIFLD = lambda x: f"CASE WHEN lower(trim({x})) NOT IN ('', 'n/a', 'na', 'none', '-') THEN trim({x}) END"


@C.query(f"SELECT hifld_id, name, {_HIFLD('alt_name')} AS alt_name FROM hifld_hospitals")
def src17_sparql(spark, d):
    """Also JSN09: the accessor of a binding's value."""
    value = lambda x: F.when(c(x).isNotNull(), F.struct(F.lit("literal").alias("type"), c(x).cast("string").alias("value")))
    rows = table(spark, d, "hifld_hospitals").select((c("hifld_id") % 20).alias("page"), F.to_json(F.struct(value("hifld_id").alias("id"), value("name").alias("name"), value("alt_name").alias("alt"))).alias("b"))
    answers = rows.groupBy("page").agg(F.concat(F.lit('{"results":{"bindings":['), F.array_join(F.collect_list("b"), ","), F.lit("]}}")).alias("body"))
    read = bundles.sparql_rows(answers, ["id", "name", "alt"])
    return read.select(c("id").cast("long").alias("hifld_id"), "name", tx.without_placeholder(c("alt"), "osm").alias("alt_name"))


@C.query(f"""WITH n AS (SELECT website AS item, {_HKEY} AS key, arg_min(name, organization_id) AS raw FROM organizations WHERE website IS NOT NULL AND {_HKEY} <> '' GROUP BY ALL) SELECT item, key, raw FROM n""")
def src18_aliases(spark, d):
    from rosterlake.operators.lookup import alias_items

    rows = table(spark, d, "organizations").where("website is not null")
    value = lambda x: F.struct(c(x).cast("string").alias("value"))
    b = rows.select((c("organization_id") % 20).alias("page"), F.to_json(F.struct(value("website").alias("item"), value("name").alias("name"), value("state").alias("state"), value("organization_id").alias("seq"))).alias("b"))
    answers = b.groupBy("page").agg(F.concat(F.lit('{"results":{"bindings":['), F.array_join(F.collect_list("b"), ","), F.lit("]}}")).alias("body"))
    read = bundles.sparql_rows(answers, ["item", "name", "state", "seq"]).withColumn("seq", c("seq").cast("long"))
    return alias_items(read, "item", "name", "state", "seq", tx.org_key(c("name"))).select("item", "key", "raw")


_ARC = lambda x: f"CASE WHEN lower(trim({x})) NOT IN ('not available', 'no website', 'n/a', 'na', 'none', '-', '') THEN trim({x}) END"


@C.query(f"""WITH h AS (SELECT {_ARC('name')} AS name, {_ARC('alt_name')} AS alt, upper(trim(state)) AS state, {_ARC('website')} AS website FROM hifld_hospitals),
k AS (SELECT DISTINCT * FROM (SELECT row_number() OVER () AS i, *, unnest([trim(regexp_replace(lower(name), '\\s+', ' ', 'g')), trim(regexp_replace(lower(alt), '\\s+', ' ', 'g'))]) AS key FROM h)) SELECT key, state, website FROM k WHERE key <> '' AND website IS NOT NULL""")
def src19_features(spark, d):
    f = F.to_json(F.struct(F.struct(c("name").alias("NAME"), c("alt_name").alias("ALT_NAME"), c("state").alias("STATE"), c("website").alias("WEBSITE")).alias("attributes")))
    pages = table(spark, d, "hifld_hospitals").groupBy(F.floor(c("hifld_id") / 2000).alias("offset")).agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list(f), ","), F.lit("]}")).alias("body"))
    return bundles.arcgis_index(bundles.feature_rows(pages, ["NAME", "ALT_NAME", "STATE", "WEBSITE"]))


@C.query(f"SELECT {_HKEY} AS key, upper(trim(state)) AS state, trim(website) AS website FROM organizations WHERE organization_type = 'hospital' AND trim(website) <> '' AND {_HKEY} <> ''")
def src20_classified(spark, d):
    f = F.to_json(F.struct(F.struct("name", "website", "state", c("organization_type").alias("classification")).alias("attributes")))
    pages = table(spark, d, "organizations").groupBy("state", F.floor(c("organization_id") / 500).alias("page")).agg(F.concat(F.lit('{"data":['), F.array_join(F.collect_list(f), ","), F.lit("]}")).alias("body"))
    return bundles.va_index(bundles.feature_rows(pages, ["name", "website", "state", "classification"]), "hospital")


def _tags(spark, d):
    kind = F.when(c("organization_type") == "hospital", "hospital").otherwise("clinic")
    odd, tag = c("organization_id") % 2 == 1, lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    pairs = F.filter(F.array(tag(F.when(odd, "amenity").otherwise("healthcare"), kind), tag(F.lit("name"), c("name")), tag(F.when(odd, "website").otherwise("contact:website"), c("website"))), lambda x: x["value"].isNotNull())
    return table(spark, d, "organizations").select("organization_id", F.map_from_entries(pairs).alias("tags"))


_OSM_SQL = "SELECT name, website FROM organizations WHERE organization_type = 'hospital' AND website IS NOT NULL"


@C.query(_OSM_SQL)
def src22_map_elements(spark, d):
    return bundles.osm_elements(_tags(spark, d)).select("name", "website")


@C.query(_OSM_SQL)
def src24_map_query(spark, d):
    pages = _tags(spark, d).groupBy((c("organization_id") % 20).alias("page")).agg(F.concat(F.lit('{"elements":['), F.array_join(F.collect_list(F.to_json(F.struct("tags"))), ","), F.lit("]}")).alias("body"))
    return bundles.osm_elements(bundles.overpass_elements(pages)).select("name", "website")


@C.query("SELECT organization_id, CASE WHEN website IN (SELECT website FROM organizations WHERE website_confidence = 'high' AND website IS NOT NULL) THEN 'page' END AS page FROM organizations WHERE website IS NOT NULL")
def src25_reachable(spark, d):
    """Also UDF07: what answers is a table given by the caller."""
    orgs = table(spark, d, "organizations").where("website is not null")
    probes = orgs.select(c("website").alias("url"), F.when(c("website_confidence") == "high", 200).otherwise(404).alias("status"), F.lit("page").alias("html"))
    return bundles.reachable(orgs.select("organization_id", c("website").alias("url")), probes).select("organization_id", "page")


@C.query(r"""SELECT spool_seq, CASE WHEN spool_seq % 5 > 0 THEN CASE WHEN regexp_matches(h, '^[{\[]') THEN 'json' WHEN starts_with(h, '<?xml') OR starts_with(h, '<urlset') OR starts_with(h, '<sitemapindex') THEN 'xml' WHEN starts_with(h, '<') THEN 'html' ELSE 'other' END END AS kind FROM (SELECT spool_seq, lower(ltrim(substr(body, 1, 500))) AS h FROM spool_resources)""")
def src26_probes(spark, d):
    answers = table(spark, d, "spool_resources").select(c("spool_seq").alias("url"), F.when(c("spool_seq") % 5 > 0, 200).otherwise(404).alias("status"), "body")
    return bundles.probe_kinds(answers).select(c("url").alias("spool_seq"), "kind")


@C.query(r"""WITH u AS (SELECT doc_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path FROM documents WHERE url IS NOT NULL)
SELECT doc_id, NOT (length(host) % 2 = 0 AND starts_with(path, '/p')) AS allowed, CASE WHEN length(host) % 2 = 0 THEN 2.5 END::DOUBLE AS delay FROM u""")
def src27_robots(spark, d):
    urls = table(spark, d, "documents").where("url is not null").select("doc_id", "url")
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    robots = urls.select(host.alias("host")).where("length(host) % 2 = 0").distinct().select("host", F.lit("User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /p\nCrawl-delay: 2.5\n\nUser-agent: x\nDisallow: /q\n").alias("body"))
    return bundles.permitted(urls, robots).select("doc_id", "allowed", "delay")


# Fields of resources, from resources made of listings


def _practitioner(spark, d):
    text = lambda **kv: F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in kv.items()])
    takes = F.when(c("accepting_new_patients"), "newpt").when(~c("accepting_new_patients"), "nopt").otherwise("other")
    body = F.struct(
        F.array(F.struct(F.array("first_name").alias("given"), c("last_name").alias("family"), F.array("credentials").alias("suffix"))).alias("name"), F.array(text(system="http://local", value="1"), text(system="http://us-npi", value=c("npi"))).alias("identifier"),
        F.array(text(system="fax", value="0"), text(system="phone", value=c("phone"))).alias("telecom"), F.struct(F.array("address", F.lit("Suite 1")).alias("line")).alias("address"),
        F.transform("languages", lambda x: F.struct(F.array(F.struct(x.alias("display"))).alias("coding"))).alias("communication"),
        F.array(F.struct(F.array(text(system="http://local", code="0", display=c("specialty")), text(system="http://nucc.org/p", code=c("taxonomy_code"), display=c("taxonomy_desc"))).alias("coding"))).alias("specialty"),
        F.array(F.struct(F.lit("http://x/newpatients").alias("url"), F.array(F.struct(F.lit("acceptingPatients").alias("url"), F.struct(F.array(F.struct(takes.alias("code"))).alias("coding")).alias("valueCodeableConcept"))).alias("extension"))).alias("extension"),
    )
    return table(spark, d, "providers").select("provider_id", F.parse_json(F.to_json(body)).alias("v"))


@C.query("SELECT provider_id, array_to_string(list_filter(coalesce(languages, []), lambda x: x IS NOT NULL), ', ') AS languages FROM providers")
def jsn03_languages(spark, d):
    return _practitioner(spark, d).select("provider_id", F.array_join(fhir.languages(c("v")), ", ").alias("languages"))


@C.query("SELECT provider_id, taxonomy_code AS code, taxonomy_desc AS display FROM providers")
def jsn04_specialty(spark, d):
    k = fhir.preferred_coding(fhir.items(c("v"), "$.specialty"), "nucc.org")
    return _practitioner(spark, d).select("provider_id", k["code"].alias("code"), k["display"].alias("display"))


@C.query("SELECT provider_id, accepting_new_patients AS accepting FROM providers")
def jsn05_accepting(spark, d):
    return _practitioner(spark, d).select("provider_id", fhir.accepting_new_patients(c("v")).alias("accepting"))


@C.query("SELECT provider_id, nullif(npi, '') AS npi FROM providers")
def jsn06_identifier(spark, d):
    return _practitioner(spark, d).select("provider_id", fhir.identifier(c("v"), "us-npi").alias("npi"))


@C.query("SELECT provider_id, phone, concat_ws(', ', address, 'Suite 1') AS address FROM providers")
def jsn07_contact(spark, d):
    return _practitioner(spark, d).select("provider_id", fhir.contact(c("v"), "phone").alias("phone"), fhir.address_line(c("v")).alias("address"))


@C.query("SELECT provider_id, nullif(trim(concat_ws(' ', coalesce(first_name, ''), last_name)), '') AS name, nullif(trim(credentials), '') AS suffix FROM providers")
def str23_resource_name(spark, d):
    return _practitioner(spark, d).select("provider_id", fhir.person_name(c("v")).alias("name"), fhir.person_suffix(c("v")).alias("suffix"))


@C.query("SELECT npi AS number, CASE WHEN is_active = 1 THEN taxonomy_desc ELSE specialty END AS taxonomy_desc FROM providers WHERE npi IS NOT NULL")
def jsn08_taxonomy(spark, d):
    """The primary one counts even without a description; inactive rows have none that is primary."""
    one = F.struct(c("npi").alias("number"), F.array(F.struct(F.lit("a").alias("code"), c("specialty").alias("desc"), F.lit(False).alias("primary")), F.struct(c("taxonomy_code").alias("code"), c("taxonomy_desc").alias("desc"), (c("is_active") == 1).alias("primary"))).alias("taxonomies"))
    answers = table(spark, d, "providers").where("npi is not null").select(F.to_json(F.struct(F.array(one).alias("results"))).alias("body"))
    return bundles.taxonomy_rows(answers).select("number", "taxonomy_desc")


@C.query(_ROLES + """, l AS (SELECT DISTINCT practitioner_id, location_id FROM mine WHERE location_id IN (SELECT resource_id FROM now WHERE resource_type = 'Location')), n AS (SELECT practitioner_id, count(*) AS n FROM l GROUP BY 1), o AS (SELECT DISTINCT practitioner_id FROM roles WHERE practitioner_id IN (SELECT practitioner_id FROM known)) SELECT practitioner_id, coalesce(n, 0)::INT AS locations FROM o LEFT JOIN n USING (practitioner_id)""")
def agg16_grouped_roles(spark, d):
    """Also UDF03: the records of a dataset adapter, all of a practitioner's roles grouped."""
    records = adapters.PROVIDERS.get("resource-spool").records(spark, f"{d}/spool_resources.parquet")
    return records.select("practitioner_id", F.coalesce(F.size(F.coalesce("locations", F.array().cast(records.schema["locations"].dataType))), F.lit(0)).alias("locations"))


# Ledgers


def _marks(spark, d):
    e = table(spark, d, "events")
    return e.select(F.concat(F.lit("r"), c("user_id") % 2).alias("run"), c("event_type").alias("phase"), c("event_id").cast("string").alias("key"), F.lit("done").alias("status"), c("props").alias("payload"), F.lit(None).cast("string").alias("error"), c("ts").cast("timestamp").alias("at"))


def _ledger(spark, d):
    led, marks = lg.Ledger(spark, _folder(spark, "ledger")), _marks(spark, d)
    for r in ("r0", "r1"):
        led.start_or_resume(r, "2024-01-01 00:00:00")
        led.mark(marks.where(c("run") == r), r)
    return led, marks


@C.query("SELECT 'r' || (user_id % 2) AS run, event_type AS phase, count(*) AS n FROM events WHERE NOT (user_id % 2 = 0 AND event_type = 'click') GROUP BY ALL")
def stm03_cleared_phase(spark, d):
    led, _ = _ledger(spark, d)
    led.clear("r0", "click")
    return led.log().groupBy("run", "phase").agg(F.count("*").alias("n"))


@C.query("SELECT CAST(event_id AS VARCHAR) AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE user_id % 2 = 1 AND event_type = 'view'")
def stm04_payloads(spark, d):
    return lg.payloads(_marks(spark, d), "r1", "view", "k long").select("key", "payload.k")


@C.query("SELECT count(*) AS marks, CAST(ceil(count(*) / 7.0) AS INT) AS commits FROM health_systems")
def stm05_group_commit(spark, d):
    """A loop of the driver over the health systems, which are fixed in number."""
    led = lg.Ledger(spark, _folder(spark, "ledger"))
    with led.grouped("r", every=7) as group:
        for r in table(spark, d, "health_systems").select("system_id").collect():
            group.add("p", str(r[0]), "done", "2024-01-01 00:00:00")
    return led.log("r").agg(F.count("*").alias("marks")).withColumn("commits", F.lit(group.commits))


@C.query("SELECT event_type AS key, count(*) AS spooled FROM events GROUP BY 1")
def stm06_spooled(spark, d):
    led, e = lg.Ledger(spark, _folder(spark, "ledger")), table(spark, d, "events").select("event_type", "event_id")
    marks = e.select("event_type").distinct().select(F.lit("r").alias("run"), F.lit("p").alias("phase"), c("event_type").alias("key"), F.lit("done").alias("status"), F.lit(None).cast("string").alias("payload"), F.lit(None).cast("string").alias("error"), F.lit(NOW).cast("timestamp").alias("at"))
    led.spool(e, "events", marks, "r")
    data = spark.read.parquet(led.spooled("r", "events"))
    return data.join(lg.standing(led.log("r")).where("status = 'done'").select(c("key").alias("event_type")), "event_type").groupBy(c("event_type").alias("key")).agg(F.count("*").alias("spooled"))


@C.query("SELECT false AS spool_there, 0 AS marks, true AS resumed")
def stm07_fresh_run(spark, d):
    led, marks = lg.Ledger(spark, _folder(spark, "ledger")), _marks(spark, d).where("run = 'r0'")
    led.start_or_resume("r0", "2024-01-01 00:00:00")
    led.spool(table(spark, d, "events").select("event_id"), "events", marks, "r0")
    resumed = led.start_or_resume("r0", "2024-01-02 00:00:00") and files.exists(spark, led.spooled("r0", "events"))
    led.complete("r0", "2024-01-03 00:00:00")
    led.start_or_resume("r0", "2024-01-04 00:00:00")
    return spark.createDataFrame([(files.exists(spark, led.spooled("r0", "events")), led.log("r0").count(), resumed)], "spool_there boolean, marks int, resumed boolean")


@C.query("""WITH p AS (SELECT user_id AS query, event_id AS page, event_type <> 'error' AS ok, CASE WHEN event_type <> 'purchase' THEN 'u' || event_id END AS next_url FROM events),
l AS (SELECT query, max(page) FILTER (ok) AS page, arg_max_null(next_url, page) FILTER (ok) AS next_url FROM p GROUP BY 1) SELECT query, coalesce(page + 1, 0) AS page, CASE WHEN page IS NOT NULL THEN next_url END AS url FROM l""")
def stm08_resumed_cursors(spark, d):
    pages = table(spark, d, "events").select(c("user_id").alias("query"), c("event_id").alias("page"), F.when(c("event_type") == "error", "failed").otherwise("ok").alias("status"), F.when(c("event_type") != "purchase", F.concat(F.lit("u"), "event_id")).alias("next_url"))
    return lg.resume_page(pages)


# Work, runs and state

_L = "(SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'pending' WHEN 'error' THEN 'error' ELSE 'done' END AS status, CAST(floor(value) AS BIGINT) % 6 AS attempts FROM events)"


@C.query(f"SELECT id, CASE WHEN status = 'pending' THEN 'done' ELSE status END AS status, attempts + CASE WHEN status = 'pending' THEN 1 ELSE 0 END AS attempts FROM {_L}")
def dml10_marked(spark, d):
    work = ledger(spark, d).withColumn("error", F.lit(None).cast("string"))
    return queues.mark(work, work.where("status = 'pending'").select("id", F.lit("done").alias("status"), "error"), NOW).select("id", "status", "attempts")


@C.query(f"SELECT id, CASE WHEN status = 'error' THEN 'pending' ELSE status END AS status, CASE WHEN status = 'error' THEN 0 ELSE attempts END AS attempts FROM {_L}")
def dml11_requeued(spark, d):
    work = ledger(spark, d)
    return queues.requeue(work, work.where("status = 'error'").select("id")).select("id", "status", "attempts")


@C.query(f"SELECT organization_id, website, '2024-01-01 00:00:00' AS added_at FROM organizations WHERE website IS NOT NULL UNION ALL SELECT organization_id, website, '{NOW}' FROM organizations WHERE website_confidence = 'high' AND website IS NOT NULL")
def dml17_trail(spark, d):
    rows = table(spark, d, "organizations").where("website is not null").select("organization_id", "website", "website_confidence")
    first = merge.appended(rows.drop("website_confidence").withColumn("added_at", F.lit(None).cast("timestamp")).limit(0), rows.drop("website_confidence"), "2024-01-01 00:00:00")
    return merge.appended(first, rows.where("website_confidence = 'high'").drop("website_confidence"), NOW).select("organization_id", "website", stamp("added_at").alias("added_at"))


@C.query(f"SELECT max(run_id) AS run_id, 'sitemap' AS source, '{NOW}' AS finished_at, (SELECT count(*) FROM providers)::INT AS new FROM provider_snapshots")
def dml18_run(spark, d):
    """Also DAT01 (the time is given, in seconds) and SRT02 (the run finished last)."""
    last, empty = runs(spark, d)[-1], spark.createDataFrame([], "run_id long, kind string, source string, started_at timestamp, finished_at timestamp, new int, notes string")
    began = queues.set_source(queues.start_run(queues.start_run(empty, last - 1, "scrape", NOW), last, "scrape", NOW), last, "sitemap")
    done = queues.finish_run(began, last, NOW, {"new": table(spark, d, "providers").count()})
    return commands.last_finished(done).select("run_id", "source", stamp("finished_at").alias("finished_at"), "new")


@C.query(_MERGE + "SELECT outcome, count(*) AS n FROM j WHERE outcome IN ('NEW', 'CHANGED') GROUP BY 1")
def dml20_dry_run(spark, d):
    return merge.pending(_upsert(spark, d))


@C.query("SELECT count(*) FILTER (event_type = 'error') + count(*) FILTER (event_type = 'view') > 0 AS fatal, count(*) FILTER (event_type = 'error') || ' failed batches; ' || count(*) FILTER (event_type = 'view') || ' silently empty answers' AS reason FROM events")
def cls11_completeness(spark, d):
    kind = F.when(c("event_type") == "error", "failed").when(c("event_type") == "view", "silent_empty").otherwise("ok")
    return ingest.completeness(queues.counts_by(table(spark, d, "events"), kind, "status"))


@C.query("SELECT true AS itself, NOT EXISTS (SELECT 1 FROM providers WHERE phone IS NOT NULL) AS without_phone")
def cls12_clean(spark, d):
    rows = table(spark, d, "providers").select("provider_id", "phone")
    other = rows.withColumn("phone", F.lit(None).cast("string"))
    return spark.createDataFrame([(compare.is_clean(compare.diff(rows, rows, "provider_id", ["phone"])), compare.is_clean(compare.diff(rows, other, "provider_id", ["phone"])))], "itself boolean, without_phone boolean")


@C.query(_values([("maybe", False), ("off", True), ("strict", True), ("warn", True)], "checksum, valid"))
def cls13_policy(spark, d):
    def valid(x: str) -> bool:
        try:
            return bool(rules.NumberPolicy(checksum=x))
        except ValueError:
            return False

    return spark.createDataFrame([(x, valid(x)) for x in ("strict", "warn", "off", "maybe")], "checksum string, valid boolean")


@C.query(_values([("unknown adapter 'none'; known: hospital-file",)], "said"))
def udf04_unknown_adapter(spark, d):
    try:
        adapters.ORGANIZATIONS.get("none")
    except ValueError as e:
        return spark.createDataFrame([(str(e),)], "said string")


@C.query("SELECT organization_id, CASE WHEN regexp_matches(name, '\\bwellness\\b', 'i') THEN 'Wellness' END AS shape FROM organizations WHERE regexp_matches(name, '\\bwellness\\b', 'i')")
def udf08_site_shapes(spark, d):
    """Also UDF01: what a site adds to the shapes of organizations' names."""
    site = ingest.SiteAdapter("query", r"-(\d+)$", org_shapes=((r"\bwellness\b", "Wellness"),))
    return table(spark, d, "organizations").select("organization_id", tx.first_label(c("name"), list(site.org_shapes)).alias("shape")).where("shape is not null")


@C.query("SELECT k.provider_id, k.organization_id FROM (SELECT p.provider_id, coalesce(a.organization_id, b.organization_id) AS organization_id FROM (SELECT provider_id, nullif(trim(regexp_replace(lower(hospital_affiliation), '\\s+', ' ', 'g')), '') AS a, nullif(trim(regexp_replace(lower(practice_name), '\\s+', ' ', 'g')), '') AS p FROM providers WHERE is_active = 1) p LEFT JOIN (SELECT normalized_name, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1) a ON p.a = a.normalized_name LEFT JOIN (SELECT normalized_name, max(organization_id) AS organization_id FROM organizations WHERE normalized_name <> '' GROUP BY 1) b ON p.p = b.normalized_name) k WHERE organization_id IS NOT NULL AND k.provider_id % 10 <> 0")
def fil18_link_pool(spark, d):
    rows = table(spark, d, "providers")
    return commands.link_organizations(rows, table(spark, d, "organizations"), rows.where("provider_id % 10 = 0").select("provider_id"), tx.org_key)


# Sorted and limited lists, reports and sinks


@C.query("SELECT url, reason FROM (SELECT profile_url AS url, CASE WHEN is_active = 0 THEN 'left' END AS reason FROM providers WHERE profile_url IS NOT NULL ORDER BY profile_url LIMIT 500) WHERE reason IS NOT NULL ORDER BY url LIMIT 40")
def srt12_sample(spark, d):
    """Also SRT11: the look at the first addresses before a run."""
    judged = table(spark, d, "providers").where("profile_url is not null").select(c("profile_url").alias("url"), F.when(c("is_active") == 0, "left").alias("reason"))
    return commands.sampled(judged, 500)[1].select("url", "reason")


@C.query("SELECT run_id, provider_id AS npi FROM (SELECT DISTINCT run_id, provider_id FROM provider_snapshots) ORDER BY run_id DESC, npi LIMIT 5000")
def srt06_newest_changes(spark, d):
    feed = table(spark, d, "provider_snapshots").select("run_id", c("provider_id").alias("npi"), F.lit("f").alias("field")).distinct()
    return commands.changes(feed, 5000).select("run_id", "npi")


@C.query("WITH a AS (SELECT organization_id, normalized_name AS k, 0 AS i FROM organizations UNION ALL SELECT organization_id, lower(trim(city)), 1 FROM organizations WHERE website_confidence = 'high') SELECT organization_id, array_to_string(list_distinct([first(k ORDER BY i)]) || CASE WHEN max(i) = 1 AND max(k) FILTER (i = 1) IS DISTINCT FROM max(k) FILTER (i = 0) THEN [max(k) FILTER (i = 1)] ELSE [] END, '|') AS keys FROM a GROUP BY 1")
def srt07_candidate_keys(spark, d):
    orgs = table(spark, d, "organizations")
    aliases = orgs.select("organization_id", c("organization_id").alias("alias_id"), F.lower(F.trim("city")).alias("normalized_alias"), c("website_confidence").alias("confidence"))
    return cascade.candidate_keys(orgs.select("organization_id", "normalized_name"), aliases).select("organization_id", F.array_join("keys", "|").alias("keys"))


def _sheets(spark, sheets) -> dict:
    """What a reader of the written sheets sees."""
    folder = _folder(spark, "sheets")
    files.write_sheets(sheets, folder)
    return {n: files.read_csv(spark, f"{folder}/{n}", sheets[n].columns) for n in sheets}


@C.query("SELECT npi, CAST(location_count AS VARCHAR) AS location_count, CASE nppes_name_match WHEN true THEN 'Yes' WHEN false THEN 'No' END AS name_match, CASE WHEN lower(trim(site_confidence)) IN ('low', 'medium') THEN 'true' ELSE 'false' END AS needs_review FROM providers WHERE is_active = 1")
def snk01_providers(spark, d):
    """Also SRT03."""
    return _sheets(spark, reports.providers(table(spark, d, "providers")))["Providers"].select("npi", "location_count", "name_match", "needs_review")


@C.query("SELECT provider_type AS classification, CAST(count(*) AS VARCHAR) AS n FROM providers WHERE is_active = 0 GROUP BY 1")
def snk02_excluded(spark, d):
    """Also SRT04."""
    rows = table(spark, d, "providers").where("is_active = 0").select(c("profile_url").alias("url"), "full_name", c("provider_type").alias("classification"), c("source_notes").alias("reason"))
    return _sheets(spark, reports.excluded(rows))["By classification"]


@C.query("SELECT CAST(count(*) AS VARCHAR) AS total, CAST(count(*) FILTER (is_active = 1) AS VARCHAR) AS active, CAST(count(*) FILTER (is_active = 0) AS VARCHAR) AS inactive, CAST(count(*) FILTER (npi IS NULL) AS VARCHAR) AS without_npi FROM providers")
def snk03_summary(spark, d):
    rows = table(spark, d, "providers")
    ids = spark.createDataFrame([(r, NOW) for r in runs(spark, d)], "run_id long, finished_at string")
    changes = table(spark, d, "provider_snapshots").select("run_id", "provider_id")
    return _sheets(spark, {"Totals": reports.summary(rows, changes, ids, ledger(spark, d))["Totals"]})["Totals"]


@C.query("SELECT CAST(organization_id AS VARCHAR) AS organization_id, CASE WHEN coalesce(website, '') = '' THEN 'true' ELSE 'false' END AS needs_website FROM organizations")
def snk04_organizations(spark, d):
    none = table(spark, d, "providers").where("false").select("provider_id", F.lit(0).cast("long").alias("organization_id"))
    return _sheets(spark, reports.organizations(table(spark, d, "organizations").select("organization_id", "website", "website_confidence", "state", "name"), none))["Organizations"].select("organization_id", "needs_website")


@C.query("SELECT '| ' || provider_type || ' | ' || count(*) || ' | ' || printf('%.1f', round(100.0 * count(*) / sum(count(*)) OVER (), 4)) || ' |' AS line FROM providers WHERE provider_type IS NOT NULL GROUP BY provider_type")
def snk05_report(spark, d):
    kinds = table(spark, d, "providers").where("provider_type is not null").select(c("provider_type").alias("label"))
    text = reports.investigation(kinds, table(spark, d, "providers").select(c("source_notes").alias("reason")))
    lines = [x for x in text.split("## Reasons")[0].splitlines() if x.startswith("| ") and not x.startswith("| kind")]
    return spark.createDataFrame([(x,) for x in lines], "line string")


@C.query(_OSM_SQL)
def snk06_cache(spark, d):
    path = _folder(spark, "osm")
    commands.refresh_osm_cache(_tags(spark, d), path)
    return files.read_json_or_empty(spark, path, "name string, website string")


@C.query("SELECT organization_id, CASE WHEN website_confidence = 'high' THEN 'new' ELSE 'old' END AS mark FROM organizations")
def snk07_row_upsert(spark, d):
    orgs, state = table(spark, d, "organizations"), files.VersionedTable(spark, _folder(spark, "state"))
    state.write(orgs.select("organization_id", F.lit("old").alias("mark")))
    state.upsert(orgs.where("website_confidence = 'high'").select("organization_id", F.lit("new").alias("mark")), ["organization_id"])
    state.keep(1)
    return state.read()


QUERIES, ORACLE = C.queries, C.sql
