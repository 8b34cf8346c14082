"""Queries of state transitions, decision tables, enrichment and ledgers, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlake.functions import text as tx
from rosterlake.operators import merge, rules
from rosterlake.plans import cascade, ingest
from rosterlake.plans.catalog import Catalog
from rosterlake.plans.q_functions import _shape as _shape_sql
from rosterlake.plans.q_functions import luhn
from rosterlake.plans.q_relational import _BEFORE, _HKEY, _LAST, _LINKS, _TOP, _TS, links, runs, snapshot, stamp
from rosterlake.session import table
from rosterlake.sources import bundles
from rosterlake.streaming import events as ev
from rosterlake.streaming import ledger as lg

C = Catalog()
c = F.col
NOW = "2025-03-01 00:00:00"
FIELDS = ["full_name", "practice_name", "specialty", "phone"]


def _old(spark, d):
    """The last delivery but one as stored state."""
    before = runs(spark, d)[-2]
    rows = snapshot(spark, d, before)
    return rows.select("*", (F.length("full_name") % 4 != 0).alias("is_active"), F.lit("2024-01-01").cast("timestamp").alias("first_seen"), F.lit("2024-12-01").cast("timestamp").alias("last_seen"), F.lit(before).cast("int").alias("last_seen_run_id"))


def _upsert(spark, d):
    last = runs(spark, d)[-1]
    return merge.upsert(_old(spark, d), snapshot(spark, d, last), "provider_id", FIELDS, last, NOW)


_EQ = " AND ".join(f"nullif(o.{f}, '') IS NOT DISTINCT FROM nullif(n.{f}, '')" for f in FIELDS)
_MERGE = f"""WITH o AS (SELECT *, length(full_name) % 4 <> 0 AS is_active FROM {_TOP.format(_BEFORE)}), n AS {_TOP.format(_LAST)},
j AS (SELECT coalesce(o.provider_id, n.provider_id) AS provider_id, {", ".join(f"o.{f} AS o_{f}, n.{f} AS n_{f}" for f in FIELDS)}, o.is_active,
 CASE WHEN n.provider_id IS NULL THEN 'UNTOUCHED' WHEN o.provider_id IS NULL THEN 'NEW' WHEN {_EQ} AND o.is_active THEN 'UNCHANGED' ELSE 'CHANGED' END AS outcome FROM o FULL JOIN n USING (provider_id))
"""


@C.query(_MERGE + "SELECT provider_id, outcome FROM j")
def dml01_outcome(spark, d):
    return _upsert(spark, d).outcome


@C.query(_MERGE + "SELECT provider_id, " + ", ".join(f"CASE WHEN outcome IN ('NEW', 'CHANGED') THEN n_{f} ELSE o_{f} END AS {f}" for f in FIELDS) + f""",
 CASE WHEN outcome = 'UNTOUCHED' THEN is_active ELSE true END AS is_active, CASE WHEN outcome = 'UNTOUCHED' THEN '2024-12-01 00:00:00' ELSE '{NOW}' END AS last_seen, CASE WHEN outcome = 'UNTOUCHED' THEN {_BEFORE} ELSE {_LAST} END AS last_seen_run_id FROM j""")
def dml01_state(spark, d):
    return _upsert(spark, d).state.select("provider_id", *FIELDS, "is_active", stamp("last_seen").alias("last_seen"), "last_seen_run_id")


@C.query(_MERGE + " UNION ALL ".join(f"SELECT provider_id, '{f}' AS field, o_{f} AS old_value, n_{f} AS new_value, {_LAST} AS run_id FROM j WHERE outcome = 'CHANGED' AND nullif(o_{f}, '') IS DISTINCT FROM nullif(n_{f}, '')" for f in FIELDS))
def dml02_field_changes(spark, d):
    return _upsert(spark, d).changes


@C.query(_MERGE + "SELECT outcome, count(*) AS n FROM j GROUP BY 1")
def agg18_tally(spark, d):
    return _upsert(spark, d).outcome.groupBy("outcome").agg(F.count("*").alias("n"))


_KEYED = "SELECT address_key, arg_min(facility_name, location_id) AS name FROM locations WHERE address_key IS NOT NULL AND facility_name IS NOT NULL GROUP BY 1"


@C.query(f"""WITH a AS ({_KEYED}), o AS (SELECT * FROM a WHERE length(name) % 2 = 0), b AS (SELECT address_key, min(address) AS name FROM locations WHERE address_key IS NOT NULL GROUP BY 1)
SELECT o.address_key, o.name, CASE WHEN b.address_key IS NULL THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS last_seen FROM o LEFT JOIN b USING (address_key) UNION ALL SELECT b.address_key, b.name, '{NOW}' FROM b WHERE address_key NOT IN (SELECT address_key FROM o)""")
def dml03_location_upsert(spark, d):
    rows = table(spark, d, "locations").where("address_key is not null")
    then = F.lit("2024-01-01").cast("timestamp")
    old = rows.where("facility_name is not null").groupBy("address_key").agg(F.min_by("facility_name", "location_id").alias("name")).where("length(name) % 2 = 0").select("address_key", "name", then.alias("first_seen"), then.alias("last_seen"))
    batch = rows.groupBy("address_key").agg(F.min("address").alias("name"))
    return merge.touch_or_insert(old, batch, "address_key", NOW).select("address_key", "name", stamp("last_seen").alias("last_seen"))


@C.query("""WITH o AS (SELECT l_orderkey AS owner, l_suppkey AS target, min(l_linenumber) AS rank FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), b AS (SELECT l_orderkey AS owner, l_suppkey AS target, max(l_linenumber) AS rank FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT * FROM b UNION ALL SELECT o.* FROM o ANTI JOIN b USING (owner, target)""")
def dml04_overwrite_links(spark, d):
    rows = table(spark, d, "lineitem").select(c("l_orderkey").alias("owner"), c("l_suppkey").alias("target"), c("l_linenumber").alias("rank"), "l_returnflag")
    old = rows.where("l_returnflag = 'A'").groupBy("owner", "target").agg(F.min("rank").alias("rank"))
    return merge.overwrite_links(old, rows.where("l_returnflag = 'R'").select("owner", "target", "rank"), ["owner", "target"], "rank")


@C.query("""WITH l AS (SELECT l_orderkey AS owner, l_suppkey AS target, l_linenumber AS n, l_returnflag AS f FROM lineitem), o AS (SELECT owner, target, bool_or(n = 1) AS is_primary, false AS is_active FROM l WHERE f = 'A' GROUP BY ALL),
b AS (SELECT owner, target, bool_or(n <= 3) AS is_primary, min(n) AS ord FROM l WHERE f = 'R' GROUP BY ALL), fresh AS (SELECT b.* FROM b ANTI JOIN o USING (owner, target)),
g AS (SELECT *, row_number() OVER (PARTITION BY owner, is_primary ORDER BY ord, target) AS k FROM fresh)
SELECT o.owner, o.target, o.is_primary, o.is_active OR b.owner IS NOT NULL AS is_active FROM o LEFT JOIN b USING (owner, target)
UNION ALL SELECT g.owner, g.target, g.is_primary AND k = 1 AND g.owner NOT IN (SELECT owner FROM o WHERE is_primary), true FROM g""")
def dml05_enrich_links(spark, d):
    rows = table(spark, d, "lineitem").select(c("l_orderkey").alias("owner"), c("l_suppkey").alias("target"), c("l_linenumber").alias("n"), "l_returnflag")
    old = rows.where("l_returnflag = 'A'").groupBy("owner", "target").agg(F.bool_or(c("n") == 1).alias("is_primary")).withColumn("is_active", F.lit(False))
    batch = rows.where("l_returnflag = 'R'").select("owner", "target", (c("n") <= 3).alias("is_primary"), "n")
    return merge.enrich_links(old, batch, "owner", "target", "n")


@C.query("""WITH o AS (SELECT source, source_id, max(name) AS name, max(phone) AS phone FROM organizations WHERE source_id IS NOT NULL GROUP BY ALL)
SELECT x.organization_id, CASE WHEN o.source IS NULL THEN 'NEW' WHEN x.name IS NOT DISTINCT FROM o.name AND x.phone IS NOT DISTINCT FROM o.phone THEN 'UNCHANGED' ELSE 'CHANGED' END AS outcome
FROM (SELECT organization_id, source, source_id, CASE WHEN organization_type = 'hospital' THEN upper(name) ELSE name END AS name, phone FROM organizations) x LEFT JOIN o USING (source, source_id)""")
def dml06_null_safe_upsert(spark, d):
    rows = table(spark, d, "organizations").select("organization_id", "source", "source_id", "name", "phone", "organization_type")
    old = rows.where("source_id is not null").groupBy("source", "source_id").agg(F.max("name").alias("name"), F.max("phone").alias("phone"))
    batch = rows.withColumn("name", F.when(c("organization_type") == "hospital", F.upper("name")).otherwise(c("name")))
    return merge.null_safe_upsert(old, batch, ["source", "source_id"], ["name", "phone"], ["organization_id"])


@C.query("SELECT system_id, name, coalesce(nullif(primary_domain, ''), p.d) AS primary_domain FROM health_systems h LEFT JOIN (SELECT system_id, min(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS d FROM documents WHERE url IS NOT NULL AND system_id IS NOT NULL GROUP BY 1) p USING (system_id)")
def dml14_fill_domain(spark, d):
    found = table(spark, d, "documents").where("url is not null and system_id is not null").groupBy("system_id").agg(F.min(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)).alias("primary_domain"))
    return merge.update_columns(table(spark, d, "health_systems"), found, "system_id", ["primary_domain"], only_empty=True).select("system_id", "name", "primary_domain")


@C.query("SELECT o.organization_id, CASE WHEN k.n IS NOT NULL THEN k.n::VARCHAR ELSE o.website_confidence END AS website_confidence FROM organizations o LEFT JOIN (SELECT organization_id, count(*) AS n FROM " + _LINKS + " WHERE organization_id IS NOT NULL GROUP BY 1) k USING (organization_id)")
def dml07_set_columns(spark, d):
    patch = links(spark, d).where("organization_id is not null").groupBy("organization_id").agg(F.count("*").cast("string").alias("website_confidence"))
    return merge.update_columns(table(spark, d, "organizations"), patch, "organization_id", ["website_confidence"]).select("organization_id", "website_confidence")


@C.query(f"SELECT DISTINCT provider_id, organization_id FROM {_LINKS} WHERE organization_id IS NOT NULL AND provider_id NOT IN (SELECT provider_id FROM providers WHERE is_active = 0)")
def dml08_new_links(spark, d):
    old = table(spark, d, "providers").where("is_active = 0").select("provider_id")
    return merge.insert_missing(old, links(spark, d).where("organization_id is not null"), ["provider_id"])


@C.query("SELECT DISTINCT url FROM documents WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM documents WHERE url IS NOT NULL AND lang = 'es')")
def dml09_enqueue(spark, d):
    docs = table(spark, d, "documents").select("url", "lang")
    return merge.insert_missing(docs.where("url is not null and lang = 'es'").select("url").distinct(), docs.select("url"), ["url"])


@C.query("SELECT provider_id, is_active = 1 AND provider_id IN (SELECT provider_id FROM provider_snapshots WHERE run_id = " + _LAST + ") AS is_active FROM providers")
def dml12_deactivate(spark, d):
    state = table(spark, d, "providers").select("provider_id", (c("is_active") == 1).alias("is_active"))
    return merge.deactivate_missing(state, "provider_id", table(spark, d, "provider_snapshots").where(c("run_id") == runs(spark, d)[-1]), complete=True)


@C.query(f"""WITH o AS (SELECT provider_id, specialty FROM {_TOP.format(_BEFORE)}), n AS (SELECT provider_id, specialty FROM {_TOP.format(_LAST)})
SELECT coalesce(o.provider_id, n.provider_id) AS provider_id, CASE WHEN n.provider_id IS NOT NULL THEN n.specialty ELSE o.specialty END AS specialty, CASE WHEN o.provider_id IS NOT NULL THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS date_found FROM o FULL JOIN n USING (provider_id)""")
def dml13_keep_first_date(spark, d):
    then = F.lit("2024-01-01").cast("timestamp")
    old = snapshot(spark, d, runs(spark, d)[-2]).select("provider_id", "specialty", then.alias("date_found"), then.alias("last_seen"))
    return merge.keep_first_date(old, snapshot(spark, d, runs(spark, d)[-1]).select("provider_id", "specialty"), "provider_id", NOW).select("provider_id", "specialty", stamp("date_found").alias("date_found"))


@C.query(f"SELECT DISTINCT website AS item, {_HKEY} AS key FROM organizations WHERE website IS NOT NULL AND {_HKEY} <> '' AND (website, {_HKEY}) NOT IN (SELECT website, {_HKEY} FROM organizations WHERE website IS NOT NULL AND {_HKEY} <> '' AND source = 'CMS')")
def dml15_add_alias(spark, d):
    rows = table(spark, d, "organizations").where("website is not null").select(c("website").alias("item"), tx.org_key(c("name")).alias("key"), "source").where("key <> ''")
    return merge.insert_missing(rows.where("source = 'CMS'").select("item", "key"), rows.select("item", "key"), ["item", "key"])


@C.query(f"""WITH o AS (SELECT provider_id, coalesce(specialty, '') AS v FROM {_TOP.format(_BEFORE)}), n AS (SELECT provider_id, specialty AS v FROM {_TOP.format(_LAST)} WHERE specialty IS NOT NULL)
SELECT o.provider_id, o.v, CASE WHEN n.v IS DISTINCT FROM o.v AND n.v IS NOT NULL THEN '{NOW}' ELSE 'open' END AS valid_to FROM o LEFT JOIN n USING (provider_id) UNION ALL SELECT n.provider_id, n.v, 'open' FROM n LEFT JOIN o USING (provider_id) WHERE n.v IS DISTINCT FROM o.v""")
def dml16_switch_members(spark, d):
    current = snapshot(spark, d, runs(spark, d)[-2]).select("provider_id", F.coalesce("specialty", F.lit("")).alias("v"), F.lit("2024-01-01").cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    changes = snapshot(spark, d, runs(spark, d)[-1]).where("specialty is not null").select("provider_id", c("specialty").alias("v"))
    return merge.switch_members(current, changes, "provider_id", "v", NOW).select("provider_id", "v", F.coalesce(stamp("valid_to"), F.lit("open")).alias("valid_to"))


@C.query("SELECT event_type AS key, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC) AS k FROM events) WHERE k = 1")
def dml19_latest_values(spark, d):
    return merge.latest_values(table(spark, d, "events").withColumnRenamed("event_type", "key"), "key", "value", "ts")


@C.query("SELECT provider_id, is_active, NULL::VARCHAR AS added FROM providers")
def dml21_add_columns(spark, d):
    rows = table(spark, d, "providers").select("provider_id", "is_active")
    return merge.add_columns(rows, {"is_active": "int", "added": "string"}, {"is_active": 1})


@C.query("SELECT doc_id, system_id FROM documents WHERE system_id IS NOT NULL AND system_id NOT IN (SELECT system_id FROM health_systems)")
def fk01_orphans(spark, d):
    return merge.orphans(table(spark, d, "documents").select("doc_id", "system_id"), "system_id", table(spark, d, "health_systems"), "system_id").select("doc_id", "system_id")


_SET = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_TOK = "list_filter(list_transform(regexp_split_to_array(upper(coalesce(credentials, '')), '[,\\s/]+'), lambda t: replace(t, '.', '')), lambda t: t <> '')"


@C.query(f"""WITH p AS (SELECT *, {_TOK} AS toks, CASE nppes_enumeration WHEN 'NPI-1' THEN 1 WHEN 'NPI-2' THEN 2 ELSE 0 END AS e, {_shape_sql('full_name')} AS s1, {_shape_sql('practice_name')} AS s2, coalesce(regexp_matches(taxonomy_desc, 'physician|surgeon', 'i'), false) AS doc FROM providers),
q AS (SELECT *, list_has_any(toks, {_SET(rules.PHYSICIAN)}) AS phy, list_has_any(toks, {_SET(rules.ADVANCED)}) AS app, list_has_any(toks, {_SET(rules.CLINICIAN)}) AS cli FROM p)
SELECT provider_id, CASE WHEN e = 2 THEN coalesce(s1, s2, 'Organization') WHEN e = 1 AND phy THEN 'Physician' WHEN e = 1 AND app THEN 'APP' WHEN e = 1 AND cli AND doc THEN 'Physician' WHEN e = 1 AND cli THEN 'APP' WHEN e = 1 AND doc THEN 'Physician' WHEN e = 1 THEN 'Unknown'
 WHEN s1 IS NOT NULL AND NOT phy AND NOT app THEN s1 WHEN phy THEN 'Physician' WHEN app THEN 'APP' ELSE 'Unknown' END AS type,
 CASE WHEN e = 2 THEN 'high' WHEN e = 1 AND phy THEN 'high' WHEN e = 1 AND app THEN 'high' WHEN e = 1 AND cli AND doc THEN 'medium' WHEN e = 1 THEN 'low' WHEN s1 IS NOT NULL AND NOT phy AND NOT app THEN 'medium' WHEN phy OR app THEN 'medium' ELSE 'low' END AS confidence FROM q""")
def cls01_classify(spark, d):
    kind = rules.classify(c("full_name"), c("credentials"), c("nppes_enumeration"), c("practice_name"), F.lit(None).cast("string"), c("taxonomy_desc"))
    return table(spark, d, "providers").select("provider_id", kind.alias("k")).select("provider_id", "k.type", "k.confidence")


_B = lambda x: f"coalesce(trim({x}), '') = ''"


@C.query(f"""SELECT provider_id, concat_ws('; ', CASE WHEN {_B('full_name')} THEN 'No individual provider name' WHEN len(regexp_split_to_array(trim(full_name), '\\s+')) < 2 THEN 'Name does not look like a person (single token)' END,
 CASE WHEN {_B('npi')} THEN 'No NPI' WHEN NOT coalesce(CASE WHEN regexp_matches(npi, '^[0-9]{{10}}$') THEN {luhn('npi')} ELSE false END, false) THEN 'NPI fails CMS checksum' END, CASE WHEN {_B('address')} THEN 'No practice address' END,
 CASE WHEN {_B('city')} OR {_B('state')} THEN 'Incomplete address (missing city or state)' END, CASE WHEN {_B('profile_url')} THEN 'No profile URL' END,
 CASE WHEN NOT {_B('phone')} AND {_B('full_name')} AND {_B('address')} AND {_B('specialty')} AND {_B('practice_name')} THEN 'Only a phone number is present' END) AS problems FROM providers""")
def cls02_problems(spark, d):
    cols = {x: c(x) for x in ("full_name", "npi", "address", "city", "state", "profile_url", "phone", "specialty", "practice_name")} | {"enumeration": c("nppes_enumeration")}
    return table(spark, d, "providers").select("provider_id", F.array_join(rules.problems(cols, rules.NumberPolicy(checksum="strict")), "; ").alias("problems"))


@C.query(f"""SELECT provider_id, concat_ws('; ', CASE WHEN coalesce(npi, '') <> '' AND NOT coalesce(CASE WHEN regexp_matches(npi, '^[0-9]{{10}}$') THEN {luhn('npi')} ELSE false END, false) THEN 'NPI fails CMS checksum (kept: npi.checksum=warn)' END,
 CASE WHEN nppes_enumeration = 'not_found' THEN 'no NPPES record; classification is heuristic' END, CASE WHEN nppes_name_match = false THEN 'directory name does not match CMS legal name' END) AS notes FROM providers""")
def cls03_warnings(spark, d):
    return table(spark, d, "providers").select("provider_id", F.array_join(rules.warnings(c("npi"), c("nppes_enumeration"), c("nppes_name_match")), "; ").alias("notes"))


@C.query("""SELECT provider_id, CASE WHEN location_count > 3 OR lower(trim(site_confidence)) = 'low' THEN 'low' WHEN location_count > 1 THEN 'medium' WHEN nppes_enumeration IS NULL OR nppes_name_match = false THEN 'medium' WHEN lower(trim(site_confidence)) = 'medium' THEN 'medium' ELSE 'high' END AS grade FROM providers""")
def cls04_confidence(spark, d):
    return table(spark, d, "providers").select("provider_id", rules.site_confidence(c("location_count"), c("nppes_enumeration").isNotNull(), c("nppes_name_match"), F.lower(F.trim("site_confidence"))).alias("grade"))


@C.query("SELECT provider_id, CASE WHEN profile_url IS NULL THEN 'no address of a page' WHEN npi IS NULL THEN 'no number' WHEN address IS NULL THEN 'no place' END AS reason FROM providers")
def cls05_first_reason(spark, d):
    return table(spark, d, "providers").select("provider_id", rules.first_reason((c("profile_url").isNull(), "no address of a page"), (c("npi").isNull(), "no number"), (c("address").isNull(), "no place")).alias("reason"))


# The cascade: hospitals look for websites in three indexes made of organizations; a page answers if a document's text stands for it.
_IDX = lambda n, w: f"{n}s AS (SELECT key, state, min(website) AS website FROM s WHERE src = '{w}' AND state <> '' GROUP BY ALL HAVING count(DISTINCT website) = 1), {n}n AS (SELECT key, min(website) AS website FROM s WHERE src = '{w}' GROUP BY ALL HAVING count(DISTINCT website) = 1)"
_CASCADE = f"""WITH s AS (SELECT normalized_name AS key, upper(trim(state)) AS state, website, source AS src FROM organizations WHERE website IS NOT NULL AND normalized_name <> ''),
{_IDX('a', 'CMS')}, {_IDX('b', 'NPPES')}, {_IDX('m', 'Manual Review')},
h AS (SELECT hifld_id, name, {_HKEY} AS key, upper(trim(state)) AS state FROM hifld_hospitals),
up AS (SELECT DISTINCT website FROM organizations WHERE website_confidence IN ('high', 'medium') AND website IS NOT NULL),
r AS (SELECT h.hifld_id AS organization_id, 0 AS rank, 'CMS' AS source, coalesce(x.website, y.website) AS website FROM h LEFT JOIN as_ x ON h.key = x.key AND h.state = x.state LEFT JOIN an y ON h.key = y.key
 UNION ALL SELECT h.hifld_id, 1, 'NPPES', coalesce(x.website, y.website) FROM h LEFT JOIN bs x ON h.key = x.key AND h.state = x.state LEFT JOIN bn y ON h.key = y.key
 UNION ALL SELECT h.hifld_id, 2, 'Manual Review', coalesce(x.website, y.website) FROM h LEFT JOIN ms x ON h.key = x.key AND h.state = x.state LEFT JOIN mn y ON h.key = y.key),
t AS (SELECT r.*, CASE WHEN rank > 0 THEN website IN (SELECT website FROM up) END AS reachable FROM r WHERE website IS NOT NULL),
u AS (SELECT *, CASE WHEN rank = 0 THEN 'high' WHEN reachable THEN 'low' END AS confidence FROM t), b2 AS (SELECT organization_id, min(rank) FILTER (confidence IS NOT NULL) AS best FROM u GROUP BY 1)
SELECT organization_id, rank, source, website, reachable, confidence, coalesce(rank = best, false) AS chosen FROM u JOIN b2 USING (organization_id) WHERE best IS NULL OR rank <= best""".replace("as AS (", "as_ AS (")


@C.query(_CASCADE)
def cls09_cascade(spark, d):
    orgs = table(spark, d, "organizations")
    of = lambda s: bundles.website_rows(orgs.where(c("source") == s), [c("name")], c("state"), c("website"), "va").withColumn("state", F.nullif("state", F.lit("")))
    probes = orgs.where("website_confidence in ('high', 'medium') and website is not null").select(c("website").alias("url"), F.lit(200).alias("status"), F.lit("").alias("html")).distinct()
    hospitals = table(spark, d, "hifld_hospitals").select(c("hifld_id").alias("organization_id"), "name", F.upper(F.trim("state")).alias("state"), F.array(tx.org_key(c("name"))).alias("keys"))
    sources = [cascade.Source("CMS", of("CMS"), checked=False), cascade.Source("NPPES", of("NPPES")), cascade.Source("Manual Review", of("Manual Review"))]
    return cascade.enrich(hospitals, c("keys"), sources, probes)


@C.query("""WITH log AS (SELECT CAST(user_id AS VARCHAR) AS key, event_type = 'purchase' AND value > 80 AS done FROM events) SELECT DISTINCT CAST(user_id AS VARCHAR) AS key FROM events WHERE CAST(user_id AS VARCHAR) NOT IN (SELECT key FROM log WHERE done)""")
def stm01_remaining(spark, d):
    e = table(spark, d, "events")
    log = e.select(F.lit("r").alias("run"), F.lit("p").alias("phase"), c("user_id").cast("string").alias("key"), F.when((c("event_type") == "purchase") & (c("value") > 80), "done").otherwise("error").alias("status"), c("props").alias("payload"), F.lit(None).cast("string").alias("error"), c("ts").alias("at"))
    return lg.remaining(e.select(c("user_id").cast("string").alias("key")).distinct(), log, "r", "p")


@C.query("SELECT CAST(count(DISTINCT user_id) FILTER (has) AS BIGINT) AS done, CAST(count(DISTINCT user_id) FILTER (NOT has) AS BIGINT) AS error, 0::BIGINT AS pending FROM (SELECT user_id, bool_or(event_type = 'purchase') AS has FROM events GROUP BY 1)")
def stm02_progress(spark, d):
    e = table(spark, d, "events")
    log = e.select(F.lit("r").alias("run"), F.lit("p").alias("phase"), c("user_id").cast("string").alias("key"), F.when(c("event_type") == "purchase", "done").otherwise("error").alias("status"), c("props").alias("payload"), F.lit(None).cast("string").alias("error"), c("ts").alias("at"))
    return lg.progress(log)


@C.query(f"SELECT event_type, {_TS.format('time_bucket(INTERVAL 1 DAY, ts)')} AS start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stm10_window_counts(spark, d):
    rows = table(spark, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    return ev.window_counts(rows, "1 day", "1 hour", "event_type").select("event_type", stamp("start").alias("start"), "n", F.round("total", 2).alias("total"))


@C.query(f"SELECT event_type, {_TS.format('time_bucket(INTERVAL 1 DAY, ts)')} AS start, count(*) AS n FROM events GROUP BY ALL")
def stm10_streamed_counts(spark, d):
    """The same as a stream read to its end; complete mode, so that no window is held back."""
    stream = ev.window_counts(ev.read(spark, d), "1 day", "1 hour", "event_type").select("event_type", stamp("start").alias("start"), "n")
    return ev.run_to_end(stream, "complete")


@C.query("SELECT user_id, count(*)::BIGINT AS sessions FROM (SELECT user_id, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events) WHERE gap IS NULL OR gap >= INTERVAL 1 HOUR GROUP BY 1")
def stm10_sessions(spark, d):
    rows = table(spark, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    return ev.sessions(rows, "1 hour", "1 hour", "user_id").groupBy("user_id").agg(F.count("*").alias("sessions"))


def fhir_ingest(spark, d):
    """New providers from the spool against the listings that are there."""
    records = ingest.normalized(ingest.resource_views(table(spark, d, "spool_resources")))
    fresh, _, _ = ingest.ingest(records, table(spark, d, "providers").where("npi is not null"), rules.NumberPolicy(require_profile_url=False))
    return fresh.select("npi", "practitioner_id", "full_name", "practice_name", "address", "city", "state", "zip", "location_count")


C.query()(fhir_ingest)
QUERIES, ORACLE = C.queries, C.sql
