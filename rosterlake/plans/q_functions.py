"""Queries of the column expressions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlake.functions import documents, fhir
from rosterlake.functions import text as tx
from rosterlake.functions.states import STATE_CODES
from rosterlake.operators import rules
from rosterlake.operators.primary import date_windows
from rosterlake.plans.catalog import Catalog
from rosterlake.session import table

C = Catalog()
c = F.col
WS = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def collapse(x: str) -> str:
    return WS.format(x)


def luhn(x: str) -> str:
    """SQL: whether the ten digits of x are right with the prefix 80840."""
    d = f"CAST(substr('80840' || {x}, 16 - i, 1) AS INT)"
    return f"list_sum(list_transform(range(1, 16), lambda i: CASE WHEN i % 2 = 1 THEN {d} WHEN {d} > 4 THEN {d} * 2 - 9 ELSE {d} * 2 END)) % 10 = 0"


def parts(x: str) -> str:
    return f"list_filter(list_transform(str_split({x}, ','), lambda p: trim(p)), lambda p: p <> '')"


_N = f"SELECT *, {collapse('full_name')} AS n FROM providers"
_AFTER = "list_filter(list_transform(str_split(n, ',')[2:], lambda p: trim(p)), lambda p: p <> '')"


@C.query(f"SELECT provider_id, CASE WHEN regexp_matches(npi, '^[0-9]{{10}}$') THEN {luhn('npi')} ELSE false END AS valid FROM providers")
def str01_npi_valid(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.npi_valid(c("npi")).alias("valid"))


@C.query(f"WITH p AS ({_N}) SELECT provider_id, trim(str_split(n, ',')[1]) AS name, array_to_string({_AFTER}, ', ') AS credentials FROM p")
def str02_name_and_credentials(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.name_part(c("full_name")).alias("name"), tx.credential_part(c("full_name")).alias("credentials"))


@C.query(f"""WITH p AS ({_N}), q AS (SELECT provider_id, coalesce({parts(collapse('credentials'))}, []) AS have, {_AFTER} AS said FROM p)
SELECT provider_id, array_to_string(list_concat(have, list_filter(said, lambda x, i: NOT list_contains(list_transform(have, lambda y: upper(y)), upper(x)) AND NOT list_contains(list_transform(said[1:i-1], lambda y: upper(y)), upper(x)))), ', ') AS credentials FROM q""")
def str03_merged_credentials(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.merged_credentials(c("credentials"), c("full_name")).alias("credentials"))


@C.query(r"""SELECT provider_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(upper(coalesce(credentials, '') || ',' || full_name), '[,\s/]+'), lambda t: replace(t, '.', '')), lambda t: t <> ''))), ' ') AS tokens FROM providers""")
def str04_credential_tokens(spark, d):
    both = F.concat(F.coalesce("credentials", F.lit("")), F.lit(","), "full_name")
    return table(spark, d, "providers").select("provider_id", F.array_join(F.array_sort(tx.credential_tokens(both)), " ").alias("tokens"))


@C.query(f"""WITH p AS (SELECT provider_id, list_filter(str_split({collapse('full_name')}, ' '), lambda t: t <> '') AS t FROM providers)
SELECT provider_id, CASE WHEN len(t) >= 2 THEN t[1] END AS first_name,
 CASE WHEN len(t) >= 3 AND upper(replace(t[-1], '.', '')) IN ('JR','SR','II','III','IV','V') THEN t[-2] WHEN len(t) >= 2 THEN t[-1] END AS last_name FROM p""")
def str05_person_split(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.first_name(c("full_name")).alias("first_name"), tx.last_name(c("full_name")).alias("last_name"))


@C.query("""WITH p AS (SELECT provider_id, regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^1([0-9]{10})$', '\\1') AS g FROM providers)
SELECT provider_id, CASE WHEN length(g) = 10 THEN substr(g, 1, 3) || '-' || substr(g, 4, 3) || '-' || substr(g, 7) END AS phone FROM p""")
def str06_phone(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.clean_phone(c("phone")).alias("phone"))


@C.query(f"SELECT organization_id, CASE WHEN name <> '' THEN {collapse('lower(name)')} END AS key, CASE WHEN name <> '' THEN {collapse('lower(name)')} END = normalized_name AS agrees FROM organizations")
def str07_org_key(spark, d):
    return table(spark, d, "organizations").select("organization_id", tx.org_key(c("name")).alias("key"), (tx.org_key(c("name")) == c("normalized_name")).alias("agrees"))


def _street(x: str) -> str:
    out = f"regexp_replace(lower({x}), '[.,#]', ' ', 'g')"
    for w in sorted(tx.ADDRESS_WORDS, key=lambda w: (-len(w), w)):
        out = f"regexp_replace({out}, '\\b{w}\\b', '{tx.ADDRESS_WORDS[w]}', 'g')"
    return collapse(out)


@C.query(f"""WITH l AS (SELECT *, substr(regexp_replace(zip, '[^0-9]', '', 'g'), 1, 5) AS z FROM locations)
SELECT location_id, CASE WHEN trim(address) <> '' AND z <> '' THEN {_street('address')} || '|' || substr(upper(trim(coalesce(state, ''))), 1, 2) || '|' || z END AS key FROM l""")
def str08_address_key(spark, d):
    return table(spark, d, "locations").select("location_id", tx.address_key(c("address"), c("state"), c("zip")).alias("key"))


@C.query(r"SELECT provider_id, array_to_string(list_transform(regexp_extract_all(full_name, '(\pL+|[^\pL]+)', 1), lambda w: upper(w[1]) || lower(w[2:])), '') AS shown FROM providers")
def str09_title_case(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.title_case(c("full_name")).alias("shown"))


@C.query("""SELECT provider_id, CASE WHEN coalesce(full_name, '') <> '' AND coalesce(trim(last_name), '') <> '' THEN contains(regexp_replace(lower(full_name), '[^a-z ]', '', 'g'), lower(trim(last_name)))
 AND (coalesce(trim(first_name), '') = '' OR contains(regexp_replace(lower(full_name), '[^a-z ]', '', 'g'), lower(trim(first_name)))) END AS matches FROM providers""")
def str10_names_match(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.names_match(c("full_name"), c("first_name"), c("last_name")).alias("matches"))


def _shape(x: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}', 'i') THEN '{label}'" for p, label in rules.ORG_SHAPES) + " END"


@C.query(f"SELECT organization_id, {_shape('name')} AS shape FROM organizations")
def str11_org_shape(spark, d):
    return table(spark, d, "organizations").select("organization_id", tx.first_label(c("name"), rules.ORG_SHAPES).alias("shape"))


_GENERIC = ", ".join(f"'{w}'" for w in tx.GENERIC_WORDS)
_WORDS = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"


@C.query(f"""WITH w AS (SELECT organization_id, {_WORDS.format('name')} AS ws FROM organizations),
r AS (SELECT *, len(ws) AS n, len(ws) - coalesce(list_max(list_filter(range(1, len(ws) + 1), lambda i: ws[i] NOT IN ({_GENERIC}))), 0) AS run FROM w)
SELECT organization_id, array_to_string(flatten(list_transform(list_filter(list_transform(range(0, run + 1), lambda k: n - k), lambda m: m >= 2 OR (m = n AND m >= 1)), lambda m: [array_to_string(ws[1:m], '') || '.com', array_to_string(ws[1:m], '') || '.org'])), ',') AS domains FROM r""")
def str12_candidate_domains(spark, d):
    return table(spark, d, "organizations").select("organization_id", F.array_join(tx.candidate_domains(c("name")), ",").alias("domains"))


@C.query(f"SELECT organization_id, array_to_string(list_filter({_WORDS.format('name')}, lambda w: w NOT IN ({_GENERIC}) AND length(w) > 3), ' ') AS words FROM organizations")
def str13_distinctive_words(spark, d):
    return table(spark, d, "organizations").select("organization_id", F.array_join(tx.distinctive_words(c("name")), " ").alias("words"))


@C.query(f"""SELECT doc_id, coalesce(len(list_filter({_WORDS.format('h.name')}, lambda w: w NOT IN ({_GENERIC}) AND length(w) > 3 AND contains(lower(d.text), w))) > 0, false) AS mentions
FROM documents d JOIN health_systems h USING (system_id)""")
def str14_page_mentions(spark, d):
    docs, systems = table(spark, d, "documents"), table(spark, d, "health_systems")
    return docs.join(systems, "system_id").select("doc_id", tx.page_mentions(c("text"), c("name")).alias("mentions"))


_BUILT = "concat_ws('-', nullif(address, ''), nullif(city, ''), nullif(state, ''), nullif(substr(regexp_replace(zip, '[^0-9]', '', 'g'), 1, 5), ''))"


@C.query(f"SELECT location_id, coalesce(lower(trim(facility_name)) = lower({_BUILT}), false) AS by_name, lower(trim({_BUILT})) = lower({_BUILT}) AS by_built FROM locations")
def str15_generated_name(spark, d):
    rows = table(spark, d, "locations")
    built = F.upper(F.concat_ws("-", *[tx.filled(c(x)) for x in ("address", "city", "state")], tx.zip5(c("zip"))))
    test = lambda n: tx.is_generated_name(n, F.array("address"), c("city"), c("state"), c("zip"))
    return rows.select("location_id", test(c("facility_name")).alias("by_name"), test(built).alias("by_built"))


@C.query("SELECT provider_id, CASE WHEN len(languages) > 0 THEN array_to_string(languages, ', ') END AS listed, coalesce(len(languages), 0)::INT AS n FROM providers")
def str16_list_text(spark, d):
    as_text = tx.list_text(c("languages"))
    return table(spark, d, "providers").select("provider_id", as_text.alias("listed"), F.size(tx.text_list(as_text)).alias("n"))


@C.query("SELECT provider_id, trim(coalesce(nullif(hospital_affiliation, ''), nullif(practice_name, ''), nullif(full_name, ''))) AS shown FROM providers")
def str17_first_filled(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.first_filled(c("hospital_affiliation"), c("practice_name"), c("full_name")).alias("shown"))


@C.query("""SELECT provider_id, regexp_extract(profile_url, '^([a-zA-Z]+://[^/?#]+)', 1) || '/p' AS rooted, regexp_replace(profile_url, '[^/]*$', '') || 'next' AS beside,
 CASE WHEN contains(profile_url, '://') THEN profile_url ELSE 'https://' || profile_url END AS whole FROM providers WHERE profile_url IS NOT NULL""")
def str18_urls(spark, d):
    rows = table(spark, d, "providers").where("profile_url is not null")
    return rows.select("provider_id", tx.absolute_url(F.lit("/p"), c("profile_url")).alias("rooted"), tx.absolute_url(F.lit("next"), c("profile_url")).alias("beside"), tx.with_scheme(c("profile_url")).alias("whole"))


@C.query("SELECT doc_id, coalesce(regexp_matches(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '(^|\\.)pages1\\.example$'), false) AS inside FROM documents")
def str19_host_within(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.host_within(c("url"), "pages1.example").alias("inside"))


@C.query("SELECT doc_id, substr(text, 1, 80) AS head FROM documents")
def str20_clipped(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.clipped(c("text"), 80).alias("head"))


_STATES = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in STATE_CODES.items()) + ") AS s(label, code)"


@C.query(f"""SELECT provider_id, coalesce(s.code, CASE WHEN upper(trim(p.state)) IN (SELECT code FROM {_STATES}) THEN upper(trim(p.state)) END) AS code,
 nullif(substr(regexp_replace(p.zip, '[^0-9]', '', 'g'), 1, 5), '') AS zip5 FROM providers p LEFT JOIN {_STATES} ON lower(trim(p.state)) = s.label""")
def str21_state_and_zip(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.state_code(c("state")).alias("code"), tx.zip5(c("zip")).alias("zip5"))


@C.query("SELECT provider_id, nullif(concat_ws('; ', source_notes, CASE WHEN npi IS NULL THEN 'no number' END, CASE WHEN address IS NULL THEN 'no address' END), '') AS notes FROM providers")
def str24_notes(spark, d):
    return table(spark, d, "providers").select("provider_id", tx.notes(c("source_notes"), F.when(c("npi").isNull(), "no number"), F.when(c("address").isNull(), "no address")).alias("notes"))


@C.query("SELECT hifld_id, CASE WHEN lower(trim(alt_name)) NOT IN ('not available','no website','n/a','na','none','-','') THEN trim(alt_name) END AS alt_name, CASE WHEN lower(trim(website)) NOT IN ('not available','no website','n/a','na','none','-','') THEN trim(website) END AS website FROM hifld_hospitals")
def fil14_placeholders(spark, d):
    return table(spark, d, "hifld_hospitals").select("hifld_id", *[tx.without_placeholder(c(x), "hifld").alias(x) for x in ("alt_name", "website")])


_CARD = lambda x: F.coalesce(F.regexp_replace(c(x), "[;\r\n]", " "), F.lit(""))
_CLEAN = lambda x: f"nullif(trim(regexp_replace({x}, '[;\\r\\n]', ' ', 'g')), '')"


@C.query(f"""WITH p AS (SELECT *, regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^1([0-9]{{10}})$', '\\1') AS g FROM providers)
SELECT provider_id, {_CLEAN('full_name')} AS name, {_CLEAN('practice_name')} AS organization, CASE WHEN length(g) = 10 THEN substr(g, 1, 3) || '-' || substr(g, 4, 3) || '-' || substr(g, 7) END AS phone,
 {_CLEAN('address')} AS address, {_CLEAN('city')} AS city, {_CLEAN('state')} AS state, {_CLEAN('zip')} AS zip FROM p""")
def doc01_vcards(spark, d):
    line = lambda *xs: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in xs], F.lit("\r\n"))
    card = F.concat(line("BEGIN:VCARD"), line("FN:", _CARD("full_name")), line("ORG;TYPE=work:", _CARD("practice_name")), line("TEL:", _CARD("phone")), line("ADR;TYPE=work:;;", _CARD("address"), ";", _CARD("city"), ";", _CARD("state"), ";", _CARD("zip"), ";"), line("END:VCARD"))
    read = table(spark, d, "providers").select("provider_id", documents.parse_vcard(card).alias("v"))
    return read.select("provider_id", "v.name", "v.organization", "v.phone", "v.address", "v.city", "v.state", "v.zip")


@C.query("SELECT provider_id, nullif(trim(full_name), '') AS name, nullif(trim(specialty), '') AS specialty, accepting_new_patients AS accepting FROM providers")
def doc02_jsonld(spark, d):
    node = F.to_json(F.struct(F.lit("Physician").alias("@type"), c("full_name").alias("name"), F.array("specialty").alias("medicalSpecialty"), c("accepting_new_patients").cast("string").alias("isAcceptingNewPatients")))
    page = F.concat(F.lit('<html><script type="application/ld+json">{"@type": "WebSite"}</script><script type="application/ld+json">{broken</script><script type="application/ld+json">{"@graph": ['), node, F.lit("]}</script></html>"))
    n = documents.jsonld_node(page)
    return table(spark, d, "providers").select("provider_id", documents.jsonld_text(n, "name").alias("name"), documents.jsonld_text(n, "medicalSpecialty").alias("specialty"), documents.jsonld_flag(n, "isAcceptingNewPatients").alias("accepting"))


@C.query(f"SELECT organization_id, nullif(trim({collapse('name')}), '') AS title, nullif(trim(city), '') AS segment FROM organizations")
def doc04_titles(spark, d):
    page = F.concat(F.lit("<html><title>x | "), F.coalesce("city", F.lit("")), F.lit(" | Brand</title><h1 class='a'><b>"), c("name"), F.lit("</b></h1></html>"))
    return table(spark, d, "organizations").select("organization_id", documents.page_title(page).alias("title"), documents.title_segment(page, "brand").alias("segment"))


@C.query("SELECT doc_id, coalesce(contains(lower(substr(text, 1, 4000)), 'page not found'), false) AS error_page FROM documents")
def doc05_error_pages(spark, d):
    return table(spark, d, "documents").select("doc_id", documents.is_error_page(c("text"), F.lit(None).cast("string")).alias("error_page"))


@C.query("SELECT provider_id, array_to_string(list_sort(list_distinct([location_count::VARCHAR, provider_id::VARCHAR])), ',') AS ids FROM providers")
def doc06_location_ids(spark, d):
    page = F.concat(F.lit('<a href="/x?location='), "provider_id", F.lit('"> <a href="/y?a=1&location='), "location_count", F.lit('"><a href="/x?location='), "provider_id", F.lit('">'))
    return table(spark, d, "providers").select("provider_id", F.array_join(documents.location_ids(page), ",").alias("ids"))


@C.query("""WITH m AS (SELECT doc_id, regexp_extract_all(text, '[0-9]{4,}') AS ms FROM documents)
SELECT doc_id, array_to_string(list_filter(ms, lambda x, i: NOT list_contains(ms[1:i-1], x)), ',') AS numbers FROM m""")
def doc07_matches(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(documents.matches_in_order(c("text"), "[0-9]{4,}"), ",").alias("numbers"))


@C.query("SELECT provider_id, profile_url AS loc FROM providers WHERE profile_url IS NOT NULL")
def doc08_sitemap_locs(spark, d):
    body = F.concat(F.lit("<?xml version='1.0'?><urlset><url>\n<loc> "), c("profile_url"), F.lit(" </loc></url></urlset>"))
    return table(spark, d, "providers").where("profile_url is not null").select("provider_id", F.explode(documents.sitemap_locs(body)).alias("loc"))


@C.query(r"""WITH b AS (SELECT spool_seq, lower(ltrim(substr(body, 1, 500))) AS h FROM spool_resources)
SELECT spool_seq, CASE WHEN regexp_matches(h, '^[{\[]') THEN 'json' WHEN starts_with(h, '<?xml') OR starts_with(h, '<urlset') OR starts_with(h, '<sitemapindex') THEN 'xml' WHEN starts_with(h, '<') THEN 'html' ELSE 'other' END AS kind FROM b""")
def doc09_body_kinds(spark, d):
    return table(spark, d, "spool_resources").select("spool_seq", documents.body_kind(c("body")).alias("kind"))


@C.query(r"""WITH r AS (SELECT spool_seq, str_split(regexp_replace(regexp_replace(practitioner_ref, '/_history/[^/]*$', ''), '/+$', ''), '/') AS p, practitioner_ref FROM spool_resources)
SELECT spool_seq, CASE WHEN len(p) >= 2 AND NOT starts_with(practitioner_ref, '#') AND p[-1] <> '' AND p[-2] <> '' THEN p[-2] END AS kind, CASE WHEN len(p) >= 2 AND NOT starts_with(practitioner_ref, '#') AND p[-1] <> '' AND p[-2] <> '' THEN p[-1] END AS id FROM r""")
def jsn01_references(spark, d):
    r = fhir.reference(c("practitioner_ref"))
    return table(spark, d, "spool_resources").select("spool_seq", r["type"].alias("kind"), r["id"].alias("id"))


@C.query("SELECT provider_id, substr(sha256(to_json(struct_pack(full_name := full_name, specialty := specialty, phone := phone))), 1, 16) AS hash FROM providers")
def jsn10_content_hash(spark, d):
    return table(spark, d, "providers").select("provider_id", fhir.content_hash([c("full_name"), c("specialty"), c("phone")]).alias("hash"))


@C.query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsn11_payload(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@C.query("""WITH e AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-01', INTERVAL 10 DAY)) AS edge),
w AS (SELECT NULL::TIMESTAMP AS lower, min(edge) AS upper FROM e UNION ALL SELECT edge, lead(edge) OVER (ORDER BY edge) FROM e)
SELECT coalesce(strftime(lower, '%Y-%m-%d'), '') AS lower, coalesce(strftime(upper, '%Y-%m-%d'), '') AS upper, count(ts) AS n FROM w LEFT JOIN events ON (lower IS NULL OR ts >= lower) AND (upper IS NULL OR ts < upper) GROUP BY ALL""")
def dat03_windows(spark, d):
    # The windows are a few; each event looks up the one that its time falls into by the lower edge.
    w = date_windows(spark, "2024-01-01", "2024-03-01", 10)
    days = F.floor((F.unix_timestamp(c("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))) / 864000)
    last = w.where("lower is not null").count() - 1
    at = F.least(F.greatest(days, F.lit(-1)), F.lit(last))
    counts = table(spark, d, "events").groupBy(at.alias("i")).agg(F.count("*").alias("n"))
    numbered = w.withColumn("i", F.coalesce(F.floor((F.unix_timestamp("lower") - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))) / 864000), F.lit(-1)))
    show = lambda x: F.coalesce(F.date_format(x, "yyyy-MM-dd"), F.lit(""))
    return numbered.join(counts, "i", "left").select(show("lower").alias("lower"), show("upper").alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))


@C.query("SELECT event_id, epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01') // 1000000 AS seconds, round(least(2.0 ** least(event_id, 20), 60.0), 4) AS wait FROM events")
def mth02_backoff_and_elapsed(spark, d):
    seconds = F.unix_timestamp(c("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))
    return table(spark, d, "events").select("event_id", seconds.alias("seconds"), F.round(rules.backoff_seconds(F.least(c("event_id"), F.lit(20)), 2.0, 60.0), 4).alias("wait"))


QUERIES, ORACLE = C.queries, C.sql
