"""Queries p1, p4 and p6 over the provider directory tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators.history import ChainStore
from rosterlake.operators.nested import child_tables, spool_children, typed_children
from rosterlake.operators.snapshots import snapshot_changes
from rosterlake.session import scratch, table

#: The columns of a delivery that are compared where a content hash is missing.
COMPARED = ["full_name", "credentials", "specialty", "primary_site_of_care", "practice_name", "address", "city", "state", "zip", "phone", "location_count"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object that is an element of an array in the spool and in normalized_providers."""
    spool = spool_children(table(spark, sf_dir, "spool_resources"))
    norm = table(spark, sf_dir, "normalized_providers")
    return spool.unionByName(typed_children(norm, F.col("record_id"), "NormalizedProvider"))


def p1_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of locations.hours, linked to its location and record."""
    return child_tables(table(spark, sf_dir, "normalized_providers"), "record_id")["locations.hours"]


def p1_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of organizations, linked to its record."""
    return child_tables(table(spark, sf_dir, "normalized_providers"), "record_id")["organizations"]


def _stamp(col: str):
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss")


def p4_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of specialty and primary_site_of_care, the last delivery applied as an update."""
    rows = table(spark, sf_dir, "provider_snapshots")
    last = rows.agg(F.max("run_id")).first()[0]
    update = F.coalesce(F.col("run_id") == F.lit(last), F.lit(False))
    store = ChainStore(f"{scratch(spark)}/chains-{uuid4().hex}", "provider_id", "updated_date", ["specialty", "primary_site_of_care"], buckets=max(16, rows.count() // 1_000_000))
    store.apply(rows.where(~update))
    store.apply(rows.where(update))
    return store.chains(spark)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per version with its period as text; the open end is 'open'."""
    return p4_chains(spark, sf_dir).select("provider_id", _stamp("valid_from").alias("valid_from"), F.coalesce(_stamp("valid_to"), F.lit("open")).alias("valid_to"))


def p4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions with their values."""
    return p4_chains(spark, sf_dir).select("provider_id", "specialty", "primary_site_of_care", _stamp("valid_from").alias("valid_from"), F.coalesce(_stamp("valid_to"), F.lit("open")).alias("valid_to"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers added, removed and changed in each run against the run before."""
    rows = table(spark, sf_dir, "provider_snapshots")
    present = (F.col("is_active") == 1) & (F.col("last_seen_run_id") == F.col("run_id"))
    return snapshot_changes(rows, "run_id", "provider_id", present, "updated_date", "content_hash", COMPARED)


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many providers were added, removed and changed per run."""
    return p6_found(spark, sf_dir).groupBy("run_id", "change").agg(F.count("*").alias("n"))


P1_SQL = r"""
WITH RECURSIVE s0 AS (
  SELECT spool_seq, resource_type, resource_id, spooled_at,
         regexp_replace(regexp_replace(body, '^[\x{0000}-\x{0020}\x{00A0}\x{00AD}\x{200B}-\x{200F}\x{2028}-\x{202F}\x{2060}-\x{2064}\x{FEFF}]+', ''), '\s+$', '') AS b
  FROM spool_resources),
s1 AS (SELECT *, CASE WHEN json_valid(b) THEN b::JSON END AS j FROM s0),
s2 AS (SELECT * EXCLUDE (j), CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN (j->>'$')::JSON END ELSE j END AS j FROM s1),
s3 AS (SELECT * EXCLUDE (j), CASE WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.resource') AND NOT json_exists(j, '$.resourceType') THEN j->'$.resource' ELSE j END AS j FROM s2),
readable AS (SELECT * FROM s3 WHERE json_type(j) = 'OBJECT'),
tree AS (SELECT r.spool_seq, t.type, t.fullkey FROM readable r, json_tree(r.j) t),
names AS (SELECT DISTINCT regexp_extract(fullkey, '\.([A-Za-z_0-9]+)$', 1) AS n FROM tree WHERE type = 'ARRAY'),
pat AS (SELECT '\.(' || string_agg(n, '|' ORDER BY n) || ')(\.|$)' AS p FROM names WHERE n <> ''),
newest AS (
  SELECT spool_seq, resource_type, resource_id FROM (
    SELECT *, row_number() OVER (PARTITION BY resource_type, resource_id ORDER BY spooled_at DESC, spool_seq DESC) AS k
    FROM readable WHERE resource_type IS NOT NULL AND trim(resource_id) <> '') WHERE k = 1),
objs AS (
  SELECT n.resource_type AS parent_type, n.resource_id AS parent_id,
         regexp_replace(regexp_replace(t.fullkey, p.p, '.\1[0]\2', 'g'), p.p, '.\1[0]\2', 'g') AS k
  FROM newest n JOIN tree t USING (spool_seq), pat p WHERE t.type = 'OBJECT'),
spool AS (
  SELECT parent_type, parent_id, substr(regexp_replace(k, '\[[0-9]+\]', '', 'g'), 3) AS child_path,
         array_to_string(regexp_extract_all(k, '\[([0-9]+)\]', 1), '.') AS child_pos
  FROM objs WHERE k LIKE '%]'),
loc AS (
  SELECT record_id, l, i - 1 AS i FROM (
    SELECT record_id, unnest(locations) AS l, generate_subscripts(locations, 1) AS i FROM normalized_providers) WHERE l IS NOT NULL),
org AS (
  SELECT record_id, i - 1 AS i FROM (
    SELECT record_id, unnest(organizations) AS o, generate_subscripts(organizations, 1) AS i FROM normalized_providers) WHERE o IS NOT NULL),
hrs AS (
  SELECT record_id, i, k - 1 AS k FROM (
    SELECT record_id, i, unnest(l.hours) AS h, generate_subscripts(l.hours, 1) AS k FROM loc) WHERE h IS NOT NULL)
SELECT * FROM spool
UNION ALL SELECT 'NormalizedProvider', record_id::VARCHAR, 'locations', i::VARCHAR FROM loc
UNION ALL SELECT 'NormalizedProvider', record_id::VARCHAR, 'locations.hours', i::VARCHAR || '.' || k::VARCHAR FROM hrs
UNION ALL SELECT 'NormalizedProvider', record_id::VARCHAR, 'organizations', i::VARCHAR FROM org
"""

P1_HOURS_SQL = """
WITH loc AS (SELECT record_id, unnest(locations) AS l, generate_subscripts(locations, 1) - 1 AS i FROM normalized_providers),
hrs AS (SELECT record_id, i, unnest(l.hours) AS h, generate_subscripts(l.hours, 1) - 1 AS k FROM loc WHERE l IS NOT NULL)
SELECT record_id::VARCHAR AS parent_id, i::VARCHAR || '.' || k::VARCHAR AS pos, i::VARCHAR AS parent_pos, h.day AS day, h.opens AS opens, h.closes AS closes
FROM hrs WHERE h IS NOT NULL
"""

P1_ORGS_SQL = """
WITH o AS (SELECT record_id, unnest(organizations) AS o, generate_subscripts(organizations, 1) - 1 AS i FROM normalized_providers)
SELECT record_id::VARCHAR AS parent_id, i::VARCHAR AS pos, NULL::VARCHAR AS parent_pos, o.organization.name AS organization_name, o.organization.state AS organization_state,
       o.organization.source AS organization_source, o.organization.source_id AS organization_source_id, o.label AS label
FROM o WHERE o IS NOT NULL
"""

_P4_CTE = r"""
WITH r AS (
  SELECT provider_id, updated_date,
         max(trim(regexp_replace(lower(specialty), '\s+', ' ', 'g'))) AS s,
         max(trim(regexp_replace(lower(primary_site_of_care), '\s+', ' ', 'g'))) AS p
  FROM provider_snapshots WHERE provider_id IS NOT NULL AND updated_date IS NOT NULL GROUP BY ALL),
h AS (
  SELECT provider_id, updated_date, last_value(s IGNORE NULLS) OVER w AS s, last_value(p IGNORE NULLS) OVER w AS p
  FROM r WINDOW w AS (PARTITION BY provider_id ORDER BY updated_date ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, lag(s) OVER w AS ls, lag(p) OVER w AS lp, row_number() OVER w AS k
      FROM h WHERE s IS NOT NULL OR p IS NOT NULL WINDOW w AS (PARTITION BY provider_id ORDER BY updated_date)),
v AS (SELECT *, lead(updated_date) OVER (PARTITION BY provider_id ORDER BY updated_date) AS nxt
      FROM l WHERE k = 1 OR s IS DISTINCT FROM ls OR p IS DISTINCT FROM lp)
"""
_P4_TIMES = "strftime(updated_date, '%Y-%m-%d %H:%M:%S') AS valid_from, coalesce(strftime(nxt, '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to"

_P6_CTE = """
WITH present AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, provider_id ORDER BY updated_date DESC, content_hash DESC NULLS LAST) AS k
  FROM provider_snapshots WHERE is_active = 1 AND last_seen_run_id = run_id),
s AS (SELECT * FROM present WHERE k = 1),
runs AS (SELECT run_id, lag(run_id) OVER (ORDER BY run_id) AS before FROM (SELECT DISTINCT run_id FROM provider_snapshots)),
n AS (SELECT s.*, r.before FROM s JOIN runs r USING (run_id) WHERE r.before IS NOT NULL),
b AS (SELECT s.*, r.run_id AS pair FROM s JOIN runs r ON s.run_id = r.before),
f AS (
  SELECT coalesce(n.run_id, b.pair) AS run_id, coalesce(n.provider_id, b.provider_id) AS provider_id,
    CASE WHEN b.provider_id IS NULL THEN 'added' WHEN n.provider_id IS NULL THEN 'removed'
         WHEN CASE WHEN n.content_hash IS NULL OR b.content_hash IS NULL THEN """ + " OR ".join(f"n.{c} IS DISTINCT FROM b.{c}" for c in COMPARED) + """
              ELSE lower(trim(n.content_hash)) <> lower(trim(b.content_hash)) END THEN 'changed' END AS change
  FROM n FULL JOIN b ON n.run_id = b.pair AND n.provider_id = b.provider_id)
"""

QUERIES = {
    "p1_found": p1_found, "p1_hours": p1_hours, "p1_organizations": p1_organizations,
    "p4_found": p4_found, "p4_versions": p4_versions, "p6_found": p6_found, "p6_counts": p6_counts,
}
ORACLE = {
    "p1_found": P1_SQL, "p1_hours": P1_HOURS_SQL, "p1_organizations": P1_ORGS_SQL,
    "p4_found": _P4_CTE + f"SELECT provider_id, {_P4_TIMES} FROM v",
    "p4_versions": _P4_CTE + f"SELECT provider_id, s AS specialty, p AS primary_site_of_care, {_P4_TIMES} FROM v",
    "p6_found": _P6_CTE + "SELECT run_id, provider_id, change FROM f WHERE change IS NOT NULL",
    "p6_counts": _P6_CTE + "SELECT run_id, change, count(*) AS n FROM f WHERE change IS NOT NULL GROUP BY ALL",
}
