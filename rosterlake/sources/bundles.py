"""Landed answers of interfaces: resource bundles, website indexes, pages of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.functions.documents import body_kind, is_sitemap_index, matches_in_order, sitemap_locs
from rosterlake.functions.text import absolute_url, org_key, state_code, with_scheme, without_placeholder
from rosterlake.session import cut


def bundle_resources(bundles: DataFrame, body: str = "body") -> DataFrame:
    """(page, resource_type, resource_id, resource): the entries of bundles; malformed ones are skipped.

    ``page`` is the bundle's number in ``bundles``. An unreadable bundle gives no rows.
    """
    v = F.try_parse_json(body)
    entries = F.coalesce(F.try_variant_get(v, "$.entry", "array<variant>"), F.array().cast("array<variant>"))
    each = bundles.select("page", F.explode(F.transform(entries, lambda e: F.try_variant_get(e, "$.resource", "variant"))).alias("resource"))
    typed = each.select("page", F.try_variant_get("resource", "$.resourceType", "string").alias("resource_type"), F.try_variant_get("resource", "$.id", "string").alias("resource_id"), "resource")
    return typed.where("resource_type is not null and resource_id is not null")


def bundle_status(bundles: DataFrame, body: str = "body") -> DataFrame:
    """(page, status, next_url): unreadable, silent_empty (total is 0), empty, or ok. A missing total is normal."""
    v = F.try_parse_json(body)
    n = F.size(F.coalesce(F.try_variant_get(v, "$.entry", "array<variant>"), F.array().cast("array<variant>")))
    links = F.coalesce(F.try_variant_get(v, "$.link", "array<struct<relation string, url string>>"), F.array().cast("array<struct<relation string, url string>>"))
    status = F.when(v.isNull(), "unreadable").when(F.try_variant_get(v, "$.total", "bigint") == 0, "silent_empty").when(n == 0, "empty").otherwise("ok")
    return bundles.select("page", status.alias("status"), F.get(F.filter(links, lambda x: x["relation"] == "next"), F.lit(0))["url"].alias("next_url"))


def in_window(resources: DataFrame, at: str, lower: str | None, upper: str | None) -> DataFrame:
    """Rows with lower <= at <= upper; a missing edge is open."""
    out = resources
    if lower:
        out = out.where(F.col(at) >= F.lit(lower).cast("timestamp"))
    return out.where(F.col(at) <= F.lit(upper).cast("timestamp")) if upper else out


def website_rows(rows: DataFrame, names: list[Column], state: Column, website: Column, source: str) -> DataFrame:
    """(key, state, website) for every name of a row; rows without a website or name give none.

    States are codes in capitals. Names are folded; placeholders of the source count as missing.
    """
    site = without_placeholder(website, source)
    keys = F.array_distinct(F.array_compact(F.array(*[org_key(without_placeholder(n, source)) for n in names])))
    flat = rows.select(F.explode(keys).alias("key"), F.upper(F.trim(state)).alias("state"), site.alias("website"))
    return flat.where("key <> '' and website is not null")


def sparql_rows(answers: DataFrame, fields: list[str], body: str = "body") -> DataFrame:
    """The bindings of landed query answers, one text column per field."""
    v = F.try_parse_json(body)
    each = answers.select(F.explode(F.coalesce(F.try_variant_get(v, "$.results.bindings", "array<variant>"), F.array().cast("array<variant>"))).alias("b"))
    return each.select(*[F.try_variant_get("b", f"$.{f}.value", "string").alias(f) for f in fields])


def feature_rows(answers: DataFrame, fields: list[str], body: str = "body", within: str = "attributes") -> DataFrame:
    """The features of landed offset pages, one text column per attribute."""
    v = F.try_parse_json(body)
    each = answers.select(F.explode(F.coalesce(F.try_variant_get(v, "$.features", "array<variant>"), F.try_variant_get(v, "$.data", "array<variant>"), F.array().cast("array<variant>"))).alias("f"))
    return each.select(*[F.try_variant_get("f", f"$.{within}.{f}", "string").alias(f) for f in fields])


def sparql_index(bindings: DataFrame) -> DataFrame:
    """Website rows from (hospitalLabel, altLabel, stateLabel, website)."""
    return website_rows(bindings, [F.col("hospitalLabel"), F.col("altLabel")], state_code(F.col("stateLabel")), F.col("website"), "osm")


def arcgis_index(rows: DataFrame) -> DataFrame:
    return website_rows(rows, [F.col("NAME"), F.col("ALT_NAME")], F.col("STATE"), F.col("WEBSITE"), "hifld")


def va_index(rows: DataFrame, kept: str = "VA Medical Center (VAMC)") -> DataFrame:
    """Only rows of the classification ``kept``."""
    return website_rows(rows.where(F.col("classification") == kept), [F.col("name")], F.col("state"), F.col("website"), "va")


def osm_index(rows: DataFrame) -> DataFrame:
    return website_rows(rows, [F.col("name"), F.col("alt_name"), F.col("official_name")], F.col("state"), F.col("website"), "osm")


def osm_elements(rows: DataFrame, tags: str = "tags") -> DataFrame:
    """Elements tagged as hospitals that have a website, of two tags the first."""
    t = lambda k: F.try_element_at(F.col(tags), F.lit(k))
    hospital = F.coalesce(t("amenity") == "hospital", F.lit(False)) | F.coalesce(t("healthcare") == "hospital", F.lit(False))
    site = F.coalesce(t("website"), t("contact:website"))
    return rows.where(hospital & site.isNotNull()).select(t("name").alias("name"), t("alt_name").alias("alt_name"), t("official_name").alias("official_name"), site.alias("website"), F.coalesce(t("addr:state"), F.lit(None)).alias("state"))


def crawl_sitemaps(landed: DataFrame, start: DataFrame | list[str], most_files: int | None = None) -> DataFrame:
    """(url): the pages that sitemaps reachable from ``start`` list, through indexes, each file once.

    ``landed`` has (url, body); ``start`` is a table with (url) or a short
    list. A frontier of files not read before is followed level by level until
    it is empty, so cycles end. With ``most_files``, a courtesy to the sites,
    at most so many files are read in all, the first of a level by address;
    only files that were read count as seen.
    """
    spark, left = landed.sparkSession, most_files
    frontier = spark.createDataFrame([(u,) for u in start], "url string") if isinstance(start, list) else start.select("url")
    seen, pages = None, landed.select("url").limit(0)
    while left is None or left > 0:
        frontier = frontier.distinct() if seen is None else frontier.distinct().join(seen, "url", "left_anti")
        files = frontier.join(landed.select("url", "body"), "url")
        files = cut(files if left is None else files.orderBy("url").limit(left))
        n = files.count()
        if not n:
            break
        left = None if left is None else left - n
        read = files.select("url").distinct()
        seen = read if seen is None else seen.unionByName(read)
        listed = files.select(is_sitemap_index(F.col("body")).alias("index"), F.explode(sitemap_locs(F.col("body"))).alias("url"))
        pages = pages.unionByName(listed.where("not index").select("url"))
        frontier = listed.where("index").select("url")
    return pages.distinct()


def until_idle(pages: DataFrame, listing: str, page: str, links: str, stop_after: int = 2) -> DataFrame:
    """The pages of each listing before its first run of ``stop_after`` idle ones: pages whose links are none or those of the page before."""
    w = Window.partitionBy(listing).orderBy(page)
    idle = (F.size(links) == 0) | F.coalesce(F.col(links) == F.lag(links).over(w), F.lit(False))
    run = pages.withColumn("__idle", idle).withColumn("__island", F.sum((~F.col("__idle")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ended = run.withColumn("__still", F.sum(F.col("__idle").cast("int")).over(Window.partitionBy(listing, "__island").orderBy(page)))
    cutoff = ended.where(F.col("__idle") & (F.col("__still") >= stop_after)).groupBy(listing).agg(F.min(page).alias("__stop"))
    return ended.join(cutoff, listing, "left").where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).select(*pages.columns)


def listing_links(pages: DataFrame, pattern: str, base: str, stop_after: int = 2) -> DataFrame:
    """(url): distinct links of listing pages in their order, up to ``stop_after`` empty or repeating pages in a row.

    ``pages`` has (listing, page, html). A page repeats if all its links are those of the page before.
    """
    kept = until_idle(pages.withColumn("links", matches_in_order(F.col("html"), pattern, 0)), "listing", "page", "links", stop_after)
    return kept.select(F.explode("links").alias("link")).select(absolute_url(F.col("link"), F.lit(base)).alias("url")).distinct()


def ajax_links(answers: DataFrame, pattern: str, body: str = "body") -> DataFrame:
    """(page, links): links in the joined data of the commands of an answer."""
    cmds = F.coalesce(F.try_variant_get(F.try_parse_json(body), "$", "array<variant>"), F.array().cast("array<variant>"))
    html = F.array_join(F.array_compact(F.transform(cmds, lambda c: F.try_variant_get(c, "$.data", "string"))), "")
    return answers.select("page", matches_in_order(html, pattern, 0).alias("links"))


def jsonapi_rows(answers: DataFrame, collection: str, body: str = "body") -> DataFrame:
    """(page, id, path, next_url) of a collection's landed pages."""
    v = F.try_parse_json(body)
    rows = F.coalesce(F.try_variant_get(v, "$.data", "array<variant>"), F.array().cast("array<variant>"))
    each = answers.select("page", F.try_variant_get(v, "$.links.next.href", "string").alias("next_url"), F.explode(rows).alias("d"))
    kept = each.where(F.try_variant_get("d", "$.type", "string") == collection)
    return kept.select("page", F.try_variant_get("d", "$.id", "string").alias("id"), F.try_variant_get("d", "$.attributes.path.alias", "string").alias("path"), "next_url")


def landed_answers(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """(n, url, status, body): an answer per request (n, url), in their order: ok, silent_empty, failed, or missing.

    ``landed`` has (url, status, body). A failure is a value of its request,
    never an exception; an answer whose total is 0 may be one that isn't
    reported. Of several answers to one address a good one counts.
    """
    good = F.col("status") == 200
    one = landed.groupBy("url").agg(F.max(F.struct(good.alias("good"), "body")).alias("a"))
    empty = F.try_variant_get(F.try_parse_json("a.body"), "$.total", "bigint") == 0
    status = F.when(F.col("a").isNull(), "missing").when(~F.coalesce("a.good", F.lit(False)), "failed").when(empty, "silent_empty").otherwise("ok")
    return requests.join(one, "url", "left").select("n", "url", status.alias("status"), F.when(F.col("a.good"), F.col("a.body")).alias("body")).orderBy("n")


def split_includes(bundles: DataFrame, matched_type: str, body: str = "body") -> DataFrame:
    """(page, resource_type, resource_id, mode): the entries of bundles as 'match' or 'include', each include once.

    The mode is the entry's own, else a resource of ``matched_type`` is a match. An included resource comes again on
    many pages; the first page that has it keeps it.
    """
    v = F.try_parse_json(body)
    each = bundles.select("page", F.explode(F.coalesce(F.try_variant_get(v, "$.entry", "array<variant>"), F.array().cast("array<variant>"))).alias("e"))
    said = lambda path: F.try_variant_get("e", path, "string")
    read = each.select("page", said("$.resource.resourceType").alias("resource_type"), said("$.resource.id").alias("resource_id"), said("$.search.mode").alias("mode")).where("resource_type is not null and resource_id is not null")
    read = read.withColumn("mode", F.coalesce("mode", F.when(F.col("resource_type") == matched_type, "match").otherwise("include")))
    included = read.where("mode <> 'match'").groupBy("resource_type", "resource_id").agg(F.min("page").alias("page")).select("page", "resource_type", "resource_id", F.lit("include").alias("mode"))
    return read.where("mode = 'match'").unionByName(included)


def settled(attempts: DataFrame, key: str, order: str, most: int, base: float, cap: float) -> DataFrame:
    """(key, status, tries, waited): how each request ended if it is tried until it is ok, ``most`` times at most.

    ``attempts`` has the status of each landed attempt. Between two attempts
    min(base * 2^n, cap) seconds are waited.
    """
    ranked = attempts.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("__k") <= most)
    ended = ranked.groupBy(key).agg(F.min(F.when(F.col("status") == "ok", F.col("__k"))).alias("first"), F.count("*").alias("n"), F.max_by("status", "__k").alias("last"))
    tries = F.coalesce("first", "n").cast("int")
    waits = F.aggregate(F.sequence(F.lit(0), F.lit(most)), F.lit(0.0), lambda t, i: t + F.when(i < tries - 1, F.least(F.lit(base) * F.pow(F.lit(2.0), i), F.lit(cap))).otherwise(0.0))
    return ended.select(key, F.when(F.col("first").isNotNull(), "ok").otherwise(F.col("last")).alias("status"), tries.alias("tries"), F.round(waits, 4).alias("waited"))


def permitted(urls: DataFrame, robots: DataFrame) -> DataFrame:
    """``urls`` with ``allowed`` and ``delay``: what the robots file of the host says to everyone; without one all is allowed.

    ``robots`` has (host, body).
    """
    group = F.regexp_extract("body", r"(?ims)^user-agent:\s*\*\s*$(.*?)(?=^user-agent:|\z)", 1)
    rules = robots.groupBy("host").agg(F.max("body").alias("body")).select(
        "host", F.regexp_extract_all(group, F.lit(r"(?im)^disallow:[ \t]*(\S+)"), F.lit(1)).alias("__no"), F.nullif(F.regexp_extract(group, r"(?im)^crawl-delay:[ \t]*([0-9.]+)", 1), F.lit("")).cast("double").alias("delay")
    )
    read = urls.withColumn("host", F.lower(F.try_parse_url("url", F.lit("HOST")))).withColumn("__path", F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("/")))
    j = read.join(rules, "host", "left")
    return j.withColumn("allowed", ~F.coalesce(F.exists("__no", lambda p: F.startswith("__path", p)), F.lit(False))).drop("__no", "__path")


def overpass_elements(answers: DataFrame, body: str = "body") -> DataFrame:
    """(tags): the elements of landed map queries, for ``osm_elements``."""
    every = F.coalesce(F.try_variant_get(F.try_parse_json(body), "$.elements", "array<variant>"), F.array().cast("array<variant>"))
    return answers.select(F.explode(every).alias("e")).select(F.try_variant_get("e", "$.tags", "map<string,string>").alias("tags"))


def taxonomy_rows(answers: DataFrame, body: str = "body") -> DataFrame:
    """(number, taxonomy_code, taxonomy_desc) of landed registry answers: the primary taxonomy, even without a description, else the first."""
    v = F.try_parse_json(body)
    each = answers.select(F.explode(F.coalesce(F.try_variant_get(v, "$.results", "array<variant>"), F.array().cast("array<variant>"))).alias("r"))
    kind = "array<struct<code string, `desc` string, `primary` boolean>>"
    read = each.select(F.try_variant_get("r", "$.number", "string").alias("number"), F.coalesce(F.try_variant_get("r", "$.taxonomies", kind), F.array().cast(kind)).alias("t"))
    chosen = F.coalesce(F.get(F.filter("t", lambda t: F.coalesce(t["primary"], F.lit(False))), F.lit(0)), F.get("t", F.lit(0)))
    return read.select("number", chosen["code"].alias("taxonomy_code"), chosen["desc"].alias("taxonomy_desc"))


def probe_kinds(answers: DataFrame) -> DataFrame:
    """(url, status, kind) of probed addresses: what kind of body each gave."""
    return answers.select("url", "status", F.when(F.col("status") == 200, body_kind(F.col("body"))).alias("kind"))


def reachable(urls: DataFrame, probes: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``page``: the body of its probe if the status was 200, else NULL. A missing scheme is https."""
    landed = probes.where("status = 200").groupBy(with_scheme(F.col("url")).alias("__u")).agg(F.max("html").alias("page"))
    return urls.join(landed, with_scheme(F.col(url)) == F.col("__u"), "left").drop("__u")


def admitted(urls: DataFrame, pattern: str, group: int, name: str) -> DataFrame:
    """Addresses that match, with a group of the match."""
    return urls.where(F.col("url").rlike(pattern)).withColumn(name, F.regexp_extract("url", pattern, group))
