"""Pipelines on made-up records: a site, an interface, the cascade, and the reports."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators.rules import NumberPolicy
from rosterlake.plans import cascade, commands, ingest, reports


def npi(n):
    base = f"1{n:08d}"
    digits = [int(x) for x in "80840" + base]
    total = sum(x if i % 2 else (x * 2 - 9 * (x > 4)) for i, x in enumerate(reversed(digits)))
    return base + str(-total % 10)


CARD = "BEGIN:VCARD\r\nFN:{name}\r\nORG:{org}\r\nTEL:4075550{n:03d}\r\nADR:;;{address};Town;FL;32803;\r\nEND:VCARD"


def site(spark):
    """60 physicians, 20 advanced practitioners, 12 organizations and 9 odd records."""
    urls, cards, pages, reg = [], [], [], []

    def add(n, name, cred="MD", number=None, address="1 Main St", org="Main Clinic Site", card=True, html=None, enumeration="NPI-1", registered=True, alias=""):
        number = number or npi(n)
        slug = name.lower().replace(" ", "-").replace(",", "").replace(".", "")
        url = f"https://x.example/profile/{slug}{alias}-{number}"
        urls.append((url,))
        if card and not alias:
            cards.append((number, CARD.format(name=f"{name}, {cred}" if cred else name, org=org, n=n % 1000, address=address)))
        pages.append((url, html if html is not None else f"<h1>{name}{', ' + cred if cred else ''}</h1>"))
        if registered and not alias:
            first, last = name.split()[0], name.split()[-1]
            reg.append((number, enumeration, first, last, cred, name if enumeration == "NPI-2" else None, "207Q", "Family Medicine Physician"))

    for i in range(60):
        add(i, f"Ada{i} Lund{i}", "MD")
    for i in range(60, 80):
        add(i, f"Bo{i} Berg{i}", "APRN")
    for i in range(80, 92):
        add(i, f"Northside{i} Medical Center", "", enumeration="NPI-2")
    add(92, "Cy Noaddress", address="")
    add(93, "Di Phoneonly", address="", org="")
    add(94, "Ed Badnumber", number="1234567890", registered=False)
    add(95, "Flo Same")
    add(96, "Flo Same")
    add(97, "Gus Many", html='<h1>Gus Many, MD</h1> <a href="?location=1"> <a href="?location=2"> <a href="?location=3"> <a href="?location=4">')
    add(98, "Hal Gone", html="<h1>Page not found</h1>", card=False)
    add(99, "Ivy Unlisted", registered=False)
    add(0, "Ada0 Lund0", alias="-again")
    mk = spark.createDataFrame
    registry = mk(reg, "npi string, enumeration string, first_name string, last_name string, credential string, organization_name string, taxonomy_code string, taxonomy_desc string")
    return mk(urls, "url string"), mk(cards, "npi string, card string"), mk(pages, "url string, html string"), registry


def test_site_crawl(spark):
    urls, cards, pages, registry = site(spark)
    good, bad = ingest.crawl(urls, cards, pages, registry, ingest.adapter("example"), NumberPolicy())
    assert urls.count() == 101 and good.count() == 85
    assert {r.npi: r.site_confidence for r in good.collect()}[npi(97)] == "low"
    assert bad.count() >= 12 and bad.where("reason = 'not an individual'").count() == 12
    strict, _ = ingest.crawl(urls, cards, pages, registry, ingest.adapter("example"), NumberPolicy(checksum="strict"))
    assert strict.count() == 84 and strict.where("npi = '1234567890'").count() == 0
    without, _ = ingest.crawl(urls, cards, pages, registry.limit(0), ingest.adapter("example"), NumberPolicy())
    assert without.count() == 85 and without.where("site_confidence = 'high'").count() < 42
    with pytest.raises(ValueError, match="example"):
        ingest.adapter("nobody")


def test_refresh_run_twice(spark):
    urls, cards, pages, registry = site(spark)
    good, _ = ingest.crawl(urls, cards, pages, registry, ingest.adapter("example"), NumberPolicy())
    empty = good.limit(0).select("*", F.lit(True).alias("is_active"), *[F.lit(None).cast("timestamp").alias(x) for x in ("first_seen", "last_seen")], F.lit(0).alias("last_seen_run_id"))
    one, _ = commands.refresh(empty, urls, cards, pages, registry, "example", 1, "2024-01-01 00:00:00", True)
    state = spark.createDataFrame(one.state.collect(), one.state.schema)
    two, _ = commands.refresh(state, urls, cards, pages, registry, "example", 2, "2024-02-01 00:00:00", True)
    assert rows(two.outcome.groupBy("outcome").count()) == [("UNCHANGED", "85")] and two.changes.count() == 0
    assert reports.summary(good.withColumn("provider_id", F.xxhash64("npi")).withColumn("is_active", F.lit(1)), spark.createDataFrame([], "provider_id long, run_id int"), spark.createDataFrame([(1, None)], "run_id int, finished_at timestamp"), spark.createDataFrame([], "id int, status string, attempts int"))["Duplicates"].count() == 1


def resources():
    role = lambda i, p, locs, org=None: ("PractitionerRole", f"r{i}", {"practitioner": {"reference": f"Practitioner/{p}"}, "organization": {"reference": f"Organization/{org}"} if org else None, "location": [{"reference": f"Location/{x}"} for x in locs]})
    prac = lambda p, n: ("Practitioner", p, {"identifier": [{"system": "us-npi", "value": n}] if n else [], "name": [{"given": ["Ada"], "family": p}]})
    loc = lambda x: ("Location", x, {"name": f"Site {x}", "address": {"line": ["1 Main"], "city": "Town", "state": "RI", "postalCode": "02903"}})
    return [prac("p1", npi(1)), prac("p2", None), loc("l1"), loc("l2"), ("Organization", "o1", {"name": "Org"}), role(1, "p1", ["l2"]), role(2, "p1", ["l1", "l2"], "o1"), role(3, "p2", ["l1", "l9"]), role(4, "p9", ["l1"])]


def spool(spark, rs):
    data = [(i, t, k, json.dumps({"resourceType": t, "id": k, **b}), "2024-01-01 00:00:00") for i, (t, k, b) in enumerate(rs)]
    return spark.createDataFrame(data, "spool_seq long, resource_type string, resource_id string, body string, spooled_at string").withColumn("spooled_at", F.col("spooled_at").cast("timestamp"))


def test_interface_records_in_any_order(spark):
    want = None
    for seed in range(2):
        rs = resources()
        random.Random(seed).shuffle(rs)
        rs = rs + rs[:3]
        views = ingest.resource_views(spool(spark, rs))
        got = rows(ingest.normalized(views), "practitioner_id", "npi", "primary_location", "location_count", "role_id", "address")
        want = want or got
        assert got == want == [("p1", npi(1), "l2", "2", "r1", "1 Main"), ("p2", None, "l1", "2", "r3", "1 Main")]
    assert rows(ingest.misses(views)) == [("location", "4", "1"), ("organization", "1", "0"), ("practitioner", "3", "1")] or rows(ingest.misses(views))[2] == ("practitioner", "3", "1")
    nested = {r.practitioner_id: r for r in ingest.nested_records(views).collect()}
    assert [x.location_id for x in nested["p1"].locations] == ["l2", "l1"]
    fresh, links, bad = ingest.ingest(ingest.normalized(views), spark.createDataFrame([], "npi string"), NumberPolicy(require_profile_url=False))
    assert rows(fresh, "practitioner_id") == [("p1",)] and links.count() == 0 and rows(bad) == [("p2", "No NPI")]
    fresh, links, _ = ingest.ingest(ingest.normalized(views), spark.createDataFrame([(npi(1),)], "npi string"), NumberPolicy(require_profile_url=False))
    assert fresh.count() == 0 and rows(links, "practitioner_id") == [("p1",)]


def test_completeness(spark):
    verdict = lambda *xs: ingest.completeness(spark.createDataFrame(list(xs), "status string, n long")).first()
    assert not verdict(("ok", 3), ("empty", 9)).fatal and verdict(("ok", 3), ("silent_empty", 1)).fatal and "1 failed" in verdict(("failed", 1)).reason


def test_cascade(spark):
    site_rows = lambda *xs: spark.createDataFrame(list(xs), "key string, state string, website string")
    orgs = spark.createDataFrame([(1, "Acme Widgets", "TX", "acme widgets"), (2, "Beta Clinic", "TX", "beta clinic"), (3, "Gamma Works", "FL", "gamma works"), (4, "Delta Thing", None, "delta thing")], "organization_id int, name string, state string, normalized_name string")
    aliases = spark.createDataFrame([(1, 2, "old beta", "high"), (2, 2, "gossip", "low")], "alias_id int, organization_id int, normalized_alias string, confidence string")
    a = cascade.Source("a", site_rows(("acme widgets", "TX", "a.org"), ("acme widgets", "FL", "b.org")), checked=False)
    b = cascade.Source("b", site_rows(("old beta", None, "beta.org"), ("gamma works", None, "dead.org")))
    d = cascade.Source("c", site_rows(("beta clinic", "TX", "c.org"), ("gamma works", "FL", "gamma.org")))
    probes = spark.createDataFrame([("https://beta.org", 200, "all about BETA"), ("gamma.org", 200, "nothing"), ("https://dead.org", 500, ""), ("deltathing.org", 200, "delta")], "url string, status int, html string")
    got = rows(commands.enrich_organizations(orgs, [a, b, d], probes, aliases), "organization_id", "source", "website", "confidence", "chosen")
    assert got == [
        ("1", "a", "https://a.org", "high", "True"), ("2", "b", "https://beta.org", "medium", "True"),
        ("3", "b", "https://dead.org", None, "False"), ("3", "c", "https://gamma.org", "low", "True"), ("4", "guess", "https://deltathing.org", "medium", "True"),
    ]


def test_reports_and_commands(spark, tmp_path):
    assert len(commands.COMMANDS) == 16
    labels = spark.createDataFrame([("Physician",), ("Physician",), ("Clinic",)], "label string")
    text = commands.investigate(labels, spark.createDataFrame([("no address",)], "reason string"))
    assert "| Physician | 2 | 66.7 |" in text and "* no address (1)" in text
    orgs = spark.createDataFrame([(1, "A", "TX", None, None), (2, "B", None, "w", "high")], "organization_id int, name string, state string, website string, website_confidence string")
    sheets = reports.organizations(orgs, spark.createDataFrame([(1, 7), (1, 8)], "organization_id int, provider_id int"))
    assert rows(sheets["Organizations"], "organization_id", "providers", "needs_website") == [("1", "2", "True"), ("2", "0", "False")]
    commands.export_organizations(orgs, spark.createDataFrame([], "organization_id int, provider_id int"), str(tmp_path))
    assert (tmp_path / "Organizations" / "_SUCCESS").exists()
