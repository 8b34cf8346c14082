import json
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators.lookup import unambiguous
from rosterlake.sources import bundles, files, seeds
from rosterlake.sources.files import exists
from rosterlake.sources.paged import PagedSource, fetch_with_retry
from rosterlake.streaming import events as ev
from rosterlake.streaming.ledger import SCHEMA, Ledger, remaining


def test_hospital_file(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("﻿Facility ID,Facility Name,Address,City/Town,State,ZIP Code,Telephone Number\n010001,North  Pole Hospital ,1 Main,Town,AK,,Not Available\n010002,Other,2 Main,Town,AK,00501,(907) 555-0101\n", encoding="utf-8")
    got = files.hospitals_from_csv(files.read_csv(spark, str(path)))
    assert rows(got, "source_id", "name", "normalized_name", "zip", "phone") == [("010001", "North  Pole Hospital", "north pole hospital", None, None), ("010002", "Other", "other", "00501", "(907) 555-0101")]
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "none.csv"))


def test_versions_cache_and_metadata(spark, tmp_path):
    t = files.VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.version() is None
    t.write(spark.range(3))
    t.write(t.read().where("id > 0"))
    assert t.version() == 1 and t.read().count() == 2
    assert files.current_download('{"distribution": [{"downloadURL": "u"}]}') == "u"
    for bad in ("{}", "x", '{"distribution": []}'):
        with pytest.raises(RuntimeError):
            files.current_download(bad)
    landed = spark.sql("SELECT 'u' AS url, timestamp '2024-01-02 00:00:00' AS fetched_at, 'new' AS body UNION ALL SELECT 'u', timestamp '2024-01-01 20:00:00', 'old' UNION ALL SELECT 'v', timestamp '2023-01-01', 'x'")
    assert rows(files.cached(landed, "2024-01-02 12:00:00", 24), "url", "body") == [("u", "new")]
    assert files.read_json_or_empty(spark, str(tmp_path / "no.json"), "a string").count() == 0


def test_bundles(spark):
    from fake_api import PAGES

    b = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(PAGES.values())] + [(9, "{bad"), (8, None)], "page int, body string")
    assert rows(bundles.bundle_resources(b), "page", "resource_id") == [("0", "1"), ("1", "2")]
    assert rows(bundles.bundle_status(b), "page", "status") == [("0", "ok"), ("1", "ok"), ("2", "silent_empty"), ("8", "unreadable"), ("9", "unreadable")]


def test_paged_source_follows_cursors_and_reports(spark):
    spark.dataSource.register(PagedSource)
    df = spark.read.format("pages").option("fetch", "fake_api:fetch").option("url", "x://{q}?1").option("queries", '["a", "b", "c"]').option("base", "0").option("most", "0").load()
    assert rows(df, "query", "page", "status") == [("a", "0", "ok"), ("a", "1", "ok"), ("b", "0", "silent_empty"), ("c", "0", "failed")]
    waits = []
    assert fetch_with_retry(lambda u: 1 / 0, "u", 4, 1.0, 3.0, waits.append) == ("failed", None) and waits == [1.0, 2.0, 3.0]


def test_indexes(spark):
    rows_ = spark.createDataFrame([("A", "Alias A", "TX", "a.org"), ("A", None, "FL", "b.org"), ("B", "Not Available", "tx", "No Website"), (None, None, None, None)], "NAME string, ALT_NAME string, STATE string, WEBSITE string")
    idx = bundles.arcgis_index(rows_)
    assert rows(unambiguous(idx, ["key"], "website")) == [("alias a", "a.org")]
    assert rows(unambiguous(idx, ["key", "state"], "website")) == [("a", "FL", "b.org"), ("a", "TX", "a.org"), ("alias a", "TX", "a.org")]
    answers = spark.createDataFrame([('{"results": {"bindings": [{"hospitalLabel": {"value": "H"}, "stateLabel": {"value": "Texas"}, "website": {"value": "h.org"}}, {}]}}',), ("bad",)], "body string")
    assert rows(bundles.sparql_index(bundles.sparql_rows(answers, ["hospitalLabel", "altLabel", "stateLabel", "website"]))) == [("h", "TX", "h.org")]
    va = spark.createDataFrame([("V", "VA Medical Center (VAMC)", "v.gov", "TX"), ("W", "Clinic", "w.gov", "TX")], "name string, classification string, website string, state string")
    assert rows(bundles.va_index(va), "key") == [("v",)]
    tags = spark.createDataFrame([({"amenity": "hospital", "website": "a", "contact:website": "b", "name": "N"},), ({"amenity": "cafe", "website": "c"},), ({"healthcare": "hospital"},)], "tags map<string,string>")
    assert rows(bundles.osm_index(bundles.osm_elements(tags)), "key", "website") == [("n", "a")]


def test_sitemaps_with_a_cycle(spark):
    loc = lambda *us: "".join(f"<loc>{u}</loc>" for u in us)
    landed = spark.createDataFrame([("s0", f"<sitemapindex>{loc('s1', 's0', 's2')}"), ("s1", f"<urlset>{loc('p1', 'p2')}"), ("s2", f"<sitemapindex>{loc('s0', 's1')}")], "url string, body string")
    assert rows(bundles.crawl_sitemaps(landed, ["s0"])) == [("p1",), ("p2",)]
    assert bundles.crawl_sitemaps(landed, ["none"]).count() == 0
    assert rows(bundles.crawl_sitemaps(landed, landed.where("url = 's0'"), most_files=2)) == [("p1",), ("p2",)] and bundles.crawl_sitemaps(landed, ["s0"], most_files=1).count() == 0


def test_listings_and_answers(spark):
    html = lambda *us: "".join(f'<a href="/p/{u}">' for u in us)
    pages = spark.createDataFrame([("l", 0, html(1, 2)), ("l", 1, html(3)), ("l", 2, html(3)), ("l", 3, ""), ("l", 4, html(9))], "listing string, page int, html string")
    assert rows(bundles.listing_links(pages, r"/p/\d+", "https://h.org/x")) == [("https://h.org/p/1",), ("https://h.org/p/2",), ("https://h.org/p/3",)]
    ajax = spark.createDataFrame([(0, json.dumps([{"data": html(1)}, {"x": 1}, {"data": html(1, 2)}])), (1, "bad")], "page int, body string")
    assert rows(bundles.ajax_links(ajax, r"/p/\d+")) == [("0", "['/p/1', '/p/2']"), ("1", "[]")]
    probes = spark.createDataFrame([("https://a.org", 200, "page"), ("https://b.org", 404, "no")], "url string, status int, html string")
    assert rows(bundles.reachable(spark.createDataFrame([("a.org",), ("b.org",)], "url string"), probes), "url", "page") == [("a.org", "page"), ("b.org", None)]
    assert rows(bundles.probe_kinds(spark.createDataFrame([("u", 200, "{}"), ("v", 500, "{}")], "url string, status int, body string")), "url", "kind") == [("u", "json"), ("v", None)]


def test_seeds_and_settings(spark, tmp_path):
    assert seeds.states(spark).count() >= 50 and seeds.sources(spark).count() == 4 and seeds.health_systems(spark).count() == 6
    f = tmp_path / "s.yaml"
    f.write_text("attempts: 5  # tries\nrequire_npi: no\nother: x\n")
    s = seeds.Settings.load(str(f), {"ROSTERLAKE_DATA_DIR": "/d"})
    assert (s.attempts, s.require_npi, s.data_dir, s.extra) == (5, False, "/d", {"other": "x"})


def test_ledger(spark, tmp_path):
    led = Ledger(spark, f"file://{tmp_path}/l")
    mark = lambda *ks, status="done", at="2024-01-01 00:00:00": spark.createDataFrame([("r", "p", k, status, "{}", None, at) for k in ks], SCHEMA.replace("timestamp", "string"))
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert not led.start_or_resume("r", "2024-01-01 00:00:00")
    led.spool(work.where("key = 'a'"), "data", mark("a"), "r")
    led.mark(mark("b", status="error", at="2024-01-02 00:00:00"), "r")
    led.mark(mark("a", status="error", at="2024-01-03 00:00:00"), "r")
    assert rows(remaining(work, led.log(), "r", "p")) == [("b",), ("c",)]
    assert led.start_or_resume("r", "2024-01-04 00:00:00")
    led.complete("r", "2024-01-05 00:00:00")
    assert not led.start_or_resume("r", "2024-01-06 00:00:00") and remaining(work, led.log(), "r", "p").count() == 3
    # A run that begins anew has neither marks nor spool; another run's stay.
    assert not exists(spark, led.spooled("r", "data"))
    with led.grouped("s/2", every=2) as marks:
        for k in "abc":
            marks.add("p", k, "done", "2024-01-01 00:00:00")
    assert marks.commits == 2 and remaining(work, led.log(), "s/2", "p").count() == 0
    led.mark(mark("a"), "r")
    led.clear("r", "p")
    assert remaining(work, led.log(), "r", "p").count() == 3 and remaining(work, led.log("s/2"), "s/2", "p").count() == 0


def test_streams(spark, tmp_path):
    src = f"{tmp_path}/in"
    e = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", i % 2, "error" if i < 6 else "ok", 1.0) for i in range(10)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    e.write.parquet(src)
    read = lambda: ev.read(spark, src, "*.parquet", e.schema)
    stream = ev.run_to_end(ev.window_counts(read(), "5 minutes", "1 minute", "event_type"), "complete")
    assert rows(stream) == rows(ev.window_counts(e.withColumn("ts", F.col("ts").cast("timestamp")), "5 minutes", "1 minute", "event_type"))
    assert ev.run_to_end(ev.without_repeats(read(), ["user_id"], "1 hour")).count() == 2
    assert sorted(r.key for r in ev.run_to_end(ev.failure_alarm(read(), "user_id", "event_type", "error", 3)).collect()) == [0, 1]

    def merge(before, batch):
        counts = batch.groupBy("user_id").agg(F.count("*").alias("n"))
        return counts if before is None else before.unionByName(counts).groupBy("user_id").agg(F.sum("n").alias("n"))

    for _ in range(2):
        ev.upsert_batches(read(), f"{tmp_path}/state", f"{tmp_path}/cp", merge)
    assert rows(spark.read.parquet(f"{tmp_path}/state/v0")) == [("0", "5"), ("1", "5")]
    e.write.mode("append").parquet(src)
    shutil.rmtree(f"{tmp_path}/state/v0")
    with pytest.raises(Exception, match="the state before batch 1"):
        ev.upsert_batches(read(), f"{tmp_path}/state", f"{tmp_path}/cp", merge)


def test_adapters_and_discovery(spark, tmp_path):
    from rosterlake.sources import adapters

    with pytest.raises(ValueError, match="hospital-file"):
        adapters.ORGANIZATIONS.get("none")
    (tmp_path / "h.csv").write_text("Facility ID,Facility Name,Address,City/Town,State,ZIP Code,Telephone Number\n1,A,b,c,d,e,f\n")
    a = adapters.ORGANIZATIONS.get("hospital-file")
    assert a.normalize(a.read(spark, str(tmp_path / "h.csv"))).count() == 1 and not adapters.PROVIDERS.get("resource-spool").requires_profile_url
    maps = spark.createDataFrame([("s", "<urlset><loc>p</loc>")], "url string, body string")
    starts = spark.createDataFrame([("s",)], "url string")
    coll = spark.createDataFrame([(0, json.dumps({"data": [{"type": "node--provider", "id": "1", "attributes": {"path": {"alias": "/q"}}}]}))], "page int, body string")
    assert adapters.discover({"sitemaps": maps, "starts": starts, "collection": coll})[0] == "sitemap"
    name, urls = adapters.discover({"sitemaps": maps.limit(0), "starts": starts, "collection": coll})
    assert name == "collection" and rows(urls) == [("/q",)]
    for bad in ({"forced": "none"}, {"forced": "sitemap"}):
        with pytest.raises(ValueError):
            adapters.discover({"collection": coll}, **bad)


def test_queue_marks_runs_and_cursors(spark):
    from rosterlake.operators import queues
    from rosterlake.streaming.ledger import resume_page

    q = spark.createDataFrame([(1, "pending", 0, None, None), (2, "error", 3, "old", None)], "id int, status string, attempts int, error string, last_fetched timestamp")
    got = queues.mark(q, spark.createDataFrame([(1, "error", "x" * 900)], "id int, status string, error string"), "2024-01-01 00:00:00")
    assert [(r.id, r.status, r.attempts, len(r.error or "")) for r in got.orderBy("id").collect()] == [(1, "error", 1, 500), (2, "error", 3, 3)]
    assert rows(queues.requeue(got, spark.createDataFrame([(2,)], "id int")), "id", "status", "attempts") == [("1", "error", "1"), ("2", "pending", "0")]
    runs = spark.createDataFrame([(1, None, 0, None)], "run_id int, finished_at timestamp, new int, notes string")
    assert rows(queues.finish_run(runs, 1, "2024-01-01 00:00:00", {"new": 5}, "n" * 300).selectExpr("new", "length(notes)", "finished_at is not null")) == [("5", "200", "True")]
    with pytest.raises(ValueError):
        queues.finish_run(runs, 1, "2024-01-01 00:00:00", {"bad": 1})
    pages = spark.createDataFrame([("a", 0, "ok", "u1"), ("a", 1, "failed", None), ("b", 0, "ok", None), ("c", 0, "failed", None)], "query string, page int, status string, next_url string")
    assert rows(resume_page(pages)) == [("a", "1", "u1"), ("b", "1", None), ("c", "0", None)] and rows(resume_page(pages, True), "page") == [("0",)] * 3
