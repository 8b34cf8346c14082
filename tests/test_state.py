from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators import compare, lookup, merge, primary, queues, rules

STATE = "k string, url string, v string, is_active boolean, first_seen timestamp, last_seen timestamp, last_seen_run_id int"


def test_upsert_outcomes_and_second_run(spark):
    empty = spark.createDataFrame([], STATE)
    batch = spark.createDataFrame([("a", "u", "1"), ("b", None, "2"), (None, "w", "9")], "k string, url string, v string")
    one = merge.upsert(empty, batch, "k", ["v"], 1, "2024-01-01 00:00:00", ("url",))
    assert {r.outcome for r in one.outcome.collect()} == {"NEW"} and one.changes.count() == 0
    state = one.state.where("k is not null")
    again = merge.upsert(state, batch.where("k is not null"), "k", ["v"], 2, "2024-02-01 00:00:00", ("url",))
    assert {r.outcome for r in again.outcome.collect()} == {"UNCHANGED"} and again.changes.count() == 0
    changed = merge.upsert(state, spark.createDataFrame([("a", None, "3")], "k string, url string, v string"), "k", ["v"], 3, "2024-03-01 00:00:00", ("url",))
    assert rows(changed.outcome) == [("a", "CHANGED"), ("b", "UNTOUCHED")] and rows(changed.state, "k", "url", "v") == [("a", "u", "3"), ("b", None, "2")]
    assert rows(changed.changes) == [("a", "v", "1", "3", "3")]
    gone = merge.deactivate_missing(state, "k", spark.createDataFrame([("a",)], "k string"), True)
    assert rows(gone, "k", "is_active") == [("a", "True"), ("b", "False")]
    back = merge.upsert(gone, spark.createDataFrame([("b", None, "2")], "k string, url string, v string"), "k", ["v"], 4, "2024-04-01 00:00:00")
    assert rows(back.outcome)[1] == ("b", "CHANGED") and back.changes.count() == 0
    assert rows(merge.deactivate_missing(state, "k", spark.createDataFrame([], "k string"), False), "is_active") == [("True",), ("True",)]


def test_empty_and_null_are_the_same_in_changes(spark):
    old, new = spark.createDataFrame([(1, ""), (2, "x")], "k int, v string"), spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    assert rows(merge.field_changes(old, new, "k", ["v"])) == [("2", "v", "x", None)]


def test_enrich_links_first_claim_wins(spark):
    old = spark.createDataFrame([(1, 10, True, False)], "p int, l int, is_primary boolean, is_active boolean")
    batch = spark.createDataFrame([(1, 11, True, 0), (1, 10, False, 1), (2, 20, True, 1), (2, 21, True, 0)], "p int, l int, is_primary boolean, n int")
    got = rows(merge.enrich_links(old, batch, "p", "l", "n"))
    assert got == [("1", "10", "True", "True"), ("1", "11", "False", "True"), ("2", "20", "False", "True"), ("2", "21", "True", "True")]


def test_unambiguous_and_tiers(spark):
    sites = spark.createDataFrame([("a", "TX", "1"), ("a", "TX", "1"), ("a", "FL", "2"), ("b", "TX", "3"), ("b", "TX", "4"), ("", "TX", "5"), (None, "TX", "6"), ("c", "TX", None)], "key string, state string, w string")
    by_state, by_name = lookup.unambiguous(sites, ["key", "state"], "w"), lookup.unambiguous(sites, ["key"], "w")
    assert rows(by_state) == [("a", "FL", "2"), ("a", "TX", "1")] and rows(by_name) == []
    probe = spark.createDataFrame([(1, "a", "FL"), (2, "a", None), (3, None, None)], "id int, key string, state string")
    assert rows(lookup.tiered_lookup(probe, [(["key", "state"], by_state), (["key"], by_name)], "w"), "id", "w", "tier") == [("1", "2", "1"), ("2", None, None), ("3", None, None)]


def test_anti_join_with_nulls_and_conflicts(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(lookup.unlinked(left, spark.createDataFrame([(1,), (None,)], "k int"), "k")) == [("2",), (None,)]
    known = spark.createDataFrame([("n1", None, 1), (None, "u2", 2)], "npi string, url string, id int")
    inc = spark.createDataFrame([("n1", "u2"), ("n1", None), (None, "u2"), (None, None)], "npi string, url string")
    assert sorted(map(str, ((r.matched, r.conflict) for r in lookup.two_step_match(inc, known, "npi", "url", "id").collect()))) == sorted(map(str, [(1, True), (1, False), (2, False), (None, False)]))


def test_primary_is_the_same_in_any_order(spark):
    data = [("p", "l2"), ("p", "l1"), ("p", "l2"), ("p", "l1"), ("p", None), ("q", "l9")]
    for d in (data, data[::-1]):
        assert rows(primary.primary_by_count(spark.createDataFrame(d, "o string, l string"), "o", "l")) == [("p", "l1", "2", "2"), ("q", "l9", "1", "1")]


def test_limits_and_windows(spark):
    q = spark.createDataFrame([(1, "pending", 0, None), (2, "error", 4, None), (3, "done", 0, None)], "id int, status string, attempts int, last_fetched timestamp")
    assert queues.pending(q, 0).count() == 1 and queues.stale(q, "2024-01-01", 0).count() == 1
    orgs = spark.createDataFrame([(1, None, None)], "organization_id int, website string, website_checked_at timestamp")
    assert queues.without_website(orgs, "2024-01-01", 90, 0).count() == 0 and queues.without_website(orgs, "2024-01-01", 90, None).count() == 1
    assert primary.date_windows(spark, "2024-01-01", "2024-01-21", 10).count() == 4


def test_diff_and_clean(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, None), (4, "z")], "k int, v string")
    assert rows(compare.diff(a, b, "k", ["v"]), "k", "kind") == [("1", "differs"), ("3", "only_a"), ("4", "only_b")]
    assert compare.is_clean(compare.diff(a, a, "k", ["v"])) and not compare.is_clean(compare.diff(a, b, "k", ["v"]))


def test_switch_members(spark):
    cur = spark.sql("SELECT 1 AS o, 'a' AS v, timestamp '2024-01-01' AS valid_from, cast(null AS timestamp) AS valid_to UNION ALL SELECT 2, 'b', timestamp '2024-01-01', null")
    got = merge.switch_members(cur, spark.createDataFrame([(1, "c"), (2, "b"), (3, "d")], "o int, v string"), "o", "v", "2024-06-01 00:00:00")
    assert rows(got.select("o", "v", F.col("valid_to").isNull().alias("open"))) == [("1", "a", "False"), ("1", "c", "True"), ("2", "b", "True"), ("3", "d", "True")]


def test_confidence_table(spark):
    data = [(1, True, True, "high", "high"), (4, True, True, "high", "low"), (2, True, True, "high", "medium"), (1, False, None, "high", "medium"), (1, True, False, "high", "medium"), (1, True, None, "high", "high"), (1, True, True, "low", "low"), (1, True, True, "medium", "medium")]
    df = spark.createDataFrame(data, "n int, reg boolean, m boolean, c string, want string")
    got = df.select(rules.site_confidence(F.col("n"), F.col("reg"), F.col("m"), F.col("c")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)
