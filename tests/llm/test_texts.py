"""Contamination, mixtures, residue and survivors against brute force and on odd input."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterlake.llm import contamination, mixture, residue, survivors
from rosterlake.llm.text import words


def test_words_set_writing_aside():
    plain = words("Read the record and answer")
    for t in ("READ  THE&nbsp;record <b>and</b> answer!", "Réad thé rec-\nord and an​swer", "Ｒead the re\xadcord, and answer", "> Read<br/>the record and <i>answer</i>"):
        assert words(t) == plain
    assert words(None) == words("") == words(" .,") == [] and words("o'clock O’Clock") == ["oclock", "oclock"]


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(5, 60)))) for i in range(15)]
    docs = []
    for k in range(n):
        t = [r.choice(vocabulary) for _ in range(r.randint(0, 150))]
        if r.random() < 0.6:
            w = r.choice(items)[1].split()
            size = r.choice([8, 11, 12, 13, 30])
            a, at = r.randrange(max(1, len(w) - size)), r.randrange(len(t) + 1)
            t[at:at] = w[a : a + size]
        docs.append((k, " ".join(t).upper() if r.random() < 0.3 else ", ".join(t)))
    return docs, items


def runs_of(t, n=12):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_leaks_equal_brute_force(spark):
    for seed in range(2):
        docs, items = corpus(seed)
        want = sorted((str(d), str(i)) for d, t in docs for i, x in items if runs_of(t) & runs_of(x))
        got = rows(contamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
        assert want and sorted(got) == want


def test_leaks_in_blocks_and_odd_input(spark, monkeypatch):
    docs, items = corpus(5)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = rows(contamination.leaks(d, i))
    monkeypatch.setattr(contamination, "INDEX_ITEMS", 4)
    assert rows(contamination.leaks(d, i)) == whole
    odd = d.unionByName(spark.createDataFrame([(900, None), (901, ""), (None, items[0][1]), (0, docs[0][1]), (902, "x " * 200_000)], d.schema)).withColumn("item_id", F.lit(7))
    assert rows(contamination.leaks(odd, i.withColumn("doc_id", F.lit(1)))) == whole
    assert contamination.leaks(d, i.limit(0)).count() == 0 and contamination.leaks(d.limit(0), i).count() == 0


def counts(spark, data):
    return spark.createDataFrame(data, "doc_id long, source string, tokens long")


def test_running_sums_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BUCKET_DOCS", 7)
    data = [(i, "ab"[i % 3 == 0], 1 + i % 5) for i in range(200)]
    got = mixture.running_tokens(counts(spark, data), 1).collect()
    for s in "ab":
        at = 0
        for r in sorted((r for r in got if r.source == s), key=lambda r: r.before):
            assert r.before == at
            at += r.tokens


def test_mixture_meets_shares_and_caps(spark):
    data = [(i, "big", 100) for i in range(900)] + [(1000 + i, "small", 100) for i in range(20)] + [(2000, "small", 0), (2001, None, 5)]
    targets = spark.createDataFrame([("Big ", 0.5, 1), ("SMALL", 0.2, 4), ("absent", 0.4, 2), (None, 0.1, 1), ("big", None, None)], "source string, target_share double, max_repeats int")
    c = counts(spark, data)
    shares = mixture.plan(c.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("available")), targets)
    mixed = mixture.mix(c, shares)
    report = {r.source: r for r in mixture.report(mixed, shares).collect()}
    assert abs(report["big"].actual_share - 5 / 7) < 0.02 and abs(report["small"].actual_share - 2 / 7) < 0.02 and report["absent"].tokens == 0
    assert report["small"].repeats <= 4 and report["big"].repeats == 1
    got = mixed.collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(got) and all(0 <= r.position <= 1 for r in got)
    # The source that may be repeated more comes later.
    mean = lambda s: sum(r.position for r in got if r.source == s) / sum(r.source == s for r in got)
    assert mean("small") > mean("big")
    ordered = [r.position for r in mixture.in_order(mixed, 3).collect()]
    assert ordered == sorted(ordered)


def test_mixture_beyond_the_caps_and_empty(spark):
    c = counts(spark, [(1, "a", 10), (2, "b", 10)])
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    shares = mixture.plan(c.groupBy("source").agg(F.sum("tokens").alias("available")), targets, total=100)
    used = {r.source: r.tokens for r in mixture.report(mixture.mix(c, shares), shares).collect()}
    assert used == {"a": 10, "b": 30}
    none = mixture.plan(c.limit(0).groupBy("source").agg(F.sum("tokens").alias("available")), targets)
    assert mixture.mix(c.limit(0), none).count() == 0


def test_token_counts(spark):
    tiktoken = pytest.importorskip("tiktoken")
    assert tiktoken
    docs = spark.createDataFrame([(1, "hello hello", " Run-Log "), (2, None, None), (3, "", "")], "doc_id long, text string, source string")
    assert rows(mixture.token_counts(docs)) == [("1", "run_log", "2"), ("2", None, "0"), ("3", None, "0")]


GOOD = ["The clinic on Main Street opens at {n}.", "Patients of Dr. {w} wait about {n} minutes.", "Ward {n} and ward 404 share one station.", "We use [brackets] for words added by {w}.", "The course on JavaScript is full until {n}.", "The word undefined means that no code was given."]
BAD = ["404 Not Found", "Please enable JavaScript to view this directory.", "Dr. {{{{name}}}} works in {w}.", "Lorem ipsum dolor sit amet magna nulla velit.", "HTTP 503 Service Unavailable. Request {n}", "The office is {{{{city}}}} near {w}.", "undefined undefined", "Call us at |PHONE| before {n}."]


def made(spark, n, seed):
    r = random.Random(seed)
    fill = lambda t: t.format(n=r.randint(1, 999), w=r.choice(["Lund", "Berg", "Town", "Ryde"]))
    data = []
    for i in range(n):
        parts = [fill(r.choice(GOOD)) for _ in range(r.randint(1, 5))]
        bad = r.random() < 0.2
        if bad:
            parts.insert(r.randrange(len(parts) + 1), fill(r.choice(BAD)))
        data.append((i, " ".join(parts), f"https://h{i % 9}.example/x", bad))
    return spark.createDataFrame(data, "doc_id long, text string, url string, bad boolean")


def test_residue_on_unseen_documents(spark):
    model = residue.train(made(spark, 800, 1))
    assert model.validation["f1"] > 0.9
    test = made(spark, 300, 2)
    got = {r.doc_id for r in residue.affected(test, model).collect()}
    want = {r.doc_id for r in test.where("bad").collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.02 * 300
    assert residue.clean(test, model).count() == 300 - len(got)


#: Templates that no weak label matches; they stand in pages of their own and between clean sentences.
UNLABELLED = ["Reload the page to see the list of doctors.", "Your request was blocked by the gateway, code {n}.", "~office_name~ is open until {n}.", "Reviews could not be fetched, try later.", "[FIRST NAME] sees patients in {w}."]


def test_residue_beyond_the_labels(spark):
    r = random.Random(7)
    fill = lambda t: t.format(n=r.randint(1, 999), w=r.choice(["Lund", "Berg", "Town", "Ryde"]))
    labels = residue.weak()
    assert not any(labels.search(fill(t)) for t in UNLABELLED)
    data = [(i, " ".join(fill(r.choice(GOOD)) for _ in range(r.randint(3, 6))), f"https://h{i % 9}.example/x", False) for i in range(900)]
    data += [(1000 + i, fill(r.choice(BAD)), f"https://h{i % 9}.example/x", True) for i in range(80)]
    data += [(2000 + i, fill(r.choice(UNLABELLED)), f"https://h{i % 9}.example/x", True) for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string, url string, bad boolean")
    got = {x.doc_id for x in residue.affected(docs).collect()}
    unlabelled = {i for i in range(2000, 2040)}
    # Some of these families are told from clean text by their length and place alone.
    assert len(got & unlabelled) >= 16 and len([i for i in got if i < 900]) <= 9


def test_slots_are_one_token_whatever_their_marks():
    for text in ("Dr. {{name}} works", "Dr. ${name} works", "Dr. <%= name %> works", "Dr. %NAME% works", "Dr. |NAME| works", "Dr. [[name]] works", "Dr. ~name~ works", "Dr. [LAST NAME] works"):
        toks, said = residue.tokens(text)
        assert toks == ["Dr", ".", "slotz", "works"] and "slot 0" in said, text
    for text in ("We use [brackets] here", "about 50% of 60% of", 'a {"npi": 1} b', "a [sic] b", "<b>bold</b> text"):
        assert "slotz" not in residue.tokens(text)[0], text


def test_residue_on_odd_input(spark):
    docs = made(spark, 60, 3).drop("bad").unionByName(spark.createDataFrame([(100, None, None), (101, "", "not a url"), (102, "x" * 300_000, ""), (None, "404 Not Found", ""), (0, "404 Not Found", "")], "doc_id long, text string, url string"))
    assert (0,) in [(r.doc_id,) for r in residue.affected(docs.withColumn("score", F.lit("clash"))).collect()]
    assert residue.affected(docs.limit(0)).count() == 0
    only_good = spark.createDataFrame([(1, "All is well here.", None)], "doc_id long, text string, url string")
    assert residue.affected(only_good).count() == 0


T0 = datetime(2024, 1, 1)
SCHEMA = "id long, e string, at timestamp, conf int, v string"


def best(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return rows(survivors.best_rows(df, F.col("e"), "id", "at", [survivors.Rule("v", survivors.told(F.col("v")), [F.coalesce("conf", F.lit(0))])]), "entity", "row")


def test_survivors_equal_brute_force(spark):
    r = random.Random(4)
    data = [(i, f"e{r.randint(0, 12)}", T0 + timedelta(days=r.randint(0, 5)), r.choice([None, 1, 2, 3]), r.choice([None, "", "n/a", "Unknown", "a", "b", "c"])) for i in range(120)]
    want = []
    for e in {x[1] for x in data}:
        group = [x for x in data if x[1] == e]
        usable = [x for x in group if x[4] in ("a", "b", "c")]
        if len(group) > 1 and usable:
            want.append((e, str(min(usable, key=lambda x: (-(x[3] or 0), -x[2].timestamp(), x[0]))[0])))
    assert best(spark, data) == sorted(want)


def test_learned_order_decides_without_times(spark):
    timed = [(10 * i + j, f"t{i}", T0 + timedelta(days=40 * j), 1, "Resident" if j == 0 else "Attending") for i in range(5) for j in range(2)]
    untimed = [(900, "u", None, 1, "Resident"), (901, "u", None, 1, "Attending"), (902, "w", None, 1, "Other"), (901 + 2, "w", None, 1, "Else")]
    got = dict(best(spark, timed + untimed))
    assert got["u"] == "901" and got["w"] == "902"


def test_cycle_hot_group_and_empty(spark):
    cyc = [(1, "a", T0, 1, "x"), (2, "a", T0 + timedelta(1), 1, "y"), (3, "b", T0, 1, "y"), (4, "b", T0 + timedelta(1), 1, "x"), (5, "u", None, 1, "y"), (6, "u", None, 1, "x")]
    assert dict(best(spark, cyc))["u"] == "5"
    hot = [(i, "hot", T0 + timedelta(minutes=i), 1, f"v{i % 7}") for i in range(2000)] + [(5000, "one", T0, 1, "z"), (5001, None, T0, 1, "z")]
    assert best(spark, hot) == [("hot", "1999")] and best(spark, []) == []


def test_numbers_and_phones(spark):
    df = spark.createDataFrame([("NPI 1710588744",), ("1710588744.0",), ("17105 88744",), ("1234567890",), ("0000000000",), (None,)], "n string")
    assert [r.x for r in df.select(survivors.valid_npi(F.col("n")).alias("x")).collect()] == ["1710588744"] * 3 + [None] * 3
    ph = spark.createDataFrame([("(407) 646-7070 x22",), ("000-000-0000",), ("n/a",), ("646-7070",), ("1-407-646-7070",)], "p string")
    assert [r.x is not None for r in ph.select(survivors.dialled(F.col("p")).alias("x")).collect()] == [True, False, False, False, True]
