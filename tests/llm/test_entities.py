"""Names, addresses, persons, organizations and hospitals."""

import random
from itertools import combinations
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterlake import session
from rosterlake.llm import addresses, graph, hospitals, linking
from rosterlake.llm import names as names_
from rosterlake.llm.addresses import near, read_address
from rosterlake.llm.names import align_persons, best_assignment, hungarian, read_person
from rosterlake.llm.orgnames import ACRONYM, align_orgs


@pytest.mark.parametrize(("a", "b"), [
    ("Katherine H. Lund", "Lund, Kathy"), ("Bob Berg", "Berg Robert"), ("Søren Ryde", "Soren G Ryde, MD"), ("Dr. R Berg", "Bob Berg"), ("Ada Lund-Berg", "Ada LundBerg"),
    ("Ada Lund-Berg", "Ada Berg"), ("Theodore Lundqvist", "Thoedore Lundqvst"), ("W. J. Lund", "Bill J Lund"), ("Ada Lund Jr", "Lund Jr, Ada"),
])
def test_names_of_one_person(a, b):
    assert align_persons(a, b) > 0 and align_persons(b, a) > 0


@pytest.mark.parametrize(("a", "b"), [("Ada Lund Jr", "Ada Lund Sr"), ("Ada Lund", "Eva Lund"), ("Ada B Lund", "Ada C Lund"), ("Ada Lund", "Ada Berg"), ("", "Ada Lund"), (None, None)])
def test_names_of_different_persons(a, b):
    assert align_persons(a, b) == 0


def test_assignment_equals_brute_force():
    from itertools import permutations

    r = random.Random(1)
    for _ in range(30):
        n, m = r.randint(1, 4), r.randint(1, 4)
        s = [[r.choice([-1.0, 0.3, 0.5, 0.9]) for _ in range(m)] for _ in range(n)]
        side = range(max(n, m))
        best = max(sum(max(0, s[i][j]) for i, j in enumerate(p) if i < n and j < m) for p in permutations(side))
        assert abs(best_assignment(s)[0] - best) < 1e-9


def test_hungarian_equals_sets_of_columns():
    r = random.Random(2)
    for _ in range(200):
        n, m = r.randint(1, 7), r.randint(1, 7)
        s = [[r.choice([-1.0, 0.0, 0.3, 0.5, 0.85, 0.9]) for _ in range(m)] for _ in range(n)]
        total, pairs = hungarian(s)
        assert abs(total - best_assignment(s)[0]) < 1e-9 and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_long_names_of_organizations_are_aligned_whole():
    words = "Lund Berg Ryde Amber Rowan Haw Briar Umber Odrun Thorn Gale Marsh Fenn Colby Wex".split()
    for more, other in (("Astrid", "Bertil"), ("Children", "Women")):
        assert align_orgs(" ".join([*words[:12], more]), " ".join([*words[:12], other])) == 0
    assert align_orgs(" ".join(words), " ".join(words[::-1])) == 1
    assert 0.9 < align_orgs(" ".join(words), " ".join([*words[:0:-1], "Lunt"])) < 1


def test_read_person_takes_everything():
    for n in ("", " ", ",", "-", "Dr", "MD,", "x" * 100_000, "Jr.", "a.b.c.", "ﬁ ß"):
        read_person(n)


@pytest.mark.parametrize(("a", "b"), [
    ("Saint Odrun Children's Hospital", "ST. ODRUN CHILD HSPTL"), ("Hawfold Bay Univ Hosp.", "University Hospital of Hawfold Bay, Inc."), ("Lund & Berg Cardiology Associates", "Lund and Berg Cardio Assocs"),
    ("Briarella Fam Med", "Briarella Family Medicine"), ("Umberview Orthopedic Specialists - Town", "Orthopaedic Specialists of Umberveiw"), ("RMC Center", "Rowanfold Medical Center"), ("AIMA Town", "Amberlea Internal Medicine Associates"),
])
def test_names_of_one_organization(a, b):
    assert align_orgs(a, b, "Town") >= ACRONYM


@pytest.mark.parametrize(("a", "b"), [("Lund General Hospital", "Lund Children's Hospital"), ("Lund Hospital North Campus", "Lund Hospital South Campus"), ("Lund Hospital", "Berg Hospital"), ("Lund Bay Clinic", "Lund Hills Clinic"), (None, "x")])
def test_names_of_different_organizations(a, b):
    assert align_orgs(a, b) == 0


@pytest.mark.parametrize(("text", "want"), [
    ("12 N. Rosedale Dr - Rm 103", ("12", "n", "rosedale", "dr")), ("Twelve Rosedale Drv N", ("12", "n", "rosedale", "dr")), ("Suite 3, Rosedale Drive, 12", ("12", None, "rosedale", "dr")), ("12 NORTH EAST ninth ave #4", ("12", "ne", "9th", "ave")),
    ("8331 S.R. 986", ("8331", None, "route 986", None)), ("St Rd 986, 8331", ("8331", None, "route 986", None)), ("Lund Clinic - 12 Rosedale Ct", ("12", None, "rosedale", "ct")), ("12 Rosedale, Town, FL 03539-1234", ("12", None, "rosedale", None)),
])
def test_read_address(text, want):
    got = read_address(text, None, None, None)
    assert tuple(got[k] for k in ("num", "dir", "street", "suffix")) == want


def test_read_address_takes_everything():
    assert read_address("12 Rosedale, Town, FL 03539-1234", None, None, None)["zip5"] == "03539" and read_address(None, "a", "b", "c") is None
    for t in ("", ",", "#", "Suite 4", "12", "N", "x" * 50_000, "-- - --", "Fl 3", "PO Box 12"):
        read_address(t, None, None, None)


def places_of(spark, data):
    df = spark.createDataFrame(data, "id long, address string, city string, state string, zip string").withColumn("num", F.lit("clash"))
    read = addresses.read_addresses(df, ["id"])
    got = addresses.with_place(read, addresses.places(read))
    return rows(addresses.same_place(got, got, "id", "id").where("id_a < id_b"))


def test_places(spark):
    data = [
        (1, "12 N Rosedale Drive", "Town", "FL", "11111"), (2, "12 Rosedale", "Town", "FL", "11111"), (3, "Twelve North Rosedael Dr., Ste 4", "TOWN", None, "11111-0001"), (4, "12 N Rosedale Dr", "Town", "Florida", None),
        (5, "12 S Rosedale Drive", "Ryde", "FL", "22222"), (6, "120 N Rosedale Drive", "Town", "FL", "11111"), (7, "12 Rosedale Ct", "Ryde", "FL", "22222"), (8, None, "Town", "FL", "11111"), (9, "12 N Rosedale Drive", "Town", "FL", "11111"),
    ]
    assert places_of(spark, data) == sorted(((str(a), str(b)) for a, b in combinations([1, 2, 3, 4, 9], 2)), key=repr)
    assert places_of(spark, []) == []


def test_missing_part_that_two_places_could_fill_links_neither(spark):
    data = [(1, "12 N Rosedale Dr", "Town", "FL", "11111"), (2, "12 S Rosedale Dr", "Town", "FL", "11111"), (3, "12 Rosedale Dr", "Town", "FL", "11111")]
    assert places_of(spark, data) == []


def test_components_equal_brute_force(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = {x.id: x.root for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want and graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neighbours_equal_brute_force(spark):
    r = random.Random(5)
    ts = sorted({"".join(r.choice("abc") for _ in range(r.randint(3, 6))) for _ in range(120)})
    got = {(x.t, x.u) for x in graph.neighbours(spark.createDataFrame([(t,) for t in ts], "t string")).collect()}
    assert got == {(a, b) for a in ts for b in ts if a == b or (min(len(a), len(b)) >= 4 and near(a, b, 1))}


def test_neighbours_two_edits_equal_brute_force(spark):
    r = random.Random(6)
    ts = sorted({"".join(r.choice("ab") for _ in range(r.randint(5, 10))) for _ in range(80)} | {"lundqvist", "lumdqvost", "ulndqvits", "lundqvistas"})
    got = {(x.t, x.u) for x in graph.neighbours(spark.createDataFrame([(t,) for t in ts], "t string")).collect()}
    assert got == {(a, b) for a in ts for b in ts if near(a, b, 2 if min(len(a), len(b)) >= 7 else 1)} and {("lundqvist", "lumdqvost"), ("lundqvist", "ulndqvits")} <= got


def test_forms_of_tokens_do_not_come_to_the_driver(spark, monkeypatch):
    """The index is many times as large as the vocabulary that Spark judges it by, so it is never broadcast."""
    plans, write = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    assert graph.neighbours(spark.createDataFrame([("lundqvist",), ("lumdqvist",), ("berg",)], "t string")).count() == 5
    assert any("explode" in p for p in plans) and not any("Broadcast" in p for p in plans)


LISTING = "provider_id long, full_name string, npi string, phone string, practice_name string, specialty string, address string, city string, state string, zip string"


def listing(i, name, npi=None, phone=None, practice="Lund Clinic", specialty="Cardiology", address="12 Rosedale Dr", zip_="11111"):
    return (i, name, npi, phone, practice, specialty, address, "Town", "FL", zip_)


def persons(spark, data):
    people = linking.people(spark.createDataFrame(data, LISTING).withColumn("id", F.lit("clash")))
    return rows(linking.pairs_of(linking.person_classes(people)))


def test_persons(spark):
    n1, n2 = "1710588744", "1194013169"
    data = [
        listing(1, "Robert Lundqvist", n1), listing(2, "Lundqvist, Bob", f"NPI {n1}", address=None, zip_=None), listing(3, "R. Lundqvist"), listing(4, "Robert Ryde", n1, address=None, zip_=None),
        listing(5, "Robert Lundqvist", n2, address="99 Far St", zip_="22222", practice="Other"), listing(6, "Robert Bergman"), listing(7, None), listing(8, "Robret Lundqvist", address=None, phone=None, specialty=None),
    ]
    assert persons(spark, data) == sorted(((str(a), str(b)) for a, b in combinations([1, 2, 3, 4, 8], 2)), key=repr)
    assert persons(spark, []) == []


@pytest.mark.parametrize(("a", "b"), [("Ada James", "A. James"), ("Robert Lundqvist", "R. Lumdqvost"), ("Ada Rosenfeldt", "A. Rosen"), ("Ada Lund Berg", "A. Lundberg")])
def test_candidates_are_as_wide_as_the_alignment(spark, a, b):
    assert align_persons(a, b) > linking.NEAR_CONTEXT
    assert persons(spark, [listing(1, a, phone="407-555-0101"), listing(2, b, phone="407-555-0101", address=None, zip_=None, practice=None)]) == [("1", "2")]


def test_listings_without_a_code_meet_whichever_id_is_less(spark):
    for a, b in ((1, 2), (2, 1)):
        assert persons(spark, [listing(a, "Ada Lund", address=None, zip_=None), listing(b, "Lund, Ada")]) == [("1", "2")]


def test_given_names_alone_let_none_meet(spark):
    """Of 60 listings of one given name and place, without numbers, only the two that share a family name are candidates."""
    families = ["".join(random.Random(i).choice("bcdfghklmnprst") + random.Random(-i - 1).choice("aeiou") for i in range(k * 5, k * 5 + 5)) for k in range(59)]
    assert len({*families}) == 59
    people = linking.people(spark.createDataFrame([listing(i, f"Robert {f}") for i, f in enumerate([*families, families[0]])], LISTING))
    got = {(x.x, x.y) for x in linking.near_candidates(people).collect()}
    assert (0, 59) in got and len(got) < 60


def test_family_tokens_hold_what_names_agree_by():
    names = ["Ada James", "A. James", "James, Ada", "Ada Lund Berg", "A. Lundberg", "Ada Rosen", "Rosenfeldt, A", "Ada Maria Lund", "Lund Ada", "Maria Lund", "Lund", "Maria", "Robert Lumdqvost", "Robert Lundqvist", "Lundqvist Robert J"]
    for a, b in combinations(names, 2):
        x, y = names_.family_tokens(a), names_.family_tokens(b)
        meet = any(not (g and h) and (t == u or (not (begun or begun2) and min(len(t), len(u)) > 3 and near(t, u, 2 if min(len(t), len(u)) >= 7 else 1))) for t, (g, begun) in x.items() for u, (h, begun2) in y.items())
        assert meet or align_persons(a, b) == 0, (a, b)


def test_many_rows_of_one_number_meet_as_few_do(spark, monkeypatch):
    n1 = "1710588744"
    data = [listing(i, n, n1, address=None, zip_=None) for i, n in enumerate(["Robert Lundqvist", "Bob Lumdqvist", "R. Lundqvist", "Ada Berg", "Bob Ryde", "Ada Rydholm"], 1)]
    want = persons(spark, data)
    monkeypatch.setattr(linking, "MANY", 2)
    assert persons(spark, data) == want and ("1", "2") in want


def test_tables_and_shuffle_files_go_when_a_step_ends(spark):
    folder, held = Path(session.scratch(spark).removeprefix("file:")), []
    inside = lambda: {p for p in folder.rglob("*.parquet") if p.is_file()}
    session.written(spark.range(1))
    before, setting = inside(), spark.conf.get(session._CLEANUP, None)
    shuffles = lambda: spark._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    known = shuffles()

    def make():
        step = session.written(spark.range(1000).repartition(7).groupBy("id").count())
        held.append(inside() - before)
        return session.kept(spark, lambda: step.where("id < 10"))

    out = session.kept(spark, make)
    left = shuffles()
    assert held[0] and not held[0] & inside() and out.count() == 10
    assert len(inside() - before) == len(out.inputFiles()) and left <= known and spark.conf.get(session._CLEANUP, None) == setting


def test_generations_at_one_place(spark):
    n1, n2 = "1710588744", "1194013169"
    data = [listing(1, "Ada Lund Jr", n1), listing(2, "Ada Lund Sr", n2), listing(3, "Lund Jr, Ada"), listing(4, "Ada Lund Sr.")]
    assert persons(spark, data) == [("1", "3"), ("2", "4")]
    # Drawn equally to both: to neither.
    assert persons(spark, [*data[:2], listing(5, "Ada Lund")]) == []


def test_listings_without_number_join_to_a_fixpoint(spark, monkeypatch):
    n1, n2 = "1710588744", "1194013169"
    npi = {1: n1, 10: n1, 11: n2}
    # A chain of five from one with a number; 12 is drawn equally to two classes, 13 and 14 are linked to it only.
    links = [(a, b, 2.0, npi.get(a), npi.get(b)) for a, b in [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (10, 12), (11, 12), (12, 13), (13, 14)]]
    monkeypatch.setattr(linking, "person_links", lambda _: spark.createDataFrame(links, "a long, b long, weight double, npi_a string, npi_b string"))
    people = spark.createDataFrame([(i, npi.get(i)) for i in (*range(1, 7), *range(10, 15))], "id long, npi string")
    want = [*combinations(range(1, 7), 2), *combinations((12, 13, 14), 2)]
    assert rows(linking.pairs_of(linking.person_classes(people))) == sorted(((str(a), str(b)) for a, b in want), key=repr)


ORG = "organization_id long, name string, organization_type string, phone string, website string, address string, city string, state string, zip string"


def test_organizations_and_practices(spark):
    orgs = [
        (1, "Lundmark General Hospital", "hospital", None, None, "12 Rosedale Dr", "Town", "FL", "11111"), (2, "General Hosp. of Lundmrk, Inc.", None, None, None, None, "Town", "FL", None), (3, "Lundmark General Hospital", None, None, None, None, "Ryde", "FL", "22222"),
        (4, "Lundmark General Hospital North Campus", None, "407-555-0101", None, "9 Elm St", "Town", "FL", "11111"), (5, "Lundmark General Hospital South Campus", None, None, None, None, "Town", "FL", "11111"), (6, None, None, None, None, None, None, None, None), (7, "LGH Town", None, None, None, None, "Town", "FL", "11111"),
    ]
    listings = [listing(1, "x", practice="LUNDMARK GEN HSPTL"), listing(2, "x", practice="Lundmark General Hospital So. Campus"), listing(3, "x", practice=None), listing(4, "x", practice="n/a")]
    rows_ = linking.mentions(spark.createDataFrame(orgs, ORG), spark.createDataFrame(listings, LISTING)).cache()
    links = linking.org_links(rows_)
    classes = linking.org_classes(links)
    same = {(int(a) // 2, int(b) // 2) for a, b in rows(linking.pairs_of(classes))}
    assert {(1, 2), (1, 7)} <= same and not same & {(1, 3), (4, 5), (1, 5)}
    practice = {(int(a), int(b)) for a, b in rows(linking.practice_pairs(links, classes))}
    assert {(1, 1), (2, 1), (5, 2)} <= practice and all(b < 3 for _, b in practice) and (3, 1) not in practice


def test_hospitals(spark):
    orgs = [(i, n, t, p, w, None, c, s, z) for i, n, t, p, w, c, s, z in [
        (1, "Lundmark General Hospital", "hospital", "407-555-0101", None, "Town", "FL", "11111"), (2, "Lundmark Gen Hosp.", "hospital", None, None, "Town", "FL", None), (3, "Berglund Children's Hospital", None, None, "https://www.bch.example", "Ryde", "Texas", "22222"),
        (4, "Lundmark General Hospital", "hospital", "407-555-0199", None, "Far", "TX", "33333"), (5, "Lundmark Clinic", "practice", "407-555-0101", None, "Town", "FL", "11111"), (6, None, None, None, None, None, None, None), (7, "Rydholm Specialty Hospital", "hospital", None, None, "Ryde", "TX", "22222"),
    ]]
    hif = [(1, "LUNDMARK GENERAL HOSPITAL", None, "Town", "FLORIDA", "11111", None, "NOT AVAILABLE"), (2, "General Hospital, Lundmrak", None, "Town", "FL", "11111", "(407) 555-0101", None), (3, "Old Name Hospital", "Children's Hospital of Berglund", "Ryde", "TX", "22222", None, "http://bch.example/home"), (4, "UNKNOWN MEDICAL CENTER", None, "Town", "FL", "11111", None, None), (5, None, None, None, None, None, None, None)]
    left = hospitals.records(hospitals.from_organizations(spark.createDataFrame(orgs, ORG).withColumn("id", F.lit("clash"))))
    right = hospitals.records(hospitals.from_hifld(spark.createDataFrame(hif, "hifld_id long, name string, alt_name string, city string, state string, zip string, telephone string, website string")))
    got = hospitals.matches(left, right)
    assert rows(got, "l", "r") == [("1", "1"), ("1", "2"), ("2", "1"), ("2", "2"), ("3", "3")]
    assert all(hospitals.LEAST <= r.confidence < 1 for r in got.collect())
    assert hospitals.matches(left.limit(0), right).count() == 0
