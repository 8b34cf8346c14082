"""Which rows mean the same person or organization.

Candidates come from an index on (context, token): a context is a number, a
telephone, a place or a locality that two rows share, and tokens are looked up
with their symmetric-delete neighbours. Candidate names are aligned by optimal
assignment, and a pair is kept if its names agree as well as its context asks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm import addresses
from rosterlake.llm.addresses import read_address, read_city, read_state, read_zip
from rosterlake.llm.graph import components, neighbours
from rosterlake.llm.names import align_persons, family_tokens, person_tokens, read_person, share_given, share_token, use
from rosterlake.llm.orgnames import ACRONYM, align_orgs, own_tokens
from rosterlake.llm.survivors import told, valid_npi
from rosterlake.session import kept, spread, written

#: Agreement of persons' names that a context asks for: with a number, telephone, place or practice, and with a locality only.
NEAR_CONTEXT, LOCALITY_ONLY = 0.2, 0.6
#: Agreement that organizations' names need in a shared locality.
ORG_AGREES = 0.55


def ten_digits(col: Column) -> Column:
    """The ten digits of a telephone without extension, or null; zeros only are null."""
    bare = F.regexp_replace(F.lower(col), r"\s*(?:x|ext\.?|extension)\s*\d+\s*$", "")
    digits = F.regexp_replace(F.regexp_replace(bare, "[^0-9]", ""), "^1(?=[0-9]{10}$)", "")
    return F.when((F.length(digits) == 10) & ~digits.rlike("^0+$"), digits)


def site_of(col: Column) -> Column:
    """The host of a website without www., or null."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(col)), r"^(?:https?://)?(?:www\.)?([a-z0-9-]+(?:\.[a-z0-9-]+)+)", 1), F.lit(""))


def located(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the components of the address; rows without a street have only city, state and zip5."""
    cols = rows.select(*keep, *[F.col(c).cast("string") for c in ("address", "city", "state", "zip")])
    types = {f.name: f.dataType.simpleString() for f in cols.schema.fields}
    schema = ", ".join([f"{k} {types[k]}" for k in keep] + [f"{f} string" for f in addresses.FIELDS])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rest = dict.fromkeys(addresses.FIELDS)
            got = [
                read_address(a, c, s, z) or rest | {"city": read_city(c), "state": read_state(s), "zip5": read_zip(z)}
                for a, c, s, z in zip(pdf.address, pdf.city, pdf.state, pdf.zip)
            ]
            yield pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(got, columns=addresses.FIELDS, dtype=object)], axis=1)

    return spread(cols).mapInPandas(read, schema)


def placed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``located`` with the place of each address (null without one)."""
    read = written(located(rows, keep))
    whole = read.where("street is not null and num is not null")
    found = addresses.places(whole)
    keyed = found.select(*[F.col(f).alias(f"p_{f}") for f in addresses.FIELDS], "place")
    on = reduce(Column.__and__, [F.col(f).eqNullSafe(F.col(f"p_{f}")) for f in addresses.FIELDS])
    return read.join(keyed, on, "left").drop(*[f"p_{f}" for f in addresses.FIELDS])


def tokens_of(rows: DataFrame, how) -> DataFrame:
    """(id, t): the index tokens of ``name`` by the function ``how``."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, t) for i, n in zip(pdf["id"], pdf["name"]) for t in how(n)]
            yield pd.DataFrame(out, columns=["id", "t"]).astype({"id": "int64", "t": "object"})

    return rows.where("name is not null").select("id", "name").mapInPandas(cut_up, "id long, t string")


def families_of(rows: DataFrame) -> DataFrame:
    """(id, t, given, begun): the index tokens of ``names.family_tokens`` and what it tells of them."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, t, *how) for i, n in zip(pdf["id"], pdf["name"]) for t, how in family_tokens(n).items()]
            yield pd.DataFrame(out, columns=["id", "t", "given", "begun"]).astype({"id": "int64", "t": "object", "given": "bool", "begun": "bool"})

    return rows.where("name is not null").select("id", "name").mapInPandas(cut_up, "id long, t string, given boolean, begun boolean")


def contexts(rows: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """(id, c): the contexts of each row, as text of kind and value; null ones are left out."""
    made = F.array_compact(F.array(*[F.concat(F.lit(f"{k}|"), v) for k, v in kinds.items()]))
    return rows.select("id", F.explode(made).alias("c"))


def keyed(ctx: DataFrame, toks: DataFrame) -> DataFrame:
    """(id, k) and what else both have: the hash of each row's every context with its every token.

    A pair that meets by chance, for two of them having one hash, is judged
    by its names and contexts as any other.
    """
    return ctx.join(toks, "id").withColumn("k", F.xxhash64("c", "t")).drop("c", "t")


def looked_up(toks: DataFrame, near: DataFrame) -> DataFrame:
    """``toks`` with every token's neighbours in its place."""
    return toks.join(near, "t").drop("t").withColumnRenamed("u", "t").distinct()


def candidates(index: DataFrame, probe: DataFrame, asked: Column | None = None) -> DataFrame:
    """Distinct (x, y): x from ``index`` and y from ``probe`` share a context and a token or its neighbour.

    Both are ``keyed``, the probe, which should be the lesser, with its tokens
    ``looked_up``: that makes it many times longer. Rows meet on
    (context, token) only, so even a context that holds a third of all rows is
    spread by its tokens. ``asked`` is of both rows' other columns, as a. and b.
    """
    a, b = index.alias("a"), probe.alias("b")
    met = a.join(b, F.col("a.k") == F.col("b.k")).where("a.id <> b.id")
    return (met if asked is None else met.where(asked)).select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct()


def _same(f: str) -> Column:
    return F.coalesce(F.col(f"a.{f}") == F.col(f"b.{f}"), F.lit(False))


def _differ(f: str) -> Column:
    return F.coalesce(F.col(f"a.{f}") != F.col(f"b.{f}"), F.lit(False))


def _near_city() -> Column:
    return F.coalesce(F.levenshtein(F.col("a.city"), F.col("b.city")) <= 2, F.lit(False))


def aligned(pairs: DataFrame, a: str, b: str, how, out: str, extra: str | None = None) -> DataFrame:
    """Adds ``out``: how(name a, name b[, extra]) for the columns ``a`` and ``b``."""
    cols = [a, b] + ([extra] if extra else [])

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series([float(how(p, q, r) if extra else how(p, q)) for p, q, r in zip(x, y, z)], dtype="float64")

    return pairs.withColumn(out, score(*[F.col(c) for c in (*cols, *([a] if not extra else []))]))


# Persons


def people(providers: DataFrame) -> DataFrame:
    """What of each listing tells who it means: (id, name, npi, tel, practice, specialty, place, city, state, zip5)."""
    told_of = providers.where("provider_id is not null").select(
        F.col("provider_id").alias("id"), F.col("full_name").alias("name"), valid_npi(F.col("npi")).alias("npi"), ten_digits(F.col("phone")).alias("tel"),
        told(F.col("practice_name")).alias("practice"), F.lower(F.trim(told(F.col("specialty")))).alias("specialty"), "address", "city", "state", "zip",
    )
    return placed(told_of, ["id", "name", "npi", "tel", "practice", "specialty"]).drop("num", "dir", "street", "suffix")


#: Numbers under which two given names must stand for each other, and their least share of the fuller one's numbers.
LEARNED_NUMBERS, LEARNED_SHARE = 4, 0.02


def learned_forms(rows: DataFrame) -> frozenset[tuple[str, str]]:
    """(given name, other form) pairs that the rows themselves show: one family name and number, two given names.

    Each number's most frequent given name is paired with its others, no
    others among themselves, so that a number on a third of all rows costs no
    more than its names. Pairs that typing errors or initials explain are left
    out, and those of fewer than LEARNED_NUMBERS numbers or LEARNED_SHARE of
    the name's numbers, as changes of name and errors in numbers are spread
    over many. What comes to the driver is at most 1 / LEARNED_SHARE forms per
    name that LEARNED_NUMBERS persons bear.
    """

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, name in zip(pdf.npi, pdf.name):
                given, family, _ = read_person(name)
                if given and family and len(given[0]) > 1:
                    out.append((n, "".join(family), given[0]))
            yield pd.DataFrame(out, columns=["npi", "family", "given"], dtype=object)

    named = rows.where("npi is not null and name is not null").select("npi", "name").mapInPandas(cut_up, "npi string, family string, given string")
    counted = written(named.groupBy("npi", "family", "given").agg(F.count("*").alias("n")))
    main = counted.groupBy("npi", "family").agg(F.max_by("given", F.struct("n", F.length("given"), "given")).alias("full"), F.count("*").alias("forms"))
    pairs = counted.join(main.where("forms > 1"), ["npi", "family"]).where("given <> full").groupBy("full", "given").agg(F.count("*").alias("n"))
    pairs = pairs.where(F.col("n") >= LEARNED_NUMBERS).where(F.levenshtein("full", "given") > 2)
    borne = main.groupBy("full").agg(F.count("*").alias("all"))
    return frozenset((r[0], r[1]) for r in pairs.join(borne, "full").where(F.col("n") >= LEARNED_SHARE * F.col("all")).select("full", "given").collect())


#: Rows of one number up to which all their names are compared; beyond, those that share a token.
MANY = 200


def same_number(rows: DataFrame, with_forms) -> DataFrame:
    """(a, b, npi): listings with one number whose names agree loosely, or in a given or family name alone."""
    numbered = rows.where("npi is not null and name is not null").select("id", "npi", "name")
    side = lambda df, i, n: df.select("npi", F.col("id").alias(i), F.col("name").alias(n))
    hot = written(numbered.groupBy("npi").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("npi"))
    few = numbered.join(hot, "npi", "left_anti")
    pairs = side(few, "x", "na").join(side(few, "y", "nb"), "npi").where("x < y")
    if hot.take(1):
        many = numbered.join(hot, "npi", "left_semi")
        toks, ctx = written(tokens_of(many, with_forms(lambda n: person_tokens(n, True)))), contexts(many, {"n": F.col("npi")})
        met = written(candidates(keyed(ctx, toks), keyed(ctx, looked_up(toks, neighbours(toks))), F.expr("a.id < b.id")))
        pairs = pairs.unionByName(met.join(side(many, "x", "na"), "x").join(side(many.drop("npi").withColumn("npi", F.lit(None)), "y", "nb").drop("npi"), "y"))
    agree = with_forms(lambda p, q: share_token(p, q) and (align_persons(p, q) > 0 or share_given(p, q)))
    return aligned(pairs, "na", "nb", agree, "agree").where("agree > 0").select(F.col("x").alias("a"), F.col("y").alias("b"), "npi")


def near_candidates(rows: DataFrame) -> DataFrame:
    """Distinct (x, y): listings, one of them without a number, that share a telephone, place, practice or locality, and whose names may agree.

    Those with one number are in ``same_number``, those with two are never
    linked. Names agree only if a family name of one is near one of the other,
    so given names alone let none meet.
    """
    toks = written(families_of(rows))
    # Beginnings are compared as they are.
    near = written(neighbours(toks.where("not begun")))
    bare, uncoded = rows.where("npi is null"), rows.where("zip5 is null")
    plain = toks.select("id", "t", "given").join(rows.select("id", F.col("npi").isNull().alias("bare")), "id")
    few = toks.join(bare.select("id").unionByName(uncoded.select("id")).distinct(), "id", "left_semi").join(rows.select("id", F.col("npi").isNull().alias("bare")), "id")
    # A given name looks for nothing that is never more than one.
    families = toks.where("not given").select(F.col("t").alias("u")).distinct().withColumn("family", F.lit(True))
    told_apart = near.join(families, "u", "left")
    probe = looked_up(few.where("not begun").drop("begun"), told_apart.withColumn("family", F.coalesce("family", F.lit(False)))).where("not given or family").drop("family")
    own = written(probe.unionByName(few.where("begun").select("id", "given", "bare", "t")))
    asked = F.expr("not (a.given and b.given)")
    # Under a telephone or postal code two rows without a number meet from both sides.
    once = asked & F.expr("not (a.bare and b.bare) or a.id < b.id")
    code, phone, more = {"z": F.col("zip5")}, {"p": F.col("tel")}, {"y": F.col("city"), "l": F.col("place").cast("string"), "o": F.lower("practice")}
    # A town, place or practice in common means a postal code in common, but for rows without one: only these look there.
    looks = ((rows, bare, code, once), (rows, bare, phone, once), (bare, uncoded, more, asked), (rows, bare.where("zip5 is null"), more, asked))
    met = [written(candidates(keyed(contexts(a, kinds), plain), keyed(contexts(b, kinds), own), how)) for a, b, kinds, how in looks]
    return reduce(DataFrame.unionByName, met).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def person_links(rows: DataFrame) -> DataFrame:
    """(a, b, weight, npi_a, npi_b): listings whose names and contexts agree; a < b.

    Listings with two different valid numbers are never linked. With the same
    number, telephone, place or practice, names may agree loosely, and with
    the same number a given or family name alone may (names change). With
    only the locality in common, names must agree well and specialties not
    differ. Rows without a name have no links. Links by number have no weight.
    """
    spark = rows.sparkSession
    learned = learned_forms(rows)

    def with_forms(how):
        def call(*names):
            use(learned)
            return how(*names)

        return call

    numbered = kept(spark, lambda: same_number(rows, with_forms))
    pairs = kept(spark, lambda: near_candidates(rows))
    full = pairs.join(rows.alias("a"), F.col("x") == F.col("a.id")).join(rows.alias("b"), F.col("y") == F.col("b.id")).where(~_differ("npi"))
    flat = full.select(
        "x", "y", F.col("a.name").alias("na"), F.col("b.name").alias("nb"), F.col("a.practice").alias("pa"), F.col("b.practice").alias("pb"), F.col("a.npi").alias("npi_a"), F.col("b.npi").alias("npi_b"),
        _same("tel").alias("same_tel"), _same("place").alias("same_place"), (_same("zip5") | (_near_city() & ~_differ("zip5") & ~_differ("state"))).alias("same_town"),
        _same("specialty").alias("same_specialty"), _differ("specialty").alias("other_specialty"),
    ).where("same_tel or same_place or same_town")
    asked = aligned(flat, "na", "nb", with_forms(align_persons), "score").where(F.col("score") >= NEAR_CONTEXT)
    asked = aligned(asked, "pa", "pb", lambda p, q: align_orgs(p, q) if p and q else 0.0, "practice")
    at_work = F.col("same_tel") | F.col("same_place") | (F.col("practice") >= ORG_AGREES) & F.col("same_town")
    ok = at_work | (F.col("same_town") & (F.col("score") >= LOCALITY_ONLY) & ~F.col("other_specialty"))
    flag = lambda c, w: F.when(F.col(c), w).otherwise(0.0)
    weight = F.col("score") * 2 + flag("same_tel", 1.0) + flag("same_place", 1.0) + F.when(F.col("practice") >= ORG_AGREES, 1.0).otherwise(0.0) + flag("same_specialty", 0.5)
    loose = asked.where(ok).select(F.col("x").alias("a"), F.col("y").alias("b"), weight.alias("weight"), "npi_a", "npi_b")
    return loose.unionByName(numbered.select("a", "b", F.lit(None).cast("double").alias("weight"), F.col("npi").alias("npi_a"), F.col("npi").alias("npi_b")))


def person_classes(rows: DataFrame) -> DataFrame:
    """(id, root): the listings of one person; listings without links are left out.

    Listings with one number are joined first. A listing without a number
    joins the class it is linked to with the greatest weight, and may draw
    others in turn, until none joins: as many rounds as the longest chain has
    links, each written to the shared folder. One that is drawn equally to two
    classes joins none. What remains is joined among itself.
    """
    links = kept(rows.sparkSession, lambda: person_links(rows))
    core = components(links.where("npi_a = npi_b"))
    ends = links.where("npi_a is null or npi_b is null")
    sides = written(ends.select(F.col("a").alias("id"), F.col("npi_a").alias("own"), F.col("b").alias("other"), "weight").unionByName(ends.select(F.col("b").alias("id"), F.col("npi_b").alias("own"), F.col("a").alias("other"), "weight")))
    # Every row with a number is a class, if only of itself.
    settled = rows.where("npi is not null").select("id").join(core, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    while True:
        loose = sides.where("own is null").join(settled.select("id"), "id", "left_anti")
        drawn = written(loose.join(settled.select(F.col("id").alias("other"), "root"), "other").groupBy("id", "root").agg(F.max("weight").alias("w")))
        best = drawn.groupBy("id").agg(F.max(F.struct("w", "root")).alias("m"), F.max("w").alias("top"))
        # Of the classes' weights only the two greatest matter; an equal second is a second class of the top weight.
        second = drawn.join(best.select("id", "top", F.col("m.root").alias("first")), "id").where((F.col("root") != F.col("first")) & (F.col("w") >= F.col("top") - 1e-9)).select("id").distinct()
        joined = written(best.join(second, "id", "left_anti").select("id", F.col("m.root").alias("root")))
        if not joined.take(1):
            break
        settled = written(settled.unionByName(joined))
    # Who is left is linked to no class, or drawn equally to two.
    left = ends.where("npi_a is null and npi_b is null")
    for e in ("a", "b"):
        left = left.join(settled.select(F.col("id").alias(e)), e, "left_anti")
    return settled.unionByName(components(left))


def pairs_of(classes: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all rows of one class."""
    a, b = classes.alias("a"), classes.alias("b")
    return a.join(b, (F.col("a.root") == F.col("b.root")) & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").cast(id_type).alias("id_a"), F.col("b.id").cast(id_type).alias("id_b"))


# Organizations


def mentions(organizations: DataFrame, providers: DataFrame) -> DataFrame:
    """Organizations (even ids) and the practices that listings name (odd ids, one per listing)."""
    cols = ["address", "city", "state", "zip"]
    org = organizations.where("organization_id is not null").select((F.col("organization_id") * 2).alias("id"), F.col("name"), ten_digits(F.col("phone")).alias("tel"), site_of(F.col("website")).alias("site"), *cols)
    pro = providers.where("provider_id is not null").select((F.col("provider_id") * 2 + 1).alias("id"), told(F.col("practice_name")).alias("name"), ten_digits(F.col("phone")).alias("tel"), F.lit(None).cast("string").alias("site"), *cols)
    return placed(org.unionByName(pro), ["id", "name", "tel", "site"]).drop("num", "dir", "street", "suffix")


def _is_org(col: str = "id") -> Column:
    return F.col(col) % 2 == 0


def org_candidates(rows: DataFrame) -> DataFrame:
    """Distinct (x, y): an organization x, and an organization (x < y) or practice y that shares a locality, telephone or website and a token."""
    toks = written(tokens_of(rows, own_tokens))
    near = written(neighbours(toks))
    few = rows.where(_is_org() | F.col("zip5").isNull()).select("id")
    own = written(looked_up(toks.join(few, "id", "left_semi"), near))
    coded = contexts(rows, {"z": F.col("zip5")})
    # Rows with postal codes meet in these; what else is in common is asked only where one of the two has none.
    other = contexts(rows, {"c": F.col("city"), "l": F.col("place").cast("string"), "p": F.col("tel"), "w": F.col("site")})
    bare = other.join(rows.where("zip5 is null").select("id"), "id", "left_semi")
    # Organizations look for all rows, or rows without a postal code, whatever they are, for organizations.
    found = written(candidates(keyed(coded, toks), keyed(coded.where(_is_org()), own), ~_is_org("a.id") | F.expr("b.id < a.id")))
    lost = written(candidates(keyed(other, toks), keyed(bare.where(_is_org()), own), ~_is_org("a.id") | F.expr("b.id < a.id")))
    theirs = written(candidates(keyed(other.where(_is_org()), toks), keyed(bare, own), ~_is_org("b.id") | F.expr("a.id < b.id")))
    return theirs.unionByName(found.unionByName(lost).select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()


def org_links(rows: DataFrame) -> DataFrame:
    """(a, b, score): an organization a, and an organization (a < b) or practice b that means the same.

    Names must agree and the rows lie in one locality: the same postal code,
    or town where one has no code, or place or telephone. Different postal
    codes, states or telephones without a common place contradict. Campuses
    named apart are apart. Rows without a name have no links.
    """
    pairs = kept(rows.sparkSession, lambda: org_candidates(rows))
    full = pairs.join(rows.alias("a"), F.col("x") == F.col("a.id")).join(rows.alias("b"), F.col("y") == F.col("b.id"))
    town = _near_city() & ~_differ("zip5")
    sure = _same("place") | _same("tel")
    here = sure | _same("zip5") | town
    against = (_differ("zip5") & ~_same("place")) | _differ("state") | (_is_org("y") & _differ("tel") & ~_same("place"))
    flat = full.where(here & ~against).select("x", "y", F.col("a.name").alias("na"), F.col("b.name").alias("nb"), F.coalesce("a.city", "b.city").alias("city"), (sure | _same("site")).alias("sure"), _same("zip5").alias("zip"))
    scored = aligned(flat, "na", "nb", align_orgs, "score", "city")
    ok = (F.col("score") > ORG_AGREES) | ((F.col("score") >= ACRONYM - 1e-9) & (F.col("sure") | F.col("zip"))) | ((F.col("score") > 0.3) & F.col("sure"))
    return scored.where(ok).select(F.col("x").alias("a"), F.col("y").alias("b"), (F.col("score") + F.when(F.col("sure"), 0.5).otherwise(0.0)).alias("score"))


def org_classes(links: DataFrame) -> DataFrame:
    """(id, root) of organizations that are linked."""
    return components(links.where(_is_org("b")).select("a", "b"))


def practice_pairs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(id_a, id_b): an organization and a listing whose practice means it or another row of its class.

    A practice belongs to the class it agrees with best.
    """
    own = links.where(~_is_org("b")).join(classes.select(F.col("id").alias("a"), "root"), "a", "left").select("b", F.coalesce("root", "a").alias("root"), "score")
    drawn = own.groupBy("b", "root").agg(F.max("score").alias("score"))
    top = drawn.groupBy("b").agg(F.max("score").alias("top"))
    best = drawn.join(top, "b").where("score >= top - 1e-9").select("b", "root")
    members = classes.select("id", "root").unionByName(best.select(F.col("root").alias("id"), "root")).distinct()
    return best.join(members, "root").select((F.col("id") / 2).cast("bigint").alias("id_a"), ((F.col("b") - 1) / 2).cast("bigint").alias("id_b"))
