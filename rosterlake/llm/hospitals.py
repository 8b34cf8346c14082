"""Matching hospitals of two sources that share no number.

Method: deterministic rule cascade. Successive exact joins on weaker and weaker
combinations of attributes; records that a rule resolves are taken out by
anti-joins before the next, and a pair's confidence is the labelled precision of
its rule, smoothed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.addresses import deletes, read_address, read_city, read_state, read_zip
from rosterlake.llm.graph import components
from rosterlake.llm.linking import aligned, site_of, ten_digits
from rosterlake.llm.orgnames import _KNOWN, align_orgs, initials, read_org, versions
from rosterlake.llm.survivors import told
from rosterlake.session import Growing, cut, spread, written

#: Rules, the strongest first: keys of both sides that must be equal, and whether the names must also agree.
_RULES = [
    ("name, zip", ["full", "zip5"], False),
    ("telephone", ["tel"], False),
    ("name, city, state", ["full", "city", "state"], False),
    ("site, zip", ["site", "zip5"], True),
    ("own words, zip", ["own", "zip5"], True),
    ("own words, city, state", ["own", "city", "state"], True),
    ("own words but a letter, zip", ["fuzzy", "zip5"], True),
    ("own words but a letter, city, state", ["fuzzy", "city", "state"], True),
    ("initials, zip", ["short", "zip5"], True),
    ("initials, city, state", ["short", "city", "state"], True),
    ("site, city, state", ["site", "city", "state"], True),
    ("site, state", ["site", "state"], True),
    ("name, state", ["full", "state"], True),
    ("name, city", ["full", "city"], True),
    ("own words but a letter, state", ["fuzzy", "state"], True),
]
NAMES = [name for name, _, _ in _RULES]
RULES = {n: (keys, check) for n, (_, keys, check) in enumerate(_RULES)}
#: Each rule is a pass of its own.
PASSES = [[n] for n in RULES]
#: Rules that ask for the site: their labels are telephones; those of the others are sites.
BY_SITE = [n for n, (keys, _) in RULES.items() if "site" in keys]
#: Beta prior of a rule's precision, and the least confidence of a match.
PRIOR, LEAST = (2.0, 1.0), 0.5


def records(rows: DataFrame) -> DataFrame:
    """Adds the keys of the rules to rows with (id, name, alt, tel, site, address, city, state, zip).

    ``full``: all words spelled out, in order of the alphabet, with the campus;
    ``own``: those that name the hospital; ``short``: initials. Each is an
    array, as a row may have several names. A name that holds the town has keys with and without it.
    """
    schema = "id long, name string, alt string, tel string, site string, city string, state string, zip5 string, full array<string>, own array<string>, short array<string>"
    cols = ["id", "name", "alt", "tel", "site", "address", "city", "state", "zip"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, name, alt, tel, site, address, city, state, code in pdf[cols].itertuples(index=False):
                at = read_address(address, city, state, code) or {"city": read_city(city), "state": read_state(state), "zip5": read_zip(code)}
                full, own, short = _names(name, alt, at["city"])
                out.append((i, name, alt, tel, site, at["city"], at["state"], at["zip5"], sorted(full), sorted(own), sorted(short)))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    keys = spread(rows.select(*[F.col(c).cast("string") if c != "id" else F.col(c) for c in cols])).mapInPandas(read, schema)
    fuzzy = F.array_distinct(F.flatten(F.transform("own", lambda o: F.transform(deletes(F.substring_index(o, "|", 1)), lambda d: F.concat_ws("|", d, F.substring_index(o, "|", -1))))))
    return written(keys.withColumn("fuzzy", fuzzy))


def _names(name: str | None, alt: str | None, city: str | None) -> tuple[set[str], set[str], set[str]]:
    """The keys full, own and short of a row's names."""
    full, own, short = set(), set(), set()
    town = frozenset((city or "").split()) - _KNOWN
    for n in [v for x in (name, alt) for v, _ in versions(x)]:
        for every, campus, acronym in read_org(n):
            for toks in {every, tuple(t for t in every if t not in town) or every}:
                full.add(" ".join(sorted(toks)) + "|" + campus)
                mine = "".join(sorted(t for t in toks if t not in _KNOWN))
                if mine:
                    own.add(mine + "|" + campus)
                if len(toks) > 1:
                    short.update({initials(toks), initials(toks, campus)})
            if acronym:
                short.add("".join(sorted(acronym)))
    return full, own, short


def _key_list(n: int, keys: list[str], _checked: bool) -> Column:
    """Rule n's keys of a record, as an array of (n, key); without any part of them it is empty."""
    many, single = [k for k in keys if k in ("full", "own", "short", "fuzzy")], [k for k in keys if k not in ("full", "own", "short", "fuzzy")]
    there = reduce(Column.__and__, [F.col(k).isNotNull() for k in single], F.lit(True))

    def key(m: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), F.concat_ws("\u0001", F.lit(str(n)), m, *single).alias("key"))

    return F.when(there, F.transform(F.col(many[0]), key) if many else F.array(key(F.lit("")))).otherwise(F.array())


def _keyed(side: DataFrame, resolved: DataFrame | None, step: list[int]) -> DataFrame:
    """One row per value of the combined keys of the step's rules, with ``open``: no rule has resolved the record.

    Each has what the join needs of the record, so that candidates are judged
    where they meet.
    """
    listed = [_key_list(n, *RULES[n]) for n in step]
    marked = side.withColumn("open", F.lit(True)) if resolved is None else side.join(resolved.withColumn("done", F.lit(True)), "id", "left").withColumn("open", F.col("done").isNull())
    names = F.array_compact(F.array("name", "alt"))
    return marked.select("id", "open", "tel", "site", "zip5", "state", "city", names.alias("names"), F.inline(F.flatten(F.array(*listed))))


def _agree(x: list | None, y: list | None, city: str | None) -> float:
    return max((align_orgs(p, q, city) for p in (x if x is not None else ()) for q in (y if y is not None else ()) if p and q), default=0.0)


def cascade(left: DataFrame, right: DataFrame, passes: list[list[int]] = PASSES) -> DataFrame:
    """(l, r, rule, ok, label): the pairs that each rule finds, ``ok`` those that count as found.

    A pass joins unresolved records of either side with all of the other, as
    one record may have several counterparts; a record that a pair counts for
    is resolved. No pair counts whose postal codes, states or telephones
    contradict. The label says whether an attribute is equal that neither the
    rule nor this test asks for: the site of pairs that count, and for rules
    that ask for the site the telephone, which is looked at in all of the
    rule's pairs that have two. Without two values it is null.
    """
    found, table = None, Growing(left.sparkSession)
    for step in passes:
        good = None if found is None else found.where("ok")
        a, b = (_keyed(side, None if good is None else good.select(F.col(e).alias("id")).distinct(), step).alias(m) for side, e, m in ((left, "l", "a"), (right, "r", "b")))
        same = lambda f: F.col(f"a.{f}") == F.col(f"b.{f}")
        fits = F.coalesce(same("zip5"), F.lit(True)) & F.coalesce(same("state"), F.lit(True))
        opened, by_site = F.col("a.open") | F.col("b.open"), F.col("a.n").isin(BY_SITE) if BY_SITE else F.lit(False)
        ok = opened & F.coalesce(same("tel"), F.lit(True))
        label = F.when(by_site, same("tel")).when(ok, same("site"))
        met = a.join(b, F.col("a.key") == F.col("b.key")).where(fits & (ok | (by_site & same("tel").isNotNull())))
        best = F.min(F.struct(F.col("a.n").alias("n"), ok.alias("ok"), label.alias("label"), F.coalesce("a.city", "b.city").alias("city"), F.col("a.names").alias("nx"), F.col("b.names").alias("ny")))
        pairs = met.groupBy(F.col("a.id").alias("l"), F.col("b.id").alias("r")).agg(best.alias("p")).select("l", "r", "p.*")
        checked = [n for n in step if RULES[n][1]]
        if checked:
            asked = F.col("n").isin(checked)
            pairs = aligned(pairs.withColumn("nx", F.when(asked, F.col("nx"))), "nx", "ny", _agree, "s", "city").where((F.col("s") > 0) | ~asked)
        # The next pass reads who is resolved from what the passes have written.
        found = table.add(pairs.select("l", "r", F.get(F.array(*map(F.lit, NAMES)), F.col("n")).alias("rule"), "ok", F.col("label").cast("int").alias("label")))
    return found


def precision(found: DataFrame) -> DataFrame:
    """(rule, labelled, right, confidence): the share of right pairs among a rule's labelled ones, smoothed by PRIOR."""
    a, b = PRIOR
    by = found.groupBy("rule").agg(F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("right"))
    return by.withColumn("confidence", (F.col("right") + a) / (F.col("labelled") + a + b))


def matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, r, rule, confidence): pairs of records of both sides that mean the same hospital.

    Pairs of one class (records joined through common counterparts) that no
    rule found themselves have the rule 'through others' and the least
    confidence of the class.
    """
    found = cascade(left, right)
    # A table as long as the list of rules.
    trust = F.broadcast(precision(found).where(F.col("confidence") >= LEAST).select("rule", "confidence"))
    kept = cut(found.where("ok").join(trust, "rule").groupBy("l", "r").agg(F.max_by("rule", "confidence").alias("rule"), F.max("confidence").alias("confidence")))
    # Both sides' ids in one space: even and odd.
    classes = cut(components(kept.select((F.col("l") * 2).alias("a"), (F.col("r") * 2 + 1).alias("b"))))
    least = kept.join(classes.select((F.col("id") / 2).cast("bigint").alias("l"), (F.col("id") % 2).alias("odd"), "root").where("odd = 0"), "l").groupBy("root").agg(F.min("confidence").alias("least"))
    l_side = classes.where("id % 2 = 0").select((F.col("id") / 2).cast("bigint").alias("l"), "root")
    r_side = classes.where("id % 2 = 1").select(((F.col("id") - 1) / 2).cast("bigint").alias("r"), "root")
    every = l_side.join(r_side, "root").join(least, "root").join(kept, ["l", "r"], "left")
    return every.select("l", "r", F.coalesce("rule", F.lit("through others")).alias("rule"), F.coalesce("confidence", "least").alias("confidence"))


def from_organizations(rows: DataFrame) -> DataFrame:
    """Organizations in the form that ``records`` reads; practices take no part."""
    kind = F.lower(F.trim("organization_type"))
    return rows.where(F.col("organization_id").isNotNull() & (kind.isNull() | (kind != "practice"))).select(
        F.col("organization_id").alias("id"), told(F.col("name")).alias("name"), F.lit(None).cast("string").alias("alt"), ten_digits(F.col("phone")).alias("tel"), site_of(F.col("website")).alias("site"), "address", "city", "state", "zip"
    )


def from_hifld(rows: DataFrame) -> DataFrame:
    """hifld_hospitals in the form that ``records`` reads."""
    return rows.where("hifld_id is not null").select(
        F.col("hifld_id").alias("id"), told(F.col("name")).alias("name"), told(F.col("alt_name")).alias("alt"), ten_digits(F.col("telephone")).alias("tel"), site_of(told(F.col("website"))).alias("site"),
        F.lit(None).cast("string").alias("address"), told(F.col("city")).alias("city"), told(F.col("state")).alias("state"), told(F.col("zip")).alias("zip"),
    )
