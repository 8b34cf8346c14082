"""Names, numbers, addresses and websites as column expressions.

All patterns are Unicode-aware and no expression raises: what can't be read
gives NULL (or an empty array), as every docstring says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.functions.states import STATE_CODES

#: Spellings of an empty cell by source.
PLACEHOLDERS = {
    "cms": ("", "not available"),
    "hifld": ("not available", "no website", "n/a", "na", "none", "-", ""),
    "osm": ("", "n/a", "na", "none", "-"),
    "va": ("",),
}
#: Words of an address and their short forms.
ADDRESS_WORDS = {
    "street": "st", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "road": "rd", "lane": "ln", "court": "ct", "place": "pl", "parkway": "pkwy", "highway": "hwy",
    "suite": "ste", "building": "bldg", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw", "north": "n", "south": "s", "east": "e", "west": "w",
}
#: Generations that aren't a family name, and words that prove nothing about an organization.
GENERATIONS = ("JR", "SR", "II", "III", "IV", "V")
GENERIC_WORDS = ("medical", "center", "centre", "hospital", "health", "healthcare", "system", "systems", "regional", "general", "clinic", "group", "medicine", "care", "community")
DOMAIN_ENDINGS = ("com", "org")


def collapse(c: Column) -> Column:
    """Trimmed, with every run of white space one space."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def filled(c: Column) -> Column:
    """The value, or NULL if it is '' (white space counts as a value)."""
    return F.nullif(c, F.lit(""))


def without_placeholder(c: Column, source: str) -> Column:
    """The trimmed value, or NULL where the source's spelling says that nothing is there."""
    return F.when(~F.lower(F.trim(c)).isin(*PLACEHOLDERS[source]), F.trim(c))


def npi_valid(c: Column) -> Column:
    """Exactly ten digits whose check digit is right for the prefix 80840; NULL is false."""
    return F.coalesce(c.rlike("^[0-9]{10}$") & F.call_function("luhn_check", F.concat(F.lit("80840"), c)), F.lit(False))


def comma_parts(c: Column) -> Column:
    """The parts between commas, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(collapse(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def name_part(c: Column) -> Column:
    """What stands before the first comma; '' stays ''."""
    return F.trim(F.get(F.split(collapse(c), ","), F.lit(0)))


def credential_part(c: Column) -> Column:
    """What stands behind the first comma, joined by ', '; '' without a comma."""
    after = F.filter(F.transform(F.slice(F.split(collapse(c), ","), 2, 1000), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(c.isNotNull(), F.array_join(after, ", "))


def merged_credentials(creds: Column, title: Column) -> Column:
    """Credentials with those of a title that aren't among them, in order, regardless of case."""
    have = F.coalesce(comma_parts(creds), F.array().cast("array<string>"))
    said = F.filter(F.transform(F.split(F.coalesce(credential_part(title), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")

    def add(acc: Column, x: Column) -> Column:
        known = F.exists(acc, lambda y: F.upper(y) == F.upper(x))
        return F.when(known, acc).otherwise(F.concat(acc, F.array(x)))

    return F.array_join(F.aggregate(said, have, add), ", ")


def credential_tokens(c: Column) -> Column:
    """Distinct credentials in capitals without dots; NULL gives an empty array."""
    parts = F.transform(F.split(F.upper(F.coalesce(c, F.lit(""))), r"(?U)[,\s/]+"), lambda t: F.replace(t, F.lit("."), F.lit("")))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def _name_tokens(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(collapse(c), F.lit("")), " "), lambda t: t != "")


def first_name(c: Column) -> Column:
    """The first of at least two tokens, else NULL."""
    ts = _name_tokens(c)
    return F.when(F.size(ts) >= 2, F.get(ts, F.lit(0)))


def last_name(c: Column) -> Column:
    """The last of at least two tokens, but not a generation if there are three or more."""
    ts = _name_tokens(c)
    generation = F.upper(F.replace(F.try_element_at(ts, F.lit(-1)), F.lit("."), F.lit(""))).isin(*GENERATIONS)
    return F.when(F.size(ts) >= 2, F.when((F.size(ts) >= 3) & generation, F.try_element_at(ts, F.lit(-2))).otherwise(F.try_element_at(ts, F.lit(-1))))


def clean_phone(c: Column) -> Column:
    """NNN-NNN-NNNN from ten digits, or eleven that begin with 1, else NULL."""
    digits = F.regexp_replace(F.regexp_replace(c, "[^0-9]", ""), "^1(?=[0-9]{10}$)", "")
    return F.when(F.length(digits) == 10, F.regexp_replace(digits, "^(...)(...)(....)$", "$1-$2-$3"))


def org_key(c: Column) -> Column:
    """Lower case with single spaces. NULL and '' give NULL, white space alone ''."""
    return F.when(c != "", collapse(F.lower(c)))


def address_key(address: Column, state: Column, zip_code: Column) -> Column:
    """street|ST|ZIP5 with short forms, or NULL without address or digits in the zip. The town takes no part."""
    street = F.regexp_replace(F.lower(address), "[.,#]", " ")
    street = reduce(lambda s, w: F.regexp_replace(s, rf"\b{w}\b", ADDRESS_WORDS[w]), sorted(ADDRESS_WORDS, key=lambda w: (-len(w), w)), street)
    five = F.substring(F.regexp_replace(zip_code, "[^0-9]", ""), 1, 5)
    key = F.concat(collapse(street), F.lit("|"), F.substring(F.upper(F.trim(F.coalesce(state, F.lit("")))), 1, 2), F.lit("|"), five)
    return F.when((F.trim(address) != "") & (five != ""), key)


def title_case(c: Column) -> Column:
    """A capital after anything that isn't a letter, small letters elsewhere."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def names_match(shown: Column, first: Column, last: Column) -> Column:
    """Whether a registry's names stand in a shown name; NULL if that can't be told."""
    letters = F.regexp_replace(F.lower(shown), "[^a-z ]", "")
    f, ln = F.coalesce(F.lower(F.trim(first)), F.lit("")), F.coalesce(F.lower(F.trim(last)), F.lit(""))
    return F.when((F.coalesce(shown, F.lit("")) != "") & (ln != ""), F.contains(letters, ln) & ((f == "") | F.contains(letters, f)))


def first_label(c: Column, patterns: list[tuple[str, str]]) -> Column:
    """The label of the first pattern found, else NULL."""
    return F.coalesce(*[F.when(c.rlike(f"(?iU){p}"), F.lit(label)) for p, label in patterns], F.lit(None).cast("string"))


def name_words(c: Column) -> Column:
    """Words of letters and digits in lower case; NULL gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))


def candidate_domains(c: Column) -> Column:
    """Domains a name suggests: all its words, then with one generic word less at the end each time, per ending.

    A first word alone is never suggested if it had others behind it.
    """
    ws = name_words(c)
    generic = F.transform(ws, lambda w: w.isin(*GENERIC_WORDS))
    # Length of the run of generic words at the end, leaving at least two words or the whole name.
    run = F.aggregate(F.reverse(generic), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, g: F.struct((a["n"] + F.when(a["on"] & g, 1).otherwise(0)).alias("n"), (a["on"] & g).alias("on")))["n"]
    keep = F.transform(F.sequence(F.lit(0), run), lambda k: F.size(ws) - k)
    usable = F.filter(keep, lambda n: (n >= 2) | ((n == F.size(ws)) & (n >= 1)))
    return F.flatten(F.transform(usable, lambda n: F.transform(F.array(*map(F.lit, DOMAIN_ENDINGS)), lambda e: F.concat(F.array_join(F.slice(ws, F.lit(1), n), ""), F.lit("."), e))))


def distinctive_words(c: Column) -> Column:
    """Words of more than three letters that aren't generic."""
    return F.filter(name_words(c), lambda w: ~w.isin(*GENERIC_WORDS) & (F.length(w) > 3))


def page_mentions(page: Column, name: Column) -> Column:
    """Whether a page holds any distinctive word of the name; false where either is NULL."""
    low = F.lower(page)
    return F.coalesce(F.exists(distinctive_words(name), lambda w: F.contains(low, w)), F.lit(False))


def is_generated_name(name: Column, lines: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Whether a place's name is nothing but its address joined by '-'."""
    five = F.substring(F.regexp_replace(zip_code, "[^0-9]", ""), 1, 5)
    parts = F.filter(F.concat(F.coalesce(lines, F.array().cast("array<string>")), F.array(city, state, five)), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.coalesce(F.lower(F.trim(name)) == F.lower(F.array_join(parts, "-")), F.lit(False))


def list_text(c: Column) -> Column:
    """A list as text, ', ' between; NULL and empty lists give NULL."""
    return F.when(F.size(c) > 0, F.array_join(c, ", "))


def text_list(c: Column) -> Column:
    """The list in a text; NULL gives an empty one."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def first_filled(*cols: Column) -> Column:
    """The first value that isn't NULL or '', trimmed."""
    return F.trim(F.coalesce(*[filled(c) for c in cols]))


def with_scheme(c: Column) -> Column:
    """https:// before an address without a scheme."""
    return F.when(F.contains(c, F.lit("://")), c).otherwise(F.concat(F.lit("https://"), c))


def absolute_url(link: Column, base: Column) -> Column:
    """A link as seen from ``base``: whole ones stay, those with a leading / follow the host."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    return F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), link).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(F.regexp_replace(base, "[^/]*$", ""), link))


def host_within(url: Column, domain: str) -> Column:
    """Whether the host is the domain or lies below it."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce((host == domain) | host.endswith(f".{domain}"), F.lit(False))


def clipped(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def state_code(c: Column) -> Column:
    """The postal code of a state given by name or code, else NULL."""
    names = F.create_map(*[F.lit(x) for kv in STATE_CODES.items() for x in kv])
    key = F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(names, key), F.when(F.upper(key).isin(*sorted(set(STATE_CODES.values()))), F.upper(key)))


def zip5(c: Column) -> Column:
    return filled(F.substring(F.regexp_replace(c, "[^0-9]", ""), 1, 5))


def notes(*cols: Column) -> Column:
    """Remarks that are there, '; ' between; NULL if none is."""
    return filled(F.concat_ws("; ", *cols))
