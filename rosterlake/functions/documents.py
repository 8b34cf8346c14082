"""Contact cards, pages and listings as column expressions; unreadable input gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.functions.text import clean_phone, filled

#: Kinds of JSON-LD nodes that describe a person who treats patients.
PERSON_TYPES = ("Physician", "Person", "MedicalBusiness", "IndividualPhysician")


def card_field(card: Column, name: str) -> Column:
    """The value of the last line of that name, whatever its parameters."""
    return F.trim(F.try_element_at(F.regexp_extract_all(card, F.lit(rf"(?im)^{name}(?:;[^:\r\n]*)?:([^\r\n]*)"), F.lit(1)), F.lit(-1)))


def parse_vcard(card: Column) -> Column:
    """struct(name, organization, phone, title, address, city, state, zip), or NULL without BEGIN:VCARD."""
    adr = F.split(card_field(card, "ADR"), ";")
    part = lambda i: filled(F.trim(F.get(adr, F.lit(i))))
    one = lambda n: filled(card_field(card, n))
    org = filled(F.trim(F.get(F.split(card_field(card, "ORG"), ";"), F.lit(0))))
    return F.when(
        F.contains(F.upper(card), F.lit("BEGIN:VCARD")),
        F.struct(one("FN").alias("name"), org.alias("organization"), clean_phone(card_field(card, "TEL")).alias("phone"), one("TITLE").alias("title"), part(2).alias("address"), part(3).alias("city"), part(4).alias("state"), part(5).alias("zip")),
    )


def jsonld_node(page: Column) -> Column:
    """The first JSON-LD node of a person's kind as a variant, from an object, an array or @graph; bad scripts are passed over."""
    scripts = F.regexp_extract_all(page, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))

    def nodes(text: Column) -> Column:
        v = F.try_parse_json(text)
        many = "array<variant>"
        return F.coalesce(F.try_variant_get(v, "$.@graph", many), F.try_variant_get(v, "$", many), F.array(v))

    def is_person(v: Column) -> Column:
        kinds = F.coalesce(F.try_variant_get(v, "$.@type", "array<string>"), F.array(F.try_variant_get(v, "$.@type", "string")))
        return F.coalesce(F.arrays_overlap(kinds, F.array(*map(F.lit, PERSON_TYPES))), F.lit(False))

    return F.get(F.filter(F.flatten(F.transform(scripts, nodes)), lambda v: v.isNotNull() & is_person(v)), F.lit(0))


def jsonld_text(node: Column, *keys: str) -> Column:
    """The first of the keys that has a text, a list's first text, or an object's name."""
    ways = []
    for k in keys:
        ways += [F.get(F.try_variant_get(node, f"$.{k}", "array<string>"), F.lit(0)), F.try_variant_get(node, f"$.{k}.name", "string"), F.when(F.try_variant_get(node, f"$.{k}", "map<string,variant>").isNull() & F.try_variant_get(node, f"$.{k}", "array<variant>").isNull(), F.try_variant_get(node, f"$.{k}", "string"))]
    return F.coalesce(*[filled(F.trim(w)) for w in ways])


def jsonld_flag(node: Column, key: str) -> Column:
    """A boolean given as such or as text (true/false, yes/no, also as the end of a schema address)."""
    said = F.lower(F.regexp_replace(F.try_variant_get(node, f"$.{key}", "string"), r"^.*/", ""))
    return F.when(said.isin("true", "yes"), True).when(said.isin("false", "no"), False)


def page_title(page: Column) -> Column:
    """og:title, else the first h1 without tags."""
    og = F.regexp_extract(page, r"""(?is)<meta[^>]+property=["']og:title["'][^>]*content=["']([^"']*)""", 1)
    h1 = F.regexp_replace(F.regexp_extract(page, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"(?s)<[^>]*>", "")
    return F.coalesce(filled(F.trim(og)), filled(F.trim(F.regexp_replace(h1, r"(?U)\s+", " "))))


def title_segment(page: Column, brand: str) -> Column:
    """The second part of <title> between bars, unless it is the brand."""
    seg = F.trim(F.get(F.split(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\|"), F.lit(1)))
    return F.when(~F.contains(F.lower(seg), F.lit(brand.lower())), filled(seg))


def is_error_page(page: Column, name: Column) -> Column:
    """Whether the beginning says "page not found", or the name holds 404."""
    return F.coalesce(F.contains(F.lower(F.substring(page, 1, 4000)), F.lit("page not found")), F.lit(False)) | F.coalesce(F.contains(name, F.lit("404")), F.lit(False))


def location_ids(page: Column) -> Column:
    """Sorted distinct numbers of location= parameters."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r"[?&]location=(\d+)"), F.lit(1))))


def matches_in_order(page: Column, pattern: str, group: int = 0) -> Column:
    """Distinct matches, the first occurrence deciding the order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(pattern), F.lit(group)))


def sitemap_locs(body: Column) -> Column:
    """The addresses in a sitemap."""
    return F.transform(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))


def is_sitemap_index(body: Column) -> Column:
    return F.contains(F.lower(F.substring(body, 1, 2000)), F.lit("<sitemapindex"))


def body_kind(body: Column) -> Column:
    """json, xml, html or other, by how a body begins; NULL is other."""
    head = F.lower(F.ltrim(F.substring(body, 1, 500)))
    return F.when(head.rlike(r"^[{\[]"), "json").when(head.startswith("<?xml") | head.startswith("<urlset") | head.startswith("<sitemapindex"), "xml").when(head.startswith("<"), "html").otherwise("other")
