"""Fields of directory resources held as objects (map<string, variant>); a lone object counts as a list of one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.functions.text import filled

#: Codes of whether new patients are taken.
TAKES_NEW, TAKES_NONE = ("newpt",), ("nopt", "existptonly")


def text(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def items(v: Column, path: str = "$") -> Column:
    """The objects of a list, or a lone object, without nulls; otherwise an empty array."""
    many = F.filter(F.try_variant_get(v, path, "array<variant>"), lambda x: F.try_variant_get(x, "$", "map<string,variant>").isNotNull())
    lone = F.when(F.try_variant_get(v, path, "map<string,variant>").isNotNull(), F.array(F.try_variant_get(v, path, "variant")))
    return F.coalesce(many, lone, F.array().cast("array<variant>"))


def texts(v: Column, path: str) -> Column:
    """The texts of a list, or a lone text."""
    return F.coalesce(F.filter(F.try_variant_get(v, path, "array<string>"), lambda x: x.isNotNull()), F.array_compact(F.array(F.when(F.try_variant_get(v, path, "map<string,variant>").isNull(), text(v, path)))))


def reference(c: Column) -> Column:
    """struct(type, id): the last two segments of a reference; NULL for fragments and single segments. A version is cut off."""
    parts = F.split(F.regexp_replace(F.regexp_replace(c, "/_history/[^/]*$", ""), "/+$", ""), "/")
    kind, key = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))
    return F.when(~c.startswith("#") & (F.size(parts) >= 2) & (kind != "") & (key != ""), F.struct(kind.alias("type"), key.alias("id")))


def next_link(links: Column) -> Column:
    """The address of the link with relation 'next'."""
    return F.get(F.filter(links, lambda x: x["relation"] == "next"), F.lit(0))["url"]


def concept_text(v: Column) -> Column:
    """A concept's text, else its first coding's display."""
    return F.coalesce(filled(text(v, "$.text")), text(F.get(items(v, "$.coding"), F.lit(0)), "$.display"))


def preferred_coding(concepts: Column, system_part: str) -> Column:
    """struct(code, display) of the first coding of that system in any concept, else of the first concept's first coding."""
    every = F.flatten(F.transform(concepts, lambda c: items(c, "$.coding")))
    chosen = F.coalesce(F.get(F.filter(every, lambda c: F.contains(text(c, "$.system"), F.lit(system_part))), F.lit(0)), F.get(items(F.get(concepts, F.lit(0)), "$.coding"), F.lit(0)))
    return F.when(chosen.isNotNull(), F.struct(text(chosen, "$.code").alias("code"), text(chosen, "$.display").alias("display")))


def accepting_new_patients(role: Column, url_part: str = "newpatients") -> Column:
    """True, false, or NULL where the nested extension doesn't say."""
    outer = F.filter(items(role, "$.extension"), lambda e: F.contains(text(e, "$.url"), F.lit(url_part)))
    inner = F.filter(F.flatten(F.transform(outer, lambda e: items(e, "$.extension"))), lambda e: text(e, "$.url") == "acceptingPatients")
    codes = F.filter(F.flatten(F.transform(inner, lambda e: F.transform(items(e, "$.valueCodeableConcept.coding"), lambda c: text(c, "$.code")))), lambda c: c.isin(*TAKES_NEW, *TAKES_NONE))
    return F.get(codes, F.lit(0)).isin(*TAKES_NEW)


def identifier(v: Column, system_part: str) -> Column:
    """The value of the first identifier of that system which has one."""
    hits = F.filter(items(v, "$.identifier"), lambda i: F.contains(text(i, "$.system"), F.lit(system_part)) & (F.coalesce(text(i, "$.value"), F.lit("")) != ""))
    return text(F.get(hits, F.lit(0)), "$.value")


def contact(v: Column, system: str) -> Column:
    """The value of the first contact point of that system."""
    return text(F.get(F.filter(items(v, "$.telecom"), lambda t: text(t, "$.system") == system), F.lit(0)), "$.value")


def address_line(v: Column) -> Column:
    return filled(F.array_join(texts(v, "$.address.line"), ", "))


def person_name(v: Column) -> Column:
    """Given names and family name of the first name."""
    n = F.get(items(v, "$.name"), F.lit(0))
    return filled(F.trim(F.concat_ws(" ", F.array_join(texts(n, "$.given"), " "), text(n, "$.family"))))


def person_suffix(v: Column) -> Column:
    return filled(F.array_join(texts(F.get(items(v, "$.name"), F.lit(0)), "$.suffix"), ", "))


def languages(v: Column) -> Column:
    return F.filter(F.transform(items(v, "$.communication"), concept_text), lambda x: x.isNotNull())


def taxonomy_desc(taxonomies: Column) -> Column:
    """The primary taxonomy's description, even if NULL; without a primary one the first's."""
    primary = F.filter(taxonomies, lambda t: F.coalesce(t["primary"], F.lit(False)))
    return F.when(F.size(primary) > 0, F.get(primary, F.lit(0))["desc"]).otherwise(F.get(taxonomies, F.lit(0))["desc"])


def content_hash(cols: list[Column]) -> Column:
    """Sixteen hexadecimal digits of the SHA-256 of the values as JSON, nulls kept."""
    return F.substring(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256), 1, 16)
