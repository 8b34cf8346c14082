"""Decision tables as columns: ordered conditions, the first that holds decides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.functions.text import credential_tokens, first_label, npi_valid

#: Credentials by kind of person, and shapes of organizations' names, the most specific first.
PHYSICIAN = "MD DO MBBS MBBCH MB DPM DDS DMD DC OD".split()
ADVANCED = "APRN APRN-BC APRN-C ARNP APN NP NP-C FNP FNP-C FNP-BC AGNP AGACNP ACNP PNP CPNP WHNP PMHNP CNM CNP CNS CRNA PA PA-C DNP MSN RN-BC".split()
CLINICIAN = "PHD PSYD LCSW LMHC LPC LCPC MSW CSW AUD CCC-A CCC-SLP RD LD PHARMD DPT MA MS".split()
ORG_SHAPES = [
    (r"\bhospital\b|\bmedical cent(er|re)\b|\bregional health\b", "Hospital"),
    (r"\burgent care\b|\bwalk-?in\b|\bexpress care\b", "Clinic"),
    (r"\bclinic\b|\bhealth cent(er|re)\b|\bcare cent(er|re)\b", "Clinic"),
    (r"\bmedical group\b|\bphysician network\b|\bassociates\b|\bpartners\b|\b(llc|inc|pa|pllc|llp|corp)\b\.?$", "Organization"),
    (r"\bimaging\b|\blaborator(y|ies)\b|\bpharmacy\b|\brehab(ilitation)?\b|\bsurgery cent(er|re)\b|\bemergency room\b|\bER\b", "Facility"),
]


@dataclass(frozen=True)
class NumberPolicy:
    """What is asked of a provider number; ``checksum`` is strict, warn or off."""

    require_npi: bool = True
    checksum: str = "warn"
    require_registry: bool = False
    require_profile_url: bool = True

    def __post_init__(self):
        if self.checksum not in ("strict", "warn", "off"):
            raise ValueError("checksum must be strict, warn or off")


def classify(name: Column, credentials: Column, enumeration: Column, org_name: Column, registry_credential: Column, taxonomy: Column, extra: list[tuple[str, str]] | None = None) -> Column:
    """struct(type, confidence) of a directory record; the registry's word comes first, then names and credentials."""
    shapes = ORG_SHAPES + (extra or [])
    own = credential_tokens(credentials)
    both = F.array_union(own, credential_tokens(registry_credential))
    has = lambda toks, kinds: F.arrays_overlap(toks, F.array(*map(F.lit, kinds)))
    label = F.coalesce(first_label(name, shapes), first_label(org_name, shapes), F.lit("Organization"))
    doctor = F.coalesce(taxonomy.rlike("(?i)physician|surgeon"), F.lit(False))
    s = lambda t, c: F.struct((t if isinstance(t, Column) else F.lit(t)).alias("type"), F.lit(c).alias("confidence"))
    shape = first_label(name, shapes)
    registered = (
        F.when(enumeration == "NPI-2", s(label, "high"))
        .when((enumeration == "NPI-1") & has(both, PHYSICIAN), s("Physician", "high")).when((enumeration == "NPI-1") & has(both, ADVANCED), s("APP", "high"))
        .when((enumeration == "NPI-1") & has(both, CLINICIAN) & doctor, s("Physician", "medium")).when((enumeration == "NPI-1") & has(both, CLINICIAN), s("APP", "low"))
        .when((enumeration == "NPI-1") & doctor, s("Physician", "low")).when(enumeration == "NPI-1", s("Unknown", "low"))
    )
    person = has(own, PHYSICIAN) | has(own, ADVANCED)
    return registered.when(shape.isNotNull() & ~person, s(shape, "medium")).when(has(own, PHYSICIAN), s("Physician", "medium")).when(has(own, ADVANCED), s("APP", "medium")).otherwise(s("Unknown", "low"))


def problems(cols: dict[str, Column], policy: NumberPolicy = NumberPolicy()) -> Column:
    """What is wrong with a record, in order; an empty array if nothing is.

    ``cols`` has full_name, npi, enumeration, address, city, state,
    profile_url, phone, specialty and practice_name.
    """
    blank = lambda c: F.coalesce(F.trim(cols[c]), F.lit("")) == ""
    one = F.size(F.split(F.trim(cols["full_name"]), r"(?U)\s+")) < 2
    checks = [
        (blank("full_name"), "No individual provider name"), (~blank("full_name") & one, "Name does not look like a person (single token)"),
        (blank("npi") & F.lit(policy.require_npi), "No NPI"), (~blank("npi") & ~npi_valid(cols["npi"]) & F.lit(policy.checksum == "strict"), "NPI fails CMS checksum"),
        (F.coalesce(cols["enumeration"] == "not_found", F.lit(True)) & F.lit(policy.require_registry), "No NPPES record and npi.require_nppes is set"),
        (blank("address"), "No practice address"), (blank("city") | blank("state"), "Incomplete address (missing city or state)"),
        (blank("profile_url") & F.lit(policy.require_profile_url), "No profile URL"),
        (~blank("phone") & blank("full_name") & blank("address") & blank("specialty") & blank("practice_name"), "Only a phone number is present"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in checks]))


def warnings(npi: Column, enumeration: Column, name_match: Column, policy: NumberPolicy = NumberPolicy()) -> Column:
    """Remarks on a record that is kept."""
    bad = (F.coalesce(npi, F.lit("")) != "") & ~npi_valid(npi)
    return F.array_compact(F.array(
        F.when(bad & F.lit(policy.checksum == "warn"), F.lit("NPI fails CMS checksum (kept: npi.checksum=warn)")), F.when(bad & F.lit(policy.checksum == "off"), F.lit("NPI checksum not verified (npi.checksum=off)")),
        F.when(enumeration == "not_found", F.lit("no NPPES record; classification is heuristic")), F.when(name_match.eqNullSafe(F.lit(False)), F.lit("directory name does not match CMS legal name")),
    ))


def site_confidence(sites: Column, registered: Column, name_match: Column, class_confidence: Column) -> Column:
    """high, medium or low: how far the main site can be believed. A name match that is NULL is no mismatch."""
    return (
        F.when(sites > 3, "low").when(class_confidence == "low", "low").when(sites > 1, "medium")
        .when(~F.coalesce(registered, F.lit(False)) | name_match.eqNullSafe(F.lit(False)), "medium").when(class_confidence == "medium", "medium").otherwise("high")
    )


def first_reason(*gates: tuple[Column, str]) -> Column:
    """The reason of the first gate that is true, NULL if none is."""
    return F.coalesce(*[F.when(c, F.lit(r)) for c, r in gates])


def yes_no(c: Column) -> Column:
    """Yes, No, or NULL."""
    return F.when(c, "Yes").when(~c, "No")


def needs_review(confidence: Column) -> Column:
    return F.coalesce(F.lower(F.trim(confidence)).isin("low", "medium"), F.lit(False))


def backoff_seconds(attempt: Column, base: float, most: float) -> Column:
    """base to the power of the attempt, at most ``most``."""
    return F.least(F.pow(F.lit(base), attempt), F.lit(most))
