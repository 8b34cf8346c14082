"""Names of organizations: reading and aligning them."""

from __future__ import annotations

import re
from functools import lru_cache

from rosterlake.llm.addresses import near
from rosterlake.llm.names import best_assignment, plain

#: Words for kinds of organizations with their abbreviations and other spellings.
KINDS = {
    "hospital": "hosp hsptl hospitals hospitl", "center": "ctr cntr centre centers cent", "health": "hlth healthcare", "medical": "medcl", "medicine": "medcn medicne",
    "associates": "assoc assocs associate assn", "children": "childrens child childs chldrns", "women": "womens womans", "rehabilitation": "rehab rehabil rehabilitn", "general": "gen genl gnrl",
    "community": "comm commun cmty comnty", "university": "univ univrsty", "surgical": "surg surgcl", "orthopedic": "ortho orthopaedic orthop orthopedics", "memorial": "mem meml memrl",
    "group": "grp", "pediatrics": "peds paediatrics pediatric pediatr", "specialists": "splsts specialist splst", "specialty": "spclty speciality spcl", "institute": "inst institut",
    "services": "svc svcs service serv", "dermatology": "derm dermatol", "therapy": "thpy ther therpy", "behavioral": "behav behavioural behavl", "cardiology": "cardio card cardiol",
    "internal": "int intl intern", "physical": "phys physicl", "family": "fam famly", "regional": "reg rgnl regl", "wellness": "welln wllness", "urgent": "urg urgt", "care": "", "eye": "", "clinic": "clin", "practice": "prac",
}
REGIONS = {"hills": "hls hill", "valley": "vly vlly", "lakes": "lks", "summit": "smt", "bay": "", "plains": "plns", "prairie": "", "coast": "cst", "harbor": "hbr harbour", "heights": "hts", "springs": "spgs"}
OTHER = {"saint": "st snt ste", "fort": "ft", "mount": "mt", "north": "n no", "south": "s so", "east": "e", "west": "w", "campus": "cmps camp", "and": "& +"}
EMPTY = frozenset("the of and at for in inc incorporated llc pllc pc pa lp llp ltd co corp main a an".split())

_WORD = {w: k for d in (KINDS, REGIONS, OTHER) for k, v in d.items() for w in (k, *v.split())}
_WORD |= {"spec": "spec", "med": "med"}
#: Abbreviations that stand for several words.
_OPEN = {"spec": {"specialty", "specialists"}, "med": {"medical", "medicine"}}
_KNOWN = frozenset([*KINDS, *REGIONS, *OTHER, *_OPEN])
_ALIAS = re.compile(r"\b(?:dba|d/b/a|f/k/a|fka|aka|a/k/a|formerly(?: known as)?|now(?: known as)?|doing business as)\b")


@lru_cache(maxsize=300_000)
def read_org(name: str | None) -> tuple[tuple[tuple[str, ...], str, str], ...]:
    """The names in a name (its own and aliases), each (tokens, campus, acronym).

    Abbreviations are spelled out, legal forms and filler words dropped; a
    campus is kept apart. A short first word may be an acronym. None gives ().
    """
    if not name or not name.strip():
        return ()
    out = []
    for part in _ALIAS.split(re.sub(r"\((?:main|primary)\)", " ", name, flags=re.I) if not _ALIAS.search(name.lower()) else re.sub(r"\((?:main|primary)\)", " ", name.lower(), flags=re.I)):
        acronym = ""
        text = plain(part)
        text = re.sub(r"\b((?:[a-z]\.){2,}[a-z]?)(?=\W|$)", lambda m: m[1].replace(".", ""), text)
        campus = ""
        m = re.search(r"\b(north|south|east|west|n|s|e|w|no|so)\.?\s+(?:campus|cmps|camp)\b\.?", text)
        if m:
            campus = _WORD.get(m[1], m[1])
            text = text[: m.start()] + " " + text[m.end() :]
        raw = re.findall(r"[a-z0-9]+|&|\+", text)
        toks = []
        for t in raw:
            t = _WORD.get(t, t)
            if t not in EMPTY:
                toks.append(t)
        if toks:
            head = toks[0]
            if 2 <= len(head) <= 6 and head not in _KNOWN and len(toks) <= 4:
                acronym = head
            out.append((tuple(toks), campus, acronym))
    return tuple(out)


#: The agreement of an acronym with a name that has these initials.
ACRONYM = 0.55
#: What two typing errors in a short word count; a name with them agrees no better than FAR, for which a place or
#: telephone in common must speak.
TWO_ERRORS, FAR = 0.6, 0.5
#: What an agreement with an alias counts, of one with the name itself.
ALIAS = 0.5


@lru_cache(maxsize=500_000)
def _token(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if a in _KNOWN and b in _KNOWN:
        return 0.8 if b in _OPEN.get(a, ()) or a in _OPEN.get(b, ()) else 0.0
    short = min(len(a), len(b))
    if near(a, b, 0 if short < 4 else 1 if short < 10 else 2):
        return 0.85
    if short >= 8 and near(a, b, 2):
        return TWO_ERRORS
    for x, y in ((a, b), (b, a)):
        # An abbreviation keeps the first letter and the order of the others.
        if y in _KNOWN and x not in _KNOWN and 3 <= len(x) < len(y) and x[0] == y[0]:
            it = iter(y)
            if all(c in it for c in x):
                return 0.7
    return 0.0


def initials(toks: tuple[str, ...], campus: str = "") -> str:
    """The initials of a name in the order of the alphabet, as words may be reordered."""
    return "".join(sorted("".join(t[0] for t in toks) + (campus[0] + "c" if campus else "")))


def _one(x: tuple, y: tuple, city: frozenset[str]) -> float:
    (ta, ca, aa), (tb, cb, ab) = x, y
    for (t1, a1), (t2, c2) in (((ta, aa), (tb, cb)), ((tb, ab), (ta, ca))):
        if a1 and len(a1) > 1 and len(t2) > 1:
            rest = [t for t in t1[1:] if t not in city]
            short = "".join(sorted(a1))
            if all(r in t2 or any(_token(r, t) > 0 for t in t2) for r in rest):
                own = tuple(t for t in t2 if t not in city) or t2
                if short in (initials(t2, c2), initials(own, c2)):
                    return ACRONYM
    if ca != cb:
        return 0.0
    drop = lambda ts: tuple(t for t in ts if t not in city) or ts
    best = 0.0
    for a, b in {(ta, tb), (drop(ta), tb), (ta, drop(tb)), (drop(ta), drop(tb))}:
        if a == b:
            pairs = [(i, i) for i in range(len(a))]
        else:
            _, pairs = best_assignment([[_token(p, q) for q in b] for p in a])
        ma, mb = {i for i, _ in pairs}, {j for _, j in pairs}
        own_a = [i for i, t in enumerate(a) if t not in _KNOWN or t in REGIONS]
        own_b = [j for j, t in enumerate(b) if t not in _KNOWN or t in REGIONS]
        left_a, left_b = [a[i] for i in range(len(a)) if i not in ma], [b[j] for j in range(len(b)) if j not in mb]
        # What names it must be found in the other; a kind may be left out on one side only.
        lost_own = sum(i not in ma for i in own_a) + sum(j not in mb for j in own_b)
        if lost_own or (left_a and left_b):
            # Joined or parted words.
            if "".join(a) == "".join(b):
                best = 1.0
            continue
        if not own_a and not own_b and (left_a or left_b):
            continue
        if (left_a or left_b) and any(a[i] != b[j] and a[i] not in _KNOWN and not near(a[i], b[j], 1) for i, j in pairs):
            continue
        weight = lambda t: 2.0 if t not in _KNOWN else 1.0
        all_w = max(sum(map(weight, a)), sum(map(weight, b)))
        got = sum(weight(a[i]) * _token(a[i], b[j]) for i, j in pairs)
        far = any(_token(a[i], b[j]) == TWO_ERRORS for i, j in pairs)
        best = max(best, min(got / all_w, FAR) if far else got / all_w)
    return best


@lru_cache(maxsize=500_000)
def align_orgs(a: str | None, b: str | None, city: str | None = None) -> float:
    """Agreement of two organizations' names in [0, 1]; 0 if they contradict each other.

    Tokens are aligned by optimal assignment, permitting typing errors and
    abbreviations. Words that name the organization must be found on both
    sides; a word of its kind may be left out on one side. Acronyms agree with
    names that have these initials. A campus must be named on both sides or
    on none. ``city`` may stand in a name or not.
    Aliases in a name agree in their own right. Empty names agree with nothing.
    """
    own = frozenset(_WORD.get(t, t) for t in re.findall(r"[a-z]+", plain(city or "")))
    best = 0.0
    for x in versions(a):
        for y in versions(b):
            if x[1] and y[1] and best:
                continue
            for i, p in enumerate(read_org(x[0])):
                for j, q in enumerate(read_org(y[0])):
                    best = max(best, _one(p, q, own) * (1.0 if i == 0 and j == 0 else ALIAS))
    return best


def versions(name: str | None) -> list[tuple[str | None, bool]]:
    """The name, and the name without what follows a dash or comma at its end, as a town would."""
    out: list[tuple[str | None, bool]] = [(name, False)]
    if name:
        m = re.match(r"(.{6,}?)\s+[-–]\s+[^-–]+$", name) or re.match(r"(.{12,}),\s+[^,]+$", name)
        if m and any(t not in _KNOWN for toks, _, _ in read_org(m[1]) for t in toks):
            out.append((m[1], True))
    return out


def own_tokens(name: str | None) -> list[str]:
    """What an index of names is asked for: the words that name the organization, and its initials after '#'.

    A name without words of its own gives all of its words joined by '_'.
    """
    out: set[str] = set()
    for version, _ in versions(name):
        for toks, campus, acronym in read_org(version):
            own = [t for t in toks if t not in _KNOWN and len(t) > 2]
            out.update(own)
            if not own:
                out.add("_".join(sorted(toks)))
            if len(own) > 1:
                out.add("".join(own))
            if len(toks) > 1:
                out.update({"#" + initials(toks), "#" + initials(toks, campus)})
            if acronym:
                out.add("#" + "".join(sorted(acronym)))
    return sorted(out)
