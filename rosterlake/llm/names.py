"""Names as people type them: persons and organizations under many spellings.

Method: a symmetric-delete neighbourhood index on tokens finds tokens at small
edit distances without comparing all pairs; candidate names are then aligned
token by token in the best assignment, permitting initials, abbreviations and
nicknames.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from rosterlake.llm.addresses import near

#: Everyday English and Spanish given names and the short forms in use for them. What else is in use
#: among the rows at hand is learned from them (``linking.learned_forms``).
NICKNAMES = {
    "abigail": "abby", "albert": "al bert", "alejandro": "alex ale", "alexander": "alex", "alfred": "fred alf", "amanda": "mandy", "andrew": "andy drew", "angela": "angie", "anthony": "tony", "antonio": "tono",
    "arthur": "art", "barbara": "barb babs", "benjamin": "ben benny", "bernard": "bernie", "bradley": "brad", "catherine": "cathy kate", "charles": "charlie chuck", "christina": "chris tina", "christopher": "chris kit",
    "concepcion": "concha", "cynthia": "cindy", "daniel": "dan danny", "david": "dave", "deborah": "deb debbie", "dennis": "denny", "dolores": "lola", "donald": "don donnie", "dorothy": "dot dottie", "douglas": "doug",
    "eduardo": "lalo", "edward": "ed eddie ned ted", "eleanor": "ellie nell", "elizabeth": "liz beth betty betsy eliza lizzie libby", "enrique": "quique", "eugene": "gene", "florence": "flo", "frances": "fran",
    "francis": "frank", "francisco": "paco pancho", "franklin": "frank", "frederick": "fred freddie freddy", "gabriel": "gabe", "geoffrey": "geoff", "gerald": "jerry", "gregory": "greg", "guadalupe": "lupe",
    "guillermo": "memo", "harold": "hal harry", "henry": "hank harry", "howard": "howie", "ignacio": "nacho", "isabella": "bella izzy", "jacob": "jake", "jacqueline": "jackie", "james": "jim jimmy jamie", "janet": "jan",
    "jeffrey": "jeff", "jennifer": "jen jenny", "jessica": "jess", "jesus": "chuy", "john": "jack johnny", "jonathan": "jon", "jose": "pepe", "joseph": "joe joey", "josephine": "jo josie", "joshua": "josh", "judith": "judy",
    "katherine": "kate katie kathy kit kay", "kenneth": "ken kenny", "kimberly": "kim", "lawrence": "larry", "leonard": "leo len lenny", "lillian": "lily", "louis": "lou louie", "louise": "lou", "lucille": "lucy",
    "manuel": "manolo", "margaret": "maggie meg peggy marge", "martin": "marty", "matthew": "matt", "maximilian": "max", "mercedes": "meche", "michael": "mike mick mickey", "mildred": "millie", "mitchell": "mitch",
    "nathaniel": "nate nat nathan", "nicholas": "nick", "nicole": "nicki", "norman": "norm", "oliver": "ollie", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "peter": "pete",
    "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "reginald": "reggie", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron ronnie", "rosario": "charo",
    "russell": "russ", "samantha": "sam", "samuel": "sam sammy", "sandra": "sandy", "sarah": "sally sadie", "stephen": "steve", "steven": "steve", "stuart": "stu", "susan": "sue susie", "suzanne": "sue suzy",
    "terrence": "terry", "theodore": "ted teddy theo", "theresa": "terry tess", "thomas": "tom tommy", "timothy": "tim", "tobias": "toby", "valerie": "val", "victor": "vic", "victoria": "vicky tori", "vincent": "vince",
    "virginia": "ginny", "walter": "walt wally", "william": "bill will billy willie liam", "zachary": "zach",
}
#: What may stand around a person's name without being part of it, and generations, which are part of it.
TITLES = frozenset("dr doctor mr mrs ms miss prof professor md do aprn dpt pa pac dpm phd od rn np fnp dnp esq dds dmd".split())
GENERATIONS = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "2", "iii": "3", "iv": "4", "2nd": "2", "3rd": "3"}

#: Letters that no accent is taken from.
_PLAIN = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "ı": "i"})
_LETTERS = re.compile(r"[a-z]+|\d+[a-z]*")
#: Short and full forms by the full forms that they may stand for, those full forms' short ones, and what was learned.
_SHORT: dict[str, frozenset[str]] = {}
_FORMS: dict[str, tuple[str, ...]] = {}
_LEARNED: frozenset[tuple[str, str]] | None = None


def use(learned: frozenset[tuple[str, str]]) -> None:
    """From here on, in this process, read names with these (full form, other form) beside NICKNAMES."""
    global _LEARNED
    if learned == _LEARNED:
        return
    _LEARNED = learned
    forms: dict[str, set[str]] = {f: set(v.split()) for f, v in NICKNAMES.items()}
    for full, other in learned:
        forms.setdefault(full, set()).add(other)
    _SHORT.clear(), _FORMS.clear()
    for full, others in forms.items():
        _FORMS[full] = tuple(sorted(others))
        for n in (full, *others):
            _SHORT[n] = _SHORT.get(n, frozenset()) | {full}
    for f in (token_score, _initials, _close_known, align_persons, share_given, share_token):
        f.cache_clear()


def plain(text: str) -> str:
    """Lower case, without accents and apostrophes; words joined by case alone are parted."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text.translate(_PLAIN)) if unicodedata.category(c) not in ("Mn", "Cf"))
    text = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", text)
    return re.sub(r"['’`´]", "", text.lower())


@lru_cache(maxsize=200_000)
def read_person(name: str | None) -> tuple[tuple[str, ...], tuple[str, ...], str]:
    """(given tokens, family tokens, generation) of a name in any order.

    "Family, Given" is read by its comma; else the last token, with those
    joined to it by a hyphen, is the family name. Titles, degrees and
    generations are taken off first. None gives empty tuples.
    """
    if not name:
        return (), (), ""
    text, gen = plain(name), ""
    parts = []
    for part in text.split(","):
        ws = []
        for w in re.sub(r"[^\w\s-]", lambda m: " " if m[0] != "." else ".", part).split():
            bare = w.replace(".", "")
            if bare in GENERATIONS:
                gen = GENERATIONS[bare]
            elif bare.replace("-", "") not in TITLES:
                ws += [x for x in w.split(".") if x.strip("-")] if not re.fullmatch(r"(?:[a-z]\.)+[a-z]?", w) else [x for x in w.split(".") if x]
        if ws:
            parts.append(ws)
    if not parts:
        return (), (), gen
    split = lambda ws: tuple(t for w in ws for t in _LETTERS.findall(w))
    if len(parts) > 1:
        return split(parts[1]), split(parts[0]), gen
    ws = parts[0]
    if len(ws) == 1:
        return (), split(ws), gen
    # Initials stand with the given name: with one at the end the family name came first.
    if len(ws[-1]) == 1 and len(ws) > 1 and len(ws[0]) > 1:
        return split(ws[1:]), split(ws[:1]), gen
    return split(ws[:-1]), split(ws[-1:]), gen


def edits_allowed(n: int) -> int:
    return 0 if n < 4 else 1 if n < 7 else 2


@lru_cache(maxsize=500_000)
def token_score(a: str, b: str) -> float:
    """How well two given-name tokens agree: 1 equal, less for nicknames, typing errors and initials, -1 contradictory."""
    if a == b:
        return 1.0 if len(a) > 1 else 0.6
    if len(a) == 1 or len(b) == 1:
        if a[0] == b[0]:
            return 0.5
        long = b if len(a) == 1 else a
        one = a if len(a) == 1 else b
        return 0.4 if one in _initials(long) else -1.0
    if _SHORT.get(a, frozenset()) & _SHORT.get(b, frozenset()):
        return 0.9
    if near(a, b, min(edits_allowed(len(a)), edits_allowed(len(b)))):
        return 0.8
    for x, y in ((a, b), (b, a)):
        for full in _close_known(x):
            if full in _SHORT.get(y, ()):
                return 0.7
    return -1.0


@lru_cache(maxsize=100_000)
def _initials(token: str) -> frozenset[str]:
    """Initials of the full and short forms that a given name may stand for."""
    return frozenset(v[0] for f in _close_known(token) for v in (f, *_FORMS[f]))


@lru_cache(maxsize=100_000)
def _close_known(token: str) -> frozenset[str]:
    """Full given names that a misspelt full or short form may stand for."""
    if len(token) < 4 or token in _SHORT:
        return _SHORT.get(token, frozenset())
    return frozenset(f for k, fs in _SHORT.items() if near(token, k, min(edits_allowed(len(token)), edits_allowed(len(k)))) for f in fs)


#: Columns up to which an assignment is found by sets of columns, the work being as 2 to their number.
FEW = 12


def hungarian(scores: list[list[float]]) -> tuple[float, list[tuple[int, int]]]:
    """As ``best_assignment``, for any number of rows and columns: the work is as lesser² x greater of the two."""
    if len(scores) > len(scores[0]):
        total, pairs = hungarian([list(c) for c in zip(*scores)])
        return total, sorted((i, j) for j, i in pairs)
    n, m = len(scores), len(scores[0])
    # Potentials of rows and columns, the row of each column and the column before it on a path; 0 is outside.
    u, v, row = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row[0], at = i, 0
        least, before, done = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row[at]:
            done[at] = True
            r, step, to = row[at], float("inf"), 0
            for j in range(1, m + 1):
                if not done[j]:
                    cost = -max(scores[r - 1][j - 1], 0.0) - u[r] - v[j]
                    if cost < least[j]:
                        least[j], before[j] = cost, at
                    if least[j] < step:
                        step, to = least[j], j
            for j in range(m + 1):
                if done[j]:
                    u[row[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = to
        while at:
            row[at] = row[before[at]]
            at = before[at]
    pairs = sorted((row[j] - 1, j - 1) for j in range(1, m + 1) if row[j] and scores[row[j] - 1][j - 1] > 0)
    return sum(scores[i][j] for i, j in pairs), pairs


def best_assignment(scores: list[list[float]]) -> tuple[float, list[tuple[int, int]]]:
    """The pairing of rows with columns, each at most once, of the greatest sum; only what scores more than 0 is paired."""
    rows, cols = len(scores), len(scores[0]) if scores else 0
    # All sets of columns are tried where these are few.
    if cols > FEW:
        return hungarian(scores)
    best: dict[int, tuple[float, list[tuple[int, int]]]] = {0: (0.0, [])}
    for i in range(rows):
        after = dict(best)
        for used, (s, pairs) in best.items():
            for j in range(cols):
                if not used >> j & 1 and scores[i][j] > 0:
                    k = used | 1 << j
                    if k not in after or after[k][0] < s + scores[i][j]:
                        after[k] = (s + scores[i][j], [*pairs, (i, j)])
        best = after
    return max(best.values(), key=lambda v: v[0])


#: A family name may stand for one that goes on after it, if so many letters are in both and so many left over.
SHORTENED = 5


def _family_edits(name: str) -> int:
    return 0 if len(name) < 4 else 1 if len(name) < 9 else 2


def _family_score(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Family names: equal or misspelt, joined or parted, or one part of a double name."""
    x, y = "".join(a), "".join(b)
    if x == y:
        return 1.0
    if near(x, y, min(_family_edits(x), _family_edits(y))):
        return 0.9
    if len(a) != len(b):
        few, many = (a, b) if len(a) < len(b) else (b, a)
        if all(any(near(f, m, min(_family_edits(f), _family_edits(m))) for m in many) for f in few):
            return 0.7
    elif len(a) == len(b) == 1 and min(len(x), len(y)) >= SHORTENED and (x.startswith(y) or y.startswith(x)) and abs(len(x) - len(y)) >= SHORTENED:
        return 0.6
    return -1.0


def _readings(name: str | None) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """The ways to part a name into given and family tokens, the likeliest first."""
    given, family, _ = read_person(name)
    out = [(given, family)]
    if family and given:
        out.append((family, given))
    if len(given) > 1 and len(given[-1]) > 1:
        out.append((given[:-1], (given[-1], *family)))
    return out


def given_score(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Given names aligned by optimal assignment; 0 if they contradict each other or one has none.

    One that is left over is tolerated, two full ones or two initials that
    disagree are not.
    """
    if not a or not b:
        return 0.0
    first = token_score(a[0], b[0])
    rest1, rest2 = a[1:], b[1:]
    if first <= 0:
        # The middle name may be the one in use.
        total, pairs = best_assignment([[token_score(x, y) for y in b] for x in a])
        if not pairs or max(len(a[i]) for i, _ in pairs) < 2 or min(len(b[j]) for _, j in pairs) < 2:
            return 0.0
        return 0.5 * total / max(len(a), len(b))
    if rest1 and rest2:
        total, pairs = best_assignment([[token_score(x, y) for y in rest2] for x in rest1])
        if len(pairs) < min(len(rest1), len(rest2)):
            return 0.0
        return 0.8 * first + 0.2 * min(1.0, 2 * total / len(pairs))
    return 0.9 * first if rest1 or rest2 else first


@lru_cache(maxsize=500_000)
def align_persons(a: str | None, b: str | None) -> float:
    """Agreement of two persons' names in [0, 1]; 0 if they contradict each other.

    Names may be given in either order and family names be double. A
    generation (Jr, Sr) that differs contradicts; one that is missing lowers
    the agreement. Empty names agree with nothing.
    """
    na, nb = read_person(a)[2], read_person(b)[2]
    if na and nb and na != nb:
        return 0.0
    ra, rb, best = _readings(a), _readings(b), 0.0
    for i, (g1, f1) in enumerate(ra):
        for j, (g2, f2) in enumerate(rb):
            if not f1 or not f2 or (i == 1 and j == 1):
                continue
            fam = _family_score(f1, f2)
            if fam > 0:
                best = max(best, fam * (given_score(g1, g2) if g1 and g2 else 0.3))
    return best * (0.9 if na != nb else 1.0)


@lru_cache(maxsize=500_000)
def share_given(a: str | None, b: str | None) -> bool:
    """A full given name, or the family name, agrees though the rest differs, as after a change of name."""
    na, nb = read_person(a)[2], read_person(b)[2]
    if na and nb and na != nb:
        return False
    for g1, f1 in _readings(a):
        for g2, f2 in _readings(b):
            if (g1 and g2 and given_score(g1, g2) > 0) or (f1 and f2 and _family_score(f1, f2) > 0):
                return True
    return False


def person_tokens(name: str | None, with_given: bool = False) -> list[str]:
    """What an index of names is asked for: all tokens but initials (with the full forms of given names if asked for).

    Names may be given in either order, so a given name may be the family
    name of another reading and none is left out. What a reading takes for a
    double family name is given in parts and joined, and a long family name
    also by the beginnings that ``_family_score`` lets stand for it.
    """
    given, family, _ = read_person(name)
    toks = [t for t in (*given, *family) if len(t) > 1]
    out = set(toks)
    for _, own in _readings(name):
        if len(own) > 1:
            out.add("".join(own))
        elif own:
            out.update(own[0][:n] for n in range(SHORTENED, len(own[0]) - SHORTENED + 1))
    if with_given:
        out.update(f for t in toks for f in (_close_known(t) or (t,)))
    return sorted(out)


def family_tokens(name: str | None) -> dict[str, tuple[bool, bool]]:
    """The tokens of ``person_tokens`` that stand in a family name, and of each whether only in that of the reversed order, and whether only as its beginning.

    Two names that agree at all have near ones, or equal ones if one is a
    beginning, and one of the two isn't of the reversed order: ``align_persons``
    doesn't reverse both.
    """
    out: dict[str, tuple[bool, bool]] = {}
    for k, (_, own) in enumerate(_readings(name)):
        toks = [(t, False) for t in own if len(t) > 1]
        if len(own) > 1:
            toks.append(("".join(own), False))
        elif own:
            toks += [(own[0][:n], True) for n in range(SHORTENED, len(own[0]) - SHORTENED + 1)]
        for t, begun in toks:
            was = out.get(t, (True, True))
            out[t] = (k == 1 and was[0], begun and was[1])
    return out


@lru_cache(maxsize=500_000)
def share_token(a: str | None, b: str | None) -> bool:
    """A token of ``person_tokens`` with full forms is in both names, or near one of the other as ``graph.neighbours`` has it."""
    x, y = person_tokens(a, True), person_tokens(b, True)
    if not {*x}.isdisjoint(y):
        return True
    x, y = ([t for t in ts if len(t) > 3 and t.isascii() and t.isalpha() and t.islower()] for ts in (x, y))
    return any(near(t, u, 2 if min(len(t), len(u)) >= 7 else 1) for t in x for u in y)


use(frozenset())
