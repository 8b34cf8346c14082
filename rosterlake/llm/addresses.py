"""Reading postal addresses and finding those that denote one place.

Method: set-containment join for missing parts. Each address is indexed by its
rarest tokens and probed from the addresses that hold them; a pair is verified
by weighted containment and by the absence of contradictory components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.states import CODES, STATE_CODES
from rosterlake.session import spread, written

#: Ways to write the kind of a street, directions, numbers and parts of a building.
SUFFIXES = {
    "ave": "avenue av ave aven avn", "st": "street st str strt", "rd": "road rd", "dr": "drive dr drv driv", "ln": "lane ln la",
    "blvd": "boulevard blvd boul boulv bvd", "ct": "court ct crt", "cir": "circle cir circ crcl", "pl": "place pl plc", "ter": "terrace ter terr",
    "pkwy": "parkway pkwy pky parkwy pkway", "way": "way wy", "hwy": "highway hwy", "sq": "square sq", "trl": "trail trl", "loop": "loop", "plz": "plaza plz",
}
DIRECTIONS = {"n": "n north no", "s": "s south so", "e": "e east", "w": "w west", "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest"}
UNITS = "ste suite unit rm room fl floor flr apt apartment bldg building dept no # lot space"
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
ORDINALS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split()
CITY_WORDS = {"ft": "fort", "mt": "mount", "st": "saint", "ste": "sainte", "snt": "saint", "n": "north", "s": "south", "e": "east", "w": "west"}

_SUFFIX = {w: k for k, v in SUFFIXES.items() for w in v.split()}
_DIR = {w: k for k, v in DIRECTIONS.items() for w in v.split()}
_PAIR = {("n", "e"): "ne", ("n", "w"): "nw", ("s", "e"): "se", ("s", "w"): "sw"}
_NUMBER = {w: str(n) for n, w in enumerate(ONES)}
_ORDINAL = {w: str(n) for n, w in enumerate(ORDINALS)}
_ROUTE = re.compile(r"\b(?:s r|sr|st rd|state rd|state road|st road|state route|st rt|st rte|state rte|state rt|st route|state hwy|st hwy|state highway)\s+(\d+)\b")
_UNIT = re.compile(r"(?:\b(?:ste|suite|unit|rm|room|floor|flr|apt|apartment|bldg|building|dept)\b\.?\s*#?\s*|#\s*|\bfl\b\.?\s*#?\s*(?=\d{1,3}\b))(?:\d+[a-z]?(?:-\w+)?\b|[a-z]\b)", re.I)
_ORD = re.compile(r"\d+(?:st|nd|rd|th)$")
_STATE_ZIP = re.compile(r"^(?:(?P<s>[a-z][a-z. ]*?)\s+)?(?P<z>\d{4,5})(?:-\d{3,4})?$")
_LONG = [w for w in (*_SUFFIX, *_DIR) if len(w) >= 5]

FIELDS = ["num", "dir", "street", "suffix", "zip5", "city", "state"]


def near(a: str, b: str, most: int) -> bool:
    """At most ``most`` edits apart, a swap of neighbours counting as one."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return False
        two, one = one, row
    return one[-1] <= most


def read_state(text: str | None) -> str | None:
    if not text:
        return None
    t = " ".join(text.replace(".", " ").lower().split())
    return t.upper() if t.upper() in CODES else STATE_CODES.get(t)


def read_zip(text: str | None) -> str | None:
    m = re.match(r"\s*(\d{4,5})(?!\d)", text or "")
    return m[1].zfill(5) if m else None


def read_city(text: str | None) -> str | None:
    ws = re.findall(r"[^\W\d_]+", (text or "").lower())
    return " ".join([CITY_WORDS.get(ws[0], ws[0]), *ws[1:]]) if ws else None


def _is_street(tokens: list[str]) -> bool:
    return len(tokens) > 1 and any(t in _SUFFIX or _ORD.match(t) for t in tokens) or bool(tokens and (tokens[0].isdigit() or tokens[0] in _NUMBER))


def read_address(address: str | None, city: str | None, state: str | None, zip_code: str | None) -> dict | None:
    """The components of an address, or None without a street. Suites, rooms and floors are dropped.

    The whole address may stand in one field, a facility's name may stand
    before it, and the number may come last; words for numbers and every
    spelling of kinds and directions in the lists above are understood.
    """
    out = dict.fromkeys(FIELDS)
    out |= {"city": read_city(city), "state": read_state(state), "zip5": read_zip(zip_code)}
    if not address or not address.strip():
        return None
    chunks = [c.strip() for c in re.split(r",|\s[-–]\s|;|\n", address) if c.strip()]
    # Locality at the end: "..., City, ST 12345" or parts of it.
    if len(chunks) > 1:
        m = _STATE_ZIP.match(chunks[-1].lower())
        st = read_state(chunks[-1]) if not m else read_state(m["s"])
        if (m and (len(m["z"]) == 5 or m["s"]) and (m["s"] is None or st) and not (m["s"] is None and len(chunks) == 2)) or (st and not m):
            chunks.pop()
            out["zip5"] = out["zip5"] or (read_zip(m["z"]) if m else None)
            out["state"] = out["state"] or st
            if len(chunks) > 1 and not re.search(r"\d|#", chunks[-1]) and not _is_street(re.findall(r"\w+", chunks[-1].lower())):
                here = read_city(chunks.pop())
                out["city"] = out["city"] or here
    parts = []
    for c in chunks:
        t = _UNIT.sub(" ", c.lower())
        t = re.sub(r"['’]", "", t)
        t = re.sub(r"\b([nsew])\.\s*([nsew])\.?(?=\s)", r"\1\2", t)
        t = re.sub(r"[^\w\s]", " ", t)
        ws = t.split()
        if ws:
            parts.append(ws)
    if not parts:
        return None
    lone = [p[0] for p in parts if len(p) == 1 and (p[0].isdigit() or p[0] in _NUMBER)]
    parts = [p for p in parts if not (len(p) == 1 and (p[0].isdigit() or p[0] in _NUMBER))]
    streets = [p for p in parts if _is_street(p)] or parts[-1:]
    if not streets:
        return None
    numbered = [p for p in streets if p[0].isdigit() or p[0] in _NUMBER]
    ws = (numbered or streets)[-1 if len(numbered) > 1 else 0]
    num = None
    if ws[0].isdigit() or (ws[0] in _NUMBER and len(ws) > 1):
        num, ws = _NUMBER.get(ws[0], ws[0]), ws[1:]
    elif lone:
        num = _NUMBER.get(lone[0], lone[0])
    elif len(ws) > 1 and (ws[-1].isdigit() or ws[-1] in _NUMBER) and not _ROUTE.search(" ".join(ws)):
        num, ws = _NUMBER.get(ws[-1], ws[-1]), ws[:-1]
    elif len(ws) > 2 and ws[-1].isdigit() and ws[-2].isdigit():
        num, ws = ws[-1], ws[:-1]
    if not ws:
        return None
    text = " ".join(ws)
    m = _ROUTE.search(text)
    if m:
        rest = (text[: m.start()] + " " + text[m.end() :]).split()
        if num is None and rest and (rest[-1].isdigit() or rest[-1] in _NUMBER):
            num = _NUMBER.get(rest[-1], rest[-1])
            rest.pop()
        ds = [_DIR[w] for w in rest if w in _DIR]
        out |= {"num": num, "street": f"route {m[1]}", "dir": "".join(ds)[:2] or None}
        return _finished(out)
    ws, direction = _take_direction(ws)
    suffix = None
    if len(ws) > 1:
        if ws[-1] in _SUFFIX:
            suffix, ws = _SUFFIX[ws[-1]], ws[:-1]
        elif len(ws[-1]) >= 5:
            close = next((w for w in _LONG if w in _SUFFIX and near(ws[-1], w, 1)), None)
            if close:
                suffix, ws = _SUFFIX[close], ws[:-1]
    if direction is None:
        ws, direction = _take_direction(ws)
    name = " ".join(f"{_ORDINAL[w]}th" if w in _ORDINAL else re.sub(r"^(\d+)(?:st|nd|rd|th)$", r"\1th", w) for w in ws)
    out |= {"num": num, "dir": direction, "street": name or None, "suffix": suffix}
    return _finished(out)


def _finished(out: dict) -> dict | None:
    if out["num"]:
        out["num"] = out["num"].lstrip("0") or "0"
    return out if out["street"] else None


def _take_direction(ws: list[str]) -> tuple[list[str], str | None]:
    """A direction at either end, also in two words, if a name remains."""
    for lead in (True, False):
        two, one = (ws[:2], ws[:1]) if lead else (ws[-2:], ws[-1:])
        if len(ws) > 2 and (_DIR.get(two[0]), _DIR.get(two[1])) in _PAIR:
            return (ws[2:] if lead else ws[:-2]), _PAIR[_DIR[two[0]], _DIR[two[1]]]
        if len(ws) > 1 and one[0] in _DIR and not (lead and len(ws) == 2 and ws[1] in _SUFFIX):
            return (ws[1:] if lead else ws[:-1]), _DIR[one[0]]
    return ws, None


def read_addresses(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the components of address, city, state and zip; rows without a street or number are left out."""
    kept = rows.where("address is not null").select(*keys, *[F.col(c).cast("string") for c in ("address", "city", "state", "zip")])
    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + [f"{f} string" for f in FIELDS])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(i, r) for i, r in enumerate(map(read_address, pdf.address, pdf.city, pdf.state, pdf.zip)) if r and r["num"]]
            out = pdf.iloc[[i for i, _ in got]][keys].reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame([r for _, r in got], columns=FIELDS, dtype=object)], axis=1)

    return spread(kept).mapInPandas(read, schema)


def deletes(text: Column) -> Column:
    """The text and what remains of it without any one character."""
    one = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 3, one).otherwise(F.array())))


def compatible(a: str, b: str) -> Column:
    """No component contradicts: direction, kind, postal code and state are equal or missing on one side."""
    same = F.lit(True)
    for f in ("dir", "suffix", "zip5", "state"):
        same = same & F.coalesce(F.col(f"{a}.{f}") == F.col(f"{b}.{f}"), F.lit(True))
    return same


def _verified(a: str, b: str) -> Column:
    """Containment of the lesser address in the other, by weight, without contradiction."""

    def agree(f: str, most: int) -> Column:
        x, y = F.col(f"{a}.{f}"), F.col(f"{b}.{f}")
        d = F.levenshtein(x, y)
        return F.when(x == y, 1.0).when(~x.rlike("[0-9]") & ~y.rlike("[0-9]") & (d <= F.when(F.least(F.length(x), F.length(y)) >= 6, most).otherwise(1)), 1 - d / (2 * F.greatest(F.length(x), F.length(y)))).otherwise(0.0)

    street, city = agree("street", 2), agree("city", 2)
    both = lambda f: F.col(f"{a}.{f}").isNotNull() & F.col(f"{b}.{f}").isNotNull()
    same_zip = F.coalesce(F.col(f"{a}.zip5") == F.col(f"{b}.zip5"), F.lit(False))
    # Within one postal code the city's spelling doesn't matter.
    located = same_zip | (both("city") & (city > 0)) | ~(both("zip5") | both("city"))
    shared = F.lit(0.0)
    for f, part in (("num", F.lit(1.0)), ("street", street), ("zip5", F.lit(1.0)), ("city", F.when(same_zip, 1.0).otherwise(city))):
        shared = shared + F.when(both(f), part * F.least(F.col(f"{a}.w_{f}"), F.col(f"{b}.w_{f}"))).otherwise(0.0)
    # A misspelt name is rarer than the name meant; both weigh as the less rare does.
    lesser = F.least(*[F.col(f"{m}.weight") - F.col(f"{m}.w_street") for m in (a, b)]) + F.least(F.col(f"{a}.w_street"), F.col(f"{b}.w_street"))
    return compatible(a, b) & (F.col(f"{a}.num") == F.col(f"{b}.num")) & (street > 0) & located & (shared >= CONTAINED * lesser)


#: How much of the lesser address's weight the other must hold.
CONTAINED = 0.8


def places(addresses: DataFrame) -> DataFrame:
    """(FIELDS, place): every distinct form of an address with the place it belongs to.

    ``addresses`` has FIELDS. Forms of one place are those linked by verified
    containment; each form points to the fullest form it is linked to (then
    the more frequent), and pointers are followed to their end. A form with a
    part missing that is linked to forms which contradict each other in that
    part is linked to none of them.
    """
    forms = addresses.groupBy(*FIELDS).agg(F.count("*").alias("n")).withColumn("form", F.xxhash64(*[F.coalesce(f, F.lit("")) for f in FIELDS]))
    forms = written(forms)
    num = F.col("num")
    tokens = F.concat(
        F.array(F.struct(F.lit("num").alias("kind"), num.alias("t")), F.struct(F.lit("street").alias("kind"), F.col("street").alias("t"))),
        *[F.when(F.col(f).isNotNull(), F.array(F.struct(F.lit(f).alias("kind"), F.col(f).alias("t")), F.struct(F.lit("where").alias("kind"), F.concat_ws("|", F.lit(f[0]), num, f).alias("t")))).otherwise(F.array()) for f in ("zip5", "city")],
        F.transform(deletes(F.col("street")), lambda x: F.struct(F.lit("name").alias("kind"), F.concat_ws("|", F.lit("s"), num, x).alias("t"))),
    )
    listed = forms.select("form", F.inline(tokens))
    df = listed.groupBy("kind", "t").agg(F.count("*").alias("df"))
    total = float(max(2, forms.count()))
    weighed = listed.join(df, ["kind", "t"]).groupBy("form").agg(
        *[F.max(F.when(F.col("kind") == f, F.log(F.lit(total) / F.col("df")) + 0.1)).alias(f"w_{f}") for f in ("num", "street", "zip5", "city")],
        *[F.min_by(F.when((F.col("kind") == k) & (F.col("df") > 1), F.col("t")), F.when((F.col("kind") == k) & (F.col("df") > 1), F.struct("df", "t"))).alias(f"i_{k}") for k in ("where", "name")],
    )
    full = forms.join(weighed, "form").withColumn("weight", sum((F.coalesce(f"w_{f}", F.lit(0.0)) for f in ("num", "street", "zip5", "city")), F.lit(0.0)))
    full = written(full)
    index = full.select(F.col("form").alias("x"), F.explode(F.array_compact(F.array("i_where", "i_name"))).alias("t"))
    probe = listed.where("kind in ('where', 'name')").select(F.col("form").alias("y"), "t")
    pairs = index.join(probe, "t").where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    a, b = full.alias("a"), full.alias("b")
    linked = pairs.join(a, F.col("x") == F.col("a.form")).join(b, F.col("y") == F.col("b.form")).where(_verified("a", "b"))
    parts = ("dir", "suffix", "zip5")
    side = lambda m, o: linked.select(F.col(f"{m}.form").alias("form"), F.col(f"{o}.form").alias("other"), *[F.col(f"{m}.{p}").alias(f"m_{p}") for p in parts], *[F.col(f"{o}.{p}").alias(f"o_{p}") for p in parts], F.col(f"{o}.n").alias("o_n"))
    both = written(side("a", "b").unionByName(side("b", "a")))
    torn = both.groupBy("form").agg(*[(F.min(f"o_{p}") != F.max(f"o_{p}")).alias(f"t_{p}") for p in parts])
    unsure = [F.col(f"m_{p}").isNull() & F.col(f"o_{p}").isNotNull() & F.coalesce(f"t_{p}", F.lit(False)) for p in parts]
    kept = both.join(torn, "form").where(~(unsure[0] | unsure[1] | unsure[2]))
    # A link must be sure from both of its ends.
    kept = kept.join(kept.select(F.col("form").alias("other"), F.col("other").alias("form")), ["form", "other"], "left_semi")
    rank = lambda f, n, *cs: F.struct(sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in cs), F.lit(0)).alias("p"), F.col(n).alias("n"), F.col(f).alias("f"))
    own = full.select("form", rank("form", "n", *FIELDS).alias("r"))
    theirs = kept.select("form", "other").join(own.select(F.col("form").alias("other"), "r"), "other").select("form", "r")
    points = written(own.unionByName(theirs).groupBy("form").agg(F.max("r").alias("r")).select("form", F.col("r.f").alias("root")))
    while True:
        on = points.join(points.select(F.col("form").alias("root"), F.col("root").alias("next")), "root").select("form", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        on = written(on)
        points = on.drop("moved")
        if not on.where("moved").take(1):
            break
    return forms.join(points, "form").select(*FIELDS, F.col("root").alias("place"))


def with_place(addresses: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``addresses`` with their place."""
    a, p = addresses.alias("a"), found.alias("p")
    on = F.lit(True)
    for f in FIELDS:
        on = on & F.col(f"a.{f}").eqNullSafe(F.col(f"p.{f}"))
    return a.join(p, on).select("a.*", "p.place")


def same_place(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(id_a, id_b) of rows of both tables at one place whose components don't contradict."""
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, F.col("a.place") == F.col("b.place")).where(compatible("a", "b")).select(F.col(f"a.{left_id}").alias("id_a"), F.col(f"b.{right_id}").alias("id_b"))
