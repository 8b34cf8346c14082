"""Template residue, filler, error messages and script notices in documents.

Method: a regularized linear classifier on hashed n-grams, length and title
features, trained here on weak labels from response-status lines and a few
general phrases, and validated on hosts it hasn't seen. It scores every segment
(sentence or line) of every document, so that a document is found also if only a
part of it is affected.

Weak labels know a part of the cases only, so that what is unlabelled isn't
taken for clean. Three things let the classifier go beyond its labels:

* Rare n-grams can only speak for residue (their weights are kept at 0 or
  above): a phrase that no label knows isn't learned as clean. Common ones may
  speak for either side.
* A name in the marks of a template engine (a slot) becomes one token whatever
  the marks are, and only n-grams with that token count in its segment.
* The fit is repeated: unlabelled segments that score high are labelled, those
  in between are left out.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import spread

#: The training set: about so many documents by hash, of at most so many characters each, and of their segments
#: without a label at most so many per fit. These bound what reaches the driver; every document is scored whole.
TRAIN_DOCS, TRAIN_CHARS, TRAIN_CLEAN = 12_000, 8_000, 30_000
#: Hashed n-grams without and with a slot, and the strength of the L2 penalty.
BUCKETS, SLOTTED, PENALTY = 1 << 17, 1 << 14, 2e-6
#: Tokens that a reader remembers from batch to batch.
MOST_KNOWN = 200_000
#: Share of documents from which on a word or n-gram is common.
COMMON = 0.01
#: Fits, and the scores from which on an unlabelled segment is labelled, and up to which it is taken for clean.
ROUNDS, SURE, CLEAN = 3, 0.9, 0.3

#: Weak labels. Lines of a response's status, and general phrases that stand in place of content.
STATUS = (
    r"^\W*(?:http|error|status)?[\s:/\d.]*\b(?:40[0-9]|41[0-9]|429|50[0-9])\b[\s:\-]*(?:error\b|not found|page not found|the page|forbidden|unauthorized|bad|gateway|internal|service|too many|unavailable|p[aá]gina)",
    r"\b(?:internal server error|bad gateway|gateway time-?out|service (?:temporarily )?unavailable|too many requests)\b",
    r"^\W*(?:page|p[aá]gina) (?:not found|no encontrada)",
)
PHRASES = (
    r"^\W*(?:access denied|acceso denegado)\b|\bpermission to (?:view|access)\b",
    r"\b(?:enable|activate|habilite|active) (?:java ?script|cookies)\b|\b(?:requires?|requiere) java ?script\b",
    r"^\W*(?:loading|please wait|cargando)\b|\b(?:unable|failed) to load\b|\b(?:something went wrong|unexpected error)\b",
    r"\bsession (?:has |is )?expired\b|\b(?:signed|logged) out after\b|\bsign in again\b",
    r"\bbrowser does(?: not|n't) support\b|\bchecking your browser\b",
    r"^\W*traceback\b|\b[a-z]+error:",
    r"\blorem ipsum\b|\bdolor sit amet\b|\bconsectetur adipiscing\b",
    r"\b(?:text|content) goes here\b|\btest test\b|\bfirst ?name last ?name\b|\bplaceholder until\b|\btexto de ejemplo\b",
    r"\b(?:undefined undefined|null null|nan nan)\b|\[object object\]",
    r"\{\{|\}\}|\{%|%\}|<%|%>|\$\{",
    r"%[A-Z_.]{3,}%|\[(?:insert|your) [^\]]*\]",
)

_SPLIT = re.compile(r"(?<=[.!?…])\s+|\n+")
_WRAPPED = re.compile(r"((?<=[^\W\d_])-)?\s*\n(?=[a-zà-ÿ])")
_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>")
_NAME = r"([A-Za-z_][\w.]*(?:[ /][A-Za-z_][\w.]*){0,3})"
#: A name in marks that a template engine would have replaced; square brackets alone are used in plain text, too.
_SLOT = re.compile(r"(?:\{\{+|\{%|<%=?|\$\{|\[\[+|@@+)\s*(?:if |for |end)?" + _NAME + r"\s*(?:\}\}+|%\}|%>|\}|\]\]+|@@+)|[|~%{$#]" + _NAME + r"[|~%}$#]|\[" + _NAME + r"\]")
_MARKS = re.compile(r"[{\[<@|~%$#]")
_TOKEN = re.compile(r"[^\W\d_]+(?:_[^\W\d]+)*|\d+|[^\w\s]+|_+")
_SHAPES = ("upper", "snake", "camel", "lower", "title")
_FILLED = "slotz"

# Features beside the n-grams, in the order of their numbers after these. A slot has several, so that what is
# around it doesn't outweigh it.
_SIZES = tuple(1 << k for k in range(5, 11))
_COUNTS = (2, 3, 5, 8)
_PLAIN = [
    *[f"slot {k}" for k in range(6)], *[f"slot {s}" for s in _SHAPES], *[f"bracket {s}" for s in _SHAPES], *[f"document < {n}" for n in _SIZES], *[f"segment < {n}" for n in _SIZES],
    *[f"segments < {n}" for n in _COUNTS], *[f"uncommon >= {k}/6" for k in range(1, 6)], *[f"small words {k}" for k in range(4)], *[f"capitals {k}" for k in range(5)],
    *[f"numbers {k}" for k in range(3)], *[f"ends {c}" for c in (".", "?", "!", ":", "word", "other")], *[f"twice {k}" for k in range(3)], "title", *[f"title {k}" for k in range(7)],
]
_FIRST = BUCKETS + SLOTTED
_AT = {n: _FIRST + i for i, n in enumerate(_PLAIN)}
WIDTH = _FIRST + len(_PLAIN)


def weak(status: tuple[str, ...] = STATUS, phrases: tuple[str, ...] = PHRASES) -> re.Pattern:
    """One pattern of all weak labels."""
    return re.compile("|".join(f"(?:{p})" for p in (*status, *phrases)), re.I | re.M)


def segments(text: str) -> list[str]:
    """The sentences and lines of a text; white space alone is none. A line that goes on in small letters is joined."""
    text = _WRAPPED.sub(lambda m: "" if m[1] else " ", text)
    return [s for s in (x.strip() for x in _SPLIT.split(text)) if s]


def _shape(word: str) -> str:
    if word.isupper() and len(word) > 1:
        return "upper"
    if "_" in word or "." in word:
        return "snake"
    if re.search(r"[a-z][A-Z]", word):
        return "camel"
    return "lower" if word.islower() else "title"


def tokens(seg: str) -> tuple[list[str], set[str]]:
    """The tokens of a segment, slots as one token each, and the features of its slots."""
    if not seg.isascii():
        seg = "".join(c for c in unicodedata.normalize("NFKD", seg) if unicodedata.category(c) not in ("Mn", "Cf"))
    said: set[str] = set()

    def fill(m: re.Match) -> str:
        name = m[1] or m[2] or m[3]
        shape = _shape(name)
        if m[3] and (shape in ("lower", "snake") or (shape == "title" and not re.search("[ /]", name))):
            said.add(f"bracket {shape}")
            return m[0]
        said.update(_PLAIN[:6])
        said.add(f"slot {shape}")
        return f" {_FILLED} "

    if _MARKS.search(seg):
        seg = _SLOT.sub(fill, _MARKUP.sub(" ", seg) if "<" in seg else seg)
    return _TOKEN.findall(seg), said


@dataclass
class Reader:
    """Reads texts into features, a batch at a time. ``common``: small-letter words that many documents have."""

    common: frozenset[str]
    _known: dict[str, int] = field(default_factory=dict)
    _hash: list[int] = field(default_factory=list)
    _kind: list[int] = field(default_factory=list)

    def _number(self, t: str) -> int:
        n = self._known.get(t)
        if n is None:
            n = self._known[t] = len(self._hash)
            self._hash.append(zlib.crc32(b"0" if t[0].isdigit() else t.casefold().encode()))
            small = len(t) > 1 and t.islower() and t != _FILLED
            # Flags: small word, uncommon, capital, number, letters, slot.
            self._kind.append(small | (small and t not in self.common) << 1 | t[0].isupper() << 2 | t[0].isdigit() << 3 | t[0].isalpha() << 4 | (t == _FILLED) << 5)
        return n

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(features, lengths, document of each segment, segments) of the texts' segments in order."""
        segs, docs, codes, lengths, shape, extra = [], [], [], [], [], []
        if len(self._known) > MOST_KNOWN:
            self._known, self._hash, self._kind = {}, [], []
        for d, text in enumerate(texts):
            own = segments(text)
            chars = sum(map(len, own))
            for place, s in enumerate(own):
                toks, said = tokens(s)
                codes.extend(map(self._number, toks))
                lengths.append(len(toks))
                last = toks[-1][-1] if toks else ""
                shape.append((chars, len(s), len(own), place, 4 if last.isalnum() else {".": 0, "?": 1, "!": 2, ":": 3}.get(last, 5)))
                if said:
                    extra.extend((len(segs), _AT[x]) for x in said)
                segs.append(s)
                docs.append(d)
        if not segs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
        n, code = len(segs), np.array(codes, dtype=np.int64)
        size = np.array(lengths, dtype=np.int64)
        h, kind = (np.array(x, dtype=np.uint64)[code] if len(code) else np.zeros(0, np.uint64) for x in (self._hash, self._kind))
        seg = np.repeat(np.arange(n), size)
        slot = (kind >> np.uint64(5)) & np.uint64(1)
        with_slot = np.bincount(seg, weights=slot, minlength=n) > 0
        keys = []
        for length, salt in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
            if len(code) < length:
                continue
            m = len(code) - length + 1
            same = seg[:m] == seg[length - 1 :]
            mixed, has = np.full(m, salt, dtype=np.uint64), np.zeros(m, dtype=bool)
            for k in range(length):
                mixed = (mixed ^ h[k : k + m]) * np.uint64(0x100000001B3)
                has |= slot[k : k + m] > 0
            ok = same & (has | ~with_slot[seg[:m]])
            mixed >>= np.uint64(20)
            bucket = np.where(has, np.uint64(BUCKETS) + mixed % np.uint64(SLOTTED), mixed % np.uint64(BUCKETS))
            keys.append(seg[:m][ok] * WIDTH + bucket[ok].astype(np.int64))
        each = np.array(shape, dtype=np.int64)
        count = lambda bit: np.bincount(seg, weights=(kind >> np.uint64(bit)) & np.uint64(1), minlength=n).astype(np.int64)
        small, uncommon, capital, number = (count(b) for b in range(4))
        row = np.arange(n) * WIDTH
        put = lambda mask, name: keys.append(row[mask] + _AT[name])
        for x in _SIZES:
            put(each[:, 0] < x, f"document < {x}")
            put(each[:, 1] < x, f"segment < {x}")
        for x in _COUNTS:
            put(each[:, 2] < x, f"segments < {x}")
        for k in range(1, 6):
            put((small > 0) & (uncommon * 6 >= k * small), f"uncommon >= {k}/6")
        for name, value in (("small words", np.minimum(small, 3)), ("capitals", 4 * capital // np.maximum(size, 1)), ("numbers", np.minimum(number, 2))):
            keys.append(row + _AT[f"{name} 0"] + value)
        keys.append(row + _AT["ends ."] + each[:, 4])
        if len(code) > 1:
            again = (seg[:-1] == seg[1:]) & (h[:-1] == h[1:]) & ((kind[1:] >> np.uint64(4)) & np.uint64(1) > 0)
            hit = np.bincount(seg[:-1][again], minlength=n) > 0
            for k in range(3):
                put(hit, f"twice {k}")
        first = each[:, 3] == 0
        put(first, "title")
        keys.append((row + _AT["title 0"] + np.ceil(np.log2(np.minimum(size, 40) + 1)).astype(np.int64))[first])
        if extra:
            keys.append(np.array([i * WIDTH + a for i, a in extra], dtype=np.int64))
        every = np.unique(np.concatenate(keys))
        return every % WIDTH, np.bincount(every // WIDTH, minlength=n), np.array(docs, dtype=np.int64), segs


@dataclass
class Model:
    """Weights, bias, threshold and common words, and how it did on unseen hosts."""

    weights: np.ndarray
    bias: float
    threshold: float
    validation: dict
    common: frozenset[str] = frozenset()

    def scores(self, texts: list[str], reader: Reader | None = None) -> np.ndarray:
        """The greatest probability of any segment of each text; 0 for texts without segments."""
        feats, lengths, docs, _ = (reader or Reader(self.common)).read(texts)
        out = np.zeros(len(texts))
        if len(lengths):
            np.maximum.at(out, docs, _probability(self.weights, self.bias, feats, lengths))
        return out

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])


def _probability(w: np.ndarray, b: float, feats: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # Every segment has features.
    return 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[feats], starts) + b, -30, 30)))


def _chosen(feats: np.ndarray, lengths: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return feats[np.repeat(mask, lengths)], lengths[mask]


def _fit(feats: np.ndarray, lengths: np.ndarray, y: np.ndarray, rare: np.ndarray, steps: int = 80) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Adagrad over the whole set; weights of ``rare`` features stay at 0 or above."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    w, b = np.zeros(WIDTH), 0.0
    seen, seen_b = np.full(WIDTH, 1e-10), 1e-10
    # Both classes weigh the same.
    each = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[feats], starts) + b, -30, 30)))
        err = (p - y) * each
        g = np.bincount(feats, weights=np.repeat(err, lengths), minlength=WIDTH) + PENALTY * w
        seen += g * g
        seen_b += err.sum() ** 2
        w -= 0.3 * g / np.sqrt(seen)
        b -= 0.3 * err.sum() / np.sqrt(seen_b)
        np.maximum(w, 0, out=w, where=rare)
    return w, float(b)


def _learn(feats: np.ndarray, lengths: np.ndarray, docs: np.ndarray, hit: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, float]:
    """ROUNDS fits, each on what the one before labels; the weak labels always stay."""
    y, p = hit, np.zeros(len(hit))
    rng = np.random.default_rng(0)
    for _ in range(ROUNDS):
        touched = np.isin(docs, docs[y])
        clean = np.flatnonzero(~touched & (p < CLEAN))
        use = y.copy()
        use[clean if len(clean) <= TRAIN_CLEAN else rng.choice(clean, TRAIN_CLEAN, replace=False)] = True
        w, b = _fit(*_chosen(feats, lengths, use), y[use].astype(float), rare)
        p = _probability(w, b, feats, lengths)
        y = hit | (p >= SURE)
    return w, b


def train(documents: DataFrame, size: int = TRAIN_DOCS, seed: int = 0, labels: re.Pattern | None = None) -> Model:
    """Fit on a bounded sample of weakly labelled documents, by hash; validate on hosts left out.

    About ``size`` documents of at most TRAIN_CHARS characters reach the
    driver, twice as many at most. Segments that match a weak label are
    positive, segments of documents without any begin as clean; the rest of a
    matched document is left out. The threshold is the one with the best F1 on
    the hosts left out (a quarter of all, by hash), segments without a label
    that a model of all hosts is sure of aside; 0.9 where these hold too
    little of either class. Without any label no document is found.
    """
    labels = labels or weak()
    host = F.lower(F.try_parse_url(F.trim("url"), F.lit("HOST")))
    share = min(1.0, size / max(1, documents.count()))
    kept = documents.where("text is not null and trim(text) <> ''").where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < round(share * 1_000_000))
    rows = kept.where(F.length("text") <= TRAIN_CHARS).select("text", host.alias("host")).limit(2 * size).toPandas()
    # The order of arrival doesn't matter.
    rows = rows.sort_values(["text", "host"], na_position="first", ignore_index=True)
    texts = rows.text.tolist()
    small = Counter(t for text in texts for t in {t for s in segments(text) for t in tokens(s)[0] if len(t) > 1 and t.islower()})
    common = frozenset(t for t, n in small.items() if n >= COMMON * len(texts))
    feats, lengths, docs, segs = Reader(common).read(texts)
    hit = np.array([bool(labels.search(s)) for s in segs], dtype=bool)
    if not hit.any() or hit.all():
        return Model(np.zeros(WIDTH), -30.0 if not hit.any() else 30.0, 0.5, {"segments": len(segs)}, common)
    in_docs = np.bincount(np.unique(np.repeat(docs, lengths) * WIDTH + feats) % WIDTH, minlength=WIDTH)
    rare = in_docs < COMMON * len(texts)
    # What is said of a slot never speaks for a clean segment.
    rare[BUCKETS : _AT[f"slot {_SHAPES[-1]}"] + 1] = True
    rare[_AT[f"slot {_SHAPES[-1]}"] + 1 :] = False
    w, b = _learn(feats, lengths, docs, hit, rare)
    said: dict = {"documents": len(texts), "segments": len(segs), "labelled": int(hit.sum()), "found": int((_probability(w, b, feats, lengths) >= SURE).sum())}
    threshold = SURE
    out = np.array([h is not None and zlib.crc32(str(h).encode()) % 4 == 0 for h in rows.host], dtype=bool)[docs]
    if 20 <= hit[out].sum() and 20 <= hit[~out].sum() and (~hit)[out].sum() >= 20:
        v, c = _learn(*_chosen(feats, lengths, ~out), docs[~out], hit[~out], rare)
        judged = out & (hit | (_probability(w, b, feats, lengths) < SURE))
        p = _probability(v, c, *_chosen(feats, lengths, judged))
        best = max((_f1(p >= t, hit[judged]) + (t,) for t in np.linspace(0.6, 0.95, 8)), key=lambda x: (round(x[0], 2), -abs(x[3] - SURE)))
        threshold = float(best[3])
        said |= {"held_out": int(judged.sum()), "f1": best[0], "precision": best[1], "recall": best[2]}
    return Model(w, b, threshold, said, common)


def _f1(got: np.ndarray, want: np.ndarray) -> tuple[float, float, float]:
    hit = float((got & (want == 1)).sum())
    p, r = hit / max(1.0, got.sum()), hit / max(1.0, want.sum())
    return (2 * p * r / (p + r) if p + r else 0.0), p, r


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every document, from its whole text; null and blank texts score 0."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # WIDTH doubles and the common words: 1 MB

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        reader = Reader(m.common)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                yield pd.DataFrame({"doc_id": part.doc_id, "score": m.scores([t or "" for t in part.text], reader)})

    return spread(documents.where("doc_id is not null").select("doc_id", "text")).mapInPandas(score, "doc_id long, score double")


def affected(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id) of the documents to exclude. Repeated ids come out once if any of their texts is affected."""
    model = model or train(documents)
    return scored(documents, model).where(F.col("score") >= model.threshold).select("doc_id").distinct()


def clean(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents without the affected ones."""
    return documents.join(affected(documents, model), "doc_id", "left_anti")
