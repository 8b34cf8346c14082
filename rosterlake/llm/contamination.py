"""Evaluation items inside training texts.

Method: a BM25 inverted index of the test items, queried by every passage of
every document with block-max WAND; every item above its threshold is
retrieved, and the overlap of words is then verified.

The threshold loses nothing. A case is a run of ``run`` words of an item. An
item's threshold is the smallest BM25 weight that any of its own runs has, so a
passage that holds a run scores at least that much. Impacts are stored divided
by the item's threshold, which makes it 1 for all items.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.text import words
from rosterlake.session import spread

#: Words in a row that make a case.
RUN = 12
#: Most words of a passage; passages overlap by RUN - 1 words, so that no run is cut.
PASSAGE = 24
#: Postings per block of the index.
BLOCK = 32
#: Items per index. More items are taken in blocks, each against all documents.
INDEX_ITEMS = 5000


class ItemIndex:
    """Inverted index of items: per word the item numbers, impacts and block maxima."""

    def __init__(self, items: list[tuple[int, list[str]]], run: int = RUN, k1: float = 1.2, b: float = 0.75):
        self.run = run
        self.ids = [i for i, w in items if len(w) >= run]
        texts = [w for _, w in items if len(w) >= run]
        self.runs: list[set[str]] = [{" ".join(w[k : k + run]) for k in range(len(w) - run + 1)} for w in texts]
        df = Counter(t for w in texts for t in set(w))
        mean = sum(map(len, texts)) / len(texts) if texts else 1.0
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for n, w in enumerate(texts):
            impact = {}
            for t, tf in Counter(w).items():
                idf = math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5))
                impact[t] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(w) / mean))
            least = min(sum(impact[t] for t in set(w[k : k + run])) for k in range(len(w) - run + 1))
            for t, x in impact.items():
                postings[t].append((n, x / least))
        self.items = {t: np.array([n for n, _ in p], dtype=np.int32) for t, p in postings.items()}
        self.impacts = {t: [x for _, x in p] for t, p in postings.items()}
        self.top = {t: max(x) for t, x in self.impacts.items()}
        self.blocks = {t: [max(x[k : k + BLOCK]) for k in range(0, len(x), BLOCK)] for t, x in self.impacts.items()}

    def above(self, query: set[str]) -> list[int]:
        """Numbers of all items that score at least 1 for the words of a passage."""
        eps, end = 1 - 1e-9, len(self.ids)
        terms = [t for t in query if t in self.top]
        if sum(self.top[t] for t in terms) < eps:
            return []
        lists = [[0, self.items[t], self.impacts[t], self.top[t], self.blocks[t]] for t in terms]
        found = []
        at = lambda c: int(c[1][c[0]]) if c[0] < len(c[1]) else end
        while True:
            lists.sort(key=at)
            bound, pivot = 0.0, None
            for k, c in enumerate(lists):
                if at(c) == end:
                    break
                bound += c[3]
                if bound >= eps:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = at(lists[pivot])
            while pivot + 1 < len(lists) and at(lists[pivot + 1]) == item:
                pivot += 1
            head = lists[: pivot + 1]
            # Shallow move: the blocks in which the item would lie bound the score more tightly.
            spots = [c[0] + int(np.searchsorted(c[1][c[0] :], item)) for c in head]
            blocks = sum(c[4][s // BLOCK] for c, s in zip(head, spots) if s < len(c[1]))
            if blocks < eps:
                ends = [int(c[1][min((s // BLOCK + 1) * BLOCK, len(c[1])) - 1]) + 1 for c, s in zip(head, spots) if s < len(c[1])]
                after = at(lists[pivot + 1]) if pivot + 1 < len(lists) else end
                goal = max(item + 1, min([*ends, after]))
                for c in head:
                    c[0] += int(np.searchsorted(c[1][c[0] :], goal))
                continue
            score = 0.0
            for c, s in zip(head, spots):
                if s < len(c[1]) and c[1][s] == item:
                    score += c[2][s]
                    s += 1
                c[0] = s
            if score >= eps:
                found.append(item)

    def leaked(self, text: list[str]) -> set[int]:
        """Ids of the items of which the words hold a run.

        Queried are passages made of places at which a run could begin: where
        the greatest impacts of the next ``run`` words reach the threshold.
        """
        out: set[int] = set()
        sums = [0.0, *accumulate(self.top.get(w, 0.0) for w in text)]
        last, step = len(text) - self.run, PASSAGE - self.run + 1
        k = 0
        while k <= last:
            if sums[k + self.run] - sums[k] < 1 - 1e-6:
                k += 1
                continue
            end = k + 1
            while end <= last and end < k + step and sums[end + self.run] - sums[end] >= 1 - 1e-6:
                end += 1
            passage = text[k : end - 1 + self.run]
            hits = self.above(set(passage))
            if hits:
                runs = [" ".join(passage[j : j + self.run]) for j in range(end - k)]
                out.update(self.ids[n] for n in hits if not self.runs[n].isdisjoint(runs))
            k = end
        return out


def leaks(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, item_id): the text holds at least ``run`` consecutive words of the item.

    Whole texts of all documents are read, once per block of INDEX_ITEMS
    items; one block's index is what every executor gets, so its size is
    bounded. Null and empty texts, and items of fewer words, give no row;
    repeated rows of a document or item give one. Nothing is shuffled but the
    pairs found.
    """
    spark, parts = documents.sparkSession, []
    ids = items.where("item_id is not null and text is not null")
    total = ids.count()
    blocks = -(-total // INDEX_ITEMS)
    for n in range(blocks):
        rows = (ids if blocks == 1 else ids.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n)).select("item_id", "text").collect()
        index = spark.sparkContext.broadcast(ItemIndex([(r.item_id, words(r.text)) for r in rows], run))

        def probe(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                hits = [(d, i) for d, t in zip(pdf.doc_id, pdf.text) for i in index.value.leaked(words(t))]
                yield pd.DataFrame(hits, columns=["doc_id", "item_id"], dtype="int64")

        parts.append(spread(documents.where("doc_id is not null and text is not null").select("doc_id", "text")).mapInPandas(probe, "doc_id long, item_id long"))
    if not parts:
        return documents.select("doc_id", F.lit(None).cast("long").alias("item_id")).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
