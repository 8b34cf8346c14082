"""Figures for the README: python tests/llm/measure.py p10|p2|p3 [sf_dir]

p10: what is found with half of the phrase labels taken away, of what is found with all of them and matches no label
that is left. p2 and p3: numbers or telephones that the operators usually read are hidden from them and tell which
pairs are right.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import functions as F  # noqa: E402

from rosterlake.session import build_session, cut, table  # noqa: E402


def p10(spark, d):
    from rosterlake.llm import residue

    docs = table(spark, d, "documents")
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null and text is not null").select("doc_id", "text").toLocalIterator()}
    found = lambda m: {r.doc_id for r in residue.affected(docs, m).collect()}
    t = time.time()
    model = residue.train(docs)
    print(f"trained in {time.time() - t:.1f} s: {model.validation}, threshold {model.threshold:.2f}")
    t = time.time()
    every = found(model)
    print(f"all labels: {len(every)} documents found in {time.time() - t:.1f} s, {sum(bool(residue.weak().search(texts[i])) for i in every)} of them match a label; {sum(bool(residue.weak().search(x)) for i, x in texts.items() if i not in every)} match one and aren't found")
    for name, kept in (("even phrases away", residue.PHRASES[1::2]), ("odd phrases away", residue.PHRASES[::2]), ("status only", ())):
        labels = residue.weak(residue.STATUS, kept)
        less = residue.train(docs, labels=labels)
        got = found(less)
        unmatched = {i for i in every if not any(labels.search(s) for s in residue.segments(texts[i]))}
        print(f"{name}: {len(got & unmatched)} of {len(unmatched)} unmatched documents found, {len(got - every)} others, threshold {less.threshold:.2f}")


if __name__ == "__main__":
    which, sf = sys.argv[1], (sys.argv[2:] or ["/root/testdata/sf0.1"])[0]
    session = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    globals()[which](session, sf)
