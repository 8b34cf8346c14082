"""Classes of records that are linked to each other."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import spread, written

#: Letters from which on two typing errors are tolerated, the least of what the aligners ask for (names.edits_allowed).
TWO_EDITS = 7


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every record in ``links``: the smallest id it is connected to.

    Labels spread along links and are followed to their own label in each
    round, so that the rounds are as the logarithm of the longest chain. Each
    round is written to the shared folder; nothing is gathered.
    """
    ends = links.select(F.col(a).alias("id"), F.col(b).alias("other"))
    both = written(ends.unionByName(ends.select(F.col("other").alias("id"), F.col("id").alias("other"))).where("id <> other").distinct())
    labels = written(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "root"), "other").groupBy("id").agg(F.min("root").alias("r"))
        spread = labels.join(near, "id").select("id", F.least("root", "r").alias("root"), F.col("root").alias("was"))
        far = spread.join(spread.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left")
        after = written(far.select("id", F.coalesce(F.least("root", "next"), F.col("root")).alias("root"), "was"))
        labels = after.select("id", "root")
        if not after.where("root <> was").take(1):
            return labels


def neighbours(tokens: DataFrame) -> DataFrame:
    """(t, u): each token with itself and the tokens at a small edit distance, by symmetric deletion.

    One edit, or two in tokens of ``TWO_EDITS`` letters and more, a swap of
    neighbours counting as one: no name is aligned with more. Tokens at that
    distance share a form with as many letters deleted, so that none is
    missed; the distance is then checked. The index grows with the
    vocabulary, not with the table, by up to a hundred forms and more a token,
    so it is shuffled: nothing of it comes to the driver.
    """
    from rosterlake.llm.addresses import deletes, near

    vocabulary = written(tokens.select("t").distinct())
    # A vocabulary fits in one split, while what is made of it is work for all cores.
    plain = spread(vocabulary.where("t rlike '^[a-z]{4,}$'"))
    once = deletes(F.col("t"))
    twice = F.array_distinct(F.flatten(F.transform(once, deletes)))
    # Forms meet by their hashes: what has the same by chance is told by the distance.
    forms = plain.select("t", F.explode(F.transform(F.when(F.length("t") >= TWO_EDITS, twice).otherwise(once), lambda d: F.xxhash64(d))).alias("d"))
    # Spark takes the forms to be as few as the tokens and would broadcast them. Sides that are alike are shuffled once.
    x, y = forms.hint("merge").alias("x"), forms.alias("y")
    found = x.join(y, F.col("x.d") == F.col("y.d")).where("x.t < y.t").select(F.col("x.t").alias("t"), F.col("y.t").alias("u")).distinct()

    @F.pandas_udf("boolean")
    def close(t: pd.Series, u: pd.Series) -> pd.Series:
        return pd.Series([near(a, b, 2 if min(len(a), len(b)) >= TWO_EDITS else 1) for a, b in zip(t, u)], dtype="bool")

    # Two swaps are four edits to levenshtein.
    kept = written(found.where(F.levenshtein("t", "u") <= 4).where(close("t", "u")))
    return vocabulary.select("t", F.col("t").alias("u")).unionByName(kept).unionByName(kept.select(F.col("u").alias("t"), F.col("t").alias("u")))
