"""Mixing sources to target weights along a curriculum.

Method: time-varying curriculum. Each source has a weight schedule over the
training time; its integral is the source's cumulative demand of tokens. The
demand is inverted to give every document, at the tokens that precede it in its
source, its position in training, and documents are range-sorted by position.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.session import spread

#: Where the vocabulary files of public tokenizers are; a parameter of every call.
TOKENIZERS = os.environ.get("TOKENIZERS_PATH", "/opt/tokenizers")
#: Groups into which a source's documents are dealt by hash for running sums: about this many documents each.
BUCKET_DOCS = 20_000
#: How much a fully repeatable source's weight moves over training, of its share.
RAMP = 0.5


def source_key(col: Column) -> Column:
    """A source's name regardless of case, outer spaces and '-' versus '_'. Empty is null."""
    key = F.regexp_replace(F.lower(F.trim(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))), "-", "_")
    return F.when(key != "", key)


def token_counts(documents: DataFrame, path: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, source, tokens): tokens of the whole text by a public byte-level BPE; null texts have 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers_here", f"{path}/__init__.py")
        public = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public)
        with open(f"{path}/{vocabulary}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "source": pdf.source, "tokens": [len(coder.encode_ordinary(t)) if t else 0 for t in pdf.text]})

    read = documents.where("doc_id is not null").select("doc_id", source_key(F.col("source")).alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    return spread(read).mapInPandas(count, "doc_id long, source string, tokens long")


def plan(available: DataFrame, targets: DataFrame, total: float | None = None, ramp: float = RAMP) -> DataFrame:
    """Per source its share, tokens available, tokens to use, and the ends of its weight schedule.

    Shares are scaled to one over the sources that have documents; the others
    can't be met and are reported with 0. ``total`` tokens are mixed; by
    default the greatest total at which every share can be met without using a
    source more than its ``max_repeats``. With a greater ``total`` scarce
    sources stop at their cap and the rest fall short of the total. Sources
    without a target, a share that isn't positive or repeats below 1 take no
    part. The table has as many rows as there are targets.

    A source's weight at time t in [0, 1] is share * (1 + slope * (2t - 1)).
    Slopes weighted by share add up to 0, so all weights add up to 1 at any
    time: sources that may be repeated more come later.
    """
    t = targets.groupBy(source_key(F.col("source")).alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.where("source is not null and target_share > 0 and max_repeats >= 1").join(available, "source", "left")
    every, there = Window.partitionBy(), F.coalesce("available", F.lit(0)) > 0
    t = t.withColumn("available", F.coalesce("available", F.lit(0))).withColumn("share", F.when(there, F.col("target_share")).otherwise(0.0))
    t = t.withColumn("share", F.try_divide("share", F.sum("share").over(every)))
    most = F.min(F.when(there, F.try_divide(F.col("max_repeats") * F.col("available"), F.col("share")))).over(every)
    t = t.withColumn("total", most if total is None else F.lit(float(total)))
    t = t.withColumn("demand", F.when(there, F.least(F.col("share") * F.col("total"), (F.col("max_repeats") * F.col("available")).cast("double"))).otherwise(0.0))
    log = F.log(F.col("max_repeats").cast("double"))
    around = log - F.sum(F.col("share") * log).over(every)
    widest = F.max(F.abs(around)).over(every)
    return t.withColumn("slope", F.coalesce(F.try_divide(F.lit(ramp) * around, widest), F.lit(0.0)))


def running_tokens(counts: DataFrame, seed: int) -> DataFrame:
    """Adds ``before``: the tokens of the same source that precede a document in an order by hash.

    Two-level sum: documents are dealt into buckets by the hash that orders
    them, sums run inside a bucket, and bucket totals run over the buckets. A
    source of any size is spread over many buckets; no task holds a source.
    """
    n = counts.count()
    buckets = max(1, -(-n // BUCKET_DOCS))
    h = F.xxhash64("doc_id", F.lit(seed))
    dealt = counts.withColumn("__h", h).withColumn("__b", F.floor((h / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    totals = dealt.groupBy("source", "__b").agg(F.sum("tokens").alias("__t"))
    starts = totals.select("source", "__b", (F.sum("__t").over(Window.partitionBy("source").orderBy("__b")) - F.col("__t")).alias("__s"))
    inside = F.sum("tokens").over(Window.partitionBy("source", "__b").orderBy("__h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    summed = dealt.withColumn("__i", inside).join(starts, ["source", "__b"])
    return summed.select("doc_id", "source", "tokens", (F.col("__s") + F.col("__i")).alias("before"))


def mix(counts: DataFrame, shares: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, copy, tokens, position): the documents of the mixture with their place in [0, 1].

    A source's demand is met by whole passes and a last partial one, in an
    order by hash; a document is taken if its middle lies within the demand.
    Documents without tokens or without a target source are left out. Rows
    with the same id count as separate documents.
    """
    # As many rows as targets: a table with a proven bound.
    wanted = F.broadcast(shares.where("demand > 0").select("source", "available", "demand", "slope"))
    placed = running_tokens(counts.where("tokens > 0 and source is not null"), seed).join(wanted, "source")
    passes = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("demand") / F.col("available")).cast("int") - 1))
    copies = placed.withColumn("copy", F.explode(passes))
    middle = F.col("copy") * F.col("available") + F.col("before") + F.col("tokens") / 2
    copies = copies.withColumn("__y", middle / F.col("demand")).where("__y <= 1")
    # Demand up to t is t + slope * (t * t - t), of all; its inverse is the position.
    k, y = F.col("slope"), F.col("__y")
    root = F.sqrt((1 - k) * (1 - k) + 4 * k * y)
    position = F.when(F.abs(k) < 1e-9, y).otherwise((root - (1 - k)) / (2 * k))
    return copies.select("doc_id", "source", F.col("copy").cast("int").alias("copy"), "tokens", F.round(position, 12).alias("position"))


def in_order(mixture: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-sorted by position: the partitions follow each other, each sorted inside."""
    keys = ["position", "doc_id", "copy"]
    return (mixture.repartitionByRange(partitions, *keys) if partitions else mixture.repartitionByRange(*keys)).sortWithinPartitions(*keys)


def report(mixture: DataFrame, shares: DataFrame) -> DataFrame:
    """Per target source: target share, actual share of tokens, tokens, documents used and most copies of one."""
    used = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"), (F.max("copy") + 1).alias("repeats"))
    out = shares.select("source", "target_share", "max_repeats", "share", "available").join(used, "source", "left")
    total = F.sum("tokens").over(Window.partitionBy())
    return out.select(
        "source", "target_share", F.col("share").alias("scaled_share"), F.coalesce(F.try_divide("tokens", total), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("repeats", F.lit(0)).alias("repeats"), "max_repeats", "available",
    )
