"""Streams over event files: the latest row per key, counts per window, rows without repeats, and upserts per batch.

Event times without a zone are read as UTC, since watermarks need a zone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rosterlake.session import scratch
from rosterlake.sources.files import exists


def read(spark: SparkSession, folder: str, pattern: str = "events.parquet", schema=None) -> DataFrame:
    """A stream of the parquet files of that name, with ``ts`` as a timestamp with zone."""
    schema = schema or spark.read.parquet(f"{folder}/{pattern}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(events: DataFrame, size: str, late: str, *keys: str) -> DataFrame:
    """Counts and sums per tumbling window and key; rows later than ``late`` are dropped."""
    grouped = (events.withWatermark("ts", late) if events.isStreaming else events).groupBy(F.window("ts", size).alias("w"), *keys)
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def without_repeats(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def sessions(events: DataFrame, gap: str, late: str, key: str) -> DataFrame:
    grouped = (events.withWatermark("ts", late) if events.isStreaming else events).groupBy(F.session_window("ts", gap).alias("w"), key)
    return grouped.agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def failure_alarm(events: DataFrame, key: str, kind: str, bad: str, least: int) -> DataFrame:
    """(key, failures, ts) whenever a key has had ``least`` bad events in a row; the run's length is the state."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        out = []
        for pdf in batches:
            for t, e in pdf.sort_values("ts")[["ts", kind]].itertuples(index=False):
                run = run + 1 if e == bad else 0
                if run == least:
                    out.append((k[0], run, t))
        state.update((run,))
        yield pd.DataFrame(out, columns=["key", "failures", "ts"])

    return events.groupBy(key).applyInPandasWithState(step, "key long, failures long, ts timestamp", "run long", "append", GroupStateTimeout.NoTimeout)


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process what is there and give the result as a table in the shared folder; nothing is gathered on the driver.

    In complete mode each batch replaces the table, else its rows are added under the batch's number, so that a batch
    repeated after a failure counts once.
    """
    spark = stream.sparkSession
    path = f"{scratch(spark)}/stream-{uuid4().hex}"

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/b={0 if mode == 'complete' else number}")

    query = stream.writeStream.foreachBatch(save).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}/checkpoint").start()
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("b", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/table").drop("b") if exists(spark, f"{path}/table") else spark.createDataFrame([], stream.schema)


def upsert_batches(stream: DataFrame, path: str, checkpoint: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
    """Merge each micro-batch into the state at ``path``; a batch that was applied before is passed over.

    Each batch writes a new version v<batch>; since the version is named by
    the batch, repeating a batch after a failure gives the same files.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        if exists(spark, f"{path}/v{number}/_SUCCESS"):
            return
        if number and not exists(spark, f"{path}/v{number - 1}/_SUCCESS"):
            raise RuntimeError(f"the state before batch {number} isn't at {path}")
        before = spark.read.parquet(f"{path}/v{number - 1}") if number else None
        merge(before, batch).write.mode("overwrite").parquet(f"{path}/v{number}")

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
