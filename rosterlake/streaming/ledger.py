"""A durable ledger of work that can be resumed.

Work is kept as rows (run, phase, key, status, payload, error, at). What counts
for a key is its latest row, but done is never undone by a later error. Data are
written before the mark that they are there, so that a mark is never without
its data; a mark that is missing only repeats work.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.sources.files import VersionedTable, children, exists, remove

SCHEMA = "run string, phase string, key string, status string, payload string, error string, at timestamp"


def standing(log: DataFrame) -> DataFrame:
    """(run, phase, key, status, payload, error, at): done if it ever was, else the latest row."""
    order = F.struct((F.col("status") == "done").alias("d"), "at")
    best = log.groupBy("run", "phase", "key").agg(F.max_by(F.struct("status", "payload", "error", "at"), order).alias("r"))
    return best.select("run", "phase", "key", "r.*")


def remaining(work: DataFrame, log: DataFrame, run: str, phase: str) -> DataFrame:
    """Work (key) that isn't done in this run and phase."""
    done = standing(log.where((F.col("run") == run) & (F.col("phase") == phase))).where("status = 'done'")
    return work.join(done.select("key"), "key", "left_anti")


def payloads(log: DataFrame, run: str, phase: str, schema: str) -> DataFrame:
    """(key, payload as a struct) of done work."""
    done = standing(log.where((F.col("run") == run) & (F.col("phase") == phase))).where("status = 'done'")
    return done.select("key", F.from_json("payload", schema).alias("payload"))


def progress(log: DataFrame, statuses: tuple[str, ...] = ("done", "error", "pending")) -> DataFrame:
    """One row with the number of keys of each status; missing ones are 0."""
    return standing(log).agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


class Ledger:
    """The ledger as files in a folder: per run a versioned table of marks and a folder of spooled data.

    Each batch is one append. Marks are forgotten by publishing the next
    version, so that a crash leaves the old marks or the new ones, and never
    those of another run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marks(self, run: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/marks/{quote(run, safe='')}")

    def log(self, run: str | None = None) -> DataFrame:
        """The marks of a run, or of all of them."""
        found = self.spark.createDataFrame([], SCHEMA)
        for r in [run] if run is not None else [unquote(n) for n in children(self.spark, f"{self.path}/marks")]:
            table = self._marks(r)
            version = table.version()
            if version is not None:
                found = found.unionByName(self.spark.read.schema(SCHEMA).parquet(f"{table.path}/v{version}"))
        return found

    def _state(self) -> DataFrame:
        path = f"{self.path}/runs"
        return self.spark.read.schema("run string, complete boolean, at timestamp").parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], "run string, complete boolean, at timestamp")

    def start_or_resume(self, run: str, at: str) -> bool:
        """True if an incomplete run is resumed: marks and spool stay. A new one, or one that was complete, begins without either."""
        last = self._state().where(F.col("run") == run).orderBy(F.desc("at")).take(1)
        if last and not last[0].complete:
            return True
        self.clear(run)
        remove(self.spark, f"{self.path}/spool/{quote(run, safe='')}")
        self.spark.createDataFrame([(run, False, at)], "run string, complete boolean, at string").withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(f"{self.path}/runs")
        return False

    def complete(self, run: str, at: str) -> None:
        self.spark.createDataFrame([(run, True, at)], "run string, complete boolean, at string").withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(f"{self.path}/runs")

    def clear(self, run: str, phase: str | None = None) -> None:
        """Forget a run's marks, or those of one phase."""
        table = self._marks(run)
        if table.version() is not None:
            table.write(self.log(run).where(F.lit(False) if phase is None else F.col("phase") != phase))

    def mark(self, rows: DataFrame, run: str) -> None:
        """Append a batch of the run's marks."""
        table, batch = self._marks(run), rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")])
        version = table.version()
        if version is None:
            table.write(batch)
        else:
            batch.write.mode("append").parquet(f"{table.path}/v{version}")

    def spooled(self, run: str, name: str) -> str:
        return f"{self.path}/spool/{quote(run, safe='')}/{name}"

    def spool(self, data: DataFrame, name: str, marks: DataFrame, run: str) -> None:
        """Write data, and only then the marks that it is there."""
        data.write.mode("append").parquet(self.spooled(run, name))
        self.mark(marks, run)

    def grouped(self, run: str, every: int = 100) -> GroupCommit:
        return GroupCommit(self, run, every)


class GroupCommit:
    """Marks of a loop on the driver, committed ``every`` so many and at the end; what isn't committed is done again."""

    def __init__(self, ledger: Ledger, run: str, every: int):
        self.ledger, self.run, self.every, self.held, self.commits = ledger, run, every, [], 0

    def add(self, phase: str, key: str, status: str, at: str, payload: str | None = None, error: str | None = None) -> None:
        self.held.append((self.run, phase, key, status, payload, error, at))
        if len(self.held) >= self.every:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.ledger.mark(self.ledger.spark.createDataFrame(self.held, SCHEMA.replace("timestamp", "string")), self.run)
            self.held, self.commits = [], self.commits + 1

    def __enter__(self) -> GroupCommit:
        return self

    def __exit__(self, *error) -> None:
        if error[0] is None:
            self.flush()


def resume_page(pages: DataFrame, restart: bool = False, restarts: int = 0, most_restarts: int = 3) -> DataFrame:
    """(query, page, url): where each cursor goes on: the page after its last good one.

    ``pages`` has (query, page, status, next_url). A cursor that has ended has
    a null url; one whose last page failed goes on at the last good page's
    next address. With ``restart``, as when a server has forgotten its
    cursors, every query begins at page 0 with a null url; that is done at
    most ``most_restarts`` times (RuntimeError beyond).
    """
    if restart and restarts >= most_restarts:
        raise RuntimeError(f"cursors were lost {restarts + 1} times")
    last = pages.where("status = 'ok'").groupBy("query").agg(F.max_by(F.struct("page", "next_url"), "page").alias("l"))
    every = pages.select("query").distinct().join(last, "query", "left")
    start = F.lit(restart) | F.col("l").isNull()
    return every.select("query", F.when(start, 0).otherwise(F.col("l.page") + 1).alias("page"), F.when(~start, F.col("l.next_url")).alias("url"))
