"""Session settings and table access shared by all plans."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rosterlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed zone; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    return ship((builder.master(master) if master else builder).getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python, once per application, so that they needn't have it installed."""
    context = spark.sparkContext
    if not getattr(context, "_has_rosterlake", False):
        root = Path(__file__).resolve().parent
        # Only the driver reads this file; Spark's own file server hands it on.
        target = Path(tempfile.mkdtemp(prefix="rosterlake-")) / "rosterlake.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(target))
        context._has_rosterlake = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables. Timestamps without a zone are read as they are."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    ``spark.checkpoint.dir`` of the session wins. Only a local master, as in
    tests, gets a temporary folder of its own when the setting is missing.
    """
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        spark.sparkContext.setCheckpointDir(set_dir)
        return set_dir
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = Path(tempfile.gettempdir()) / f"rosterlake-{os.getuid()}-{os.getpid()}"
    own.mkdir(parents=True, exist_ok=True)
    spark.sparkContext.setCheckpointDir(own.as_uri())
    return own.as_uri()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage; survives lost executors.

    The last stage is computed twice by a reliable checkpoint: for one that
    runs Python ``written`` is the better way.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read from there: lineage ends, lost executors cost a retry.

    Unlike a checkpoint it is computed once, and only the columns asked for are
    read again. What an application has written is removed when it ends.
    """
    return _write(df, f"{_WITHIN.get() or scratch(df.sparkSession)}/{uuid4().hex}")


def kept(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``written`` of what ``make`` gives; all that was written inside ``make`` is removed then.

    So a job of many steps holds no more of the shared folder than the step at hand needs.
    """
    above = _WITHIN.get() or scratch(spark)
    inner = f"{above}/{uuid4().hex}"
    token = _WITHIN.set(inner)
    try:
        return _write(make(), f"{above}/{uuid4().hex}")
    finally:
        _WITHIN.reset(token)
        _delete(spark, inner)


#: The folder of what is written inside ``kept``.
_WITHIN: ContextVar[str | None] = ContextVar("within", default=None)
#: Spark's setting that removes the shuffle files of an action when it ends, not when the driver's garbage is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


class Growing:
    """A table in the shared folder to which passes append; it is always read as one scan, however many there were."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.schema = spark, f"{scratch(spark)}/{uuid4().hex}", None

    def add(self, df: DataFrame) -> DataFrame:
        """Append ``df`` and give the whole table."""
        self.schema = self.schema or df.schema
        df.write.mode("append").parquet(self.path)
        return self.spark.read.schema(self.schema).parquet(self.path)


def scratch(spark: SparkSession) -> str:
    """This application's part of the shared folder, removed when it ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/rosterlake-{spark.sparkContext.applicationId}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


_SCRATCH: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    """Best effort: a session that was stopped before has no way left to remove its files."""
    context = SparkContext._active_spark_context
    if context is None or context is not spark.sparkContext:
        return
    try:
        _delete(spark, folder)
    except Exception:  # noqa: BLE001 - the gateway may be gone
        pass


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read in fewer parts than there are, as a single small file is; else as it is.

    What is moved then is at most the cores' number of input splits; a large
    table is never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
